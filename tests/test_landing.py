"""Landed payload files: order, files landed twice, the record, whole documents and envelopes."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from evwin.operators import ingest as I
from evwin.sources import landing as L
from evwin.sources import versioned as V


@pytest.fixture
def place():
    base = tempfile.mkdtemp(prefix="evwin-landing-")
    return os.path.join(base, "land"), os.path.join(base, "record")


def _put(folder, name, text, at):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)
    os.utime(path, (at, at))


def _calendar(*events):
    return json.dumps({"ipoCalendar": [{"date": "2001-01-02", "name": n, "symbol": "S", "exchange": x} for n, x in events]})


def test_last_landed_document_wins_whatever_its_name(spark, place):
    land, record = place
    _put(land, "calendar/z.json", _calendar(("Co", "NYSE"), ("Other", "OTC")), 1000)
    _put(land, "calendar/sub/a.json", _calendar(("Co", "NASDAQ")), 2000)
    load = L.take(spark, land, "calendar", record, per_line=False, run_id="r1")
    events = I.event_key_dedupe(I.calendar_parse(load.rows, seq_col="seq"))
    assert {(r.company_name, r.exchange) for r in events.collect()} == {("Co", "NASDAQ"), ("Other", "OTC")}


def test_a_file_landed_twice_counts_once(spark, place):
    land, record = place
    text = _calendar(("Co", "NYSE"))
    for i, name in enumerate(("b.json", "a.json", "again/b.json")):
        _put(land, f"calendar/{name}", text, 1000 + i)
    _put(land, "calendar/new.json", _calendar(("New", "NYSE")), 5000)
    load = L.take(spark, land, "calendar", record, per_line=False, run_id="r1")
    assert load.files.count() == 4 and load.rows.count() == 2
    assert min(r.seq.path for r in load.rows.collect()).endswith("calendar/b.json")   # the first to land
    # not settled: the same files are taken again
    assert L.take(spark, land, "calendar", record, per_line=False, run_id="r2").rows.count() == 2
    L.settle(load)
    assert L.take(spark, land, "calendar", record, per_line=False, run_id="r2").files.count() == 0
    # an old document under a new name, a changed file, another feed with the same bytes
    _put(land, "calendar/copy.json", text, 9000)
    _put(land, "calendar/new.json", _calendar(("Newer", "NYSE")), 9001)
    _put(land, "other/b.json", text, 9002)
    second = L.take(spark, land, "calendar", record, per_line=False, run_id="r2")
    assert second.files.count() == 2
    assert [json.loads(r.payload)["ipoCalendar"][0]["name"] for r in second.rows.collect()] == ["Newer"]
    L.settle(second)
    assert L.take(spark, land, "other", record, per_line=False, run_id="r2").rows.count() == 1
    got = V.read(spark, record)
    assert got.count() == 6 and {r.run_id for r in got.collect()} == {"r1", "r2"}


def test_envelopes_lines_and_lines_that_are_none(spark, place):
    land, record = place
    lines = [json.dumps({"symbol": "A", "date_from": "2001-01-01", "date_to": "2001-01-31", "payload": '{"Note": "x"}'}),
             "", json.dumps({"symbol": "B", "error": "timeout"}), '{"symbol": "C", "payl', "   "]
    _put(land, "series/one.txt", "\n".join(lines), 1000)
    load = L.take(spark, land, "series", record, per_line=True, run_id="r")
    got = {r.seq.line: (r.symbol, str(r.date_to), r.payload, r.error) for r in load.rows.collect()}
    assert got[0] == ("A", "2001-01-31", '{"Note": "x"}', None)
    assert got[2] == ("B", "None", None, "timeout")
    assert got[3][2] == lines[3] or got[3][0] == "C"      # cut off: no symbol or payload is made up
    assert sorted(got) == [0, 2, 3]


def test_no_folder_and_empty_files(spark, place):
    land, record = place
    assert L.take(spark, land, "none", record, per_line=True, run_id="r").rows.count() == 0
    _put(land, "empty/e.json", "", 1000)
    _put(land, "empty/a name with % and é.json", "{}", 1000)
    load = L.take(spark, land, "empty", record, per_line=False, run_id="r")
    assert [r.payload for r in load.rows.collect()] == ["{}"]
    assert I.calendar_parse(load.rows, seq_col="seq").count() == 0
    L.settle(load)
    assert L.take(spark, land, "empty", record, per_line=False, run_id="r").files.count() == 0


def test_landed_rows_come_back(spark, place):
    land, record = place
    docs = spark.createDataFrame([(i, json.dumps({"data": [{"name": f"n{i}"}]})) for i in range(5)], "batch_seq long, payload string")
    L.land_documents(docs, f"{land}/docs")
    load = L.take(spark, land, "docs", record, per_line=False, run_id="r")
    assert {r.payload.strip() for r in load.rows.collect()} == {r.payload for r in docs.collect()}
    rows = docs.select(F.concat(F.lit("S"), "batch_seq").alias("symbol"), "payload")
    L.land_envelopes(rows, f"{land}/env")
    back = L.take(spark, land, "env", record, per_line=True, run_id="r").rows.select("symbol", "payload")
    assert sorted(back.collect()) == sorted(rows.collect())


def test_a_large_file_of_envelopes_is_read_by_several_tasks(spark, place):
    land, record = place
    lines = [json.dumps({"symbol": f"S{i}", "payload": "x" * (i % 700)}) for i in range(3000)]
    swapped = [lines[1], lines[0], *lines[2:]]
    for name, held, end, at in (("a", lines, "\n", 1000), ("b", lines, "\n", 1001), ("c", swapped, "\n", 1002), ("d", lines, "\r\n", 1003)):
        _put(land, f"series/{name}.txt", end.join(held), at)
    digests, before = [], spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size in ("16k", "100k", "64m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            load = L.take(spark, land, "series", record, per_line=True, run_id="r")
            tasks = load.rows.groupBy(F.spark_partition_id()).count().count()
            rows = sorted(load.rows.collect(), key=lambda r: r.seq)
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        assert tasks > 3 or size == "64m"
        # a file with the same lines in another order, or with other line ends, is another file
        assert [(r.seq.path[-5:], r.symbol, len(r.payload)) for r in rows] == [
            (f"{name}.txt", d["symbol"], len(d["payload"])) for name, held in (("a", lines), ("c", swapped), ("d", lines)) for d in map(json.loads, held)]
        digests.append({r.path[-5:]: r.digest for r in load.files.collect()})
    assert digests[0] == digests[1] == digests[2] and len(set(digests[0].values())) == 3


def test_a_series_is_parsed_once_however_its_rows_are_filtered(spark, place):
    """Neither the filters of the parser nor those of a reader bring a second parse of a line or a payload."""
    land, record = place
    day = {f: "1" for f in I.SERIES_FIELDS}
    good = json.dumps({I.SERIES_KEY: {"2001-05-02": day, "2001-07-02": day}})
    bad = json.dumps({I.SERIES_KEY: {"2001-05-02": day, "2001-05-03": day | {"4. close": "x"}}})
    _put(land, "series/a.txt", "\n".join(map(json.dumps, ({"symbol": "A", "payload": good}, {"symbol": "B", "payload": bad}, {"symbol": "C", "error": "timeout"}))), 1000)
    rows = L.take(spark, land, "series", record, per_line=True, run_id="r").rows
    window = [F.lit(d).cast("date").alias(c) for d, c in (("2001-03-02", "date_from"), ("2001-06-30", "date_to"))]
    bars = I.daily_series_flatten(rows.select("symbol", "payload", *window)).filter("symbol <> 'Z' and close > 0")
    plan = bars._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 2 and plan.count("parseJson(") == 1     # the envelope's and the series'; the payload's whole
    assert [(r.symbol, str(r.price_date), r.volume) for r in bars.collect()] == [("A", "2001-05-02", 1)]
    errors = rows.filter("error is not null").select("symbol")
    assert errors._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1 and [r.symbol for r in errors.collect()] == ["C"]
    read = I.series_bars(rows.select("symbol", "error", "payload", *window))    # as a run keeps it: the bars and the failed calls
    assert [(r.symbol, r.error, r.bars and len(r.bars)) for r in read.orderBy("symbol").collect()] == [("A", None, 1), ("B", None, None), ("C", "timeout", None)]
    assert I.daily_series_flatten(read).collect() == I.daily_series_flatten(rows.select("symbol", "payload", *window)).collect()
