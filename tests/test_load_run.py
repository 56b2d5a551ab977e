"""The load and backfill runs, their counters and run table, and the days of series."""

import datetime as dt
import json
import os
import random
import tempfile
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from evwin.config import Params
from evwin.operators import price_days as PD
from evwin.operators import worklist as W
from evwin.plans import load_run as R
from evwin.plans import quality as Q
from evwin.session import ensure_checkpoint_dir
from evwin.sources import schemas as S
from evwin.sources import versioned as V
from evwin.sources.raw import with_month

AS_OF = dt.date(2001, 6, 30)
NOW = dt.datetime(2001, 6, 30, 9)
P = Params(as_of=AS_OF)


def _clock():
    return iter(NOW + dt.timedelta(minutes=i) for i in range(9)).__next__


def _write(folder, feed, lines):
    os.makedirs(f"{folder}/{feed}", exist_ok=True)
    with open(f"{folder}/{feed}/a.txt", "w") as f:
        f.write("\n".join(json.dumps(x) for x in lines))


@pytest.fixture
def scene(spark):
    """Empty tables, and landed feeds for four listings: AA found and priced, BB priced by the
    second vendor only, CC without a match, DD whose calls fail."""
    base = tempfile.mkdtemp(prefix="evwin-run-")
    land, t = f"{base}/land", R.Tables(spark, f"{base}/tables")
    for name, schema in (("ipo_events", S.IPO_EVENTS), ("company_profiles", S.COMPANY_PROFILES), ("symbol_map", S.SYMBOL_MAP), ("daily_prices", S.DAILY_PRICES)):
        t.create(name, spark.createDataFrame([], schema))
    events = [{"date": "2001-05-01", "name": f"Co {s}", "symbol": s, "exchange": "NYSE"} for s in ("AA", "BB", "CC", "DD")]
    _write(land, "calendar", [{"ipoCalendar": events + events[:1]}])
    _write(land, "finnhub_profile", [{"symbol": "AA", "payload": json.dumps({"ticker": "AA", "finnhubIndustry": "Tech"})},
                                     {"symbol": "BB", "payload": "{}"}, {"symbol": "DD", "error": "timeout"},
                                     {"symbol": "ZZ", "payload": json.dumps({"ticker": "ZZ", "finnhubIndustry": "x"})}])
    _write(land, "yahoo_profile", [{"symbol": s, "payload": json.dumps({"longName": s, "sector": "Sec"})} for s in ("AA", "BB")])
    _write(land, "alpha_search", [{"symbol": s, "payload": json.dumps({"bestMatches": [{"1. symbol": s + "X"}]})} for s in ("AA", "BB")]
           + [{"symbol": "CC", "payload": '{"bestMatches": []}'}])
    quote = lambda s, x="NYQ": json.dumps({"quotes": [{"symbol": s, "exchange": x, "quoteType": "EQUITY"}]})
    _write(land, "yahoo_search", [{"symbol": "AA", "payload": quote("AA")}, {"symbol": "BB", "payload": quote("BB")},
                                  {"symbol": "CC", "payload": quote("CC", "LSE")}, {"symbol": "DD", "error": "timeout"}])
    series = {"Time Series (Daily)": {"2001-05-02": {"4. close": "7"}, "2001-05-03": {"4. close": "8"}}}
    _write(land, "series", [{"symbol": "BBX", "payload": json.dumps(series)}, {"symbol": "AAX", "payload": json.dumps(series)}])
    _write(land, "bars_errors", [{"symbol": "BB", "error": "timeout"}])
    rows = [("AA", dt.datetime(2001, 5, 2), 1.0), ("AA", dt.datetime(2001, 6, 20), 2.0), ("BB", dt.datetime(2001, 6, 21), 3.0)]
    spark.createDataFrame(rows, "symbol string, Date timestamp, Close double").write.parquet(f"{land}/bars")
    return t, land


def test_a_load_run_from_landed_files_to_the_run_table(scene):
    t, land = scene
    got = R.load_run(t, land, "r1", P, use_fallback=True, clock=_clock())
    assert got == dict(ipos=5, fh_profiles=1, yh_profiles=1, alpha_map_attempted=3, alpha_map_priceable=2, alpha_map_not_priceable=1,
                       yahoo_map_attempted=4, yahoo_map_priceable=2, yahoo_map_not_priceable=2, prices_tickers=2, prices_rows=4,
                       with_data=2, no_data=0, failed=1, yahoo_used=1, alpha_used=1)
    assert t.read("ipo_events").count() == 4
    assert {(r.source, r.symbol) for r in t.read("company_profiles").collect()} == {("finnhub", "AA"), ("yahoo", "BB")}
    notes = {(r.vendor, r.ipo_symbol): r.notes for r in t.read("symbol_map").collect()}
    assert notes["yahoo", "DD"] == "yahoo_search:error:timeout" and notes["yahoo", "AA"].endswith("with_history")
    assert sorted((r.symbol, r.price_date.day, r.close) for r in t.read("daily_prices").collect()) == [
        ("AA", 2, Decimal(1)), ("AA", 20, Decimal(2)), ("BBX", 2, Decimal(7)), ("BBX", 3, Decimal(8))]
    (row,) = t.read("ingestion_runs").collect()
    assert (row.run_id, row.source, row.status) == ("r1", R.MAIN_RUN, "success") and row.finished_at > row.started_at
    assert row.notes == ", ".join(f"{k}={got[k]}" for k in R.MAIN_COUNTERS) and len(R.MAIN_COUNTERS) == 16
    runs = os.path.join(ensure_checkpoint_dir(t.spark), "evwin")
    assert not [n for n in os.listdir(runs) if n.startswith("run-") and os.listdir(os.path.join(runs, n))]    # what it wrote on the way is gone
    # nothing new has landed: the same files are known, and marks leave only the bar whose download failed
    again = R.load_run(t, land, "r2", P, use_fallback=True, clock=_clock())
    assert (again["ipos"], again["fh_profiles"], again["alpha_map_attempted"], again["prices_rows"]) == (0, 0, 0, 1)
    assert t.read("daily_prices").filter("symbol = 'BB'").count() == 1 and t.read("ingestion_runs").count() == 2


def test_a_run_that_fails_is_recorded_raised_and_can_be_repeated(scene, monkeypatch):
    t, land = scene
    seen = []

    def dies(*args, **kwargs):
        seen.extend(r.status for r in t.read("ingestion_runs").collect())
        raise ValueError("vendor gone")
    monkeypatch.setattr(R, "load_prices", dies)
    with pytest.raises(ValueError, match="vendor gone"):
        R.load_run(t, land, "r1", P, clock=_clock())
    assert seen == ["running"]
    (row,) = t.read("ingestion_runs").collect()
    assert (row.status, row.notes) == ("failed", "vendor gone")
    monkeypatch.undo()
    got = R.load_run(t, land, "r2", P, use_fallback=True, clock=_clock())     # files were not recorded: they are taken again
    assert got["ipos"] == 5 and got["prices_rows"] == 4
    assert sorted((r.run_id, r.status) for r in t.read("ingestion_runs").collect()) == [("r1", "failed"), ("r2", "success")]


def test_a_missing_calendar_fails_the_run(spark, scene):
    t, land = scene
    with pytest.raises(R.MissingFeed):
        R.load_run(t, land + "-none", "r1", P, clock=_clock())
    assert [r.notes for r in t.read("ingestion_runs").collect()] == ["feed 'calendar' has not landed"]


def test_a_backfill_takes_the_mart_s_symbols_in_its_order(spark, scene):
    t, land = scene
    day = dt.date(2001, 5, 1)
    coverage = spark.createDataFrame([("e1", "AA", "AA", "yahoo", day, "partial_coverage", 30), ("e2", "QQ", "AA", "yahoo", day, "mapped_but_no_prices", None),
                                      ("e3", "GG", "GG", "yahoo", day, "good_coverage", 70), ("e4", "FF", "FF", "yahoo", dt.date(2001, 7, 9), "very_low_coverage", 1)],
                                     "event_id string, ipo_symbol string, price_symbol string, price_vendor string, ipo_date date, coverage_status string, distinct_price_days long")
    got = R.backfill_run(t, land, "b1", coverage, P, clock=_clock())
    # e2 goes first and loads the series; e1 finds nothing left
    assert got == dict(attempted=2, rows=2, with_data=1, no_data=1, failed=0, yahoo_used=2, alpha_used=0)
    (row,) = t.read("ingestion_runs").collect()
    assert row.source == R.BACKFILL_RUN and row.notes.startswith("attempted=2, rows=2, ")


# ---- days of series ----------------------------------------------------------
_PX = "source string, symbol string, price_date date, v int"


def _prices(spark, rows):
    return with_month(spark.createDataFrame(rows, _PX))


def test_days_follow_loads_in_any_order(spark):
    for seed in range(2):
        rnd = random.Random(seed)
        base = tempfile.mkdtemp(prefix="evwin-days-")
        held = {}
        for _ in range(4):
            batch = {(rnd.choice(["a", "y"]), f"S{rnd.randrange(3)}", dt.date(2001, 1, 1) + dt.timedelta(rnd.randrange(90))): rnd.randrange(9) for _ in range(25)}
            held |= batch
            df = _prices(spark, [(*k, v) for k, v in batch.items()])
            R.upsert_partitioned(spark, f"{base}/p", df, ["source", "symbol", "price_date"], "price_month")
            PD.follow(spark, f"{base}/d", df)
        prices, days = V.read(spark, f"{base}/p"), V.read(spark, f"{base}/d")
        assert sorted(days.collect()) == sorted(PD.days_of(prices).collect()) and prices.count() == len(held)
        for lo, hi in ((None, None), (dt.date(2001, 1, 15), dt.date(2001, 2, 28)), (dt.date(2001, 1, 31), dt.date(2001, 1, 31)), (None, dt.date(2001, 3, 1))):
            want = {}
            for s, y, d in held:
                if (lo is None or d >= lo) and (hi is None or d <= hi):
                    want[s, y] = max(want.get((s, y), d), d)
            assert {(r.source, r.symbol): r.hwm for r in PD.high_water_marks(days, None, lo, hi).collect()} == want
            if lo and hi:
                assert {r.symbol for r in PD.with_history(days, "a", hi, (hi - lo).days).collect()} == {y for s, y in want if s == "a"}
        wl = spark.createDataFrame([("L", f"S{i}", dt.date(2001, 2, 1)) for i in range(4)], "ipo_symbol string, vendor_symbol string, ipo_date date")
        by_days = W.load_windows(wl, None, source="y", as_of=AS_OF, marks=PD.high_water_marks(days))
        assert sorted(by_days.collect()) == sorted(W.load_windows(wl, prices, source="y", as_of=AS_OF).collect())


def test_price_keys_are_checked_by_days(spark):
    rows = [("a", "S", dt.date(2001, 1, d), 1) for d in (1, 2, 2, 2, 31)] + [("a", "T", dt.date(2001, 1, 2), 1)] * 2 + [
        ("y", "S", dt.date(2001, 1, 2), 1), (None, "S", dt.date(2001, 2, 1), 1), (None, "S", dt.date(2001, 2, 1), 2), ("a", None, dt.date(2001, 2, 1), 1),
        ("a", "S", None, 1), ("a", "S", None, 2), ("y", "S", None, 1)]
    for some in (rows, rows[4:6], rows[:2], []):
        p = _prices(spark, some)
        tables = {"daily_prices": (p, ("source", "symbol", "price_date"))}
        assert sorted(Q.key_checks(tables, days=PD.days_of(p)).collect()) == sorted(Q.key_checks(tables).collect())


def test_price_key_check_shuffles_no_price_keys(spark):
    """Below the only exchange over prices stands the semi-join with doubtful months."""
    import contextlib
    import io

    from conftest import SF0001
    from evwin.plans import catalog
    g = catalog.graph(spark, SF0001)
    df = Q.key_checks({"daily_prices": (g.raw.daily_prices, ("source", "symbol", "price_date"))}, days=g.price_days)
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    plan = out.getvalue()
    assert "dynamicpruning" in plan and "LeftSemi" in plan
    assert df.filter("status <> 'pass'").count() == 0


def test_load_windows_read_no_price_file(spark):
    from conftest import SF0001
    from evwin.plans import catalog
    files = catalog.QUERIES["load_windows"](spark, SF0001).inputFiles()
    assert files and not any("daily_prices" in f for f in files)
    assert not any("daily_prices" in f for f in catalog.QUERIES["history_check"](spark, SF0001).inputFiles())


def test_a_clone_reads_the_source_until_its_own_commits(spark):
    base = tempfile.mkdtemp(prefix="evwin-clone-")
    rows = _prices(spark, [("y", "S", dt.date(2001, m, d), d) for m in (1, 2) for d in (1, 2)])
    V.create(spark, f"{base}/a", rows, "price_month", ("price_month", "symbol"))
    V.clone(spark, f"{base}/a", f"{base}/b")
    held = lambda t: sorted((r.price_date, r.v) for r in V.read(spark, f"{base}/{t}").collect())
    before, files = held("a"), V.read(spark, f"{base}/a").inputFiles()
    assert held("b") == before and not [n for n in os.listdir(f"{base}/b") if n.startswith("version=")]     # no row is copied
    for v in (7, 8, 9):     # more states than a vacuum keeps
        R.upsert_partitioned(spark, f"{base}/b", _prices(spark, [("y", "S", dt.date(2001, 2, 2), v), ("y", "S", dt.date(2001, 3, 1), v)]),
                             ["source", "symbol", "price_date"], "price_month")
    assert held("a") == before and sorted(V.read(spark, f"{base}/a").inputFiles()) == sorted(files)
    assert held("b") == [*before[:3], (dt.date(2001, 2, 2), 9), (dt.date(2001, 3, 1), 9)]
    V.create(spark, f"{base}/e", _prices(spark, [("y", "S", dt.date(2001, 2, 1), 5)]), "price_month", ("price_month",), {"2001-01": V._folder(f"{base}/a", V.snapshot(spark, f"{base}/a").parts["2001-01"])})
    assert held("e") == [*before[:2], (dt.date(2001, 2, 1), 5)]
    V.clone(spark, f"{base}/b", f"{base}/c")
    assert held("c") == held("b") and V.read(spark, f"{base}/c", parts=["2001-01"]).count() == 2
    with pytest.raises(FileNotFoundError):
        V.clone(spark, f"{base}/none", f"{base}/d")


def test_a_query_of_one_run_builds_that_run_only(spark):
    """Of the feeds those that the run takes, and no other run; the run table needs both."""
    from evwin.plans import catalog
    from evwin.sources.payloads import FEEDS
    base = tempfile.mkdtemp(prefix="evwin-tables-")
    write = lambda name, rows, schema: spark.createDataFrame(rows, schema).write.parquet(f"{base}/{name}.parquet")
    write("part", [(k, f"p{k}", "b", "t", 1, 2.0) for k in range(1, 90)], "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double")
    write("supplier", [(k, k % 3) for k in range(1, 6)], "s_suppkey long, s_nationkey long")
    write("lineitem", [(i, i % 4 + 1, i % 5 + 1, 10.0 + i, 2.0, dt.date(2001, 3, 1) + dt.timedelta(i)) for i in range(120)],
          "l_orderkey long, l_linenumber int, l_suppkey long, l_extendedprice double, l_quantity double, l_shipdate date")
    root = catalog.graph(spark, base).raw.root.removeprefix("file:")
    built = lambda: {n.rsplit("-", 1)[0] for n in os.listdir(root)} if os.path.exists(root) else set()
    feeds = lambda: {n[len("landing-"):] for n in built() if n.startswith("landing-")} & set(FEEDS)
    prices = catalog.QUERIES["backfill_run_prices"](spark, base)
    assert feeds() == {"series", "bars", "bars_errors"} and "run-backfill" in built() and "run-main" not in built()
    loaded = catalog.QUERIES["load_run_prices"](spark, base)
    assert feeds() == set(FEEDS) - {"triage", "vendor_search"}
    keys = lambda df: {(r.source, r.symbol, r.price_date) for r in df.collect()}
    before = {f for f in loaded.inputFiles() if "/price_month=2001-03/" in f}
    assert before and all("/daily_prices/v-" in f for f in before)      # months before the load are those of the store, not copies
    seed = keys(catalog.graph(spark, base).raw.daily_prices.filter(F.col("price_date") <= F.lit(catalog.O.LOAD_CUTOFF)))
    assert seed and seed < keys(loaded) and seed <= keys(prices)
    audit = catalog.QUERIES["run_audit"](spark, base).collect()
    assert sorted((r.run_id.split("-")[0], r.status) for r in audit) == [("backfill", "success"), ("lost", "failed"), ("main", "success")]
