"""The load run and the backfill run as one flow each: landed files in, five stored tables
and a run table out.

``load_run`` takes the landed calendar, then profiles of both vendors, then symbol searches
of both, then prices (primary vendor, the other as a fallback); each step's worklist is
made from the tables as the steps before have left them.  ``backfill_run`` loads prices
for the listings that the coverage mart finds short.  Tables are versioned, so readers see
each step before or after its commit; counters come from ``observe`` on the writes, not
from reading again.  The run table has a row a run, ``running`` first, ``success`` with
the counters or ``failed`` with the error at the end.  Loaded files are recorded last: a
run that dies is repeated on the same files, and upserting twice changes nothing."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from evwin.config import DEFAULT_PARAMS, Params
from evwin.functions.exprs import lit_date, ts_lit
from evwin.operators import ingest as I
from evwin.operators import price_days as PD
from evwin.operators import worklist as W
from evwin.operators.upsert import key_bucket, upsert_partitioned
from evwin.session import materialize, scratch
from evwin.sources import landing as L
from evwin.sources import versioned
from evwin.sources.raw import PRICE_LAYOUT
from evwin.sources.schemas import INGESTION_RUNS, KEYS

# table -> partition column; it follows from the key, or from what never changes under one
PARTITION = {"ipo_events": "ipo_year", "company_profiles": "key_bucket", "symbol_map": "key_bucket",
             "daily_prices": "price_month", "price_days": "price_month", "ingestion_runs": "run_day"}
MAIN_RUN, BACKFILL_RUN = "ipo_ingestion", "ipo_price_backfill"
#: The feeds that each run takes.
BACKFILL_FEEDS = ("series", "bars", "bars_errors")
MAIN_FEEDS = ("calendar", "finnhub_profile", "yahoo_profile", "alpha_search", "yahoo_search", *BACKFILL_FEEDS)
MAIN_COUNTERS = ("ipos", "fh_profiles", "yh_profiles", "alpha_map_attempted", "alpha_map_priceable",
                 "alpha_map_not_priceable", "yahoo_map_attempted", "yahoo_map_priceable", "yahoo_map_not_priceable",
                 "prices_tickers", "prices_rows", "with_data", "no_data", "failed", "yahoo_used", "alpha_used")
BACKFILL_COUNTERS = ("attempted", "rows", "with_data", "no_data", "failed", "yahoo_used", "alpha_used")


def with_partition(name: str, rows: DataFrame) -> DataFrame:
    value = {"ipo_year": lambda: F.date_format("ipo_date", "yyyy"), "price_month": lambda: F.date_format("price_date", "yyyy-MM"),
             "run_day": lambda: F.date_format("started_at", "yyyy-MM-dd"), "key_bucket": lambda: key_bucket(list(KEYS[name]))}
    return rows.withColumn(PARTITION[name], value[PARTITION[name]]())


class Tables:
    """The stored tables of a folder; ``runs``: a folder whose run table they share."""

    def __init__(self, spark: SparkSession, root: str, runs: str | None = None):
        self.spark, self.root, self.runs = spark, root, runs or root

    def path(self, name: str) -> str:
        return f"{self.runs if name == 'ingestion_runs' else self.root}/{name}"

    def read(self, name: str) -> DataFrame:
        held = versioned.read(self.spark, self.path(name))
        return held if name in ("daily_prices", "price_days") else held.drop(PARTITION[name])

    def create(self, name: str, rows: DataFrame, elsewhere: dict[str, str] | None = None) -> None:
        layout = PRICE_LAYOUT if name == "daily_prices" else (PARTITION[name], *KEYS[name])
        versioned.create(self.spark, self.path(name), with_partition(name, rows), PARTITION[name], layout, elsewhere)
        if name == "daily_prices":
            versioned.create(self.spark, self.path("price_days"), PD.days_of(self.read(name)), "price_month", ("price_month", "symbol", "source"))

    def clone(self, name: str, source: Tables) -> None:
        """Begin with what ``source``, which is not written to any more, holds; prices come with their days."""
        for n in (name, "price_days") if name == "daily_prices" else (name,):
            versioned.clone(self.spark, source.path(n), self.path(n))

    def upsert(self, name: str, batch: DataFrame) -> None:
        prices = name == "daily_prices"
        follow = (lambda rows: PD.follow(self.spark, self.path("price_days"), rows)) if prices else None
        upsert_partitioned(self.spark, self.path(name), with_partition(name, batch), list(KEYS[name]), PARTITION[name],
                           PRICE_LAYOUT if prices else None, then=follow)


def observed(rows: DataFrame, /, **counters: Column) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """``rows`` with counters taken as they are written, and what reads them after that.
    Rows that the optimizer proves absent leave no counters: all are 0."""
    seen = Observation()
    out = rows.observe(seen, *[c.cast("bigint").alias(n) for n, c in counters.items()])

    def read() -> dict[str, int]:
        got = seen.get
        return {n: got.get(n) or 0 for n in counters}
    return out, read


# ---- the run table -----------------------------------------------------------
def _run_row(t: Tables, run_id: str, source: str, started: dt.datetime, finished: dt.datetime | None, status: str, notes: str | None) -> None:
    rows = t.spark.range(1).select(
        F.lit(run_id).alias("run_id"), F.lit(source).alias("source"), ts_lit(started).alias("started_at"),
        (ts_lit(finished) if finished else F.lit(None).cast("timestamp")).alias("finished_at"),
        F.lit(status).alias("status"), F.lit(notes).cast("string").alias("notes"))
    t.upsert("ingestion_runs", t.spark.createDataFrame([], INGESTION_RUNS).unionByName(rows))


def audited(t: Tables, run_id: str, source: str, order: tuple[str, ...], work: Callable[[], dict[str, int]],
            clock: Callable[[], dt.datetime] = dt.datetime.now) -> dict[str, int]:
    """Run ``work`` under a row of the run table: ``running``, then ``success`` with the
    counters as notes, or ``failed`` with the error, which is raised again."""
    started = clock()
    _run_row(t, run_id, source, started, None, "running", None)
    try:
        with scratch(t.spark):
            counters = work()
    except Exception as e:
        _run_row(t, run_id, source, started, clock(), "failed", str(e))
        raise
    _run_row(t, run_id, source, started, clock(), "success", ", ".join(f"{k}={counters[k]}" for k in order))
    return counters


# ---- steps -------------------------------------------------------------------
class MissingFeed(RuntimeError):
    """A feed that a run cannot do without has not landed."""


class _Landed:
    """The feeds of one run; their files are recorded when the run has written all."""

    def __init__(self, t: Tables, folder: str | dict[str, str], run_id: str):
        self.t, self.folder, self.run_id, self.loads = t, folder, run_id, []

    def under(self, feed: str) -> str:
        """The folder that holds the feed's."""
        return self.folder if isinstance(self.folder, str) else self.folder[feed]

    def take(self, feed: str, per_line: bool = True, needed: bool = False) -> DataFrame:
        if needed and not L.listing(self.t.spark, f"{self.under(feed)}/{feed}").take(1):
            raise MissingFeed(f"feed '{feed}' has not landed")
        load = L.take(self.t.spark, self.under(feed), feed, self.t.path("landed_files"), per_line=per_line, run_id=self.run_id)
        self.loads.append(load)
        return load.rows

    def settle(self) -> None:
        for load in self.loads:
            L.settle(load)


def _asked(rows: DataFrame, symbols: DataFrame) -> DataFrame:
    """The last response to each symbol of a worklist."""
    asked = rows.join(symbols.select(F.col("symbol").alias("_sym")), F.upper("symbol") == F.col("_sym"), "left_semi")
    return asked.groupBy("symbol").agg(F.max_by(F.struct("payload", "error"), "seq").alias("_r")).select("symbol", "_r.payload", "_r.error")


def load_events(t: Tables, landed: _Landed, now: dt.datetime) -> int:
    parsed, count = observed(I.calendar_parse(landed.take("calendar", per_line=False, needed=True), seq_col="seq"), n=F.count(F.lit(1)))
    # counted in the last stage of a write: a stage before a shuffle may run twice
    t.upsert("ipo_events", I.event_key_dedupe(materialize(parsed, "calendar-rows"), batch_ts=now))
    return count()["n"]


def load_profiles(t: Tables, rows: DataFrame, parse: Callable[[DataFrame], DataFrame], now: dt.datetime, wl: dict, limit: int | None) -> int:
    symbols = W.symbols_missing_profile(t.read("ipo_events"), t.read("company_profiles"), limit=limit, **wl)
    records = parse(_asked(rows, symbols)).filter("outcome = 'upserted'")
    batch, count = observed(I.profiles_conform(records, t.read("company_profiles").columns, now), n=F.count(F.lit(1)))
    t.upsert("company_profiles", batch)
    return count()["n"]


def load_symbols(t: Tables, rows: DataFrame, vendor: str, resolve: Callable[[DataFrame], DataFrame], now: dt.datetime, wl: dict, limit: int | None) -> dict[str, int]:
    symbols = W.unresolved_symbols(t.read("ipo_events"), t.read("symbol_map"), vendor=vendor, limit=limit, **wl)
    found = resolve(_asked(rows, symbols))
    batch, count = observed(I.symbol_map_rows(found, vendor=vendor, batch_ts=now), **I.map_counters())
    t.upsert("symbol_map", batch)
    return count()


def load_prices(t: Tables, worklist: DataFrame, staged: DataFrame, failures: DataFrame, now: dt.datetime, p: Params, *,
                turn: Column | None = None, use_fallback: bool = False) -> dict[str, int]:
    marks = PD.high_water_marks(t.read("price_days"), hi=p.as_of)
    first, second = W.fallback_windows(worklist, None, t.read("symbol_map"), as_of=p.as_of, window_days=p.long_window,
                                       turn=turn, marks=marks, failures=failures)
    outcomes, count = observed(W.turn_outcomes(first, second, staged, use_fallback=use_fallback, bucket_days=p.bucket_days), **W.run_counters())
    t.upsert("daily_prices", I.price_rows(W.loaded_bars(outcomes), batch_ts=now).drop("price_month"))
    return count()


def staged_bars(landed: _Landed, p: Params) -> tuple[DataFrame, DataFrame]:
    """Landed bars of both vendors, and the series whose download failed."""
    spark, lo = landed.t.spark, p.as_of - dt.timedelta(days=p.worklist_recent_days)
    inside = landed.take("series").select("symbol", "error", "payload", lit_date(lo).alias("date_from"), lit_date(p.as_of).alias("date_to"))
    # kept read, since responses are many times their bars of the time: for those bars and for the failed calls
    series = materialize(I.series_bars(inside), "series-bars")
    frames = spark.read.parquet(f"{landed.under('bars')}/bars")
    frames = frames.withColumns({"date_from": lit_date(lo), "date_to": lit_date(p.as_of)})
    bars = I.bars_normalise(frames, symbol_col="symbol", date_col="Date").unionByName(I.daily_series_flatten(series))
    failed = [df.filter("error is not null").select(F.lit(source).alias("source"), "symbol")
              for df, source in ((series, "alphavantage"), (landed.take("bars_errors"), "yahoo"))]
    return bars, failed[0].unionByName(failed[1])


# ---- the two runs ------------------------------------------------------------
def load_run(t: Tables, folder: str | dict[str, str], run_id: str, p: Params = DEFAULT_PARAMS, *, use_fallback: bool = False,
             profile_limits: dict[str, int | None] = {}, resolve_limits: dict[str, int | None] = {},
             clock: Callable[[], dt.datetime] = dt.datetime.now) -> dict[str, int]:
    """Landed files of ``folder`` (one, or by feed) into the tables; returns and audits the sixteen counters.
    Budgets of the worklists are unset (whole) unless given by vendor."""
    wl, now = dict(as_of=p.as_of, recent_days=p.worklist_recent_days), clock()

    def work() -> dict[str, int]:
        landed, out = _Landed(t, folder, run_id), {}
        out["ipos"] = load_events(t, landed, now)
        out["fh_profiles"] = load_profiles(t, landed.take("finnhub_profile"), I.profiles_finnhub, now, wl, profile_limits.get("finnhub"))
        out["yh_profiles"] = load_profiles(t, landed.take("yahoo_profile"), I.profiles_yahoo, now, wl, profile_limits.get("yahoo"))
        staged, failures = staged_bars(landed, p)

        def by_quotes(rows):
            history = I.history_check(I.resolve_ranked_exact(rows), staged.select("source", "symbol", "price_date"), as_of=p.as_of)
            return I.yahoo_map_rows(rows, history, error_chars=200)
        for vendor, short, feed, resolve in (("alphavantage", "alpha", "alpha_search", I.resolve_first_or_exact), ("yahoo", "yahoo", "yahoo_search", by_quotes)):
            got = load_symbols(t, landed.take(feed), vendor, resolve, now, wl, resolve_limits.get(vendor))
            out |= {f"{short}_map_{k}": v for k, v in got.items()}
        pairs = W.priceable_pairs(t.read("ipo_events"), t.read("symbol_map"), vendor="yahoo", limit=p.price_pair_limit, **wl)
        got = load_prices(t, pairs, staged, failures, now, p, use_fallback=use_fallback)
        out |= {"prices_tickers": got.pop("attempted"), "prices_rows": got.pop("rows")} | got
        landed.settle()
        return out
    return audited(t, run_id, MAIN_RUN, MAIN_COUNTERS, work, clock)


def backfill_run(t: Tables, folder: str | dict[str, str], run_id: str, coverage: DataFrame, p: Params = DEFAULT_PARAMS, *, use_fallback: bool = False,
                 clock: Callable[[], dt.datetime] = dt.datetime.now) -> dict[str, int]:
    """Prices for the listings that the coverage mart finds short, by the mart's symbol.
    Bars are staged by whoever landed them; none are recorded as loaded."""
    now = clock()

    def work() -> dict[str, int]:
        landed = _Landed(t, folder, run_id)
        staged, failures = staged_bars(landed, p)
        short = W.backfill_candidates(coverage, as_of=p.as_of, recent_days=p.worklist_recent_days, limit=p.backfill_limit)
        worklist = short.withColumn("vendor_symbol", F.col("price_symbol"))
        return load_prices(t, worklist, staged, failures, now, p, turn=W.worst_first(), use_fallback=use_fallback)
    return audited(t, run_id, BACKFILL_RUN, BACKFILL_COUNTERS, work, clock)
