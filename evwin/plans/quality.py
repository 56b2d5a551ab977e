"""Data-quality checks Q01-Q04: not-null and uniqueness tests on models and
raw keys, with severities.  Each check is an aggregate (no collect); the
result is a small check table: (model, column, test, failures, severity,
status)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evwin.operators.price_days import doubtful

# --- fixed values: the tests the reference declares ---------------------------
NOT_NULL_TESTS = {
    "listings_recent": [("event_id", "error"), ("ipo_date", "error"), ("ipo_symbol", "error"),
                        ("price_symbol", "warn"), ("industry", "warn"), ("sector", "warn")],
    "window_prices_30d": [("event_id", "error"), ("price_date", "error"), ("close", "error"),
                          ("price_source", "error")],
    "metrics_30d": [("event_id", "error"), ("ipo_date", "error"), ("coverage_status_30d", "error")],
    "coverage_summary_30d": [("coverage_status", "error")],
    "benchmarks_30d": [("industry", "error")],
}
UNIQUE_TESTS = {"listings_recent": ["event_id"], "metrics_30d": ["event_id"]}
# -----------------------------------------------------------------------------

CHECK_SCHEMA = "model string, column string, test string, failures bigint, severity string"


def _status(df: DataFrame) -> DataFrame:
    f, sev = F.col("failures"), F.col("severity")
    return df.withColumn("status", F.when(f == 0, "pass").when(sev == "warn", "warn").otherwise("fail"))


def not_null_checks(df: DataFrame, model: str, tests: list[tuple[str, str]]) -> DataFrame:
    """Q01: one aggregate per model, unpivoted to one row per column."""
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c, _ in tests])
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("bigint").alias("failures"),
                                        F.lit(sev).alias("severity")) for c, sev in tests]))
    out = agg.select(rows.alias("r")).select(
        F.lit(model).alias("model"), "r.column", F.lit("not_null").alias("test"), "r.failures", "r.severity")
    return _status(out)


def unique_check(df: DataFrame, model: str, column: str, severity: str = "error") -> DataFrame:
    """Q02: number of key values that occur more than once (NULL excluded)."""
    dup = (df.filter(F.col(column).isNotNull()).groupBy(column).count().filter(F.col("count") > 1)
           .agg(F.count(F.lit(1)).cast("bigint").alias("failures")))
    return _status(dup.select(F.lit(model).alias("model"), F.lit(column).alias("column"),
                              F.lit("unique").alias("test"), "failures", F.lit(severity).alias("severity")))


def model_checks(models: dict[str, DataFrame]) -> DataFrame:
    """Q01 + Q02 + Q03 over the named model DataFrames."""
    parts = [not_null_checks(models[m], m, t) for m, t in NOT_NULL_TESTS.items() if m in models]
    parts += [unique_check(models[m], m, c) for m, cols in UNIQUE_TESTS.items() if m in models for c in cols]
    return reduce(DataFrame.unionByName, parts)


def verdict(checks: DataFrame) -> DataFrame:
    """Q03 overall: fail if an error-severity test fails, else warn if a warn
    test fails, else pass; with counts."""
    st = F.col("status")
    return checks.agg(
        F.count(F.lit(1)).alias("tests"),
        F.count_if(st == "pass").alias("passed"),
        F.count_if(st == "warn").alias("warned"),
        F.count_if(st == "fail").alias("failed")).select(
        "*", F.when(F.col("failed") > 0, "fail").when(F.col("warned") > 0, "warn").otherwise("pass")
        .alias("verdict"))


def key_checks(tables: dict[str, tuple[DataFrame, tuple[str, ...]]], days: DataFrame | None = None) -> DataFrame:
    """Q04: NOT NULL and uniqueness of each raw table's (composite) key, both
    from one grouped aggregate per table (partial aggregation map-side; NULL
    keys group together, as in SQL GROUP BY).  With ``days`` (``price_days``)
    the key of ``daily_prices`` is checked without a shuffle of all its keys."""
    parts = []
    for name, (df, keys) in tables.items():
        counts = _series_counts(df, days) if name == "daily_prices" and days is not None else _key_counts(df, keys)
        rows = F.explode(F.array(
            F.struct(F.lit("not_null").alias("test"), F.col("nn").alias("failures")),
            F.struct(F.lit("unique").alias("test"), F.col("uq").alias("failures"))))
        parts.append(counts.select(rows.alias("r")).select(
            F.lit(name).alias("model"), F.lit(",".join(keys)).alias("column"), "r.test", "r.failures",
            F.lit("error").alias("severity")))
    return _status(reduce(DataFrame.unionByName, parts))


def _key_counts(df: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).select(any_null.alias("_null"), "_n")
    return g.agg(F.coalesce(F.sum(F.when(F.col("_null"), F.col("_n"))), F.lit(0)).cast("bigint").alias("nn"),
                 F.count_if(F.col("_n") > 1).cast("bigint").alias("uq"))


def _series_counts(prices: DataFrame, days: DataFrame) -> DataFrame:
    """The same counts for (source, symbol, price_date): a series has a repeated
    key in a month only where it has more dated rows than days.  Those months
    alone (none, in a sound table) are read and grouped by key."""
    null_key = F.col("source").isNull() | F.col("symbol").isNull()
    known = days.agg(F.coalesce(F.sum(F.when(null_key, F.col("n_rows")).otherwise(F.col("undated"))), F.lit(0)).cast("bigint").alias("nn"),
                     F.count_if(F.col("undated") > 1).alias("uq"))
    d = doubtful(days).select(F.col("source").alias("_s"), F.col("symbol").alias("_y"), F.col("price_month").alias("_m"))
    again = prices.join(d, (F.col("price_month") == F.col("_m")) & F.col("source").eqNullSafe(F.col("_s"))
                        & F.col("symbol").eqNullSafe(F.col("_y")), "left_semi").filter(F.col("price_date").isNotNull())
    dup = (again.groupBy("source", "symbol", "price_date").count()
           .agg(F.lit(0).cast("bigint").alias("nn"), F.count_if(F.col("count") > 1).alias("uq")))
    return known.unionByName(dup).agg(F.sum("nn").alias("nn"), F.sum("uq").alias("uq"))


def key_violations(df: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """The violating key values themselves (duplicates with their counts)."""
    return df.groupBy(*keys).count().filter(F.col("count") > 1)
