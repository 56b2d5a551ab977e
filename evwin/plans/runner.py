"""Daily model run: the data work of the reference's ``dbt run`` + ``dbt test``.

Builds every model from the raw tables with one set of parameters, writes the
marts as parquet under ``out_dir`` (the staging intermediates -- listings and
the long price window -- are written once and shared by all marts, so the
window join runs once per run), then evaluates the data-quality checks on
the written marts.  Each mart is written to its own folder with overwrite,
so rerunning a failed run is safe."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from evwin.config import DEFAULT_PARAMS, Params
from evwin.plans import models as M
from evwin.plans import quality as Q

# table written -> model of the graph; a model stands after the one it reads
TABLES = {"listings_recent": "listings", "window_prices_30d": "window_short", "dim_industry": "dim_industry",
          "coverage_100d": "coverage", "coverage_summary_100d": "coverage_summary",
          "metrics_100d": "metrics_long", "benchmarks_100d": "benchmarks_long", "metrics_30d": "metrics_short",
          "coverage_summary_30d": "coverage_summary_short", "benchmarks_30d": "benchmarks_short"}
MARTS = tuple(t for t in TABLES if t not in ("listings_recent", "window_prices_30d"))


def run_models(spark: SparkSession, raw, out_dir: str, params: Params = DEFAULT_PARAMS) -> dict[str, str]:
    g = M.ModelGraph(raw, params, materialize=("listings", "window_long"))
    paths = {}
    for table, model in TABLES.items():
        paths[table] = f"{out_dir.rstrip('/')}/{table}"
        getattr(g, model).write.mode("overwrite").parquet(paths[table])
        g.written(model, spark.read.parquet(paths[table]))
    return paths


def run_checks(spark: SparkSession, paths: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """The declared tests on the written models: (check table, verdict)."""
    models = {name: spark.read.parquet(paths[name]) for name in
              ("listings_recent", "window_prices_30d", "metrics_30d", "coverage_summary_30d", "benchmarks_30d")}
    checks = Q.model_checks(models)
    return checks, Q.verdict(checks)
