"""Single-node reference point: DuckDB runs the oracle's SQL restatement of the
headline queries over the same stored raw tables the Spark queries read
(median of 3 after a warm-up, result fully fetched).  Prints one JSON line.

usage: python tools/duckdb_baseline.py [sf_dir] [threads]"""

import json
import os
import statistics
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from bench import HEADLINE  # noqa: E402
from evwin.plans import catalog, oracle  # noqa: E402
from evwin.session import local_session  # noqa: E402
from evwin.sources.raw import stored_raw_tables  # noqa: E402


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    threads = int(sys.argv[2]) if len(sys.argv) > 2 else 8
    spark = local_session(threads)
    r = stored_raw_tables(spark, sf_dir)
    paths = {n: getattr(r, n).inputFiles() for n in ("ipo_events", "daily_prices", "symbol_map", "company_profiles")}
    spark.stop()
    con = duckdb.connect()
    con.execute(f"SET threads = {threads}")
    views = {"raw_events": "ipo_events", "raw_prices": "daily_prices", "raw_map": "symbol_map",
             "raw_profiles": "company_profiles"}
    for v, t in views.items():
        files = ", ".join(f"'{f.replace('file:', '')}'" for f in paths[t])
        con.execute(f"CREATE VIEW {v} AS SELECT * FROM read_parquet([{files}], hive_partitioning = true)")
    out = {}
    for k in HEADLINE:
        if k not in catalog.FINAL_SQL:
            continue
        sql = oracle.on_stored_tables(catalog.FINAL_SQL[k])
        con.execute(sql).fetchall()
        ts = []
        for _ in range(3):
            t = time.perf_counter()
            con.execute(sql).fetchall()
            ts.append(time.perf_counter() - t)
        out[k] = round(statistics.median(ts), 4)
    print(json.dumps({"engine": "duckdb", "threads": threads, "value": round(sum(out.values()), 4),
                      "queries": out, "sf": os.path.basename(sf_dir.rstrip("/"))}))


if __name__ == "__main__":
    main()
