"""Daily model run writes every mart and the checks run on them."""

import os
import tempfile

from conftest import SF0001
from evwin.plans.runner import MARTS, run_checks, run_models
from evwin.sources.raw import stored_raw_tables


def test_run_models_and_checks(spark):
    out = tempfile.mkdtemp(prefix="evwin-marts-")
    paths = run_models(spark, stored_raw_tables(spark, SF0001), out)
    for name in MARTS:
        assert os.path.isdir(paths[name])
    assert spark.read.parquet(paths["metrics_30d"]).count() == 54
    checks, verdict = run_checks(spark, paths)
    v = verdict.collect()[0]
    assert v.tests == 17 and v.verdict == "fail"     # NULL closes in the 30-day window fail not_null
    failing = {(r.model, r.column) for r in checks.filter("status = 'fail'").collect()}
    assert failing == {("window_prices_30d", "close")}


def test_changed_input_of_equal_length_is_read_anew(spark, tmp_path):
    """Same paths and byte lengths, other contents: queries must not answer from the old store."""
    import os
    import shutil

    import __spark_entry__ as E

    from conftest import SF0001
    for f in os.listdir(SF0001):
        shutil.copyfile(f"{SF0001}/{f}", tmp_path / f)
    before = E.queries()["view_ipos"](spark, str(tmp_path)).count()
    part = tmp_path / "part.parquet"
    old = part.stat().st_size
    spark.read.parquet(f"{SF0001}/part.parquet").filter("p_partkey <= 50").coalesce(1).write.parquet(str(tmp_path / "cut"))
    new = next((tmp_path / "cut").glob("*.parquet")).read_bytes()
    assert len(new) <= old
    shutil.copyfile(next((tmp_path / "cut").glob("*.parquet")), part)
    (tmp_path / "pad.txt").write_bytes(b" " * (old - len(new)))
    assert E.queries()["view_ipos"](spark, str(tmp_path)).count() < before


def test_a_query_takes_one_view_of_the_store(spark, monkeypatch):
    """However many helpers a query is made of, inputs are listed once and no table is opened again."""
    from evwin.plans import catalog
    calls = {"root": 0, "open": 0}
    root, opened = catalog.store_root, catalog.stored_raw_tables

    def counted(name, fn):
        def run(*args):
            calls[name] += 1
            return fn(*args)
        return run
    monkeypatch.setattr(catalog, "store_root", counted("root", root))
    monkeypatch.setattr(catalog, "stored_raw_tables", counted("open", opened))
    catalog.QUERIES["kpis"](spark, SF0001)
    for key in ("kpis", "load_windows", "price_run_summary", "dq_keys", "run_audit", "prices_upsert"):
        calls.update(root=0, open=0)
        catalog.QUERIES[key](spark, SF0001)
        assert calls == {"root": 1, "open": 0}, key


def test_input_listing_sees_lengths_and_times_behind_a_mount_table(spark, tmp_path):
    from evwin.sources.raw import store_root
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.evwin.link./in", f"file://{tmp_path}")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "a.txt").write_text("abc")
    seen = {store_root(spark, d) for d in (f"viewfs://evwin/in", f"viewfs://evwin/in/", str(tmp_path))}
    assert len(seen) <= 2
    (tmp_path / "sub" / "a.txt").write_text("abcd")
    assert store_root(spark, "viewfs://evwin/in") not in seen and store_root(spark, str(tmp_path)) not in seen


def test_cluster_without_shared_folder_is_refused():
    import pytest

    from evwin.session import ensure_checkpoint_dir

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://somewhere:7077"

        def getConf(self):
            return Conf()

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(Session())
