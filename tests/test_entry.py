import importlib.util
import os

from conftest import SF_SMALL

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _entry():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_entry_runs(spark):
    df = _entry().entry(spark)
    assert df.count() > 0
    assert "peak_traffic_label" in df.columns


def test_every_oracle_has_a_query():
    e = _entry()
    assert set(e.oracle_sql()) <= set(e.queries())


def test_oracles_match_at_small_scale(spark):
    import oracle_compare as oc
    e = _entry()
    q, o = e.queries(), e.oracle_sql()
    con = oc.duck(SF_SMALL)
    bad = []
    for key in o:
        r = oc.compare(spark, con, key, SF_SMALL, q, o)
        if r["status"] != "ok":
            bad.append((key, r["status"][:200]))
    assert not bad, bad
