import importlib.util
import os

from conftest import ROOT


def _entry():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_entry_runs(spark):
    m = _entry()
    df = m.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["symbol", "window_start", "window_end"]


def test_contract_keys():
    m = _entry()
    q, o = m.queries(), m.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 80
