"""The driver contract in __spark_entry__.py."""

import importlib.util
import os

from ledgerline.plans.registry import load_all

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _module():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    m = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(m)
    return m


def test_entry_queries_and_oracles(spark):
    m = _module()
    df = m.entry(spark)
    assert df.columns[:3] == ["id_ejecucion", "cuenta", "ot"] and df.count() > 0
    qs, sql = m.queries(), m.oracle_sql()
    own = set(load_all())
    assert own <= set(qs) and own <= set(sql) <= set(qs) and len(own) >= 88
    assert all(callable(f) for f in qs.values()) and all(isinstance(s, str) and s.strip() for s in sql.values())
    out = qs["watermark_increment"](spark, "/root/testdata/sf0.001")
    assert out.columns == ["o_orderkey", "o_orderdate", "o_totalprice"]
