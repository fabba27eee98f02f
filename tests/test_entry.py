"""Driver contract: entry() runs the flagship query with a stable schema."""
import importlib.util
import os

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _entry_module():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_entry_flagship(spark):
    mod = _entry_module()
    df = mod.entry(spark)
    assert df.columns == ["month_start", "sales_value", "quantity", "baskets", "households", "sales_per_basket"]
    rows = df.collect()
    assert len(rows) == 12 and all(r.baskets > 0 for r in rows)


def test_contract_maps_are_consistent():
    mod = _entry_module()
    q, o = mod.queries(), mod.oracle_sql()
    assert set(o) <= set(q)
    assert all(isinstance(v, str) and "SELECT" in v.upper() for v in o.values())
