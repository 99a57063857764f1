import importlib.util
import os


def _entry():
    p = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "__spark_entry__.py")
    spec = importlib.util.spec_from_file_location("spark_entry", p)
    m = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(m)
    return m


def test_entry_contract(spark):
    m = _entry()
    df = m.entry(spark)
    assert df.count() > 0
    assert set(m.oracle_sql()) <= set(m.queries())
    rows_only = set(m.queries()) - set(m.oracle_sql())
    from roadlens.plans.catalog import load_all

    # Queries of the library itself all have a SQL form.
    assert not rows_only & set(load_all()), rows_only
