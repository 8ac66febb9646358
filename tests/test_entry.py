import __spark_entry__ as entry
from lexweave.plans.registry import ORACLES, QUERIES
from lexweave.schemas import RELATIONS, schema


def test_contract(spark):
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql()) and set(entry.oracle_sql()) <= set(entry.queries())
    df = entry.entry(spark)
    assert df.columns == ["word", "freq", "tier", "sources", "rank"] and df.count() > 0


def test_schemas():
    assert all(schema(name).names for name in RELATIONS)
