import importlib

from __spark_entry__ import SMOKE_DIR as SMOKE
from tessera.plans.catalog import load_all


def test_entry_and_registry(spark):
    entry = importlib.import_module("__spark_entry__")
    df = entry.entry(spark)
    assert df.count() > 0
    assert "weighted_wind_direction" in df.columns
    qs, sqls = entry.queries(), entry.oracle_sql()
    assert set(sqls) <= set(qs)
    assert set(load_all()) <= set(sqls)  # every query outside the llm subpackage has oracle SQL


def test_every_query_runs_on_smoke_data(spark):
    entry = importlib.import_module("__spark_entry__")
    registered = entry.queries()
    for name in load_all():  # the llm subpackage's queries run in its own tests
        df = registered[name](spark, SMOKE)
        df.write.format("noop").mode("overwrite").save()


def test_entry_schema_is_stable(spark):
    entry = importlib.import_module("__spark_entry__")
    assert entry.entry(spark).schema == entry.entry(spark).schema
