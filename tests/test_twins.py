"""Every query with a SQL twin gives the same rows; the others run and give a stable schema."""

import pytest

import __spark_entry__ as spark_entry
from compare import database, differences

SQL = spark_entry.oracle_sql()
QUERIES = spark_entry.queries()
MAY_BE_EMPTY = {"als_prefilter", "als_postfilter", "staged_run"}  # no candidate may have a positive score
WIDE = ("fm_score", "fm_gradient", "fm_sgd_step", "param_grid", "encode_features_long", "multiclass_metrics")


@pytest.fixture(scope="module")
def con(sf_dir):
    return database(sf_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, con, sf_dir, name):
    assert differences(QUERIES[name](spark, sf_dir), con, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    rows = df.collect()
    assert len(set(df.columns)) == len(df.columns) and all(len(r) == len(df.columns) for r in rows)
    assert rows or name in MAY_BE_EMPTY


@pytest.mark.parametrize("name", WIDE)
def test_same_with_generated_code(spark, con, sf_dir, name):
    """The wide expressions as they are compiled in production; the other tests interpret them."""
    spark.conf.set("spark.sql.codegen.wholeStage", "true")
    try:
        assert differences(QUERIES[name](spark, sf_dir), con, SQL[name]) is None
    finally:
        spark.conf.set("spark.sql.codegen.wholeStage", "false")


def test_flagship(spark):
    df = spark_entry.entry(spark)
    assert df.columns == ["itemid", "rating", "rank"]
    assert 0 < df.count() <= 10


def test_every_twin_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", ["fm_score", "encode_features_long", "topk_per_user", "tf_idf", "auc", "score_candidates"])
def test_no_cross_join(spark, sf_dir, name, capsys):
    QUERIES[name](spark, sf_dir).explain()
    plan = capsys.readouterr().out
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
