"""Cutting hot keys into pieces does not change a join."""

import uuid

import pytest
from pyspark.sql import functions as F

from quarterbill.operators import spread
from quarterbill.operators.spread import spread_join


@pytest.mark.parametrize("how", ["inner", "left", "left_anti", "left_semi"])
@pytest.mark.parametrize("most_hot", [1, 10_000])
def test_same_rows_as_a_plain_join(spark, monkeypatch, how, most_hot):
    monkeypatch.setattr(spread, "MOST_HOT_KEYS", most_hot)
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 3 == 1, "warm")
        .otherwise(F.concat(F.lit("k"), F.col("id") % 50))
        .alias("pi"),
        F.col("id").alias("email"),
    )
    per_key = spark.createDataFrame(
        [("hot", 1), ("k2", 2), ("k5", 3), ("nobody", 4)], "pi string, project int"
    )
    plain = rows.join(per_key, "pi", how)
    spreaded = spread_join(
        rows, per_key, "pi", spread_by=["email"], how=how, rows_per_task=100
    ).select(*plain.columns)
    assert sorted(map(tuple, spreaded.collect()), key=repr) == sorted(
        map(tuple, plain.collect()), key=repr
    )


def test_a_hot_key_lands_in_many_tasks(spark):
    rows = spark.range(20_000).selectExpr("'hot' AS pi", "id AS email")
    per_key = spark.createDataFrame([("hot", 1)], "pi string, project int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        joined = spread_join(
            rows, per_key, "pi", spread_by=["email"], rows_per_task=1000
        )
        assert joined.count() == 20_000
        assert joined.select(F.spark_partition_id()).distinct().count() > 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def _exchanges(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("Exchange hashpartitioning")


def test_staged_tables_of_one_key_join_without_a_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        left = spread.stage_by(spark.range(5000).selectExpr("concat('p', id % 700) AS email", "id"), "email")
        right = spread.stage_by(spark.range(700).selectExpr("concat('p', id) AS email", "id AS v"), "email")
        joined = left.join(right, "email")
        assert joined.count() == 5000 and _exchanges(joined) == 0
        last = left.selectExpr("*", "row_number() OVER (PARTITION BY email ORDER BY id DESC) AS n").where("n = 1")
        assert _exchanges(last.join(right, "email").groupBy("email").count()) == 0
        plain = spread.stage(left).join(spread.stage(right), "email")
        assert _exchanges(plain) == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_staged_steps_are_removed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(spread, "new_folder", lambda spark, name="staged": f"file://{tmp_path}/{name}-{uuid.uuid4().hex}")
    with spread.staged_steps(spark):
        spread.stage(spark.range(3))
        table = spread.stage_by(spark.range(3), "id")
        assert table.count() == 3 and len(list(tmp_path.iterdir())) == 2
    assert list(tmp_path.iterdir()) == []
    with pytest.raises(ZeroDivisionError), spread.staged_steps(spark):
        spread.stage(spark.range(3))
        1 / 0  # noqa: B018
    assert list(tmp_path.iterdir()) == []
    spread.stage(spark.range(3))
    assert len(list(tmp_path.iterdir())) == 1  # outside of such a block nothing is removed
