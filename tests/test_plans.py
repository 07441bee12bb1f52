"""Plans that must hold at scale: pushed filters, pruned columns, no cross joins, reduction before
shuffles, and hot keys that are split."""

import re

import pytest
from pyspark.sql import functions as F

from millrace import feeds
from millrace.operators.joins import lookup_join, retained_join
from millrace.operators.upsert import latest_by_key
from millrace.operators.visitors import detect_bounce, first_visit_per_day, repair_new_flag
from millrace.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith("stream_")])
def test_no_cross_joins(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in text
    # A left-anti join against at most one row is an existence test, not a pairing.
    loops = re.findall(r"BroadcastNestedLoopJoin \w+, (\w+)", text)
    assert all(kind == "LeftAnti" for kind in loops) and len(loops) == text.count("LocalLimit 1")


def test_other_tables_are_not_read(spark):
    text = plan(QUERIES["status_changed"](spark, SF))
    assert "orders" in text and "lineitem" not in text
    assert "o_totalprice" not in text


def test_lookup_is_broadcast_and_first(no_broadcast):
    text = plan(QUERIES["cart_add"](no_broadcast, SF))
    assert re.search(r"BroadcastHashJoin \[source_type_id", text)
    assert not re.search(r"Exchange hashpartitioning\(source_type", text)


def test_status_filter_reaches_the_order_rows(spark):
    """The cancelled flow drops the order inserts before it joins: two of the three order branches
    of the change log carry updates, and only they are left."""
    wide, cancelled = (plan(QUERIES[n](spark, SF)) for n in ("order_wide", "order_cancel"))
    assert wide.count("1001") > 0 and "insert AS type" in wide
    assert "insert AS type" not in cancelled


def test_one_row_per_group_before_the_shuffle(spark):
    pages = feeds.page_rows(spark, SF)
    for df in (first_visit_per_day(pages), latest_by_key(pages, ["mid"], ["ts"])):
        text = plan(df)
        assert "WindowGroupLimit" in text and "Partial" in text and "Final" in text
        assert text.index("Final") < text.index("Exchange") < text.index("Partial")    # printed top down


def test_flag_repair_aggregates_by_hash(spark):
    text = plan(repair_new_flag(feeds.page_rows(spark, SF)))
    assert "HashAggregate" in text and "SortAggregate" not in text and "partial_min" in text


def test_bounce_windows_are_split_in_time(spark):
    text = plan(detect_bounce(feeds.page_rows(spark, SF)))
    shuffles = [line for line in text.splitlines() if "Exchange hashpartitioning(_key" in line]
    assert len(shuffles) == 1 and "_span" in shuffles[0]


def skewed(spark):
    """A third of the rows has one key."""
    return spark.range(0, 60_000, 1, 12).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        (F.col("id") % 50_000).alias("at"), F.repeat(F.sha2(F.col("id").cast("string"), 512), 4).alias("pad"), "id")


@pytest.fixture
def small_skew_limits(no_broadcast):
    values = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
              "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
              "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB", "spark.sql.shuffle.partitions": "16"}
    old = {k: no_broadcast.conf.get(k, None) for k in values}
    for k, v in values.items():
        no_broadcast.conf.set(k, v)
    yield no_broadcast
    for k, v in old.items():
        no_broadcast.conf.unset(k) if v is None else no_broadcast.conf.set(k, v)


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_unbounded_join_splits_hot_keys(small_skew_limits):
    left = skewed(small_skew_limits)
    right = left.filter("id < 9 or id % 3 <> 0").select(F.col("k").alias("rk"), F.col("id").alias("v"))
    for how in ("inner", "left"):
        joined = retained_join(left, right, [("k", "rk")], how)
        assert "skew=true" in final_plan(joined)
        assert joined.count() == 40_000 + 20_000 * 3


def test_banded_join_spreads_a_hot_key(small_skew_limits):
    left = skewed(small_skew_limits)
    right = left.select(F.col("k").alias("rk"), F.col("at").alias("rt"), F.col("id").alias("v"))
    joined = retained_join(left, right, [("k", "rk")], ttl=2, left_ts="at", right_ts="rt")
    keys = [line for line in plan(joined).splitlines() if "SortMergeJoin" in line]
    assert len(keys) == 1 and "_left_bucket" in keys[0] and "_right_bucket" in keys[0]
    # hot rows lie 3 apart, so a hot row meets itself and, where the ids wrap, its neighbours within 2
    text = final_plan(joined)
    assert "Cartesian" not in text


def test_flag_repair_splits_a_hot_visitor(small_skew_limits):
    df = skewed(small_skew_limits).select(
        F.col("k").alias("mid"), F.when(F.col("id") % 2 == 0, "1").otherwise("0").alias("is_new"),
        (F.col("id") + F.when(F.col("id") > 59_990, 2 * 86_400_000).otherwise(0)).alias("ts"),
        F.col("id").alias("arrival"), "pad")
    repaired = repair_new_flag(df)
    assert "skew=true" in final_plan(repaired) and repaired.count() == 60_000


def test_large_dictionary_is_not_broadcast(spark):
    df = spark.range(100).select(F.col("id").cast("string").alias("code"))
    dic = spark.range(100).select(F.col("id").cast("string").alias("dic_code"), F.lit("n").alias("dic_name"))
    joined = lookup_join(df, dic, "code", {"dic_name": "name"}, max_rows=10)
    assert "isHint" not in joined._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" not in joined._jdf.queryExecution().analyzed().toString()
