"""The change log made in one pass: the same rows as table by table."""

import datetime

import pytest
from pyspark.sql import functions as F

from millrace import feeds


@pytest.fixture
def tables(spark, tmp_path):
    day = datetime.datetime(2020, 1, 1)
    orders = [(k, k % 3, "OFP"[k % 3], day, "1-URGENT") for k in range(1, 13)] + [(2, 7, "P", day, None), (None, 1, "F", day, None)]
    lines = [(k, k % 4 if k % 5 else None, 1, n, 3.0, 10.5, 0.04 + n / 100, 0.05 + n / 100, "RNA"[k % 2], "O")
             for k in range(1, 14) for n in (1, 2)] + [(None, 1, 1, 1, 1.0, 1.0, None, None, "R", "O")]
    parts = [(k, f"part {k}", 9.5) for k in (0, 1, 1, 2)]  # a key twice, one missing
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp_ntz, o_orderpriority string"
                          ).write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                          "l_discount double, l_tax double, l_returnflag string, l_linestatus string").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_retailprice double").write.parquet(f"{tmp_path}/part.parquet")
    return str(tmp_path)


def rows(df):
    return sorted(df.select(F.to_json(F.struct("*"))).toPandas().iloc[:, 0])


def test_whole_change_log_has_the_same_rows(spark, tables):
    one_by_one = rows(feeds.change_log(spark, tables))
    assert len(one_by_one) > 100
    assert rows(feeds.change_log(spark, tables, whole=True)) == one_by_one


def test_whole_change_log_joins_lines_to_their_orders_twice(spark, tables):
    plan = feeds.change_log(spark, tables, whole=True)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join Inner") == 2


@pytest.mark.parametrize("name", ["order_detail", "order_detail_activity", "order_detail_coupon"])
def test_names_of_lines_are_made_behind_the_joins(spark, tables, name):
    plan = feeds.change_log(spark, tables).filter(F.col("table") == name)._jdf.queryExecution().optimizedPlan().toString()
    assert 0 < plan.rfind("concat_ws") < plan.find("Join ")
