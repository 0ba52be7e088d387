"""How far rows move: code books are sent to the tasks, an order's rows lie together once, routing moves no line."""

import glob

import pytest
from pyspark.sql import functions as F

from emporia.operators import dwd
from emporia.session import OPEN_WRITERS, WAREHOUSE_CONF, open_files
from emporia.sources import files
from emporia.sources.bench_ods import _data
from emporia.streaming import routing

CHANGE = "type string, ts bigint, data struct<id: string, order_id: string, n: bigint>, old map<string,string>, dt string"


@pytest.fixture()
def no_broadcast(spark):
    """Joins as of large tables, but for what asks to be broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_facts_are_not_dealt_out_by_code(no_broadcast):
    spark = no_broadcast
    dic = spark.createDataFrame([("1", "urgent", "24"), ("2", "high", "24")], "dic_code string, dic_name string, parent_code string")
    day = F.lit("2020-06-14")
    cart = spark.range(4).select(
        F.lit("insert").alias("type"), F.lit(1592064000).cast("bigint").alias("ts"),
        _data("cart_info", {"id": F.col("id").cast("string"), "sku_num": F.lit(1), "source_type": (F.col("id") % 3).cast("string")}).alias("data"),
        F.lit(None).cast("map<string,string>").alias("old"), day.alias("dt"))
    facts = dwd.trade_cart_add(cart, dic)
    assert "Exchange hashpartitioning" not in _plan(facts)
    assert sorted((r.id, r.source_type_name) for r in facts.collect()) == [("0", None), ("1", "urgent"), ("2", "high"), ("3", None)]


def test_current_rows_stay_where_the_orders_lie(no_broadcast):
    spark = no_broadcast
    rows = [("insert", 1, ("a-1", "a", 1), None, "d"), ("update", 2, ("a-1", "a", 5), None, "d"), ("update", 2, ("a-1", "a", 4), None, "d"),
            ("insert", 1, ("b-1", "b", 7), None, "d"), ("delete", 9, ("b-1", "b", 8), None, "d"), ("insert", 3, (None, None, 2), None, "d"),
            ("insert", 1, ("c-1", None, 3), None, "d")]
    flat = spark.createDataFrame([(t, s, *d, o, dt) for t, s, d, o, dt in rows], "type string, ts bigint, id string, order_id string, n bigint, old map<string,string>, dt string")
    together = flat.repartition(4, "order_id")
    changes = together.select("type", "ts", F.struct("id", "order_id", "n").alias("data"), "old", "dt")
    within = files.current_rows(changes, "order_id")
    assert _plan(within).count("Exchange") == 1  # the one that laid them together
    expected = [("a-1", "a", 5), ("b-1", "b", 7), ("c-1", None, 3), (None, None, 2)]
    for got in (within, files.current_rows(changes)):
        assert got.columns == ["id", "order_id", "n"]
        assert sorted(map(tuple, got.collect()), key=str) == sorted(expected, key=str)


def test_first_day_lines_move_once_before_their_links(no_broadcast):
    from emporia.plans.catalog import Warehouse

    w = Warehouse(no_broadcast, "/root/testdata/sf0.001")
    lines, orders = w.boot("order_detail"), w.boot("order_info")
    facts = lines.select("data.id", "data.order_id").join(orders.select(F.col("data.id").alias("oid"), "data.user_id"), F.col("order_id") == F.col("oid"), "left")
    # four for the lines (lines, orders, customers, orders with customers), four for the orders (returned lines in place of lines)
    assert _plan(facts).count("Exchange hashpartitioning") == 8


def test_routing_by_table_moves_no_line(spark, tmpdir_path):
    lines = spark.range(0, 40, 1, 4).select(F.format_string('{"table":"order_info","type":"insert","ts":1592064000,"data":{"id":"%d"}}', "id").alias("value"))
    routing.batch_writer(f"{tmpdir_path}/out", by_day=False)(lines, 0)
    assert len(glob.glob(f"{tmpdir_path}/out/table=order_info_inc/batch=*/part-*")) == 4
    assert routing.read_routed(spark, f"{tmpdir_path}/out", "order_info").count() == 40
    assert spark.conf.get(OPEN_WRITERS, "0") == "0"


def test_open_files_are_set_back_after_a_failure(spark):
    with pytest.raises(ValueError), open_files(spark, 3):
        assert spark.conf.get(OPEN_WRITERS) == "3"
        raise ValueError
    assert spark.conf.get(OPEN_WRITERS) == "0"


def test_shuffle_files_go_with_their_write():
    assert WAREHOUSE_CONF["spark.sql.classic.shuffleDependency.fileCleanup.enabled"] == "true"
    assert int(WAREHOUSE_CONF["spark.sql.adaptive.advisoryPartitionSizeInBytes"][:-1]) <= 16
