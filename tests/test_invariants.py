"""Invariants from the test strategy, on the checking tables (sf0.001)."""

import os

import pytest
from pyspark.sql import functions as F

from emporia.operators import dwd
from emporia.plans.catalog import Warehouse

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(f"{SF}/orders.parquet"), reason="checking tables not present")


def test_seven_day_never_exceeds_thirty_day(spark):
    w = Warehouse(spark, SF)
    for df, stems in [
        (w.sku_order_nd(), ["order_count", "order_num", "order_total_amount"]),
        (w.user_order_nd(), ["order_count", "order_original_amount"]),
        (w.province_nd(), ["order_count", "order_total_amount"]),
        (w.visitor_nd(), ["view_count", "during_time"]),
    ]:
        bad = df.where(" OR ".join(f"{s}_7d > {s}_30d" for s in stems)).count()
        assert bad == 0


def test_two_session_forms_group_rows_alike(spark):
    """F13 (last start) and F20 (running start count) split a device's day into the same sessions."""
    w = Warehouse(spark, SF)
    log = w.b.ods_log()
    a = dwd.traffic_page_view(log, w.b.ods_province()).select("dt", "mid_id", "ts", F.col("session_id").alias("s13"))
    b = dwd.session_running_count(log).select("dt", F.col("mid").alias("mid_id"), "ts", F.col("session_id").alias("s20"))
    j = a.join(b, ["dt", "mid_id", "ts"]).where(F.col("s13").isNotNull())
    assert j.count() > 0
    # within a day, each F13 session maps to exactly one F20 session and back
    assert j.groupBy("dt", "s13").agg(F.countDistinct("s20").alias("n")).where("n > 1").count() == 0
    assert j.groupBy("dt", "s20").agg(F.countDistinct("s13").alias("n")).where("n > 1").count() == 0


def test_login_state_merge_equals_history(spark):
    w = Warehouse(spark, SF)
    merged = {r["user_id"]: (r["login_date_last"], r["login_count_td"]) for r in w.login_td().collect()}
    from emporia.operators import dws
    hist = {r["user_id"]: (r["login_date_last"], r["login_count_td"])
            for r in dws.user_login_td_history(w.login(None, w.t), w.t).collect()}
    assert merged == hist
