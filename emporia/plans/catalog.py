"""Query catalog: every operator run end to end on the driver tables.

``Warehouse`` wires the bench views (``sources.bench``) through the DWD, DWS
and ADS operators for one trade day and one traffic day. Everything stays
lazy: each query is one DataFrame plan that Catalyst optimises as a whole
(shared sub-plans are re-planned per query, never collected).
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emporia import schemas
from emporia.functions.sessions import HOT_ROWS
from emporia.functions.spans import shift_date
from emporia.operators import ads, dim, dwd, dws
from emporia.plans import landed
from emporia.session import scratch_folder
from emporia.streaming import routing
from emporia.sources import files
from emporia.sources.bench import (
    CORRUPT_AT, CORRUPT_EVERY, RETENTION_DO_DATE, TRADE_DO_DATE, TRAFFIC_DO_DATE, BenchTables,
)
from emporia.sources.bench_ods import BenchOds


def _shared(fn):
    """Build a sub-plan once per ``Warehouse`` and arguments.

    Handing the same DataFrame to several branches of one query gives Spark
    identical sub-trees, which it plans once (``ReusedExchange``) instead of
    recomputing the shared aggregation.
    """
    def wrapper(self, *args):
        key = (fn.__name__, args)
        if key not in self._memo:
            self._memo[key] = fn(self, *args)
        return self._memo[key]
    wrapper.__name__ = fn.__name__
    wrapper.__doc__ = fn.__doc__
    return wrapper


class Warehouse:
    def __init__(self, spark: SparkSession, sf_dir: str, trade_date: str = TRADE_DO_DATE,
                 traffic_date: str = TRAFFIC_DO_DATE):
        self.b = BenchTables(spark, sf_dir)
        self.d = trade_date
        self.t = traffic_date
        self._memo: dict = {}

    # -------------------------------------------------------------- windows
    @property
    def ods(self) -> BenchOds:
        return BenchOds(self.b)

    @_shared
    def bootstrapped(self) -> dict[str, DataFrame]:
        """The current rows of all change tables as changes of the report day."""
        return self.ods.bootstrap((shift_date(self.d, -1), self.d), self.d)

    def boot(self, table: str) -> DataFrame:
        return self.bootstrapped()[table]

    def _w30(self, d: str) -> tuple[str, str]:
        return shift_date(d, -29), d

    # ----------------------------------------------------------- dimensions
    @_shared
    def dim_sku(self) -> DataFrame:
        return self.b.dim_sku()

    @_shared
    def dim_province(self) -> DataFrame:
        return dim.province_full(self.b.ods_province(), self.b.raw("region").selectExpr(
            "cast(r_regionkey as string) as id", "r_name as region_name"))

    @_shared
    def dim_coupon(self) -> DataFrame:
        return dim.coupon_full(self.b.ods_coupon(), self.b.ods_dictionary())

    @_shared
    def dim_activity(self) -> DataFrame:
        return dim.activity_full(self.b.ods_activity_rule(), self.b.ods_activity_info(), self.b.ods_dictionary())

    # ------------------------------------------------------------- 1-day trade
    @_shared
    def sku_order_1d(self, start=None, end=None) -> DataFrame:
        return dws.trade_user_sku_order_1d(self.b.order_detail(start, end, province=False), self.dim_sku())

    @_shared
    def sku_refund_1d(self, start=None, end=None) -> DataFrame:
        return dws.trade_user_sku_order_refund_1d(self.b.refund_detail(start, end, province=False), self.dim_sku())

    @_shared
    def user_order_1d(self, start=None, end=None) -> DataFrame:
        return dws.trade_user_order_1d(self.b.order_detail(start, end, province=False))

    @_shared
    def cart_add_1d(self, start=None, end=None) -> DataFrame:
        return dws.trade_user_cart_add_1d(self.b.cart_add(start, end))

    @_shared
    def payment_1d(self, start=None, end=None) -> DataFrame:
        return dws.trade_user_payment_1d(self.b.pay_detail(start, end))

    @_shared
    def province_1d(self, start=None, end=None) -> DataFrame:
        return dws.trade_province_order_1d(self.b.order_detail(start, end), self.dim_province())

    @_shared
    def user_refund_1d(self, start=None, end=None) -> DataFrame:
        return dws.trade_user_order_refund_1d(self.b.refund_detail(start, end, province=False))

    # ------------------------------------------------------------- n-day trade
    @_shared
    def sku_order_nd(self) -> DataFrame:
        return dws.trade_user_sku_order_nd(self.sku_order_1d(*self._w30(self.d)), self.d)

    @_shared
    def sku_refund_nd(self) -> DataFrame:
        return dws.trade_user_sku_order_refund_nd(self.sku_refund_1d(*self._w30(self.d)), self.d)

    @_shared
    def user_order_nd(self) -> DataFrame:
        return dws.trade_user_order_nd(self.user_order_1d(*self._w30(self.d)), self.d)

    @_shared
    def cart_add_nd(self) -> DataFrame:
        return dws.trade_user_cart_add_nd(self.cart_add_1d(*self._w30(self.d)), self.d)

    @_shared
    def payment_nd(self) -> DataFrame:
        return dws.trade_user_payment_nd(self.payment_1d(*self._w30(self.d)), self.d)

    @_shared
    def province_nd(self) -> DataFrame:
        return dws.trade_province_order_nd(self.province_1d(*self._w30(self.d)), self.d)

    @_shared
    def user_refund_nd(self) -> DataFrame:
        return dws.trade_user_order_refund_nd(self.user_refund_1d(*self._w30(self.d)), self.d)

    @_shared
    def coupon_nd(self) -> DataFrame:
        return dws.trade_coupon_order_nd(self.b.order_detail(*self._w30(self.d), province=False), self.dim_coupon(), self.d)

    @_shared
    def activity_nd(self) -> DataFrame:
        return dws.trade_activity_order_nd(self.b.order_detail(*self._w30(self.d), province=False), self.dim_activity(), self.d)

    # ----------------------------------------------------------- to-date trade
    @_shared
    def order_td(self) -> DataFrame:
        """Daily merge: yesterday's state (rebuilt from history) ⟗ today's 1-day rows."""
        prev = shift_date(self.d, -1)
        hist = self.user_order_1d(None, self.d)
        old = dws.trade_user_order_td_init(hist, prev)
        return dws.trade_user_order_td(old, hist, self.d)

    @_shared
    def payment_td(self) -> DataFrame:
        prev = shift_date(self.d, -1)
        hist = self.payment_1d(None, self.d)
        old = dws.trade_user_payment_td_init(hist, prev)
        return dws.trade_user_payment_td(old, hist, self.d)

    # ----------------------------------------------------------------- traffic
    @_shared
    def page_view(self, start=None, end=None) -> DataFrame:
        return dwd.traffic_page_view(self.b.ods_log(start, end), self.b.ods_province(), most=HOT_ROWS)

    @_shared
    def login(self, start=None, end=None) -> DataFrame:
        return dwd.user_login(self.b.ods_log(start, end), self.b.ods_province(), most=HOT_ROWS)

    @_shared
    def register(self, start=None, end=None) -> DataFrame:
        return dwd.user_register(self.b.ods_user_inc(start, end), self.b.ods_log(start, end), self.b.ods_province())

    def register_first_day(self) -> DataFrame:
        """The same users, bootstrapped: each goes to the day it registered."""
        users = self.b.ods_user_inc().withColumn("type", F.lit("bootstrap-insert")).withColumn("dt", F.lit(self.t))
        return dwd.user_register(users, self.b.ods_log(), self.b.ods_province(), first_day=True)

    @_shared
    def session_1d(self, start=None, end=None) -> DataFrame:
        return dws.traffic_session_page_view_1d(self.page_view(start, end))

    @_shared
    def page_rows(self, start=None, end=None) -> DataFrame:
        """Page views without the session pass (for device × page summaries)."""
        return dwd.traffic_page_view(self.b.ods_log(start, end), self.b.ods_province(), sessions=False)

    @_shared
    def visitor_1d(self, start=None, end=None) -> DataFrame:
        return dws.traffic_page_visitor_page_view_1d(self.page_rows(start, end))

    @_shared
    def visitor_nd(self) -> DataFrame:
        return dws.traffic_page_visitor_page_view_nd(self.visitor_1d(*self._w30(self.t)), self.t)

    @_shared
    def login_td(self, d: str | None = None) -> DataFrame:
        """Login state at ``d``: yesterday's state rebuilt from history ⟗ the day's logins."""
        d = d or self.t
        prev = shift_date(d, -1)
        logins = self.login(None, self.t)  # one pass over the log, shared by both states
        old = dws.user_login_td_history(logins, prev)
        return dws.user_login_td(old, logins, d)


def _arrays_as_json(df: DataFrame, cols: list[str]) -> DataFrame:
    """Nested array columns rendered as JSON text, for a cross-engine value check only."""
    for c in cols:
        df = df.withColumn(c, F.to_json(F.col(c), {"ignoreNullFields": "false"}))
    return df


def _payload(table: str) -> Column:
    """A change's payload as text: its fields that aren't NULL, in the table's order."""
    names = [c.split(" ")[0] for c in schemas.CHANGE_DATA[table].split(", ")]
    return F.concat_ws("|", *[F.col(f"data.{c}").cast("string") for c in names])


def _all_changes(changes: dict[str, DataFrame]) -> DataFrame:
    """Change records of several tables in one frame: table, dt, type, ts, row id, payload and changed columns as text."""
    changed = F.concat_ws("|", F.array_sort(F.transform(F.map_entries("old"), lambda e: F.concat_ws("=", e["key"], e["value"]))))
    parts = [c.select(F.lit(t).alias("table"), "dt", "type", "ts", F.col("data.id").alias("id"), _payload(t).alias("payload"),
                      F.when(F.col("old").isNull(), "").otherwise(changed).alias("changed")) for t, c in changes.items()]
    return functools.reduce(DataFrame.unionByName, parts)


def _one_by_one(w: Warehouse, parts: list[DataFrame]) -> DataFrame:
    """The rows of all parts, each stored before the next one is made: the shuffle files of one part are on disk at a time."""
    spark, root = w.b.spark, scratch_folder(w.b.spark, "parts")
    for k, part in enumerate(parts):
        part.write.option("compression", "zstd").parquet(f"{root}/{k}")
    return functools.reduce(DataFrame.unionByName, [spark.read.schema(p.schema).parquet(f"{root}/{k}") for k, p in enumerate(parts)])


#: Parts of the order lines whose facts are made one after the other.
SHARES = 3


def _share(changes: DataFrame, key: str, k: int) -> DataFrame:
    """The ``k``-th part of the lines (or of what is linked to them by ``key``), dealt by the line's id; all parts are all rows."""
    return changes.where(F.pmod(F.xxhash64(F.col(f"data.{key}")), F.lit(SHARES)) == k)


def _w(fn: Callable[[Warehouse], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: fn(Warehouse(spark, sf_dir))


def build_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q: dict[str, Callable[[Warehouse], DataFrame]] = {}
    # ---- DIM
    q["dim_province_full"] = lambda w: w.dim_province()
    q["dim_coupon_full"] = lambda w: w.dim_coupon()
    q["dim_activity_full"] = lambda w: w.dim_activity()
    # ---- DWS 1-day, first-day form: all history, one partition per day
    q["dws_trade_user_sku_order_1d"] = lambda w: w.sku_order_1d()
    q["dws_trade_user_sku_order_refund_1d"] = lambda w: w.sku_refund_1d()
    q["dws_trade_user_order_1d"] = lambda w: w.user_order_1d()
    q["dws_trade_user_cart_add_1d"] = lambda w: w.cart_add_1d()
    q["dws_trade_user_payment_1d"] = lambda w: w.payment_1d()
    q["dws_trade_province_order_1d"] = lambda w: w.province_1d()
    q["dws_trade_user_order_refund_1d"] = lambda w: w.user_refund_1d()
    # ---- DWS n-day
    q["dws_trade_user_sku_order_nd"] = lambda w: w.sku_order_nd()
    q["dws_trade_user_sku_order_refund_nd"] = lambda w: w.sku_refund_nd()
    q["dws_trade_user_order_nd"] = lambda w: w.user_order_nd()
    q["dws_trade_user_cart_add_nd"] = lambda w: w.cart_add_nd()
    q["dws_trade_user_payment_nd"] = lambda w: w.payment_nd()
    q["dws_trade_province_order_nd"] = lambda w: w.province_nd()
    q["dws_trade_user_order_refund_nd"] = lambda w: w.user_refund_nd()
    q["dws_trade_coupon_order_nd"] = lambda w: w.coupon_nd()
    q["dws_trade_activity_order_nd"] = lambda w: w.activity_nd()
    # ---- DWS to-date
    q["dws_trade_user_order_td"] = lambda w: w.order_td()
    q["dws_trade_user_payment_td"] = lambda w: w.payment_td()
    # ---- ADS trade
    q["ads_trade_stats_by_tm"] = lambda w: ads.trade_stats_by_tm(
        w.sku_order_1d(*w._w30(w.d)), w.sku_order_nd(), w.sku_refund_1d(*w._w30(w.d)), w.sku_refund_nd(), w.d)
    q["ads_trade_stats_by_cate"] = lambda w: ads.trade_stats_by_cate(
        w.sku_order_1d(*w._w30(w.d)), w.sku_order_nd(), w.sku_refund_1d(*w._w30(w.d)), w.sku_refund_nd(), w.d)
    q["ads_repeat_purchase_by_tm"] = lambda w: ads.repeat_purchase_by_tm(w.sku_order_nd(), w.d)
    q["ads_trade_stats"] = lambda w: ads.trade_stats(
        w.user_order_1d(*w._w30(w.d)), w.user_order_nd(), w.user_refund_1d(*w._w30(w.d)), w.user_refund_nd(), w.d)
    q["ads_order_by_province"] = lambda w: ads.order_by_province(w.province_1d(*w._w30(w.d)), w.province_nd(), w.d)
    q["ads_new_buyer_stats"] = lambda w: ads.new_buyer_stats(w.order_td(), w.payment_td(), w.d)
    q["ads_coupon_stats"] = lambda w: ads.coupon_stats(w.coupon_nd(), w.d)
    q["ads_activity_stats"] = lambda w: ads.activity_stats(w.activity_nd(), w.d)
    q["ads_sku_cart_num_top3_by_cate"] = lambda w: ads.sku_cart_num_top3_by_cate(w.b.cart_full(w.d), w.dim_sku(), w.d)
    # ---- DWD traffic and users (all days: the back-fill form, one partition per day)
    q["dwd_traffic_page_view_inc"] = lambda w: w.page_view()
    q["dwd_traffic_start_inc"] = lambda w: dwd.traffic_start(w.b.ods_log(), w.b.ods_province())
    q["dwd_traffic_action_inc"] = lambda w: dwd.traffic_action(w.b.ods_log(), w.b.ods_province())
    q["dwd_traffic_display_inc"] = lambda w: dwd.traffic_display(w.b.ods_log(), w.b.ods_province())
    q["dwd_traffic_error_inc"] = lambda w: dwd.traffic_error(w.b.ods_log(), w.b.ods_province())
    q["dwd_user_register_inc"] = lambda w: w.register()
    q["dwd_user_register_first_day"] = lambda w: w.register_first_day()
    q["dwd_user_login_inc"] = lambda w: w.login()
    q["sessionize_running_sum"] = lambda w: dwd.session_running_count(w.b.ods_log(), most=HOT_ROWS)
    # ---- DWS traffic / users
    q["dws_traffic_session_page_view_1d"] = lambda w: w.session_1d()
    q["dws_traffic_page_visitor_page_view_1d"] = lambda w: w.visitor_1d()
    q["dws_traffic_page_visitor_page_view_nd"] = lambda w: w.visitor_nd()
    q["dws_user_user_login_td"] = lambda w: w.login_td()
    # ---- ADS traffic / users
    q["ads_traffic_stats_by_channel"] = lambda w: ads.traffic_stats_by_channel(w.session_1d(*w._w30(w.t)), w.t)
    q["ads_page_path"] = lambda w: ads.page_path(w.page_view(*w._w30(w.t)), w.t, most=HOT_ROWS)
    q["ads_user_change"] = lambda w: ads.user_change(w.login_td(w.t), w.login_td(shift_date(w.t, -1)), w.t)
    q["ads_user_retention"] = lambda w: ads.user_retention(
        w.register(shift_date(RETENTION_DO_DATE, -7), RETENTION_DO_DATE), w.login_td(RETENTION_DO_DATE), RETENTION_DO_DATE)
    q["ads_user_stats"] = lambda w: ads.user_stats(w.register(None, w.t), w.login_td(w.t), w.t)
    q["user_stats_filter_form"] = lambda w: ads.user_stats_filter_form(w.register(None, w.t), w.login_td(w.t), w.t)
    q["ads_user_action"] = lambda w: ads.user_action(
        w.visitor_1d(*w._w30(w.t)), w.visitor_nd(), w.cart_add_1d(*w._w30(w.t)), w.cart_add_nd(),
        w.user_order_1d(*w._w30(w.t)), w.user_order_nd(), w.payment_1d(*w._w30(w.t)), w.payment_nd(), w.t)
    # ---- DIM from raw snapshots / changes
    q["dim_sku_full"] = lambda w: _arrays_as_json(dim.sku_full(**{
        k: v for k, v in zip(
            ["sku_info", "spu_info", "category3", "category2", "category1", "trademark", "attr_value", "sale_attr_value"],
            [w.ods.sku_snapshots()[t] for t in ["sku_info", "spu_info", "base_category3", "base_category2",
                                                 "base_category1", "base_trademark", "sku_attr_value",
                                                 "sku_sale_attr_value"]])}), ["sku_attr_values", "sku_sale_attr_values"])
    q["dim_date"] = lambda w: dim.date_dim(w.b.raw("orders").selectExpr("date_format(o_orderdate, 'yyyy-MM-dd') AS date_id"))
    q["dim_user_zip_init"] = lambda w: dim.user_zip_init(w.ods.user_info_inc(shift_date(w.d, -1), w.d), shift_date(w.d, -1))
    q["dim_user_zip"] = lambda w: dim.user_zip(
        dim.user_zip_init(w.ods.user_info_inc(shift_date(w.d, -1), w.d), shift_date(w.d, -1)).drop("dt"),
        w.ods.user_info_inc(shift_date(w.d, -1), w.d), w.d)
    # ---- DWD from raw change records (all event days)
    q["dwd_trade_cart_add_inc"] = lambda w: dwd.trade_cart_add(w.ods.cart_info_inc(), w.ods.dictionary())
    q["dwd_trade_order_detail_inc"] = lambda w: _one_by_one(w, [dwd.trade_order_detail(
        _share(w.ods.order_detail_inc(), "id", k), w.ods.order_info_inc(), _share(w.ods.detail_activity_inc(), "order_detail_id", k),
        _share(w.ods.detail_coupon_inc(), "order_detail_id", k), w.ods.dictionary()) for k in range(SHARES)])
    q["dwd_trade_cancel_detail_inc"] = lambda w: dwd.trade_cancel_detail(
        w.ods.order_detail_inc(), w.ods.order_info_inc(), w.ods.detail_activity_inc(), w.ods.detail_coupon_inc(), w.ods.dictionary())
    q["dwd_trade_pay_detail_suc_inc"] = lambda w: dwd.trade_pay_detail(
        w.ods.order_detail_inc(), w.ods.order_info_inc(), w.ods.payment_info_inc(), w.ods.detail_activity_inc(),
        w.ods.detail_coupon_inc(), w.ods.dictionary())
    q["dwd_trade_order_refund_inc"] = lambda w: dwd.trade_order_refund(
        w.ods.order_refund_info_inc(), w.ods.order_info_inc(), w.ods.dictionary())
    q["dwd_trade_refund_pay_suc_inc"] = lambda w: dwd.trade_refund_pay(
        w.ods.refund_payment_inc(), w.ods.order_info_inc(), w.ods.order_refund_info_inc(), w.ods.dictionary())
    q["dwd_trade_cart_full"] = lambda w: dwd.trade_cart_full(w.ods.cart_info_full(w.d), w.d)
    q["dwd_tool_coupon_get_inc"] = lambda w: dwd.tool_coupon_get(w.ods.coupon_use_inc())
    q["dwd_tool_coupon_order_inc"] = lambda w: dwd.tool_coupon_order(w.ods.coupon_use_inc())
    q["dwd_tool_coupon_pay_inc"] = lambda w: dwd.tool_coupon_pay(w.ods.coupon_use_inc())
    q["dwd_interaction_favor_add_inc"] = lambda w: dwd.interaction_favor_add(w.ods.favor_info_inc())
    q["dwd_interaction_comment_inc"] = lambda w: dwd.interaction_comment(w.ods.comment_info_inc(), w.ods.dictionary())
    # ---- the first day: all 13 tables bootstrapped from their current rows, and the facts made from them
    q["snapshot_as_changes"] = lambda w: _one_by_one(w, [_all_changes({t: c}) for t, c in w.bootstrapped().items()])
    q["dwd_trade_cart_add_first_day"] = lambda w: dwd.trade_cart_add(w.boot("cart_info"), w.ods.dictionary(), w.d, first_day=True)
    q["dwd_trade_order_detail_first_day"] = lambda w: _one_by_one(w, [dwd.trade_order_detail(
        _share(w.boot("order_detail"), "id", k), w.boot("order_info"), _share(w.boot("order_detail_activity"), "order_detail_id", k),
        _share(w.boot("order_detail_coupon"), "order_detail_id", k), w.ods.dictionary(), w.d, first_day=True) for k in range(SHARES)])
    q["dwd_trade_cancel_detail_first_day"] = lambda w: dwd.trade_cancel_detail(
        w.boot("order_detail"), w.boot("order_info"), w.boot("order_detail_activity"), w.boot("order_detail_coupon"),
        w.ods.dictionary(), w.d, first_day=True)
    q["dwd_trade_pay_detail_suc_first_day"] = lambda w: dwd.trade_pay_detail(
        w.boot("order_detail"), w.boot("order_info"), w.boot("payment_info"), w.boot("order_detail_activity"),
        w.boot("order_detail_coupon"), w.ods.dictionary(), w.d, first_day=True)
    q["dwd_trade_order_refund_first_day"] = lambda w: dwd.trade_order_refund(
        w.boot("order_refund_info"), w.boot("order_info"), w.ods.dictionary(), w.d, first_day=True)
    q["dwd_trade_refund_pay_suc_first_day"] = lambda w: dwd.trade_refund_pay(
        w.boot("refund_payment"), w.boot("order_info"), w.boot("order_refund_info"), w.ods.dictionary(), w.d, first_day=True)
    q["dwd_tool_coupon_get_first_day"] = lambda w: dwd.tool_coupon_get(w.boot("coupon_use"), w.d, first_day=True)
    q["dwd_tool_coupon_order_first_day"] = lambda w: dwd.tool_coupon_order(w.boot("coupon_use"), w.d, first_day=True)
    q["dwd_tool_coupon_pay_first_day"] = lambda w: dwd.tool_coupon_pay(w.boot("coupon_use"), w.d, first_day=True)
    q["dwd_interaction_favor_add_first_day"] = lambda w: dwd.interaction_favor_add(w.boot("favor_info"), w.d, first_day=True)
    q["dwd_interaction_comment_first_day"] = lambda w: dwd.interaction_comment(
        w.boot("comment_info"), w.ods.dictionary(), w.d, first_day=True)
    # ---- collectors (S6–S8): streams over landed lines, their output read back
    q["normalize_types"] = lambda w: files.normalize_types(w.b.raw("orders"))
    q["stream_partition_log_by_event_day"] = lambda w: log_routing(w)
    q["stream_route_cdc"] = lambda w: change_routing(w)
    # ---- raw days, checked and replay-safe reading, publishing
    q["read_snapshot_checked"] = landed.snapshot_checked
    q["load_ods_late_arrival"] = landed.late_arrival
    q["read_cdc_once"] = lambda w: _all_changes(landed.read_changes_once(w))
    q["read_cdc_drift"] = landed.change_drift
    q["read_log_once"] = landed.read_log_once
    q["report_published"] = lambda w: landed.published_report(
        w, ads.order_by_province(w.province_1d(*w._w30(w.d)), w.province_nd(), w.d), ["dt", "recent_days", "province_name"])
    q["run_day"] = landed.chained_days
    q["dim_user_zip_late_days"] = landed.zipper_with_late_days
    return {name: _w(fn) for name, fn in q.items()}


def log_routing(w: Warehouse) -> DataFrame:
    """S6 + S7: the app log lands as JSON lines, some truncated; a stream drops those and routes the rest by event day.

    The stream runs over all that landed, and again (from its checkpoint, to find nothing new); the rows are
    read back from what it wrote.
    """
    log = w.b.ods_log()
    line = F.to_json(F.struct("common", "page", "actions", "displays", "start", "err", "ts"))
    broken = (F.col("ts") % CORRUPT_EVERY) == CORRUPT_AT
    lines = log.select(F.when(broken, F.substring(line, 1, 25)).otherwise(line).alias("value"))
    spark, root = w.b.spark, scratch_folder(w.b.spark, "log-stream")
    lines.write.option("compression", "gzip").text(f"{root}/landed")
    for _ in range(2):
        routing.collect_log(spark, f"{root}/landed", f"{root}/routed", f"{root}/checkpoint").awaitTermination()
    routed = spark.read.schema("value string, dt string").text(f"{root}/routed")
    kept = F.from_json("value", "common STRUCT<mid: STRING>, ts BIGINT")
    return routed.select("dt", kept.alias("k")).select("dt", "k.ts", "k.common.mid")


def change_routing(w: Warehouse) -> DataFrame:
    """The changes of all 13 tables land as JSON lines; one stream routes them by table and day, and they are read back table by table.

    The tables land one after the other. After each the stream runs on from its checkpoint, and again, as above; what it has
    routed goes before more lands.
    """
    spark, root = w.b.spark, scratch_folder(w.b.spark, "change-stream")
    changes = w.ods.changes((shift_date(w.d, -1), w.d))
    for t, c in changes.items():  # a write each: the shuffle files of one table's go before the next one's come
        line = F.to_json(F.struct(F.lit(t).alias("table"), "type", "ts", "data", "old"))
        c.select(line.alias("value")).write.option("compression", "gzip").text(f"{root}/landed/{t}")
        for _ in range(2):
            routing.collect_all_changes(spark, f"{root}/landed/*", f"{root}/routed", f"{root}/checkpoint").awaitTermination()
        files.remove(spark, f"{root}/landed/{t}")
    return _all_changes({t: routing.read_routed(spark, f"{root}/routed", t) for t in changes})


FLAGSHIP = "ads_trade_stats_by_tm"
