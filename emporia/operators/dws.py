"""DWS — 1-day, n-day and to-date summaries.

Every 1-day operator groups by ``dt`` as well, so the daily job is the same
function applied to a one-day slice and the first-day job is the same function
applied to all history (the dynamic-partition form).

``count(distinct order_id)`` next to plain sums is written as two grouping
levels (line -> order -> user): both levels get map-side partial aggregation,
so one heavy user never arrives in a single task as raw lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.functions.spans import MONEY, in_window, nd_measures, shift_date

SKU_ATTRS = [
    "sku_name", "category1_id", "category1_name", "category2_id", "category2_name",
    "category3_id", "category3_name", "tm_id", "tm_name",
]
PROVINCE_ATTRS = ["province_name", "area_code", "iso_code", "iso_3166_2"]


def _sum_money(c: str, nvl: bool = False):
    v = F.coalesce(F.col(c), F.lit(0)) if nvl else F.col(c)
    return F.sum(v).cast(MONEY)


def _sku_attrs(dim_sku: DataFrame) -> DataFrame:
    return dim_sku.select(F.col("id").alias("__sku"), *SKU_ATTRS)


# ----------------------------------------------------------------- 1-day
def trade_user_sku_order_1d(order_detail: DataFrame, dim_sku: DataFrame) -> DataFrame:
    """A1: user×SKU order measures, aggregated first, then enriched with the SKU dimension."""
    agg = order_detail.groupBy("dt", "user_id", "sku_id").agg(
        F.count(F.lit(1)).alias("order_count_1d"),
        F.sum("sku_num").cast("bigint").alias("order_num_1d"),
        _sum_money("split_original_amount").alias("order_original_amount_1d"),
        _sum_money("split_activity_amount", nvl=True).alias("activity_reduce_amount_1d"),
        _sum_money("split_coupon_amount", nvl=True).alias("coupon_reduce_amount_1d"),
        _sum_money("split_total_amount").alias("order_total_amount_1d"),
    )
    j = agg.join(_sku_attrs(dim_sku), agg.sku_id == F.col("__sku"), "left")
    return j.select(
        "user_id", "sku_id", *SKU_ATTRS, "order_count_1d", "order_num_1d", "order_original_amount_1d",
        "activity_reduce_amount_1d", "coupon_reduce_amount_1d", "order_total_amount_1d", "dt",
    )


def trade_user_sku_order_refund_1d(refund_detail: DataFrame, dim_sku: DataFrame) -> DataFrame:
    """A2: user×SKU refund requests, then the SKU dimension."""
    agg = refund_detail.groupBy("dt", "user_id", "sku_id").agg(
        F.count(F.lit(1)).alias("order_refund_count_1d"),
        F.sum("refund_num").cast("bigint").alias("order_refund_num_1d"),
        _sum_money("refund_amount").alias("order_refund_amount_1d"),
    )
    j = agg.join(_sku_attrs(dim_sku), agg.sku_id == F.col("__sku"), "left")
    return j.select(
        "user_id", "sku_id", *SKU_ATTRS, "order_refund_count_1d", "order_refund_num_1d",
        "order_refund_amount_1d", "dt",
    )


def trade_user_order_1d(order_detail: DataFrame) -> DataFrame:
    """A3: per user — distinct orders, quantity and amounts."""
    per_order = order_detail.groupBy("dt", "user_id", "order_id").agg(
        F.sum("sku_num").alias("n"),
        F.sum("split_original_amount").alias("o"),
        F.sum(F.coalesce("split_activity_amount", F.lit(0))).alias("a"),
        F.sum(F.coalesce("split_coupon_amount", F.lit(0))).alias("c"),
        F.sum("split_total_amount").alias("t"),
    )
    return per_order.groupBy("dt", "user_id").agg(
        F.count(F.lit(1)).alias("order_count_1d"),
        F.sum("n").cast("bigint").alias("order_num_1d"),
        F.sum("o").cast(MONEY).alias("order_original_amount_1d"),
        F.sum("a").cast(MONEY).alias("activity_reduce_amount_1d"),
        F.sum("c").cast(MONEY).alias("coupon_reduce_amount_1d"),
        F.sum("t").cast(MONEY).alias("order_total_amount_1d"),
    ).select(
        "user_id", "order_count_1d", "order_num_1d", "order_original_amount_1d",
        "activity_reduce_amount_1d", "coupon_reduce_amount_1d", "order_total_amount_1d", "dt",
    )


def trade_user_cart_add_1d(cart_add: DataFrame) -> DataFrame:
    """A4: per user cart additions (reads the cart-add facts, V7)."""
    return cart_add.groupBy("dt", "user_id").agg(
        F.count(F.lit(1)).alias("cart_add_count_1d"),
        F.sum("sku_num").cast("bigint").alias("cart_add_num_1d"),
    ).select("user_id", "cart_add_count_1d", "cart_add_num_1d", "dt")


def trade_user_payment_1d(pay_detail: DataFrame) -> DataFrame:
    """A5: per user — distinct paid orders, quantity, amount."""
    per_order = pay_detail.groupBy("dt", "user_id", "order_id").agg(
        F.sum("sku_num").alias("n"), F.sum("split_payment_amount").alias("p")
    )
    return per_order.groupBy("dt", "user_id").agg(
        F.count(F.lit(1)).alias("payment_count_1d"),
        F.sum("n").cast("bigint").alias("payment_num_1d"),
        F.sum("p").cast(MONEY).alias("payment_amount_1d"),
    ).select("user_id", "payment_count_1d", "payment_num_1d", "payment_amount_1d", "dt")


def trade_province_order_1d(order_detail: DataFrame, dim_province: DataFrame) -> DataFrame:
    """Per province — distinct orders and amounts, then the province dimension."""
    per_order = order_detail.groupBy("dt", "province_id", "order_id").agg(
        F.sum("split_original_amount").alias("o"),
        F.sum(F.coalesce("split_activity_amount", F.lit(0))).alias("a"),
        F.sum(F.coalesce("split_coupon_amount", F.lit(0))).alias("c"),
        F.sum("split_total_amount").alias("t"),
    )
    agg = per_order.groupBy("dt", "province_id").agg(
        F.count(F.lit(1)).alias("order_count_1d"),
        F.sum("o").cast(MONEY).alias("order_original_amount_1d"),
        F.sum("a").cast(MONEY).alias("activity_reduce_amount_1d"),
        F.sum("c").cast(MONEY).alias("coupon_reduce_amount_1d"),
        F.sum("t").cast(MONEY).alias("order_total_amount_1d"),
    )
    prov = dim_province.select(F.col("id").alias("__pid"), *PROVINCE_ATTRS)
    j = agg.join(prov, agg.province_id == F.col("__pid"), "left")
    return j.select(
        "province_id", *PROVINCE_ATTRS, "order_count_1d", "order_original_amount_1d",
        "activity_reduce_amount_1d", "coupon_reduce_amount_1d", "order_total_amount_1d", "dt",
    )


def trade_user_order_refund_1d(refund_detail: DataFrame) -> DataFrame:
    """Per user refund requests (reads the refund-request facts, V8)."""
    return refund_detail.groupBy("dt", "user_id").agg(
        F.count(F.lit(1)).alias("order_refund_count_1d"),
        F.sum("refund_num").cast("bigint").alias("order_refund_num_1d"),
        _sum_money("refund_amount").alias("order_refund_amount_1d"),
    ).select("user_id", "order_refund_count_1d", "order_refund_num_1d", "order_refund_amount_1d", "dt")


SESSION_KEYS = ["session_id", "mid_id", "brand", "model", "operate_system", "version_code", "channel"]
VISITOR_KEYS = ["mid_id", "brand", "model", "operate_system", "page_id"]


def traffic_session_page_view_1d(page_view: DataFrame) -> DataFrame:
    """Per session — total duration and page count."""
    return page_view.groupBy("dt", *SESSION_KEYS).agg(
        F.sum("during_time").cast("bigint").alias("during_time_1d"),
        F.count(F.lit(1)).alias("page_count_1d"),
    ).select(*SESSION_KEYS, "during_time_1d", "page_count_1d", "dt")


def traffic_page_visitor_page_view_1d(page_view: DataFrame) -> DataFrame:
    """Per device × page — duration and views."""
    return page_view.groupBy("dt", *VISITOR_KEYS).agg(
        F.sum("during_time").cast("bigint").alias("during_time_1d"),
        F.count(F.lit(1)).alias("view_count_1d"),
    ).select(*VISITOR_KEYS, "during_time_1d", "view_count_1d", "dt")


# --------------------------------------------------------------- n-day
def _nd(df: DataFrame, keys: list[str], measures, do_date: str) -> DataFrame:
    """One scan of the 30 days ending at ``do_date`` (upper bound included, V6)."""
    window = df.where(in_window("dt", do_date, 30))
    return window.groupBy(*keys).agg(*nd_measures(measures, do_date)).withColumn("dt", F.lit(do_date))


def _order_nd(df: DataFrame, keys: list[str], do_date: str) -> DataFrame:
    measures = [
        ("order_count_1d", "order_count", "bigint"),
        ("order_num_1d", "order_num", "bigint"),
        ("order_original_amount_1d", "order_original_amount", "money"),
        ("activity_reduce_amount_1d", "activity_reduce_amount", "money"),
        ("coupon_reduce_amount_1d", "coupon_reduce_amount", "money"),
        ("order_total_amount_1d", "order_total_amount", "money"),
    ]
    return _nd(df, keys, measures, do_date)


def trade_user_sku_order_nd(user_sku_order_1d: DataFrame, do_date: str) -> DataFrame:
    """A10: user×SKU order measures over 7 and 30 days (7-day count BIGINT, V13)."""
    return _order_nd(user_sku_order_1d, ["user_id", "sku_id", *SKU_ATTRS], do_date)


def trade_user_sku_order_refund_nd(user_sku_refund_1d: DataFrame, do_date: str) -> DataFrame:
    """user×SKU refund measures over 7 and 30 days."""
    measures = [
        ("order_refund_count_1d", "order_refund_count", "bigint"),
        ("order_refund_num_1d", "order_refund_num", "bigint"),
        ("order_refund_amount_1d", "order_refund_amount", "money"),
    ]
    return _nd(user_sku_refund_1d, ["user_id", "sku_id", *SKU_ATTRS], measures, do_date)


def trade_user_order_nd(user_order_1d: DataFrame, do_date: str) -> DataFrame:
    """Per user over 7 and 30 days (7-day total sums the total, V4)."""
    return _order_nd(user_order_1d, ["user_id"], do_date)


def trade_user_cart_add_nd(cart_add_1d: DataFrame, do_date: str) -> DataFrame:
    """A13."""
    measures = [("cart_add_count_1d", "cart_add_count", "bigint"), ("cart_add_num_1d", "cart_add_num", "bigint")]
    return _nd(cart_add_1d, ["user_id"], measures, do_date)


def trade_user_payment_nd(payment_1d: DataFrame, do_date: str) -> DataFrame:
    """A14."""
    measures = [
        ("payment_count_1d", "payment_count", "bigint"),
        ("payment_num_1d", "payment_num", "bigint"),
        ("payment_amount_1d", "payment_amount", "money"),
    ]
    return _nd(payment_1d, ["user_id"], measures, do_date)


def trade_province_order_nd(province_1d: DataFrame, do_date: str) -> DataFrame:
    """Per province (30-day total sums the total, V5)."""
    measures = [
        ("order_count_1d", "order_count", "bigint"),
        ("order_original_amount_1d", "order_original_amount", "money"),
        ("activity_reduce_amount_1d", "activity_reduce_amount", "money"),
        ("coupon_reduce_amount_1d", "coupon_reduce_amount", "money"),
        ("order_total_amount_1d", "order_total_amount", "money"),
    ]
    return _nd(province_1d, ["province_id", *PROVINCE_ATTRS], measures, do_date)


def trade_coupon_order_nd(order_detail: DataFrame, dim_coupon: DataFrame, do_date: str) -> DataFrame:
    """Coupons released in the last 30 days with the order lines that used them.

    Unused coupons stay (right join) and are grouped by the coupon's own id
    (V9). Lines are aggregated per coupon before the join: coupon ids are
    unique in the dimension, so this equals join-then-group with a smaller
    shuffle.
    """
    lines = order_detail.where(in_window("dt", do_date, 30) & F.col("coupon_id").isNotNull())
    used = lines.groupBy("coupon_id").agg(
        F.sum("split_original_amount").alias("o"), F.sum("split_coupon_amount").alias("c")
    )
    start_date = F.substring("start_time", 1, 10)
    cou = dim_coupon.where(start_date >= F.lit(shift_date(do_date, -29))).select(
        F.col("id").alias("coupon_id"), "coupon_name", "coupon_type_code", "coupon_type_name",
        F.col("benefit_rule").alias("coupon_rule"), start_date.alias("start_date"),
    )
    j = cou.join(used, "coupon_id", "left")
    keys = ["coupon_id", "coupon_name", "coupon_type_code", "coupon_type_name", "coupon_rule", "start_date"]
    return j.groupBy(*keys).agg(
        F.sum("o").cast(MONEY).alias("original_amount_30d"),
        F.sum("c").cast(MONEY).alias("coupon_reduce_amount_30d"),
    ).withColumn("dt", F.lit(do_date))


def trade_activity_order_nd(order_detail: DataFrame, dim_activity: DataFrame, do_date: str) -> DataFrame:
    """Activities started in the last 30 days (deduplicated) with their order lines."""
    lines = order_detail.where(in_window("dt", do_date, 30) & F.col("activity_id").isNotNull())
    used = lines.groupBy("activity_id").agg(
        F.sum("split_original_amount").alias("o"), F.sum("split_activity_amount").alias("a")
    )
    act_keys = ["activity_id", "activity_name", "activity_type_code", "activity_type_name", "start_time"]
    act = (
        dim_activity.where(F.substring("start_time", 1, 10) >= F.lit(shift_date(do_date, -29)))
        .select(*act_keys)
        .dropDuplicates(act_keys)
    )
    j = act.join(used, "activity_id", "left")
    return j.groupBy(*act_keys).agg(
        F.sum("o").cast(MONEY).alias("original_amount_30d"),
        F.sum("a").cast(MONEY).alias("activity_reduce_amount_30d"),
    ).select(
        "activity_id", "activity_name", "activity_type_code", "activity_type_name",
        F.substring("start_time", 1, 10).alias("start_date"), "original_amount_30d",
        "activity_reduce_amount_30d", F.lit(do_date).alias("dt"),
    )


def trade_user_order_refund_nd(user_refund_1d: DataFrame, do_date: str) -> DataFrame:
    """A18."""
    measures = [
        ("order_refund_count_1d", "order_refund_count", "bigint"),
        ("order_refund_num_1d", "order_refund_num", "bigint"),
        ("order_refund_amount_1d", "order_refund_amount", "money"),
    ]
    return _nd(user_refund_1d, ["user_id"], measures, do_date)


def traffic_page_visitor_page_view_nd(visitor_1d: DataFrame, do_date: str) -> DataFrame:
    """A19."""
    measures = [("during_time_1d", "during_time", "bigint"), ("view_count_1d", "view_count", "bigint")]
    return _nd(visitor_1d, VISITOR_KEYS, measures, do_date)


# ------------------------------------------------------------- to-date
def trade_user_order_td_init(user_order_1d: DataFrame, do_date: str) -> DataFrame:
    """A20 first day: aggregate all history up to ``do_date``."""
    hist = user_order_1d.where(F.col("dt") <= F.lit(do_date))
    return hist.groupBy("user_id").agg(
        F.min("dt").alias("order_date_first"),
        F.max("dt").alias("order_date_last"),
        F.sum("order_count_1d").cast("bigint").alias("order_count_td"),
        F.sum("order_num_1d").cast("bigint").alias("order_num_td"),
        F.sum("order_original_amount_1d").cast(MONEY).alias("original_amount_td"),
        F.sum("activity_reduce_amount_1d").cast(MONEY).alias("activity_reduce_amount_td"),
        F.sum("coupon_reduce_amount_1d").cast(MONEY).alias("coupon_reduce_amount_td"),
        F.sum("order_total_amount_1d").cast(MONEY).alias("total_amount_td"),
    ).withColumn("dt", F.lit(do_date))


def _nvl0(c: str):
    return F.coalesce(F.col(c), F.lit(0))


def trade_user_order_td(old_td: DataFrame, user_order_1d: DataFrame, do_date: str) -> DataFrame:
    """A20 daily: yesterday's state FULL OUTER JOIN today's delta."""
    old = old_td.select(
        F.col("user_id").alias("o_uid"), "order_date_first", "order_date_last", "order_count_td",
        "order_num_td", "original_amount_td", "activity_reduce_amount_td", "coupon_reduce_amount_td",
        "total_amount_td",
    )
    new = user_order_1d.where(F.col("dt") == F.lit(do_date)).drop("dt")
    j = old.join(new, old.o_uid == new.user_id, "full")
    is_new = F.col("user_id").isNotNull()
    return j.select(
        F.coalesce("o_uid", "user_id").alias("user_id"),
        F.when(is_new & F.col("o_uid").isNull(), F.lit(do_date)).otherwise(F.col("order_date_first")).alias("order_date_first"),
        F.when(is_new, F.lit(do_date)).otherwise(F.col("order_date_last")).alias("order_date_last"),
        (_nvl0("order_count_td") + _nvl0("order_count_1d")).cast("bigint").alias("order_count_td"),
        (_nvl0("order_num_td") + _nvl0("order_num_1d")).cast("bigint").alias("order_num_td"),
        (_nvl0("original_amount_td") + _nvl0("order_original_amount_1d")).cast(MONEY).alias("original_amount_td"),
        (_nvl0("activity_reduce_amount_td") + _nvl0("activity_reduce_amount_1d")).cast(MONEY).alias("activity_reduce_amount_td"),
        (_nvl0("coupon_reduce_amount_td") + _nvl0("coupon_reduce_amount_1d")).cast(MONEY).alias("coupon_reduce_amount_td"),
        (_nvl0("total_amount_td") + _nvl0("order_total_amount_1d")).cast(MONEY).alias("total_amount_td"),
        F.lit(do_date).alias("dt"),
    )


def trade_user_payment_td_init(payment_1d: DataFrame, do_date: str) -> DataFrame:
    """A21 first day."""
    hist = payment_1d.where(F.col("dt") <= F.lit(do_date))
    return hist.groupBy("user_id").agg(
        F.min("dt").alias("payment_date_first"),
        F.max("dt").alias("payment_date_last"),
        F.sum("payment_count_1d").cast("bigint").alias("payment_count_td"),
        F.sum("payment_num_1d").cast("bigint").alias("payment_num_td"),
        F.sum("payment_amount_1d").cast(MONEY).alias("payment_amount_td"),
    ).withColumn("dt", F.lit(do_date))


def trade_user_payment_td(old_td: DataFrame, payment_1d: DataFrame, do_date: str) -> DataFrame:
    """A21 daily."""
    old = old_td.select(
        F.col("user_id").alias("o_uid"), "payment_date_first", "payment_date_last", "payment_count_td",
        "payment_num_td", "payment_amount_td",
    )
    new = payment_1d.where(F.col("dt") == F.lit(do_date)).drop("dt")
    j = old.join(new, old.o_uid == new.user_id, "full")
    is_new = F.col("user_id").isNotNull()
    return j.select(
        F.coalesce("o_uid", "user_id").alias("user_id"),
        F.when(is_new & F.col("o_uid").isNull(), F.lit(do_date)).otherwise(F.col("payment_date_first")).alias("payment_date_first"),
        F.when(is_new, F.lit(do_date)).otherwise(F.col("payment_date_last")).alias("payment_date_last"),
        (_nvl0("payment_count_td") + _nvl0("payment_count_1d")).cast("bigint").alias("payment_count_td"),
        (_nvl0("payment_num_td") + _nvl0("payment_num_1d")).cast("bigint").alias("payment_num_td"),
        (_nvl0("payment_amount_td") + _nvl0("payment_amount_1d")).cast(MONEY).alias("payment_amount_td"),
        F.lit(do_date).alias("dt"),
    )


def user_login_td_init(users_open: DataFrame, login: DataFrame, do_date: str) -> DataFrame:
    """A22 first day: every current user with the logins of all days so far; no login yet -> registration day, count 1."""
    day_logins = login.where(F.col("dt") <= F.lit(do_date)).groupBy("user_id").agg(
        F.max("dt").alias("login_date_last"), F.count(F.lit(1)).alias("login_count_td")
    )
    u = users_open.select(F.col("id").alias("user_id"), F.substring("create_time", 1, 10).alias("create_date"))
    j = u.join(day_logins, "user_id", "left")
    return j.select(
        "user_id",
        F.coalesce("login_date_last", "create_date").alias("login_date_last"),
        F.coalesce("login_count_td", F.lit(1)).cast("bigint").alias("login_count_td"),
        F.lit(do_date).alias("dt"),
    )


def user_login_td_history(login: DataFrame, do_date: str) -> DataFrame:
    """A22 state rebuilt from all login facts up to ``do_date`` (back-fill form)."""
    hist = login.where(F.col("dt") <= F.lit(do_date))
    return hist.groupBy("user_id").agg(
        F.max("dt").alias("login_date_last"), F.count(F.lit(1)).cast("bigint").alias("login_count_td")
    ).withColumn("dt", F.lit(do_date))


def user_login_td(old_td: DataFrame, login: DataFrame, do_date: str) -> DataFrame:
    """A22 daily: yesterday's state FULL OUTER JOIN today's logins."""
    old = old_td.select(F.col("user_id").alias("o_uid"), "login_date_last", "login_count_td")
    new = login.where(F.col("dt") == F.lit(do_date)).groupBy("user_id").agg(
        F.count(F.lit(1)).alias("login_count_1d")
    )
    j = old.join(new, old.o_uid == new.user_id, "full")
    return j.select(
        F.coalesce("o_uid", "user_id").alias("user_id"),
        F.when(F.col("user_id").isNotNull(), F.lit(do_date)).otherwise(F.col("login_date_last")).alias("login_date_last"),
        (_nvl0("login_count_td") + _nvl0("login_count_1d")).cast("bigint").alias("login_count_td"),
        F.lit(do_date).alias("dt"),
    )

