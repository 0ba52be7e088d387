"""DWD — transaction and traffic facts.

Change records (``type, ts, data, old``) and the nested app log come in with a
``dt`` column; every operator keeps ``dt`` so that it runs on one day (daily
job) or on many days at once (first-day / back-fill job) unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emporia.functions.sessions import first_row_per_group, running_start
from emporia.functions.spans import MONEY, change_has, shift_date
from emporia.functions.times import date_from_ms, date_from_s, date_of_text, time_from_ms, time_from_s

# Code book of the source system.
ORDER_PAID, ORDER_CANCELLED, ORDER_REFUND_REQUESTED, ORDER_REFUNDED = "1002", "1003", "1005", "1006"
PAYMENT_OK = "1602"
REFUND_PAID, REFUND_REQUESTED = "1602", "0705"
DIC_PAYMENT, DIC_APPRAISE, DIC_REFUND_REASON, DIC_REFUND_TYPE, DIC_SOURCE = "11", "12", "13", "15", "24"


def _dic(dictionary: DataFrame, parent: str, code: str, name: str) -> DataFrame:
    """A code book's entries, sent to every task: facts have a few codes, so dealing them out by code would be a few tasks."""
    return F.broadcast(dictionary.where(F.col("parent_code") == parent).select(
        F.col("dic_code").alias(code), F.col("dic_name").alias(name)
    ))


def _day(df: DataFrame, do_date: str | None) -> DataFrame:
    return df if do_date is None else df.where(F.col("dt") == F.lit(do_date))


# ------------------------------------------------------------------ trade
def trade_cart_add(cart_inc: DataFrame, dictionary: DataFrame, do_date: str | None = None, first_day: bool = False) -> DataFrame:
    """cart additions — inserts, and updates that raised the quantity (delta = new − old).

    On the first day the bootstrapped cart lines are the additions, each on the day it was made.
    """
    c = _day(cart_inc, do_date)
    if first_day:
        c = c.where(F.col("type") == "bootstrap-insert").withColumn("dt", date_of_text("data.create_time"))
        made = F.coalesce(F.unix_timestamp(F.to_utc_timestamp("data.create_time", "GMT+8")), F.col("ts"))
        c = c.withColumn("ts", made).withColumn("type", F.lit("insert"))
    old_num = F.col("old").getItem("sku_num")
    raised = (F.col("type") == "update") & old_num.isNotNull() & (
        F.col("data.sku_num") > old_num.cast("bigint")
    )
    rows = c.where((F.col("type") == "insert") | raised).select(
        F.col("data.id").alias("id"), F.col("data.user_id").alias("user_id"), F.col("data.sku_id").alias("sku_id"),
        date_from_s("ts").alias("date_id"), time_from_s("ts").alias("create_time"),
        F.col("data.source_id").alias("source_id"), F.col("data.source_type").alias("source_type_code"),
        F.when(F.col("type") == "insert", F.col("data.sku_num"))
        .otherwise(F.col("data.sku_num") - old_num.cast("bigint")).cast("bigint").alias("sku_num"),
        "dt",
    )
    dic = _dic(dictionary, DIC_SOURCE, "__code", "source_type_name")
    j = rows.join(dic, rows.source_type_code == F.col("__code"), "left")
    return j.select(
        "id", "user_id", "sku_id", "date_id", "create_time", "source_id", "source_type_code", "source_type_name",
        "sku_num", "dt",
    )


def _detail_lines(order_detail_inc: DataFrame, types: tuple[str, ...]) -> DataFrame:
    taken = order_detail_inc.where(F.col("type").isin(*types)).select(
        F.col("data.id").alias("id"), F.col("data.order_id").alias("order_id"), F.col("data.sku_id").alias("sku_id"),
        F.col("data.create_time").alias("create_time"), F.col("data.source_id").alias("source_id"),
        F.col("data.source_type").alias("source_type_code"), F.col("data.sku_num").alias("sku_num"),
        F.col("data.order_price").alias("__price"), F.col("data.split_activity_amount").alias("split_activity_amount"),
        F.col("data.split_coupon_amount").alias("split_coupon_amount"),
        F.col("data.split_total_amount").alias("split_total_amount"),
        F.col("dt").alias("__line_dt"),
    )
    return taken.select(
        "id", "order_id", "sku_id", "create_time", "source_id", "source_type_code", "sku_num",
        (F.col("sku_num") * F.col("__price")).cast(MONEY).alias("split_original_amount"),
        "split_activity_amount", "split_coupon_amount", "split_total_amount", "__line_dt",
    )


def _line_links(detail_activity_inc: DataFrame, detail_coupon_inc: DataFrame, types: tuple[str, ...]):
    act = detail_activity_inc.where(F.col("type").isin(*types)).select(
        F.col("data.order_detail_id").alias("__act_line"), F.col("data.activity_id").alias("activity_id"),
        F.col("data.activity_rule_id").alias("activity_rule_id"), F.col("dt").alias("__act_dt"),
    )
    cou = detail_coupon_inc.where(F.col("type").isin(*types)).select(
        F.col("data.order_detail_id").alias("__cou_line"), F.col("data.coupon_id").alias("coupon_id"),
        F.col("dt").alias("__cou_dt"),
    )
    return act, cou


LINE_MEASURES = ["sku_num", "split_original_amount", "split_activity_amount", "split_coupon_amount"]


def trade_order_detail(
    order_detail_inc: DataFrame, order_info_inc: DataFrame, detail_activity_inc: DataFrame,
    detail_coupon_inc: DataFrame, dictionary: DataFrame, do_date: str | None = None, first_day: bool = False,
) -> DataFrame:
    """order lines ⟕ order ⟕ activity ⟕ coupon ⟕ source dictionary; original = qty × price.

    Daily: the day's inserts. First day: ``bootstrap-insert`` rows, and ``dt``
    becomes the line's own creation day (dynamic partitions).
    """
    types = ("bootstrap-insert",) if first_day else ("insert",)
    lines = _detail_lines(_day(order_detail_inc, do_date), types)
    orders = _day(order_info_inc, do_date).where(F.col("type").isin(*types)).select(
        F.col("data.id").alias("__oid"), F.col("data.user_id").alias("user_id"),
        F.col("data.province_id").alias("province_id"),
    )
    act, cou = _line_links(_day(detail_activity_inc, do_date), _day(detail_coupon_inc, do_date), types)
    dic = _dic(dictionary, DIC_SOURCE, "__code", "source_type_name")
    j = (
        lines.join(orders, lines.order_id == F.col("__oid"), "left")
        .join(act, lines.id == F.col("__act_line"), "left")
        .join(cou, lines.id == F.col("__cou_line"), "left")
        .join(dic, lines.source_type_code == F.col("__code"), "left")
    )
    date_id = date_of_text("create_time")
    return j.select(
        "id", "order_id", "user_id", "sku_id", "province_id", "activity_id", "activity_rule_id", "coupon_id",
        date_id.alias("date_id"), "create_time", "source_id", "source_type_code", "source_type_name",
        *LINE_MEASURES, "split_total_amount",
        (date_id if first_day else F.col("__line_dt")).alias("dt"),
    )


def _status_changed_to(order_info_inc: DataFrame, status: str) -> Column:
    return (
        (F.col("type") == "update") & change_has("old", "order_status") & (F.col("data.order_status") == status)
    )


def _status_now(status: str) -> Column:
    """First day: a bootstrapped row already in ``status``."""
    return (F.col("type") == "bootstrap-insert") & (F.col("data.order_status") == status)


def _lookback(first_day: bool, do_date: str | None, lookback_days: int):
    """The rows that a run on ``do_date`` may look up, by partition; every row for all event days."""
    if do_date is None:
        return lambda df: df
    lo = do_date if first_day else shift_date(do_date, -lookback_days)
    return lambda df: df.where((F.col("dt") >= F.lit(lo)) & (F.col("dt") <= F.lit(do_date)))


def _event_days(lookback_days: int) -> list[Column]:
    """An event's day, and the first day that it looks back to."""
    first = F.date_format(F.date_sub(F.col("dt").cast("date"), lookback_days), "yyyy-MM-dd")
    return [F.col("dt").alias("__day"), first.alias("__from")]


def _in_reach(dt: str) -> Column:
    """Rows of day ``dt`` that the event of the joined side may look up."""
    return (F.col(dt) >= F.col("__from")) & (F.col(dt) <= F.col("__day"))


def _event_dt(time_col: str, first_day: bool) -> Column:
    """Daily: the event's day. First day: the day of the row's own event time."""
    return (date_of_text(time_col) if first_day else F.col("__day")).alias("dt")


def trade_cancel_detail(
    order_detail_inc: DataFrame, order_info_inc: DataFrame, detail_activity_inc: DataFrame,
    detail_coupon_inc: DataFrame, dictionary: DataFrame, do_date: str | None = None, lookback_days: int = 1,
    first_day: bool = False,
) -> DataFrame:
    """lines of orders whose status became cancelled; lines looked up ``lookback_days`` back.

    First day: bootstrapped orders already cancelled, each to the day it was cancelled. Without
    ``do_date``: all event days, each looking back from its own.
    """
    window = _lookback(first_day, do_date, lookback_days)
    lines = _detail_lines(window(order_detail_inc), ("insert", "bootstrap-insert"))
    became = _status_now(ORDER_CANCELLED) if first_day else _status_changed_to(order_info_inc, ORDER_CANCELLED)
    cancelled = _day(order_info_inc, do_date).where(became).select(
        F.col("data.id").alias("__oid"), F.col("data.user_id").alias("user_id"),
        F.col("data.province_id").alias("province_id"), F.col("data.operate_time").alias("cancel_time"),
        *_event_days(0 if first_day else lookback_days),
    )
    act, cou = _line_links(window(detail_activity_inc), window(detail_coupon_inc), ("insert", "bootstrap-insert"))
    dic = _dic(dictionary, DIC_SOURCE, "__code", "source_type_name")
    j = (
        lines.join(cancelled, (lines.order_id == F.col("__oid")) & _in_reach("__line_dt"), "inner")
        .join(act, (lines.id == F.col("__act_line")) & _in_reach("__act_dt"), "left")
        .join(cou, (lines.id == F.col("__cou_line")) & _in_reach("__cou_dt"), "left")
        .join(dic, lines.source_type_code == F.col("__code"), "left")
    )
    return j.select(
        "id", "order_id", "user_id", "sku_id", "province_id", "activity_id", "activity_rule_id", "coupon_id",
        date_of_text("cancel_time").alias("date_id"), "cancel_time", "source_id", "source_type_code",
        "source_type_name", *LINE_MEASURES, "split_total_amount", _event_dt("cancel_time", first_day),
    )


def trade_pay_detail(
    order_detail_inc: DataFrame, order_info_inc: DataFrame, payment_inc: DataFrame, detail_activity_inc: DataFrame,
    detail_coupon_inc: DataFrame, dictionary: DataFrame, do_date: str | None = None, lookback_days: int = 1,
    first_day: bool = False,
) -> DataFrame:
    """lines of orders whose payment succeeded today; payment and source names.

    First day: bootstrapped successful payments, each to its callback day. Without ``do_date``: all event days.
    """
    reach = 0 if first_day else lookback_days
    window = _lookback(first_day, do_date, lookback_days)
    lines = _detail_lines(window(order_detail_inc), ("insert", "bootstrap-insert"))
    ok = F.col("data.payment_status") == PAYMENT_OK
    became = ((F.col("type") == "bootstrap-insert") & ok) if first_day else (
        (F.col("type") == "update") & change_has("old", "payment_status") & ok)
    paid = _day(payment_inc, do_date).where(became).select(
        F.col("data.order_id").alias("__pid"), F.col("data.user_id").alias("user_id"),
        F.col("data.payment_type").alias("payment_type_code"), F.col("data.callback_time").alias("callback_time"),
        *_event_days(reach),
    )
    # an order's row serves the events of its day and of the days that look back to it: one row for each
    days = F.transform(F.sequence(F.lit(0), F.lit(reach)), lambda k: F.date_format(F.date_add(F.col("dt").cast("date"), k), "yyyy-MM-dd"))
    served = F.explode(days) if reach else F.col("dt")
    orders = window(order_info_inc).select(
        F.col("data.id").alias("__oid"), F.col("data.province_id").alias("province_id"), served.alias("__oday")
    ).dropDuplicates(["__oid", "__oday"])
    act, cou = _line_links(window(detail_activity_inc), window(detail_coupon_inc), ("insert", "bootstrap-insert"))
    pay_dic = _dic(dictionary, DIC_PAYMENT, "__pcode", "payment_type_name")
    src_dic = _dic(dictionary, DIC_SOURCE, "__code", "source_type_name")
    j = (
        lines.join(paid, (lines.order_id == F.col("__pid")) & _in_reach("__line_dt"), "inner")
        .join(orders, (lines.order_id == F.col("__oid")) & (F.col("__day") == F.col("__oday")), "left")
        .join(act, (lines.id == F.col("__act_line")) & _in_reach("__act_dt"), "left")
        .join(cou, (lines.id == F.col("__cou_line")) & _in_reach("__cou_dt"), "left")
        .join(pay_dic, F.col("payment_type_code") == F.col("__pcode"), "left")
        .join(src_dic, lines.source_type_code == F.col("__code"), "left")
    )
    return j.select(
        "id", "order_id", "user_id", "sku_id", "province_id", "activity_id", "activity_rule_id", "coupon_id",
        "payment_type_code", "payment_type_name", date_of_text("callback_time").alias("date_id"), "callback_time",
        "source_id", "source_type_code", "source_type_name", *LINE_MEASURES,
        F.col("split_total_amount").alias("split_payment_amount"), _event_dt("callback_time", first_day),
    )


def trade_order_refund(
    refund_inc: DataFrame, order_info_inc: DataFrame, dictionary: DataFrame, do_date: str | None = None, first_day: bool = False,
) -> DataFrame:
    """refund requests ⟕ the order's change of that day (status → refund requested, for the province) ⟕ type ⟕ reason.

    First day: every bootstrapped request ⟕ its bootstrapped order, each to its request day. Without ``do_date``: all event days.
    """
    ri = _day(refund_inc, do_date).where(
        F.col("type") == ("bootstrap-insert" if first_day else "insert")).select(
        F.col("data.id").alias("id"), F.col("data.user_id").alias("user_id"),
        F.col("data.order_id").alias("order_id"), F.col("data.sku_id").alias("sku_id"),
        F.col("data.create_time").alias("create_time"), F.col("data.refund_type").alias("refund_type_code"),
        F.col("data.refund_reason_type").alias("refund_reason_type_code"),
        F.col("data.refund_reason_txt").alias("refund_reason_txt"), F.col("data.refund_num").alias("refund_num"),
        F.col("data.refund_amount").alias("refund_amount"), F.col("dt").alias("__day"),
    )
    order_rows = (F.col("type") == "bootstrap-insert") if first_day else _status_changed_to(
        order_info_inc, ORDER_REFUND_REQUESTED)
    oi = _day(order_info_inc, do_date).where(order_rows).select(
        F.col("data.id").alias("__oid"), F.col("data.province_id").alias("province_id"), F.col("dt").alias("__oday")
    )
    t = _dic(dictionary, DIC_REFUND_TYPE, "__t", "refund_type_name")
    r = _dic(dictionary, DIC_REFUND_REASON, "__r", "refund_reason_type_name")
    j = (
        ri.join(oi, (ri.order_id == F.col("__oid")) & (F.col("__day") == F.col("__oday")), "left")
        .join(t, ri.refund_type_code == F.col("__t"), "left")
        .join(r, ri.refund_reason_type_code == F.col("__r"), "left")
    )
    return j.select(
        "id", "user_id", "order_id", "sku_id", "province_id", date_of_text("create_time").alias("date_id"),
        "create_time", "refund_type_code", "refund_type_name", "refund_reason_type_code",
        "refund_reason_type_name", "refund_reason_txt", "refund_num", "refund_amount",
        _event_dt("create_time", first_day),
    )


def trade_refund_pay(
    refund_payment_inc: DataFrame, order_info_inc: DataFrame, refund_inc: DataFrame, dictionary: DataFrame,
    do_date: str | None = None, first_day: bool = False,
) -> DataFrame:
    """successful refund payments ⟕ order (refunded that day) ⟕ refund request (requested, of that day) on two keys.

    First day: bootstrapped successful refund payments ⟕ bootstrapped orders and requests, each to its callback day.
    Without ``do_date``: all event days.
    """
    paid_ok = F.col("data.refund_status") == REFUND_PAID
    rp_rows = ((F.col("type") == "bootstrap-insert") & paid_ok) if first_day else (
        (F.col("type") == "update") & change_has("old", "refund_status") & paid_ok)
    rp = _day(refund_payment_inc, do_date).where(rp_rows).select(
        F.col("data.id").alias("id"), F.col("data.order_id").alias("order_id"), F.col("data.sku_id").alias("sku_id"),
        F.col("data.payment_type").alias("payment_type_code"), F.col("data.callback_time").alias("callback_time"),
        F.col("data.total_amount").alias("refund_amount"), F.col("dt").alias("__day"),
    )
    oi_rows = (F.col("type") == "bootstrap-insert") if first_day else _status_changed_to(order_info_inc, ORDER_REFUNDED)
    oi = _day(order_info_inc, do_date).where(oi_rows).select(
        F.col("data.id").alias("__oid"), F.col("data.user_id").alias("user_id"),
        F.col("data.province_id").alias("province_id"), F.col("dt").alias("__oday"),
    )
    ri_rows = (F.col("type") == "bootstrap-insert") if first_day else (
        (F.col("type") == "update") & change_has("old", "refund_status")
        & (F.col("data.refund_status") == REFUND_REQUESTED))
    ri = _day(refund_inc, do_date).where(ri_rows).select(
        F.col("data.order_id").alias("__r_order"), F.col("data.sku_id").alias("__r_sku"),
        F.col("data.refund_num").alias("refund_num"), F.col("dt").alias("__rday"),
    )
    pay = _dic(dictionary, DIC_PAYMENT, "__p", "payment_type_name")
    j = (
        rp.join(oi, (rp.order_id == F.col("__oid")) & (F.col("__day") == F.col("__oday")), "left")
        .join(ri, (rp.order_id == F.col("__r_order")) & (rp.sku_id == F.col("__r_sku")) & (F.col("__day") == F.col("__rday")), "left")
        .join(pay, rp.payment_type_code == F.col("__p"), "left")
    )
    return j.select(
        "id", "user_id", "order_id", "sku_id", "province_id", "payment_type_code", "payment_type_name",
        date_of_text("callback_time").alias("date_id"), "callback_time",
        F.col("refund_num").cast(MONEY).alias("refund_num"), "refund_amount",
        _event_dt("callback_time", first_day),
    )


def trade_cart_full(cart_full_snapshot: DataFrame, do_date: str | None = None) -> DataFrame:
    """the day's snapshot of cart lines not yet ordered."""
    c = _day(cart_full_snapshot, do_date).where(F.col("is_ordered") == "0")
    return c.select("id", "user_id", "sku_id", "sku_name", "sku_num", "dt")


# ------------------------------------------------------------ tool / interaction
def _first_day_dt(df: DataFrame, first_day: bool) -> DataFrame:
    """First-day form: rows go to the partition of their own business day."""
    return df.withColumn("dt", F.col("date_id")) if first_day else df


def tool_coupon_get(coupon_use_inc: DataFrame, do_date: str | None = None, first_day: bool = False) -> DataFrame:
    """F8: coupons received (first day: every bootstrapped coupon use, by receive day)."""
    c = _day(coupon_use_inc, do_date).where(F.col("type") == ("bootstrap-insert" if first_day else "insert"))
    return _first_day_dt(c.select(
        F.col("data.id").alias("id"), F.col("data.coupon_id").alias("coupon_id"), F.col("data.user_id").alias("user_id"),
        date_of_text("data.get_time").alias("date_id"), F.col("data.get_time").alias("get_time"), "dt",
    ), first_day)


def tool_coupon_order(coupon_use_inc: DataFrame, do_date: str | None = None, first_day: bool = False) -> DataFrame:
    """coupons used when ordering (``using_time`` changed; first day: set)."""
    if first_day:
        cond = (F.col("type") == "bootstrap-insert") & F.col("data.using_time").isNotNull()
    else:
        cond = (F.col("type") == "update") & change_has("old", "using_time")
    c = _day(coupon_use_inc, do_date).where(cond)
    return _first_day_dt(c.select(
        F.col("data.id").alias("id"), F.col("data.coupon_id").alias("coupon_id"), F.col("data.user_id").alias("user_id"),
        F.col("data.order_id").alias("order_id"), date_of_text("data.using_time").alias("date_id"),
        F.col("data.using_time").alias("order_time"), "dt",
    ), first_day)


def tool_coupon_pay(coupon_use_inc: DataFrame, do_date: str | None = None, first_day: bool = False) -> DataFrame:
    """coupons used at payment (``used_time`` changed; first day: set)."""
    if first_day:
        cond = (F.col("type") == "bootstrap-insert") & F.col("data.used_time").isNotNull()
    else:
        cond = (F.col("type") == "update") & change_has("old", "used_time")
    c = _day(coupon_use_inc, do_date).where(cond)
    return _first_day_dt(c.select(
        F.col("data.id").alias("id"), F.col("data.coupon_id").alias("coupon_id"), F.col("data.user_id").alias("user_id"),
        F.col("data.order_id").alias("order_id"), date_of_text("data.used_time").alias("date_id"),
        F.col("data.used_time").alias("payment_time"), "dt",
    ), first_day)


def interaction_favor_add(favor_inc: DataFrame, do_date: str | None = None, first_day: bool = False) -> DataFrame:
    """favourites added."""
    c = _day(favor_inc, do_date).where(F.col("type") == ("bootstrap-insert" if first_day else "insert"))
    return _first_day_dt(c.select(
        F.col("data.id").alias("id"), F.col("data.user_id").alias("user_id"), F.col("data.sku_id").alias("sku_id"),
        date_of_text("data.create_time").alias("date_id"), F.col("data.create_time").alias("create_time"), "dt",
    ), first_day)


def interaction_comment(comment_inc: DataFrame, dictionary: DataFrame, do_date: str | None = None,
                        first_day: bool = False) -> DataFrame:
    """comments ⟕ appraise dictionary (parent 12)."""
    kind = "bootstrap-insert" if first_day else "insert"
    c = _day(comment_inc, do_date).where(F.col("type") == kind).select(
        F.col("data.id").alias("id"), F.col("data.user_id").alias("user_id"), F.col("data.sku_id").alias("sku_id"),
        F.col("data.order_id").alias("order_id"), F.col("data.create_time").alias("create_time"),
        F.col("data.appraise").alias("appraise_code"), "dt",
    )
    dic = _dic(dictionary, DIC_APPRAISE, "__a", "appraise_name")
    j = c.join(dic, c.appraise_code == F.col("__a"), "left")
    return _first_day_dt(j.select(
        "id", "user_id", "sku_id", "order_id", date_of_text("create_time").alias("date_id"), "create_time",
        "appraise_code", "appraise_name", "dt",
    ), first_day)


# ------------------------------------------------------------------ traffic
COMMON = [
    ("ar", "area_code"), ("ba", "brand"), ("ch", "channel"), ("is_new", "is_new"), ("md", "model"),
    ("mid", "mid_id"), ("os", "operate_system"), ("uid", "user_id"), ("vc", "version_code"),
]
PAGE = [
    ("item", "page_item"), ("item_type", "page_item_type"), ("last_page_id", "last_page_id"),
    ("page_id", "page_id"), ("source_type", "source_type"),
]
DEVICE_OUT = ["province_id", "brand", "channel", "is_new", "model", "mid_id", "operate_system", "user_id", "version_code"]
PAGE_OUT = ["page_item", "page_item_type", "last_page_id", "page_id", "source_type"]


def _common(prefix: str = "common") -> list[Column]:
    return [F.col(f"{prefix}.{src}").alias(dst) for src, dst in COMMON]


def _with_province(log_rows: DataFrame, province: DataFrame) -> DataFrame:
    """Left join on area code; an unknown area code leaves ``province_id`` NULL."""
    p = province.select(F.col("id").alias("province_id"), F.col("area_code").alias("__area"))
    return log_rows.join(p, log_rows.area_code == F.col("__area"), "left").drop("__area")


def _sessionized(log: DataFrame, most: int | None = None) -> DataFrame:
    """Page rows with ``session_id = mid + '-' + last session start`` (per device and day).

    ``last_page_id is null`` marks a start; rows before a device's first start
    get a NULL session (V18).
    """
    rows = log.where(F.col("page").isNotNull()).select(
        *_common(), F.col("page.during_time").cast("bigint").alias("during_time"),
        *[F.col(f"page.{src}").alias(dst) for src, dst in PAGE], "ts", "dt",
    )
    rows = running_start(rows, ["dt", "mid_id"], "ts", F.col("last_page_id").isNull(), "__start", how="last", most=most)
    return rows.withColumn("session_id", F.concat(F.col("mid_id"), F.lit("-"), F.col("__start").cast("string"))).drop(
        "__start"
    )


def traffic_page_view(log: DataFrame, province: DataFrame, do_date: str | None = None,
                      sessions: bool = True, most: int | None = None) -> DataFrame:
    """page views with session id and province. ``most``: rows of a device and hour beyond which the hour is split.

    Besides the table's columns the raw ``ts`` (ms) is kept: ``view_time`` has
    second resolution, and ordered reports need an unambiguous order (V19).
    ``sessions=False`` leaves ``session_id`` NULL and skips the ordered pass,
    for consumers that never read it (device × page summaries).
    """
    if sessions:
        rows = _sessionized(_day(log, do_date), most)
    else:
        rows = _day(log, do_date).where(F.col("page").isNotNull()).select(
            *_common(), F.col("page.during_time").cast("bigint").alias("during_time"),
            *[F.col(f"page.{src}").alias(dst) for src, dst in PAGE], "ts", "dt",
        ).withColumn("session_id", F.lit(None).cast("string"))
    j = _with_province(rows, province)
    return j.select(
        *DEVICE_OUT, *PAGE_OUT, date_from_ms("ts").alias("date_id"), time_from_ms("ts").alias("view_time"),
        "session_id", "during_time", "ts", "dt",
    )


def traffic_start(log: DataFrame, province: DataFrame, do_date: str | None = None) -> DataFrame:
    """app launches."""
    rows = _day(log, do_date).where(F.col("start").isNotNull()).select(
        *_common(), F.col("start.entry").alias("entry"), F.col("start.open_ad_id").cast("string").alias("open_ad_id"),
        F.col("start.loading_time").alias("loading_time_ms"), F.col("start.open_ad_ms").alias("open_ad_ms"),
        F.col("start.open_ad_skip_ms").alias("open_ad_skip_ms"), "ts", "dt",
    )
    j = _with_province(rows, province)
    return j.select(
        *DEVICE_OUT, "entry", "open_ad_id", date_from_ms("ts").alias("date_id"), time_from_ms("ts").alias("start_time"),
        "loading_time_ms", "open_ad_ms", "open_ad_skip_ms", "dt",
    )


def traffic_action(log: DataFrame, province: DataFrame, do_date: str | None = None) -> DataFrame:
    """one row per action (``explode``), timed by the action's own ``ts``."""
    rows = _day(log, do_date).where(F.col("actions").isNotNull()).select(
        *_common(), F.col("page.during_time").cast("bigint").alias("during_time"),
        *[F.col(f"page.{src}").alias(dst) for src, dst in PAGE], F.explode("actions").alias("action"), "dt",
    )
    j = _with_province(rows, province)
    return j.select(
        *DEVICE_OUT, "during_time", *PAGE_OUT, F.col("action.action_id").alias("action_id"),
        F.col("action.item").alias("action_item"), F.col("action.item_type").alias("action_item_type"),
        date_from_ms("action.ts").alias("date_id"), time_from_ms("action.ts").alias("action_time"), "dt",
    )


def traffic_display(log: DataFrame, province: DataFrame, do_date: str | None = None) -> DataFrame:
    """F16: one row per display, timed by the page's ``ts``."""
    rows = _day(log, do_date).where(F.col("displays").isNotNull()).select(
        *_common(), F.col("page.during_time").cast("bigint").alias("during_time"),
        *[F.col(f"page.{src}").alias(dst) for src, dst in PAGE], F.explode("displays").alias("display"), "ts", "dt",
    )
    j = _with_province(rows, province)
    return j.select(
        *DEVICE_OUT, "during_time", *PAGE_OUT, date_from_ms("ts").alias("date_id"),
        time_from_ms("ts").alias("display_time"), F.col("display.display_type").alias("display_type"),
        F.col("display.item").alias("display_item"), F.col("display.item_type").alias("display_item_type"),
        F.col("display.order").cast("bigint").alias("display_order"),
        F.col("display.pos_id").cast("bigint").alias("display_pos_id"), "dt",
    )


def traffic_error(log: DataFrame, province: DataFrame, do_date: str | None = None) -> DataFrame:
    """error logs, arrays kept intact."""
    rows = _day(log, do_date).where(F.col("err").isNotNull()).select(
        *_common(), *[F.col(f"page.{src}").alias(dst) for src, dst in PAGE],
        F.col("start.entry").alias("entry"), F.col("start.loading_time").cast("string").alias("loading_time"),
        F.col("start.open_ad_id").cast("string").alias("open_ad_id"),
        F.col("start.open_ad_ms").cast("string").alias("open_ad_ms"),
        F.col("start.open_ad_skip_ms").cast("string").alias("open_ad_skip_ms"), "actions", "displays",
        F.col("err.error_code").cast("string").alias("error_code"), F.col("err.msg").alias("error_msg"), "ts", "dt",
    )
    j = _with_province(rows, province)
    return j.select(
        *DEVICE_OUT, *PAGE_OUT, "entry", "loading_time", "open_ad_id", "open_ad_ms", "open_ad_skip_ms", "actions",
        "displays", date_from_ms("ts").alias("date_id"), time_from_ms("ts").alias("error_time"), "error_code",
        "error_msg", "dt",
    )


LOGIN_OUT = ["user_id", "date_id", "login_time", "channel", "province_id", "version_code", "mid_id", "brand",
             "model", "operate_system"]


def user_register(user_inc: DataFrame, log: DataFrame, province: DataFrame, do_date: str | None = None,
                  first_day: bool = False) -> DataFrame:
    """new users ⟕ their first ``register`` page log of that day ⟕ province, one row per user.

    On the first day the bootstrapped users are the registrations, each on the day it was made.
    """
    ui = _day(user_inc, do_date).where(F.col("type") == ("bootstrap-insert" if first_day else "insert")).select(
        F.col("data.id").alias("user_id"), F.col("data.create_time").alias("create_time"),
        (date_of_text("data.create_time") if first_day else F.col("dt")).alias("dt"),
    )
    pages = _day(log, do_date).where(
        (F.col("page.page_id") == "register") & F.col("common.uid").isNotNull()
    ).select(*_common(), "ts", F.col("dt").alias("__ldt"))
    # the first page by time, ties by device: a partial group limit keeps the sort small
    order = Window.partitionBy("user_id", "__ldt").orderBy("ts", "mid_id", "channel", "version_code")
    lg = pages.withColumn("__first", F.row_number().over(order)).where("__first = 1").drop("__first", "ts")
    lg = lg.withColumnRenamed("user_id", "__luid")
    j = ui.join(lg, (ui.user_id == F.col("__luid")) & (ui.dt == F.col("__ldt")), "left")
    j = _with_province(j, province)
    return j.select(
        "user_id", date_of_text("create_time").alias("date_id"), "create_time", "channel", "province_id",
        "version_code", "mid_id", "brand", "model", "operate_system", "dt",
    )


def user_login(log: DataFrame, province: DataFrame, do_date: str | None = None, most: int | None = None) -> DataFrame:
    """first logged-in page of each session (per day), with province.

    ``row_number() over (partition by session_id order by ts) = 1`` is a
    min-by aggregation here (map-side partial); rows of one ``ts`` are ordered
    by device. Rows without a session form one group per day, as in SQL.
    """
    rows = _sessionized(_day(log, do_date), most).where(F.col("user_id").isNotNull())
    vals = ["user_id", "channel", "area_code", "version_code", "mid_id", "brand", "model", "operate_system"]
    first = first_row_per_group(rows.withColumn("__mid", F.col("mid_id")), ["dt", "session_id"], ["ts", "__mid"], vals)
    j = _with_province(first, province)
    return j.select(
        "user_id", date_from_ms("ts").alias("date_id"), time_from_ms("ts").alias("login_time"), "channel",
        "province_id", "version_code", "mid_id", "brand", "model", "operate_system", "dt",
    )


def session_running_count(log: DataFrame, do_date: str | None = None, most: int | None = None) -> DataFrame:
    """the alternative session id — running count of session starts per device."""
    rows = _day(log, do_date).where(F.col("page").isNotNull()).select(
        F.col("common.mid").alias("mid"), F.col("page.last_page_id").alias("last_page_id"),
        F.col("page.page_id").alias("page_id"), "ts", "dt",
    )
    rows = running_start(rows, ["dt", "mid"], "ts", F.col("last_page_id").isNull(), "__n", how="count", most=most)
    return rows.select(
        "mid", "last_page_id", "page_id", "ts",
        F.concat(F.col("mid"), F.lit("-"), F.col("__n").cast("string")).alias("session_id"), "dt",
    )
