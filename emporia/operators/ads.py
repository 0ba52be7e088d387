"""ADS — reports for one business day.

The reference gets several spans (1/7/30 days) by exploding a literal array,
which multiplies the rows before aggregating. Where the measures allow it,
these operators instead scan once with one conditional sum per span and turn
the (small) aggregated result into one row per span afterwards. Results are
the same; rows are not tripled before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emporia.functions.ratios import cents, exact_rate
from emporia.functions.sessions import position_and_next
from emporia.functions.spans import MONEY, explode_spans, in_window, pick_span, shift_date

SPANS = (1, 7, 30)
ND_SPANS = (7, 30)


def _since(do_date: str, span: int) -> Column:
    return F.lit(shift_date(do_date, -(span - 1)))


def _unpivot(df: DataFrame, keys: Sequence[str], per_span: dict[int, dict[str, Column]]) -> DataFrame:
    """Wide ``x_7``/``x_30`` columns -> one row per span with ``recent_days``."""
    structs = []
    for span, cols in per_span.items():
        structs.append(F.struct(F.lit(span).cast("bigint").alias("recent_days"), *[c.alias(n) for n, c in cols.items()]))
    names = list(next(iter(per_span.values())).keys())
    out = df.select(*keys, F.explode(F.array(*structs)).alias("__s"))
    return out.select(*keys, "__s.recent_days", *[F.col(f"__s.{n}").alias(n) for n in names])


def _dt(do_date: str) -> Column:
    return F.lit(do_date).alias("dt")


# ----------------------------------------------------------------------- R1
def traffic_stats_by_channel(session_1d: DataFrame, do_date: str) -> DataFrame:
    """Per span × channel — devices, avg duration (s), avg pages, sessions, bounce rate."""
    rows = session_1d.where(in_window("dt", do_date, 30))
    per_dev = []
    for s in SPANS:
        inside = F.col("dt") >= _since(do_date, s)
        per_dev += [
            F.sum(F.when(inside, 1).otherwise(0)).alias(f"sv_{s}"),
            F.sum(F.when(inside, F.col("during_time_1d")).otherwise(0)).alias(f"dur_{s}"),
            F.sum(F.when(inside, F.col("page_count_1d")).otherwise(0)).alias(f"pg_{s}"),
            F.sum(F.when(inside & (F.col("page_count_1d") == 1), 1).otherwise(0)).alias(f"bn_{s}"),
        ]
    dev = rows.groupBy("channel", "mid_id").agg(*per_dev)
    per_ch = []
    for s in SPANS:
        per_ch += [
            F.sum(F.when(F.col(f"sv_{s}") > 0, 1).otherwise(0)).alias(f"uv_{s}"),
            F.sum(f"sv_{s}").alias(f"sv_{s}"),
            F.sum(f"dur_{s}").alias(f"dur_{s}"),
            F.sum(f"pg_{s}").alias(f"pg_{s}"),
            F.sum(f"bn_{s}").alias(f"bn_{s}"),
        ]
    ch = dev.groupBy("channel").agg(*per_ch)
    div = lambda a, b: F.call_function("div", a, F.nullif(b, F.lit(0)))
    per_span = {
        s: {
            "uv_count": F.col(f"uv_{s}").cast("bigint"),
            "avg_duration_sec": div(F.col(f"dur_{s}"), F.col(f"sv_{s}") * F.lit(1000)).cast("bigint"),
            "avg_page_count": div(F.col(f"pg_{s}"), F.col(f"sv_{s}")).cast("bigint"),
            "sv_count": F.col(f"sv_{s}").cast("bigint"),
            "bounce_rate": exact_rate(F.col(f"bn_{s}"), F.col(f"sv_{s}")),
        }
        for s in SPANS
    }
    out = _unpivot(ch, ["channel"], per_span).where(F.col("sv_count") > 0)
    return out.select(
        _dt(do_date), "recent_days", "channel", "uv_count", "avg_duration_sec", "avg_page_count", "sv_count",
        "bounce_rate",
    )


# ----------------------------------------------------------------------- R2
def page_path(page_view: DataFrame, do_date: str, most: int | None = None) -> DataFrame:
    """R2: numbered page→next-page transitions per span (``step-n:page``).

    A session id belongs to one day, so a session is either fully inside a
    span or not: position and next page are computed once per session and
    counted per span with conditional sums. Rows without a session (before a
    device's first start) form one group per span, as in SQL; those are
    positioned per span. Both use the bucketed window, so neither a long
    session nor the NULL group runs in one task. Order: ``ts`` then device (V19). ``most``: rows of a group
    and hour beyond which the hour is split (all devices' session-less rows of an hour are one group).
    """
    rows = page_view.where(in_window("dt", do_date, 30)).select("session_id", "mid_id", "page_id", "ts", "dt")

    def transitions(df: DataFrame, keys: list[str]) -> DataFrame:
        pos = position_and_next(df, keys, "ts", ["mid_id"], ["page_id"], rn_col="rn", most=most)
        return pos.select(
            *[c for c in df.columns if c not in ("page_id", "ts", "mid_id", "session_id")],
            F.concat(F.lit("step-"), F.col("rn").cast("string"), F.lit(":"), F.col("page_id")).alias("source"),
            F.coalesce(
                F.concat(F.lit("step-"), (F.col("rn") + 1).cast("string"), F.lit(":"), F.col("next_page_id")),
                F.lit("null"),
            ).alias("target"),
        )

    with_session = transitions(rows.where(F.col("session_id").isNotNull()), ["session_id"])
    counts = with_session.groupBy("source", "target").agg(
        *[F.sum(F.when(F.col("dt") >= _since(do_date, s), 1).otherwise(0)).alias(f"c_{s}") for s in SPANS]
    )
    part1 = _unpivot(counts, ["source", "target"], {s: {"path_count": F.col(f"c_{s}")} for s in SPANS})
    no_session = explode_spans(rows.where(F.col("session_id").isNull()), SPANS)
    no_session = no_session.where(F.col("dt") >= F.date_format(F.date_sub(F.lit(do_date).cast("date"), (F.col("recent_days") - 1).cast("int")), "yyyy-MM-dd"))
    part2 = transitions(no_session, ["recent_days"]).groupBy("recent_days", "source", "target").agg(
        F.count(F.lit(1)).alias("path_count")
    )
    allp = part1.select("recent_days", "source", "target", "path_count").unionByName(part2)
    out = allp.groupBy("recent_days", "source", "target").agg(F.sum("path_count").cast("bigint").alias("path_count"))
    return out.where(F.col("path_count") > 0).select(_dt(do_date), "recent_days", "source", "target", "path_count")


# ------------------------------------------------------------------- R3–R6
def user_change(login_td_today: DataFrame, login_td_yesterday: DataFrame, do_date: str) -> DataFrame:
    """Churned users (last login exactly 7 days ago) and returned users (gap ≥ 8 days, V1)."""
    # both counts in one aggregation over tagged rows (no join between two one-row results)
    churn = login_td_today.where(F.col("login_date_last") == F.lit(shift_date(do_date, -7))).select(
        F.lit(1).alias("c"), F.lit(0).alias("b"))
    t = login_td_today.select("user_id", "login_date_last")
    y = login_td_yesterday.select("user_id", F.col("login_date_last").alias("login_date_pre"))
    back = t.join(y, "user_id").where(F.datediff(F.col("login_date_last"), F.col("login_date_pre")) >= 8).select(
        F.lit(0).alias("c"), F.lit(1).alias("b"))
    out = churn.unionByName(back).agg(F.sum("c").alias("c"), F.sum("b").alias("b"))
    return out.select(
        _dt(do_date), F.coalesce("c", F.lit(0)).cast("bigint").alias("user_churn_count"),
        F.coalesce("b", F.lit(0)).cast("bigint").alias("user_back_count"),
    )


def user_retention(register: DataFrame, login_td_today: DataFrame, do_date: str) -> DataFrame:
    """Cohorts registered in the 7 days before ``do_date`` and how many logged in today."""
    reg = register.where(
        (F.col("dt") >= F.lit(shift_date(do_date, -7))) & (F.col("dt") < F.lit(do_date))
    ).select("user_id", "date_id")
    j = reg.join(login_td_today.select("user_id", "login_date_last"), "user_id")
    kept = F.sum(F.when(F.col("login_date_last") == F.lit(do_date), 1).otherwise(0))
    g = j.groupBy("date_id").agg(kept.alias("rc"), F.count(F.lit(1)).alias("nc"))
    return g.select(
        _dt(do_date), F.col("date_id").alias("create_date"),
        F.datediff(F.lit(do_date).cast("date"), F.col("date_id").cast("date")).cast("int").alias("retention_day"),
        F.col("rc").cast("bigint").alias("retention_count"), F.col("nc").cast("bigint").alias("new_user_count"),
        exact_rate(F.col("rc"), F.col("nc")).alias("retention_rate"),
    )


def user_stats(register: DataFrame, login_td_today: DataFrame, do_date: str) -> DataFrame:
    """Per span — new users and active users (one scan each, V12 upper bound)."""
    reg = register.where(F.col("date_id") <= F.lit(do_date))
    # one aggregation over both inputs' tagged rows (no join between two one-row results)
    zero = [F.lit(0).alias(f"act_{s}") for s in SPANS]
    reg_rows = reg.select(F.lit(1).alias("n"), F.lit(0).alias("m"), *[
        F.when(F.col("date_id") >= _since(do_date, s), 1).otherwise(0).alias(f"new_{s}") for s in SPANS], *zero)
    act_rows = login_td_today.select(F.lit(0).alias("n"), F.lit(1).alias("m"), *[
        F.lit(0).alias(f"new_{s}") for s in SPANS], *[
        F.when(F.col("login_date_last") >= _since(do_date, s), 1).otherwise(0).alias(f"act_{s}") for s in SPANS])
    cols = ["n", "m", *[f"new_{s}" for s in SPANS], *[f"act_{s}" for s in SPANS]]
    both = reg_rows.unionByName(act_rows).agg(*[F.sum(c).alias(c) for c in cols]).where(
        (F.col("n") > 0) & (F.col("m") > 0))
    per_span = {
        s: {"new_user_count": F.col(f"new_{s}").cast("bigint"), "active_user_count": F.col(f"act_{s}").cast("bigint")}
        for s in SPANS
    }
    return _unpivot(both, [], per_span).select(_dt(do_date), "recent_days", "new_user_count", "active_user_count")


def user_stats_filter_form(register: DataFrame, login_td_today: DataFrame, do_date: str) -> DataFrame:
    """The same metric written as explode + filter + count (a metamorphic twin of R5)."""
    def since(df: DataFrame, col: str) -> DataFrame:
        x = explode_spans(df, SPANS)
        lo = F.date_format(F.date_sub(F.lit(do_date).cast("date"), (F.col("recent_days") - 1).cast("int")), "yyyy-MM-dd")
        return x.where((F.col(col) >= lo) & (F.col(col) <= F.lit(do_date)))

    new = since(register, "date_id").groupBy("recent_days").agg(F.count(F.lit(1)).alias("new_user_count"))
    act = since(login_td_today, "login_date_last").groupBy("recent_days").agg(
        F.count(F.lit(1)).alias("active_user_count")
    )
    return new.join(act, "recent_days").select(_dt(do_date), "recent_days", "new_user_count", "active_user_count")


# ----------------------------------------------------------------------- R7
def user_action(
    visitor_1d: DataFrame, visitor_nd: DataFrame, cart_1d: DataFrame, cart_nd: DataFrame,
    order_1d: DataFrame, order_nd: DataFrame, pay_1d: DataFrame, pay_nd: DataFrame, do_date: str,
) -> DataFrame:
    """Funnel per span — home, detail, cart, order, payment (1-day counts rows, V20)."""
    def today(df: DataFrame) -> DataFrame:
        return df.where(F.col("dt") == F.lit(do_date))

    pages = ["home", "good_detail"]
    p1 = today(visitor_1d).where(F.col("page_id").isin(pages)).agg(
        F.sum(F.when(F.col("page_id") == "home", 1).otherwise(0)).cast("bigint").alias("home_count"),
        F.sum(F.when(F.col("page_id") == "good_detail", 1).otherwise(0)).cast("bigint").alias("good_detail_count"),
    ).select(F.lit(1).cast("bigint").alias("recent_days"), "home_count", "good_detail_count")

    def nd_count(df: DataFrame, measures: dict[str, tuple[str, Column | None]]) -> DataFrame:
        x = explode_spans(today(df), ND_SPANS)
        aggs = []
        for out, (stem, cond) in measures.items():
            v = pick_span("recent_days", {7: f"{stem}_7d", 30: f"{stem}_30d"})
            c = v > 0 if cond is None else (cond & (v > 0))
            aggs.append(F.sum(F.when(c, 1).otherwise(0)).cast("bigint").alias(out))
        return x.groupBy("recent_days").agg(*aggs)

    pn = nd_count(
        visitor_nd.where(F.col("page_id").isin(pages)),
        {"home_count": ("view_count", F.col("page_id") == "home"),
         "good_detail_count": ("view_count", F.col("page_id") == "good_detail")},
    )
    page = p1.unionByName(pn)

    def part(d1: DataFrame, dn: DataFrame, stem: str, out: str) -> DataFrame:
        one = today(d1).agg(F.count(F.lit(1)).alias(out)).select(F.lit(1).cast("bigint").alias("recent_days"), out)
        return one.unionByName(nd_count(dn, {out: (stem, None)}))

    cart = part(cart_1d, cart_nd, "cart_add_count", "cart_count")
    od = part(order_1d, order_nd, "order_count", "order_count")
    pay = part(pay_1d, pay_nd, "payment_count", "payment_count")
    j = page.join(cart, "recent_days").join(od, "recent_days").join(pay, "recent_days")
    return j.select(
        _dt(do_date), "recent_days", "home_count", "good_detail_count", "cart_count", "order_count", "payment_count"
    )


# ----------------------------------------------------------------------- R8
def new_buyer_stats(order_td: DataFrame, payment_td: DataFrame, do_date: str) -> DataFrame:
    """First-time orderers and payers per span."""
    # one aggregation over both inputs' tagged rows (no join between two one-row results)
    o_rows = order_td.select(F.lit(1).alias("n"), F.lit(0).alias("m"), *[
        F.when(F.col("order_date_first") >= _since(do_date, s), 1).otherwise(0).alias(f"o_{s}") for s in SPANS],
        *[F.lit(0).alias(f"p_{s}") for s in SPANS])
    p_rows = payment_td.select(F.lit(0).alias("n"), F.lit(1).alias("m"), *[F.lit(0).alias(f"o_{s}") for s in SPANS], *[
        F.when(F.col("payment_date_first") >= _since(do_date, s), 1).otherwise(0).alias(f"p_{s}") for s in SPANS])
    cols = ["n", "m", *[f"o_{s}" for s in SPANS], *[f"p_{s}" for s in SPANS]]
    both = o_rows.unionByName(p_rows).agg(*[F.sum(c).alias(c) for c in cols]).where(
        (F.col("n") > 0) & (F.col("m") > 0))
    per_span = {
        s: {"new_order_user_count": F.col(f"o_{s}").cast("bigint"), "new_payment_user_count": F.col(f"p_{s}").cast("bigint")}
        for s in SPANS
    }
    return _unpivot(both, [], per_span).select(
        _dt(do_date), "recent_days", "new_order_user_count", "new_payment_user_count"
    )


# ----------------------------------------------------------------------- R9
def repeat_purchase_by_tm(user_sku_nd: DataFrame, do_date: str) -> DataFrame:
    """Per span × brand — users with ≥2 orders ÷ users with ≥1."""
    per_user = user_sku_nd.groupBy("tm_id", "tm_name", "user_id").agg(
        F.sum("order_count_7d").alias("c7"), F.sum("order_count_30d").alias("c30")
    )
    per_tm = per_user.groupBy("tm_id", "tm_name").agg(
        *[F.sum(F.when(F.col(f"c{s}") >= 2, 1).otherwise(0)).alias(f"r2_{s}") for s in ND_SPANS],
        *[F.sum(F.when(F.col(f"c{s}") >= 1, 1).otherwise(0)).alias(f"r1_{s}") for s in ND_SPANS],
    )
    per_span = {s: {"order_repeat_rate": exact_rate(F.col(f"r2_{s}"), F.col(f"r1_{s}"))} for s in ND_SPANS}
    return _unpivot(per_tm, ["tm_id", "tm_name"], per_span).select(
        _dt(do_date), "recent_days", "tm_id", "tm_name", "order_repeat_rate"
    )


# --------------------------------------------------------------- R10 / R11
def _trade_stats_by(
    keys: list[str], sku_order_1d: DataFrame, sku_order_nd: DataFrame, sku_refund_1d: DataFrame,
    sku_refund_nd: DataFrame, do_date: str,
) -> DataFrame:
    def side(d1: DataFrame, dn: DataFrame, stem: str, cnt: str, users: str) -> DataFrame:
        one = d1.where(F.col("dt") == F.lit(do_date)).groupBy(*keys, "user_id").agg(F.sum(f"{stem}_1d").alias("c"))
        one = one.groupBy(*keys).agg(
            F.sum("c").cast("bigint").alias(cnt), F.count(F.lit(1)).cast("bigint").alias(users)
        ).withColumn("recent_days", F.lit(1).cast("bigint"))
        per_user = dn.groupBy(*keys, "user_id").agg(
            F.sum(f"{stem}_7d").alias("c7"), F.sum(f"{stem}_30d").alias("c30")
        )
        per_key = per_user.groupBy(*keys).agg(
            *[F.sum(f"c{s}").alias(f"s{s}") for s in ND_SPANS],
            *[F.sum(F.when(F.col(f"c{s}") > 0, 1).otherwise(0)).alias(f"u{s}") for s in ND_SPANS],
        )
        nd = _unpivot(
            per_key, keys,
            {s: {cnt: F.col(f"s{s}").cast("bigint"), users: F.col(f"u{s}").cast("bigint")} for s in ND_SPANS},
        )
        return one.unionByName(nd)

    od = side(sku_order_1d, sku_order_nd, "order_count", "order_count", "order_user_count")
    rf = side(sku_refund_1d, sku_refund_nd, "order_refund_count", "order_refund_count", "order_refund_user_count")
    jk = ["recent_days", *keys]
    a = od.select(*[F.col(k).alias(f"a_{k}") for k in jk], "order_count", "order_user_count")
    b = rf.select(*[F.col(k).alias(f"b_{k}") for k in jk], "order_refund_count", "order_refund_user_count")
    cond = None
    for k in jk:  # plain equality: NULL keys never match, as in SQL
        c = F.col(f"a_{k}") == F.col(f"b_{k}")
        cond = c if cond is None else cond & c
    j = a.join(b, cond, "full")
    return j.select(
        _dt(do_date),
        *[F.coalesce(F.col(f"a_{k}"), F.col(f"b_{k}")).alias(k) for k in jk],
        F.coalesce("order_count", F.lit(0)).cast("bigint").alias("order_count"),
        F.coalesce("order_user_count", F.lit(0)).cast("bigint").alias("order_user_count"),
        F.coalesce("order_refund_count", F.lit(0)).cast("bigint").alias("order_refund_count"),
        F.coalesce("order_refund_user_count", F.lit(0)).cast("bigint").alias("order_refund_user_count"),
    )


def trade_stats_by_tm(sku_order_1d, sku_order_nd, sku_refund_1d, sku_refund_nd, do_date: str) -> DataFrame:
    """Per span × brand — orders, ordering users, refunds, refunding users (distinct, V10)."""
    return _trade_stats_by(["tm_id", "tm_name"], sku_order_1d, sku_order_nd, sku_refund_1d, sku_refund_nd, do_date)


CATE_KEYS = ["category1_id", "category1_name", "category2_id", "category2_name", "category3_id", "category3_name"]


def trade_stats_by_cate(sku_order_1d, sku_order_nd, sku_refund_1d, sku_refund_nd, do_date: str) -> DataFrame:
    """The same by three-level category (7 join keys)."""
    return _trade_stats_by(CATE_KEYS, sku_order_1d, sku_order_nd, sku_refund_1d, sku_refund_nd, do_date)


# ----------------------------------------------------------------------- R12
def sku_cart_num_top3_by_cate(cart_full: DataFrame, dim_sku: DataFrame, do_date: str, top: int = 3) -> DataFrame:
    """Top SKUs per category by quantity in carts; ties share a rank (dense).

    The rank filter lets Spark insert a partial ``WindowGroupLimit`` before the
    shuffle, so a large category sends only its leading rows.
    """
    cart = cart_full.where(F.col("dt") == F.lit(do_date)).groupBy("sku_id").agg(
        F.sum("sku_num").cast("bigint").alias("cart_num")
    )
    cate = dim_sku.select(F.col("id").alias("__sku"), "sku_name", *CATE_KEYS)
    j = cart.join(cate, cart.sku_id == F.col("__sku"), "left")
    w = Window.partitionBy("category1_id", "category2_id", "category3_id").orderBy(F.col("cart_num").desc())
    ranked = j.withColumn("rk", F.dense_rank().over(w)).where(F.col("rk") <= top)
    return ranked.select(_dt(do_date), *CATE_KEYS, "sku_id", "sku_name", "cart_num", F.col("rk").cast("bigint").alias("rk"))


# ----------------------------------------------------------------------- R13
def trade_stats(order_1d, order_nd, refund_1d, refund_nd, do_date: str) -> DataFrame:
    """Per span — amount, orders, ordering users, refunds, refunding users."""
    o1 = order_1d.where(F.col("dt") == F.lit(do_date)).agg(
        F.sum("order_total_amount_1d").cast(MONEY).alias("order_total_amount"),
        F.sum("order_count_1d").cast("bigint").alias("order_count"),
        F.count(F.lit(1)).cast("bigint").alias("order_user_count"),
    ).withColumn("recent_days", F.lit(1).cast("bigint"))
    on = order_nd.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(F.coalesce(f"order_total_amount_{s}d", F.lit(0))).alias(f"t{s}") for s in ND_SPANS],
        *[F.sum(F.coalesce(f"order_count_{s}d", F.lit(0))).alias(f"c{s}") for s in ND_SPANS],
        *[F.sum(F.when(F.col(f"order_total_amount_{s}d") > 0, 1).otherwise(0)).alias(f"u{s}") for s in ND_SPANS],
    ).where(F.col("n") > 0)
    on = _unpivot(on, [], {
        s: {"order_total_amount": F.col(f"t{s}").cast(MONEY), "order_count": F.col(f"c{s}").cast("bigint"),
            "order_user_count": F.col(f"u{s}").cast("bigint")} for s in ND_SPANS
    })
    odr = o1.unionByName(on)
    r1 = refund_1d.where(F.col("dt") == F.lit(do_date)).agg(
        F.sum("order_refund_count_1d").cast("bigint").alias("order_refund_count"),
        F.count(F.lit(1)).cast("bigint").alias("order_refund_user_count"),
    ).withColumn("recent_days", F.lit(1).cast("bigint"))
    rn = refund_nd.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(f"order_refund_count_{s}d").alias(f"c{s}") for s in ND_SPANS],
        *[F.sum(F.when(F.col(f"order_refund_count_{s}d") > 0, 1).otherwise(0)).alias(f"u{s}") for s in ND_SPANS],
    ).where(F.col("n") > 0)
    rn = _unpivot(rn, [], {
        s: {"order_refund_count": F.col(f"c{s}").cast("bigint"), "order_refund_user_count": F.col(f"u{s}").cast("bigint")}
        for s in ND_SPANS
    })
    ref = r1.unionByName(rn)
    a = odr.withColumnRenamed("recent_days", "a_rd")
    b = ref.withColumnRenamed("recent_days", "b_rd")
    j = a.join(b, a.a_rd == b.b_rd, "full")
    return j.select(
        _dt(do_date), F.coalesce("a_rd", "b_rd").alias("recent_days"),
        F.coalesce("order_total_amount", F.lit(0)).cast(MONEY).alias("order_total_amount"),
        F.coalesce("order_count", F.lit(0)).cast("bigint").alias("order_count"),
        F.coalesce("order_user_count", F.lit(0)).cast("bigint").alias("order_user_count"),
        F.coalesce("order_refund_count", F.lit(0)).cast("bigint").alias("order_refund_count"),
        F.coalesce("order_refund_user_count", F.lit(0)).cast("bigint").alias("order_refund_user_count"),
    )


# ----------------------------------------------------------------------- R14
def order_by_province(province_1d: DataFrame, province_nd: DataFrame, do_date: str) -> DataFrame:
    """Per span × province — orders and amount."""
    attrs = ["province_id", "province_name", "area_code", "iso_code", F.col("iso_3166_2").alias("iso_code_3166_2")]
    one = province_1d.where(F.col("dt") == F.lit(do_date)).select(
        _dt(do_date), F.lit(1).cast("bigint").alias("recent_days"), *attrs,
        F.col("order_count_1d").alias("order_count"), F.col("order_total_amount_1d").alias("order_total_amount"),
    )
    nd = explode_spans(province_nd, ND_SPANS).select(
        _dt(do_date), "recent_days", *attrs,
        pick_span("recent_days", {7: "order_count_7d", 30: "order_count_30d"}).cast("bigint").alias("order_count"),
        pick_span("recent_days", {7: "order_total_amount_7d", 30: "order_total_amount_30d"}).cast(MONEY).alias("order_total_amount"),
    )
    return one.unionByName(nd)


# ----------------------------------------------------------------- R15 / R16
def coupon_stats(coupon_nd: DataFrame, do_date: str) -> DataFrame:
    """Subsidy rate = reduction ÷ original (NULL when unused)."""
    return coupon_nd.select(
        _dt(do_date), "coupon_id", "coupon_name", "start_date", F.col("coupon_rule").alias("rule_name"),
        exact_rate(cents(F.col("coupon_reduce_amount_30d")), cents(F.col("original_amount_30d"))).alias("reduce_rate"),
    )


def activity_stats(activity_nd: DataFrame, do_date: str) -> DataFrame:
    """Activity subsidy rate."""
    return activity_nd.select(
        _dt(do_date), "activity_id", "activity_name", "start_date",
        exact_rate(cents(F.col("activity_reduce_amount_30d")), cents(F.col("original_amount_30d"))).alias("reduce_rate"),
    )
