"""Hand-made fixtures with answers worked out by hand (first day 2020-06-14, daily 2020-06-15)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from emporia import schemas
from emporia.operators import ads, dim, dwd, dws

D0, D1 = "2020-06-14", "2020-06-15"
GMT8 = dt.timezone(dt.timedelta(hours=8))


def secs(text: str) -> int:
    return int(dt.datetime.fromisoformat(text).replace(tzinfo=GMT8).timestamp())


def ms(text: str) -> int:
    return secs(text) * 1000


def changes(spark, table, rows):
    """rows: (type, ts, data dict, old dict|None, dt)."""
    schema = schemas.struct_of(schemas.change_schema(table) + ", dt STRING")
    data_fields = [f.name for f in schema["data"].dataType.fields]
    out = [(t, ts, tuple(d.get(k) for k in data_fields), old, day) for t, ts, d, old, day in rows]
    return spark.createDataFrame(out, schema)


# ----------------------------------------------------------------------------- DIM
def test_user_zipper(spark):
    user = lambda i, name, op="2020-06-10": {
        "id": i, "login_name": f"l{i}", "name": name, "phone_num": "p", "email": "e", "create_time": "2020-06-01 00:00:00",
        "operate_time": op,
    }
    boot = changes(spark, "user_info", [
        ("bootstrap-insert", secs("2020-06-14 01:00:00"), user("1", "a"), None, D0),
        ("bootstrap-insert", secs("2020-06-14 01:00:00"), user("2", "b"), None, D0),
        ("bootstrap-insert", secs("2020-06-14 01:00:00"), user("3", "c"), None, D0),
    ])
    open0 = dim.user_zip_init(boot, D0)
    assert open0.count() == 3
    assert open0.where("id = '1'").first()["name"] == open0.sparkSession.sql("select md5('a') m").first()["m"]
    t = secs("2020-06-15 10:00:00")
    day1 = changes(spark, "user_info", [
        ("update", t, user("1", "a1", "2020-06-15 10:00:00"), {"name": "a"}, D1),
        ("update", t, user("1", "a2", "2020-06-15 10:00:01"), {"name": "a1"}, D1),  # same ts, later operate_time
        ("delete", t, user("3", "zzz"), None, D1),  # ignored change type
        ("insert", t, user("4", "d"), None, D1),
    ])
    out = dim.user_zip(open0.drop("dt"), day1, D1)
    rows = {(r["id"], r["dt"]): r for r in out.collect()}
    md5 = lambda s: spark.sql(f"select md5('{s}') m").first()["m"]
    assert set(rows) == {("1", "9999-12-31"), ("2", "9999-12-31"), ("3", "9999-12-31"), ("4", "9999-12-31"), ("1", D0)}
    assert rows[("1", "9999-12-31")]["name"] == md5("a2") and rows[("1", "9999-12-31")]["start_date"] == D1
    assert rows[("1", D0)]["name"] == md5("a") and rows[("1", D0)]["end_date"] == D0
    assert rows[("2", "9999-12-31")]["start_date"] == D0
    assert rows[("3", "9999-12-31")]["name"] == md5("c")
    assert rows[("4", "9999-12-31")]["start_date"] == D1
    # exactly one open row per user, no overlapping validity
    assert out.where("dt = '9999-12-31'").groupBy("id").count().where("count > 1").count() == 0


def test_sku_dimension_attributes(spark):
    sku = spark.createDataFrame([("s1", "p1", Decimal("9.90"), "n1", "d", Decimal("1.00"), "t1", "c3", None, "1", None),
                                 ("s2", "p1", Decimal("5.00"), "n2", "d", Decimal("1.00"), "t9", "c3", None, "0", None)],
                                schemas.SNAPSHOTS["sku_info"])
    spu = spark.createDataFrame([("p1", "spu", None, "c3", "t1")], schemas.SNAPSHOTS["spu_info"])
    c3 = spark.createDataFrame([("c3", "cat3", "c2")], schemas.SNAPSHOTS["base_category3"])
    c2 = spark.createDataFrame([("c2", "cat2", "c1")], schemas.SNAPSHOTS["base_category2"])
    c1 = spark.createDataFrame([("c1", "cat1")], schemas.SNAPSHOTS["base_category1"])
    tm = spark.createDataFrame([("t1", "brand", None)], schemas.SNAPSHOTS["base_trademark"])
    attr = spark.createDataFrame([("1", "a", "v", "s1", "color", "red"), ("2", "a", "v", "s1", "color", "red")],
                                 schemas.SNAPSHOTS["sku_attr_value"])
    sale = spark.createDataFrame([], schemas.SNAPSHOTS["sku_sale_attr_value"])
    out = {r["id"]: r for r in dim.sku_full(sku, spu, c3, c2, c1, tm, attr, sale).collect()}
    assert out["s1"]["category1_name"] == "cat1" and out["s1"]["tm_name"] == "brand" and out["s1"]["is_sale"] is True
    assert len(out["s1"]["sku_attr_values"]) == 1  # repeated attribute folded by collect_set
    assert out["s2"]["sku_attr_values"] is None and out["s2"]["tm_name"] is None


def test_coupon_and_activity_rule_text(spark):
    cols = schemas.SNAPSHOTS["coupon_info"]
    base = dict(coupon_name="c", condition_amount=Decimal("100.00"), condition_num=2, benefit_amount=Decimal("10.00"),
                benefit_discount=Decimal("0.20"))
    names = [f.split(" ")[0] for f in cols.split(", ")]
    rows = []
    for i, t in enumerate(["3201", "3202", "3203"]):
        d = dict(base, id=str(i), coupon_type=t, range_type="3301")
        rows.append(tuple(d.get(n) for n in names))
    cou = spark.createDataFrame(rows, cols)
    dic = spark.createDataFrame([("3201", "x", "32", None, None), ("3301", "cat", "33", None, None)],
                                schemas.SNAPSHOTS["base_dic"])
    out = {r["id"]: r for r in dim.coupon_full(cou, dic).collect()}
    assert out["0"]["benefit_rule"] == "满100.00元减10.00元" and out["0"]["coupon_type_name"] == "x"
    assert out["1"]["benefit_rule"] == "满2件打8.00折" and out["1"]["range_type_name"] == "cat"
    assert out["2"]["benefit_rule"] == "减10.00元"


# ----------------------------------------------------------------------------- DWD
def test_cart_add_changes(spark):
    t = secs("2020-06-15 09:00:00")
    cart = changes(spark, "cart_info", [
        ("insert", t, {"id": "1", "user_id": "u", "sku_id": "s", "sku_num": 2, "source_type": "2401"}, None, D1),
        ("update", t, {"id": "2", "user_id": "u", "sku_id": "s", "sku_num": 3}, {"sku_num": "1"}, D1),
        ("update", t, {"id": "3", "user_id": "u", "sku_id": "s", "sku_num": 1}, {"sku_num": "3"}, D1),
        ("update", t, {"id": "4", "user_id": "u", "sku_id": "s", "sku_num": 5}, {"is_checked": "0"}, D1),
    ])
    dic = spark.createDataFrame([("2401", "search", "24", None, None)], schemas.SNAPSHOTS["base_dic"])
    out = {r["id"]: r for r in dwd.trade_cart_add(cart, dic, D1).collect()}
    assert set(out) == {"1", "2"}
    assert out["1"]["sku_num"] == 2 and out["1"]["source_type_name"] == "search"
    assert out["2"]["sku_num"] == 2
    assert out["1"]["date_id"] == D1 and out["1"]["create_time"] == "2020-06-15 09:00:00"


def _log(spark, rows):
    """rows: (mid, uid, ar, last_page, page, ts_text, actions, displays, start, err)."""
    schema = schemas.struct_of(schemas.LOG + ", dt STRING")
    out = []
    for mid, uid, ar, last, page, ts, actions, displays, start, err in rows:
        common = (ar, "b", "ch", "0", "m", mid, "os", uid, "v1")
        pg = ("1000", None, None, last, page, None) if page else None
        out.append((common, pg, actions, displays, start, err, ms(ts), D1))
    return spark.createDataFrame(out, schema)


def test_sessions_logins_and_paths(spark):
    rows = [
        ("d1", "u1", "110", "home", "good_detail", "2020-06-15 08:00:00", None, None, None, None),  # before any start
        ("d1", "u1", "110", None, "home", "2020-06-15 09:00:00", None, None, None, None),  # start A
        ("d1", None, "110", "home", "cart", "2020-06-15 09:01:00", None, None, None, None),
        ("d1", "u1", "110", None, "home", "2020-06-15 10:00:00", None, None, None, None),  # start B
        ("d1", "u1", "110", "home", "trade", "2020-06-15 10:00:00", None, None, None, None),  # equal ts sees B
        ("d2", "u2", "999", None, "home", "2020-06-15 11:00:00", None, None, None, None),  # unknown area code
    ]
    log = _log(spark, rows)
    prov = spark.createDataFrame([("p1", "bj", "r1", "110", "CN-11", "CN-BJ")], schemas.SNAPSHOTS["base_province"])
    pv = dwd.traffic_page_view(log, prov, D1).collect()
    sid = {(r["mid_id"], r["view_time"], r["page_id"]): r["session_id"] for r in pv}
    a, b = f"d1-{ms('2020-06-15 09:00:00')}", f"d1-{ms('2020-06-15 10:00:00')}"
    assert sid[("d1", "2020-06-15 08:00:00", "good_detail")] is None
    assert sid[("d1", "2020-06-15 09:01:00", "cart")] == a
    assert sid[("d1", "2020-06-15 10:00:00", "trade")] == b
    assert {r["province_id"] for r in pv if r["mid_id"] == "d2"} == {None}
    assert {r["province_id"] for r in pv if r["mid_id"] == "d1"} == {"p1"}
    # running count of starts
    alt = {(r["mid"], r["page_id"], r["ts"]): r["session_id"] for r in dwd.session_running_count(log, D1).collect()}
    assert alt[("d1", "good_detail", ms("2020-06-15 08:00:00"))] == "d1-0"
    assert alt[("d1", "trade", ms("2020-06-15 10:00:00"))] == "d1-2"
    # first logged-in page per session (NULL session is one group)
    logins = dwd.user_login(log, prov, D1).collect()
    assert sorted((r["user_id"], r["login_time"]) for r in logins) == [
        ("u1", "2020-06-15 08:00:00"), ("u1", "2020-06-15 09:00:00"), ("u1", "2020-06-15 10:00:00"),
        ("u2", "2020-06-15 11:00:00"),
    ]
    # R2 page path over the day
    pvdf = dwd.traffic_page_view(log, prov, D1)
    paths = {(r["recent_days"], r["source"], r["target"]): r["path_count"] for r in ads.page_path(pvdf, D1).collect()}
    assert paths[(1, "step-1:home", "step-2:cart")] == 1
    assert paths[(1, "step-1:home", "step-2:trade")] == 1
    assert paths[(1, "step-2:trade", "null")] == 1
    assert paths[(1, "step-1:good_detail", "null")] == 1  # the session-less row
    assert paths[(1, "step-1:home", "step-2:cart")] == paths[(30, "step-1:home", "step-2:cart")]


def test_actions_displays_errors(spark):
    act = [("cart_add", "s1", "sku_id", ms("2020-06-15 12:00:05")), ("favor", "s2", "sku_id", ms("2020-06-15 12:00:07"))]
    disp = [("promo", "s1", "sku_id", "1", "1"), ("promo", "s2", "sku_id", "2", "2"), ("query", "s3", "sku_id", "3", "3")]
    rows = [
        ("d1", "u1", "110", "home", "good_detail", "2020-06-15 12:00:00", act, disp, None, None),
        ("d2", "u2", "110", None, None, "2020-06-15 13:00:00", None, None, ("icon", 100, 1, 2, 3), (500, "boom")),
        ("d3", "u3", "110", "home", "home", "2020-06-15 14:00:00", None, None, None, None),
    ]
    log = _log(spark, rows)
    prov = spark.createDataFrame([("p1", "bj", "r1", "110", "CN-11", "CN-BJ")], schemas.SNAPSHOTS["base_province"])
    acts = dwd.traffic_action(log, prov, D1).collect()
    assert sorted(r["action_time"] for r in acts) == ["2020-06-15 12:00:05", "2020-06-15 12:00:07"]
    disps = dwd.traffic_display(log, prov, D1).collect()
    assert sorted(r["display_order"] for r in disps) == [1, 2, 3]
    assert {r["display_time"] for r in disps} == {"2020-06-15 12:00:00"}
    errs = dwd.traffic_error(log, prov, D1).collect()
    assert len(errs) == 1 and errs[0]["error_code"] == "500" and errs[0]["entry"] == "icon"
    starts = dwd.traffic_start(log, prov, D1).collect()
    assert len(starts) == 1 and starts[0]["loading_time_ms"] == 100


# ----------------------------------------------------------------------------- DWS
def test_nday_window_edges(spark):
    d = "2020-06-30"
    days = {"2020-06-24": 1, "2020-06-23": 10, "2020-06-01": 100, "2020-05-31": 1000, "2020-07-01": 10000, d: 5}
    rows = [("u", n, n, Decimal(n), Decimal(0), Decimal(0), Decimal(n), day) for day, n in days.items()]
    one = spark.createDataFrame(rows, "user_id string, order_count_1d long, order_num_1d long, "
                                "order_original_amount_1d decimal(16,2), activity_reduce_amount_1d decimal(16,2), "
                                "coupon_reduce_amount_1d decimal(16,2), order_total_amount_1d decimal(16,2), dt string")
    r = dws.trade_user_order_nd(one, d).first()
    assert r["order_count_7d"] == 6 and r["order_count_30d"] == 116
    assert r["order_total_amount_7d"] == Decimal("6.00")
    assert r["dt"] == d


def test_to_date_merge_equals_history(spark):
    hist = [("a", 1, "2020-06-13"), ("b", 2, "2020-06-13"), ("b", 1, "2020-06-15"), ("c", 3, "2020-06-15")]
    rows = [(u, n, n, Decimal(n), Decimal(0), Decimal(0), Decimal(n), day) for u, n, day in hist]
    one = spark.createDataFrame(rows, "user_id string, order_count_1d long, order_num_1d long, "
                                "order_original_amount_1d decimal(16,2), activity_reduce_amount_1d decimal(16,2), "
                                "coupon_reduce_amount_1d decimal(16,2), order_total_amount_1d decimal(16,2), dt string")
    old = dws.trade_user_order_td_init(one, D0)
    merged = {r["user_id"]: r for r in dws.trade_user_order_td(old, one, D1).collect()}
    direct = {r["user_id"]: r for r in dws.trade_user_order_td_init(one, D1).collect()}
    assert merged["a"]["order_date_last"] == "2020-06-13" and merged["a"]["order_count_td"] == 1
    assert merged["b"]["order_date_first"] == "2020-06-13" and merged["b"]["order_date_last"] == D1
    assert merged["c"]["order_date_first"] == D1 and merged["c"]["total_amount_td"] == Decimal("3.00")
    for u in "abc":
        for c in ("order_date_first", "order_date_last", "order_count_td", "total_amount_td"):
            assert merged[u][c] == direct[u][c]


# ----------------------------------------------------------------------------- ADS
def test_user_change_gaps(spark):
    d = "2020-06-15"
    today = spark.createDataFrame(
        [("u7", "2020-06-08"), ("u8", d), ("u9", d), ("u1", d)], "user_id string, login_date_last string")
    yesterday = spark.createDataFrame(
        [("u7", "2020-06-08"), ("u8", "2020-06-07"), ("u9", "2020-06-06"), ("u1", "2020-06-08")],
        "user_id string, login_date_last string")
    r = ads.user_change(today, yesterday, d).first()
    assert r["user_churn_count"] == 1  # last login exactly 7 days ago
    assert r["user_back_count"] == 2  # gaps of 8 and 9 days; a gap of 7 is not a return


def test_cart_top3_ties_share_rank(spark):
    cart = spark.createDataFrame([(f"s{i}", n, D1) for i, n in enumerate([9, 8, 7, 7, 1])],
                                 "sku_id string, sku_num long, dt string")
    sku = spark.createDataFrame([(f"s{i}", f"n{i}", "c1", "x", "c2", "y", "c3", "z") for i in range(5)],
                                "id string, sku_name string, category1_id string, category1_name string, "
                                "category2_id string, category2_name string, category3_id string, category3_name string")
    out = sorted((r["sku_id"], r["rk"]) for r in ads.sku_cart_num_top3_by_cate(cart, sku, D1).collect())
    assert out == [("s0", 1), ("s1", 2), ("s2", 3), ("s3", 3)]


def test_unused_coupon_rate_is_null(spark):
    nd = spark.createDataFrame([("c1", "n", "2020-06-10", "rule", None, None),
                                ("c2", "n", "2020-06-10", "rule", Decimal("200.00"), Decimal("57.00"))],
                               "coupon_id string, coupon_name string, start_date string, coupon_rule string, "
                               "original_amount_30d decimal(16,2), coupon_reduce_amount_30d decimal(16,2)")
    out = {r["coupon_id"]: r["reduce_rate"] for r in ads.coupon_stats(nd, D1).collect()}
    assert out["c1"] is None
    assert out["c2"] == Decimal("0.29")  # 0.285 rounds half up


def test_trade_by_tm_keeps_refund_only_brand(spark):
    d = D1
    o1 = spark.createDataFrame([("u", "1", "A", 2, d)], "user_id string, tm_id string, tm_name string, order_count_1d long, dt string")
    on = spark.createDataFrame([("u", "1", "A", 2, 3)], "user_id string, tm_id string, tm_name string, order_count_7d long, order_count_30d long")
    r1 = spark.createDataFrame([("u", "2", "B", 1, d), ("v", "2", "B", 1, d)],
                               "user_id string, tm_id string, tm_name string, order_refund_count_1d long, dt string")
    rn = spark.createDataFrame([("u", "2", "B", 1, 1), ("u", "2", "B", 0, 1)],
                               "user_id string, tm_id string, tm_name string, order_refund_count_7d long, order_refund_count_30d long")
    out = {(r["recent_days"], r["tm_id"]): r for r in ads.trade_stats_by_tm(o1, on, r1, rn, d).collect()}
    assert out[(1, "2")]["order_count"] == 0 and out[(1, "2")]["order_refund_user_count"] == 2
    assert out[(30, "2")]["order_refund_count"] == 2 and out[(30, "2")]["order_refund_user_count"] == 1  # distinct (V10)
    assert out[(7, "1")]["order_user_count"] == 1 and out[(30, "1")]["order_count"] == 3


def test_user_stats_forms_agree(spark):
    d = D1
    reg = spark.createDataFrame([("u1", D1, D1), ("u2", "2020-06-10", "2020-06-10"), ("u3", "2020-05-01", "2020-05-01")],
                                "user_id string, date_id string, dt string")
    td = spark.createDataFrame([("u1", D1), ("u2", "2020-06-12"), ("u3", "2020-06-01")],
                               "user_id string, login_date_last string")
    a = sorted(tuple(r) for r in ads.user_stats(reg, td, d).collect())
    b = sorted(tuple(r) for r in ads.user_stats_filter_form(reg, td, d).collect())
    assert a == b == [(d, 1, 1, 1), (d, 7, 2, 2), (d, 30, 2, 3)]


def test_cancel_looks_back_one_day_and_two_refunds(spark):
    t = lambda s: secs(f"2020-06-15 {s}")
    line = lambda i, o, sku, day: {"id": i, "order_id": o, "sku_id": sku, "sku_num": 1, "order_price": Decimal("5.00"),
                                   "create_time": f"{day} 08:00:00", "split_total_amount": Decimal("5.00")}
    od = changes(spark, "order_detail", [
        ("insert", secs("2020-06-14 08:00:00"), line("l1", "o1", "s1", D0), None, D0),  # yesterday: found
        ("insert", secs("2020-06-13 08:00:00"), line("l0", "o0", "s1", "2020-06-13"), None, "2020-06-13"),  # too old
    ])
    oi = changes(spark, "order_info", [
        ("update", t("09:00:00"), {"id": "o1", "user_id": "u1", "province_id": "p", "order_status": "1003",
                                   "operate_time": "2020-06-15 09:00:00"}, {"order_status": "1001"}, D1),
        ("update", t("09:00:00"), {"id": "o0", "user_id": "u0", "province_id": "p", "order_status": "1003",
                                   "operate_time": "2020-06-15 09:00:00"}, {"order_status": "1001"}, D1),
        ("update", t("10:00:00"), {"id": "o9", "user_id": "u9", "province_id": "p", "order_status": "1006"},
         {"order_status": "1005"}, D1),
    ])
    empty = changes(spark, "order_detail_activity", [])
    emptyc = changes(spark, "order_detail_coupon", [])
    dic = spark.createDataFrame([], schemas.SNAPSHOTS["base_dic"])
    out = dwd.trade_cancel_detail(od, oi, empty, emptyc, dic, D1).collect()
    assert [(r["id"], r["cancel_time"], r["date_id"]) for r in out] == [("l1", "2020-06-15 09:00:00", D1)]
    # two refunds of one order with different SKUs: each payment joins its own request (two keys)
    rp = changes(spark, "refund_payment", [
        ("update", t("11:00:00"), {"id": "p1", "order_id": "o9", "sku_id": "sA", "total_amount": Decimal("3.00"),
                                   "refund_status": "1602", "callback_time": "2020-06-15 11:00:00"},
         {"refund_status": "1601"}, D1),
        ("update", t("11:00:00"), {"id": "p2", "order_id": "o9", "sku_id": "sB", "total_amount": Decimal("4.00"),
                                   "refund_status": "1602", "callback_time": "2020-06-15 11:00:00"},
         {"refund_status": "1601"}, D1),
    ])
    ri = changes(spark, "order_refund_info", [
        ("update", t("10:30:00"), {"id": "r1", "order_id": "o9", "sku_id": "sA", "refund_num": 1,
                                   "refund_status": "0705"}, {"refund_status": "0701"}, D1),
        ("update", t("10:30:00"), {"id": "r2", "order_id": "o9", "sku_id": "sB", "refund_num": 2,
                                   "refund_status": "0705"}, {"refund_status": "0701"}, D1),
    ])
    pays = {r["id"]: r for r in dwd.trade_refund_pay(rp, oi, ri, dic, D1).collect()}
    assert pays["p1"]["refund_num"] == Decimal("1.00") and pays["p2"]["refund_num"] == Decimal("2.00")
    assert pays["p1"]["user_id"] == "u9" and pays["p2"]["refund_amount"] == Decimal("4.00")
