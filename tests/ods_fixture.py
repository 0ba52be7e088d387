"""A two-day raw (ODS) folder: 2020-06-14 bootstrap, 2020-06-15 daily changes."""

import datetime as dt
import json
import os

from emporia import schemas

D0, D1 = "2020-06-14", "2020-06-15"
GMT8 = dt.timezone(dt.timedelta(hours=8))


def secs(text):
    return int(dt.datetime.fromisoformat(text).replace(tzinfo=GMT8).timestamp())


def _cols(ddl):
    return [c.split(" ")[0] for c in ddl.split(", ")]


def _tsv(root, table, day, rows):
    cols = _cols(schemas.SNAPSHOTS[table])
    path = f"{root}/ods_{table}_full/dt={day}"
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/part-0", "w") as f:
        for r in rows:
            f.write("\t".join("" if r.get(c) is None else str(r[c]) for c in cols) + "\n")


def _inc(root, table, day, recs):
    path = f"{root}/ods_{table}_inc/dt={day}"
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/part-0.json", "w") as f:
        for typ, ts, data, old in recs:
            f.write(json.dumps({"type": typ, "ts": ts, "data": data, "old": old}) + "\n")


def _log(root, day, recs):
    path = f"{root}/ods_log_inc/dt={day}"
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/part-0.json", "w") as f:
        for r in recs:
            f.write(json.dumps(r) + "\n")


def snapshots(root, day):
    _tsv(root, "base_category1", day, [{"id": "1", "name": "phones"}])
    _tsv(root, "base_category2", day, [{"id": "11", "name": "smart", "category1_id": "1"}])
    _tsv(root, "base_category3", day, [{"id": "111", "name": "5g", "category2_id": "11"}])
    _tsv(root, "base_trademark", day, [{"id": "t1", "tm_name": "acme"}, {"id": "t2", "tm_name": "zeta"}])
    _tsv(root, "spu_info", day, [{"id": "p1", "spu_name": "phone", "category3_id": "111", "tm_id": "t1"}])
    _tsv(root, "sku_info", day, [
        {"id": "s1", "spu_id": "p1", "price": "100.00", "sku_name": "phone-a", "tm_id": "t1", "category3_id": "111", "is_sale": "1"},
        {"id": "s2", "spu_id": "p1", "price": "50.00", "sku_name": "phone-b", "tm_id": "t2", "category3_id": "111", "is_sale": "1"},
    ])
    _tsv(root, "sku_attr_value", day, [{"id": "1", "attr_id": "a", "value_id": "v", "sku_id": "s1", "attr_name": "ram", "value_name": "8g"}])
    _tsv(root, "sku_sale_attr_value", day, [])
    _tsv(root, "base_dic", day, [
        {"dic_code": "2401", "dic_name": "search", "parent_code": "24"},
        {"dic_code": "1101", "dic_name": "alipay", "parent_code": "11"},
        {"dic_code": "3201", "dic_name": "full reduction", "parent_code": "32"},
        {"dic_code": "3101", "dic_name": "full reduction", "parent_code": "31"},
        {"dic_code": "1201", "dic_name": "good", "parent_code": "12"},
        {"dic_code": "1501", "dic_name": "refund only", "parent_code": "15"},
        {"dic_code": "1301", "dic_name": "quality", "parent_code": "13"},
    ])
    _tsv(root, "coupon_info", day, [
        {"id": "c1", "coupon_name": "c1", "coupon_type": "3201", "condition_amount": "100.00", "benefit_amount": "10.00",
         "range_type": "3301", "start_time": "2020-06-10 00:00:00"},
        {"id": "c2", "coupon_name": "never used", "coupon_type": "3201", "condition_amount": "100.00",
         "benefit_amount": "10.00", "range_type": "3301", "start_time": "2020-06-12 00:00:00"},
    ])
    _tsv(root, "activity_info", day, [{"id": "a1", "activity_name": "summer", "activity_type": "3101",
                                       "start_time": "2020-06-01 00:00:00"}])
    _tsv(root, "activity_rule", day, [{"id": "r1", "activity_id": "a1", "activity_type": "3101",
                                       "condition_amount": "100.00", "benefit_amount": "20.00", "benefit_level": "1"}])
    _tsv(root, "base_region", day, [{"id": "r1", "region_name": "north"}])
    _tsv(root, "base_province", day, [{"id": "p1", "name": "beijing", "region_id": "r1", "area_code": "110000",
                                       "iso_code": "CN-11", "iso_3166_2": "CN-BJ"}])
    _tsv(root, "cart_info", day, [
        {"id": "k1", "user_id": "u1", "sku_id": "s1", "sku_num": "2", "is_ordered": "0"},
        {"id": "k2", "user_id": "u2", "sku_id": "s2", "sku_num": "5", "is_ordered": "1"},
    ])


def user(i, name, created):
    return {"id": i, "login_name": f"l{i}", "name": name, "phone_num": "1", "email": "e", "create_time": created}


def line(i, order, sku, qty, price, created, total, act="0.00", cou="0.00"):
    return {"id": i, "order_id": order, "sku_id": sku, "sku_num": qty, "order_price": price, "create_time": created,
            "source_type": "2401", "split_total_amount": total, "split_activity_amount": act,
            "split_coupon_amount": cou}


def log(mid, uid, page, last, ts_text):
    return {"common": {"mid": mid, "uid": uid, "ar": "110000", "ch": "xiaomi", "ba": "mi", "md": "m1", "os": "android",
                       "vc": "v1", "is_new": "0"},
            "page": {"page_id": page, "last_page_id": last, "during_time": "3000"},
            "ts": secs(ts_text) * 1000}


def write(root):
    for day in (D0, D1):
        snapshots(root, day)
    # ---- day 0: bootstrap of current rows (history inside)
    t0 = secs("2020-06-14 23:00:00")
    _inc(root, "user_info", D0, [("bootstrap-insert", t0, user("u1", "ann", "2020-06-01 10:00:00"), None),
                                 ("bootstrap-insert", t0, user("u2", "bob", "2020-06-13 10:00:00"), None)])
    _inc(root, "order_info", D0, [
        ("bootstrap-insert", t0, {"id": "o1", "user_id": "u1", "province_id": "p1", "order_status": "1002"}, None),
        ("bootstrap-insert", t0, {"id": "o0", "user_id": "u2", "province_id": "p1", "order_status": "1003",
                                  "operate_time": "2020-06-12 18:00:00"}, None),
    ])
    _inc(root, "order_detail", D0, [
        ("bootstrap-insert", t0, line("d1", "o1", "s1", 1, "100.00", "2020-06-13 09:00:00", "90.00", act="10.00"), None),
        ("bootstrap-insert", t0, line("d0", "o0", "s2", 1, "50.00", "2020-06-12 09:00:00", "50.00"), None),
    ])
    _inc(root, "payment_info", D0, [("bootstrap-insert", t0, {"id": "pay0", "order_id": "o1", "user_id": "u1",
                                                              "payment_type": "1101", "payment_status": "1602",
                                                              "callback_time": "2020-06-13 09:30:00"}, None)])
    _inc(root, "order_detail_activity", D0, [("bootstrap-insert", t0, {"id": "x", "order_id": "o1",
                                                                       "order_detail_id": "d1", "activity_id": "a1",
                                                                       "activity_rule_id": "r1"}, None)])
    _inc(root, "coupon_use", D0, [("bootstrap-insert", t0, {"id": "cu1", "coupon_id": "c1", "user_id": "u1",
                                                            "get_time": "2020-06-12 08:00:00"}, None)])
    _log(root, D0, [log("m1", "u1", "home", None, "2020-06-14 10:00:00")])
    # ---- day 1: daily changes
    t1 = secs("2020-06-15 12:00:00")
    _inc(root, "cart_info", D0, [("bootstrap-insert", t0, {"id": "k0", "user_id": "u1", "sku_id": "s1", "sku_num": 2,
                                 "create_time": "2020-06-12 09:00:00", "source_id": None, "source_type": "2401"}, None)])
    _inc(root, "user_info", D1, [("insert", t1, user("u3", "cy", "2020-06-15 12:00:00"), None),
                                 ("update", t1, user("u1", "ann2", "2020-06-01 10:00:00"), {"name": "ann"})])
    _inc(root, "order_info", D1, [
        ("insert", t1, {"id": "o2", "user_id": "u2", "province_id": "p1", "order_status": "1001"}, None),
        ("update", t1, {"id": "o2", "user_id": "u2", "province_id": "p1", "order_status": "1002"},
         {"order_status": "1001"}),
    ])
    _inc(root, "order_detail", D1, [
        ("insert", t1, line("d2", "o2", "s2", 2, "50.00", "2020-06-15 12:00:00", "90.00", cou="10.00"), None),
        ("insert", t1, line("d3", "o2", "s1", 1, "100.00", "2020-06-15 12:00:00", "100.00"), None),
    ])
    _inc(root, "order_detail_coupon", D1, [("insert", t1, {"id": "y", "order_id": "o2", "order_detail_id": "d2",
                                                           "coupon_id": "c1"}, None)])
    _inc(root, "payment_info", D1, [("update", t1, {"id": "pay1", "order_id": "o2", "user_id": "u2",
                                                    "payment_type": "1101", "payment_status": "1602",
                                                    "callback_time": "2020-06-15 12:30:00"},
                                     {"payment_status": "1601"})])
    _inc(root, "order_refund_info", D1, [("insert", t1, {"id": "rf1", "user_id": "u2", "order_id": "o2", "sku_id": "s2",
                                                         "refund_type": "1501", "refund_num": 1,
                                                         "refund_amount": "45.00", "refund_reason_type": "1301",
                                                         "create_time": "2020-06-15 13:00:00"}, None)])
    _inc(root, "cart_info", D1, [("insert", t1, {"id": "k3", "user_id": "u3", "sku_id": "s1", "sku_num": 1,
                                                 "source_type": "2401"}, None)])
    _log(root, D1, [
        log("m1", "u1", "home", None, "2020-06-15 09:00:00"),
        log("m1", "u1", "good_detail", "home", "2020-06-15 09:01:00"),
        log("m3", "u3", "register", None, "2020-06-15 12:00:00"),
    ])
