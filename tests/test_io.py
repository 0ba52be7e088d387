"""Sources (S1–S5), sinks (S9–S17) and streams (S6–S8) on small files."""

import gzip
import json
import os
import time
from decimal import Decimal

from pyspark.sql import functions as F

from emporia.sinks import tables
from emporia.sources import files
from emporia.streaming import routing

D0, D1 = "2020-06-14", "2020-06-15"


def _write_text(path, lines, gz=False):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    data = ("\n".join(lines) + "\n").encode()
    with (gzip.open(path, "wb") if gz else open(path, "wb")) as f:
        f.write(data)


def test_snapshot_tsv_and_types(spark, tmpdir_path):
    root = tmpdir_path
    _write_text(f"{root}/ods_sku_info_full/dt={D1}/part-0.gz",
                ["1\tp1\t9.90\tname\t\t1.00\tt1\tc3\t\t1\t2020-06-01 00:00:00",
                 "2\tp1\t5.5\tname2\tdesc\t\tt1\tc3\t\t0\t"], gz=True)
    df = files.read_snapshot(spark, root, "sku_info", [D1])
    rows = {r["id"]: r for r in df.collect()}
    assert rows["1"]["sku_desc"] is None and rows["1"]["price"] == Decimal("9.90")
    assert rows["2"]["weight"] is None and rows["2"]["dt"] == D1
    assert dict(df.dtypes)["dt"] == "string"


def test_changes_and_log_json(spark, tmpdir_path):
    root = tmpdir_path
    rec = {"type": "update", "ts": 1592186400, "data": {"id": "7", "sku_num": 3, "user_id": "u"}, "old": {"sku_num": "1"}}
    _write_text(f"{root}/ods_cart_info_inc/dt={D1}/a.json", [json.dumps(rec)])
    c = files.read_changes(spark, root, "cart_info").first()
    assert c["data"]["sku_num"] == 3 and c["old"]["sku_num"] == "1" and c["dt"] == D1
    log = {"ts": 1592186400000, "page": {"page_id": "home", "during_time": "1000"}, "common": {"mid": "m1"},
           "actions": [{"action_id": "a", "ts": 1}], "extra": 1}
    _write_text(f"{root}/ods_log_inc/dt={D1}/b.json", [json.dumps(log)])
    lg = files.read_log(spark, root, [D1]).first()
    assert lg["page"]["page_id"] == "home" and lg["common"]["uid"] is None and lg["actions"][0]["action_id"] == "a"


def test_normalize_and_bootstrap(spark):
    df = spark.createDataFrame([(1, 2, Decimal("1.50"), 2.5, "x")], "a int, b smallint, c decimal(10,2), d double, e string")
    n = files.normalize_types(df)
    assert dict(n.dtypes) == {"a": "bigint", "b": "bigint", "c": "string", "d": "double", "e": "string"}
    assert n.first()["c"] == "1.50"
    boot = files.snapshot_as_changes(df, 1592064000, D0).first()
    assert boot["type"] == "bootstrap-insert" and boot["data"]["e"] == "x" and boot["old"] is None


def test_partition_writes_are_idempotent(spark, tmpdir_path):
    path = f"{tmpdir_path}/t"
    a = spark.createDataFrame([("x", 1, D0), ("y", 2, D1)], "k string, v long, dt string")
    tables.overwrite_dynamic(a, path)
    tables.overwrite_partition(spark.createDataFrame([("z", 3)], "k string, v long"), path, D1)
    tables.overwrite_partition(spark.createDataFrame([("z", 3)], "k string, v long"), path, D1)
    got = sorted(tuple(r) for r in spark.read.parquet(path).select("k", "v", "dt").collect())
    assert got == [("x", 1, D0), ("z", 3, D1)]
    assert [r["dt"] for r in tables.list_partitions(spark, path).collect()] == [D0, D1]
    tables.load_ods_append(spark.createDataFrame([("w", 4, D1)], "k string, v long, dt string"), path)
    assert spark.read.parquet(path).where(F.col("dt") == D1).count() == 2
    assert tables.load_ods_overwrite(spark, None, path, D1) is False


def test_report_upsert_replaces_by_key(spark, tmpdir_path):
    path = f"{tmpdir_path}/ads"
    keys = ["dt", "recent_days"]
    r1 = spark.createDataFrame([(D1, 1, 10), (D1, 7, 70)], "dt string, recent_days long, n long")
    tables.report_upsert(spark, r1, path, keys)
    tables.report_upsert(spark, r1, path, keys)  # identical rerun: nothing changes
    r2 = spark.createDataFrame([(D1, 7, 71)], "dt string, recent_days long, n long")
    tables.report_upsert(spark, r2, path, keys)  # changed rerun: one version per key
    got = sorted(tuple(r) for r in spark.read.parquet(path).select("dt", "recent_days", "n").collect())
    assert got == [(D1, 1, 10), (D1, 7, 71)]
    assert tables.drop_empty(spark.createDataFrame([], "a int")) and tables.drop_empty(None)


def test_stream_validation_and_routing(spark, tmpdir_path):
    src, out, ck = f"{tmpdir_path}/in", f"{tmpdir_path}/out", f"{tmpdir_path}/ck"
    ts_day1 = 1592186400000  # 2020-06-15 10:00 GMT+8
    ts_late = 1592100000000  # 2020-06-14 10:00 GMT+8, arrives with day 2
    _write_text(f"{src}/f1.txt", [
        json.dumps({"ts": ts_day1, "page": {"page_id": "home"}}),
        "{ts:%d, page:{page_id:'x'}}" % ts_day1,  # unquoted keys accepted
        '{"ts": 1, "page":',  # truncated
        "",
        "[1]",
        json.dumps({"ts": ts_late}),
    ])
    q = routing.collect_log(spark, src, out, ck)
    q.awaitTermination(120)
    df = spark.read.text(out)
    got = sorted((r["dt"], r["value"][:5]) for r in df.collect())
    assert [g[0] for g in got] == ["2020-06-14", "2020-06-15", "2020-06-15"]
    q2 = routing.collect_log(spark, src, out, ck)  # same checkpoint: nothing added
    q2.awaitTermination(120)
    assert spark.read.text(out).count() == 3


def test_stream_change_routing(spark, tmpdir_path):
    src, out, ck = f"{tmpdir_path}/in", f"{tmpdir_path}/out", f"{tmpdir_path}/ck"
    _write_text(f"{src}/f1.txt", [
        json.dumps({"database": "db", "table": "order_info", "type": "insert", "ts": 1592186400, "data": {"id": "1"}}),
        json.dumps({"database": "db", "table": "cart_info", "type": "update", "ts": 1592100000, "data": {"id": "2"},
                    "old": {"sku_num": "1"}}),
        "not json",
    ])
    q = routing.collect_changes(spark, src, out, ck)
    q.awaitTermination(120)
    got = sorted((r["table"], r["dt"]) for r in spark.read.text(out).collect())
    assert got == [("cart_info_inc", "2020-06-14"), ("order_info_inc", "2020-06-15")]


def test_landing_to_raw_is_rerun_safe(spark, tmpdir_path):
    from emporia.plans.daily import Chain

    land, ods = f"{tmpdir_path}/landing", f"{tmpdir_path}/ods"
    _write_text(f"{land}/ods_order_info_inc/{D1}/a.json", [json.dumps({"type": "insert", "ts": 1, "data": {"id": "1"}})])
    _write_text(f"{land}/ods_log_inc/{D1}/a.json", [json.dumps({"ts": 1592186400000})])
    chain = Chain(spark, ods, f"{tmpdir_path}/wh")
    done = chain.load_ods(D1, land)
    assert done["ods_order_info_inc"] and done["ods_log_inc"] and not done["ods_cart_info_inc"]
    chain.load_ods(D1, land)  # rerun: both days are derived anew from what landed
    assert files.read_changes(spark, ods, "order_info", [D1]).count() == 1
    assert files.read_log(spark, ods, [D1]).count() == 1
    _write_text(f"{land}/ods_log_inc/{D1}/late.json", [json.dumps({"ts": 1592186400001})])
    chain.load_ods(D1, land)  # a late file of the day
    assert files.read_log(spark, ods, [D1]).count() == 2
    assert files.read_changes(spark, ods, "order_info", [D1]).first()["data"]["id"] == "1"


def test_calendar_file_replaces_table(spark, tmpdir_path):
    from emporia.plans.daily import Chain

    cal = f"{tmpdir_path}/date_info.tsv"
    _write_text(cal, ["2020-06-14\t24\t7\t14\t6\t2\t2020\t0\t", "2020-10-01\t40\t4\t1\t10\t4\t2020\t0\t1"])
    chain = Chain(spark, f"{tmpdir_path}/ods", f"{tmpdir_path}/wh")
    chain.load_date_dim(cal)
    chain.load_date_dim(cal)  # whole-table overwrite: idempotent
    rows = {r["date_id"]: r for r in spark.read.parquet(chain.path("dim_date")).collect()}
    assert len(rows) == 2 and rows["2020-10-01"]["holiday_id"] == "1" and rows["2020-06-14"]["holiday_id"] is None
