"""S18/S19 end to end on a two-day raw folder: first day, daily run, rerun changes nothing."""

import os
import shutil
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from emporia import schemas
from emporia.functions.spans import shift_date
from emporia.plans import daily
from emporia.plans.daily import Chain
from emporia.plans.steps import HalfWritten
from emporia.sinks import tables, versions
from emporia.sources import files

from tests.ods_fixture import D0, D1, secs, write


QUIET = frozenset(schemas.CHANGE_DATA)  # the fixture has no folder for tables without changes


def _layers(chain):
    return {n: sorted(map(tuple, chain.read(n).collect()), key=repr) for n in sorted(os.listdir(chain.wh_root))}


def test_first_day_then_daily(spark, tmpdir_path):
    ods, wh, pub = f"{tmpdir_path}/ods", f"{tmpdir_path}/wh", f"{tmpdir_path}/pub"
    write(ods)
    with pytest.raises(FileNotFoundError):
        Chain(spark, ods, wh, pub).run_first_day(D0)  # a missing input is not an empty one
    chain = Chain(spark, ods, wh, pub, quiet=QUIET)
    with pytest.raises(FileNotFoundError):
        chain.load_dws_td(D1, first_day=False)  # nor is a missing day before
    chain.run_first_day(D0)
    assert {(r["user_id"], r["dt"]) for r in chain.read("dwd_user_register_inc").collect()} >= {("u1", "2020-06-01")}
    cart = chain.read("dwd_trade_cart_add_inc").first()
    assert (cart["id"], cart["sku_num"], cart["dt"], cart["create_time"]) == ("k0", 2, "2020-06-12", "2020-06-12 09:00:00")
    od = chain.read("dwd_trade_order_detail_inc").collect()
    assert sorted((r["id"], r["dt"]) for r in od) == [("d0", "2020-06-12"), ("d1", "2020-06-13")]  # by own day
    assert [(r["id"], r["dt"]) for r in chain.read("dwd_trade_cancel_detail_inc").collect()] == [("d0", "2020-06-12")]
    assert [(r["id"], r["dt"]) for r in chain.read("dwd_trade_pay_detail_suc_inc").collect()] == [("d1", "2020-06-13")]
    assert chain.read("dwd_tool_coupon_get_inc").first()["dt"] == "2020-06-12"
    chain.run_day(D1)

    zipper = {(r["id"], r["dt"]) for r in chain.read("dim_user_zip").collect()}
    assert ("u1", D0) in zipper and ("u1", "9999-12-31") in zipper and ("u3", "9999-12-31") in zipper
    td = {r["user_id"]: r for r in chain.read("dws_trade_user_order_td", [D1]).collect()}
    assert td["u1"]["order_date_first"] == "2020-06-13" and td["u1"]["order_count_td"] == 1
    assert td["u2"]["order_count_td"] == 2  # the bootstrapped (later cancelled) order counts as ordered
    assert td["u2"]["order_date_first"] == "2020-06-12" and td["u2"]["total_amount_td"] == Decimal("240.00")
    pay_td = {r["user_id"]: r for r in chain.read("dws_trade_user_payment_td", [D1]).collect()}
    assert pay_td["u1"]["payment_date_first"] == "2020-06-13" and pay_td["u2"]["payment_date_first"] == D1
    pay = chain.read("dwd_trade_pay_detail_suc_inc", [D1]).collect()
    assert sorted(r["id"] for r in pay) == ["d2", "d3"] and {r["payment_type_name"] for r in pay} == {"alipay"}
    by_tm = {(r["recent_days"], r["tm_id"]): r for r in chain.read("ads_trade_stats_by_tm", [D1]).collect()}
    assert by_tm[(1, "t2")]["order_count"] == 1 and by_tm[(1, "t2")]["order_refund_count"] == 1
    assert by_tm[(30, "t1")]["order_count"] == 2  # d1 (06-13) + d3 (06-15)
    assert by_tm[(30, "t2")]["order_count"] == 2  # d0 (06-12) + d2 (06-15)
    coupons = {r["coupon_id"]: r["reduce_rate"] for r in chain.read("ads_coupon_stats", [D1]).collect()}
    assert coupons == {"c1": Decimal("0.10"), "c2": None}
    reg = chain.read("dwd_user_register_inc", [D1]).collect()
    assert [(r["user_id"], r["mid_id"], r["province_id"]) for r in reg] == [("u3", "m3", "p1")]

    # every step again, in a chain that knows nothing of the first run: every layer stays as it is
    before = _layers(chain)
    assert len(chain.reports(D1)) == 15
    published = sorted(map(tuple, tables.read_table(spark, f"{pub}/ads_trade_stats").collect()), key=repr)
    again = Chain(spark, ods, wh, pub, quiet=QUIET, resume=False)
    again.run_day(D1)
    assert len(again.ran) > 60
    assert _layers(again) == before
    assert sorted(map(tuple, tables.read_table(spark, f"{pub}/ads_trade_stats").collect()), key=repr) == published

    versions = {}
    for r in again.read("dim_user_zip").collect():
        versions.setdefault(r["id"], []).append((r["start_date"], r["end_date"], r["dt"]))
    for own in versions.values():
        own.sort()
        assert all(a <= b for a, b, _ in own) and [e for _, e, _ in own].count("9999-12-31") == 1
        assert all(shift_date(x[1], 1) == y[0] for x, y in zip(own, own[1:], strict=False))
    with pytest.raises(ValueError):
        again.load_user_zip(D0, first_day=False)  # a day before the newest version


def test_empty_results_clear_their_day_and_stay_typed(spark, tmpdir_path):
    path = f"{tmpdir_path}/t"
    rows = spark.createDataFrame([("a", 1)], "k string, v long")
    tables.overwrite_partition(rows, path, D0)
    tables.overwrite_partition(rows.limit(0), path, D0)
    assert tables.read_table(spark, path).collect() == [] and tables.read_table(spark, path).columns == ["k", "v", "dt"]
    tables.overwrite_dynamic(rows.withColumn("dt", F.lit(D0)).limit(0), f"{tmpdir_path}/u")
    assert tables.read_table(spark, f"{tmpdir_path}/u").count() == 0
    report = rows.withColumn("dt", F.lit(D1))
    tables.replace_report_day(spark, report, path, D1)
    tables.replace_report_day(spark, report.limit(0), path, D1)
    assert tables.read_table(spark, path, [D1]).count() == 0


def test_publishing_null_keys_again_adds_nothing(spark, tmpdir_path):
    rows = spark.createDataFrame([(D0, None, 1)], "dt string, tm_id string, n long")
    for _ in range(3):
        tables.report_upsert(spark, rows, f"{tmpdir_path}/r", ["dt", "tm_id"])
    assert spark.read.parquet(f"{tmpdir_path}/r").count() == 1


def test_files_follow_the_size_of_days(spark, tmpdir_path):
    days = spark.range(0, 20000, 1, 16).withColumn("dt", F.concat(F.lit("2020-01-"), F.lpad((F.col("id") % 28 + 1).cast("string"), 2, "0")))
    tables.overwrite_dynamic(days, f"{tmpdir_path}/d")
    files = [f for _, _, names in os.walk(f"{tmpdir_path}/d") for f in names if f.endswith(".parquet")]
    assert len(files) == 28  # one a day, not one a task and day


def _export_current(spark, ods, root):
    """The change tables' rows as they stand on the first day, as tab-delimited exports."""
    for table in schemas.CHANGE_DATA:
        path = f"{ods}/ods_{table}_inc/dt={D0}"
        if os.path.isdir(path):
            rows = files.current_rows(files.read_changes(spark, ods, table, [D0]))
            rows.write.option("sep", "\t").option("nullValue", "").option("emptyValue", "").csv(f"{root}/{table}")


def test_first_day_starts_from_exported_rows(spark, tmpdir_path):
    """Bootstrapped from exports, the first day gives what it gives from the raw changes; log history is fanned out."""
    ods, wh, cur = f"{tmpdir_path}/ods", f"{tmpdir_path}/wh", f"{tmpdir_path}/current"
    write(ods)
    early = shift_date(D0, -3)
    line = '{"common": {"mid": "m9", "uid": "u1"}, "page": {"page_id": "home", "during_time": "7"}, "ts": %d}' % (secs(f"{early} 10:00:00") * 1000)
    os.makedirs(f"{ods}/ods_log_inc/dt={early}")
    with open(f"{ods}/ods_log_inc/dt={early}/part-0.json", "w") as f:
        f.write(line + "\n")
    _export_current(spark, ods, cur)
    want = Chain(spark, ods, wh, quiet=QUIET)
    want.run_first_day(D0)
    views = want.read("dwd_traffic_page_view_inc").collect()
    assert {r["dt"] for r in views} >= {early, D0} and {r["dt"] for r in want.read("dws_traffic_session_page_view_1d").collect()} >= {early, D0}
    logins = {r["user_id"]: r for r in want.read("dws_user_user_login_td", [D0]).collect()}
    assert logins["u1"]["login_count_td"] == 1 + sum(r["user_id"] == "u1" for r in want.read("dwd_user_login_inc", [D0]).collect())
    before = _layers(want)

    other = f"{tmpdir_path}/ods2"
    for name in os.listdir(ods):  # the same raw folder without any change table
        if not any(name == f"ods_{t}_inc" for t in schemas.CHANGE_DATA):
            shutil.copytree(f"{ods}/{name}", f"{other}/{name}")
    with pytest.raises(FileNotFoundError):
        Chain(spark, other, f"{tmpdir_path}/wh2").run_first_day(D0, cur)  # the fixture exports only some tables
    chain = Chain(spark, other, f"{tmpdir_path}/wh2", quiet=QUIET)
    for _ in range(2):  # a bootstrap may be run again
        chain.run_first_day(D0, cur)
        assert _layers(chain) == before
    kinds = files.read_changes(spark, other, "order_info", [D0]).select("type", F.col("old").isNull()).distinct().collect()
    assert [tuple(r) for r in kinds] == [("bootstrap-insert", True)]


def test_current_rows_are_the_latest_states(spark):
    schema = schemas.struct_of(schemas.change_schema("order_status_log"))
    row = lambda kind, ts, i, status: (kind, ts, (i, "o", status, None), None)
    changes = spark.createDataFrame([row("insert", 1, "a", "1"), row("update", 3, "a", "3"), row("update", 2, "a", "2"), row("delete", 9, "a", "9"),
                                     row("insert", 1, "b", "1"), row("update", 1, "b", "2"), row("bootstrap-insert", 0, None, "0")], schema)
    got = {(r["id"], r["order_status"]) for r in files.current_rows(changes).collect()}
    assert got == {("a", "3"), ("b", "2"), (None, "0")}
    assert files.current_rows(changes.limit(0)).count() == 0


def test_a_failed_chain_resumes_at_the_broken_step(spark, tmpdir_path, monkeypatch):
    ods, wh, pub = f"{tmpdir_path}/ods", f"{tmpdir_path}/wh", f"{tmpdir_path}/pub"
    write(ods)
    first = Chain(spark, ods, wh, pub, quiet=QUIET)
    first.run_first_day(D0)
    assert len(first.ran) == len(set(first.ran)) and ("dim_user_zip", D0) in first.ran

    monkeypatch.setattr(daily.tables, "overwrite_partition", _failing(daily.tables.overwrite_partition, "dws_trade_user_payment_1d"))
    failed = Chain(spark, ods, wh, pub, quiet=QUIET)
    with pytest.raises(RuntimeError, match="killed"):
        failed.run_day(D1)
    monkeypatch.undo()
    states = {(r["table"], r["day"]): r["state"] for r in failed.steps.report().collect()}
    assert states["dws_trade_user_payment_1d", D1] == "running" and states["dws_trade_user_order_1d", D1] == "done"
    with pytest.raises(HalfWritten):
        Chain(spark, ods, wh, pub, quiet=QUIET).read("dws_trade_user_payment_1d", [D1])
    with pytest.raises(HalfWritten):  # nothing is built on it either
        Chain(spark, ods, wh, pub, quiet=QUIET).load_dws_nd(D1)

    resumed = Chain(spark, ods, wh, pub, quiet=QUIET)
    resumed.run_day(D1)
    assert resumed.ran[0] == ("dws_trade_user_payment_1d", D1) and not {t for t, _ in resumed.ran} & {t for t, _ in failed.ran}
    want = _layers(resumed)
    done = Chain(spark, ods, wh, pub, quiet=QUIET)
    done.run_day(D1)
    assert done.ran == [] and _layers(done) == want

    # a raw file that changes runs what is made from it, and no more
    os.utime(f"{ods}/ods_cart_info_inc/dt={D1}/part-0.json", (1, 1))
    changed = Chain(spark, ods, wh, pub, quiet=QUIET)
    changed.run_day(D1)
    ran = {t for t, _ in changed.ran}
    assert "dwd_trade_cart_add_inc" in ran and "dwd_trade_order_detail_inc" not in ran and "dim_sku_full" not in ran
    assert _layers(changed) == want


def _failing(write, table):
    def run(df, path, dt):
        if path.endswith(table):
            write(df.limit(0), path, dt)  # a part is there already
            raise RuntimeError("killed")
        write(df, path, dt)
    return run


def test_a_zipper_that_was_half_replaced_is_replaced_from_its_copy(spark, tmpdir_path, monkeypatch):
    ods, wh = f"{tmpdir_path}/ods", f"{tmpdir_path}/wh"
    write(ods)
    for root in (wh, f"{wh}-whole"):
        Chain(spark, ods, root, quiet=QUIET).load_user_zip(D0, first_day=True)
    whole = Chain(spark, ods, f"{wh}-whole", quiet=QUIET)
    whole.load_user_zip(D1, first_day=False)
    real = tables.overwrite_partition

    def half(df, path, dt):
        if dt == "9999-12-31":
            raise RuntimeError("killed")  # the closed versions are written, the open ones aren't
        real(df, path, dt)

    monkeypatch.setattr(daily.tables, "overwrite_partition", half)
    with pytest.raises(RuntimeError, match="killed"):
        Chain(spark, ods, wh, quiet=QUIET).load_user_zip(D1, first_day=False)
    monkeypatch.undo()
    with pytest.raises(HalfWritten):
        Chain(spark, ods, wh, quiet=QUIET).read("dim_user_zip", ["9999-12-31"])
    chain = Chain(spark, ods, wh, quiet=QUIET)
    chain.load_user_zip(D1, first_day=False)
    assert _layers(chain) == _layers(whole)


def test_readers_see_a_report_before_or_after_a_commit(spark, tmpdir_path):
    path = f"{tmpdir_path}/r"
    rows = lambda *r: spark.createDataFrame(list(r), "dt string, tm_id string, n long")
    seen = lambda: sorted(map(tuple, tables.read_table(spark, path).collect()), key=repr)
    tables.replace_report_day(spark, rows((D0, "a", 1), (D0, None, 2)), path, D0)
    before = seen()
    version = versions.stage_days(rows((D0, "b", 9)), path)  # written, not switched: a crash here changes nothing
    assert seen() == before == [("a", 1, D0), (None, 2, D0)]
    old = tables.read_table(spark, path)  # a reader that began before the switch
    versions.switch(spark, path, version, [D0])
    assert seen() == [("b", 9, D0)] and old.count() == 2
    number = versions.current(spark, path)[0]
    files.write_small(spark, f"{path}/_manifests/{number + 1:012d}", "")  # a writer cut off while it switched
    assert seen() == [("b", 9, D0)]

    tables.report_upsert(spark, rows((D0, "b", 10), (D0, None, 3), (D1, "c", 4)), path, ["dt", "tm_id"])
    tables.report_upsert(spark, rows((D0, None, 5)), path, ["dt", "tm_id"])  # a NULL key is replaced too
    assert seen() == sorted([("b", 10, D0), (None, 5, D0), ("c", 4, D1)], key=repr)
    tables.report_upsert(spark, rows(), path, ["dt", "tm_id"])  # nothing to publish changes nothing
    assert len(seen()) == 3
    assert [r.dt for r in tables.list_partitions(spark, path).collect()] == [D0, D1]
    tables.replace_report_day(spark, rows(), path, D1)
    assert len(seen()) == 2 and tables.read_table(spark, path, [D1]).columns == ["tm_id", "n", "dt"]
    with pytest.raises(versions.LostRace):  # computed from a state that another writer replaced
        versions.commit_days(rows((D0, "x", 0)), path, [D0], after=number)
    assert versions.vacuum(spark, path) >= 2 and len(seen()) == 2 and versions.vacuum(spark, path) == 0
