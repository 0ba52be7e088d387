"""Raw days by manifest, checked and replay-safe reading, splicing of late user days."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from emporia import schemas
from emporia.functions.spans import shift_date
from emporia.operators import dim
from emporia.plans.daily import Chain
from emporia.sinks import landing
from emporia.sources import files, quality
from tests.ods_fixture import D0, D1, write


def _put(path, name, text):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}", "w") as f:
        f.write(text)


def test_a_late_file_reloads_its_day_only(spark, tmpdir_path):
    land, ods = f"{tmpdir_path}/land/ods_log_inc", f"{tmpdir_path}/ods/ods_log_inc"
    _put(f"{land}/{D0}", "a", '{"ts": 1}\n{"ts": 2}\n')
    _put(f"{land}/dt={D1}", "a", '{"ts": 3}\n')
    seen = lambda: sorted((r["dt"], r["ts"]) for r in files.read_log(spark, f"{tmpdir_path}/ods").collect())
    assert landing.load_landed(spark, land, ods) == {D0: True, D1: True}
    assert seen() == [(D0, 1), (D0, 2), (D1, 3)]
    assert landing.load_landed(spark, land, ods) == {D0: False, D1: False}  # nothing new
    _put(f"{land}/{D0}", "late", '{"ts": 9}\n')
    before = os.stat(f"{ods}/dt={D1}").st_mtime_ns
    assert landing.pending(spark, land, ods).keys() == {D0}
    assert landing.load_landed(spark, land, ods) == {D0: True, D1: False}
    assert seen() == [(D0, 1), (D0, 2), (D0, 9), (D1, 3)] and os.stat(f"{ods}/dt={D1}").st_mtime_ns == before
    os.remove(f"{ods}/_landed/{D1}")  # a load that broke before its manifest
    assert landing.load_landed(spark, land, ods, [D1]) == {D1: True} and len(seen()) == 4
    assert landing.load_landed(spark, f"{tmpdir_path}/nothing", ods) == {}
    report = {(r["dt"], r["file"]) for r in landing.manifest_report(spark, ods).collect()}
    assert report == {(D0, "a"), (D0, "late"), (D1, "a")}


def test_the_chain_names_the_days_to_run_again(spark, tmpdir_path):
    chain = Chain(spark, f"{tmpdir_path}/ods", f"{tmpdir_path}/wh")
    land = f"{tmpdir_path}/land"
    _put(f"{land}/ods_base_region_full/{D0}", "a", "r1\tnorth\n")
    _put(f"{land}/ods_cart_info_inc/{D1}", "a", '{"type": "insert", "ts": 1, "data": {"id": "1"}}\n')
    assert chain.load_ods(D0, land)["ods_base_region_full"] and not chain.load_ods(D0, land)["ods_cart_info_inc"]
    changed = chain.load_landed(land)
    assert changed["ods_cart_info_inc"] == {D1: True} and changed["ods_base_region_full"] == {D0: False}
    assert chain.snap("base_region", D0).first()["region_name"] == "north" and chain.inc("cart_info", [D1]).count() == 1


def test_snapshots_keep_to_their_budget(spark, tmpdir_path):
    good = "\t".join(["1", "p", "9.50", "n", "d", "1.00", "t", "c", "", "1", ""])
    cut, letters, long = "2\tp", good.replace("9.50", "x"), good + "\tmore"
    _put(f"{tmpdir_path}/ods_sku_info_full/dt={D0}", "a", "\n".join([good, cut, letters, long, good.replace("1\t", "7\t", 1)]) + "\n")
    read = lambda **b: quality.read_snapshot_checked(spark, tmpdir_path, "sku_info", D0, quality.Budget(**b), f"{tmpdir_path}/aside")
    with pytest.raises(quality.TooManyErrors, match="3 of 5"):
        read()
    aside = [r.value for r in spark.read.text(f"{tmpdir_path}/aside/sku_info/dt={D0}").collect()]
    assert sorted(aside) == sorted([cut, letters, long])  # written before it raised
    with pytest.raises(quality.TooManyErrors):
        read(records=3, share=0.5)
    found = read(records=3, share=0.6)
    assert (found.lines, found.bad, sorted(r["id"] for r in found.rows.collect())) == (5, 3, ["1", "7"])
    assert sorted(r["line"] for r in found.rejected.collect()) == sorted(aside) and found.rows.columns == [*schemas.struct_of(schemas.SNAPSHOTS["sku_info"]).names, "dt"]
    _put(f"{tmpdir_path}/ods_sku_info_full/dt={D1}", "a", "")
    empty = quality.read_snapshot_checked(spark, tmpdir_path, "sku_info", D1)
    assert (empty.lines, empty.bad, empty.rows.count()) == (0, 0, 0)
    with pytest.raises(FileNotFoundError):
        quality.read_snapshot_checked(spark, tmpdir_path, "sku_info", "1999-01-01")


def test_the_chain_reads_within_its_budget(spark, tmpdir_path):
    write(f"{tmpdir_path}/ods")
    plain, strict = (Chain(spark, f"{tmpdir_path}/ods", f"{tmpdir_path}/{n}", budget=b, once=b is not None) for n, b in (("a", None), ("b", quality.Budget())))
    for chain in (plain, strict):
        chain.load_dims(D0)
    for table in ("dim_sku_full", "dim_coupon_full", "dim_province_full"):
        rows = [sorted(map(str, c.read(table).drop("create_time").collect())) for c in (plain, strict)]
        assert rows[0] == rows[1]
    assert sorted(map(str, plain.inc("order_info", [D1]).collect())) == sorted(map(str, strict.inc("order_info", [D1]).collect()))
    with open(f"{tmpdir_path}/ods/ods_base_region_full/dt={D1}/part-0", "a") as f:
        f.write("only one field\n")
    with pytest.raises(quality.TooManyErrors):
        strict.load_dims(D1)


def test_a_change_that_landed_twice_counts_once(spark):
    line = lambda i, ts, pos=None, **more: json.dumps({"type": "update", "ts": ts, "data": {"id": i, **more}, "old": {"status": "1"}} | ({"xid": pos[0], "xoffset": pos[1]} if pos else {}))
    rows = [(line("a", 1), D0), (line("a", 1), D0), (line("a", 1), D1),  # the same, three times
            (line("a", 2), D0), (line("a", 1, status="x"), D0),  # other second, other content
            (line("b", 1, (5, 0)), D1), (line("b", 1, (5, 0), shop="7"), D0), (line("b", 1, (5, 1)), D1),  # by position
            ("{broken", D0), ('{"type": "insert", "ts": 1}', D0)]
    lines = spark.createDataFrame(rows, "value string, dt string")
    got = sorted((r["data"]["id"], r["ts"], r["dt"]) for r in quality.changes_once(lines, "user_info").collect())
    assert got == [("a", 1, D0), ("a", 1, D0), ("a", 2, D0), ("b", 1, D0), ("b", 1, D1)]
    assert quality.changes_once(lines.limit(0), "user_info").count() == 0
    drift = {(r["field"], r["state"]): r["lines"] for r in quality.drift(lines, "user_info").collect()}
    assert drift["shop", "unknown"] == 1 and drift["email", "missing"] == 0 and ("status", "unknown") not in drift and ("id", "missing") not in drift
    log = spark.createDataFrame([('{"ts": 5, "common": {"mid": "m"}}', D1), ('{"ts": 5, "common": {"mid": "m"}}', D0), ('{"ts": 6}', D0)], "value string, dt string")
    assert sorted((r["ts"], r["dt"]) for r in quality.log_once(log).collect()) == [(5, D0), (6, D0)]


def _users(spark, rows):
    fields = schemas.struct_of(schemas.change_schema("user_info"))["data"].dataType.names
    data = lambda i, level: tuple({"id": i, "user_level": level}.get(f) for f in fields)
    return spark.createDataFrame([(kind, ts, data(i, level), None, day) for kind, ts, i, level, day in rows],
                                 "type string, ts bigint, data " + schemas.struct_of(schemas.change_schema("user_info"))["data"].dataType.simpleString() + ", old map<string,string>, dt string")


def test_late_user_days_are_spliced_in(spark):
    """Days in any order give what all changes at once give; untouched users' rows of the touched days stay."""
    rng = random.Random(2)
    days = [shift_date(D0, k) for k in range(6)]
    rows = [("bootstrap-insert", 0, f"u{u}", "L0", days[0]) for u in range(12)]
    rows += [("update", 100 * k + rng.randint(0, 3), f"u{rng.randint(0, 11)}", f"L{k}.{n}", days[k]) for k in range(1, 6) for n in range(5)]
    rows += [("insert", 300, "new", "first", days[3]), ("delete", 301, "u1", "gone", days[3]), ("update", 501, None, "no id", days[5])]
    changes = _users(spark, rows)
    last = {}
    for kind, ts, i, level, day in rows:
        if kind != "delete":
            key = (str(i), day)
            last[key] = max(last.get(key, (-1, "")), (ts, level))
    want = []
    for user in {u for u, _ in last}:
        own = sorted((d, v[1]) for (u, d), v in last.items() if u == user)
        want += [(user, level, d, shift_date(own[k + 1][0], -1) if k + 1 < len(own) else "9999-12-31") for k, (d, level) in enumerate(own)]
    for order in ([1, 2, 3, 4, 5], [5, 3, 1, 4, 2]):
        zipper = dim.user_zip_init(changes, days[0])
        for k in order + order[:1]:  # a day may be merged again
            made = dim.user_zip_splice(zipper, changes.where(F.col("dt") == days[k]))
            rows_now = made.where("not gone").drop("gone")
            moved = {r.dt for r in made.select("dt").distinct().collect()}
            kept = zipper.where(~F.col("dt").isin(*moved))
            zipper = spark.createDataFrame(kept.unionByName(rows_now).collect(), zipper.schema)
        got = [(str(r["id"]), r["user_level"], r["start_date"], r["end_date"]) for r in zipper.collect()]
        level = {(u, d): v[1] for (u, d), v in last.items()}
        assert sorted((u, s, e) for u, _, s, e in got) == sorted((u, s, e) for u, _, s, e in want)
        ties = {(u, d) for u, d in level if sum(1 for _, ts, i, _, x in rows if str(i) == u and x == d and ts == last[u, d][0]) > 1}
        assert all(v == level[u, s] for u, v, s, _ in got if (u, s) not in ties)


def test_the_chain_splices_a_late_day(spark, tmpdir_path):
    ods, wh = f"{tmpdir_path}/ods", f"{tmpdir_path}/wh"
    write(ods)
    late, after = shift_date(D0, 1), shift_date(D0, 2)
    assert late == D1
    os.makedirs(f"{ods}/ods_user_info_inc/dt={after}")
    with open(f"{ods}/ods_user_info_inc/dt={after}/part-0.json", "w") as f:
        f.write(json.dumps({"type": "update", "ts": 1592300000, "data": {"id": "u1", "name": "ann3"}, "old": None}) + "\n")
    orders = {"in order": [D1, after], "late": [after, D1]}
    layers = {}
    for name, days in orders.items():
        chain = Chain(spark, ods, f"{wh}-{name}")
        chain.load_user_zip(D0, first_day=True)
        for d in days:
            chain.load_user_zip(d, first_day=False)
        layers[name] = sorted(map(tuple, chain.read("dim_user_zip").collect()), key=repr)
        with pytest.raises(ValueError):
            Chain(spark, ods, f"{wh}-{name}", resume=False).load_user_zip(D0, first_day=False)
    assert layers["in order"] == layers["late"] and len(layers["late"]) >= 5
