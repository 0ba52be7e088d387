"""The daily chain (S18) and the first-day chain.

Layers run in dependency order for one business date::

    ODS → DIM & DWD → DWS 1-day → DWS n-day ∥ to-date → ADS → publish

Each step reads its inputs from the warehouse folder and writes its output
there (one partition per ``dt``, dynamic overwrite). Materialising every layer
is what the reference does, and it is what keeps a 100 TB run restartable:
each step's lineage starts at stored files, a lost executor only recomputes
tasks of the current step, and a failed step reruns alone with the same
result. A ledger of steps (``plans.steps``) lets a failed chain resume where it broke and keeps
half-written tables from being read. This module only orders the steps; Spark does the work.
"""

from __future__ import annotations

import contextlib
import datetime as _dt
import functools
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor, wait
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporia.functions.sessions import HOT_ROWS
from emporia.functions.spans import shift_date
from emporia.operators import ads, dim, dwd, dws
from emporia.plans.steps import DONE, StepLedger, fingerprint, raw_fingerprint
from emporia.session import scratch_folder
from emporia.sinks import landing, tables
from emporia.sources import files, quality
from emporia.sources.quality import Budget

OPEN = dim.OPEN_END

# Keys of the published report tables (same key ⇒ row replaced).
REPORT_KEYS = {
    "ads_traffic_stats_by_channel": ["dt", "recent_days", "channel"],
    "ads_page_path": ["dt", "recent_days", "source", "target"],
    "ads_user_change": ["dt"],
    "ads_user_retention": ["dt", "create_date", "retention_day"],
    "ads_user_stats": ["dt", "recent_days"],
    "ads_user_action": ["dt", "recent_days"],
    "ads_new_buyer_stats": ["dt", "recent_days"],
    "ads_repeat_purchase_by_tm": ["dt", "recent_days", "tm_id"],
    "ads_trade_stats_by_tm": ["dt", "recent_days", "tm_id"],
    "ads_trade_stats_by_cate": ["dt", "recent_days", "category1_id", "category2_id", "category3_id"],
    "ads_sku_cart_num_top3_by_cate": ["dt", "category1_id", "category2_id", "category3_id", "sku_id"],
    "ads_trade_stats": ["dt", "recent_days"],
    "ads_order_by_province": ["dt", "recent_days", "province_id"],
    "ads_coupon_stats": ["dt", "coupon_id"],
    "ads_activity_stats": ["dt", "activity_id"],
}


def _together(load):
    """A layer's steps run together."""
    @functools.wraps(load)
    def run(self, *args, **kw):
        with self._layer():
            load(self, *args, **kw)
    return run


@dataclass
class Chain:
    spark: SparkSession
    ods_root: str  # raw files: <ods_root>/ods_<table>_{full,inc}/dt=<day>/
    wh_root: str  # warehouse tables: <wh_root>/<table>/dt=<day>/
    publish_root: str | None = None  # published reports (keyed upsert)
    quiet: frozenset[str] = frozenset()  # change tables whose day folder may be missing (a day without changes)
    resume: bool = True  # pass over steps whose inputs are as they were when the step ended
    steps_root: str | None = None  # the step ledger; beside the warehouse folder by default
    budget: Budget | None = None  # bad lines that a snapshot may have; None: lines are read as they are
    rejected_root: str | None = None  # sidecar of the snapshots' bad lines
    once: bool = False  # changes that landed several times count once
    together: int = 4  # steps of a layer that run at the same time: none of them reads another's table

    def __post_init__(self):
        self.steps = StepLedger(self.spark, self.steps_root or f"{self.wh_root.rstrip('/')}-steps")
        self.day = ""  # the run's day
        self.ran: list[tuple[str, str]] = []  # steps that wrote, in order
        self._read: dict | None = None  # what the step being planned reads
        self._checked: dict = {}  # snapshots that were read and checked
        self._pool: ThreadPoolExecutor | None = None  # while a layer's steps run together
        self._running: list = []

    # ------------------------------------------------------------------ io
    def path(self, table: str) -> str:
        return tables.table_path(self.wh_root, table)

    def _note(self, name: str, what) -> None:
        if self._read is not None:
            self._read[name] = what

    def read(self, table: str, days: list[str] | None = None) -> DataFrame:
        """A warehouse table; its declared columns type it, also where it is empty. A half-written one raises."""
        if days is None:
            self._note(table, self.steps.whole(table))
        elif OPEN in days:  # the open versions are the work of all days' steps
            self._note(f"{table} {days}", self.steps.whole(table))
        else:
            self._note(f"{table} {days}", {d: self.steps.whole(table, d, d) for d in days})
        return tables.read_table(self.spark, self.path(table), days)

    def state(self, table: str, day: str) -> DataFrame:
        """A day that the next one builds on; it must have been written."""
        if not tables._exists(self.spark, f"{self.path(table)}/dt={day}"):
            raise FileNotFoundError(f"{table} has no {day}: run that day first")
        return self.read(table, [day])

    def window(self, table: str, do_date: str, days: int = 30) -> DataFrame:
        lo = shift_date(do_date, -(days - 1))
        self._note(f"{table} {lo}-{do_date}", self.steps.whole(table, lo, do_date))
        return tables.read_table(self.spark, self.path(table), [shift_date(lo, k) for k in range(days)])

    def _raw(self, name: str, days: list[str]) -> None:
        for d in days:
            self._note(f"raw {name} {d}", raw_fingerprint(self.spark, f"{self.ods_root.rstrip('/')}/{name}/dt={d}"))

    def snap(self, table: str, d: str) -> DataFrame:
        self._raw(f"ods_{table}_full", [d])
        if self.budget is not None:
            if (table, d) not in self._checked:  # several steps read it
                self._checked[table, d] = quality.read_snapshot_checked(self.spark, self.ods_root, table, d, self.budget, self.rejected_root).rows
            return self._checked[table, d]
        return files.read_snapshot(self.spark, self.ods_root, table, [d])

    def inc(self, table: str, days: list[str]) -> DataFrame:
        self._raw(f"ods_{table}_inc", days)
        if self.once and all(files.path_exists(self.spark, f"{self.ods_root.rstrip('/')}/ods_{table}_inc/dt={d}") for d in days):
            return quality.read_changes_once(self.spark, self.ods_root, table, days)
        return files.read_changes(self.spark, self.ods_root, table, days, may_be_absent=table in self.quiet)

    def log(self, d: str) -> DataFrame:
        self._raw("ods_log_inc", [d])
        return files.read_log(self.spark, self.ods_root, [d])

    def logs_to(self, d: str) -> DataFrame:
        """The app log of all days up to ``d`` (which must be there); the other days' folders are pruned."""
        self.log(d)
        days = [r.dt for r in tables.list_partitions(self.spark, f"{self.ods_root.rstrip('/')}/ods_log_inc").collect()]
        self._raw("ods_log_inc", [x for x in days if x <= d])
        return files.read_log(self.spark, self.ods_root).where(F.col("dt") <= F.lit(d))

    @contextlib.contextmanager
    def _layer(self):
        """Steps within run together, and all end before what follows; the first failure is raised then."""
        if self.together < 2 or self._pool is not None:
            yield
            return
        with ThreadPoolExecutor(self.together) as self._pool:
            try:
                yield
            finally:
                running, self._running, self._pool = self._running, [], None
                wait(running)
        for step in running:
            step.result()

    def _step(self, name: str, inputs: str, write: Callable[[], object], then: Callable[[], object] | None = None) -> None:
        """Writes, unless the step is done from the same inputs; ``then`` follows in either case."""
        day = self.day

        def run() -> None:
            if not (self.resume and self.steps.is_done(name, day, inputs)):
                self.steps.begin(name, day, inputs)
                write()
                self.steps.finish(name, day, inputs)
                self.ran.append((name, day))
            if then is not None:
                then()

        if self._pool is None:
            run()
        else:
            self._running.append(self._pool.submit(run))

    def _planned(self, make: Callable) -> tuple:
        """What ``make()`` gives, and the fingerprint of all that it reads."""
        self._read = {}
        try:
            return make(), fingerprint(self._read)
        finally:
            self._read = None

    def put(self, make: Callable[[], DataFrame], table: str, d: str | None = None) -> None:
        """One step: a table's day ``d``, or (first day) all days that the rows have."""
        df, inputs = self._planned(make)
        if d is not None:
            self._step(table, inputs, lambda: tables.overwrite_partition(df, self.path(table), d))
            return
        day, self.day = self.day, f"{self.day}-history"
        try:
            self._step(table, inputs, lambda: tables.overwrite_dynamic(df, self.path(table)))
        finally:
            self.day = day

    # ------------------------------------------------------------------ ODS
    def load_ods(self, d: str, landing_root: str) -> dict[str, bool]:
        """Landed files of day ``d`` (``<landing>/<table>/<d>/``) into the raw tables."""
        from emporia import schemas

        return {name: d in days for name, days in self.load_landed(landing_root, [d]).items()}

    def load_landed(self, landing_root: str, days: list[str] | None = None) -> dict[str, dict[str, bool]]:
        """S9/S10 for all tables: days with new files are made again from all their files, the others passed over.

        Returns table -> day -> whether it was loaded now: the days that ``run_day`` has to run (again) for.
        """
        from emporia import schemas

        names = [f"ods_{t}_full" for t in schemas.SNAPSHOTS] + [f"ods_{t}_inc" for t in schemas.CHANGE_DATA] + ["ods_log_inc"]
        return {n: landing.load_landed(self.spark, f"{landing_root.rstrip('/')}/{n}", f"{self.ods_root.rstrip('/')}/{n}", days) for n in names}

    def bootstrap(self, d: str, current_root: str) -> None:
        """The 13 change tables' current rows (``<current_root>/<table>``) as the raw changes of the first day.

        A day's raw changes are replaced, so a bootstrap may be run again. A missing table raises, unless it is ``quiet``.
        """
        from emporia import schemas

        at = int(_dt.datetime.fromisoformat(f"{d}T00:00:00+08:00").timestamp())
        for table in schemas.CHANGE_DATA:
            if table in self.quiet and not files.path_exists(self.spark, f"{current_root.rstrip('/')}/{table}"):
                continue
            rows = files.read_current(self.spark, current_root, table)
            tables.write_changes(files.snapshot_as_changes(rows, at, d), f"{self.ods_root}/ods_{table}_inc", d)

    # ------------------------------------------------------------------ DIM
    def load_date_dim(self, date_info_path: str) -> None:
        """The calendar from its prepared file, replacing the whole (unpartitioned) table."""
        tables.overwrite_table(files.read_date_info(self.spark, date_info_path), self.path("dim_date"))

    @_together
    def load_dims(self, d: str) -> None:
        self.day = d
        s = lambda t: self.snap(t, d)
        self.put(lambda: dim.sku_full(s("sku_info"), s("spu_info"), s("base_category3"), s("base_category2"),
                              s("base_category1"), s("base_trademark"), s("sku_attr_value"),
                              s("sku_sale_attr_value")), "dim_sku_full", d)
        self.put(lambda: dim.coupon_full(s("coupon_info"), s("base_dic")), "dim_coupon_full", d)
        self.put(lambda: dim.activity_full(s("activity_rule"), s("activity_info"), s("base_dic")), "dim_activity_full", d)
        self.put(lambda: dim.province_full(s("base_province"), s("base_region")), "dim_province_full", d)

    def load_user_zip(self, d: str, first_day: bool) -> None:
        """D6 / D7. A day's merge replaces two partitions that it read, so it is written beside first.

        That copy is named in the ledger while the two are replaced: a run that finds the step
        unfinished replaces them from the copy, and reads neither.
        """
        self.day = d
        if first_day:
            self.put(lambda: dim.user_zip_init(self.inc("user_info", [d]), d).drop("dt"), "dim_user_zip", OPEN)
            return
        prev = shift_date(d, -1)
        found = self.steps.entry("dim_user_zip", d)
        if found and found["state"] != DONE and found.get("copy") and files.path_exists(self.spark, f"{found['copy']}/_SUCCESS"):
            spliced = "gone" in self.spark.read.parquet(found["copy"]).columns
            self._replace_zipper(found["copy"], d, *(self._moved(found["copy"]) if spliced else (prev, OPEN)))
            self.steps.finish("dim_user_zip", d, found["inputs"])
            self.ran.append(("dim_user_zip", d))
        users, raw = self._planned(lambda: self.inc("user_info", [d]))
        inputs = fingerprint({"raw": raw, "before": self.steps.whole("dim_user_zip", None, prev)})
        if self.resume and self.steps.is_done("dim_user_zip", d, inputs):
            return
        newest = self.state("dim_user_zip", OPEN).agg(F.max("start_date")).first()[0]
        if newest and newest > d:
            self._splice_zipper(users, d, inputs)
            return
        zipper = self.read("dim_user_zip", [OPEN, prev])
        copy = scratch_folder(self.spark, "zipper")
        dim.user_zip(dim.zipper_before(zipper, d), users, d).write.parquet(copy)
        self.steps.begin("dim_user_zip", d, inputs, copy=copy)
        self._replace_zipper(copy, d, prev, OPEN)
        self.steps.finish("dim_user_zip", d, inputs)
        self.ran.append(("dim_user_zip", d))

    def _splice_zipper(self, users: DataFrame, d: str, inputs: str) -> None:
        """A day older than the newest version: its changes go in between, and only the days that this moves are written."""
        zipper = self.read("dim_user_zip")
        if zipper.agg(F.min("start_date")).first()[0] >= d:
            raise ValueError(f"dim_user_zip begins on {d} or later; the day can't be spliced in")
        copy = scratch_folder(self.spark, "zipper")
        dim.user_zip_splice(zipper, users.where(F.col("dt") == F.lit(d))).write.parquet(copy)
        self.steps.begin("dim_user_zip", d, inputs, copy=copy)
        self._replace_zipper(copy, d, *self._moved(copy))
        self.steps.finish("dim_user_zip", d, inputs)
        self.ran.append(("dim_user_zip", d))

    def _moved(self, copy: str) -> list[str]:
        return sorted(r.dt for r in self.spark.read.parquet(copy).select("dt").distinct().collect())

    def _replace_zipper(self, copy: str, d: str, *days: str) -> None:
        out = self.spark.read.parquet(copy)
        if "gone" in out.columns:  # a splice: rows of the days that it moves, some of them empty by now
            out = out.where("not gone").drop("gone")
        for day in days:
            tables.overwrite_partition(out.where(F.col("dt") == F.lit(day)).drop("dt"), self.path("dim_user_zip"), day)

    # ------------------------------------------------------------------ DWD
    @_together
    def load_dwd(self, d: str, first_day: bool) -> None:
        self.day = d
        prev = shift_date(d, -1)
        dic = lambda: self.snap("base_dic", d)
        prov = lambda: self.snap("base_province", d)
        log = lambda: self.logs_to(d) if first_day else self.log(d)
        fd = dict(first_day=first_day)
        target = None if first_day else d
        logged = None if first_day else d  # first day: all days of the log, each to its own partition
        self.put(lambda: dwd.trade_order_detail(self.inc("order_detail", [d]), self.inc("order_info", [d]),
                                        self.inc("order_detail_activity", [d]), self.inc("order_detail_coupon", [d]),
                                        dic(), d, **fd), "dwd_trade_order_detail_inc", target)
        self.put(lambda: dwd.trade_cart_add(self.inc("cart_info", [d]), dic(), d, **fd), "dwd_trade_cart_add_inc", target)
        self.put(lambda: dwd.trade_cart_full(self.snap("cart_info", d), d), "dwd_trade_cart_full", d)
        both = [d] if first_day else [prev, d]
        self.put(lambda: dwd.trade_cancel_detail(self.inc("order_detail", both), self.inc("order_info", both),
                                         self.inc("order_detail_activity", both),
                                         self.inc("order_detail_coupon", both), dic(), d, **fd),
                 "dwd_trade_cancel_detail_inc", target)
        self.put(lambda: dwd.trade_pay_detail(self.inc("order_detail", both), self.inc("order_info", both),
                                      self.inc("payment_info", [d]), self.inc("order_detail_activity", both),
                                      self.inc("order_detail_coupon", both), dic(), d, **fd),
                 "dwd_trade_pay_detail_suc_inc", target)
        self.put(lambda: dwd.trade_order_refund(self.inc("order_refund_info", [d]), self.inc("order_info", [d]), dic(), d, **fd),
                 "dwd_trade_order_refund_inc", target)
        self.put(lambda: dwd.trade_refund_pay(self.inc("refund_payment", [d]), self.inc("order_info", [d]),
                                      self.inc("order_refund_info", [d]), dic(), d, **fd),
                 "dwd_trade_refund_pay_suc_inc", target)
        coupon_use = lambda: self.inc("coupon_use", [d])
        self.put(lambda: dwd.tool_coupon_get(coupon_use(), d, **fd), "dwd_tool_coupon_get_inc", target)
        self.put(lambda: dwd.tool_coupon_order(coupon_use(), d, **fd), "dwd_tool_coupon_order_inc", target)
        self.put(lambda: dwd.tool_coupon_pay(coupon_use(), d, **fd), "dwd_tool_coupon_pay_inc", target)
        self.put(lambda: dwd.interaction_favor_add(self.inc("favor_info", [d]), d, **fd), "dwd_interaction_favor_add_inc", target)
        self.put(lambda: dwd.interaction_comment(self.inc("comment_info", [d]), dic(), d, **fd), "dwd_interaction_comment_inc", target)
        self.put(lambda: dwd.traffic_page_view(log(), prov(), logged, most=HOT_ROWS), "dwd_traffic_page_view_inc", target)
        self.put(lambda: dwd.traffic_start(log(), prov(), logged), "dwd_traffic_start_inc", target)
        self.put(lambda: dwd.traffic_action(log(), prov(), logged), "dwd_traffic_action_inc", target)
        self.put(lambda: dwd.traffic_display(log(), prov(), logged), "dwd_traffic_display_inc", target)
        self.put(lambda: dwd.traffic_error(log(), prov(), logged), "dwd_traffic_error_inc", target)
        self.put(lambda: dwd.user_login(log(), prov(), logged, most=HOT_ROWS), "dwd_user_login_inc", target)
        self.put(lambda: dwd.user_register(self.inc("user_info", [d]), log(), prov(), logged, **fd), "dwd_user_register_inc", target)

    # ------------------------------------------------------------------ DWS
    @_together
    def load_dws_1d(self, d: str, first_day: bool) -> None:
        self.day = d
        days = None if first_day else [d]
        target = None if first_day else d
        od = lambda: self.read("dwd_trade_order_detail_inc", days)
        sku = lambda: self.read("dim_sku_full", [d]).drop("dt")
        prov = lambda: self.read("dim_province_full", [d]).drop("dt")
        self.put(lambda: dws.trade_user_sku_order_1d(od(), sku()), "dws_trade_user_sku_order_1d", target)
        self.put(lambda: dws.trade_user_order_1d(od()), "dws_trade_user_order_1d", target)
        self.put(lambda: dws.trade_province_order_1d(od(), prov()), "dws_trade_province_order_1d", target)
        self.put(lambda: dws.trade_user_cart_add_1d(self.read("dwd_trade_cart_add_inc", days)), "dws_trade_user_cart_add_1d", target)
        refund = lambda: self.read("dwd_trade_order_refund_inc", days)
        self.put(lambda: dws.trade_user_sku_order_refund_1d(refund(), sku()), "dws_trade_user_sku_order_refund_1d", target)
        self.put(lambda: dws.trade_user_order_refund_1d(refund()), "dws_trade_user_order_refund_1d", target)
        self.put(lambda: dws.trade_user_payment_1d(self.read("dwd_trade_pay_detail_suc_inc", days)), "dws_trade_user_payment_1d", target)
        pv = lambda: self.read("dwd_traffic_page_view_inc", days)
        self.put(lambda: dws.traffic_session_page_view_1d(pv()), "dws_traffic_session_page_view_1d", target)
        self.put(lambda: dws.traffic_page_visitor_page_view_1d(pv()), "dws_traffic_page_visitor_page_view_1d", target)

    @_together
    def load_dws_nd(self, d: str) -> None:
        pairs = [
            ("dws_trade_user_sku_order_1d", "dws_trade_user_sku_order_nd", dws.trade_user_sku_order_nd),
            ("dws_trade_user_sku_order_refund_1d", "dws_trade_user_sku_order_refund_nd", dws.trade_user_sku_order_refund_nd),
            ("dws_trade_user_order_1d", "dws_trade_user_order_nd", dws.trade_user_order_nd),
            ("dws_trade_user_cart_add_1d", "dws_trade_user_cart_add_nd", dws.trade_user_cart_add_nd),
            ("dws_trade_user_payment_1d", "dws_trade_user_payment_nd", dws.trade_user_payment_nd),
            ("dws_trade_province_order_1d", "dws_trade_province_order_nd", dws.trade_province_order_nd),
            ("dws_trade_user_order_refund_1d", "dws_trade_user_order_refund_nd", dws.trade_user_order_refund_nd),
            ("dws_traffic_page_visitor_page_view_1d", "dws_traffic_page_visitor_page_view_nd",
             dws.traffic_page_visitor_page_view_nd),
        ]
        self.day = d
        for src, out, op in pairs:
            self.put(functools.partial(lambda op, src: op(self.window(src, d), d), op, src), out, d)
        od = lambda: self.window("dwd_trade_order_detail_inc", d)
        self.put(lambda: dws.trade_coupon_order_nd(od(), self.read("dim_coupon_full", [d]).drop("dt"), d),
                 "dws_trade_coupon_order_nd", d)
        self.put(lambda: dws.trade_activity_order_nd(od(), self.read("dim_activity_full", [d]).drop("dt"), d),
                 "dws_trade_activity_order_nd", d)

    @_together
    def load_dws_td(self, d: str, first_day: bool) -> None:
        self.day = d
        prev = shift_date(d, -1)
        if first_day:
            self.put(lambda: dws.trade_user_order_td_init(self.read("dws_trade_user_order_1d"), d), "dws_trade_user_order_td", d)
            self.put(lambda: dws.trade_user_payment_td_init(self.read("dws_trade_user_payment_1d"), d), "dws_trade_user_payment_td", d)
            users = lambda: self.read("dim_user_zip", [OPEN]).drop("dt")
            self.put(lambda: dws.user_login_td_init(users(), self.read("dwd_user_login_inc"), d), "dws_user_user_login_td", d)
            return
        self.put(lambda: dws.trade_user_order_td(self.state("dws_trade_user_order_td", prev),
                                         self.read("dws_trade_user_order_1d", [d]), d), "dws_trade_user_order_td", d)
        self.put(lambda: dws.trade_user_payment_td(self.state("dws_trade_user_payment_td", prev),
                                           self.read("dws_trade_user_payment_1d", [d]), d), "dws_trade_user_payment_td", d)
        self.put(lambda: dws.user_login_td(self.state("dws_user_user_login_td", prev), self.read("dwd_user_login_inc", [d]), d),
                 "dws_user_user_login_td", d)

    # ------------------------------------------------------------------ ADS
    def reports(self, d: str) -> dict[str, DataFrame]:
        prev = shift_date(d, -1)
        r = self.read
        today = lambda t: r(t, [d])
        out = {
            "ads_traffic_stats_by_channel": ads.traffic_stats_by_channel(self.window("dws_traffic_session_page_view_1d", d), d),
            "ads_page_path": ads.page_path(self.window("dwd_traffic_page_view_inc", d), d, most=HOT_ROWS),
            "ads_user_change": ads.user_change(today("dws_user_user_login_td"), self.state("dws_user_user_login_td", prev), d),
            "ads_user_retention": ads.user_retention(self.window("dwd_user_register_inc", d, 8), today("dws_user_user_login_td"), d),
            "ads_user_stats": ads.user_stats(self.window("dwd_user_register_inc", d), today("dws_user_user_login_td"), d),
            "ads_new_buyer_stats": ads.new_buyer_stats(today("dws_trade_user_order_td"), today("dws_trade_user_payment_td"), d),
            "ads_repeat_purchase_by_tm": ads.repeat_purchase_by_tm(today("dws_trade_user_sku_order_nd"), d),
            "ads_sku_cart_num_top3_by_cate": ads.sku_cart_num_top3_by_cate(
                today("dwd_trade_cart_full"), today("dim_sku_full").drop("dt"), d),
            "ads_order_by_province": ads.order_by_province(today("dws_trade_province_order_1d"),
                                                           today("dws_trade_province_order_nd"), d),
            "ads_coupon_stats": ads.coupon_stats(today("dws_trade_coupon_order_nd"), d),
            "ads_activity_stats": ads.activity_stats(today("dws_trade_activity_order_nd"), d),
        }
        args = (today("dws_trade_user_sku_order_1d"), today("dws_trade_user_sku_order_nd"),
                today("dws_trade_user_sku_order_refund_1d"), today("dws_trade_user_sku_order_refund_nd"), d)
        out["ads_trade_stats_by_tm"] = ads.trade_stats_by_tm(*args)
        out["ads_trade_stats_by_cate"] = ads.trade_stats_by_cate(*args)
        out["ads_trade_stats"] = ads.trade_stats(
            today("dws_trade_user_order_1d"), today("dws_trade_user_order_nd"),
            today("dws_trade_user_order_refund_1d"), today("dws_trade_user_order_refund_nd"), d)
        out["ads_user_action"] = ads.user_action(
            today("dws_traffic_page_visitor_page_view_1d"), today("dws_traffic_page_visitor_page_view_nd"),
            today("dws_trade_user_cart_add_1d"), today("dws_trade_user_cart_add_nd"),
            today("dws_trade_user_order_1d"), today("dws_trade_user_order_nd"),
            today("dws_trade_user_payment_1d"), today("dws_trade_user_payment_nd"), d)
        return out

    def load_ads(self, d: str) -> None:
        """R1–R16 and their publishing; a report is a step, and so is publishing it."""
        self.day = d
        made, inputs = self._planned(lambda: self.reports(d))
        with self._layer():
            for name, df in made.items():
                publish = functools.partial(self._publish, name, d, inputs) if self.publish_root else None
                self._step(name, inputs, functools.partial(tables.replace_report_day, self.spark, df, self.path(name), d), publish)

    def _publish(self, name: str, d: str, inputs: str) -> None:
        """S15, a step of its own, unless the report has no rows."""
        step = f"publish-{name}"
        if self.resume and self.steps.is_done(step, d, inputs):
            return
        rows = tables.read_table(self.spark, self.path(name), [d])
        self.steps.begin(step, d, inputs)
        if not tables.drop_empty(rows):
            tables.report_upsert(self.spark, rows, tables.table_path(self.publish_root, name), REPORT_KEYS[name], keep=2)
        self.steps.finish(step, d, inputs)
        self.ran.append((step, d))

    # --------------------------------------------------------------- chains
    def run_first_day(self, d: str, current_root: str | None = None) -> None:
        """Bootstrap — DIM, zipper init, DWD history fanned out by day, 1-day history, to-date init.

        ``current_root``: the change tables' exported current rows, from which the day's raw changes are made first.
        """
        if current_root:
            self.bootstrap(d, current_root)
        self.load_dims(d)
        self.load_user_zip(d, first_day=True)
        self.load_dwd(d, first_day=True)
        self.load_dws_1d(d, first_day=True)
        self.load_dws_td(d, first_day=True)

    def run_day(self, d: str) -> None:
        """One daily run, layers in dependency order."""
        self.load_dims(d)
        self.load_user_zip(d, first_day=False)
        self.load_dwd(d, first_day=False)
        self.load_dws_1d(d, first_day=False)
        self.load_dws_nd(d)
        self.load_dws_td(d, first_day=False)
        self.load_ads(d)


def main(argv: list[str] | None = None) -> None:
    """``python -m emporia.plans.daily --ods … --warehouse … --date 2020-06-15 [--first-day]``

    (on a cluster: ship the package with ``--py-files`` and call ``main()`` from the submitted script).
    """
    import argparse

    from emporia.session import get_session

    p = argparse.ArgumentParser(description="run one day of the warehouse chain")
    p.add_argument("--ods", required=True, help="raw tables root")
    p.add_argument("--warehouse", required=True, help="warehouse tables root")
    p.add_argument("--publish", default=None, help="published reports root")
    p.add_argument("--landing", default=None, help="landed files root (loaded into --ods first)")
    p.add_argument("--date", required=True, help="business date yyyy-MM-dd")
    p.add_argument("--first-day", action="store_true", help="bootstrap run")
    p.add_argument("--again", action="store_true", help="run every step, also those that are done")
    p.add_argument("--current", default=None, help="exported current rows of the change tables (first day: bootstrapped from them)")
    a = p.parse_args(argv)
    chain = Chain(get_session(), a.ods, a.warehouse, a.publish, resume=not a.again)
    if a.landing:
        chain.load_ods(a.date, a.landing)
    if a.first_day:
        chain.run_first_day(a.date, a.current)
    else:
        chain.run_day(a.date)


if __name__ == "__main__":
    main()
