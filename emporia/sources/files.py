"""Raw-layer readers.

All readers pass an explicit schema (no inference) and return the table's
columns plus ``dt``. Paths follow the warehouse layout
``<root>/<table>/dt=<yyyy-MM-dd>/...``; ``dt`` is pinned to STRING through
``basePath`` + a string schema, because partition inference would make it a
DATE. Day filters on ``dt`` prune directories (``PartitionFilters``).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emporia import schemas


def _with_dt(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("dt", T.StringType(), True)])


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` exists on its file system (local, HDFS or object store)."""
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(jpath))


def hadoop_path(spark: SparkSession, path: str):
    """(the JVM, ``path`` as its path, the file system that holds it)."""
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, jpath, jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder that nothing reads any more; a missing one is as good."""
    _, jpath, fs = hadoop_path(spark, path)
    fs.delete(jpath, True)


def write_small(spark: SparkSession, path: str, text: str, replace: bool = True) -> None:
    """A small text file on any file system; without ``replace`` an existing one raises."""
    _, jpath, fs = hadoop_path(spark, path)
    out = fs.create(jpath, replace)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_small(spark: SparkSession, path: str) -> str | None:
    """Its text, or None if it isn't there."""
    jvm, jpath, fs = hadoop_path(spark, path)
    if not fs.exists(jpath):
        return None
    stream = fs.open(jpath)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def listing(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(name, bytes, time) of the data files right under a folder, in order; none if it is missing."""
    if not path_exists(spark, path):
        return []
    _, jpath, fs = hadoop_path(spark, path)
    found = [(s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(jpath) if s.isFile()]
    return sorted(f for f in found if not f[0].startswith(("_", ".")))


def _paths(root: str, table: str, days: Iterable[str] | None) -> tuple[list[str], str]:
    base = f"{root.rstrip('/')}/{table}"
    if days is None:
        return [base], base
    return [f"{base}/dt={d}" for d in days], base


def _load(spark: SparkSession, reader, schema: T.StructType, paths: list[str], may_be_absent: bool = False) -> DataFrame:
    """Read the day folders. A missing one is an error, unless the caller knows of days without rows."""
    present = [p for p in paths if path_exists(spark, p)]
    if len(present) < len(paths) and not may_be_absent:
        raise FileNotFoundError(f"raw input not loaded: {sorted(set(paths) - set(present))}")
    if not present:
        return spark.createDataFrame([], schema)
    return reader(present)


def read_snapshot(spark: SparkSession, root: str, table: str, days: Iterable[str] | None = None) -> DataFrame:
    """A daily full snapshot — tab-delimited (gzip or plain), empty field = NULL."""
    schema = _with_dt(schemas.struct_of(schemas.SNAPSHOTS[table]))
    paths, base = _paths(root, f"ods_{table}_full", days)
    reader = (
        spark.read.schema(schema)
        .option("sep", "\t")
        .option("nullValue", "")
        .option("basePath", base)
        .option("mode", "PERMISSIVE")
    )
    return _load(spark, reader.csv, schema, paths)


def read_changes(spark: SparkSession, root: str, table: str, days: Iterable[str] | None = None,
                 may_be_absent: bool = False) -> DataFrame:
    """Change records ``{type, ts, data, old}`` (one JSON object per line).

    ``may_be_absent``: a day's folder may be missing, which then means a day without changes.
    """
    schema = _with_dt(schemas.struct_of(schemas.change_schema(table)))
    paths, base = _paths(root, f"ods_{table}_inc", days)
    return _load(spark, spark.read.schema(schema).option("basePath", base).json, schema, paths, may_be_absent)


def read_log(spark: SparkSession, root: str, days: Iterable[str] | None = None) -> DataFrame:
    """S3: the nested app log; missing keys become NULL, key order is irrelevant."""
    schema = _with_dt(schemas.struct_of(schemas.LOG))
    paths, base = _paths(root, "ods_log_inc", days)
    return _load(spark, spark.read.schema(schema).option("basePath", base).json, schema, paths)


def read_date_info(spark: SparkSession, path: str) -> DataFrame:
    """The prepared calendar file (tab-delimited) behind the calendar dimension's staging table."""
    schema = schemas.struct_of(schemas.DATE_INFO)
    return spark.read.schema(schema).option("sep", "\t").option("nullValue", "").csv(path)


def normalize_types(df: DataFrame) -> DataFrame:
    """Source → warehouse types.

    Every integral type becomes BIGINT; decimal, char/varchar, date and
    timestamp become STRING (decimals keep their exact text); double and
    float stay; everything else is unchanged.
    """
    cols = []
    for f in df.schema.fields:
        t = f.dataType
        c = F.col(f"`{f.name}`")
        if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            c = c.cast("bigint")
        elif isinstance(t, (T.DecimalType, T.CharType, T.VarcharType, T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")
        cols.append(c.alias(f.name))
    return df.select(*cols)


BOOTSTRAP = "bootstrap-insert"
#: Types that carry a row's state (a deletion doesn't).
STATE_TYPES = ("insert", "update", BOOTSTRAP)


def read_current(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A change table's current rows as the source exports them (tab-delimited, empty = NULL), for the bootstrap."""
    schema = schemas.struct_of(schemas.CHANGE_DATA[table])
    path = f"{root.rstrip('/')}/{table}"
    if not path_exists(spark, path):
        raise FileNotFoundError(f"current rows not exported: {path}")
    return spark.read.schema(schema).option("sep", "\t").option("nullValue", "").csv(path)


def current_rows(changes: DataFrame, within: str | None = None) -> DataFrame:
    """The table as it stands after its changes: the payload of each id's latest change.

    Changes of one second are ordered by their content, so the answer doesn't depend on how they lie in
    files. The latest is an aggregate, combined before the shuffle: an id may have any number of changes.
    ``within``: a payload field that all changes of an id agree in; rows that lie together by it don't move.
    """
    keys = ["id"] if within is None else [within, "id"]
    rest = [f.name for f in changes.schema["data"].dataType.fields if f.name not in keys]
    kept = changes.where(F.col("type").isin(*STATE_TYPES))
    latest = kept.groupBy(*[F.col(f"data.{k}").alias(k) for k in keys]).agg(
        F.max(F.struct("ts", *[F.col(f"data.{c}").alias(c) for c in rest])).alias("__m"))
    return latest.select(*[F.col(c if c in keys else f"__m.{c}") for c in changes.schema["data"].dataType.names])


def snapshot_as_changes(df: DataFrame, ts_seconds: int, dt: str) -> DataFrame:
    """First-day bootstrap — each current row becomes a ``bootstrap-insert`` change."""
    data_cols = [c for c in df.columns if c != "dt"]
    return df.select(
        F.lit(BOOTSTRAP).alias("type"),
        F.lit(ts_seconds).cast("bigint").alias("ts"),
        F.struct(*[F.col(f"`{c}`") for c in data_cols]).alias("data"),
        F.lit(None).cast("map<string,string>").alias("old"),
        F.lit(dt).alias("dt"),
    )
