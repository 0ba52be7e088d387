"""SimHash near-duplicates, joined by pigeonring filtering.

A fingerprint's 64 bits are a ring of ``SEGMENTS`` segments. If two fingerprints differ in ``BITS`` bits
at most, then some segment starts a chain in which, for every length l, the first l segments differ in
less than l * (BITS + 1) / SEGMENTS bits altogether: with four segments of 16 bits and three bits, in
0, 1, 2 and 3 bits. (Plain pigeonholing asks for the first of these budgets alone.)

1. Equal fingerprints are one point, whatever the number of their documents.
2. The first two budgets are looked up: each point is posted under each start, its segment there, and
   the next segment with one bit left out, each bit in turn. So two points of a chain meet under a key of
   31 bits, and unrelated ones hardly ever.
3. Pairs under a key are held against the third budget, then against the full distance.

A key that many near copies share is not joined with itself. Its smallest and largest points are centres,
to which all its points are compared; then only points outside the key's largest component are compared
with those of other components. What is left out are links between points that are known to be connected.

Defined results. NULL or empty text, or no word: fingerprint zero, which links like any other. Fewer
than three words: the whole sequence is the one shingle. Repeated rows are rows of the result each; a
NULL doc_id is never a component's name unless the component has no other. An empty table gives no
rows; extra columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emporia.llm.common import _IS_SPACE, _LOWER, staged, text_chunks, with_small_batches, word_spans
from emporia.llm.op7_jaccard import components

WORDS, SEED = 3, 42
#: Fingerprints link at so many differing bits at most.
BITS = 3
SEGMENTS, WIDTH = 4, 16
#: Points that one task posts (64 rows of 16 bytes each).
POINTS = 16_384
#: Shingles whose bits are counted at once.
_STEP = 1 << 16


def shingle_hashes(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of every row's shingles, repeats included, and where each row's begin, the end appended."""
    import xxhash

    low = _LOWER[data]
    start, end = word_spans(low, at)
    n = len(at) - 1
    row = np.searchsorted(at, start, "right") - 1
    count = np.bincount(row, minlength=n)
    first = np.cumsum(count) - count
    # the words with one space between them, so that a shingle is one slice
    solid = ~_IS_SPACE[low]
    keep = solid.copy()
    keep[1:] |= solid[:-1]
    text = np.where(solid, low, np.uint8(32))[keep].tobytes()
    place = np.cumsum(keep)
    begin = place[start] - 1
    stop = begin + (end - start)
    last = np.minimum(np.arange(len(start)) + WORDS, (first + count)[row]) - 1
    whole = (last - np.arange(len(start)) == WORDS - 1) | (np.arange(len(start)) == first[row])
    digest = xxhash.xxh64_intdigest
    spans = zip(begin[whole].tolist(), stop[last[whole]].tolist(), strict=True)
    codes = np.fromiter((digest(text[a:b], SEED) for a, b in spans), np.uint64, int(whole.sum()))
    return codes, np.searchsorted(row[whole], np.arange(n + 1))


def majority(codes: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Per row, the bits that are set in over half of its codes (no code: zero)."""
    n = len(start) - 1
    size = np.diff(start)
    row = np.repeat(np.arange(n), size)
    total = np.zeros((n, 64), np.int64)
    for a in range(0, len(codes), _STEP):
        bits = np.unpackbits(codes[a : a + _STEP].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        rows = row[a : a + _STEP]
        firsts = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
        total[rows[firsts]] += np.add.reduceat(bits, firsts, axis=0, dtype=np.int32)
    return np.packbits(2 * total > size[:, None], axis=1, bitorder="little").view("<u8").reshape(-1)


def fingerprints(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, fp): each row's fingerprint as a long."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            keys = batch.column(batch.schema.get_field_index(key))
            for first, data, at in text_chunks(batch, text):
                made = majority(*shingle_hashes(data, at)).view(np.int64)
                yield pa.RecordBatch.from_arrays([keys.slice(first, len(made)), pa.array(made)], names=["doc_id", "fp"])

    rows = docs.select(F.col(key).cast("bigint").alias(key), text)
    return with_small_batches(rows).mapInArrow(run, "doc_id bigint, fp bigint")


def _turned(c: str, start: str) -> str:
    """The ring read from segment ``start`` on (a shift by 64 is none)."""
    return f"(shiftrightunsigned({c}, {WIDTH} * ({start})) | shiftleft({c}, 64 - {WIDTH} * ({start})))"


def chain_keys(c: str) -> Column:
    """The keys under which a point is posted: start, left-out bit, and the two segments without that bit."""
    two = f"{_turned(c, f'k div {WIDTH}')} & {(1 << 2 * WIDTH) - 1}L"
    out = f"shiftleft(1L, {WIDTH} + k % {WIDTH})"
    return F.expr(f"transform(sequence(0, {SEGMENTS * WIDTH - 1}), k -> shiftleft(cast(k as bigint), {2 * WIDTH}) | ({two} & ~{out}))")


def near(x: str, y: str, key: str) -> Column:
    """The chain that starts where ``key`` says keeps its third budget, and the whole ring its last."""
    three = f"bit_count(({_turned(f'({x} ^ {y})', f'cast(shiftright({key}, {2 * WIDTH}) div {WIDTH} as int)')}) & {(1 << 3 * WIDTH) - 1}L)"
    return F.expr(f"{three} <= {BITS - 1} and bit_count({x} ^ {y}) <= {BITS}")


def shared_keys(posted: DataFrame) -> DataFrame:
    """(key, fp, low, high): the postings under keys that two points or more share, with the key's smallest and largest point.

    Spark takes the postings of an explode for as large as the points that they are made from, so it would send all
    of them to every executor through the driver: the join's kind is named.
    """
    ends = posted.groupBy("key").agg(F.min("fp").alias("low"), F.max("fp").alias("high")).filter("low < high")
    return posted.join(ends.hint("merge"), "key")


def linked(spark: SparkSession, points: DataFrame) -> DataFrame:
    """(id, component) of the points (distinct ``fp``) that link with another one."""
    # a point becomes 64 postings: the points are dealt out so that a task makes a bounded number of them
    parts = -(-points.count() // POINTS) or 1
    posted = points.repartition(parts).select("fp", F.explode(chain_keys("fp")).alias("key"))
    shared = staged(spark, shared_keys(posted), "shared-keys")
    centre = F.explode(F.array("low", "high"))
    stars = shared.select("fp", "key", centre.alias("c")).filter(F.col("fp") != F.col("c")).filter(near("fp", "c", "key"))
    stars = staged(spark, stars.select(F.greatest("fp", "c").alias("a"), F.least("fp", "c").alias("b")).distinct(), "stars")
    group = components(spark, stars)

    named = shared.join(group.select(F.col("id").alias("fp"), F.col("component").alias("g")), "fp", "left")
    named = staged(spark, named.select("key", "fp", F.coalesce("g", "fp").alias("g")), "named")
    sizes = named.groupBy("key", "g").agg(F.count(F.lit(1)).alias("n"))
    main = sizes.groupBy("key").agg(F.max(F.struct("n", "g")).alias("m"), F.count(F.lit(1)).alias("parts")).filter("parts > 1")
    split = staged(spark, named.join(main.select("key", F.col("m.g").alias("main")), "key"), "split-keys")
    few = split.filter("g <> main").select("key", F.col("fp").alias("a"), F.col("g").alias("ga"))
    every = split.select(F.col("key").alias("k"), F.col("fp").alias("b"), F.col("g").alias("gb"), "main")
    apart = F.expr("key = k and ga <> gb and (gb = main or a < b)") & near("a", "b", "key")
    more = few.join(every, apart).select("a", "b").distinct()
    more = staged(spark, more, "links")
    if more.isEmpty():
        return group
    return components(spark, stars.unionByName(more))


def simhash_components(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id, class_id (smallest doc_id of the same fingerprint)."""
    spark = docs.sparkSession
    rows = staged(spark, fingerprints(docs, text, key), "fingerprints")
    points = staged(spark, rows.groupBy("fp").agg(F.min("doc_id").alias("class_id")), "points")
    named = points.join(linked(spark, points.select("fp")).select(F.col("id").alias("fp"), F.col("component").alias("g")), "fp", "left")
    named = named.select("fp", "class_id", F.coalesce("g", "fp").alias("g"))
    least = named.groupBy("g").agg(F.min("class_id").alias("component_id"))
    classes = staged(spark, named.join(least, "g").select("fp", "class_id", "component_id"), "classes")
    shown = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return rows.join(classes, "fp").select("doc_id", shown.alias("fingerprint"), "component_id", "class_id")


def op13_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
