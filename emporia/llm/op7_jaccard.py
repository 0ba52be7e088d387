"""Exact n-gram Jaccard join as a join in a metric space, with the linked components.

The Jaccard distance is a metric, and two documents link at a distance of ``RADIUS`` at most. Rows
with equal shingle sets are one point. Points go through two levels of pivots.

1. Cells around shingles. At a distance of RADIUS, two sets share one of the first
   floor(RADIUS * size) + 1 shingles of each in any common order. So each point is replicated to
   the cells of those shingles and no further. Shingles that a sample shows to be frequent come last
   in the order, which keeps passages that many documents share from forming cells.
   Of cells with the same members the first is kept. Two members of a cell are only compared if, this being the
   first shingle that both hold, what comes after it can be enough for a link.
2. Centres within a cell. Each point is weighed by the members of its cells: a text that many copies were made
   from shares more of its shingles than the copies do, so it meets the most points. A cell's centre is its
   heaviest point. Each point is measured against one centre at a time, the heaviest of its cells' whose component it
   isn't in yet, and after some rounds against all that are left. Members within RADIUS of a centre are linked through
   it, without a pair among themselves. Only pairs of members that are not in one component yet are joined further,
   and the triangle inequality leaves those whose distances from the centre differ by at most RADIUS. Cells that
   stay large take further centres, from their two largest components, and go round again. The pairs that are left in
   the end are measured so many at a time that their texts don't outgrow the input.

Before a pair is measured it is held against a bound: each set is folded into counts over ``FOLDS`` hash
classes, and the sum of the smaller counts is never below the intersection. Measured pairs are exact:
both texts are brought together and their shingle sets compared. A cell is
done when its members are in one component or all remaining pairs were measured, so no link that
joins two components is lost.

Defined results. NULL or empty text, or no word: no shingle, linked with nothing. Fewer words than a
shingle: the whole sequence is one. Repeated rows are one point; rows that share a doc_id but not
the text count as linked. An empty table gives no rows; extra columns are not looked at.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from emporia.llm.common import _MULT, Powers, discard, mix64, release_memory, sampled, staged, text_chunks, with_small_batches, word_hashes, worker_memory

WORDS = 5
#: Documents link at 100 * intersection >= PERCENT * union.
PERCENT = 80
RADIUS = 1 - PERCENT / 100
#: Hash classes of the bound on intersections.
FOLDS = 128
#: Bytes of text that are hashed at once.
STEP_BYTES = 256 << 10
#: Cells are formed in so many turns, each for its share of the shingles: the rows of one turn are on disk at a time.
TURNS = 4
#: Bounds of the sample (documents, and shingles of each) that only orders the shingles.
SAMPLE_DOCS, SAMPLE_SHINGLES = 20_000, 400
#: Cells with more unresolved members than this take further centres.
LEAF = 48
#: Rounds of further centres; what is left then is joined pair by pair, split as it is large.
ROUNDS = 3
#: Rounds in which a point is measured against one other, a centre first; the next one takes all that are left.
SINGLE = 3
#: Pairs that are measured at a time: as many as there are points, and no fewer than these.
LEAST_PAIRS = 50_000
#: Ids that are sent to every task to pick their rows, at most (8 MB); beyond it the rows are joined.
SENT = 1_000_000


def shingles(data: np.ndarray, at: np.ndarray, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the rows' distinct shingles, ordered within each row, and where each row starts."""
    words, row = word_hashes(data, at, powers)
    n = len(at) - 1
    count = np.bincount(row, minlength=n)
    start = np.cumsum(count) - count
    steps = np.ones(WORDS, np.uint64)
    steps[1:] = np.uint64(_MULT)
    steps = np.cumprod(steps)
    padded = np.concatenate([words, np.zeros(WORDS, np.uint64)])
    left = (start + count)[row] - np.arange(len(words))  # words of the row from here on
    code = np.zeros(len(words), np.uint64)
    for i in range(WORDS):
        code += np.where(left > i, padded[i : i + len(words)] * steps[i], np.uint64(i + 1))
    keep = (left >= WORDS) | ((np.arange(len(words)) == start[row]) & (count[row] < WORDS))
    code, row = mix64(code[keep]), row[keep]
    order = np.lexsort((code, row))
    code, row = code[order], row[order]
    first = np.ones(len(code), bool)
    first[1:] = (code[1:] != code[:-1]) | (row[1:] != row[:-1])
    code, row = code[first], row[first]
    return code, np.searchsorted(row, np.arange(n + 1))


def frequent_shingles(docs: DataFrame, text: str = "text", key: str = "doc_id") -> np.ndarray:
    """Shingles that two or more documents of a bounded sample hold; they only set an order."""
    def run(batches):
        import pyarrow as pa

        powers = Powers()
        for batch in batches:
            for _, data, at in text_chunks(batch, text, STEP_BYTES):
                code, start = shingles(data, at, powers)
                rank = np.arange(len(code)) - np.repeat(start[:-1], np.diff(start))
                yield pa.RecordBatch.from_arrays([pa.array(code[rank < SAMPLE_SHINGLES].view(np.int64))], names=["s"])

    some = sampled(docs.select(key, text).filter(F.col(text).isNotNull()), [key], SAMPLE_DOCS, 7)
    seen = some.select(text).mapInArrow(run, "s bigint").groupBy("s").count().filter("count >= 2")
    return np.sort(seen.select("s").toPandas()["s"].to_numpy().view(np.uint64))


def points(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per document: doc_id, n (shingles), two hashes of the set, its folded counts, and the shingles whose cells it goes to."""
    often = frequent_shingles(docs, text, key)

    def run(batches):
        import pyarrow as pa

        worker_memory("jaccard")
        powers = Powers()
        for batch in batches:
            keys = batch.column(batch.schema.get_field_index(key))
            for begin, data, at in text_chunks(batch, text, STEP_BYTES):
                code, start = shingles(data, at, powers)
                size = np.diff(start)
                row = np.repeat(np.arange(len(size)), size)
                sums = [np.zeros(len(size), np.uint64) for _ in range(2)]
                for s, salt in zip(sums, (1, 2), strict=True):
                    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(code + np.uint64(salt * _MULT & (1 << 63) - 1)))])
                    s[:] = total[start[1:]] - total[start[:-1]]
                last = np.zeros(len(code), bool)
                if len(often) and len(code):
                    last = often[np.minimum(np.searchsorted(often, code), len(often) - 1)] == code
                order = np.lexsort((code, last, row))  # frequent shingles of a row come last
                rank = np.arange(len(code)) - start[row]
                cells = code[order][rank < (size * (100 - PERCENT) // 100 + 1)[row]].view(np.int64)
                folds = np.bincount(row * FOLDS + (code >> np.uint64(40)).astype(np.int64) % FOLDS, minlength=len(size) * FOLDS)
                folds = folds.reshape(len(size), FOLDS).astype("<u4")
                width = np.where(size > 0, size * (100 - PERCENT) // 100 + 1, 0)
                ends = np.concatenate([[0], np.cumsum(width)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [keys.slice(begin, len(size)), pa.array(size.astype(np.int64)), *[pa.array(s.view(np.int64)) for s in sums],
                     pa.array([f.tobytes() for f in folds], pa.binary()), pa.ListArray.from_arrays(pa.array(ends), pa.array(cells))],
                    names=["doc_id", "n", "h1", "h2", "folds", "cells"])
        release_memory()

    rows = docs.select(F.col(key).cast("bigint").alias(key), text)
    return rows.mapInArrow(run, "doc_id bigint, n bigint, h1 bigint, h2 bigint, folds binary, cells array<bigint>")


def _needed(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """The rows (with ``id``) that some pair names: only these have to move."""
    ids = staged(rows.sparkSession, pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "ids")
    return rows.join(F.broadcast(ids) if ids.count() <= SENT else ids, "id", "left_semi")


def possible(pairs: DataFrame, folds: DataFrame) -> DataFrame:
    """The pairs (a, b) of a stored table whose folded counts allow a link. ``folds``: (id, n, folds)."""
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            n = sum(batch.column(i).to_numpy() for i in (2, 4))
            a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), "<u4").reshape(-1, FOLDS) for i in (3, 5))
            keep = (100 + PERCENT) * np.minimum(a, b).sum(axis=1, dtype=np.int64) >= PERCENT * n
            yield batch.select([0, 1]).filter(pa.array(keep))

    folds = _needed(folds, pairs)
    side = lambda x: folds.select(F.col("id").alias(x), F.col("n").alias(f"n{x}"), F.col("folds").alias(f"f{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "na", "fa", "nb", "fb")
    return both.mapInArrow(run, "a bigint, b bigint")


def counts_of(folds: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, counts): the folded counts of some ids as an array, for expressions."""
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            counts = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<i4")
            at = np.arange(batch.num_rows + 1, dtype=np.int32) * FOLDS
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(at), pa.array(counts))], names=["id", "counts"])

    return folds.join(ids.select("id").distinct(), "id", "left_semi").select("id", "folds").mapInArrow(run, "id bigint, counts array<int>")


def measured(pairs: DataFrame, docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(a, b, same, either): sizes of the intersection and the union for each pair of doc_ids of a stored table."""
    def run(batches):
        import pyarrow as pa

        worker_memory("jaccard")
        powers = Powers()
        for batch in batches:
            for begin in range(0, batch.num_rows, 128):
                part = batch.slice(begin, 128)
                both = []
                for side in ("ta", "tb"):
                    one = [(code[x:y]) for _, data, at in text_chunks(part, side, STEP_BYTES) for code, start in [shingles(data, at, powers)]
                           for x, y in zip(start[:-1], start[1:], strict=True)]
                    both.append(one)
                same = [len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(*both, strict=True)]
                either = [len(x) + len(y) - s for x, y, s in zip(*both, same, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(same, pa.int64()), pa.array(either, pa.int64())],
                                                 names=["a", "b", "same", "either"])
        release_memory()

    texts = _needed(docs.select(F.col(key).cast("bigint").alias("id"), F.col(text).alias("t")).filter(F.col("t").isNotNull()), pairs)
    pair = pairs.join(texts.select(F.col("id").alias("a"), F.col("t").alias("ta")), "a").join(texts.select(F.col("id").alias("b"), F.col("t").alias("tb")), "b")
    return pair.select("a", "b", "ta", "tb").mapInArrow(run, "a bigint, b bigint, same bigint, either bigint")


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(id, component): the smallest id that links (a, b) reach, for every id in a link.

    Large-star and small-star steps: each moves links to the smallest neighbour, until only stars
    are left. A hub's links are aggregated and joined, never gathered.
    """
    links = staged(spark, links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    mark = None
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
        before, links = links, staged(spark, small.select("e.u", "e.v").filter("u <> v").distinct(), "links")
        discard(before)
        now = tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == mark:
            break
        mark = now
    return links.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "id").unionByName(
        links.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())


def _near(a: str, b: str, at_a: str | None = None, at_b: str | None = None):
    """Whether two set sizes allow a link, where the first shingle that both hold stands at these places.

    What stands before it is in one set alone, so the intersection is in the rest of either. A pair that shares
    an earlier shingle is held against that one in its cell.
    """
    sizes = 100 * F.least(a, b) >= PERCENT * F.greatest(a, b)
    if at_a is None:
        return sizes
    return sizes & ((100 + PERCENT) * F.least(F.col(a) - F.col(at_a), F.col(b) - F.col(at_b)) >= PERCENT * (F.col(a) + F.col(b)))


def _is_link():
    return 100 * F.col("same") >= PERCENT * F.col("either")


def _centre(c: str) -> list:
    """The columns of a cell's centre, from the struct of a member."""
    return [F.col(f"{c}.{x}").alias("centre" if x == "id" else f"centre_{x}") for x in ("id", "n", "pos", "low")]


def _untried(pairs: DataFrame, tried: DataFrame) -> DataFrame:
    """The pairs (a, b) that were measured in neither order."""
    both = tried.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    return pairs.join(both, ["a", "b"], "left_anti")


def jaccard_components(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, and class_id, the smallest doc_id of its equal sets."""
    spark = with_small_batches(docs).sparkSession
    rows = staged(spark, points(docs, text, key), "points")
    one = rows.filter("n > 0").groupBy("n", "h1", "h2").agg(F.min("doc_id").alias("class_id"))
    classes = rows.select("doc_id", "n", "h1", "h2").join(one, ["n", "h1", "h2"], "left").select(
        "doc_id", "n", F.coalesce("class_id", "doc_id").alias("class_id"))
    classes = staged(spark, classes, "classes")
    reps = rows.filter("n > 0").join(classes.filter("doc_id = class_id").select("doc_id").distinct(), "doc_id", "left_semi")
    posts = staged(spark, reps.select(F.col("doc_id").alias("id"), "n", "cells"), "posts")
    folds = staged(spark, reps.select(F.col("doc_id").alias("id"), "n", "folds").dropDuplicates(["id"]), "folds")
    discard(rows)
    at_once = max(posts.count(), LEAST_PAIRS)
    posted = posts.select("id", "n", F.posexplode("cells").alias("pos", "cell"))
    shared = []  # the rows of cells with two or more; most shingles are one point's
    for turn in range(TURNS):
        some = posted.filter(F.pmod("cell", F.lit(TURNS)) == turn).withColumn("members", F.count(F.lit(1)).over(Window.partitionBy("cell")))
        shared.append(staged(spark, some.filter("members > 1"), "shared"))
    # low: the members of a point's cells, with a minus. What many copies were made from meets more points than the copies do
    posted = reduce(DataFrame.unionByName, shared).withColumn("low", -F.sum("members").over(Window.partitionBy("id"))).drop("members")
    posted = staged(spark, posted, "weighed")
    discard(posts, *shared)
    sets = posted.groupBy("cell").agg(F.min(F.struct("low", "id", "n", "pos")).alias("c"), F.count(F.lit(1)).alias("members"),
                                      *[F.bit_xor(F.xxhash64("id", F.lit(k))).alias(f"x{k}") for k in (1, 2)])
    first = F.min(F.struct(F.col("c.pos").alias("at"), "cell", "c")).alias("one")  # the first of them in the common order
    cells = sets.groupBy("members", "x1", "x2").agg(first).select("one.cell", F.col("one.c").alias("c"))
    cells = staged(spark, cells.select("cell", *_centre("c")), "cell-sets")
    weighed, posted = posted, staged(spark, posted.join(cells, "cell"), "cells")
    discard(cells, weighed)

    def measure(pairs: DataFrame, hold: bool = True) -> DataFrame:
        """The sizes for pairs of a stored table, ``at_once`` of them at a time: their texts are on disk together."""
        turns, out = -(-pairs.count() // at_once) or 1, []
        for turn in range(turns):
            some = pairs.filter(F.pmod(F.xxhash64("a", "b"), F.lit(turns)) == turn)
            some = staged(spark, possible(some, folds) if hold else some, "pairs")
            out.append(staged(spark, measured(some, docs, text, key), "measured"))
            discard(some)
        return reduce(DataFrame.unionByName, out)

    known = tried = group = None

    def merge(pairs: DataFrame, singles: int, hold: bool = True) -> None:
        """Measures pairs (a, b, low) until none is left between components; ``singles`` rounds take a point's first pair alone."""
        nonlocal known, tried, group
        pairs = staged(spark, pairs, "to-merge")
        done = None
        for turn in range(singles + 1):
            left = pairs
            if done is not None:
                left = left.join(done, ["a", "b"], "left_anti")
            if group is not None:
                name = lambda c: group.select(F.col("id").alias(c), F.col("component").alias(f"g_{c}"))
                left = left.join(name("a"), "a", "left").join(name("b"), "b", "left").filter(F.coalesce("g_a", "a") != F.coalesce("g_b", "b"))
            left = left.groupBy("a").agg(F.min(F.struct("low", "b")).alias("c")).select("a", "c.b") if turn < singles else left.select("a", "b")
            now = staged(spark, left, "next-pairs")
            if known is not None and now.isEmpty():
                break
            more = measure(now, hold)
            done = now if done is None else done.unionByName(now)
            tried = now if tried is None else tried.unionByName(now)
            known = more if known is None else known.unionByName(more)
            group = components(spark, known.filter(_is_link()).select("a", "b"))
        discard(pairs)

    to_centre = posted.filter("id <> centre").filter(_near("n", "centre_n", "pos", "centre_pos"))
    merge(to_centre.groupBy(F.col("id").alias("a"), F.col("centre").alias("b")).agg(F.min("centre_low").alias("low")), SINGLE)

    # Members of cells that are not in one component yet, with their distance from the cell's centre.
    def unresolved(members: DataFrame) -> DataFrame:
        named = members.join(group.select("id", F.col("component").alias("g")), "id", "left").withColumn("g", F.coalesce("g", "id"))
        split = named.groupBy("cell").agg(F.min("g").alias("g1"), F.max("g").alias("g2"), F.count(F.lit(1)).alias("members")).filter("g1 <> g2")
        return named.join(split.drop("g1", "g2"), "cell")

    member = ["cell", "id", "n", "pos", "low"]
    away = known.select(F.col("a").alias("id"), F.col("b").alias("centre"), (1 - F.col("same") / F.col("either")).alias("d"))
    rest = posted.join(away, ["id", "centre"], "left").select(*member, F.when(F.col("id") == F.col("centre"), F.lit(0.0)).otherwise(F.col("d")).alias("d"))
    rest = staged(spark, unresolved(rest), "unresolved")
    for turn in range(ROUNDS):
        wide = rest.filter(F.col("members") > LEAF)
        if wide.isEmpty():
            break
        by = F.col("low") if turn == 0 else F.xxhash64("id", F.lit(turn))
        of = wide.groupBy("cell", "g").agg(F.min(F.struct(by.alias("by"), "low", "id", "n", "pos")).alias("c"), F.count(F.lit(1)).alias("size"))
        of = staged(spark, of, "parts")
        # a member each of a cell's two largest components, for the members of its others
        largest = lambda parts: parts.groupBy("cell").agg(F.max(F.struct("size", "g", "c")).alias("p")).select("cell", "p.g", "p.c")
        one = largest(of)
        two = one.unionByName(largest(of.join(one, ["cell", "g"], "left_anti")))
        new = wide.select("cell", "id", "n", "pos", "g").join(two.select("cell", F.col("g").alias("cg"), *_centre("c")), "cell")
        new = new.filter(F.col("g") != F.col("cg")).filter(_near("n", "centre_n", "pos", "centre_pos"))
        new = new.select(F.greatest("id", "centre").alias("a"), F.least("id", "centre").alias("b")).distinct()
        new = staged(spark, _untried(new, tried), "pairs")
        if new.isEmpty():
            break
        tried = tried.unionByName(new)
        more = measure(new)
        known = known.unionByName(more)
        if more.filter(_is_link()).isEmpty():
            break
        group = components(spark, known.filter(_is_link()).select("a", "b"))
        rest = staged(spark, unresolved(rest.select(*member, "d")), "unresolved")

    left = rest.join(counts_of(folds, rest), "id").select("cell", "id", "n", "pos", "g", "d", "counts")
    left = staged(spark, left, "counted")
    right = left.select("cell", F.col("id").alias("b"), F.col("n").alias("nb"), F.col("pos").alias("pb"), F.col("g").alias("gb"), F.col("d").alias("db"),
                        F.col("counts").alias("counts_b"))
    pairs = left.join(right, "cell").filter((F.col("g") != F.col("gb")) & (F.col("id") > F.col("b"))).filter(_near("n", "nb", "pos", "pb"))
    pairs = pairs.filter(F.coalesce(F.abs(F.col("d") - F.col("db")) <= RADIUS + 1e-9, F.lit(True)))
    # the bound on intersections is held against a pair where it is made: few are left of a large group that isn't linked
    most = F.aggregate(F.zip_with("counts", "counts_b", lambda x, y: F.least(x, y)), F.lit(0), lambda s, x: s + x)
    pairs = pairs.filter((100 + PERCENT) * most >= PERCENT * (F.col("n") + F.col("nb")))
    pairs = staged(spark, _untried(pairs.select(F.col("id").alias("a"), "b").distinct(), tried), "pairs")
    if not pairs.isEmpty():
        # where points have many pairs each, most of them are in one component after a few of these
        merge(pairs.withColumn("low", F.lit(0)), SINGLE if pairs.count() > at_once else 0, hold=False)
    joined = classes.join(group.select(F.col("id").alias("class_id"), "component"), "class_id", "left")
    return joined.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "class_id").alias("component_id"), "class_id")


def op7_jaccard_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
