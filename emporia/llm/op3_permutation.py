"""Approximate nearest neighbours by a permutation index.

Pivots are a bounded sample of the vectors. Every vector is represented by the order of its
``ORDER`` nearest pivots, and posted to the pivot inverted files of its ``POSTED`` nearest ones, each
split into blocks of at most about ``BLOCK`` entries. A query visits the files of its ``VISITED`` nearest
pivots, ranks their entries by Spearman's distance between the orders (the sum of squared differences
of ranks; a pivot that is missing from an order has rank ORDER), and reranks the nearest ``RERANKED``
share of each block, and never fewer than asked for, by the exact inner product in double precision.
Spearman's distance is a product of the rank vectors but for their own lengths, so the queries and
entries of a block are ranked together, by one product of matrices.

Pivots are compared by inner product after division by the vector's length, so the order does not
depend on it; for the exact measure the original vectors count. An entry posted to several
visited files is ranked in the first of them only. Queries and blocks meet by an equi-join on the
file, in groups of bounded size on either side. A file that holds a third of all vectors is many blocks.

Defined results. Vectors that are NULL, zero, of another length than most, or with a NULL or
non-finite component take no part, as queries or as candidates. Ties go to the smaller vec_id.
Repeated rows (same vec_id) are one vector. With fewer candidates than asked for, all are returned.
An empty table gives no rows; extra columns are not looked at.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from emporia.llm.common import sampled, staged

PIVOTS = 128
ORDER = 64
POSTED = 4
VISITED = 64
RERANKED = 0.1
BLOCK = 4096
#: Queries that a group holds at most, about (entries are dealt out once for each), and that are ranked at once.
QUERIES, AT_ONCE = 8192, 128


def usable(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, v): one row per id that has a finite, non-zero vector of the table's usual length."""
    v = F.col(vector)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.filter(F.col(key).isNotNull() & v.isNotNull() & (F.size(v) > 0) & fine)
    rows = rows.select(F.col(key).cast("bigint").alias("id"), v.cast("array<double>").alias("v")).groupBy("id").agg(F.min("v").alias("v"))
    usual = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.filter(F.size("v") == (usual["n"] if usual else 0))


def _orders(unit: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Ranks of all pivots for each vector, ORDER for those beyond its nearest ORDER."""
    near = np.argsort(-(unit @ pivots.T), axis=1, kind="stable")[:, : min(ORDER, len(pivots))]
    ranks = np.full((len(unit), len(pivots)), ORDER, np.int16)
    np.put_along_axis(ranks, near, np.arange(near.shape[1], dtype=np.int16)[None, :], axis=1)
    return ranks


def ordered(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    """(id, v, near): the numbers of the nearest pivots in order, as bytes are not needed beyond 32768."""
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            v = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, pivots.shape[1])
            ranks = _orders(v / np.linalg.norm(v, axis=1, keepdims=True), pivots)
            near = np.argsort(ranks, axis=1, kind="stable")[:, : min(ORDER, len(pivots))].astype(np.int16)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(list(near), pa.list_(pa.int16()))], names=["id", "v", "near"])

    return rows.mapInArrow(run, "id bigint, v array<double>, near array<smallint>")


def nearest(vectors: DataFrame, k: int = 20, is_query=None, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each query by inner product."""
    spark = vectors.sparkSession
    rows = staged(spark, usable(vectors, key, vector), "vectors")
    schema = "query_id bigint, vec_id bigint, score double"
    # Fitted on a bounded sample: PIVOTS of some more vectors that are chosen by a hash of their id.
    sample = sampled(rows, ["id"], 2 * PIVOTS, 5).orderBy(F.xxhash64("id", F.lit(5)), "id").limit(PIVOTS).select("v").collect()
    if not sample:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    pivots = np.array([r.v for r in sample], float)
    pivots = np.unique(pivots / np.linalg.norm(pivots, axis=1, keepdims=True), axis=0)
    index = staged(spark, ordered(rows, pivots), "orders")
    query = is_query if is_query is not None else F.pmod(F.col("id"), F.lit(20)) == 0
    asked = index.filter(query)
    n_posted, n_visited = min(POSTED, len(pivots)), min(max(VISITED, 1), len(pivots))

    entries = index.select("id", "v", "near", F.explode(F.slice("near", 1, n_posted)).alias("file"))
    sizes = entries.groupBy("file").agg(F.count(F.lit(1)).alias("n"))
    lots = {r.file: max(1, -(-r.n // BLOCK)) for r in sizes.collect()}  # one row per pivot
    groups = max(1, -(-asked.count() // QUERIES))
    table = F.create_map(*[F.lit(x) for f, n in lots.items() for x in (f, n)])
    lot = F.pmod(F.xxhash64("id"), F.element_at(table, F.col("file").cast("int")).cast("bigint")).cast("int")
    side = F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("part")
    entries = entries.select("id", "v", "near", F.col("file").cast("int").alias("file"), lot.alias("lot")).select("*", side)
    visits = asked.select("id", "v", "near", F.explode(F.slice("near", 1, n_visited).cast("array<int>")).alias("file"),
                          F.pmod(F.xxhash64("id"), F.lit(groups).cast("bigint")).cast("int").alias("part"))
    visits = visits.filter(F.col("file").isin(*lots) if len(lots) < len(pivots) else F.lit(True))
    visits = visits.withColumn("lot", F.explode(F.sequence(F.lit(0), (F.element_at(table, F.col("file")) - 1).cast("int"))))
    n_pivots = len(pivots)

    def rank(left, right):
        import pyarrow as pa

        def side_of(t):
            near = t.column("near").combine_chunks().flatten().to_numpy().astype(np.int64).reshape(t.num_rows, -1)
            ranks = np.full((t.num_rows, n_pivots), ORDER, np.int16)
            np.put_along_axis(ranks, near, np.arange(near.shape[1], dtype=np.int16)[None, :], axis=1)
            v = t.column("v").combine_chunks().flatten().to_numpy().reshape(t.num_rows, -1)
            return t.column("id").to_numpy(), v, near, ranks

        if not left.num_rows or not right.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        file = left.column("file")[0].as_py()
        ids, v, near, ranks = side_of(right)
        order = np.argsort(ids)
        ids, v, near, ranks = ids[order], v[order], near[order], ranks[order]
        qids, qv, qnear, qranks = side_of(left)
        posted, low = near[:, :n_posted], ranks.astype(np.float32)
        own_length = (low * low).sum(axis=1)
        kept = min(len(ids), max(k + 1, int(np.ceil(RERANKED * len(ids)))))
        out = []
        for begin in range(0, len(qids), AT_ONCE):
            part = slice(begin, begin + AT_ONCE)
            seen = np.zeros((len(qids[part]), n_pivots), bool)
            np.put_along_axis(seen, qnear[part, :n_visited], True, axis=1)
            # an entry counts in the first of its files that the query visits
            first = np.full((len(seen), len(ids)), -1, np.int16)
            for i in reversed(range(posted.shape[1])):
                first = np.where(seen[:, posted[:, i]], posted[:, i].astype(np.int16), first)
            far = own_length - 2 * (qranks[part].astype(np.float32) @ low.T)  # exact: whole numbers below 2^24
            far[(first != file) | (qids[part][:, None] == ids)] = np.inf
            some = np.argpartition(far, kept - 1, axis=1)[:, :kept]
            for q, one, own, d in zip(qids[part], qv[part], some, np.take_along_axis(far, some, axis=1), strict=True):
                own = own[d < np.inf]
                score = np.array([float(np.dot(x, one)) for x in v[own]]) if len(own) < 8 else np.einsum("ij,j->i", v[own], one)
                best = np.lexsort((ids[own], -score))[:k]
                out.append((np.full(len(best), q), ids[own][best], score[best]))
        return pa.table({n: np.concatenate(c) for n, c in zip(("query_id", "vec_id", "score"), zip(*out, strict=True), strict=True)})

    found = visits.groupBy("file", "lot", "part").cogroup(entries.groupBy("file", "lot", "part")).applyInArrow(rank, schema)
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    found = found.withColumn("rank", place).filter(F.col("rank") <= k)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op3_permutation_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))
