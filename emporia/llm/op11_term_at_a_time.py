"""Ranked lexical search, term at a time with limited accumulators.

1. The items' distinct terms are a vocabulary. One pass over the texts keeps, per document, its number of
   terms and the vocabulary's terms in it with their occurrences; that table is written. N, L and the
   document frequencies are sums over it.
2. Each task turns its documents into blocks of posting lists. An item's terms are taken rarest first; a
   term's list adds to the accumulators of its documents, and creates those that are missing. A term's
   bound is its weight times the largest impact of its list in the block. Once the bounds of the terms
   left add up to less than the kth best score so far (of the block, or of the task's blocks before), no
   document without an accumulator can come in, so none is created any more, and the remaining
   (longest) lists only update those that are there, exactly.
3. A task leaves k documents an item; they are merged in two steps.

Items are taken in blocks of a bounded number of terms, each held against all documents. Terms are looked
up by a 64-bit hash and compared byte by byte, so the result is exact.

Defined results. NULL or empty text, or one without a term: never ranked, and not counted in N. An item
without terms, or whose terms occur nowhere: no rows. Rows that share an item_id are one item with the terms
of all. Repeated documents are ranked each; equal scores go by doc_id, NULL last. Extra columns are not
looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from emporia.llm.common import _LOWER, Powers, span_hashes, staged, text_chunks, with_small_batches, word_spans
from emporia.llm.parts import spread

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Documents returned for each item.
BEST = 50
#: (Item, term) pairs that one pass over the documents serves.
ITEM_TERMS = 500_000
#: Postings of a block (about 40 bytes each in a task).
BLOCK = 2_000_000
#: Tasks whose findings are merged first.
MERGED = 500

_UPPER, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BREAKS = np.ones(256, bool)
_BREAKS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def item_terms(items: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, term): the distinct terms of each item."""
    low = F.translate(F.col(text), _UPPER, _SMALL)
    found = F.explode(F.regexp_extract_all(low, F.lit(TERM), F.lit(0)))
    return items.select(F.col(item).alias("item_id"), found.alias("term")).distinct()


class Vocabulary:
    """Terms (bytes, distinct) by hash; ``number`` gives the index of each span's term, or -1."""

    def __init__(self, terms: list[bytes]):
        self.powers = Powers()
        at = np.concatenate([[0], np.cumsum([len(t) for t in terms])]).astype(np.int64)
        flat = np.frombuffer(b"".join(terms), np.uint8)
        codes = span_hashes(flat, at[:-1], at[1:], self.powers) if terms else np.zeros(0, np.uint64)
        self.index = np.argsort(codes, kind="stable")
        self.codes = codes[self.index]
        if (self.codes[1:] == self.codes[:-1]).any():
            raise ValueError("two terms share a hash")
        self.flat, self.start, self.size = flat, at[:-1], np.diff(at)

    def number(self, low: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        out = np.full(len(start), -1, np.int64)
        if not len(self.codes) or not len(start):
            return out
        codes = span_hashes(low, start, end, self.powers)
        place = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        hit = np.flatnonzero(self.codes[place] == codes)
        term = self.index[place[hit]]
        same_size = self.size[term] == (end - start)[hit]
        hit, term = hit[same_size], term[same_size]
        if len(hit):
            own, size = low[spread(start[hit], self.size[term])], self.size[term]
            differs = own != self.flat[spread(self.start[term], size)]
            same = np.add.reduceat(differs, np.cumsum(size) - size) == 0
            out[hit[same]] = term[same]
        return out


def postings(docs: DataFrame, terms: list[bytes], text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per document with a term: doc_id, n (its terms), and the vocabulary's terms in it with their occurrences."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        vocabulary = Vocabulary(terms)
        for batch in batches:
            keys = batch.column(batch.schema.get_field_index(key))
            for first, data, at in text_chunks(batch, text):
                low = _LOWER[data]
                start, end = word_spans(low, at, _BREAKS)
                row = np.searchsorted(at, start, "right") - 1
                n = np.bincount(row, minlength=len(at) - 1)
                number = vocabulary.number(low, start, end)
                known = number >= 0
                pair, tf = np.unique(row[known] * max(len(terms), 1) + number[known], return_counts=True)
                row, number = np.divmod(pair, max(len(terms), 1))
                some = np.flatnonzero(n)
                ends = np.concatenate([[0], np.searchsorted(row, some, "right")]).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(v.astype(np.int32))) for v in (number, tf)]
                yield pa.RecordBatch.from_arrays([keys.slice(first, len(n)).take(pa.array(some)), pa.array(n[some]), *lists], names=["doc_id", "n", "terms", "tfs"])

    rows = docs.select(F.col(key).cast("bigint").alias(key), text)
    return with_small_batches(rows).mapInArrow(run, "doc_id bigint, n bigint, terms array<int>, tfs array<int>")


class Best:
    """The k best (score, doc_id) seen, best first; a NULL doc_id counts as the largest."""

    def __init__(self, k: int):
        self.k = k
        self.score = np.zeros(0, np.int64)
        self.doc = np.zeros(0, np.int64)
        self.null = np.zeros(0, bool)

    def bar(self) -> int:
        """The kth best score: what scores less is out."""
        return int(self.score[-1]) if len(self.score) == self.k else 0

    def add(self, score: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        if len(score) > self.k:
            least = np.partition(score, len(score) - self.k)[len(score) - self.k]
            top = score >= least
            score, doc, null = score[top], doc[top], null[top]
        score, doc, null = np.concatenate([self.score, score]), np.concatenate([self.doc, doc]), np.concatenate([self.null, null])
        order = np.lexsort((doc, null, -score))[: self.k]
        self.score, self.doc, self.null = score[order], doc[order], null[order]


def search_block(lists: dict, plan: list, best: Best, doc: np.ndarray, null: np.ndarray) -> int:
    """Adds a block's documents to an item's best; returns the number of accumulators created.

    ``lists``: term -> (documents of the block, impacts, largest impact). ``plan``: (term, weight), rarest first.
    """
    there = [(weight, *lists[term]) for term, weight in plan if weight and term in lists]
    if not there:
        return 0
    bounds = np.array([weight * most for weight, _, _, most in there], np.int64)
    left = np.cumsum(bounds[::-1])[::-1]  # of this list and those after it
    score = np.zeros(len(doc), np.int64)
    created = np.zeros(len(doc), bool)
    creating, n, bar = True, 0, best.bar()
    for (weight, rows, impact, _), rest in zip(there, left.tolist(), strict=True):
        if creating and n >= best.k:
            some = score[created]
            bar = max(bar, int(np.partition(some, len(some) - best.k)[len(some) - best.k]))
        if creating and rest < bar:
            creating = False
        if not creating:
            mine = created[rows]
            rows, impact = rows[mine], impact[mine]
        score[rows] += weight * impact
        if creating:
            created[rows] = True
            n = int(np.count_nonzero(created))
    found = np.flatnonzero(created & (score > 0) & (score >= bar))
    best.add(score[found], doc[found], null[found])
    return n


def _blocks(batches: Iterator) -> Iterator:
    """Arrow batches of postings, joined to blocks."""
    import pyarrow as pa

    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += len(batch.column(2).flatten()) + batch.num_rows
        if size >= BLOCK:
            yield pa.Table.from_batches(held).combine_chunks()
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def ranked_here(rows: DataFrame, plans: list, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """(item, doc_id, score): the k best of each task's documents for each plan, by its index."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        best = [Best(k) for _ in plans]
        for block in _blocks(batches):
            ids, n, terms, tfs = (block.column(i).combine_chunks() for i in range(4))
            null = np.asarray(ids.is_null())
            doc = ids.fill_null(0).to_numpy(zero_copy_only=False)
            m = 50 + 50 * n.to_numpy() * n_docs // n_terms
            row = np.repeat(np.arange(len(doc)), np.diff(terms.offsets.to_numpy()))
            number, tf = terms.flatten().to_numpy(), tfs.flatten().to_numpy().astype(np.int64)
            impact = 1_000_000_000 * tf // (1000 * tf + 20 * m[row])
            order = np.argsort(number, kind="stable")
            number, row, impact = number[order], row[order], impact[order]
            edges = np.flatnonzero(np.concatenate([[True], number[1:] != number[:-1], [True]])) if len(number) else np.zeros(1, np.int64)
            lists = {int(number[a]): (row[a:b], impact[a:b], int(impact[a:b].max())) for a, b in pairwise(edges.tolist())}
            for plan, mine in zip(plans, best, strict=True):
                search_block(lists, plan, mine, doc, null)
        for i, mine in enumerate(best):
            if len(mine.doc):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(mine.doc), i, np.int32)), pa.array(mine.doc, mask=mine.null), pa.array(mine.score)],
                                                 names=["item", "doc_id", "score"])

    return rows.select("doc_id", "n", "terms", "tfs").mapInArrow(run, "item int, doc_id bigint, score bigint")


def _top(rows: DataFrame, by: list[Column | str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = BEST, text: str = "text", key: str = "doc_id", item: str = "item_id") -> DataFrame:
    """(item_id, rank, doc_id, score): each item's k best documents."""
    spark = docs.sparkSession
    wanted = staged(spark, item_terms(items, item), "item-terms")
    blocks = -(-wanted.count() // ITEM_TERMS)
    found = spark.createDataFrame([], f"item_id {wanted.schema['item_id'].dataType.simpleString()}, rank int, doc_id bigint, score bigint")
    for block in range(blocks):
        # a bounded number of (item, term) pairs: all terms of an item fall in one block
        rows = wanted.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).collect()
        terms = sorted({r.term.encode() for r in rows})
        number = {t: i for i, t in enumerate(terms)}
        table = staged(spark, postings(docs, terms, text, key), "postings")
        n_docs, n_terms = table.agg(F.count(F.lit(1)), F.sum("n")).first()
        df = dict(table.select(F.explode("terms").alias("t")).groupBy("t").count().collect())  # at most one row a term
        names = sorted({r.item_id for r in rows}, key=lambda x: (x is None, x))
        place = {name: i for i, name in enumerate(names)}
        plans: list[list] = [[] for _ in names]
        for r in rows:
            t = number[r.term.encode()]
            if t in df:
                plans[place[r.item_id]].append((df[t], t))
        weight = lambda d: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1)))
        plans = [[(t, weight(d)) for d, t in sorted(p)] for p in plans]
        if not df:
            continue
        here = ranked_here(table, plans, n_docs, n_terms, k).withColumn("part", F.floor(F.spark_partition_id() / MERGED))
        best = _top(_top(here, ["item", "part"], k), ["item"], k)
        named = spark.createDataFrame(list(enumerate(names)), f"item int, {found.schema['item_id'].simpleString().replace(':', ' ')}")
        found = found.unionByName(best.join(named, "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))
    return found


def op11_term_at_a_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return search(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"))


OP11_SQL = r"""
with d as (select row_number() over () as r, doc_id,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as t from documents),
p as (select r, doc_id, len(t) as n, unnest(t) as term from d),
s as (select count(*) as n_docs, sum(len(t))::bigint as n_terms from d where len(t) > 0),
f as (select r, doc_id, n, term, count(*) as tf from p group by r, doc_id, n, term),
w as (select term, floor(1000 * ln((2 * any_value(n_docs) + 2)::double / (2 * count(*) + 1)))::bigint as w from f, s group by term),
q as (select distinct item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark),
c as (select q.item_id, f.r, f.doc_id, sum(w.w * ((1000000000 * f.tf) // (1000 * f.tf + 20 * (100 - 50 + ((50 * f.n * s.n_docs) // s.n_terms)))))::bigint as score
      from q join f on q.term = f.term join w on w.term = q.term, s group by q.item_id, f.r, f.doc_id),
o as (select item_id, row_number() over (partition by item_id order by score desc, doc_id)::int as rank, doc_id, score from c where score > 0)
select item_id, rank, doc_id, score from o where rank <= 50
"""
