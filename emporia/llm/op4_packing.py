"""Pattern packing: few-document length patterns fitted to the length histogram.

1. Every text is tokenised, ended by id 0, and cut into pieces of at most ``capacity`` tokens.
   The pieces are written once, each with its chunk (the task that made it) and its rank among
   the chunk's pieces of that length.
2. The histogram of lengths has at most ``capacity`` entries, whatever the input. Patterns of one
   to three lengths that fill a sequence exactly are enumerated, their repeat counts fitted to
   the histogram by non-negative least squares, rounded and trimmed to what is there.
3. The residual histogram (that of several shares of the fit, to leave short lengths for the
   rest; the fewest sequences win) is packed best fit: the longest length left opens a pattern that
   takes the longest lengths that still fit, and is repeated as often as the counts allow.
4. The plan, a bounded table, gives each (length, rank) its sequence and offset; a piece's rank is
   its rank in the chunk plus the counts of that length in the chunks before.

So only counts per chunk and length are shuffled; a length that a third of all pieces share
is spread over as many tasks as its pieces were.

Defined results. NULL or empty text: one piece, the single id 0. Repeated rows are packed each on
its own. An empty table gives no rows. Extra columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from emporia.llm.common import staged, text_chunks, with_small_batches, worker_memory
from emporia.llm.parts import PartTable

CAPACITY = 2048
END_ID = 0
#: Steps of the projected gradient that fits the repeat counts.
FIT_STEPS = 150
#: Shares of the fitted repeats that are tried; the plan with the fewest sequences counts.
SHARES = (1.0, 0.9, 0.75, 0.5, 0.25)


def _table(path: str | None) -> PartTable:
    kept = worker_memory("packing")
    if ("parts", path) not in kept:
        from tokenizers import Tokenizer

        file = path
        if file is None:
            import public_tokenizers

            file = public_tokenizers.path("byte_bpe_50k.json")
        tokenizer = Tokenizer.from_file(file)
        tokenizer.encode_special_tokens = True
        kept["parts", path] = PartTable(
            lambda parts: [e.ids for e in tokenizer.encode_batch_fast([p.decode() for p in parts], add_special_tokens=False)])
    return kept["parts", path]


def pieces(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None, text: str = "text", key: str = "doc_id",
           with_ids: bool = False) -> DataFrame:
    """One row per piece; the first piece of a cut document takes the remainder."""
    columns = f"{key} bigint, piece int, start bigint, length bigint, ids_crc32 bigint, chunk bigint, local_rank bigint"
    names = [c.split()[0] for c in columns.split(", ")]

    def run(batches: Iterator) -> Iterator:
        import os

        import pyarrow as pa
        from pyspark import TaskContext

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        table, chunk = _table(path), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            keys = batch.column(batch.schema.get_field_index(key)).to_pylist()
            for first, data, at in text_chunks(batch, text):
                ids, ends = table.encode(data, at)
                ids = ids.astype("<u4")
                rows: list[tuple] = []
                parts: list[bytes] = []
                for k, (a, b) in enumerate(pairwise(ends.tolist())):
                    packed = ids[a:b].tobytes() + END_ID.to_bytes(4, "little")
                    n = b - a + 1
                    edges = [0, *range(n % capacity or capacity, n + 1, capacity)]
                    for j, (x, y) in enumerate(pairwise(edges)):
                        own = packed[4 * x : 4 * y]
                        rows.append((keys[first + k], j, x, y - x, zlib.crc32(own), chunk, seen[y - x]))
                        seen[y - x] += 1
                        if with_ids:
                            parts.append(own)
                kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 5]
                made = [pa.array(v, t) for v, t in zip(zip(*rows, strict=True), kinds, strict=True)]
                if with_ids:
                    made.append(pa.array([np.frombuffer(p, "<u4").astype(np.int32) for p in parts], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(made, names=names + ["ids"] * with_ids)

    return docs.select(F.col(key).cast("bigint").alias(key), F.col(text).alias(text)).mapInArrow(run, columns + ", ids array<int>" * with_ids)


def fit_patterns(counts: np.ndarray, steps: int = FIT_STEPS) -> list[tuple[tuple[int, ...], int]]:
    """(lengths, repeats) of exactly full patterns of at most three lengths, by non-negative least squares.

    ``counts[n]``: pieces of length n; its last index is the capacity. Only patterns of lengths
    that occur are enumerated. The counts are fitted by accelerated projected gradient, rounded,
    and taken as far as the histogram allows.
    """
    capacity = len(counts) - 1
    there = np.flatnonzero(counts)
    is_there = counts > 0
    rows = []
    if is_there[capacity]:
        rows.append(np.array([[capacity, 0, 0]]))
    pair = there[(there * 2 <= capacity)]
    pair = pair[is_there[capacity - pair]]
    rows.append(np.stack([pair, capacity - pair, np.zeros_like(pair)], axis=1))
    for a in there[there * 3 <= capacity].tolist():
        b = there[(there >= a) & (there * 2 <= capacity - a)]
        b = b[is_there[capacity - a - b]]
        rows.append(np.stack([np.full_like(b, a), b, capacity - a - b], axis=1))
    pattern = np.concatenate(rows)
    if not len(pattern):
        return []
    target = counts.astype(float)
    target[0] = 0

    def used(x: np.ndarray) -> np.ndarray:
        out = sum(np.bincount(pattern[:, i], x, capacity + 1) for i in range(3))
        out[0] = 0
        return out

    def slope(r: np.ndarray) -> np.ndarray:
        return r[pattern].sum(axis=1)

    # The largest eigenvalue of A'A bounds the step; some power iterations find it.
    v = np.ones(len(pattern))
    for _ in range(20):
        v = slope(used(v))
        norm = np.linalg.norm(v)
        v /= norm
    x = y = np.zeros(len(pattern))
    momentum = 1.0
    for _ in range(steps):
        new = np.maximum(0.0, y - slope(used(y) - target) / (1.05 * norm))
        after = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        y = new + (momentum - 1) / after * (new - x)
        x, momentum = new, after
    # Rounded so that every run of neighbouring patterns keeps its sum to within one.
    whole = np.diff(np.floor(np.concatenate([[0.0], np.cumsum(x)]) + 0.5)).astype(np.int64)
    left = counts.astype(np.int64).copy()
    out = []
    for i in np.flatnonzero(whole):
        repeats = int(whole[i])
        lengths = tuple(int(n) for n in pattern[i] if n)
        for n in set(lengths):
            repeats = min(repeats, int(left[n]) // lengths.count(n))
        if repeats > 0:
            for n in lengths:
                left[n] -= repeats
            out.append((lengths, repeats))
    return out


def pack_rest(counts: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit patterns for a histogram; every round uses up at least one length."""
    left = counts.astype(np.int64).copy()
    capacity = len(left) - 1
    out = []
    while left.any():
        own: dict[int, int] = {}
        room = capacity
        there = np.flatnonzero(left)
        while room:
            i = int(np.searchsorted(there, room, "right")) - 1
            while i >= 0 and own.get(int(there[i]), 0) >= left[there[i]]:
                i -= 1
            if i < 0:
                break
            n = int(there[i])
            times = min(room // n, int(left[n]) - own.get(n, 0))
            own[n] = own.get(n, 0) + times
            room -= n * times
        repeats = min(int(left[n]) // k for n, k in own.items())
        for n, k in own.items():
            left[n] -= repeats * k
        out.append((tuple(n for n, k in own.items() for _ in range(k)), repeats))
    return out


def plan_slots(counts: np.ndarray) -> dict[str, np.ndarray]:
    """The plan as slots: from rank ``rank`` of ``length`` on, each ``per`` pieces go to the next sequence."""
    fitted = fit_patterns(counts)
    plans = []
    for share in SHARES:
        some = [(lengths, int(share * repeats)) for lengths, repeats in fitted if int(share * repeats)]
        rest = counts.astype(np.int64).copy()
        for lengths, repeats in some:
            for n in lengths:
                rest[n] -= repeats
        plans.append(some + pack_rest(rest))
    plan = min(plans, key=lambda p: sum(repeats for _, repeats in p))
    taken = np.zeros(len(counts), np.int64)
    sequence = 0
    slots = []
    for lengths, repeats in plan:
        offset = 0
        for n in sorted(set(lengths), reverse=True):
            per = lengths.count(n)
            slots.append((n, int(taken[n]), per, sequence, offset))
            taken[n] += per * repeats
            offset += per * n
        sequence += repeats
    slots.sort()
    cols = np.array(slots, np.int64).reshape(-1, 5).T
    return dict(zip(("length", "rank", "per", "sequence", "offset"), cols, strict=True))


_RANKS = 40  # bits of a rank in a search key; lengths stand above


def packed(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``rows`` of ``pieces``, stored, with ``sequence_id`` and ``offset``."""
    per_chunk = rows.groupBy("chunk", "length").agg(F.count(F.lit(1)).alias("n"))
    per_chunk = staged(rows.sparkSession, per_chunk, "packing-counts")
    counts = np.zeros(capacity + 1, np.int64)
    for r in per_chunk.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most ``capacity`` rows
        counts[r.length] = r.n
    slots = plan_slots(counts)
    before = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    base = per_chunk.select("chunk", "length", before.alias("base"))
    ranked = rows.join(base, ["chunk", "length"])
    kept = [c for c in rows.columns if c not in ("chunk", "local_rank")]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        keys = (slots["length"] << _RANKS) + slots["rank"]
        for batch in batches:
            length, local, start = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "local_rank", "base"))
            rank = local + start
            slot = np.searchsorted(keys, (length << _RANKS) + rank, "right") - 1
            turn, copy = np.divmod(rank - slots["rank"][slot], slots["per"][slot])
            made = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            made += [pa.array(slots["sequence"][slot] + turn), pa.array(slots["offset"][slot] + copy * length)]
            yield pa.RecordBatch.from_arrays(made, names=[*kept, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name in kept)
    return ranked.mapInArrow(run, schema + ", sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their places, the token ids included on demand."""
    return packed(staged(with_small_batches(docs).sparkSession, pieces(docs, capacity, path, with_ids=with_ids), "packing-pieces"), capacity)


def op4_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
