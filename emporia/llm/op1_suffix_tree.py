"""Language-model scoring by a probabilistic suffix tree over bytes.

A text is its sequence of words (A-Z lowered), spelled as bytes: each word and a space, then one
end symbol. The tree predicts the next byte from the longest retained context of at most
``MAX_DEPTH`` bytes that ends the history.

* Counting: every training text is read whole; each task sums its (context, next byte) strings of
  all depths from one sort, and the sums of all tasks are added by key.
* Contexts are candidates from a share ``MIN_SHARE`` of all symbols on, so each depth has at most
  1 / MIN_SHARE of them whatever the input: that bounds the model, which travels to every task.
* Retention: a context stays when its smoothed next-symbol distribution diverges from its longest
  retained suffix's by at least ``MIN_GAIN`` nats per corpus symbol (share times Kullback-Leibler
  divergence).
* Smoothing: counts plus ``PRIOR`` observations drawn from the suffix's distribution; at the root
  half a count for every byte value.
* Whole words: a token is spelled by the tree with chance ``SPELLED`` and otherwise drawn from the
  training counts of tokens; its probability is the sum of both. ``score`` has the base's events,
  the known tokens and one type for all unseen ones, which gets the rate at which training met new
  words, distinct / (tokens + distinct). ``spelled_score`` spells unseen words out instead.
* Scoring: the retained contexts and all their substrings form an automaton whose state is the
  longest suffix in it, so a step is one table lookup; long stretches of text are scored as many
  strands side by side, each warmed up on the bytes before it.

The word counts of the base score go the other way round: documents are dealt to blocks, each block
asks for its distinct words once, and the totals come back to the block. A frequent word is one
row per block, however often it occurs.

Defined results. NULL or empty text: the end alone. Repeated rows count and are scored each on its
own. An empty table gives no rows; without any training text all counts are 0. Extra columns are
not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from emporia.llm.common import Powers, _LOWER, crc_of, release_memory, staged, text_chunks, with_small_batches, word_hashes, word_spans
from emporia.llm.parts import spread

MAX_DEPTH = 6
MIN_SHARE = 1e-5
MIN_GAIN = 5e-8
PRIOR = 4.0
#: Chance that a token is spelled by the tree, not drawn from the training counts.
SPELLED = 0.5
#: Bytes of text in a block, about.
BLOCK_BYTES = 12 << 20
#: Bytes of text that are worked on at once, about: each takes some 100 bytes of memory meanwhile.
STEP_BYTES = 512 << 10
#: Distinct strings that a counting task holds before it hands them on.
HELD = 3_000_000
#: Strings that wait to be summed with those that it holds, at least; beyond it half as many as it holds.
WAITING = 500_000

_END, _SPACE = 10, 32
_LN10 = math.log(10)
_BITS = 8 * (MAX_DEPTH + 1)


def spelled(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The rows as bytes (words each with a space, then the end), where each token starts, and which are ends."""
    low = np.append(_LOWER[data], np.uint8(_SPACE))
    start, end = word_spans(low[:-1], at)
    size = end - start + 1
    out = low[spread(start, size)] if len(start) else np.zeros(0, np.uint8)
    ends = np.cumsum(size)
    if len(out):
        out[ends - 1] = _SPACE
        out[out == 0] = 1
    words = np.searchsorted(start, at[1:])
    stop = np.concatenate([[0], ends])[words]
    first = np.insert(ends - size, words, stop)
    is_end = np.zeros(len(first), bool)
    is_end[words + np.arange(len(words))] = True
    first += np.cumsum(is_end) - is_end
    return np.insert(out, stop, np.uint8(_END)), first, is_end


def strings(stream: np.ndarray) -> np.ndarray:
    """Per symbol, itself and the bytes before it as one number, latest in the highest byte.

    Bytes from before the last end are 0; the end itself stays as the mark of a start.
    """
    n = len(stream)
    padded = np.concatenate([np.full(MAX_DEPTH, _END, np.uint8), stream])
    key = stream.astype(np.uint64) << np.uint64(_BITS - 8)
    open_ = np.ones(n, bool)
    for d in range(1, MAX_DEPTH + 1):
        before = padded[MAX_DEPTH - d : MAX_DEPTH - d + n]
        key |= np.where(open_, before, 0).astype(np.uint64) << np.uint64(_BITS - 8 * (d + 1))
        open_ &= before != _END
    return key


def summed(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order with their counts."""
    if counts is None:
        keys = np.sort(keys)
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        return keys[first], np.diff(np.append(first, len(keys)))
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def depths(keys: np.ndarray, counts: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The same sums for contexts of every depth: shorter contexts are prefixes of the sorted keys."""
    for d in range(MAX_DEPTH, -1, -1):
        low = np.uint64((1 << (_BITS - 8 * (d + 1))) - 1)
        short = keys & ~low
        first = np.flatnonzero(np.concatenate([[True], short[1:] != short[:-1]])) if len(short) else np.zeros(0, np.int64)
        if not len(first):
            continue
        k, n = short[first], np.add.reduceat(counts, first)
        whole = (k >> np.uint64(_BITS - 8 * (d + 1))) & np.uint64(255) != 0
        yield d, k[whole], n[whole]


def string_counts(train: DataFrame, text: str = "text") -> DataFrame:
    """(depth, key, n) over all texts of ``train``."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def merged(parts: list) -> tuple[np.ndarray, np.ndarray]:
            return summed(np.concatenate([k for k, _ in parts]), np.concatenate([n for _, n in parts])) if len(parts) > 1 else parts[0]

        def out(held: tuple) -> Iterator:
            for d, k, n in depths(*held):
                for i in range(0, len(k), 1 << 16):
                    piece = k[i : i + (1 << 16)].astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(piece), d, np.int32)), pa.array(piece), pa.array(n[i : i + (1 << 16)].astype(np.int64))],
                                                     names=["depth", "key", "n"])

        parts: list[tuple[np.ndarray, np.ndarray]] = []  # the first is what was summed so far
        for batch in batches:
            for _, data, at in text_chunks(batch, text, STEP_BYTES):
                parts.append(summed(strings(spelled(data, at)[0])))
                if sum(len(k) for k, _ in parts[1:]) > max(min(WAITING, HELD), len(parts[0][0]) // 2):
                    parts = [merged(parts)]
                    if len(parts[0][0]) > HELD // 2:
                        yield from out(parts.pop())
        if parts:
            yield from out(merged(parts))
        parts.clear()
        release_memory()

    rows = train.select(F.col(text)).mapInArrow(run, "depth int, key bigint, n bigint")
    return rows.groupBy("depth", "key").agg(F.sum("n").alias("n"))


@dataclass
class SuffixTree:
    """The automaton: symbols of bytes, next state and log10 probability per state and symbol."""

    symbol: np.ndarray
    following: np.ndarray
    log10: np.ndarray
    n_retained: int

    def symbol_scores(self, stream: np.ndarray) -> np.ndarray:
        """log10 probability of every byte of ``spelled`` texts."""
        n, width = len(stream), self.log10.shape[1]
        across = max(1, min(8192, n // 64))
        down = max(-(-n // across), MAX_DEPTH)
        grid = np.full(across * down, _END, np.uint8)
        grid[:n] = stream
        codes = self.symbol[grid].reshape(across, down)
        warm = np.full((across, MAX_DEPTH), self.symbol[_END], codes.dtype)
        warm[1:] = codes[:-1, -MAX_DEPTH:]
        steps = np.ascontiguousarray(np.concatenate([warm, codes], axis=1).T).astype(np.int64)
        state = np.zeros(across, np.int64)
        scores = np.empty((down, across), np.float32)
        following, log10 = self.following.ravel(), self.log10.ravel()
        for i in range(down + MAX_DEPTH):
            cell = state * width + steps[i]
            if i >= MAX_DEPTH:
                np.take(log10, cell, out=scores[i - MAX_DEPTH])
            state = following[cell]
        return scores.T.ravel()[:n].astype(float)

    def score(self, data: np.ndarray, at: np.ndarray, counts: np.ndarray, ends: int, tokens: int, fresh: float) -> tuple[np.ndarray, np.ndarray]:
        """log10 probability of each row, with unseen words as one type and with them spelled out.

        ``counts`` of the rows' words in training, ``ends`` of the end, of ``tokens`` in all;
        ``fresh``: probability of the unseen type.
        """
        stream, first, is_end = spelled(data, at)
        by_tree = np.add.reduceat(self.symbol_scores(stream), first)
        seen = np.empty(len(first))
        seen[~is_end], seen[is_end] = counts, ends
        with np.errstate(divide="ignore"):
            by_count = np.log(seen * (1 - SPELLED) / max(tokens, 1))
            known = math.log10(1 - fresh) if fresh < 1 else -math.inf
        both = np.logaddexp(by_count, by_tree * _LN10 + math.log(SPELLED)) / _LN10
        row_start = np.concatenate([[0], np.flatnonzero(is_end)[:-1] + 1])
        typed = np.where(seen > 0, both + known, math.log10(fresh))
        return np.add.reduceat(typed, row_start), np.add.reduceat(both, row_start)


def build_tree(context_keys: np.ndarray, context_depth: np.ndarray, context_n: np.ndarray, keys: np.ndarray, depth: np.ndarray,
               n: np.ndarray, total: int) -> SuffixTree:
    """Fits the tree from bounded counts.

    context_*: candidate contexts (key with the latest byte highest, length, count); keys, depth,
    n: (context, next byte) strings of the root and of the candidates.
    """
    root = depth == 0
    shift = np.uint64(_BITS - 8)
    seen = np.unique(np.append((keys[root] >> shift).astype(np.int64), [_END, _SPACE]))
    symbol = np.full(256, len(seen), np.int16)
    symbol[seen] = np.arange(len(seen))
    width = len(seen) + 1
    base = np.full(width, 0.5)
    np.add.at(base, symbol[(keys[root] >> shift).astype(np.int64)], n[root])
    rows = [base[None, :] / (n[root].sum() + 0.5 * 256)]
    place: dict[tuple[int, int], int] = {(0, 0): 0}  # (length, key): its distribution's row
    size = 1
    retained: list[tuple[int, int]] = []
    mask = np.uint64((1 << _BITS) - 1)
    for d in range(1, MAX_DEPTH + 1):
        own = context_depth == d
        ck, cn = context_keys[own], context_n[own]
        if not len(ck):
            break
        order = np.argsort(ck)
        ck, cn = ck[order], cn[order]
        shorter = ck & ~np.uint64((1 << (_BITS - 8 * (d - 1))) - 1) if d > 1 else np.zeros(len(ck), np.uint64)
        parent = np.array([place[d - 1, int(k)] for k in shorter])
        table = np.concatenate(rows)
        before = table[parent]
        sums = before * PRIOR
        mine = depth == d
        at = np.searchsorted(ck, (keys[mine] << np.uint64(8)) & mask)
        np.add.at(sums, (at, symbol[(keys[mine] >> shift).astype(np.int64)]), n[mine])
        spare = 256 - (width - 1)  # bytes that share the last column
        weight = np.ones(width)
        weight[-1] = spare
        sums /= (sums * weight).sum(axis=1, keepdims=True)
        gain = (sums * weight * np.log(sums / before)).sum(axis=1) * (cn / max(total, 1))
        keep = gain >= MIN_GAIN
        for k, row, stays, i in zip(ck.tolist(), parent.tolist(), keep.tolist(), (np.cumsum(keep) - 1).tolist(), strict=True):
            place[d, k] = size + i if stays else row
        retained += [(d, k) for k, stays in zip(ck.tolist(), keep.tolist(), strict=True) if stays]
        rows.append(sums[keep])
        size += int(keep.sum())
    # All substrings of the retained contexts are states; each is frequent, as what holds it is.
    states = {(0, 0)}
    for d, k in retained:
        for skip in range(d):
            for length in range(1, d - skip + 1):
                states.add((length, (k << 8 * skip & (1 << _BITS) - 1) >> (_BITS - 8 * length) << (_BITS - 8 * length)))
    listed = sorted(states)
    number = {s: i for i, s in enumerate(listed)}
    table = np.concatenate(rows)
    log10 = np.log10(table[[place[s] for s in listed]]).astype(np.float32)
    following = np.zeros((len(listed), width), np.int32)
    by_length = {length: (np.array([k for d, k in listed if d == length], np.uint64), min((i for (d, _), i in number.items() if d == length), default=0))
                 for length in range(1, MAX_DEPTH + 1)}
    state_keys = np.array([k for _, k in listed], np.uint64)
    state_depth = np.array([d for d, _ in listed])
    for s, b in enumerate(seen.tolist()):
        made = (state_keys >> np.uint64(8)) | np.uint64(b << (_BITS - 8))
        for length in range(1, MAX_DEPTH + 1):
            known, first = by_length[length]
            if not len(known):
                continue
            cut = made & ~np.uint64((1 << (_BITS - 8 * length)) - 1)
            i = np.minimum(np.searchsorted(known, cut), len(known) - 1)
            hit = (known[i] == cut) & (length <= state_depth + 1)
            following[hit, s] = first + i[hit]
        if b == _END:  # a new text: what came before the end is out of sight
            following[:, s] = number.get((1, _END << (_BITS - 8)), 0)
    return SuffixTree(symbol, following, log10, len(retained))


def train_tree(train: DataFrame, text: str = "text") -> SuffixTree:
    counts = staged(train.sparkSession, string_counts(train, text), "suffix-counts")
    total = counts.filter("depth = 0").agg(F.sum("n")).first()[0] or 0
    frequent = counts.filter(F.col("n") >= max(1.0, MIN_SHARE * total)).filter(F.col("depth") < MAX_DEPTH)
    frequent = frequent.select((F.col("depth") + 1).alias("depth"), "key", "n")
    nexts = counts.withColumn("context", F.shiftleft("key", 8).bitwiseAND(F.lit((1 << _BITS) - 1)))
    ends = F.shiftright("key", _BITS - 8) == _END  # nothing follows an end, so it is a context only as the start mark
    contexts = frequent.filter(~ends | (F.col("depth") == 1))
    nexts = nexts.join(contexts.select("depth", F.col("key").alias("context")), ["depth", "context"], "left_semi").unionByName(
        counts.filter("depth = 0").withColumn("context", F.lit(0).cast("bigint")))
    columns = lambda df: [x.to_numpy() for x in df.select("depth", "key", "n").toArrow().columns]
    c_depth, c_key, c_n = columns(contexts)  # at most MAX_DEPTH / MIN_SHARE rows
    e_depth, e_key, e_n = columns(nexts)  # every byte that follows one of them, however rare: at most 256 rows for each
    # A context whose suffix fell below the share by rounding goes too (counts at row starts differ by the start mark).
    have = {(0, 0)} | set(zip(c_depth.tolist(), c_key.tolist(), strict=True))
    cut = lambda d, k: (d - 1, k >> (_BITS - 8 * (d - 1)) << (_BITS - 8 * (d - 1)))
    for d in range(2, MAX_DEPTH + 1):
        have -= {s for s in have if s[0] == d and (cut(*s) not in have or (d - 1, s[1] << 8 & (1 << _BITS) - 1) not in have)}
    ok = np.array([s in have for s in zip(c_depth.tolist(), c_key.tolist(), strict=True)], bool)
    c_depth, c_key, c_n = c_depth[ok], c_key[ok], c_n[ok]
    ok = e_depth == 0
    for d in range(1, MAX_DEPTH + 1):
        ok |= (e_depth == d) & np.isin(e_key << 8 & (1 << _BITS) - 1, c_key[c_depth == d])
    return build_tree(c_key.astype(np.uint64), c_depth, c_n.astype(float), e_key[ok].astype(np.uint64), e_depth[ok], e_n[ok].astype(float), int(total))


def block_words(blocks: DataFrame) -> DataFrame:
    """(hash, block, n): the distinct words of each block and how often its training texts have them."""
    def count(table):
        import pyarrow as pa

        powers, keys, counts = Powers(), [], []
        block = table.column("block")[0].as_py()
        for batch in table.to_batches():
            trained = batch.column("train").to_numpy(zero_copy_only=False)
            for first, data, at in text_chunks(batch, size=STEP_BYTES):
                words, rows = word_hashes(data, at, powers)
                one, back = np.unique(words, return_inverse=True)
                keys.append(one)
                counts.append(np.bincount(back, trained[first + rows], len(one)).astype(np.int64))
        k, n = summed(np.concatenate(keys), np.concatenate(counts))
        del keys, counts, powers
        release_memory()
        return pa.table({"hash": k.view(np.int64), "block": np.full(len(k), block, np.int64), "n": n})

    return blocks.groupBy("block").applyInArrow(count, "hash bigint, block bigint, n bigint")


def score_documents(docs: DataFrame, held_out, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Score all documents by a tree, and a base, learnt from those that are not ``held_out``."""
    spark = with_small_batches(docs).sparkSession
    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"), (~held_out).alias("train"))
    sizes = rows.agg(F.sum(F.octet_length("text")), F.sum(F.col("train").cast("long"))).first()
    n_blocks, n_ends = max(1, math.ceil((sizes[0] or 0) / BLOCK_BYTES)), sizes[1] or 0
    tree = train_tree(rows.filter("train"))
    blocks = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_blocks).cast("long"))).repartition(n_blocks, "block")
    same = Window.partitionBy("hash")
    words = block_words(blocks).select("block", "hash", "n", F.sum("n").over(same).alias("c"), (F.min("block").over(same) == F.col("block")).alias("first"))
    words = staged(spark, words, "suffix-words")
    known = words.agg(F.sum("n"), F.sum((F.col("first") & (F.col("c") > 0)).cast("long"))).first()
    tokens, distinct = (known[0] or 0) + n_ends, (known[1] or 0) + (n_ends > 0)
    fresh = distinct / (tokens + distinct) if tokens else 1.0

    def score(left, right):
        import pyarrow as pa

        hashes = right.column("hash").to_numpy().view(np.uint64)
        order = np.argsort(hashes)
        hashes, counts = hashes[order], right.column("c").to_numpy()[order]
        powers, out = Powers(), []
        below = math.log10(tokens + 0.5 * (distinct + 1))
        for batch in left.to_batches():
            for first, data, at in text_chunks(batch, size=STEP_BYTES):
                n = len(at) - 1
                got, row = word_hashes(data, at, powers)
                c = counts[np.searchsorted(hashes, got)] if len(got) else np.zeros(0)
                n_tokens = np.bincount(row, minlength=n) + 1
                n_known = np.bincount(row, c > 0, n).astype(np.int64) + (n_ends > 0)
                base = np.bincount(row, np.log10(c + 0.5), n) + math.log10(n_ends + 0.5) - n_tokens * below
                typed, spelled_out = tree.score(data, at, c, n_ends, tokens, fresh)
                ids, trained = (batch.column(x).slice(first, n) for x in ("doc_id", "train"))
                out.append(pa.table({"doc_id": ids, "held_out": pa.array(~trained.to_numpy(zero_copy_only=False)), "n_tokens": n_tokens.astype(np.int64),
                                     "n_known": n_known, "train_tokens": np.full(n, tokens, np.int64), "base_score": base, "score": typed, "spelled_score": spelled_out}))
        del powers, hashes, counts
        release_memory()
        return pa.concat_tables(out)

    schema = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double, spelled_score double"
    return blocks.groupBy("block").cogroup(words.select("block", "hash", "c").groupBy("block")).applyInArrow(score, schema)


def op1_suffix_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score_documents(docs, F.pmod(crc_of("doc_id"), F.lit(5)) == 1)
