"""Cross-tokenizer alignment: divide and conquer at shared cuts.

Two tokenizers cut the same bytes. An interval of a text holds tokens of A and of B; if some offset inside
it ends a token of both, it is cut there. A shared end near the middle is looked for: the middle one of
the interval's A ends is sought among its B ends by bisection, then the A ends before and after it, ever
farther out. Where one is found, both halves go the same way; where none is, the interval is a leaf
group. All intervals of one depth take their steps together, as arrays.

Texts are first cut where both tokenizers must cut whatever stands beside: before a single space or line
end that non-spaces surround. Such parts recur, so a worker aligns each distinct one once and remembers it.

A pair of ids is linked in a document if two tokens of it overlap there; its count is the number of
documents that hold it linked. Tasks join documents to blocks with a dictionary of their pairs; documents
refer to the dictionary, and are written once. The dictionaries' entries are counted, each id's highest
count is found, and both go back to the blocks, where each document sums its own.

Defined results. NULL or empty text, and texts that either tokenizer doesn't give back byte by byte: no
tokens, zeros, ``groups`` empty (its hash is the empty string), never counted. Repeated rows are documents
each; NULL ids stay. An empty table gives no rows; extra columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporia.llm.common import _BYTE_CODES, _MULT, Powers, mix64, staged, text_chunks, with_small_batches, worker_memory
from emporia.llm.parts import _CUT_BEFORE, LONGEST_KEPT, spread

#: Bits of B's ids in a pair.
_B_BITS = 15
#: Bytes of text that share a dictionary of pairs.
BLOCK_BYTES = 32 << 20
#: Parts that a worker remembers (with 20 linked pairs each on average); beyond it the memory starts anew.
REMEMBERED = 200_000
#: Bytes of text whose links are sorted at once, and of parts that are encoded at once (a token takes some hundred bytes then).
STEP_BYTES, ENCODED_BYTES = 512 << 10, 64 << 10


def shared_cuts(a: np.ndarray, a_at: np.ndarray, b: np.ndarray, b_at: np.ndarray) -> np.ndarray:
    """Which of the A ends are cuts, for all texts at once.

    ``a`` and ``b``: ascending ends of the texts' tokens, over one running offset; ``a_at`` and ``b_at``: where
    each text's begin, the end appended. A text's last ends are equal.
    """
    cut = np.zeros(len(a), bool)
    lo, hi = a_at[:-1].copy(), a_at[1:] - 1  # the interval's A ends without its last one, which is a cut
    blo, bhi = b_at[:-1].copy(), b_at[1:] - 1
    some = a_at[1:] > a_at[:-1]
    cut[hi[some]] = True
    open_ = (hi > lo) & (bhi > blo)
    lo, hi, blo, bhi = (x[open_] for x in (lo, hi, blo, bhi))
    while len(lo):
        middle = (lo + hi) >> 1
        found = np.full(len(lo), -1, np.int64)
        where = np.zeros(len(lo), np.int64)
        left = np.arange(len(lo))
        step = 0
        while len(left):
            for sign in (-1, 1) if step else (1,):
                at = middle[left] + sign * step
                inside = (at >= lo[left]) & (at < hi[left])
                k, at = left[inside], at[inside]
                place = np.searchsorted(b, a[at])
                place = np.minimum(np.maximum(place, blo[k]), bhi[k] - 1)
                hit = (b[place] == a[at]) & (found[k] < 0)
                found[k[hit]], where[k[hit]] = at[hit], place[hit]
            step += 1
            left = left[(found[left] < 0) & ((middle[left] - step >= lo[left]) | (middle[left] + step < hi[left]))]
        ok = found >= 0
        at, place = found[ok], where[ok]
        cut[at] = True
        lo, hi = np.concatenate([lo[ok], at + 1]), np.concatenate([at, hi[ok]])
        blo, bhi = np.concatenate([blo[ok], place + 1]), np.concatenate([place, bhi[ok]])
        open_ = (hi > lo) & (bhi > blo)
        lo, hi, blo, bhi = (x[open_] for x in (lo, hi, blo, bhi))
    return cut


def overlaps(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of all pairs of tokens whose byte ranges overlap; ends over one running offset, from 0 on."""
    if not len(a):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    a_start = np.concatenate([[0], a[:-1]])
    first = np.searchsorted(b, a_start, "right")  # the first B token that ends after the A token begins
    last = np.searchsorted(b, a, "left")  # the first that reaches its end
    n = last - first + 1
    return np.repeat(np.arange(len(a)), n), spread(first, n)


def _tokenizers(path_a: str | None, path_b: str | None):
    """encode(parts) -> (ids, byte lengths, tokens of each part, whether each part came back whole), for A and for B.

    A part is bytes that begin with a space or a line end (the text's first part with the space before it).
    """
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(path_a or public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    # the byte-level alphabet: printable bytes stand for themselves, the others for code points from 256 on
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [x for x in range(256) if x not in set(plain)]
    byte = {chr(x): x for x in plain} | {chr(256 + i): x for i, x in enumerate(other)}
    a_bytes: dict[int, bytes] = {}
    for piece, i in a.get_vocab(with_added_tokens=True).items():
        a_bytes[i] = bytes(byte[c] for c in piece) if all(c in byte for c in piece) else piece.encode()
    b = sentencepiece.SentencePieceProcessor(model_file=path_b or public_tokenizers.path("piece_bpe_32k.model"))
    if b.get_piece_size() > 1 << _B_BITS or max(a_bytes) >= 1 << 32 - _B_BITS:
        raise ValueError("a pair of these tokenizers' ids takes more than 32 bits")
    b_bytes = []
    for i in range(b.get_piece_size()):
        piece = b.id_to_piece(i)
        b_bytes.append(bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode())
        if " " in b_bytes[i].decode("utf-8", "replace").lstrip(" ") or (len(b_bytes[i]) > 1 and b"\n" in b_bytes[i]):
            raise ValueError("B has pieces that go on after a space or over a line end, so its texts can't be cut there")

    def encode_a(texts: list[str]) -> list[list[int]]:
        return [e.ids for e in a.encode_batch_fast(texts, add_special_tokens=False)]

    def encode_b(texts: list[str]) -> list[list[int]]:
        # B sets a space before each text: a part's own space is left to it; before a line end it is a token of its own
        made = b.encode([t[1:] if t[0] == " " else t for t in texts], num_threads=1)
        return [ids if t[0] == " " else ids[1:] for t, ids in zip(texts, made, strict=True)]

    def run(parts: list[bytes]) -> list[tuple[list[list[int]], list[list[int]], np.ndarray]]:
        texts = [p.decode() for p in parts]
        out = []
        for encode, table in ((encode_a, a_bytes), (encode_b, b_bytes)):
            ids = encode(texts)
            out.append((ids, [[len(table[i]) for i in x] for x in ids],
                        np.array([b"".join([table[i] for i in x]) == p for x, p in zip(ids, parts, strict=True)], bool)))
        return out

    return run


class PartAligner:
    """Remembers each distinct part's alignment: counts, groups as text, and linked pairs."""

    def __init__(self, path_a: str | None = None, path_b: str | None = None):
        self.encode = _tokenizers(path_a, path_b)
        self.powers = Powers()
        self.forget()

    def forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.slot = np.zeros(0, np.int64)
        self.numbers = np.zeros((0, 5), np.int64)  # tokens of A, of B, groups, links, whether whole
        self.groups: list[bytes] = []
        self.start = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.pairs = np.zeros(0, np.uint32)

    def align(self, parts: list[bytes]) -> None:
        """Appends the parts' alignments, made for a bounded number of bytes at a time."""
        ends, made, first = np.cumsum([len(p) for p in parts]), [], 0
        while first < len(parts):
            done = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, done + ENCODED_BYTES, "right")))
            made.append(self.aligned(parts[first:last]))
            first = last
        for groups, _, _ in made:
            self.groups += groups
        numbers = np.concatenate([n for _, n, _ in made])
        links = numbers[:, 3]
        begin = np.cumsum(links) - links + len(self.pairs)
        self.numbers = np.concatenate([self.numbers, numbers])
        self.start, self.size = np.concatenate([self.start, begin]), np.concatenate([self.size, links])
        self.pairs = np.concatenate([self.pairs, *[c for _, _, c in made]])

    def aligned(self, parts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """The parts' groups as text, their numbers, and their linked pairs one after the other."""
        (ids_a, len_a, ok_a), (ids_b, len_b, ok_b) = self.encode(parts)
        ok = ok_a & ok_b
        ids_a, len_a, ids_b, len_b = ([x if y else [] for x, y in zip(v, ok, strict=True)] for v in (ids_a, len_a, ids_b, len_b))
        flat = lambda v: np.fromiter((x for y in v for x in y), np.int64)
        at = lambda v: np.concatenate([[0], np.cumsum(np.fromiter(map(len, v), np.int64, len(v)))])
        a, b, a_at, b_at = np.cumsum(flat(len_a)), np.cumsum(flat(len_b)), at(ids_a), at(ids_b)
        a_id, b_id = flat(ids_a), flat(ids_b)
        cut = shared_cuts(a, a_at, b, b_at)
        x, y = overlaps(a, b)
        code = (a_id[x] << _B_BITS | b_id[y]).astype(np.uint32)
        links = np.diff(np.searchsorted(x, a_at))
        ends = np.flatnonzero(cut)
        groups = np.diff(np.searchsorted(ends, a_at))
        b_ends = np.searchsorted(b, a[ends])
        name_a, name_b = list(map(str, a_id.tolist())), list(map(str, b_id.tolist()))
        made, i, j = [], 0, 0
        for p, q in zip((ends + 1).tolist(), (b_ends + 1).tolist(), strict=True):
            made.append(f"{','.join(name_a[i:p])}|{','.join(name_b[j:q])}")
            i, j = p, q
        first = np.concatenate([[0], np.cumsum(groups)]).tolist()
        return ([";".join(made[p:q]).encode() for p, q in pairwise(first)],
                np.stack([np.diff(a_at), np.diff(b_at), groups, links, ok], axis=1).astype(np.int64), code)

    def parts_of(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, lengths and hashes of the parts; each row of ``data`` begins with a space."""
        cut = np.zeros(len(data) + 1, bool)
        if len(data) > 2:
            solid = data > 32
            cut[1:-2] = solid[:-2] & _CUT_BEFORE[data[2:]] & ((data[1:-1] == 32) | (data[1:-1] == 10))
        cut[at] = True
        edges = np.flatnonzero(cut)
        starts, lengths = edges[:-1], np.diff(edges)
        self.powers.reach(len(data) + 1)
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE_CODES[data] * self.powers.up[: len(data)], out=total[1:])
        codes = (total[edges[1:]] - total[starts]) * self.powers.down[starts]
        return starts, lengths, mix64(codes + lengths.astype(np.uint64) * np.uint64(_MULT))

    def slots(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The alignment (its index here) of each part in order, and where each row's parts start, end appended."""
        starts, lengths, codes = self.parts_of(data, at)
        if len(self.groups) > REMEMBERED or len(self.pairs) > 20 * REMEMBERED:
            self.forget()
        out = np.full(len(codes), -1, np.int64)
        if len(self.keys):
            place = np.minimum(np.searchsorted(self.keys, codes), len(self.keys) - 1)
            out = np.where(self.keys[place] == codes, self.slot[place], -1)
        missing = np.flatnonzero(out < 0)
        if len(missing):
            new, one, back = np.unique(codes[missing], return_index=True, return_inverse=True)
            one = missing[one]
            raw = data.tobytes()
            base = len(self.groups)
            self.align([raw[s : s + n] for s, n in zip(starts[one].tolist(), lengths[one].tolist(), strict=True)])
            out[missing] = base + back
            kept = lengths[one] <= LONGEST_KEPT
            keys, slot = np.concatenate([self.keys, new[kept]]), np.concatenate([self.slot, base + np.flatnonzero(kept)])
            order = np.argsort(keys, kind="stable")
            self.keys, self.slot = keys[order], slot[order]
        return out, np.searchsorted(starts, at)


def _aligner(path_a: str | None, path_b: str | None) -> PartAligner:
    kept = worker_memory("alignment")
    if ("aligner", path_a, path_b) not in kept:
        kept["aligner", path_a, path_b] = PartAligner(path_a, path_b)
    return kept["aligner", path_a, path_b]


class Pairs:
    """A block's dictionary: pairs in the order they came, and the documents that hold each."""

    def __init__(self):
        self.codes = np.zeros(0, np.uint32)
        self.place = np.zeros(0, np.int64)
        self.documents = np.zeros(0, np.int64)

    def places(self, codes: np.ndarray) -> np.ndarray:
        """Place of each of some distinct ascending pairs; new ones are appended."""
        at = np.minimum(np.searchsorted(self.codes, codes), max(len(self.codes) - 1, 0))
        known = self.codes[at] == codes if len(self.codes) else np.zeros(len(codes), bool)
        out = np.zeros(len(codes), np.int64)
        out[known] = self.place[at[known]]
        new = codes[~known]
        out[~known] = len(self.codes) + np.arange(len(new))
        merged, place = np.concatenate([self.codes, new]), np.concatenate([self.place, out[~known]])
        order = np.argsort(merged, kind="stable")
        self.codes, self.place = merged[order], place[order]
        self.documents = np.concatenate([self.documents, np.zeros(len(new), np.int64)])
        return out

    def in_order(self) -> np.ndarray:
        out = np.zeros(len(self.codes), np.uint32)
        out[self.place] = self.codes
        return out


def _squeezed(x: np.ndarray) -> bytes:
    """Small numbers (below 2^32) as byte planes, compressed."""
    import zlib

    return zlib.compress(x.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _spread_out(x: bytes) -> np.ndarray:
    import zlib

    return np.frombuffer(zlib.decompress(x), np.uint8).reshape(4, -1).T.copy().view("<u4").reshape(-1).astype(np.int64)


_DOCUMENT = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint"


def aligned(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, text: str = "text", key: str = "doc_id",
            with_groups: bool = False) -> DataFrame:
    """One row per document, and one per block with its dictionary (``codes``, ``documents``).

    A document's row: its numbers, ``groups_sha256``, ``groups`` on demand, and its linked pairs' places in the block's
    dictionary (``places``, ascending, as differences) with their occurrences (``times``).
    """
    columns = f"block bigint, {_DOCUMENT}, groups_sha256 string, groups string, places binary, times binary, codes array<bigint>, documents array<bigint>"
    names = [c.split()[0] for c in columns.split(", ")]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        aligner, task = _aligner(path_a, path_b), TaskContext.get().partitionId()
        pairs, number, held = Pairs(), 0, 0
        block = lambda: (task << 24) + number
        kinds = [pa.int64()] * 6 + [pa.string()] * 2 + [pa.binary()] * 2 + [pa.list_(pa.int64())] * 2

        def batch_of(rows: list[tuple]):
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

        def dictionary():
            row = batch_of([(block(), *[None] * 11)])
            for name, numbers in (("codes", pairs.in_order().astype(np.int64)), ("documents", pairs.documents)):
                whole = pa.ListArray.from_arrays(pa.array([0, len(numbers)], pa.int32()), pa.array(numbers))
                row = row.set_column(names.index(name), name, whole)
            return row

        for batch in batches:
            keys = batch.column(batch.schema.get_field_index(key)).to_pylist()
            for first, data, at in text_chunks(batch, text, STEP_BYTES):
                n = len(at) - 1
                some = np.diff(at) > 0
                size = np.where(some, np.diff(at) + 1, 0)  # a space stands before each text
                begin = np.concatenate([[0], np.cumsum(size)])
                led = np.full(begin[-1], 32, np.uint8)
                led[spread(begin[:-1][some] + 1, np.diff(at)[some])] = data
                slot, edges = aligner.slots(led, begin) if len(led) else (np.zeros(0, np.int64), np.zeros(n + 1, np.int64))
                row = np.repeat(np.arange(n), np.diff(edges))
                whole = np.bincount(row, 1 - aligner.numbers[slot, 4], n) == 0
                sums = [np.bincount(row, aligner.numbers[slot, i], n).astype(np.int64) * whole for i in range(4)]
                # each document's distinct parts, then their distinct pairs, with occurrences
                part, times = np.unique(row[whole[row]] * (len(aligner.groups) + 1) + slot[whole[row]], return_counts=True)
                doc, part = np.divmod(part, len(aligner.groups) + 1)
                code = aligner.pairs[spread(aligner.start[part], aligner.size[part])]
                owner, times = np.repeat(doc, aligner.size[part]), np.repeat(times, aligner.size[part])
                own, back = np.unique(owner << 32 | code.astype(np.int64), return_inverse=True)
                times = np.bincount(back, times, len(own)).astype(np.int64)
                owner, code = own >> 32, (own & 0xFFFFFFFF).astype(np.uint32)
                distinct, which, held_by = np.unique(code, return_inverse=True, return_counts=True)
                place = pairs.places(distinct)
                pairs.documents[place] += held_by
                place = place[which]
                order = np.lexsort((place, owner))
                owner, place, times = owner[order], place[order], times[order]
                limit = np.searchsorted(owner, np.arange(n + 1))
                rows = []
                for k in range(n):
                    groups = b";".join([aligner.groups[i] for i in slot[edges[k] : edges[k + 1]].tolist()]) if whole[k] and some[k] else b""
                    own = place[limit[k] : limit[k + 1]]
                    rows.append((block(), keys[first + k], *[int(s[k]) for s in sums], hashlib.sha256(groups).hexdigest() if groups else "",
                                 groups.decode() if with_groups else None, _squeezed(np.diff(own, prepend=0)), _squeezed(times[limit[k] : limit[k + 1]]), None, None))
                yield batch_of(rows)
                held += len(data)
                if held >= BLOCK_BYTES:
                    yield dictionary()
                    pairs, number, held = Pairs(), number + 1, 0
        if len(pairs.codes):
            yield dictionary()

    rows = docs.select(F.col(key).cast("bigint").alias(key), text)
    return with_small_batches(rows).mapInArrow(run, columns)


def pair_counts(rows: DataFrame) -> DataFrame:
    """(code, n, best) from the blocks' dictionaries: documents that hold the pair, and whether no pair of its A id has more."""
    entries = rows.filter("codes is not null").select(F.explode(F.arrays_zip("codes", "documents")).alias("e"))
    counted = entries.groupBy(F.col("e.codes").alias("code")).agg(F.sum("e.documents").alias("n"))
    counted = staged(rows.sparkSession, counted, "pair-counts")
    highest = counted.groupBy(F.shiftright("code", _B_BITS).alias("a")).agg(F.max("n").alias("most"))
    return counted.join(highest, F.shiftright("code", _B_BITS) == F.col("a")).select("code", "n", (F.col("n") == F.col("most")).alias("best"))


def alignment(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, text: str = "text", key: str = "doc_id",
              with_groups: bool = False) -> DataFrame:
    """One row per document: its numbers of tokens, groups and links, ``n_best``, ``count_sum``, ``groups_sha256`` and ``groups`` (on demand)."""
    spark = docs.sparkSession
    rows = staged(spark, aligned(docs, path_a, path_b, text, key, with_groups), "aligned")
    entries = rows.filter("codes is not null").select(F.col("block").alias("of_block"), F.posexplode("codes").alias("place", "code"))
    known = entries.join(pair_counts(rows), "code").select("of_block", "place", "n", "best")
    documents = rows.filter("codes is null").drop("codes", "documents")
    columns = f"{_DOCUMENT}, n_best bigint, count_sum bigint, groups_sha256 string, groups string"

    def summed(left, right):
        import pyarrow as pa

        worker_memory("alignment sums")  # the parts that this worker remembered are not needed any more
        place = right.column("place").to_numpy()
        n, best = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
        n[place], best[place] = right.column("n").to_numpy(), right.column("best").to_numpy(zero_copy_only=False)
        sums = []
        for p, t in zip(left.column("places"), left.column("times"), strict=True):
            own, times = np.cumsum(_spread_out(p.as_py())), _spread_out(t.as_py())
            sums.append((int((best[own] * times).sum()), int((n[own] * times).sum())))
        kept = [left.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")]
        made = [pa.array([s[i] for s in sums], pa.int64()) for i in range(2)]
        return pa.table([*kept, *made, left.column("groups_sha256"), left.column("groups")], names=[c.split()[0] for c in columns.split(", ")])

    return documents.groupBy("block").cogroup(known.groupBy("of_block")).applyInArrow(summed, columns)


def op12_shared_cut_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")).drop("groups")
