"""Byte-level BPE encoding and decoding by dynamic programming over prefixes.

For each byte prefix of a piece (one match of the split pattern) the table ``last`` stores the
last token of the prefix's encoding. It is unique: it is the one token ``t`` that ends the prefix
and that stands after the last token of what is left as the merge rules would leave it, i.e. the
two encode to themselves when put together. So an append only adds entries, and an edit only
recomputes the entries from the edited byte on; the ids are read by walking back from the end.

Texts are cut into parts that encode on their own (``parts.py``); a part seen before is looked up.

Defined results. NULL or empty text: no tokens. Repeated rows are encoded each on its own; extra
columns are carried by ``encoded`` unless they are named ``ids``.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporia.llm.common import text_chunks, with_small_batches, worker_memory
from emporia.llm.parts import PartTable, spread

#: Token pairs whose fit a worker remembers; beyond it the memory starts anew.
REMEMBERED = 2_000_000
_NEVER = 1 << 60


def vocabulary(path: str | None = None) -> dict[bytes, int]:
    """Ranks by token bytes. ``path``: a ranks file; None: the public one, found on the worker."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f) if a}


class PrefixEncoder:
    """Encodes pieces by the last token of every prefix."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.endings = {b[i:] for b in ranks for i in range(len(b))}
        self.fits: dict[tuple[int, int], bool] = {}
        self.histories: dict[int, tuple] = {}

    def merges(self, piece: bytes) -> tuple[list[bytes], list[tuple[int, bytes, bytes]]]:
        """The merge rules as they are defined, the lowest-ranked neighbours first.

        Returns the final parts and, per merge, its rank and the first and last part after it.
        """
        parts = [piece[i : i + 1] for i in range(len(piece))]
        history = []
        while len(parts) > 1:
            rank, i = min((self.ranks.get(parts[i] + parts[i + 1], _NEVER), i) for i in range(len(parts) - 1))
            if rank == _NEVER:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            history.append((rank, parts[0], parts[-1]))
        return parts, history

    def history(self, token: int) -> tuple[list[int], list[bytes], list[bytes]]:
        """Of a token on its own: ranks of its merges (``_NEVER`` at the end), first and last parts.

        The ranks are empty if the merge rules never make the token.
        """
        known = self.histories.get(token)
        if known is None:
            piece = self.bytes_of[token]
            parts, steps = self.merges(piece)
            ranks = [r for r, _, _ in steps] + [_NEVER] if len(parts) == 1 else []
            known = self.histories[token] = ranks, [piece[:1], *(x for _, x, _ in steps)], [piece[-1:], *(x for _, _, x in steps)]
        return known

    def follows(self, a: int, b: int) -> bool:
        """Whether token ``b`` may stand after token ``a``; -1 for ``a``: at the start.

        Both sides merge on their own, lower rank first and the left side first among equals,
        unless at some step the two parts at the border would merge before either.
        """
        known = self.fits.get((a, b))
        if known is not None:
            return known
        if len(self.fits) > REMEMBERED:
            self.fits.clear()
        right, first, _ = self.history(b)
        if a < 0 or not right:
            fits = bool(right)
        else:
            left, _, last = self.history(a)
            i = j = 0
            while True:
                across = self.ranks.get(last[i] + first[j], _NEVER)
                fits = across == _NEVER or across >= left[i] or across > right[j]
                if not fits or left[i] == right[j] == _NEVER:
                    break
                if left[i] <= right[j]:
                    i += 1
                else:
                    j += 1
        self.fits[a, b] = fits
        return fits

    def extend(self, piece: bytes, last: list[int]) -> list[int]:
        """``last[i]``: last token of the first i + 1 bytes; completes it for all of ``piece``."""
        ranks, endings, fits = self.ranks, self.endings, self.fits
        for end in range(len(last) + 1, len(piece) + 1):
            start, found = end - 1, []
            while start >= 0 and (tail := piece[start:end]) in endings:
                token = ranks.get(tail)
                if token is not None:
                    found.append((last[start - 1] if start else -1, token))
                start -= 1
            while found:
                pair = found.pop()
                ok = fits.get(pair)
                if self.follows(*pair) if ok is None else ok:
                    last.append(pair[1])
                    break
            else:
                raise ValueError(f"the vocabulary lacks byte {piece[end - 1]}")
        return last

    def encode_sorted(self, pieces: list[bytes]) -> Iterator[list[int]]:
        """Ids of pieces in sorted order; each starts from the prefix it shares with the one before."""
        before, last = b"", []
        for piece in pieces:
            same, most = 0, min(len(before), len(piece))
            while same < most and before[same] == piece[same]:
                same += 1
            last = self.extend(piece, last[:same])
            before = piece
            yield self.ids(last)

    def append(self, piece: bytes, last: list[int], more: bytes) -> tuple[bytes, list[int]]:
        """The piece with bytes added at its end: what is stored stays right."""
        return piece + more, self.extend(piece + more, list(last))

    def edit(self, piece: bytes, last: list[int], start: int, end: int, by: bytes) -> tuple[bytes, list[int]]:
        """The piece with bytes start..end replaced: entries before the edit stay right."""
        new = piece[:start] + by + piece[end:]
        return new, self.extend(new, last[:start])

    def ids(self, last: list[int]) -> list[int]:
        """Token ids, read from the end back."""
        out, at = [], len(last)
        while at:
            out.append(last[at - 1])
            at -= len(self.bytes_of[out[-1]])
        return out[::-1]


class TextEncoder:
    """Whole texts to ids and back."""

    def __init__(self, path: str | None = None, pattern: str | None = None):
        import regex

        if pattern is None:
            import public_tokenizers

            pattern = public_tokenizers.PATTERN
        self.split = regex.compile(pattern).findall
        self.core = PrefixEncoder(vocabulary(path))
        self.table = PartTable(self._make)
        size = max(self.core.bytes_of) + 1
        tokens = [self.core.bytes_of.get(i, b"") for i in range(size)]
        self.token_length = np.array([len(t) for t in tokens], np.int64)
        self.token_start = np.cumsum(self.token_length) - self.token_length
        self.token_bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def _make(self, parts: list[bytes]) -> list[list[int]]:
        cut = [[x.encode() for x in self.split(p.decode())] for p in parts]
        pieces = sorted({x for c in cut for x in c})
        ids = dict(zip(pieces, self.core.encode_sorted(pieces), strict=True))
        return [ids[c[0]] if len(c) == 1 else [i for x in c for i in ids[x]] for c in cut]

    def encode(self, batch, column: str = "text"):
        """Ids (uint32) of each text of an Arrow batch."""
        for _, data, at in text_chunks(batch, column):
            ids, ends = self.table.encode(data, at)
            yield from (ids[a:b] for a, b in pairwise(ends.tolist()))

    def decode(self, ids: np.ndarray) -> bytes:
        return self.token_bytes[spread(self.token_start[ids], self.token_length[ids])].tobytes()


def encoder_of(path: str | None = None, pattern: str | None = None) -> TextEncoder:
    """The worker's encoder: tasks that follow each other in a worker share what it remembers."""
    kept = worker_memory("bpe")
    if ("bpe", path, pattern) not in kept:
        kept["bpe", path, pattern] = TextEncoder(path, pattern)
    return kept["bpe", path, pattern]


def _map_texts(docs: DataFrame, columns: str, schema: str, rows, path: str | None, pattern: str | None, text: str) -> DataFrame:
    """``rows(encoder, ids)``: the new columns' values for one text, as a tuple."""
    names = [c.split()[0] for c in columns.split(",")]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        encoder = encoder_of(path, pattern)
        for batch in batches:
            made = [rows(encoder, x) for x in encoder.encode(batch, text)]
            kept = [(f.name, c) for f, c in zip(batch.schema, batch.columns, strict=True) if f.name != "__text" and f.name not in names]
            new = [pa.array(v, t) for v, t in zip(zip(*made, strict=True) if made else [[] for _ in names], schema(pa), strict=True)]
            yield pa.RecordBatch.from_arrays([c for _, c in kept] + new, names=[n for n, _ in kept] + names)

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "__text" and f.name not in names)
    return with_small_batches(docs).mapInArrow(run, f"{kept}, {columns}" if kept else columns)


def encoded(docs: DataFrame, path: str | None = None, pattern: str | None = None, text: str = "text") -> DataFrame:
    """``docs`` with ``ids``, an array of token ids."""
    return _map_texts(docs, "ids array<int>", lambda pa: [pa.list_(pa.int32())],
                      lambda e, x: (x.astype(np.int32),), path, pattern, text)


def decoded(rows: DataFrame, path: str | None = None, ids: str = "ids") -> DataFrame:
    """``rows`` with ``bytes``, what the ids stand for (NULL ids: empty)."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        tokens = {i: b for b, i in vocabulary(path).items()}
        for batch in batches:
            at = batch.schema.get_field_index(ids)
            made = [b"".join(tokens[i] for i in x.as_py() or []) for x in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.binary())], names=[*batch.schema.names, "bytes"])

    return rows.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", bytes binary")


def op5_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.col("text").alias("__text"))

    def digests(encoder: TextEncoder, ids: np.ndarray):
        return len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(), hashlib.sha256(encoder.decode(ids)).hexdigest()

    return _map_texts(docs, "n_tokens bigint, ids_sha256 string, decoded_sha256 string",
                      lambda pa: [pa.int64(), pa.string(), pa.string()], digests, None, None, "__text")
