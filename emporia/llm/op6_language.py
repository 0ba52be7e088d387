"""Language identification as a multilingual mixture, fitted by expectation-maximisation.

Training counts byte trigrams (A-Z lowered) of the labelled texts per language. A document's
words are the observations: a word's likelihood in a language is the product of its trigrams'.
Expectation-maximisation estimates the document's language proportions; the language set is the
one among the k most likely languages (k = 1, 2, ...) whose likelihood less a penalty per extra
language is largest.

Counting is one pass with sums per task; what reaches the driver is bounded by 1 / MIN_SHARE
trigrams a language. Scoring is one map without a shuffle.

Defined results. NULL text, or text without a letter: ``und``, score 0. Ties between languages go
to the first by name. Without any training text every document is ``und``. Repeated rows are
predicted each on its own; extra columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporia.llm.common import _LOWER, crc_of, release_memory, text_chunks, with_small_batches, word_spans, worker_memory

#: A trigram below this share of its language's trigrams counts as unseen.
MIN_SHARE = 1e-6
#: Rounds of expectation-maximisation.
ROUNDS = 12
#: Log-likelihood that one more language must gain: this times log(words + 1).
PENALTY = 6.0
#: Bytes scored at a time.
STEP = 1 << 20
#: Bytes counted at a time, about.
COUNT_BYTES = 512 << 10
UNKNOWN = "und"


def trigrams(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The trigram that ends at each byte; bytes before a row start read as a space."""
    low = _LOWER[data].astype(np.uint32)
    one, two = np.roll(low, 1), np.roll(low, 2)
    if len(low):
        starts = at[:-1][at[:-1] < len(low)]
        one[starts] = 32
        two[starts] = 32
        second = starts + 1
        second = second[second < len(low)]
        two[second] = 32
    return low | one << 8 | two << 16


def trigram_counts(train: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, gram, n) over all texts of ``train``."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        worker_memory("language")
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            langs = np.array(batch.column(batch.schema.get_field_index(lang)).to_pylist(), object)
            for first, data, at in text_chunks(batch, text, COUNT_BYTES):
                grams = trigrams(data, at)
                own = np.repeat(np.arange(len(at) - 1), np.diff(at))
                names, code = np.unique(langs[first : first + len(at) - 1].astype(str), return_inverse=True)
                key, n = np.unique(code[own].astype(np.int64) << 24 | grams, return_counts=True)
                for i, name in enumerate(names.tolist()):
                    mine = key >> 24 == i
                    g, c = key[mine] & 0xFFFFFF, n[mine]
                    if name in held:
                        g, back = np.unique(np.concatenate([held[name][0], g]), return_inverse=True)
                        c = np.bincount(back, np.concatenate([held[name][1], c])).astype(np.int64)
                    held[name] = g, c
        for name, (g, c) in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(g)), pa.array(g.astype(np.int32)), pa.array(c.astype(np.int64))], names=["lang", "gram", "n"])
        release_memory()

    rows = with_small_batches(train).filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(lang, text)
    return rows.mapInArrow(run, "lang string, gram int, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


@dataclass
class LanguageModel:
    """Languages by name; row of a trigram (-1: unseen); log probabilities, the last row unseen."""

    languages: list[str]
    grams: np.ndarray
    logs: np.ndarray

    def word_logs(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log-likelihood of each word in each language, and the word's row."""
        start, end = word_spans(data, at)
        grams = trigrams(data, at)
        place = np.minimum(np.searchsorted(self.grams, grams), len(self.grams) - 1)
        place[self.grams[place] != grams] = len(self.grams)
        total = np.zeros((len(data) + 1, len(self.languages)))
        np.cumsum(self.logs[place], axis=0, out=total[1:])
        return total[end] - total[start], np.searchsorted(at, start, "right") - 1

    def proportions(self, logs: np.ndarray, first: np.ndarray, row: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Language proportions of each document, and its log-likelihood. ``allowed``: languages of each."""
        count = np.bincount(row, minlength=len(first))[:, None]
        logs = np.where(allowed[row], logs, -np.inf)
        top = logs.max(axis=1, keepdims=True)
        weight = np.exp(logs - top)
        share = allowed / allowed.sum(axis=1, keepdims=True)
        for _ in range(ROUNDS):
            part = weight * share[row]
            part /= part.sum(axis=1, keepdims=True)
            share = np.add.reduceat(part, first) / count
        likely = np.log((weight * share[row]).sum(axis=1)) + top[:, 0]
        return share, np.add.reduceat(likely, first)

    def predict(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per row: proportions under the selected set, their language numbers' order, and whether it has a word."""
        n, size = len(at) - 1, len(self.languages)
        best = np.zeros((n, size))
        logs, row = self.word_logs(data, at)
        have = np.unique(row)
        if not len(have):
            return best, np.zeros(n, bool)
        first = np.searchsorted(row, have)
        row = np.searchsorted(have, row)
        words = np.bincount(row)
        share, _ = self.proportions(logs, first, row, np.ones((len(have), size), bool))
        alone = np.add.reduceat(logs, first)
        order = np.argsort(-share - 1e-9 * (alone == alone.max(axis=1, keepdims=True)), axis=1, kind="stable")
        single = alone.argmax(axis=1)
        chosen = np.zeros_like(share)
        chosen[np.arange(len(have)), single] = 1
        value = alone.max(axis=1)
        going = np.arange(len(have))
        for k in range(2, size + 1):
            allowed = np.zeros((len(going), size), bool)
            np.put_along_axis(allowed, order[going, :k], True, axis=1)
            mine = np.isin(row, going)
            new, likely = self.proportions(logs[mine], np.searchsorted(row[mine], going), np.searchsorted(going, row[mine]), allowed)
            likely -= PENALTY * (k - 1) * np.log(words[going] + 1)
            better = likely > value[going]
            chosen[going[better]], value[going[better]] = new[better], likely[better]
            going = going[better]
            if not len(going):
                break
        best[have] = chosen
        found = np.zeros(n, bool)
        found[have] = True
        return best, found


def train_model(train: DataFrame, text: str = "text", lang: str = "lang") -> LanguageModel:
    counts = trigram_counts(train, text, lang)
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    kept = counts.join(totals, "lang").filter(F.col("n") >= MIN_SHARE * F.col("total"))
    rows = kept.select("lang", "gram", "n").toPandas()  # at most 1 / MIN_SHARE rows a language
    languages = sorted(rows["lang"].unique().tolist())
    grams = np.unique(rows["gram"].to_numpy()).astype(np.uint32)
    table = np.full((len(grams) + 1, len(languages)), 0.5)
    np.add.at(table, (np.searchsorted(grams, rows["gram"].to_numpy()), np.searchsorted(languages, rows["lang"].to_numpy().astype(str)) if languages else []), rows["n"].to_numpy())
    return LanguageModel(languages, grams, np.log(table / table.sum(axis=0)))


def identified(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (its proportion) and ``languages``, the selected set by proportion."""
    new = ["lang_pred", "score", "languages"]
    kept = [f for f in docs.schema if f.name not in new]

    def has_letter(data: np.ndarray, at: np.ndarray) -> np.ndarray:
        low = _LOWER[data]
        plain = np.concatenate([[0], np.cumsum((low >= 97) & (low <= 122))])[at]
        found = np.diff(plain) > 0
        for i in np.flatnonzero(~found).tolist():
            found[i] = any(map(str.isalpha, data[at[i] : at[i + 1]].tobytes().decode()))
        return found

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        worker_memory("language")
        names = np.array([*model.languages, UNKNOWN], object)
        for batch in batches:
            pred, score, sets = [], [], []
            for _, data, at in text_chunks(batch, text, STEP):
                share, found = model.predict(data, at) if model.languages else (np.zeros((len(at) - 1, 1)), np.zeros(len(at) - 1, bool))
                found &= has_letter(data, at)
                top = np.where(found, share.argmax(axis=1), len(model.languages))
                pred += names[top].tolist()
                score += np.where(found, np.minimum(share.max(axis=1), 1.0), 0.0).tolist()
                order = np.argsort(-share, axis=1, kind="stable")
                sets += [[names[j] for j in o if s[j] > 0] if f else [] for o, s, f in zip(order, share, found, strict=True)]
            made = [pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(sets, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(f.name)) for f in kept] + made, names=[f.name for f in kept] + new)
        release_memory()

    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept)
    return docs.mapInArrow(run, schema + "lang_pred string, score double, languages array<string>")


def op6_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held_out = F.pmod(crc_of("doc_id"), F.lit(3)) == 1
    model = train_model(docs.filter(~held_out))
    found = identified(docs.select("doc_id", "text", held_out.alias("held_out")), model)
    return found.select("doc_id", "held_out", "lang_pred", "score", "languages")
