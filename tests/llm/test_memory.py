"""What Python workers hold while they work, and what they keep afterwards."""

import subprocess
import sys
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from emporia.llm import op1_suffix_tree as op1
from emporia.llm import op6_language as op6

MB = 1 << 20


class Captured:
    """Stands for a frame: gives the function that a task would run."""

    def __getattr__(self, _):
        return lambda *_a, **_b: self

    def mapInArrow(self, run, _schema):
        self.run = run
        return self

    def applyInArrow(self, run, _schema):
        self.run = run
        return self


@pytest.fixture(scope="module")
def batches():
    rng = np.random.default_rng(5)
    words = ["".join(chr(97 + c) for c in rng.integers(0, 26, rng.integers(2, 9))) for _ in range(3000)]
    texts = [" ".join(words[i] for i in rng.integers(0, len(words), 400)) for _ in range(3000)]
    table = pa.table({"text": texts, "lang": ["aa"] * len(texts), "train": [True] * len(texts), "block": [0] * len(texts)})
    return table.to_batches(max_chunksize=1000)


def peak(work) -> float:
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1] / MB
    finally:
        tracemalloc.stop()


def drained(run, batches):
    for _ in run(iter(batches)):
        pass


def test_op1_counts_strings_and_words_in_small_steps(batches, spark):  # noqa: ARG001
    frame = Captured()
    op1.string_counts(frame)
    assert peak(lambda: drained(frame.run, batches)) < 150
    op1.block_words(frame)
    assert peak(lambda: frame.run(pa.Table.from_batches(batches))) < 40


def test_op1_strings_are_summed_however_seldom_they_are_handed_on(batches, monkeypatch):
    def sums():
        frame, n = Captured(), {}
        op1.string_counts(frame)
        for b in frame.run(iter(batches[:1])):
            for d, k, c in zip(*(x.to_pylist() for x in b.columns), strict=True):
                n[d, k] = n.get((d, k), 0) + c
        return n

    want = sums()
    monkeypatch.setattr(op1, "HELD", 20_000)
    assert sums() == want
    monkeypatch.setattr(op1, "HELD", 3_000_000)
    monkeypatch.setattr(op1, "WAITING", 1000)
    assert sums() == want


def test_op6_counts_in_small_steps(batches, spark, monkeypatch):  # noqa: ARG001
    frame = Captured()
    monkeypatch.setattr(op6, "with_small_batches", lambda df: df)
    op6.trigram_counts(frame)
    assert peak(lambda: drained(frame.run, batches)) < 35


def test_a_worker_hands_back_the_memory_of_another_operator():
    code = """
import re
import numpy, pyarrow
from emporia.llm.common import worker_memory
rss = lambda: int(re.search(r"VmRSS:\\s+(\\d+)", open("/proc/self/status").read())[1]) / 1024
kept = worker_memory("one")
kept["table"] = [bytearray(50_000) for _ in range(3000)]
last = bytearray(50_000)  # on top of the heap
before = rss()
worker_memory("another")
print(before - rss())
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, timeout=120)
    assert float(out.stdout) > 100


def test_op2_learnt_starts_take_no_workers(spark, words, monkeypatch):  # noqa: ARG001
    from emporia.llm import op2_quality

    made, real = [], type(spark).createDataFrame
    rows = [(i, "you fool " + " ".join(words[i : i + 60]) if i % 2 else " ".join(words[i : i + 60]), "aa", int(i % 2)) for i in range(200)]
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id bigint, text string, lang string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    monkeypatch.setattr(type(spark), "createDataFrame", lambda self, data, *a, **b: made.append(type(data)) or real(self, data, *a, **b))
    op2_quality.learn_starts(docs, labels)
    assert all(kind is pa.Table for kind in made)
