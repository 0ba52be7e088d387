"""Operators 11 to 13 against SQL or brute force, with the awkward rows of ``corpus``."""

import bisect
import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from emporia.llm import op11_term_at_a_time as op11
from emporia.llm import op12_alignment as op12
from emporia.llm import op13_simhash as op13

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile(op11.TERM)


# ------------------------------------------------------------------ 11
def slow_search(docs, items, k):
    lists = [(i, TERM.findall((t or "").translate(LOW))) for i, t in docs]
    lists = [(i, t) for i, t in lists if t]
    n_docs, n_terms = len(lists), sum(len(t) for _, t in lists)
    df = Counter(t for _, ts in lists for t in set(ts))
    terms = defaultdict(set)
    for item, text in items:
        terms[item] |= set(TERM.findall((text or "").translate(LOW)))
    out = []
    for item, ts in terms.items():
        scored = []
        for i, found in lists:
            tf, m = Counter(found), 100 - 50 + 50 * len(found) * n_docs // n_terms
            weight = lambda t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
            s = sum(weight(t) * (1_000_000_000 * tf[t] // (1000 * tf[t] + 20 * m)) for t in ts if tf[t])
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def items(spark, texts, words):
    rng = random.Random(9)
    rows = [(f"q{i}", " ".join(rng.choice(words) for _ in range(rng.randint(1, 30)))) for i in range(12)]
    rows += [("q0", "one more text of the same item " + words[0]), ("copy", texts[2][1]), ("none", None), ("blank", " . "), ("unseen", "zzzzqqqq"), ("odd", "É ü 中文")]
    return spark.createDataFrame([(*r, "x") for r in rows], "item_id string, text string, doc_id string")


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("k, block", [(50, 2_000_000), (3, 500), (1, 1)])
def test_search_equals_scoring_everything(spark, corpus, items, k, block, monkeypatch):
    monkeypatch.setattr(op11, "BLOCK", block)
    docs = corpus.unionByName(corpus.filter("doc_id in (3, 9)").withColumn("doc_id", F.lit(None).cast("bigint")))
    want = slow_search([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()], k)
    assert rows_of(op11.search(docs, items, k)) == want and want
    monkeypatch.setattr(op11, "ITEM_TERMS", 40)  # items go in several blocks
    assert rows_of(op11.search(docs, items, k)) == want


def test_accumulators_stop_once_no_newcomer_can_win():
    """A rare term decides; the common term's thousand other documents get no accumulator."""
    rows = np.arange(1000)
    lists = {0: (rows[:5], np.full(5, 900_000), 900_000), 1: (rows, np.full(1000, 500_000), 500_000)}
    best = op11.Best(3)
    created = op11.search_block(lists, [(0, 5000), (1, 10)], best, rows + 7, np.zeros(1000, bool))
    assert created == 5 and best.doc.tolist() == [7, 8, 9] and best.score[0] == 5000 * 900_000 + 10 * 500_000
    tie = op11.Best(3)  # bounds that only equal the bar may still tie with a smaller doc_id
    lists = {0: (rows[5:8], np.full(3, 10), 10), 1: (rows[:5], np.full(5, 10), 10)}
    op11.search_block(lists, [(0, 1), (1, 1)], tie, rows, np.zeros(1000, bool))
    assert tie.doc.tolist() == [0, 1, 2]


def test_vocabulary_compares_bytes():
    v = op11.Vocabulary([b"ab", b"abc", b"z"])
    low = np.frombuffer(b"ab abc q z", np.uint8)
    start, end = np.array([0, 3, 7, 9]), np.array([2, 6, 8, 10])
    assert v.number(low, start, end).tolist() == [0, 1, -1, 2]
    assert op11.Vocabulary([]).number(low, start, end).tolist() == [-1] * 4


def test_search_on_empty_tables(spark, corpus, items, empty):
    assert op11.search(empty, items).count() == 0
    assert op11.search(corpus, items.filter("item_id = 'none'")).count() == 0


# ------------------------------------------------------------------ 12
@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def slow_alignment(docs, tokenizers):
    a, b = tokenizers
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(x): x for x in plain}
    byte |= {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in plain)}
    kept = []
    for i, t in docs:
        text = (" " + t).encode() if t else b""
        ta = a.encode(" " + t, add_special_tokens=False).ids if t else []
        tb = b.encode(t) if t else []
        ba = [bytes(byte[c] for c in a.id_to_token(x)) for x in ta]
        bb = [bytes([int(p[3:5], 16)]) if b.is_byte(x) else p.replace("▁", " ").encode() for x in tb for p in [b.id_to_piece(x)]]
        if b"".join(ba) != text or b"".join(bb) != text:
            ta, tb, ba, bb = [], [], [], []
        ends = lambda v: [sum(map(len, v[: k + 1])) for k in range(len(v))] if len(v) < 400 else np.cumsum([len(x) for x in v]).tolist()
        ea, eb = ends(ba), ends(bb)
        cuts = sorted(set(ea) & set(eb))
        groups = [(ta[bisect.bisect_right(ea, x) : bisect.bisect_right(ea, y)], tb[bisect.bisect_right(eb, x) : bisect.bisect_right(eb, y)])
                  for x, y in zip([0, *cuts], cuts, strict=False)]
        links = []
        j = 0
        for k, x in enumerate(ta):
            lo, hi = ea[k] - len(ba[k]), ea[k]
            while j and eb[j - 1] > lo:
                j -= 1
            while j < len(tb) and eb[j] - len(bb[j]) < hi:
                if eb[j] > lo:
                    links.append((x, tb[j]))
                j += 1
        kept.append((i, ta, tb, groups, links))
    count = Counter(p for *_, links in kept for p in set(links))
    most = defaultdict(int)
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    out = []
    for i, ta, tb, groups, links in kept:
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        out.append((i, len(ta), len(tb), len(groups), len(links), sum(count[p] == most[p[0]] for p in links), sum(count[p] for p in links),
                    hashlib.sha256(text.encode()).hexdigest() if ta else "", text))
    return out


def test_alignment_equals_whole_texts(spark, corpus, tokenizers, monkeypatch):
    extra = ["a  b", " a", "a ", "\nab", "a\nb c\n\nd", "x\ty\r\nz", "café ﬁx", "a▁b", "<s>a</s> <|endoftext|>", "  x 　 y  \nz", "<0x41> q\x00r", " ", "  ", "\n"]
    more = spark.createDataFrame([(900 + i, t) for i, t in enumerate(extra)] + [(None, "null id")], "doc_id bigint, text string")
    docs = corpus.select("doc_id", "text").unionByName(more).repartition(3)
    want = slow_alignment([tuple(r) for r in docs.collect()], tokenizers)
    got = [tuple(r[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "groups"))
           for r in op12.alignment(docs, with_groups=True).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert sum(x[1] == 0 for x in want) == 3  # NULL, empty, and U+2581


def test_small_blocks_and_forgetful_workers_change_nothing(corpus, monkeypatch):
    docs = corpus.select("doc_id", "text")
    want = rows_of(op12.alignment(docs))
    monkeypatch.setattr(op12, "BLOCK_BYTES", 3000)
    monkeypatch.setattr(op12, "REMEMBERED", 50)
    assert rows_of(op12.alignment(docs)) == want


def test_parts_are_encoded_a_bounded_number_of_bytes_at_a_time():
    aligner = op12.PartAligner()
    sizes, real = [], aligner.encode
    aligner.encode = lambda parts: sizes.append(sum(map(len, parts))) or real(parts)
    parts = [f" w{i} and more".encode() for i in range(20_000)]
    aligner.align(parts)
    assert sum(sizes) == sum(map(len, parts)) and max(sizes) <= 64 << 10
    assert len(aligner.groups) == len(aligner.numbers) == len(parts) and aligner.size.sum() == len(aligner.pairs)
    assert (aligner.start[1:] == aligner.start[:-1] + aligner.size[:-1]).all()


def test_shared_cuts_are_the_common_ends():
    rng = np.random.default_rng(5)
    for _ in range(200):
        a_at, b_at, a, b, base = [0], [0], [], [], 0
        for _ in range(rng.integers(1, 6)):
            size = int(rng.integers(1, 60))
            ends = [sorted({*rng.choice(size, rng.integers(0, size), replace=False).tolist()} - {0}) + [size] for _ in range(2)]
            a += [base + x for x in ends[0]]
            b += [base + x for x in ends[1]]
            a_at.append(len(a))
            b_at.append(len(b))
            base += size
        cut = op12.shared_cuts(np.array(a), np.array(a_at), np.array(b), np.array(b_at))
        assert np.array(a)[cut].tolist() == sorted(set(a) & set(b))


def test_alignment_of_an_empty_table(empty):
    assert op12.alignment(empty).count() == 0


# ------------------------------------------------------------------ 13
def slow_fingerprint(text):
    w = WORD.findall((text or "").translate(LOW))
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    codes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(c >> b & 1 for c in codes) > len(codes))


def slow_components(prints, names):
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                parent[find(i)] = find(j)
    least = {}
    for i, name in enumerate(names):
        if name is not None:
            least[find(i)] = min(least.get(find(i), name), name)
    return [least.get(find(i)) for i in range(len(prints))]


def test_simhash_equals_brute_force(spark, corpus):
    docs = corpus.select("doc_id", "text").unionByName(spark.createDataFrame([(None, "a lone text without an id")], "doc_id bigint, text string"))
    rows = [tuple(r) for r in docs.collect()]
    prints = [slow_fingerprint(t) for _, t in rows]
    want = [(i, f"{p:016x}", c) for (i, _), p, c in zip(rows, prints, slow_components(prints, [i for i, _ in rows]), strict=True)]
    assert rows_of(op13.simhash_components(docs).drop("class_id")) == sorted(want, key=str)


def test_majority_over_long_rows(monkeypatch):
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 1 << 63, 500, dtype=np.uint64) * 2 + rng.integers(0, 2, 500, dtype=np.uint64)
    start = np.array([0, 0, 3, 300, 300, 499, 500])
    want = [sum(1 << b for b in range(64) if 2 * sum(int(c) >> b & 1 for c in codes[x:y]) > y - x) for x, y in zip(start[:-1], start[1:], strict=True)]
    for step in (1 << 16, 7):
        monkeypatch.setattr(op13, "_STEP", step)
        assert op13.majority(codes, start).tolist() == want


def test_chains_find_every_link_and_components_are_whole(spark):
    """Dense and sparse clusters of points, with chains whose ends are far apart, against all pairs."""
    rng = random.Random(6)
    points = {rng.getrandbits(64) for _ in range(40)} | {0, (1 << 64) - 1}
    for size, most in ((150, 5), (60, 3), (40, 8), (30, 1)):
        centre = rng.getrandbits(64)
        points |= {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, most))) for _ in range(size)}
    walk = rng.getrandbits(64)
    for _ in range(40):
        walk ^= sum(1 << b for b in rng.sample(range(64), rng.choice([2, 3, 3, 4])))
        points.add(walk)
    points = sorted(points)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    found = op13.linked(spark, spark.createDataFrame([(signed(p),) for p in points], "fp bigint"))
    got = {r.id: r.component for r in found.collect()}
    want = slow_components(points, [signed(p) for p in points])
    assert [got.get(signed(p), signed(p)) for p in points] == want
    assert len(set(want)) < len(points) / 2


def test_simhash_of_an_empty_table(empty):
    assert op13.simhash_components(empty).count() == 0


def test_postings_are_never_broadcast(spark):
    """An explode's rows count as its input's in Spark's estimates: a small table of points has 64 times as many postings."""
    points = spark.createDataFrame([(p,) for p in (0, 1, 3, 1 << 40)], "fp bigint")
    shared = op13.shared_keys(points.select("fp", F.explode(op13.chain_keys("fp")).alias("key")))
    assert "Broadcast" not in shared._jdf.queryExecution().executedPlan().toString()
    assert {r.fp for r in shared.collect()} == {0, 1, 3, 1 << 40}
