"""Secret scan: fixed patterns, and character Markov models compared by log-likelihood ratio.

Two first-order character models are trained from labelled samples: random strings (the values
that the fixed patterns find in the sample, and drawn strings over the usual key alphabets) and
ordinary identifiers (the sample's words, alone and joined as people join names). A run of key
characters that no pattern covers becomes a finding of kind ``random`` when the first model
explains it better than the second by ``THRESHOLD`` nats per character.

Only the fit uses a bounded sample (about ``sample_docs`` documents, chosen by a hash);
the scan reads every text whole. Native expressions only.

Defined results. NULL or empty text: no spans. Repeated rows are scanned each on its own; an
empty table trains on the drawn strings alone and gives no rows. Extra columns are carried by
``find_secrets`` unless they are named ``spans``.
"""

from __future__ import annotations

import math
import random
import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emporia.llm.common import sampled

#: kind, pattern, group that holds the value, least length of that group (dropped below it).
BASE = [
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
]
# Words that names in programs and texts are made of.
PLAIN_WORDS = """about account action after again always amount another application archive array available background backup balance before
between block boolean buffer button cache callback change channel character children class client collection column command comment
common complete component condition config connection content context control convert count country create current customer data
database date default delete description detail device dictionary directory display document domain double download element email
enable encode error event example exception execute export extension factory failure feature field file filter folder format
function general generate global group handler header height history identifier image important index information instance integer
interface internal invoice keyword language library license linear list local location manager message method minimum model module
monitor name network notification number object option order ordinary output package parameter parent path pattern payment people
plain position previous primary process product profile project property public query random record reference register request
resource response result return schema school search section security selected sequence server service session setting simple
source standard start status storage string structure system table target template through thread timeout together transaction
transport update upload username validate value variable version virtual visible warning window without working""".split()

#: Cheap tests that a text with a match passes.
_MAY = {"assign": r"(?i:passw|secret|token|api_?key)", "access": r"AKIA[A-Z0-9]{16}", "hex": r"[0-9a-f]{24}"}
KINDS = [k for k, *_ in BASE] + ["random"]
#: What the Markov models look at: runs of key characters.
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
THRESHOLD = 0.5
#: Bound of the sample that the models are fitted on.
SAMPLE_DOCS = 2000
#: Drawn random strings for each alphabet.
DRAWN = 400

_SPAN = "array<struct<start:int,kind:int,end:int,value:string>>"


def _let(value: Column, body) -> Column:
    return F.transform(F.array(value), body)[0]


def _spans(text: Column, kind: int, pattern: str, group: int, least: int) -> Column:
    """Spans of a pattern's matches, left to right: what lies between them gives their places."""
    parts = F.arrays_zip(F.split(text, pattern).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"),
                         F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value"))
    none = F.array().cast(_SPAN)

    def step(acc: Column, x: Column) -> Column:
        start = acc["pos"] + F.length(x["gap"])
        end = start + F.coalesce(F.length(x["hit"]), F.lit(0))
        new = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), x["value"].alias("value"))
        return F.struct(end.alias("pos"), F.when(F.length(x["value"]) >= least, F.concat(acc["out"], F.array(new).cast(_SPAN))).otherwise(acc["out"]).alias("out"))

    return F.aggregate(parts, F.struct(F.lit(0).alias("pos"), none.alias("out")), step, lambda a: a["out"])


def base_spans(text: Column) -> Column:
    """Findings of the fixed patterns by start, then kind in the listed order."""
    none = F.array().cast(_SPAN)
    return F.array_sort(F.concat(*[F.when(text.rlike(_MAY[k]), _spans(text, i, p, g, n)).otherwise(none) for i, (k, p, g, n) in enumerate(BASE)]))


def _pair_counts(words: list[str]) -> list[list[float]]:
    seen = [[0.0] * 128 for _ in range(128)]
    for word in words:
        before = 0
        for c in map(ord, word):
            if c < 128:
                seen[before][c] += 1
                before = c
    return seen


def _drawn_strings(rng: random.Random) -> list[str]:
    alphabets = [string.hexdigits[:16], string.ascii_uppercase + string.digits, string.ascii_letters + string.digits,
                 string.ascii_letters + string.digits + "+/", string.ascii_letters + string.digits + "_-"]
    return ["".join(rng.choice(a) for _ in range(rng.randint(20, 44))) for a in alphabets for _ in range(DRAWN)]


def train(docs: DataFrame, text: str = "text", key: str = "doc_id", sample_docs: int = SAMPLE_DOCS) -> list[float]:
    """Log-likelihood ratios (random against ordinary) of 128 x 128 character pairs; row 0 is a start.

    Takes about ``sample_docs`` documents (never over four times that), of each at most 200 words and 20 labelled values, so
    what comes to the driver is bounded.
    """
    some = sampled(docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("t")), [key, "t"], sample_docs, 3)
    found = F.slice(F.transform(base_spans(F.col("t")), lambda s: s["value"]), 1, 20)
    words = F.slice(F.array_distinct(F.regexp_extract_all("t", F.lit(r"\b[A-Za-z]{3,}\b"), F.lit(0))), 1, 200)
    rows = some.select(found.alias("found"), words.alias("words")).collect()
    rng = random.Random(11)
    secrets = _drawn_strings(rng) + [v for r in rows for v in r.found if len(v) >= 16]
    names = [w for r in rows for w in r.words] + PLAIN_WORDS * max(1, sum(len(r.words) for r in rows) // (8 * len(PLAIN_WORDS)))
    parted = [f(w) for w in names for f in (str, str.capitalize)]
    joined = [rng.choice(["_", "-", "/", "+", "=", ""]).join(rng.sample(parted, 3)) for _ in range(len(names) // 3)]
    numbered = [f"{w}_{rng.randint(0, 2030)}" for w in names[:: 20]]
    key_chars = len(string.ascii_letters + string.digits) + 5
    good, plain = _pair_counts(secrets), _pair_counts(names + joined + numbered)
    table = []
    for a, b in zip(good, plain, strict=True):
        sa, sb = sum(a) + key_chars * 0.5, sum(b) + key_chars * 0.5
        table += [math.log((x + 0.5) / sa) - math.log((y + 0.5) / sb) for x, y in zip(a, b, strict=True)]
    return table


def log_ratio(run: Column, table: Column) -> Column:
    """Sum over the run's character pairs of the log-likelihood ratio."""
    def summed(codes: Column) -> Column:
        before = lambda i: F.when(i > 0, F.get(codes, i - 1)).otherwise(0)
        pairs = F.transform(codes, lambda c, i: F.get(table, before(i) * 128 + c))
        return F.aggregate(pairs, F.lit(0.0), lambda a, x: a + x)

    return _let(F.transform(F.split(run, ""), lambda c: F.ascii(c)), summed)


def find_secrets(docs: DataFrame, model: list[float], text: str = "text") -> DataFrame:
    """``docs`` with ``spans``: array of (start, kind number, end, value), in code points."""
    table = F.split(F.lit(",".join(map(repr, model))), ",").cast("array<double>")
    t = F.coalesce(F.col(text), F.lit(""))
    kept = [F.col(f"`{c}`") for c in docs.columns if c != "spans"]
    none = F.array().cast(_SPAN)
    df = docs.select(*kept, base_spans(t).alias("__base"), F.when(t.rlike(CANDIDATE), _spans(t, len(BASE), CANDIDATE, 0, 1)).otherwise(none).alias("__runs"))
    base = F.col("__base")
    free = F.filter("__runs", lambda r: ~F.exists(base, lambda b: (b["start"] < r["end"]) & (b["end"] > r["start"])))
    added = F.filter(free, lambda r: log_ratio(r["value"], table) > THRESHOLD * F.length(r["value"]))
    added = F.when(F.size("__runs") > 0, added).otherwise(none)
    return df.select(*kept, F.array_sort(F.concat(base, added)).alias("spans"))


def rendered(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column, by: str = "[secret]") -> Column:
    """The text with each run of overlapping spans replaced by a marker."""
    def step(acc: Column, s: Column) -> Column:
        gap = F.when(s["start"] >= acc["pos"], F.concat(F.substring(text, acc["pos"] + 1, s["start"] - acc["pos"]), F.lit(by))).otherwise("")
        return F.struct(F.greatest(acc["pos"], s["end"]).alias("pos"), F.concat(acc["out"], gap).alias("out"))

    start = F.struct(F.lit(0).alias("pos"), F.lit("").alias("out"))
    whole = F.aggregate(spans, start, step, lambda a: F.concat(a["out"], F.substring(text, a["pos"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, whole).otherwise(text)


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find_secrets(docs, train(docs))
    base = F.filter("spans", lambda s: s["kind"] < len(BASE))
    count = lambda i: F.size(F.filter("spans", lambda s: s["kind"] == i)).cast("long")
    return found.select("doc_id", *[count(i).alias(f"n_{k}") for i, (k, *_) in enumerate(BASE)],
                        F.sha2(rendered(base), 256).alias("base_sha256"), rendered(F.col("spans")).alias("spans"))
