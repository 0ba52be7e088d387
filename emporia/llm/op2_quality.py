"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger keeps the measurements and one bit per
failed rule; policies (named, versioned bit masks) and ablations are then bit arithmetic on the
ledger, without another look at the texts.

``toxic_words`` is a fixed English list. ``toxic_starts`` is learnt from labels: per language, word
starts that mark toxic documents when they occur often enough (``learn_starts``). Without a model
no document fails it; policy ``v3`` has all rules, ``v2`` those that ``OP2_SQL`` states.

Defined results. NULL or empty text: all measurements 0, fails ``few_words``. Repeated rows are
measured each on its own. A document whose language is NULL or was not learnt is held against the
learnt starts of every language. Extra columns are carried by ``ledger`` unless a measurement has the
same name, which then wins. An empty table gives an empty ledger.
"""

from __future__ import annotations

import math
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import SPACE, sampled, staged

# Insults that count as toxic words.
TOXIC_WORDS = "clown disgusting idiot loser moron pathetic scum stupid trash worthless".split()

#: Rules in bit order: name, and the condition over the measurements under which it fails.
RULES = [
    ("few_words", "n_words < 50"),
    ("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    ("symbols", "10 * n_symbols > n_words"),
    ("duplicate_lines", "10 * n_dup_lines > 3 * n_lines"),
    ("word_length", "word_chars < 2 * n_words or word_chars > 12 * n_words"),
    ("capitals", "10 * n_capitals > 3 * word_chars"),
    ("exclamations", "5 * n_exclamations > n_words"),
    ("toxic_words", "n_toxic >= 2"),
    ("toxic_starts", "n_toxic_starts >= 1"),
]
BIT = {name: 1 << i for i, (name, _) in enumerate(RULES)}

#: Policy versions: the rules whose failure rejects a document.
POLICIES = {
    "base": ["few_words", "repeated_words"],
    "v1": ["few_words", "repeated_words", "symbols", "duplicate_lines", "word_length", "capitals", "exclamations"],
    "v2": [name for name, _ in RULES if name != "toxic_starts"],
    "v3": [name for name, _ in RULES],
}
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals",
            "n_exclamations", "n_toxic", "n_toxic_starts"]

#: Labelled documents that the starts are learnt from: about so many toxic ones and so many clean ones.
SAMPLE_TOXIC, SAMPLE_CLEAN = 2000, 4000
#: Lengths of a word start; occurrences that a rule may ask for; candidates kept for each language.
START_LENGTHS, LEAST, CANDIDATES = (3, 10), (1, 2, 3), 64
#: Least share of toxic documents among those that a learnt rule rejects.
PRECISION = 0.75
_LETTER = r"[\p{L}\p{N}]"

#: Low bits of a packed window that hold its position; the bits above hold the window's hash.
_POSITION_BITS = 27


def mask(policy: str) -> int:
    return sum(BIT[name] for name in POLICIES[policy])


def _chars_left(text: Column, drop: str) -> Column:
    return F.length(F.regexp_replace(text, drop, ""))


def _repeat_words(repeated: Column) -> Column:
    """Words that lie in a three-word window which the text holds twice or more.

    ``repeated``: sorted positions of those windows. Each covers its own word and the two after
    it, less what the next repeated window covers anyway.
    """
    three = F.lit(3).cast("long")
    gain = F.transform(repeated, lambda x, j: F.least(three, F.coalesce(F.get(repeated, j + 1) - x, three)))
    return F.aggregate(gain, F.lit(0).cast("long"), lambda a, x: a + x)


def _gain(tp: float, fp: float, toxic: float, clean: float) -> float:
    """Nats by which splitting (toxic, clean) into what a rule rejects and the rest explains the labels better."""
    part = lambda a, b: sum(x * math.log(x / (a + b)) for x in (a, b) if x > 0)
    return part(tp, fp) + part(toxic - tp, clean - fp) - part(toxic, clean)


def _level(c: int):
    return lambda x: F.struct(x.alias("start"), F.lit(c).alias("c"))


def learn_starts(docs: DataFrame, labels: DataFrame, text: str = "text", lang: str = "lang") -> dict[str | None, list[tuple[str, int]]]:
    """Per language, rules (word start, least occurrences): a document that satisfies one is toxic.

    Each rule must explain the labels that the rules before it leave open better than chance would
    with that many candidates, so few labels give few rules or none. Fitted on a bounded sample of
    labelled documents; counts are taken by Spark, and only the candidates' occurrences reach the driver.
    """
    labelled = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    some = sampled(labelled.filter("toxic = 1"), ["doc_id"], SAMPLE_TOXIC, 5).unionByName(
        sampled(labelled.filter("toxic = 0"), ["doc_id"], SAMPLE_CLEAN, 5))
    some = F.broadcast(some)  # of bounded size, so the texts need not move
    words = F.regexp_extract_all(F.lower(F.col(text)), F.lit(f"{_LETTER}+"), F.lit(0))
    seen = docs.select("doc_id", F.col(lang).alias("lang"), text).join(some, "doc_id").select(
        F.monotonically_increasing_id().alias("row"), "lang", "toxic", F.coalesce(words, F.array().cast("array<string>")).alias("words"))
    seen = staged(docs.sparkSession, seen, "labelled-words")

    # per document its starts in order, so equal ones are neighbours: no row moves to count them
    low, high = START_LENGTHS
    cut = lambda w: F.transform(F.sequence(F.lit(low), F.least(F.lit(high), F.length(w))), lambda k: F.substring(w, F.lit(1), k))
    starts = F.flatten(F.transform(F.filter("words", lambda w: F.length(w) >= low), cut))
    ordered = seen.select("row", "lang", "toxic", F.sort_array(starts).alias("a"))
    at = lambda d: F.filter("a", lambda x, i: F.get(F.col("a"), i + d) == x)
    reached = F.concat(*[F.transform(F.array_distinct(at(c - 1)), _level(c)) for c in LEAST])
    per_doc = ordered.select("row", "lang", "toxic", F.explode(reached).alias("r")).select("row", "lang", "toxic", "r.start", "r.c")

    totals = labelled.groupBy("toxic").count().collect()
    share = {r.toxic: r["count"] for r in totals}
    taken = {r.toxic: r["count"] for r in some.groupBy("toxic").count().collect()}
    weigh = {t: share.get(t, 0) / taken[t] if taken.get(t) else 1.0 for t in (0, 1)}
    sizes = defaultdict(lambda: [0, 0])
    for r in seen.groupBy("lang", "toxic").count().collect():
        sizes[r.lang][r.toxic] = r["count"]

    # starts with the same counts and beginning count as one (the longest); the surest ones become candidates
    hit = lambda t, c: F.count(F.when((F.col("toxic") == t) & (F.col("c") == c), 1))
    counts = per_doc.groupBy("lang", "start").agg(*[hit(t, c).alias(f"h{t}{c}") for t in (0, 1) for c in LEAST]).filter("h11 >= 3")
    cells = [f"h{t}{c}" for t in (0, 1) for c in LEAST]
    counts = counts.groupBy("lang", F.substring("start", 1, low).alias("s"), *cells).agg(F.max_by("start", F.length("start")).alias("start"))
    sure = F.greatest(*[F.when(F.col(f"h1{c}") * weigh[1] >= PRECISION * (F.col(f"h1{c}") * weigh[1] + F.col(f"h0{c}") * weigh[0]), F.col(f"h1{c}")).otherwise(0)
                        for c in LEAST])
    counts = counts.select("lang", "start", sure.alias("sure"))
    surest = F.slice(F.sort_array(F.collect_list(F.when(F.col("sure") >= 3, F.struct("sure", "start"))), asc=False), 1, CANDIDATES)
    ranked = counts.groupBy("lang").agg(F.count(F.lit(1)).alias("tried"), surest.alias("c")).collect()
    tried = {r.lang: r.tried for r in ranked}
    best = [(r.lang, x.start) for r in ranked for x in r.c]
    if not best:
        return {}
    # an Arrow table: rows of Python objects would go through Python workers
    wanted = docs.sparkSession.createDataFrame(pa.table({"l": pa.array([x for x, _ in best], pa.string()), "s": pa.array([x for _, x in best], pa.string())}))
    occurs = defaultdict(lambda: defaultdict(list))
    for r in per_doc.join(F.broadcast(wanted), F.col("lang").eqNullSafe(F.col("l")) & (F.col("start") == F.col("s"))).select("row", "lang", "toxic", "start", "c").collect():
        occurs[r.lang][r.start, r.c].append((r.row, r.toxic))

    model = {}
    for name, found in occurs.items():
        rules, done = [], set()
        clean, toxic = sizes[name]
        bar = math.log(100 * len(LEAST) * max(tried[name], 1))
        while True:
            options = []
            for (start, least), rows in found.items():
                ids = [(d, t) for d, t in rows if d not in done]
                tp = sum(t for _, t in ids)
                fp = len(ids) - tp
                if tp and tp * weigh[1] >= PRECISION * (tp * weigh[1] + fp * weigh[0]):
                    options.append((_gain(tp, fp, toxic, clean), len(start), start, -least, ids))
            top = max(options, key=lambda o: o[:4], default=None)
            if top is None or top[0] < bar:
                break
            rules.append((top[2], -top[3]))
            done |= {d for d, _ in top[4]}
            toxic -= sum(t for _, t in top[4])
            clean -= sum(1 - t for _, t in top[4])
        if rules:
            model[name] = rules
    return model


def _failed_starts(low: Column, lang: Column, model: dict | None) -> Column:
    """Number of learnt rules of the document's language that it satisfies."""
    none = F.lit(0).cast("long")

    def failed(rules: list[tuple[str, int]]) -> Column:
        names = sorted({s for s, _ in rules}, key=len, reverse=True)
        hits = F.regexp_extract_all(low, F.lit(rf"(?<!{_LETTER})(?:{'|'.join(names)})"), F.lit(0))

        def satisfied(found: Column, start: str, least: int) -> Column:
            return F.when(F.size(F.filter(found, lambda x: x.startswith(start))) >= least, 1).otherwise(0)

        number = F.transform(F.array(hits), lambda h: sum((satisfied(h, *r) for r in rules), F.lit(0)))[0]
        may = F.greatest(F.lit(False), *[low.contains(s) for s in names])
        return F.when(may, number.cast("long")).otherwise(none)

    model = {k: v for k, v in (model or {}).items() if v}
    if not model:
        return none
    every = sum((failed(r) for r in model.values()), none)
    out = None
    for name, rules in model.items():
        if name is not None:
            out = (F if out is None else out).when(lang == name, failed(rules))
    return every if out is None else out.otherwise(every)


def measured(docs: DataFrame, text: str = "text", model: dict | None = None) -> DataFrame:
    """``docs`` with the measurements as long columns (native expressions only).

    Windows are hashed, packed with their position into one long and sorted, so equal windows
    become neighbours. Each step is a column of its own that the next reads more than once, so
    that Spark computes it once and sorts plain long arrays.
    """
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in MEASURES]
    long = lambda c: c.cast("long")
    keep = F.lit((1 << _POSITION_BITS) - 1)
    w, h, p, at, low, t = (F.col(f"__{x}") for x in ("w", "h", "p", "at", "low", "t"))

    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    df = docs.select(*kept, F.coalesce(F.col(text), F.lit("")).alias("__t"), lang.alias("__lang"))
    df = df.select(*kept, t, "__lang", F.lower(t).alias("__low"), F.array_remove(F.split(t, SPACE), "").alias("__w"),
                   F.filter(F.split(t, "\n"), lambda s: s.rlike(r"[^\x20\x09-\x0D]")).alias("__l"))
    hashes = F.transform(w, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))
    found = F.greatest(*[low.contains(x) for x in TOXIC_WORDS])
    words = rf"\b(?:{'|'.join(TOXIC_WORDS)})\b"
    df = df.select(
        *kept,
        long(F.size(w)).alias("n_words"),
        long(_chars_left(t, SPACE)).alias("word_chars"),
        long(F.length(t) - _chars_left(t, r"[#*$%&|<>]")).alias("n_symbols"),
        long(F.size("__l") - F.size(F.array_distinct("__l"))).alias("n_dup_lines"),
        long(F.size("__l")).alias("n_lines"),
        long(_chars_left(t, r"\P{Lu}+")).alias("n_capitals"),
        long(F.length(t) - F.length(F.replace(t, F.lit("!"), F.lit("")))).alias("n_exclamations"),
        long(F.when(found, F.size(F.regexp_extract_all(low, F.lit(words), F.lit(0)))).otherwise(0)).alias("n_toxic"),
        _failed_starts(low, F.col("__lang"), model).alias("n_toxic_starts"),
        F.when(F.size(w) >= 4, F.slice(hashes, F.lit(1), F.size(w) - 2)).alias("__h"),
    )
    rest = [F.col(m) for m in MEASURES if m != "n_repeat_words"]
    packed = F.transform(h, lambda x, i: F.shiftleft(x, _POSITION_BITS).bitwiseOR(i))
    df = df.select(*kept, *rest, h, F.when(F.size(F.array_distinct(h)) < F.size(h), F.sort_array(packed)).alias("__p"))

    def same(j):
        window = lambda k: F.get(h, F.get(p, k).bitwiseAND(keep).cast("int"))
        return F.coalesce(window(j) == window(j + 1), F.lit(False))

    hit = F.filter(p, lambda x, j: same(j) | ((j > 0) & same(j - 1)))
    df = df.select(*kept, *rest, F.sort_array(F.transform(hit, lambda x: x.bitwiseAND(keep))).alias("__at"))
    return df.select(*kept, *rest, F.coalesce(_repeat_words(at), F.lit(0).cast("long")).alias("n_repeat_words"))


def ledger(docs: DataFrame, text: str = "text", model: dict | None = None) -> DataFrame:
    """Measurements and ``failed_bits`` (long): one bit per rule that the document fails.

    ``model``: what ``learn_starts`` gave, or None for the fixed rules alone.
    """
    bits = F.lit(0).cast("long")
    for name, fails in RULES:
        bits = bits.bitwiseOR(F.when(F.expr(fails), F.lit(BIT[name])).otherwise(F.lit(0)).cast("long"))
    m = measured(docs, text, model)
    kept = [F.col(f"`{c}`") for c in m.columns if c not in (*MEASURES, "failed_bits")]
    # the row's findings leave as the one item of a generator: a filter or column over them reads what was
    # computed, where a plain projection would be copied into it and run again for each use
    found = F.struct(*MEASURES, bits.alias("failed_bits"))
    return m.select(*kept, F.explode(F.array(found)).alias("__found")).select(*kept, "__found.*")


def passes(policy: str, bits: Column | str = "failed_bits") -> Column:
    """Whether a ledger row satisfies a policy version."""
    c = F.col(bits) if isinstance(bits, str) else bits
    return c.bitwiseAND(F.lit(mask(policy)).cast("long")) == 0


def ablation(ledger_rows: DataFrame, policy: str = "v2") -> DataFrame:
    """Per rule of a policy: documents that fail it, fail it alone, and are kept without it.

    One pass: the ledger is first counted per distinct bit pattern (2^rules rows at most).
    """
    seen = ledger_rows.groupBy(F.col("failed_bits").bitwiseAND(F.lit(mask(policy)).cast("long")).alias("bits")).agg(
        F.count(F.lit(1)).alias("n"))
    rules = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(BIT[r]).cast("long").alias("bit")) for r in POLICIES[policy]]))
    return (seen.select("bits", "n", rules.alias("r"))
            .groupBy(F.col("r.rule").alias("rule"))
            .agg(F.sum(F.when(F.col("bits").bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
                 F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("n_failed_alone"),
                 F.sum(F.when(F.col("bits").bitwiseAND(F.bitwise_not(F.col("r.bit"))) == 0, F.col("n")).otherwise(0)).alias("n_kept_without"),
                 F.bit_or("bits").alias("bits_seen")))


def op2_quality_ledger(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = ledger(docs)
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       (~passes("base")).alias("base_failed"), passes("v2").alias("kept"), "failed_bits")


def op2_quality_ledger_learnt(spark, sf_dir: str) -> DataFrame:
    """The ledger with the learnt rule's bit, and what the third policy keeps."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    model = learn_starts(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return ledger(docs, model=model).select("doc_id", *MEASURES, (~passes("base")).alias("base_failed"), passes("v3").alias("kept"), "failed_bits")


OP2_SQL = r"""
with d as (select doc_id, coalesce(text, '') as t from documents),
w as (select doc_id, t, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') as w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l from d),
g as (select doc_id, t, w, l, case when len(w) < 3 then [] else
        list_transform(range(1, len(w) - 1), lambda i: {'i': i, 'g': w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]}) end as g from w),
e as (select doc_id, u.g as g, u.i as i from (select doc_id, unnest(g) as u from g)),
r as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, g) as n from e) where n >= 2),
p as (select distinct doc_id, i + k as i from r, (values (0), (1), (2)) v(k)),
c as (select doc_id, count(*) as n from p group by doc_id),
m as (select g.doc_id, len(w)::bigint as n_words, length(array_to_string(w, ''))::bigint as word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
        (len(l) - len(list_distinct(l)))::bigint as n_dup_lines, coalesce(c.n, 0)::bigint as n_repeat_words,
        len(l) as n_lines, length(regexp_replace(t, '\P{Lu}', '', 'g')) as n_capitals,
        length(regexp_replace(t, '[^!]', '', 'g')) as n_exclamations,
        len(regexp_extract_all(lower(t), '\b(?:clown|disgusting|idiot|loser|moron|pathetic|scum|stupid|trash|worthless)\b')) as n_toxic
      from g left join c on g.doc_id = c.doc_id),
b as (select *, (case when n_words < 50 then 1 else 0 end) + (case when 100 * n_repeat_words > 50 * n_words then 2 else 0 end)
        + (case when 10 * n_symbols > n_words then 4 else 0 end) + (case when 10 * n_dup_lines > 3 * n_lines then 8 else 0 end)
        + (case when word_chars < 2 * n_words or word_chars > 12 * n_words then 16 else 0 end)
        + (case when 10 * n_capitals > 3 * word_chars then 32 else 0 end)
        + (case when 5 * n_exclamations > n_words then 64 else 0 end) + (case when n_toxic >= 2 then 128 else 0 end) as bits from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (bits & 3) <> 0 as base_failed, bits = 0 as kept, bits::bigint as failed_bits from b
"""
