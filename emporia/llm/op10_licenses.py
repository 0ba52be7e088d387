"""Licence scan by patience alignment.

A licence text (template) is aligned with a stretch of the document: words that are unique in both
are anchors, the longest increasing run of anchors stays, and the gaps between them are aligned the
same way. Coverage is the share of the template's words that are matched.

Where to look is exact, not a guess: a template's key words are chosen so that they make up more than
1 - ``COVERAGE`` of its words, so an alignment of that coverage matches at least one of them. Each place
of a key word in the text gives a stretch, the template laid over that word with some room. If that isn't
enough, the stretch goes on to where the last key word stands that follows in the template's order, however
far, and then to all of the text that is left: a text may have any number of foreign words inside (a page header,
code, other clauses). In such a long stretch
only words in runs of ``RUN`` or more count towards the coverage, since single words of a long text fall in
order by chance. One map over whole texts, without a shuffle.

Defined results. NULL or empty text: nothing found. Repeated rows are scanned each on its own. Of
findings that overlap, the one with more matched words stays, then higher coverage, then the
first template by name. An empty table gives no rows; extra columns are not looked at.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from emporia.llm.common import with_small_batches
from emporia.llm.license_texts import LICENSE_TEXTS

COVERAGE = 0.75
#: Least run of matched words that counts where a stretch has more room than the template. A template of fewer
#: than two runs is a phrase: it is found within its room, or not at all.
RUN = 4
_WORD = re.compile(r"[^\W_]+(?:\.\d+)*")
# Common words, the last choice for key words.
_COMMON = set("the of and or to in is be a any this for with not you may without by all other use on that it from at as no".split())


def words_of(text: str) -> tuple[list[str], list[int], list[int]]:
    """Lower-case words with their starts and ends."""
    found = list(_WORD.finditer(text))
    return [m[0].lower() for m in found], [m.start() for m in found], [m.end() for m in found]


def _rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest increasing subsequence by the second member; the pairs are in order of the first."""
    tops: list[int] = []
    last: list[int] = []
    before = [-1] * len(pairs)
    for i, (_, b) in enumerate(pairs):
        pile = bisect_left(tops, b)
        if pile == len(tops):
            tops.append(b)
            last.append(i)
        else:
            tops[pile], last[pile] = b, i
        before[i] = last[pile - 1] if pile else -1
    out, i = [], last[-1] if last else -1
    while i >= 0:
        out.append(pairs[i])
        i = before[i]
    return out[::-1]


def aligned(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Matched positions (in a, in b), both increasing."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a1, a2, b1, b2 = todo.pop()
        while a1 < a2 and b1 < b2 and a[a1] == b[b1]:
            out.append((a1, b1))
            a1, b1 = a1 + 1, b1 + 1
        while a1 < a2 and b1 < b2 and a[a2 - 1] == b[b2 - 1]:
            a2, b2 = a2 - 1, b2 - 1
            out.append((a2, b2))
        if a1 >= a2 or b1 >= b2:
            continue
        in_a, in_b = Counter(a[a1:a2]), Counter(b[b1:b2])
        place = {w: j for j, w in enumerate(b[b1:b2], b1) if in_b[w] == 1}
        anchors = _rising([(i, place[w]) for i, w in enumerate(a[a1:a2], a1) if in_a[w] == 1 and w in place])
        out += anchors
        if anchors:
            edges = [(a1 - 1, b1 - 1), *anchors, (a2, b2)]
            todo += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(edges, edges[1:], strict=False)]
    return sorted(out)


def in_runs(pairs: list[tuple[int, int]], least: int = RUN) -> list[tuple[int, int]]:
    """The pairs that lie in runs: so many or more that follow each other on both sides."""
    out, run = [], []
    for pair in [*pairs, None]:
        if run and (pair is None or pair != (run[-1][0] + 1, run[-1][1] + 1)):
            if len(run) >= least:
                out += run
            run = []
        if pair is not None:
            run.append(pair)
    return out


@dataclass
class Finding:
    name: str
    start: int
    end: int
    matched: int
    coverage: float


class Scanner:
    """Finds templates in texts."""

    def __init__(self, templates: dict[str, str], coverage: float = COVERAGE):
        import ahocorasick

        self.coverage = coverage
        self.templates = {n: words_of(t)[0] for n, t in templates.items()}
        spread = Counter(w for t in self.templates.values() for w in set(t))
        self.keys: dict[str, list[tuple[str, int, int]]] = {}
        for name, words in self.templates.items():
            count = Counter(words)
            covered = 0
            for w in sorted(count, key=lambda w: (w in _COMMON, -len(w) // 3, spread[w], w)):
                if covered > (1 - coverage) * len(words):
                    break
                places = [i for i, x in enumerate(words) if x == w]
                self.keys.setdefault(w, []).append((name, places[0], places[-1]))
                covered += count[w]
        self.finder = ahocorasick.Automaton()
        for w in self.keys:
            self.finder.add_word(w, w)
        self.finder.make_automaton()

    def find(self, text: str) -> list[Finding]:
        low = text.lower()
        hits = list(self.finder.iter(low)) if low else []
        if not hits:
            return []
        words, starts, ends = words_of(text)
        found: list[Finding] = []
        done: dict[str, int] = {}
        whole: set[str] = set()  # templates that were held against all the rest of the text
        places: dict[str, list[tuple[int, int, int]]] = {}  # a template's key words in the text: place, first and last place in the template
        for i, w in enumerate(words):
            for name, first, last in self.keys.get(w, ()):
                places.setdefault(name, []).append((i, first, last))
        for name, hits in places.items():
            template = self.templates[name]
            room = max(3, len(template) // 4)
            tried = -1  # the end of the last long stretch: what lies in it isn't tried again
            for k, (i, first, last) in enumerate(hits):
                if i < done.get(name, 0):
                    continue
                lo, hi = max(0, i - last - room), min(len(words), i + len(template) - first + room)
                pairs = aligned(template, words[lo:hi])
                if len(pairs) < self.coverage * len(template) and i > tried:
                    reach, at = hi, first
                    for j, begin, end in hits[k + 1 :]:
                        if j < reach or end > at:
                            reach, at = max(reach, min(len(words), j + len(template) - begin + room)), max(at, begin)
                    tried = max(reach if reach > hi else i, tried)
                    if len(template) < 2 * RUN:
                        continue
                    if reach > hi:
                        hi = reach
                        pairs = in_runs(aligned(template, words[lo:hi]))
                    if len(pairs) < self.coverage * len(template) and name not in whole:
                        whole.add(name)  # what stands before its key words may be far off too
                        lo, hi = done.get(name, 0), len(words)
                        pairs = in_runs(aligned(template, words[lo:]))
                if len(pairs) >= self.coverage * len(template):
                    a, b = lo + pairs[0][1], lo + pairs[-1][1]
                    found.append(Finding(name, starts[a], ends[b], len(pairs), len(pairs) / len(template)))
                    done[name] = b + 1
        found.sort(key=lambda f: (-f.matched, -f.coverage, f.name, f.start))
        kept: list[Finding] = []
        for f in found:
            if all(f.end <= k.start or f.start >= k.end for k in kept):
                kept.append(f)
        return sorted(kept, key=lambda f: f.start)


def scanned(docs: DataFrame, templates: dict[str, str] | None = None, coverage: float = COVERAGE, text: str = "text") -> DataFrame:
    """``docs`` without the text, with ``findings``: array of (license, start, end, coverage), in code points."""
    kept = [f for f in docs.schema if f.name not in (text, "findings")]
    texts = templates or LICENSE_TEXTS

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        scanner = Scanner(texts, coverage)
        kind = pa.list_(pa.struct([("license", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("coverage", pa.float64())]))
        for batch in batches:
            rows = [[{"license": f.name, "start": f.start, "end": f.end, "coverage": f.coverage} for f in scanner.find(x.as_py() or "")]
                    for x in batch.column(batch.schema.get_field_index(text))]
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(f.name)) for f in kept] + [pa.array(rows, kind)],
                                             names=[f.name for f in kept] + ["findings"])

    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept)
    return with_small_batches(docs).mapInArrow(run, schema + "findings array<struct<license:string,start:int,end:int,coverage:double>>")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scanned(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return found.selectExpr(
        "doc_id", "cast(size(findings) as bigint) as n_found",
        "array_join(array_sort(array_distinct(transform(findings, f -> f.license))), ',') as licenses",
        "coalesce(array_max(transform(findings, f -> f.coverage)), 0d) as best_coverage",
        "array_join(transform(findings, f -> concat_ws(':', f.license, f.start, f.end)), ',') as spans")
