"""Main-text extraction by a recurrent block labeller.

A page is read as the sequence of its leaf blocks: the text between block-level tags, with the path
of open tags above it. A bidirectional LSTM (numpy) reads for each block a vector of the hashed path
(tags, and the words of class, id and role), hashed words, and a few measures, and labels the block
as article or not with the whole page as context.

The labeller is trained here, on a bounded sample of about ``SAMPLE_PAGES`` pages. Their labels come from
the pages' own marks (article and main elements against navigation, notices, forms and so on);
each page is also trained on in other dress, with its parts renamed and boilerplate of other pages'
text put around and between them, so that the marks of a part count and not the words in it.
Extraction is one map over all pages without a shuffle.

Defined results. NULL or empty html, or no article block: empty text. Text of script, style and
the like is never a block. Broken markup: unclosed elements end with their parent; an end tag
without a start is skipped. Repeated rows are extracted each on its own; extra columns are not
looked at. An empty table gives no rows.
"""

from __future__ import annotations

import html as entities
import random
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporia.llm.common import sampled, with_small_batches

SAMPLE_PAGES = 160
#: Blocks of a training sequence; longer pages give several, from their beginning to their end.
TRAIN_BLOCKS = 60
PATH, WORDS, MEASURES = 512, 32, 6
HIDDEN = 16
EPOCHS = 10
SEED = 5

# Elements by role.
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark q ruby s samp small span strike strong sub sup time tt u var wbr "
             "math mfrac mi mn mo mover mpadded mphantom mroot mrow ms mspace msqrt mstyle msub msubsup msup mtext munder munderover semantics".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
SILENT = set("script style template noscript textarea svg annotation iframe object canvas audio video select option datalist".split())
#: Silent elements that hold plain text until they are closed; another one without its end is passed over alone.
RAW = set("script style textarea iframe".split())
BOILER_TAGS = set("head nav header footer aside form button dialog menu fieldset".split())
BOILER_WORDS = set(
    "ad ads advert advertisement advertising adsense banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert popup modal overlay "
    "sidebar side rail widget menu nav navbar navigation breadcrumb breadcrumbs topbar header masthead footer foot copyright comment comments comment-list respond reply "
    "replies discussion disqus share sharing social related recommended newsletter subscribe subscription signup login search form tags pagination pager toolbar".split())
MAIN_WORDS = set("article content main post entry story body text page".split())

# A comment, a tag, a tag with a quote that is never closed (it ends at the next >), a tag that the page's end cuts off, or a declaration.
_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^<>"']|"[^"]*"|'[^']*')*+)/?>|<(/?)([a-zA-Z][^\s/>"']*)([^<>]*)>|<[a-zA-Z][^<>]*\Z|<[!?][^>]*>""", re.S)
_MARK = re.compile(r"""(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_NAME = re.compile(r"[a-z]+(?:-[a-z]+)*|[A-Z][a-z]+")


@dataclass
class Block:
    text: str
    path: tuple[str, ...]  # one entry per open element: tag, then the words of its marks
    linked: int  # characters inside links


def blocks_of(page: str) -> list[Block]:
    """The page's leaf blocks in order."""
    out: list[Block] = []
    stack: list[tuple[str, str]] = []
    pieces: list[str] = []
    linked = 0

    def close() -> None:
        nonlocal linked
        text = " ".join("".join(pieces).split())
        if text:
            out.append(Block(text, tuple(e for t, e in stack if t not in INLINE), linked))
        pieces.clear()
        linked = 0

    at, size = 0, len(page)
    while at < size:
        token = _TOKEN.search(page, at)
        text = page[at : token.start() if token else size]
        if text:
            plain = entities.unescape(text) if "&" in text else text
            pieces.append(plain)
            if any(t == "a" for t, _ in stack):
                linked += len(plain.strip())
        if not token:
            break
        at = token.end()
        mark = token.group(1, 2, 3) if token[2] else token.group(4, 5, 6)
        if mark[1] is None:
            continue
        tag, ends = mark[1].lower(), bool(mark[0])
        if tag in SILENT and not ends:
            if not (tag == "svg" and token[0].endswith("/>")):
                done = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
                at = done.end() if done else size if tag in RAW else at
            pieces.append(" ")
            continue
        if tag not in INLINE:
            close()
        elif tag == "br":
            pieces.append(" ")
        if ends:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
            if depth is not None:
                if any(t not in INLINE for t, _ in stack[depth:]):
                    close()
                del stack[depth:]
        elif tag not in VOID:
            shut = tag if tag in ("li", "dt", "dd", "tr", "td", "th", "option") else "p" if tag not in INLINE else None
            if shut:
                depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == shut), None)
                fence = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] in ("ul", "ol", "dl", "table", "div", "section", "article", "main")), -1)
                if depth is not None and depth > fence:
                    del stack[depth:]
            marks = " ".join(w.lower() for m in _MARK.finditer(mark[2] or "") for w in _NAME.findall(m[1] or m[2] or m[3] or ""))
            stack.append((tag, f"{tag} {marks}".strip()))
    close()
    return out


def is_main(path: tuple[str, ...]) -> bool:
    """What the page's own marks say of a block: the labels of the training sample."""
    main = False
    for entry in path:
        tag, *marks = entry.split()
        if tag in BOILER_TAGS or BOILER_WORDS & {p for m in marks for p in (m, *m.split("-"))}:
            return False
        main |= tag in ("article", "main") or bool(MAIN_WORDS & {p for m in marks for p in (m, *m.split("-"))})
    return main


def _slot(word: str, size: int) -> tuple[int, float]:
    h = zlib.crc32(word.encode())
    return h % size, 1.0 if h >> 16 & 1 else -1.0


def vectors(blocks: list[Block], memory: dict) -> np.ndarray:
    """One row per block: path, all its words, measures. ``memory`` keeps the rows of paths, and the slots of words."""
    out = np.zeros((len(blocks), PATH + WORDS + MEASURES), np.float32)
    for i, b in enumerate(blocks):
        row = memory.get(b.path)
        if row is None:
            row = np.zeros(PATH, np.float32)
            for entry in b.path:
                tag, *marks = entry.split()
                names = {p for m in marks for p in (m, *m.split("-"))}
                for w in [f"<{tag}", *names]:
                    at, sign = _slot(w, PATH)
                    row[at] += sign
            if len(memory) < 50_000:
                memory[b.path] = row
        out[i, :PATH] = row
        words = b.text.lower().split(" ")
        sums = [0.0] * WORDS
        for w in words:
            known = memory.get(w)
            if known is None:
                known = _slot(w, WORDS)
                if len(memory) < 200_000:
                    memory[w] = known
            sums[known[0]] += known[1]
        out[i, PATH : PATH + WORDS] = sums
        out[i, PATH : PATH + WORDS] /= len(words)
        n = len(b.text)
        stops = sum(map(b.text.count, ".,;:!?"))
        out[i, PATH + WORDS :] = (np.log1p(n) / 6, b.linked / max(n, 1), stops / max(n, 1) * 10, i / max(len(blocks), 1), 1 / (1 + i), 1 / (len(blocks) - i))
    return out


class Labeller:
    """Bidirectional LSTM over block vectors with one logit per block."""

    def __init__(self, size: int = PATH + WORDS + MEASURES, hidden: int = HIDDEN, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.hidden = hidden
        self.weights = {}
        for side in "fb":
            self.weights[f"x{side}"] = rng.normal(0, 1 / np.sqrt(size), (size, 4 * hidden)).astype(np.float32)
            self.weights[f"h{side}"] = rng.normal(0, 1 / np.sqrt(hidden), (hidden, 4 * hidden)).astype(np.float32)
            bias = np.zeros(4 * hidden, np.float32)
            bias[hidden : 2 * hidden] = 1  # forget gates start open
            self.weights[f"b{side}"] = bias
        self.weights["out"] = rng.normal(0, 0.3, 2 * hidden).astype(np.float32)
        self.weights["skip"] = np.zeros(size, np.float32)  # the block's own evidence
        self.weights["bias"] = np.zeros(1, np.float32)

    def _run(self, x: np.ndarray, side: str) -> tuple[np.ndarray, list]:
        """States of one direction; x: steps, pages, size."""
        n = self.hidden
        given = x @ self.weights[f"x{side}"] + self.weights[f"b{side}"]
        h = c = np.zeros((x.shape[1], n), np.float32)
        states, trace = np.empty((*x.shape[:2], n), np.float32), []
        for t in range(len(x)):
            z = given[t] + h @ self.weights[f"h{side}"]
            gate = 1 / (1 + np.exp(-np.clip(z[:, : 3 * n], -30, 30)))
            i, f, o = gate[:, :n], gate[:, n : 2 * n], gate[:, 2 * n :]
            g = np.tanh(z[:, 3 * n :])
            before, hb = c, h
            c = f * c + i * g
            tc = np.tanh(c)
            h = o * tc
            states[t] = h
            trace.append((hb, before, i, f, o, g, tc))
        return states, trace

    def _back(self, x: np.ndarray, side: str, trace: list, d: np.ndarray, grads: dict) -> None:
        n = self.hidden
        dh = dc = np.zeros((x.shape[1], n), np.float32)
        dz = np.empty((*x.shape[:2], 4 * n), np.float32)
        for t in range(len(x) - 1, -1, -1):
            hb, before, i, f, o, g, tc = trace[t]
            dh = dh + d[t]
            dc = dc + dh * o * (1 - tc * tc)
            dz[t, :, :n] = dc * g * i * (1 - i)
            dz[t, :, n : 2 * n] = dc * before * f * (1 - f)
            dz[t, :, 2 * n : 3 * n] = dh * tc * o * (1 - o)
            dz[t, :, 3 * n :] = dc * i * (1 - g * g)
            dc = dc * f
            dh = dz[t] @ self.weights[f"h{side}"].T
        before = np.stack([s[0] for s in trace])
        grads[f"x{side}"] = np.tensordot(x, dz, ([0, 1], [0, 1]))
        grads[f"h{side}"] = np.tensordot(before, dz, ([0, 1], [0, 1]))
        grads[f"b{side}"] = dz.sum(axis=(0, 1))

    @staticmethod
    def _turned(length: np.ndarray, steps: int) -> np.ndarray:
        """Per page, the steps in reverse with the padding left at the end."""
        t = np.arange(steps)[:, None]
        return np.where(t < length, length - 1 - t, t)

    def logits(self, x: np.ndarray, length: np.ndarray):
        turn, column = self._turned(length, len(x)), np.arange(x.shape[1])
        back = x[turn, column]
        hf, tf = self._run(x, "f")
        hb, tb = self._run(back, "b")
        both = np.concatenate([hf, hb[turn, column]], axis=2)
        return both @ self.weights["out"] + x @ self.weights["skip"] + self.weights["bias"][0], (turn, column, back, tf, tb, both)

    def fit(self, pages: list[tuple[np.ndarray, np.ndarray]], epochs: int = EPOCHS, batch: int = 32, rate: float = 0.01) -> None:
        """Adam on the cross-entropy of all blocks."""
        rng = np.random.default_rng(SEED)
        pages = sorted(pages, key=lambda p: len(p[1]))
        lots = [pages[i : i + batch] for i in range(0, len(pages), batch)]
        m = {k: np.zeros_like(w) for k, w in self.weights.items()}
        v = {k: np.zeros_like(w) for k, w in self.weights.items()}
        step = 0
        for _ in range(epochs):
            for j in rng.permutation(len(lots)):
                x, length = padded([p[0] for p in lots[j]])
                x[:, :, PATH:] *= rng.random((x.shape[0], x.shape[1], 1)) < 0.5  # labels must not lean on the words
                y, _ = padded([p[1][:, None].astype(np.float32) for p in lots[j]])
                logit, (turn, column, back, tf, tb, both) = self.logits(x, length)
                real = np.arange(len(x))[:, None] < length
                d = (1 / (1 + np.exp(-logit)) - y[:, :, 0]) * real / real.sum()
                grads = {"out": np.tensordot(d, both, ([0, 1], [0, 1])), "skip": np.tensordot(d, x, ([0, 1], [0, 1])), "bias": np.array([d.sum()], np.float32)}
                spread = d[:, :, None] * self.weights["out"]
                n = self.hidden
                self._back(x, "f", tf, spread[:, :, :n], grads)
                self._back(back, "b", tb, spread[:, :, n:][turn, column], grads)
                step += 1
                for k, g in grads.items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    self.weights[k] = (self.weights[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)

    def label(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Whether each block of each page is article text; pages of like length run side by side."""
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        order = sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: len(pages[i]))
        while order:
            longest = len(pages[order[-1]])
            lot = order[-max(1, min(256, 20_000 // longest)) :]
            del order[-len(lot) :]
            x, length = padded([pages[i] for i in lot])
            logit, _ = self.logits(x, length)
            for j, i in enumerate(lot):
                out[i] = logit[: length[j], j] > 0
        return out


def padded(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """steps, pages, size; and the lengths."""
    length = np.array([len(r) for r in rows])
    x = np.zeros((length.max(), len(rows), rows[0].shape[1]), np.float32)
    for j, r in enumerate(rows):
        x[: len(r), j] = r
    return x, length


def dressed(blocks: list[Block], texts: list[str], rng: random.Random) -> list[Block]:
    """The page's article in another dress: other wrappers, and boilerplate around and inside it."""
    wrap = rng.choice([("html", "body", "article"), ("html", "body", "main"), ("html", "body", "div page", "div content"), ("html", "body", "main", "article post"),
                       ("html", "body", "div container", "article", "div entry-content"), ("html", "body", "div wrapper", "section article-body")])
    outer = wrap[: rng.randint(2, len(wrap) - 1)]
    plain = lambda path: tuple(e.split()[0] for e in path if e.split()[0] in ("p", "h1", "h2", "h3", "ul", "ol", "li", "blockquote", "pre", "table", "tr", "td", "figure", "figcaption"))
    forms = [("ul", "li"), ("ol", "li"), ("blockquote", "p"), ("h2",), ("h3",), ("table", "tr", "td"), ("div",), ("pre",), ("section", "p"), ("figure", "figcaption"), ("dl", "dd"), ()]
    inner = lambda path: rng.choice(forms) if rng.random() < 0.3 else plain(path)
    part = [Block(b.text, wrap + inner(b.path), b.linked) for b in blocks if is_main(b.path)]
    words = sorted(BOILER_WORDS)
    marked = [f"{rng.choice(['div', 'section', 'ul', 'p', 'aside', 'span'])} {w}{rng.choice(['', '-box', '-list', '-area', '-' + rng.choice(words)])}" for w in words]

    def junk(where: tuple[str, ...], n: int) -> list[Block]:
        own = rng.choice([*sorted(BOILER_TAGS - {"head"}), *rng.sample(marked, 16)])
        inner = rng.choice([(), ("ul", "li"), ("p",), ("div",), ("div", "p"), ("article",) if own in ("aside", "section comments", "div comments") else ("p",)])
        got = []
        for _ in range(n):
            text = rng.choice(texts)
            if rng.random() < 0.4:
                text = " ".join(text.split()[: rng.randint(1, 6)])
            got.append(Block(text, (*where, own, *inner), len(text) if rng.random() < 0.3 else 0))
        return got

    out = [Block(rng.choice(texts)[:60], ("html", "head", "title"), 0)]
    for _ in range(rng.randint(0, 3)):
        out += junk(outer, rng.randint(1, 6))
    for b in part:
        out.append(b)
        if rng.random() < 0.1:
            out += junk(wrap, rng.randint(1, 3))
    for _ in range(rng.randint(0, 3)):
        out += junk(rng.choice([outer, wrap]), rng.randint(1, 6))
    return out


def train_labeller(pages: DataFrame, html: str = "html", key: str = "page_id") -> Labeller:
    """Fits the labeller on about SAMPLE_PAGES pages (never over four times that)."""
    rows = sampled(pages.filter(F.col(html).isNotNull()).select(key, html), [key], SAMPLE_PAGES, 9).collect()
    rng = random.Random(SEED)
    sample = [blocks_of(r[1]) for r in sorted(rows, key=lambda r: (r[0] is None, r[0], r[1]))] or [blocks_of("<article><p>Some text.</p></article>")]
    sample = [b for b in sample if b] or [blocks_of("<article><p>Some text.</p></article>")]
    texts = [b.text for p in sample for b in p][:5000]
    seqs = sample + [dressed(p, texts, rng) for p in sample for _ in range(8)]
    memory: dict = {}
    data = []
    for i, p in enumerate(seqs):
        x, y = vectors(p, memory), np.array([is_main(b.path) for b in p])
        last = max(len(p) - TRAIN_BLOCKS, 0)
        # a sample page as windows that cover it; a re-dressed one as a window anywhere in it
        starts = [*range(0, last, TRAIN_BLOCKS), last] if i < len(sample) else [rng.randint(0, last)]
        data += [(x[a : a + TRAIN_BLOCKS], y[a : a + TRAIN_BLOCKS]) for a in starts]
    labeller = Labeller()
    labeller.fit(data)
    return labeller


def extracted(pages: DataFrame, labeller: Labeller, html: str = "html") -> DataFrame:
    """``pages`` without the html, with ``text`` and ``n_chars``."""
    kept = [f for f in pages.schema if f.name not in (html, "text", "n_chars")]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        memory: dict = {}
        for batch in batches:
            texts: list[str] = []
            column = batch.column(batch.schema.get_field_index(html))
            for begin in range(0, batch.num_rows, 256):
                read = [blocks_of(x or "") for x in column.slice(begin, 256).to_pylist()]
                for blocks, keep in zip(read, labeller.label([vectors(b, memory) for b in read]), strict=True):
                    texts.append("\n".join(b.text for b, k in zip(blocks, keep, strict=True) if k))
            made = [pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(f.name)) for f in kept] + made, names=[f.name for f in kept] + ["text", "n_chars"])

    return with_small_batches(pages).mapInArrow(run, "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept) + "text string, n_chars bigint")


def op9_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return extracted(pages, train_labeller(pages))
