"""Personal data by candidate gradient boosting.

Generators with high recall propose overlapping spans of five kinds. Boosted trees score each
candidate by its format (length, digits, separators, checksums, entropy) and its context (what
stands before and after it). Thresholds per kind are calibrated on candidates that the trees have
not seen, and the candidates above them are redacted, best first and without overlaps. Spans of the
base rules (below) always stay, and candidates that touch one of them are left out.

No labels exist for spans, so the trees learn from planted ones (:mod:`chesstally.llm.pii_plants`): private
values of each kind in usual formats and look-alikes (versions, dates, times, checksums, commit ids,
placeholders, code) are put, with words that usually stand before them, into contexts taken from the
corpus. What was planted decides a candidate's label: it is positive if it is a planted private value
from end to end, and negative if it lies in a look-alike or has other ends. No rule that finds or
labels candidates is an input of the trees. A second round adds candidates of the corpus that the first
round takes for background, so that the trees know the corpus's own numbers and codes.

Thresholds: half of the plants, with other contexts and other words before them, are kept for
calibration; they bound a kind's threshold by precision and recall. Between these bounds it lies where the
scores of all candidates of the corpus are sparsest. Bounded samples: ``CONTEXTS`` contexts and
``BACKGROUND`` candidates per kind, chosen by hashes; everything else covers all texts.
"""

from __future__ import annotations

import math
import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chesstally.llm import pii_plants as plants
from chesstally.llm.common import materialize, sample_by_hash, slices

KINDS = ("email", "ip", "card", "phone", "secret")
BASE_KINDS = KINDS[:4]
CONTEXTS = 4000
PLANTS = 500  # of either label per kind and half
BACKGROUND = 1000
PRECISION, RECALL = 0.98, 0.95  # bounds of a kind's threshold on the calibration half
_TREES, _DEPTH, _BINS, _SHRINK = 40, 3, 32, 0.25
_BEFORE, _AFTER = 24, 4
_STEPS = 1000  # bins of scores

# ---- base rules -------------------------------------------------------------------------------

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Not after a digit: a search from inside a run of digits finds what the run's start did not.
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of the e-mail rule; searched around each "@", so in linear time."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            done = m.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` by start, then kind."""
    out = [(a, b, "email") for a, b in emails(text)]
    out += [(*m.span(), "ip") for m in _IP.finditer(text)
            if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split("."))]
    for m in _CARD.finditer(text):
        if len(m.group()) >= 14:
            d = _digits(m.group())
            if 14 <= len(d) <= 19 and luhn(d):
                out.append((*m.span(), "card"))
    out += [(*m.span(), "phone") for m in _PHONE.finditer(text) if 10 <= len(_digits(m.group())) <= 15]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


# ---- candidates -------------------------------------------------------------------------------

_ANY = re.compile(r"(?i)[0-9@=]|[\[(]at[\])]| dot |::|eyJ|AKIA|(?:pass|pwd|token|secret|key)[\w-]*[\"']?[ \t]{0,3}:")
_OUTER = frozenset(" \t\n\r\x0b\f<>\"'(),;:[]{}|")
_AT = re.compile(r"(?i)[\w.+-]{1,64} ?(?:\[at\]|\(at\)) ?[\w-]{1,63}(?:(?: ?(?:\[dot\]|\(dot\)) ?| dot |\.)[\w-]{1,63}){1,8}"
                 r"|(?<![\w.+-])[\w.+-]{1,64} at [\w-]{1,63}(?: dot [\w-]{1,63}){1,8}")
_DOTTED = re.compile(r"(?<![0-9.])[0-9]{1,5}(?:\.[0-9]{1,5}){2,7}")
_HEXES = re.compile(r"(?<![0-9A-Fa-f:])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){4,7}")
_COLONS = re.compile(r"(?<![0-9A-Za-z:.])[0-9A-Fa-f]{0,4}:[0-9A-Fa-f:]{1,38}(?![0-9A-Za-z])")
_CARDS = re.compile(r"(?<![0-9])(?:[3-6][0-9]{3}([ .-])[0-9]{4}\1[0-9]{4}\1[0-9]{2,7}|3[0-9]{3}([ .-])[0-9]{6}\2[0-9]{4,5})(?![0-9])")
_PHONES = re.compile(r"(?<![0-9])(?:(?:\+?[0-9]{1,3}[ .-]?)?(?:\([0-9]{3,4}\)[ .-]?[0-9]{3,4}[ .-][0-9]{3,4}"
                     r"|[0-9]{3,4}([ .-])[0-9]{3,4}\1[0-9]{4}))(?![0-9])")
_CALLED = re.compile(r"(?i)\b(?:tele)?(?:phone|tel|call|mobile|cell|fax|whatsapp)\b\W{0,3}(?:no\.?|number)?\W{0,3}$")
_NUMBER = re.compile(r"\+?\(?(?<![0-9])[0-9](?:[ ().\-]{0,2}[0-9]){7,18}")
_KEYED = re.compile(r"(?i:pass(?:word|wd)?|pwd|token|secret|api[_-]?key)[\"']?[ \t]{0,3}[=:][ \t]{0,3}[\"']?"
                    r"([^\s\"']{6,})")
_DENSE = re.compile(r"(?<![A-Za-z0-9_+/=-])[A-Za-z0-9_+/=-]{16,}")
_JWT = re.compile(r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{4,}\.[A-Za-z0-9_-]+(?:\.[A-Za-z0-9_-]+)?")
_ACCESS = re.compile(r"(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![A-Za-z0-9])")
_LOGIN = re.compile(r"://[^\s/:@]{1,64}:([^\s/@]+)@")


def candidates(text: str) -> set[tuple[int, int, str]]:
    """Overlapping spans of all generators."""
    if not _ANY.search(text):
        return set()
    out: set[tuple[int, int, str]] = set()
    at = text.find("@")
    while at >= 0:
        a, b = at, at + 1
        while a > 0 and at - a < 64 and text[a - 1] not in _OUTER:
            a -= 1
        while b < len(text) and b - at < 255 and text[b] not in _OUTER:
            b += 1
        while b > at + 1 and text[b - 1] in ".!?":
            b -= 1
        if a < at < b - 1:
            out.add((a, b, "email"))
        at = text.find("@", at + 1)
    out.update((*m.span(), "email") for m in _AT.finditer(text))
    out.update((*m.span(), "ip") for r in (_DOTTED, _HEXES) for m in r.finditer(text))
    for m in _COLONS.finditer(text):
        a, b = m.span()
        b -= m.group().endswith(":") and not m.group().endswith("::")
        if text.count(":", a, b) >= 2:
            out.add((a, b, "ip"))
    for r in (_NUMBER, _CARDS, _PHONES):
        for m in r.finditer(text):
            out.update((*m.span(), k) for k in ("card", "phone"))
    out.update((*m.span(1), "secret") for r in (_KEYED, _LOGIN) for m in r.finditer(text))
    out.update((*m.span(), "secret") for r in (_JWT, _ACCESS) for m in r.finditer(text))
    out.update((*m.span(), "secret") for m in _DENSE.finditer(text)
               if any(c.isdigit() for c in m.group()) and any(c.isalpha() for c in m.group()))
    out.update(s for s in base_spans(text))
    return out


#: Words that often stand before private values, and before look-alikes.
_WORDS = [re.compile(r"(?i)" + w) for w in (
    r"pass(word|wd)?|pwd|token|secret|key|akia|bearer|credential|auth", r"tel|phone|call|mobile|cell|fax|whatsapp|dial",
    r"card|visa|amex|mastercard|credit|paid|charge", r"mail|write|contact|reach|@", r"ip\b|host|server|address|from|ping|node",
    r"version|\bv\b|release|chapter|section|build", r"commit|sha|md5|hash|digest|checksum|etag|uuid|rev",
    r"order|invoice|ticket|isbn|serial|part|item|id\b|no\b", r"date|time|on\b|since|until|at\b")]


def features(before: str, span: str, after: str, kind: str) -> list[float]:
    """Format and context of a span as numbers."""
    n = len(span)
    d = _digits(span)
    groups = [len(g) for g in re.findall(r"[0-9]+", span[:200])] or [0]
    gaps = set(re.findall(r"[^0-9A-Za-z]+", span[:200]))
    parts = span.split(".")
    share = [c / n for c in Counter(span).values()]
    octets = [int(p) for p in parts if p.isascii() and p.isdigit() and len(p) < 6]
    runs = re.findall(r"[A-Za-z]+", span[:200])
    near = before[-16:]
    return [
        n, len(d), len(d) / n, sum(c.isupper() for c in span) / n, sum(c.islower() for c in span) / n,
        sum(c in "0123456789abcdef" for c in span) / n, sum(c in " -()." for c in span), len(parts),
        span.count("@"), span.count(":"), span.startswith("+"), -sum(p * math.log2(p) for p in share), len(share) / n,
        len(d) >= 12 and luhn(d), max(octets, default=-1), len(octets), len(groups), groups[0], groups[-1],
        max(groups), min(groups), len(gaps), "::" in span, span[:1] == "(", max(map(len, runs), default=0), len(runs),
        sum(a.isalpha() and b.isdigit() or a.isdigit() and b.isalpha() for a, b in zip(span[:200], span[1:200])),
        span.isalpha(), span.islower(), " at " in span.lower(), "dot" in span.lower(), int(d[:1] or 0), int(d[:4] or 0),
        "=" in span.rstrip("="), span.endswith("="), span.count("/"), span.count("_"), span.count("-"), span[:3] == "eyJ",
        sum(not c.isalnum() for c in span) / n, span.strip(".,;:!?").lower() in plants.PLACEHOLDERS, span[:1] in "<{[$%*",
        span[-1:] in ">}]%*", "://" in before, before[-1:].isalnum(), after[:1].isalnum(), before[-1:] in ("=", '"', "'"), before[-2:-1] in (":", "="),
        before[-1:] in (":", "/"), before[-1:] in (".", "-", "_"), after[:1] in (".", "-", "_", ":", "/", "("),
        *(bool(w.search(near)) for w in _WORDS)]


# ---- boosted trees ----------------------------------------------------------------------------


@dataclass
class Trees:
    """Gradient boosting of depth-limited trees on binned features, logistic loss."""

    edges: list[np.ndarray] = field(default_factory=list)
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)
    start: float = 0.0

    def _bin(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(self.edges)], 1)

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        self.edges = [np.unique(np.quantile(c, np.linspace(0, 1, _BINS + 1)[1:-1])) for c in x.T]
        b = self._bin(x)
        p = min(max(y.mean(), 1e-3), 1 - 1e-3)
        self.start = math.log(p / (1 - p))
        score = np.full(len(y), self.start)
        for _ in range(_TREES):
            prob = 1 / (1 + np.exp(-score))
            g, h = prob - y, np.maximum(prob * (1 - prob), 1e-6)
            inner = 2 ** _DEPTH - 1
            feat, cut = np.zeros(inner, int), np.full(inner, _BINS)  # cut _BINS: all go left
            node = np.zeros(len(y), int)
            for k in range(inner):
                here = np.flatnonzero(node == k)
                if len(here) >= 2:
                    best = (1e-9, 0, _BINS)
                    gs, hs = g[here].sum(), h[here].sum()
                    for j in range(x.shape[1]):
                        gl = np.cumsum(np.bincount(b[here, j], g[here], _BINS))[:-1]
                        hl = np.cumsum(np.bincount(b[here, j], h[here], _BINS))[:-1]
                        gain = gl**2 / (hl + 1) + (gs - gl)**2 / (hs - hl + 1) - gs**2 / (hs + 1)
                        at = int(np.argmax(gain))
                        if gain[at] > best[0]:
                            best = (gain[at], j, at)
                    feat[k], cut[k] = best[1:]
                node[here] = 2 * k + 1 + (b[here, feat[k]] > cut[k])
            leaf = node - inner
            value = -np.bincount(leaf, g, 2 ** _DEPTH) / (np.bincount(leaf, h, 2 ** _DEPTH) + 1) * _SHRINK
            score += value[leaf]
            self.trees.append((feat, cut, value))
        return self

    def predict(self, x: np.ndarray) -> np.ndarray:
        if not len(x):
            return np.empty(0)
        b = self._bin(x)
        rows = np.arange(len(x))
        score = np.full(len(x), self.start)
        for feat, cut, value in self.trees:
            node = np.zeros(len(x), int)
            for _ in range(_DEPTH):
                node = 2 * node + 1 + (b[rows, feat[node]] > cut[node])
            score += value[node - len(feat)]
        return 1 / (1 + np.exp(-score))


@dataclass
class Model:
    trees: dict[str, Trees] | None = None  # by kind; None: nothing to learn from; the base rules alone
    cuts: dict[str, float] = field(default_factory=dict)  # kinds without a cut select nothing
    measured: dict[str, tuple[float, float]] = field(default_factory=dict)  # precision and recall on kept plants


def _around(text: str, a: int, b: int) -> tuple[str, str, str]:
    return text[max(0, a - _BEFORE):a], text[a:b], text[b:b + _AFTER]


def _bins(scores: np.ndarray) -> np.ndarray:
    return (scores * _STEPS).astype(int)


def planted(kind: str, contexts: list[tuple[str, str]], half: int, n: int = PLANTS
            ) -> list[tuple[list[float], bool]]:
    """Features and labels of the candidates in and around ``n`` planted values and ``n`` look-alikes."""
    rng = random.Random(f"{kind} {half}")
    out = []
    for i in range(2 * n):
        left, right = contexts[rng.randrange(len(contexts))]
        real = i % 2 == 0
        before, span, after = (plants.private if real else plants.look_alike)(kind, rng, half)
        a = len(left) + 1 + len(before)
        b = a + len(span)
        text = f"{left} {before}{span}{after} {right}"
        base = base_spans(text)
        if real and any(s < b and a < e for s, e, _ in base):
            continue  # a base rule's already
        for lo, hi, k in sorted(candidates(text)):
            if k == kind and lo < b and a < hi and all(hi <= s or e <= lo for s, e, _ in base):
                out.append((features(*_around(text, lo, hi), kind), real and (lo, hi) == (a, b)))
    return out


def _contexts(docs: DataFrame, text_col: str, most: int) -> list[tuple[str, str]]:
    """Some characters before and after a place in each of at most ``most`` texts, by a hash of the text."""
    text, n = F.col(text_col), F.length(text_col)
    place = (F.pmod(F.xxhash64(F.lit(9), text), F.greatest(n, F.lit(1))) + 1).cast("int")
    rows = docs.where(n > 0).select(
        F.xxhash64(text).alias("h"), F.substr(text, F.greatest(place - _BEFORE, F.lit(1)), F.lit(_BEFORE)).alias("a"),
        F.substr(text, place, F.lit(2 * _AFTER)).alias("b"))
    return [(r["a"], r["b"]) for r in sample_by_hash(rows, "h", most, seed=3).collect()] or [("", "")]


def fit(docs: DataFrame, text_col: str = "text", contexts: int = CONTEXTS, background: int = BACKGROUND) -> Model:
    """Trees and thresholds (see the module's text). An empty table gives the base rules alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Distinct candidates that touch no base span, as features."""
        for part in slices(batches):
            rows: dict[int, tuple] = {}
            for text in part.column(0).to_pylist():
                base = base_spans(text or "")
                for a, b, kind in candidates(text or ""):
                    if all(b <= s or e <= a for s, e, _ in base):
                        before, span, after = _around(text, a, b)
                        key = xxhash.xxh64_intdigest(f"{kind}|{before}|{span}|{after}".encode()) >> 1
                        rows[key] = (kind, [float(f) for f in features(before, span, after, kind)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(rows), pa.int64()), pa.array([k for k, _ in rows.values()], pa.string()),
                 pa.array([x for _, x in rows.values()], pa.list_(pa.float32()))], ["key", "kind", "x"])

    around = _contexts(docs, text_col, contexts)
    if around == [("", "")]:
        return Model()
    found = materialize(
        docs.select(F.col(text_col).alias("text")).mapInArrow(run, "key long, kind string, x array<float>")
        .groupBy("key").agg(F.first("kind").alias("kind"), F.first("x").alias("x")), "pii-candidates")
    seen: dict[str, list] = {k: [] for k in KINDS}
    for kind in KINDS:
        rows = sample_by_hash(found.where(F.col("kind") == kind), "key", background, seed=5)
        seen[kind] = [r["x"] for r in rows.collect()]
    trees, kept = {}, {}
    for kind in KINDS:
        rows, kept[kind] = planted(kind, around[::2], 0), planted(kind, around[1::2] or around, 1)
        x, y = np.array([r[0] for r in rows], float), np.array([r[1] for r in rows], float)
        trees[kind] = Trees().fit(x, y)
        if seen[kind]:  # what the first round takes for the corpus's background joins the negatives
            own = np.array(seen[kind], float)
            own = own[trees[kind].predict(own) < 0.5]
            trees[kind] = Trees().fit(np.concatenate([x, own]), np.concatenate([y, np.zeros(len(own))]))

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[tuple[str, int]] = Counter()
        for part in slices(batches, 4096):
            kinds = np.array(part.column(1).to_pylist())
            x = np.array(part.column(2).to_pylist(), float)
            for kind in set(kinds.tolist()):
                held.update(zip([kind] * int((kinds == kind).sum()), _bins(trees[kind].predict(x[kinds == kind])).tolist()))
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in held], pa.string()), pa.array([b for _, b in held], pa.int64()),
             pa.array(held.values(), pa.int64())], ["kind", "bin", "n"])

    everywhere = {k: np.zeros(_STEPS + 1) for k in KINDS}
    for r in (found.mapInArrow(scores, "kind string, bin long, n long").groupBy("kind", "bin")
              .agg(F.sum("n").alias("n")).collect()):
        everywhere[r["kind"]][r["bin"]] += r["n"]
    cuts, measured = {}, {}
    for kind in KINDS:
        x, y = np.array([r[0] for r in kept[kind]], float), np.array([r[1] for r in kept[kind]], bool)
        cut = _cut(trees[kind].predict(x), y, everywhere[kind])
        if cut is not None:
            chosen = trees[kind].predict(x) >= cut
            cuts[kind], measured[kind] = cut, (float(y[chosen].mean()), float(chosen[y].mean()))
    return Model(trees, cuts, measured)


def _cut(scores: np.ndarray, y: np.ndarray, everywhere: np.ndarray) -> float | None:
    """The least score with ``PRECISION`` on the kept plants, or one above it that keeps ``RECALL``: there
    where the corpus's candidates are sparsest (in a window of a twentieth)."""
    grid = np.arange(1, _STEPS + 1) / _STEPS
    above = scores[:, None] >= grid
    right, n = (above & y[:, None]).sum(0), above.sum(0)
    able = np.flatnonzero((right > 0) & (right >= PRECISION * n))
    if not len(able):
        return None
    low = able[0]
    high = max([low, *np.flatnonzero(right >= RECALL * y.sum())])
    dense = np.convolve(everywhere, np.ones(_STEPS // 20 + 1), "same")
    return float(grid[low + int(np.argmin(dense[low + 1:high + 2]))])


def select(model: Model, texts: list[str]) -> list[list[tuple[int, int, str, float, bool]]]:
    """Spans ``(start, end, kind, score, base)`` of each text, by start, then kind."""
    out, asked = [], []
    for i, text in enumerate(texts):
        base = base_spans(text)
        out.append([(*s, 1.0, True) for s in base])
        if model.trees is None:
            continue
        for a, b, kind in candidates(text):
            if kind in model.cuts and all(b <= s or e <= a for s, e, _ in base):
                asked.append((i, a, b, kind))
    if asked:
        best = []
        for k in model.cuts:
            own = [s for s in asked if s[3] == k]
            if own:
                best += zip(model.trees[k].predict(np.array(
                    [features(*_around(texts[i], a, b), k) for i, a, b, _ in own], float)).tolist(), own)
        best.sort(key=lambda r: (-r[0], r[1]))
        for score, (i, a, b, kind) in best:
            if score >= model.cuts[kind] and all(b <= s[0] or s[1] <= a for s in out[i]):
                out[i].append((a, b, kind, score, False))
    for spans in out:
        spans.sort(key=lambda s: (s[0], KINDS.index(s[2])))
    return out


_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()),
                   ("score", pa.float64()), ("base", pa.bool_())])
_FIELDS = ("start", "end", "kind", "score", "base")


def find_spans(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, spans`` of every row: code points, end exclusive, with score and whether a base rule
    found the span. A null text is the empty text; repeated rows and null ids keep their rows; other
    columns are ignored; an empty table gives an empty result."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found = select(model, [t or "" for t in part.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([[dict(zip(_FIELDS, s)) for s in spans] for spans in found],
                                          pa.list_(_SPAN))], ["doc_id", "spans"])

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id long, spans array<struct<start:long,end:long,kind:string,score:double,base:boolean>>"))


def redact(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with every span of the text replaced by its kind in brackets (null stays null)."""

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        given = [t if isinstance(t, str) else "" for t in texts]
        out = []
        for text, original, spans in zip(given, texts, select(model, given)):
            parts, at = [], 0
            for a, b, kind, *_ in spans:
                if a >= at:
                    parts += [text[at:a], f"[{kind.upper()}]"]
                at = max(at, b)
            out.append("".join(parts) + text[at:] if isinstance(original, str) else None)
        return pd.Series(out, dtype=object)

    return docs.withColumn(text_col, clean(F.col(text_col)))


def digest_columns(found: DataFrame) -> DataFrame:
    """Counts of base spans per kind, the digest of the base spans, the list of all spans, and the numbers of
    secrets and of all spans (added ones included)."""
    def shown(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long")

    base = F.filter("spans", lambda s: s["base"])
    counts = [count(k).alias(f"n_{k}") for k in BASE_KINDS]
    return found.select("doc_id", *counts, F.sha2(shown(base).cast("binary"), 256).alias("base_sha256"),
                        shown(F.col("spans")).alias("spans"),
                        F.size(F.filter("spans", lambda s: s["kind"] == "secret")).cast("long").alias("n_secret"),
                        F.size("spans").cast("long").alias("n_spans"))
