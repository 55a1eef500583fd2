"""Benchmark decontamination by pigeonhole edit matching.

A test item matches a document if some passage of the document is within ``k`` edits of it, with
``k = floor(RATE * length)``. Each item is split into ``k + 1`` pieces; by the pigeonhole principle
one piece is intact in every match. All pieces of a block of items form one automaton, which finds
exact piece hits in one pass over a text; hits are grouped by item and alignment, and each group is
verified with Myers' bit-parallel edit distance. Nothing is shuffled.

Texts are compared as lower-case words joined by one space (``\\w+`` words), with a space at either
end: case, punctuation and white space never count as edits, and matches begin and end at words.

Items travel to the tasks in blocks of at most ``BLOCK_CHARS`` characters; a benchmark beyond that
is handled in several passes, so what is broadcast at once has a fixed bound.
"""

from __future__ import annotations

import re
import uuid
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chesstally.llm.common import slices

RATE = 1 / 16
#: About 60 bytes of automaton per character in each worker.
BLOCK_CHARS = 4_000_000
_WORD = re.compile(r"\w+")


def normalise(text: str | None) -> str:
    """Lower-case words between single spaces; empty if there are none."""
    words = _WORD.findall((text or "").lower())
    return f" {' '.join(words)} " if words else ""


def pieces(item: str, rate: float = RATE) -> list[tuple[int, str]]:
    """``k + 1`` pieces of near-equal length with their offsets; they cover the item."""
    k = int(len(item) * rate)
    ends = [len(item) * i // (k + 1) for i in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(ends, ends[1:])]


def myers(pattern: str, text: str, peq: dict[str, int] | None = None,
          anchored: bool = False) -> tuple[int, int]:
    """Least edit distance of ``pattern`` to a passage of ``text`` and the (first) end of such a
    passage; ``anchored``: passages begin at the start of ``text``."""
    m = len(pattern)
    if peq is None:
        peq = _peq(pattern)
    mask, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score = mask, 0, m
    best, end = m, 0
    for at, c in enumerate(text, 1):
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | (~(xh | pv) & mask)
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = ((ph << 1) | anchored) & mask
        mh = (mh << 1) & mask
        pv = mh | (~(xv | ph) & mask)
        mv = ph & xv
        if score < best:
            best, end = score, at
    return best, end


def _peq(pattern: str) -> dict[str, int]:
    peq: dict[str, int] = defaultdict(int)
    for i, c in enumerate(pattern):
        peq[c] |= 1 << i
    return dict(peq)


class Matcher:
    """The automaton over the pieces of a block of items."""

    def __init__(self, items: list[tuple[int | None, str]], rate: float = RATE):
        self.items = [(i, n) for i, n in ((i, normalise(t)) for i, t in items) if n]
        self.rate, self.peqs = rate, {}
        where: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for at, (_, item) in enumerate(self.items):
            for offset, piece in pieces(item, rate):
                where[piece].append((at, offset))
        self.auto = ahocorasick.Automaton()
        for piece, spots in where.items():
            self.auto.add_word(piece, (len(piece), spots))
        if where:
            self.auto.make_automaton()

    def find(self, text: str) -> Iterator[tuple[int, int, int, int]]:
        """``(item index, distance, start, end)`` of the best match of each item in a normalised
        text: least distance, then first end."""
        if not (self.items and text):
            return
        starts: dict[int, set[int]] = defaultdict(set)  # item -> starts of the item that hits imply
        for last, (n, spots) in self.auto.iter(text):
            for item, offset in spots:
                starts[item].add(last + 1 - n - offset)
        for at in sorted(starts):
            item = self.items[at][1]
            n = len(item)
            k = int(n * self.rate)
            found = None
            exact = text.find(item, max(0, min(starts[at])))
            if exact >= 0:
                found = (0, exact + n)
            else:
                group: list[int] = []
                for s in [*sorted(starts[at]), None]:
                    if group and (s is None or s - group[-1] > 2 * k):
                        a = max(0, group[0] - k)
                        window = text[a:group[-1] + n + k]
                        if at not in self.peqs:
                            self.peqs[at] = _peq(item)
                        d, e = myers(item, window, self.peqs[at])
                        if d <= k and (found is None or d < found[0]):
                            found = (d, a + e)
                        group = []
                    group.append(s)
            if found:
                d, end = found
                back = text[max(0, end - n - d):end][::-1]  # the passage's start: match backwards
                length = myers(item[::-1], back, anchored=True)[1]
                yield at, d, end - length, end

    def any(self, text: str) -> bool:
        return next(self.find(text), None) is not None


_MATCHERS: dict[str, Matcher] = {}


def _blocks(items: DataFrame, id_col: str, text_col: str, block_chars: int):
    """The items in broadcast blocks of bounded size, each with a name for the workers' cache."""
    spark = items.sparkSession
    rows = items.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("text is not null")
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    count = -(-2 * total // block_chars) if total > block_chars else 1
    for b in range(count):  # twice as many as needed on average: hashing deals them unevenly
        part = rows if count == 1 else rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(count)) == b)
        got = sorted({(r["id"], r["text"]) for r in part.toLocalIterator()}, key=lambda x: (x[0] is None, x))
        yield uuid.uuid4().hex, spark.sparkContext.broadcast(got)


def _matcher(name: str, items, rate: float) -> Matcher:
    if name not in _MATCHERS:
        _MATCHERS.clear()
        _MATCHERS[name] = Matcher(items.value, rate)
    return _MATCHERS[name]


class _Places:
    """Spans in the given text of spans of its normalised form; the text is read once, for any number of
    them."""

    def __init__(self, text: str) -> None:
        self.firsts, self.spans, at = [], [], 1
        for m in _WORD.finditer(text):
            for word in _WORD.findall(m.group().lower()):
                self.firsts.append(at)
                self.spans.append(m.span())
                at += len(word) + 1

    def find(self, start: int, end: int) -> tuple[int, int]:
        a = max(0, bisect_right(self.firsts, max(start + 1, 1)) - 1)
        b = max(a, bisect_right(self.firsts, max(end - 2, 1)) - 1)
        return self.spans[a][0], self.spans[b][1]


def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_id: str = "item_id", item_text: str = "text", rate: float = RATE,
               block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``doc_id, item_id, distance, start, end``: one row per document row and item that occurs in it,
    with its best match; ``start`` and ``end`` (exclusive) are code points of the whole words that the
    match touches.

    Null and wordless texts match nothing, on either side; repeated items with one id count once;
    repeated document rows give repeated rows; other columns are ignored; an empty table on either
    side gives an empty result.
    """
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    schema = "doc_id long, item_id long, distance int, start long, end long"
    out = None
    for name, block in _blocks(items, item_id, item_text, block_chars):

        def run(batches: Iterator[pa.RecordBatch], name=name, block=block) -> Iterator[pa.RecordBatch]:
            found = _matcher(name, block, rate)
            for part in slices(batches):
                rows = []
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    places = None
                    for at, d, a, b in found.find(normalise(text)):
                        places = places or _Places(text)
                        rows.append((doc, found.items[at][0], d, *places.find(a, b)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 5, (
                        pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()))],
                    ["doc_id", "item_id", "distance", "start", "end"])

        hits = src.mapInArrow(run, schema)
        out = hits if out is None else out.union(hits)
    return out


def _clean(name: str, block, rate: float):
    @F.pandas_udf("boolean")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        found = _matcher(name, block, rate)
        for texts in batches:
            yield pd.Series([not found.any(normalise(t)) for t in texts], dtype=bool)

    return clean


def drop_leaks(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id",
               item_text: str = "text", rate: float = RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` without the documents in which an item occurs; columns and other rows stay."""
    for name, block in _blocks(items, item_id, item_text, block_chars):
        docs = docs.where(_clean(name, block, rate)(F.col(text_col)))
    return docs
