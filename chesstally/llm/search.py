"""Ranked lexical search with range-maximum tables over posting lists.

Every query item is ranked against every document by a sum of integer term impacts.

1. One pass over the documents writes a postings table: per document its length and, for the terms
   that any item has, their counts. Corpus counts (documents, terms, document frequencies) are
   aggregations of that table.
2. Its rows are taken in shards of bounded size. A shard holds a posting list per term, sorted by
   document, with a sparse table over its impacts: the maximum of any range of documents in two
   look-ups. For an item, intervals of documents are taken best first: an interval's bound is the
   sum of its terms' range maxima. The document with the largest single impact is scored, and splits
   the interval in two. An interval whose bound cannot reach the k-th best score so far is dropped, so
   most documents are never looked at, and the k best of the shard are exact.
3. The shards' best are ranked per item; Spark limits each task's rows before they are shuffled.

The items' terms are broadcast in blocks of bounded size, whatever the number of items; a document's
part of a posting list is never longer than its shard.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from chesstally.llm.common import materialize, slices

K = 50
BLOCK_CHARS = 4_000_000
SHARD_POSTINGS = 1_000_000
_BATCH = 64  # intervals split at a time

#: Separators become blanks and A-Z lower case; digits, letters and all non-ASCII bytes stay.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms(text: str | None) -> list[bytes]:
    """The text's terms in order; null has none."""
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split() if text else []


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Shard:
    """Posting lists of some documents, with range-maximum tables.

    ``keys`` is term * size + document, ascending, so one sorted array holds all lists.
    """

    def __init__(self, n_docs: int, term: np.ndarray, doc: np.ndarray, impact: np.ndarray) -> None:
        self.size = max(1, n_docs)
        order = np.argsort(term.astype("i8") * self.size + doc, kind="stable")
        self.doc, self.impact = doc[order].astype("i8"), impact[order].astype("i8")
        self.keys = term[order].astype("i8") * self.size + self.doc
        longest = int(np.bincount(term).max()) if len(term) else 0
        self.log = np.zeros(longest + 2, "i4")
        for i in range(2, longest + 2):
            self.log[i] = self.log[i >> 1] + 1
        at = np.arange(len(term), dtype="i4")
        self.tables = [at]  # tables[j][i]: where the maximum of the 2**j postings from i on stands
        for j in range(int(self.log[longest]) if longest else 0):
            a = self.tables[-1]
            far = np.minimum(at + (1 << j), len(at) - 1)
            b = a[far]
            # Ranges that run into the next list are never asked for.
            self.tables.append(np.where(self.impact[a] >= self.impact[b], a, b))
        self.table = np.stack(self.tables) if len(term) else np.zeros((1, 0), "i4")
        del self.tables

    def maxima(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Maximum impact of the postings [lo, hi) and where it stands; 0 for empty ranges."""
        n = hi - lo
        some = n > 0
        lo, n = np.where(some, lo, 0), np.where(some, n, 1)
        j = self.log[n]
        a, b = self.table[j, lo], self.table[j, lo + n - (1 << j)]
        at = np.where(self.impact[a] >= self.impact[b], a, b)
        return np.where(some, self.impact[at], 0), at

    def best(self, query: np.ndarray, k: int) -> list[tuple[int, int]]:
        """``(score, document)`` of the k best documents with a score above 0, equal scores by
        document."""
        if not len(self.keys) or not len(query):
            return []
        base = query.astype("i8") * self.size
        lo = np.searchsorted(self.keys, base)[None, :]
        hi = np.searchsorted(self.keys, base + self.size)[None, :]
        query = np.flatnonzero(hi[0] > lo[0])
        lo, hi, base = lo[:, query], hi[:, query], base[query]
        if not len(query):
            return []
        # An interval is its ranges in the query's posting lists, its bound and its first document.
        tops, where = self.maxima(lo, hi)
        bound, first = tops.sum(1), np.zeros(1, "i8")
        scores, docs = np.empty(0, "i8"), np.empty(0, "i8")
        least, last = 0, -1  # the k-th score so far and its document
        while len(bound):
            take = np.arange(len(bound)) if len(bound) <= _BATCH else np.argpartition(-bound, _BATCH)[:_BATCH]
            lo1, hi1, tops1, where1, first1 = lo[take], hi[take], tops[take], where[take], first[take]
            rows = np.arange(len(take))
            split = self.doc[where1[rows, tops1.argmax(1)]]
            at = np.searchsorted(self.keys, base[None, :] + split[:, None])
            near = np.minimum(at, len(self.keys) - 1)
            hit = (at < hi1) & (self.keys[near] == base[None, :] + split[:, None])
            scores = np.concatenate([scores, np.where(hit, self.impact[near], 0).sum(1)])
            docs = np.concatenate([docs, split])
            if len(scores) > k:
                order = np.lexsort((docs, -scores))[:k]
                scores, docs = scores[order], docs[order]
                least, last = int(scores[-1]), int(docs[-1])
            new_lo = np.concatenate([lo1, at + hit])
            new_hi = np.concatenate([at, hi1])
            new_first = np.concatenate([first1, split + 1])
            new_tops, new_where = self.maxima(new_lo, new_hi)
            rest = np.ones(len(bound), bool)
            rest[take] = False
            bound = np.concatenate([bound[rest], new_tops.sum(1)])
            lo, hi = np.concatenate([lo[rest], new_lo]), np.concatenate([hi[rest], new_hi])
            tops, where = np.concatenate([tops[rest], new_tops]), np.concatenate([where[rest], new_where])
            first = np.concatenate([first[rest], new_first])
            open_ = (bound > least) | ((bound == least) & (bound > 0) & (first < last))
            if not open_.all():
                lo, hi, tops, where = lo[open_], hi[open_], tops[open_], where[open_]
                bound, first = bound[open_], first[open_]
        order = np.lexsort((docs, -scores))
        return [(int(scores[i]), int(docs[i])) for i in order if scores[i] > 0][:k]


def _blocks(items: DataFrame, item_id: str, item_text: str, block_chars: int):
    """The items in broadcast blocks of bounded size: distinct ``(id, terms)``, and the block's terms."""
    rows = items.select(F.col(item_id).alias("id"), F.col(item_text).alias("text"))
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    count = -(-2 * total // block_chars) if total > block_chars else 1
    for b in range(count):  # twice as many as needed on average: hashing deals them unevenly
        part = rows if count == 1 else rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(count)) == b)
        held: dict[bytes, int] = {}
        got = []
        for r in part.toLocalIterator():
            mine = {held.setdefault(t, len(held)) for t in terms(r["text"])}
            got.append((r["id"], np.array(sorted(mine), "i4")))
        yield got, held


_HELD: dict[str, object] = {}


def _kept(name: str, value):
    """A broadcast value, unpickled once per worker and block."""
    if name not in _HELD:
        _HELD.clear()
        _HELD[name] = value.value
    return _HELD[name]


def _postings(docs: DataFrame, vocab: dict[bytes, int]) -> DataFrame:
    """``doc_id, n, terms, tfs`` of every document; only its block's terms are listed."""
    name, shared = uuid.uuid4().hex, docs.sparkSession.sparkContext.broadcast(vocab)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _kept(name, shared)
        for part in slices(batches):
            ids, ns, ts, fs = [], [], [], []
            for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                words = terms(text)
                if words:
                    found = [(held[t], c) for t, c in Counter(words).items() if t in held]
                    ids.append(doc)
                    ns.append(len(words))
                    ts.append([t for t, _ in found])
                    fs.append([c for _, c in found])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, part.column(0).type), pa.array(ns, pa.int64()),
                 pa.array(ts, pa.list_(pa.int32())), pa.array(fs, pa.list_(pa.int32()))],
                ["doc_id", "n", "terms", "tfs"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return materialize(docs.mapInArrow(run, f"doc_id {kind}, n long, terms array<int>, tfs array<int>"), "search")


def _shards(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """Documents of a partition in shards: ids, lengths, and arrays (document, term, count)."""
    ids, ns, parts, held = [], [], [], 0
    for batch in batches:
        for part in slices([batch], 4096):
            lists = part.column(2)
            lens = np.diff(np.asarray(lists.offsets))
            parts.append((len(ids) + np.repeat(np.arange(part.num_rows), lens), np.asarray(lists.flatten()),
                          np.asarray(part.column(3).flatten())))
            ids += part.column(0).to_pylist()
            ns.append(np.asarray(part.column(1)))
            held += int(lens.sum())
            if held >= most:
                yield ids, np.concatenate(ns), [np.concatenate(x) for x in zip(*parts)]
                ids, ns, parts, held = [], [], [], 0
    if ids:
        yield ids, np.concatenate(ns), [np.concatenate(x) for x in zip(*parts)]


def _id_order(i) -> tuple:
    return (i is not None, i)


def search(docs: DataFrame, items: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text",
           item_id: str = "item_id", item_text: str = "text", block_chars: int = BLOCK_CHARS,
           shard_postings: int = SHARD_POSTINGS) -> DataFrame:
    """``item_id, rank, doc_id, score``: each item's k best documents with a score above 0, ranks from 1;
    equal scores by ascending id, null ids first.

    Null and termless texts match nothing, on either side. Each row is a document, also one that repeats
    another's id or text; rows of one item id are items of their own, equal rows are one item. Other
    columns are ignored. An empty table on either side gives an empty result.
    """
    spark = docs.sparkSession
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    items = items.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text")).distinct()
    kinds = [src.schema["doc_id"].dataType, items.schema["item_id"].dataType]
    (doc_type, item_type), (doc_arrow, item_arrow) = [k.simpleString() for k in kinds], map(to_arrow_type, kinds)
    out = None
    for asked, vocab in _blocks(items, "item_id", "text", block_chars):
        posts = _postings(src, vocab)
        n_docs, n_terms = posts.agg(F.count(F.lit(1)), F.sum("n")).first()
        dfs = posts.select(F.explode("terms").alias("t")).groupBy("t").count().toLocalIterator()
        weights = np.zeros(max(1, len(vocab)), "i8")
        for r in dfs:  # no more rows than the block has terms
            weights[r["t"]] = weight(n_docs, r["count"])
        name = uuid.uuid4().hex
        shared = spark.sparkContext.broadcast((asked, weights, n_docs, n_terms or 1))

        def run(batches: Iterator[pa.RecordBatch], name=name, shared=shared) -> Iterator[pa.RecordBatch]:
            asked, weights, n_docs, n_terms = _kept(name, shared)
            for ids, ns, (doc, term, tf) in _shards(batches, shard_postings):
                place = np.empty(len(ids), "i8")  # documents in the order of their ids
                by_id = sorted(range(len(ids)), key=lambda i: _id_order(ids[i]))
                place[by_id] = np.arange(len(ids))
                m = 50 + 50 * ns * n_docs // n_terms
                tf = tf.astype("i8")
                impact = weights[term] * (1_000_000_000 * tf // (1000 * tf + 20 * m[doc]))
                shard = Shard(len(ids), term, place[doc], impact)
                for q, (_, query) in enumerate(asked):
                    if best := shard.best(query, k):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([q] * len(best), pa.int32()),
                             pa.array([asked[q][0]] * len(best), item_arrow),
                             pa.array([ids[by_id[d]] for _, d in best], doc_arrow),
                             pa.array([s for s, _ in best], pa.int64())],
                            ["q", "item_id", "doc_id", "score"])

        best = posts.mapInArrow(run, f"q int, item_id {item_type}, doc_id {doc_type}, score long")
        order = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
        top = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        top = top.select("item_id", "rank", "doc_id", "score")
        out = top if out is None else out.unionByName(top)
    return out


#: DuckDB: every document scored against every item that shares a term with it.
ORACLE = r"""
with words as (select row_number() over () as d, doc_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from documents),
tfs as (select d, doc_id, term, count(*) as tf from words group by all),
lens as (select d, count(*) as n from words group by d),
corpus as (select count(*) as n_docs, sum(n) as n_terms from lens),
asked as (select distinct item_id, text, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark),
dfs as (select term, count(*) as df from tfs group by term),
weights as (select term, floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1)))::bigint as w from dfs, corpus),
impacts as (select d, doc_id, term,
        w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))) as impact
        from tfs join lens using (d) join weights using (term), corpus),
scores as (select item_id, text, d, doc_id, sum(impact)::bigint as score
        from asked join impacts using (term) group by all having score > 0),
ranked as (select item_id, doc_id, score,
        row_number() over (partition by item_id, text order by score desc, doc_id nulls first)::int as rank from scores)
select item_id, rank, doc_id, score from ranked where rank <= 50
"""
