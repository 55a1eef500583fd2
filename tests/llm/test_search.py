import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from chesstally.llm import search
from tests.llm.conftest import sentence

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return [re.sub("[A-Z]", lambda m: m.group().lower(), t) for t in TERM.findall(text or "")]


def brute(docs, items, k):
    held = [(i, plain_terms(t)) for i, t, _ in docs]
    held = [(i, Counter(ts), len(ts)) for i, ts in held if ts]
    n_docs, n_terms = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in set(items):
        scores = []
        for i, c, n in held:
            m = 100 - 50 + (50 * n * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
                    for t in set(plain_terms(text)) if t in c)
            if s > 0:
                scores.append((-s, i is not None, i))
        out += [(item, r + 1, x[2], -x[0]) for r, x in enumerate(sorted(scores, key=lambda x: x[:2] + (x[2] or 0,))[:k])]
    return sorted(out, key=str)


def texts_of(rng):
    texts = [None, "", " .,;", "The THE the", sentence(rng, 9000), "Straße 42 naïve ÀÉ", "well-known", "a"]
    texts += [sentence(rng, rng.randint(0, 60)) for _ in range(250)]
    docs = [(i, t, "s") for i, t in enumerate(texts)]
    return docs + [(3, "the the", "s"), (None, "the señal", "s"), (None, "the señal", "s"), (9, texts[9], "s"), (900, texts[9], "s")]


@pytest.mark.parametrize("k, shard, block", [(3, 1, 10**6), (50, 400, 40), (50, 10**6, 10**6), (1000, 1000, 10**6)])
def test_search_equals_brute_force(spark, make, rng, k, shard, block):
    docs = texts_of(rng)
    items = [(1, "The naïve señal, 42!"), (1, "the well known"), (2, None), (3, ""), (4, "unknownterm zzz"),
             (None, "straße über"), (5, sentence(rng, 40)), (5, "a a a a"), (6, "the"), (6, "the")]
    asked = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, score int")
    got = search.search(make(docs, extra=["score", "rank", "n", "item_id"]).repartition(3), asked, k=k,
                        shard_postings=shard, block_chars=block).collect()
    assert sorted([(r.item_id, r["rank"], r.doc_id, r.score) for r in got], key=str) == brute(docs, items, k)


def test_empty_tables(spark, make):
    items = spark.createDataFrame([(1, "the")], "item_id long, text string")
    docs = make(["the end", "of"])
    assert search.search(docs.where("1 = 0"), items).count() == 0
    assert search.search(docs, items.where("1 = 0")).count() == 0
    assert search.search(docs, items).collect() == [(1, 1, 0, search.search(docs, items).first().score)]


def test_shard_looks_at_few_documents_and_misses_none():
    gen = np.random.default_rng(1)
    n_docs, n_terms = 20_000, 30
    rows = np.unique(gen.integers(0, n_terms * n_docs, 100_000))
    term, doc = rows // n_docs, rows % n_docs
    impact = (gen.pareto(1.5, len(rows)) * 1000).astype("i8") + 1
    shard = search.Shard(n_docs, term, doc, impact)
    asked = []
    maxima = shard.maxima
    shard.maxima = lambda lo, hi: asked.append(len(lo)) or maxima(lo, hi)
    query = np.array([1, 4, 9, 20])
    total = np.zeros(n_docs, "i8")
    for t in query:
        np.add.at(total, doc[term == t], impact[term == t])
    want = sorted(((-s, d) for d, s in enumerate(total) if s))[:10]
    assert shard.best(query, 10) == [(-s, d) for s, d in want]
    assert sum(asked) < n_docs / 4
    for _ in range(200):  # range maxima
        a, b = sorted(gen.integers(0, len(rows), 2))
        t = shard.keys[a] // n_docs
        b = min(b, int(np.searchsorted(shard.keys, (t + 1) * n_docs)))
        top = maxima(np.array([[a]]), np.array([[b]]))[0][0, 0]
        assert top == (shard.impact[a:b].max() if b > a else 0)


def test_hot_source_ties(spark, make):
    docs = make([(i, "the same text", "hot") for i in range(500)])
    items = spark.createDataFrame([(7, "same")], "item_id long, text string")
    got = search.search(docs.repartition(5), items, k=50, shard_postings=90).collect()
    assert got == []  # a term of all documents weighs nothing
    docs = docs.union(make([(1000 + i, "other words", "s") for i in range(500)]))
    got = search.search(docs.repartition(5), items, k=50, shard_postings=90).collect()
    assert [(r["rank"], r.doc_id) for r in sorted(got, key=lambda r: r["rank"])] == [(i + 1, i) for i in range(50)]
