import random
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from chesstally.llm import graph, line_dedup, queries, simhash
from tests.llm.conftest import sentence


def brute_fp(text, k=3):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, cur = [], ""
    for c in t + " ":
        if c == " " or "\x09" <= c <= "\x0d":
            if cur:
                words.append(cur)
            cur = ""
        else:
            cur += c
    if not words:
        return 0
    sh = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hs) * 2 > len(hs))


def components(n, linked):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(n):
        for j in range(i):
            if linked(i, j):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(n)]


def test_fingerprint_by_definition(rng):
    texts = [None, "", " \n", "one", "Two Words", "a b c", "É Ä ABC\x0bx\x85y\xa0z"] + [
        sentence(rng, n) for n in (4, 17, 300)]
    for t in texts:
        assert simhash.fingerprint(t) % (1 << 64) == brute_fp(t)


@pytest.mark.parametrize("dense", [1, 30, simhash.DENSE])
def test_links_equal_all_pairs(spark, dense):
    r = random.Random(3)
    base = [r.getrandbits(64) for _ in range(12)]
    vals = {0, (1 << 64) - 1, 1, 7, 1 << 63}
    for b in base:
        vals |= {b}
        for _ in range(40):
            x = b
            for _ in range(r.randint(1, 6)):
                x ^= 1 << r.randrange(64)
            vals.add(x)
    # a dense family inside one segment value
    vals |= {base[0] ^ (m << 40) for m in range(200)}
    vals = sorted(vals)
    signed = [int(np.uint64(v).astype(np.int64)) for v in vals]
    got = simhash.hamming_links(spark.createDataFrame([(v,) for v in signed], "fp long"), dense=dense)
    comps = {x["node"]: x["component"] for x in graph.connected_components(got).collect()}
    want = components(len(vals), lambda i, j: (vals[i] ^ vals[j]).bit_count() <= 3)
    groups = defaultdict(set)
    for v, c in zip(signed, want):
        groups[c].add(v)
    for g in groups.values():
        assert {comps.get(v, v) for v in g} == {min(g)}


def test_components(spark):
    r = random.Random(5)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 470)]
    edges += edges[:5] + [(7, 7)]
    got = {x["node"]: x["component"] for x in graph.connected_components(
        spark.createDataFrame(edges, "u long, v long")).collect()}
    pairs = {frozenset(e) for e in edges}
    want = components(480, lambda i, j: frozenset((i, j)) in pairs)
    assert all(got.get(i, i) == want[i] for i in range(480))
    assert graph.connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_groups_and_kept_documents(make, rng):
    a, b = sentence(rng, 200), sentence(rng, 200)
    rows = [(5, a, "s"), (3, a, "s"), (9, b, None), (4, None, "s"), (2, "", "s"), (None, a, "s"),
            (8, a + " more", "s"), (9, b, None), (None, "lonely text of its own", "s"),
            (11, sentence(rng, 30000), "s")]
    docs = make(rows, extra=["component_id", "fingerprint", "fp"])
    out = simhash.simhash_groups(docs).collect()
    assert len(out) == len(rows)
    fps = [brute_fp(t) for _, t, _ in rows]
    comp = components(len(rows), lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 3)
    ids = defaultdict(list)
    for (i, _, _), c in zip(rows, comp):
        if i is not None:
            ids[c].append(i)
    want = sorted((str(r[0]), f"{fp:016x}", str(min(ids[c], default=None)))
                  for r, fp, c in zip(rows, fps, comp))
    assert sorted((str(o.doc_id), o.fingerprint, str(o.component_id)) for o in out) == want
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    left = [r["doc_id"] for r in kept.collect()]
    assert left.count(None) == 2 and left.count(9) == 1 and 5 not in left and 3 in left and 4 not in left
    empty = docs.where("1 = 0")
    assert simhash.simhash_groups(empty).count() == 0 and simhash.keep_one(empty).count() == 0


def brute_lines(rows, min_sites, min_texts=3):
    sites, texts, first = defaultdict(set), defaultdict(set), {}
    for i, t, s in rows:
        for p, line in enumerate((t or "").split("\n")):
            x = line.strip(" \t\r")
            if x:
                sites[x].add(s or "")
                texts[x].add(t)
                spot = (2**63 - 1 if i is None else i, p)
                first[x] = min(first.get(x, spot), spot)
    out = []
    for i, t, s in rows:
        ls = (t or "").split("\n")
        gone = [len(sites[x.strip(" \t\r")]) >= min_sites and len(texts[x.strip(" \t\r")]) >= min_texts
                and first[x.strip(" \t\r")] != (2**63 - 1 if i is None else i, p) for p, x in enumerate(ls)]
        text = "\n".join(x for x, g in zip(ls, gone) if not g) if any(gone) else t
        out.append((str(i), str(text), len(ls), sum(gone)))
    return sorted(out)


def test_lines_against_brute_force(make, rng):
    rows = []
    for i in range(300):
        ls = [f"spread {rng.randrange(40)}" if rng.random() < .5 else sentence(rng, 5) for _ in range(6)]
        ls += ["", "  same everywhere\r", "\t"]
        rows.append((i, "\n".join(ls), f"s{min(rng.randrange(30), rng.randrange(30))}"))
    rows += [(None, "same everywhere\nown line", "s1"), (400, None, None), (401, "", "s2"),
             (402, "same everywhere", None), (402, "same everywhere", None),
             (403, "\n".join(["same everywhere"] * 20000), "s9")]
    docs = make(rows, extra=["id", "pos", "drop", "n"])
    for t, texts in ((2, 3), (3, 3), (10, 2), (25, 40), (3, 12)):
        out = line_dedup.dedup_lines(docs, min_sites=t, min_texts=texts, counts=("n_lines", "n_removed"))
        got = sorted((str(r.doc_id), str(r.text), r.n_lines, r.n_removed) for r in out.collect())
        assert got == brute_lines(rows, t, texts)
    plain = line_dedup.dedup_lines(docs)
    assert plain.columns == docs.columns
    assert line_dedup.dedup_lines(docs.where("1 = 0")).count() == 0
    code = plain._jdf.queryExecution().toString()
    assert "Python" not in code and "Pandas" not in code and "Arrow" not in code


def test_passages_on_few_sites_go_and_copies_stay(spark, make, rng, tmp_dir):
    """Passages of over 50 words on 3 to 9 sites, in otherwise different documents; a document copied to many
    sites, a line that one site repeats, and names that clash with the query's."""
    rows, passages = [], {n: sentence(rng, 55 + n) for n in range(2, 10)}
    for n, passage in passages.items():
        for k in range(n):
            rows.append((len(rows), f"{sentence(rng, 12)}\n{passage}\n{sentence(rng, 9)}", f"site{k}"))
    copied, own = sentence(rng, 60) + "\n" + sentence(rng, 60), sentence(rng, 60)
    rows += [(1000 + k, copied, f"site{k}") for k in range(8)]
    rows += [(2000 + k, f"{own}\n{sentence(rng, 8)}", "hot") for k in range(30)]
    docs = make(rows)
    left = {n: 0 for n in passages}
    for r in line_dedup.dedup_lines(docs).collect():
        for n, passage in passages.items():
            left[n] += passage in r.text
        if 1000 <= r.doc_id < 1008:
            assert r.text == copied
    assert left == {n: 2 if n == 2 else 1 for n in passages}
    assert sum(own in r.text for r in line_dedup.dedup_lines(docs).collect()) == 30
    docs.withColumn("n_lines", F.lit("x")).withColumn("N_Removed", F.lit("y")).write.parquet(tmp_dir + "/documents.parquet")
    out = queries.op1_line_dedup(spark, tmp_dir)
    assert out.columns == ["doc_id", "text", "n_lines", "n_removed"]
    assert {r.doc_id: r.n_lines for r in out.collect()}[1000] == 2


def test_keep_one_by_id_and_text(make, rng):
    a, b, c = (sentence(rng, 40) for _ in range(3))

    def kept(rows):
        return sorted(((r.doc_id, r.text) for r in simhash.keep_one(make(rows)).collect()), key=str)

    assert kept([(5, a, "s"), (5, b, "s")]) == sorted([(5, a), (5, b)], key=str)
    assert kept([(2, b, "s"), (5, a, "s"), (5, b, "t")]) == sorted([(2, b), (5, a)], key=str)
    assert kept([(5, a, "s"), (5, a, "s"), (6, a, "s"), (5, c, "s"), (5, c, "s")]) == sorted([(5, a), (5, c)], key=str)
    near = a.replace(a.split()[3], "other", 1)
    together = (brute_fp(a) ^ brute_fp(near)).bit_count() <= 3
    assert len(kept([(5, a, "s"), (5, near, "s"), (7, near, "s")])) == (1 if together else 2)
    assert kept([(None, a, "s"), (None, a, "s"), (3, a, "s")]) == sorted([(None, a), (None, a), (3, a)], key=str)
    assert kept([(None, a, "s")]) == [(None, a)]


def test_halves_of_the_rest_agree():
    r = random.Random(8)
    for width, bits in ((32, 3), (32, 1), (48, 2), (32, 0)):
        masks = simhash._halves(width, bits)
        for _ in range(300):
            a = r.getrandbits(width)
            b = a
            for _ in range(bits):
                b ^= 1 << r.randrange(width)
            assert any(a & m == b & m for m in masks)
        assert min(m.bit_count() for m in masks) >= (width // 2 - bits if bits else width)


def test_probes_are_never_broadcast(spark, monkeypatch):
    """Spark sizes exploded rows by the table that they come from, which can be a few MB for GBs of probes."""
    plans, real = {}, simhash.materialize
    monkeypatch.setattr(simhash, "materialize", lambda df, label: (
        plans.update({label: df._jdf.queryExecution().executedPlan().toString()}), real(df, label))[1])
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == "10485760b"  # the default
    fps = simhash.materialize(spark.range(2000).selectExpr("xxhash64(id) as fp"), "fps")  # a file of 16 kB
    assert simhash.hamming_links(fps).count() == 0
    assert "SortMergeJoin" in plans["simhash-hits"] and "Broadcast" not in plans["simhash-hits"]
