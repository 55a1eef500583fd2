import hashlib
import random
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from chesstally.llm import minhash
from tests.llm.conftest import sentence


def hashes(text, k=5):
    words = [w for w in __import__("re").split("[ \t\n\x0b\f\r]+", (text or "").lower()) if w]
    out = set()
    for i in range(max(1, len(words) - k + 1) if words else 0):
        seed = 42
        for w in words[i:i + k]:
            seed = xxhash.xxh64_intdigest(w.encode(), seed)
        out.add(seed)
    return out


def brute(text, bins=minhash.BINS):
    least = [None] * bins
    for h in hashes(text):
        b, v = h % bins, h >> 33
        least[b] = v if least[b] is None else min(v, least[b])
    if not any(x is not None for x in least):
        return ""
    full = []
    for i, (start, stride) in enumerate(minhash._walks(bins)):
        walk = [i] + [(start + stride * t) % bins for t in range(bins)]
        assert set(walk) == set(range(bins))
        full.append(next(least[j] for j in walk if least[j] is not None))
    return "".join(f"{x & 255:02x}" for x in full)


def like(a, b, bins=minhash.BINS):
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    agree = sum(a[i:i + 2] == b[i:i + 2] for i in range(0, 2 * bins, 2)) / bins
    return max(0.0, (agree - 1 / 256) / (1 - 1 / 256))


def test_edited_documents_against_brute_force(make):
    r = random.Random(9)
    rows = [(1000 * i if i % 7 else 500 + i, sentence(r, r.randint(0, 120)), "s") for i in range(1, 200)]
    rows += [(-5, None, "s"), (7, "", "s"), (9, "ab", "s"), (11, " \n", "s"), (12, "É é ſtraße one two three four", "s"),
             (10**12, sentence(r, 20000), "s"), (13, "Same Words here", "s"), (14, "same words  here", "s")]
    docs = make(rows, extra=["fp", "bucket", "tie", "fingerprint"])
    out = {x.doc_id: x for x in minhash.edited_documents(docs).collect()}
    assert len(out) == len(rows) == docs.count()
    order = sorted(rows, key=lambda x: -x[0])
    for (i, t, _), (_, nxt, _) in zip(order, order[1:] + order[:1]):
        t, nxt = t or "", nxt or ""
        m = len(t) // 3
        edited = t[:len(t) - m] + nxt[:m]
        x = out[i]
        assert (x.n_chars, x.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest()), i
        assert x.fingerprint == brute(t) and x.edited_fingerprint == brute(edited)
        assert x.near_edited == pytest.approx(like(brute(t), brute(edited)))
        assert x.near_next == pytest.approx(like(brute(t), brute(nxt)))
    assert out[13].fingerprint == out[14].fingerprint
    plan = minhash.edited_documents(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "InArrow" not in plan


def test_estimate_is_near_the_resemblance(spark):
    r = random.Random(2)
    pairs, errors = [], []
    for _ in range(60):
        words = sentence(r, 600).split()
        cut = r.randint(0, 600)
        pairs.append((" ".join(words), " ".join(words[:cut]) + " " + sentence(r, 600 - cut)))
    df = spark.createDataFrame(pairs, "a string, b string").select(
        "a", "b", minhash.fingerprint(F.col("a")).alias("x"), minhash.fingerprint(F.col("b")).alias("y"))
    for row in df.select("a", "b", minhash.likeness(F.col("x"), F.col("y")).alias("s")).collect():
        a, b = hashes(row.a), hashes(row.b)
        errors.append(row.s - len(a & b) / len(a | b))
    assert abs(sum(errors) / len(errors)) < 0.02 and max(map(abs, errors)) < 0.18


def test_ties_nulls_and_small_tables(make):
    docs = make([(3, "a b", "s"), (3, "c d", "s"), (3, "a b", "s"), (None, "x", "s"), (None, None, "s")])
    out = minhash.edited_documents(docs).collect()
    assert sorted(str(x.doc_id) for x in out) == ["3", "3", "3", "None", "None"]
    one = minhash.edited_documents(make(["only one here"])).collect()
    assert one[0].near_next == 1.0 and one[0].n_chars == 13
    assert minhash.edited_documents(docs.where("1 = 0")).count() == 0
    assert minhash.fingerprints(docs).count() == 5


def test_buckets_of_uneven_ids(make):
    """An outlying id, ids that many rows share, and many rows without one: no bucket holds much more than
    its share, and buckets follow the order of the rows."""
    r = random.Random(5)

    def sizes(rows):
        df = make(rows).select("doc_id", "text").withColumn("tie", F.xxhash64("text"))
        got = df.withColumn("b", minhash._bucket(df, 50, 512, 128)).collect()
        order = sorted(got, key=lambda x: (x.doc_id is None, -(x.doc_id or 0), x.tie))
        assert [x.b for x in order] == sorted(x.b for x in got)
        return max(Counter(x.b for x in got).values())

    plain = [(i, f"text {i} {r.random()}", "s") for i in range(2000)]
    assert sizes(plain) <= 110
    assert sizes(plain + [(10**15, "far", "s"), (-2**62, "lowest", "s")]) <= 110
    assert sizes([(2**63 - 1 if i % 7 else i * 2**50, f"{i}", "s") for i in range(900)]) <= 110
    assert sizes(plain[:1400] + [(None, f"no id {i}", "s") for i in range(600)]) <= 110
    assert sizes(plain[:1400] + [(700, f"one id {i}", "s") for i in range(700)]) <= 110
    assert sizes([(int(r.paretovariate(.3)) % 2**60, f"{i}", "s") for i in range(2000)]) <= 110
    assert sizes(plain[:3]) <= 3 and sizes([(None, "a", "s")]) == 1


def test_next_documents_of_uneven_ids(make):
    r = random.Random(6)
    rows = [(i, f"text {i}", "s") for i in range(700)] + [(10**15, "far", "s")]
    rows += [(None, f"no id {i}", "s") for i in range(300)] + [(350, f"shared {i}", "s") for i in range(300)]
    r.shuffle(rows)
    df = make(rows)
    ties = {x.text: x.t for x in df.select("text", F.xxhash64("text").alias("t")).collect()}
    order = sorted(rows, key=lambda x: (x[0] is None, -(x[0] or 0), ties[x[1]]))
    want = sorted((a[1], b[1]) for a, b in zip(order, order[1:] + order[:1]))
    got = minhash.next_documents(df, rows_per_bucket=20).select("text", "next_text").collect()
    assert sorted(map(tuple, got)) == want
