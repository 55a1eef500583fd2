import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from chesstally.llm import lm
from tests.llm.conftest import sentence


def small_network(vocab=40):
    r = np.random.default_rng(0)
    net = lm.Network(np.arange(vocab, 0, -1).astype(float))
    net.p = {k: (v + r.normal(0, 0.2, v.shape)).astype(np.float64) for k, v in net.p.items()}
    return net


def plain_score(net, ids):
    """Token by token, straight from the equations."""
    n, p = lm.HIDDEN, net.p
    h, last, total = np.zeros(n), lm.END, 0.0

    def sig(x):
        return 1 / (1 + np.exp(-x))

    for to in [*ids, lm.END]:
        x, g = p["x"][last] + p["b"], h @ p["u"]
        z, r = sig(x[:n] + g[:n]), sig(x[n:2 * n] + g[n:2 * n])
        c = np.tanh(x[2 * n:] + r * g[2 * n:])
        h = (1 - z) * c + z * h
        a = np.exp(h @ p["c"] + p["cb"])
        k, w = divmod(int(to), net.width)
        b = np.exp(h @ p["o"][k] + p["ob"][k])
        total += math.log(a[k] / a.sum()) + math.log(b[w] / b.sum())
        last = to
    return total


def test_scores_in_windows_equal_the_equations():
    r = random.Random(1)
    net = small_network()
    texts = [np.array([r.randrange(40) for _ in range(n)], np.int64) for n in (0, 1, 31, 32, 33, 64, 200, 5)]
    for steps, batch in ((32, 512), (7, 3)):
        got = net.score(texts, steps, batch)
        assert np.allclose(got, [plain_score(net, t) for t in texts], rtol=1e-5)


def test_probabilities_sum_to_one():
    net = small_network(64)
    h = np.random.default_rng(1).normal(size=(1, lm.HIDDEN))
    got, _ = net.log_probability(np.repeat(h, 64, 0), np.arange(64))
    assert np.exp(got).sum() == pytest.approx(1.0, abs=1e-6)
    sp = lm.Spelling([b"abc", b"abd", b"\xc3\xa9a"] * 5)
    each = sp.log.reshape((sp.n,) * 4)
    assert np.allclose(np.exp(each).sum(3), 1)


def test_gradients_by_differences():
    net = small_network()
    r = np.random.default_rng(3)
    ids, to = r.integers(0, 40, (6, 4)), r.integers(0, 40, (6, 4))
    keep, mask = (r.random((6, 4)) > .2).astype(float), r.random((6, 4)) > .3
    h0 = r.normal(size=(4, lm.HIDDEN))
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    _, _, grads, _ = net.gradients(ids, keep, to, mask, h0)
    for name in net.p:
        flat = net.p[name].reshape(-1)
        for at in r.choice(len(flat), 6, replace=False):
            old, eps = flat[at], 1e-5
            flat[at] = old + eps
            up = net.gradients(ids, keep, to, mask, h0)[0]
            flat[at] = old - eps
            down = net.gradients(ids, keep, to, mask, h0)[0]
            flat[at] = old
            assert grads[name].reshape(-1)[at] == pytest.approx((up - down) / (2 * eps), abs=2e-3)


def test_classes_share_their_steps(monkeypatch):
    """Logits of all classes are bounded and exponentiated at once, not class by class."""
    net, sizes = small_network(64), []
    bounded = lm._bounded
    monkeypatch.setattr(lm, "_bounded", lambda x: sizes.append(x.shape) or bounded(x))
    h = np.random.default_rng(2).normal(size=(64, lm.HIDDEN))
    together, _ = net.log_probability(h, np.arange(64))
    assert sizes == [(64, lm.CLASSES), (64, net.width)]
    alone = [net.log_probability(h[i:i + 1], np.arange(i, i + 1))[0][0] for i in range(64)]
    assert together == pytest.approx(alone, rel=1e-9)


def test_words_of_many_texts_at_once():
    r = random.Random(12)
    marks = [*" \t\n\x0b\x0c\r", "\x1c", "\x1f", "\x85", "\xa0", "\u2003", "\u3000", "\0", *"AzÉİ漢\x08\x0e\x7f"]
    texts = ["".join(r.choice(marks) for _ in range(r.randrange(12))) for _ in range(3000)] + [None, "", " ", " a ", "b"]
    for some in (texts, texts[-5:], texts[-5:-4], []):
        words, begins = lm._words(pa.array(["cut off", *some], pa.string()).slice(1))
        words = words.to_pylist()
        assert begins[-1] == len(words) and len(begins) == len(some) + 1
        assert [words[a:b] for a, b in zip(begins, begins[1:])] == [lm.tokens(t) for t in some]
    words = [w for t in texts for w in lm.tokens(t)]
    one, many = lm.Spelling(words), lm.Spelling(pa.array([b"", *words], pa.binary()).slice(1))
    assert (one.log == many.log).all()
    assert (one.log_probability(words) == many.log_probability(pa.array([b"", *words], pa.binary()).slice(1))).all()


def test_documents_against_brute_force(make, monkeypatch):
    monkeypatch.setattr(lm, "KNOWN_WORDS", 20)
    monkeypatch.setattr(lm, "_FLUSH", 50)
    r = random.Random(5)
    rows = [(i, sentence(r, r.randint(0, 60)) + f" rare{r.randrange(60)}", "s") for i in range(200)]
    monkeypatch.setattr(lm, "VOCAB", 40)
    rows += [(300, None, "s"), (301, "", "s"), (302, "THE the é unseenword", "s"), (None, "the of", "s"),
             (5, rows[5][1], "s"), (303, sentence(r, 20000), "s")]
    docs = make(rows, extra=["words", "times", "rid", "score", "c"])
    out = lm.score_documents(docs).collect()
    counts = Counter()
    for i, t, _ in rows:
        if i is not None and zlib.crc32(str(i).encode()) % 7 != 2:
            counts.update([*lm.tokens(t), b""])
    n, v = sum(counts.values()), len(counts)
    want = []
    for i, t, _ in rows:
        toks = [*lm.tokens(t), b""]
        want.append((str(i), i is not None and zlib.crc32(str(i).encode()) % 7 == 2, len(toks),
                     sum(counts[w] > 0 for w in toks), n,
                     sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in toks)))
    got = sorted((str(o.doc_id), o.held_out, o.n_tokens, o.n_known, o.train_tokens, o.base_score) for o in out)
    for g, w in zip(got, sorted(want), strict=True):
        assert g[:5] == w[:5] and g[5] == pytest.approx(w[5], rel=1e-9)
    model = lm.fit(docs, lm.token_counts(docs))
    others = {w: c for w, c in counts.items() if w and w not in model.ids}
    assert sum(others.values()) == model.others
    texts = sorted((str(i), t) for i, t, _ in rows if len(t or "") < 3000)
    scores = {str(o.doc_id): o.score for o in out}
    for i, t in texts:
        toks = lm.tokens(t)
        ln = plain_score(model.network, model.encode(toks))
        ln += sum(math.log(model.spelt([w])[0] + model.share(counts[w])) for w in toks if w not in model.ids)
        assert scores[i] == pytest.approx(ln / math.log(10), rel=1e-4)
    assert lm.score_documents(docs.where("1 = 0")).count() == 0


def test_order_is_learnt(make):
    """Words that follow a fixed cycle: the network must beat the unigram on held-out documents."""
    r = random.Random(6)
    cycle = [f"w{i}" for i in range(12)]
    rows = []
    for i in range(700):
        a = r.randrange(12)
        rows.append((i, " ".join(cycle[(a + k) % 12] for k in range(r.randint(10, 60))), "s"))
    out = [o for o in lm.score_documents(make(rows)).collect() if o.held_out]
    assert len(out) > 50
    assert sum(o.score for o in out) > 0.6 * sum(o.base_score for o in out)


def test_long_unseen_words_cost_their_spelling(make):
    """Words whose probability is below the least double, in held-out and null-id documents."""
    r = random.Random(8)
    rows = [(i, sentence(r, 30) + f" rare{i}", "s") for i in range(200)]
    unseen = next(i for i in range(300, 400) if zlib.crc32(str(i).encode()) % 7 == 2)
    words = ["".join(r.choice("abcdefghij") for _ in range(1000)), "漢字仮名" * 84, "the", "é" * 5000]
    rows += [(unseen, " ".join(words), "s"), (None, " ".join(words[:2]), "s"), (None, "the", "s")]
    docs = make(rows)
    model = lm.fit(docs, lm.token_counts(docs))
    assert all(model.spelt([w.encode()])[0] == 0 for w in words if w != "the")
    got = {(o.doc_id, o.n_tokens): o.score for o in lm.score_documents(docs).collect()}
    for key, words in (((unseen, 5), words), ((None, 3), words[:2]), ((None, 2), ["the"])):
        toks = [w.encode() for w in words]
        ln = plain_score(model.network, model.encode(toks))
        ln += sum(model.spelling.log_probability([w])[0] + math.log(model.spelled) for w in toks if w != b"the")
        assert got[key] == pytest.approx(ln / math.log(10), rel=1e-4)
    assert got[None, 3] < got[None, 2] - 1000


def test_long_known_words_cost_their_share(make, monkeypatch):
    """The same for long words that training documents hold, inside and outside the table of counts."""
    r = random.Random(9)
    long = "z" * 3000
    rows = [(i, sentence(r, 30) + f" rare{i} {long if i % 3 == 0 else ''}", "s") for i in range(200)]
    monkeypatch.setattr(lm, "VOCAB", 10)
    docs = make(rows + [(None, long, "s")])
    for known in (1 << 16, 20):
        monkeypatch.setattr(lm, "KNOWN_WORDS", known)
        counts = lm.token_counts(docs)
        model = lm.fit(docs, counts)
        c = counts.where(lm.F.col("word") == long.encode()).first()["c"]
        ln = plain_score(model.network, model.encode([long.encode()])) + math.log(model.share(c))
        got = next(o.score for o in lm.score_documents(docs).collect() if o.doc_id is None)
        assert got == pytest.approx(ln / math.log(10), rel=1e-4)


def test_learns_from_all_training_documents(make):
    """Order shown by long documents only, and spelling of words that any of them holds."""
    r = random.Random(10)
    cycle = [f"word{i:06d}" for i in range(12)]
    train = [i for i in range(60) if zlib.crc32(str(i).encode()) % 7 != 2][:8]
    held = [i for i in range(60) if zlib.crc32(str(i).encode()) % 7 == 2][:5]
    long = " ".join(cycle) + " "
    rows = [(i, long * 800, "s") for i in train] + [(i, long * 4, "s") for i in held]
    assert len(rows[0][1]) > 100_000
    got = [o for o in lm.score_documents(make(rows)).collect() if o.held_out]
    assert len(got) == len(held) and sum(o.score for o in got) > 0.6 * sum(o.base_score for o in got)
    words = [("".join(r.choice("abcdé") for _ in range(r.randint(1, 9))).encode(), r.randrange(1, 5)) for _ in range(90)]
    docs = make(["x"])
    counts = docs.sparkSession.createDataFrame([(bytearray(w), c) for w, c in words], "word binary, c long")
    want = lm.Spelling([w for w, _ in words])
    assert np.allclose(lm.Spelling.of_counts(counts).log, want.log)


def test_scores_do_not_depend_on_partitions(make, monkeypatch):
    """Several shards a round, a document given many times, and other orders and partitions."""
    monkeypatch.setattr(lm, "SHARD_TOKENS", 3000)
    monkeypatch.setattr(lm, "LANE_TOKENS", 500)
    monkeypatch.setattr(lm, "FAN", 2)
    r = random.Random(11)
    rows = [(i, sentence(r, r.randint(0, 120)), "s") for i in range(400)] + [(7, sentence(r, 300), "s")]
    rows += [(8, rows[9][1], "hot")] * 60
    got = [sorted((str(o.doc_id), o.n_tokens, o.score) for o in lm.score_documents(df).collect())
           for df in (make(rows).coalesce(1), make(rows[::-1]).repartition(4))]
    for a, b in zip(*got, strict=True):
        assert a[:2] == b[:2] and a[2] == pytest.approx(b[2], rel=1e-5)
    train = [(i, t) for i, t, _ in rows if zlib.crc32(str(i).encode()) % 7 != 2]
    total = sum(len(lm.tokens(t)) + 1 for _, t in train)
    src = make(rows).selectExpr("doc_id as id", "text")
    coded = lm._coded(src, {b"the": 2}, total)
    sizes = {(x["round"], x.shard): x.n for x in coded.groupBy("round", "shard").agg(
        lm.F.sum(lm.F.length("data") / 2 + 1).alias("n")).collect()}
    assert {i for i, _ in sizes} == {0, 1, 2, 3} and max(s for _, s in sizes) > 2
    assert max(sizes.values()) < 2 * 3000  # the row given 60 times is in no single shard
    assert sum(sizes.values()) == total


def test_lanes_lose_no_token():
    """Long and short documents: each target is learnt from once, with the state reset between documents."""
    net, seen = small_network(), []
    r = np.random.default_rng(4)
    texts = [r.integers(2, 40, n).astype(np.uint16) for n in (0, 1, 24, 25, 300, 7, 7, 60)]

    def gradients(ids, keep, to, mask, h0):
        seen.append((ids, keep, to, mask))
        return 0.0, int(mask.sum()), {k: np.zeros_like(v) for k, v in net.p.items()}, h0

    net.gradients = gradients
    lm.LANE_TOKENS, kept = 100, lm.LANE_TOKENS
    net.fit(texts)
    lm.LANE_TOKENS = kept
    assert sum(int(m.sum()) for *_, m in seen) == sum(len(t) + 1 for t in texts)
    assert sum(int(((k == 0) & m).sum()) for _, k, _, m in seen) == len(texts)
    bag = Counter(int(x) for _, _, to, m in seen for x in to[m])
    assert bag == Counter([lm.END] * len(texts) + [int(x) for t in texts for x in t])


def test_nothing_to_learn_from(make):
    """Only rows that are held out or have no id."""
    held = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 7 == 2)
    out = lm.score_documents(make([(held, "a few words", "s"), (None, "others", "s"), (held, None, "s")])).collect()
    assert sorted((o.n_tokens, o.n_known, o.train_tokens) for o in out) == [(1, 0, 0), (2, 0, 0), (4, 0, 0)]
    assert all(o.base_score == 0 and math.isfinite(o.score) and o.score < 0 for o in out)
