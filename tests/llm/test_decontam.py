import random

from chesstally.llm import decontam
from tests.llm.conftest import sentence


def sellers(p, t):
    """Least edit distance of p to a substring of t, by the plain dynamic programme."""
    row = list(range(len(p) + 1))
    best = row[-1]
    for c in t:
        new = [0]
        for i, x in enumerate(p, 1):
            new.append(min(row[i] + 1, new[-1] + 1, row[i - 1] + (x != c)))
        row = new
        best = min(best, row[-1])
    return best


def edit(r, s, n):
    s = list(s)
    for _ in range(n):
        at = r.randrange(len(s))
        op = r.randrange(3)
        if op == 0:
            s[at] = r.choice("qzj")
        elif op == 1:
            s.insert(at, r.choice("qzj"))
        else:
            del s[at]
    return "".join(s)


def test_myers_distance():
    r = random.Random(1)
    for _ in range(200):
        p = "".join(r.choice("ab c") for _ in range(r.randint(1, 90)))
        t = "".join(r.choice("ab c") for _ in range(r.randint(0, 120)))
        assert decontam.myers(p, t)[0] == sellers(p, t)


def test_pieces_cover_the_item():
    for n in (1, 15, 16, 17, 200):
        got = decontam.pieces("x" * n)
        assert len(got) == n // 16 + 1 and sum(len(p) for _, p in got) == n
        assert all(p and a + len(p) <= n for a, p in got)


def test_leaks_against_brute_force(spark, make):
    r = random.Random(4)
    items = [(i, sentence(r, r.randint(2, 40))) for i in range(12)]
    items += [(12, None), (13, ""), (14, "..."), (0, items[0][1]), (15, "the of"), (None, "zz top null id")]
    texts = [None, "", "!!", "The, OF!", "lathe of", sentence(r, 20000) + " " + items[2][1], "a zz top null id b"]
    for i, t in items[:12]:
        n = int(len(decontam.normalise(t)) / 16)
        for e in (0, n // 2, n, n + 1, 2 * n + 2):
            texts.append(sentence(r, 12) + " " + edit(r, t, e) + "\n" + sentence(r, 9))
        texts.append(t.upper().replace(" ", " -- "))
    docs = make(texts + [(500, items[3][1], "s"), (500, items[3][1], "s"), (None, items[4][1], "s")],
                extra=["item_id", "distance"])
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = []
    for row in docs.collect():
        t = decontam.normalise(row.text)
        for i, x in dict(items).items():
            x = decontam.normalise(x)
            if x and t:
                d = sellers(x, t)
                if d <= int(len(x) / 16):
                    want.append((str(row.doc_id), str(i), d))
    for chars in (10**6, 900):  # in one block, and in several passes
        out = decontam.find_leaks(docs, bench, block_chars=chars).collect()
        assert sorted((str(o.doc_id), str(o.item_id), o.distance) for o in out) == sorted(want)
    texts_of = {row.doc_id: row.text for row in docs.collect()}
    by = dict(items)
    for o in out:
        span = decontam.normalise(texts_of[o.doc_id][o.start:o.end])
        if o.distance == 0:
            assert span == decontam.normalise(by[o.item_id])
        assert sellers(decontam.normalise(by[o.item_id]), span) <= o.distance + 2
    leaked = {o.doc_id for o in out if o.doc_id is not None}
    for chars in (10**6, 900):
        kept = decontam.drop_leaks(docs, bench, block_chars=chars)
        assert kept.columns == docs.columns
        assert {k.doc_id for k in kept.collect()} == {i for i in texts_of if i is not None} - leaked
    none = bench.where("1 = 0")
    assert decontam.find_leaks(docs, none).count() == 0
    assert decontam.drop_leaks(docs, none).count() == docs.count()
    assert decontam.find_leaks(docs.where("1 = 0"), bench).count() == 0
