import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from chesstally.llm import mixing
from tests.llm.conftest import sentence

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def water_fill(sizes, weights=(3, 1, 2), share=1.5, stop=2):
    """Targets by sharing the excess of full sources again and again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, rest, open_ = dict.fromkeys(names, 0.0), share * sum(sizes.values()), set(names)
    while rest > 1e-9 and open_:
        total, over = sum(weight[s] for s in open_), 0.0
        for s in sorted(open_, key=str):
            target[s] += rest * weight[s] / total
        for s in list(open_):
            if target[s] >= stop * sizes[s]:
                over += target[s] - stop * sizes[s]
                target[s] = stop * sizes[s]
                open_.discard(s)
        rest = over
    return target


def corpus(rng):
    texts = [None, "", " \t ", "one", sentence(rng, 3000), "a b c"] + [sentence(rng, rng.randint(0, 90)) for _ in range(240)]
    names = ["hot"] * 6 + ["b", "a", "é", None, "zz", "c"]
    rows = [(i, t, rng.choice(names)) for i, t in enumerate(texts)]
    return rows + [(3, "one", "hot"), (3, "one", "hot"), (None, "no id", "a"), (5, "tiny source", "tiny"), (6, "", "void")]


@pytest.mark.parametrize("block, slots", [(16, 32), (7, 5), (1024, 16384)])
def test_mix(make, rng, block, slots):
    rows = corpus(rng)
    docs = make(rows, extra=["size", "target", "sk", "part", "pos"])
    mix = mixing.Mix(docs, block=block, shard_slots=slots, texts=True)
    got = mix.taken().collect()
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(WORD.findall(t or ""))
    want = water_fill(sizes)
    by_id = {i: s for i, _, s in rows}
    assert sorted((str(g.doc_id), g.size) for g in got) == sorted((str(i), len(WORD.findall(t or ""))) for i, t, _ in rows)
    taken, target = Counter(), {}
    for g in got:
        assert 0 <= g.taken <= 2 * g.size
        if list(by_id).count(g.doc_id) and sum(i == g.doc_id for i, _, _ in rows) == 1:
            s = by_id[g.doc_id]
            assert g.source_size == sizes[s] and g.target == pytest.approx(want[s])
    for s, words in sizes.items():
        mine = [g for g in got if g.target == pytest.approx(want[s]) and g.source_size == words]
        assert sum(g.taken for g in mine) == int(want[s] + 0.5)
    # the mix itself: as many words per source, slots of a shard numbered from 0, words of the source's documents
    said = mix.texts().collect()
    spoken, spots = Counter(), defaultdict(list)
    for r in said:
        words = r.text.split(" ")
        assert len(words) == r.words <= block
        spoken[r.source] += len(words)
        spots[r.shard].append(r.slot)
    assert {s: n for s, n in spoken.items()} == {s: int(t + 0.5) for s, t in want.items() if t}
    assert all(sorted(v) == list(range(len(v))) for v in spots.values())
    assert sorted(map(len, spots.values()))[1:] == [slots] * (len(spots) - 1)
    bag = Counter()
    for r in said:
        bag.update((r.source, w) for w in r.text.split(" "))
    have = Counter((s, w) for _, t, s in rows for w in WORD.findall(t or ""))
    assert all(bag[k] <= 2 * n for k, n in have.items()) and not set(bag) - set(have)


def test_reruns_and_partitions_agree(make, rng):
    rows = corpus(rng)
    one = mixing.Mix(make(rows), block=16, shard_slots=32)
    two = mixing.Mix(make(rows[::-1]).repartition(11), block=16, shard_slots=32)
    assert sorted(map(str, one.taken().collect())) == sorted(map(str, two.taken().collect()))
    assert sorted(one.slots.collect()) == sorted(two.slots.collect())
    many = mixing.Mix(make(rows), block=16, shard_slots=32, seed=12)
    assert sorted(many.slots.collect()) != sorted(one.slots.collect())


def test_shards_resemble_the_targets(make, rng):
    docs = make([(i, sentence(rng, 200), "a" if i < 400 else "b") for i in range(800)])
    mix = mixing.Mix(docs, block=20, shard_slots=1000)
    share = {r.sk: r["sum(words)"] for r in mix.slots.where("shard = 3").groupBy("sk").sum("words").collect()}
    # targets 160,000 (the first source stops) and 80,000 words; 1000 slots stay within five deviations
    assert abs(share["aa"] / (share["aa"] + share["ab"]) - 2 / 3) < 5 * (2 / 9 / 1000) ** 0.5


def test_many_sources_are_drawn_by_groups(make, rng, monkeypatch):
    monkeypatch.setattr(mixing, "GROUP", 3)
    rows = corpus(rng)
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(WORD.findall(t or ""))
    mix = mixing.Mix(make(rows), block=16, shard_slots=32)
    words = {r.sk: r["sum(words)"] for r in mix.slots.groupBy("sk").sum("words").collect()}
    assert words == {"n" if s is None else "a" + s: int(t + 0.5) for s, t in water_fill(sizes).items() if t}


def test_without_words(make):
    for docs in (make([(1, None, "a"), (2, " ", None)]), make([(1, "x", "a")]).where("1 = 0")):
        mix = mixing.Mix(docs, texts=True)
        assert [(g.taken, g.target) for g in mix.taken().collect()] == [(0, 0.0)] * docs.count()
        assert mix.slots.count() == 0 and mix.texts().count() == 0


def test_permutations():
    for n in (1, 2, 3, 5, 64, 1000, 4097):
        key = np.full(n, 17 * n - 2**40)
        at = np.arange(n)
        to = mixing.permute(at, np.full(n, n), key)
        assert sorted(to) == list(at)
        assert (mixing.permute(to, np.full(n, n), key, back=True) == at).all()
        if n > 60:
            assert (to != at).mean() > 0.9
