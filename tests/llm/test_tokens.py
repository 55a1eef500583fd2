import os
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest

from chesstally.llm import packing, token_scan
from chesstally.llm.tokens import END, RANKS, encode
from tests.llm.conftest import sentence

PATH = public_tokenizers.path(RANKS)


def rows_of(rng):
    texts = [None, "", " ", "one", sentence(rng, 9000), "é🙂", "<|endoftext|>"]
    texts += [sentence(rng, rng.randint(0, 400)) for _ in range(150)]
    return ([(i, t, "s") for i, t in enumerate(texts)]
            + [(3, "one", "s"), (None, "no id at all", "s"), (4, "again", "s")])


@pytest.mark.parametrize("block", [1, 7, 64, 1 << 18])
def test_counts_by_scan_equal_direct_counts(make, rng, block):
    rows = rows_of(rng)[:40] if block == 1 else rows_of(rng)
    rows = [r for r in rows if block > 1 or len(r[1] or "") < 2000]
    docs = make(rows, extra=["file", "block", "data", "n_tokens"])
    got = token_scan.count_tokens(docs, PATH, block_ids=block).collect()
    assert sorted((str(g.doc_id), g.n_tokens) for g in got) == sorted(
        (str(i), len(encode(PATH, t))) for i, t, _ in rows)
    assert token_scan.count_tokens(docs.where("1 = 0"), PATH).count() == 0


def test_scan_of_raw_files(spark, tmp_dir, rng):
    want = {}
    for name in "abc":
        lens = [rng.choice([0, 0, 1, 5, 40, 300]) for _ in range(rng.randint(1, 60))]
        flat = []
        for n in lens:
            flat += [rng.randrange(1000) for _ in range(n)] + [END]
        if name != "a":  # an open end
            flat += [5] * 17
            lens.append(17)
        np.array(flat, "<u2").tofile(os.path.join(tmp_dir, name + ".bin"))
        want[name] = lens
    np.array([], "<u2").tofile(os.path.join(tmp_dir, "empty.bin"))
    for block in (3, 50, 1 << 18):
        got = defaultdict(dict)
        for r in token_scan.scan(token_scan.read_files(spark, tmp_dir, block)).collect():
            got[r.file[-5]][r.ordinal] = r.n_tokens
        assert {k: [v[i] for i in range(len(v))] for k, v in got.items()} == want


def best_fit_decreasing(lengths, cap):
    segs = sorted(((min(cap, n - a), i, a) for i, n in enumerate(lengths) for a in range(0, n, cap)),
                  key=lambda s: (-s[0], s[1], s[2]))
    rooms = []
    for n, _, _ in segs:
        fit = [r for r in rooms if r >= n]
        if fit:
            rooms.remove(min(fit))
            rooms.append(min(fit) - n)
        else:
            rooms.append(cap - n)
    return sorted(rooms)


def test_rooms_equal_plain_best_fit(rng):
    for cap in (1, 2, 7, 64, 100):
        for _ in range(20):
            lengths = [rng.choice([0, 1, rng.randint(0, cap), rng.randint(0, 3 * cap)]) for _ in range(60)]
            rows = packing.pack(lengths, cap)
            assert sorted(cap - sum(n for *_, n in r) for r in rows) == best_fit_decreasing(lengths, cap)
            got = defaultdict(list)
            for r in rows:
                for i, a, n in r:
                    got[i].append((a, n))
            for i, n in enumerate(lengths):
                assert [x for a, k in sorted(got[i]) for x in range(a, a + k)] == list(range(n))


@pytest.mark.parametrize("length,window", [(64, 500), (2048, 1 << 21), (100, 50)])
def test_packed_rows_give_the_documents_back(make, rng, length, window):
    rows = rows_of(rng)
    docs = make(rows, extra=["row", "window", "input_ids"])
    out = packing.pack_documents(docs, PATH, length=length, window_ids=window).collect()
    assert len({(r.shard, r.window, r.row) for r in out}) == len(out)
    ids, pos = packing.matrix(out), packing.matrix(out, "position_ids")
    assert ids.shape == pos.shape == (len(out), length)
    back = defaultdict(list)
    for r, row, p in zip(out, ids, pos):
        assert r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_used <= length
        assert (row[r.n_used:] == END).all() and (p[r.n_used:] == 0).all()
        for doc, start, a, b in zip(r.doc_ids, r.doc_starts, r.cu_seqlens, r.cu_seqlens[1:]):
            assert b > a and p[a:b].tolist() == list(range(b - a))
            back[doc].append((start, row[a:b].tolist()))
    want = defaultdict(list)
    for i, t, _ in rows:
        want[i].append(encode(PATH, t).tolist())
    for i, lists in want.items():
        flat = [x for _, part in sorted(back[i], key=lambda s: s[0]) for x in part]
        assert len(flat) == sum(map(len, lists))
        if len(lists) == 1:
            assert flat == lists[0]
    assert packing.pack_documents(docs.where("1 = 0"), PATH).count() == 0
