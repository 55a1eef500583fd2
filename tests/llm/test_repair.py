import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from chesstally.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string, ck string, pos int"


def rows_frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)


def hurt(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def brute(rows):
    """Facts and repaired lines of one conversation by whole audits in a plain dynamic programme."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    seen, faults = set(), []
    for _, _, role, text in rows:
        bare = text.strip(" \t\n\x0b\f\r")
        faults.append("b" if not bare else "d" if (role, text) in seen else "t" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    # state: (audit initials so far are in) "", "s", "u", "a"
    follow = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    def inserted(states):
        todo = list(states)
        while todo:
            s = todo.pop()
            for name in ("user", "assistant"):
                if (s, name[0]) in follow:
                    cost, audit, lines = states[s]
                    way = (cost + 5, audit + "I", (*lines, name + ":"))
                    t = follow[s, name[0]]
                    if t not in states or way < states[t]:
                        states[t] = way
                        todo.append(t)
        return states

    states = {"": (0, "", ())}
    for (_, _, role, text), fault in zip(rows, faults):
        before, states = inserted(dict(states)), {}
        for s, (cost, audit, lines) in before.items():
            ways = [(s, cost + 2, "D", ())]
            if fault not in ("b", "d"):
                more = 5 * (fault == "t")
                if (s, role[:1]) in follow:
                    ways.append((follow[s, role[:1]], cost + more, "K", (f"{role}:{text}",)))
                ways += [(follow[s, n[0]], cost + 1 + more, "R", (f"{n}:{text}",))
                         for n in ("user", "assistant") if (s, n[0]) in follow]
            for t, c, letter, line in ways:
                way = (c, audit + letter, lines + line)
                states[t] = min(states.get(t, way), way)
    cost, audit, lines = min(w for s, w in inserted(dict(states)).items() if s in ("", "a"))
    initials = [r[2][:1] for r in rows]
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return (gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, digest), list(lines)


FIELDS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def conversations(rng, n=120):
    rows = [(None, 1, "user", "No id."), (None, None, None, None), (None, 2, "assistant", "x" * 50_000 + "."),
            (5000, 0, "user", None), (5001, 0, "", "Empty role."), (5001, 1, "", "Empty role.")]
    for conv in range(n):
        for turn in range(rng.randint(1, 9)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "useful", None])
            text = rng.choice(["Yes.", "No!", "cut off", " ", "", "Why?\n", "é…", f"{rng.random()}."])
            rows += [(conv, rng.choice([turn, turn, turn, None, turn + 3]), role, text)] * rng.choice([1, 1, 1, 2])
    return rows


@pytest.mark.parametrize("block, fan", [(1, 2), (3, 2), (1024, 256)])
def test_repair_equals_plain_dynamic_programme(spark, block, fan):
    rows = conversations(random.Random(block))
    df = rows_frame(spark, rows)
    fixed = repair.Repair(df, block=block, fan=fan)
    got = {r.ck: r for r in fixed.conversations.join(fixed.digests(), "ck", "left").collect()}
    lines = {}
    for r in fixed.rows().withColumn("key", F.col("conv_id")).orderBy("key", "pos", "sub").collect():
        lines.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    empty = hashlib.sha256(b"").hexdigest()
    for conv in {r[0] for r in rows}:
        mine = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows if c == conv]
        want, said = brute(mine)
        r = got["n" if conv is None else f"a{conv}"]
        assert tuple(r[f] for f in FIELDS[:-1]) == want[:-1]
        assert (r.repaired_sha256 or empty) == want[-1]
        assert lines.get(conv, []) == said


def test_damaged_conversations(spark):
    rows = conversations(random.Random(4), 200)
    got = repair.repair_damaged(rows_frame(spark, rows)).collect()
    left = hurt(rows)
    assert len(got) == len({r[0] for r in rows})
    for r in got:
        mine = [x for x in left if x[0] == r.conv_id]
        if mine:
            assert tuple(r[f] for f in FIELDS) == brute(mine)[0], r.conv_id
        else:
            assert (r.cost, r.audit, r.gaps) == (0, "", 0)
            assert r.repaired_sha256 == hashlib.sha256(b"").hexdigest()
    assert repair.repair_damaged(rows_frame(spark, []).limit(0)).count() == 0


def test_a_conversation_of_most_rows_is_dealt_to_blocks(spark):
    rng = random.Random(9)
    rows = [(1, t, rng.choice(["user", "assistant", "system"]), rng.choice(["A.", "cut", "B?", f"{t}."])) for t in range(4000)]
    rows += [(2, 0, "user", "Hi."), (2, 1, "assistant", "Ho.")]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        fixed = repair.Repair(rows_frame(spark, rows).repartition(7), block=64, fan=4)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert fixed.blocks.selectExpr("max(length(codes))").first()[0] <= 64
    r = fixed.conversations.join(fixed.digests(), "ck").where("conv_id = 1").first()
    assert tuple(r[f] for f in FIELDS) == brute(rows[:4000])[0]
    # no task of the written rows holds the whole conversation
    assert fixed.laid.where("conv_id = 1").select("part").distinct().count() > 2


def test_hirschberg_equals_forward_programme():
    rng = random.Random(2)
    for _ in range(300):
        codes = "".join(rng.choice(repair._CLASSES) for _ in range(rng.randint(1, 40)))
        for s in range(4):
            cost, _ = repair._forward(codes, s)
            for e in range(4):
                if cost[e] < repair._FAR:
                    path = repair.hirschberg(codes, s, e)
                    assert len(path) == len(codes)
                    paid = sum({"D": 2, "I": 5, "R": 1, "K": 0}[c] for a, _ in path for c in a)
                    paid += sum(5 for c, (a, _) in zip(codes, path) if (ord(c) - 97) % 3 == 1 and a[-1] != "D")
                    assert paid == cost[e]
