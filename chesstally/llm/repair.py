"""Structure repair of conversations by Hirschberg's divide and conquer.

A conversation must read as an optional system message followed by user/assistant pairs (or be empty).
Rows may be kept (0), given another role (1), deleted (2; blank rows and repeats must be) and messages
without text inserted (5); a truncated row that stays costs 5. Reading positions form four states
(nothing yet, after system, after user, after assistant), so all that a run of rows can do is a 4x4
table of least costs. Two such tables join by a (min, +) product.

* Inside a block of rows, Hirschberg's method: forward costs from the start state and backward costs
  from the end state meet in the middle, the best crossing state splits the problem in two, and so on
  down to single rows. Memory is two vectors of four states, whatever the length.
* Across blocks the same: the tables of blocks are joined up a tree (``FAN`` children a node), and
  crossing states are chosen down the tree. A conversation of any length, even one that holds a third
  of all rows, is so dealt to tasks of at most ``BLOCK`` rows or ``FAN`` tables each.

Ties go to the edits whose initials (D, I, K, R) come first. Insertions belong to the row after them,
so parts that end in different states differ before either ends, and a part's audits need no text to
be compared: each table carries the ranks of its four end states' audits, and the crossing with the
least rank is the audit-least one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chesstally.llm.common import materialize
from chesstally.llm.ordered import key_of, lay_out, running

BLOCK = 1024
FAN = 256

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
_FAR = 1 << 60  # the cost of what cannot be
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_FINE, _CUT, _DROP = range(3)
#: Trailing insertions that complete a conversation in each state.
_TAIL = {_START: "", _SYSTEM: "II", _USER: "I", _ASSISTANT: ""}
_NAMES = {"u": "user", "a": "assistant"}


def _next(state: int, initial: str) -> int | None:
    """The state after a message, if it may stand there."""
    if initial == "s":
        return _SYSTEM if state == _START else None
    if initial == "u":
        return None if state == _USER else _USER
    return _ASSISTANT if initial == "a" and state == _USER else None


def _ways(initial: str, fault: int) -> list[dict[int, tuple[int, str, str]]]:
    """For each state before a row: the states after it with cost, audit and what becomes of the row
    (inserted roles, then K, D, or the new role's initial in capitals), cheapest and least first."""
    rows = []
    for state in range(4):
        best: dict[int, tuple[int, str, str]] = {}
        at, cost, letters, added = state, 0, "", ""
        for _ in range(3):  # none, one or two insertions; a third would return to a state
            ways = [(at, DELETE, "D", "D")]
            if fault != _DROP:
                more = TRUNCATED * (fault == _CUT)
                if (to := _next(at, initial)) is not None:
                    ways.append((to, KEEP + more, "K", "K"))
                role = "a" if at == _USER else "u"
                ways.append((_next(at, role), REROLE + more, "R", role.upper()))
            for to, c, letter, what in ways:
                way = (cost + c, letters + letter, added + what)
                best[to] = min(best.get(to, way), way)
            role = "a" if at == _USER else "u"
            at, cost, letters, added = _next(at, role), cost + INSERT, letters + "I", added + role
        rows.append(best)
    return rows


#: By row class: three faults for each initial.
_WAYS = [_ways(i, f) for i in "sua?" for f in range(3)]
_CLASSES = "abcdefghijkl"  # a row's class as a letter, so a block is a string


def row_class(role: Column, drop: Column, cut: Column) -> Column:
    """The letter of a row's class."""
    first = F.substring(role, 1, 1)
    at = F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)
    fault = F.when(drop, _DROP).when(cut, _CUT).otherwise(_FINE)
    return F.substring(F.lit(_CLASSES), (at * 3 + fault + 1).cast("int"), F.lit(1))


def _forward(codes: str, state: int) -> tuple[list[int], list[int]]:
    """Least costs of reaching each state over the rows, and the ranks of their least audits."""
    cost, rank = [_FAR] * 4, [0] * 4
    cost[state] = 0
    for code in codes:
        best: list = [None] * 4
        for p, ways in enumerate(_WAYS[ord(code) - 97]):
            if cost[p] < _FAR:
                for t, (c, letters, _) in ways.items():
                    way = (cost[p] + c, rank[p], letters)
                    if best[t] is None or way < best[t]:
                        best[t] = way
        cost = [_FAR if b is None else b[0] for b in best]
        order = sorted((b[1:], t) for t, b in enumerate(best) if b is not None)
        rank = [0] * 4
        for r, (_, t) in enumerate(order):
            rank[t] = r
    return cost, rank


def _backward(codes: str, state: int) -> list[int]:
    """Least costs of reaching ``state`` at the end from each state before the rows."""
    cost = [_FAR] * 4
    cost[state] = 0
    for code in reversed(codes):
        ways = _WAYS[ord(code) - 97]
        cost = [min((c + cost[t] for t, (c, _, _) in ways[p].items()), default=_FAR) for p in range(4)]
    return [min(c, _FAR) for c in cost]


def _crossing(cost: list[int], rank: list[int], rest: list[int]) -> int:
    return min((cost[s] + rest[s], rank[s], s) for s in range(4) if cost[s] < _FAR and rest[s] < _FAR)[2]


def hirschberg(codes: str, start: int, end: int) -> list[tuple[str, str]]:
    """Audit and fate of each row on the cheapest, audit-least way between two states."""
    out: list[tuple[str, str]] = []
    todo = [(0, len(codes), start, end)] if codes else []
    while todo:  # depth first, left halves before right ones
        lo, hi, s, e = todo.pop()
        if hi - lo == 1:
            out.append(_WAYS[ord(codes[lo]) - 97][s][e][1:])
            continue
        mid = (lo + hi) // 2
        m = _crossing(*_forward(codes[lo:mid], s), _backward(codes[mid:hi], e))
        todo += [(mid, hi, m, e), (lo, mid, s, m)]
    return out


def _legal(a: int, b: int) -> bool:
    return (a // 3, b // 3) in ((0, 1), (1, 2), (2, 1))


#: A block's or node's summary: 16 costs, 16 ranks, classes of its ends, illegal neighbours inside.
_WIDTH = 35


@lru_cache(1 << 14)
def _short(codes: str) -> tuple[int, ...]:
    tables = [_forward(codes, s) for s in range(4)]
    at = [ord(c) - 97 for c in codes]
    bad = sum(not _legal(a, b) for a, b in zip(at, at[1:]))
    return (*(c for t in tables for c in t[0]), *(r for t in tables for r in t[1]), at[0], at[-1], bad)


def _summary(codes: str) -> tuple[int, ...]:
    return _short(codes) if len(codes) <= 64 else _short.__wrapped__(codes)


def _step(cost: list[int], rank: list[int], node: np.ndarray) -> tuple[list[int], list[int]]:
    """A forward vector carried over a node's table."""
    best: list = [None] * 4
    for p in range(4):
        if cost[p] < _FAR:
            for t in range(4):
                if node[4 * p + t] < _FAR:
                    way = (cost[p] + int(node[4 * p + t]), rank[p], int(node[16 + 4 * p + t]))
                    if best[t] is None or way < best[t]:
                        best[t] = way
    order = sorted((b[1:], t) for t, b in enumerate(best) if b is not None)
    ranks = [0] * 4
    for r, (_, t) in enumerate(order):
        ranks[t] = r
    return [_FAR if b is None else b[0] for b in best], ranks


def _over(nodes: np.ndarray, state: int) -> tuple[list[int], list[int]]:
    cost, rank = [_FAR] * 4, [0] * 4
    cost[state] = 0
    for node in nodes:
        cost, rank = _step(cost, rank, node)
    return cost, rank


def _join(nodes: np.ndarray) -> list[int]:
    """The summary of several nodes in order."""
    tables = [_over(nodes, s) for s in range(4)]
    bad = int(nodes[:, 34].sum()) + sum(not _legal(int(a[33]), int(b[32])) for a, b in zip(nodes, nodes[1:]))
    return [*(c for t in tables for c in t[0]), *(r for t in tables for r in t[1]),
            int(nodes[0][32]), int(nodes[-1][33]), bad]


def _states(nodes: np.ndarray, start: int, end: int) -> list[int]:
    """Hirschberg over nodes: the states before each of them and after the last."""
    out = [start]
    todo = [(0, len(nodes), start, end)]
    while todo:
        lo, hi, s, e = todo.pop()
        if hi - lo == 1:
            out.append(e)
            continue
        mid = (lo + hi) // 2
        rest = [_FAR] * 4
        rest[e] = 0
        for node in nodes[mid:hi][::-1]:
            rest = [min(min(int(node[4 * p + t]) + rest[t] for t in range(4)), _FAR) for p in range(4)]
        m = _crossing(*_over(nodes[lo:mid], s), rest)
        todo += [(mid, hi, m, e), (lo, mid, s, m)]
    return out


@F.pandas_udf(T.ArrayType(T.LongType()))
def _summaries(codes: pd.Series) -> pd.Series:
    return pd.Series([np.array(_summary(c)) for c in codes])


@F.pandas_udf(T.ArrayType(T.LongType()))
def _joined(nodes: pd.Series) -> pd.Series:
    return pd.Series([np.array(_join(np.asarray(n).reshape(-1, _WIDTH))) for n in nodes])


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def _split(nodes: pd.Series, start: pd.Series, end: pd.Series) -> pd.Series:
    return pd.Series([np.array(_states(np.asarray(n).reshape(-1, _WIDTH), int(s), int(e)), "int32")
                      for n, s, e in zip(nodes, start, end)])


@F.pandas_udf(T.IntegerType())
def _end(node: pd.Series) -> pd.Series:
    """The state in which the cheapest, audit-least repair of a whole conversation ends."""
    rest = [INSERT * len(_TAIL[s]) for s in range(4)]
    return pd.Series([_crossing(list(map(int, n[:4])), list(map(int, n[16:20])), rest) for n in node],
                     dtype="int32")


@lru_cache(1 << 14)
def _path(codes: str, start: int, end: int) -> list[tuple[str, str]]:
    return hirschberg(codes, start, end)


@F.pandas_udf(T.StructType().add("audit", T.StringType()).add("fates", T.ArrayType(T.StringType())))
def _edits(codes: pd.Series, start: pd.Series, end: pd.Series) -> pd.DataFrame:
    got = [(_path if len(c) <= 64 else hirschberg)(c, int(s), int(e)) for c, s, e in zip(codes, start, end)]
    return pd.DataFrame({"audit": ["".join(a for a, _ in g) for g in got],
                         "fates": [[f for _, f in g] for g in got]})


class Repair:
    """The repair of a table of conversation rows.

    Rows are taken per conversation in ascending turn (nulls first), then role, then text. Null roles and
    texts count as one space; a null conversation id is a conversation of its own; a role that begins
    with none of s, u, a (the empty one too) cannot stay. Equal rows are repeats of the first. Other
    columns are ignored. An empty table gives empty results.

    ``conversations``: one row per conversation id with its faults, ``cost`` and ``audit``.
    ``rows()``: the repaired conversations, a row per message: ``conv_id, pos, sub, role, text``, in
    the order of ``pos, sub``.
    """

    def __init__(self, rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text", block: int = BLOCK, fan: int = FAN) -> None:
        self.block = block
        src = rows.select(
            F.col(conv).alias("conv_id"), key_of(conv).alias("ck"), F.col(turn).alias("turn"),
            F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("role"),
            F.coalesce(F.col(text).cast("string"), F.lit(" ")).alias("text"))
        # Cut to so many characters, role and text still ascend with the order and make small range bounds.
        deal = [F.col("ck"), F.col("turn").asc_nulls_first(), F.substring("role", 1, 16), F.substring("text", 1, 32)]
        order = [F.col("ck"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
        self.laid = lay_out(src, deal, order, "repair-rows")
        same = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
        firsts = (self.laid.groupBy("ck", F.unhex(same).alias("same")).agg(F.min("pos").alias("pos"))
                  .select("pos", F.lit(True).alias("first")))
        last = F.right(F.rtrim("text", F.lit(" \t\n\x0b\f\r")), F.lit(1))
        faults = (self.laid.select("ck", "conv_id", "turn", "role", "part", "pos", last.alias("last"))
                  .join(firsts, "pos", "left"))
        blank, repeat = F.col("last") == "", F.col("first").isNull()
        faults = (faults.withColumn("fault", F.when(blank, "b").when(repeat, "d")
                                    .when(~F.col("last").isin(".", "!", "?"), "t").otherwise(""))
                  .withColumn("code", row_class(F.col("role"), F.col("fault").isin("b", "d"), F.col("fault") == "t"))
                  .select("ck", "conv_id", "turn", "part", "pos", "fault", "code"))
        numbered = running(faults, ["ck"], F.lit(1), "idx").withColumn("block", F.expr(f"idx div {block}"))
        self.coded = materialize(numbered, "repair-codes")
        in_order = F.array_sort(F.collect_list(F.struct("idx", "code")))
        self.blocks = materialize(
            self.coded.groupBy("ck", "block").agg(F.array_join(F.transform(in_order, lambda x: x.code), "").alias("codes"))
            .withColumn("node", _summaries("codes")), "repair-blocks")
        self._tree(fan)

    def _tree(self, fan: int) -> None:
        most = self.blocks.agg(F.max("block")).first()[0] or 0
        levels, tops = [], self.blocks.select("ck", "block", "node")
        while most:  # up: one table per node
            below = tops.groupBy("ck", F.expr(f"block div {fan}").alias("above")).agg(
                F.array_sort(F.collect_list(F.struct("block", "node"))).alias("kids"))
            level = materialize(below.withColumn("nodes", F.flatten(F.transform("kids", lambda x: x.node)))
                                .withColumn("kids", F.transform("kids", lambda x: x.block))
                                .withColumn("node", _joined("nodes")), "repair-level")
            levels.append(level)
            tops = level.select("ck", F.col("above").alias("block"), "node")
            most //= fan
        self.roots = materialize(
            tops.withColumn("end", _end("node")).select("ck", "block", F.lit(0).alias("start"), "end", "node"),
            "repair-roots")
        spans = self.roots.select("ck", "block", "start", "end")
        for level in reversed(levels):  # down: one pair of states per node
            met = level.join(spans.withColumnRenamed("block", "above"), ["ck", "above"])
            met = met.withColumn("states", _split("nodes", "start", "end"))
            spans = (met.select("ck", "states", F.posexplode("kids").alias("at", "block"))
                     .select("ck", "block", F.col("states")[F.col("at")].alias("start"),
                             F.col("states")[F.col("at") + 1].alias("end")))
        self.edits = materialize(
            self.blocks.select("ck", "block", "codes").join(spans, ["ck", "block"])
            .withColumn("e", _edits("codes", "start", "end")).select("ck", "block", "e.audit", "e.fates"),
            "repair-edits")

    @property
    def _tails(self) -> Column:
        return F.element_at(F.array(*(F.lit(_TAIL[s]) for s in range(4))), F.col("end") + 1)

    @property
    def conversations(self) -> DataFrame:
        """``ck, conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit``; the audit of a
        conversation is one string with a character per edit."""
        def count(fault: str) -> Column:
            return F.sum((F.col("fault") == fault).cast("long"))

        counts = self.coded.groupBy("ck").agg(
            F.first("conv_id").alias("conv_id"), F.max("turn").alias("hi"), F.min("turn").alias("lo"),
            count("b").alias("blank"), count("d").alias("duplicate"), count("t").alias("truncated"))
        turns = (self.coded.where("turn is not null").groupBy("ck", "turn").agg(F.lit(1).alias("one"))
                 .groupBy("ck").agg(F.count("one").alias("turns")))
        audits = self.edits.groupBy("ck").agg(F.array_sort(F.collect_list(F.struct("block", "audit"))).alias("a"))
        spent = (F.element_at("node", (F.col("end") + 1).cast("int")) + INSERT * F.length(self._tails))
        ends = self.roots.select("ck", spent.cast("long").alias("cost"), F.element_at("node", _WIDTH).alias("illegal"),
                                 self._tails.alias("tail"))
        gaps = F.coalesce(F.col("hi") - F.col("lo") + 1 - F.col("turns"), F.lit(0)).cast("long")
        return (counts.join(ends, "ck").join(audits, "ck").join(turns, "ck", "left")
                .select("ck", "conv_id", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost",
                        F.concat(F.array_join(F.transform("a", lambda x: x.audit), ""), "tail").alias("audit")))

    def _repaired(self) -> DataFrame:
        fate = F.col("fates")[F.col("idx") - F.col("block") * self.block]
        fated = (self.coded.select("ck", "block", "idx", "pos").join(self.edits.drop("audit"), ["ck", "block"])
                 .select("pos", fate.alias("fate")))
        met = self.laid.select("ck", "conv_id", "pos", "role", "text").join(fated, "pos")
        # The characters of a fate: inserted roles, then what becomes of the row.
        def message(x: Column) -> Column:
            role = (F.when(x == "K", F.col("role")).when(F.lower(x) == "u", F.lit(_NAMES["u"]))
                    .otherwise(F.lit(_NAMES["a"])))
            return F.struct(role.alias("role"), F.when(x.isin(*_NAMES), F.lit("")).otherwise(F.col("text")).alias("text"))

        messages = F.transform(F.split(F.regexp_replace("fate", "D", ""), ""), message)
        out = (met.where("fate != 'D'").select("ck", "conv_id", "pos", F.posexplode(messages).alias("sub", "m"))
               .select("ck", "conv_id", "pos", "sub", "m.role", "m.text"))
        tail = F.when(F.col("end") == _USER, F.array(F.lit("assistant"))).otherwise(F.array(F.lit("user"), F.lit("assistant")))
        ids = self.coded.groupBy("ck").agg(F.first("conv_id").alias("conv_id"))
        added = (self.roots.where(F.col("end").isin(_SYSTEM, _USER)).join(ids, "ck")
                 .select("ck", "conv_id", F.lit(2 ** 62).alias("pos"), F.posexplode(tail).alias("sub", "role"))
                 .withColumn("text", F.lit("")))
        return out.unionByName(added)

    def rows(self) -> DataFrame:
        return self._repaired().drop("ck")

    def digests(self) -> DataFrame:
        """``ck, repaired_sha256`` of ``role:text`` lines joined by newlines, for conversations that keep
        a message. SHA-256 has to read a conversation in order: its rows stream through one task, which
        holds one batch of them and the running state, never the whole conversation."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            key, state = None, None
            for batch in batches:
                out = []
                for ck, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                    if ck != key:
                        if state is not None:
                            out.append((key, state.hexdigest()))
                        key, state = ck, hashlib.sha256()
                    else:
                        state.update(b"\n")
                    state.update(f"{role}:{text}".encode("utf-8", "surrogatepass"))
                yield _pairs(out)
            if state is not None:
                yield _pairs([(key, state.hexdigest())])

        ordered = (self._repaired().repartition("ck").sortWithinPartitions("ck", "pos", "sub")
                   .select("ck", "role", "text"))
        return ordered.mapInArrow(run, "ck string, repaired_sha256 string")


def _pairs(rows: list[tuple[str, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string())],
        ["ck", "repaired_sha256"])


def damage(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text") -> DataFrame:
    """``conv_id, turn, role, text`` with planted faults, by crc32 of ``conv_id:turn`` (nulls: one space)
    modulo 20: 0 drops a row, 1 empties its text, 2 removes ``. ! ?``, 3 repeats it, 4 makes it a user's."""
    def given(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.encode(F.concat(given(conv), F.lit(":"), given(turn)), "UTF-8")) % 20
    src = rows.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), given(role).alias("role"),
                      given(text).alias("text"), kind.alias("kind")).where("kind != 0")
    told = (F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
            .otherwise(F.col("text")))
    times = F.when(F.col("kind") == 3, 2).otherwise(1)
    return (src.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                       told.alias("text"), F.explode(F.sequence(F.lit(1), times)).alias("copy")).drop("copy"))


def repair_damaged(rows: DataFrame, conv: str = "conv_id") -> DataFrame:
    """One row per conversation id of ``rows`` after ``damage`` and repair: ``conv_id, gaps, blank,
    duplicate, truncated, illegal, cost, audit, repaired_sha256``. A conversation that lost all rows
    has zeros, an empty audit and the digest of the empty text."""
    fixed = Repair(damage(rows, conv))
    ids = rows.groupBy(F.col(conv).alias("conv_id")).agg(F.lit(1).alias("one")).select("conv_id", key_of("conv_id").alias("ck"))
    empty = hashlib.sha256(b"").hexdigest()
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return (ids.join(fixed.conversations.drop("conv_id"), "ck", "left").join(fixed.digests(), "ck", "left")
            .select("conv_id", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts),
                    F.coalesce("audit", F.lit("")).alias("audit"),
                    F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256")))


#: DuckDB: the same by one dynamic programme per conversation, row by row, with whole audits carried along.
ORACLE = r"""
with recursive
tab as (select list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
        lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as t),
keyed as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
        coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as k from conversations),
crc as (select keyed.*, xor(list_reduce(list_concat([4294967295::bigint],
        list_transform(string_split(k, ''), lambda x: ascii(x)::bigint)),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 as kind from keyed, tab),
hurt as (select conv_id, turn, case when kind = 4 then 'user' else role end as role,
        case when kind = 1 then '' when kind = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text
        from crc, range(case when kind = 3 then 2 else 1 end) where kind <> 0),
numbered as (select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as i from hurt),
placed as (select *, row_number() over (partition by conv_id, role, text order by i) as copy,
        lag(left(role, 1)) over (partition by conv_id order by i) as prev,
        regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) as last from numbered),
faults as (select *, case when last = '' then 'b' when copy > 1 then 'd'
        when last not in ('.', '!', '?') then 't' else '' end as fault from placed),
ins(p, q, n, added) as (values (0, 0, 0, []::varchar[]), (1, 1, 0, []), (2, 2, 0, []), (3, 3, 0, []),
        (0, 2, 1, ['user:']), (1, 2, 1, ['user:']), (3, 2, 1, ['user:']), (2, 3, 1, ['assistant:']),
        (0, 3, 2, ['user:', 'assistant:']), (1, 3, 2, ['user:', 'assistant:'])),
moves(q, initial, t) as (values (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (3, 'u', 2), (2, 'a', 3)),
turned(q, t, role) as (values (0, 2, 'user'), (1, 2, 'user'), (3, 2, 'user'), (2, 3, 'assistant')),
deals as (
  select conv_id, i, p, q as t, 5 * n + 2 as cost, repeat('I', n) || 'D' as audit, added as said from faults, ins
  union all
  select conv_id, i, p, t, 5 * n + case when fault = 't' then 5 else 0 end, repeat('I', n) || 'K',
         list_append(added, role || ':' || text)
  from faults join moves on left(role, 1) = initial join ins using (q) where fault not in ('b', 'd')
  union all
  select conv_id, i, p, t, 5 * n + 1 + case when fault = 't' then 5 else 0 end, repeat('I', n) || 'R',
         list_append(added, turned.role || ':' || text)
  from faults, turned join ins using (q) where fault not in ('b', 'd')),
best as (select conv_id, i, p, t, min({'cost': cost, 'audit': audit, 'said': said}) as w from deals group by all),
walk as (
  select conv_id, 0::bigint as i, 0 as t, {'cost': 0::bigint, 'audit': '', 'said': []::varchar[]} as w
  from (select distinct conv_id from faults)
  union all
  select conv_id, i, t, w from (
    select walk.conv_id, best.i, best.t, min({'cost': (walk.w.cost + best.w.cost)::bigint,
           'audit': walk.w.audit || best.w.audit, 'said': list_concat(walk.w.said, best.w.said)}) as w
    from walk join best on walk.conv_id is not distinct from best.conv_id and best.i = walk.i + 1 and best.p = walk.t
    group by all)),
ends(t, n, added) as (values (0, 0, []::varchar[]), (3, 0, []), (2, 1, ['assistant:']), (1, 2, ['user:', 'assistant:'])),
sizes as (select conv_id, max(i) as i, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
        count(*) filter (fault = 'b') as blank, count(*) filter (fault = 'd') as duplicate,
        count(*) filter (fault = 't') as truncated,
        count(*) filter (i > 1 and prev || left(role, 1) not in ('su', 'ua', 'au')) as illegal
        from faults group by conv_id),
fixed as (select sizes.conv_id, any_value(sizes) as s,
        min({'cost': walk.w.cost + 5 * n, 'audit': walk.w.audit || repeat('I', n),
             'said': list_concat(walk.w.said, added)}) as w
        from sizes join walk on walk.conv_id is not distinct from sizes.conv_id and walk.i = sizes.i
        join ends using (t) group by sizes.conv_id)
select o.conv_id, coalesce(s.gaps, 0)::bigint as gaps, coalesce(s.blank, 0)::bigint as blank,
       coalesce(s.duplicate, 0)::bigint as duplicate, coalesce(s.truncated, 0)::bigint as truncated,
       coalesce(s.illegal, 0)::bigint as illegal, coalesce(w.cost, 0)::bigint as cost,
       coalesce(w.audit, '') as audit,
       sha256(coalesce(array_to_string(w.said, chr(10)), '')) as repaired_sha256
from (select distinct conv_id from conversations) o
left join fixed on fixed.conv_id is not distinct from o.conv_id
"""
