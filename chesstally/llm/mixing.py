"""Mixing sources to target weights.

1. Targets: sources in the order of their names get weights in turn and share a multiple of all
   words; a target stops at a multiple of its source's words, and the excess goes to the others by
   weight, until none is above.
2. Packing: each source's documents, in the order of their ids, are one row of words, cut into blocks of
   fixed length. Only the last block of a source is shorter.
3. Drawing: output shards have a fixed number of slots; the slots of a shard go to sources by one
   multinomial draw with the targets as probabilities, seeded by the shard.
4. The i-th slot of a source takes the block at place i of a pseudorandom permutation of its blocks; when
   all blocks have been used, another permutation follows. A permutation is a Feistel network with
   cycle walking, evaluated per slot, so none is stored. Slots and blocks meet by an equi-join on
   source and block.

A multinomial draw leaves each source some slots above or below its share. Slots above go to the sources
that are below, in order (both are numbered by running sums and joined by number), and the last slot of
a source takes only the words that are missing, so every source contributes its target rounded to
words, and a block is used at most ``stop`` times.

Draws, permutations and order depend on the documents and ``seed`` alone, not on partitions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chesstally.llm.common import materialize, text_of
from chesstally.llm.ordered import key_of, lay_out, running

WEIGHTS = (3, 1, 2)
SHARE = 1.5
STOP = 2
BLOCK_WORDS = 1024
SHARD_SLOTS = 16384
#: Sources drawn by one multinomial; more are drawn group by group, then within each group.
GROUP = 4096
SEED = 11

_WORD = r"[^\x20\x09-\x0D]+"
_MASK = np.uint64(0xFFFFFFFFFFFFFFFF)


def words_of(text: str | Column) -> Column:
    return F.regexp_extract_all(text_of(text), F.lit(_WORD), F.lit(0))


def _mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the result depends on every bit of x."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


_ROUNDS = 4


def permute(at: np.ndarray, n: np.ndarray, key: np.ndarray, back: bool = False) -> np.ndarray:
    """Place of ``at`` (0 to n-1) under the permutation of ``n`` places that ``key`` selects, or, with
    ``back``, the place that is mapped to it."""
    at, n, key = (np.asarray(x).astype(t) for x, t in ((at, "u8"), (n, "u8"), (key, "i8")))
    key = key.view("u8")
    bits = np.ceil(np.log2(np.maximum(n, 2).astype("f8"))).astype("u8")
    half = np.maximum((bits + np.uint64(1)) >> np.uint64(1), np.uint64(1))
    low = (np.uint64(1) << half) - np.uint64(1)

    def network(x: np.ndarray, rows: np.ndarray) -> np.ndarray:
        h, m, k = half[rows], low[rows], key[rows]
        a, b = x >> h, x & m
        for r in reversed(range(_ROUNDS)) if back else range(_ROUNDS):
            salt = k + np.uint64(r) * np.uint64(0x9E3779B97F4A7C15)
            if back:
                a, b = b ^ (_mix64(a ^ salt) & m), a
            else:
                a, b = b, a ^ (_mix64(b ^ salt) & m)
        return (a << h) | b

    with np.errstate(over="ignore"):
        out = at.copy()
        todo = np.flatnonzero(n > 1)
        while len(todo):  # places beyond n are walked through
            out[todo] = network(out[todo], todo)
            todo = todo[out[todo] >= n[todo]]
    return out.astype("i8")


@F.pandas_udf(T.LongType())
def _permuted(at: pd.Series, n: pd.Series, key: pd.Series) -> pd.Series:
    return pd.Series(permute(at.to_numpy(), n.to_numpy(), key.to_numpy()))


def _key(name: Column, epoch: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), name, epoch)


def with_targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, stop: float = STOP) -> DataFrame:
    """Sources ``(place, words)``, ``place`` from 0, with ``weight`` and ``target``. The level up to which
    open sources are filled rises with each round in which further ones stop; a round is one sum."""
    turn = F.lit(0)
    for i, w in enumerate(weights):
        turn = F.when(F.col("place") % len(weights) == i, float(w)).otherwise(turn)
    src = sources.withColumn("weight", turn.cast("double"))
    most = F.col("words") * float(stop)
    total, all_weights = src.agg(F.sum("words"), F.sum("weight")).first()
    total = share * (total or 0)
    level, closed = total / (all_weights or 1.0), -1
    while True:
        full = most <= F.col("weight") * level
        n, held, open_ = src.agg(F.sum(full.cast("long")), F.sum(F.when(full, most)),
                                 F.sum(F.when(~full, F.col("weight")))).first()
        if n == closed or not open_:
            break
        level, closed = (total - (held or 0.0)) / open_, n
    return src.withColumn("target", F.when(F.col("weight") * level >= most, most).otherwise(F.col("weight") * level)
                          if total else F.lit(0.0))


def _slots_needed(block: int, seed: int):
    """Slots that a source needs for its words, and the words that the last of them takes."""

    @F.pandas_udf(T.StructType().add("slots", T.LongType()).add("cut", T.LongType()))
    def needed(want: pd.Series, words: pd.Series, name: pd.Series) -> pd.DataFrame:
        # ``name`` holds the permutation keys of the epochs that the words can reach.
        want, words = want.to_numpy("i8"), words.to_numpy("i8")
        blocks = -(-words // block)
        epoch = np.where(words > 0, (want - 1) // np.maximum(words, 1), 0)
        epoch = np.where(want > 0, epoch, 0)
        left = want - epoch * words
        short = blocks * block - words  # what the last block lacks
        keys = np.array([k[e] for k, e in zip(name, epoch)], "i8")
        place = permute(np.maximum(blocks - 1, 0), np.maximum(blocks, 1), keys, back=True)
        slots = -(-left // block)
        reached = slots * block - np.where(place < slots, short, 0)
        slots = slots + (reached < left)
        before = (slots - 1) * block - np.where(place < slots - 1, short, 0)
        return pd.DataFrame({"slots": epoch * blocks + slots, "cut": np.where(want > 0, left - before, 0)})

    return needed


def _draws(spark, shards: int, slots: int, total: int, groups: list[tuple[int, int]], seed: int) -> DataFrame:
    """``shard, grp, n``: slots of each shard per group of sources."""
    share = np.array([s for _, s in groups], "f8")
    share /= share.sum()
    ids = np.array([g for g, _ in groups])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for shard in frame["id"]:
                n = min(slots, total - int(shard) * slots)
                drawn = np.random.Generator(np.random.PCG64([seed, int(shard)])).multinomial(n, share)
                yield pd.DataFrame({"shard": shard, "grp": ids, "n": drawn})[drawn > 0]

    return spark.range(shards).mapInPandas(run, "shard long, grp long, n long")


def _drawn_within(seed: int):
    @F.pandas_udf(T.ArrayType(T.LongType()))
    def draw(shard: pd.Series, grp: pd.Series, n: pd.Series, needs: pd.Series) -> pd.Series:
        out = []
        for s, g, k, m in zip(shard, grp, n, needs):
            m = np.asarray(m, "f8")
            out.append(np.random.Generator(np.random.PCG64([seed, int(s), int(g) + 1])).multinomial(k, m / m.sum()))
        return pd.Series(out)

    return draw


class Mix:
    """The mix of a table of documents.

    A null text is the empty one; documents without words take part in nothing. Null ids come first
    in a source's order, a null source is a source of its own, the last; equal rows are documents of
    their own. Other columns are ignored. Without words, all targets are 0 and there are no slots.

    ``placed``: a row per document with ``source_size``, ``target`` and its first word's place in its
    source. ``slots``: ``shard, slot, sk, block, words`` of the mix.
    """

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                 weights=WEIGHTS, share: float = SHARE, stop: int = STOP, block: int = BLOCK_WORDS,
                 shard_slots: int = SHARD_SLOTS, seed: int = SEED, texts: bool = False) -> None:
        self.block = block
        src = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                          key_of(source_col).alias("sk"), F.xxhash64(text_of(text_col)).alias("h"),
                          *([text_of(text_col).alias("text")] if texts else []),
                          F.size(words_of(text_col)).cast("long").alias("size"))
        order = [F.col("sk"), F.col("doc_id").asc_nulls_first(), F.col("h")]
        self.laid = lay_out(src, order, order, "mix-docs")
        names = self.laid.groupBy("sk").agg(F.sum("size").alias("words"))
        names = lay_out(names, [F.col("sk")], [F.col("sk")], "mix-sources")
        names = running(names, [], F.lit(1), "place")
        names = materialize(with_targets(names, weights, share, stop), "mix-targets")
        want = F.floor(F.col("target") + 0.5).cast("long")
        keys = F.array(*(_key(F.col("sk"), F.lit(e), seed) for e in range(int(np.ceil(stop)))))
        need = _slots_needed(block, seed)(want, F.col("words"), keys)
        self.sources = materialize(
            names.withColumn("need", need).select(
                "part", "pos", "place", "sk", "words", "target", F.ceil(F.col("words") / block).alias("blocks"),
                F.col("need.slots").alias("slots"), F.col("need.cut").alias("cut")), "mix-needs")
        self.placed = running(self.laid, ["sk"], F.col("size"), "start",
                              self.sources.select("sk", F.col("words").alias("source_size"), "target"))
        self.slots = self._slots(shard_slots, seed)

    def _slots(self, shard_slots: int, seed: int) -> DataFrame:
        spark, src = self.laid.sparkSession, self.sources
        total = src.agg(F.sum("slots")).first()[0] or 0
        schema = "shard long, slot long, sk string, block long, words long"
        if not total:
            return spark.createDataFrame([], schema)
        grp = F.expr(f"place div {GROUP}")
        groups = src.groupBy(grp.alias("grp")).agg(
            F.sum("slots").alias("all"), F.array_sort(F.collect_list(F.struct("place", "slots"))).alias("in"))
        shares = [(r["grp"], r["all"]) for r in groups.where("all > 0").select("grp", "all").orderBy("grp").toLocalIterator()]
        drawn = _draws(spark, -(-total // shard_slots), shard_slots, total, shares, seed)
        counts = (drawn.join(groups, "grp")
                  .withColumn("ns", _drawn_within(seed)("shard", "grp", "n", F.transform("in", lambda x: x.slots)))
                  .select("shard", F.explode(F.arrays_zip(F.transform("in", lambda x: x.place).alias("place"),
                                                          F.col("ns").alias("n"))).alias("x"))
                  .select("shard", "x.place", "x.n").where("n > 0"))
        counts = materialize(counts, "mix-counts")
        # Slots above a source's need, and those missing below it, each numbered over all sources.
        drawn_all = counts.groupBy("place").agg(F.sum("n").alias("drawn"))
        src = materialize(src.join(drawn_all, "place", "left").withColumn("drawn", F.coalesce("drawn", F.lit(0))), "mix-drawn")
        src = running(src, [], F.greatest(F.col("drawn") - F.col("slots"), F.lit(0)), "over")
        src = running(src, [], F.greatest(F.col("slots") - F.col("drawn"), F.lit(0)), "under")
        src = materialize(src.select("place", "sk", "words", "blocks", "slots", "cut", "drawn", "over", "under"), "mix-sums")
        facts = ["sk", "words", "blocks", "slots", "cut"]
        before = Window.partitionBy("place").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
        here = Window.partitionBy("shard").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
        spread = (counts.join(src.drop("under", "drawn"), "place")
                  .withColumn("at", F.coalesce(F.sum("n").over(before), F.lit(0)))
                  .withColumn("low", F.coalesce(F.sum("n").over(here), F.lit(0)))
                  .withColumn("all", F.sum("n").over(Window.partitionBy("shard")))
                  .withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1))))
        spread = spread.select(
            "shard", _permuted(F.col("low") + F.col("i"), F.col("all"), F.xxhash64(F.lit(seed), F.col("shard"))).alias("slot"),
            *facts, "over", (F.col("at") + F.col("i")).alias("turn"))
        own = spread.where("turn < slots").select("shard", "slot", *facts, "turn")
        spare = spread.where("turn >= slots").select("shard", "slot", (F.col("over") + F.col("turn") - F.col("slots")).alias("no"))
        missing = (src.where("slots > drawn").withColumn("turn", F.explode(F.sequence(F.col("drawn"), F.col("slots") - 1)))
                   .select(*facts, "turn", (F.col("under") + F.col("turn") - F.col("drawn")).alias("no")))
        both = own.unionByName(spare.join(missing, "no").drop("no"))
        block = _permuted(F.expr("turn % blocks"), F.col("blocks"), _key(F.col("sk"), F.expr("cast(turn div blocks as int)"), seed))
        full = F.when(F.col("block") == F.col("blocks") - 1, F.col("words") - F.col("block") * self.block).otherwise(self.block)
        return materialize(
            both.withColumn("block", block)
            .withColumn("n", F.when(F.col("turn") == F.col("slots") - 1, F.col("cut")).otherwise(full).cast("long"))
            .select("shard", "slot", "sk", "block", F.col("n").alias("words")), "mix-slots")

    def _pieces(self, text: bool) -> DataFrame:
        """Documents' parts per block: places ``lo`` to ``hi`` in the block."""
        n, b = F.col("size"), self.block

        def piece(at: Column) -> Column:
            lo = F.greatest(F.col("start") - at * b, F.lit(0)).cast("long")
            hi = F.least(F.col("start") + n - at * b, F.lit(b)).cast("long")
            said = [F.array_join(F.slice("ws", (at * b + lo - F.col("start") + 1).cast("int"), (hi - lo).cast("int")), " ")
                    .alias("said")] if text else []
            return F.struct(at.alias("block"), lo.alias("lo"), hi.alias("hi"), *said)

        spans = F.transform(F.sequence(F.expr(f"start div {b}"), F.expr(f"(start + size - 1) div {b}")), piece)
        docs = self.placed.withColumn("ws", words_of("text")) if text else self.placed
        return (docs.withColumn("p", F.explode_outer(F.when(n > 0, spans)))
                .select("pos", "doc_id", "source", "sk", "size", "source_size", "target", "p.*"))

    def taken(self) -> DataFrame:
        """``doc_id, size, source_size, target, taken``: a row per document; ``taken`` counts the words that
        the mix takes from it, repeats counted."""
        uses = self.slots.groupBy("sk", "block").agg(F.collect_list("words").alias("uses"))  # at most ``stop``
        part = F.aggregate(F.coalesce("uses", F.array().cast("array<bigint>")), F.lit(0).cast("long"),
                           lambda n, u: n + F.greatest(F.least(F.col("hi"), u) - F.col("lo"), F.lit(0)))
        return (self._pieces(False).join(uses, ["sk", "block"], "left").withColumn("part", part)
                .groupBy("pos", "doc_id", "size", "source_size", "target").agg(F.sum("part").alias("taken"))
                .select("doc_id", "size", "source_size", "target", "taken"))

    def texts(self) -> DataFrame:
        """``shard, slot, source, block, words, text``: the mix itself (needs ``texts=True``)."""
        blocks = (self._pieces(True).where("block is not null").groupBy("sk", "block")
                  .agg(F.first("source").alias("source"), F.array_sort(F.collect_list(F.struct("lo", "said"))).alias("p"))
                  .select("sk", "block", "source", F.flatten(F.transform("p", lambda x: F.split(x.said, " "))).alias("ws")))
        return (self.slots.join(blocks, ["sk", "block"])
                .select("shard", "slot", "source", "block", "words",
                        F.array_join(F.slice("ws", F.lit(1), F.col("words").cast("int")), " ").alias("text")))
