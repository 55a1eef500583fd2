"""SimHash near-duplicates by multi-index hashing.

A fingerprint is cut into segments. Two fingerprints at ``max_bits`` or fewer differing bits agree,
in at least one segment, up to ``max_bits // segments`` bits (pigeonhole), so each fingerprint
enumerates the small Hamming ball around each of its segments, looks the ball's values up in the
table of segment values, and verifies the complete distance of what it finds.

Only distinct fingerprints take part, so a group of exact copies is one entry, whatever its size.
A segment value held by one fingerprint is verified in the lookup itself. Where several
fingerprints share a segment value, the remaining bits are cut again (pigeonhole once more) and the
members of each sub-bucket are linked inside a task, which emits a spanning forest and not the
pairs: the number of links stays linear in the number of members, and components are the same. Where
very many share a value (``DENSE``), the remaining bits are cut into twice ``max_bits`` pieces, of which any
linked pair agrees in half, so that sub-buckets have twice as many bits in common.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chesstally.llm.common import fresh, materialize, slices, text_of
from chesstally.llm.graph import connected_components

BITS = 64
DENSE = 4096  # fingerprints that share a segment value
_ROWS = 1 << 16  # shingles whose bits are unpacked at a time


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64-bit SimHash over word shingles, as a signed integer; 0 for a text without words."""
    words = (text or "").encode().lower().split()  # bytes: A-Z only, and \x20 \x09-\x0D only
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) < shingle:
        hashes = [digest(joined, 42)]
    else:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths + 1) - 1
        first = (ends - lengths)[: len(words) - shingle + 1].tolist()
        hashes = [digest(joined[a:b], 42) for a, b in zip(first, ends[shingle - 1:].tolist())]
    raw = np.array(hashes, dtype=">u8").view(np.uint8).reshape(-1, 8)
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(raw), _ROWS):
        counts += np.unpackbits(raw[at:at + _ROWS], axis=1).sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes)).view(">i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = 3) -> DataFrame:
    """``(doc_id, th, fp)`` for every row, ``th`` a hash of the text; a null text is the empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(
                    [fingerprint(t, shingle) for t in part.column(2).to_pylist()], pa.int64())],
                ["doc_id", "th", "fp"])

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_of(text_col)).alias("th"),
                        F.col(text_col).alias("text"))
            .mapInArrow(run, "doc_id long, th long, fp long"))


def _balls(width: int, radius: int) -> list[int]:
    """Masks of up to ``radius`` bits out of ``width``."""
    return [sum(1 << b for b in bits) for r in range(radius + 1)
            for bits in combinations(range(width), r)]


def _star(values: np.ndarray, home: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Spanning forest of the members of a bucket: links need at least one home member."""
    links, left = [], np.arange(len(values))
    while len(left):
        root, queue, left = int(left[0]), [int(left[0])], left[1:]
        while queue and len(left):
            x = queue.pop()
            near = np.bitwise_count(values[left] ^ values[x]) <= max_bits
            if not home[x]:
                near &= home[left]
            found = left[near]
            if len(found):
                left = left[~near]
                queue += found.tolist()
                links += [(root, int(y)) for y in found]
    return links


def _halves(width: int, max_bits: int) -> list[int]:
    """Masks of ``width`` bits, one of which covers nothing but bits in which two values agree that differ in
    ``max_bits`` or fewer: any half of twice so many pieces."""
    n = 2 * max_bits
    ends = [width * i // max(1, n) for i in range(n + 1)]
    parts = [(1 << b) - (1 << a) for a, b in zip(ends, ends[1:])] or [(1 << width) - 1]
    return [sum(c) for c in combinations(parts, max(1, max_bits))]


def hamming_links(fps: DataFrame, max_bits: int = 3, segments: int = 2, dense: int = DENSE) -> DataFrame:
    """``fps(fp)`` of distinct values -> ``(u, v)`` links whose components are those of all pairs at
    ``max_bits`` or fewer differing bits."""
    width, radius = BITS // segments, max_bits // segments
    mask = (1 << width) - 1
    cuts = max_bits + 1  # the rest of two linked fingerprints agrees in one of so many pieces

    def signed(x: int) -> int:
        return x - (1 << BITS) if x >= 1 << (BITS - 1) else x

    def segment(s: int):
        return F.shiftrightunsigned("fp", s * width).bitwiseAND(F.lit(signed(mask)))

    keys = fps.select("fp", F.inline(F.array(*[
        F.struct(F.lit(s).alias("seg"), segment(s).alias("key")) for s in range(segments)])))
    held = keys.groupBy("seg", "key").agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("one"))
    balls = F.array(*[F.lit(m).cast("long") for m in _balls(width, radius)])
    probes = (keys.select("fp", "seg", F.col("key").alias("own"), F.explode(balls).alias("flip"))
              .select("fp", "seg", F.col("own").bitwiseXOR(F.col("flip")).alias("key"),
                      (F.col("flip") == 0).alias("home")))
    # Hits in the table; a fingerprint that meets only itself goes. Spark sizes exploded rows as if there were one
    # of each, and would broadcast dozens of probes per fingerprint: both sides are sorted and merged instead.
    hits = materialize(probes.hint("merge").join(held, ["seg", "key"]).where("n > 1 or fp != one"), "simhash-hits")
    single = (hits.where("n = 1")
              .where(F.bit_count(F.col("fp").bitwiseXOR(F.col("one"))) <= max_bits)
              .select(F.col("one").alias("u"), F.col("fp").alias("v")))

    step = -(-(BITS - width) // cuts)

    def rest(s: int):  # the fingerprint without segment s
        low = F.col("fp").bitwiseAND(F.lit(signed((1 << (s * width)) - 1)))
        if s == segments - 1:
            return low
        return F.shiftleft(F.shiftrightunsigned("fp", (s + 1) * width), s * width).bitwiseOR(low)

    def pieces(s: int):
        return F.array(*[F.struct(F.lit(c).alias("part"),
                                  F.shiftrightunsigned(rest(s), c * step)
                                  .bitwiseAND(F.lit((1 << step) - 1)).alias("piece"))
                         for c in range(cuts)])

    def halves(s: int):
        return F.array(*[F.struct(F.lit(cuts + i).alias("part"), rest(s).bitwiseAND(F.lit(signed(m))).alias("piece"))
                         for i, m in enumerate(_halves(BITS - width, max_bits))])

    def of_segment(made):
        out = made(segments - 1)
        for s in range(segments - 1):
            out = F.when(F.col("seg") == s, made(s)).otherwise(out)
        return out

    # Members of a segment value see the same number, so all are cut in the same way.
    cut = F.when(F.col("n") > dense, of_segment(halves)).otherwise(of_segment(pieces))
    bucket = ["seg", "key", "part", "piece"]

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(key, rows):
            values = np.array([r[0] for r in rows], np.int64).view(np.uint64)
            home = np.array([r[1] for r in rows], bool)
            if len(values) < 2 or not home.any():
                return [], []
            pairs = _star(values, home, max_bits)
            got = values.view(np.int64)
            return [int(got[a]) for a, _ in pairs], [int(got[b]) for _, b in pairs]

        key, rows = None, []
        us: list[int] = []
        vs: list[int] = []
        for part in slices(batches, 1 << 16):
            cols = [part.column(i).to_pylist() for i in range(6)]
            for *k, fp, home in zip(*cols):
                if k != key:
                    if len(rows) > 1:
                        u, v = done(key, rows)
                        us += u
                        vs += v
                    key, rows = k, []
                rows.append((fp, home))
            if us:
                yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())],
                                                 ["u", "v"])
                us, vs = [], []
        if len(rows) > 1:
            us, vs = done(key, rows)
            yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())],
                                             ["u", "v"])

    several = (hits.where("n > 1").select("seg", "key", "fp", "home", F.inline(cut))
               .select(*bucket, "fp", "home")
               .repartition(*[F.col(c) for c in bucket])
               .sortWithinPartitions(*bucket).mapInArrow(link, "u long, v long"))
    return single.union(several)


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """Near-duplicate groups: ``doc_id, fingerprint`` (16 hex digits), ``component_id`` (the smallest
    doc_id that can be reached over links of ``max_bits`` or fewer differing bits).

    One row per input row. A null or blank text has fingerprint zero and links like any other;
    repeated rows are copies of each other; a null doc_id is never a component's id unless the
    component has no other (then the id is null); other columns are ignored; an empty table gives
    an empty result.
    """
    fps, of = _components(docs, id_col, text_col, shingle, max_bits)
    ids = of.groupBy("component").agg(F.min("id").alias("component_id"))
    named = materialize(of.join(ids, "component").select("fp", "component_id"), "simhash-components")
    return fps.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _components(docs: DataFrame, id_col: str, text_col: str, shingle: int,
                max_bits: int) -> tuple[DataFrame, DataFrame]:
    """Rows as ``doc_id, th, fp``, and per fingerprint ``fp, id`` (its least doc_id), ``component``."""
    fps = materialize(fingerprints(docs, id_col, text_col, shingle), "simhash-fp")
    distinct = materialize(fps.select("fp").distinct(), "simhash-distinct")
    comps = connected_components(hamming_links(distinct, max_bits))
    # Components over fingerprints first; the ids enter as one minimum per fingerprint.
    least = fps.groupBy("fp").agg(F.min("doc_id").alias("id"))
    return fps, (least.join(comps.withColumnRenamed("node", "fp"), "fp", "left")
                 .select("fp", "id", F.coalesce("component", "fp").alias("component")))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
             max_bits: int = 3) -> DataFrame:
    """One document of each near-duplicate group: the one with the smallest doc_id, of several texts under
    that id in the group the one with the least fingerprint. Rows that share an id but not a group are
    documents of their own; equal rows are one. Rows without a doc_id all stay, since no group can
    name them."""
    fps, of = _components(docs, id_col, text_col, shingle, max_bits)
    fps = fps.where("doc_id is not null")
    first = (fps.groupBy("fp").agg(F.min(F.struct("doc_id", "fp", "th")).alias("first"))  # of each fingerprint
             .join(of.select("fp", "component"), "fp").groupBy("component").agg(F.min("first").alias("first")))
    i, t = fresh(docs, "kept_id"), fresh(docs, "kept_text")
    keep = materialize(first.select(F.col("first.doc_id").alias(i), F.col("first.th").alias(t)), "simhash-keep")
    keyed = docs.withColumn(i, F.col(id_col).cast("long")).withColumn(t, F.xxhash64(text_of(text_col)))
    kept = keyed.join(keep, [i, t], "left_semi")
    again = (fps.join(keep.toDF("doc_id", "th"), ["doc_id", "th"], "left_semi").groupBy("doc_id", "th")
             .agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count())
    if again:
        kept = kept.dropDuplicates([i, t])
    return kept.select(*docs.columns).unionByName(docs.where(F.col(id_col).isNull()))
