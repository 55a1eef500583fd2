"""Document fingerprints by one-permutation MinHash, in DataFrame functions only.

Every word shingle is hashed once; the hash's low bits name a bin and its high bits are the value.
Each bin keeps its least value. Empty bins borrow from other bins by optimal densification: bin
``i`` walks a pseudo-random order of all bins that is its own and takes the first filled one. Of each
bin's value the low ``B_BITS`` bits are packed into the fingerprint. Two fingerprints agree in a bin
with probability ``J + (1 - J) / 2**B_BITS`` for a resemblance ``J``; ``likeness`` solves for ``J``.

All steps are array functions over one row: the shingles of a document never leave their row, and
nothing is shuffled.
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chesstally.llm.common import text_of

SHINGLE = 5
BINS = 128
B_BITS = 8
_EMPTY = 1 << 31  # above every value: a bin's placeholder
_SPACES = "[ \t\n\x0b\f\r]+"
_NEAR = 12  # steps of a bin's walk that are tried one by one before all bins are searched


def _bind(value: Column, body) -> Column:
    """``body`` of a value that is computed once: higher-order functions name it as an element."""
    return F.transform(F.array(value), body)[0]


def _walks(bins: int) -> list[tuple[int, int]]:
    """Start and odd stride of each bin's walk; with a power of two of bins it visits every bin."""
    rng = random.Random(20250101)
    return [(rng.randrange(bins), 2 * rng.randrange(bins // 2) + 1) for _ in range(bins)]


def shingle_hashes(text: Column, shingle: int = SHINGLE) -> Column:
    """64-bit hashes of the word shingles (lower case, ASCII white space); a text of fewer words has
    one shingle of all its words, a text without words none."""
    words = F.filter(F.split(F.lower(text), _SPACES), lambda w: w != "")
    return _bind(words, lambda w: F.when(F.size(w) == 0, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - shingle + 1, F.lit(1))),
                    lambda i: F.xxhash64(F.slice(w, i, shingle)))))


def bins_of(hashes: Column, bins: int = BINS) -> Column:
    """Least 31-bit value of every bin, in bin order; null where a bin is empty."""
    keyed = F.transform(hashes, lambda h: F.shiftleft(h.bitwiseAND(F.lit(bins - 1)), 32)
                        .bitwiseOR(F.shiftrightunsigned(h, 33)))
    marks = F.array(*[F.lit((i << 32) | _EMPTY).cast("long") for i in range(bins)])
    # Sorted with one placeholder per bin: a bin's least value is the entry after a placeholder.
    ordered = F.sort_array(F.concat(keyed, marks))
    firsts = _bind(ordered, lambda s: F.filter(
        s, lambda x, at: (at == 0) | (F.get(s, at - 1).bitwiseAND(F.lit(_EMPTY)) != 0)))
    return F.transform(firsts, lambda x: F.when(
        x.bitwiseAND(F.lit(_EMPTY)) == 0, x.bitwiseAND(F.lit(_EMPTY - 1))))


def densified(values: Column, bins: int = BINS) -> Column:
    """Bins with every empty one filled; null if all are empty."""
    starts, strides = (F.array(*map(F.lit, x)) for x in zip(*_walks(bins)))

    def fill(v: Column) -> Column:
        def one(x: Column, at: Column) -> Column:
            def step(t: Column) -> Column:
                return F.get(v, (F.get(starts, at) + F.get(strides, at) * t).bitwiseAND(F.lit(bins - 1)))
            every = F.filter(F.transform(F.sequence(F.lit(_NEAR), F.lit(bins - 1)), step),
                             lambda y: y.isNotNull())
            return F.coalesce(x, *[step(F.lit(t)) for t in range(_NEAR)], F.get(every, F.lit(0)))
        return F.when(F.exists(v, lambda x: x.isNotNull()), F.transform(v, one))

    return _bind(values, fill)


def fingerprint(text: Column, shingle: int = SHINGLE, bins: int = BINS) -> Column:
    """Packed fingerprint: two hex digits (``B_BITS`` low-order bits) per bin, in bin order; the empty
    string for a text without words (null included)."""
    full = densified(bins_of(shingle_hashes(text_of(text), shingle), bins), bins)
    digits = F.transform(full, lambda x: F.lpad(F.hex(x.bitwiseAND(F.lit((1 << B_BITS) - 1))), 2, "0"))
    return F.lower(F.coalesce(F.array_join(digits, ""), F.lit("")))


def likeness(a: Column, b: Column, bins: int = BINS) -> Column:
    """Estimated resemblance of two fingerprints, 0 to 1, corrected for chance agreement of the kept
    bits; 1 for two texts without words, 0 if one has none."""
    agree = F.size(F.filter(F.sequence(F.lit(0), F.lit(bins - 1)), lambda i: F.substr(
        a, i * 2 + 1, F.lit(2)) == F.substr(b, i * 2 + 1, F.lit(2)))) / F.lit(float(bins))
    chance = 1.0 / (1 << B_BITS)
    fair = F.greatest(F.lit(0.0), (agree - chance) / (1 - chance))
    return (F.when(a == b, 1.0).when((a == "") | (b == ""), 0.0).otherwise(fair))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint`` of every row; other columns are ignored. Null, empty and blank texts have the
    empty fingerprint; texts of any length are read whole; equal texts have equal fingerprints; an
    empty table gives an empty result."""
    return docs.select(F.col(id_col).alias("doc_id"), fingerprint(F.col(text_col)).alias("fingerprint"))


def _bucket(rows: DataFrame, rows_per_bucket: int, quantiles: int, most_per_quantile: int) -> Column:
    """Number of a row's bucket: ascending in the order of descending ``doc_id``, then ascending ``tie``."""
    sizes = rows.agg(F.count("doc_id").alias("ids"), F.count(F.lit(1)).alias("n")).first()
    wanted = max(1, -(-sizes["ids"] // rows_per_bucket))
    k = min(quantiles, wanted)
    cuts = rows.agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"), F.percentile_approx(
        "doc_id", [i / k for i in range(1, k)] or [0.5], 40 * quantiles).alias("q")).first()
    bounds = F.array(*(F.lit(int(q)).cast("long") for q in cuts["q"] or [0]))
    b, i = len(cuts["q"] or [0]), F.col("doc_id")
    at = (F.col("tie").cast("double") + 2.0 ** 63) / 2.0 ** 64  # 0 to 1
    lower = F.size(F.filter(bounds, lambda q: q < i))
    same = F.size(F.filter(bounds, lambda q: q == i))
    # An id that is several quantiles: later ties further down. Between two quantiles: equal widths.
    place = F.lit(b) - (lower + same - F.floor(F.least(at, F.lit(1 - 1e-9)) * same))
    fine = min(most_per_quantile, -(-wanted // k))
    low = F.coalesce(F.get(bounds, lower - 1), F.lit(cuts["a"] or 0))
    high = F.coalesce(F.get(bounds, lower), F.lit(cuts["b"] or 0))
    step = F.floor((high - i).cast("double") / (high - low + 1).cast("double") * fine)
    between = F.when(same > 0, F.lit(fine)).otherwise(F.greatest(F.lit(0), F.least(step, F.lit(fine - 1))))
    nulls = max(1, min(quantiles * most_per_quantile, -(-(sizes["n"] - sizes["ids"]) // rows_per_bucket)))
    last = F.lit((b + 1) * (fine + 1)) + F.floor(F.least(at, F.lit(1 - 1e-9)) * nulls)
    return F.when(i.isNull(), last).otherwise(place * (fine + 1) + between).cast("long")


def next_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   carry: dict[str, Column] | None = None, rows_per_bucket: int = 500,
                   quantiles: int = 512, most_per_quantile: int = 128) -> DataFrame:
    """Every row with the next row in descending order of id (after the last: the first), as columns
    ``doc_id, text`` (null: empty), the columns of ``carry``, and each with the prefix ``next_``.

    A window over all rows would be one task. Rows are bucketed by quantiles of the ids instead, so an
    outlying id widens no bucket; an id that fills several quantiles, and rows without an id, are cut
    by ranges of their texts' hashes. The first row of each bucket is copied into the bucket before
    it, where a window per bucket finds it. Rows without an id come last; rows that share an id follow
    each other in the order of their texts' hashes.
    """
    rows = (docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
            .withColumn("tie", F.xxhash64("text")))
    rows = rows.withColumn("bucket", _bucket(rows, rows_per_bucket, quantiles, most_per_quantile))
    order = [F.col("doc_id").desc_nulls_last(), "tie"]
    # One row per bucket, at most quantiles * most_per_quantile of them: who comes first in each.
    heads = rows.groupBy("bucket").agg(
        F.min(F.struct((-F.coalesce("doc_id", F.lit(0))).alias("neg"), "tie")).alias("head"))
    turn = Window.orderBy("bucket")
    heads = heads.select(
        "head.neg", F.col("head.tie").alias("t"), F.col("bucket").alias("b"),
        F.coalesce(F.lag("bucket").over(turn), F.max("bucket").over(
            turn.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("to"))
    # Repeated rows of a head are alike, so a copy of each is harmless.
    at_head = (F.col("bucket") == F.col("b")) & (F.col("tie") == F.col("t")) & (
        -F.coalesce("doc_id", F.lit(0)) == F.col("neg"))
    copies = rows.join(F.broadcast(heads), at_head, "left").select("doc_id", "text", "bucket", "tie", "to")
    spread = F.when(F.col("to").isNull(), F.array(F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("copy")))) \
        .otherwise(F.array(F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("copy")),
                           F.struct(F.col("to").alias("bucket"), F.lit(True).alias("copy"))))
    carry = carry or {}
    cols = ["doc_id", "text", *carry]
    laid = copies.select("doc_id", "text", "tie", *[c.alias(k) for k, c in carry.items()], F.inline(spread))
    window = Window.partitionBy("bucket").orderBy("copy", *order)
    ahead = F.lead(F.struct(*cols)).over(window)
    return (laid.select(*cols, "copy", ahead.alias("ahead")).where("not copy")
            .select(*cols, *[F.col(f"ahead.{c}").alias(f"next_{c}") for c in cols]))


def edited_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, in which the last third of the code points
    gave way to the first as many (or all) of the next document's, with likenesses.

    Returns ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next``, one row per input row. Null texts are empty; other columns are ignored; a table of
    one row is its own next document; an empty table gives an empty result.
    """
    rows = next_documents(docs, id_col, text_col, {"fp": fingerprint(F.col("text"))})
    n = F.length("text")
    third = F.expr("cast(length(text) div 3 as int)")
    edited = F.concat(F.substr("text", F.lit(1), n - third), F.substr("next_text", F.lit(1), third))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), "fp", "next_fp", edited.alias("edited"))
    rows = rows.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                       F.col("fp").alias("fingerprint"), fingerprint(F.col("edited")).alias("edited_fingerprint"),
                       "next_fp")
    return rows.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                       likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
                       likeness(F.col("fingerprint"), F.col("next_fp")).alias("near_next"))
