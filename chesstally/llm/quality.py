"""Quality classifier: compressed sizes under dictionaries of good and of bad text.

Two zstandard dictionaries are built from labelled lines, one from good and one from bad documents
(lines seen in both are left out). Every text is compressed block by block with each of them; the
normalised difference of the two compressed sizes, with the compression ratio beside it, becomes a
probability by a logistic calibration on labelled documents that the dictionaries have not seen.

The model is fitted on the driver from a bounded sample: at most ``MAX_PER_CLASS`` documents per
class, each of at most ``MAX_DOC_CHARS`` characters and all of at most ``MAX_CLASS_CHARS``, chosen by a
hash of their id among the labels that have a document. Class shares are counted over all of these
labels. Scoring compresses whole texts inside tasks, without a shuffle.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chesstally.llm.common import materialize, sample_by_hash, text_of

MAX_PER_CLASS = 1500
MAX_DOC_CHARS = 200_000
MAX_CLASS_CHARS = 20_000_000
BLOCK = 1024
LEVEL = 1
DICT_BYTES = 1 << 16
FOLDS, HELD_OUT = 3, 1


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that are kept for evaluation (false for a null id)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS == HELD_OUT,
                      F.lit(False))


def _blocks(data: bytes) -> list[bytes]:
    return [data[i:i + BLOCK] for i in range(0, len(data), BLOCK)]


def _compressor(words: bytes) -> zstandard.ZstdCompressor:
    made = zstandard.ZstdCompressionDict(words)
    made.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=made, write_checksum=False,
                                    write_content_size=False, write_dict_id=False)


def _dictionary(lines: list[bytes]) -> bytes:
    """A trained dictionary; for samples too small to train on, their raw text."""
    samples = [b for x in lines for b in _blocks(x)]
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(lines)[-DICT_BYTES:] or b"\n" * 8


@dataclass(frozen=True)
class Model:
    """Two dictionaries and the calibration; ``prior`` is the share of label 1 and the score of an
    empty text (0.5 if there was nothing to learn from)."""

    prior: float
    good: bytes | None = None
    bad: bytes | None = None
    mean: tuple[float, ...] = ()
    scale: tuple[float, ...] = ()
    weights: tuple[float, ...] = ()

    def features(self, good, bad, text: str) -> list[float]:
        blocks = _blocks(text.encode())
        g = sum(len(good.compress(b)) for b in blocks)
        b = sum(len(bad.compress(x)) for x in blocks)
        return [(b - g) / (b + g), min(b, g) / sum(map(len, blocks))]

    def score_all(self, texts) -> np.ndarray:
        out = np.full(len(texts), self.prior)
        if self.good is None:
            return out
        good, bad = _compressor(self.good), _compressor(self.bad)
        full = [i for i, t in enumerate(texts) if t]
        if full:
            x = np.array([self.features(good, bad, texts[i]) for i in full])
            z = (x - self.mean) / self.scale @ self.weights[1:] + self.weights[0]
            out[full] = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        return out


def _logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Weighted logistic regression by Newton steps."""
    x = np.c_[np.ones(len(x)), x]
    t = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ t, -30, 30)))
        h = (x * (w * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(t))
        t = t + np.linalg.solve(h, x.T @ (w * (y - p)) - ridge * t)
    return t


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", max_per_class: int = MAX_PER_CLASS) -> Model:
    """Fit on labelled documents outside the held-out fold. Null labels and ids and labels without a
    document are ignored; a document labelled more than once counts with its largest label, an id
    with several texts with the first by hash; without two documents of both classes the model gives
    every text the share of label 1 and a warning says so."""
    known = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
             .groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("y")))
    # Ids and lengths only: which labelled documents there are, before any is chosen.
    have = (docs.select(F.col(id_col).alias("id"), F.length(text_of(text_col)).alias("n"))
            .groupBy("id").agg(F.min("n").alias("low"), F.max("n").alias("n")))
    known = materialize(known.join(have, "id"), "quality-labels")
    shares = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = shares.get(0, 0) + shares.get(1, 0)
    prior = shares.get(1, 0) / total if total else 0.5
    fit_for = known.where((F.col("low") > 0) & (F.col("n") <= MAX_DOC_CHARS))
    picked = None
    for y in (0, 1):
        top = sample_by_hash(fit_for.where(F.col("y") == y), "id", max_per_class, seed=7)
        picked = top if picked is None else picked.union(top)
    order = F.xxhash64(F.lit(7), F.col("id"))
    so_far = Window.partitionBy("y").orderBy(order, "id")  # at most max_per_class rows per class
    picked = picked.withColumn("so_far", F.sum("n").over(so_far)).where(F.col("so_far") <= MAX_CLASS_CHARS)
    rows = (docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
            .join(F.broadcast(picked.select("id", "y")), "id")  # at most 2 * max_per_class ids
            .groupBy("id", "y").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
            .orderBy(order, "id").collect())
    texts = {y: [r["text"] for r in rows if r["y"] == y] for y in (0, 1)}
    if min(map(len, texts.values())) < 2:
        warnings.warn(f"quality classifier: {len(texts[0])} and {len(texts[1])} labelled documents to learn from; "
                      f"every text scores {prior:.3f}", stacklevel=2)
        return Model(prior)
    half = {y: len(t) // 2 for y, t in texts.items()}
    lines = {y: dict.fromkeys(x for d in t[:half[y]] for x in d.encode().split(b"\n") if x.strip())
             for y, t in texts.items()}
    words = {y: _dictionary([x for x in lines[y] if x not in lines[1 - y]]) for y in (0, 1)}
    draft = Model(prior, words[1], words[0])
    good, bad = _compressor(draft.good), _compressor(draft.bad)
    rest = [(t, y) for y in (0, 1) for t in texts[y][half[y]:]]
    x = np.array([draft.features(good, bad, t) for t, _ in rest])
    y = np.array([y for _, y in rest])
    share = np.where(y == 1, prior / max(1, y.sum()), (1 - prior) / max(1, (1 - y).sum()))
    mean, scale = x.mean(0), x.std(0) + 1e-9
    weights = _logistic((x - mean) / scale, y, share * len(y))
    return Model(prior, draft.good, draft.bad, tuple(mean), tuple(scale), tuple(weights))


def score_column(model: Model, text_col: str = "text") -> Column:
    """The score of every text, 0 to 1 (higher: label 1 is likelier); null counts as empty."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(model.score_all([t or "" for t in texts]))

    return score(F.col(text_col))


def score_documents(docs: DataFrame, model: Model, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``; other columns are ignored. Null and
    empty texts score the share of label 1; a null id is not held out; texts of any length are
    scored whole; equal texts score alike; an empty table gives an empty result."""
    scored = docs.select(F.col(id_col).cast("long").alias("doc_id"), score_column(model, text_col).alias("score"))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score",
                         F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """``docs`` without the documents that score below 0.5; columns and other rows stay, in any number of
    repeats. Null and empty texts go or stay by the share of label 1; an empty table stays empty."""
    model = fit(docs, labels, id_col, text_col)
    return docs.where(score_column(model, text_col) >= 0.5)
