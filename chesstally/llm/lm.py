"""Language-model scoring: a gated recurrent network in numpy with a class-factored softmax.

What the corpus gives: the count of every token over all training documents, by one aggregation.
The counts alone give the base score (add-one unigram); they choose the network's vocabulary, its
classes and the starting point of its output layer, and the byte four-grams of all other words. The
recurrent weights are fitted by truncated backpropagation on all training documents, whole, in one
pass at every size: ids are written once, and dealt by a hash of id, text and number of the copy to
rounds and shards. A round takes a share of the documents (the shares grow and add up to the whole)
in shards of ``SHARD_TOKENS`` on average; each shard goes on from the round's weights, and their
mean, weighted by tokens and added up in a tree, begins the next round. Shards depend on the documents
alone, not on how the table is partitioned.

A document is scored as a whole: its tokens run through the network in windows, and the state is
carried from window to window. A word outside the network's vocabulary costs the probability of
"other word" times that of the word among others: a mixture of its share of all other training tokens
and a byte four-gram spelling model of distinct words, weighted by the share of tokens seen once (Good-Turing), so every
text has a proper probability.

Counts of frequent words travel to the tasks as a table of at most ``KNOWN_WORDS`` rows; all other
words are joined with their counts by a shuffle, in which no word is hot any more.
"""

from __future__ import annotations

import heapq
import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chesstally.llm.common import materialize, slices, text_of

FOLDS, HELD_OUT = 7, 2
KNOWN_WORDS = 1 << 17
ROUNDS = (1, 2, 4, 8)  # shares of the training documents
SHARD_TOKENS = 4_000_000
FAN = 64  # weights added up by one task
VOCAB, CLASSES, HIDDEN = 1024, 32, 16
STEPS, RATE = 24, 0.01
LANES, LANE_TOKENS = 128, 8192  # documents read side by side: one for so many tokens of a shard
END, OTHER = 0, 1  # ids of the end of a text (also what precedes its first token) and of other words
_FLUSH = 500_000  # distinct words that a task holds before it hands its counts on
_SLICE = 1 << 14  # texts split at once (8 MB of them, or one text)
_BUFFER = 8_000_000  # tokens that a scoring task holds to sort documents by length
_ALPHABET = 40


def tokens(text: str | None) -> list[bytes]:
    """Words of a text: bytes, A-Z lower-cased, cut at ASCII white space."""
    return (text or "").encode().lower().split()


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """``tokens`` of many texts, one after another, and where each text's begin (and the last one's end)."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words, begins = lists.values.cast(pa.binary()), lists.offsets.to_numpy()
    some = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    if not some.all():  # white space at a text's begin or end leaves an empty word
        words, begins = words.filter(pa.array(some)), np.concatenate([[0], np.cumsum(some)])[begins]
    return words, begins


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS == HELD_OUT,
                      F.lit(False))


def _training(src: DataFrame) -> DataFrame:
    """The rows of ``src`` (``id, ...``) that are learnt from."""
    return src.where(F.col("id").isNotNull() & ~held_out("id"))


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word binary, c long`` over all training documents; the end of a text is the empty word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for part in slices(batches, _SLICE):
            found = _words(part.column(0))[0].value_counts()
            held.append(pa.table({"word": found.field(0), "c": found.field(1)}))
            held.append(pa.table({"word": pa.array([b""]), "c": pa.array([part.num_rows])}))
            if sum(map(len, held)) >= _FLUSH:
                held = [_added(held)]
                if len(held[0]) >= _FLUSH:
                    yield from held.pop().to_batches()
        if held:
            yield from _added(held).to_batches()

    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    part = _training(src).select("text").mapInArrow(run, "word binary, c long")
    return part.groupBy("word").agg(F.sum("c").alias("c"))


def _added(counts: list[pa.Table]) -> pa.Table:
    return pa.concat_tables(counts).group_by("word", use_threads=False).aggregate([("c", "sum")]).rename_columns(["word", "c"])


class Spelling:
    """Byte four-grams of distinct words, each ended by a line feed (which no word holds); rare bytes
    share one symbol and are then equally likely."""

    def __init__(self, words: list[bytes] | pa.Array):
        self._alphabet(self.bytes_of(words))
        self._estimate(self.grams(words))

    @staticmethod
    def ended(words: list[bytes] | pa.Array) -> np.ndarray:
        """The words' bytes, a line feed after each word."""
        words = words.cast(pa.binary()) if isinstance(words, pa.Array) else pa.array(words, pa.binary())
        out = pc.binary_join_element_wise(words, b"", b"\n")
        ends = np.frombuffer(out.buffers()[1], np.int32)[out.offset:out.offset + len(out) + 1]
        return np.frombuffer(out.buffers()[2], np.uint8)[ends[0]:ends[-1]]

    @classmethod
    def bytes_of(cls, words: list[bytes] | pa.Array) -> np.ndarray:
        return np.bincount(cls.ended(words), minlength=256).astype(float)

    @classmethod
    def of_counts(cls, counts: DataFrame) -> Spelling:
        """From all rows of ``word, c``; each word counts once, as unseen words are unlike frequent ones."""

        def added(kernel) -> DataFrame:
            def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                total = 0
                for part in slices(batches, 1 << 16):
                    total = total + kernel(part.column(0))
                at = np.flatnonzero(total) if np.ndim(total) else np.empty(0, int)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at, pa.int64()), pa.array(total[at] if len(at) else [], pa.float64())], ["at", "n"])

            return counts.select("word").mapInArrow(run, "at long, n double").groupBy("at").agg(
                F.sum("n").alias("n"))

        def collected(df: DataFrame, size: int) -> np.ndarray:
            out, got = np.zeros(size), df.toArrow()
            out[got["at"].to_numpy()] = got["n"].to_numpy()
            return out

        self = cls.__new__(cls)
        self._alphabet(collected(added(cls.bytes_of), 256))
        self._estimate(collected(added(self.grams), self.n ** 4))
        return self

    def _alphabet(self, seen: np.ndarray) -> None:
        seen[10] = 0
        top = [b for b in np.argsort(-seen, kind="stable")[:_ALPHABET - 2] if seen[b]]
        self.symbol = np.full(256, 1, np.int64)  # 1: any other byte
        self.symbol[10] = 0
        for i, b in enumerate(top):
            self.symbol[b] = i + 2
        self.n = len(top) + 2

    def grams(self, words: list[bytes] | pa.Array) -> np.ndarray:
        return np.bincount(self._context(self.ended(words)), minlength=self.n ** 4).astype(float)

    def _estimate(self, grams: np.ndarray) -> None:
        n = self.n
        held = [grams.reshape((n,) * 4)]
        for _ in range(3):
            held.append(held[-1].sum(0))
        share = held.pop() + 0.5
        share = share / share.sum()
        while held:  # from single bytes to four in a row
            more = held.pop()
            share = (more + 5 * share[None]) / (more.sum(-1, keepdims=True) + 5)
        self.log = np.log(share).ravel().astype(np.float32)

    def _context(self, data: np.ndarray) -> np.ndarray:
        """Each byte with the three before it in its word, as one number."""
        s = self.symbol[data]
        past = []
        for back in (1, 2, 3):
            p = np.zeros_like(s)
            p[back:] = s[:-back]
            for q in past:
                p[q == 0] = 0
            past.append(p)
        at = past[2]
        for symbol in (past[1], past[0], s):
            at = at * self.n + symbol
        return at

    def log_probability(self, words: list[bytes] | pa.Array) -> np.ndarray:
        """Natural logarithm of each word's probability."""
        if not len(words):
            return np.empty(0)
        data = self.ended(words)
        at = self._context(data)
        each = self.log[at].astype(np.float64) - np.where(at % self.n == 1, math.log(256), 0.0)
        ends = np.flatnonzero(data == 10)
        return np.add.reduceat(each, np.concatenate([[0], ends[:-1] + 1]))


def _bounded(x: np.ndarray) -> np.ndarray:
    """Logits, in place, kept where their exponentials and sums of these are finite: softmax then needs
    no maximum of each row."""
    return np.clip(x, -60, 60, out=x)


class Network:
    """GRU over token ids; output ids are grouped into classes of equal width by frequency."""

    def __init__(self, freq: np.ndarray, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.vocab = len(freq)
        self.width = -(-self.vocab // CLASSES)
        h, w = HIDDEN, self.width
        share = np.zeros(CLASSES * w)
        share[:self.vocab] = (freq + 1) / (freq + 1).sum()
        share = share.reshape(CLASSES, w)
        with np.errstate(divide="ignore"):
            self.p = {
                "x": rng.normal(0, 0.1, (self.vocab, 3 * h)), "u": rng.normal(0, h ** -0.5, (h, 3 * h)),
                "b": np.zeros(3 * h), "c": rng.normal(0, 0.1, (h, CLASSES)),
                "cb": np.maximum(np.log(share.sum(1)), -30.0),
                "o": rng.normal(0, 0.1, (CLASSES, h, w)),
                "ob": np.maximum(np.log(share / np.maximum(share.sum(1, keepdims=True), 1e-30)), -30.0),
            }
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def states(self, ids: np.ndarray, h: np.ndarray, keep: np.ndarray | None = None):
        """``ids[t, b]`` -> states after each input, the last one, and the gates' and candidate's values with
        what the gradients need; ``keep`` (0 where a text begins) resets states. Gates come first in all
        arrays, so that each is in one piece."""
        p, n = self.p, HIDDEN
        # The two gates' inputs are negated: their sigmoids are then 1 / (1 + exp(input)).
        sign = np.array([-1, -1, 1], h.dtype)[:, None, None]
        u = p["u"].reshape(n, 3, n).transpose(1, 0, 2) * sign
        x = np.take((p["x"] + p["b"]).reshape(self.vocab, 3, n).transpose(1, 0, 2) * sign, ids, axis=1)
        out = np.empty((*ids.shape, n), x.dtype)
        g = np.empty((3, len(h), n), x.dtype)
        by_gate = None if keep is None else np.empty_like(out)
        resets = None if keep is None else (keep == 0).any(1)
        for t in range(len(ids)):
            if keep is not None and resets[t]:
                h = h * keep[t][:, None]
            np.matmul(h, u, out=g)
            zr, c = x[:2, t], x[2, t]
            zr += g[:2]
            np.exp(zr, out=zr)
            zr += 1
            np.reciprocal(zr, out=zr)
            if by_gate is not None:
                by_gate[t] = g[2]
            c += np.multiply(zr[1], g[2], out=g[2])
            np.tanh(c, out=c)
            h = np.subtract(h, c, out=out[t])
            h *= zr[0]
            h += c
        return out, h, (x, by_gate)

    def log_probability(self, h: np.ndarray, target: np.ndarray, grads: dict | None = None):
        """Log-probabilities of targets after states ``h``; with ``grads``, also the loss's gradient
        by ``h`` (sum of negative log-probabilities)."""
        p = self.p
        order = np.argsort((target // self.width).astype(np.uint8), kind="stable")
        h, target = h[order], target[order]
        cls, word = target // self.width, target % self.width
        rows = np.arange(len(target))
        ends = np.searchsorted(cls, np.arange(CLASSES + 1))
        groups = [(k, slice(ends[k], ends[k + 1])) for k in np.flatnonzero(np.diff(ends))]
        # Only products are made class by class; all else is done for all targets at once.
        x, own = h @ p["c"], rows * CLASSES + cls
        x = _bounded(np.add(x, p["cb"], out=x))
        mine = x.take(own).astype(np.float64)
        x = np.exp(x, out=x)
        total = x @ np.ones(CLASSES, h.dtype)
        mine -= np.log(total)
        y, own_word = np.empty((len(rows), self.width), h.dtype), rows * self.width + word
        for k, at in groups:
            part = np.matmul(h[at], p["o"][k], out=y[at])
            part += p["ob"][k]
        logit = _bounded(y).take(own_word)
        y = np.exp(y, out=y)
        ones, total_word = np.ones(self.width, h.dtype), np.empty(len(rows), h.dtype)
        for _, at in groups:
            np.matmul(y[at], ones, out=total_word[at])
        mine += logit - np.log(total_word)
        out = np.empty_like(mine)
        out[order] = mine
        if grads is None:
            return out, None
        x /= total[:, None]
        x.reshape(-1)[own] -= 1
        y /= total_word[:, None]
        y.reshape(-1)[own_word] -= 1
        grads["c"], grads["cb"] = h.T @ x, x.sum(0)
        grads["o"], grads["ob"] = np.zeros_like(p["o"]), np.zeros_like(p["ob"])
        dh, by_word = x @ p["c"].T, np.empty_like(h)
        for k, at in groups:
            np.matmul(y[at], p["o"][k].T, out=by_word[at])
            np.matmul(h[at].T, y[at], out=grads["o"][k])
            np.add.reduce(y[at], 0, out=grads["ob"][k])
        dh += by_word
        back = by_word
        back[order] = dh
        return out, back

    def gradients(self, ids, keep, target, mask, h0):
        """Loss and gradients of one window (truncated: the incoming state is a constant)."""
        p, n = self.p, HIDDEN
        hs, h_last, ((z, r, c), gc) = self.states(ids, h0, keep)
        grads: dict[str, np.ndarray] = {}
        live = np.flatnonzero(mask.ravel())
        whole, flat = len(live) == mask.size, (hs.reshape(-1, n), target.ravel())
        logp, dout = self.log_probability(*(flat if whole else (v[live] for v in flat)), grads)
        if not whole:
            dlive, dout = dout, np.zeros_like(flat[0])
            dout[live] = dlive
        dout = dout.reshape(hs.shape)
        resets = (keep == 0).any(1)
        before = np.concatenate([h0[None], hs[:-1]])
        for t in np.flatnonzero(resets):
            before[t] *= keep[t][:, None]
        by_c = (1 - z) * (1 - c * c)
        # What a unit of the state's gradient gives for the two gates and the candidate's recurrent part.
        by = np.empty((*ids.shape, 3, n), hs.dtype)
        np.multiply((before - c) * z, 1 - z, out=by[:, :, 0])
        np.multiply(by_c * gc * r, 1 - r, out=by[:, :, 1])
        np.multiply(by_c, r, out=by[:, :, 2])
        dg = np.empty((*ids.shape, 3 * n), hs.dtype)
        by_gate, back = dg.reshape(by.shape), p["u"].T
        dh, part = np.zeros_like(h0), np.empty_like(h0)
        for t in range(len(ids) - 1, -1, -1):
            here = dout[t]
            here += dh
            np.multiply(here[:, None], by[t], out=by_gate[t])
            np.multiply(here, z[t], out=dh)
            dh += np.matmul(dg[t], back, out=part)
            if resets[t]:
                dh *= keep[t][:, None]
        grads["u"] = before.reshape(-1, n).T @ dg.reshape(-1, 3 * n)
        dx = dg
        np.multiply(dout, by_c, out=dx[..., 2 * n:])
        flat, at = dx.reshape(-1, 3 * n), ids.ravel()
        order = np.argsort(at.astype(np.uint16), kind="stable")
        at = at[order]
        starts = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        grads["x"] = np.zeros_like(p["x"])
        grads["x"][at[starts]] = np.add.reduceat(flat[order], starts, axis=0)
        grads["b"] = flat.sum(0)
        return -logp.sum(), len(live), grads, h_last

    def fit(self, texts: list[np.ndarray], top: float = RATE) -> None:
        """Adam over one pass: lanes of documents one after another (the longest first, each to the
        emptiest lane), in windows of ``STEPS`` tokens, with the state carried over windows and reset
        where a document begins. A lane that has ended is dropped."""
        if not texts:
            return
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        spare = {k: np.empty_like(x) for k, x in self.p.items()}
        total = sum(map(len, texts)) + len(texts)
        width = min(max(1, min(LANES, total // LANE_TOKENS)), len(texts))
        lanes: list[list[np.ndarray]] = [[] for _ in range(width)]
        room = [(0, k) for k in range(width)]
        for text in sorted(texts, key=len, reverse=True):
            size, k = heapq.heappop(room)
            lanes[k].append(text)
            heapq.heappush(room, (size + len(text) + 1, k))
        sizes = sorted(room, reverse=True)
        n = np.array([size for size, _ in sizes])
        # Inputs: END, w1 .. wn of each document; targets: w1 .. wn, END.
        ids, to = (np.full((n[0], width), END, np.uint16) for _ in range(2))
        keep = np.ones((n[0], width), np.float32)
        for k, (_, lane) in enumerate(sizes):
            at = 0
            for text in lanes[lane]:
                ids[at + 1:at + 1 + len(text), k] = to[at:at + len(text), k] = text
                keep[at, k] = 0
                at += len(text) + 1
        windows = -(-int(n[0]) // STEPS)
        h = np.zeros((width, HIDDEN), np.float32)
        for step, a in enumerate(range(0, int(n[0]), STEPS), 1):
            live = int((n > a).sum())
            here = slice(a, a + STEPS), slice(0, live)
            mask = np.arange(a, min(a + STEPS, n[0]))[:, None] < n[:live]
            _, count, grads, h = self.gradients(ids[here], keep[here], to[here], mask, h[:live])
            rate = top * min(1.0, step / 20) * max(0.05, 1 - step / (1.1 * windows))
            norm = math.sqrt(sum(float(np.vdot(g, g)) for g in grads.values())) / count
            clip = min(1.0, 1.0 / max(norm, 1e-9)) / count
            fixed = rate / (1 - 0.9 ** step), 1 / (1 - 0.99 ** step)
            for k, g in grads.items():
                g *= clip
                s = spare[k]
                m[k] += np.multiply(np.subtract(g, m[k], out=s), 0.1, out=s)
                np.subtract(np.multiply(g, g, out=s), v[k], out=s)
                v[k] += np.multiply(s, 0.01, out=s)
                np.sqrt(np.multiply(v[k], fixed[1], out=s), out=s)
                s += 1e-8
                self.p[k] -= np.divide(np.multiply(m[k], fixed[0], out=g), s, out=s)

    def score(self, texts: list[np.ndarray], steps: int = 32, batch: int = 512) -> np.ndarray:
        """Log-probability of each whole document (end included), in natural logarithms."""
        out = np.zeros(len(texts))
        order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
        for a in range(0, len(order), batch):
            group = np.array(order[a:a + batch])
            n = np.array([len(texts[i]) + 1 for i in group])  # descending
            flat = np.concatenate([*(texts[i] for i in group), [END]]).astype(np.uint16)
            begin = np.concatenate([[0], np.cumsum(n[:-1] - 1)])
            h = np.zeros((len(group), HIDDEN), np.float32)
            last = np.full(len(group), END, np.uint16)
            for t in range(0, int(n[0]), steps):
                live = int((n > t).sum())
                h, last = h[:live], last[:live]
                at = np.arange(t, min(t + steps, int(n[0])))[:, None]
                inside = at < n[:live] - 1  # beyond a text: END, and after that not counted
                to = np.where(inside, flat[np.where(inside, begin[:live] + at, 0)], END).astype(np.uint16)
                ids = np.vstack([last[None], to[:-1]])
                hs, h, _ = self.states(ids, h)
                count = (at < n[:live]).ravel()
                got = np.zeros(to.size)
                got[count], _ = self.log_probability(hs.reshape(-1, HIDDEN)[count], to.ravel()[count])
                out[group[:live]] += got.reshape(to.shape).sum(0)
                last = to[-1]
        return out


@dataclass
class Model:
    """The network, its vocabulary, and what it needs for other words."""

    ids: dict[bytes, int]  # words of the network
    counts: dict[bytes, int]  # the most frequent words' counts (b"": ends of texts)
    total: int  # tokens in training documents
    distinct: int
    network: Network
    spelling: Spelling
    others: int = 0  # training tokens outside the network's vocabulary
    spelled: float = 1.0  # share of the spelling model among other words

    def encode(self, words: list[bytes]) -> np.ndarray:
        get = self.ids.get
        return np.fromiter(map(get, words, repeat(OTHER)), np.uint16, len(words))

    def log_spelt(self, words: list[bytes] | pa.Array) -> np.ndarray:
        """Logarithm of the spelling model's part of other words' probabilities: long words' parts are
        below the least double."""
        return self.spelling.log_probability(words) + math.log(self.spelled)

    def spelt(self, words: list[bytes]) -> np.ndarray:
        """The spelling model's part of other words' probabilities."""
        return np.exp(self.log_spelt(words))

    def share(self, count) -> float:
        """The counts' part."""
        return (1 - self.spelled) * count / max(1, self.others)

    def log_other(self, words: list[bytes], counts) -> np.ndarray:
        """Logarithm of both parts' sum."""
        with np.errstate(divide="ignore"):
            return np.logaddexp(self.log_spelt(words), np.log(self.share(np.asarray(counts, float))))


def _least_count(counts: DataFrame, most: int) -> int:
    """The least count above which there are ``most`` words or fewer, to an eighth of a power of two:
    from a histogram of a few hundred rows, where a sort would send ``most`` rows per task."""
    step = F.floor(F.log2(F.col("c")) * 8)
    rows = counts.groupBy(step.alias("k")).agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("c")).collect()
    least, n = 1 << 62, 0
    for r in sorted(rows, key=lambda r: -r["k"]):
        n += r["n"]
        if n > most:
            break
        least = r["c"]
    return least


def _pack(p: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([p[k].ravel() for k in sorted(p)]).astype(np.float64)


def _unpack(flat: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k in sorted(like):
        out[k] = flat[at:at + like[k].size].reshape(like[k].shape).astype(np.float32)
        at += like[k].size
    return out


def _coded(src: DataFrame, ids: dict[bytes, int], total: int) -> DataFrame:
    """Training rows of ``src`` (``id, text``) as ``round, shard, h, copy, data`` (16-bit ids), written once.
    A round of n tokens has n / ``SHARD_TOKENS`` shards, to which rows are dealt by hash."""
    table = src.sparkSession.sparkContext.broadcast(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(list(table.value), pa.binary())
        # One place more at the end, which place -1 reads.
        to = np.array([*table.value.values(), OTHER], "<u2")
        for part in slices(batches, _SLICE):
            words, begins = _words(part.column(1))
            data = to[pc.index_in(words, known).fill_null(-1).to_numpy()]
            data = pa.Array.from_buffers(pa.large_binary(), len(part), [
                None, pa.py_buffer(begins.astype(np.int64) * 2), pa.py_buffer(data)]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(np.diff(begins) + 1, pa.int64()), data], ["h", "n", "data"])

    rows = _training(src).select(F.xxhash64("id", "text").alias("h"), "text").mapInArrow(run, "h long, n long, data binary")
    # Equal rows become one with their number, then copies dealt one by one: a row that is there very many
    # times is in every shard.
    rows = (rows.groupBy("h", "n", "data").agg(F.count(F.lit(1)).alias("times"))
            .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "times"))))
    place = F.pmod(F.xxhash64("h", "copy"), F.lit(sum(ROUNDS)))
    turn, size = F.lit(len(ROUNDS) - 1), F.lit(total * ROUNDS[-1] // sum(ROUNDS))
    for i in reversed(range(len(ROUNDS) - 1)):
        turn = F.when(place < sum(ROUNDS[:i + 1]), i).otherwise(turn)
        size = F.when(place < sum(ROUNDS[:i + 1]), total * ROUNDS[i] // sum(ROUNDS)).otherwise(size)
    shards = F.ceil(size / F.lit(SHARD_TOKENS))
    return materialize(rows.select(
        turn.alias("round"), F.pmod(F.xxhash64(F.lit(7), "h", "copy"), F.greatest(shards, F.lit(1))).alias("shard"),
        "h", "copy", "data"), "lm-shards")


def _train(network: Network, src: DataFrame, ids: dict[bytes, int], total: int) -> None:
    """Rounds over all training rows of ``src`` (``id, text``); see the module's text."""
    sc, coded = src.sparkSession.sparkContext, _coded(src, ids, total)
    shards = dict(coded.groupBy("round").agg(F.max("shard") + 1).collect())  # a row per round
    kind = "g long, n double, w binary"
    for i in range(len(ROUNDS)):
        left = shards.get(i, 0)
        if not left:
            continue
        got = (coded.where(F.col("round") == i).repartition(2 * left, "shard")
               .groupBy("shard").applyInArrow(_learner(sc.broadcast(network), RATE / (1 + i)), kind))
        while left > 1:
            got = got.groupBy(F.expr(f"g div {FAN}")).applyInArrow(_mean, kind)
            left = -(-left // FAN)
        network.p = _unpack(np.frombuffer(got.first()["w"]), network.p)


def _learner(start, top: float):
    """Trains on one shard from the broadcast weights."""

    def learn(table: pa.Table) -> pa.Table:
        net = _copied(start.value)
        order = np.lexsort((table["copy"].to_numpy(), table["h"].to_numpy()))
        texts = [np.frombuffer(b, "<u2") for b in table["data"].take(pa.array(order)).to_pylist()]
        net.fit(texts, top)
        return _weights(table["shard"][0].as_py(), sum(map(len, texts)) + len(texts), _pack(net.p))

    return learn


def _mean(table: pa.Table) -> pa.Table:
    """The mean of at most ``FAN`` weights, added in the same order in every run."""
    rows = sorted(table.to_pylist(), key=lambda r: r["g"])
    size = sum(r["n"] for r in rows)
    return _weights(rows[0]["g"] // FAN, size, sum(np.frombuffer(r["w"]) * (r["n"] / size) for r in rows))


def _weights(g: int, n: float, flat: np.ndarray) -> pa.Table:
    return pa.table({"g": pa.array([g], pa.int64()), "n": pa.array([float(n)]), "w": pa.array([flat.tobytes()], pa.binary())})


def _copied(network: Network) -> Network:
    """The broadcast value is shared by the tasks of a worker."""
    out = object.__new__(Network)
    out.vocab, out.width = network.vocab, network.width
    out.p = {k: v.copy() for k, v in network.p.items()}
    return out


def fit(docs: DataFrame, counts: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Model from all training documents and their counts (see the module's text)."""
    sums = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v"),
                      F.count_if(F.col("c") == 1).alias("once")).first()
    top = counts.where(F.col("c") >= _least_count(counts, KNOWN_WORDS)).collect()
    top.sort(key=lambda r: (-r["c"], r["word"]))
    table = {bytes(r["word"]): r["c"] for r in top}
    table |= {b"": r["c"] for r in counts.where(F.length("word") == 0).limit(1).collect()}
    words = [w for w in table if w][:VOCAB - 2]
    ids = {w: i + 2 for i, w in enumerate(words)}
    src = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    freq = np.zeros(2 + len(words))
    freq[END] = table.get(b"", 0)
    freq[2:] = [table[w] for w in words]
    freq[OTHER] = max(0, sums["n"] - freq.sum())
    network = Network(freq)
    _train(network, src, ids, sums["n"])
    spelling = Spelling.of_counts(counts.where((F.length("word") > 0) & ~F.col("word").isin(words)))
    others = int(freq[OTHER])
    spelled = min(1.0, (sums["once"] + 1) / (others + 2)) if others else 1.0
    return Model(ids, table, sums["n"], sums["v"], network, spelling, others, spelled)


_TABLES: dict[str, tuple] = {}


def _tables(name: str, m: Model) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """The words of the model's table; by a word's place there, the base's logarithm, the network's id, what it
    costs as another word. Made once per worker process and model."""
    if name not in _TABLES:
        place = {w: i for i, w in enumerate(m.counts)}
        # One place more at the end of each, which place -1 reads.
        logs = np.log10(np.fromiter(chain(m.counts.values(), [0]), float, len(place) + 1) + 1)
        ids = np.fromiter(chain(map(m.ids.get, place, repeat(OTHER)), [OTHER]), np.uint16, len(place) + 1)
        near = [w for w in place if w and w not in m.ids]
        other = np.zeros(len(place) + 1)
        other[[place[w] for w in near]] = m.log_other(near, [m.counts[w] for w in near])
        _TABLES.clear()
        _TABLES[name] = pa.array(list(place), pa.binary()), logs, ids, other
    return _TABLES[name]


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row.

    ``base_score`` is the add-one unigram's and ``score`` the network's log10 probability of the whole
    text. Learns from the rows whose ``crc32(doc_id) % 7`` is not 2. A null text is the empty text
    (one token, its end); rows with a null id are scored, neither held out nor learnt from; repeated
    rows each count; other columns are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    counts = materialize(token_counts(docs, id_col, text_col), "lm-counts")
    model = fit(docs, counts, id_col, text_col)
    shared, name = spark.sparkContext.broadcast(model), uuid.uuid4().hex
    log_total = math.log10(model.total + model.distinct + 1)
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        task, at = TaskContext.get().partitionId(), 0
        table, logs, ids, other = _tables(name, m)
        end = m.counts.get(b"", 0)
        held: list[tuple[dict, np.ndarray]] = []  # columns of a slice, what other words add to scores
        texts: list[np.ndarray] = []
        size = 0

        def columns(docs, words: pa.Array, places: np.ndarray) -> int:
            """All but the network's part; words whose counts are not here go on as lists."""
            nonlocal at
            begins, ends = places[:-1], places[1:]
            coded = words.dictionary_encode()  # each word of the slice is looked up and spelt once
            kinds, kind = coded.dictionary, coded.indices.to_numpy()
            spots = pc.index_in(kinds, table).fill_null(-1).to_numpy()
            spot = spots[kind]
            here = spot >= 0

            def sums(values: np.ndarray) -> np.ndarray:
                total = np.concatenate([[0], np.cumsum(values)])
                return total[ends] - total[begins]

            far, rare = np.flatnonzero(~here), np.flatnonzero(spots < 0)
            spelt = np.zeros(len(kinds))
            spelt[rare] = m.log_spelt(kinds.take(pa.array(rare)))
            offsets = pa.array(np.searchsorted(far, places), pa.int32())
            net = ids[spot]  # OTHER for words that are not in the table
            texts.extend(net[a:b] for a, b in zip(begins, ends))
            rid = (task << 36) + at
            at += len(docs)
            held.append(({
                "rid": pa.array(range(rid, rid + len(docs)), pa.int64()), "doc_id": docs,
                "n_tokens": pa.array(ends - begins + 1, pa.int64()),
                "known": pa.array(sums(here) + (end > 0), pa.int64()),
                "logs": pa.array(sums(np.where(here, logs[spot], 0.0)) + math.log10(end + 1), pa.float64()),
                "words": pa.ListArray.from_arrays(offsets, kinds.take(pa.array(kind[far]))),
                "spelt": pa.ListArray.from_arrays(offsets, pa.array(spelt[kind[far]], pa.float64()))},
                sums(np.where(here, other[spot], 0.0))))
            return len(words) + len(docs)

        def flush():
            scores, done = m.network.score(texts), 0
            for cols, extra in held:
                cols["ln"] = pa.array(scores[done:done + len(extra)] + extra, pa.float64())
                done += len(extra)
                yield pa.RecordBatch.from_arrays([cols[c] for c in order], order)

        order = ["rid", "doc_id", "n_tokens", "known", "logs", "ln", "words", "spelt"]
        for part in slices(batches, _SLICE):
            size += columns(part.column(0), *_words(part.column(1)))
            if size >= _BUFFER:
                yield from flush()
                held, texts, size = [], [], 0
        if held:
            yield from flush()

    rows = materialize(src.mapInArrow(
        run, "rid long, doc_id long, n_tokens long, known long, logs double, ln double, "
             "words array<binary>, spelt array<double>"), "lm-rows")
    # Words that are not in the table of frequent ones meet their counts here.
    found = F.coalesce("c", F.lit(0))
    share = found * F.lit(model.share(1.0))
    both = F.greatest("spelt", F.log(share)) + F.log1p(F.exp(-F.abs(F.col("spelt") - F.log(share))))
    ln = F.when(share > 0, both).otherwise(F.col("spelt"))
    rare = (rows.where(F.size("words") > 0)
            .select("rid", F.inline(F.arrays_zip("words", "spelt")))
            # A hash table per partition of distinct words: no sort of the texts' words.
            .join(counts.withColumnRenamed("word", "words").hint("shuffle_hash"), "words", "left")
            .groupBy("rid").agg(
                F.count_if(found > 0).alias("more"), F.sum(F.log10(found + 1)).alias("more_logs"),
                F.sum(ln).alias("more_ln")))
    zero = F.lit(0.0)
    base = F.col("logs") + F.coalesce("more_logs", zero) - F.col("n_tokens") * F.lit(log_total)
    score = (F.col("ln") + F.coalesce("more_ln", zero)) / F.lit(math.log(10))
    return rows.select("rid", "doc_id", "n_tokens", "known", "logs", "ln").join(rare, "rid", "left").select(
        "doc_id", held_out("doc_id").alias("held_out"), "n_tokens",
        (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(model.total).cast("long").alias("train_tokens"), base.alias("base_score"),
        score.alias("score"))
