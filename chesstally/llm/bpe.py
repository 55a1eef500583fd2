"""BPE encoding and decoding with reuse of content-defined chunks.

A text's UTF-8 bytes are cut where a rolling hash of the last bytes hits a pattern, so that equal
passages in different documents are cut alike. A chunk that occurs in more than one distinct text
is encoded once, by its owner (the first text that holds it), and every other text fetches its ids
by a join on the chunk's hash; chunks of one text only are encoded with that text. Chunk joins may
cut a word, so each join is repaired: a window over the join is encoded anew, and it must begin and
end with the tokens that the chunks on both sides gave for their words next to the window; else the
window is widened, at last to the whole pair of chunks.

Equal texts are encoded once: documents map to distinct texts by a 128-bit digest, texts leave the
scan once per task as compressed blobs, and only blobs and ids are shuffled.

The tokenizer must cut at ASCII white space and drop it (as the word BPE files do), so that words
between such white space are encoded alone; ``tests/llm`` holds the result against the encoding of
whole texts.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chesstally.llm.common import materialize, slices

AVERAGE, LEAST, MOST = 512, 128, 4096
_MARK = "\x01"
#: Words of these characters need none of the normalizer's work but lower case, and fall into the
#: pre-tokenizer's pieces by a plain pattern (no apostrophe: it may start a contraction; no "<": it
#: may start a special token).
_PLAIN = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff0-9!-&(-;=-~]+")
_PARTS = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^a-z\u00df-\u00f6\u00f8-\u00ff0-9]+")
#: The normalizer and pre-tokenizer for which that holds.
_KNOWN = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
        {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {
            "Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
         "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
    "post_processor": None,
}
_MEMO, _LONG = 300_000, 256  # words in the memo, bytes of a word in it
_SPACE = b" \t\n\r\x0b\x0c"


def cuts(data: bytes) -> list[int]:
    """End offsets of the content-defined chunks of ``data``; chunks never split a character."""
    n = len(data)
    if n <= LEAST:
        return [n] if n else []
    raw = np.frombuffer(data, np.uint8)
    h = (raw.astype(np.uint32) + np.uint32(1)) * np.uint32(0x9E3779B1)
    step, mult = 1, np.uint32(0x85EBCA6B)
    with np.errstate(over="ignore"):
        while step < 16:  # doubling: a polynomial hash of the last 16 bytes
            h[step:] += h[:-step] * mult
            mult = np.uint32(mult * mult)
            step *= 2
    hit = (h >> np.uint32(32 - AVERAGE.bit_length() + 1)) == 0
    hit[:-1] &= (raw[1:] & 0xC0) != 0x80  # the next byte begins a character
    out, last = [], 0
    for end in (np.flatnonzero(hit) + 1).tolist() + [n]:
        while end - last > MOST:
            at = last + MOST
            while raw[at] & 0xC0 == 0x80:
                at -= 1
            out.append(at)
            last = at
        if end - last >= LEAST or end == n:
            if end > last:
                out.append(end)
            last = end
    return out


class Encoder:
    """Encodes byte pieces word by word; a bounded memo keeps the ids of words seen before."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        os.environ.setdefault("RAYON_NUM_THREADS", "1")
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.memo: dict[bytes, tuple[int, ...]] = {}
        self.names = [self.tok.id_to_token(i) or "" for i in range(self.tok.get_vocab_size(True))]
        shape = json.loads(self.tok.to_str())
        self.plain = all(shape[k] == v for k, v in _KNOWN.items())
        self.model = self.tok.model
        # The byte alphabet of byte-level models: printable bytes stand for themselves.
        kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in kept]
        self.alphabet = {b: chr(b) for b in kept} | {b: chr(256 + i) for i, b in enumerate(rest)}
        self.parts: dict[str, tuple[int, ...]] = {}
        mark = self.tok.encode(_MARK, add_special_tokens=False).ids
        self.mark = mark[0] if len(mark) == 1 else None
        self.digits = [str(i) for i in range(len(self.names))]

    def learn(self, words: set[bytes]) -> None:
        """Put the ids of these words into the memo, in one call of the tokenizer."""
        new = [w for w in words.difference(self.memo) if len(w) <= _LONG]
        if len(self.memo) + len(new) > _MEMO:
            self.memo.clear()
            new = [w for w in words if len(w) <= _LONG]
        for at in range(0, len(new), 4096):
            part = new[at:at + 4096]
            self.memo.update(zip(part, self._coded(part)))

    def get(self, words: list[bytes]) -> list[tuple[int, ...]]:
        """Ids of learnt words; very long ones are never kept."""
        if words and max(map(len, words)) > _LONG:
            return [self.memo[w] if len(w) <= _LONG else self._coded([w])[0] for w in words]
        return list(map(self.memo.__getitem__, words))

    def words(self, piece: bytes) -> list[tuple[int, ...]]:
        """Ids of each word between ASCII white space."""
        words = piece.split()
        self.learn(set(words))
        return self.get(words)

    def _coded(self, words: list[bytes]) -> list[tuple[int, ...]]:
        shown = [w.decode() for w in words]
        if not self.plain:
            return self._whole(shown)
        odd = [w for w in shown if not _PLAIN.fullmatch(w)]
        odd = dict(zip(odd, self._whole(odd))) if odd else {}
        out = []
        for w in shown:
            if w in odd:
                out.append(odd[w])
            else:
                parts = _PARTS.findall(w.lower())
                out.append(self._part(parts[0]) if len(parts) == 1
                           else tuple(chain.from_iterable(map(self._part, parts))))
        return out

    def _part(self, part: str) -> tuple[int, ...]:
        """Ids of one pre-token, kept in a bounded memo of its own."""
        ids = self.parts.get(part)
        if ids is None:
            if len(self.parts) >= _MEMO:
                self.parts.clear()
            text = part if part.isascii() else "".join(map(self.alphabet.__getitem__, part.encode()))
            ids = tuple([t.id for t in self.model.tokenize(text)])
            if len(part) <= _LONG:
                self.parts[part] = ids
        return ids

    def _whole(self, shown: list[str]) -> list[tuple[int, ...]]:
        """Words between marks make one text, which the library encodes faster than a list."""
        if self.mark is not None and len(shown) > 1 and not any(_MARK in w for w in shown):
            ids = self.tok.encode_batch_fast([f" {_MARK} ".join(shown)], add_special_tokens=False)[0].ids
            ends = np.flatnonzero(np.array(ids) == self.mark).tolist()
            if len(ends) == len(shown) - 1:
                return [tuple(ids[a + 1:b]) for a, b in zip([-1, *ends], [*ends, len(ids)])]
        return [tuple(e.ids) for e in self.tok.encode_batch_fast(shown, add_special_tokens=False)]

    def decode(self, ids: list[int]) -> str:
        if self.tok.decoder is None:  # the library joins token strings by spaces
            return " ".join([self.names[i] for i in ids])
        return self.tok.decode(ids, skip_special_tokens=False)

    def digests(self, ids: list[int]) -> tuple[int, str, str]:
        shown = " ".join([self.digits[i] for i in ids]).encode()
        return (len(ids), hashlib.sha256(shown).hexdigest(),
                hashlib.sha256(self.decode(ids).encode()).hexdigest())


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker process and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _edge(piece: bytes, n: int, left: bool) -> int | None:
    """Offset at which the last (``left``) or first ``n`` words of ``piece`` begin or end, at white
    space inside the piece; None if it has fewer words between white space."""
    at = len(piece) if left else 0
    for _ in range(n):
        if left:
            at = max(piece.rfind(c, 0, len(piece[:at].rstrip(_SPACE))) for c in
                     (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c")) + 1
            if at <= 0:
                return None
        else:
            start = at + len(piece[at:]) - len(piece[at:].lstrip(_SPACE))
            ends = [e for e in (piece.find(c, start) for c in
                                (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c")) if e >= 0]
            if not ends:
                return None
            at = min(ends)
    return at


def join_chunks(enc: Encoder, pieces: list[bytes], coded: list[list[tuple[int, ...]]]) -> list[int]:
    """Token ids of the concatenation of ``pieces`` from the ids of each piece's words.

    ``out`` holds words that no later join can change; ``tail`` is the last piece's words."""
    out: list[tuple[int, ...]] = []
    held, tail = pieces[0], coded[0]
    for piece, words in zip(pieces[1:], coded[1:]):
        guard = 2  # one word beside the cut and one beyond it
        while True:
            a, b = _edge(held, guard, True), _edge(piece, guard, False)
            if a is None or b is None:  # too few words on a side: both are one piece from here on
                held, tail = held + piece, None
                break
            if tail is None:
                tail = enc.words(held)
            # Words of the window that lie in either piece; the cut itself may join two of them.
            left, right = held[a:], piece[:b]
            nl, nr = len(left.split()), len(right.split())
            window = enc.words(left + right)
            if (nl > 1 and nr > 1 and window[:1] == tail[-nl:][:1] and window[-1] == words[nr - 1]):
                out += tail[:len(tail) - nl]
                out += window[:-1]
                # The last word of the window stays open for the next join.
                held, tail = right.split()[-1] + piece[b:], words[nr - 1:]
                break
            guard *= 2
    out += enc.words(held) if tail is None else tail
    return list(chain.from_iterable(out))


def encode_text(enc: Encoder, data: bytes, known: dict[int, list[tuple[int, ...]]] | None = None,
                ends: list[int] | None = None) -> list[int]:
    """Ids of a whole text; ``known`` has the words' ids of chunks that are encoded already."""
    ends = cuts(data) if ends is None else ends
    if not ends:
        return []
    pieces = [data[a:b] for a, b in zip([0, *ends], ends)]
    known = known or {}
    split = [p.split() for p in pieces]
    need = set(chain.from_iterable(w for i, w in enumerate(split) if i not in known))
    # Words that the cuts run through; the windows over the joins will ask for them.
    need.update(a[-1] + b[0] for a, b, p, q in zip(split, split[1:], pieces, pieces[1:])
                if a and b and p[-1:] not in _SPACE and q[:1] not in _SPACE)
    enc.learn(need)
    coded = [known[i] if i in known else enc.get(w) for i, w in enumerate(split)]
    return join_chunks(enc, pieces, coded)


def _pack(words: list[tuple[int, ...]]) -> bytes:
    """Words' ids as bytes: number of words, ids per word, ids."""
    counts = np.fromiter(map(len, words), "<u4", len(words))
    ids = np.fromiter(chain.from_iterable(words), "<u4", int(counts.sum()))
    return zstandard.compress(np.array([len(words)], "<u4").tobytes() + counts.tobytes() + ids.tobytes(), 1)


def _unpack(blob: bytes) -> list[tuple[int, ...]]:
    flat = np.frombuffer(zstandard.decompress(blob), "<u4")
    n = int(flat[0])
    ends = np.cumsum(flat[1:n + 1]).tolist()
    ids = flat[n + 1:].tolist()
    return [tuple(ids[a:b]) for a, b in zip([0, *ends], ends)]


_DONE = "rk binary, n_tokens long, ids_sha256 string, decoded_sha256 string, ids array<int>, decoded string"


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                     with_ids: bool = False) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every row's whole text; ``with_ids`` adds
    ``ids array<int>`` and ``decoded``, the decoded text.

    ``path`` is a tokenizers file that every executor has. A null text is the empty text (no
    tokens); repeated rows and ids each give their row; other columns are ignored; an empty table
    gives an empty result.
    """
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def meta(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()  # 16 bytes for each row of this task at most
        for part in slices(batches):
            rks, chunks = [], []
            for t in part.column(1).to_pylist():
                data = (t or "").encode()
                rk = xxhash.xxh3_128_digest(data)
                rks.append(rk)
                if rk in seen:
                    chunks.append(None)
                    continue
                seen.add(rk)
                ends = cuts(data)
                chunks.append([xxhash.xxh3_128_digest(data[a:b]) for a, b in zip([0, *ends], ends)])
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(rks, pa.binary()), pa.array(chunks, pa.list_(pa.binary()))],
                ["doc_id", "rk", "chunks"])

    def blobs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for part in slices(batches):
            rks, texts = [], []
            for t in part.column(1).to_pylist():
                data = (t or "").encode()
                rk = xxhash.xxh3_128_digest(data)
                if rk not in seen:
                    seen.add(rk)
                    rks.append(rk)
                    texts.append(squeeze(data))
            yield pa.RecordBatch.from_arrays([pa.array(rks, pa.binary()), pa.array(texts, pa.binary())],
                                             ["rk", "blob"])

    known = materialize(src.mapInArrow(meta, "doc_id long, rk binary, chunks array<binary>"), "bpe-meta")
    pieces = known.where("chunks is not null").select("rk", F.posexplode("chunks").alias("idx", "hash"))
    # A chunk's owner is one of its texts; should two texts' short digests agree, both encode it.
    short = F.xxhash64("rk")
    # Written, so that the join can split the places of a chunk that very many texts hold.
    shared = materialize(pieces.groupBy("hash").agg(F.min(short).alias("own"), F.max(short).alias("end"))
                         .where("own != end").select("hash", "own"), "bpe-shared")
    # Where each text meets shared chunks; the owner encodes and publishes.
    refs = (pieces.join(shared, "hash")
            .select("rk", F.struct("idx", "hash", (short == F.col("own")).alias("own")).alias("ref"))
            .groupBy("rk").agg(F.collect_set("ref").alias("refs")))

    def result(rk: bytes, enc: Encoder, ids: list[int]) -> dict:
        n, a, b = enc.digests(ids)
        return {"rk": rk, "n_tokens": n, "ids_sha256": a, "decoded_sha256": b,
                "ids": ids if with_ids else None, "decoded": enc.decode(ids) if with_ids else None}

    fields = [("rk", pa.binary()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
              ("decoded_sha256", pa.string()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())]

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Texts without foreign chunks are done; owners publish chunks; other texts are handed on."""
        enc, last = encoder(path), None
        unzip = zstandard.ZstdDecompressor().decompress
        schema = pa.schema([*fields, ("hash", pa.binary()), ("words", pa.binary()), ("blob", pa.binary())])
        for part in slices(batches, 64):
            rows = []
            for rk, blob, refs in zip(*(part.column(i).to_pylist() for i in range(3))):
                if rk == last:  # the same text from another task
                    continue
                last, data = rk, unzip(blob)
                ends = cuts(data)
                own = {r["idx"]: r["hash"] for r in refs or () if r["own"]}
                foreign = any(not r["own"] for r in refs or ())
                coded = {i: enc.words(data[ends[i - 1] if i else 0:ends[i]]) for i in own}
                rows += [{"hash": h, "words": _pack(coded[i])}
                         for h, i in {h: i for i, h in own.items()}.items()]
                rows.append({"rk": rk, "blob": blob} if foreign
                            else result(rk, enc, encode_text(enc, data, coded, ends)))
            yield pa.RecordBatch.from_pylist(rows, schema)

    texts = src.mapInArrow(blobs, "rk binary, blob binary")
    stage = materialize(texts.join(refs, "rk", "left").select("rk", "blob", "refs")
                        .mapInArrow(first, _DONE + ", hash binary, words binary, blob binary"), "bpe-first")
    book = materialize(stage.where("hash is not null").select("hash", "words").dropDuplicates(["hash"]),
                       "bpe-book")
    waiting = stage.where("blob is not null").select("rk", "blob")
    fetched = (refs.join(waiting.select("rk"), "rk", "left_semi").select("rk", F.inline("refs"))
               .select("rk", "idx", "hash").join(book, "hash")
               .groupBy("rk").agg(F.collect_list(F.struct("idx", "words")).alias("got")))

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, last = encoder(path), None
        unzip = zstandard.ZstdDecompressor().decompress
        for part in slices(batches, 64):
            rows = []
            for rk, blob, got in zip(*(part.column(i).to_pylist() for i in range(3))):
                if rk != last:
                    last = rk
                    coded = {g["idx"]: _unpack(g["words"]) for g in got}
                    rows.append(result(rk, enc, encode_text(enc, unzip(blob), coded)))
            yield pa.RecordBatch.from_pylist(rows, pa.schema(fields))

    late = waiting.join(fetched, "rk").select("rk", "blob", "got").mapInArrow(second, _DONE)
    cols = ["rk", "n_tokens", "ids_sha256", "decoded_sha256", *(("ids", "decoded") if with_ids else ())]
    # Written, so that the join below can split the rows of a text with very many copies.
    done = materialize(stage.where("n_tokens is not null").select(*cols).union(late.select(*cols))
                       .dropDuplicates(["rk"]), "bpe-done")
    return known.select("doc_id", "rk").join(done, "rk").select("doc_id", *cols[1:])


def decode_documents(coded: DataFrame, path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``coded`` with the decoded text of its id lists (null ids: null)."""

    @F.pandas_udf("string")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = encoder(path)
        for lists in batches:
            yield lists.map(lambda ids: None if ids is None else enc.decode([int(i) for i in ids]))

    return coded.withColumn(out_col, decode(F.col(ids_col)))
