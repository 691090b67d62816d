"""Byte-level BPE: merges replayed over a corpus, and decoding.

Texts are split by the tokenizer's pattern.  The different pieces of a block of texts are laid out
side by side; an inverted index leads from the rank of a pair of neighbouring tokens to the
positions where the pair stands.  Ranks are taken from the smallest up: all positions of a pair
are merged at once, and only their neighbours get new pairs.  A piece that is known from an earlier
block of the same task is looked up.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from array import array
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import column, in_tasks, raw_texts, slices, with_row

#: Bytes of text whose new pieces are merged together, and pieces that a task remembers.
BLOCK_BYTES, REMEMBERED = 2 << 20, 250_000
#: Above all ranks; positions and ranks take four bytes, as a block's pieces are far fewer bytes.
NONE = np.int32(2**31 - 1)
#: The pattern that ``Vocabulary.split`` knows, and its contractions.
COMMON_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CONTRACTION = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d")
OTHER, LETTER, NUMBER, SPACE = range(4)


@lru_cache(1)
def character_classes() -> np.ndarray:
    """Of every code point: letter, number, white space or other."""
    points = [k for k in range(0x110000) if not 0xD800 <= k < 0xE000]
    every = "".join(map(chr, points))
    out = np.full(0x110000, OTHER, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\p{White_Space}")):
        out[[ord(c) for c in regex.findall(pattern, every)]] = kind
    return out


class Vocabulary:
    """Token bytes by id, and the id that each pair of tokens merges to; an id is also its merge's rank."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks, self.pattern = ranks, pattern
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"the vocabulary has no token for the bytes {missing}")
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = rank
        keys = np.fromiter(pairs.keys(), np.int64, len(pairs))
        order = np.argsort(keys)
        self.keys = np.concatenate((keys[order], [np.int64(2**62)]))
        self.merged = np.concatenate((np.fromiter(pairs.values(), np.int32, len(pairs))[order], [NONE]))
        self.byte_pairs = self.pair_ranks(np.repeat(self.byte_ids, 256), np.tile(self.byte_ids, 256)).reshape(256, 256)
        #: Tokens with which a pair merges to a smaller rank than their own; their merges are done one a piece.
        self.out_of_order = {t for key, rank in pairs.items() for t in (key >> 32, key & 0xFFFFFFFF) if t > rank}

        self.classes = character_classes() if pattern == COMMON_PATTERN else None

    def split(self, text: str) -> list[str]:
        """The matches of ``COMMON_PATTERN``, by classes of characters in place of a regular expression."""
        points = np.frombuffer(text.encode("utf-32-le"), "<u4")
        n = len(points)
        if not n:
            return []
        kind = self.classes[points]
        starts = np.ones(n + 1, bool)
        starts[1:n] = kind[1:] != kind[:-1]
        # The last of several white spaces stands alone before other characters, or, if a space, leads them.
        after_space = np.flatnonzero(starts[1:n] & (kind[:-1] == SPACE)) + 1
        starts[after_space - 1] = True
        starts[after_space] = points[after_space - 1] != 0x20
        if "'" in text:
            for q in np.flatnonzero((points[:-1] == 0x27) & starts[: n - 1] & (kind[1:] == LETTER)).tolist():
                if m := CONTRACTION.match(text, q):
                    starts[q + 1] = False
                    starts[m.end()] = True
        at = np.flatnonzero(starts).tolist()
        return [text[a:b] for a, b in zip(at, at[1:], strict=False)]

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.merged[at], NONE)

    def replay(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of the pieces (none empty) side by side, and where each piece's tokens end.

        The pair with the smallest rank merges first, the leftmost of equal ones.
        """
        if not pieces:
            return np.empty(0, np.int32), np.empty(0, np.int64)
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        raw = np.frombuffer(b"".join(pieces), np.uint8)
        tokens, n = self.byte_ids[raw], len(raw)
        starts = np.cumsum(sizes) - sizes
        # Position n stands for "no neighbour".
        after, before = np.arange(1, n + 2, dtype=np.int32), np.arange(-1, n, dtype=np.int32)
        after[starts[1:] - 1] = n
        after[n - 1] = n
        before[starts] = n
        rank = np.full(n + 1, NONE)
        alive = np.ones(n + 1, bool)
        inner = np.flatnonzero(after[:n] < n).astype(np.int32)
        rank[inner] = self.byte_pairs[raw[inner], raw[inner + 1]]
        tokens = np.concatenate((tokens, np.zeros(1, np.int32)))
        index: dict[int, list[np.ndarray]] = {}
        todo: list[int] = []

        def add(positions: np.ndarray) -> None:
            found = rank[positions]
            some = found < NONE
            positions, found = positions[some], found[some]
            order = np.argsort(found, kind="stable")
            positions, found = positions[order], found[order]
            ends = np.append(np.flatnonzero(np.diff(found)) + 1, len(found)).tolist()
            start = 0
            for r, end in zip(found[np.array(ends) - 1].tolist() if len(found) else (), ends, strict=False):
                if r not in index:
                    index[r] = []
                    heapq.heappush(todo, r)
                index[r].append(positions[start:end])
                start = end

        add(inner)
        while todo:
            r = heapq.heappop(todo)
            groups = index.pop(r)
            at = np.sort(np.concatenate(groups), kind="stable") if len(groups) > 1 else groups[0]
            at = at[rank[at] == r]
            if not len(at):
                continue
            at = at[np.concatenate(([True], at[1:] != at[:-1]))]
            if r in self.out_of_order:
                piece = np.searchsorted(starts, at, side="right")
                leftmost = np.concatenate(([True], np.diff(piece) > 0))
                at, later = at[leftmost], at[~leftmost]
            else:
                # In a run of overlapping pairs every other one merges, from the left.
                run = np.concatenate(([True], after[at[:-1]] != at[1:]))
                odd = (np.arange(len(at)) - np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))) % 2
                at, later = at[odd == 0], at[:0]
            gone = after[at]
            tokens[at] = r
            following = after[gone]
            after[at] = following
            before[following] = at
            rank[gone] = NONE
            alive[gone] = False
            left = before[at]
            left = left[left < n]
            touched = np.concatenate((at, left))
            nexts = after[touched]
            rank[touched] = np.where(nexts < n, self.pair_ranks(tokens[touched], tokens[nexts]), NONE)
            add(np.concatenate((touched, later)) if len(later) else touched)
        kept = np.flatnonzero(alive[:n])
        return tokens[kept], np.append(np.searchsorted(kept, starts)[1:], len(kept))


class Encoder:
    """Encodes texts with a bounded memory of pieces."""

    def __init__(self, vocabulary: Vocabulary, kind: str) -> None:
        self.vocabulary, self.kind = vocabulary, kind
        classed = vocabulary.classes is not None
        self.split = vocabulary.split if classed else regex.compile(vocabulary.pattern).findall
        self._forget()

    def _forget(self) -> None:
        self.numbers: defaultdict[str, int] = defaultdict()
        self.numbers.default_factory = self.numbers.__len__
        # The ids of all known pieces side by side, and where each piece's end.
        self.ids, self.ends = bytearray(), array("q", [0])

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text, as little-endian integers side by side."""
        if len(self.numbers) > REMEMBERED:
            self._forget()
        number = self.numbers.__getitem__
        coded = [array("I", map(number, self.split(t))) for t in texts]
        new = [p.encode() for p in islice(self.numbers, len(self.ends) - 1, None)]
        whole = [self.vocabulary.ranks.get(p) for p in new]  # a piece that is a token needs no merge
        tokens, ends = self.vocabulary.replay([p for p, w in zip(new, whole, strict=True) if w is None])
        size = np.dtype(self.kind).itemsize
        flat, end, start = memoryview(tokens.astype(self.kind).tobytes()), iter((ends * size).tolist()), 0
        for w in whole:
            if w is None:
                stop = next(end)
                self.ids += flat[start:stop]
                start = stop
            else:
                self.ids += w.to_bytes(size, "little")
            self.ends.append(len(self.ids))
        known, ends = np.frombuffer(bytes(self.ids), self.kind), np.frombuffer(self.ends, np.int64) // size
        return (self._joined(known, ends, np.frombuffer(pieces, np.uint32)) for pieces in coded)

    @staticmethod
    def _joined(known: np.ndarray, ends: np.ndarray, pieces: np.ndarray) -> bytes:
        """The ids of pieces, gathered from those of all known pieces."""
        first, sizes = ends[pieces], ends[pieces + 1] - ends[pieces]
        place = np.cumsum(sizes)
        return known[np.arange(place[-1] if len(place) else 0) + np.repeat(first - place + sizes, sizes)].tobytes()


def load(spark: SparkSession, path: str, pattern: str) -> Broadcast:
    """A rank file (a token in base64 and its rank, a line) for the tasks; such files are a few MB."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
    return spark.sparkContext.broadcast(Vocabulary(ranks, pattern))


def _decode(text: bytes | None) -> str:
    return (text or b"").decode("utf-8", "replace")


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """The batches in parts of about ``BLOCK_BYTES`` of text, a row at least."""
    for batch in slices(batches, BLOCK_BYTES):
        yield batch, [_decode(t) for t in raw_texts(batch)]


def encoded(docs: DataFrame, vocabulary: Broadcast, text_column: str = "text", bytes_per_id: int = 4) -> DataFrame:
    """Every row of ``docs`` as ``row`` (a struct of the columns but the text), with ``ids``: the
    tokens of the whole text as little-endian unsigned integers of 4 or 2 bytes.

    A null or empty text has no ids; bytes that are not UTF-8 are read as U+FFFD.  Special
    tokens in a text are ordinary text.  Nothing is shuffled.
    """
    kind = {4: "<u4", 2: "<u2"}[bytes_per_id]
    rows = docs.select(
        F.struct(*[column(c) for c in docs.columns if c != text_column]).alias("row"), column(text_column).alias("text")
    )
    return in_tasks(rows, _encoder(vocabulary, kind), with_row(rows, "ids binary"))


def _encoder(vocabulary: Broadcast, kind: str) -> Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        if len(vocabulary.value.tokens) > 1 << 8 * np.dtype(kind).itemsize:
            raise ValueError(f"the vocabulary's ids need more than {np.dtype(kind).itemsize} bytes")
        encoder = Encoder(vocabulary.value, kind)
        for batch, texts in _parts(batches):
            ids = pa.array(list(encoder.encode(texts)), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("row"), ids], ["row", "ids"])

    return run


def decode(ids: bytes | None, tokens: list[bytes]) -> bytes:
    """The bytes of little-endian unsigned 32-bit ids."""
    return b"".join(map(tokens.__getitem__, np.frombuffer(ids or b"", "<u4").tolist()))


def decoded(rows: DataFrame, vocabulary: Broadcast) -> DataFrame:
    """``row`` and ``ids`` as ``encoded`` makes them, with the ``text`` that the ids stand for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        tokens = vocabulary.value.tokens
        for batch in slices(batches, BLOCK_BYTES, "ids"):
            texts = [_decode(decode(x, tokens)) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("ids"), pa.array(texts, pa.string())], ["row", "ids", "text"])

    return in_tasks(rows.select("row", "ids"), run, with_row(rows, "ids binary, text string"))


def digests(
    docs: DataFrame, vocabulary: Broadcast, id_column: str = "doc_id", text_column: str = "text", with_ids: bool = False
) -> DataFrame:
    """One row per document: ``doc_id``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` (of the bytes that the ids
    decode to) and, if asked for, ``ids`` as ``encoded`` gives them."""
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        encoder, tokens = Encoder(vocabulary.value, "<u4"), vocabulary.value.tokens
        sha = lambda raw: hashlib.sha256(raw).hexdigest()
        for batch, texts in _parts(batches):
            ids = list(encoder.encode(texts))
            columns = {
                "doc_id": batch.column("doc_id"),
                "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()),
                "ids_sha256": pa.array(list(map(sha, ids)), pa.string()),
                "decoded_sha256": pa.array([sha(decode(x, tokens)) for x in ids], pa.string()),
            }
            if with_ids:
                columns["ids"] = pa.array(ids, pa.binary())
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    rows = docs.select(column(id_column).alias("doc_id"), column(text_column).alias("text"))
    schema = f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids binary" * with_ids
    return in_tasks(rows, run, schema)
