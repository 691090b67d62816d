"""Filter interaction audit: what each quality filter removes, alone and after others, in every order.

The facts that the filters need come from one pass of a table-driven transducer over the bytes of a
block of texts.  Its state (outside or inside a word) and the class of the next byte select a row
of ``EMIT``: whether a word starts or ends there, and whether the byte is a capital, a symbol or the first of a
code point.  Every class leads to one state whatever the state before, so all steps of the automaton
are looked up at once.  The words' spans go into an open-addressing hash table as they come;
an entry that is met is compared byte by byte before a word counts as known.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping
from itertools import permutations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import column, in_tasks, raw_texts, slices, work_dir, written

#: The filters in their own order, and the limits of the first three.
FILTERS = "ABCDE"
MIN_WORDS, MIN_DISTINCT_PERCENT, MAX_CAPITAL_PERCENT = 100, 80, 10
#: Bytes of text that one pass takes, a whole text at least.
BLOCK_BYTES = 1 << 20
#: A word of more bytes than this is hashed by itself.
LONG_WORD = 64

BLANK, CAPITAL, SYMBOL, PLAIN, INNER = range(5)
OUTSIDE, INSIDE = range(2)
STARTS, ENDS, IS_CAPITAL, IS_SYMBOL, IS_POINT = 1, 2, 4, 8, 16


def _classes() -> np.ndarray:
    """The class of every byte; ``INNER`` are the bytes of a code point after its first."""
    out = np.full(256, PLAIN, np.uint8)
    out[0x80:0xC0] = INNER
    out[0x41:0x5B] = CAPITAL
    out[list(b"#$%&*|")] = SYMBOL
    out[[0x20, *range(0x09, 0x0E)]] = BLANK
    return out


def _emissions() -> np.ndarray:
    """What is counted, by state and class."""
    out = np.zeros((2, 5), np.uint8)
    out[OUTSIDE, [CAPITAL, SYMBOL, PLAIN, INNER]] |= STARTS
    out[INSIDE, BLANK] |= ENDS
    out[:, CAPITAL] |= IS_CAPITAL
    out[:, SYMBOL] |= IS_SYMBOL
    out[:, [BLANK, CAPITAL, SYMBOL, PLAIN]] |= IS_POINT
    return out


CLASS, EMIT = _classes(), _emissions()
#: The state that a class leads to.
NEXT = np.array([OUTSIDE, INSIDE, INSIDE, INSIDE, INSIDE], np.uint8)
#: Masks of the lowest 0 to 8 bytes of a number.
LOW = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * MIX
    return x ^ (x >> np.uint64(32))


class Spans:
    """Word spans of a block, as numbers of 8 bytes at a time."""

    def __init__(self, raw: bytes, starts: np.ndarray, ends: np.ndarray, docs: np.ndarray) -> None:
        self.raw, self.starts, self.sizes, self.docs = raw, starts, ends - starts, docs
        self.eights = np.ndarray((len(raw) - 7,), "<u8", raw, 0, (1,))
        self.first = self.chunk(np.arange(len(starts)), 0)
        self.hashes = _mixed(_mixed(self.first ^ (docs.astype(np.uint64) * MIX)) ^ self.sizes.astype(np.uint64))
        more, at = np.flatnonzero((self.sizes > 8) & (self.sizes <= LONG_WORD)), 8
        while len(more):
            self.hashes[more] = _mixed(self.hashes[more] ^ self.chunk(more, at))
            at += 8
            more = more[self.sizes[more] > at]
        for k in np.flatnonzero(self.sizes > LONG_WORD).tolist():
            self.hashes[k] ^= np.uint64(xxhash.xxh64_intdigest(self.word(k)))

    def chunk(self, words: np.ndarray, at: int) -> np.ndarray:
        """The bytes of the words from ``at`` on, up to eight."""
        return self.eights[self.starts[words] + at] & LOW[np.minimum(self.sizes[words] - at, 8)]

    def word(self, k: int) -> memoryview:
        start = int(self.starts[k])
        return memoryview(self.raw)[start : start + int(self.sizes[k])]

    def equal(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the words ``a`` and ``b`` are of one document and equal in every byte."""
        out = (self.docs[a] == self.docs[b]) & (self.sizes[a] == self.sizes[b]) & (self.first[a] == self.first[b])
        long = self.sizes[a] > LONG_WORD
        more, at = np.flatnonzero(out & ~long & (self.sizes[a] > 8)), 8
        while len(more):
            out[more] = self.chunk(a[more], at) == self.chunk(b[more], at)
            at += 8
            more = more[out[more] & (self.sizes[a[more]] > at)]
        for k in np.flatnonzero(out & long).tolist():
            out[k] = self.word(int(a[k])) == self.word(int(b[k]))
        return out

    def distinct(self) -> np.ndarray:
        """The words that are the first to take a place in the table: one of each in a document."""
        n = len(self.starts)
        capacity = 1 << max(4, (2 * n).bit_length())
        table, mask = np.full(capacity, -1, np.int64), np.uint64(capacity - 1)
        left, place = np.arange(n), self.hashes & mask
        while len(left):
            free = table[place] < 0
            table[place[free]] = left[free]
            held = table[place]
            known = held == left
            check = np.flatnonzero(~known)
            known[check] = self.equal(left[check], held[check])
            left, place = left[~known], (place[~known] + np.uint64(1)) & mask
        return table[table >= 0]


def counted(texts: list[bytes | None]) -> dict[str, np.ndarray]:
    """``words``, ``distinct`` words, ``capitals``, ``symbols`` and code ``points`` of every text.

    A word is a run of bytes without the blanks U+0020 and U+0009 to U+000D.  Null counts as empty.
    """
    sizes = np.fromiter((len(t or b"") + 1 for t in texts), np.int64, len(texts))
    raw = b" ".join([*(t or b"" for t in texts), bytes(8)])  # a blank ends each text; eight bytes more can be read
    heads, n = np.cumsum(sizes) - sizes, int(sizes.sum())
    kind = CLASS[np.frombuffer(raw, np.uint8, n)]
    state = np.empty(n, np.uint8)
    state[0], state[1:] = OUTSIDE, NEXT[kind[:-1]]
    out = EMIT[state, kind]
    starts, ends = np.flatnonzero(out & STARTS), np.flatnonzero(out & ENDS)
    docs = np.searchsorted(heads, starts, side="right") - 1
    total = lambda bit: np.add.reduceat((out & bit) != 0, heads, dtype=np.int64)
    return {
        "words": np.bincount(docs, minlength=len(texts)),
        "distinct": np.bincount(docs[Spans(raw, starts, ends, docs).distinct()], minlength=len(texts)),
        "capitals": total(IS_CAPITAL),
        "symbols": total(IS_SYMBOL),
        "points": total(IS_POINT) - 1,
    }


def failures(texts: list[bytes | None]) -> np.ndarray:
    """The filters A to D that each text fails, as bits."""
    if not texts:
        return np.empty(0, np.int32)
    c = counted(texts)
    fails = [
        c["words"] < MIN_WORDS,
        100 * c["distinct"] < MIN_DISTINCT_PERCENT * c["words"],
        100 * c["capitals"] > MAX_CAPITAL_PERCENT * c["points"],
        c["symbols"] > 0,
    ]
    return sum(f.astype(np.int32) << k for k, f in enumerate(fails))


def judged(docs: DataFrame, part: str = "lang") -> DataFrame:
    """One row per document: ``doc_id``, ``part``, ``fails`` (filters A to E as bits 0 to 4).

    A null text is an empty one, a null part an empty string.  Filter E is failed by a text that
    equals the text of a smaller id anywhere in the table; a null id is neither smaller nor larger, and rows that
    repeat an id are no copies of each other.  Equality is that of SHA-256.  Other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in slices(batches, BLOCK_BYTES):
            bits = pa.array(failures(raw_texts(batch)), pa.int32())
            yield pa.RecordBatch.from_arrays([*map(batch.column, ("doc_id", "part", "digest")), bits], ["doc_id", "part", "digest", "fails"])

    text = F.coalesce(column("text").cast("string"), F.lit(""))
    rows = docs.select(
        column("doc_id").alias("doc_id"),
        F.coalesce(column(part).cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
        text.alias("text"),
    )
    kind = docs.schema["doc_id"].dataType.simpleString()
    path = work_dir(docs.sparkSession, "filters")
    rows = written(in_tasks(rows, run, f"doc_id {kind}, part string, digest binary, fails int"), f"{path}/judged")
    # The first of each text is found by its own id, so the copies of one text don't meet.
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    rows = rows.join(first, ["doc_id", "digest"], "left")
    copy = F.col("first").isNull() & F.col("doc_id").isNotNull()
    return rows.select("doc_id", "part", F.col("fails").bitwiseOR(F.when(copy, 1 << FILTERS.index("E")).otherwise(0)).alias("fails"))


def _bits(letters: Column) -> Column:
    """The bits of the filters that a string names."""
    return sum((F.contains(letters, F.lit(x)).cast("int") * (1 << k) for k, x in enumerate(FILTERS)), F.lit(0))


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """One row per part, order of the filters (``filter_order``) and ``step`` in it, zeros included.

    ``kept``: documents left after the step; ``removed``: those that its filter removes;
    ``redundant``: those that fail its filter and were removed before; ``unique_fails``: those that fail no other
    filter; ``good_lost`` and ``toxic_lost``: the removed that ``labels`` (``doc_id``, ``quality``, ``toxic``) calls good or
    toxic; ``shapley``: what the filter removes, summed over all orders.  A document with several labels is good, or
    toxic, if one of them says so; without a label or an id it is neither.  An empty table has no parts and gives no row.

    Documents are first counted by part, failed filters and labels; only these counts, at most 128 a part, meet the orders.
    """
    marks = labels.where(column("doc_id").isNotNull()).groupBy(column("doc_id").alias("doc_id"))
    marks = marks.agg(F.max(column("quality") == 1).alias("good"), F.max(column("toxic") == 1).alias("toxic"))
    yes = lambda c: F.coalesce(F.col(c), F.lit(False)).alias(c)
    rows = judged(docs, part).join(marks, "doc_id", "left").select("part", "fails", yes("good"), yes("toxic"))
    cells = rows.groupBy("part", "fails", "good", "toxic").agg(F.count("*").alias("n"))
    orders = F.array(*[F.lit("".join(p)) for p in permutations(FILTERS)])
    cells = cells.withColumn("filter_order", F.explode(orders))
    cells = cells.withColumn("step", F.explode(F.array(*[F.lit(k + 1) for k in range(len(FILTERS))])))
    fails, own = F.col("fails"), _bits(F.substr("filter_order", F.col("step"), F.lit(1)))
    before = _bits(F.substr("filter_order", F.lit(1), F.col("step") - 1))
    cells = cells.select("*", (fails.bitwiseAND(own) != 0).alias("own"), (fails.bitwiseAND(before) != 0).alias("gone"), (fails == own).alias("alone"))
    here = F.col("own") & ~F.col("gone")
    share = (F.col("n") * 120 / F.bit_count("fails")).cast("long")  # of k failed filters, each comes first in a kth of all orders
    counts: Mapping[str, tuple[Column, Column]] = {
        "kept": (~F.col("own") & ~F.col("gone"), F.col("n")),
        "removed": (here, F.col("n")),
        "redundant": (F.col("own") & F.col("gone"), F.col("n")),
        "unique_fails": (F.col("alone"), F.col("n")),
        "good_lost": (here & F.col("good"), F.col("n")),
        "toxic_lost": (here & F.col("toxic"), F.col("n")),
        "shapley": (F.col("own"), share),
    }
    sums = [F.sum(F.when(when, n).otherwise(F.lit(0))).cast("long").alias(c) for c, (when, n) in counts.items()]
    return cells.groupBy("part", "filter_order", "step").agg(*sums)
