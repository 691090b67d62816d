"""Runs: stretches of words that repeat with a period at least four times over.

A block of texts becomes one sequence of numbers, equal for equal words of one text.  Ranks of all
substrings of 2, 4, 8, ... words are refined from each other until the suffix array is complete; at every length, the
words that start with a block of that length hold one interval of it.  For the aligned (dyadic) blocks of ``m`` words,
the occurrences in the neighbouring windows, up to ``m`` words to either side, are asked of a wavelet tree over the suffix array
(range successor and predecessor).  As a block of ``m`` words occurs in so short a window at the
distances of an arithmetic progression, its first one is the candidate period.

No run is missed.  A run of period ``q`` has a length ``m``, a power of two, with ``q <= m < 2q`` (2 for ``q`` 1).  It has at least
``max(6, 4q)`` words, and ``4q > 2m - 1`` of them hold an aligned block; of ``m + 2q - 1`` or more, the same block ``q`` words
on or back lies in the run as well, and none lies nearer, as ``q`` is the smallest period and ``m >= q``.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import column, in_tasks, raw_texts, slices

#: A run has this many words at least, and its period this many times.
LEAST_WORDS, LEAST_TIMES = 6, 4
#: Bytes of text that are searched together, a whole text at least.
BLOCK_BYTES = 1 << 20


class WaveletTree:
    """The positions of a suffix array, by bits from the highest: how many of a prefix of the array have a zero there."""

    def __init__(self, values: np.ndarray, bits: int) -> None:
        self.bits, self.zeros = bits, []
        for bit in range(bits - 1, -1, -1):
            is_zero = (values >> bit & 1) == 0
            self.zeros.append(np.concatenate(([0], np.cumsum(is_zero))))
            values = np.concatenate((values[is_zero], values[~is_zero]))

    def below(self, low: np.ndarray, high: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many values of each interval [low, high) are under its bound."""
        out = np.zeros(len(low), np.int64)
        beyond = bound >> self.bits > 0
        out[beyond] = (high - low)[beyond]
        for k, zeros in enumerate(self.zeros):
            one = bound >> (self.bits - 1 - k) & 1 == 1
            a, b = zeros[low], zeros[high]
            out += np.where(one & ~beyond, b - a, 0)
            low, high = np.where(one, zeros[-1] + low - a, a), np.where(one, zeros[-1] + high - b, b)
        return out

    def smallest(self, low: np.ndarray, high: np.ndarray, order: np.ndarray) -> np.ndarray:
        """The value of each interval that has so many smaller ones; there must be one."""
        out = np.zeros(len(low), np.int64)
        for k, zeros in enumerate(self.zeros):
            a, b = zeros[low], zeros[high]
            one = order >= b - a
            order = np.where(one, order - (b - a), order)
            out |= one.astype(np.int64) << (self.bits - 1 - k)
            low, high = np.where(one, zeros[-1] + low - a, a), np.where(one, zeros[-1] + high - b, b)
        return out

    def neighbours(self, low: np.ndarray, high: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values of each interval next above and next below ``at``, which the interval holds; -1 for none."""
        smaller = self.below(low, high, at)
        out = []
        for there, order in ((smaller + 1 < high - low, smaller + 1), (smaller > 0, smaller - 1)):
            found = np.full(len(at), -1, np.int64)
            found[there] = self.smallest(low[there], high[there], order[there])
            out.append(found)
        return out[0], out[1]


def _ranked(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every key, how many keys are smaller and how many are equal."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    first = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    sizes = np.diff(np.append(first, len(keys)))
    rank, equal = np.empty(len(keys), np.int64), np.empty(len(keys), np.int64)
    rank[order], equal[order] = np.repeat(first, sizes), np.repeat(sizes, sizes)
    return rank, equal


def candidates(sequence: np.ndarray, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions and candidate periods in texts that start at ``heads`` and share no number.

    The text numbered first has the smallest numbers, and so on, so that suffixes of one text are neighbours.
    """
    n = len(sequence)
    sizes = np.diff(np.append(heads, n))
    text = np.repeat(np.arange(len(heads)), sizes)
    local, end = np.arange(n) - heads[text], (heads + sizes)[text]
    rank, equal = _ranked(sequence)
    asked: list[tuple[np.ndarray, np.ndarray, np.ndarray, int]] = []
    length = 1
    while (equal > 1).any():
        # Ranks of twice the length; where a rank is shared by no other it is final.
        open_ = np.flatnonzero(equal > 1)
        further = open_ + length
        inside = further < end[open_]
        behind = np.where(inside, rank[np.minimum(further, n - 1)] + 1, 0)
        refined, left = _ranked(rank[open_] * (n + 1) + behind)
        # The open ones of a smaller rank are as many as all of a smaller rank, less the final ones.
        first_open, _ = _ranked(rank[open_])
        rank[open_] += refined - first_open
        equal[open_] = left
        length *= 2
        at = open_[(left > 1) & (local[open_] % length == 0) & (open_ + length <= end[open_])]
        if len(at):
            asked.append((at, rank[at], rank[at] + equal[at], length))
    suffixes = np.empty(n, np.int64)
    suffixes[rank] = local
    if not asked:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    tree = WaveletTree(suffixes, max(1, int(sizes.max() - 1).bit_length()))
    at, low, high = (np.concatenate([x[k] for x in asked]) for k in range(3))
    window = np.repeat([m for *_, m in asked], [len(x[0]) for x in asked])
    after, before = tree.neighbours(low, high, local[at])
    found, periods = [], []
    for near, distance in ((after, after - local[at]), (before, local[at] - before)):
        hit = (near >= 0) & (distance <= window)
        found.append(np.minimum(at, heads[text[at]] + near)[hit])
        periods.append(distance[hit])
    return np.concatenate(found), np.concatenate(periods)


def numbered(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """The words of the texts as numbers, larger from text to text, and where each text starts."""
    out, used = [], 0
    for words in texts:
        numbers: defaultdict[bytes, int] = defaultdict()
        numbers.default_factory = lambda n=numbers, u=used: u + len(n)
        out.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
        used += len(numbers)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    return np.concatenate(out) if out else np.empty(0, np.int64), np.cumsum(sizes) - sizes


def maximal_runs(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """``(start, length, period)`` of every run of each text, by start and period."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    some = [k for k, t in enumerate(texts) if len(t) >= LEAST_WORDS]
    sequence, heads = numbered([texts[k] for k in some])
    if not some:
        return out
    at, periods = candidates(sequence, heads)
    text = np.searchsorted(heads, at, side="right") - 1
    found = sorted(set(zip(text.tolist(), periods.tolist(), at.tolist(), strict=True)))
    ends = np.append(heads[1:], len(sequence))
    for (t, q), places in groupby(found, key=lambda x: x[:2]):
        own = sequence[heads[t] : ends[t]]
        # Where a word differs from the one a period later; a run lies between two such places.
        breaks = np.concatenate(([-1], np.flatnonzero(own[:-q] != own[q:]), [len(own) - q]))
        k = np.unique(np.searchsorted(breaks, np.array([p - heads[t] for *_, p in places]), side="left"))
        starts, lengths = breaks[k - 1] + 1, breaks[k] - breaks[k - 1] - 1 + q
        out[some[t]] += [(s, n, q) for s, n in zip(starts.tolist(), lengths.tolist(), strict=True) if n >= max(LEAST_WORDS, LEAST_TIMES * q)]
    return [sorted(set(x), key=lambda r: (r[0], r[2])) for x in out]


def greatest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the most periods; of equal ones the first, then the one of the smallest period."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by single blanks, without what follows the first period of any run."""
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    if runs:
        words = [w for w, g in zip(words, np.cumsum(gone[:-1]).tolist(), strict=True) if not g]
    return b" ".join(words)


def words_of(text: bytes | None) -> list[bytes]:
    """Runs of characters other than U+0020 and U+0009 to U+000D."""
    return (text or b"").split()


def repeating_tail(words: list[bytes], draw: int) -> list[bytes]:
    """Words whose tail repeats itself: from ``a`` on, every word is one of the first ``p`` there (``a`` and ``p`` follow from ``draw``)."""
    n = len(words)
    if not n:
        return words
    a = draw % n
    p = 1 + (n - a) // (3 + draw % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]


def periodic_runs(docs: DataFrame, seed: Column | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``n_runs``; ``start``, ``length``, ``period``, ``exponent_milli`` of the greatest
    run (null without one); ``runs_sha256`` of all runs, ``collapsed_sha256`` of the text without repetitions; ``collapsed``, that
    text, and ``runs``, all runs.

    Words are runs of characters other than blanks (U+0020, U+0009 to U+000D); null has none.  Every row gives a row,
    repeated rows and null ids too; other columns are ignored.  Texts are whole; nothing is shuffled.  Where ``seed`` (a long)
    is not null, the text's tail is made to repeat first (``repeating_tail``): a check of what the search finds.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    best_columns = ("start", "length", "period", "exponent_milli")
    schema = f"doc_id {kind}, n_runs bigint, {', '.join(f'{c} bigint' for c in best_columns)}, runs_sha256 string, collapsed_sha256 string"
    sha = lambda raw: hashlib.sha256(raw).hexdigest()
    as_struct = pa.list_(pa.struct([(c, pa.int64()) for c in best_columns[:3]]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in slices(batches, BLOCK_BYTES):
            texts = [words_of(t) for t in raw_texts(batch)]
            texts = [w if s is None else repeating_tail(w, s) for w, s in zip(texts, batch.column("seed").to_pylist(), strict=True)]
            found = maximal_runs(texts)
            best = [greatest(r) for r in found]
            short = [collapsed(w, r) for w, r in zip(texts, found, strict=True)]
            listed = [[dict(zip(best_columns, r, strict=False)) for r in of] for of in found]
            columns = [
                batch.column("doc_id"),
                pa.array(list(map(len, found)), pa.int64()),
                *(pa.array([b and b[k] for b in best], pa.int64()) for k in range(3)),
                pa.array([b and 1000 * b[1] // b[2] for b in best], pa.int64()),
                pa.array([sha(b"".join(b"%d,%d,%d\n" % r for r in of)) for of in found], pa.string()),
                pa.array(list(map(sha, short)), pa.string()),
                pa.array(short, pa.binary()).cast(pa.string()),
                pa.array(listed, as_struct),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_runs", *best_columns, "runs_sha256", "collapsed_sha256", "collapsed", "runs"])

    rows = docs.select(
        column(id_column).alias("doc_id"), column(text_column).alias("text"), (F.lit(None) if seed is None else seed).cast("long").alias("seed")
    )
    return in_tasks(rows, run, f"{schema}, collapsed string, runs array<struct<start: bigint, length: bigint, period: bigint>>")
