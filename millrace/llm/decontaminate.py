"""Benchmark decontamination with a generalised suffix automaton of the normalised test items.

The automaton holds every run of words that occurs in some item.  A document's words are
streamed through it, and at each word the state tells the longest run that ends there.  Where that
run is at least a window long, or ends with a whole item that is shorter than a window, the
words of the window are hit.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.llm.common import column, in_tasks, raw_texts, slices, with_row, work_dir, written
from millrace.sources import storage

#: Words are runs of digits, lower-cased ASCII letters and all non-ASCII characters.
_KEPT = bytes(range(0x30, 0x3A)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
NORMAL = bytes(c if c in _KEPT else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256))
WORD = re.compile(b"[^ ]+")


class Automaton:
    """Generalised suffix automaton over item words, with the windows that items share at its states."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int) -> None:
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.items = [item for item, _ in items]
        coded = [[self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words] for _, words in items]
        for words in coded:
            last = 0
            for w in words:
                last = self._extend(last, w)
        #: Items by state of a window, and by state of a short item.
        self.windows: dict[int, set[int]] = {}
        self.shorts: dict[int, set[int]] = {}
        for k, words in enumerate(coded):
            state = 0
            for n, w in enumerate(words, 1):
                state = self.next[state][w]
                if n >= window:
                    self.windows.setdefault(self._window_of(state), set()).add(k)
            if 0 < len(words) < window:
                self.shorts.setdefault(state, set()).add(k)
        self.shortest = min((min(len(w), window) for w in coded if w), default=0)
        #: The next state up the suffix links, this one included, that is a short item.
        self.short_above = [-1] * len(self.link)
        for state in sorted(range(len(self.link)), key=self.length.__getitem__):
            up = self.link[state]
            self.short_above[state] = state if state in self.shorts else self.short_above[up] if up >= 0 else -1

    def _window_of(self, state: int) -> int:
        while self.length[self.link[state]] >= self.window:
            state = self.link[state]
        return state

    def _copy(self, state: int, below: int, w: int) -> int:
        """Split the state that ``below`` leads to by ``w``, for runs of one word more than ``below``'s."""
        new = len(self.link)
        self.next.append(dict(self.next[state]))
        self.link.append(self.link[state])
        self.length.append(self.length[below] + 1)
        self.link[state] = new
        while below >= 0 and self.next[below].get(w) == state:
            self.next[below][w] = new
            below = self.link[below]
        return new

    def _extend(self, last: int, w: int) -> int:
        known = self.next[last].get(w)
        if known is not None:
            return known if self.length[known] == self.length[last] + 1 else self._copy(known, last, w)
        new = len(self.link)
        self.next.append({})
        self.link.append(0)
        self.length.append(self.length[last] + 1)
        at = last
        while at >= 0 and w not in self.next[at]:
            self.next[at][w] = new
            at = self.link[at]
        if at >= 0:
            known = self.next[at][w]
            self.link[new] = known if self.length[known] == self.length[at] + 1 else self._copy(known, at, w)
        return new

    def match(self, words: list[bytes]) -> tuple[list[list[int]], set[int]]:
        """Spans of hit words (first, last), merged and in order, and the items that hit them."""
        spans: list[list[int]] = []
        found: set[int] = set()
        if not self.shortest:
            return spans, found
        get = self.vocabulary.get
        coded = [get(w, -1) for w in words]
        # A run ends at any word that no item has; runs shorter than every window can't be hit.
        ends = np.flatnonzero(np.fromiter(coded, np.int64, len(coded)) < 0)
        first = np.concatenate(([0], ends + 1))
        size = np.concatenate((ends, [len(coded)])) - first
        for start, n in zip(first[size >= self.shortest].tolist(), size[size >= self.shortest].tolist(), strict=True):
            state = run = 0
            for p in range(start, start + n):
                w = coded[p]
                while state and w not in self.next[state]:
                    state = self.link[state]
                    run = self.length[state]
                if w in self.next[state]:
                    state = self.next[state][w]
                    run += 1
                hit = 0
                if run >= self.window:
                    hit = self.window
                    found |= self.windows.get(self._window_of(state), set())
                short = self.short_above[state]
                while short > 0:
                    if self.length[short] <= run:
                        hit = max(hit, self.length[short])
                        found |= self.shorts[short]
                    short = self.short_above[self.link[short]]
                if hit:
                    low = p - hit + 1
                    while spans and spans[-1][1] >= low - 1:
                        low = min(low, spans.pop()[0])
                    spans.append([low, p])
        return spans, found


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(NORMAL).split()


def _merged(spans: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for low, high in sorted(spans):
        if out and out[-1][1] >= low - 1:
            out[-1][1] = max(out[-1][1], high)
        else:
            out.append([low, high])
    return out


def without(text: bytes, spans: list[list[int]]) -> bytes:
    """The text without the words of the spans and what stands between them; one space takes a span's place."""
    at = [m.span() for m in WORD.finditer(text.translate(NORMAL))]
    out, end = [], 0
    for low, high in spans:
        out.append(text[end : at[low][0]])
        end = at[high][1]
    out.append(text[end:])
    return b" ".join(x.strip(b" ") if k else x.rstrip(b" ") for k, x in enumerate(out)).strip(b" ")


def _blocks(
    items: DataFrame, id_column: str, text_column: str, block_bytes: int
) -> Iterator[tuple[list[tuple[str | None, bytes]], bool]]:
    """The distinct items in blocks of about ``block_bytes``, one at a time, and whether a block is the last; items are never split."""
    chosen = items.select(column(id_column).cast("string").alias("item"), column(text_column).alias("text"))
    # Equal rows have one hash: were they kept, a block would hold all copies.
    chosen = chosen.where("text IS NOT NULL").distinct()
    total = chosen.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    for k in range(n):
        part = chosen if n == 1 else chosen.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k)
        rows = part.select("item", F.col("text").cast("binary").alias("text")).collect()
        yield [(r["item"], bytes(r["text"])) for r in rows], k == n - 1


SPANS = "array<struct<first: int, last: int>>"
ARROW_SPANS = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))


def overlaps(
    docs: DataFrame,
    items: DataFrame,
    window: int = 10,
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    keep_text: bool = False,
    block_bytes: int = 4_000_000,
) -> DataFrame:
    """What every row of ``docs`` shares with the items: ``row`` (a struct of the other columns),
    ``text`` (null unless ``keep_text``), ``n_words``, ``spans``, ``n_hit`` and ``item_ids``.

    ``spans`` has the first and last index of hit words, merged; ``item_ids`` are sorted as strings,
    each once.  A window is ``window`` consecutive words of an item, or a whole shorter item.
    Null and empty texts have no words; a null item id hits words but is not among
    ``item_ids``.  Items with equal ids count as one.  Rows are never dropped.

    The documents are not shuffled.  Items are sent to the tasks in blocks of at most about
    ``block_bytes`` of text, which bounds what a task holds; each block is one pass over the
    documents, and between two passes the rows are a written table.
    """
    rows, schema, shared = _before_last(docs, items, window, text_column, item_column, item_text_column, keep_text, block_bytes)
    rows = in_tasks(rows, _matcher(shared, keep_text), schema)
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["last"] - s["first"] + 1)
    return rows.select("row", "text", "n_words", "spans", hit.alias("n_hit"), "item_ids")


def _before_last(
    docs: DataFrame,
    items: DataFrame,
    window: int,
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    keep_text: bool = False,
    block_bytes: int = 4_000_000,
) -> tuple[DataFrame, StructType, Broadcast]:
    """The rows of ``overlaps`` after all blocks of items but the last, their schema, and the last block's automaton."""
    spark = docs.sparkSession
    others = F.struct(*[column(c) for c in docs.columns if c != text_column]).alias("row")
    rows = docs.select(
        others,
        column(text_column).alias("text"),
        F.lit(0).cast("bigint").alias("n_words"),
        F.array().cast(SPANS).alias("spans"),
        F.array().cast("array<string>").alias("item_ids"),
    )
    schema = with_row(rows, f"text string, n_words bigint, spans {SPANS}, item_ids array<string>")
    blocks = _blocks(items, item_column, item_text_column, block_bytes)
    path = before = None
    for k, (block, is_last) in enumerate(blocks):
        if k:
            path = path or work_dir(spark, "overlaps")
            rows = written(rows, f"{path}/{k}")
            if before:
                storage.remove(spark, before)
            before = f"{path}/{k}"
        shared = spark.sparkContext.broadcast(Automaton([(i, words_of(t)) for i, t in block], window))
        if not is_last:
            rows = in_tasks(rows, _matcher(shared, True), schema)
    return rows, schema, shared


def _matched(automaton: Automaton, batch: pa.RecordBatch) -> Iterator[tuple[bytes | None, int, list[list[int]], set[int], list[str]]]:
    """Text, number of words, spans, items and earlier items' ids of each row, spans of earlier blocks included."""
    earlier = batch.column("spans").to_pylist(), batch.column("item_ids").to_pylist()
    for text, had, had_ids in zip(raw_texts(batch), *earlier, strict=True):
        words = words_of(text)
        own, found = automaton.match(words)
        yield text, len(words), _merged(own + [[x["first"], x["last"]] for x in had]) if had else own, found, had_ids


def _matcher(shared: Broadcast, keep_text: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        automaton = shared.value
        for batch in slices(batches):
            n_words, spans, ids = [], [], []
            for _, n, own, found, had_ids in _matched(automaton, batch):
                n_words.append(n)
                spans.append([{"first": a, "last": b} for a, b in own])
                ids.append(sorted({automaton.items[i] for i in found if automaton.items[i] is not None} | set(had_ids)))
            text = batch.column("text") if keep_text else pa.nulls(batch.num_rows, pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), text, pa.array(n_words, pa.int64()), pa.array(spans, ARROW_SPANS), pa.array(ids, pa.list_(pa.string()))],
                ["row", "text", "n_words", "spans", "item_ids"],
            )

    return run


def report(
    docs: DataFrame, items: DataFrame, window: int = 10, id_column: str = "doc_id", text_column: str = "text", **named: object
) -> DataFrame:
    """One row per document: ``doc_id``, ``n_words``, ``n_hit``, ``n_items``, ``items_sha256``, ``contaminated``."""
    chosen = docs.select(column(id_column).alias("doc_id"), column(text_column).alias("text"))
    return overlaps(chosen, items, window, **named).select(
        "row.doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def decontaminated(
    docs: DataFrame, items: DataFrame, window: int = 10, max_coverage: float = 0.5, text_column: str = "text", **named: object
) -> DataFrame:
    """The documents with every hit span cut from the text; those covered to more than ``max_coverage`` go.

    Coverage is the share of a document's words that are hit.  Columns are as given; where
    there is a column ``n_chars`` and a text changes, it takes the new length.
    """
    rows, _, shared = _before_last(docs, items, window, text_column, keep_text=True, **named)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        automaton = shared.value
        for batch in slices(batches):
            texts, changed, stays = [], [], []
            for text, n, spans, _, _ in _matched(automaton, batch):
                stays.append(sum(b - a + 1 for a, b in spans) <= max_coverage * n)
                texts.append(without(text, spans) if spans and stays[-1] else text)
                changed.append(bool(spans))
            text = pa.array(texts, pa.binary()).cast(pa.string())
            done = pa.RecordBatch.from_arrays([batch.column("row"), text, pa.array(changed, pa.bool_())], ["row", "text", "changed"])
            yield done.filter(pa.array(stays, pa.bool_()))

    rows = in_tasks(rows, run, with_row(rows, "text string, changed boolean"))
    new = {text_column: F.col("text")}
    if "n_chars" in docs.columns and text_column != "n_chars":
        own = F.col("row").getField("n_chars")
        new["n_chars"] = F.when(F.col("changed"), F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(own)
    return rows.select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])
