"""Language identification by compression.

Every language has a dictionary: raw text of that language, which a compressor may refer to.  A text
is compressed with each language's dictionary and has the language that makes it smallest.  If
the next smallest is nearly as small, the text is rejected.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import column, in_tasks, plain_words, raw_texts, slices, with_row

LEVEL = 6
#: A text is compressed in pieces of so many bytes, so that the dictionary counts all the way.
PIECE = 4096
#: Texts sampled for a language, and the bytes of its dictionary.
SAMPLE, DICTIONARY_BYTES, MAX_LANGUAGES = 400, 64 * 1024, 200
#: Least lead of the smallest size over the next, as a share of the next.
MIN_MARGIN = 0.004
UNDETERMINED = "und"
LETTER = regex.compile(r"\p{L}")


def normal(text: bytes) -> bytes:
    """Lower case, with one blank for whatever ASCII is not a letter."""
    return b" ".join(plain_words(text))


def remainder(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


def learned(docs: DataFrame, lang: str = "lang", sample: int = SAMPLE, size: int = DICTIONARY_BYTES) -> dict[str, bytes]:
    """A dictionary for every value of ``lang``, from ``text`` and ``lang`` of the given rows.

    About ``sample`` different texts a language are drawn by a hash, twice as many for all languages together at most, and ``size``
    bytes of them kept: a bounded sample, to which a long text gives a part from its middle and copies of a text give one.  Null languages and texts
    teach nothing.  More than ``MAX_LANGUAGES`` languages are an error.
    """
    rows = docs.select(column("text").alias("text"), column(lang).cast("string").alias("lang"))
    rows = rows.where("lang IS NOT NULL AND text IS NOT NULL")
    # Copies of a text count once.
    texts = F.approx_count_distinct(F.xxhash64("text")).alias("n")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(texts).limit(MAX_LANGUAGES + 1).collect()}
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not counts:
        return {}
    chance = F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(min(1.0, sample / max(1, n))))])
    rows = rows.withColumn("draw", F.pmod(F.xxhash64(F.lit("sample"), "text"), F.lit(1 << 30)) / chance[F.col("lang")])
    # What a text gives is cut to its share of the dictionary, from the middle, so many texts take part.
    share = max(1000, 2 * size // sample)
    piece = F.substring(F.col("text"), F.greatest(F.lit(1), ((F.length("text") - share) / 2).cast("int") + 1), F.lit(share))
    picked = rows.where(F.col("draw") < 1 << 30).select("lang", "draw", piece.alias("text")).distinct()
    found: dict[str, list[tuple[float, bytes]]] = {}
    for r in picked.orderBy("draw", "lang", "text").limit(2 * sample * len(counts)).collect():
        found.setdefault(r["lang"], []).append((r["draw"], normal(r["text"].encode())))
    # Text near the end of a dictionary is cheapest to refer to; order doesn't depend on the run.
    return {k: b" ".join(t for _, t in sorted(v))[-size:] for k, v in found.items()}


class Sizer:
    """Compressed sizes of a text with each language's dictionary."""

    def __init__(self, dictionaries: dict[str, bytes], level: int = LEVEL) -> None:
        self.languages = sorted(dictionaries)
        self.compressors = []
        for k in self.languages:
            data = zstandard.ZstdCompressionDict(dictionaries[k], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            data.precompute_compress(level=level)
            self.compressors.append(
                zstandard.ZstdCompressor(level=level, dict_data=data, write_checksum=False, write_content_size=False, write_dict_id=False).compress
            )

    def sizes(self, text: bytes) -> np.ndarray:
        pieces = [text[k : k + PIECE] for k in range(0, len(text), PIECE)]
        return np.array([sum(len(c(p)) for p in pieces) for c in self.compressors])


def predicted(docs: DataFrame, dictionaries: dict[str, bytes], min_margin: float = MIN_MARGIN, text_column: str = "text") -> DataFrame:
    """Every row of ``docs`` as ``row`` (a struct of the columns but the text) and ``text``, with
    ``lang_pred``, ``score`` and ``accepted``.

    ``score`` is the lead of the smallest size over the next, as a share of the next (1 if there
    is one language only); equal sizes go to the language whose name comes first.  ``accepted``
    is false where the score is under ``min_margin``.  A null text or one without a letter is
    ``und``, with score 0, and not accepted; so is every text if nothing was learned.  The dictionaries
    (their number and size are bounded) are broadcast; nothing is shuffled.
    """
    shared = docs.sparkSession.sparkContext.broadcast(dictionaries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        sizer = Sizer(shared.value)
        for batch in slices(batches):
            found = [_best(sizer, t) for t in raw_texts(batch)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    batch.column("text"),
                    pa.array([x for x, _ in found], pa.string()),
                    pa.array([s for _, s in found], pa.float64()),
                    pa.array([x != UNDETERMINED and s >= min_margin for x, s in found], pa.bool_()),
                ],
                ["row", "text", "lang_pred", "score", "accepted"],
            )

    rows = docs.select(
        F.struct(*[column(c) for c in docs.columns if c != text_column]).alias("row"), column(text_column).alias("text")
    )
    return in_tasks(rows, run, with_row(rows, "text string, lang_pred string, score double, accepted boolean"))


def _best(sizer: Sizer, text: bytes | None) -> tuple[str, float]:
    if not text or not sizer.languages or not LETTER.search(text.decode("utf-8", "replace")):
        return UNDETERMINED, 0.0
    sizes = sizer.sizes(normal(text))
    if len(sizes) == 1:
        return sizer.languages[0], 1.0
    order = np.argsort(sizes, kind="stable")
    least, second = sizes[order[:2]]
    return sizer.languages[order[0]], float(second - least) / float(second)


def report(docs: DataFrame, min_margin: float = MIN_MARGIN) -> DataFrame:
    """One row per document: ``doc_id``, ``held_out``, ``lang_pred``, ``score``, ``accepted``.

    Languages are learned from the rows that aren't held out: those whose id, as text, has a
    CRC-32 that 5 doesn't divide.  A null id is not held out, and teaches nothing.
    """
    rest = remainder(column("doc_id"))
    dictionaries = learned(docs.where(rest != 0))
    rows = predicted(docs.select("doc_id", "text"), dictionaries, min_margin)
    held_out = F.coalesce(remainder(F.col("row.doc_id")) == 0, F.lit(False)).alias("held_out")
    return rows.select("row.doc_id", held_out, "lang_pred", "score", "accepted")


def accepted(docs: DataFrame, min_margin: float = MIN_MARGIN) -> DataFrame:
    """The documents whose language is accepted, with their columns as given."""
    rows = predicted(docs, learned(docs.where(remainder(column("doc_id")) != 0)), min_margin).where("accepted")
    return rows.select(*[F.col("text") if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns])
