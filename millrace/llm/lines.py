"""Line dedup by the spread of a line over sites."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import column, parted, work_dir, written

#: Registers of a sketch as a power of two, and its standard error.
SKETCH_BITS = 10
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_BITS / 2)


def _trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\r\f\v"))


def _lines(docs: DataFrame, site: str) -> DataFrame:
    """Every line that isn't blank: a 128-bit hash in two columns, its place and its site.

    A document is known by its id and a hash of its text, so repeated rows are one document.
    """
    chosen = docs.select(
        column("doc_id").alias("doc_id"), F.xxhash64("text").alias("text_hash"), column(site).alias("site"), column("text").alias("text")
    )
    split = chosen.select("doc_id", "text_hash", "site", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    split = split.withColumn("line", _trimmed(F.col("line"))).where("line <> ''")
    return split.select("doc_id", "text_hash", "site", "pos", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit("line"), "line").alias("h2"))


def boilerplate(rows: DataFrame, path: str, min_sites: int = 6) -> DataFrame:
    """The lines (``h1``, ``h2``) on at least ``min_sites`` sites, with the first place of each; ``rows`` are a written table of lines.

    One sketch of sites a line is built where the line is read and merged after the shuffle.  An estimate
    further than three standard errors from the threshold decides; lines nearer to it get
    an exact count of their sites.  Rows without a site count for none.
    """
    # Null sorts first in a struct; the flag puts rows without an id last.
    place = F.struct(F.isnull("doc_id").alias("none"), "doc_id", "text_hash", "pos")
    spread = rows.groupBy("h1", "h2").agg(
        F.min(place).alias("first"), F.hll_sketch_agg(F.col("site").cast("string"), SKETCH_BITS).alias("sketch")
    )
    spread = spread.select("h1", "h2", "first", F.hll_sketch_estimate("sketch").alias("estimate"))
    slack = 3 * SKETCH_ERROR * min_sites + 1
    spread = written(spread.where(F.col("estimate") >= min_sites - slack), f"{path}/spread")
    sure = spread.where(F.col("estimate") > min_sites + slack).select("h1", "h2", "first")
    near = spread.where(F.col("estimate") <= min_sites + slack).select("h1", "h2", "first")
    sites = rows.select("h1", "h2", "site").join(near.select("h1", "h2"), ["h1", "h2"], "left_semi").distinct()
    counted = sites.groupBy("h1", "h2").agg(F.count("site").alias("sites")).where(F.col("sites") >= min_sites)
    exact = near.join(counted.select("h1", "h2"), ["h1", "h2"], "left_semi")
    return written(sure.unionByName(exact), f"{path}/boilerplate")


def deduplicated(docs: DataFrame, min_sites: int = 6, site: str = "source") -> DataFrame:
    """The documents (``doc_id``, ``text`` and ``site`` among their columns) without cross-site boilerplate.

    A line that is on ``min_sites`` sites or more stays at its first place only: in the document
    with the smallest id (of equal ids, the smallest text hash), at its first position.  Lines are
    compared without outer blanks; blank lines and null texts stay as they are.  No row goes: a document all of
    whose lines are repeated keeps an empty text.  Returns ``row`` (a struct of the columns but the text),
    ``text`` (cleaned), ``n_lines`` (not blank) and ``n_removed``.

    Only texts that lose a line, and few others, are shuffled: a bitmap of fixed size tells the others.
    """
    path = work_dir(docs.sparkSession, "lines")
    lines = written(_lines(docs, site), f"{path}/lines")
    common = boilerplate(lines, path, min_sites)
    here = (F.col("pos") == F.col("first.pos")) & F.col("doc_id").eqNullSafe(F.col("first.doc_id"))
    here &= F.col("text_hash") == F.col("first.text_hash")
    key = lambda i, h: F.concat(F.coalesce(i.cast("string"), F.lit("-")), F.lit(":"), h.cast("string"))
    gone = lines.select("doc_id", "text_hash", "pos", "h1", "h2").join(common, ["h1", "h2"]).where(~here)
    gone = gone.groupBy(key(F.col("doc_id"), F.col("text_hash")).alias("_key")).agg(F.collect_set("pos").alias("_gone"))
    gone = written(gone, f"{path}/gone")
    rows = docs.select(F.struct(*[column(c) for c in docs.columns if c != "text"]).alias("row"), column("text").alias("text"))
    rows = rows.withColumn("_key", key(F.col("row.doc_id"), F.xxhash64("text")))
    some, whole = parted(rows, F.xxhash64("_key"), gone.select(F.xxhash64("_key").alias("h")), "h", f"{path}/losers")
    split = some.join(gone, "_key", "left").select("row", "text", "_gone", F.split("text", "\n").alias("_lines"))
    stays = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), "_gone")
    text = F.array_join(F.transform(stays, lambda k: F.get(F.col("_lines"), k)), "\n")
    text = F.when(F.col("_gone").isNull(), F.col("text")).otherwise(text).alias("text")
    split = split.select("row", text, _not_blank(F.col("_lines")), F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_removed"))
    return split.unionAll(whole.select("row", "text", _not_blank(F.split("text", "\n")), F.lit(0).cast("long").alias("n_removed")))


def _not_blank(lines: Column) -> Column:
    """The number of lines that aren't blank."""
    return F.coalesce(F.size(F.filter(lines, lambda x: _trimmed(x) != "")), F.lit(0)).cast("long").alias("n_lines")


def cleaned(docs: DataFrame, min_sites: int = 6, site: str = "source") -> DataFrame:
    """``deduplicated`` with the columns of ``docs``; ``n_chars``, if given, follows the text."""
    done = deduplicated(docs, min_sites, site)
    new = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        new["n_chars"] = F.when(F.col("n_removed") > 0, length).otherwise(F.col("row").getField("n_chars"))
    return done.select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])
