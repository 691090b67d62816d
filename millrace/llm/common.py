"""What the operators share: work tables, text columns in tasks, connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.sources import storage

#: Bytes of a column of texts that a task turns into Python objects at once, a row at least.
SLICE_BYTES = 4 << 20


def column(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col(f"`{name}`")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_dir(spark: SparkSession, label: str) -> str:
    """A new folder below the one that all executors share (``spark.checkpoint.dir``)."""
    return storage.shared_dir(spark, f"llm-{label}")


def written(df: DataFrame, path: str) -> DataFrame:
    """Write a frame as a table and read it: what follows doesn't depend on how it came about."""
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def in_tasks(
    df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]], schema: str | StructType
) -> DataFrame:
    """``mapInArrow``; the functions take their batches in ``slices``, as the session's limits may let long texts add up.

    What a task no longer needs is given back, as its worker goes on to other tasks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        yield from function(batches)
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def slices(batches: Iterable[pa.RecordBatch], size: int = SLICE_BYTES, name: str = "text") -> Iterator[pa.RecordBatch]:
    """The batches in parts of about ``size`` bytes of one string or binary column, a row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(name)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start, done = 0, 0
        while start < len(ends):
            stop = max(start + 1, int(np.searchsorted(ends, done + size, side="right")))
            yield batch.slice(start, stop - start)
            start, done = stop, int(ends[stop - 1])


#: Bits of ``hash_filter``: its size, whatever the number of hashes.
FILTER_BITS = 1 << 24


def _marks(hashes: DataFrame, name: str) -> DataFrame:
    """A bitmap of ``FILTER_BITS`` bits: the numbers (``at``) of 64 bits that have some, and the ``bits``."""
    bit = hashes.select(F.pmod(F.col(name), F.lit(FILTER_BITS)).alias("bit"))
    marked = F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 AS int))")).alias("bits")
    return bit.groupBy(F.shiftright("bit", 6).alias("at")).agg(marked)


def hash_filter(hashes: DataFrame, name: str) -> Callable[[pa.Array], pa.Array]:
    """A test, for use in tasks, that every hash in a column (long, not null) passes, and most others don't.

    A bitmap of fixed size is made on the executors, collected in ``FILTER_BITS / 64`` numbers at most and broadcast.  The
    more hashes there are, the more others pass.
    """
    words = _marks(hashes, name).toArrow()
    bitmap = np.zeros(FILTER_BITS // 64, np.int64)
    bitmap[words["at"].to_numpy()] = words["bits"].to_numpy()
    shared = hashes.sparkSession.sparkContext.broadcast(bitmap)

    def passes(found: pa.Array) -> pa.Array:
        at = found.to_numpy(zero_copy_only=False) % FILTER_BITS
        return pa.array(shared.value[at >> 6] >> (at & 63) & 1 == 1)

    return passes


def parted(rows: DataFrame, hashed: Column, hashes: DataFrame, name: str, path: str) -> tuple[DataFrame, DataFrame]:
    """The rows whose hash may be in a column of ``hashes`` (long, not null), and those whose hash is not.

    The bitmap of the hashes is written to ``path`` and broadcast: ``FILTER_BITS / 64`` rows of two numbers at most.  No row is
    shuffled.
    """
    marks = written(_marks(hashes, name), path).select(F.col("at").alias("_at"), F.col("bits").alias("_bits"))
    bit = F.pmod(hashed, F.lit(FILTER_BITS))
    found = rows.withColumn("_bit", bit).join(F.broadcast(marks), F.shiftright("_bit", 6) == F.col("_at"), "left")
    maybe = F.coalesce(F.expr("_bits & shiftleft(1L, cast(_bit & 63 AS int)) <> 0"), F.lit(False))
    return found.where(maybe).drop("_bit", "_at", "_bits"), found.where(~maybe).drop("_bit", "_at", "_bits")


def with_row(df: DataFrame, others: str) -> StructType:
    """A schema of the frame's column ``row`` as it is, and others."""
    return StructType([df.schema["row"], *StructType.fromDDL(others).fields])


def raw_texts(batch: pa.RecordBatch, name: str = "text") -> list[bytes | None]:
    """A text column as UTF-8 bytes."""
    return batch.column(name).cast(pa.binary()).to_pylist()


#: Of ASCII, lower-case letters only; all else is a blank.
_LETTERS = bytes(c if 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))


def plain_words(text: bytes | None) -> list[bytes]:
    """The words of a lower-cased text: runs of ASCII letters and of characters beyond ASCII."""
    return (text or b"").decode("utf-8", "replace").lower().encode().translate(_LETTERS).split()


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def components(links: DataFrame, path: str) -> DataFrame:
    """The connected component of every node that has a link.

    ``links`` has columns ``a`` and ``b`` (long, not null).  Returns ``node`` and ``root``;
    nodes of one component have the same root, itself one of them.  Each round, every
    node joins the neighbour that comes first in an order that is drawn anew for the round,
    and links are renamed accordingly, so a constant share of the nodes goes each time and
    the number of rounds grows with the logarithm of the nodes.  Minima are combined before
    the shuffle and nothing is gathered per node; each round is a written table below ``path``.
    """
    spark = links.sparkSession
    pairs = links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    left, steps = written(pairs, f"{path}/links-0"), []
    while not left.isEmpty():
        n = len(steps)
        order = lambda c: F.struct(F.xxhash64(F.lit(n), c).alias("at"), c.alias("node"))  # noqa: B023, E731
        both = left.select("a", "b").unionAll(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        first = both.groupBy("a").agg(F.min(order(F.col("b"))).alias("f"))
        moved = first.select(F.col("a").alias("node"), F.least(F.col("f"), order(F.col("a")))["node"].alias("to"))
        step = written(moved, f"{path}/step-{n}")
        steps.append(step)
        to_a, to_b = (step.select(F.col("node").alias(c), F.col("to").alias(f"to_{c}")) for c in "ab")
        renamed = left.join(to_a, "a").join(to_b, "b").where("to_a <> to_b")
        renamed = renamed.select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")).distinct()
        left = written(renamed, f"{path}/links-{n + 1}")
        storage.remove(spark, f"{path}/links-{n}")
    if not steps:
        return left.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = steps[0].select("node", F.col("to").alias("root"))
    for step in steps[1:]:
        later = step.select(F.col("node").alias("root"), "to")
        roots = roots.join(later, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    return roots
