"""Token counts from flat token files that have no index.

A token file is nothing but token ids side by side, little-endian unsigned integers of 2 or 4
bytes, with an end-of-document id after each document.  Files are read in blocks.  In each block
the separators are found by one vectorised comparison; a prefix scan over the blocks' totals
then says how many documents end before a block and how many tokens of its first document lie in
earlier ones.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.bpe import encoded
from millrace.llm.common import in_tasks, work_dir, written

#: Tokens of a block, and blocks whose totals are scanned in one task.
BLOCK_TOKENS, SCANNED_TOGETHER = 1 << 21, 4096


def write_token_files(docs: DataFrame, vocabulary: Broadcast, path: str, end_id: int, text_column: str = "text") -> None:
    """Write the documents' tokens as flat files of 2-byte ids, ``end_id`` after each document.

    Each task writes its file through Spark's text sink, for which a document's ids are a line
    and the two bytes of ``end_id`` the line separator; so nothing is gathered or shuffled, and an
    interrupted task leaves nothing behind.
    """
    if not 0 < end_id < 1 << 16:
        raise ValueError("the end-of-document id must fit in two bytes")
    ids = encoded(docs, vocabulary, text_column, bytes_per_id=2)
    end = end_id.to_bytes(2, "little").decode("latin-1")
    sink = ids.select(F.col("ids").cast("string").alias("value")).write.option("encoding", "ISO-8859-1")
    sink.option("lineSep", end).option("compression", "none").text(path)


def _open(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(path.replace("file:/", "file:///", 1) if path.startswith("file:/") and path[6] != "/" else path)


def _scan(end_id: int, bytes_per_id: int) -> Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]]:
    kind = np.dtype({2: "<u2", 4: "<u4"}[bytes_per_id])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            for path, block, start, size in zip(*(batch.column(c).to_pylist() for c in ("path", "block", "start", "size")), strict=True):
                if size % bytes_per_id:
                    raise ValueError(f"{path} ends in the middle of a token")
                files, name = _open(path)
                with files.open_input_file(name) as source:
                    tokens = np.frombuffer(source.read_at(size, start), kind)
                if len(tokens) * bytes_per_id != size:
                    raise OSError(f"{path}: {size} bytes expected at {start}")
                at = np.flatnonzero(tokens == end_id)
                inner = np.diff(at) - 1
                first, last = (int(at[0]), int(at[-1])) if len(at) else (None, None)
                row = [[path], [block], [start // bytes_per_id], [len(tokens)], [len(at)], [first], [last], [inner.astype(np.int32)]]
                kinds = [pa.string(), *[pa.int64()] * 6, pa.list_(pa.int32())]
                arrays = [pa.array(v, k) for v, k in zip(row, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, ["path", "block", "start", "tokens", "ends", "first", "last", "inner"])

    return run


def count_tokens(spark: SparkSession, path: str, end_id: int, bytes_per_id: int = 2, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """One row per document: ``file`` (its name), ``doc`` (from 0 in each file), ``start`` (the token it begins at),
    ``n_tokens`` (without the end-of-document id) and ``ended``.

    ``path`` is a folder of token files, on a file system that both Spark and Arrow read.  Tokens
    after a file's last end-of-document id are one document more, with ``ended`` false.  An empty
    document has 0 tokens; an empty file has no document; a file that ends within a token is an
    error.  Only one block is in a task's memory at a time, however long files or documents are.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "length").where("length > 0")
    step = block_tokens * bytes_per_id
    blocks = files.select("path", "length", F.explode(F.sequence(F.lit(0), F.expr(f"(length - 1) div {step}"))).alias("block"))
    start = F.col("block") * step
    blocks = blocks.select("path", F.col("block").cast("bigint"), start.alias("start"), F.least(F.lit(step), F.col("length") - start).alias("size"))
    schema = "path string, block bigint, start bigint, tokens bigint, ends bigint, first bigint, last bigint, inner array<int>"
    spread = blocks.repartition("path", "block")
    found = written(in_tasks(spread, _scan(end_id, bytes_per_id), schema), f"{work_dir(spark, 'tokens')}/blocks")

    # The scan: within stretches of blocks first, then over the stretches' totals.
    totals = found.select("path", "block", F.expr(f"block div {SCANNED_TOGETHER}").alias("stretch"), "ends", (F.col("start") + F.col("last")).alias("last_end"))
    before = lambda *keys: Window.partitionBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    near = before("path", "stretch").orderBy("block")
    local = totals.select("path", "block", "stretch", F.sum("ends").over(near).alias("docs_near"), F.max("last_end").over(near).alias("end_near"))
    far = before("path").orderBy("stretch")
    stretches = totals.groupBy("path", "stretch").agg(F.sum("ends").alias("ends"), F.max("last_end").alias("last_end"))
    stretches = stretches.select("path", "stretch", F.sum("ends").over(far).alias("docs_far"), F.max("last_end").over(far).alias("end_far"))
    carried = local.join(stretches, ["path", "stretch"]).select(
        "path",
        "block",
        (F.coalesce("docs_near", F.lit(0)) + F.coalesce("docs_far", F.lit(0))).alias("docs_before"),
        (F.coalesce("end_near", "end_far", F.lit(-1)) + 1).alias("begun"),
    )
    stitched = found.join(carried, ["path", "block"])
    file = F.element_at(F.split("path", "/"), -1).alias("file")
    # The first document that ends in a block began at "begun", maybe blocks ago; the others begin and end here.
    opening = stitched.where("ends > 0").select(
        file, F.col("docs_before").alias("doc"), F.col("begun").alias("start"), (F.col("start") + F.col("first") - F.col("begun")).alias("n_tokens"), F.lit(True).alias("ended")
    )
    origin = (F.col("start") + F.col("first") + 1).alias("origin")
    inner = _inner(stitched.where("ends > 1").select(file, "docs_before", origin, "inner"))
    latest = stitched.groupBy("path").agg(F.max(F.struct("block", "start", "tokens", "ends", "last", "docs_before", "begun")).alias("b")).select(file, "b.*")
    tail = F.when(F.col("ends") > 0, F.col("start") + F.col("last") + 1).otherwise(F.col("begun"))
    latest = latest.select("file", (F.col("docs_before") + F.col("ends")).alias("doc"), tail.alias("from"), (F.col("start") + F.col("tokens")).alias("to"))
    latest = latest.where(F.col("to") > F.col("from"))
    unended = latest.select("file", "doc", F.col("from").alias("start"), (F.col("to") - F.col("from")).alias("n_tokens"), F.lit(False).alias("ended"))
    return opening.unionAll(inner).unionAll(unended)


def _inner(blocks: DataFrame) -> DataFrame:
    """The documents that begin and end in one block, from their lengths."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                sizes = batch.column("inner")[k].values.to_numpy(zero_copy_only=False).astype(np.int64)
                starts = batch.column("origin")[k].as_py() + np.cumsum(sizes + 1) - (sizes + 1)
                file = pa.array([batch.column("file")[k].as_py()] * len(sizes), pa.string())
                number = batch.column("docs_before")[k].as_py() + 1 + np.arange(len(sizes))
                columns = [file, pa.array(number), pa.array(starts), pa.array(sizes), pa.array(np.ones(len(sizes), bool))]
                yield pa.RecordBatch.from_arrays(columns, ["file", "doc", "start", "n_tokens", "ended"])

    return in_tasks(blocks, run, "file string, doc bigint, start bigint, n_tokens bigint, ended boolean")
