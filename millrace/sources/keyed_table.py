"""Keyed tables: upserts over plain Parquet.

A write appends one directory to a change log; nothing is rewritten and
nothing is shuffled.  A read reduces the log to the winner per key.  The
winner is the ``max`` of a struct ``(sequence columns, batch number, other
columns)``; ``max`` does not care about order or repetition, so replays and
reordered batches give the same table.

``compact`` folds the log into a base with one row per key, bucketed by key.
A read then joins the base with what was logged since; the base is already
laid out by key, so only the new part is shuffled, and with an empty log the
read is a plain scan.

Layout below the table path::

    _table.json                 schema and table properties
    log/<n>-<attempt>/          rows of batch n
    commits/<n>                 which folder, writer and epoch became batch n
    base/<version>-<attempt>/   compacted rows, bucketed by key
    versions/<version>.json     which base to read and the batches folded into it

A batch counts once its commit marker exists.  A marker is named by the number
alone and never replaced, so of two writers that take one number the second
goes on to the next, with the rows it has written: rows get their batch number
from their folder when they are read.  On a file system whose rename replaces
files, as a local disk's does, that rests on a check right before the rename.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import and_
from typing import Any, NamedTuple
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.schema import check_schema, key_columns, required_columns, spark_type
from millrace.operators.constraints import not_null
from millrace.operators.project import named
from millrace.sources import storage

# Buckets of a table's base where none are asked for, and the catalog database
# in which a base is declared.
BUCKETS = 8
DATABASE = "default"


class TableExistsError(ValueError):
    pass


class NoSuchTableError(LookupError):
    pass


class ColumnMismatchError(ValueError):
    """The rows do not have the columns that the table declares."""


class ConcurrentWriteError(RuntimeError):
    """Another writer changed the table while keys that it lacks were being written."""


class Commit(NamedTuple):
    batch: int
    epoch: int
    writer: str
    folder: str

    @property
    def marker(self) -> str:
        return f"{self.batch:012d}"


class Snapshot(NamedTuple):
    """One view of a table: its current version and the batches committed since."""

    version: dict[str, Any]
    commits: list[Commit]

    @property
    def last_batch(self) -> int:
        return max([self.version["folded"], *[c.batch for c in self.commits]])

    def last_epoch(self, writer: str) -> int:
        return max([self.version["writers"].get(writer, -1), *[c.epoch for c in self.commits if c.writer == writer]])


class KeyedTable:
    def __init__(self, spark: SparkSession, path: str, properties: Mapping[str, Any]):
        self.spark = spark
        self.path = path
        self.schema = check_schema(properties["schema"], need_key=True)
        self.sequence_by = list(properties["sequence_by"])
        self.partial_updates = bool(properties["partial_updates"])
        self.buckets = int(properties["buckets"])
        self.database = str(properties.get("database", DATABASE))
        self.keys = key_columns(self.schema)
        # Sequence columns lead the remaining ones, as they decide the order.
        others = [c["column_name"] for c in self.schema if c["column_name"] not in self.keys]
        self._values = [*self.sequence_by, *[c for c in others if c not in self.sequence_by]]
        self._types = {c["column_name"]: spark_type(c["column_type"]) for c in self.schema}
        # Inside the files columns go by position, so any declared name is safe.
        self._k = [f"_k{i}" for i in range(len(self.keys))]
        self._v = [f"_v{i}" for i in range(len(self._values))]

    # ---- lifecycle

    @classmethod
    def create(
        cls,
        spark: SparkSession,
        path: str,
        schema: Iterable[Mapping[str, Any]],
        *,
        sequence_by: Sequence[str] = (),
        partial_updates: bool = False,
        buckets: int | None = None,
        database: str = DATABASE,
        if_not_exists: bool = False,
    ) -> KeyedTable:
        """Create an empty table.

        ``sequence_by`` names the columns that order changes to a key; without
        it the later batch wins.  ``partial_updates`` lets a write carry only
        some columns.  ``buckets`` is the layout of the compacted base, 8 by
        default: choose it so that one bucket fits a task.  Only
        ``compact(buckets=)`` changes it.  ``database``, which must exist, is
        where a session declares the base, as only catalog tables have buckets.
        """
        if cls.exists(spark, path):
            if if_not_exists:
                return cls.open(spark, path)
            raise TableExistsError(path)
        checked = check_schema(schema, need_key=True)
        keys = key_columns(checked)
        unknown = [c for c in sequence_by if c in keys or c not in {s["column_name"] for s in checked}]
        if unknown:
            raise ColumnMismatchError(f"sequence_by must name non-key columns of the table: {unknown}")
        properties = {
            "schema": checked,
            "sequence_by": list(sequence_by),
            "partial_updates": partial_updates,
            "buckets": buckets or BUCKETS,
            "database": database,
        }
        storage.put_text(spark, f"{path}/_table.json", json.dumps(properties, indent=1))
        return cls(spark, path, properties)

    @classmethod
    def exists(cls, spark: SparkSession, path: str) -> bool:
        return storage.exists(spark, f"{path}/_table.json")

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> KeyedTable:
        if not cls.exists(spark, path):
            raise NoSuchTableError(path)
        return cls(spark, path, json.loads(storage.read_text(spark, f"{path}/_table.json")))

    @classmethod
    def drop(cls, spark: SparkSession, path: str, *, if_exists: bool = False) -> None:
        if not cls.exists(spark, path):
            if if_exists:
                return
            raise NoSuchTableError(path)
        table = cls.open(spark, path)
        for folder in storage.names(spark, f"{path}/base"):
            spark.sql(f"DROP TABLE IF EXISTS {table._base_name(folder)}")
        storage.remove(spark, path)

    # ---- writing

    def upsert(
        self, df: DataFrame, *, writer: str | None = None, epoch: int = 0, changed_only: bool = False
    ) -> bool:
        """Insert or replace rows by key.

        Columns are matched by name, case-insensitively, and cast.  A column
        that is missing keeps its old values if the table takes partial
        updates, and is an error otherwise; an explicit NULL overwrites.  A
        NULL in a required column fails the write before anything is visible,
        and so does a new key without one.  ``changed_only`` compares the rows
        with the table first and writes those that differ.

        ``writer`` and ``epoch`` name the write.  A named write that was
        committed before, or came before a committed one of the same writer, is
        not done again; the result says whether it was done.
        """
        return self._append(df, writer, epoch, changed_only=changed_only)

    def insert_if_absent(self, df: DataFrame, *, writer: str | None = None, epoch: int = 0) -> bool:
        """Insert rows whose key the table does not have; the first by ``sequence_by`` wins within ``df``."""
        return self._append(df, writer, epoch, absent_only=True)

    def soft_delete(self, keys: DataFrame, *, moment: Column | None = None, column: str = "tombstone") -> bool:
        """Set ``column`` to a time (now by default) in the rows with these keys; other columns stay.

        Needs a table with partial updates.  Keys that the table does not have are left out.
        """
        if not self.partial_updates:
            raise ColumnMismatchError("a soft delete needs a table with partial updates")
        names = [named(k) for k in self.keys]
        marked = keys.select(*names, (F.current_timestamp() if moment is None else moment).alias(column))
        among = keys.select(*[named(k).cast(self._types[k]).alias(i) for k, i in zip(self.keys, self._k)])
        held = self._present(self._state(self._snapshot(), among=among))
        # A deletion is ordered like the row it deletes, and comes after it.
        carried = held.select(*names, *[named(c) for c in self.sequence_by])
        return self._append(marked.join(carried, self.keys), None, 0, held=True)

    def _append(
        self,
        df: DataFrame,
        writer: str | None,
        epoch: int,
        *,
        absent_only: bool = False,
        changed_only: bool = False,
        held: bool = False,
    ) -> bool:
        if writer is not None and (not writer or "." in writer or "/" in writer):
            raise ValueError("a writer name may not be empty and may hold no dot or slash")
        now = self._snapshot()
        if writer and epoch <= now.last_epoch(writer):
            return False
        rows = self._internal(df)
        if not held:
            rows = self._complete(rows, df.columns, now)
        if absent_only:
            rows = self._absent(rows, now)
        if changed_only:
            rows = self._changed(rows, now)
        folder = f"{now.last_batch + 1:012d}-{uuid4().hex[:12]}"
        rows.write.mode("overwrite").parquet(f"{self.path}/log/{folder}")
        return self._commit(folder, writer or "", epoch, now.last_batch if absent_only else None)

    def _commit(self, folder: str, writer: str, epoch: int, seen: int | None) -> bool:
        """Make a written folder the next batch; ``seen`` is the last batch that its rows depend on."""
        while True:
            now = self._snapshot()
            if writer and epoch <= now.last_epoch(writer):
                return False
            if seen is not None and now.last_batch != seen:
                raise ConcurrentWriteError(f"{self.path} was changed by another writer")
            commit = Commit(now.last_batch + 1, epoch, writer, folder)
            try:
                storage.put_text(self.spark, f"{self.path}/commits/{commit.marker}", json.dumps(commit[1:]))
                return True
            except FileExistsError:
                if self._snapshot().last_batch < commit.batch:
                    raise

    def _complete(self, rows: DataFrame, given: Sequence[str], now: Snapshot) -> DataFrame:
        """``rows``, failing where a required column is left out and the table lacks the key."""
        have = {c.lower() for c in given}
        omitted = [c for c in required_columns(self.schema) if c.lower() not in have]
        if not omitted:
            return rows
        state = self._state(now, among=rows.select(*self._k))
        if state is None:
            marked = rows.withColumn("_held", F.lit(None).cast("boolean"))
        else:
            marked = rows.join(state.select(*self._k, F.lit(True).alias("_held")), self._k, "left")
        key = F.when(not_null(F.col("_held"), ", ".join(omitted)), F.col(self._k[0]))
        return marked.withColumn(self._k[0], key).select(*rows.columns)

    def _changed(self, rows: DataFrame, now: Snapshot) -> DataFrame:
        """The winner per key of ``rows``, where it differs from what the table holds."""
        flags = [f"_s{i}" for i in range(len(self._v))] if self.partial_updates else []
        if not self._v:
            best = rows.distinct()
        elif self.partial_updates:
            led = [F.col(self._v[i]).alias(f"q{i}") for i in range(len(self.sequence_by))]
            cells = [F.max(F.struct(*led, F.col(v).alias("v"))).alias(v) for v in self._v]
            reduced = rows.groupBy(*self._k).agg(*cells, *[F.max(s).alias(s) for s in flags])
            best = reduced.select(*self._k, *[F.col(f"{v}.v").alias(v) for v in self._v], *flags)
        else:
            reduced = rows.groupBy(*self._k).agg(F.max(F.struct(*self._v)).alias("row"))
            best = reduced.select(*self._k, "row.*")
        state = self._state(now)
        if state is None:
            return best
        cells = [F.col(f"_g{i}.v" if self.partial_updates else f"_g0.{v}") for i, v in enumerate(self._v)]
        current = state.select(*self._k, F.lit(True).alias("_held"), *[c.alias(f"_c{i}") for i, c in enumerate(cells)])
        differs = F.col("_held").isNull()
        for i, v in enumerate(self._v):
            other = ~F.col(v).eqNullSafe(F.col(f"_c{i}"))
            differs = differs | (F.col(flags[i]) & other if flags else other)
        return best.join(current, self._k, "left").where(differs).select(*best.columns)

    def _internal(self, df: DataFrame) -> DataFrame:
        given: dict[str, list[int]] = {}
        for i, name in enumerate(df.columns):
            given.setdefault(name.lower(), []).append(i)
        declared = {c.lower(): c for c in self._types}
        repeated = [n for n, at in given.items() if len(at) > 1]
        extra = [n for n in given if n not in declared]
        needed = [*self.keys, *self.sequence_by] if self.partial_updates else list(self._types)
        missing = [c for c in needed if c.lower() not in given]
        if repeated or extra or missing:
            raise ColumnMismatchError(f"missing columns {missing}, unknown columns {extra}, repeated columns {repeated}")
        safe = df.toDF(*[f"_p{i}" for i in range(len(df.columns))])
        required = {*required_columns(self.schema), *self.sequence_by}

        def stored(name: str) -> Column:
            if name.lower() not in given:
                return F.lit(None).cast(self._types[name])
            column = F.col(f"_p{given[name.lower()][0]}").cast(self._types[name])
            return not_null(column, name) if name in required else column

        columns = [stored(c).alias(i) for c, i in zip([*self.keys, *self._values], [*self._k, *self._v])]
        if self.partial_updates:
            columns += [F.lit(c.lower() in given).alias(f"_s{i}") for i, c in enumerate(self._values)]
        return safe.select(*columns)

    def _absent(self, rows: DataFrame, now: Snapshot) -> DataFrame:
        """First row per key of ``rows``, without the keys that the table already holds."""
        carried = [c for c in rows.columns if c not in self._k]
        if carried:
            first = rows.groupBy(*self._k).agg(F.min(F.struct(*carried)).alias("row")).select(*self._k, "row.*")
        else:
            first = rows.distinct()
        log, base = self._log(now), self._base(now)
        if log is not None:
            # Only the log's rows with one of these keys are reduced.
            logged = log.select(*self._k).join(first.select(*self._k), self._k, "left_semi")
            first = first.join(logged.distinct(), self._k, "left_anti")
        # The base holds each key once and is bucketed by key: this side is not shuffled.
        return first if base is None else first.join(base.select(*self._k), self._k, "left_anti")

    # ---- reading

    def read(self, where: str | Column | Sequence[str | Column] | None = None) -> DataFrame:
        """All columns in declared order, one row per key.

        ``where``, a condition or a list of them, may use key columns only.  It
        is applied below the merge, so it reaches the Parquet scans and prunes
        buckets of the base.
        """
        return self._present(self._state(self._snapshot(), where))

    def is_on_keys(self, condition: str | Column) -> bool:
        """Whether a condition can be told from the key columns alone."""
        struct = T.StructType([T.StructField(k, self._types[k]) for k in self.keys])
        empty = self.spark.createDataFrame([], struct)
        try:
            empty.where(condition)
        except AnalysisException:
            return False
        return True

    def _present(self, state: DataFrame | None) -> DataFrame:
        if state is None:
            return self.spark.createDataFrame([], self._struct())
        columns = {k: F.col(i) for k, i in zip(self.keys, self._k)}
        for i, name in enumerate(self._values):
            columns[name] = F.col(f"_g{i}.v" if self.partial_updates else f"_g0._v{i}")
        return state.select(*[columns[c].alias(c) for c in self._types])

    def lookup(self, **key: Any) -> DataFrame:
        """The row of one key, or no row."""
        if sorted(key) != sorted(self.keys):
            raise ColumnMismatchError(f"give exactly the key columns {self.keys}")
        condition = F.lit(True)
        for name, value in key.items():
            condition = condition & (named(name) == F.lit(value))
        return self.read(condition)

    def changes(self, commits: Sequence[Commit]) -> DataFrame:
        """The rows that these commits (consecutive ones) made different or new, as they are after the last one.

        Only the keys that the commits wrote are looked up, in the state before them
        and in the one after.  If a compaction folded some of them, the state
        before is gone, and all rows that they wrote are returned.
        """
        now = self._snapshot()
        first, last = min(c.batch for c in commits), max(c.batch for c in commits)
        touched = self._log(Snapshot(now.version, list(commits))).select(*self._k).distinct()

        def at(batch: int) -> DataFrame:
            then = Snapshot(now.version, [c for c in now.commits if c.batch <= batch])
            return self._present(self._state(then, among=touched))

        after = at(last)
        if now.version["folded"] >= first:
            return after
        names = [f"c{i}" for i in range(len(self._types))]
        keys = [n for n, c in zip(names, self._types) if c in self.keys]
        others = [n for n in names if n not in keys] or keys
        old = at(first - 1).toDF(*names).select(*[F.col(k).alias(f"old_{k}") for k in keys], F.struct(*others).alias("old"))
        same = reduce(and_, [F.col(k) == F.col(f"old_{k}") for k in keys]) & F.struct(*others).eqNullSafe(F.col("old"))
        changed = after.toDF(*names).join(old, same, "left_anti")
        return changed.toDF(*self._types)

    def _struct(self) -> T.StructType:
        return T.StructType([T.StructField(name, kind) for name, kind in self._types.items()])

    def _groups(self) -> list[tuple[str, Column]]:
        """State columns: what each one is the maximum of."""
        order = [F.col(self._v[i]).alias(f"q{i}") for i in range(len(self.sequence_by))]
        if not self.partial_updates:
            led = [F.col(v) for v in self._v[: len(self.sequence_by)]]
            rest = [F.col(v) for v in self._v[len(self.sequence_by) :]]
            return [("_g0", F.struct(*led, F.col("_batch"), *rest))]
        return [
            (f"_g{i}", F.when(F.col(f"_s{i}"), F.struct(*order, F.col("_batch"), F.col(v).alias("v"))))
            for i, v in enumerate(self._v)
        ]

    def _state(
        self,
        now: Snapshot,
        where: str | Column | Sequence[str | Column] | None = None,
        among: DataFrame | None = None,
    ) -> DataFrame | None:
        """One row per key: the keys and the winning structs, by position.

        The log is reduced to one row per key and then meets the base in a join
        on the base's buckets, which are not shuffled.  ``among`` keeps the keys
        that it has, on both sides, before they are reduced and joined.
        """

        def kept(rows: DataFrame) -> DataFrame:
            rows = self._restrict(rows, where)
            return rows if among is None else rows.join(among, self._k, "left_semi")

        log, base = self._log(now), self._base(now)
        if log is not None:
            groups = self._groups()
            maxima = [F.max(value).alias(name) for name, value in groups] or [F.max("_batch").alias("_g")]
            log = kept(log).groupBy(*self._k).agg(*maxima)
        if base is not None:
            base = kept(base)
        if log is None or base is None:
            return base if log is None else log
        names = [c for c in base.columns if c not in self._k]
        newer = log.select(*self._k, *[F.col(n).alias(f"new_{n}") for n in names])
        merged = [F.greatest(F.col(n), F.col(f"new_{n}")).alias(n) for n in names]
        return base.join(newer, self._k, "full_outer").select(*self._k, *merged)

    def _restrict(self, df: DataFrame, where: str | Column | Sequence[str | Column] | None) -> DataFrame:
        conditions = [where] if isinstance(where, (str, Column)) else list(where or ())
        if not conditions:
            return df
        renamed = df.withColumnsRenamed(dict(zip(self._k, self.keys)))
        for condition in conditions:
            renamed = renamed.where(condition)
        return renamed.withColumnsRenamed(dict(zip(self.keys, self._k)))

    def _log(self, now: Snapshot) -> DataFrame | None:
        if not now.commits:
            return None
        folders = [f"{self.path}/log/{c.folder}" for c in now.commits]
        rows = self.spark.read.schema(self._log_struct()).parquet(*folders)
        folder = F.substring_index(F.substring_index("_metadata.file_path", "/", -2), "/", 1)
        batch = F.substring(folder, 1, 12).cast("long")
        # Folders that met another writer's batch, and became a later one than they are named for.
        moved = [c for c in now.commits if not c.folder.startswith(c.marker)]
        if moved:
            numbers = F.create_map(*[x for c in moved for x in (F.lit(c.folder), F.lit(c.batch).cast("long"))])
            batch = F.coalesce(F.element_at(numbers, folder), batch)
        return rows.withColumn("_batch", batch)

    def _log_struct(self) -> T.StructType:
        fields = [T.StructField(i, self._types[c]) for c, i in zip([*self.keys, *self._values], [*self._k, *self._v])]
        if self.partial_updates:
            fields += [T.StructField(f"_s{i}", T.BooleanType()) for i in range(len(self._values))]
        return T.StructType(fields)

    def _base(self, now: Snapshot) -> DataFrame | None:
        version = now.version
        if not version["folder"]:
            return None
        name = self._base_name(version["folder"])
        # Bucketing is a property of catalog tables; a session that has not
        # seen this version yet declares it over the existing files.
        keys = ", ".join(self._k)
        location = f"{self.path}/base/{version['folder']}".replace("'", "\\'")
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({version['ddl']}) USING parquet "
            f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {version['buckets']} BUCKETS "
            f"LOCATION '{location}'"
        )
        return self.spark.table(name)

    def _snapshot(self) -> Snapshot:
        # Commits are listed before the version is read.  If a compaction ends in
        # between, its version covers some of them, and none is missed.
        markers = storage.names(self.spark, f"{self.path}/commits")
        versions = [n for n in storage.names(self.spark, f"{self.path}/versions") if not n.startswith(".")]
        version = {"version": 0, "folded": -1, "folder": None, "writers": {}, "buckets": self.buckets, "history": []}
        if versions:
            version = json.loads(storage.read_text(self.spark, f"{self.path}/versions/{versions[-1]}"))
        numbers = [int(m) for m in markers if not m.startswith(".")]
        return Snapshot(version, [self._commit_at(n) for n in numbers if n > version["folded"]])

    def _commit_at(self, batch: int) -> Commit:
        return Commit(batch, *json.loads(storage.read_text(self.spark, f"{self.path}/commits/{batch:012d}")))

    # ---- maintenance

    def pending(self) -> int:
        """Committed batches that the next compaction will fold."""
        return len(self._snapshot().commits)

    def compact(self, buckets: int | None = None) -> bool:
        """Fold the log into a new base; readers switch to it when it is complete.

        ``buckets`` changes the number of buckets from here on.
        """
        now = self._snapshot()
        old = now.version
        buckets = buckets or old["buckets"]
        if not now.commits and (not old["folder"] or buckets == old["buckets"]):
            return False
        # A session of its own: its shuffles then have as many partitions as the
        # base has buckets, and writing the buckets needs no shuffle more.
        session = self.spark.newSession()
        session.conf.set("spark.sql.shuffle.partitions", str(buckets))
        session.conf.set("spark.sql.session.timeZone", self.spark.conf.get("spark.sql.session.timeZone"))
        state = KeyedTable.open(session, self.path)._state(now)
        folder = f"{old['version'] + 1:08d}-{uuid4().hex[:12]}"
        (
            state.write.format("parquet")
            .bucketBy(buckets, *self._k)
            .sortBy(*self._k)
            .option("path", f"{self.path}/base/{folder}")
            .saveAsTable(self._base_name(folder))
        )
        writers = dict(old["writers"])
        for c in now.commits:
            if c.writer:
                writers[c.writer] = max(c.epoch, writers.get(c.writer, -1))
        present = storage.names(self.spark, f"{self.path}/base")
        history = [v for v in old["history"] if v["folder"] is None or v["folder"] in present]
        version = {
            "version": old["version"] + 1,
            "folded": now.last_batch,
            "folder": folder,
            "buckets": buckets,
            "writers": writers,
            "history": [*history, {"folder": old["folder"], "folded": old["folded"], "until": time.time()}],
            "ddl": ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in state.schema),
        }
        name = f"{version['version']:08d}.json"
        storage.put_text(self.spark, f"{self.path}/versions/{name}", json.dumps(version))
        if old["folder"]:
            # Its files stay for frames that were planned on them.
            self.spark.sql(f"DROP TABLE IF EXISTS {self._base_name(old['folder'])}")
        return True

    def vacuum(self, *, older_than: float = 0) -> None:
        """Delete log batches and bases that were replaced more than ``older_than`` seconds ago.

        Choose it longer than any reader or write takes; with 0, call it when none is under way.
        """
        version = self._snapshot().version
        if not version["folder"]:
            return
        limit = time.time() - older_than
        kept = [version, *[v for v in version["history"] if v["until"] > limit]]
        oldest = min(v["folded"] for v in kept)
        numbers = [int(m) for m in storage.names(self.spark, f"{self.path}/commits") if not m.startswith(".")]
        live = {self._commit_at(n).folder for n in numbers if n > oldest}
        for number in numbers:
            # The last number stays taken, so that no late writer can commit below it.
            if number < oldest:
                storage.remove(self.spark, f"{self.path}/commits/{number:012d}")
        for folder in storage.names(self.spark, f"{self.path}/log"):
            if int(folder.split("-")[0]) <= oldest and folder not in live:
                storage.remove(self.spark, f"{self.path}/log/{folder}")
        for folder in storage.names(self.spark, f"{self.path}/base"):
            if int(folder.split("-")[0]) <= version["version"] and folder not in [v["folder"] for v in kept]:
                self.spark.sql(f"DROP TABLE IF EXISTS {self._base_name(folder)}")
                storage.remove(self.spark, f"{self.path}/base/{folder}")

    def _base_name(self, folder: str) -> str:
        return f"`{self.database}`.millrace_base_" + folder.replace("-", "_")


def scan_table(spark: SparkSession, path: str, where: str | Column | None = None) -> DataFrame:
    """All rows of a keyed table, columns in declared order."""
    return KeyedTable.open(spark, path).read(where)


def upsert_table(spark: SparkSession, path: str, df: DataFrame, **write: Any) -> bool:
    """Write rows into a keyed table, replacing by key."""
    return KeyedTable.open(spark, path).upsert(df, **write)
