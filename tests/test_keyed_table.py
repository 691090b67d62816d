import os
import random

import pytest
from pyspark.sql import functions as F

from millrace.operators.keyed import absent_rows, first_by_key, latest_by_key
from millrace.sources import storage
from millrace.sources.keyed_table import (
    ColumnMismatchError,
    ConcurrentWriteError,
    KeyedTable,
    NoSuchTableError,
    TableExistsError,
    scan_table,
    upsert_table,
)
from tests.conftest import rows

SCHEMA = [
    {"column_name": "id", "column_type": "biginteger", "nullable": False, "primary_key": True},
    {"column_name": "v", "column_type": "string"},
    {"column_name": "seq", "column_type": "biginteger"},
]
BATCHES = [[(1, "a", 1), (2, "b", 1)], [(1, "c", 3), (3, "d", 1)], [(1, "z", 2), (2, None, 2)]]


LATEST = [(1, "c", 3), (2, None, 2), (3, "d", 1)]


def frame(spark, data, names="id long, v string, seq long"):
    return spark.createDataFrame(data, names)


def sequenced(spark, work, **more):
    return KeyedTable.create(spark, work, SCHEMA, sequence_by=["seq"], **more)


@pytest.mark.parametrize("partial", [False, True])
@pytest.mark.parametrize("compact_after", [(), (1,), (0, 1, 2)])
def test_fixture_batches(spark, work, partial, compact_after):
    table = sequenced(spark, work, partial_updates=partial, buckets=3)
    for n, batch in enumerate(BATCHES):
        assert table.upsert(frame(spark, batch), writer="w", epoch=n)
        if n in compact_after:
            table.compact()
            table.vacuum()
    assert rows(scan_table(spark, work)) == LATEST
    assert not table.upsert(frame(spark, BATCHES[1]), writer="w", epoch=1)
    assert rows(table.read()) == LATEST
    assert upsert_table(spark, work, frame(spark, BATCHES[1]))
    assert rows(table.read()) == LATEST
    assert table.read().columns == ["id", "v", "seq"]


def test_arrival_order_does_not_matter(spark, work):
    results = []
    for turn in range(3):
        batches = list(BATCHES)
        random.Random(turn).shuffle(batches)
        table = sequenced(spark, f"{work}/{turn}")
        for n, batch in enumerate(batches):
            table.upsert(frame(spark, batch))
            if n == turn:
                table.compact()
        results.append(rows(table.read()))
    assert results == [LATEST] * 3


def test_without_sequence_the_later_batch_wins(spark, work):
    table = KeyedTable.create(spark, work, SCHEMA)
    for batch in BATCHES:
        table.upsert(frame(spark, batch))
    assert rows(table.read()) == [(1, "z", 2), (2, None, 2), (3, "d", 1)]


def test_insert_if_absent(spark, work):
    table = sequenced(spark, work)
    table.insert_if_absent(frame(spark, BATCHES[0]))
    table.compact()
    for batch in BATCHES[1:]:
        table.insert_if_absent(frame(spark, batch))
    assert rows(table.read().select("id", "v")) == [(1, "a"), (2, "b"), (3, "d")]
    table.insert_if_absent(frame(spark, [(9, "late", 5), (9, "early", 4)]))
    assert rows(table.lookup(id=9)) == [(9, "early", 4)]


def test_partial_updates_keep_other_columns(spark, work):
    schema = [*SCHEMA[:2], {"column_name": "w", "column_type": "double"}]
    table = KeyedTable.create(spark, work, schema, partial_updates=True)
    table.upsert(frame(spark, [(1, "a", 1.5), (2, "b", 2.5)], "id long, v string, w double"))
    table.upsert(frame(spark, [(1, None)], "id long, v string"))
    table.compact()
    table.upsert(frame(spark, [(2, 9.5), (3, 3.5)], "id long, w double"))
    assert rows(table.read()) == [(1, None, 1.5), (2, "b", 9.5), (3, None, 3.5)]


def test_soft_delete_leaves_out_unknown_keys(spark, work):
    schema = [*SCHEMA[:2], {"column_name": "tombstone", "column_type": "timestamp"}]
    table = KeyedTable.create(spark, work, schema, partial_updates=True)
    table.upsert(frame(spark, [(1, "a"), (2, "b")], "id long, v string"))
    table.soft_delete(frame(spark, [(2,), (9,)], "id long"))
    assert rows(table.read().selectExpr("id", "v", "tombstone IS NULL")) == [(1, "a", True), (2, "b", False)]
    whole = KeyedTable.create(spark, f"{work}/whole", schema)
    with pytest.raises(ColumnMismatchError):
        whole.soft_delete(frame(spark, [(2,)], "id long"))


def test_columns_match_by_name_and_are_cast(spark, work):
    table = sequenced(spark, work)
    table.upsert(frame(spark, [("7", 3, "x")], "SEQ string, ID int, V string"))
    assert rows(table.read()) == [(3, "x", 7)]
    with pytest.raises(ColumnMismatchError, match="missing columns \\['v'\\]"):
        table.upsert(frame(spark, [(1, 1)], "id long, seq long"))
    with pytest.raises(ColumnMismatchError, match="unknown columns \\['more'\\]"):
        table.upsert(frame(spark, [(1, "a", 1, 2)], "id long, v string, seq long, more int"))
    with pytest.raises(ColumnMismatchError, match="repeated"):
        table.upsert(frame(spark, [(1, "a", 1)]).select("*", F.lit(2).alias("V")))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        table.upsert(frame(spark, [("x", "a", 1)], "id string, v string, seq long"))
    assert rows(table.read()) == [(3, "x", 7)]


@pytest.mark.parametrize("bad", [(None, "a", 1), (1, "a", None)])
def test_null_key_or_sequence_fails_and_leaves_nothing(spark, work, bad):
    table = sequenced(spark, work)
    table.upsert(frame(spark, BATCHES[0]))
    with pytest.raises(Exception, match="NOT NULL violated"):
        table.upsert(frame(spark, [bad, (5, "q", 1)]))
    assert rows(table.read().select("id")) == [(1,), (2,)]


def test_lifecycle(spark, work):
    with pytest.raises(NoSuchTableError):
        KeyedTable.open(spark, work)
    with pytest.raises(NoSuchTableError):
        KeyedTable.drop(spark, work)
    KeyedTable.drop(spark, work, if_exists=True)
    table = sequenced(spark, work)
    assert rows(table.read()) == [] and table.read().columns == ["id", "v", "seq"]
    assert not table.compact()
    with pytest.raises(TableExistsError):
        sequenced(spark, work)
    assert KeyedTable.create(spark, work, SCHEMA, if_not_exists=True).sequence_by == ["seq"]
    table.upsert(frame(spark, BATCHES[0]))
    table.compact()
    KeyedTable.drop(spark, work)
    assert not os.path.exists(work)
    with pytest.raises(ColumnMismatchError):
        KeyedTable.create(spark, work, SCHEMA, sequence_by=["nope"])


def test_crashed_write_is_invisible(spark, work, monkeypatch):
    table = sequenced(spark, work)
    table.upsert(frame(spark, BATCHES[0]), writer="w", epoch=0)

    def crash(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(storage, "put_text", crash)
        with pytest.raises(OSError):
            table.upsert(frame(spark, [(1, "ghost", 99)]), writer="w", epoch=1)
    assert rows(table.read()) == [(1, "a", 1), (2, "b", 1)]
    assert table.upsert(frame(spark, BATCHES[1]), writer="w", epoch=1)
    assert rows(table.read()) == [(1, "c", 3), (2, "b", 1), (3, "d", 1)]
    table.compact()
    table.vacuum()
    assert len(os.listdir(f"{work}/log")) == 0 or all(n.startswith(".") for n in os.listdir(f"{work}/log"))
    assert rows(table.read()) == [(1, "c", 3), (2, "b", 1), (3, "d", 1)]


def test_replaced_files_stay_for_their_readers(spark, work):
    table = sequenced(spark, work)
    seen = []
    for n, batch in enumerate(BATCHES):
        table.upsert(frame(spark, batch), writer="w", epoch=n)
        seen.append((table.read(), rows(table.read())))
        table.compact()
        table.vacuum(older_than=3600)
    # Each frame was planned before some compactions and still gives its rows.
    assert [rows(df) for df, _ in seen] == [found for _, found in seen]
    assert len(os.listdir(f"{work}/base")) == 3
    table.vacuum()
    assert len(os.listdir(f"{work}/base")) == 1
    assert rows(table.read()) == LATEST
    assert not table.upsert(frame(spark, BATCHES[0]), writer="w", epoch=2)


def test_only_named_writers_are_remembered(spark, work):
    table = sequenced(spark, work)
    table.upsert(frame(spark, BATCHES[0]))
    table.upsert(frame(spark, BATCHES[1]), writer="feed", epoch=4)
    table.compact()
    assert table._snapshot().version["writers"] == {"feed": 4}
    assert not table.upsert(frame(spark, BATCHES[2]), writer="feed", epoch=3)
    with pytest.raises(ValueError):
        table.upsert(frame(spark, BATCHES[2]), writer="a.b")


def meanwhile(monkeypatch, table, act):
    """Let ``act`` happen between the last look of ``table``'s writer and its commit."""
    put = storage.put_text

    def late(spark, path, text):
        if "/commits/" in path:
            monkeypatch.setattr(storage, "put_text", put)
            act()
        put(spark, path, text)

    monkeypatch.setattr(storage, "put_text", late)


@pytest.mark.parametrize("cleaned", [False, True])
def test_no_write_is_lost_beside_another(spark, work, monkeypatch, cleaned):
    table = sequenced(spark, work)
    other = KeyedTable.open(spark, work)

    def act():
        other.upsert(frame(spark, BATCHES[0]))
        if cleaned:
            other.compact()
            other.vacuum(older_than=3600)

    meanwhile(monkeypatch, table, act)
    assert table.upsert(frame(spark, BATCHES[1]))
    assert table._snapshot().last_batch == 1
    assert rows(table.read()) == [(1, "c", 3), (2, "b", 1), (3, "d", 1)]
    table.compact()
    assert rows(table.read()) == [(1, "c", 3), (2, "b", 1), (3, "d", 1)]


def test_later_batch_wins_after_a_race(spark, work, monkeypatch):
    table = KeyedTable.create(spark, work, SCHEMA)
    meanwhile(monkeypatch, table, lambda: KeyedTable.open(spark, work).upsert(frame(spark, [(1, "z", 1)])))
    table.upsert(frame(spark, [(1, "a", 1)]))
    assert rows(table.read()) == [(1, "a", 1)]


def test_absent_keys_are_not_written_over_another_writers(spark, work, monkeypatch):
    table = sequenced(spark, work)
    meanwhile(monkeypatch, table, lambda: KeyedTable.open(spark, work).upsert(frame(spark, BATCHES[0])))
    with pytest.raises(ConcurrentWriteError):
        table.insert_if_absent(frame(spark, BATCHES[1]))
    assert rows(table.read()) == [(1, "a", 1), (2, "b", 1)]


def test_soft_delete_of_sequenced_rows(spark, work):
    schema = [*SCHEMA, {"column_name": "tombstone", "column_type": "timestamp"}]
    table = KeyedTable.create(spark, work, schema, sequence_by=["seq"], partial_updates=True)
    table.upsert(frame(spark, BATCHES[0]))
    table.compact()
    table.soft_delete(frame(spark, [(2,), (2,), (9,)], "id long"))
    found = table.read().selectExpr("id", "v", "seq", "tombstone IS NULL")
    assert rows(found) == [(1, "a", 1, True), (2, "b", 1, False)]


def test_partial_insert_needs_required_columns(spark, work):
    schema = [*SCHEMA[:2], {"column_name": "w", "column_type": "double", "nullable": False}]
    table = KeyedTable.create(spark, work, schema, partial_updates=True)
    with pytest.raises(Exception, match="NOT NULL violated"):
        table.upsert(frame(spark, [(1, "a")], "id long, v string"))
    table.upsert(frame(spark, [(1, "a", 1.5)], "id long, v string, w double"))
    table.upsert(frame(spark, [(1, "b")], "id long, v string"))
    with pytest.raises(Exception, match="NOT NULL violated"):
        table.upsert(frame(spark, [(1, "c"), (2, "c")], "id long, v string"))
    assert rows(table.read()) == [(1, "b", 1.5)]


@pytest.mark.parametrize("partial", [False, True])
def test_only_changed_rows_are_logged(spark, work, partial):
    table = KeyedTable.create(spark, work, SCHEMA, partial_updates=partial)
    data = [(1, "a", 1), (1, "b", 2), (2, None, None)]
    table.upsert(frame(spark, data), changed_only=True)
    held = rows(table.read())
    for _ in range(2):
        table.upsert(frame(spark, data), changed_only=True)
        assert table._log(table._snapshot()).count() == 2
        assert rows(table.read()) == held
    table.upsert(frame(spark, [(2, "x", None), (3, "y", 1)]), changed_only=True)
    assert table._log(table._snapshot()).count() == 4


def test_composite_key_and_odd_names(spark, work):
    schema = [
        {"column_name": "a b", "column_type": "string", "nullable": False, "primary_key": True},
        {"column_name": "x.y", "column_type": "integer", "nullable": False, "primary_key": True},
        {"column_name": "_v0", "column_type": "boolean"},
    ]
    table = KeyedTable.create(spark, work, schema, buckets=2)
    names = ["a b", "x.y", "_v0"]
    table.upsert(spark.createDataFrame([("p", 1, True), ("p", 2, False)]).toDF(*names))
    table.compact()
    table.upsert(spark.createDataFrame([("p", 1, False)]).toDF(*names))
    assert rows(table.read()) == [("p", 1, False), ("p", 2, False)]
    assert rows(table.lookup(**{"a b": "p", "x.y": 2})) == [("p", 2, False)]
    with pytest.raises(ColumnMismatchError):
        table.lookup(**{"a b": "p"})


def test_key_only_table(spark, work):
    table = KeyedTable.create(spark, work, SCHEMA[:1])
    for _ in range(2):
        table.upsert(frame(spark, [(1,), (2,)], "id long"))
        table.compact()
    assert rows(table.read()) == [(1,), (2,)]


def test_new_session_reads_compacted_base(spark, work):
    table = sequenced(spark, work)
    table.upsert(frame(spark, BATCHES[0]))
    table.compact()
    for name in os.listdir(f"{work}/base"):
        spark.sql(f"DROP TABLE default.millrace_base_{name.replace('-', '_')}")
    assert rows(scan_table(spark.newSession(), work)) == [(1, "a", 1), (2, "b", 1)]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def users(spark, work, events):
    schema = [
        {"column_name": "user_id", "column_type": "biginteger", "nullable": False, "primary_key": True},
        {"column_name": "event_id", "column_type": "biginteger"},
    ]
    table = KeyedTable.create(spark, work, schema, sequence_by=["event_id"], buckets=4)
    table.upsert(events.select("user_id", "event_id"))
    table.compact()
    return table


def test_compacted_read_has_no_shuffle(users):
    assert "Exchange" not in plan(users.read())
    assert "ReadSchema: struct<_k0:bigint>" in plan(users.read().select("user_id"))


def test_log_is_merged_bucket_by_bucket(users, events):
    users.upsert(events.select("user_id", "event_id").limit(5))
    merged = plan(users.read())
    base_side = merged.split("millrace_base")[0].split("FullOuter")[1]
    assert "Bucketed: true" in merged and "Exchange" not in base_side
    assert plan(users.read("user_id = 3")).count("EqualTo(_k0,3)") == 2
    assert users.is_on_keys("user_id = 3") and not users.is_on_keys("user_id = event_id")


def test_buckets_change_on_request_only(users, events):
    assert users._snapshot().version["buckets"] == 4
    before = rows(users.read())
    assert not users.compact() and users.compact(buckets=6)
    users.upsert(events.select("user_id", "event_id"))
    users.compact()
    assert users._snapshot().version["buckets"] == 6
    assert rows(users.read()) == before


def test_write_has_no_shuffle(spark, work, events):
    table = sequenced(spark, work)
    rows_in = table._internal(events.selectExpr("user_id AS id", "event_type AS v", "event_id AS seq"))
    assert "Exchange" not in plan(rows_in)


def test_latest_and_first_by_key(spark):
    df = frame(spark, [r for b in BATCHES for r in b])
    assert rows(latest_by_key(df, ["id"], ["seq"])) == LATEST
    assert rows(first_by_key(df, ["id"], ["seq"])) == [(1, "a", 1), (2, "b", 1), (3, "d", 1)]
    assert rows(latest_by_key(df.select("id"), ["id"], [])) == [(1,), (2,), (3,)]
    assert rows(absent_rows(df, frame(spark, [(1,), (1,)], "id long"), ["id"])) == [(2, "b", 1), (2, None, 2), (3, "d", 1)]
    with pytest.raises(ValueError):
        latest_by_key(df, [], ["seq"])


def test_hot_key_is_reduced_before_the_shuffle(spark):
    df = spark.range(0, 100000, 1, 4).select(F.lit(1).alias("k"), F.col("id").alias("seq"))
    latest = latest_by_key(df, ["k"], ["seq"])
    assert rows(latest) == [(1, 99999)]
    text = plan(latest)
    assert text.index("partial_max") > text.index("Exchange")


def merged_by_hand(writes, partial):
    """What the table must hold: per key and column, the value of the greatest (sequence, batch)."""
    state = {}
    for batch, (columns, data) in enumerate(writes):
        for row in data:
            given = dict(zip(columns, row))
            key, seq = given.pop("id"), given["seq"]
            cells = state.setdefault(key, {})
            if partial:
                for name, value in given.items():
                    order = (seq, batch, value is not None, str(value))
                    if name not in cells or order > cells[name][0]:
                        cells[name] = (order, value)
            else:
                order = (seq, batch, given["v"] is not None, str(given["v"]))
                if not cells or order > cells["v"][0]:
                    cells["v"], cells["seq"] = (order, given["v"]), (order, seq)
    return sorted(
        ((key, cells.get("v", (0, None))[1], cells["seq"][1]) for key, cells in state.items()),
        key=lambda r: tuple((x is None, str(x)) for x in r),
    )


@pytest.mark.parametrize("turn", range(2))
@pytest.mark.parametrize("partial", [False, True])
def test_random_writes_against_a_model(spark, work, partial, turn):
    random_ = random.Random(turn)
    table = sequenced(spark, work, partial_updates=partial, buckets=random_.choice([1, 2, 5]))
    writes = []
    for _ in range(6):
        columns = ["id", "seq"] if partial and random_.random() < 0.4 else ["id", "seq", "v"]
        data = [
            (random_.randint(0, 6), random_.randint(0, 9), random_.choice(["a", "b", None]))[: len(columns)]
            for _ in range(random_.randint(1, 12))
        ]
        kinds = {"id": "id long", "seq": "seq long", "v": "v string"}
        table.upsert(frame(spark, data, ", ".join(kinds[c] for c in columns)))
        writes.append((columns, data))
        if random_.random() < 0.35:
            table.compact()
        if random_.random() < 0.3:
            table.vacuum()
    assert rows(table.read()) == merged_by_hand(writes, partial)


def test_base_in_a_database_of_its_own(spark, work):
    spark.sql("CREATE DATABASE IF NOT EXISTS bases")
    schema = [
        {"column_name": "id", "column_type": "integer", "primary_key": True},
        {"column_name": "v", "column_type": "string"},
    ]
    table = KeyedTable.create(spark, work, schema, buckets=2, database="bases")
    for value in ("a", "b"):
        table.upsert(spark.createDataFrame([(1, value)], "id int, v string"))
        table.compact()
    assert rows(scan_table(spark, work)) == [(1, "b")]
    assert spark.sql("SHOW TABLES IN bases").count() == 1
    KeyedTable.drop(spark, work)
    assert spark.sql("SHOW TABLES IN bases").count() == 0
