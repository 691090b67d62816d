"""One runnable query per operator, each with the SQL that must give the same rows.

Every query reads whole tables from a directory of Parquet files.  Queries that
land, publish or load write into a new directory under the session's shared
folder and read the result back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.ids import row_id
from millrace.functions.rows import cast_all_to_string, encode_rows, keyed_records
from millrace.functions.schema import Column, check_schema, from_struct
from millrace.operators import constraints, keyed, related
from millrace.operators.project import matches, project, select_columns
from millrace.plans import flows
from millrace.plans.catalog import Catalog
from millrace.sources import storage
from millrace.sources.datasets import scan_dataset, scan_dataset_stream
from millrace.sources.keyed_table import KeyedTable, scan_table, upsert_table
from millrace.sources.topics import Broker, inspect_topics, publish_keyed, write_topic, write_topic_stream
from millrace.streaming.continuous import quarantined
from millrace.streaming.landing import bucket_of, land_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

ONCE = {"availableNow": True}


def query(sql: str, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name, or under that of the operator it is for."""

    def register(function: Query) -> Query:
        QUERIES[name or function.__name__] = function
        SQL[name or function.__name__] = sql
        return function

    return register


# ---- shared steps


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def workspace(spark: SparkSession) -> str:
    return storage.shared_dir(spark, "millrace")


def land(df: DataFrame, path: str, *, quoted: bool = False) -> list[Column]:
    """Write a frame as landed text; returns the schema to scan it with."""
    encode_rows(df, quoted=quoted).write.text(path)
    return from_struct(df.schema)


def plain(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, as the given tables have them."""
    zoned = [f.name for f in df.schema if f.dataType.typeName() == "timestamp"]
    return df.withColumns({c: F.col(f"`{c}`").cast("timestamp_ntz") for c in zoned}) if zoned else df


def events_schema(*keys: str, **renamed: str) -> list[Column]:
    """Schema of a table that holds event columns."""
    kinds = {
        "event_id": "biginteger",
        "ts": "timestamp",
        "user_id": "biginteger",
        "event_type": "string",
        "value": "double",
        "props": "string",
    }
    kinds = {renamed.get(n, n): k for n, k in kinds.items() if renamed.get(n, n)}
    return [
        {"column_name": n, "column_type": k, "nullable": n not in keys, "primary_key": n in keys}
        for n, k in kinds.items()
    ]


EVENT_LINE = "concat_ws(',', event_id::varchar, ts::varchar, user_id::varchar, event_type, value::varchar, props)"
_KIND, _NO_VIEW = "event_type", "nullif(event_type, 'view')"
LATEST_EVENT = """
    SELECT event_id, ts, user_id, event_type, value, props FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events)
    WHERE rn = 1"""
LATEST_LINE = f"SELECT {EVENT_LINE} AS value FROM ({LATEST_EVENT})"


# ---- scans


@query("SELECT * FROM lineitem")
def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = workspace(spark)
    schema = land(table(spark, sf_dir, "lineitem"), path)
    return plain(scan_dataset(spark, path, schema))


@query(
    "SELECT event_id, ts, user_id, nullif(event_type, 'view') AS event_type, value, "
    "concat('  ', props, ',\"', event_type, '\" ') AS props FROM events"
)
def csv_scan_quoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = workspace(spark)
    rows = project(
        table(spark, sf_dir, "events"),
        [
            "event_id",
            "ts",
            "user_id",
            "nullif(event_type, 'view') AS event_type",
            "value",
            "concat('  ', props, ',\"', event_type, '\" ') AS props",
        ],
    )
    schema = land(rows, path, quoted=True)
    return plain(scan_dataset(spark, path, schema, quoted=True))


@query(
    """SELECT doc_id, text, nullif(lang, 'en') AS lang, concat('\\N', chr(13), chr(10), lang, '\\', ',"n', '\\n ') AS odd,
        CASE WHEN lang = 'en' THEN '\\N' ELSE '' END AS sign FROM documents"""
)
def csv_scan_reversible(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts through landed lines: line breaks, backslashes, separators, NULLs and the sign of NULL come back."""
    path = workspace(spark)
    odd = F.concat(F.lit("\\N\r\n"), "lang", F.lit('\\,"n\\n '))
    sign = F.when(F.col("lang") == "en", "\\N").otherwise("")
    lang = F.expr("nullif(lang, 'en')").alias("lang")
    rows = table(spark, sf_dir, "documents").select("doc_id", "text", lang, odd.alias("odd"), sign.alias("sign"))
    schema = land(rows, path, quoted=True)
    return scan_dataset(spark, path, schema, quoted=True)


@query("SELECT * FROM events")
def csv_scan_zone_free(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times as they are written, in whatever zone the session is."""
    path = workspace(spark)
    schema = land(table(spark, sf_dir, "events"), path)
    return scan_dataset(spark, path, schema, zone_free=True)


@query("SELECT * FROM events")
def stream_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = workspace(spark)
    schema = land(table(spark, sf_dir, "events"), f"{path}/landed")
    scan = scan_dataset_stream(spark, f"{path}/landed", schema, options={"maxFilesPerTrigger": 100})
    written = scan.writeStream.format("parquet").option("path", f"{path}/out")
    written.option("checkpointLocation", f"{path}/checkpoint").trigger(**ONCE).start().awaitTermination()
    return plain(spark.read.parquet(f"{path}/out"))


@query(LATEST_EVENT, name="scan_table")
def table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = workspace(spark)
    KeyedTable.create(spark, path, events_schema("user_id"), sequence_by=["event_id"])
    upsert_table(spark, path, table(spark, sf_dir, "events"))
    return plain(scan_table(spark, path))


# ---- rows to text


@query(f"SELECT {EVENT_LINE} AS value FROM events")
def row_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_rows(table(spark, sf_dir, "events"))


@query(f"SELECT {EVENT_LINE.replace(_KIND, _NO_VIEW)} AS value FROM events")
def row_encode_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_rows(
        table(spark, sf_dir, "events").withColumn("event_type", F.expr("nullif(event_type, 'view')"))
    )


@query(
    """SELECT concat_ws(',', l_orderkey::varchar, l_partkey::varchar, l_suppkey::varchar, l_linenumber::varchar,
        l_quantity::varchar, l_extendedprice::varchar, l_discount::varchar, l_tax::varchar, l_returnflag,
        l_linestatus, l_shipdate::varchar) AS value FROM lineitem"""
)
def row_encode_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_rows(table(spark, sf_dir, "lineitem"))


@query(
    """SELECT event_id::varchar AS event_id, ts::varchar AS ts, user_id::varchar AS user_id, event_type,
        value::varchar AS value, props FROM events""",
    name="cast_all_to_string",
)
def cast_to_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cast_all_to_string(table(spark, sf_dir, "events"))


@query(f"SELECT event_id::varchar AS key, {EVENT_LINE} AS value FROM events")
def keyed_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed_records(table(spark, sf_dir, "events"), "event_id")


# ---- projections and predicates


@query("SELECT event_id AS id, event_type FROM events")
def project_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(table(spark, sf_dir, "events"), ["event_id AS id", "event_type"])


@query(
    """SELECT event_id, upper(event_type) AS kind, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
        CASE WHEN value > 10 THEN 'high' ELSE 'low' END AS band, CAST(year(ts) AS INTEGER) AS y FROM events"""
)
def project_scalar(spark: SparkSession, sf_dir: str) -> DataFrame:
    exprs = [
        "event_id",
        "upper(event_type) AS kind",
        "CAST(get_json_object(props, '$.k') AS INT) AS k",
        "CASE WHEN value > 10 THEN 'high' ELSE 'low' END AS band",
        "year(ts) AS y",
    ]
    return project(table(spark, sf_dir, "events"), exprs)


@query("SELECT count(*) AS n, max(event_id) AS m FROM events")
def project_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(table(spark, sf_dir, "events"), ["count(*) AS n", "max(event_id) AS m"])


@query(
    """SELECT l_orderkey, l_partkey, sum(l_quantity) OVER (PARTITION BY l_orderkey) AS order_quantity,
        CAST(rank() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC) AS INTEGER) AS price_rank
    FROM lineitem"""
)
def project_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows over the few lines of one order; quantities are whole numbers, so their sum is exact."""
    exprs = [
        "l_orderkey",
        "l_partkey",
        "sum(l_quantity) OVER (PARTITION BY l_orderkey) AS order_quantity",
        "rank() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC) AS price_rank",
    ]
    return project(table(spark, sf_dir, "lineitem"), exprs)


@query("SELECT o_orderkey, unnest(string_split(o_orderpriority, '-')) AS part FROM orders")
def project_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(table(spark, sf_dir, "orders"), ["o_orderkey", "explode(split(o_orderpriority, '-')) AS part"])


@query("SELECT event_id, value >= (SELECT max(c_acctbal) / 100 FROM customer) AS large FROM events")
def project_subquery(spark: SparkSession, sf_dir: str) -> DataFrame:
    limit = f"(SELECT max(c_acctbal) / 100 FROM parquet.`{sf_dir}/customer.parquet`)"
    return project(table(spark, sf_dir, "events"), ["event_id", f"value >= {limit} AS large"])


@query("SELECT l_orderkey AS id, l_quantity FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 10")
def project_where(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(
        table(spark, sf_dir, "lineitem"),
        ["l_orderkey AS id", "l_quantity"],
        where="l_returnflag = 'R' AND l_quantity > 10",
    )


@query("SELECT o_orderpriority, o_orderkey FROM orders", name="select_columns")
def columns_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select_columns(table(spark, sf_dir, "orders"), "o_orderpriority", "o_orderkey")


@query(
    """SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND nullif(o_orderpriority, '5-LOW') IS NULL
        AND (o_orderkey = 7 OR o_custkey = 7 OR o_totalprice = 1001.91 OR o_custkey = 11)"""
)
def predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = project(table(spark, sf_dir, "orders"), ["*", "nullif(o_orderpriority, '5-LOW') AS p", "o_custkey AS c"])
    wanted = matches(
        equal={"o_orderstatus": "F"},
        null=["p"],
        either={"o_orderkey": 7, "o_custkey": 7, "o_totalprice": 1001.91, "c": 11},
    )
    return orders.where(wanted).select("o_orderkey")


# ---- constraints


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def constraint_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    schema = from_struct(lines.schema, ["l_orderkey", "l_linenumber"])
    return constraints.check_constraints(lines, schema).duplicates


@query("SELECT event_id, user_id FROM events WHERE event_type = 'view'")
def constraint_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = project(table(spark, sf_dir, "events"), ["event_id", "user_id", "nullif(event_type, 'view') AS kind"])
    schema = from_struct(rows.schema, ["event_id", "kind"])
    return constraints.check_constraints(rows, schema).nulls.select("event_id", "user_id")


@query(
    """SELECT 'null' AS problem, user_id, 1 AS n FROM events WHERE event_type = 'view'
    UNION ALL SELECT 'duplicate', user_id, count(*) FROM events GROUP BY user_id HAVING count(*) > 1""",
    name="check_schema",
)
def schema_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What breaks a schema that was declared with its defaults left out: a column is nullable and no key."""
    declared = check_schema(
        [
            {"column_name": "user_id", "column_type": "biginteger", "primary_key": True},
            {"column_name": "kind", "column_type": "string"},
            {"column_name": "value", "column_type": "double", "nullable": False},
        ],
        need_key=True,
    )
    exprs = ["user_id", "nullif(event_type, 'error') AS kind", "if(event_type = 'view', NULL, value) AS value"]
    nulls, duplicates = constraints.check_constraints(project(table(spark, sf_dir, "events"), exprs), declared)
    one = nulls.select(F.lit("null").alias("problem"), "user_id", F.lit(1).cast("bigint").alias("n"))
    return one.unionByName(duplicates.select(F.lit("duplicate").alias("problem"), "user_id", "n"))


# ---- keyed rows and tables


@query(LATEST_EVENT)
def latest_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed.latest_by_key(table(spark, sf_dir, "events"), ["user_id"], ["event_id"])


@query("SELECT user_id, arg_min(event_type, event_id) AS event_type, min(event_id) AS event_id FROM events GROUP BY 1")
def first_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = select_columns(table(spark, sf_dir, "events"), "user_id", "event_type", "event_id")
    return keyed.first_by_key(events, ["user_id"], ["event_id"])


def _event_batches(events: DataFrame) -> list[DataFrame]:
    """The events in three batches that arrive out of order."""
    return [
        events.where("event_type IN ('view', 'signup')"),
        events.where("event_type = 'error'"),
        events.where("event_type NOT IN ('view', 'signup', 'error')"),
    ]


@query(LATEST_EVENT)
def upsert_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = workspace(spark)
    target = KeyedTable.create(spark, path, events_schema("user_id"), sequence_by=["event_id"])
    for number, batch in enumerate(_event_batches(table(spark, sf_dir, "events"))):
        target.upsert(batch, writer="feed", epoch=number)
    return plain(target.read())


@query(LATEST_EVENT)
def upsert_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = workspace(spark)
    target = KeyedTable.create(spark, path, events_schema("user_id"), sequence_by=["event_id"])
    first, second, third = _event_batches(table(spark, sf_dir, "events"))
    target.upsert(first)
    target.upsert(second)
    target.compact()
    target.upsert(third)
    return plain(target.read())


@query(
    """SELECT user_id, max(event_id) AS event_id, arg_max(value, event_id) AS value,
        arg_max(event_type, event_id) FILTER (event_type IN ('view', 'signup')) AS event_type
    FROM events GROUP BY user_id"""
)
def upsert_partial(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = workspace(spark)
    schema = events_schema("user_id", ts="", props="")
    target = KeyedTable.create(spark, path, schema, sequence_by=["event_id"], partial_updates=True)
    whole, errors, others = _event_batches(table(spark, sf_dir, "events"))
    target.upsert(whole.select("user_id", "event_id", "value", "event_type"))
    target.upsert(errors.select("user_id", "event_id", "value"))
    target.compact()
    target.upsert(others.select("user_id", "event_id", "value"))
    return target.read()


@query(
    """WITH ranked AS (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY
            CASE WHEN event_type = 'error' THEN 0 ELSE 1 END, event_id) AS rn FROM events)
    SELECT event_id, ts, user_id, event_type, value, props FROM ranked WHERE rn = 1"""
)
def insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = workspace(spark)
    events = table(spark, sf_dir, "events")
    target = KeyedTable.create(spark, path, events_schema("user_id"), sequence_by=["event_id"])
    target.insert_if_absent(events.where("event_type = 'error'"))
    target.compact()
    target.insert_if_absent(events)
    return plain(target.read())


@query(LATEST_EVENT)
def table_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = workspace(spark)
    events = table(spark, sf_dir, "events")
    KeyedTable.create(spark, path, events_schema("user_id")).upsert(events)
    KeyedTable.drop(spark, path)
    KeyedTable.drop(spark, path, if_exists=True)
    KeyedTable.create(spark, path, events_schema("user_id"), sequence_by=["event_id"], if_not_exists=True)
    KeyedTable.create(spark, path, events_schema("user_id"), if_not_exists=True).upsert(events)
    return plain(scan_table(spark, path))


# ---- soft delete, lookups and related rows


def _tombstoned(events: DataFrame) -> DataFrame:
    return events.withColumn("tombstone", F.when(F.col("event_type") == "error", F.col("ts")))


@query("SELECT event_id, user_id, event_type FROM events WHERE event_type <> 'error'")
def live_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return related.live_rows(_tombstoned(table(spark, sf_dir, "events"))).select("event_id", "user_id", "event_type")


def _soft_deleted(spark: SparkSession, sf_dir: str, path: str) -> KeyedTable:
    """A table of the events in which the errors were deleted."""
    events = table(spark, sf_dir, "events")
    columns = _tombstoned(events).select("event_id", "user_id", "event_type", "tombstone")
    target = KeyedTable.create(spark, path, from_struct(columns.schema, ["event_id"]), partial_updates=True)
    target.upsert(events.select("event_id", "user_id", "event_type"))
    target.soft_delete(events.where("event_type = 'error'"), moment=F.col("ts"))
    return target


@query("SELECT event_id, user_id, event_type FROM events WHERE event_type <> 'error'")
def soft_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = workspace(spark)
    return related.live_rows(_soft_deleted(spark, sf_dir, path).read()).drop("tombstone")


@query("SELECT event_id, user_id, event_type FROM events WHERE event_type <> 'error'")
def soft_delete_sequenced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deletions in a table that orders its changes, with a base below them."""
    events = table(spark, sf_dir, "events")
    columns = _tombstoned(events).select("event_id", "user_id", "event_type", "ts", "tombstone")
    schema = from_struct(columns.schema, ["event_id"])
    target = KeyedTable.create(spark, workspace(spark), schema, sequence_by=["ts"], partial_updates=True)
    target.upsert(columns.drop("tombstone"))
    target.compact()
    target.soft_delete(events.where("event_type = 'error'"), moment=F.col("ts"))
    return related.live_rows(target.read()).drop("tombstone", "ts")


@query(
    """SELECT event_id, user_id, event_type, CASE WHEN event_type = 'error' THEN ts END AS tombstone FROM events""",
    name="dump",
)
def dump_with_deleted(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = workspace(spark)
    return plain(_soft_deleted(spark, sf_dir, path).read())


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey = 7 AND o_orderstatus <> 'P'", name="get_by_key")
def row_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    marked = orders.withColumn("tombstone", F.when(F.col("o_orderstatus") == "P", F.col("o_orderdate")))
    found = related.get_by_key(marked, 7, key="o_orderkey")
    return found.select("o_orderkey", "o_custkey", "o_totalprice")


@query(
    """SELECT event_id, ts, user_id, event_type, value, props FROM events
    WHERE event_id = (SELECT max(event_id) FROM events WHERE user_id = 7)"""
)
def table_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = workspace(spark)
    target = KeyedTable.create(spark, path, events_schema("user_id"), sequence_by=["event_id"])
    first, second, third = _event_batches(table(spark, sf_dir, "events"))
    target.upsert(first.unionByName(second))
    target.compact()
    target.upsert(third)
    return plain(target.lookup(user_id=7))


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_custkey = 7 AND o_orderstatus <> 'P'", name="list_children")
def children_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    marked = orders.withColumn("tombstone", F.when(F.col("o_orderstatus") == "P", F.col("o_orderdate")))
    return related.list_children(marked, 7, parent_column="o_custkey").select("o_orderkey", "o_totalprice")


# Orders under their status as parent: an order is labelled by its own key and
# by its customer's, so one label may fit several orders.
_ORDER_LABELS = """
    labels AS (
        SELECT o_orderstatus AS parent, o_orderkey::varchar AS id, o_orderkey::varchar AS label FROM orders
        WHERE o_orderpriority <> '5-LOW'
        UNION
        SELECT o_orderstatus, o_orderkey::varchar, o_custkey::varchar FROM orders WHERE o_orderpriority <> '5-LOW'),
    asked AS (
        SELECT DISTINCT o_orderstatus AS parent, c_custkey::varchar AS label
        FROM (SELECT DISTINCT o_orderstatus FROM orders), customer)"""


def _order_labels(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("parent"),
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_custkey").cast("string").alias("name"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.col("o_orderdate")).alias("tombstone"),
    )
    # Statuses are three fixed values, so asking for each customer under every
    # one of them is a narrow explode.
    statuses = F.explode(F.array(F.lit("F"), F.lit("O"), F.lit("P")))
    asked = table(spark, sf_dir, "customer").select(
        statuses.alias("parent"), F.col("c_custkey").cast("string").alias("label")
    )
    return asked, orders


@query(f"WITH {_ORDER_LABELS} SELECT parent, label, id FROM asked JOIN labels USING (parent, label)")
def find_by_id_or_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked, orders = _order_labels(spark, sf_dir)
    return related.find_labels(asked, orders, parent_column="parent").select("parent", "label", "id")


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND (o_orderkey = 99 OR o_custkey = 99)")
def find_one_by_id_or_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn("tombstone", F.lit(None).cast("timestamp"))
    found = related.find_by_id_or_name(
        orders, 99, parent="F", parent_column="o_orderstatus", id_column="o_orderkey", name_column="o_custkey"
    )
    return found.select("o_orderkey")


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey::varchar = 'Customer#000000007' OR c_name = 'Customer#000000007'")
def find_by_name_numeric_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A name that is no number, asked of rows whose ids are numbers."""
    customers = table(spark, sf_dir, "customer").withColumn("tombstone", F.lit(None).cast("timestamp"))
    found = related.find_by_id_or_name(customers, "Customer#000000007", id_column="c_custkey", name_column="c_name")
    return found.select("c_custkey", "c_name")


@query(
    f"""WITH {_ORDER_LABELS},
    counted AS (SELECT parent, label, count(*) AS n, max((id = label)::int) AS exact, min(id) AS single
        FROM labels GROUP BY parent, label)
    SELECT parent, label,
        CASE WHEN n = 1 THEN single WHEN exact = 1 THEN label END AS id,
        CASE WHEN n IS NULL THEN 'missing' WHEN n = 1 OR exact = 1 THEN 'found' ELSE 'ambiguous' END AS outcome
    FROM asked LEFT JOIN counted USING (parent, label)"""
)
def resolve_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked, orders = _order_labels(spark, sf_dir)
    return related.resolve_labels(asked, orders, parent_column="parent")


@query(
    f"""WITH {_ORDER_LABELS},
    counted AS (SELECT parent, label, count(*) AS n, max((id = label)::int) AS exact, min(id) AS single
        FROM labels GROUP BY parent, label)
    SELECT event_id, parent, label,
        CASE WHEN n = 1 THEN single WHEN exact = 1 THEN label END AS resolved_id,
        CASE WHEN n IS NULL THEN 'missing' WHEN n = 1 OR exact = 1 THEN 'found' ELSE 'ambiguous' END AS outcome
    FROM (SELECT event_id, 'O' AS parent, user_id::varchar AS label FROM events) LEFT JOIN counted USING (parent, label)"""
)
def stream_resolve_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order that each event's user stands for, by its id or its customer, as events are landed."""
    root = workspace(spark)
    schema = land(table(spark, sf_dir, "events"), f"{root}/landed")
    events = scan_dataset_stream(spark, f"{root}/landed", schema, options={"maxFilesPerTrigger": 100})
    asked = events.select("event_id", F.lit("O").alias("parent"), F.col("user_id").cast("string").alias("label"))
    found = related.resolve_label_stream(asked, _order_labels(spark, sf_dir)[1], parent_column="parent")
    written = found.writeStream.format("parquet").option("path", f"{root}/out")
    written.option("checkpointLocation", f"{root}/checkpoint").trigger(**ONCE).start().awaitTermination()
    return spark.read.parquet(f"{root}/out")


@query(
    """SELECT c_custkey AS parent, 'self' AS "group", c_name, c_acctbal, NULL::bigint AS o_orderkey,
        NULL::double AS o_totalprice, NULL::bigint AS event_id FROM customer
    UNION ALL SELECT o_custkey, 'orders', NULL, NULL, o_orderkey, o_totalprice, NULL FROM orders
        WHERE o_custkey IN (SELECT c_custkey FROM customer)
    UNION ALL SELECT user_id, 'events', NULL, NULL, NULL, NULL, event_id FROM events
        WHERE event_type <> 'error' AND user_id IN (SELECT c_custkey FROM customer)"""
)
def gather_related(spark: SparkSession, sf_dir: str) -> DataFrame:
    children = {
        "orders": (table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice"), "o_custkey"),
        "events": (
            related.live_rows(_tombstoned(table(spark, sf_dir, "events"))).select("user_id", "event_id"),
            "user_id",
        ),
    }
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    gathered = related.related_rows(customers, "c_custkey", children)
    return gathered.select("parent", "group", "c_name", "c_acctbal", "o_orderkey", "o_totalprice", "event_id")


def _flow_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as flow rows: the customer is the dataset and, unless urgent, the priority is the table."""
    return project(
        table(spark, sf_dir, "orders"),
        [
            "o_orderkey AS id",
            "o_custkey AS dataset_id",
            "nullif(o_orderpriority, '1-URGENT') AS data_table_id",
            "if(o_orderstatus = 'F', 'load', 'output') AS flow_kind",
            "if(o_totalprice > 400000, o_orderdate, NULL) AS tombstone",
        ],
    )


@query(
    """SELECT o_orderkey AS id, o_custkey AS dataset_id FROM orders
    WHERE o_orderstatus <> 'F' AND o_orderpriority = '1-URGENT' AND o_totalprice <= 400000"""
)
def outputs_null_parent(spark: SparkSession, sf_dir: str) -> DataFrame:
    outputs = _flow_rows(spark, sf_dir).where(matches(equal={"flow_kind": "output"}, null=["data_table_id"]))
    return related.live_rows(outputs).select("id", "dataset_id")


@query(
    """SELECT o_orderkey AS id, o_custkey AS dataset_id FROM orders
    WHERE o_orderstatus <> 'F' AND o_orderpriority = '2-HIGH' AND o_totalprice <= 400000"""
)
def outputs_of_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    outputs = _flow_rows(spark, sf_dir).where(matches(equal={"flow_kind": "output", "data_table_id": "2-HIGH"}))
    return related.live_rows(outputs).select("id", "dataset_id")


def _order_catalog(spark: SparkSession, sf_dir: str) -> Catalog:
    """A catalog with a flow for every order; the priorities of a dataset's orders are its tables."""
    root = workspace(spark)
    catalog = Catalog(spark, root, topics_below(root))
    orders = project(
        table(spark, sf_dir, "orders"),
        [
            "concat('flow-', o_orderkey) AS id",
            "concat('dataset-', o_custkey % 10) AS dataset_id",
            "o_orderpriority AS name",
            "concat('table_', o_custkey % 10, left(o_orderpriority, 1)) AS table_id",
            "if(o_orderstatus = 'F', 'load', 'output') AS flow_kind",
            "CAST(o_orderdate AS TIMESTAMP) AS timestamp",
            "CAST(if(o_totalprice > 400000, o_orderdate, NULL) AS TIMESTAMP) AS tombstone",
        ],
    )
    tables = orders.select(F.col("table_id").alias("id"), "dataset_id", "name").distinct()
    upsert_table(spark, f"{root}/catalog/data_tables", tables)
    of_table = F.when(F.col("name") != "1-URGENT", F.col("table_id")).alias("data_table_id")
    flow_rows = orders.select("id", "flow_kind", "dataset_id", of_table, "timestamp", "tombstone")
    upsert_table(spark, f"{root}/catalog/dataflows", flow_rows)
    return catalog


_LIVE_OUTPUT = "o_custkey % 10 = 7 AND o_orderstatus <> 'F' AND o_totalprice <= 400000"


@query(
    f"""SELECT 'flow-' || o_orderkey AS id, 'dataset-7' AS dataset_id, NULL::varchar AS data_table_id FROM orders
    WHERE {_LIVE_OUTPUT} AND o_orderpriority = '1-URGENT'"""
)
def dataset_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _order_catalog(spark, sf_dir).dataset_outputs("dataset-7").drop("timestamp")


@query(
    f"""SELECT 'flow-' || o_orderkey AS id, 'dataset-7' AS dataset_id, 'table_72' AS data_table_id FROM orders
    WHERE {_LIVE_OUTPUT} AND o_orderpriority = '2-HIGH'"""
)
def table_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _order_catalog(spark, sf_dir).table_outputs("dataset-7", "2-HIGH").drop("timestamp")


@query(
    """SELECT 'flow-' || o_orderkey AS id, CASE WHEN o_orderstatus = 'F' THEN 'load' ELSE 'output' END AS flow_kind,
        'dataset-' || (o_custkey % 10) AS dataset_id, o_totalprice > 400000 AS deleted FROM orders"""
)
def catalog_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _order_catalog(spark, sf_dir).dump("dataflows")
    return rows.select("id", "flow_kind", "dataset_id", F.col("tombstone").isNotNull().alias("deleted"))


@query(
    "SELECT o_orderpriority, count(*) AS n, max(o_totalprice) AS most FROM orders GROUP BY o_orderpriority",
    name="to_records",
)
def summary_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A summary of all orders as records, and these as rows again."""
    orders = table(spark, sf_dir, "orders").groupBy("o_orderpriority")
    summary = orders.agg(F.count("*").alias("n"), F.max("o_totalprice").alias("most"))
    return spark.createDataFrame(related.to_records(summary), summary.schema)


@query("SELECT count(*) AS n, count(*) AS n_distinct, count(*) AS n_well_formed FROM events")
def row_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    shape = "^event-[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$"
    return (
        table(spark, sf_dir, "events")
        .select(row_id("event").alias("id"))
        .agg(
            F.count("id").alias("n"),
            F.countDistinct("id").alias("n_distinct"),
            F.count_if(F.col("id").rlike(shape)).alias("n_well_formed"),
        )
    )


# ---- topics and landing


def _topic(spark: SparkSession, sf_dir: str, root: str, name: str = "events") -> Broker:
    broker = topics_below(root)
    write_topic(encode_rows(table(spark, sf_dir, name)), broker, name)
    return broker


def topics_below(root: str) -> Broker:
    """Topics as folders of Parquet files, through Spark's own source and sink."""
    return Broker({"path": f"{root}/topics/{{topic}}"}, "parquet", "key STRING, value STRING")


def _values(spark: SparkSession, broker: Broker, topic: str) -> DataFrame:
    return broker.read(spark, [topic], {}).select("value")


@query("SELECT strftime(ts, '%Y-%m-%d--%H') AS bucket, count(*) AS n FROM events GROUP BY 1")
def landing_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy(bucket_of(F.col("ts")).alias("bucket")).agg(F.count("*").alias("n"))


@query("SELECT * FROM events")
def topic_to_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = workspace(spark)
    broker = _topic(spark, sf_dir, root)
    flows.topic_to_dataset(
        spark,
        broker,
        "events",
        f"{root}/landed",
        checkpoint=f"{root}/checkpoint",
        start={"earliest": True},
        trigger=ONCE,
    ).awaitTermination()
    return plain(scan_dataset(spark, f"{root}/landed", events_schema()))


@query(
    """SELECT * FROM events UNION ALL
    SELECT o_orderkey, o_orderdate, o_custkey, 'order', o_totalprice, o_orderpriority FROM orders"""
)
def landing_two_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two topics land side by side in one dataset, each under its own checkpoint."""
    root = workspace(spark)
    broker = _topic(spark, sf_dir, root)
    as_events = ["o_orderkey", "o_orderdate", "o_custkey", "'order' AS event_type", "o_totalprice", "o_orderpriority"]
    write_topic(encode_rows(project(table(spark, sf_dir, "orders"), as_events)), broker, "orders")
    landings = [
        flows.topic_to_dataset(
            spark,
            broker,
            topic,
            f"{root}/landed",
            checkpoint=f"{root}/checkpoint-{topic}",
            source=topic,
            start={"earliest": True},
            trigger=ONCE,
        )
        for topic in ("events", "orders")
    ]
    for landing in landings:
        landing.awaitTermination()
    return plain(scan_dataset(spark, f"{root}/landed", events_schema()))


@query(
    """SELECT strftime(o_orderdate, '%Y-%m') AS bucket, count(*) AS n, min(o_orderkey) AS first_key
    FROM orders WHERE strftime(o_orderdate, '%Y-%m') >= '2001-01' GROUP BY 1"""
)
def landed_bucket_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = workspace(spark)
    orders = table(spark, sf_dir, "orders")
    broker = _topic(spark, sf_dir, root, "orders")
    land_stream(
        broker.read_stream(spark, ["orders"], {}).select(F.col("value").cast("string").alias("value")),
        f"{root}/landed",
        checkpoint=f"{root}/checkpoint",
        time=F.to_timestamp(F.split("value", ",")[4]),
        bucket_format="yyyy-MM",
        files_per_bucket=2,
        trigger=ONCE,
    ).awaitTermination()
    landed = scan_dataset(spark, f"{root}/landed", from_struct(orders.schema), bucket="bucket")
    recent = landed.where("bucket >= '2001-01'")
    return recent.groupBy("bucket").agg(F.count("*").alias("n"), F.min("o_orderkey").alias("first_key"))


@query("SELECT * FROM events")
def stream_late_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that come late fill hours that a stream has read before; it reads the new files there."""
    root = workspace(spark)
    broker = topics_below(root)
    for rows in ("event_id % 3 > 0", "event_id % 3 = 0 OR event_id IS NULL"):
        write_topic(encode_rows(table(spark, sf_dir, "events").where(rows)), broker, "events")
        land_stream(
            broker.read_stream(spark, ["events"], {}).select(F.col("value").cast("string").alias("value")),
            f"{root}/landed",
            checkpoint=f"{root}/checkpoint",
            time=F.to_timestamp(F.split("value", ",")[1]),
            bucket_format="yyyy-MM",
            files_per_bucket=1,
            trigger=ONCE,
        ).awaitTermination()
        lines = scan_dataset_stream(spark, f"{root}/landed", events_schema()).writeStream.format("parquet")
        lines.option("path", f"{root}/out").option("checkpointLocation", f"{root}/read").trigger(**ONCE).start().awaitTermination()
    return plain(spark.read.parquet(f"{root}/out"))


@query(f"SELECT {EVENT_LINE} AS value FROM events")
def topic_to_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = workspace(spark)
    broker = _topic(spark, sf_dir, root)
    flows.topic_to_topic(
        spark,
        broker,
        "events",
        "copy",
        checkpoint=f"{root}/checkpoint",
        start={"earliest": True},
        trigger=ONCE,
    ).awaitTermination()
    return _values(spark, broker, "copy")


@query("SELECT doc_id::varchar AS key, text AS value FROM documents")
def topic_of_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts as values: a record, unlike a landed line, may hold line breaks."""
    broker = topics_below(workspace(spark))
    texts = project(table(spark, sf_dir, "documents"), ["CAST(doc_id AS STRING) AS key", "text AS value"])
    write_topic(texts, broker, "documents", keyed=True)
    return broker.read(spark, ["documents"], {})


@query(
    f"""SELECT 'events' AS topic, (user_id % 4)::integer AS partition, event_id AS offset, user_id::varchar AS key, {EVENT_LINE} AS value
    FROM events
    UNION ALL SELECT 'orders', (o_custkey % 4)::integer, o_orderkey, o_custkey::varchar,
        concat_ws(',', o_orderkey::varchar, o_custkey::varchar, o_orderstatus, o_totalprice::varchar,
            o_orderdate::varchar, o_orderpriority) FROM orders""",
    name="inspect_topics",
)
def topics_inspect(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several topics, from records as a broker keeps them; partitions and offsets come from the rows' own columns."""
    path = f"{workspace(spark)}/records"
    for name, key, number in [("events", "user_id", "event_id"), ("orders", "o_custkey", "o_orderkey")]:
        rows = table(spark, sf_dir, name)
        place = [F.lit(name).alias("topic"), (F.col(key) % 4).cast("int").alias("partition"), F.col(number).cast("long").alias("offset")]
        value = F.concat_ws(",", *[F.col(c).cast("string") for c in rows.columns])
        rows.select(*place, F.col(key).cast("string").alias("key"), value.alias("value")).write.mode("append").parquet(path)
    kept = Broker({"path": path}, "parquet", "topic STRING, partition INT, offset BIGINT, key STRING, value STRING")
    return inspect_topics(spark, kept, ["events", "orders"])


@query(
    """SELECT o_orderkey::varchar AS key, concat_ws(',', o_orderkey::varchar, o_custkey::varchar, o_orderstatus,
        o_totalprice::varchar, o_orderdate::varchar, o_orderpriority) AS value FROM orders""",
    name="publish_keyed",
)
def publish_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    broker = topics_below(workspace(spark))
    publish_keyed(table(spark, sf_dir, "orders"), broker, "orders", "o_orderkey")
    return broker.read(spark, ["orders"], {})


# ---- dataflows


@query(LATEST_EVENT)
def dataset_to_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = workspace(spark)
    schema = land(table(spark, sf_dir, "events"), f"{root}/landed")
    KeyedTable.create(spark, f"{root}/table", events_schema("user_id"), sequence_by=["event_id"])
    flows.dataset_to_table(spark, f"{root}/landed", schema, f"{root}/table", ["*"])
    return plain(scan_table(spark, f"{root}/table"))


@query("SELECT concat_ws(',', event_id::varchar, event_type) AS value FROM events")
def dataset_to_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = workspace(spark)
    broker = topics_below(root)
    schema = land(table(spark, sf_dir, "events"), f"{root}/landed")
    flows.dataset_to_topic(spark, f"{root}/landed", schema, broker, "out", ["event_id", "event_type"])
    return _values(spark, broker, "out")


@query(LATEST_LINE)
def table_to_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = workspace(spark)
    broker = topics_below(root)
    target = KeyedTable.create(spark, f"{root}/table", events_schema("user_id"), sequence_by=["event_id"])
    target.upsert(table(spark, sf_dir, "events"))
    target.compact()
    flows.table_to_topic(spark, f"{root}/table", broker, "out")
    return _values(spark, broker, "out")


@query(LATEST_EVENT)
def stream_dataset_to_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = workspace(spark)
    for number, batch in enumerate(_event_batches(table(spark, sf_dir, "events"))):
        schema = land(batch, f"{root}/landed/{number}")
    KeyedTable.create(spark, f"{root}/table", events_schema("user_id"), sequence_by=["event_id"])
    flows.dataset_to_table(
        spark,
        f"{root}/landed",
        schema,
        f"{root}/table",
        ["*"],
        continuous=True,
        checkpoint=f"{root}/checkpoint",
        trigger=ONCE,
        source_options={"maxFilesPerTrigger": 2},
        compact_every=2,
    ).awaitTermination()
    return plain(scan_table(spark, f"{root}/table"))


@query(
    "SELECT event_id, user_id, nullif(event_type, 'view') AS event_type, nullif(event_type, 'view') IS NULL AS quarantined FROM events"
)
def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events go into a table that needs their type; those without one are put aside and the load goes on."""
    root = workspace(spark)
    for number, batch in enumerate(_event_batches(table(spark, sf_dir, "events"))):
        schema = land(batch, f"{root}/landed/{number}")
    target = [
        {"column_name": "event_id", "column_type": "biginteger", "nullable": False, "primary_key": True},
        {"column_name": "user_id", "column_type": "biginteger", "nullable": True},
        {"column_name": "event_type", "column_type": "string", "nullable": False},
    ]
    KeyedTable.create(spark, f"{root}/table", target)
    flows.dataset_to_table(
        spark,
        f"{root}/landed",
        schema,
        f"{root}/table",
        ["event_id", "user_id", "nullif(event_type, 'view') AS event_type"],
        continuous=True,
        checkpoint=f"{root}/checkpoint",
        trigger=ONCE,
        source_options={"maxFilesPerTrigger": 4},
        quarantine=f"{root}/quarantine",
    ).awaitTermination()
    loaded = scan_table(spark, f"{root}/table").withColumn("quarantined", F.lit(False))
    aside = quarantined(spark, f"{root}/quarantine").drop("load", "batch").withColumn("quarantined", F.lit(True))
    return loaded.unionByName(aside)


@query("SELECT 1 AS id, count(*) AS n, max(event_id) AS m, min(event_type) AS first_type FROM events")
def stream_dataset_to_table_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = workspace(spark)
    for number, batch in enumerate(_event_batches(table(spark, sf_dir, "events"))):
        schema = land(batch, f"{root}/landed/{number}")
    target = [
        {"column_name": "id", "column_type": "integer", "nullable": False, "primary_key": True},
        {"column_name": "n", "column_type": "biginteger"},
        {"column_name": "m", "column_type": "biginteger"},
        {"column_name": "first_type", "column_type": "string"},
    ]
    KeyedTable.create(spark, f"{root}/table", target)
    flows.dataset_to_table(
        spark,
        f"{root}/landed",
        schema,
        f"{root}/table",
        ["1 AS id", "count(*) AS n", "max(event_id) AS m", "min(event_type) AS first_type"],
        continuous=True,
        checkpoint=f"{root}/checkpoint",
        trigger=ONCE,
        source_options={"maxFilesPerTrigger": 1},
    ).awaitTermination()
    return scan_table(spark, f"{root}/table")


@query("SELECT l_orderkey, sum(l_quantity) AS order_quantity FROM lineitem GROUP BY l_orderkey")
def stream_dataset_to_table_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of one order arrive in several files, and the window has to see them all."""
    root = workspace(spark)
    lines = table(spark, sf_dir, "lineitem")
    for flag in ("R", "A", "N"):
        schema = land(lines.where(F.col("l_returnflag") == flag), f"{root}/landed/{flag}")
    target = [
        {"column_name": "l_orderkey", "column_type": "biginteger", "nullable": False, "primary_key": True},
        {"column_name": "order_quantity", "column_type": "double"},
    ]
    KeyedTable.create(spark, f"{root}/table", target)
    flows.dataset_to_table(
        spark,
        f"{root}/landed",
        schema,
        f"{root}/table",
        ["l_orderkey", "sum(l_quantity) OVER (PARTITION BY l_orderkey) AS order_quantity"],
        continuous=True,
        checkpoint=f"{root}/checkpoint",
        trigger=ONCE,
    ).awaitTermination()
    return scan_table(spark, f"{root}/table")


_FIRST_HALF = "SELECT * FROM events WHERE event_id % 2 = 0"


@query(
    f"""WITH a AS ({LATEST_EVENT.replace("FROM events", f"FROM ({_FIRST_HALF})")}), b AS ({LATEST_EVENT}),
    c AS (SELECT * FROM a UNION ALL (SELECT * FROM b EXCEPT SELECT * FROM a))
    SELECT {EVENT_LINE} AS value FROM c WHERE event_type <> 'error'"""
)
def stream_table_to_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table's rows as they stand, and after more writes the rows that these changed."""
    root = workspace(spark)
    broker, events = topics_below(root), table(spark, sf_dir, "events")
    target = KeyedTable.create(spark, f"{root}/table", events_schema("user_id"), sequence_by=["event_id"])
    halves = [events.where("event_id % 2 = 0"), events.where("event_id % 2 = 1 AND user_id % 2 = 0"), events]
    for batches in (halves[:1], halves[1:]):
        for batch in batches:
            target.upsert(batch)
        flows.table_to_topic(
            spark,
            f"{root}/table",
            broker,
            "out",
            where="event_type <> 'error'",
            continuous=True,
            checkpoint=f"{root}/checkpoint",
            trigger=ONCE,
        ).awaitTermination()
    return _values(spark, broker, "out")


@query("SELECT concat_ws(',', event_id::varchar, event_type) AS value FROM events WHERE event_type <> 'error'")
def stream_dataset_to_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = workspace(spark)
    broker = topics_below(root)
    schema = land(table(spark, sf_dir, "events"), f"{root}/landed")
    flows.dataset_to_topic(
        spark,
        f"{root}/landed",
        schema,
        broker,
        "out",
        ["event_id", "event_type"],
        where="event_type <> 'error'",
        continuous=True,
        checkpoint=f"{root}/checkpoint",
        trigger=ONCE,
    ).awaitTermination()
    return _values(spark, broker, "out")


@query(
    """SELECT o_orderkey::varchar AS key, concat_ws(',', o_orderkey::varchar, o_custkey::varchar, o_orderstatus,
        o_totalprice::varchar, o_orderdate::varchar, o_orderpriority) AS value FROM orders"""
)
def stream_publish_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = workspace(spark)
    broker = topics_below(root)
    orders = spark.readStream.schema(table(spark, sf_dir, "orders").schema).option("pathGlobFilter", "orders.parquet")
    records = keyed_records(orders.parquet(sf_dir), "o_orderkey")
    write_topic_stream(
        records, broker, "out", checkpoint=f"{root}/checkpoint", trigger=ONCE, keyed=True
    ).awaitTermination()
    return broker.read(spark, ["out"], {})


# ---- catalog


def _registered(spark: SparkSession, sf_dir: str) -> tuple[Catalog, Broker, str, str]:
    """Events registered as a dataset that was landed from its topic, with a table of the latest per user."""
    root = workspace(spark)
    broker = topics_below(root)
    catalog = Catalog(spark, root, broker)
    dataset = catalog.register_dataset("events", events_schema("event_id"), land=False).id
    write_topic(encode_rows(table(spark, sf_dir, "events")), broker, dataset)
    catalog.start_landing(dataset, start={"earliest": True}, trigger=ONCE).query.awaitTermination()
    loaded = catalog.register_table(
        dataset,
        "latest",
        events_schema("id", event_id="seq", user_id="id"),
        ["event_id AS seq", "ts", "user_id AS id", "event_type", "value", "props"],
        sequence_by=["seq"],
        trigger=ONCE,
    )
    loaded.query.awaitTermination()
    return catalog, broker, dataset, loaded.id


@query(f"SELECT event_id AS seq, ts, user_id AS id, event_type, value, props FROM ({LATEST_EVENT})")
def registered_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    catalog, _, dataset, _ = _registered(spark, sf_dir)
    return plain(scan_table(spark, catalog.table_path(catalog.table_id(dataset, "latest"))))


@query(
    f"""SELECT 'dataset' AS source, event_id::varchar AS value FROM events
    UNION ALL SELECT 'table', value FROM ({LATEST_LINE})"""
)
def registered_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    catalog, broker, dataset, _ = _registered(spark, sf_dir)
    of_dataset = catalog.register_dataset_output(dataset, ["event_id"], continuous=True, trigger=ONCE)
    of_dataset.query.awaitTermination()
    of_table = catalog.register_table_output(dataset, "latest")
    return (
        _values(spark, broker, of_dataset.topic)
        .select(F.lit("dataset").alias("source"), "value")
        .unionByName(_values(spark, broker, of_table.topic).select(F.lit("table").alias("source"), "value"))
    )
