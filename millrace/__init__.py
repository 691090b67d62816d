"""Moving and reshaping data between topics, landed text datasets and keyed tables, on Spark."""

from millrace.functions.rows import cast_all_to_string, encode_rows, keyed_records
from millrace.functions.schema import check_schema, from_struct, spark_type, to_struct
from millrace.operators.constraints import check_constraints, duplicate_keys, null_violations
from millrace.operators.keyed import absent_rows, first_by_key, latest_by_key
from millrace.operators.project import matches, project, select_columns
from millrace.operators.related import (
    find_by_id_or_name,
    find_labels,
    get_by_key,
    list_children,
    live_rows,
    related_rows,
    resolve_id,
    resolve_label_stream,
    resolve_labels,
    to_records,
)
from millrace.plans.catalog import Catalog
from millrace.plans.flows import dataset_to_table, dataset_to_topic, table_to_topic, topic_to_dataset, topic_to_topic
from millrace.plans.shape import growth, is_row_local
from millrace.sources.datasets import scan_dataset, scan_dataset_stream
from millrace.sources.keyed_table import KeyedTable, scan_table, upsert_table
from millrace.sources.topics import (
    Broker,
    inspect_topics,
    publish_keyed,
    read_topic_stream,
    write_topic,
    write_topic_stream,
)
from millrace.streaming.continuous import quarantined
from millrace.streaming.landing import land_stream

__all__ = [name for name in dir() if not name.startswith("_")]
