import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions import ids
from millrace.functions.rows import cast_all_to_string, encode_rows, keyed_records
from millrace.sources.datasets import scan_dataset
from millrace.sources.storage import shared_dir


def lines(df):
    return [r.value for r in df.collect()]


def test_nulls_are_left_out(spark):
    df = spark.createDataFrame([("a", None, "c"), (None, None, None)], "x string, y string, z string")
    assert lines(encode_rows(df)) == ["a,c", ""]
    assert lines(encode_rows(df, quoted=True)) == ["a,\\N,c", "\\N,\\N,\\N"]


def test_value_column_is_part_of_the_text(spark):
    df = spark.createDataFrame([(1, "v", "k")], "id long, value string, key string")
    encoded = encode_rows(df)
    assert encoded.columns == ["value"] and lines(encoded) == ["1,v,k"]


def test_dotted_and_repeated_names(spark):
    df = spark.range(1).select(F.lit(1).alias("a.b"), F.lit(2).alias("x"), F.lit(3).alias("x"))
    assert lines(encode_rows(df)) == ["1,2,3"]
    cast = cast_all_to_string(df)
    assert cast.columns == ["a.b", "x", "x"] and {k for _, k in cast.dtypes} == {"string"}
    assert keyed_records(df, "a.b").collect() == [("1", "1,2,3")]
    with pytest.raises(ValueError, match="ambiguous"):
        keyed_records(df, "x")
    with pytest.raises(ValueError, match="no such column"):
        keyed_records(df, "nope")


def test_text_of_numbers(spark):
    df = spark.sql("SELECT 1.0D, 1e7D, true, timestamp '2021-01-01 00:00:00.12', 7")
    assert lines(encode_rows(df)) == ["1.0,1.0E7,true,2021-01-01 00:00:00.12,7"]


FIELD = st.one_of(st.none(), st.text(alphabet=st.sampled_from('ab ,"\'\\x{}:nrN\n\r'), max_size=6))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(-5, 5), FIELD, FIELD), min_size=1, max_size=30))
def test_quoted_round_trip(spark, data):
    schema = [
        {"column_name": "i", "column_type": "integer"},
        {"column_name": "s", "column_type": "string"},
        {"column_name": "t", "column_type": "string"},
    ]
    path = shared_dir(spark, "quoted")
    encode_rows(spark.createDataFrame(data, "i int, s string, t string"), quoted=True).write.text(path)
    back = [tuple(r) for r in scan_dataset(spark, path, schema, quoted=True).collect()]
    order = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted(back, key=order) == sorted(data, key=order)


def test_ids():
    assert re.fullmatch(r"dataset-[0-9a-f-]{36}", ids.new_id("dataset"))
    assert re.fullmatch(r"table_[0-9a-f]{32}", ids.new_table_id())
