from millrace.llm import lines
from tests.llm import brute


def documents():
    text = brute.prose(40, 9)
    common = ["Shared by all.", "\tShared, indented.  ", "Du même."]
    out = ["\n".join([text[k], common[0], "", common[1].strip() if k % 2 else common[1], text[(k + 1) % 40]]) for k in range(40)]
    out += [f"rare {k % 3}\n{common[2]}" for k in range(5)] + [common[0], "", None, "\n\n", "same\nsame", "x\n" * 20_000]
    return out


def test_lines_equal_brute_force(spark):
    frame = spark.createDataFrame([(k, t, None, None if k == 2 else f"src{k % 9}", -1) for k, t in enumerate(documents())], brute.DOCUMENT)
    rows = [tuple(r) for r in frame.select("doc_id", "text", "source").collect()]
    for least in (2, 6, 9, 10):
        expected = brute.lines_cleaned(rows, least)
        found = lines.cleaned(frame, least).collect()
        assert {r["doc_id"]: r["text"] for r in found} == expected
        assert all(r["n_chars"] == (-1 if r["text"] == rows[r["doc_id"]][1] else len(r["text"])) for r in found)


def test_awkward_columns_repeated_rows_and_empty_tables(spark):
    frame = brute.awkward(spark, documents())
    done = lines.cleaned(frame)
    assert done.dtypes == frame.dtypes and done.count() == frame.count()
    assert done.where("doc_id = 3").select("text").distinct().count() == 1
    assert lines.cleaned(frame.limit(0)).collect() == []


def test_near_threshold_lines_are_counted_exactly(spark):
    # So many sites that a sketch only estimates: 400 sites each for lines around a threshold of 400.
    rows = [(site * 10 + k, f"line {k}", None, f"site {site}", None) for k in range(6) for site in range(395 + 2 * k)]
    frame = spark.createDataFrame(rows, brute.DOCUMENT)
    found = {r["text"] for r in lines.cleaned(frame, 400).where("text <> ''").select("text").distinct().collect()}
    n = {k: sum(r["text"] == f"line {k}" for r in lines.cleaned(frame, 400).select("text").collect()) for k in range(6)}
    assert found == {f"line {k}" for k in range(6)} and n == {0: 395, 1: 397, 2: 399, 3: 1, 4: 1, 5: 1}


def test_no_python_and_unchanged_settings(spark):
    frame = brute.awkward(spark, brute.prose(20, 2))
    before = dict(spark.sparkContext.getConf().getAll()), {r["key"]: r["value"] for r in spark.sql("SET").collect()}
    done = lines.deduplicated(frame)
    assert "Arrow" not in (plan := done._jdf.queryExecution().executedPlan().toString()) and "Python" not in plan
    done.collect()
    assert before == (dict(spark.sparkContext.getConf().getAll()), {r["key"]: r["value"] for r in spark.sql("SET").collect()})
