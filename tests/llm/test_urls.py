from pyspark.sql import functions as F

from millrace.llm import urls

PAGE = "page_id long, url string, html string, host string, rule string"
CASES = {
    "https://M.Example.NET/en/25#top": ("m.example.net", "/en/25", "example.net/en/", "allow"),
    "https://a.net/x": ("a.net", "/x", "net/", "block"),
    "https://a.net": ("a.net", "", None, "allow"),
    "http://example.com/de/1?q=/": ("example.com", "/de/1", "example.com/de/", "block"),
    "http://notexample.com/de/1": ("notexample.com", "/de/1", None, "allow"),
    "http://x.org/fr/#a?b": ("x.org", "/fr/", "org/fr/", "allow"),
    "http://x.org/FR/": ("x.org", "/FR/", None, "allow"),
    "ftp://h?x://y/z": ("h", "", None, "allow"),
    "://": ("", "", None, "allow"),
    "no scheme/de/": ("", "", None, "allow"),
    "": ("", "", None, "allow"),
    None: ("", "", None, "allow"),
    "https://ÀB.org/fr/é\n?": ("Àb.org", "/fr/é\n", "org/fr/", "allow"),
    "https://www.free-casino.example.org/en/3": ("www.free-casino.example.org", "/en/3", None, "block"),
    "https://www.cheap-pills.example.com/en/450?page=2&ref=x": ("www.cheap-pills.example.com", "/en/450", None, "block"),
    "https://www.gardens.example.org/en/3.html": ("www.gardens.example.org", "/en/3.html", None, "allow"),
}


def test_cases(spark):
    pages = spark.createDataFrame([(k, u, None, "clash", "clash") for k, u in enumerate(CASES)] + [(None, None, None, None, None)], PAGE)
    pages = pages.withColumn("a.b", F.lit(1))
    found = urls.verdicts(pages, urls.labelled_urls(spark), urls.RULES).collect()
    assert {r["page_id"]: tuple(r)[1:5] for r in found if r["page_id"] is not None} == dict(enumerate(CASES.values()))
    assert len(found) == len(CASES) + 1


def test_a_long_url_counts_whole(spark):
    host = "https://h.example.org/" + "x" * 50_000 + "/casino-win/free-bets"
    row = spark.createDataFrame([(1, host)], "page_id long, url string")
    assert len(row.select(urls.features(*urls.host_and_path(F.col("url")))).first()[0]) > 150_000


def test_plan_is_native(spark):
    plan = urls.verdicts(spark.createDataFrame([(1, "x")], "page_id long, url string"), urls.labelled_urls(spark), urls.RULES)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Exchange"))


def test_held_out_accuracy(spark):
    name = F.expr("coalesce(nullif(regexp_extract(url, '([a-z-]+)[.]example', 1), ''), url)")  # a site's URLs are in one fold
    labelled = urls.labelled_urls(spark).withColumn("fold", F.pmod(F.xxhash64(name), F.lit(4)))
    model = urls.weights(labelled.where("fold > 0"))
    p = urls.probability(*urls.host_and_path(F.col("url")), model)
    rows = labelled.where("fold = 0").select((p >= 0.5).cast("int").alias("p"), "blocked").collect()
    assert sum(r["p"] == r["blocked"] for r in rows) >= 0.85 * len(rows) and len(rows) > 20


def test_empty_table_and_labels_of_one_kind(spark):
    empty = spark.createDataFrame([], "page_id long, url string")
    assert urls.verdicts(empty, urls.labelled_urls(spark), urls.RULES).collect() == []
    one = urls.labelled_urls(spark).where("blocked = 1")
    assert set(urls.weights(one)) == {0.0} and set(urls.weights(one.limit(0))) == {0.0}
