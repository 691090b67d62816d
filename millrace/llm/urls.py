"""URL filter: rules by host and path, and a logistic regression on hashed character n-grams for the rest.

Everything that touches the pages is SQL functions; the model's weights are a literal array.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer, Normalizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import ascii_lower, column

#: Lengths of n-grams, and the number of weights they are hashed to.
GRAMS, BUCKETS = (3, 4, 5), 1 << 12
#: Rules are compared one by one with every URL, so their number is bounded.
MAX_RULES = 1000

#: Verdict, host and path of each rule of the registered query.
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]

#: Names of invented sites; the second list is to be blocked.
GOOD_NAMES = """library museum weather recipes gardening history university school science maps news travel music letters physics
hospital council archive theatre forum birds railway poems chess cooking language village harbour painting county orchestra
journal astronomy botany football cycling pottery knitting parish winter wiki thermal thesis theory northern other
brother leather bakery teacher timetable citizens mountains tickets insurance parents radio bicycle economy court
boats cheese rivers bridges schools winery garden nations stations portion ration author thousand thinking thread
south month truth health wealth earth breath north-coast river-walk old-town city-news open-data""".split()
BAD_NAMES = """casino-win casino-royal bets-now free-bets free-casino cheap-pills pills-online cheap-meds spam-farm link-farm spam-mail
ads-track track-ads ads-server adult-x adult-cam xxx-adult win-bets poker-win lottery-win free-pills ad-tracker spam-links
cheap-loans adult-video casino-bonus bets-online adult-dating pills-cheap ads-click farm-spam casino-spins pharm-pills
adult-chat track-clicks spam-seo bets-tips cheap-viagra""".split()


def _labelled() -> list[tuple[str, int]]:
    """The small labelled table: prefixes, domains and paths take turns alike in both kinds, so that names decide."""
    turns = [("", "com", "en/{}"), ("www.", "net", "de/{}.html"), ("m.", "org", "fr/{}/"), ("blog.", "com", "es/{}"), ("", "net", "en/{}/")]
    turns += [("www.", "org", "en/{}.html"), ("blog.", "net", "fr/{}"), ("m.", "com", "de/{}"), ("www.", "com", "fr/{}.html"), ("", "org", "es/{}/")]
    out = []
    for label, names in ((0, GOOD_NAMES), (1, BAD_NAMES)):
        for k, name in enumerate(names):
            for prefix, top, path in (turns[k % 10], turns[(k + 7) % 10]):
                out.append((f"https://{prefix}{name}.example.{top}/{path.format(100 + k)}", label))
    # Short hosts and texts without a host say little, and little is no reason to block.
    short = [(f"http://{letter}.{top}{path}", 0) for letter in "abcdefghijklmnopqrstuvwxyz" for top, path in (("net", ""), ("org", "/FR/"), ("com", "/1"))]
    return out + short + [(text, 0) for text in ("", "about", "mailto", "none", "unknown", "://", "local", "file", "page", "null")]


LABELLED = _labelled()


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: then up to ``?``, ``#`` or
    the end.  Null, or without ``://``: both empty."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return ascii_lower(host), path


def first_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The longest rule that fits, as a struct of ``rule`` and ``verdict``; else null.

    Of equally long rules the one with the longer host wins, then the one that comes first.
    """
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    order = sorted(rules, key=lambda r: (-len(r[1] + r[2]), -len(r[1])))
    out = F.lit(None)
    for verdict, rule_host, rule_path in reversed(order):
        name = rule_host.lower()
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(rule_path)
        value = F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, value).otherwise(out)
    return out if rules else F.lit(None).cast("struct<rule: string, verdict: string>")


def features(host: Column, path: Column) -> Column:
    """Buckets of the character n-grams of host and path, each n-gram counted as often as it stands."""

    def grams(kind: str, text: Column, n: int) -> Column:
        starts = F.when(F.length(text) >= n, F.sequence(F.lit(1), F.length(text) - (n - 1)))
        gram = lambda i: F.pmod(F.xxhash64(F.lit(kind), F.substring(text, i, F.lit(n))), F.lit(BUCKETS)).cast("int")
        return F.coalesce(F.transform(starts, gram), F.array().cast("array<int>"))

    marked = [("host", F.concat(F.lit("."), host, F.lit("."))), ("path", path)]
    return F.concat(*[grams(kind, text, n) for kind, text in marked for n in GRAMS])


def weights(labelled: DataFrame, url: str = "url", label: str = "blocked") -> list[float]:
    """Weights of a logistic regression on the labelled URLs, a small table, with the bias last.

    A URL's features are the shares of its n-grams.  Without labels of both kinds every weight is zero.
    """
    host, path = host_and_path(column(url))
    grams = features(host, path).cast("array<string>").alias("grams")
    rows = labelled.select(column(label).cast("double").alias("label"), grams).where("label IS NOT NULL")
    out = [0.0] * (BUCKETS + 1)
    if rows.select("label").distinct().count() < 2 or rows.where(F.size("grams") > 0).isEmpty():
        return out
    counter = CountVectorizer(inputCol="grams", outputCol="counts", vocabSize=BUCKETS).fit(rows)
    shares = Normalizer(inputCol="counts", outputCol="features", p=1.0).transform(counter.transform(rows)).coalesce(1)
    model = LogisticRegression(regParam=1e-6, maxIter=100, standardization=False).fit(shares)
    for bucket, weight in zip(counter.vocabulary, model.coefficients.toArray(), strict=True):
        out[int(bucket)] = float(weight)
    out[-1] = float(model.intercept)
    return out


def probability(host: Column, path: Column, model: Sequence[float]) -> Column:
    at, literal = features(host, path), F.array(*map(F.lit, model[:-1]))
    total = F.aggregate(at, F.lit(0.0), lambda s, k: s + F.get(literal, k))
    return 1 / (1 + F.exp(-(total / F.greatest(F.size(at), F.lit(1)) + model[-1])))


def verdicts(
    pages: DataFrame,
    labelled: DataFrame,
    rules: Sequence[tuple[str, str, str]] = (),
    threshold: float = 0.5,
    id_column: str = "page_id",
    url_column: str = "url",
) -> DataFrame:
    """One row per page: ``page_id``, ``host``, ``path``, ``rule``, ``verdict``, ``p_block``.

    A rule's verdict goes before the model's; a URL without host and path has no features and
    gets the model's verdict on none.  Rows are never dropped, joined or shuffled.
    """
    model = weights(labelled)
    host, path = host_and_path(column(url_column))
    rows = pages.select(column(id_column).alias("page_id"), host.alias("host"), path.alias("path"))
    rule = first_rule(F.col("host"), F.col("path"), rules)
    rows = rows.select("*", rule.alias("fit"), probability(F.col("host"), F.col("path"), model).alias("p_block"))
    by_model = F.when(F.col("p_block") >= threshold, "block").otherwise("allow")
    verdict = F.coalesce("fit.verdict", by_model).alias("verdict")
    return rows.select("page_id", "host", "path", F.col("fit.rule").alias("rule"), verdict, "p_block")


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The small labelled table as a frame of ``url`` and ``blocked``."""
    rows = [f"('{url}', {label})" for url, label in LABELLED]
    return spark.sql(f"SELECT * FROM VALUES {', '.join(rows)} AS t(url, blocked)")
