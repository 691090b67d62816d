"""One query per operator over its whole table, with the SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import bpe, decontaminate, filters, forest, language, licenses, lines, runs, simhash, token_counts, topk, toxicity, urls
from millrace.llm.common import table, work_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

#: The tokenizer of the queries, and an id that it leaves free for the end of a document.
TOKENIZER, END_OF_DOCUMENT = "byte_bpe_multi_50k.tiktoken", 50256


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def vocabulary(spark: SparkSession, name: str = TOKENIZER) -> Broadcast:
    return bpe.load(spark, public_tokenizers.path(name), public_tokenizers.PATTERN)


@query
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, max_bits=2)


@query
def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)


@query
def op3_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tokens of each document of flat token files, written from all documents.  Files are named by their number."""
    path = f"{work_dir(spark, 'token-files')}/files"
    token_counts.write_token_files(table(spark, sf_dir, "documents"), vocabulary(spark), path, END_OF_DOCUMENT)
    return token_counts.count_tokens(spark, path, END_OF_DOCUMENT).withColumn("file", F.regexp_extract("file", r"part-\d+", 0))


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.scored(docs, toxicity.learned(docs, table(spark, sf_dir, "labels")))


@query
def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), vocabulary(spark))


@query
def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return licenses.scanned(docs, licenses.learned(docs))


@query
def op7_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.deduplicated(table(spark, sf_dir, "documents")).select("row.doc_id", "text", "n_lines", "n_removed")


@query
def op8_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), k=5, every=50, scale=256)


@query
def op9_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.verdicts(table(spark, sf_dir, "pages"), urls.labelled_urls(spark), urls.RULES)


@query
def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.report(table(spark, sf_dir, "documents"))


@query
def op11_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.near_duplicates(table(spark, sf_dir, "documents"), words=2, percent=80)


@query
def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs in all documents, of which a tenth, by their id, get a tail that repeats itself."""
    draw = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    found = runs.periodic_runs(table(spark, sf_dir, "documents"), F.when(draw % 10 == 0, F.floor(draw / 10)))
    return found.drop("collapsed", "runs")


@query
def op13_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')"

SQL["op2_decontaminate"] = f"""
    WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
    i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
    windows AS (
        SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[k:k + least(len(w), 10) - 1], ' ') AS g
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 8, 2))) AS k FROM i WHERE len(w) > 0)),
    grams AS (
        SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS g
        FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)),
    hits AS (SELECT doc_id, p, n, item_id FROM grams JOIN windows USING (n, g)),
    places AS (
        SELECT doc_id, count(DISTINCT q) AS n_hit
        FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM hits) GROUP BY doc_id),
    found AS (
        SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
        FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
        sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN places USING (doc_id) LEFT JOIN found USING (doc_id)"""

_BLANKS = "concat(' ', chr(9), chr(13), chr(12), chr(11))"
SQL["op7_lines"] = f"""
    WITH l AS (
        SELECT doc_id, source, pos, parts[pos] AS raw, trim(parts[pos], {_BLANKS}) AS line
        FROM (SELECT doc_id, source, parts, unnest(range(1, len(parts) + 1)) AS pos
              FROM (SELECT doc_id, source, string_split(text, chr(10)) AS parts FROM documents))),
    common AS (
        SELECT line, min(struct_pack(d := doc_id, p := pos)) AS first FROM l WHERE line <> ''
        GROUP BY line HAVING count(DISTINCT source) >= 6),
    marked AS (
        SELECT doc_id, pos, raw, l.line <> '' AS has_text, first IS NOT NULL AND (first.d <> doc_id OR first.p <> pos) AS gone
        FROM l LEFT JOIN common USING (line)),
    made AS (
        SELECT doc_id, count(*) FILTER (WHERE has_text)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_removed,
            coalesce(string_agg(raw, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS kept
        FROM marked GROUP BY doc_id)
    SELECT doc_id, CASE WHEN coalesce(n_removed, 0) > 0 THEN kept ELSE text END AS text,
        coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed
    FROM documents LEFT JOIN made USING (doc_id)"""

SQL["op8_top_k"] = """
    WITH v AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vec FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (
        SELECT q.vec_id AS query_id, r.vec_id AS vec_id, list_dot_product(q.vec, r.vec)::BIGINT AS score
        FROM v q JOIN v r ON len(q.vec) = len(r.vec) AND q.vec_id <> r.vec_id WHERE q.vec_id % 50 = 0),
    n AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
    SELECT query_id, rank, vec_id, score FROM n WHERE rank <= 5"""

_FAILS = " + ".join(f"CASE WHEN contains({{0}}, '{x}') THEN {1 << k} ELSE 0 END" for k, x in enumerate("ABCDE"))
SQL["op13_filters"] = f"""
    WITH t AS (
        SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
            regexp_extract_all(coalesce(text, ''), '[^ \\x09-\\x0D]+') AS w FROM documents),
    e AS (SELECT text, min(doc_id) AS least FROM t GROUP BY text),
    f AS (
        SELECT doc_id, part, CASE WHEN len(w) < 100 THEN 1 ELSE 0 END
            + CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 2 ELSE 0 END
            + CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) THEN 4 ELSE 0 END
            + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END + CASE WHEN doc_id > least THEN 16 ELSE 0 END AS fails
        FROM t JOIN e USING (text)),
    l AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
    n AS (
        SELECT part, fails, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, count(*) AS n
        FROM f LEFT JOIN l USING (doc_id) GROUP BY ALL),
    x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
    o AS (
        SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM x a, x b, x c, x d, x e
        WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
    s AS (SELECT filter_order, unnest(range(1, 6))::INTEGER AS step FROM o),
    m AS (SELECT *, {_FAILS.format("substring(filter_order, step, 1)")} AS own, {_FAILS.format("left(filter_order, step - 1)")} AS before FROM s),
    c AS (
        SELECT part, filter_order, step, own, good, toxic, n, fails, fails & own <> 0 AS hit, fails & before <> 0 AS gone FROM n, m),
    r AS (
        SELECT part, filter_order, step, own, coalesce(sum(n) FILTER (WHERE NOT hit AND NOT gone), 0)::BIGINT AS kept,
            coalesce(sum(n) FILTER (WHERE hit AND NOT gone), 0)::BIGINT AS removed,
            coalesce(sum(n) FILTER (WHERE hit AND gone), 0)::BIGINT AS redundant,
            coalesce(sum(n) FILTER (WHERE fails = own), 0)::BIGINT AS unique_fails,
            coalesce(sum(n) FILTER (WHERE hit AND NOT gone AND good), 0)::BIGINT AS good_lost,
            coalesce(sum(n) FILTER (WHERE hit AND NOT gone AND toxic), 0)::BIGINT AS toxic_lost
        FROM c GROUP BY part, filter_order, step, own)
    SELECT * EXCLUDE (own), (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley FROM r"""

SQL["op11_forest"] = f"""
    WITH RECURSIVE w AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^ \\x09-\\x0D]+') AS w FROM documents),
    s AS (
        SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN w
            ELSE list_transform(range(1, len(w)), lambda k: w[k] || ' ' || w[k + 1]) END) AS s FROM w),
    e AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
    links AS (
        SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id
            AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
        GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
    reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
    c AS (SELECT a AS doc_id, min(b) AS least FROM reach GROUP BY a)
    SELECT doc_id, len(s)::BIGINT AS n_shingles, least(doc_id, least) AS component_id, doc_id = least(doc_id, least) AS kept
    FROM s LEFT JOIN c USING (doc_id)"""
