import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import forest
from millrace.llm.common import hash_filter
from tests.llm import brute


def shingles(text, words=2):
    w = re.findall(r"[^\x20\x09-\x0D]+", brute.lower(text))
    return {tuple(w[k : k + words]) for k in range(len(w) - words + 1)} or ({tuple(w)} if w else set())


def groups(sets, percent=80):
    """The group number of every set, by comparing all pairs."""
    group = list(range(len(sets)))

    def root(k):
        while group[k] != k:
            k = group[k]
        return k

    for i, a in enumerate(sets):
        for j in range(i if a else 0):
            both = len(a & sets[j])
            if sets[j] and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                group[max(root(i), root(j))] = min(root(i), root(j))
    return [root(k) for k in range(len(sets))]


def expected(rows, words=2):
    sets = [shingles(t, words) for _, t in rows]
    of, least = groups(sets), {}
    for g, (i, _) in zip(of, rows, strict=True):
        least[g] = min([x for x in (least.get(g), i) if x is not None], default=None)
    return sorted((str(i), len(s), str(least[g]), i is not None and least[g] == i) for (i, _), s, g in zip(rows, sets, of, strict=True))


def found(frame, words=2):
    return sorted((str(a), b, str(c), d) for a, b, c, d in forest.near_duplicates(frame, words).collect())


def edited(draw, words, n):
    out = list(words)
    for _ in range(n):
        out[draw.randrange(len(out))] = f"new{draw.randrange(10**6)}"
    return " ".join(out)


def texts():
    draw = random.Random(8)
    some = [*brute.prose(50, 3), "", None, " \t\n", "one", "ONE", "one two", "One\x0bTwo", "x " * 30_000, "y " * 30_000]
    for k in range(0, 50, 4):
        words = some[k].split()
        some += [some[k].upper(), some[k] + " zu", edited(draw, words, 1), edited(draw, words, 2)]
    return some


def test_components_equal_all_pairs(spark):
    frame = brute.awkward(spark, texts())
    rows = [tuple(r) for r in frame.select("doc_id", "text").collect()]
    assert found(frame) == expected(rows)
    assert found(frame, 5) == expected(rows, 5)


def test_large_groups_chains_and_outliers(spark, monkeypatch):
    """Regions far larger than what a lesser depth leaves together, with members that only some others link."""
    monkeypatch.setattr(forest, "REGION", 4)
    draw = random.Random(9)
    base = [f"w{draw.randrange(300)}" for _ in range(120)]
    some = [edited(draw, base, draw.randint(0, 14)) for _ in range(250)]
    chain = list(base)
    for k in range(0, 60, 2):  # each differs little from the one before, the last much from the first
        chain[k], chain[k + 1] = f"c{k}", f"d{k}"
        some.append(" ".join(chain))
    some += [" ".join(base[:60] + [f"t{k}-{j}" for j in range(40)]) for k in range(60)]  # a shared half alone links nothing
    frame = spark.createDataFrame([(k, t) for k, t in enumerate(some)], "doc_id long, text string")
    assert found(frame) == expected(list(enumerate(some)))


def test_few_pairs_of_a_large_group_are_confirmed(spark, monkeypatch):
    """Outliers of a large group of near copies come close to most of its sets, but are not compared with each."""
    monkeypatch.setattr(forest, "REGION", 16)
    asked, confirmed = [], forest._confirmed

    def counted(pairs, *more):
        asked.append(pairs.count())
        return confirmed(pairs, *more)

    monkeypatch.setattr(forest, "_confirmed", counted)
    draw = random.Random(10)
    base = [f"w{k}" for k in range(200)]
    rows = [(k, edited(draw, base, draw.randint(0, 24))) for k in range(240)]
    rows += [(240 + k, edited(draw, [f"v{j}" if j < 30 else w for j, w in enumerate(base)], draw.randint(0, 5))) for k in range(60)]
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == expected(rows)
    assert asked[1] <= 2 * len(rows), asked


@pytest.mark.parametrize("percent", [50, 67, 80, 100])
def test_differences_find_what_all_pairs_do(spark, tmp_path, percent):
    """Sets around one centre, two, or none, each a component of its own: what is found links all that is similar enough."""
    draw = random.Random(percent)
    made, family = [], []
    for f, bases in enumerate([[range(40)], [range(40), range(25, 70)], [range(k, k + 30) for k in range(0, 300, 40)]]):
        for k in range(60):
            own = set(bases[k % len(bases)])
            own -= set(draw.sample(sorted(own), draw.randint(0, 14)))
            own |= {draw.randrange(400, 440) for _ in range(draw.randint(0, 10))} | {500 + k // 2}
            made.append({1000 * f + x for x in own})
            family.append(f)
    hashes = np.random.default_rng(3).integers(0, 1 << 64, 4000, dtype=np.uint64)
    own = [np.sort(hashes[sorted(x)]) for x in made]
    sketches = forest.sketch(np.stack([forest.signature(x) for x in own])).tolist()
    facts = [(k, len(x), *s) for k, (x, s) in enumerate(zip(own, sketches, strict=True))]
    nodes = spark.createDataFrame(facts, f"node long, n long, {', '.join(f'{s} long' for s in forest.SKETCH)}")
    families = spark.createDataFrame([(k, k, f) for k, f in enumerate(family)], "node long, group long, family long")
    sets = spark.createDataFrame([(k, bytearray(x.tobytes())) for k, x in enumerate(own)], "node long, own binary")
    pairs = forest._by_differences(families, sets, nodes, percent, str(tmp_path / "work")).collect()
    linked = list(range(len(made)))
    for a, b in pairs:
        both = len(made[a] & made[b])
        if 100 * both >= percent * (len(made[a]) + len(made[b]) - both):
            linked = [min(linked[a], linked[b]) if x in (linked[a], linked[b]) else x for x in linked]
    assert linked == groups(made, percent)


def test_empty_table_null_ids_and_hot_copies(spark):
    empty = spark.createDataFrame([], brute.DOCUMENT)
    assert forest.near_duplicates(empty).collect() == []
    copies = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("the same few words again and again").alias("text"))
    result = forest.near_duplicates(copies, 2)
    assert result.where("component_id = 0").count() == 3000 and result.where("kept").count() == 1
    nulls = spark.createDataFrame([(None, "a b c d")] * 3 + [(None, None)], "doc_id long, text string")
    assert [tuple(r)[2:] for r in forest.near_duplicates(nulls, 2).collect()] == [(None, False)] * 4


def test_sketches_agree_where_values_do():
    draw = np.random.default_rng(1)
    a = draw.integers(0, 1 << 62, (3, forest.VALUES), dtype=np.uint64)
    b = a.copy()
    b[1] = draw.integers(0, 1 << 62, forest.VALUES, dtype=np.uint64)
    bits = forest.sketch(a) ^ forest.sketch(b)
    differ = np.bitwise_count((bits | (bits >> 1 & 0x7FFFFFFFFFFFFFFF)) & forest.ODD_BITS).sum(axis=1)
    assert differ[0] == differ[2] == 0 and 0.6 * forest.VALUES < differ[1] < 0.9 * forest.VALUES


def test_hash_filter_passes_all_of_its_own(spark):
    hashes = spark.range(5000).select(F.xxhash64("id").alias("h"))
    own = np.array([r["h"] for r in hashes.collect()])
    passes = hash_filter(hashes, "h")
    assert all(passes(forest.pa.array(own)).to_pylist())
    others = forest.pa.array(np.random.default_rng(2).integers(-(2**63), 2**63 - 1, 5000))
    assert sum(passes(others).to_pylist()) < 50
