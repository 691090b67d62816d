import random
import re
from itertools import permutations

from millrace.llm import filters
from tests.llm import brute

LABELS = "doc_id long, quality int, toxic int"


def texts():
    draw = random.Random(3)
    some = [*brute.prose(40, 7), "", None, "   \t\n", "é" * 90 + " " + "é" * 90, "# $", "ABC abc", "A" * 70 + " " + "A" * 69 + "B " + "A" * 70]
    some += [" ".join(draw.choice(["one", "two", "three", "a-rather-long-word-of-many-bytes", "Ünïcödé", "x" * 65, "x" * 64 + "y"]) for _ in range(n)) for n in (99, 100, 101, 300)]
    some += [" ".join(f"w{k}" for k in range(n)) for n in (99, 100, 250)] + [" ".join(f"word{k % 80}" for k in range(100)), " ".join(f"word{k % 79}" for k in range(100))]
    return some + some[:9] + ["word joined\x1fby " * 120]


def fails(docs):
    """Letters failed by each of (id, text)."""
    out = []
    for i, text in docs:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        bad = ""
        bad += "A" * (len(w) < 100) + "B" * (100 * len(set(w)) < 80 * len(w))
        bad += "C" * (100 * len(re.findall("[A-Z]", t)) > 10 * len(t)) + "D" * bool(re.search(r"[#$%&*|]", t))
        bad += "E" * any(j is not None and i is not None and j < i and (s or "") == t for j, s in docs)
        out.append(bad)
    return out


def test_counts_equal_regular_expressions():
    given = [None if t is None else t.encode() for t in texts()]
    found = filters.counted(given)
    for k, t in enumerate(given):
        t = (t or b"").decode()
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        expected = (len(w), len(set(w)), len(re.findall("[A-Z]", t)), len(re.findall(r"[#$%&*|]", t)), len(t))
        assert tuple(int(found[c][k]) for c in ("words", "distinct", "capitals", "symbols", "points")) == expected


def test_words_whose_hashes_meet_are_told_apart(monkeypatch):
    monkeypatch.setattr(filters, "_mixed", lambda x: x & filters.np.uint64(1))
    text = " ".join(f"word-number-{k % 50}" for k in range(500)).encode()
    assert filters.counted([text, text])["distinct"].tolist() == [50, 50]


def test_audit_equals_a_plain_version(spark):
    frame = brute.awkward(spark, texts())
    rows = [tuple(r) for r in frame.select("doc_id", "text", "lang").collect()]
    labels = [(k, k % 2, int(k % 3 == 0)) for k in range(0, 60, 2)] + [(4, 1, 1), (None, 1, 1), (7, None, None)]
    good, toxic = ({i for i, *x in labels if x[c] == 1 and i is not None} for c in (0, 1))
    bad = fails([(i, t) for i, t, _ in rows])
    found = {(r["part"], r["filter_order"], r["step"]): r for r in filters.audit(frame, spark.createDataFrame(labels, LABELS)).collect()}
    parts = {lang or "" for _, _, lang in rows}
    assert len(found) == 600 * len(parts)
    shapley = {}
    expected = {}
    for part in parts:
        own = [(i, b) for (i, _, lang), b in zip(rows, bad, strict=True) if (lang or "") == part]
        for order in map("".join, permutations("ABCDE")):
            left = own
            for step, x in enumerate(order, 1):
                gone = [(i, b) for i, b in left if x in b]
                every = [b for _, b in own if x in b]
                left = [(i, b) for i, b in left if x not in b]
                lost = [len([i for i, _ in gone if i in s]) for s in (good, toxic)]
                expected[part, order, step] = (len(left), len(gone), len(every) - len(gone), every.count(x), *lost)
                shapley[part, x] = shapley.get((part, x), 0) + len(gone)
    for key, e in expected.items():
        r = found[key]
        assert (r["kept"], r["removed"], r["redundant"], r["unique_fails"], r["good_lost"], r["toxic_lost"]) == e
        assert r["shapley"] == shapley[key[0], key[1][key[2] - 1]]


def test_empty_tables(spark):
    docs, labels = spark.createDataFrame([], brute.DOCUMENT), spark.createDataFrame([], LABELS)
    assert filters.audit(docs, labels).collect() == []
    one = spark.createDataFrame([(1, "x " * 2_000_000, None, None, None)], brute.DOCUMENT)
    found = filters.audit(one, labels).where("step = 1 AND filter_order = 'BACDE'").collect()
    assert [(r["part"], r["kept"], r["removed"], r["unique_fails"], r["shapley"]) for r in found] == [("", 0, 1, 1, 120)]
