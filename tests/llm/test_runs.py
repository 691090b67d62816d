import hashlib
import random
import zlib
from fractions import Fraction

from millrace.llm import runs
from millrace.llm.queries import QUERIES
from tests.conftest import SF_DIR
from tests.llm import brute


def plain_runs(words):
    """All runs, by walking along every period."""
    out, n = [], len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(6, 4 * q):
                own = words[i : i + length]
                if not any(own[p:] == own[:-p] for p in range(1, q)):
                    out.append((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def expected(doc_id, text, tail=False):
    """The row that the query returns for a document."""
    words = [w for w in "".join(" " if c in " \t\n\v\f\r" else c for c in text or "").split(" ") if w]
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if tail and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = plain_runs(words)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    milli = None if best[0] is None else 1000 * best[1] // best[2]
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(found), *best, milli, sha("".join(f"{a},{b},{c}\n" for a, b, c in found)), sha(kept))


def sequences():
    draw = random.Random(2)
    for _ in range(300):
        words = [b"%d" % draw.randrange(draw.choice([1, 2, 3, 5])) for _ in range(draw.randint(0, 70))]
        if draw.random() < 0.6:
            words = runs.repeating_tail(words, draw.randrange(1000))
        if draw.random() < 0.3:
            words = words + words[::-1] + words * draw.randint(1, 4)
        yield words
    a, b = [b"a"], [b"a", b"b"]
    for _ in range(10):  # Fibonacci words have many runs
        a, b = b, b + a
    yield b


def test_runs_equal_all_periods():
    given = list(sequences())
    for start in range(0, len(given), 7):
        block = given[start : start + 7]
        assert runs.maximal_runs(block) == [plain_runs(w) for w in block]


def test_wavelet_tree_finds_the_next_values():
    draw = random.Random(4)
    values = list(range(100))
    draw.shuffle(values)
    tree = runs.WaveletTree(runs.np.array(values), 7)
    for _ in range(300):
        low = draw.randrange(100)
        high = draw.randint(low + 1, 100)
        at = draw.choice(values[low:high])
        after, before = tree.neighbours(*(runs.np.array([x]) for x in (low, high, at)))
        assert after[0] == min([v for v in values[low:high] if v > at], default=-1)
        assert before[0] == max([v for v in values[low:high] if v < at], default=-1)


def test_awkward_rows(spark):
    texts = [*brute.prose(30, 5), "", None, "  \t\n ", "a", "a a a a a", "a a a a a a", "é\x1f é\x1f " * 5, "one two " * 3 + "one", "x " * 200_000]
    texts += ["la la la da " * 4 + "la la", "a b a b a b a b c c c c c c d d d d d d d"]
    frame = brute.awkward(spark, texts)
    rows = [tuple(r) for r in frame.select("doc_id", "text").collect()]
    found = runs.periodic_runs(frame)
    short = {r["doc_id"]: r["collapsed"] for r in found.where("doc_id is not null").collect()}
    assert short[texts.index("a a a a a a")] == "a" and short[texts.index("x " * 200_000)] == "x"
    key = lambda r: tuple(map(str, r))
    small = [r for r in rows if len(r[1] or "") < 100_000]
    result = [tuple(r) for r in found.drop("collapsed", "runs").collect()]
    large = [r for r in result if r[0] == texts.index("x " * 200_000)]
    assert [r[1:6] for r in large] == [(1, 0, 200_000, 1, 200_000_000)]
    assert sorted([r for r in result if r not in large], key=key) == sorted((expected(*r) for r in small), key=key)
    assert runs.periodic_runs(spark.createDataFrame([], brute.DOCUMENT)).collect() == []


def test_query_equals_a_plain_version(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    docs = [d for d in docs if len(d[1].split()) < 1500]
    found = {r["doc_id"]: tuple(r) for r in QUERIES["op12_runs"](spark, SF_DIR).collect()}
    for doc in docs:
        assert found[doc[0]] == expected(*doc, tail=True)
    assert sum(r[1] > 0 for r in found.values()) > 5
