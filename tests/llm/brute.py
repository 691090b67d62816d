"""Plain versions of the operators, for small inputs, and an awkward documents table."""

import random
import re

import xxhash
from pyspark.sql import functions as F

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


def awkward(spark, texts):
    """The texts as documents, with null and repeated ids, null columns and clashing extra columns."""
    rows = [(k, t, "en" if k % 2 else None, f"src{k % 9}", None if t is None else len(t)) for k, t in enumerate(texts)]
    rows += [(None, "a null id and some words", "en", None, 24), (None, None, None, None, None), (3, rows[3][1], None, "src1", None)]
    frame = spark.createDataFrame(rows, DOCUMENT)
    extra = ["row", "text_hash", "fingerprint", "_key", "gone", "spans", "ids", "lang_pred", "n_lines"]
    return frame.select("*", *[F.lit(k).alias(c) for k, c in enumerate(extra)], F.lit("x").alias("a.b"))


def prose(n, seed=0, vocabulary=400):
    draw = random.Random(seed)
    words = ["".join(draw.choice(["ka", "to", "mi", "ré", "su", "ne", "lo"]) for _ in range(draw.randint(1, 4))) for _ in range(vocabulary)]
    return [" ".join(draw.choice(words) for _ in range(draw.randint(1, 60))).capitalize() + "." for _ in range(n)]


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, bits=2):
    """The group number of every fingerprint, by comparing all pairs."""
    group = list(range(len(prints)))

    def root(k):
        while group[k] != k:
            k = group[k]
        return k

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= bits:
                group[max(root(i), root(j))] = min(root(i), root(j))
    return [root(k) for k in range(len(prints))]


def kept(docs):
    """Documents (id, text) left by near-duplicate removal: the smallest id of each group."""
    found = {}
    for g, d in zip(components([fingerprint(t) for _, t in docs]), docs, strict=True):
        found[g] = min(found.get(g, d), d, key=lambda x: x[0])
    return sorted(found.values())


def item_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def hits(text, items, window=10):
    """Words hit, and the ids of items with a window in the text."""
    words, hit, found = item_words(text), set(), set()
    for item, item_text in items:
        own = item_words(item_text)
        n = min(window, len(own))
        for grams in [{tuple(own[k : k + n]) for k in range(len(own) - n + 1)}] if n else []:
            for p in range(len(words) - n + 1):
                if tuple(words[p : p + n]) in grams:
                    hit.update(range(p, p + n))
                    found.add(item)
    return words, hit, found


def without_hits(text, items):
    """The text without hit words and what stands between them, or None if most of it is hit."""
    words, hit, _ = hits(text, items)
    if len(hit) > 0.5 * len(words):
        return None
    spans = [m.span() for m in re.finditer(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))] if hit else []
    out, end, k = [], 0, 0
    while k < len(spans):
        if k in hit:
            start = k
            while k + 1 in hit:
                k += 1
            out.append(text[end : spans[start][0]])
            end = spans[k][1]
        k += 1
    return text if not hit else " ".join(x.strip(" ") if n else x.rstrip(" ") for n, x in enumerate([*out, text[end:]])).strip(" ")


def lines_cleaned(docs, least=6):
    """Texts of (id, text, site) after cross-site line dedup, by id."""
    sites, first = {}, {}
    for i, text, site in sorted(docs, key=lambda d: d[0]):
        for p, line in enumerate((text or "").split("\n")):
            line = line.strip(" \t\r\f\v")
            sites.setdefault(line, set()).update([site] if site is not None else [])
            first.setdefault(line, (i, p))
    out = {}
    for i, text, _ in docs:
        own = [] if text is None else text.split("\n")
        stays = [x for p, x in enumerate(own) if not (s := x.strip(" \t\r\f\v")) or len(sites[s]) < least or first[s] == (i, p)]
        out[i] = None if text is None else "\n".join(stays)
    return out
