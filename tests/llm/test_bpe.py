import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken

from millrace.llm import bpe
from tests.llm import brute

NAMES = ["byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.tiktoken"]


def reference(name):
    with open(public_tokenizers.path(name), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return ranks, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    draw = random.Random(2)
    out = ["", " ", "a", "<|endoftext|>", "aaaaa" * 99, "   \n\n\t x  ", "日本語🙂🙂 ﷺ", "ab" * 300, "0" * 900, "é" * 700, "-" * 600, " " * 800]
    out += ["don't 'sup 'll''ve x 's \n's it'", "'", "½²Ⅷ٣x", "a\x1cb\x85c\u3000d"]
    for alphabet in ("aeiou bcd thn\n'.,ßü日🙂01", "'stdmrevl \n.x", ["the", "ing", "ion", " ", "lo", "ss", "\n"]):
        out += ["".join(draw.choice(alphabet) for _ in range(300)) for _ in range(120)]
    return [*out, *brute.prose(60, 3)]


@pytest.mark.parametrize("name", NAMES)
def test_ids_equal_the_library(name):
    ranks, known = reference(name)
    vocabulary = bpe.Vocabulary(ranks, public_tokenizers.PATTERN)
    ids = list(bpe.Encoder(vocabulary, "<u4").encode(texts()))
    assert [np.frombuffer(x, "<u4").tolist() for x in ids] == [known.encode_ordinary(t) for t in texts()]
    assert [bpe.decode(x, vocabulary.tokens).decode() for x in ids] == texts()


def test_split_equals_the_pattern():
    assert bpe.COMMON_PATTERN == public_tokenizers.PATTERN
    vocabulary = bpe.Vocabulary(reference(NAMES[0])[0], public_tokenizers.PATTERN)
    for text in texts():
        if "\x1c" not in text:  # the library's white space, unlike this module's, has no separators of ASCII
            assert vocabulary.split(text) == regex.findall(public_tokenizers.PATTERN, text)


def test_pieces_that_are_forgotten_are_merged_again(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 10)
    ranks, known = reference(NAMES[0])
    encoder = bpe.Encoder(bpe.Vocabulary(ranks, public_tokenizers.PATTERN), "<u4")
    for text in texts():
        assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode([text])] == [known.encode_ordinary(text)]


def test_digests_and_round_trip(spark):
    frame = brute.awkward(spark, [*texts(), None, "x" * 200_000])
    _, known = reference(NAMES[0])
    vocabulary = bpe.load(spark, public_tokenizers.path(NAMES[0]), public_tokenizers.PATTERN)
    sha = lambda raw: hashlib.sha256(raw).hexdigest()
    expected = []
    for i, text in frame.select("doc_id", "text").collect():
        ids = known.encode_ordinary(text or "")
        expected.append((str(i), len(ids), sha(np.array(ids, "<u4").tobytes()), sha((text or "").encode())))
    assert sorted((str(r[0]), *r[1:]) for r in bpe.digests(frame, vocabulary).collect()) == sorted(expected)
    back = bpe.decoded(bpe.encoded(frame, vocabulary), vocabulary).select("row.doc_id", "text").collect()
    assert sorted(map(str, back)) == sorted(str(r).replace("text=None", "text=''") for r in frame.select("doc_id", "text").collect())


def test_empty_table(spark):
    vocabulary = bpe.load(spark, public_tokenizers.path(NAMES[0]), public_tokenizers.PATTERN)
    assert bpe.digests(spark.createDataFrame([], brute.DOCUMENT), vocabulary).collect() == []
