import os

import numpy as np
import public_tokenizers
import pytest

from millrace.llm import bpe, token_counts
from millrace.llm.queries import END_OF_DOCUMENT, TOKENIZER
from tests.llm import brute


def brute_counts(tokens, end):
    out, start = [], 0
    for k, t in enumerate(tokens):
        if t == end:
            out.append((start, k - start, True))
            start = k + 1
    return out + ([(start, len(tokens) - start, False)] if start < len(tokens) else [])


@pytest.mark.parametrize("block_tokens", [1, 3, 64, 1 << 21])
def test_counts_equal_brute_force(spark, work, block_tokens, monkeypatch):
    monkeypatch.setattr(token_counts, "SCANNED_TOGETHER", 5)
    draw, end, expected = np.random.default_rng(1), 9, []
    os.makedirs(work)
    files = {"a": [], "b": [end], "c": [end, end, 1], "d": [1] * 70, "e": [*[1] * 70, end], "f": draw.integers(0, 300, 400).tolist(), "g": draw.integers(7, 11, 200).tolist()}
    for name, tokens in files.items():
        np.array(tokens, "<u2").tofile(f"{work}/{name}")
        expected += [(name, k, *x) for k, x in enumerate(brute_counts(tokens, end))]
    found = token_counts.count_tokens(spark, work, end, 2, block_tokens).collect()
    assert sorted(map(tuple, found)) == sorted(expected)


def test_files_hold_the_documents_tokens(spark, work):
    vocabulary = bpe.load(spark, public_tokenizers.path(TOKENIZER), public_tokenizers.PATTERN)
    frame = brute.awkward(spark, [*brute.prose(40, 8), "", None, "日本語", "line\nbreaks\r\n", "x" * 90_000])
    token_counts.write_token_files(frame, vocabulary, work, END_OF_DOCUMENT)
    found = token_counts.count_tokens(spark, work, END_OF_DOCUMENT, block_tokens=500)
    assert sorted(r["n_tokens"] for r in found.collect()) == sorted(r["n_tokens"] for r in bpe.digests(frame, vocabulary).collect())
    assert found.where("NOT ended").count() == 0


def test_a_file_that_ends_within_a_token_is_an_error(spark, work):
    os.makedirs(work)
    np.array([1, 2, 3], "u1").tofile(f"{work}/a")
    with pytest.raises(Exception, match="middle of a token"):
        token_counts.count_tokens(spark, work, 9)


def test_no_file_has_no_document(spark, work):
    os.makedirs(work)
    np.array([], "<u2").tofile(f"{work}/a")
    assert token_counts.count_tokens(spark, work, 9).collect() == []
