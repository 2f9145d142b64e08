import random
import re

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from prepspark.llm import bpe

PATH = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def ours():
    with open(PATH, "rb") as f:
        return bpe.Bpe(f.read(), P.PATTERN)


@pytest.fixture(scope="module")
def library(ours):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ours.ranks, special_tokens={})


def ids(ours, text):
    return np.frombuffer(next(ours.encode_batch([text])), "<u4").tolist()


def test_random_unicode_equals_the_library(ours, library):
    random.seed(5)
    letters = [chr(c) for c in [*range(0, 0x180), *range(0x4E00, 0x4E10), 0x1F600, 0x2028, 0x85, 0xA0, 0x3000, 0x200B, 0x300, 0xB2, 0x10FFFF]]
    for k in range(600):
        text = "".join(random.choice(letters) for _ in range(random.randint(0, 60))) * (20 if k % 20 == 0 else 1)
        assert ids(ours, text) == library.encode_ordinary(text)


@pytest.mark.parametrize("text", ["a" * 5000, "é" * 900, " " * 3000 + "x", "abcdet" * 400, "<|endoftext|>", "", "\n\n\r\n  z"])
def test_long_pieces_and_special_strings(ours, library, text):
    assert ids(ours, text) == library.encode_ordinary(text)


def test_matrix_and_heap_merge_alike(ours):
    random.seed(2)
    for _ in range(200):
        word = bytes(random.choice(b"abcdeiorst \xc3\xa9") for _ in range(random.randint(2, 40)))
        assert ours.merge_matrix([word])[0] == ours.merge_long(word)


def test_an_emptied_cache_changes_nothing(ours, library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_PIECES", 3)
    texts = ["one two three four five", "six seven one two", "one"]
    assert [np.frombuffer(x, "<u4").tolist() for x in ours.encode_batch(texts)] == [library.encode_ordinary(t) for t in texts]


def test_odd_rows_and_round_trip(odd, empty, library):
    encoded = bpe.encode_documents(odd, PATH, P.PATTERN)
    rows = bpe.decode_documents(encoded, PATH, P.PATTERN).collect()
    given = odd.select("doc_id", "text").collect()
    assert sorted((str(r.doc_id), r.decoded.decode()) for r in rows) == sorted((str(r.doc_id), r.text or "") for r in given)
    assert sorted(r.n_tokens for r in rows) == sorted(len(library.encode_ordinary(r.text or "")) for r in given)
    assert bpe.token_digests(empty).count() == 0


def test_digests(spark):
    row = bpe.token_digests(spark.createDataFrame([(1, None)], "doc_id long, text string")).first()
    assert row.n_tokens == 0 and row.ids_sha256 == row.decoded_sha256 and re.fullmatch("[0-9a-f]{64}", row.ids_sha256)
