"""Token counts against the library, and the cache."""

from __future__ import annotations

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from chanlake.llm.ship import ship
from chanlake.llm.tokencount import count_tokens, encode, load_counter, tokenizer_version

BYTE_LEVEL = public_tokenizers.path("byte_bpe_50k.json")
ALPHABET = "abZé9 '\"\t\n\x0b\x1c\x85\xa0　.!|<>_😀ñ१"
TEXT = st.text(alphabet=st.sampled_from(ALPHABET), max_size=60) | st.sampled_from(
    ["<|endoftext|>", "a <|endoftext|> b", "it's  we'll \n x", "   ", "a " * 50, "don't stop"]
)


WHOLE, COUNT = Tokenizer.from_file(BYTE_LEVEL), load_counter(BYTE_LEVEL)


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXT, max_size=6))
def test_pieces_equal_the_whole(texts):
    assert COUNT(texts) == [len(WHOLE.encode(t, add_special_tokens=False)) for t in texts]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_libraries(name):
    path = public_tokenizers.path(name)
    texts = ["Hello there, world", "", "x" * 3000, "<|endoftext|> été 123"]
    if name.endswith(".model"):
        want = [len(x) for x in SentencePieceProcessor(model_file=path).encode(texts)]
    else:
        tokenizer = Tokenizer.from_file(path)
        want = [len(tokenizer.encode(t, add_special_tokens=False)) for t in texts]
    assert load_counter(path)(texts) == want


def test_cache(spark, tmp_path):
    ship(spark)
    cache = str(tmp_path / "cache")
    rows = [(1, "one two", "x"), (2, "one two", "y"), (2, "one two", "y"), (3, None, "z"), (4, "", "z"), (None, "é" * 900, "n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    first = count_tokens(docs, BYTE_LEVEL, cache)
    tokenizer = Tokenizer.from_file(BYTE_LEVEL)
    want = sorted(
        ((i, len((t or "").encode()), len(tokenizer.encode(t or ""))) for i, t, _ in rows), key=repr
    )
    got = lambda df: sorted(map(tuple, df.select("doc_id", "n_bytes", "n_tokens").collect()), key=repr)
    assert got(first) == want
    stored = spark.read.parquet(cache)
    assert stored.count() == 3 and stored.select("tokenizer").distinct().first()[0] == tokenizer_version(BYTE_LEVEL)
    # stored counts are used, not encoded again; nothing is appended twice
    again = count_tokens(docs.limit(0).union(docs), BYTE_LEVEL, cache)
    assert got(again) == want and spark.read.parquet(cache).count() == 3
    other = public_tokenizers.path("word_bpe_49k.json")
    assert count_tokens(docs, other, cache).count() == len(rows)
    assert spark.read.parquet(cache).count() == 6
    assert encode(spark.createDataFrame([], "content binary, text string"), BYTE_LEVEL).count() == 0
    assert count_tokens(docs.limit(0), BYTE_LEVEL, str(tmp_path / "none")).count() == 0
