"""Which tokenizer files are encoded word by word, and that the others get whole texts."""

import json

import numpy as np
import pytest
from tokenizers import Tokenizer

from tidepanel.llm import queries, tokenfile
from tidepanel.llm.tokens import TokenIds, splits_words

TEXTS = ["Two  Words\nand a TAIL ", "", None, "Ünïcode ŒUVRE İ", "<|endoftext|> x"]


@pytest.mark.parametrize(("name", "by_words"), [("word_bpe_49k.json", True), ("byte_bpe_50k.json", False)])
def test_ids_equal_the_tokenizer(name, by_words):
    path = queries.tokenizer_path(name)
    own, whole = TokenIds(path), Tokenizer.from_file(path)
    assert own.by_words == by_words
    for text, raw in zip(TEXTS, own.raw(TEXTS)):
        assert np.frombuffer(raw, own.dtype).tolist() == whole.encode(text or "", add_special_tokens=False).ids


def test_cased_files_are_not_split():
    file = json.loads(Tokenizer.from_file(queries.tokenizer_path()).to_str())
    assert splits_words(file)
    assert not splits_words(file | {"normalizer": None})
    assert not splits_words(file | {"pre_tokenizer": None})


def test_hadoop_schemes_are_translated():
    assert [tokenfile.uri_of(p) for p in ("s3a://b/x", "file:///tmp/s3a://x", "hdfs://h/x")] == ["s3://b/x", "file:///tmp/s3a://x", "hdfs://h/x"]


def test_texts_of_known_words_are_not_searched_for_new_ones(monkeypatch):
    """Only from the first text with a new word on are a batch's words looked for; a full memo changes no id."""
    path = queries.tokenizer_path()
    own, whole, met = TokenIds(path), Tokenizer.from_file(path), []
    meet = own._meet
    monkeypatch.setattr(own, "_meet", lambda split: (met.append(len(split)), meet(split)))
    own.raw(["one two", "two three"])
    own.raw(["three one", "", None, "two two"])
    own.raw(["one", "four", "five"])
    assert met == [2, 2]
    own.memo_words = 3
    texts = ["six one", "two seven", "one eight nine"]
    for text, raw in zip(texts, own.raw(texts)):
        assert np.frombuffer(raw, own.dtype).tolist() == whole.encode(text, add_special_tokens=False).ids
