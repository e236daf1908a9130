"""Pieces give the ids that the tokenizer gives for whole texts."""

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings, strategies as st

from casona.llm import tokens
from casona.llm.bytehash import blocks, span_hashes, word_spans

FILES = ["byte_bpe_50k.json", "word_bpe_49k.json"]
ODD = st.text(alphabet=st.sampled_from(list("abAB '.,\n\t  0é 　 !ß́<|>Σσ日本\r\x0b\x1c\x85—…'s")), max_size=40)


def ids(texts, path):
    got = []
    for _, out, places in tokens.encoded(pa.array(texts, pa.string()), path, 7):
        got += [out[a:b].tolist() for a, b in zip(places[:-1], places[1:])]
    return got


def plain(texts, path):
    model = tokens.pieces(path).tokenizer
    return [model.encode(t or "", add_special_tokens=False).ids + [7] for t in texts]


@pytest.mark.parametrize("name", FILES)
@settings(max_examples=300, deadline=None)
@given(texts=st.lists(st.one_of(ODD, st.text(max_size=30), st.none()), min_size=1, max_size=5))
def test_any_text(name, texts):
    path = public_tokenizers.path(name)
    assert ids(texts, path) == plain(texts, path)


@pytest.mark.parametrize("name", FILES)
def test_documents(name):
    texts = pq.read_table("/root/testdata/sf0.001/documents.parquet")["text"].to_pylist() + ["", None, "x" * 5000, "<|endoftext|> a"]
    path = public_tokenizers.path(name)
    assert ids(texts, path) == plain(texts, path)


@settings(max_examples=100, deadline=None)
@given(texts=st.lists(st.binary(max_size=20), max_size=6))
def test_words_are_those_of_bytes_split(texts):
    for _, data, offsets in blocks(pa.array(texts, pa.binary()), most=16):
        starts, ends, row = word_spans(data, offsets)
        raw = data.tobytes()
        want = [(k, w) for k in range(len(offsets) - 1) for w in raw[offsets[k]:offsets[k + 1]].split()]
        assert [(int(r), raw[a:b]) for a, b, r in zip(starts, ends, row)] == want


def test_hashes_follow_the_bytes():
    data = np.frombuffer(b"abcabc abd", np.uint8)
    h = span_hashes(data, np.array([0, 3, 7, 0]), np.array([3, 6, 10, 2]))
    assert h[0] == h[1] and len(set(h.tolist())) == 3


def thue_morse(bits: int) -> tuple[str, str]:
    """Two unequal words that every polynomial hash modulo 2^64 takes for equal."""
    word = "a"
    for _ in range(bits):
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("name", FILES)
def test_regular_pieces_are_told_apart(name):
    path = public_tokenizers.path(name)
    texts = [t for bits in (5, 10, 11, 12) for word in thue_morse(bits) for t in (word, f"x {word} y")]
    assert ids(texts, path) == plain(texts, path)


def test_hashes_of_regular_words_differ():
    for bits in (3, 5, 8, 10, 12):
        raw = "".join(thue_morse(bits)).encode()
        half = len(raw) // 2
        a, b = span_hashes(np.frombuffer(raw, np.uint8), np.array([0, half]), np.array([half, len(raw)]))
        assert a != b


def test_one_hash_for_all_still_compares_bytes(monkeypatch):
    from casona.llm import bytehash

    monkeypatch.setattr(bytehash, "mix", lambda x: x * np.uint64(0))
    path = public_tokenizers.path(FILES[0])
    texts = ["one two three", "two one", "three one two  one", "a" * 40 + " one"]
    model = tokens.Pieces(path)
    for _ in range(2):
        for first, data, offsets in blocks(pa.array(texts)):
            got, at = model.encode(data, offsets)
            assert [got[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == [r[:-1] for r in plain(texts, path)]


@settings(max_examples=300, deadline=None)
@given(texts=st.lists(st.one_of(ODD, st.text(max_size=30)), min_size=1, max_size=5))
def test_sentencepiece_words(texts):
    model = tokens.pieces(public_tokenizers.path("piece_bpe_32k.model"))
    texts = [t for t in texts if t and "▁" not in t]
    for _, data, offsets in blocks(pa.array([" " + t for t in texts], pa.string())):
        got, at = model.encode(data, offsets)
        assert [got[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == [model.model.encode(t) for t in texts]
