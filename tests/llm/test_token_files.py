"""Packing and wavelet files against the tokenizer's own ids."""

import io
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from casona.llm import packing, tokens, wavelet
from casona.llm.queries import QUERIES, table, tokenizer

ROOT = "/root/testdata/sf0.01"
ROWS = [(3, "one two", "a"), (1, None, "b"), (2, "", "c"), (None, "x y", "d"), (3, "one two", "e"), (3, "abc " * 3000, "f"), (7, "z" * 9000, "g")]


def ids_of(text, name, end):
    return tokens.pieces(tokenizer(name)).tokenizer.encode(text or "", add_special_tokens=False).ids + [end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def check_packed(rows, docs, length=1024):
    """Every id in one piece, no gap or overlap in a document or a sequence."""
    where, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        where[r.doc_id, r.doc_tokens].append((r.start, r.length, r.ids_crc32))
        sequences[r.sequence_id].append((r.offset, r.length))
    want = defaultdict(list)
    for d, t in docs:
        ids = ids_of(t, "byte_bpe_50k.json", 0)
        want[d, len(ids)].append(ids)
    assert set(where) == set(want)
    for key, cuts in where.items():
        copies = want[key]
        assert sorted(c[:2] for c in cuts)[0][0] == 0
        assert sum(c[1] for c in cuts) == sum(map(len, copies))
        if len(copies) == 1:
            at = 0
            for start, size, sum32 in sorted(cuts):
                assert start == at and sum32 == crc(copies[0][start:start + size])
                at += size
    for parts in sequences.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= length
    return len(sequences)


def test_packing_of_documents(spark):
    docs = [tuple(r) for r in table(spark, ROOT, "documents").select("doc_id", "text").collect()]
    found = QUERIES["op8_packing"](spark, ROOT)
    rows = found.collect()
    n = check_packed(rows, docs)
    assert sum(r.length for r in rows) / (n * 1024) > 0.99


def test_packing_of_odd_rows(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, start string").repartition(3)
    for with_ids in (False, True):
        found = packing.packed(docs, tokenizer("byte_bpe_50k.json"), end_id=0, open_windows=2, with_ids=with_ids)
        check_packed(found.collect(), [r[:2] for r in ROWS])
        if with_ids:
            assert all(zlib.crc32(bytes(r.ids)) == r.ids_crc32 for r in found.collect())
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert packing.packed(empty, tokenizer("byte_bpe_50k.json")).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=60), st.integers(1, 4))
def test_windows_hold_everything_once(sizes, most):
    w = packing.Windows(16, most, 3)
    closed = [x for d, n in enumerate(sizes) for x in w.place(d, n)]
    assert len(w.open) <= most
    got = defaultdict(list)
    for _, room, parts in closed + w.open:
        at = 0
        for d, start, size, offset in parts:
            assert offset == at
            at += size
            got[d].append((start, size))
        assert at + room == 16
    for d, n in enumerate(sizes):
        at = 0
        for start, size in sorted(got[d]):
            assert start == at
            at += size
        assert at == n


def test_wavelet_of_documents(spark):
    rows = QUERIES["op10_wavelet"](spark, ROOT).collect()
    start, want = 0, []
    for d, t in sorted(map(tuple, table(spark, ROOT, "documents").select("doc_id", "text").collect())):
        ids = ids_of(t, "word_bpe_49k.json", 1)
        want.append((d, start, len(ids), crc(ids)))
        start += len(ids)
    assert sorted(map(tuple, rows)) == want


def test_wavelet_of_odd_rows(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, start string")
    files = wavelet.write(docs, tokenizer("word_bpe_49k.json"), shard_tokens=50)
    rows = sorted(wavelet.read(files, with_ids=True).collect(), key=lambda r: r.start)
    want = [(d, ids_of(t, "word_bpe_49k.json", 1)) for d, t, _ in sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))]
    assert [(r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in rows] == want
    assert [r.start for r in rows] == np.cumsum([0] + [len(i) for _, i in want])[:-1].tolist()
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert wavelet.read(wavelet.write(empty, tokenizer("word_bpe_49k.json"))).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from([0, 1, 5, 49405, 70000, 3]), max_size=1500), st.integers(0, 1600), st.integers(0, 1600))
def test_access_count_and_select(ids, a, b):
    ids = np.array(ids, np.uint32)
    out = io.BytesIO()
    wavelet.dump(out, np.arange(1), np.ones(1), np.array([len(ids)]), ids)
    shard = wavelet.Shard(out)
    assert shard.ids().tolist() == ids.tolist()
    if len(ids):
        assert shard.access(np.arange(len(ids))).tolist() == ids.tolist()
    a, b = sorted((min(a, len(ids)), min(b, len(ids))))
    for token in (0, 5, 70000, 4):
        places = np.flatnonzero(ids == token)
        assert shard.count(token, a, b) == ((places >= a) & (places < b)).sum()
        assert [shard.select(token, k) for k in range(min(3, len(places)))] == places[:3].tolist()
        assert shard.select(token, len(places)) is None


def test_damaged_files_are_not_decoded():
    out = io.BytesIO()
    ids = np.arange(5000, dtype=np.uint32) * 7 % 991
    wavelet.dump(out, np.array([1]), np.array([True]), np.array([5000]), ids)
    raw = bytearray(out.getvalue())
    whole = wavelet.Shard(io.BytesIO(bytes(raw)))
    assert whole.access(np.arange(5000)).tolist() == ids.tolist()
    for at in (len(raw) - 20, len(raw) // 2, 30):
        bad = bytearray(raw)
        bad[at] ^= 4
        with pytest.raises(ValueError):
            shard = wavelet.Shard(io.BytesIO(bytes(bad)))
            for name in shard.index:
                shard.section(name)


def test_regular_texts_have_ids_of_their_own(spark):
    from tests.llm.test_tokens import thue_morse

    rows = [(k, t) for k, t in enumerate(t for bits in (5, 10, 11) for t in thue_morse(bits))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    check_packed(packing.packed(docs, tokenizer("byte_bpe_50k.json"), end_id=0).collect(), rows)
    got = {r.doc_id: r.ids_crc32 for r in wavelet.read(wavelet.write(docs, tokenizer("word_bpe_49k.json"), end_id=1)).collect()}
    assert got == {k: crc(ids_of(t, "word_bpe_49k.json", 1)) for k, t in rows}
