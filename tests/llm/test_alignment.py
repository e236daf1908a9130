"""Alignment of two tokenizers against every pair of tokens of every text."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from casona.llm import alignment
from casona.llm.queries import table

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = [f.split()[0] for f in alignment.RESULT.split(", ")]


def spans(ids, names):
    at, out = 0, []
    for i in ids:
        out.append((i, at, at + len(names[i])))
        at += len(names[i])
    return out


def brute(rows):
    """The result of (doc_id, text) rows by comparing the byte ranges of all tokens of a text."""
    first, second = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    first.encode_special_tokens = True
    sides = alignment.Sides(A, B)
    names_a, names_b = sides._of_a(), sides._of_b()
    found = []
    for doc_id, text in rows:
        a = spans(first.encode(" " + (text or ""), add_special_tokens=False).ids, names_a)
        b = spans(second.encode(text or ""), names_b)
        raw = (" " + (text or "")).encode()
        if not text or b"".join(names_a[x[0]] for x in a) != raw or b"".join(names_b[x[0]] for x in b) != raw:
            found.append((doc_id, None, None, None, None))
            continue
        pairs = [(x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2]]
        ends = sorted({x[2] for x in a} & {y[2] for y in b})
        groups = [
            ([x[0] for x in a if s < x[2] <= e], [y[0] for y in b if s < y[2] <= e]) for s, e in zip([0, *ends], ends)]
        found.append((doc_id, a, b, groups, pairs))
    count = Counter(p for f in found for p in f[4] or ())
    best = {}
    for (_, y), n in count.items():
        best[y] = max(best.get(y, 0), n)
    out = []
    for doc_id, a, b, groups, pairs in found:
        if a is None:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        said = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((
            doc_id, len(a), len(b), len(groups), len(pairs), sum(count[p] == best[p[1]] for p in pairs),
            sum(count[p] for p in pairs), hashlib.sha256(said.encode()).hexdigest()))
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=repr)


CASES = [
    None, "", " ", "a", "one two  three\n\nfour", "<|endoftext|> and <s> </s> <unk>", "with ▁ inside", "日本語 ß é 😀 é", "x" * 300,
    "  spaces   at both ends  ", "tab\tand\r\nreturn \x00 nul", "Ünïcödé.,;:!? 'tis 12345 67", "one two  three\n\nfour", "\n",
]


def test_hand_written_texts(spark):
    rows = [(k, t, "x", k) for k, t in enumerate(CASES)] + [(None, CASES[4], None, 1), (4, CASES[4], "y", 2), (4, "other", "y", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_a string, chunk long")
    for chunk in (1, alignment.CHUNK):
        assert result(alignment.aligned(docs, A, B, chunk=chunk)) == brute([r[:2] for r in rows])


def test_documents(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents").filter("length(text) < 2500")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert len(rows) > 100
    assert result(alignment.aligned(docs.repartition(3), A, B, chunk=20_000)) == brute(rows)


def test_no_rows(spark):
    assert alignment.aligned(spark.createDataFrame([], "doc_id long, text string"), A, B).count() == 0


def test_long_text_in_segments(spark, monkeypatch):
    text = " ".join(f"word{k} und  noch, ein{k % 7}\n" for k in range(120))
    docs = spark.createDataFrame([(1, text), (2, "word1 und"), (3, text + " ▁ x")], "doc_id long, text string")
    raw, offsets = np.frombuffer((" " + text).encode(), np.uint8), np.array([0, len(text) + 1])
    assert len(alignment.segments(raw, offsets, 100)) > 15
    sides = alignment.Sides(A, B)
    import pyarrow as pa

    whole = next(alignment._rows(sides, pa.array([text])))[2]
    monkeypatch.setattr(alignment, "SEGMENT", 100)
    monkeypatch.setattr(alignment.segments, "__defaults__", (100,))
    row, _, first, more = next(alignment._rows(sides, pa.array([text])))
    got = alignment._joined(first, more)
    assert len(more) > 15 and got.n == tuple(whole.n) and got.groups == bytes(whole.groups)
    assert got.pairs.tolist() == whole.pairs.tolist() and got.times.tolist() == whole.times.tolist()
    assert result(alignment.aligned(docs, A, B)) == brute([tuple(r) for r in docs.collect()])


@settings(max_examples=200, deadline=None)
@given(a=st.sets(st.integers(1, 60)), b=st.sets(st.integers(1, 60)), steps=st.integers(1, 9))
def test_pieces_of_a_merge(a, b, steps):
    a, b = (np.array(sorted(x | {61}), np.int64) for x in (a, b))
    i, j, group_a, group_b = alignment.overlaps(a, b, steps)
    start = lambda ends, k: 0 if k == 0 else ends[k - 1]
    want = [(x, y) for x in range(len(a)) for y in range(len(b)) if start(a, x) < b[y] and start(b, y) < a[x]]
    assert sorted(zip(i.tolist(), j.tolist())) == want
    both = sorted(set(a.tolist()) & set(b.tolist()))
    assert group_a.tolist() == [int((a <= e).sum()) for e in both] and group_b.tolist() == [int((b <= e).sum()) for e in both]
    # every piece but the last has the same number of steps, whatever the lists
    taken = np.diff(np.append(sum(alignment.diagonals(a, b, steps)), len(a) + len(b)))
    assert (taken[:-1] == steps).all() and 0 < taken[-1] <= steps
