"""Vectorised words, shingles and Elias-Fano lists against plain Python."""
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_support import UPPER

from tickscan.llm.elias_fano import EliasFano, encode
from tickscan.llm.words import chunks, sets_by_row, shingles

PATTERN = {"space": r"[^\x20\x09-\x0D]+", "alnum": r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"}
texts = st.lists(st.one_of(st.none(), st.text(alphabet="aAbZ09 \t\n.,-éÉß\x00一", max_size=40)), max_size=8)


def batch(rows):
    return pa.RecordBatch.from_arrays([pa.array(rows, pa.string())], ["text"])


@pytest.mark.parametrize("kind", ["space", "alnum"])
@given(rows=texts)
@settings(max_examples=150, deadline=None)
def test_words(kind, rows):
    seen = {}
    for part, w in chunks(batch(rows), "text", kind):
        want = [re.findall(PATTERN[kind], (t or "").translate(UPPER)) for t in part.column("text").to_pylist()]
        assert w.counts().tolist() == [len(x) for x in want]
        for h, x in zip(w.hash.tolist(), [y for x in want for y in x]):
            assert seen.setdefault(x, h) == h
    assert len(set(seen.values())) == len(seen)


@given(rows=texts)
@settings(max_examples=100, deadline=None)
def test_shingles(rows):
    for part, w in chunks(batch(rows), "text", "space"):
        for s, t in zip(sets_by_row(*shingles(w, 3)), part.column("text").to_pylist()):
            x = re.findall(PATTERN["space"], (t or "").translate(UPPER))
            assert len(s) == len({tuple(x[i:i + 3]) for i in range(max(1, len(x) - 2))} if x else ())


def test_sliced_and_long_texts():
    rows = ["a b", None, "x " * 2_000_000, "", "c"]
    b = batch(rows).slice(1)
    assert [n for _, w in chunks(b, "text", "space") for n in w.counts()] == [0, 2_000_000, 0, 1]


@given(values=st.lists(st.integers(0, 2**64 - 1), max_size=60), asked=st.lists(st.integers(0, 2**64 - 1), max_size=20),
       shift=st.integers(0, 63))
@settings(max_examples=200, deadline=None)
def test_elias_fano(values, asked, shift):
    v = np.sort(np.array([x >> shift for x in values], np.uint64))
    e = EliasFano(np.frombuffer(encode(v), np.uint8))
    assert (e.select(np.arange(len(v))) == v).all()
    q = np.array([x >> shift for x in asked] + asked, np.uint64)
    q = np.concatenate([q, v, v + np.uint64(1)])
    assert (e.successor(q) == np.searchsorted(v, q)).all()


@given(values=st.lists(st.integers(0, 2**64 - 1), max_size=60), asked=st.lists(st.integers(0, 2**64 - 1), max_size=20),
       shift=st.integers(0, 63))
@settings(max_examples=200, deadline=None)
def test_elias_fano_find(values, asked, shift):
    v = np.sort(np.array([x >> shift for x in values], np.uint64))
    e = EliasFano(np.frombuffer(encode(v), np.uint8))
    q = np.concatenate([np.array([x >> shift for x in asked] + asked, np.uint64), v, v + np.uint64(1)])
    assert (e.find(q) == np.where(np.isin(q, v), np.searchsorted(v, q), -1)).all()
