import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rollcall.llm import common as c

TEXT = st.text(alphabet="aB \n\té你-", max_size=30)


def words(text):
    return re.findall(c.WORD, text)


@settings(deadline=None, max_examples=60)
@given(st.lists(st.one_of(st.none(), TEXT), max_size=6))
def test_words_are_those_of_the_pattern(texts):
    data, offsets = c.text_bytes(pa.array(texts, pa.string()))
    starts, ends, at = c.spans(c.solid(data), offsets)
    found = [data[s:e].tobytes().decode() for s, e in zip(starts, ends)]
    assert [found[at[i] : at[i + 1]] for i in range(len(texts))] == [words(t or "") for t in texts]


@settings(deadline=None, max_examples=60)
@given(st.lists(TEXT, min_size=1, max_size=6), st.integers(1, 3))
def test_shingle_sets_have_the_sizes_of_real_sets(texts, k):
    data, offsets = c.text_bytes(pa.array(texts))
    starts, ends, at = c.spans(c.solid(data), offsets)
    sets = c.shingle_sets(c.span_hashes(data, starts, ends), at, k)
    real = []
    for t in texts:
        w = words(t)
        real.append({tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    assert [len(s) for s in sets] == [len(s) for s in real]
    both = len(np.intersect1d(sets[0], sets[-1]))
    assert both == len(real[0] & real[-1])


def test_batches_are_cut_by_bytes_and_whole():
    batch = pa.RecordBatch.from_pydict({"text": ["a" * 10, None, "b" * 30, "", "c" * 5]})
    parts = list(c.small_batches(iter([batch]), limit=12))
    assert [p.num_rows for p in parts] == [2, 1, 2]
    assert pa.Table.from_batches(parts).to_pydict() == batch.to_pydict()


def test_code_points():
    points, offsets = c.code_points(["é🙂", None, "a"])
    assert points.tolist() == [0xE9, 0x1F642, 0x61] and offsets.tolist() == [0, 2, 2, 3]


@pytest.mark.parametrize("most", [4, 1 << 20])
def test_hashes_of_any_spans(monkeypatch, most):
    """By running sums, spans hash as they do one by one, whatever is kept from batch to batch; overlaps may be."""
    monkeypatch.setattr(c, "KEPT_POWERS", most)
    rng = np.random.default_rng(4)
    kept = {}
    for n in (300, 20, 3000):
        data = rng.integers(0, 256, n).astype(np.uint8)
        starts = rng.integers(0, n - 10, 200)
        ends = starts + rng.integers(1, 11, 200)
        got = c.span_hasher(data, kept)(starts, ends)
        want = [c.span_hashes(data, np.array([a]), np.array([b]))[0] for a, b in zip(starts, ends)]
        assert got.tolist() == [int(x) for x in want]
