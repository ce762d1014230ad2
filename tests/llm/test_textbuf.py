import re

import numpy as np
import pyarrow as pa
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import textbuf as tb

TEXT = st.lists(st.text(alphabet=st.sampled_from("ab é漢😀 \n\t\x0b\x0c\r\x1f\x00Z9."), max_size=90), max_size=8)


@settings(max_examples=80, deadline=None)
@given(TEXT)
def test_words_and_hashes(texts):
    data, off = tb.flat(pa.array(texts, pa.string()))
    starts, ends, first = tb.words(data, off, tb.NOT_SPACE)
    raw = data.tobytes()
    expected = [re.findall(rb"[^\x20\x09-\x0D]+", t.encode()) for t in texts]
    assert [[raw[s:e] for s, e in zip(starts[a:b], ends[a:b], strict=True)] for a, b in zip(first[:-1], first[1:], strict=True)] == expected
    flat = [w for ws in expected for w in ws]
    assert tb.xxh64(data, starts, ends).tolist() == [xxhash.xxh64_intdigest(w, 42) for w in flat]
    out, s, e, f = tb.squeezed(data, off, tb.NOT_SPACE) if len(data) else (data, starts, ends, first)
    assert [out.tobytes()[s[a] : e[b - 1]] if a < b else b"" for a, b in zip(f[:-1], f[1:], strict=True)] == [b" ".join(w) for w in expected]


def test_same_compares_bytes(rng=np.random.default_rng(3)):
    data = rng.integers(0, 2, 9000).astype(np.uint8)
    data[4000:8000] = data[:4000]
    a, size = rng.integers(0, 3000, 500), rng.integers(0, 1000, 500) * rng.integers(0, 3, 500)
    b = a + 4000 * rng.integers(0, 2, 500) + rng.integers(0, 2, 500)
    size = np.minimum(size, len(data) - np.maximum(a, b))
    raw = data.tobytes()
    want = [raw[i : i + n] == raw[j : j + n] for i, j, n in zip(a, b, size, strict=True)]
    assert tb.same(data, a, b, size).tolist() == want and 0 < sum(want) < 500
    assert tb.same(data, a, b, size, data.copy()).tolist() == want


def thue_morse(n, a="a", b="b"):
    """Two words of 2**n letters whose polynomial hashes modulo 2**64 agree from n = 10 on, whatever the base."""
    x, y = a, b
    for _ in range(n):
        x, y = x + y, y + x
    return x, y


def test_words_alike_to_polynomials_differ():
    for n in (10, 11, 12):
        x, y = thue_morse(n)
        data, off = tb.flat(pa.array([x, y]))
        h = tb.xxh64(data, off[:-1], off[1:])
        assert h[0] != h[1] and not tb.same(data, off[:1], off[1:2], np.array([1 << n]))[0]


def test_long_ranges_hash_as_the_library_does():
    data = np.random.default_rng(1).integers(0, 256, 5000).astype(np.uint8)
    starts = np.arange(0, 200)
    ends = starts + np.arange(200) * 24
    raw = data.tobytes()
    assert tb.xxh64(data, starts, ends, 7).tolist() == [xxhash.xxh64_intdigest(raw[s:e], 7) for s, e in zip(starts, ends, strict=True)]


def test_slices_keep_all_rows():
    batch = pa.RecordBatch.from_arrays([pa.array(["a" * 10, None, "", "b" * 50, "c"])], ["text"])
    parts = list(tb.slices(batch, "text", 12))
    assert sum((p.column(0).to_pylist() for p in parts), []) == batch.column(0).to_pylist()
    assert max(tb.sizes(p.column(0)).sum() for p in parts if p.num_rows > 1) <= 12


def test_windows_stay_inside_texts():
    data, off = tb.flat(pa.array(["a b c", "", "d e", None, "f g h i"]))
    starts, _, first = tb.words(data, off, tb.NOT_SPACE)
    assert np.flatnonzero(tb.inside(first, 3, len(starts))).tolist() == [0, 5, 6]
