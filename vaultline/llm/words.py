"""Whole-batch word handling on Arrow arrays: splitting, numbering, per-text sums.

A word is a maximal run of bytes other than ASCII white space, so it is the same
as a match of ``[^\\x20\\x09-\\x0D]+``. Nothing here loops over words in Python.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash


def slices(batch: pa.RecordBatch, name: str, most: int = 2 << 20):
    """The batch in slices of whole rows whose texts in column ``name`` have about ``most`` bytes
    together, so that what is derived from a slice stays small. Rows are copied: some Arrow
    kernels read past an array's offset."""
    size = pc.fill_null(pc.binary_length(batch.column(name)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(size.astype(np.int64) + 64) // most
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(edges[:-1], edges[1:]):
        if b > a:
            yield batch.take(pa.array(np.arange(a, b)))


def split(texts: pa.Array, lower: bool = False) -> tuple[pa.Array, np.ndarray]:
    """All words of all texts in order, and the offset of each text's first word
    (``len(texts) + 1`` numbers). A null text has no words."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    if lower:
        texts = pc.ascii_lower(texts)
    lists = pc.ascii_split_whitespace(texts)
    flat, off = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
    full = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    if not full.all():
        kept = np.concatenate([[0], np.cumsum(full)])
        flat, off = flat.filter(pa.array(full)), kept[off]
    return flat, off


def numbered(words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Each word's number, and the distinct words by number."""
    if len(words) == 0:
        return np.zeros(0, np.int64), pa.array([], words.type)
    d = words.dictionary_encode()
    return d.indices.to_numpy().astype(np.int64), d.dictionary


def hashed(distinct: pa.Array, seed: int = 0) -> np.ndarray:
    """64-bit hash of each distinct word; the same in every task and run."""
    h = xxhash.xxh3_64_intdigest
    return np.fromiter((h(w, seed) for w in distinct.cast(pa.large_binary()).to_pylist()), np.uint64,
                       len(distinct))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mix of each number."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def windows(ids: np.ndarray, off: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all windows of ``size`` words that lie within one text, and the text of each."""
    doc = np.repeat(np.arange(len(off) - 1), np.diff(off))
    start = np.arange(len(ids), dtype=np.int64)
    ok = start + size <= off[1:][doc]
    return start[ok], doc[ok]


def rolled(h: np.ndarray, start: np.ndarray, size: int) -> np.ndarray:
    """64-bit hash of the ``size`` consecutive word hashes at each start; order counts."""
    out = np.zeros(len(start), np.uint64)
    for j in range(size):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + h[start + j])
    return out


def sums(x: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sum of ``x`` over each text's words."""
    c = np.concatenate([[0], np.cumsum(x)])
    return c[off[1:]] - c[off[:-1]]
