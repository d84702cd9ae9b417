"""Ragged byte arrays: the numpy helpers that the text operators share.

A batch of texts is one ``uint8`` buffer and an offsets array; words, lines
and pre-tokens are (start, end) pairs into the buffer.  Work is done on pieces
of at most ``PIECE_BYTES`` (or one document), so that memory stays bounded.
"""

from __future__ import annotations

import ctypes
import inspect
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

PIECE_BYTES = 1 << 20
BATCH_BYTES = 8 << 20
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def map_batches(df: DataFrame, fn, schema) -> DataFrame:
    """``mapInArrow`` with this package on the workers' path, for a session
    started elsewhere (a cluster gets it with --py-files or an install), and
    with batches bounded in bytes: texts differ much in length."""
    spark = df.sparkSession
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))

    def run(batches):
        try:
            yield from fn(batches)
        finally:
            give_back()
    return df.mapInArrow(run, schema)


def map_groups(grouped, spark, fn, schema) -> DataFrame:
    """``applyInArrow``, likewise."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)
    if "key" in inspect.signature(fn).parameters:
        def run(key, table):
            try:
                return fn(key, table)
            finally:
                give_back()
    else:
        def run(table):
            try:
                return fn(table)
            finally:
                give_back()
    return grouped.applyInArrow(run, schema)


def give_back() -> None:
    """Freed memory goes back to the system: Python workers outlive their tasks,
    and what one stage needed must not stay with the next."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)

_WS = np.zeros(256, dtype=bool)
_WS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))
_TABLE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_pow: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(16, int(n).bit_length())
    if size not in _pow:
        up = np.full(size, _BASE, dtype=np.uint64)
        up[0] = 1
        down = np.full(size, _BASE_INV, dtype=np.uint64)
        down[0] = 1
        if len(_pow) > 4:
            _pow.clear()
        _pow[size] = (np.multiply.accumulate(up), np.multiply.accumulate(down))
    return _pow[size]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_buffer(arr) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (n + 1) of a string array; a null counts as empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    arr = pc.fill_null(arr.cast(pa.large_binary()), b"")
    off = np.frombuffer(arr.buffers()[1], dtype=np.int64)[arr.offset:arr.offset + len(arr) + 1]
    data = arr.buffers()[2]
    buf = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[off[0]:off[-1]], off - off[0]


def pieces(offsets: np.ndarray, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of documents of at most ``limit`` bytes together, one document
    at least."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def map_text(df: DataFrame, text_col: str, fields: list[T.StructField],
             fn: Callable[[np.ndarray, np.ndarray], dict[str, np.ndarray]],
             keep: list[str] | None = None, limit: int = PIECE_BYTES) -> DataFrame:
    """``keep`` columns of every row (all, if not given) plus ``fields``,
    computed by ``fn(bytes, offsets)`` from the whole texts.  A kept column of
    a computed one's name gives way to it."""
    names = [f.name for f in fields]
    keep = [c for c in (df.columns if keep is None else keep) if c not in names]
    schema = T.StructType([df.schema[c] for c in keep] + fields)
    sent_name = "_text"
    while sent_name in keep:
        sent_name += "_"

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            text = b.column(b.num_columns - 1)
            buf, off = text_buffer(text)
            got: dict[str, list] = {n: [] for n in names}
            for i, j in pieces(off, limit):
                out = fn(buf[off[i]:off[j]], off[i:j + 1] - off[i])
                for n in names:
                    got[n].append(out[n])
            cols = [b.column(k) for k in range(len(keep))]
            yield pa.RecordBatch.from_arrays(
                cols + [pa.array(np.concatenate(got[n])) for n in names], keep + names)

    sent = df.select(*[df[c] for c in keep], df[text_col].alias(sent_name))
    return map_batches(sent, run, schema)


def doc_of(offsets: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The document that holds each byte position (positions ascend)."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(np.searchsorted(at, offsets)))


def words(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of ``[^\\x20\\x09-\\x0D]+`` of each text."""
    if not len(buf):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    solid = ~_WS[buf]
    first = np.zeros(len(buf) + 1, dtype=bool)
    first[offsets] = True
    start = solid.copy()
    start[1:] &= ~solid[:-1] | first[1:-1]
    end = solid.copy()
    end[:-1] &= ~solid[1:] | first[1:-1]
    return np.flatnonzero(start), np.flatnonzero(end) + 1


def lines(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the pieces between line feeds of each text."""
    cut = np.flatnonzero(buf == 10)
    starts = np.union1d(offsets[:-1], cut + 1)
    # A line feed that ends a text opens an empty line there: same offset as
    # the next text's start, and without a word in any case.
    starts = starts[starts < len(buf)] if len(buf) else starts[:0]
    is_first = np.zeros(len(buf) + 1, dtype=bool)
    is_first[offsets] = True
    nxt = np.append(starts[1:], len(buf))
    ends = np.where(is_first[nxt], nxt, nxt - 1)
    # The last line of a text may itself end in a line feed.
    tail = (ends > starts) & (ends == nxt)
    tail[tail] = buf[ends[tail] - 1] == 10
    ends = np.where(tail, ends - 1, ends)
    return starts, ends


def span_hash(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's bytes, by prefix sums."""
    up, down = _powers(len(buf) + 1)
    total = np.zeros(len(buf) + 1, dtype=np.uint64)
    np.cumsum(_TABLE[buf] * up[:len(buf)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts]
               + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def gather(buf: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The spans' bytes, one after another."""
    total = int(lengths.sum())
    if not total:
        return buf[:0]
    at = np.cumsum(lengths) - lengths
    idx = np.ones(total, dtype=np.int64)
    some = lengths > 0
    s, a, n = starts[some], at[some], lengths[some]
    idx[0] = s[0]
    idx[a[1:]] = s[1:] - (s[:-1] + n[:-1] - 1)
    return buf[np.cumsum(idx)]


def factorize(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray
              ) -> tuple[np.ndarray, np.ndarray]:
    """(first, code): spans with equal bytes get equal codes, ``first[code]``
    is one span of each.  Hashes propose, bytes decide."""
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    _, first, code = np.unique(span_hash(buf, starts, ends), return_index=True,
                               return_inverse=True)
    rep = first[code]
    other = np.flatnonzero(rep != np.arange(len(rep)))
    length = ends - starts
    same = (length[other] == length[rep[other]]).all()
    if same:
        n = length[other]
        same = np.array_equal(gather(buf, starts[other], n), gather(buf, starts[rep[other]], n))
    if not same:
        raw = buf.tobytes()
        seen: dict[bytes, int] = {}
        code = np.array([seen.setdefault(raw[s:e], len(seen))
                         for s, e in zip(starts.tolist(), ends.tolist())], dtype=np.int64)
        _, first = np.unique(code, return_index=True)
    return first, code


def per_doc(counts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of a per-byte array over each text."""
    total = np.zeros(len(counts) + 1, dtype=np.int64)
    np.cumsum(counts, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]
