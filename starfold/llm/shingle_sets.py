"""Sets of word shingles of whole texts, as sorted 64-bit hashes."""

from __future__ import annotations

import numpy as np

from . import ragged

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_ODD = [np.uint64(x | 1) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                                   0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB,
                                   0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)]


def shingle_sets(buf: np.ndarray, off: np.ndarray, width: int = 5
                 ) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, sizes): the distinct ``width``-word shingles of each text,
    ascending, one text after another.  ASCII capitals count as small letters;
    a text of fewer words has its whole sequence as one shingle, a text without
    words none."""
    buf = _LOWER[buf]
    n = len(off) - 1
    s, e = ragged.words(buf, off)
    doc = ragged.doc_of(off, s)
    word = ragged.span_hash(buf, s, e)
    count = np.bincount(doc, minlength=n)
    first = np.cumsum(count) - count
    out_hash, out_doc = [], []
    if len(word) >= width:
        whole = np.zeros(len(word) - width + 1, dtype=np.uint64)
        for k in range(width):
            whole += ragged.mix(word[k:len(word) - width + 1 + k] + _ODD[k % 8]) * _ODD[(k + 3) % 8]
        inside = doc[:len(whole)] == doc[width - 1:]
        out_hash.append(ragged.mix(whole[inside]))
        out_doc.append(doc[:len(whole)][inside])
    short = np.flatnonzero((count > 0) & (count < width))
    if len(short):
        part = np.zeros(len(short), dtype=np.uint64)
        for k in range(width - 1):
            has = count[short] > k
            part[has] += (ragged.mix(word[first[short[has]] + k] + _ODD[k % 8])
                          * _ODD[(k + 3) % 8])
        # The length keeps a short sequence apart from any full shingle.
        out_hash.append(ragged.mix(part + count[short].astype(np.uint64) * _ODD[7]))
        out_doc.append(short)
    if not out_hash:
        return np.zeros(0, np.uint64), np.zeros(n, np.int64)
    h, d = np.concatenate(out_hash), np.concatenate(out_doc)
    order = np.lexsort((h, d))
    h, d = h[order], d[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    return h[new], np.bincount(d[new], minlength=n)
