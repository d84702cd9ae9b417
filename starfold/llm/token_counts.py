"""Token counts by rank-synchronous array merging (operator 5).

Texts are cut into pre-tokens by array operations on their code points; the
distinct pre-tokens of a piece are held as one ragged array of symbols, and in
every step each sequence merges all places of its own lowest-ranked pair at
once.  A sequence without a mergeable pair leaves the array; the number of its
surviving symbols is its token count, and a text's count is the sum over its
pre-tokens.  No text is shuffled.

Defined results: a null or empty text has 0 bytes and 0 tokens; special
strings inside a text are one token each, as the tokenizer file defines them;
a long text is worked on in blocks that end before a space that follows an
ASCII letter or digit, where a pre-token always starts, so memory stays bounded.
Supported files: byte-level BPE without normaliser.  Files without the
standard pre-token pattern are refused.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import ragged

OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
BLOCK_BYTES = 2 << 20


def char_classes() -> np.ndarray:
    """The class of every code point, as the tokenizer library's own pattern
    engine sees it."""
    from tokenizers import Regex
    from tokenizers.pre_tokenizers import Split
    points = np.concatenate([np.arange(0xD800), np.arange(0xE000, 0x110000)])
    every = points.astype("<u4").tobytes().decode("utf-32-le")
    table = np.zeros(0x110000 + 1, dtype=np.uint8)
    for cls, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        # Runs of the class come back as the pieces that "removed" leaves when
        # the pattern is inverted.
        for _, (a, b) in Split(Regex(pattern), "removed", invert=True).pre_tokenize_str(every):
            table[points[a:b]] = cls
    return table


def _byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a byte-level file:
    visible Latin-1 characters stand for themselves, the other bytes take the
    code points from 256 on, in order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


@dataclass
class BpeTables:
    """Arrays of one byte-level BPE file: pairs with rank and merged symbol, the
    symbol of each byte, special strings, and character classes.

    Pairs lie in layers of ``2 ** SLOT_BITS`` slots: the n-th pair that falls
    into a slot lies in the n-th layer, -1 marks a free place."""

    keys: list[np.ndarray]
    rank: list[np.ndarray]
    merged: list[np.ndarray]
    byte_symbol: np.ndarray
    specials: list[bytes]
    classes: np.ndarray
    size: int


NONE = np.int32(2**31 - 1)
SLOT_BITS = 19


def _slot(key: np.ndarray) -> np.ndarray:
    return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def look_up(key: np.ndarray, t: BpeTables) -> tuple[np.ndarray, np.ndarray]:
    """Rank and merged symbol of each pair, NONE where there is no merge."""
    rank = np.full(len(key), NONE, dtype=np.int32)
    new = np.zeros(len(key), dtype=np.int32)
    at, slot = np.arange(len(key)), _slot(key)
    for keys, ranks, merged in zip(t.keys, t.rank, t.merged):
        held = keys[slot]
        hit = held == key[at]
        rank[at[hit]] = ranks[slot[hit]]
        new[at[hit]] = merged[slot[hit]]
        on = (held >= 0) & ~hit
        at, slot = at[on], slot[on]
    return rank, new


def load_tables(path: str) -> BpeTables:
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre = spec.get("pre_tokenizer") or {}
    if (spec["model"]["type"] != "BPE" or spec.get("normalizer") or pre.get("type") != "ByteLevel"
            or not pre.get("use_regex", True) or pre.get("add_prefix_space")):
        raise ValueError("only byte-level BPE files with the standard pattern are supported")
    vocab = spec["model"]["vocab"]
    size = max(vocab.values()) + 1
    pairs = [m if isinstance(m, list) else m.split(" ", 1) for m in spec["model"]["merges"]]
    key = np.array([vocab[a] * size + vocab[b] for a, b in pairs], dtype=np.int64)
    new = np.array([vocab[a + b] for a, b in pairs], dtype=np.int32)
    layers = []
    todo, slot = np.arange(len(key)), _slot(key)
    while len(todo):
        _, first = np.unique(slot[todo], return_index=True)
        put = todo[first]
        layer = [np.full(1 << SLOT_BITS, -1, dtype=np.int64),
                 np.zeros(1 << SLOT_BITS, np.int32), np.zeros(1 << SLOT_BITS, np.int32)]
        layer[0][slot[put]], layer[1][slot[put]], layer[2][slot[put]] = key[put], put, new[put]
        layers.append(layer)
        todo = np.setdiff1d(todo, put)
    return BpeTables(*[list(x) for x in zip(*layers)],
                     np.array([vocab[c] for c in _byte_symbols()], dtype=np.int32),
                     [t["content"].encode() for t in spec.get("added_tokens", [])],
                     char_classes(), size)


def _code_points(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points and the byte position of each."""
    at = np.flatnonzero((buf & 0xC0) != 0x80)
    lead = buf[at].astype(np.int32)
    b = np.concatenate([buf, np.zeros(3, np.uint8)]).astype(np.int32) & 0x3F
    cp = lead
    two = (lead >= 0xC0) & (lead < 0xE0)
    three = (lead >= 0xE0) & (lead < 0xF0)
    four = lead >= 0xF0
    for mask, head, more in ((two, 0x1F, 1), (three, 0x0F, 2), (four, 0x07, 3)):
        if mask.any():
            p = at[mask]
            v = lead[mask] & head
            for k in range(1, more + 1):
                v = (v << 6) | b[p + k]
            cp[mask] = v
    return cp, at


def pretoken_starts(buf: np.ndarray, segment: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Byte positions at which pre-tokens start.  ``segment``: byte positions
    at which a separate text starts."""
    if not len(buf):
        return np.zeros(0, np.int64)
    cp, at = _code_points(buf)
    n = len(cp)
    cls = classes[cp]
    opens = np.zeros(n + 1, dtype=bool)
    opens[np.searchsorted(at, segment)] = True
    opens[n] = True
    space = cls == SPACE
    before_is_space = np.zeros(n, dtype=bool)
    before_is_space[1:] = space[:-1]
    before_is_space &= ~opens[:-1]
    before_is_blank = np.zeros(n, dtype=bool)
    before_is_blank[1:] = cp[:-1] == 0x20
    before_is_blank &= ~opens[:-1]
    changed = np.ones(n, dtype=bool)
    changed[1:] = cls[1:] != cls[:-1]
    # Last space of a run that something follows: it leaves the run, alone or
    # (a blank) as the head of the next pre-token.
    last = space.copy()
    last[:-1] &= ~space[1:]
    last &= ~opens[1:]
    start = np.where(space, ~before_is_space | last, changed & ~before_is_blank)
    start |= opens[:-1]

    quote = np.flatnonzero((cp == 0x27) & start)
    if len(quote):
        wide = np.concatenate([cp, np.zeros(3, cp.dtype)])
        shut = np.concatenate([opens, np.ones(3, bool)])
        a, b = wide[quote + 1], wide[quote + 2]
        one = ((a == 0x73) | (a == 0x74) | (a == 0x6D) | (a == 0x64)) & ~shut[quote + 1]
        two = ((((a == 0x72) | (a == 0x76)) & (b == 0x65)) | ((a == 0x6C) & (b == 0x6C)))
        two &= ~shut[quote + 1] & ~shut[quote + 2]
        for which, length in ((one, 2), (two, 3)):
            q = quote[which]
            start[q + 1] = False
            end = q + length
            end = end[end < n]
            end = end[cls[end] == LETTER]
            start[end] = True
    return at[start]


def merge_counts(symbols: np.ndarray, lengths: np.ndarray, t: BpeTables) -> np.ndarray:
    """Surviving symbols of each sequence of the ragged array."""
    out = np.array(lengths, dtype=np.int64)
    alive = np.flatnonzero(lengths > 1)
    sym = symbols[np.repeat(lengths > 1, lengths)]
    ids, n = alive, lengths[alive]

    def pairs(at: np.ndarray, tail: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of the pairs that begin at these places."""
        key = sym[at].astype(np.int64) * t.size + sym[np.minimum(at + 1, len(sym) - 1)]
        key[tail] = -2
        return look_up(key, t)

    if len(ids):
        every = np.arange(len(sym))
        rank, new = pairs(every, np.cumsum(n) - 1)
    while len(ids):
        head = np.cumsum(n) - n
        low = np.minimum.reduceat(rank, head)
        go = low != NONE
        out[ids[~go]] = n[~go]
        if not go.any():
            break
        mine = (rank == np.repeat(low, n)) & (rank != NONE)
        # Equal pairs can overlap only in a run of one symbol: every other one.
        where = np.flatnonzero(mine)
        fresh = np.ones(len(where), dtype=bool)
        fresh[1:] = where[1:] != where[:-1] + 1
        if not fresh.all():
            run = np.cumsum(fresh) - 1
            where = where[(where - where[fresh][run]) % 2 == 0]
        sym[where] = new[where]
        stay = np.repeat(go, n)
        stay[where + 1] = False
        taken = np.zeros(len(sym) + 1, dtype=np.int64)
        np.cumsum(stay, out=taken[1:])
        n = (taken[head + n] - taken[head])[go]
        at = taken[where]
        sym, rank, new, ids = sym[stay], rank[stay], new[stay], ids[go]
        out[ids] = n
        # Only the merged symbol's own pair and the one before it are new.
        first = np.zeros(len(sym) + 1, dtype=bool)
        first[np.cumsum(n) - n] = True
        first[-1] = True
        before = at[~first[at]] - 1
        at = np.concatenate([at, before])
        rank[at], new[at] = pairs(at, first[at + 1])
        more = n > 1
        if not more.all():
            some = np.repeat(more, n)
            sym, rank, new, ids, n = sym[some], rank[some], new[some], ids[more], n[more]
    return out


def _blocks(buf: np.ndarray) -> list[int]:
    """Safe cuts of one long text: before a blank that follows an ASCII letter
    or digit."""
    cuts, at = [], 0
    word = np.zeros(256, dtype=bool)
    word[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
    while len(buf) - at > BLOCK_BYTES:
        for lo in range(at + BLOCK_BYTES, len(buf), BLOCK_BYTES):
            part = buf[lo - 1:lo + BLOCK_BYTES]
            ok = np.flatnonzero(word[part[:-1]] & (part[1:] == 0x20))
            if len(ok):
                at = lo + int(ok[0])
                cuts.append(at)
                break
        else:
            break
    return cuts


def _count_block(buf: np.ndarray, offsets: np.ndarray, t: BpeTables) -> np.ndarray:
    """Token counts of the texts of one block."""
    n_docs = len(offsets) - 1
    total = np.zeros(n_docs, dtype=np.int64)
    if not len(buf):
        return total
    raw = buf.tobytes()
    spans = []
    for s in t.specials:
        at = raw.find(s)
        while at >= 0:
            doc = int(np.searchsorted(offsets, at, side="right")) - 1
            if at + len(s) <= offsets[doc + 1]:
                spans.append((at, at + len(s), doc))
            at = raw.find(s, at + len(s))
    segment = np.unique(np.concatenate([offsets[:-1], *[[a, b] for a, b, _ in spans]]))
    segment = segment[segment < len(buf)].astype(np.int64)
    start = pretoken_starts(buf, segment, t.classes)
    end = np.append(start[1:], len(buf))
    if spans:
        inside = np.zeros(len(buf), dtype=bool)
        for a, b, doc in spans:
            inside[a:b] = True
            total[doc] += 1
        start, end = start[~inside[start]], end[~inside[start]]
    first, code = ragged.factorize(buf, start, end)
    s, n = start[first], end[first] - start[first]
    count = merge_counts(t.byte_symbol[ragged.gather(buf, s, n)], n, t)
    doc = ragged.doc_of(offsets, start)
    total += np.bincount(doc, weights=count[code], minlength=n_docs).astype(np.int64)
    return total


def count_tokens(buf: np.ndarray, offsets: np.ndarray, t: BpeTables) -> np.ndarray:
    if len(offsets) != 2 or len(buf) <= BLOCK_BYTES:
        return _count_block(buf, offsets, t)
    cuts = [0, *_blocks(buf), len(buf)]
    return sum((_count_block(buf[a:b], np.array([0, b - a]), t) for a, b in zip(cuts, cuts[1:])),
               np.zeros(1, np.int64))


def token_counts(docs: DataFrame, tables: BpeTables, text_col: str = "text",
                 keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns of every row plus n_bytes and n_tokens.  The tables have
    a fixed size (vocabulary and character classes) and travel with the task."""
    shared = docs.sparkSession.sparkContext.broadcast(tables)

    def run(buf, off):
        return {"n_bytes": np.diff(off).astype(np.int64),
                "n_tokens": count_tokens(buf, off, shared.value)}
    return ragged.map_text(docs, text_col, [T.StructField("n_bytes", T.LongType()),
                                            T.StructField("n_tokens", T.LongType())],
                           run, keep, limit=BLOCK_BYTES)


def op5_token_counts(spark, sf_dir: str, limit: int = 512) -> DataFrame:
    import public_tokenizers
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    tables = load_tables(public_tokenizers.path("byte_bpe_50k.json"))
    return (token_counts(docs, tables, keep=["doc_id"])
            .withColumn("over_limit", F.col("n_tokens") > limit))
