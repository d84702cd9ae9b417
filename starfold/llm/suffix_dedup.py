"""Suffix-array dedup by common-prefix-aware distributed merge sort (operator 2).

A byte goes if a string of ``length`` bytes that covers it also starts earlier:
in a document of smaller id, or earlier in the same one.

Which suffixes are sorted: every string of ``length`` bytes names one of its
places, the *anchor*, the leftmost place of the least hash of ``gram`` bytes in
it.  Equal strings name the same place, so it is enough to sort the suffixes
that start at anchors (about one place in 35), each with the bytes before it, and
of these only those whose first ``gram`` bytes occur twice in the corpus.

1. Anchor hashes are brought together; the places of those met twice go back to
   their documents.  A task sends a hash once and knows its other places to be
   repeated already, so a passage that a third of all documents share is one row
   per task.
2. A task sorts its suffixes, settles what it can among them, and sends, per
   bucket of first bytes, a *front-coded run*: each suffix as the number of
   bytes it shares with the one before, and the rest.
3. A bucket's runs are merged by a loser tree that keeps, for every run's head,
   the bytes it shares with the last winner, and compares only what lies
   beyond.  The merged order comes with its common-prefix lengths; suffixes
   that share enough bytes to the right, and have equal bytes to the left, are
   copies, and all but the first are marked.
4. Marked ranges go to their documents, which drop them.

Right contexts are compared byte by byte, left contexts by 64-bit hashes.

Defined results: a null or empty text keeps nothing and loses nothing; rows
that agree in id and text are one document, with one result each; rows that
share only the id are ordered by a hash of their texts; null ids come last; a
text shorter than ``length`` loses nothing.  Very long texts are worked on in
overlapping blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import ragged
from .store import stored

BLOCK = 4 << 20
PLACE_BITS = 24
ROWS_PER_BUCKET = 400_000
SUFFIXES_PER_BUCKET = 40_000
_LAST = np.iinfo(np.int64).max


def anchors(buf: np.ndarray, off: np.ndarray, length: int, gram: int
            ) -> tuple[np.ndarray, ...]:
    """(place, first, last, text, hash): each anchor, and the first and last
    start of the strings that name it."""
    none = tuple(np.zeros(0, np.int64) for _ in range(4)) + (np.zeros(0, np.uint64),)
    n = len(buf) - gram + 1
    reach = length - gram + 1
    if len(buf) < length:
        return none
    up, down = ragged._powers(len(buf) + 1)
    total = np.zeros(len(buf) + 1, dtype=np.uint64)
    np.cumsum(ragged._TABLE[buf] * up[:len(buf)], out=total[1:])
    h = ragged.mix((total[gram:] - total[:-gram]) * down[:n])
    low = np.uint64((1 << PLACE_BITS) - 1)
    v = (h & ~low) | np.arange(n, dtype=np.uint64)
    # Sliding minimum: of the rest of one block and the start of the next.
    size = -(-n // reach) * reach
    pad = np.full(size, np.iinfo(np.uint64).max, dtype=np.uint64)
    pad[:n] = v
    grid = pad.reshape(-1, reach)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = len(buf) - length + 1
    least = np.minimum(behind[:starts], ahead[reach - 1:reach - 1 + starts])
    place = (least & low).astype(np.int64)
    # Starts whose string lies in one text.
    span = np.maximum(np.diff(off) - length + 1, 0)
    text = np.repeat(np.arange(len(span)), span)
    p = np.arange(len(text)) - np.repeat(np.cumsum(span) - span, span) + np.repeat(off[:-1], span)
    if not len(p):
        return none
    place = place[p]
    new = np.ones(len(p), dtype=bool)
    new[1:] = (place[1:] != place[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    end = np.append(at[1:], len(p)) - 1
    a = place[at]
    return a, p[at], p[end], text[at], h[a]


def blocks(buf: np.ndarray, off: np.ndarray, length: int
           ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """(bytes, offsets, rows, base): pieces of several texts, or blocks of one
    long text that overlap so that each string lies in one of them."""
    for i, j in ragged.pieces(off):
        part, rows = buf[off[i]:off[j]], np.arange(i, j)
        if len(part) <= BLOCK:
            yield part, off[i:j + 1] - off[i], rows, 0
            continue
        for base in range(0, len(part) - length + 1, BLOCK):
            block = part[base:base + BLOCK + length - 1]
            yield block, np.array([0, len(block)]), rows, base


def _window(buf: np.ndarray, start: np.ndarray, size: np.ndarray, width: int, step: int
            ) -> np.ndarray:
    """A matrix of the bytes start, start + step ... (``size`` of them), then 0."""
    k = np.arange(width)
    at = np.clip(start[:, None] + step * k, 0, max(len(buf) - 1, 0))
    return np.where(k < size[:, None], buf[at], 0).astype(np.uint8)


def _common(rows: np.ndarray) -> np.ndarray:
    """Bytes that each row shares with the one before it."""
    out = np.zeros(len(rows), dtype=np.int64)
    if len(rows) > 1:
        differ = rows[1:] != rows[:-1]
        first = differ.argmax(axis=1)
        out[1:] = np.where(differ.any(axis=1), first, rows.shape[1])
    return out


def repeated(common: np.ndarray, far: np.ndarray, near: np.ndarray, left: np.ndarray,
             order: np.ndarray, length: int, reach: int) -> np.ndarray:
    """marks[i, o]: the string that starts ``o`` bytes before suffix i also
    starts earlier.  The suffixes are sorted, ``common`` are their common
    prefixes, ``left`` the bytes before them backwards, ``order`` ranks their
    places in the corpus (one place, one rank), and o runs from ``near`` to
    ``far``."""
    m = len(common)
    marks = np.zeros((m, reach), dtype=bool)
    by_place = np.argsort(order, kind="stable")
    power = ragged._powers(reach)[0][:reach]
    sums = np.cumsum(ragged._TABLE[left] * power, axis=1, dtype=np.uint64)
    for o in range(reach):
        rows = by_place[(near[by_place] <= o) & (far[by_place] >= o)]
        if len(rows) < 2:
            continue
        run = np.cumsum(common < length - o).astype(np.uint64)[rows]
        key = ragged.mix(run) if not o else ragged.mix(ragged.mix(run) + sums[rows, o - 1])
        by_key = np.argsort(key, kind="stable")
        first, size = _starts(key[by_key])
        place = order[rows[by_key]]
        marks[rows[by_key[place > np.repeat(place[first], size)]], o] = True
    return marks


def _ranges(marks: np.ndarray, place: np.ndarray, length: int
            ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(suffix, start, end) of the bytes that marked strings cover."""
    wide = np.zeros((len(marks), marks.shape[1] + 2), dtype=np.int8)
    wide[:, 1:-1] = marks
    step = np.diff(wide, axis=1)
    row, first = np.nonzero(step == 1)
    _, after = np.nonzero(step == -1)
    return row, place[row] - (after - 1), place[row] - first + length


def merge_runs(runs: list[tuple[list[bytes], list[int]]]) -> tuple[list[int], list[int], list[int]]:
    """(run, index, common): the merged order of sorted runs with their common
    prefixes, by a loser tree.  ``shares[r]`` is what the head of run r shares
    with the last winner; of two heads the one that shares more is smaller,
    and only heads that share equally are compared, from there on."""
    k = len(runs)
    size = 1 << max(1, (k - 1).bit_length())
    heads: list[bytes | None] = [r[0][0] if r[0] else None for r in runs] + [None] * (size - k)
    shares = [0 if h is not None else -1 for h in heads]
    at = [0] * size
    loser = [0] * size

    def play(x: int, y: int) -> tuple[int, int]:
        """(winner, loser); the loser's share becomes that with the winner."""
        sx, sy = shares[x], shares[y]
        if sx != sy:
            return (x, y) if sx > sy else (y, x)
        if sx < 0:
            return x, y
        p, q = heads[x][sx:], heads[y][sx:]
        if p == q:
            shares[y] = sx + len(p)
            return x, y
        d = int.from_bytes(p) ^ int.from_bytes(q)
        same = sx + len(p) - (d.bit_length() + 7) // 8
        if p < q:
            shares[y] = same
            return x, y
        shares[x] = same
        return y, x

    winner = list(range(-size, size))
    for node in range(size - 1, 0, -1):
        x, y = winner[2 * node], winner[2 * node + 1]
        winner[node], loser[node] = play(x, y)
    best = winner[1]
    out_run, out_at, out_common = [], [], []
    while shares[best] >= 0:
        i = at[best]
        out_run.append(best)
        out_at.append(i)
        out_common.append(shares[best])
        strings, common = runs[best]
        i += 1
        at[best] = i
        if i < len(strings):
            heads[best], shares[best] = strings[i], common[i]
        else:
            heads[best], shares[best] = None, -1
        node = (best + size) >> 1
        while node:
            best, loser[node] = play(best, loser[node])
            node >>= 1
    return out_run, out_at, out_common


_META = [("id", "<i8"), ("doc", "<i8"), ("place", "<i8"), ("far", "<u1"), ("near", "<u1"),
         ("common", "<u1")]


def encode_run(right: np.ndarray, left: np.ndarray, meta: dict[str, np.ndarray]) -> bytes:
    """A front-coded run: sorted suffixes as common prefix and rest."""
    n, width = right.shape
    common = _common(right)
    rest = right[np.arange(width) >= common[:, None]]
    before = left[np.arange(left.shape[1]) < meta["far"][:, None]]
    head = np.array([n, len(rest)], dtype="<i8").tobytes()
    cols = {**meta, "common": common}
    return b"".join([head, *[cols[c].astype(t).tobytes() for c, t in _META],
                     rest.tobytes(), before.tobytes()])


def decode_run(raw: bytes, width: int, reach: int):
    """(suffixes, left matrix, meta) of a front-coded run."""
    n, n_rest = np.frombuffer(raw, "<i8", 2).tolist()
    at, meta = 16, {}
    for c, t in _META:
        meta[c] = np.frombuffer(raw, t, n, at).astype(np.int64)
        at += n * np.dtype(t).itemsize
    out, last, p = [], b"", at
    for c in meta["common"].tolist():
        last = last[:c] + raw[p:p + width - c]
        p += width - c
        out.append(last)
    left = np.zeros((n, reach), dtype=np.uint8)
    left[np.arange(reach) < meta["far"][:, None]] = np.frombuffer(raw, np.uint8, -1, at + n_rest)
    return out, left, meta


def _place_order(meta: dict[str, np.ndarray]) -> np.ndarray:
    """The rank of each place in the corpus: by id, document, place in it."""
    order = np.lexsort((meta["place"], meta["doc"], meta["id"]))
    new = np.ones(len(order), dtype=bool)
    new[1:] = np.logical_or.reduce([meta[c][order[1:]] != meta[c][order[:-1]]
                                    for c in ("id", "doc", "place")])
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.cumsum(new)
    return rank


_SENT = "bucket int, run binary, id long, doc long, start long, stop long"


def _sent(bucket, run, ids, doc, start, stop) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket, pa.int32()), pa.array(run, pa.binary()), pa.array(ids, pa.int64()),
         pa.array(doc, pa.int64()), pa.array(start, pa.int64()), pa.array(stop, pa.int64())],
        ["bucket", "run", "id", "doc", "start", "stop"])


class SuffixDedup:
    def __init__(self, docs: DataFrame, id_col: str, text_col: str, length: int, gram: int):
        self.spark = docs.sparkSession
        # ``doc`` tells documents apart: id and text.
        self.docs = docs.select(
            F.coalesce(docs[id_col].cast("long"), F.lit(_LAST)).alias("id"),
            F.xxhash64(docs[id_col], docs[text_col]).alias("doc"),
            docs[id_col].alias("own_id"), docs[text_col].alias("text"))
        self.length, self.gram = length, gram
        self.reach = length - gram + 1

    def candidates(self) -> DataFrame:
        """(doc, places): the anchors whose first bytes occur twice."""
        length, gram = self.length, self.gram
        n_bytes = self.docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        buckets = max(16, int(n_bytes * 2 / (self.reach + 1)) // ROWS_PER_BUCKET)

        def find(batches):
            for b in batches:
                doc = b.column(0).to_numpy()
                buf, off = ragged.text_buffer(b.column(1))
                for part, o, rows, base in blocks(buf, off, length):
                    a, _, _, text, h = anchors(part, o, length, gram)
                    if not len(a):
                        continue
                    order = np.argsort(h, kind="stable")
                    same = np.zeros(len(a), dtype=bool)
                    same[order[1:]] = h[order[1:]] == h[order[:-1]]
                    twin = same.copy()
                    twin[order[:-1]] |= h[order[1:]] == h[order[:-1]]
                    d = doc[rows[text]]
                    # What is known to be repeated need not meet its like, but
                    # one place of each hash must.
                    home = np.where(same, d.view(np.uint64), h) % np.uint64(buckets)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(home.astype(np.int32)),
                         pa.array(h.view(np.int64)), pa.array(d), pa.array(a - o[text] + base),
                         pa.array(same), pa.array(twin)],
                        ["bucket", "hash", "doc", "place", "settled", "known"])
        rows = ragged.map_batches(self.docs.select("doc", "text"), find,
                                  "bucket int, hash long, doc long, place long, "
                                  "settled boolean, known boolean")

        def twice(table):
            h = table.column("hash").to_numpy()
            settled = table.column("settled").to_numpy()
            keep = settled | table.column("known").to_numpy()
            at = np.flatnonzero(~settled)
            order = at[np.argsort(h[at], kind="stable")]
            eq = h[order[1:]] == h[order[:-1]]
            keep[order[1:]] |= eq
            keep[order[:-1]] |= eq
            return table.select(["doc", "place"]).filter(pa.array(keep))
        found = ragged.map_groups(rows.groupBy("bucket"), self.spark, twice,
                                  "doc long, place long")
        return stored(found, "places").groupBy("doc").agg(
            F.collect_set("place").alias("places"))

    def ranges(self) -> DataFrame:
        """(id, doc, start, stop): the bytes that go."""
        length, gram, reach = self.length, self.gram, self.reach
        places = stored(self.candidates(), "candidates")
        many = places.agg(F.sum(F.size("places"))).first()[0] or 0
        buckets = max(16, int(many) // SUFFIXES_PER_BUCKET)
        text = self.docs.join(places, "doc").select("id", "doc", "places", "text")

        def sort(batches):
            for b in batches:
                ids, doc = b.column(0).to_numpy(), b.column(1).to_numpy()
                lists = b.column(2)
                buf, off = ragged.text_buffer(b.column(3))
                for part, o, rows, base in blocks(buf, off, length):
                    a, lo, hi, txt, h = anchors(part, o, length, gram)
                    # The wanted places, as places in this block.
                    want = lists.slice(int(rows[0]), len(rows))
                    where = np.repeat(o[:-1], want.value_lengths().to_numpy()) - base
                    where = where + want.flatten().to_numpy()
                    keep = np.isin(a, where)
                    a, lo, hi, txt, h = a[keep], lo[keep], hi[keep], txt[keep], h[keep]
                    if not len(a):
                        continue
                    right = _window(part, a, np.minimum(o[txt + 1] - a, length), length, 1)
                    wide = np.zeros((len(a), -(-length // 8) * 8), dtype=np.uint8)
                    wide[:, :length] = right
                    order = np.lexsort(wide.view(">u8").T[::-1])
                    a, lo, hi, txt, h = a[order], lo[order], hi[order], txt[order], h[order]
                    right = right[order]
                    left = _window(part, a - 1, a - lo, reach, -1)
                    meta = {"id": ids[rows[txt]], "doc": doc[rows[txt]],
                            "place": a - o[txt] + base, "far": a - lo, "near": a - hi}
                    place = _place_order(meta)
                    marks = repeated(_common(right), meta["far"], meta["near"], left, place,
                                     length, reach)
                    row, start, stop = _ranges(marks, meta["place"], length)
                    d = meta["doc"][row]
                    yield _sent(np.abs(d % buckets), [None] * len(row), meta["id"][row], d,
                                start, stop)
                    # Suffixes with a string that is not settled here go on.
                    k = np.arange(reach)
                    open_ = ((k >= meta["near"][:, None]) & (k <= meta["far"][:, None])
                             & ~marks).any(axis=1)
                    once = np.zeros(len(a), dtype=bool)      # of repeated rows, one
                    once[np.unique(place, return_index=True)[1]] = True
                    open_ &= once
                    home = (h % np.uint64(buckets)).astype(np.int64)
                    go = np.flatnonzero(open_)
                    go = go[np.argsort(home[go], kind="stable")]
                    first, size = _starts(home[go])
                    runs = [encode_run(right[x], left[x], {c: v[x] for c, v in meta.items()})
                            for x in (go[f:f + s] for f, s in zip(first, size))]
                    if runs:
                        none = [None] * len(runs)
                        yield _sent(home[go[first]], runs, none, none, none, none)
        sent = ragged.map_batches(text, sort, _SENT)

        def merge(table):
            raw = [r for r in table.column("run").to_pylist() if r is not None]
            own = table.filter(table.column("run").is_null()).select(["id", "doc", "start", "stop"])
            if not raw:
                return own
            runs, lefts, metas = zip(*[decode_run(r, length, reach) for r in raw])
            run, at, common = merge_runs([(s, m["common"].tolist())
                                          for s, m in zip(runs, metas)])
            begin = np.cumsum([0] + [len(s) for s in runs])
            idx = begin[np.array(run)] + np.array(at)
            meta = {c: np.concatenate([m[c] for m in metas])[idx] for c, _ in _META}
            marks = repeated(np.array(common), meta["far"], meta["near"],
                             np.concatenate(lefts)[idx], _place_order(meta), length, reach)
            row, start, stop = _ranges(marks, meta["place"], length)
            got = pa.table({"id": meta["id"][row], "doc": meta["doc"][row], "start": start,
                            "stop": stop})
            return pa.concat_tables([own, got.cast(own.schema)])
        return stored(ragged.map_groups(sent.groupBy("bucket"), self.spark, merge,
                                        "id long, doc long, start long, stop long"), "ranges")

    def run(self, keep_text: bool = False) -> DataFrame:
        got = self.ranges().distinct().groupBy("id", "doc").agg(
            F.collect_list(F.struct("start", "stop")).alias("ranges"))
        got = got.select(F.col("id").alias("_id"), F.col("doc").alias("_doc"), "ranges")
        all_docs = self.docs.join(got, (self.docs["id"] == got["_id"])
                                  & (self.docs["doc"] == got["_doc"]), "left")
        sent = all_docs.select("own_id", "ranges", "text")
        schema = T.StructType([self.docs.schema["own_id"]]).add("n_bytes", "long").add(
            "n_removed", "long").add("n_spans", "long").add("kept_sha256", "string")
        if keep_text:
            span = T.StructType().add("start", "long").add("stop", "long")
            schema = schema.add("kept", "binary").add("spans", T.ArrayType(span))

        def cut(batches):
            for b in batches:
                out = [_cut(t, r, keep_text) for t, r in zip(b.column(2).to_pylist(),
                                                             b.column(1).to_pylist())]
                cols = list(zip(*out)) if out else [[]] * (6 if keep_text else 4)
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(),
                         pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), *[pa.array(list(c), k) for c, k in zip(cols, kinds)]],
                    schema.names)
        return ragged.map_batches(sent, cut, schema)


def _starts(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(x):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = np.ones(len(x), dtype=bool)
    new[1:] = x[1:] != x[:-1]
    at = np.flatnonzero(new)
    return at, np.diff(np.append(at, len(x)))


def _cut(text: str | None, ranges: list | None, keep_text: bool) -> tuple:
    raw = (text or "").encode()
    spans: list[list[int]] = []
    for r in sorted((r["start"], r["stop"]) for r in ranges or []):
        if spans and r[0] <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], r[1])
        else:
            spans.append(list(r))
    ends = [0, *[x for s in spans for x in s], len(raw)]
    kept = b"".join(raw[a:b] for a, b in zip(ends[::2], ends[1::2]))
    row = (len(raw), len(raw) - len(kept), len(spans), hashlib.sha256(kept).hexdigest())
    return (*row, kept, [{"start": a, "stop": b} for a, b in spans]) if keep_text else row


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 length: int = 100, gram: int = 32, keep_text: bool = True) -> DataFrame:
    """One row per row: id, n_bytes, n_removed, n_spans, kept_sha256, and with
    ``keep_text`` the remaining bytes and the removed spans."""
    if not 1 <= gram <= length <= 255:
        raise ValueError("1 <= gram <= length <= 255 is asked for")
    return SuffixDedup(docs, id_col, text_col, length, gram).run(keep_text).withColumnRenamed(
        "own_id", id_col)


def op2_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return drop_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"), keep_text=False)
