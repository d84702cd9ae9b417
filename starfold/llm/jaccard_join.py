"""N-gram Jaccard join, size-aware heavy-light (operator 4).

1. Every text becomes its set of word shingles; equal sets are one *set* from
   here on, named by a verified 64-bit digest.
2. Order: all shingles have one global order: the frequent ones last, by the
   power of two of their count, and by hash within.
   Two sets with Jaccard similarity t share their k first common shingles
   within their prefixes of n - ceil(t n) + k shingles.
3. Small sets enumerate the 2-subsets of their prefix (k = 2); large sets, and
   small ones near the boundary, are entered in the inverted lists of their
   prefix shingles (k = 1), which are scanned.  The boundary is the largest
   size at which listing subsets costs less than scanning lists, by the mean
   list length found in the counts.
4. In each list the sets are first compared with one leader, and what links
   is one component.  Only sets of *different* components are paired after
   that; a pair must share as many prefix shingles as its sizes demand.  So
   the pairs inside a group of copies are never listed, and no link between
   components is lost.  Of two components the likest pair is judged first; all
   their pairs are listed only if that leaves them apart.  A list that may be long, because its shingles are in
   ``1 << HOT_POWER`` texts or more, is never brought together: its sets are
   cut by size class and salt into blocks of about ``BLOCK``, and each pair of
   blocks is a *cell* of its own.  A pair leaves its cell only if the places of
   the shared shingle and the parity bitmaps of the two sets allow for t.
5. Every pair is verified on the whole sets.

The frequency order is a matter of speed only: any order gives the same
result.  The frequent shingles (at most ``MAX_FREQUENT``, found by counting all
shingles of all texts) travel to the tasks.

Defined results: a null, empty or blank text has no shingles and links with
nothing; equal texts, repeated rows included, are linked; null ids are never a
component's id unless it has no other; shingle hashes have 64 bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import ragged
from .graph import components
from .shingle_sets import shingle_sets
from .store import stored

MIN_FREQUENT = 4
MAX_FREQUENT = 1 << 20
ROWS_PER_BUCKET = 200_000
COUNT_BLOCK = 1 << 21
KEYS_PER_BUCKET = 1 << 21
PAIR_BLOCK = 1 << 17
HOT_POWER = 10
BLOCK = 1024
SMALL_LIST = 64
LEADERS = 64
FEW_PAIRS = 1 << 26
FEW_ROWS = 1 << 16
WANTED_ROWS = 1 << 18
# The kind of an entry, and the bit that marks one of a list that may be long.
SUBSET, LIST, HOT = 0, 1, 2
BITMAP = [f"bits{k}" for k in range(8)]


def _digests(h: np.ndarray, n: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit digests of each set."""
    out = []
    for k in (2 * seed + 1, 2 * seed + 2):
        total = np.zeros(len(h) + 1, dtype=np.uint64)
        np.cumsum(ragged.mix(h + np.uint64(k * 0x9E3779B97F4A7C15 % (1 << 64))), out=total[1:])
        end = np.cumsum(n)
        out.append(ragged.mix(total[end] - total[end - n] + n.astype(np.uint64)).view(np.int64))
    return out[0], out[1]


def _bitmaps(h: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Parity bitmaps of the sets: two of them differ in no more bits than the
    sets in members."""
    bits = 64 * len(BITMAP)
    at = (ragged.mix(h ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(bits)).astype(np.int64)
    odd = np.bincount(np.repeat(np.arange(len(n)), n) * bits + at, minlength=len(n) * bits) & 1
    return np.packbits(odd.astype(np.uint8).reshape(len(n), bits), axis=1).view(np.uint64)


def size_classes(largest: int, num: int, den: int) -> np.ndarray:
    """The least size of each class; linked sets are at most one class apart."""
    least = [1]
    while least[-1] <= largest:
        least.append(least[-1] * den // num + 1)
    return np.array(least)


def _need(n, num: int, den: int):
    """ceil(t * n): what a partner must share with a set of n at least."""
    return -(-num * n // den)


class Order:
    """The global shingle order: by the power of two of a frequent shingle's
    count (the others come first), then by hash."""

    def __init__(self, frequent: np.ndarray, power: np.ndarray):
        order = np.argsort(frequent)
        self.frequent, self.power = frequent[order], power[order].astype(np.int8)

    def prefixes(self, h: np.ndarray, n: np.ndarray, length: np.ndarray
                 ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(hashes, set number, place, power) of the first ``length`` shingles
        of each set, in order."""
        doc = np.repeat(np.arange(len(n)), n)
        late = np.zeros(len(h), dtype=np.int8)
        if len(self.frequent):
            at = np.minimum(np.searchsorted(self.frequent, h), len(self.frequent) - 1)
            late = np.where(self.frequent[at] == h, self.power[at], 0)
            order = np.lexsort((h, late, doc))
            h, late = h[order], late[order]
        rank = np.arange(len(h)) - np.repeat(np.cumsum(n) - n, n)
        inside = rank < np.repeat(length, n)
        return h[inside], doc[inside], rank[inside], late[inside]


def _entries(h, n, sid, order: Order, boundary: int, num: int, den: int,
             hot: int) -> pa.Table:
    """Keys under which the sets are found: (kind, key, sid, n, pos).  From
    power ``hot`` on, a key's list may be long."""
    first = np.unique(sid, return_index=True)[1]       # copies within the piece
    keep = np.zeros(len(sid), dtype=bool)
    keep[first] = True
    keep &= n > 1                                      # a single shingle links with equal sets only
    h, sid, n = h[np.repeat(keep, n)], sid[keep], n[keep]
    need = _need(n, num, den)
    kinds, keys, rows, places = [], [], [], []
    listed = n >= _need(boundary, num, den)
    ph, pd, place, power = order.prefixes(h, n, np.where(listed, n - need + 1, 0))
    kinds.append(np.where(power >= hot, LIST + HOT, LIST).astype(np.int8))
    places.append(place)
    keys.append(ph)
    rows.append(pd)
    small = (n <= boundary) & (need > 1)
    sh, sd, _, power = order.prefixes(h, n, np.where(small, np.minimum(n - need + 2, n), 0))
    size = np.bincount(sd, minlength=len(n)) if len(sd) else np.zeros(len(n), np.int64)
    start = np.cumsum(size) - size
    for width in np.unique(size[size > 1]):
        which = np.flatnonzero(size == width)
        block = sh[start[which][:, None] + np.arange(width)]
        many = power[start[which][:, None] + np.arange(width)] >= hot
        for i in range(width - 1):
            for j in range(i + 1, width):
                lo = np.minimum(block[:, i], block[:, j])
                hi = np.maximum(block[:, i], block[:, j])
                kinds.append(np.where(many[:, i] & many[:, j], SUBSET + HOT, SUBSET)
                             .astype(np.int8))
                places.append(np.zeros(len(which), np.int64))
                keys.append(ragged.mix(ragged.mix(lo) + hi))
                rows.append(which)
    at = np.concatenate(rows)
    return pa.table({"kind": pa.array(np.concatenate(kinds)),
                     "key": pa.array(np.concatenate(keys).view(np.int64)),
                     "sid": pa.array(sid[at]), "n": pa.array(n[at].astype(np.int32)),
                     "pos": pa.array(np.concatenate(places).astype(np.int32))})


def _runs(*cols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of equal rows."""
    if not len(cols[0]):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = np.ones(len(cols[0]), dtype=bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in cols])
    at = np.flatnonzero(new)
    return at, np.diff(np.append(at, len(new)))


def _lists_with_leader(table: pa.Table) -> pa.Table:
    """Of one bucket: the lists with two sets or more, and each one's leader.
    Of a list that may be long a bucket has a part; it stays, without leader."""
    kind, key, sid, n, pos = (table.column(c).to_numpy() for c in ("kind", "key", "sid", "n", "pos"))
    order = np.lexsort((sid, key, kind))
    kind, key, sid, n, pos = kind[order], key[order], sid[order], n[order], pos[order]
    at, _ = _runs(kind, key, sid)
    kind, key, sid, n, pos = kind[at], key[at], sid[at], n[at], pos[at]
    at, length = _runs(kind, key)
    part = kind >= HOT
    many = np.repeat(length > 1, length) | part
    lead = np.repeat(at, length)
    return pa.table({"kind": kind[many], "key": key[many], "sid": sid[many], "n": n[many],
                     "pos": pos[many],
                     "lead": pa.array(sid[lead][many], mask=part[many]),
                     "lead_n": pa.array(n[lead][many], mask=part[many])})


def _mixed(table: pa.Table, least: np.ndarray) -> pa.Table:
    """Of one bucket: the lists with sets of different components, and the parts
    of lists that may be long; with the class of each set's size."""
    kind, key, label = (table.column(c).to_numpy() for c in ("kind", "key", "label"))
    order = np.lexsort((key, kind))
    at, length = _runs(kind[order], key[order])
    keep = kind[order] >= HOT
    if len(at):
        label = label[order]
        keep |= np.repeat(np.minimum.reduceat(label, at) != np.maximum.reduceat(label, at), length)
    out = table.select([*_ENTRIES_COLUMNS, "label"]).take(pa.array(order[keep]))
    size = np.searchsorted(least, out.column("n").to_numpy(), side="right") - 1
    return out.append_column("size", pa.array(size.astype(np.int32)))


_ENTRIES = "kind byte, key long, sid long, n int, pos int"
_LISTS = _ENTRIES + ", lead long, lead_n int"
_MIXED = _ENTRIES + ", label long, size int"
_PAIRS = ("a long, b long, n_a int, n_b int, kind byte, shared int, lo long, hi long, differ long, "
          "several boolean, met long")
_ENTRIES_COLUMNS = ["kind", "key", "sid", "n", "pos"]
_CELL = ["kind", "key", "level", "x", "y"]


def _apart(batches, num: int, den: int, boundary: int, nearest: bool = False):
    """Pairs of sets of different components that share a key, with the number
    of keys they share, as they are found; with ``nearest`` the likest pair of
    each two components.  The rows come cell by cell, by size within; each set is
    paired with those from its own size to size / t, and on the other side if the
    cell has two (``side`` is 0 or 1)."""
    held: list[np.ndarray] = []
    rest = None
    for b in batches:
        table = pa.Table.from_batches([b])
        if rest is not None:
            table = pa.concat_tables([rest, table]).combine_chunks()
        start, _ = _runs(*(table.column(c).to_numpy() for c in _CELL))
        if len(start) < 2:
            rest = table
            continue
        rest = table.slice(start[-1])
        yield from _cells(table.slice(0, start[-1]), num, den, boundary, nearest, held)
    if rest is not None:
        yield from _cells(rest, num, den, boundary, nearest, held)
    if held:
        yield from _pair_table(_merged(held, nearest)).to_batches()


def _merged(parts: list[np.ndarray], nearest: bool) -> np.ndarray:
    """The parts as one, equal pairs once; with ``nearest`` equal component pairs
    once, by the pair that differs least, ``several`` if there was another."""
    rows = np.concatenate(parts)
    a, b, lo, hi, differ = (rows[:, k] for k in (0, 1, 6, 7, 8))
    rows = rows[np.lexsort((b, a, differ, hi, lo) if nearest else (b, a))]
    at, length = _runs(*(rows[:, k] for k in ((6, 7) if nearest else (0, 1))))
    best = np.repeat(at, length)
    same = (rows[:, 0] == rows[best, 0]) & (rows[:, 1] == rows[best, 1])
    out = rows[at]
    out[:, 5] = np.add.reduceat(np.where(same, rows[:, 5], 0), at)
    out[:, 9] = np.maximum.reduceat(np.where(same, rows[:, 9], 1), at)
    out[:, 10] = np.add.reduceat(rows[:, 10], at)
    return out


def _pair_table(rows: np.ndarray) -> pa.Table:
    return pa.table({"a": rows[:, 0], "b": rows[:, 1], "n_a": pa.array(rows[:, 2], pa.int32()),
                     "n_b": pa.array(rows[:, 3], pa.int32()),
                     "kind": pa.array(rows[:, 4], pa.int8()),
                     "shared": pa.array(rows[:, 5], pa.int32()), "lo": rows[:, 6],
                     "hi": rows[:, 7], "differ": rows[:, 8],
                     "several": pa.array(rows[:, 9] > 0), "met": rows[:, 10]})


def _cells(table: pa.Table, num: int, den: int, boundary: int, nearest: bool,
           held: list[np.ndarray]):
    """Pairs of whole cells; what is not yielded yet stays in ``held``."""
    sid, n, pos, label, side = (table.column(c).to_numpy()
                                for c in ("sid", "n", "pos", "label", "side"))
    n, pos = n.astype(np.int64), pos.astype(np.int64)
    kind = table.column("kind").to_numpy() & ~np.int8(HOT)
    bits = np.stack([table.column(c).to_numpy() for c in BITMAP], axis=1).view(np.uint64)
    at, length = _runs(*(table.column(c).to_numpy() for c in _CELL))
    # Position of the last partner each set may have, cell by cell.
    group = np.repeat(np.arange(len(at)), length)
    wide = int(n.max()) * den // num + 1
    last = np.searchsorted(group * (wide + 1) + n, group * (wide + 1)
                           + np.minimum(n * den // num, wide), side="right")
    count = last - np.arange(len(n)) - 1
    i = 0
    while i < len(n):
        j = i + 1
        total = int(count[i])
        while j < len(n) and total + int(count[j]) <= PAIR_BLOCK:
            total += int(count[j])
            j += 1
        if total:
            left = np.repeat(np.arange(i, j), count[i:j])
            step = np.arange(total) - np.repeat(np.cumsum(count[i:j]) - count[i:j], count[i:j])
            right = left + 1 + step
            # Two small sets meet in their subsets, not in the lists.
            ok = (label[left] != label[right]) & ((kind[left] == SUBSET) | (n[right] > boundary))
            ok &= (side[left] < 0) | (side[left] != side[right])
            left, right = left[ok], right[ok]
            # No more is common than lies before, and from, the shared shingle;
            # and the bitmaps differ in no more bits than the sets in members.
            common = -(-num * (n[left] + n[right]) // (num + den))
            ok = (np.minimum(pos[left], pos[right])
                  + np.minimum(n[left] - pos[left], n[right] - pos[right])) >= common
            left, right, common = left[ok], right[ok], common[ok]
            differ = np.bitwise_count(bits[left] ^ bits[right]).sum(axis=1, dtype=np.int64)
            ok = differ <= n[left] + n[right] - 2 * common
            left, right, differ = left[ok], right[ok], differ[ok]
            if len(left):
                swap = sid[left] > sid[right]
                a, b = np.where(swap, right, left), np.where(swap, left, right)
                one = np.ones(len(a), np.int64)
                held.append(np.stack([sid[a], sid[b], n[a], n[b], kind[a].astype(np.int64), one,
                                      np.minimum(label[a], label[b]),
                                      np.maximum(label[a], label[b]),
                                      (differ << 20) // (n[a] + n[b]), one - 1, one], axis=1))
            if sum(map(len, held)) > 2 * PAIR_BLOCK:
                held[:] = [_merged(held, nearest)]
                if len(held[0]) > PAIR_BLOCK:
                    yield from _pair_table(held.pop()).to_batches()
        i = j


def _likest(batch, num: int, den: int, boundary: int) -> pa.Table:
    """For each set the leader of its list (column ``lead``) that may be linked with
    it, is of another component, and differs in the fewest bits for their sizes."""
    one = {c: batch.column(c).to_numpy(zero_copy_only=False)
           for c in ("kind", "sid", "n", "pos", "label", *BITMAP)}
    lists = batch.column("lead")
    length = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten()
    two = {c: flat.field(c).to_numpy(zero_copy_only=False)
           for c in ("sid", "n", "pos", "label", *BITMAP)}
    row = np.repeat(np.arange(batch.num_rows), length)
    n, m = one["n"][row].astype(np.int64), two["n"].astype(np.int64)
    p, q = one["pos"][row].astype(np.int64), two["pos"].astype(np.int64)
    differ = np.zeros(len(row), np.int64)
    for c in BITMAP:
        differ += np.bitwise_count(one[c][row] ^ two[c])
    common = -(-num * (n + m) // (num + den))
    ok = (one["label"][row] != two["label"]) & (np.minimum(n, m) * den >= np.maximum(n, m) * num)
    ok &= ((one["kind"][row] & ~np.int8(HOT)) == SUBSET) | (np.maximum(n, m) > boundary)
    ok &= np.minimum(p, q) + np.minimum(n - p, m - q) >= common
    ok &= differ <= n + m - 2 * common
    at = np.flatnonzero(ok)
    at = at[np.lexsort((two["sid"][at], differ[at] / (n + m)[at], row[at]))]
    first, _ = _runs(row[at])
    at = at[first]
    a, b = one["sid"][row[at]], two["sid"][at]
    return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})


def _bucket(buckets: int):
    """A short list goes to one bucket, one that may be long to all of them."""
    key = F.when(F.col("kind") < HOT, F.col("key")).otherwise(F.xxhash64("key", "sid"))
    return F.pmod(key, F.lit(buckets))


class Join:
    def __init__(self, docs: DataFrame, id_col: str, text_col: str, width: int, num: int, den: int):
        self.spark = docs.sparkSession
        # The text's hash finds a row again, where ids are null or repeated.
        self.docs = docs.select(docs[id_col].alias("id"), F.xxhash64(docs[text_col]).alias("at"),
                                docs[text_col].alias("text"))
        self.width, self.num, self.den = width, num, den

    def _map(self, df: DataFrame, fn, schema: str) -> DataFrame:
        """``fn(hashes, sizes, rest of the batch, from, to)`` per piece of the texts."""
        width = self.width

        def run(batches):
            for b in batches:
                buf, off = ragged.text_buffer(b.column(b.num_columns - 1))
                for i, j in ragged.pieces(off):
                    h, n = shingle_sets(buf[off[i]:off[j]], off[i:j + 1] - off[i], width)
                    yield from fn(h, n, b, i, j).to_batches()
        return ragged.map_batches(df, run, schema)

    def sets(self) -> DataFrame:
        """(id, n, sid) per row, sid null without shingles; sid is verified: a
        second digest tells apart what the first does not, another seed then."""
        seed = 0
        while True:
            def digest(h, n, b, i, j, seed=seed):
                one, two = _digests(h, n, seed)
                none = n == 0
                bits = _bitmaps(h, n)
                return pa.table({"id": b.column(0).slice(i, j - i),
                                 "at": b.column(1).slice(i, j - i), "n": pa.array(n),
                                 "sid": pa.array(one, mask=none), "check": pa.array(two),
                                 **{c: pa.array(bits[:, k].view(np.int64)) for k, c in enumerate(BITMAP)}})
            schema = (T.StructType([self.docs.schema["id"]]).add("at", "long").add("n", "long")
                      .add("sid", "long").add("check", "long"))
            for c in BITMAP:
                schema = schema.add(c, "long")
            got = stored(self._map(self.docs, digest, schema), "sets")
            twice = got.filter("sid IS NOT NULL").groupBy("sid").agg(
                F.min("check").alias("lo"), F.max("check").alias("hi")).filter("lo <> hi")
            if twice.isEmpty():
                self.seed = seed
                return got.drop("check")
            seed += 1

    def order(self, shingles: int) -> tuple[Order, float]:
        """The frequent shingles and the mean number of others in a list.

        All shingles of all texts are counted: a task adds up ``COUNT_BLOCK`` of them
        at a time, so a shingle in every text is one entry a block, and deals ranges
        of them, as arrays, to buckets of about ``KEYS_PER_BUCKET``."""
        width, buckets = self.width, max(16, shingles // KEYS_PER_BUCKET)
        shift = np.uint64(64 - (buckets - 1).bit_length())

        def block(held):
            """The distinct shingles of some pieces with their counts, one row per
            bucket: keys ascend, so a bucket is a range of them."""
            key, c = np.unique(np.concatenate(held), return_counts=True)
            at, length = _runs(key >> shift)
            ends = at + length
            yield pa.RecordBatch.from_arrays(
                [pa.array((key[at] >> shift).astype(np.int64)),
                 pa.array([key[a:e].tobytes() for a, e in zip(at, ends)], pa.binary()),
                 pa.array([c[a:e].astype(np.uint32).tobytes() for a, e in zip(at, ends)],
                          pa.binary())], ["bucket", "keys", "counts"])

        def count(batches):
            held, size = [], 0
            for b in batches:
                if not b.num_rows:
                    continue
                buf, off = ragged.text_buffer(b.column(0))
                for i, j in ragged.pieces(off):
                    h, _ = shingle_sets(buf[off[i]:off[j]], off[i:j + 1] - off[i], width)
                    held.append(h)
                    size += len(h)
                    if size >= COUNT_BLOCK:
                        yield from block(held)
                        held, size = [], 0
            if size:
                yield from block(held)

        def add_up(table):
            key = np.concatenate([np.frombuffer(x.as_buffer(), np.uint64) for x in table["keys"]])
            c = np.concatenate([np.frombuffer(x.as_buffer(), np.uint32) for x in table["counts"]])
            order = np.argsort(key, kind="stable")
            key, c = key[order], c[order].astype(np.int64)
            at, _ = _runs(key)
            key, c = key[at], np.add.reduceat(c, at)
            more = c > 1
            return pa.table({"key": key[more].view(np.int64), "c": c[more]})
        blocks = ragged.map_batches(self.docs.select("text"), count,
                                    "bucket long, keys binary, counts binary")
        counts = stored(ragged.map_groups(blocks.groupBy("bucket"), self.spark, add_up,
                                          "key long, c long"), "counts")
        hist = {int(r[0]): (int(r[1]), int(r[2])) for r in counts.groupBy(
            F.floor(F.log2("c")).alias("b")).agg(
                F.count(F.lit(1)), F.sum(F.col("c") * (F.col("c") - 1))).collect()}
        bits = MIN_FREQUENT.bit_length() - 1
        while sum(k for b, (k, _) in hist.items() if b >= bits) > MAX_FREQUENT:
            bits += 1
        rare = sum(s for b, (_, s) in hist.items() if b < bits)
        many = counts.filter(F.col("c") >= (1 << bits)).select(
            "key", F.floor(F.log2("c")).alias("power")).toArrow()
        frequent = many.column("key").to_numpy().view(np.uint64)
        return Order(frequent, many.column("power").to_numpy()), rare

    def boundary(self, shingles: int, rare: float) -> int:
        """The largest size at which a set's subsets are fewer than what its
        lists hold: own entries plus the others met there."""
        others = rare / max(1.0, shingles)
        size = 1
        for n in range(2, 512):
            p = n - _need(n, self.num, self.den) + 1
            if (p + 1) * p / 2 > p * (1 + others):
                break
            size = n
        return size

    def lists(self, order: Order, boundary: int, shingles: int) -> DataFrame:
        num, den, seed, hot = self.num, self.den, self.seed, HOT_POWER
        shared = self.spark.sparkContext.broadcast(order)
        buckets = max(16, int(shingles * (1 - num / den) * 1.2) // ROWS_PER_BUCKET)

        def entries(h, n, b, i, j):
            sid, _ = _digests(h, n, seed)
            return _entries(h, n, sid, shared.value, boundary, num, den, hot)
        rows = self._map(self.docs.select("text"), entries, _ENTRIES)
        grouped = rows.withColumn("bucket", _bucket(buckets)).groupBy("bucket")
        return stored(ragged.map_groups(grouped, self.spark, _lists_with_leader, _LISTS), "lists")

    def stars(self, lists: DataFrame) -> DataFrame:
        """(a, b): the sets of each list with its leader, where their sizes fit."""
        hot = lists.filter(F.col("kind") >= HOT).drop("lead", "lead_n")
        heads = stored(hot.groupBy("kind", "key").agg(F.min(F.struct("sid", "n")).alias("_lead")),
                       "heads")
        hot = hot.join(heads, ["kind", "key"]).withColumn("lead", F.col("_lead.sid")).withColumn(
            "lead_n", F.col("_lead.n")).drop("_lead")
        fits = ((F.least("n", "lead_n") * self.den >= F.greatest("n", "lead_n") * self.num)
                & (F.col("sid") != F.col("lead")))
        return stored(lists.filter(F.col("kind") < HOT).unionByName(hot).filter(fits)
                      .select(F.col("lead").alias("a"), F.col("sid").alias("b")).distinct(), "stars")

    def merged(self, lists: DataFrame, links: DataFrame, sets: DataFrame, boundary: int
               ) -> tuple[DataFrame, DataFrame]:
        """(links, labels) after more leaders.  One leader leaves apart what is like
        each other but not like it.  While the lists of more than ``SMALL_LIST`` sets
        still hold many pairs of different components, each set of theirs goes to one
        of its lists, drawn by hash, and is verified against the likest, by the bitmaps,
        of up to ``LEADERS`` other sets drawn there: as many comparisons as there are
        sets.  It ends when the pairs are in proportion to the lists or fewer than a
        round is worth (``FEW_PAIRS``), or a round no longer takes away a tenth of
        them; what is left is paired exactly afterwards."""
        label, before, turn = components(links), None, 0
        long_ = lists.groupBy("kind", "key").count().filter(F.col("count") > SMALL_LIST)
        rows = stored(lists.join(long_.select("kind", "key"), ["kind", "key"])
                      .select(*_ENTRIES_COLUMNS), "long-lists")
        bits = stored(sets.join(rows.select("sid").distinct(), "sid", "left_semi")
                      .groupBy("sid").agg(*[F.min(c).alias(c) for c in BITMAP]), "bitmaps")
        num, den = self.num, self.den

        def likest(batches):
            for b in batches:
                if b.num_rows:
                    yield from _likest(b, num, den, boundary).to_batches()
        while True:
            known = rows.join(label, rows["sid"] == label["node"], "left").select(
                *_ENTRIES_COLUMNS, F.coalesce("label", "sid").alias("label"))
            size = known.groupBy("kind", "key", "label").agg(
                F.count(F.lit(1)).alias("c")).groupBy("kind", "key").agg(
                F.sum("c").alias("t"), F.sum(F.col("c") * F.col("c")).alias("s"))
            open_ = stored(size.filter(F.col("s") < F.col("t") * F.col("t")), "open-lists")
            held, pairs = open_.agg(F.sum("t"), F.sum((F.col("t") * F.col("t") - F.col("s")) / 2)
                                    ).first()
            if held is None or pairs <= max(FEW_PAIRS, SMALL_LIST * held) or (
                    before is not None and pairs > 0.9 * before):
                return links, label
            before, turn = pairs, turn + 1
            drawn = F.xxhash64("sid", "key", F.lit(turn))
            known = stored(known.join(open_.select("kind", "key"), ["kind", "key"])
                           .withColumn("drawn", drawn), "open-sets")
            member = F.struct("drawn", "kind", "key", "sid", "n", "pos", "label")
            one = known.groupBy("sid").agg(F.min(member).alias("m")).select("m.*")
            slot = F.pmod(F.xxhash64("sid", F.lit(turn)), F.lit(LEADERS))
            lead = (known.groupBy("kind", "key", slot.alias("slot"))
                    .agg(F.min(F.struct("drawn", "sid", "n", "pos", "label")).alias("m"))
                    .select("kind", "key", "m.*").join(bits, "sid")
                    # One leader a slot, so a list has LEADERS of them at most.
                    .groupBy("kind", "key").agg(F.collect_list(F.struct(
                        "sid", "n", "pos", "label", *BITMAP)).alias("lead")))
            lead = stored(lead, "leaders")
            met = stored(one.join(bits, "sid"), "met").join(lead, ["kind", "key"])
            near = ragged.map_batches(met.select("kind", "sid", "n", "pos", "label", *BITMAP,
                                                 "lead"), likest, "a long, b long")
            more = self.verified(stored(near.distinct(), "leader-pairs"), sets)
            if more.isEmpty():
                return links, label
            links = links.unionByName(more)
            label = components(links)

    def cells(self, lists: DataFrame, label: DataFrame, sets: DataFrame, shingles: int,
              largest: int, within: DataFrame | None = None) -> DataFrame:
        """The sets of lists with different components, cell by cell: a short
        list is one cell, a long one has a cell for each pair of blocks.  With
        ``within`` only the sets of those components (column ``label``)."""
        known = lists.join(label, lists["sid"] == label["node"], "left").select(
            "kind", "key", "sid", "n", "pos", F.coalesce("label", "sid").alias("label"))
        if within is not None:
            known = known.join(within, "label", "left_semi")
        buckets = max(16, int(shingles * (1 - self.num / self.den) * 0.3) // ROWS_PER_BUCKET)
        least = size_classes(largest, self.num, self.den)

        def mixed(table):
            return _mixed(table, least)
        grouped = known.withColumn("bucket", _bucket(buckets)).groupBy("bucket")
        rows = stored(ragged.map_groups(grouped, self.spark, mixed, _MIXED), "mixed")
        bits = (sets.join(rows.select("sid").distinct(), "sid", "left_semi")
                .groupBy("sid").agg(*[F.min(c).alias(c) for c in BITMAP]))
        rows = rows.join(bits, "sid")
        hot = rows.filter(F.col("kind") >= HOT)
        blocks = stored(hot.groupBy("kind", "key").agg(
            F.min("label").alias("_lo"), F.max("label").alias("_hi"),
            F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("_salts"))
            .filter("_lo <> _hi").drop("_lo", "_hi"), "blocks")
        salt = F.pmod(F.xxhash64("sid"), F.col("_salts")).cast("int")
        hot = hot.join(blocks, ["kind", "key"]).withColumn("_salt", salt)
        own, other, level = F.col("_salt"), F.sequence(F.lit(0), F.col("_salts") - 1), 2 * F.col(
            "size")

        def cell(level, x, y, side):
            return F.struct(level.alias("level"), x.alias("x"), y.alias("y"),
                            side.cast("int").alias("side"))
        hot = hot.withColumn("_cell", F.explode(F.concat(
            F.transform(other, lambda k: cell(level, F.least(own, k), F.greatest(own, k), F.when(
                own == k, -1).when(own < k, 0).otherwise(1))),
            F.transform(other, lambda k: cell(level + 1, own, k, F.lit(0))),
            F.transform(other, lambda k: cell(level - 1, k, own, F.lit(1))))))
        columns = [*_ENTRIES_COLUMNS, "label", *BITMAP]
        hot = hot.select(*columns, "_cell.level", "_cell.x", "_cell.y", "_cell.side")
        none = F.lit(0)
        return rows.filter(F.col("kind") < HOT).select(
            *columns, none.alias("level"), none.alias("x"), none.alias("y"),
            F.lit(-1).alias("side")).unionByName(hot)

    def verified(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """The pairs (a, b) that link, judged on their whole sets."""
        num, den, seed = self.num, self.den, self.seed
        wanted = pairs.select(F.col("a").alias("sid")).unionByName(
            pairs.select(F.col("b").alias("sid"))).distinct()
        # One document for each set that is asked for.
        one = stored(sets.join(wanted, "sid", "left_semi").groupBy("sid")
                     .agg(F.min(F.struct("id", "at")).alias("_one"))
                     .select("sid", F.col("_one.id").alias("_id"), F.col("_one.at").alias("_at")),
                     "wanted")
        # A few of them travel to the texts, so that the texts stay where they are.
        if one.count() <= WANTED_ROWS:
            one = F.broadcast(one)
        text = (self.docs.join(one, self.docs["id"].eqNullSafe(one["_id"])
                               & (self.docs["at"] == one["_at"])).select("sid", "text"))

        def own(h, n, b, i, j):
            end = np.cumsum(n)
            offsets = pa.array(np.append(0, end * 8).astype(np.int32))
            data = pa.Array.from_buffers(pa.binary(), len(n), [None, offsets.buffers()[1],
                                                               pa.py_buffer(h.tobytes())])
            return pa.table({"sid": b.column(0).slice(i, j - i), "set": data, "digest":
                             pa.array(_digests(h, n, seed)[0])})
        # Texts whose hashes agree may differ: only the right one counts.
        found = (self._map(text, own, "sid long, set binary, digest long")
                 .filter("sid = digest").drop("digest").dropDuplicates(["sid"]))
        found = stored(found, "whole-sets")
        a = found.select(F.col("sid").alias("a"), F.col("set").alias("set_a"))
        b = found.select(F.col("sid").alias("b"), F.col("set").alias("set_b"))
        both = pairs.select("a", "b").join(b, "b").join(a, "a")

        def judge(batches):
            for batch in batches:
                cols = {c: batch.column(batch.schema.get_field_index(c)) for c in batch.schema.names}
                keep = []
                for x, y in zip(cols["set_a"], cols["set_b"]):
                    x = np.frombuffer(x.as_buffer(), np.uint64)
                    y = np.frombuffer(y.as_buffer(), np.uint64)
                    both_n = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(den * both_n >= num * (len(x) + len(y) - both_n))
                keep = pa.array(keep, pa.bool_())
                yield pa.RecordBatch.from_arrays([pc.filter(cols["a"], keep),
                                                  pc.filter(cols["b"], keep)], ["a", "b"])
        return stored(ragged.map_batches(both.select("a", "b", "set_a", "set_b"), judge,
                                         "a long, b long"), "links")

    def met(self, cells: DataFrame, boundary: int, nearest: bool) -> DataFrame:
        """Of the cells: the pairs of different components that may link, or with
        ``nearest`` the likest pair of each two components (lo, hi), whether there
        are ``several`` of them, and how often any of them ``met``."""
        num, den = self.num, self.den

        def apart(batches):
            return _apart(batches, num, den, boundary, nearest)
        pairs = ragged.map_batches(cells.repartition(*_CELL).sortWithinPartitions(*_CELL, "n", "sid"),
                                   apart, _PAIRS)
        # Of the common shingles at most need - 1 lie behind the prefix of the
        # set whose prefix ends first; the rest must be among the shared ones.
        total = F.ceil((F.col("n_a") + F.col("n_b")) * num / (num + den))
        behind = F.ceil(F.greatest("n_a", "n_b") * num / den) - 1
        enough = (F.col("kind") == SUBSET) | (F.col("shared") >= total - behind)
        if not nearest:
            return (pairs.groupBy("a", "b", "n_a", "n_b", "kind").agg(F.sum("shared").alias("shared"))
                    .filter(enough).select("a", "b").distinct())
        # The shared shingles of a pair are all counted only where it is the one pair.
        pair = F.struct("a", "b")
        return (pairs.groupBy("lo", "hi").agg(
            F.min(F.struct("differ", "a", "b", "n_a", "n_b", "kind")).alias("best"),
            F.sum("shared").alias("shared"), F.sum("met").alias("met"),
            (F.max("several") | (F.min(pair) != F.max(pair))).alias("several"))
            .select("lo", "hi", "best.*", "shared", "met", "several")
            .filter(F.col("several") | enough).select("a", "b", "lo", "hi", "met", "several"))

    def paired(self, lists: DataFrame, links: DataFrame, label: DataFrame, stars: DataFrame,
               sets: DataFrame, boundary: int, shingles: int, largest: int) -> DataFrame:
        """The labels after all pairs of different components.  Two components need
        one link to be one, so first the likest pair of each two is judged; all pairs
        are listed only of those components that stay apart and had several, once
        they would be few or the likest ones no longer link."""
        within, before = None, None
        while True:
            cells = self.cells(lists, label, sets, shingles, largest, within)
            near = stored(self.met(cells, boundary, True), "nearest")
            more = self.verified(stored(near.select("a", "b").join(stars, ["a", "b"], "left_anti"),
                                        "pairs"), sets)
            linked = not more.isEmpty()
            if linked:
                links = links.unionByName(more)
                label = components(links)
            lo = label.select(F.col("node").alias("lo"), F.col("label").alias("_lo"))
            hi = label.select(F.col("node").alias("hi"), F.col("label").alias("_hi"))
            apart = stored(near.filter("several").join(lo, "lo", "left").join(hi, "hi", "left")
                           .select(F.coalesce("_lo", "lo").alias("lo"),
                                   F.coalesce("_hi", "hi").alias("hi"), "met")
                           .filter("lo <> hi"), "apart")
            rows = apart.agg(F.sum("met")).first()[0]
            if rows is None:
                return label
            within = stored(apart.select(F.col("lo").alias("label")).unionByName(
                apart.select(F.col("hi").alias("label"))).distinct(), "within")
            if rows <= FEW_ROWS or not linked or (before is not None and rows > 0.9 * before):
                break
            before = rows
        cells = self.cells(lists, label, sets, shingles, largest, within)
        pairs = self.met(cells, boundary, False).join(stars, ["a", "b"], "left_anti")
        more = self.verified(stored(pairs, "pairs"), sets)
        return label if more.isEmpty() else components(links.unionByName(more))

    def run(self) -> DataFrame:
        sets = self.sets()
        shingles, largest = (x or 0 for x in sets.agg(F.sum("n"), F.max("n")).first())
        order, rare = self.order(shingles)
        boundary = self.boundary(shingles, rare)
        lists = self.lists(order, boundary, shingles)
        stars = self.stars(lists)
        links, label = self.merged(lists, self.verified(stars, sets), sets, boundary)
        label = self.paired(lists, links, label, stars, sets, boundary, shingles, largest)
        groups = sets.filter("sid IS NOT NULL").groupBy("sid").agg(F.min("id").alias("id"))
        groups = groups.join(label, groups["sid"] == label["node"], "left").select(
            "sid", "id", F.coalesce("label", "sid").alias("label"))
        least = groups.groupBy("label").agg(F.min("id").alias("component_id"))
        own = groups.join(least, "label").select(F.col("sid").alias("_sid"), "component_id",
                                                 "label")
        out = sets.join(own, sets["sid"] == own["_sid"], "left")
        return out.select("id", "at", F.col("n").alias("n_shingles"), "sid", "label",
                          F.when(F.col("sid").isNull(), F.col("id"))
                          .otherwise(F.col("component_id")).alias("component_id"))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       width: int = 5, similarity: tuple[int, int] = (80, 100)) -> DataFrame:
    """One row per row: id, n_shingles, sid (equal for equal sets) and
    component_id, the smallest id that links lead to."""
    return (Join(docs, id_col, text_col, width, *similarity).run().drop("at", "label")
            .withColumnRenamed("id", id_col))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
             similarity: tuple[int, int] = (80, 100)) -> DataFrame:
    """The rows of ``docs`` without those that are linked to a better one: of
    each component the row with the smallest id stays (null ids last; of rows
    that share the id, the smallest text hash).  Rows that agree in id and text
    stand or fall together; documents without shingles stay."""
    found = Join(docs, id_col, text_col, width, *similarity).run()
    found = stored(found.filter("label IS NOT NULL").select("id", "at", "label"), "found")
    best = (found.groupBy(F.col("label").alias("_label"))
            .agg(F.min(F.struct(F.col("id").isNull(), "id", "at")).alias("_best")))
    is_best = (F.col("id").eqNullSafe(F.col("_best.id")) & (F.col("at") == F.col("_best.at")))
    drop = (found.join(best, found["label"] == best["_label"]).filter(~is_best)
            .select(F.col("id").alias("_id"), F.col("at").alias("_at")).distinct())
    drop = stored(drop, "dropped")
    return docs.join(drop, docs[id_col].eqNullSafe(drop["_id"])
                     & (F.xxhash64(docs[text_col]) == drop["_at"]), "left_anti")


def op4_jaccard_join(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return jaccard_components(docs).select("doc_id", "n_shingles", "component_id")
