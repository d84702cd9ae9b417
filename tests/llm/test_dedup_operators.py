"""Exact dedup, Jaccard join and suffix dedup against brute force."""

import hashlib
import os
import random
import re
import sys
from collections import Counter

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

sys.path.insert(0, os.path.dirname(__file__))

import odd_rows as odd  # noqa: E402
from starfold.llm import chunk_dedup, jaccard_join, suffix_dedup  # noqa: E402
from starfold.llm.graph import components  # noqa: E402

CAPITALS = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# -- exact dedup --------------------------------------------------------------------

def test_exact_groups_match_brute_force(spark):
    docs = odd.documents(spark)
    got = chunk_dedup.exact_groups(docs).collect()
    by = {}
    for r in docs.select("doc_id", "text").collect():
        by.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r.text or ""), []).append(r.doc_id)
    assert len(got) == docs.count()
    sha = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in by.items()}
    for r in got:
        ids = sha[r.text_sha256]
        known = [i for i in ids if i is not None]
        assert (r.group_size, r.keep_id) == (len(ids), min(known) if known else None)
    assert sum(r.kept for r in got) == len(by)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_drop_copies_keeps_the_columns_and_one_row_of_each_text(spark):
    docs = odd.documents(spark)
    out = chunk_dedup.drop_copies(docs)
    assert out.columns == docs.columns
    kept = [re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "") for r in out.collect()]
    assert len(kept) == len(set(kept)) == chunk_dedup.exact_groups(docs).filter("kept").count()


def test_a_shared_identifier_takes_another_seed(spark, monkeypatch):
    from pyspark.sql import functions as F
    plain = chunk_dedup._identifier

    def poor(chunk, seed):
        return (F.length(chunk).cast("long"), F.lit(0).cast("long")) if seed == 0 else plain(chunk,
                                                                                            seed)
    monkeypatch.setattr(chunk_dedup, "_identifier", poor)
    assert chunk_dedup.verified_seed(odd.documents(spark)) == 1


def test_exact_dedup_runs_no_python(spark):
    plan = chunk_dedup.exact_groups(odd.documents(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# -- Jaccard join ----------------------------------------------------------------

def shingles(text):
    w = odd.WORD.findall((text or "").translate(CAPITALS))
    if len(w) < 5:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4))


def brute_components(rows):
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and 100 * both >= 80 * len(a | sets[j]):
                up[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted((str(d), len(sets[i]), str(least.get(find(i)))) for i, (d, _) in enumerate(rows))


def run_components(df):
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id))
                  for r in jaccard_join.jaccard_components(df).collect())


def test_every_frequent_shingle_is_counted(spark, monkeypatch):
    docs = odd.documents(spark)
    count = Counter(x for r in docs.collect() for x in shingles(r.text))
    for block in (1 << 21, 100):
        monkeypatch.setattr(jaccard_join, "COUNT_BLOCK", block)
        order, rare = jaccard_join.Join(docs, "doc_id", "text", 5, 80, 100).order(sum(count.values()))
        assert len(order.frequent) == sum(c >= jaccard_join.MIN_FREQUENT
                                          for c in count.values()) > 0
        assert rare == sum(c * (c - 1) for c in count.values() if c < jaccard_join.MIN_FREQUENT)
    empty = odd.nothing(spark)
    assert not len(jaccard_join.Join(empty, "doc_id", "text", 5, 80, 100).order(0)[0].frequent)


def test_long_lists_in_cells_give_the_same_components(spark, monkeypatch):
    rnd = random.Random(4)
    passage = [f"p{i}" for i in range(40)]
    rows = []
    for i in range(150):
        # A template with own words in one block: similarity on both sides of 0.8.
        own, at = rnd.choice([2, 3, 4, 5, 8, 20]), rnd.randint(0, 20)
        w = passage[:at] + [f"w{rnd.randint(0, 3)}" for _ in range(own)] + passage[at + own:]
        rows.append((i, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_components(rows)
    assert len({r[2] for r in want}) > 2 and run_components(docs) == want
    monkeypatch.setattr(jaccard_join, "HOT_POWER", 2)
    monkeypatch.setattr(jaccard_join, "BLOCK", 4)
    largest = []
    plain = jaccard_join.Join.cells

    def cells(self, *args):
        out = plain(self, *args)
        largest.append(out.groupBy(*jaccard_join._CELL).count().agg({"count": "max"}).first()[0])
        return out
    monkeypatch.setattr(jaccard_join.Join, "cells", cells)
    assert run_components(docs) == want and largest[0] < 40


def _template(n, seed=4):
    """Texts of one template with own words in one block: similarity on both sides
    of 0.8, one list for all."""
    rnd = random.Random(seed)
    passage = [f"p{i}" for i in range(120)]
    rows = []
    for i in range(n):
        own, at = rnd.choice([4, 6, 8, 9, 10, 12]), rnd.randint(0, 100)
        w = passage[:at] + [f"w{rnd.randint(0, 10 ** 6)}" for _ in range(own)] + passage[at + own:]
        rows.append((i, " ".join(w)))
    return rows


def test_more_leaders_give_the_same_components(spark, monkeypatch):
    rows = _template(100)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_components(rows)
    rounds = []
    monkeypatch.setattr(jaccard_join, "SMALL_LIST", 2)
    monkeypatch.setattr(jaccard_join, "LEADERS", 8)
    monkeypatch.setattr(jaccard_join.Join, "verified", _noted(rounds, VERIFIED))
    assert run_components(docs) == want and len(rounds) > 2


def test_leaders_and_likest_pairs_in_rounds_give_the_same_components(spark, monkeypatch):
    rows = _template(100, seed=5)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_components(rows)
    for few, value in (("FEW_PAIRS", 0), ("FEW_ROWS", 0)):
        monkeypatch.setattr(jaccard_join, few, value)
    monkeypatch.setattr(jaccard_join, "SMALL_LIST", 2)
    monkeypatch.setattr(jaccard_join, "LEADERS", 8)
    monkeypatch.setattr(jaccard_join, "WANTED_ROWS", 0)
    names, plain = [], jaccard_join.stored

    def stored(df, name):
        names.append(name)
        return plain(df, name)
    monkeypatch.setattr(jaccard_join, "stored", stored)
    assert run_components(docs) == want
    assert "leader-pairs" in names and "nearest" in names


def test_likest_pair_of_two_components():
    """Two components of 60 sets, all in one list and alike: one pair is made."""
    n = 120
    table = {"kind": np.full(n, jaccard_join.LIST, np.int8), "key": np.zeros(n, np.int64),
             "sid": np.arange(n), "n": np.full(n, 50, np.int32), "pos": np.zeros(n, np.int32),
             "label": np.arange(n) % 2}
    table |= {c: np.zeros(n, np.int64) for c in jaccard_join.BITMAP}
    table |= {"level": np.zeros(n, np.int32), "x": np.zeros(n, np.int32),
              "y": np.zeros(n, np.int32), "side": np.full(n, -1, np.int32)}
    table["bits0"][2:] = np.arange(2, n)
    batch = pa.RecordBatch.from_pydict(table)
    near = [r for b in jaccard_join._apart([batch], 80, 100, 1, True) for r in b.to_pylist()]
    assert [(r["a"], r["b"], r["lo"], r["hi"], r["several"], r["met"]) for r in near] == [
        (0, 1, 0, 1, True, 3600)]
    every = [r for b in jaccard_join._apart([batch], 80, 100, 1) for r in b.to_pylist()]
    assert len(every) == 3600


def test_lists_are_stored_with_no_join_behind_them(spark, monkeypatch):
    """Or else every reader of the lists joins the long ones again."""
    rows = _template(40)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(jaccard_join, "HOT_POWER", 2)
    plans, plain = [], jaccard_join.Join.lists

    def lists(self, *args):
        out = plain(self, *args)
        plans.append(out._jdf.queryExecution().optimizedPlan().toString())
        return out
    monkeypatch.setattr(jaccard_join.Join, "lists", lists)
    assert run_components(docs) == brute_components(rows)
    assert "Join" not in plans[0]


def _noted(rounds, plain):
    def verified(self, pairs, sets):
        rounds.append(pairs.count())
        return plain(self, pairs, sets)
    return verified


VERIFIED = jaccard_join.Join.verified


def test_bitmaps_and_classes_never_part_what_links():
    rnd = np.random.default_rng(1)
    for n in (3, 40, 700):
        h = np.sort(rnd.integers(0, 1 << 62, n + n // 4, dtype=np.uint64))
        a, b = h[:n], h[n // 8:n + n // 8]
        bits = jaccard_join._bitmaps(np.concatenate([a, b]), np.array([len(a), len(b)]))
        assert np.bitwise_count(bits[0] ^ bits[1]).sum() <= len(np.setxor1d(a, b))
    least = jaccard_join.size_classes(5000, 80, 100)
    n = np.arange(1, 4000)
    size = np.searchsorted(least, n, side="right")
    assert (np.searchsorted(least, n * 100 // 80, side="right") - size <= 1).all()


def test_components_match_brute_force(spark):
    docs = odd.documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert run_components(docs) == brute_components(rows)


def test_small_and_large_sets_meet_at_any_boundary(spark, monkeypatch):
    """Families of near copies from 5 to 60 words, every way to split them
    between subsets and lists."""
    rnd = random.Random(7)
    rows = []
    for family in range(12):
        words = [f"w{rnd.randrange(4000)}" for _ in range(5 + family * 5)]
        for _ in range(6):
            w = list(words)
            for _ in range(rnd.randint(0, 2)):
                w[rnd.randrange(len(w))] = f"x{rnd.randrange(9)}"
            rows.append((len(rows), " ".join(w[:rnd.randint(len(w) - 2, len(w))])))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = brute_components(rows)
    assert run_components(docs) == want
    for boundary in (1, 30, 80):
        monkeypatch.setattr(jaccard_join.Join, "boundary", lambda *a, b=boundary: b)
        assert run_components(docs) == want


def test_keep_one_leaves_one_row_per_component(spark):
    docs = odd.documents(spark)
    out = jaccard_join.keep_one(docs)
    assert out.columns == docs.columns
    want = {c for _, n, c in run_components(docs) if n and c != "None"}
    ids = [str(r.doc_id) for r in out.collect() if shingles(r.text)]
    assert want <= set(ids)
    # Repeated rows stand or fall together.
    assert len(set(ids) - {"None"}) == len(want)


def test_components_of_chains_and_cycles(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 102), (102, 101), (101, 100), (200, 7)]
    got = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    assert {got[i] for i in range(41)} == {0} and got[200] == 0
    assert [got[i] for i in (100, 101, 102)] == [100] * 3


# -- suffix dedup ---------------------------------------------------------------

def brute_repeats(rows, length):
    seen, out = set(), {}
    for d, text in sorted(rows):
        raw = (text or "").encode()
        gone = np.zeros(len(raw), dtype=bool)
        for p in range(len(raw) - length + 1):
            g = raw[p:p + length]
            if g in seen:
                gone[p:p + length] = True
            seen.add(g)
        kept = bytes(b for b, x in zip(raw, gone) if not x)
        spans = int((gone & ~np.append(False, gone[:-1])).sum()) if len(raw) else 0
        out[d] = (len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


def run_repeats(df, **options):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
            for r in suffix_dedup.drop_repeats(df, keep_text=False, **options).collect()}


def test_repeats_match_brute_force(spark):
    rnd = random.Random(3)
    pool = ["".join(rnd.choice("abé \n") for _ in range(rnd.randint(90, 260))) for _ in range(6)]
    rows = [(i, "".join(rnd.choice(pool)[rnd.randint(0, 40):rnd.randint(60, 260)]
                        if rnd.random() < 0.7 else "x" * rnd.randint(0, 150)
                        for _ in range(rnd.randint(0, 8)))) for i in range(120)]
    rows += [(500, None), (501, ""), (502, "a" * 900), (503, "ab" * 300), (504, "\0" * 300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert run_repeats(df) == brute_repeats(rows, 100)
    assert run_repeats(df, length=40, gram=12) == brute_repeats(rows, 40)


def test_repeats_of_odd_rows(spark):
    docs = odd.documents(spark)
    out = suffix_dedup.drop_repeats(docs)
    rows = out.collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert len(r.kept) == r.n_bytes - r.n_removed and len(r.spans) == r.n_spans
        assert hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256
    plain = [tuple(r) for r in docs.filter("doc_id IS NOT NULL").select("doc_id", "text")
             .distinct().collect()]
    got = run_repeats(docs)
    for d, want in brute_repeats(plain, 100).items():
        assert got[d] == want


def test_front_coded_runs_survive_the_round_trip():
    rng = np.random.default_rng(1)
    right = np.sort(rng.integers(97, 99, (50, 20), dtype=np.uint8).view("S20").ravel())
    right = right.view(np.uint8).reshape(50, 20)
    far = rng.integers(0, 6, 50)
    left = np.where(np.arange(6) < far[:, None], rng.integers(1, 255, (50, 6)), 0).astype(np.uint8)
    meta = {"id": np.arange(50), "doc": np.arange(50) * 7 - 9, "place": np.arange(50) + 100,
            "far": far, "near": far // 2}
    s, got_left, got = suffix_dedup.decode_run(suffix_dedup.encode_run(right, left, meta), 20, 6)
    assert s == [bytes(r) for r in right] and np.array_equal(left, got_left)
    assert all(np.array_equal(got[c], meta[c]) for c in meta)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.binary(min_size=6, max_size=6).map(
    lambda b: bytes(x % 2 for x in b)), max_size=12).map(sorted), min_size=1, max_size=9))
def test_loser_tree_merges_with_common_prefixes(runs):
    def common(a, b):
        return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    coded = [(r, [0] + [common(a, b) for a, b in zip(r, r[1:])]) for r in runs]
    run, at, shares = suffix_dedup.merge_runs(coded)
    out = [runs[r][i] for r, i in zip(run, at)]
    assert out == sorted(x for r in runs for x in r)
    assert shares[1:] == [common(a, b) for a, b in zip(out, out[1:])]


def test_anchors_cover_every_string_and_agree():
    rng = np.random.default_rng(4)
    buf = rng.integers(97, 100, 3000).astype(np.uint8)
    off = np.array([0, 50, 50, 1200, 1250, 3000])
    place, first, last, text, _ = suffix_dedup.anchors(buf, off, 40, 10)
    named = {}
    for a, lo, hi, t in zip(place, first, last, text):
        for p in range(lo, hi + 1):
            assert off[t] <= p and p + 40 <= off[t + 1] and p <= a <= p + 30
            assert named.setdefault(bytes(buf[p:p + 40]), a - p) == a - p
    assert sum(hi - lo + 1 for lo, hi in zip(first, last)) == sum(
        max(0, b - a - 39) for a, b in zip(off, off[1:]))


def test_empty_tables(spark):
    none = odd.nothing(spark)
    assert chunk_dedup.exact_groups(none).count() == 0
    assert chunk_dedup.drop_copies(none).count() == 0
    assert jaccard_join.jaccard_components(none).count() == 0
    assert jaccard_join.keep_one(none).count() == 0
    assert suffix_dedup.drop_repeats(none).count() == 0
