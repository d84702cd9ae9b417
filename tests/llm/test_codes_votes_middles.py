"""Neighbour votes, pivot codes and fill-in-middle."""

import hashlib
import math
import os
import random
import re
import sys
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))

import odd_rows as odd  # noqa: E402
from conftest import SF001, SF01  # noqa: E402
from starfold.llm import chunk_middle, neighbour_vote, pivot_codes, ragged  # noqa: E402


# -- pivot codes ------------------------------------------------------------------------

def codes_by_brute_force(rows, parts=8, entries=16, rounds=6, scale=4096):
    kept = [(i, [math.floor(scale * float(x)) for x in v], lab) for i, v, lab in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return [], None
    width = len(kept[0][1]) // parts
    last = (1, 0)
    key = lambda r: ((0, r[0]) if r[0] is not None else last, r[1])
    seeds, seen = [], set()
    for r in sorted(kept, key=key):
        if r[0] not in seen and len(seeds) < entries:
            seen.add(r[0])
            seeds.append(r[1])
    cut = lambda v, p: v[p * width:(p + 1) * width]
    books = [[list(cut(v, p)) for v in seeds] for p in range(parts)]

    def near(v, p):
        d = [sum((a - b) ** 2 for a, b in zip(cut(v, p), c)) for c in books[p]]
        return d.index(min(d)), min(d)
    for _ in range(rounds):
        fresh = []
        for p in range(parts):
            got = [[] for _ in books[p]]
            for _, v, _ in kept:
                got[near(v, p)[0]].append(cut(v, p))
            fresh.append([[sum(c) // len(g) for c in zip(*g)] if g else books[p][e]
                          for e, g in enumerate(got)])
        books = fresh
    digest = hashlib.sha256(",".join(str(x) for p in books for e in p for x in e).encode())
    out, total = [], {}
    for i, v, lab in kept:
        each = [near(v, p) for p in range(parts)]
        err = sum(d for _, d in each)
        total[lab] = total.get(lab, 0) + err
        out.append((i, "".join(f"{c:02x}" for c, _ in each), err, lab))
    return sorted(((i, c, e, total[lab], digest.hexdigest()) for i, c, e, lab in out),
                  key=str), books


def vectors(spark, rows, folder):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    df = df.withColumns({c: F.lit(c) for c in ("_id", "_cells", "_near", "code", "part", "error")})
    df.repartition(3).write.mode("overwrite").parquet(f"{folder}/embeddings.parquet")
    return folder


def _f32(x):
    return float(np.float32(x))


@pytest.mark.parametrize("seed", [1, 2])
def test_codes_match_brute_force(spark, scratch, seed):
    rnd = random.Random(seed)
    rows = [(rnd.randrange(10 ** 6), [_f32(rnd.gauss(0, 0.2)) for _ in range(16)],
             rnd.choice([0, 1, 2, None])) for _ in range(300)]
    rows += [(5, [0.0] * 16, 1)] * 40 + [rows[3], rows[3]]            # ties and repeated rows
    rows += [(7, None, 1), (8, [None] + [0.0] * 15, 1), (9, [float("nan")] + [0.0] * 15, 0),
             (10, [float("-inf")] + [0.0] * 15, 0), (None, [_f32(0.3)] * 16, None), (11, [1.5] * 16, 3)]
    got = pivot_codes.op12_pivot_codes(spark, vectors(spark, rows, scratch))
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    want, _ = codes_by_brute_force(rows)
    assert sorted((tuple(r) for r in got.collect()), key=str) == want


def test_few_or_no_vectors(spark, scratch):
    rows = [(3, [0.5] * 8, 1), (1, [-0.5] * 8, None)]
    got = pivot_codes.op12_pivot_codes(spark, vectors(spark, rows, scratch))
    assert sorted((tuple(r) for r in got.collect()), key=str) == codes_by_brute_force(rows)[0]
    for rows in ([], [(1, None, 1)]):
        got = pivot_codes.op12_pivot_codes(spark, vectors(spark, rows, scratch))
        assert got.collect() == [] and len(got.columns) == 5


def test_bad_vectors_raise(spark, scratch):
    for rows, what in (([(1, [0.0] * 8, 1), (2, [0.0] * 16, 1)], "equal"),
                       ([(1, [0.0] * 9, 1)], "equal"), ([(1, [1e12] * 8, 1)], "fit")):
        with pytest.raises(ValueError, match=what):
            pivot_codes.op12_pivot_codes(spark, vectors(spark, rows, scratch))


def test_labels_beyond_the_broadcast_bound(spark, scratch, monkeypatch):
    monkeypatch.setattr(pivot_codes, "MAX_LABELS", 0)
    rows = [(i, [_f32(i / 9)] * 8, i % 3 if i % 4 else None) for i in range(30)]
    got = pivot_codes.op12_pivot_codes(spark, vectors(spark, rows, scratch))
    assert "BroadcastHashJoin" not in got._jdf.queryExecution().executedPlan().toString()
    assert sorted((tuple(r) for r in got.collect()), key=str) == codes_by_brute_force(rows)[0]


def test_pivots_prune_and_keep_ties_exact():
    rng = np.random.default_rng(3)
    centres = rng.integers(-3000, 3000, (16, 8))
    cells = centres[rng.integers(0, 16, 4000)] + rng.integers(-60, 60, (4000, 8))
    cells[:50] = (centres[0] + centres[1]) // 2
    entries = centres.copy()
    entries[9] = entries[2]                                           # equal entries
    pivots = centres[:4]
    code, best, made = pivot_codes.nearest(cells, pivot_codes.pivot_distances(cells, pivots),
                                           entries, pivots)
    all_ = ((cells[:, None] - entries[None]) ** 2).sum(axis=2)
    assert (code == all_.argmin(axis=1)).all() and (best == all_.min(axis=1)).all()
    assert made < 0.5 * all_.size


# -- fill-in-middle -----------------------------------------------------------------------

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def middle_by_brute_force(doc_id, text):
    text = text or ""
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    a, b, c, d = (int(h[8 * i:8 * i + 8], 16) for i in range(4))
    t = TOKEN.findall(text)
    n = len(t)
    i, j = sorted((a % (n + 1), b % (n + 1)))
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or c % 100 >= 50:
        return (doc_id, n, "plain", None, None, sha(text), sha(text))
    p, m, s = "".join(t[:i]), "".join(t[i:j]), "".join(t[j:])
    form = "spm" if d % 100 < 80 else "psm"
    out = f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"
    return (doc_id, n, form, len(p), len(m), sha(out), sha(text))


def middles(spark, folder):
    got = chunk_middle.op13_chunk_middle(spark, folder)
    assert got.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256",
                           "restored_sha256"]
    return sorted((tuple(r) for r in got.collect()), key=str)


def test_middles_of_odd_rows(spark, scratch):
    extra = [(1000 + i, x, "en", "s", 1) for i, x in enumerate(
        ["<P>", "a <S> b", "<M", "<<", "x <", "> y", "中文 テスト é ", "\t\na\n\n b\x0b\x0cc\r", "< P> <"]
        * 8)]
    docs = odd.documents(spark).unionByName(
        spark.createDataFrame(extra, odd.SCHEMA), allowMissingColumns=True)
    docs = docs.withColumns({c: F.lit(c) for c in ("_a", "_form", "_body", "form", "output", "n")})
    docs.write.parquet(f"{scratch}/documents.parquet")
    want = sorted((middle_by_brute_force(r.doc_id, r.text) for r in docs.collect()), key=str)
    assert middles(spark, scratch) == want
    assert {w[2] for w in want} == {"plain", "spm", "psm"}


def test_middles_of_a_table_and_of_none(spark, scratch):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    want = sorted((middle_by_brute_force(r.doc_id, r.text) for r in docs.collect()), key=str)
    assert middles(spark, SF001) == want
    odd.nothing(spark).write.parquet(f"{scratch}/documents.parquet")
    assert middles(spark, scratch) == []


@pytest.mark.parametrize("piece,memo", [(1 << 20, 1 << 25), (300, 2000)])
def test_chunks_meet_and_counts_add_up(monkeypatch, piece, memo):
    monkeypatch.setattr(ragged, "PIECE_BYTES", piece)
    rnd = random.Random(9)
    shared = " ".join(rnd.choice(["alpha", "be", "c\n", "dé", "  "]) for _ in range(900))
    texts = [t or "" for t in odd.texts()] + ["x " + shared, "yy\n" + shared, shared, " " * 20000,
                                              "z" * 20000, "ab " * 9000]
    buf, off = ragged.text_buffer(pa.array(texts))
    starts, first = chunk_middle.cut_chunks(buf, off)
    assert np.diff(np.append(starts, len(buf))).max() <= chunk_middle.MOST
    assert set(off[:-1][np.diff(off) > 0]) <= set(starts.tolist())
    held = chunk_middle.Memo(memo)
    low = np.array([rnd.randrange(1 << 32) for _ in texts])
    high = np.array([rnd.randrange(1 << 32) for _ in texts])
    got = chunk_middle.count_and_cut(buf, off, low, high, held)
    for d, text in enumerate(texts):
        t = TOKEN.findall(text)
        i, j = sorted((int(low[d]) % (len(t) + 1), int(high[d]) % (len(t) + 1)))
        a, b = "".join(t[:i]), "".join(t[:j])
        assert (got["n"][d], got["first"][d], got["second"][d], got["first_chars"][d],
                got["second_chars"][d]) == (len(t), len(a.encode()), len(b.encode()), len(a), len(b))
    assert held.hits > 0 and held.held <= max(memo, chunk_middle.MOST)


def test_shared_passages_give_equal_chunks():
    rnd = random.Random(4)
    shared = " ".join("".join(rnd.choice("abcdefgh") for _ in range(5)) for _ in range(2000))
    buf, off = ragged.text_buffer(pa.array(["head of one " + shared, "another, longer head " + shared]))
    starts, first = chunk_middle.cut_chunks(buf, off)
    ends = np.append(starts[1:], len(buf))
    spelled = [bytes(buf[s:e]) for s, e in zip(starts, ends)]
    one, two = set(spelled[:first[1]]), set(spelled[first[1]:])
    assert len(one & two) >= len(one) - 2 and len(one) > 10


# -- neighbour votes --------------------------------------------------------------------

def test_scores_hold_out_and_separate(spark):
    got = {r.doc_id: r for r in neighbour_vote.op11_neighbour_vote(spark, SF01).collect()}
    labels = spark.read.parquet(f"{SF01}/labels.parquet").collect()
    assert len(got) == spark.read.parquet(f"{SF01}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    held = [(got[x.doc_id].predicted, x.quality) for x in labels if got[x.doc_id].held_out]
    assert len(held) > 50 and sum(p == q for p, q in held) >= 0.95 * len(held)
    good = [p for p, q in held if q == 1]
    assert sum(good) >= 0.98 * len(good)


def test_held_out_labels_change_nothing(spark, scratch):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    docs.write.parquet(f"{scratch}/documents.parquet")
    turned = labels.withColumn("quality", F.when(
        neighbour_vote.fold_of("doc_id") == neighbour_vote.HELD_OUT, 1 - F.col("quality"))
        .otherwise(F.col("quality")))
    turned.write.parquet(f"{scratch}/labels.parquet")
    score = lambda d: sorted(tuple(r) for r in neighbour_vote.op11_neighbour_vote(spark, d).collect())
    assert score(SF001) == score(scratch)


def test_votes_match_brute_force(spark):
    docs = odd.documents(spark)
    model = neighbour_vote.fit_vote_model(docs, odd.labels(spark), k=3)
    got = {r.doc_id: r.score for r in neighbour_vote.vote(docs, model).collect()}
    texts = [t or "" for t in odd.texts()]
    buf, off = ragged.text_buffer(pa.array(texts))
    counts = neighbour_vote.term_counts(buf, off)
    # Pairs one by one.
    pair = [(t.encode()[i], t.encode()[i + 1]) for t in texts[24:30] for i in range(len(t.encode()) - 1)]
    assert counts[24:30, :neighbour_vote.PAIRS].sum() == len(pair)
    x = model.latent(counts)
    for d in range(len(texts)):
        near = sorted(((float(x[d] @ v), y) for v, y in zip(model.vectors, model.labels)),
                      key=lambda p: -p[0])
        last = near[2][0]
        vote = [(max(s, 0) ** 8, y) for s, y in near if s >= last - neighbour_vote.TIE]
        want = sum(v * y for v, y in vote) / sum(v for v, _ in vote)
        assert abs(got[3 * d] - want) < 1e-3, (d, texts[d][:40])


def test_long_texts_are_counted_in_blocks(monkeypatch):
    texts = ["ab cd " * 400, "", "x", "Éé!! 12\n" * 90]
    buf, off = ragged.text_buffer(pa.array(texts))
    want = neighbour_vote.term_counts(buf, off)
    monkeypatch.setattr(ragged, "PIECE_BYTES", 7)
    assert (neighbour_vote.term_counts(buf, off) == want).all()
    for d, t in enumerate(texts):
        own = neighbour_vote.term_counts(*ragged.text_buffer(pa.array([t])))
        assert (own[0] == want[d]).all()


def test_votes_of_odd_rows(spark):
    docs = odd.documents(spark)
    model = neighbour_vote.fit_vote_model(docs, odd.labels(spark), sample_rows=20)
    assert len(model.vectors) == 20
    rows = neighbour_vote.vote(docs, model).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    by_id = {r.doc_id: r.score for r in rows}
    by_text = {}
    for d in docs.filter("doc_id IS NOT NULL").collect():
        by_text.setdefault(d.text or "", []).append(by_id[d.doc_id])
    assert all(max(s) - min(s) < 1e-4 for s in by_text.values())
    none = neighbour_vote.fit_vote_model(docs, odd.labels(spark).limit(0))
    assert {r.score for r in neighbour_vote.vote(docs, none).collect()} == {0.5}
    empty = odd.nothing(spark)
    model = neighbour_vote.fit_vote_model(empty, odd.labels(spark))
    assert neighbour_vote.vote(empty, model).collect() == []
