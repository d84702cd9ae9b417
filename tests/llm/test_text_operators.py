"""Token counts, LM scoring and quality rules."""

import os
import random
import sys
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))

import odd_rows as odd  # noqa: E402
from conftest import SF01  # noqa: E402
from starfold.llm import pseudo_likelihood, quality_forest, ragged, token_counts  # noqa: E402


# -- ragged arrays ----------------------------------------------------------------------

def test_words_lines_and_factorize_match_python():
    texts = [t or "" for t in odd.texts()] + ["\n\na\n", "b\n", "\n", "a\x85b\x1cc"]
    buf, off = ragged.text_buffer(pa.array(texts))
    s, e = ragged.words(buf, off)
    raw = buf.tobytes()
    assert [raw[a:b].decode() for a, b in zip(s, e)] == [w for t in texts
                                                         for w in odd.WORD.findall(t)]
    first, code = ragged.factorize(buf, s, e)
    spelled = [raw[a:b] for a, b in zip(s, e)]
    assert [spelled[i] for i in first[code]] == spelled and len(first) == len(set(spelled))
    ls, le = ragged.lines(buf, off)
    assert ([raw[a:b] for a, b in zip(ls, le) if a < b]
            == [x for t in texts for x in t.encode().split(b"\n") if x])


def test_factorize_survives_hash_collisions(monkeypatch):
    buf, off = ragged.text_buffer(pa.array(["ab cd ab ef cd"]))
    s, e = ragged.words(buf, off)
    monkeypatch.setattr(ragged, "span_hash", lambda b, x, y: np.zeros(len(x), np.uint64))
    _, code = ragged.factorize(buf, s, e)
    assert code.tolist() == [0, 1, 0, 2, 1]


# -- token counts -----------------------------------------------------------------

@pytest.fixture(scope="module")
def byte_bpe():
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts.load_tables(path), Tokenizer.from_file(path)


def count_all(texts, tables):
    buf, off = ragged.text_buffer(pa.array(texts, pa.string()))
    return token_counts.count_tokens(buf, off, tables).tolist()


def test_counts_match_the_library(byte_bpe):
    tables, library = byte_bpe
    rnd = random.Random(5)
    marks = list("abstremvld'  \n\t'<|>12éñ中😀  -!.") + ["<|endoftext|>", "'re", "'ll", "'s"]
    texts = ["", "don't I'll ''s x's't 're", "  a  b\n\n c \t d  ", "aaaaaaaaaaaaaaaa", "\n's", "'l"]
    texts += ["".join(rnd.choice(marks) for _ in range(rnd.randint(0, 40))) for _ in range(4000)]
    texts += ["".join(chr(rnd.choice([rnd.randint(1, 0x2ff), rnd.randint(0xe000, 0x10ffff)]))
                      for _ in range(rnd.randint(0, 20))) for _ in range(2000)]
    want = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert count_all(texts, tables) == want


def test_long_texts_are_cut_where_tokens_start(byte_bpe, monkeypatch):
    tables, library = byte_bpe
    monkeypatch.setattr(token_counts, "BLOCK_BYTES", 64)
    text = " ".join(t for t in odd.texts() if t)
    assert count_all([text], tables) == [len(library.encode(text, add_special_tokens=False).ids)]


def test_token_counts_of_odd_rows(spark, byte_bpe):
    tables, library = byte_bpe
    docs = odd.documents(spark)
    got = token_counts.token_counts(docs, tables)
    assert got.columns == [c for c in docs.columns if c != "n_tokens"] + ["n_bytes", "n_tokens"]
    rows = got.collect()
    assert len(rows) == docs.count()
    for r in rows:
        text = r.text or ""
        assert (r.n_bytes, r.n_tokens) == (len(text.encode()), len(
            library.encode(text, add_special_tokens=False).ids))
    assert token_counts.token_counts(odd.nothing(spark), tables).count() == 0


def test_other_tokenizer_files_are_refused():
    with pytest.raises(ValueError):
        token_counts.load_tables(public_tokenizers.path("word_bpe_49k.json"))


# -- LM scoring --------------------------------------------------------------------

def test_held_out_documents_score_above_shuffled_ones(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text")
    scorer = pseudo_likelihood.fit(docs.filter("doc_id % 10 <> 0"))
    held = docs.filter("doc_id % 10 = 0")
    mixed = held.select("doc_id", F.concat_ws(" ", F.shuffle(F.split("text", " +"), F.lit(7)))
                        .alias("text"))

    def mean(df, s):
        return pseudo_likelihood.score(df, s, keep=["doc_id"]).agg(
            F.sum("log_likelihood") / F.sum("n_tokens")).first()[0]
    plain = pseudo_likelihood.Scorer(
        pseudo_likelihood.Net.fresh(scorer.words.first, 16, 2, 0), scorer.words, scorer.reach,
        scorer.counts)
    plain.net.group[:] = 0
    plain.net.member[:] = 0
    assert mean(held, scorer) > mean(held, plain)
    assert mean(held, scorer) > mean(mixed, scorer)


def test_scores_of_odd_rows(spark):
    docs = odd.documents(spark)
    taken = docs.withColumns({c: F.lit(c) for c in ("_net", "_known", "_far", "_times", "_met_row", "word",
                                                    "log_likelihood", "mean_log_likelihood")})
    scorer = pseudo_likelihood.fit(taken, own_words=50, near_words=80, width=4, fan_in=2)
    out = pseudo_likelihood.score(taken, scorer)
    assert set(out.columns) == set(taken.columns) and len(out.columns) == len(taken.columns)
    rows = out.collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r["_net"] == "_net" and r["row"] == "row"
        assert r.n_tokens == len(odd.WORD.findall(r.text or ""))
        assert np.isfinite(r.log_likelihood) and (r.n_tokens > 0) == (
            r.mean_log_likelihood is not None)
        assert r.n_tokens > 0 or r.log_likelihood == 0
    again = pseudo_likelihood.score(taken, scorer).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    same = {}
    for r in rows:
        same.setdefault(r.text, set()).add(round(r.log_likelihood, 6))
    assert all(len(x) == 1 for x in same.values())
    none = odd.nothing(spark)
    empty = pseudo_likelihood.fit(none)
    assert pseudo_likelihood.score(none, empty).count() == 0
    assert pseudo_likelihood.score(docs, empty).filter("log_likelihood IS NULL").count() == 0


def spelled_model(scorer):
    """log p(word | words around) from the weights, one word at a time."""
    net, words = scorer.net, scorer.words
    n_of = {np.uint64(r.word & (1 << 64) - 1): r.n for r in scorer.counts.collect()}
    outcome_of = dict(zip(words.hashes.tolist(), words.outcome.tolist()))
    total = Counter()

    def ids(text):
        buf, off = ragged.text_buffer(pa.array([text]))
        h, shape, _ = pseudo_likelihood.tokens(buf, off)
        return [(x, outcome_of.get(x, words.own + s)) for x, s in zip(h.tolist(), shape.tolist())]
    own = {h for h, o in outcome_of.items() if o < words.own}

    def learn(spellings):
        for w in spellings:
            (h, o), = ids(w)
            if h not in own:
                total[o] += n_of[np.uint64(h)]

    def log_p(word, around):
        k = np.zeros(net.place.shape[1])
        for j, a in enumerate(around):
            at = len(words.first) if a is None else ids(a)[0][1]
            k = k + net.context[at].astype(float) * net.place[j]
        k = np.tanh(k)
        (h, o), = ids(word)
        size = net.member.shape[1]
        first = net.group @ k + net.group_bias
        second = net.member[o // size] @ k + net.member_bias[o // size].astype(float)
        p = (np.exp(first[o // size]) / np.exp(first).sum()
             * np.exp(second[o % size]) / np.exp(second).sum())
        if h not in own:
            p *= n_of.get(np.uint64(h), 1) / (total[o] + 1)
        return np.log(p)
    return learn, log_p


def test_scores_match_brute_force_and_probabilities_sum_to_one(spark):
    docs = odd.documents(spark).filter("length(text) < 3000").select("doc_id", "text")
    texts = [r.text for r in docs.collect()]
    vocab = sorted({w for t in texts for w in odd.WORD.findall(t)})
    scorer = pseudo_likelihood.fit(docs, own_words=20, near_words=60, width=4)
    assert scorer.words.own == 20 and len(vocab) > len(scorer.words.hashes)
    assert scorer.counts.count() == len(vocab)
    learn, log_p = spelled_model(scorer)
    learn(vocab)

    def total(text):
        w = odd.WORD.findall(text)
        at = [None, None, *w, None, None]
        return sum(log_p(x, [at[k], at[k + 1], at[k + 3], at[k + 4]]) for k, x in enumerate(w))
    more = ["never seen wörds 123 here", vocab[0], f"{vocab[5]} unseen {vocab[5]}"]
    asked = spark.createDataFrame([(k, t) for k, t in enumerate(texts[:25] + more)],
                                  "doc_id long, text string")
    for r in pseudo_likelihood.score(asked, scorer).collect():
        assert r.log_likelihood == pytest.approx(total(r.text), rel=1e-4, abs=1e-3)
    # All words of the corpus, and a word it lacks for each shape.
    some = list(odd.WORD.findall(texts[0]))[:4]
    shapes = ["a" * n for n in range(1, 17)] + ["é" * (n // 2) + "a" * (n % 2)
                                                for n in range(2, 17)] + [
        "-" * n for n in range(1, 17)] + ["7" * n for n in range(1, 17)]
    lacking = 0.0
    for w in shapes:
        spare = w[:-1] + {"a": "q", "-": "=", "7": "9", "é": "ü"}[w[-1]]
        lacking += np.exp(log_p(spare, some))
    known = sum(np.exp(log_p(w, some)) for w in vocab)
    assert lacking < 0.5 and known + lacking == pytest.approx(1, abs=1e-3)


def test_which_words_travel_changes_no_score(spark):
    docs = odd.documents(spark).select("doc_id", "text")
    got = []
    for near in (20, 100, 1 << 17):
        scorer = pseudo_likelihood.fit(docs, own_words=20, near_words=near, width=4)
        got.append(sorted((str(r.doc_id), r.n_tokens, round(r.log_likelihood, 3))
                          for r in pseudo_likelihood.score(docs, scorer).collect()))
    assert got[0] == got[1] == got[2]


# -- quality rules ---------------------------------------------------------------------

def brute_rules(text):
    w = odd.WORD.findall(text or "")
    triples = list(zip(w, w[1:], w[2:]))
    often = Counter(triples)
    covered = {k + d for k, t in enumerate(triples) if often[t] > 1 for d in range(3)}
    lines = [x for x in (text or "").split("\n") if odd.WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""),
            len(lines) - len(set(lines)), len(covered))


def test_rule_statistics_match_brute_force(spark):
    docs = odd.documents(spark)
    rows = quality_forest.judge(docs, odd.labels(spark)).collect()
    text = {(r.doc_id,): r.text for r in docs.collect() if r.doc_id is not None}
    assert len(rows) == docs.count()
    for r in rows:
        if r.doc_id is not None:
            want = brute_rules(text[(r.doc_id,)])
            assert tuple(r[c] for c in quality_forest.BASE) == want
            assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
            assert not (r.base_failed and r.kept)


def test_forest_isolates_what_differs():
    rng = np.random.default_rng(0)
    x = np.concatenate([np.zeros((950, 3)), rng.uniform(1, 5, (50, 3))])
    score = quality_forest.fit_forest(x).score(x)
    assert score[:950].max() < score[950:].min()


def test_trees_give_the_depth_of_an_isolated_row():
    x = np.array([[0.0], [10.0]])
    f = quality_forest.fit_forest(x, trees=5, psi=2)
    assert (f.path[:, 0] > 0).all() and np.allclose(f.score(x), 2 ** -1.0)


def test_bad_documents_go_and_good_ones_stay(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    got = quality_forest.judge(docs, labels).join(labels, "doc_id")
    n = {(r.quality, r.kept): r["count"] for r in got.groupBy("quality", "kept").count().collect()}
    assert n.get((0, True), 0) <= 0.05 * (n.get((0, True), 0) + n[(0, False)])
    good = got.filter("quality = 1 AND NOT base_failed")
    assert good.filter("kept").count() >= 0.99 * good.count()


def test_junk_of_a_kind_absent_from_the_labels_goes(spark):
    """Rows are judged by the labels' good rows, not by limits set by hand."""
    rnd = random.Random(3)
    words = [w for r in spark.read.parquet(f"{SF01}/documents.parquet").join(
        spark.read.parquet(f"{SF01}/labels.parquet").filter("quality = 1"), "doc_id")
        .select("text").orderBy("doc_id").limit(20).collect() for w in odd.WORD.findall(r.text)]

    def some(change, n=200):
        return " ".join(change(w) for w in rnd.sample(words, n))
    junk = {
        "upper case": some(str.upper),
        # Inside each of two limits (0.2 and 0.3), but no good row has either.
        "digits and upper case": some(lambda w: "".join(
            rnd.choices([c.lower(), c.upper(), "7"], [0.53, 0.29, 0.18])[0] for c in w)),
        "marks": some(lambda w: w + "!?"),
        "long words": some(lambda w: w * 3),
        "repeated line": "\n".join([some(str, 60)] + [some(str, 6)] * 9),
    }
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text")
    more = spark.createDataFrame([(-1 - k, t) for k, t in enumerate(junk.values())], docs.schema)
    rows = quality_forest.judge(docs.unionByName(more), spark.read.parquet(
        f"{SF01}/labels.parquet")).filter("doc_id < 0").collect()
    kept = {list(junk)[-1 - r.doc_id] for r in rows if r.kept or r.base_failed}
    assert len(rows) == len(junk) and not kept


def test_threshold_separates_both_classes():
    good, bad = np.zeros(10), np.zeros(10)
    good[[1, 2, 3, 6]] = [50, 100, 49, 1]
    at = quality_forest.separating_bin
    assert at(good, bad, 0.005) == 6                       # nothing is known to be bad
    bad[[5, 8]] = [30, 10]
    assert at(good, bad, 0.005) == 3                       # one good row for thirty bad ones
    assert at(good, bad, 0.0) == 6                         # but not beyond the bound
    bad[5], bad[8] = 0, 40
    assert at(good, bad, 0.005) == 6


def test_bad_labels_move_the_threshold(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    stats = quality_forest.rule_statistics(docs.select("doc_id", "text"), "text", keep=["doc_id"])
    got = [quality_forest.fit_quality_model(stats, some, max_good_loss=0.2)
           for some in (labels, labels.filter("quality = 1"),
                        labels.withColumn("quality", F.when(F.col("doc_id") % 7 == 0, 0)
                                          .otherwise(F.col("quality"))))]
    assert got[2].threshold != got[0].threshold or got[1].threshold != got[0].threshold
    scored = quality_forest._scored(stats.join(labels, "doc_id").select(stats["*"], "quality"),
                                    got[0], quality_forest.STATS)
    good = scored.filter("quality = 1").filter(~quality_forest.base_failed(
        F.col("n_words"), F.col("n_repeat_words")))
    assert good.filter("NOT kept").count() <= 0.2 * good.count()


def test_keep_good_agrees_with_judge(spark):
    docs, lab = odd.documents(spark), odd.labels(spark)
    out = quality_forest.keep_good(docs, lab)
    assert out.columns == docs.columns
    kept = [r.doc_id for r in quality_forest.judge(docs, lab).filter("kept").collect()]
    assert sorted(map(str, kept)) == sorted(str(r.doc_id) for r in out.collect())


def test_quality_without_labels_or_documents(spark):
    docs = odd.documents(spark)
    no_labels = odd.labels(spark).limit(0)
    rows = quality_forest.judge(docs, no_labels).collect()
    assert all(r.kept != r.base_failed for r in rows)
    none = odd.nothing(spark)
    assert quality_forest.judge(none, odd.labels(spark)).count() == 0
    assert quality_forest.keep_good(none, no_labels).count() == 0
