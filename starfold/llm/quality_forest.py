"""Quality rules: an isolation forest on rule statistics (operator 10).

``rule_statistics`` counts, for every whole text, what the base rules and the
forest look at.  ``fit_forest`` grows isolation trees (random feature, random
cut, subsamples of ``psi`` rows) on the ratios of a bounded sample of the rows
labelled good.  Cuts are drawn beyond the range of the sample too, in every
statistic, so that what no label shows, or what never varies among good rows, is
isolated early.  The good rows are dealt in halves by a hash of their ids, each half
grows half of the trees, and for the calibration its rows are scored by the other
half's trees; every row labelled bad is scored by all trees.  Of the thresholds that
lose no more than ``max_good_loss`` of the good rows, the one is taken that separates
the classes best (the share of bad rows rejected less the share of good rows lost;
the lowest of equals).  A document is kept if it passes the base rules and its score
is not above the threshold.

Defined results: a null or empty text has no words and fails the base rule; fewer
than two good labels in either half mean no threshold, and base rules alone decide;
without bad labels no good row is lost in the calibration;
repeated rows are judged alike; labels repeated for a document count once, with
the lowest quality; null labels and null ids are no labels.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from . import ragged

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MORE = ["n_upper", "n_marks", "n_digits", "n_lines"]
STATS = BASE + MORE

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[ord("A"):ord("Z") + 1] = True
_MARK = np.zeros(256, dtype=bool)
_MARK[list(b"!?{}[]()=_~^;:/\\@+\"")] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[ord("0"):ord("9") + 1] = True


def _pairs(a: np.ndarray, b: np.ndarray, size: int) -> tuple[np.ndarray, int]:
    """Codes of the pairs (a, b), with b below ``size``."""
    u, code = np.unique(a * np.int64(size) + b, return_inverse=True)
    return code, len(u)


def count_rules(buf: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
    n = len(off) - 1
    s, e = ragged.words(buf, off)
    doc = ragged.doc_of(off, s)
    out = {"n_words": np.bincount(doc, minlength=n)}
    solid = ~ragged._WS[buf]
    out["word_chars"] = ragged.per_doc(solid & ((buf & 0xC0) != 0x80), off)
    for name, table in (("n_symbols", _SYMBOL), ("n_upper", _UPPER), ("n_marks", _MARK),
                        ("n_digits", _DIGIT)):
        out[name] = ragged.per_doc(table[buf], off)

    first, code = ragged.factorize(buf, s, e)

    covered = np.zeros(len(s) + 2, dtype=np.int64)
    if len(s) > 2:
        inside = doc[:-2] == doc[2:]
        two, n_two = _pairs(code[:-1], code[1:], len(first))
        three, _ = _pairs(two[:-1], code[2:], len(first))
        key, n_key = _pairs(three, doc[:-2], n)
        often = inside & (np.bincount(key[inside], minlength=n_key)[key] > 1)
        at = np.flatnonzero(often)
        for k in range(3):
            covered[at + k] = 1
    out["n_repeat_words"] = np.bincount(doc, weights=covered[:len(s)],
                                        minlength=n).astype(np.int64)

    ls, le = ragged.lines(buf, off)
    has = np.zeros(len(buf) + 1, dtype=np.int64)
    np.cumsum(solid, out=has[1:])
    some = has[le] > has[ls]
    ls, le = ls[some], le[some]
    ldoc = ragged.doc_of(off, ls)
    _, lcode = ragged.factorize(buf, ls, le)
    key, _ = _pairs(lcode, ldoc, n)
    _, at = np.unique(key, return_index=True)
    out["n_lines"] = np.bincount(ldoc, minlength=n)
    out["n_dup_lines"] = out["n_lines"] - np.bincount(ldoc[at], minlength=n)
    return {k: v.astype(np.int64) for k, v in out.items()}


def rule_statistics(docs: DataFrame, text_col: str = "text",
                    keep: list[str] | None = None, names: list[str] | None = None) -> DataFrame:
    """``keep`` columns of every row plus the statistics, under ``names``."""
    names = names or STATS

    def run(buf, off):
        got = count_rules(buf, off)
        return {n: got[s] for n, s in zip(names, STATS)}
    return ragged.map_text(docs, text_col, [T.StructField(n, T.LongType()) for n in names],
                           run, keep)


def base_failed(n_words, n_repeat_words):
    return (n_words < 50) | (100 * n_repeat_words > 50 * n_words)


def features(stat: dict[str, np.ndarray]) -> np.ndarray:
    """The ratios that the forest cuts."""
    w = np.maximum(stat["n_words"], 1).astype(np.float64)
    c = np.maximum(stat["word_chars"], 1).astype(np.float64)
    return np.stack([
        stat["n_symbols"] / w,
        stat["n_marks"] / w,
        stat["n_upper"] / c,
        stat["n_digits"] / c,
        stat["n_dup_lines"] / np.maximum(stat["n_lines"], 1),
        stat["n_repeat_words"] / w,
        c / w,
    ], axis=1)


# A ratio that hardly varies among the good rows is measured in this unit.
LEAST_SPREAD = 0.02
# How far beyond a part's rows a cut may fall, in spreads of the good rows.
MARGIN = 4.0


def spread(x: np.ndarray) -> np.ndarray:
    """The range of the middle 99 % of each ratio, ``LEAST_SPREAD`` at least."""
    lo, hi = np.quantile(x, [0.005, 0.995], axis=0)
    return np.maximum(hi - lo, LEAST_SPREAD)


def _mean_path(n: np.ndarray | float) -> np.ndarray:
    """Mean depth of a failed search in a binary search tree of n keys."""
    n = np.maximum(np.asarray(n, dtype=np.float64), 1)
    h = np.log(np.maximum(n - 1, 1)) + 0.5772156649015329
    return np.where(n > 2, 2 * h - 2 * (n - 1) / n, np.where(n > 1, 1.0, 0.0))


@dataclass
class Forest:
    """Complete binary trees: feature and cut of the inner nodes (a leaf above
    the bottom sends every row left), path length at the bottom."""

    feature: np.ndarray
    cut: np.ndarray
    path: np.ndarray
    depth: int
    norm: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """2 ** (-mean path / expected path): near 1 for anomalies."""
        rows, total = np.arange(len(x)), np.zeros(len(x))
        for f, c, p in zip(self.feature, self.cut, self.path):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, f[node]] >= c[node])
            total += p[node - (2 ** self.depth - 1)]
        return np.exp2(-total / len(self.path) / max(self.norm, 1e-9))


def joined(a: Forest, b: Forest) -> Forest:
    """The trees of both, of equal depth, each in units of its own expected path."""
    return Forest(np.concatenate([a.feature, b.feature]), np.concatenate([a.cut, b.cut]),
                  np.concatenate([a.path / a.norm, b.path / b.norm]), a.depth, 1.0)


def fit_forest(x: np.ndarray, trees: int = 100, psi: int = 256, depth: int = 10,
               seed: int = 10, margin: float = 0.0) -> Forest:
    """With a ``margin``, cuts are drawn from the range of a part's rows widened
    by it on both sides, and so in columns too where these rows are equal."""
    rng = np.random.default_rng(seed)
    inner = 2 ** depth - 1
    feature = np.zeros((trees, inner), dtype=np.int64)
    cut = np.full((trees, inner), np.inf)
    path = np.zeros((trees, inner + 1))
    take = min(psi, len(x))
    for t in range(trees):
        todo = [(0, 0, x[rng.choice(len(x), take, replace=False)])]
        while todo:
            node, d, part = todo.pop()
            low, high = part.min(axis=0, initial=np.inf), part.max(axis=0, initial=-np.inf)
            wide = np.flatnonzero(high + margin > low - margin) if len(part) > 1 else []
            if d == depth or not len(wide):
                at = node
                for _ in range(depth - d):
                    at = 2 * at + 1
                path[t, at - inner] = d + _mean_path(len(part))
                continue
            f = rng.choice(wide)
            lo, hi = low[f] - margin, high[f] + margin
            c = rng.uniform(lo, hi)
            c = c if c > lo else hi
            feature[t, node], cut[t, node] = f, c
            right = part[:, f] >= c
            todo += [(2 * node + 1, d + 1, part[~right]), (2 * node + 2, d + 1, part[right])]
    return Forest(feature, cut, path, depth, float(_mean_path(take)))


SCORE_BINS = 2000


@dataclass
class QualityModel:
    """A forest over ratios divided by ``unit``, and the highest score that is
    kept; without a forest the method rejects nothing."""

    forest: Forest | None
    threshold: float = 1.0
    unit: np.ndarray | float = 1.0

    def verdict(self, stat: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        n = len(stat["n_words"])
        if self.forest is None:
            return np.zeros(n), np.ones(n, dtype=bool)
        score = self.forest.score(features(stat) / self.unit)
        return score, np.floor(score * SCORE_BINS) <= self.threshold


def _scored(stats: DataFrame, model: QualityModel, names: list[str]) -> DataFrame:
    """Rows of ``stats`` plus score and kept."""
    schema = T.StructType(list(stats.schema.fields) + [
        T.StructField("score", T.DoubleType()), T.StructField("kept", T.BooleanType())])

    def run(batches):
        for b in batches:
            got = {s: b.column(b.schema.get_field_index(n)).to_numpy(zero_copy_only=False)
                   for s, n in zip(STATS, names)}
            score, good = model.verdict(got)
            good &= ~base_failed(got["n_words"], got["n_repeat_words"])
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(score, pa.float64()), pa.array(good, pa.bool_())],
                [*b.schema.names, "score", "kept"])
    return ragged.map_batches(stats, run, schema)


def separating_bin(good: np.ndarray, bad: np.ndarray, max_good_loss: float) -> int:
    """The highest bin to keep, from counts of both classes per bin."""
    lost = (good.sum() - np.cumsum(good)) / good.sum()
    rejected = (bad.sum() - np.cumsum(bad)) / max(bad.sum(), 1)
    return int(np.argmax(np.where(lost <= max_good_loss, rejected - lost, -np.inf)))


def fit_quality_model(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                      quality_col: str = "quality", sample_rows: int = 25_600,
                      max_good_loss: float = 0.005, trees: int = 100,
                      psi: int = 256) -> QualityModel:
    """Fit on at most ``sample_rows`` rows labelled good (the lowest hashes of
    their ids), calibrate on all labelled rows.  Both take only rows that pass the
    base rules."""
    lab = (labels.filter(F.col(id_col).isNotNull() & F.col(quality_col).isNotNull())
           .groupBy(F.col(id_col).alias("_lab_id")).agg(F.min(quality_col).alias("_lab_q")))
    known = (stats.join(lab, stats[id_col] == lab["_lab_id"])
             .filter(~base_failed(F.col("n_words"), F.col("n_repeat_words")))
             .withColumn("_half", F.pmod(F.xxhash64("_lab_id", F.lit("half")), F.lit(2)))
             .select("_lab_id", "_lab_q", "_half", *STATS))
    known = materialize(known, "quality-labelled")
    sample = (known.filter("_lab_q = 1").orderBy(F.xxhash64("_lab_id"), "_lab_id", *STATS)
              .limit(sample_rows).select("_half", *STATS).toArrow())
    half = sample.column("_half").to_numpy()
    if min((half == 0).sum(), (half == 1).sum()) < 2:
        return QualityModel(None)
    x = features({c: sample.column(c).to_numpy() for c in STATS})
    unit = spread(x)
    grown = [fit_forest(x[half == k] / unit, (trees + 1 - k) // 2, psi, seed=10 + k, margin=MARGIN)
             for k in (0, 1)]
    model = QualityModel(joined(*grown), float(SCORE_BINS), unit)
    # A histogram of the scores of all labelled rows: SCORE_BINS rows per class.
    parts = [_scored(known.filter((F.col("_lab_q") == 1) & (F.col("_half") == 1 - k)),
                     QualityModel(grown[k], float(SCORE_BINS), unit), STATS) for k in (0, 1)]
    parts.append(_scored(known.filter("_lab_q <> 1"), model, STATS))
    hist = (parts[0].unionByName(parts[1]).unionByName(parts[2])
            .groupBy("_lab_q", F.floor(F.col("score") * SCORE_BINS).alias("bin")).count().collect())
    good, bad = np.zeros(SCORE_BINS + 1), np.zeros(SCORE_BINS + 1)
    for q, b, n in hist:
        (good if q == 1 else bad)[b] += n
    model.threshold = float(separating_bin(good, bad, max_good_loss))
    return model


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          **fit) -> DataFrame:
    """One row per row of ``docs``: id, statistics, ``base_failed``, ``score``
    and ``kept``."""
    stats = materialize(rule_statistics(docs.select(F.col(id_col), F.col(text_col)), text_col,
                                        keep=[id_col]), "quality-stats")
    model = fit_quality_model(stats, labels, id_col, **fit)
    return _scored(stats, model, STATS).withColumn(
        "base_failed", base_failed(F.col("n_words"), F.col("n_repeat_words")))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
              text_col: str = "text", **fit) -> DataFrame:
    """The rows of ``docs`` that are kept, with their own columns.  Texts are
    read twice and never shuffled: once for the model, once for the verdict."""
    narrow = docs.select(F.col(id_col), F.col(text_col))
    stats = materialize(rule_statistics(narrow, text_col, keep=[id_col]), "quality-stats")
    model = fit_quality_model(stats, labels, id_col, **fit)
    flag = "_kept"
    while flag in docs.columns:
        flag += "_"

    def run(buf, off):
        got = count_rules(buf, off)
        _, good = model.verdict(got)
        return {flag: good & ~base_failed(got["n_words"], got["n_repeat_words"])}
    out = ragged.map_text(docs, text_col, [T.StructField(flag, T.BooleanType())], run)
    return out.filter(F.col(flag)).select(*docs.columns)


def op10_quality_forest(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return judge(docs, labels).select("doc_id", *BASE, "base_failed", "kept", "score")
