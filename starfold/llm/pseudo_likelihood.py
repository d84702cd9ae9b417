"""LM scoring by masked pseudo-likelihood (operator 6).

A small network predicts every token from the ``reach`` tokens on both sides:
the neighbours' vectors, scaled per place, are summed and squashed, and this
hidden vector gives an exact probability for every word of the corpus, in levels:

    p(word | neighbours) = p(group | hidden) * p(outcome | group, hidden) * share

The ``own_words`` most frequent words are outcomes of their own (share 1).  All
other words belong to one of ``SHAPES`` outcomes, named by their length and by
the kind of their bytes, and a word's share of its outcome is its exact count in
the whole corpus over the outcome's.  A word that the corpus lacks counts once:
each outcome of a shape keeps one place for it.  Both softmaxes are summed in
full, so p sums to 1 over the corpus's words and these places.  A document's
score is the sum over its tokens of log p.

What is gathered grows with the input: every word of the corpus (by a 64-bit hash)
is counted in a table that stays in Spark.  The words above a count that leaves
at most ``near_words`` of them travel to the tasks; the tokens of all others are
joined with the table.  Which words travel changes no score.

Training covers every document once.  In each round every task starts from the
common weights, trains on its own documents of that round with step sizes per
row, and sends its weights; they are averaged, weighed by tokens, in a tree of
``fan_in``.  The weights begin at the unigram distribution.

Defined results: a null or empty text has 0 tokens, log-likelihood 0 and no
mean; a single word is predicted from the edge alone; repeated rows train and
score like others; very long texts are scored whole, a piece of work being one
text at least; without any token the weights stay as they began; columns of the
input named like computed ones give way to them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from . import ragged

LENGTHS = 16
SHAPES = 4 * LENGTHS            # kinds of words by lengths
ABSENT = np.float32(-1e4)       # the bias of a place without an outcome: p = 0
FIXED = 1 << 20                 # logs of counts are added as whole multiples of 1 / FIXED

# What a byte says of its word: 1 beyond ASCII, 2 a mark, 4 a digit; the highest decides.
_SAYS = np.zeros(256, dtype=np.uint8)
_SAYS[0x80:] = 1
_SAYS[[c for c in range(0x21, 0x7F) if not chr(c).isalnum()]] = 2
_SAYS[ord("0"):ord("9") + 1] = 4
_KIND = np.array([0, 1, 2, 2, 3, 3, 3, 3])


def tokens(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, shape, text) of every word.  A shape is the word's kind (letters
    only; beyond ASCII; with marks; with digits) and its length in bytes, cut
    at ``LENGTHS``."""
    s, e = ragged.words(buf, off)
    length = np.minimum(e - s, LENGTHS) - 1
    # From one word's start to the next's there are but its bytes and white space.
    kind = _KIND[np.bitwise_or.reduceat(_SAYS[buf], s)] if len(s) else np.zeros(0, np.int64)
    return ragged.span_hash(buf, s, e), kind * LENGTHS + length, ragged.doc_of(off, s)


@dataclass
class Vocabulary:
    """The words that travel, by ascending hash: outcome and log of their count
    (0 for outcomes of their own).  Outcomes: own words by falling count, then
    shapes; ``log_total`` is the log of a shape's count with its absent word."""

    hashes: np.ndarray
    outcome: np.ndarray
    log_count: np.ndarray
    own: int
    log_total: np.ndarray
    first: np.ndarray                   # tokens per outcome

    def __post_init__(self):
        """The leading bits of a hash name a stretch of a few entries."""
        self.bits = np.uint64(64 - max(1, len(self.hashes).bit_length()))
        leads = np.arange((1 << int(64 - int(self.bits))) + 1)
        self.starts = np.searchsorted(self.hashes >> self.bits, leads)
        self.steps = int(np.diff(self.starts).max(initial=1)) - 1

    def _place(self, h: np.ndarray) -> np.ndarray:
        """Where the hashes stand, if known: all tokens walk their stretch together."""
        last = len(self.hashes) - 1
        at = np.minimum(self.starts[(h >> self.bits).astype(np.int64)], last)
        todo = np.arange(len(h))
        for _ in range(self.steps):
            todo = todo[self.hashes[at[todo]] < h[todo]]
            if not len(todo):
                break
            at[todo] = np.minimum(at[todo] + 1, last)
        return at

    def find(self, h: np.ndarray, shape: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(outcome, log count, known) of each token."""
        if not len(self.hashes):
            return self.own + shape, np.zeros(len(h)), np.zeros(len(h), dtype=bool)
        at = self._place(h)
        known = self.hashes[at] == h
        return (np.where(known, self.outcome[at], self.own + shape),
                np.where(known, self.log_count[at], 0.0), known)

    def shares(self, outcome: np.ndarray) -> np.ndarray:
        """The log of what a word's count is divided by: 0 for own words."""
        out = np.zeros(len(outcome))
        rare = outcome >= self.own
        out[rare] = self.log_total[outcome[rare] - self.own]
        return out


def fixed_log(n: Column) -> Column:
    return F.round(F.log(n.cast("double")) * F.lit(float(FIXED))).cast("long")


def count_words(docs: DataFrame, text_col: str) -> DataFrame:
    """Every word of the corpus once: word (hash), shape, n.  Counted per batch,
    combined before the shuffle, stored; nothing of it is cut off."""
    def run(batches):
        for b in batches:
            buf, off = ragged.text_buffer(b.column(0))
            for i, j in ragged.pieces(off, 4 * ragged.PIECE_BYTES):
                h, shape, _ = tokens(buf[off[i]:off[j]], off[i:j + 1] - off[i])
                word, at, n = np.unique(h, return_index=True, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(word.view(np.int64)), pa.array(shape[at].astype(np.int32)),
                     pa.array(n.astype(np.int64))], ["word", "shape", "n"])
    counted = ragged.map_batches(docs.select(docs[text_col].alias("text")), run,
                                 "word long, shape int, n long")
    return materialize(counted.groupBy("word").agg(F.min("shape").alias("shape"),
                                                   F.sum("n").alias("n")), "words")


def vocabulary(counts: DataFrame, own_words: int, near_words: int) -> Vocabulary:
    """The driver sees a histogram of the counts' eighth powers of two, at most
    ``near_words`` words and one number per shape."""
    level = F.floor(F.log2(F.col("n").cast("double")) * 8)
    bins = sorted(counts.groupBy(level.alias("level")).count().collect(), reverse=True)
    least, total = None, 0
    for b, n in bins:
        total += n
        if total > near_words:
            break
        least = b
    near = (counts.filter(level >= least) if least is not None else counts.limit(0)).toArrow()
    h = near.column("word").to_numpy().view(np.uint64)
    shape, n = near.column("shape").to_numpy(), near.column("n").to_numpy()
    by_count = np.lexsort((h, -n))
    own = by_count[:own_words]
    outcome = len(own) + shape.astype(np.int64)
    outcome[own] = np.arange(len(own))
    log_count = np.round(np.log(n.astype(np.float64)) * FIXED)
    log_count[own] = 0
    rare = np.zeros(SHAPES)
    for s, c in counts.groupBy("shape").agg(F.sum("n")).collect():
        rare[s] = c
    np.subtract.at(rare, shape[own], n[own])
    order = np.argsort(h)
    return Vocabulary(h[order], outcome[order], log_count[order], len(own),
                      np.log(rare + 1), np.concatenate([n[own], rare + 1]))


@dataclass
class Net:
    """Context vectors (the last is the edge of a text), place scales, and the
    two levels of output vectors and biases: groups of ``size`` outcomes."""

    context: np.ndarray
    place: np.ndarray
    group: np.ndarray
    group_bias: np.ndarray
    member: np.ndarray                  # groups x size x width
    member_bias: np.ndarray             # groups x size

    @classmethod
    def fresh(cls, first: np.ndarray, width: int, reach: int, seed: int) -> Net:
        """Weights that give every outcome its share of ``first``."""
        rng, n = np.random.default_rng(seed), len(first)
        size = int(np.ceil(np.sqrt(n)))
        groups = -(-n // size)
        share = np.zeros(groups * size)
        share[:n] = first / first.sum()
        share = share.reshape(groups, size)
        bias = np.where(share > 0, np.log(np.maximum(share, 1e-300)), ABSENT)
        return cls(rng.normal(0, 0.3, (n + 1, width)).astype(np.float32),
                   np.ones((2 * reach, width), np.float32),
                   rng.normal(0, 0.01, (groups, width)).astype(np.float32),
                   np.log(share.sum(axis=1)).astype(np.float32),
                   rng.normal(0, 0.01, (groups, size, width)).astype(np.float32),
                   bias.astype(np.float32))

    def parts(self) -> list[np.ndarray]:
        return [self.context, self.place, self.group, self.group_bias, self.member,
                self.member_bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in self.parts()])

    def filled(self, flat: np.ndarray) -> Net:
        out, at = [], 0
        for x in self.parts():
            out.append(flat[at:at + x.size].reshape(x.shape).astype(np.float32))
            at += x.size
        return Net(*out)

    def hidden(self, around: np.ndarray) -> np.ndarray:
        """What the words around say: the context vectors are scaled once per
        place, as there are fewer of them than tokens."""
        h = (self.context * self.place[0])[around[:, 0]]
        for j in range(1, around.shape[1]):
            h += (self.context * self.place[j])[around[:, j]]
        return np.tanh(h, out=h)


def with_bias(weights: np.ndarray, bias: np.ndarray) -> tuple[np.ndarray, bool]:
    """Weights with the bias as a last column, and whether their logits can leave
    what exp can take: as every entry of h lies in -1 .. 1, a logit is no further
    from its bias than its weights' absolute sum."""
    far = np.abs(weights).sum(axis=-1).max() + abs(bias.max()) > 60
    return np.concatenate([weights, bias[..., None]], axis=-1), bool(far)


def with_one(h: np.ndarray) -> np.ndarray:
    """A column per token, with a last row of ones that meets the bias."""
    out = np.ones((h.shape[1] + 1, len(h)), h.dtype)
    out[:-1] = h.T
    return out


def softmax(weights: np.ndarray, far: bool, h: np.ndarray, target: np.ndarray
            ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(the target's logit, exponentials of all, their sums), a column per token."""
    x = weights @ h
    if far:
        x -= x.max(axis=0)
    own = x[target, np.arange(len(target))]
    up = np.exp(x, out=x)
    return own, up, up.sum(axis=0)


def short(ids: np.ndarray, n: int) -> np.ndarray:
    """``ids`` below ``n`` in the narrowest type: two bytes are sorted by radix."""
    return ids.astype(np.int16 if n < 1 << 15 else np.int64)


def runs(sorted_values: np.ndarray) -> list[tuple[int, int, int]]:
    """(value, start, end) of the runs of equal values."""
    at = np.flatnonzero(np.append(True, sorted_values[1:] != sorted_values[:-1]))
    ends = np.append(at[1:], len(sorted_values))
    return list(zip(sorted_values[at].tolist(), at.tolist(), ends.tolist()))


def neighbours(ids: np.ndarray, doc: np.ndarray, reach: int, edge: int) -> np.ndarray:
    """The ids at -reach .. -1, 1 .. reach of each token; ``edge`` outside its text."""
    n = len(ids)
    out = np.full((n, 2 * reach), edge, dtype=np.int32)
    for c, d in enumerate([*range(-reach, 0), *range(1, reach + 1)]):
        a, b = max(0, -d), n - max(0, d)
        if a < b:
            same = doc[a:b] == doc[a + d:b + d]
            out[a:b, c] = np.where(same, ids[a + d:b + d], edge)
    return out


def log_outcome(net: Net, ids: np.ndarray, around: np.ndarray, batch: int = 8192) -> np.ndarray:
    """log p(outcome | neighbours) of each token, normalised over all outcomes."""
    got, (groups, size) = np.zeros(len(ids)), net.member.shape[:2]
    first, first_far = with_bias(net.group, net.group_bias)
    second, second_far = with_bias(net.member, net.member_bias)
    for a in range(0, len(ids), batch):
        t = ids[a:a + batch]
        order = np.argsort(short(t // size, groups), kind="stable")
        t = t[order]
        h = with_one(net.hidden(around[a:a + batch][order]))
        g, m = t // size, t % size
        own, _, total = softmax(first, first_far, h, g)
        out = own - np.log(total)
        for c, i, j in runs(g):
            own, _, total = softmax(second[c], second_far, h[:, i:j], m[i:j])
            out[i:j] += own - np.log(total)
        got[a + order] = out
    return got


class Trainer:
    """Gradient ascent of the log-likelihood with a step size per row."""

    def __init__(self, net: Net, rate: float = 0.05, batch: int = 8192):
        self.net, self.rate, self.batch = net, np.float32(rate), batch
        self.squares = [np.zeros(x.shape[:1] if x.ndim < 3 else x.shape[:2], np.float32)
                        for x in (net.context, net.group, net.member)]
        self.bias_squares = [np.zeros_like(x) for x in (net.group_bias, net.member_bias)]

    def _step(self, weights: np.ndarray, grad: np.ndarray, squares: np.ndarray) -> None:
        squares += (grad * grad).mean(axis=-1) if grad.ndim > squares.ndim else grad * grad
        scale = self.rate / np.sqrt(squares + np.float32(1))
        weights += grad * (scale[..., None] if grad.ndim > squares.ndim else scale)

    def train(self, ids: np.ndarray, around: np.ndarray) -> None:
        net, (groups, size) = self.net, self.net.member.shape[:2]

        def pulls(weights, far, h, target):
            """Gradients by weights and bias, and by h: what is seen less what is expected."""
            _, off, total = softmax(weights, far, h, target)
            off /= -total
            off[target, np.arange(len(target))] += 1
            return off @ h.T, off.T @ weights[:, :-1]

        for a in range(0, len(ids), self.batch):
            t = ids[a:a + self.batch]
            order = np.argsort(short(t // size, groups), kind="stable")
            t, ctx = t[order], around[a:a + self.batch][order]
            g, m = t // size, t % size
            h = net.hidden(ctx)
            one = with_one(h)
            group_grad, pull = pulls(*with_bias(net.group, net.group_bias), one, g)
            second, far = with_bias(net.member, net.member_bias)
            member_grad = np.zeros_like(second)
            for c, i, j in runs(g):
                member_grad[c], more = pulls(second[c], far, one[:, i:j], m[i:j])
                pull[i:j] += more
            pull *= 1 - h * h
            context_grad, place_grad = np.zeros_like(net.context), np.zeros_like(net.place)
            # Gradients of equal context rows are summed place by place.
            for j in range(ctx.shape[1]):
                by_row = np.argsort(short(ctx[:, j], len(net.context)), kind="stable")
                rows = ctx[by_row, j]
                first = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
                total = np.add.reduceat(pull[by_row], first, axis=0)
                context_grad[rows[first]] += total * net.place[j]
                place_grad[j] = (total * net.context[rows[first]]).sum(axis=0) / len(t)
            self._step(net.group, group_grad[:, :-1], self.squares[1])
            self._step(net.group_bias, group_grad[:, -1], self.bias_squares[0])
            self._step(net.member, member_grad[..., :-1], self.squares[2])
            self._step(net.member_bias, member_grad[..., -1], self.bias_squares[1])
            self._step(net.context, context_grad, self.squares[0])
            net.place += self.rate * place_grad


@dataclass
class Scorer:
    """A trained network, the words that travel, and the table of all counts."""

    net: Net
    words: Vocabulary
    reach: int
    counts: DataFrame


_PART = "slice int, task long, weight double, data binary"


def _average(parts: DataFrame, fan_in: int) -> np.ndarray | None:
    """The weighted mean of the tasks' weights, slice by slice, in a tree."""
    def merge(key, table):
        weight = table.column("weight").to_numpy()
        order = np.argsort(table.column("task").to_numpy())
        total = np.zeros(1)
        for k in order:
            part = np.frombuffer(table.column("data")[int(k)].as_py(), dtype=np.float64)
            total = total + part
        return pa.table({"slice": pa.array([key[0].as_py()], pa.int32()),
                         "task": pa.array([key[1].as_py()], pa.int64()),
                         "weight": pa.array([float(weight.sum())]),
                         "data": pa.array([total.tobytes()], pa.binary())})
    spark = parts.sparkSession
    while True:
        last = parts.agg(F.max("task")).first()[0]
        if last is None:
            return None
        grouped = parts.withColumn("up", F.floor(F.col("task") / fan_in)).groupBy("slice", "up")
        parts = materialize(ragged.map_groups(grouped, spark, merge, _PART), "weights")
        if last < fan_in:
            break
    rows = sorted(parts.collect(), key=lambda r: r.slice)     # the model: a fixed size
    return np.concatenate([np.frombuffer(r.data, dtype=np.float64) for r in rows]) / rows[0].weight


def fit(docs: DataFrame, text_col: str = "text", own_words: int = 4032, near_words: int = 1 << 17,
        width: int = 16, reach: int = 2, rounds: int = 2, seed: int = 6, fan_in: int = 64,
        slices: int = 16) -> Scorer:
    """Train on every document once; each round takes its share by text hash."""
    spark = docs.sparkSession
    counts = count_words(docs, text_col)
    words = vocabulary(counts, own_words, max(near_words, own_words))
    net = Net.fresh(words.first, width, reach, seed)
    edge = len(words.first)
    for r in range(rounds):
        share = docs.filter(F.pmod(F.xxhash64(F.coalesce(docs[text_col], F.lit(""))),
                                   F.lit(rounds)) == r)
        start = spark.sparkContext.broadcast((net, words))

        def train(batches, start=start):
            begun, known = start.value
            own = begun.filled(begun.flat())
            trainer, seen, task = Trainer(own), 0, 0
            for b in batches:
                if not b.num_rows:
                    continue
                task = b.column(1)[0].as_py()
                buf, off = ragged.text_buffer(b.column(0))
                for i, j in ragged.pieces(off):
                    h, shape, doc = tokens(buf[off[i]:off[j]], off[i:j + 1] - off[i])
                    ids, _, _ = known.find(h, shape)
                    trainer.train(ids, neighbours(ids, doc, reach, edge))
                    seen += len(ids)
            if seen:
                for k, part in enumerate(np.array_split(own.flat().astype(np.float64) * seen,
                                                        slices)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([k], pa.int32()), pa.array([task], pa.int64()),
                         pa.array([float(seen)]), pa.array([part.tobytes()], pa.binary())],
                        ["slice", "task", "weight", "data"])
        sent = share.select(share[text_col].alias("text"),
                            F.spark_partition_id().cast("long").alias("task"))
        mean = _average(materialize(ragged.map_batches(sent, train, _PART), "weights"), fan_in)
        if mean is not None:
            net = net.filled(mean)
    return Scorer(net, words, reach, counts)


def _unlike(name: str, taken: list[str]) -> str:
    while name in taken:
        name += "_"
    return name


def score(docs: DataFrame, scorer: Scorer, text_col: str = "text",
          keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (all, if not given) plus n_tokens, log_likelihood and its
    mean per token.

    A task scores all its tokens by the network and adds the counts of the words
    that travel; the distinct other words of each text, with how often they
    occur, meet the table of counts in one shuffled join."""
    made = ["n_tokens", "log_likelihood", "mean_log_likelihood"]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in made]
    row, net_part, known_part, far, times, sent_name, rare, met_row = (
        _unlike(n, keep) for n in ("_row", "_net", "_known", "_far", "_times", "_text", "_rare",
                                   "_met_row"))
    schema = T.StructType([docs.schema[c] for c in keep] + [
        T.StructField("n_tokens", T.LongType()), T.StructField(net_part, T.DoubleType()),
        T.StructField(known_part, T.LongType()),
        T.StructField(far, T.ArrayType(T.LongType())),
        T.StructField(times, T.ArrayType(T.LongType()))])
    shared = docs.sparkSession.sparkContext.broadcast((scorer.net, scorer.words))
    reach = scorer.reach

    def piece(buf, off):
        net, words = shared.value
        n = len(off) - 1
        h, shape, doc = tokens(buf, off)
        ids, log_count, known = words.find(h, shape)
        got = log_outcome(net, ids, neighbours(ids, doc, reach, len(words.first)))
        got -= words.shares(ids)
        # Whole numbers below 2^53 in every step, so that any order gives one sum.
        counted = np.bincount(doc, weights=log_count, minlength=n).astype(np.int64)
        h, doc_far = h[~known], doc[~known]
        order = np.lexsort((h, doc_far))
        h, doc_far = h[order], doc_far[order]
        first = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (doc_far[1:] != doc_far[:-1]))
                               ) if len(h) else np.zeros(0, np.int64)
        often = np.diff(np.append(first, len(h)))
        ends = np.searchsorted(doc_far[first], np.arange(n + 1)).astype(np.int32)
        return [pa.array(np.bincount(doc, minlength=n).astype(np.int64)),
                pa.array(np.bincount(doc, weights=got, minlength=n)), pa.array(counted),
                pa.ListArray.from_arrays(ends, pa.array(h[first].view(np.int64))),
                pa.ListArray.from_arrays(ends, pa.array(often.astype(np.int64)))]

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            buf, off = ragged.text_buffer(b.column(b.num_columns - 1))
            for i, j in ragged.pieces(off):
                yield pa.RecordBatch.from_arrays(
                    [b.column(k).slice(i, j - i) for k in range(len(keep))]
                    + piece(buf[off[i]:off[j]], off[i:j + 1] - off[i]), schema.names)

    sent = docs.select(*[docs[c] for c in keep], docs[text_col].alias(sent_name))
    out = materialize(ragged.map_batches(sent, run, schema)
                      .withColumn(row, F.monotonically_increasing_id()), "token-scores")
    words = out.select(row, F.explode(F.arrays_zip(F.col(far).alias("word"),
                                                   F.col(times).alias("times"))).alias("w"))
    # A word that the corpus lacks counts once: log 1 = 0.
    met = (words.select(F.col(row).alias(met_row), "w.word", "w.times")
           .join(scorer.counts.select("word", fixed_log(F.col("n")).alias("log_n")), "word")
           .groupBy(met_row).agg(F.sum(F.col("times") * F.col("log_n")).alias(rare)))
    out = out.join(met, out[row] == met[met_row], "left")
    known = F.col(known_part) + F.coalesce(F.col(rare), F.lit(0))
    out = out.withColumn("log_likelihood", F.col(net_part) + known / F.lit(float(FIXED)))
    return out.select(*keep, "n_tokens", "log_likelihood", F.when(
        F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens"))
        .alias("mean_log_likelihood"))


def op6_pseudo_likelihood(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return score(docs, fit(docs), keep=["doc_id"])
