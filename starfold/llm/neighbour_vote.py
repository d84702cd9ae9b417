"""Quality by the votes of the nearest labelled documents (operator 11).

Terms of a text are hashed pairs of bytes, hashed triples of character kinds
(lower, upper, digit, blank, line feed, beyond ASCII, each mark on its own), a class of
its length and one of how much its pairs repeat; they need no vocabulary and see the
whole text.  Document frequencies are counted over all documents.  A bounded sample of
labelled rows gives the latent space: the leading right singular vectors of its weighted
term matrix.  The sample's unit vectors and labels travel to the tasks, and every
document is compared with all of them, exactly, in blocks of rows; the ``k`` nearest
(and all that tie with the last) vote with the power ``sharp`` of their cosine.

Bounds: ``sample_rows`` labelled rows (default 8,192, those with the least hashes of
their ids) of ``dims`` numbers, at most 2 MB, are broadcast; the driver sees the
sparse terms of these rows and one count per term.  All other numbers cover all rows.

Defined results: null counts as empty text; an empty text has a length class and is
judged by the empty ones among the labelled; labels that are null, or neither 0 nor 1,
or of a null id, are none; of labels repeated for an id the lowest counts, of rows
repeated for an id the least text is learnt; without any label every score is 0.5, and
if no neighbour is alike at all it is the share of 1 among the sample.  Equal texts get
equal scores up to the fifth decimal.  Very long texts are counted in blocks.  An empty
table gives no rows, extra columns are ignored.
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

PAIRS, SHAPES, CLASSES = 1024, 1024, 32       # terms of each kind; two kinds of classes
TERMS = PAIRS + SHAPES + 2 * CLASSES
BLOCK_ROWS = 256                              # documents compared at once
TIE = 1e-5                                    # cosines this near the last one's tie with it
FOLD, HELD_OUT = 3, 1                         # crc32(id) mod 3 = 1 is never learnt

# Character kinds: one for each class of bytes, one for each mark.
_KIND = np.zeros(256, dtype=np.uint32)
_KIND[ord("a"):ord("z") + 1] = 1
_KIND[ord("A"):ord("Z") + 1] = 2
_KIND[ord("0"):ord("9") + 1] = 3
_KIND[[0x09, 0x0B, 0x0C, 0x0D, 0x20]] = 4
_KIND[0x0A] = 5
_KIND[0x80:] = 6
for _i, _b in enumerate(b for b in range(0x21, 0x7F) if not chr(b).isalnum()):
    _KIND[_b] = 7 + _i


def _hashed(codes: np.ndarray, size: int) -> np.ndarray:
    """Codes below 2^24 to ``size`` buckets (a power of two)."""
    return ((codes * np.uint32(2654435761)) >> np.uint32(32 - size.bit_length() + 1)).astype(
        np.int64)


def term_counts(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Terms of each text (texts x TERMS).  Neighbours belong to one text."""
    docs = len(offsets) - 1
    out = np.zeros((docs, TERMS), dtype=np.float32)
    doc_of = np.searchsorted(offsets, np.arange(0, len(buf), ragged.PIECE_BYTES), side="right") - 1
    for k, lo in enumerate(range(0, len(buf), ragged.PIECE_BYTES)):
        # Two bytes more than the block: pairs and triples that start in it.
        some = buf[lo:lo + ragged.PIECE_BYTES + 2]
        n = min(ragged.PIECE_BYTES, len(buf) - lo)
        left = int(doc_of[k])
        right = int(np.searchsorted(offsets, lo + n, side="left"))
        cuts = np.clip(offsets[left:right + 1] - lo, 0, n)
        row = np.repeat(np.arange(right - left), np.diff(cuts))
        ends = np.minimum(offsets[left + 1:right + 1] - lo, len(some))[row]
        at = np.arange(n)
        wide = some.astype(np.uint32)
        kinds = _KIND[some]
        for size, span, shift in ((PAIRS, 2, 0), (SHAPES, 3, PAIRS)):
            own = at[at + span <= ends]
            code = wide[own] * 256 + wide[own + 1] if span == 2 else (
                (kinds[own] * 64 + kinds[own + 1]) * 64 + kinds[own + 2])
            cell = row[own] * size + _hashed(code, size)
            got = np.bincount(cell, minlength=(right - left) * size).reshape(-1, size)
            out[left:right, shift:shift + size] += got
    length = np.diff(offsets)
    pairs = out[:, :PAIRS].astype(np.float64)
    # The number of equally frequent pairs that would repeat as often as these do.
    spread = np.maximum(pairs.sum(axis=1), 1) ** 2 / np.maximum((pairs ** 2).sum(axis=1), 1)
    for shift, size, weight in ((PAIRS + SHAPES, length + 1, 1), (TERMS - CLASSES, spread, 8)):
        cls = np.minimum(np.ceil(2 * np.log2(size)).astype(np.int64), CLASSES - 1)
        out[np.arange(docs), shift + cls] = weight
    return out


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """log(1 + count) times idf, as unit rows."""
    x = np.log1p(counts) * idf
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


@dataclass
class VoteModel:
    """What a document is compared with; ``vectors`` is None without labels."""
    idf: np.ndarray
    basis: np.ndarray | None = None          # terms x dims
    vectors: np.ndarray | None = None        # sample x dims, unit rows
    labels: np.ndarray | None = None
    k: int = 9
    sharp: float = 8.0

    def latent(self, counts: np.ndarray) -> np.ndarray:
        x = weighted(counts, self.idf) @ self.basis
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)

    def score(self, counts: np.ndarray) -> np.ndarray:
        if self.vectors is None:
            return np.full(len(counts), 0.5)
        x = self.latent(counts)
        out = np.empty(len(x))
        k = min(self.k, len(self.vectors))
        prior = float(self.labels.mean())
        for i in range(0, len(x), BLOCK_ROWS):
            near = x[i:i + BLOCK_ROWS] @ self.vectors.T
            last = np.partition(near, near.shape[1] - k, axis=1)[:, near.shape[1] - k]
            vote = np.where(near >= last[:, None] - TIE, np.maximum(near, 0), 0).astype(np.float64)
            vote **= self.sharp
            total = vote.sum(axis=1)
            out[i:i + BLOCK_ROWS] = (vote @ self.labels + 1e-9 * prior) / (total + 1e-9)
        return np.round(out, 6)


def _blocks(buf: np.ndarray, offsets: np.ndarray):
    """Ranges of texts whose term matrix stays small."""
    for i, j in ragged.pieces(offsets):
        for a in range(i, j, BLOCK_ROWS):
            yield a, min(a + BLOCK_ROWS, j)


def document_frequencies(docs: DataFrame, text_col: str) -> tuple[np.ndarray, int]:
    """Documents that hold each term, over all documents; and their number."""
    def run(batches):
        seen, rows = np.zeros(TERMS, dtype=np.int64), 0
        for b in batches:
            if not b.num_rows:
                continue
            buf, off = ragged.text_buffer(b.column(0))
            rows += b.num_rows
            for i, j in _blocks(buf, off):
                seen += np.count_nonzero(term_counts(buf[off[i]:off[j]], off[i:j + 1] - off[i]),
                                         axis=0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(TERMS + 1, dtype=np.int32)), pa.array(np.append(seen, rows))],
            ["term", "n"])
    parts = ragged.map_batches(docs.select(text_col), run, "term int, n long")
    total = np.zeros(TERMS + 1, dtype=np.int64)
    for term, n in parts.groupBy("term").agg(F.sum("n")).collect():
        total[term] = n
    return total[:-1], int(total[-1])


def _terms_of(sample: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Term counts and labels of the sampled rows, on the driver, by id hash."""
    schema = T.StructType([T.StructField("_at", T.LongType()),
                           T.StructField("_label", T.IntegerType()),
                           T.StructField("terms", T.ArrayType(T.IntegerType())),
                           T.StructField("counts", T.ArrayType(T.FloatType()))])

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            buf, off = ragged.text_buffer(b.column("_text"))
            terms, counts = [], []
            for i, j in _blocks(buf, off):
                for row in term_counts(buf[off[i]:off[j]], off[i:j + 1] - off[i]):
                    at = np.flatnonzero(row)
                    terms.append(at.astype(np.int32))
                    counts.append(row[at])
            yield pa.RecordBatch.from_arrays(
                [b.column("_at"), b.column("_label"),
                 pa.array(terms, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.float32()))],
                ["_at", "_label", "terms", "counts"])
    got = ragged.map_batches(sample.select("_at", "_label", "_text"), run, schema).toArrow()
    rows = sorted(zip(got["_at"].to_pylist(), range(got.num_rows)))
    x = np.zeros((got.num_rows, TERMS), dtype=np.float32)
    y = np.zeros(got.num_rows)
    terms, counts, labels = got["terms"], got["counts"], got["_label"]
    for to, (_, i) in enumerate(rows):
        x[to, terms[i].values.to_numpy()] = counts[i].values.to_numpy()
        y[to] = labels[i].as_py()
    return x, y


def leading(w: np.ndarray, dims: int) -> np.ndarray:
    """The leading right singular vectors of ``w``, from its smaller Gram matrix."""
    if len(w) >= w.shape[1]:
        vectors = np.linalg.eigh(w.T @ w)[1]
        return np.ascontiguousarray(vectors[:, ::-1][:, :dims])
    values, left = np.linalg.eigh(w @ w.T)
    some = values[::-1][:dims] > 1e-9 * values[-1]
    left = left[:, ::-1][:, :dims][:, some]
    return (w.T @ left) / np.sqrt(values[::-1][:dims][some])


def fit_vote_model(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                   text_col: str = "text", quality_col: str = "quality",
                   learn: Column | None = None, sample_rows: int = 8192, dims: int = 48,
                   k: int = 9, sharp: float = 8.0) -> VoteModel:
    """The latent vectors of at most ``sample_rows`` labelled rows of ``docs``
    (where ``learn`` holds, a condition on the label's id ``_lab_id``)."""
    df, n = document_frequencies(docs, text_col)
    idf = np.log((n + 1) / (df + 1)).astype(np.float32) + np.float32(0.1)
    lab = (labels.filter(F.col(id_col).isNotNull() & F.col(quality_col).isin(0, 1))
           .groupBy(F.col(id_col).alias("_lab_id"))
           .agg(F.min(quality_col).cast("int").alias("_label")))
    if learn is not None:
        lab = lab.filter(learn)
    here = docs.select(F.col(id_col).alias("_doc_id"), F.col(text_col).alias("_text"))
    # Only ids are compared to find the labelled rows; texts of the sample alone move.
    known = lab.join(here.select("_doc_id"), F.col("_lab_id") == F.col("_doc_id"), "left_semi")
    ids = materialize(known.withColumn("_at", F.xxhash64("_lab_id")).orderBy("_at", "_lab_id")
                      .limit(sample_rows), "vote-sample")
    texts = (here.join(F.broadcast(ids), F.col("_lab_id") == F.col("_doc_id"))
             .groupBy("_lab_id", "_label", "_at")
             .agg(F.min(F.coalesce("_text", F.lit(""))).alias("_text")))
    x, y = _terms_of(texts)
    model = VoteModel(idf, k=k, sharp=sharp)
    if not len(x):
        return model
    w = weighted(x, idf).astype(np.float64)
    model.basis = leading(w, dims).astype(np.float32)
    model.vectors, model.labels = model.latent(x).astype(np.float32), y
    return model


def vote(docs: DataFrame, model: VoteModel, id_col: str = "doc_id", text_col: str = "text"
         ) -> DataFrame:
    """One row per row of ``docs``: its id and ``score`` (0 to 1)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType),
                           T.StructField("score", T.DoubleType())])

    def run(batches):
        model = shared.value
        for b in batches:
            if not b.num_rows:
                continue
            buf, off = ragged.text_buffer(b.column(1))
            score = np.concatenate([model.score(term_counts(buf[off[i]:off[j]],
                                                            off[i:j + 1] - off[i]))
                                    for i, j in _blocks(buf, off)])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(score, pa.float64())],
                                             [id_col, "score"])
    return ragged.map_batches(docs.select(id_col, text_col), run, schema)


def fold_of(id_col: str | Column) -> Column:
    """crc32 of the id as text, mod 3; a null id is the empty text."""
    column = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(F.coalesce(column.cast("string"), F.lit(""))) % FOLD


def op11_neighbour_vote(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = fit_vote_model(docs, labels, learn=fold_of("_lab_id") != HELD_OUT)
    return vote(docs, model).select(
        "doc_id", (fold_of("doc_id") == HELD_OUT).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
