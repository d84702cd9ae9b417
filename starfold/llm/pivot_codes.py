"""Vector code compression with LAESA pivots (operator 12).

Every vector is put on an integer grid, cut into equal parts, and each part is
coded by the nearest entry of its position's codebook.  Codebooks start as the
parts of the vectors with the smallest ids and are refined by a fixed number of
rounds of assignment and averaging, all in integers, so that every run gives the
same codes.

The first entries of the start serve as *pivots* and never change.  The distance
of each part to its pivots is computed once and stored beside the integers.  In a
round only the few pivot-entry distances are new; by the triangle inequality
``|d(part, pivot) - d(pivot, entry)|`` bounds ``d(part, entry)`` from below.  The
entries of a part are visited in the order of that bound, and as soon as the bound
exceeds the best exact squared distance the rest is pruned.  Bounds are floats with
a margin for their rounding; what decides, ties included, are exact integers.

Per round a task returns sums and counts per codebook cell (entries x dimension
rows), which Spark adds up; the driver sees these sums only.  The vectors with
their pivot distances are stored once in the shared checkpoint folder.

Defined results: a null vector, or one with a null or non-finite component, is
dropped; an empty table, or one with no whole vector, gives no rows; with fewer
than ``entries`` distinct ids the codebooks are smaller; rows that repeat an id are
coded each, and the least of them stands for the id at the start; a null id comes
last; null labels are one group; extra columns are ignored.  Vectors of unequal
length, a length that the parts do not divide, and components whose squared
distances would not fit 64 bits raise ``ValueError``.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from . import ragged

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
PIVOTS = 4
# Label totals travel to the tasks up to this many labels; beyond, they are joined.
MAX_LABELS = 1 << 16
_INF = np.iinfo(np.int64).max


def on_grid(df: DataFrame, vec_col: str, scale: int, out: str) -> DataFrame:
    """Rows with a whole vector, and the vector as integers floor(scale * x)."""
    v = F.col(vec_col)
    whole = F.forall(v, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"),
                                             F.lit(False)))
    return (df.filter(v.isNotNull() & whole)
            .withColumn(out, F.transform(v, lambda x: F.floor(x.cast("double") * scale)
                                         .cast("long"))))


def _matrix(column, width: int) -> np.ndarray:
    """A list column of equal lengths as a matrix."""
    flat = column.flatten() if isinstance(column, pa.ListArray) else column
    return flat.to_numpy(zero_copy_only=False).reshape(len(column), width)


def pivot_distances(cells: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances of rows to pivots (rows x pivots), rounded to 32 bits."""
    diff = cells[:, None, :].astype(np.float64) - pivots[None].astype(np.float64)
    return np.sqrt(np.einsum("ijk,ijk->ij", diff, diff)).astype(np.float32)


def nearest(cells: np.ndarray, to_pivots: np.ndarray, entries: np.ndarray,
            pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(index of the nearest entry, its squared distance, exact evaluations made)
    of every row of one part position; ties go to the lower index."""
    n = len(cells)
    near = pivot_distances(entries, pivots).astype(np.float64)       # entries x pivots
    low = np.zeros((n, len(entries)))
    for p in range(len(pivots)):
        d = to_pivots[:, p, None].astype(np.float64)
        # A 32-bit distance is off by less than 1e-7 of itself.
        bound = np.abs(d - near[None, :, p]) - 2e-7 * (d + near[None, :, p])
        np.maximum(low, bound, out=low)
    low *= low
    low *= 1 - 1e-12
    order = np.argsort(low, axis=1, kind="stable")
    best = np.full(n, _INF, dtype=np.int64)
    code = np.full(n, len(entries), dtype=np.int64)
    open_, made = np.arange(n), 0
    for j in range(len(entries)):
        e = order[open_, j]
        # An equal distance may still win by its lower index, so only a bound
        # above the best prunes; bounds ascend, so what is pruned stays so.
        go = low[open_, e] <= best[open_]
        open_, e = open_[go], e[go]
        if not len(open_):
            break
        diff = cells[open_] - entries[e]
        d = np.einsum("ij,ij->i", diff, diff)
        made += len(d)
        better = (d < best[open_]) | ((d == best[open_]) & (e < code[open_]))
        best[open_[better]] = d[better]
        code[open_[better]] = e[better]
    return code, best, made


def _parts(batch, dim: int, parts: int, n_pivots: int):
    cells = _matrix(batch.column("_cells"), dim).astype(np.int64)
    dist = _matrix(batch.column("_near"), parts * n_pivots)
    width = dim // parts
    for p in range(parts):
        yield p, cells[:, p * width:(p + 1) * width], dist[:, p * n_pivots:(p + 1) * n_pivots]


def _round(stored: DataFrame, books: np.ndarray, pivots: np.ndarray, dim: int) -> np.ndarray:
    """One round: sums and counts per entry from all tasks, then the floors of
    the means; an entry no part chose stays."""
    parts, n_entries, width = books.shape

    def run(batches):
        total = np.zeros((parts, n_entries, width), dtype=np.int64)
        count = np.zeros((parts, n_entries), dtype=np.int64)
        for b in batches:
            for p, cells, dist in _parts(b, dim, parts, pivots.shape[1]):
                code, _, _ = nearest(cells, dist, books[p], pivots[p])
                count[p] += np.bincount(code, minlength=n_entries)
                for e in np.unique(code):
                    total[p, e] += cells[code == e].sum(axis=0)
        p, e, at = np.nonzero(np.broadcast_to(count[:, :, None] > 0, total.shape))
        yield pa.RecordBatch.from_arrays(
            [pa.array(p.astype(np.int32)), pa.array(e.astype(np.int32)),
             pa.array(at.astype(np.int32)), pa.array(total[p, e, at]), pa.array(count[p, e])],
            ["part", "entry", "at", "total", "n"])

    sums = ragged.map_batches(stored.select("_cells", "_near"), run,
                              "part int, entry int, at int, total long, n long")
    out = books.copy()
    for r in (sums.groupBy("part", "entry", "at")
              .agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect()):
        out[r["part"], r["entry"], r["at"]] = r["total"] // r["n"]
    return out


def _seeds(grid: DataFrame, id_col: str, entries: int) -> np.ndarray:
    """The integer vectors of the smallest distinct ids (``entries`` rows at
    most, so the driver can hold them)."""
    ids = (grid.select(F.col(id_col).alias("_seed")).distinct()
           .orderBy(F.col("_seed").asc_nulls_last()).limit(entries))
    rows = (grid.join(F.broadcast(ids), F.col(id_col).eqNullSafe(F.col("_seed")))
            .groupBy("_seed").agg(F.min("_cells").alias("_cells"))
            .orderBy(F.col("_seed").asc_nulls_last()).collect())
    return np.array([r["_cells"] for r in rows], dtype=np.int64)


def _check(grid: DataFrame, parts: int) -> int | None:
    """The common dimension; None for an empty table."""
    lo, hi, top = grid.agg(F.min(F.size("_cells")), F.max(F.size("_cells")), F.max(F.array_max(
        F.transform("_cells", lambda x: F.abs(x))))).first()
    if lo is None:
        return None
    if lo != hi or lo % parts:
        raise ValueError(f"vectors of {lo} to {hi} components cannot be cut into {parts} equal "
                         "parts")
    if top is not None and top > math.isqrt((1 << 62) // max(1, lo)) // 2:
        raise ValueError(f"components up to {top} on the grid: squared distances would not fit")
    return lo


def compress(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
             label_col: str = "label", parts: int = PARTS, entries: int = ENTRIES,
             rounds: int = ROUNDS, scale: int = SCALE, pivots: int = PIVOTS
             ) -> tuple[DataFrame, np.ndarray]:
    """(rows, codebooks): one row ``_id, _label, codes array<int>, error`` per kept
    vector, and the final codebooks (parts x entries x part width)."""
    schema = T.StructType([
        T.StructField("_id", vectors.schema[id_col].dataType),
        T.StructField("_label", vectors.schema[label_col].dataType)])
    grid = on_grid(vectors.select(F.col(id_col).alias("_id"), F.col(label_col).alias("_label"),
                                  F.col(vec_col).alias("_vec")), "_vec", scale, "_cells")
    grid = grid.drop("_vec")
    dim = _check(grid, parts)
    final = T.StructType(schema.fields + [T.StructField("codes", T.ArrayType(T.IntegerType())),
                                          T.StructField("error", T.LongType())])
    if dim is None:
        return (vectors.sparkSession.createDataFrame([], final),
                np.zeros((parts, 0, 0), dtype=np.int64))
    width = dim // parts
    seeds = _seeds(grid, "_id", entries)
    books = seeds.reshape(len(seeds), parts, width).transpose(1, 0, 2).copy()
    fixed = books[:, :pivots].copy()

    def measure(batches):
        for b in batches:
            if not b.num_rows:
                continue
            cells = _matrix(b.column("_cells"), dim)
            near = np.concatenate([pivot_distances(cells[:, p * width:(p + 1) * width], fixed[p])
                                   for p in range(parts)], axis=1)
            per_row = near.shape[1]
            yield pa.RecordBatch.from_arrays(
                [b.column("_id"), b.column("_label"),
                 _lists(cells.astype(np.int32 if small else np.int64), dim),
                 _lists(near, per_row)], ["_id", "_label", "_cells", "_near"])

    small = bool(grid.filter(F.exists("_cells", lambda x: F.abs(x) > (1 << 31) - 1)).isEmpty())
    cell = T.IntegerType() if small else T.LongType()
    stored = materialize(ragged.map_batches(grid, measure, T.StructType(schema.fields + [
        T.StructField("_cells", T.ArrayType(cell)),
        T.StructField("_near", T.ArrayType(T.FloatType()))])), "pivot-distances")
    for _ in range(rounds):
        books = _round(stored, books, fixed, dim)

    def assign(batches):
        for b in batches:
            if not b.num_rows:
                continue
            codes = np.zeros((b.num_rows, parts), dtype=np.int32)
            error = np.zeros(b.num_rows, dtype=np.int64)
            for p, cells, dist in _parts(b, dim, parts, fixed.shape[1]):
                code, best, _ = nearest(cells, dist, books[p], fixed[p])
                codes[:, p] = code
                error += best
            yield pa.RecordBatch.from_arrays(
                [b.column("_id"), b.column("_label"), _lists(codes, parts), pa.array(error)],
                ["_id", "_label", "codes", "error"])
    return ragged.map_batches(stored, assign, final), books


def _lists(rows: np.ndarray, width: int) -> pa.ListArray:
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * width
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(rows).ravel()))


def books_digest(books: np.ndarray) -> str:
    """sha256 of the entries' decimal components by part, entry and position."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def op12_pivot_codes(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    coded, books = compress(vectors)
    coded = materialize(coded, "codes")
    # One row per label.  The totals are read by every row of a label that may hold a
    # third of all: broadcast while they are few, else a join AQE can split.
    totals = materialize(coded.groupBy(F.col("_label").alias("_of"))
                         .agg(F.sum("error").alias("label_error")), "label-errors")
    if totals.count() <= MAX_LABELS:
        totals = F.broadcast(totals)
    hexes = F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0")))
    return (coded.join(totals, F.col("_label").eqNullSafe(F.col("_of")))
            .select(F.col("_id").alias("vec_id"), F.array_join(hexes, "").alias("code"), "error",
                    "label_error", F.lit(books_digest(books)).alias("codebooks_sha256")))


def _op12_sql() -> str:
    """The rounds as plain joins: every part against every entry."""
    ctes = ["""kept AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x:
    CAST(floor(CAST(x AS DOUBLE) * 4096) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL)) = 0
    AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0)""",
            """cells AS MATERIALIZED (SELECT vec_id, (i - 1) // (len(v) // 8) AS p,
    (i - 1) % (len(v) // 8) AS pos, v[i] AS x
  FROM (SELECT vec_id, v, unnest(range(1, len(v) + 1)) AS i FROM kept))""",
            """b0 AS MATERIALIZED (SELECT p, e, pos, x AS c FROM cells JOIN
    (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept
     ORDER BY vec_id LIMIT 16) USING (vec_id))"""]
    for r in range(ROUNDS + 1):
        ctes.append(f"""a{r} AS MATERIALIZED (SELECT vec_id, p, min(d * 16 + e) AS m FROM
    (SELECT vec_id, p, e, CAST(sum((x - c) * (x - c)) AS BIGINT) AS d
     FROM cells JOIN b{r} USING (p, pos) GROUP BY vec_id, p, e) GROUP BY vec_id, p)""")
        if r < ROUNDS:
            ctes.append(f"""b{r + 1} AS MATERIALIZED (SELECT p, e, pos,
    CASE WHEN n IS NULL THEN c ELSE (s - ((s % n) + n) % n) // n END AS c
  FROM b{r} LEFT JOIN (SELECT p, CAST(m % 16 AS BIGINT) AS e, pos, CAST(sum(x) AS BIGINT) AS s,
      CAST(count(*) AS BIGINT) AS n FROM cells JOIN a{r} USING (vec_id, p) GROUP BY ALL)
    USING (p, e, pos))""")
    ctes.append(f"""coded AS MATERIALIZED (SELECT vec_id,
    string_agg(lpad(lower(to_hex(m % 16)), 2, '0'), '' ORDER BY p) AS code,
    CAST(sum(m // 16) AS BIGINT) AS error FROM a{ROUNDS} GROUP BY vec_id)""")
    return "WITH " + ",\n".join(ctes) + f"""
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY p, e, pos)) FROM b{ROUNDS})
    AS codebooks_sha256
FROM coded JOIN kept USING (vec_id)"""


OP12_SQL = _op12_sql()
