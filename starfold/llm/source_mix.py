"""Mixing sources to target weights by hash-threshold histograms (operator 8).

Every document has a hash.  Tokens are summed by source and leading hash bits;
a running sum over these few buckets finds, for each source, the bucket in
which its budget ends, and only the documents of that bucket are looked at
again with the next bits.  The outcome is one hash threshold per source and
copy: a document is taken once if its hash lies below the first threshold and
twice if also below the second; the budgets are nested, so are the thresholds.
Nothing is sorted, and the documents are filtered in place.

Targets: the sources in code point order (null last) weigh ``weights``,
repeating, and share ``share`` of all sizes; a target stops at ``max_copies``
times its source's size, the excess is shared by weight again.

Defined results: a null or empty text has size 0 and takes nothing; a null
source is a source of its own; rows that agree in id, source and text have one
hash and are taken or left together; the document at a threshold is taken if
that brings its source nearer to the target; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

WORD = r"[^\x20\x09-\x0D]+"
HASH_BITS = 60
LEVEL_BITS = 12


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def row_hash(id_col: Column, source: Column, text: Column) -> Column:
    """60 bits of an MD5 over id, source and text."""
    key = F.concat_ws("|", F.coalesce(id_col.cast("string"), F.lit("")),
                      F.coalesce(source, F.lit("")), F.md5(F.coalesce(text, F.lit(""))))
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long")


def mix_targets(sizes: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5,
                max_copies: int = 2) -> DataFrame:
    """``sizes`` has one row per source (source, source_size); adds target.

    The shares rise with one common level until they meet ``max_copies`` times
    the source's size; in the order in which sources meet their limit, the
    level is found from running sums.  One row per source is all that the
    windows see."""
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     (rank % len(weights) + 1).cast("int"))
    t = (sizes.withColumn("_rank", rank).withColumn("_w", w)
         .withColumn("_cap", (F.col("source_size") * max_copies).cast("double")))
    by = Window.orderBy(F.col("_cap") / F.col("_w"), "_rank")
    whole = Window.partitionBy()
    t = (t.withColumn("_total", F.sum("source_size").over(whole) * F.lit(float(share)))
         .withColumn("_before", F.sum("_cap").over(by.rowsBetween(Window.unboundedPreceding, -1)))
         .withColumn("_left", F.sum("_w").over(by.rowsBetween(0, Window.unboundedFollowing)))
         .withColumn("_level", (F.col("_total") - F.coalesce("_before", F.lit(0.0)))
                     / F.col("_left")))
    meets = F.col("_cap") / F.col("_w")
    first = F.min(F.when(F.col("_level") <= meets, F.struct(meets.alias("_meets"), "_rank",
                                                            "_level"))).over(whole)
    return (t.withColumn("_at", first.getField("_level"))
            .select("source", "source_size",
                    F.least("_cap", F.col("_at") * F.col("_w")).alias("target")))


def thresholds(sized: DataFrame, targets: DataFrame, max_copies: int = 2) -> DataFrame:
    """(source, copy, bound): copy ``c`` takes the hashes below ``bound``.

    ``sized`` has source, size and hash.  Each level's histogram has at most
    2 ** LEVEL_BITS rows per source and copy; later levels read only the rows
    of the boundary buckets, which are stored on the way."""
    copies = targets.withColumn("copy", F.explode(F.array(*[F.lit(c) for c in
                                                            range(1, max_copies + 1)])))
    budget = F.least(F.greatest(F.col("target") - (F.col("copy") - 1) * F.col("source_size"),
                                F.lit(0.0)), F.col("source_size").cast("double"))
    copies = copies.select("source", "copy", budget.alias("budget"),
                           F.col("source_size").alias("have"))
    whole, none = F.lit(1 << HASH_BITS), F.lit(0)
    settled = copies.filter("budget <= 0 OR budget >= have").select(
        "source", "copy", F.when(F.col("budget") <= 0, none).otherwise(whole).alias("bound"))
    state = (copies.filter("budget > 0 AND budget < have")
             .select("source", "copy", F.col("budget").alias("need"), F.lit(0).cast("long")
                     .alias("prefix")))
    settled, state = materialize(settled, "mix-settled"), materialize(state, "mix-state")
    rows = sized
    for level in range(HASH_BITS // LEVEL_BITS):
        shift = HASH_BITS - LEVEL_BITS * (level + 1)
        here = state.select(F.col("source").alias("_s"), "copy", "need", "prefix")
        hist = (rows.groupBy("source", F.shiftright("hash", shift).alias("bucket"))
                .agg(F.sum("size").alias("n")))
        inside = (hist["source"].eqNullSafe(here["_s"])
                  & (F.shiftright(hist["bucket"], LEVEL_BITS) == here["prefix"]))
        hist = hist.join(here, inside).drop("_s", "prefix")
        up_to = F.sum("n").over(Window.partitionBy("source", "copy").orderBy("bucket"))
        state = (hist.withColumn("upto", up_to)
                 .filter("upto >= need AND upto - n < need")
                 .select("source", "copy", "n", (F.col("need") - F.col("upto") + F.col("n"))
                         .alias("need"), F.col("bucket").alias("prefix")))
        state = materialize(state, "mix-state")
        if shift:
            at = state.select(F.col("source").alias("_s"), F.col("prefix").alias("_p")).distinct()
            rows = materialize(
                rows.join(at, rows["source"].eqNullSafe(at["_s"])
                          & (F.shiftright(rows["hash"], shift) == at["_p"]), "left_semi"),
                "mix-boundary")
    # The last prefix is a whole hash: take it if its end is the nearer one.
    last = state.select("source", "copy", F.when(F.col("n") - F.col("need") <= F.col("need"),
                                                 F.col("prefix") + 1)
                        .otherwise(F.col("prefix")).alias("bound"))
    return settled.unionByName(last)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", weights: Sequence[float] = (5, 2, 1), share: float = 1.5,
        max_copies: int = 2, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (all, if not given) in ``row``, plus source, size,
    source_size, target and copies."""
    keep = list(docs.columns) if keep is None else keep
    text, source = docs[text_col], docs[source_col]
    sized = materialize(docs.select(
        F.struct(*[docs[c] for c in keep]).alias("row"), source.alias("source"),
        n_words(text).alias("size"), row_hash(docs[id_col], source, text).alias("hash")), "mix")
    narrow = sized.select("source", "size", "hash")
    sizes = narrow.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = materialize(mix_targets(sizes, weights, share, max_copies), "mix-targets")
    bounds = thresholds(narrow, targets, max_copies)
    per_source = (bounds.groupBy(F.col("source").alias("_b"))
                  .agg(F.sort_array(F.collect_list("bound")).alias("bounds")))
    plan = materialize(targets.join(per_source, targets["source"].eqNullSafe(F.col("_b")))
                       .select(F.col("source").alias("_s"), "source_size", "target", "bounds"),
                       "mix-plan")
    copies = F.size(F.filter("bounds", lambda b: F.col("hash") < b))
    return (sized.join(plan, sized["source"].eqNullSafe(plan["_s"]))
            .select("row", "source", "size", "source_size", "target",
                    copies.alias("copies")))


def take_mix(docs: DataFrame, **options) -> DataFrame:
    """The rows of the mix: a document that is taken twice is there twice."""
    taken = mix(docs, **options).filter("copies > 0")
    return (taken.withColumn("_copy", F.explode(F.sequence(F.lit(1), "copies")))
            .select(*[F.col("row").getField(c).alias(c) for c in docs.columns]))


def op8_source_mix(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix(docs, keep=["doc_id"]).select(
        F.col("row.doc_id").alias("doc_id"), "size", "source_size", "target",
        (F.col("size") * F.col("copies")).cast("long").alias("taken"))


OP8_SQL = r"""
WITH d AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(concat_ws('|', coalesce(doc_id::VARCHAR, ''), coalesce(source, ''),
                                       md5(coalesce(text, '')))), 1, 15))::BIGINT AS h
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::INT]
           ::DOUBLE AS w,
         row_number() OVER (ORDER BY source ASC NULLS LAST) AS rk
  FROM d GROUP BY source),
c AS (
  SELECT *, 2.0::DOUBLE * source_size AS cap, 2.0::DOUBLE * source_size / w AS r,
         1.5::DOUBLE * sum(source_size) OVER () AS total FROM s),
l AS (
  SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY r, rk ROWS BETWEEN UNBOUNDED PRECEDING
                                             AND 1 PRECEDING), 0.0))
            / sum(w) OVER (ORDER BY r, rk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
         AS lev FROM c),
t AS (
  SELECT source, source_size,
         least(cap, w * (SELECT lev FROM l WHERE lev <= r ORDER BY r, rk LIMIT 1)) AS target
  FROM l),
m AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY h) AS upto,
         sum(d.size) OVER (PARTITION BY d.source, h) AS n
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
b AS (
  SELECT *, least(target, source_size::DOUBLE) AS b1, greatest(target - source_size, 0.0) AS b2
  FROM m)
SELECT doc_id, size, source_size, target,
       (size * (CASE WHEN b1 >= source_size THEN 1 WHEN b1 <= 0 THEN 0
                     WHEN upto < b1 THEN 1
                     WHEN upto - n < b1 AND upto - b1 <= b1 - (upto - n) THEN 1 ELSE 0 END
              + CASE WHEN b2 >= source_size THEN 1 WHEN b2 <= 0 THEN 0
                     WHEN upto < b2 THEN 1
                     WHEN upto - n < b2 AND upto - b2 <= b2 - (upto - n) THEN 1 ELSE 0 END
               ))::BIGINT AS taken
FROM b
"""
