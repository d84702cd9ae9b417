"""Exact dedup by content-defined chunk recipes (operator 9, DataFrame only).

A normalised text is cut where its content says so (a blank after certain word
ends, 512 to 4096 characters apart).  Every distinct chunk of the corpus gets
an identifier of two 64-bit hashes, and the identifiers are *verified*: the
distinct chunk texts are grouped by identifier once, and if two texts shared
one, another seed is taken.  From then on a document is its ordered list of
identifiers, 16 bytes for about a thousand characters, and equal documents are
those with equal lists; long texts move once, as distinct chunks, for the
verification.

Defined results: a null text counts as empty, and all empty texts are equal;
repeated rows (same id, same text) are members of their group, exactly one of
them stays; null ids sort last, a group of null ids only has a null
``keep_id`` and keeps one row; other columns travel untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

# Java patterns: white space to fold, and one chunk.
BLANKS = r"[\x20\x09-\x0D]+"
CHUNK = r"(?s).{512,4096}?(?:[aeiou][nrst] |\z)|.{1,4096}"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, " ")


def _chunks(text: Column) -> Column:
    return F.regexp_extract_all(normalised(text), F.lit(CHUNK), F.lit(0))


def _identifier(chunk: Column, seed: int) -> tuple[Column, Column]:
    return F.xxhash64(F.lit(2 * seed), chunk), F.xxhash64(F.lit(2 * seed + 1), chunk)


def verified_seed(docs: DataFrame, text_col: str = "text") -> int:
    """The first seed under which no two different chunks of the corpus share
    an identifier."""
    seed = 0
    while True:
        chunk = docs.select(F.explode(_chunks(F.col(text_col))).alias("chunk"))
        a, b = _identifier(F.col("chunk"), seed)
        distinct = chunk.select(a.alias("a"), b.alias("b"), "chunk").distinct()
        if distinct.groupBy("a", "b").count().filter("count > 1").isEmpty():
            return seed
        seed += 1


def _fresh(df: DataFrame, *names: str) -> list[str]:
    out = []
    for n in names:
        while n in df.columns:
            n += "_"
        out.append(n)
    return out


def recipes(docs: DataFrame, seed: int, text_col: str, recipe: str, row: str,
            keep: list[str], more: dict[str, Column] | None = None) -> DataFrame:
    """``keep`` columns, the recipe and a row number, stored once."""
    def ids(c: Column) -> Column:
        return F.array(*_identifier(c, seed))
    return materialize(docs.select(
        *[docs[c] for c in keep],
        F.flatten(F.transform(_chunks(docs[text_col]), ids)).alias(recipe),
        F.monotonically_increasing_id().alias(row),
        *[c.alias(n) for n, c in (more or {}).items()]), "recipes")


def _groups(rec: DataFrame, id_col: str, recipe: str, row: str) -> DataFrame:
    """One row per distinct recipe: its first (id, row) and its size.  ``min``
    and ``count`` combine before the shuffle, so a hot group stays cheap."""
    first = F.min(F.struct(F.col(id_col).isNull(), F.col(id_col).alias("id"),
                           F.col(row).alias("row"))).alias("_first")
    # Stored, so that AQE can split a hot group where it is joined back.
    return materialize(
        rec.groupBy(F.col(recipe).alias("_recipe"))
        .agg(first, F.count(F.lit(1)).alias("group_size"))
        .select("_recipe", F.col("_first.id").alias("keep_id"),
                F.col("_first.row").alias("_keep_row"), "group_size"), "groups")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: id, keep_id, group_size, kept, text_sha256."""
    narrow = docs.select(F.col(id_col), F.col(text_col))
    rec = recipes(narrow, verified_seed(narrow, text_col), text_col, "_rec", "_row", [id_col],
                  {"text_sha256": F.sha2(normalised(F.col(text_col)), 256)})
    g = _groups(rec, id_col, "_rec", "_row")
    return (rec.join(g, rec["_rec"] == g["_recipe"])
            .select(rec[id_col], "keep_id", "group_size",
                    (F.col("_row") == F.col("_keep_row")).alias("kept"), "text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with their own columns."""
    rec_name, row_name = _fresh(docs, "_rec", "_row")
    seed = verified_seed(docs, text_col)
    rec = recipes(docs, seed, text_col, rec_name, row_name, list(docs.columns))
    stay = _groups(rec.select(id_col, rec_name, row_name), id_col, rec_name, row_name)
    stay = stay.select(F.col("_keep_row").alias(row_name))
    return rec.join(stay, row_name, "left_semi").select(*docs.columns)


def op9_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP9_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t
  FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)
"""
