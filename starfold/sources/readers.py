"""Readers (S1-S7).

Tables are read with their explicit ``StructType`` (no inference); Catalyst
prunes columns and pushes filters into the parquet scan.  No global sort is
needed for a full read: order matters only for numbering, which
``assign_dense_key`` does from the key itself.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas

CORRUPT = "_corrupt_record"


def table_path(base: str, name: str, suffix: str = "") -> str:
    """A table lives under a base path (a schema / database)."""
    return f"{base.rstrip('/')}/{name}{suffix}"


def read_table(spark: SparkSession, base: str, spec: schemas.TableSpec | str,
               fmt: str = "parquet", options: Mapping[str, str] | None = None,
               suffix: str = "") -> DataFrame:
    """Whole-table scan with the catalog's schema.  A name unknown to the
    catalog is read with the file's own schema."""
    if isinstance(spec, str):
        spec = schemas.SOURCES.get(spec) or schemas.WAREHOUSE.get(spec) or spec
    name = spec if isinstance(spec, str) else spec.name
    reader = spark.read.options(**(options or {}))
    if not isinstance(spec, str) and fmt != "parquet":
        reader = reader.schema(spec.schema)
    df = reader.format(fmt).load(table_path(base, name, suffix))
    if not isinstance(spec, str) and fmt == "parquet":
        # Parquet carries its schema; cast to the contract so a drifted file
        # type is caught here rather than downstream.
        df = df.select(*[F.col(f.name).cast(f.dataType) for f in spec.schema.fields])
    return df


def order_key(spec: schemas.TableSpec | str) -> tuple[str, ...]:
    """S3: the ordering key of a table for batched or partitioned reads; a
    table without one cannot be read in batches reliably."""
    if isinstance(spec, str):
        spec = schemas.SOURCES.get(spec) or schemas.WAREHOUSE.get(spec)
    if spec is None or not spec.natural_key:
        name = spec.name if spec is not None else "?"
        raise ValueError(f"no ordering key declared for table {name!r}: a batched read "
                         "without a total order may repeat or skip rows between batches")
    return spec.natural_key


def with_batches(df: DataFrame, spec: schemas.TableSpec | str, batch_rows: int,
                 batch_col: str = "batch") -> DataFrame:
    """S2 (re-aimed): tag each row with the batch of ``batch_rows`` it falls in,
    batches taken in key order -- what paging through ``ORDER BY key`` with a
    fixed page size yields, without paging."""
    from ..operators.keys import assign_dense_key  # local: keys imports session only
    key = list(order_key(spec))
    ranked = assign_dense_key(df, key, "_sf_rank")
    return ranked.withColumn(batch_col, F.floor((F.col("_sf_rank") - 1) / batch_rows)
                             .cast("long")).drop("_sf_rank")


_CUTTABLE = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)


def batch_bounds(df: DataFrame, spec: schemas.TableSpec | str, batch_rows: int) -> list:
    """The keys at which batches of about ``batch_rows`` rows start, the first
    batch's left out; from quantiles of the leading key column, in one scan of it."""
    key = order_key(spec)[0]
    kind = df.schema[key].dataType
    if not isinstance(kind, _CUTTABLE):
        raise ValueError(f"the ordering key {key!r} is {kind.simpleString()}: batches are cut at "
                         "quantiles of numbers, dates or timestamps")
    if batch_rows < 1:
        raise ValueError("a batch holds at least one row")
    n = df.agg(F.count(F.lit(1))).first()[0]
    batches = -(-n // batch_rows)
    if batches < 2:
        return []
    shares = [i / batches for i in range(1, batches)]
    cuts = df.agg(F.percentile_approx(key, shares, max(10_000, 10 * batches))).first()[0] or []
    # Equal cuts are one key with more rows than a batch: it stays whole.
    return sorted(set(cuts))


def read_batches(df: DataFrame, spec: schemas.TableSpec | str, batch_rows: int
                 ) -> Iterator[DataFrame]:
    """The table in batches of about ``batch_rows`` rows, in key order.  A batch
    is a scan with its own key range as pushed filter, so row groups of other ranges
    are skipped; together the batches are the table, null keys with the first."""
    key = F.col(order_key(spec)[0])
    cuts = batch_bounds(df, spec, batch_rows)
    if not cuts:
        yield df
        return
    yield df.filter((key < F.lit(cuts[0])) | key.isNull())
    for lo, hi in zip(cuts, cuts[1:]):
        yield df.filter((key >= F.lit(lo)) & (key < F.lit(hi)))
    yield df.filter(key >= F.lit(cuts[-1]))


def jdbc_options(url: str, table: str, *, schema: str = "raw", user: str | None = None,
                 password: str | None = None, partition_column: str | None = None,
                 lower_bound: int | None = None, upper_bound: int | None = None,
                 num_partitions: int | None = None, fetch_size: int = 50_000,
                 driver: str = "org.postgresql.Driver") -> dict[str, str]:
    """S2(a) / S4 / S5: options of a JDBC read.  With a partition column the
    table is read as ``num_partitions`` key ranges in parallel; ``fetchsize``
    pages rows inside each range (the server-side cursor of the reference)."""
    opts = {"url": url, "dbtable": f"{schema}.{table}", "driver": driver,
            "fetchsize": str(fetch_size)}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if partition_column is not None:
        # S3: ranges need a declared order key, as batches do.
        if partition_column not in order_key(table):
            raise ValueError(f"{partition_column!r} is not the ordering key of {table!r}")
        if None in (lower_bound, upper_bound, num_partitions):
            raise ValueError("a partitioned JDBC read needs lower_bound, upper_bound "
                             "and num_partitions")
        if num_partitions < 1 or upper_bound < lower_bound:
            raise ValueError("invalid JDBC partition bounds")
        opts.update({"partitionColumn": partition_column, "lowerBound": str(lower_bound),
                     "upperBound": str(upper_bound), "numPartitions": str(num_partitions)})
    return opts


def read_jdbc(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """S1(b): a JDBC read (needs the database's driver jar on the classpath)."""
    return spark.read.format("jdbc").options(**options).load()


def read_files(spark: SparkSession, paths: Sequence[str], schema: T.StructType,
               fmt: str = "csv", options: Mapping[str, str] | None = None,
               keep_corrupt: bool = True) -> DataFrame:
    """Several files (e.g. one per year) of one table in ONE scan with an
    explicit schema.  For text formats malformed rows are kept with their raw
    text in ``_corrupt_record`` (PERMISSIVE) instead of failing the load."""
    reader = spark.read.options(**(options or {}))
    if fmt in ("csv", "json") and keep_corrupt:
        schema = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType(), True)])
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    return reader.schema(schema).format(fmt).load(list(paths))


def stage_files(spark: SparkSession, paths: Sequence[str], schema: T.StructType,
                staging: str, fmt: str = "csv", options: Mapping[str, str] | None = None
                ) -> DataFrame:
    """S6 ingest: parse the files once (PERMISSIVE) and save the parsed rows,
    malformed ones included, as parquet; later steps read the saved copy
    (Spark refuses to query the corrupt-record column straight from text)."""
    read_files(spark, paths, schema, fmt, options).write.mode("overwrite").parquet(staging)
    return spark.read.parquet(staging)


def malformed(staged: DataFrame) -> DataFrame:
    """Rows of a staged PERMISSIVE read that did not parse."""
    if CORRUPT not in staged.columns:
        return staged.limit(0)
    return staged.filter(F.col(CORRUPT).isNotNull())


def read_key_map(spark: SparkSession, path: str, natural_key: str, surrogate_key: str
                 ) -> DataFrame:
    """The two key columns of a loaded table; column pruning reads only
    those two columns from the files."""
    return spark.read.parquet(path).select(natural_key, surrogate_key)


def ingest_files(spark: SparkSession, paths: Sequence[str], spec: schemas.TableSpec,
                 staging: str, fmt: str = "csv", options: Mapping[str, str] | None = None
                 ) -> tuple[DataFrame, dict]:
    """All files of one source table (e.g. one per year) parsed in ONE
    scan as text, saved once, then typed with ``try_cast``.  Returns the typed
    rows (with ``reject_reasons``: malformed line, failed casts) and a report:
    rows, malformed rows, rows with a failed cast, and natural keys seen more
    than once across the files (ids must be unique over all years)."""
    from ..operators.contract import cast_with_reasons
    from ..operators.profile import uniqueness

    text = T.StructType([T.StructField(f.name, T.StringType(), True)
                         for f in spec.schema.fields])
    staged = stage_files(spark, paths, text, staging, fmt, options)
    bad_line = F.col(CORRUPT).isNotNull()
    # A malformed line's fields are unreliable: keep its raw text only.
    marked = staged.select(
        *[F.when(bad_line, F.lit(None)).otherwise(F.col(f.name)).alias(f.name)
          for f in text.fields],
        F.col(CORRUPT),
        F.when(bad_line, F.array(F.lit("malformed")))
        .otherwise(F.array().cast("array<string>")).alias("reject_reasons"))
    typed = cast_with_reasons(marked, spec.schema, keep=[CORRUPT])
    agg = typed.agg(F.count(F.lit(1)).alias("rows"),
                    F.count_if(F.array_contains("reject_reasons", "malformed")).alias("malformed"),
                    F.count_if(F.exists("reject_reasons", lambda r: r.startswith("cast:")))
                    .alias("cast_failures")).first()
    dup = uniqueness(typed.filter(F.size("reject_reasons") == 0),
                     list(spec.natural_key)).first()
    report = {"rows": agg["rows"], "malformed": agg["malformed"],
              "cast_failures": agg["cast_failures"], "duplicate_keys": dup["duplicated_keys"]}
    return typed, report
