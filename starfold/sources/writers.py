"""Writers (K1-K6).

* ``write_table`` projects to the contract and writes, counting rows with an
  ``Observation`` in the same job (no second scan).
* ``publish`` writes to a staging folder first, then swaps it in, so a
  failing load never leaves a half-written table and a table is never
  overwritten while it is being read.
* ``write_copy`` / ``read_copy``: the text format of PostgreSQL's ``COPY``, one row
  per line whatever the texts hold, so that files split.
* ``write_tsv`` / ``read_tsv``: tab-separated text with the ``\\N`` null
  marker and quotes, as the reference's export.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.contract import project

NULL_MARKER = "\\N"


def with_load_ts(df: DataFrame, ts: str | Column | None = None, name: str = "load_ts"
                 ) -> DataFrame:
    """K5: the load time on every row (one value for the whole run).  Text with
    an offset (``...+00:00``) is the same instant in every session zone."""
    value = F.current_timestamp() if ts is None else (
        ts if isinstance(ts, Column) else F.lit(ts).cast("timestamp"))
    return df.withColumn(name, value)


@dataclass(frozen=True)
class Layout:
    """O1, how a table lies on disk: folders by derived columns (name -> SQL),
    and rows dealt to files by ranges of ``cluster`` inside them, sorted, so that
    a filter on these columns skips folders, files and row groups.  A folder gets
    as many files as its share of the rows needs, of ``max_rows`` at most."""
    folders: Mapping[str, str] = field(default_factory=dict)
    cluster: tuple[str, ...] = ()
    max_rows: int = 20_000_000

    def arrange(self, df: DataFrame) -> DataFrame:
        df = df.withColumns({n: F.expr(e) for n, e in self.folders.items()})
        order = [*self.folders, *self.cluster]
        return df.repartitionByRange(*order).sortWithinPartitions(*order) if order else df


def write_table(df: DataFrame, path: str, contract: T.StructType | Sequence[str] | None = None,
                mode: str = "append", partition_by: Sequence[str] = (),
                fmt: str = "parquet", checks: Mapping[str, str] | None = None,
                measures: dict | None = None, layout: Layout | None = None) -> int:
    """K1: write the contract's columns and return the number of rows written,
    measured while writing.  ``checks`` (name -> SQL violation predicate) are
    counted by the same observation, so validating a load costs no second
    scan; their counts land in ``measures``."""
    if contract is not None:
        df = project(df, contract)
    if layout is not None:
        # Before the observation: dealing by ranges samples what is below it.
        df = layout.arrange(df)
        partition_by = list(layout.folders)
    obs = Observation(f"rows_{uuid.uuid4().hex[:8]}")
    metrics = [F.count(F.lit(1)).alias("rows")]
    for i, pred in enumerate((checks or {}).values()):
        metrics.append(F.expr(f"count_if(coalesce(({pred}), false))").alias(f"c{i}"))
    observed = df.observe(obs, *metrics)
    w = observed.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if layout is not None:
        w = w.option("maxRecordsPerFile", layout.max_rows)
    w.save(path)
    got = obs.get
    if measures is not None:
        for i, name in enumerate((checks or {}).keys()):
            measures[name] = int(got.get(f"c{i}", 0) or 0)
    return int(got.get("rows", 0))


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a work folder once its step is published."""
    fs, p = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def swap_in(spark: SparkSession, staging: str, target: str) -> None:
    """Replace ``target`` by ``staging``: the old table is moved aside, the new
    one renamed in, and the old one deleted only after the rename worked."""
    fs, tgt = _fs(spark, target)
    _, stg = _fs(spark, staging)
    old = None
    if fs.exists(tgt):
        _, old = _fs(spark, f"{target}.__old_{uuid.uuid4().hex[:8]}")
        if not fs.rename(tgt, old):
            raise OSError(f"could not move {target} aside")
    if not fs.rename(stg, tgt):
        if old is not None:
            fs.rename(old, tgt)
        raise OSError(f"could not rename {staging} to {target}")
    if old is not None:
        fs.delete(old, True)


class PublishRefused(ValueError):
    pass


def publish(df: DataFrame, target: str, contract: T.StructType | None = None,
            partition_by: Sequence[str] = (), staging_root: str | None = None,
            validate=None, checks: Mapping[str, str] | None = None) -> int:
    """K2/K3: full, retry-safe replacement of a table.

    The table is written to a staging folder; ``checks`` (name -> violation
    predicate) are counted during that write, and any violation stops the
    publication, as does ``validate(staged_df)`` raising.  The target is only
    replaced when the staged copy is complete and clean; the refused staging
    folder stays for inspection."""
    staging = f"{staging_root or target + '.__staging'}/{uuid.uuid4().hex[:12]}"
    measures: dict[str, int] = {}
    rows = write_table(df, staging, contract, mode="overwrite", partition_by=partition_by,
                       checks=checks, measures=measures)
    bad = {k: v for k, v in measures.items() if v}
    if bad:
        detail = "; ".join(f"{k}: {v}/{rows}" for k, v in sorted(bad.items()))
        raise PublishRefused(f"not published, staged at {staging}: {detail}")
    if validate is not None:
        validate(df.sparkSession.read.parquet(staging))
    swap_in(df.sparkSession, staging, target)
    return rows


def count_null_markers(df: DataFrame) -> DataFrame:
    """K4 guard: rows whose text equals the null marker would read back as
    null; count them (one aggregate) before exporting."""
    text_cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not text_cols:
        return df.agg(F.lit(0).cast("long").alias("marker_rows"))
    hit = None
    for c in text_cols:
        h = F.col(c) == NULL_MARKER
        hit = h if hit is None else (hit | h)
    return df.agg(F.count_if(F.coalesce(hit, F.lit(False))).cast("long").alias("marker_rows"))


# The escapes of the COPY text format, the backslash itself apart.
COPY_ESCAPES = (("b", "\b"), ("f", "\f"), ("n", "\n"), ("r", "\r"), ("t", "\t"), ("v", "\v"))


def copy_field(value: Column) -> Column:
    """A value as a field of a COPY line: its text with backslash escapes, a null
    as ``\\N`` (which no text can be, as its backslash would be doubled)."""
    text = F.replace(value.cast("string"), F.lit("\\"), F.lit("\\\\"))
    for letter, char in COPY_ESCAPES:
        text = F.replace(text, F.lit(char), F.lit("\\" + letter))
    return F.coalesce(text, F.lit(NULL_MARKER))


def copy_value(field: Column) -> Column:
    """The text of a field again.  Doubled backslashes part the field into runs in
    which every backslash starts an escape; a letter that is none stands for itself."""
    def plain(run: Column) -> Column:
        for letter, char in COPY_ESCAPES:
            run = F.replace(run, F.lit("\\" + letter), F.lit(char))
        return F.replace(run, F.lit("\\"), F.lit(""))
    runs = F.transform(F.split(field, r"\\\\", -1), plain)
    return F.when(field != NULL_MARKER, F.array_join(runs, "\\"))


def write_copy(df: DataFrame, path: str, columns: Sequence[str] | None = None,
               mode: str = "overwrite", max_rows_per_file: int = 5_000_000) -> int:
    """K4, splittable: one line per row in the COPY text format; returns the rows."""
    df = df.select(*(columns or df.columns))
    line = F.concat_ws("\t", *[copy_field(F.col(c)) for c in df.columns])
    obs = Observation(f"rows_{uuid.uuid4().hex[:8]}")
    (df.select(line.alias("value")).observe(obs, F.count(F.lit(1)).alias("rows"))
     .write.mode(mode).option("lineSep", "\n").option("maxRecordsPerFile", max_rows_per_file)
     .text(path))
    return int(obs.get.get("rows", 0))


def read_copy(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """K4, the inverse of ``write_copy``: files split at any line.  A line with
    another number of fields raises, as does a value that is not of its type."""
    lines = spark.read.option("lineSep", "\n").text(path)
    fields = F.split("value", "\t", -1)
    wrong = F.concat(F.lit(f"a line has not {len(schema)} fields: "), F.substring("value", 1, 200))
    # The check stands inside the first column, so that reading it cannot be pruned away.
    checked = F.when(F.size(fields) == len(schema), fields).otherwise(
        F.raise_error(wrong).cast("array<string>"))
    split = lines.select(checked.alias("_sf"))
    return split.select(*[copy_value(F.col("_sf")[i]).cast(f.dataType).alias(f.name)
                          for i, f in enumerate(schema.fields)])


def write_tsv(df: DataFrame, path: str, columns: Sequence[str] | None = None,
              mode: str = "overwrite", check_markers: bool = True,
              max_rows_per_file: int = 1_000_000) -> int:
    """K4: tab-separated, no header, ``\\N`` for null, quotes only where
    needed, a quote doubled inside quotes.  An empty string stays an empty
    (quoted) string and reads back as such.  Quoted texts may hold line breaks, so a
    file is read by one task: ``max_rows_per_file`` bounds it."""
    if columns is not None:
        df = df.select(*columns)
    if check_markers:
        n = count_null_markers(df).first()["marker_rows"]
        if n:
            raise ValueError(f"{n} rows hold the text {NULL_MARKER!r}, which would read back "
                             "as null")
    opts = {"sep": "\t", "nullValue": NULL_MARKER, "header": "false", "quote": '"',
            "escape": '"', "quoteAll": "false", "ignoreLeadingWhiteSpace": "false",
            "ignoreTrailingWhiteSpace": "false", "maxRecordsPerFile": str(max_rows_per_file)}
    return _write_csv(df, path, mode, opts)


def _write_csv(df: DataFrame, path: str, mode: str, opts: dict[str, str]) -> int:
    obs = Observation(f"rows_{uuid.uuid4().hex[:8]}")
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode(mode).options(**opts).csv(path)
    return int(obs.get.get("rows", 0))


def read_tsv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """K4 reader, the exact inverse of ``write_tsv``: quoted text may hold line
    breaks, so a file is read by one task (``write_tsv`` bounds its rows; for files
    that split, see ``read_copy``)."""
    return (spark.read.schema(schema)
            .options(sep="\t", nullValue=NULL_MARKER, header="false", quote='"', escape='"',
                     multiLine="true", mode="FAILFAST")
            .csv(path))
