"""Bounded incremental loads with Structured Streaming (S2(b), E3, D2 across batches).

New source files are picked up ``max_files_per_trigger`` at a time with
``trigger(availableNow=True)``: the query processes what is there in bounded
micro-batches and stops.  ``foreachBatch`` writes each micro-batch to its own
folder ``batch_id=<n>`` with overwrite, so replaying a batch after a failure
rewrites the same folder instead of appending twice.  Surrogate keys of batch
``n`` continue from the maximum key of batches ``< n`` only, so a replay gives
the same numbers; that maximum comes from a one-row sidecar per batch
(``_batches/batch_id=<n>``), so finding it never scans the loaded data.  The
streaming checkpoint records which files each batch took.

With the contract of the loaded table (``spec``), a natural key is loaded once: rows
beyond the first of their key in a batch are rejected as ``unique:<key>``, rows whose
key an earlier batch loaded as ``loaded:<key>``, by an anti-join with the stored keys
(``KeyIndex``, in ``_keys``).  Null keys repeat nothing, as in SQL.

The copies a batch makes on its way are removed at its end.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..operators.keys import mark_repeats
from ..operators.lookups import REASONS
from ..session import materialize, temporaries
from ..sources.readers import order_key
from ..sources.writers import path_exists, write_table
from .key_index import KeyIndex

# Without ``spec``: transform(batch_df, key_start) -> (accepted, rejected).  With it:
# transform(batch_df) -> resolved rows with their ``reject_reasons``.
BatchTransform = Callable[..., tuple[DataFrame, DataFrame] | DataFrame]


META = "_batches"
KEYS = "_keys"
META_SCHEMA = ("batch_id long, rows long, rejected long, repeated long, first_key long, "
               "last_key long")


def _max_key_before(spark: SparkSession, target: str, batch_id: int) -> int:
    """Largest key of the batches before ``batch_id``, from the one-row
    sidecar each batch writes (never a scan of the loaded data)."""
    meta = f"{target}/{META}"
    if not path_exists(spark, meta):
        return 0
    done = spark.read.parquet(meta).filter(F.col("batch_id") < batch_id)
    return int(done.agg(F.max("last_key")).first()[0] or 0)


def batched_table(schema: T.StructType, table: schemas.TableSpec | str | None
                  ) -> schemas.TableSpec | str:
    """S3 on the stream: the table the batches belong to, which must declare an
    ordering key (``ValueError`` otherwise).  Not named, it is the catalog's source
    table of this schema."""
    if table is None:
        table = next((s for s in schemas.SOURCES.values() if s.schema == schema),
                     schemas.TableSpec("of the stream", schema))
    order_key(table)
    return table


def load_report(spark: SparkSession, target: str) -> DataFrame:
    """K6: rows accepted, rejected and repeated of every batch, with the keys it
    gave."""
    return spark.read.parquet(f"{target}/{META}").select(
        *[f.split()[0] for f in META_SCHEMA.split(", ")])


def _new_keys(resolved: DataFrame, spec: schemas.TableSpec, index: KeyIndex, batch_id: int
              ) -> DataFrame:
    """``resolved`` with the reasons of keys met before."""
    key = list(spec.natural_key)
    name = ",".join(key)
    stored = materialize(resolved, "resolved")
    good = materialize(mark_repeats(stored.filter(F.size(REASONS) == 0), key, "_sf_again"),
                       "repeats")
    lo, hi = good.agg(F.min(key[0]), F.max(key[0])).first()
    seen = index.seen(batch_id, lo, hi) if lo is not None else None
    loaded = F.lit(False)
    if seen is not None:
        good = good.join(seen.withColumn("_sf_seen", F.lit(True)), key, "left")
        loaded = F.coalesce(F.col("_sf_seen"), F.lit(False))
    reasons = (F.when(F.col("_sf_again"), F.array(F.lit(f"unique:{name}")))
               .when(loaded, F.array(F.lit(f"loaded:{name}"))).otherwise(F.col(REASONS)))
    return (good.withColumn(REASONS, reasons).select(*resolved.columns)
            .unionByName(stored.filter(F.size(REASONS) > 0)))


def incremental_load(spark: SparkSession, source_dir: str, schema: T.StructType,
                     transform: BatchTransform, target: str, key: str,
                     checkpoint_location: str, max_files_per_trigger: int = 1,
                     fmt: str = "parquet", rejected_target: str | None = None,
                     table: schemas.TableSpec | str | None = None,
                     spec: schemas.TableSpec | None = None, index_fan_in: int = 8) -> list[dict]:
    """Run the incremental load to completion; returns one progress row
    per micro-batch (batch_id, rows, rejected, first_key, last_key).

    ``table``: the source table, which must declare an ordering key.  ``spec``: the
    loaded table, whose natural key is then unique over all batches."""
    from ..plans import facts
    batched_table(schema, table)
    progress: list[dict] = []
    index = KeyIndex(spark, f"{target}/{KEYS}", spec.natural_key, index_fan_in) if spec else None
    name = f":{','.join(spec.natural_key)}" if spec else ""

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        with temporaries(spark):
            one_batch(batch, batch_id)

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        start = _max_key_before(spark, target, batch_id) + 1
        here = f"{target}/batch_id={batch_id}"
        if spec is None:
            ok, bad = transform(batch, start)
        else:
            # Batches below this one are never replayed: their runs may be merged.
            index.compact(batch_id)
            found = _new_keys(transform(batch), spec, index, batch_id)
            ok, bad = facts.number(found, list(schema.fieldNames()), spec, start)
        rows = write_table(ok, here, mode="overwrite")
        rej, again = 0, {}
        if rejected_target is not None:
            met = {"again": f"array_contains({REASONS}, 'unique{name}') OR "
                            f"array_contains({REASONS}, 'loaded{name}')"} if spec else {}
            rej = write_table(bad, f"{rejected_target}/batch_id={batch_id}", mode="overwrite",
                              checks=met, measures=again)
        if spec is not None:
            index.add(spark.read.parquet(here).select(*spec.natural_key)
                      .dropna(subset=list(spec.natural_key)), batch_id)
        last = start + rows - 1 if rows else start - 1
        line = (batch_id, rows, rej, again.get("again", 0), start, last)
        spark.createDataFrame([line], META_SCHEMA).write.mode(
            "overwrite").parquet(f"{target}/{META}/batch_id={batch_id}")
        progress.append({"batch_id": batch_id, "rows": rows, "rejected": rej,
                         "first_key": start, "last_key": last})

    stream = (spark.readStream.schema(schema).format(fmt)
              .option("maxFilesPerTrigger", max_files_per_trigger).load(source_dir))
    q = (stream.writeStream.foreachBatch(per_batch)
         .option("checkpointLocation", checkpoint_location)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return progress
