"""Tables in parts by key range, rewritten part by part (U1, copy on write).

The note of such a table in the version file holds its cuts (ascending keys) and one
part for each range between them: the folder that holds its rows.  An upsert finds the
parts its rows fall in, joins the rows of these parts only, and writes them to the
run's folder; the new version names the new folders for these parts and the old ones
for all others, whose files are neither read nor written.  The greatest surrogate key
is in the note too, so new keys need no scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..operators.contract import project
from ..operators.keys import latest_per_key, upsert_type1
from ..session import materialize
from .readers import batch_bounds
from .versions import DATA, LAYOUT, Run
from .writers import Layout, write_table

PART = f"{LAYOUT}part"


def part_of(key: Column, cuts: Sequence) -> Column:
    """The number of the range a key falls in: the cuts not above it (null: 0)."""
    if not cuts:
        return F.lit(0)
    edges = F.array(*[F.lit(c) for c in cuts])
    return F.size(F.filter(edges, lambda c: F.coalesce(c <= key, F.lit(False))))


def _write(run: Run, df: DataFrame, spec: schemas.TableSpec, cuts: Sequence) -> dict[int, str]:
    """``df`` into the run's folder, one sub-folder a part; part -> folder."""
    key = spec.natural_key[0]
    arranged = df.withColumn(PART, part_of(F.col(key), cuts))
    layout = Layout({PART: PART}, (key,))
    # All parts in one job; the numbers that got rows are few and known to the plan.
    write_table(arranged, run.folder(spec.name), mode="overwrite", layout=layout)
    held = [r[0] for r in run.spark.read.parquet(run.folder(spec.name)).select(PART).distinct()
            .collect()] if df.take(1) else []
    return {p: f"{DATA}/{run.id}/{spec.name}/{PART}={p}" for p in held}


def create_parts(run: Run, df: DataFrame, spec: schemas.TableSpec, rows_per_part: int) -> int:
    """A table in parts of about ``rows_per_part`` rows; returns the number of parts.
    The natural key is one column of whole numbers (cuts stand in the version file)."""
    if len(spec.natural_key) != 1 or not isinstance(df.schema[spec.natural_key[0]].dataType,
                                                    T.IntegralType):
        raise ValueError(f"{spec.name}: parts are ranges of one whole-number key")
    df = project(df, spec.schema)
    cuts = [int(c) for c in batch_bounds(df, spec, rows_per_part)]
    folders = _write(run, df, spec, cuts)
    top = df.agg(F.max(spec.surrogate_key)).first()[0] or 0
    run.written[spec.name] = (f"{DATA}/{run.id}/{spec.name}", spec.schema)
    run.notes[spec.name] = {"cuts": cuts, "top": top, "parts": [
        {"folder": folders.get(p)} for p in range(len(cuts) + 1)]}
    return len(cuts) + 1


def upsert_parts(run: Run, incoming: DataFrame, spec: schemas.TableSpec,
                 version_col: str | None = None) -> list[int]:
    """U1 on a table in parts: incoming rows replace those of their key, new keys are
    numbered on; returns the parts that were rewritten."""
    note = run.base.notes[spec.name]
    key, cuts = spec.natural_key[0], note["cuts"]
    if version_col is not None:
        incoming = latest_per_key(incoming, [key], version_col).drop(version_col)
    incoming = materialize(incoming, "incoming")
    touched = sorted(r[0] for r in incoming.select(part_of(F.col(key), cuts).alias("p"))
                     .distinct().collect())
    if not touched:
        return []
    old = [note["parts"][p]["folder"] for p in touched if note["parts"][p]["folder"]]
    spark = run.spark
    rows = (spark.read.schema(spec.schema).parquet(*[f"{run.target}/{f}" for f in old]) if old
            else spark.createDataFrame([], spec.schema))
    merged = materialize(upsert_type1(rows, incoming, key, spec.surrogate_key,
                                      max_key=note["top"]), "merged")
    folders = _write(run, merged, spec, cuts)
    top = max(note["top"], merged.agg(F.max(spec.surrogate_key)).first()[0] or 0)
    parts = [{"folder": folders.get(p)} if p in touched else held
             for p, held in enumerate(note["parts"])]
    run.written[spec.name] = (f"{DATA}/{run.id}/{spec.name}", spec.schema)
    run.notes[spec.name] = {"cuts": cuts, "top": top, "parts": parts}
    return touched
