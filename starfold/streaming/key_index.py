"""The natural keys a stream of batches has loaded (D2 across batches).

The keys of every batch are stored as a *run*: a folder of files dealt by ranges of the
key and sorted, so that a lookup of keys between two bounds skips the files and row
groups outside them, and whole runs by the bounds that the index notes of each.  A
version file (``sources.versions``) names the runs; adding or merging runs is one commit.

``fan_in`` runs of one size are merged into one of the next, so that ``n`` batches leave
about ``fan_in * log(n)`` runs and a key is rewritten ``log(n)`` times.  Only runs of
batches that can never be replayed (all before the one at hand) are merged.

Every key carries the batch that loaded it.  A batch sees the keys of batches below its
own only, so a replay does not meet its own keys; adding a batch again puts its keys in
the place of the former ones and forgets what later batches had added, which a stream
restarted there loads again.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import versions
from ..sources.writers import Layout

BATCH = "_batch"


class KeyIndex:
    def __init__(self, spark: SparkSession, path: str, key_cols: Sequence[str], fan_in: int = 8):
        if fan_in < 2:
            raise ValueError("runs are merged two at a time at least")
        self.spark, self.path, self.fan_in = spark, path, fan_in
        self.key_cols = list(key_cols)

    def runs(self) -> dict[str, dict]:
        """Name -> ``first`` batch, ``below`` (its keys of this batch and later are
        dead), ``size`` class, ``lo`` and ``hi`` of the leading key column."""
        return dict(versions.current(self.spark, self.path).notes)

    def _open(self, version: versions.Version, name: str, below: int) -> DataFrame:
        df = versions.opened(self.spark, self.path, version, name)
        return df.filter(F.col(BATCH) < min(below, version.notes[name]["below"]))

    def seen(self, batch_id: int, lo=None, hi=None) -> DataFrame | None:
        """The keys that batches below ``batch_id`` loaded, each once; with bounds, at
        least those whose leading column lies between them.  None if there are none."""
        version = versions.current(self.spark, self.path)
        lead, parts = self.key_cols[0], []
        for name, note in version.notes.items():
            if note["first"] >= batch_id:
                continue
            if lo is not None and note["lo"] is not None and (note["hi"] < lo or note["lo"] > hi):
                continue
            df = self._open(version, name, batch_id)
            if lo is not None:
                df = df.filter(F.col(lead).between(lo, hi))
            parts.append(df.select(*self.key_cols))
        return reduce(DataFrame.unionByName, parts) if parts else None

    def _put(self, run: versions.Run, keys: DataFrame, name: str, first: int, below: int,
             size: int) -> None:
        run.write(keys, name, layout=Layout(cluster=tuple(self.key_cols)))
        lo, hi = run.read(name).agg(F.min(self.key_cols[0]), F.max(self.key_cols[0])).first()
        plain = isinstance(lo, (int, str))      # what a version file can hold
        run.notes[name] = {"first": first, "below": below, "size": size,
                           "lo": lo if plain else None, "hi": hi if plain else None}

    def add(self, keys: DataFrame, batch_id: int) -> None:
        """The keys of a batch (each once), in the place of any it had added."""
        run = versions.Run(self.spark, self.path)
        try:
            for name, note in run.base.notes.items():
                if note["first"] >= batch_id:
                    run.drop(name)
                elif note["below"] > batch_id:
                    run.notes[name] = {**note, "below": batch_id}
            self._put(run, keys.select(*self.key_cols, F.lit(batch_id).cast("long").alias(BATCH)),
                      f"batch-{batch_id}-{run.id}", batch_id, batch_id + 1, 0)
        except BaseException:
            run.abandon()
            raise
        run.commit()
        versions.vacuum(self.spark, self.path)

    def compact(self, before: int) -> int:
        """Merges runs whose batches all lie below ``before``; returns the number of
        merges."""
        made = 0
        while True:
            run = versions.Run(self.spark, self.path)
            by_size: dict[int, list[str]] = {}
            for name, note in run.base.notes.items():
                if note["below"] <= before:
                    by_size.setdefault(note["size"], []).append(name)
            full = min((s for s, names in by_size.items() if len(names) >= self.fan_in),
                       default=None)
            if full is None:
                run.abandon()
                return made
            names = sorted(by_size[full], key=lambda n: run.base.notes[n]["first"])[:self.fan_in]
            notes = [run.base.notes[n] for n in names]
            try:
                merged = reduce(DataFrame.unionByName,
                                [self._open(run.base, n, before) for n in names])
                self._put(run, merged, f"merged-{run.id}", notes[0]["first"],
                          max(n["below"] for n in notes), full + 1)
                for name in names:
                    run.drop(name)
            except BaseException:
                run.abandon()
                raise
            run.commit()
            versions.vacuum(self.spark, self.path)
            made += 1
