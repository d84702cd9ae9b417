"""Sharding by balanced label propagation (operator 1).

Documents that share a link key are neighbours (for the registered query:
documents with equal texts).  All start in the shard their hash names.  In each
round a link group votes: the shard that holds most of its documents, weighed
by the room that is left there, attracts the others, and as many of them move
as the shard's quota admits.  The votes of a group are the exact counts over
its documents' pairwise links, without listing a pair.  A group moves in blocks of
a quarter of a quota at most, so a small one as a whole.

Rounds go on until nobody wishes to move or ``patience`` rounds have not lowered the
number of cut edges (links between shards); the placement with the fewest is kept.
``max_rounds`` is a guard only, and a run that it ends warns of the moves left.
``cut_edges`` counts what a placement cuts.

At the end the quota is made exact: in each shard the documents beyond it,
unlinked ones first, fill the shards that have room.  Ranks come from counts
per hash bucket and a row number within a bucket, so no shard and no group is
ever in one task.  The law is ``rows``: shard sizes differ by one at most, and
``slot`` numbers a shard's documents from 0.

Defined results: a null text has size 1 and links with nothing; an empty text
links with other empty texts; null ids are documents like any other; repeated
rows are neighbours, each with a slot of its own; no rows give no rows; with
fewer documents than shards some shards stay empty.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

BUCKET_ROWS = 50_000


def _u(*cols) -> Column:
    """A uniform number in [0, 1) from a hash."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 11) / F.lit(float(1 << 53))


def cut_edges(placed: DataFrame) -> int:
    """Links between shards of (key, shard): pairs of a key less pairs of a key
    and shard.  Counted, not listed."""
    votes = (placed.filter("key IS NOT NULL").groupBy("key", "shard")
             .agg(F.count(F.lit(1)).alias("c")))
    return _cut(votes.groupBy("key").agg(F.sum("c").alias("m"),
                                         F.sum(_squared("c")).alias("inside")), F.col("inside"))


def _squared(c: str) -> Column:
    wide = F.col(c).cast("decimal(19,0)")
    return wide * wide


def _cut(groups: DataFrame, inside: Column) -> int:
    return int(groups.agg(F.sum(_squared("m") - inside)).first()[0] or 0) // 2


def propagate(nodes: DataFrame, n_shards: int, max_rounds: int = 50, patience: int = 2
              ) -> DataFrame:
    """``nodes`` has row (unique), key (null: no neighbours); adds shard.

    Per round: one aggregate by (key, shard), which combines before the
    shuffle, one join back by key (AQE splits a hot key), and an n_shards by
    n_shards table of wishes on the driver."""
    n = nodes.count()
    quota = max(1.0, n / n_shards)
    hashed = F.pmod(F.xxhash64("row"), F.lit(n_shards)).cast("int")
    state = materialize(nodes.withColumn("shard", hashed), "shards")
    linked = state.filter("key IS NOT NULL")
    # What is joined back by key is stored first, so that AQE can split a hot key.
    groups = materialize(linked.groupBy("key").agg(F.count(F.lit(1)).alias("m")).filter("m > 1"),
                         "groups")
    linked = materialize(linked.join(groups, "key").select("row", "key", "m", "shard"), "linked")
    best_cut, best_linked, since = None, linked, 0
    for r in range(max_rounds + 1):
        load = {s: c for s, c in linked.groupBy("shard").count().collect()}
        room = [quota - load.get(s, 0) for s in range(n_shards)]
        # A shard attracts by its share of the group, less what it is filled.
        fill = F.element_at(F.array(*[F.lit(load.get(s, 0) / quota) for s in range(n_shards)]),
                            F.col("shard") + 1)
        votes = linked.groupBy("key", "shard").agg(F.count(F.lit(1)).alias("c"),
                                                   F.max("m").alias("m"))
        best = (votes.withColumn("inside", _squared("c"))
                .withColumn("pull", F.col("c") / F.col("m") - 0.5 * fill)
                .groupBy("key").agg(F.max(F.struct("pull", (-F.col("shard")).alias("minus")))
                                   .alias("b"), F.max("m").alias("m"),
                                    F.sum("inside").alias("inside"))
                .select(F.col("key").alias("_k"), (-F.col("b.minus")).alias("wish"), "m", "inside"))
        best = materialize(best, "votes")
        cut = _cut(best, F.col("inside"))
        if best_cut is None or cut < best_cut:
            best_cut, best_linked, since = cut, linked, 0
        else:
            since += 1
        if cut == 0 or since >= patience:
            break
        wishes = best.select("_k", "wish")
        asked = linked.join(wishes, linked["key"] == wishes["_k"]).drop("_k")
        asked = materialize(asked, "wishes")
        moves = asked.filter("wish <> shard").groupBy("shard", "wish").count().collect()
        if not moves:
            break
        if r == max_rounds:
            left = sum(c for _, _, c in moves)
            warnings.warn(f"{left} documents still wish to move after {r} rounds", stacklevel=2)
            break
        leave, enter = [0.0] * n_shards, [0.0] * n_shards
        for a, b, c in moves:
            leave[a] += c
            enter[b] += c
        admit = [min(1.0, max(0.0, room[s] + 0.5 * leave[s]) / enter[s]) if enter[s] else 0.0
                 for s in range(n_shards)]
        p = F.element_at(F.array(*[F.lit(float(x)) for x in admit]), F.col("wish") + 1)
        blocks = F.ceil(F.col("m") / F.lit(quota / 4))
        lot = _u(F.lit(r), F.col("key"), F.pmod(F.xxhash64("row"), blocks))
        linked = asked.select("row", "key", "m", F.when((F.col("wish") != F.col("shard"))
                                                        & (lot < p), F.col("wish"))
                              .otherwise(F.col("shard")).alias("shard"))
        linked = materialize(linked, "linked")
    linked = best_linked
    moved = linked.select(F.col("row").alias("_r"), "m", F.col("shard").alias("_shard"))
    return (state.join(moved, state["row"] == F.col("_r"), "left")
            .select("row", "key", F.coalesce("_shard", "shard").alias("shard"),
                    F.coalesce("m", F.lit(1)).alias("m")))


def ranked(df: DataFrame, part: list[str], bucket: list[Column], order: list[Column],
           name: str) -> DataFrame:
    """Adds ``name``: 0, 1, 2... within ``part``, in the order of ``bucket`` and
    then ``order``.  Offsets are running sums over the bucket counts; the row
    number is taken within a bucket."""
    b = [f"_b{i}" for i in range(len(bucket))]
    df = df.withColumns(dict(zip(b, bucket)))
    counts = df.groupBy(*part, *b).agg(F.count(F.lit(1)).alias("_n"))
    run = Window.partitionBy(*(part or [F.lit(0)])).orderBy(*b)
    offsets = counts.withColumn("_off", F.sum("_n").over(run) - F.col("_n")).drop("_n")
    within = F.row_number().over(Window.partitionBy(*part, *b).orderBy(*order))
    out = df.withColumn("_rn", within).join(offsets, [*part, *b])
    return out.withColumn(name, F.col("_off") + F.col("_rn") - 1).drop("_off", "_rn", *b)


def balance(placed: DataFrame, n_shards: int) -> DataFrame:
    """Exact quotas: adds shard and slot to (row, key, shard, m)."""
    total = placed.count()
    quota = [total // n_shards + (1 if s < total % n_shards else 0) for s in range(n_shards)]
    buckets = max(1, total // (n_shards * BUCKET_ROWS))
    # Linked documents first, group by group; a large group has several buckets.
    split = F.greatest(F.lit(1), F.floor(F.col("m") / BUCKET_ROWS))
    alone = F.col("m") < 2
    bucket = [alone, F.pmod(F.xxhash64(F.when(~alone, F.col("key")), F.when(alone, F.col("row"))),
                            F.lit(buckets)),
              F.pmod(F.xxhash64("row"), split)]
    first = ranked(placed, ["shard"], bucket, [F.xxhash64("key"), F.col("row")], "rank")
    first = materialize(first, "ranks")
    have = {s: c for s, c in first.groupBy("shard").count().collect()}
    limit = F.element_at(F.array(*[F.lit(q) for q in quota]), F.col("shard") + 1)
    stay = first.filter(F.col("rank") < limit).select("row", "shard", F.col("rank").alias("slot"))
    over = first.filter(F.col("rank") >= limit).select("row", "shard", "rank")
    over = ranked(over, [], [F.col("shard"), F.pmod(F.xxhash64("row"), F.lit(buckets))],
                  [F.col("row")], "at")
    # The k-th free place: shards with room, one after another.
    shard, slot, at = F.lit(None).cast("int"), F.lit(None).cast("long"), 0
    for s in range(n_shards):
        free = quota[s] - min(have.get(s, 0), quota[s])
        here = (F.col("at") >= at) & (F.col("at") < at + free)
        shard = F.when(here, F.lit(s)).otherwise(shard)
        slot = F.when(here, F.col("at") - at + min(have.get(s, 0), quota[s])).otherwise(slot)
        at += free
    moved = over.select("row", shard.alias("shard"), slot.cast("long").alias("slot"))
    return stay.unionByName(moved)


def shard_documents(docs: DataFrame, n_shards: int = 8, id_col: str = "doc_id",
                    text_col: str = "text", **rounds) -> DataFrame:
    """One row per row: id, size, text_crc32, law, shard, slot, grown_shard."""
    text = F.col(text_col)
    base = materialize(docs.select(
        F.col(id_col), (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.sha2(text, 256).alias("key"), F.monotonically_increasing_id().alias("row")), "sharding")
    placed = materialize(propagate(base.select("row", "key"), n_shards, **rounds), "placed")
    slots = balance(placed, n_shards).withColumnRenamed("row", "_row")
    return base.join(slots, base["row"] == slots["_row"]).select(
        id_col, "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op1_label_sharding(spark, sf_dir: str) -> DataFrame:
    return shard_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
