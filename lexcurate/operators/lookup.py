"""A left join with a store of one row a key, whatever share of the records names one key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexcurate.operators.broadcast import DEFAULT_MAX_BROADCAST_BYTES, broadcast_bytes, broadcast_if_small, materialize, written


def one_row_a_key(objs: DataFrame, on: str) -> DataFrame:
    """One row per key, so that a left join gives a record one result: of several rows the greatest.

    Keys that have several are found without the other columns; where there are none (the store holds a key
    once) the objects stay as they are, so no aggregate stands between the texts and a join."""
    many = materialize(objs.groupBy(on).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(on))
    if many.isEmpty():
        return objs
    many = broadcast_if_small(many)
    rest = [c for c in objs.columns if c != on]
    one = objs.join(many, on, "left_semi").groupBy(on).agg(F.max(F.struct(*rest)).alias("o"))
    return objs.join(many, on, "left_anti").unionByName(one.select(on, "o.*"))


#: A key is heavy if its records are more than half an even share of a reducer, and so many at least.
HEAVY_SHARE, LEAST_HEAVY = 0.5, 100


def heavy_keys(rows: DataFrame, on: list[str], total: int) -> DataFrame:
    """(``on``, shares) of the keys of too many of the ``total`` rows: 2 * reducers of them at most, found by a count that tasks combine."""
    share = max(LEAST_HEAVY, HEAVY_SHARE * total / int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return materialize(rows.groupBy(*on).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > share)
                       .select(*on, F.ceil(F.col("n") / share).alias("__shares")))


def look_up(recs: DataFrame, objs: DataFrame, on: str, max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """``recs`` LEFT JOIN ``objs`` (one row a key) on ``on``, however many records name one key.

    All records without a link of a run name one key. Keys that many records name are counted first; their
    records are dealt over all tasks, where they meet the few heavy objects by broadcast, or, if these are
    large, one copy a share by shuffle; all others join plainly."""
    tasks = int(recs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # written once: the numbers that deal a key's records must be the same in every attempt
    recs = written(recs.withColumn("__number", F.monotonically_increasing_id()), "lookup")
    heavy = heavy_keys(recs, [on], recs.count())
    plain = recs.drop("__number")
    if heavy.isEmpty():
        return plain.join(objs, on, "left")
    heavy = F.broadcast(heavy)  # a key holds a share at least, so there are at most 2 * tasks of them
    plain = plain.join(heavy.select(on), on, "left_anti").join(objs, on, "left")
    dealt, few = recs.join(heavy, on).repartition(tasks, "__number"), materialize(objs.join(heavy, on))
    if broadcast_bytes(few) <= max_broadcast_bytes:
        joined = dealt.drop("__number", "__shares").join(F.broadcast(few.drop("__shares")), on, "left")
    else:
        dealt = dealt.withColumn("__share", F.col("__number") % F.col("__shares")).drop("__number", "__shares")
        copies = few.withColumn("__share", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__shares") - 1))).drop("__shares")
        joined = dealt.join(copies, [on, "__share"], "left").drop("__share")
    return plain.unionByName(joined)
