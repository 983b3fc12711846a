"""Ordered work over tables of any size: running sums and next rows within
groups, and list ranking, without a task that holds a whole group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import Scratch, maybe_broadcast

SMALL_LIST = 1_000_000      # list elements up to which pointers are doubled instead of spliced


def dealt(df: DataFrame, scratch: Scratch, step: str, group: list[str], order: list[str]) -> DataFrame:
    """``df`` dealt by ranges of (group, order), stored with the number of its
    range as ``part``: a large group spans several ranges, of increasing number
    in its order."""
    out = df.repartitionByRange(*[F.col(c).asc_nulls_first() for c in (*group, *order)])
    return scratch.save(out.withColumn("part", F.spark_partition_id()), step)


def running_sums(df: DataFrame, scratch: Scratch, step: str, group: list[str], order: list[str], sums: dict[str, Column]) -> DataFrame:
    """``df`` with running sums over the rows of a group up to and including
    each row. Ranges are summed apart; what precedes a range in its group comes
    from one row per range and group."""
    rows = dealt(df.select("*", *[c.alias(f"{n}__v") for n, c in sums.items()]), scratch, f"{step}-dealt", group, order)
    totals = scratch.save(rows.groupBy("part", *group).agg(*[F.sum(f"{n}__v").alias(f"{n}__t") for n in sums]), f"{step}-totals")
    before = Window.partitionBy(*group or [F.lit(0)]).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", *group, *[F.coalesce(F.sum(f"{n}__t").over(before), F.lit(0)).alias(f"{n}__o") for n in sums])
    # Only groups that go on from an earlier range have something to add.
    offsets = scratch.save(offsets.where(" or ".join(f"{n}__o <> 0" for n in sums)), f"{step}-offsets")
    within = Window.partitionBy("part", *group).orderBy(*[F.col(c).asc_nulls_first() for c in order]).rowsBetween(Window.unboundedPreceding, 0)
    inner = rows.select("*", *[F.sum(f"{n}__v").over(within).alias(f"{n}__w") for n in sums])
    joined = inner.join(maybe_broadcast(offsets), ["part", *group], "left")
    return joined.select(*df.columns, *[(F.col(f"{n}__w") + F.coalesce(f"{n}__o", F.lit(0))).alias(n) for n in sums])


def next_rows(df: DataFrame, scratch: Scratch, step: str, group: list[str], order: str, name: str) -> DataFrame:
    """``df`` with ``name``: the next row's ``order`` in the group, or null."""
    rows = dealt(df, scratch, f"{step}-dealt", group, [order])
    firsts = scratch.save(rows.groupBy("part", *group).agg(F.min(order).alias("first")), f"{step}-firsts")
    after = Window.partitionBy(*group).orderBy("part")
    follows = firsts.select("part", *group, F.lead("first").over(after).alias("follows")).where("follows is not null")
    follows = scratch.save(follows, f"{step}-follows")
    within = Window.partitionBy("part", *group).orderBy(order)
    inner = rows.withColumn("inside", F.lead(order).over(within))
    joined = inner.join(maybe_broadcast(follows), ["part", *group], "left")
    return joined.select(*df.columns, F.coalesce("inside", "follows").alias(name))


def list_ranks(arcs: DataFrame, scratch: Scratch, small: int = SMALL_LIST) -> DataFrame:
    """(a, b, rank) of linked lists given as (a, b, next_a, next_b), where (a, b)
    names an element and the last one of a list has no next: its rank is 1, that
    of any other element one more than its next one's.

    While there are more than ``small`` elements, an independent set of them
    (drawn by a hash of the round, a quarter on average) is spliced out and put
    away, so that the work of all rounds together is in proportion to the list.
    What is left is ranked by doubling its pointers; then the rounds are undone.
    """
    live = scratch.save(arcs.select("a", "b", "next_a", "next_b", F.lit(1).cast("long").alias("w")), "rank-0")
    count, turn, gone = live.count(), 0, []
    while count > small:
        turn += 1
        head = F.pmod(F.xxhash64("a", "b", F.lit(turn)), F.lit(2)) == 0
        nexts = F.pmod(F.xxhash64("next_a", "next_b", F.lit(turn)), F.lit(2)) == 1
        nexts = head & nexts & F.col("next_a").isNotNull()
        target = live.select(F.col("a").alias("t_a"), F.col("b").alias("t_b"), F.col("next_a").alias("t_next_a"),
                             F.col("next_b").alias("t_next_b"), F.col("w").alias("t_w"))
        # An element is spliced out if it draws tails and the one before it heads.
        joined = scratch.save(live.where(nexts).join(target, (F.col("next_a") == F.col("t_a")) & (F.col("next_b") == F.col("t_b"))), f"spliced-{turn}")
        gone.append(joined.select(F.col("t_a").alias("a"), F.col("t_b").alias("b"), F.col("t_next_a").alias("next_a"),
                                  F.col("t_next_b").alias("next_b"), F.col("t_w").alias("w")))
        kept = live.where(~nexts).join(gone[-1].select("a", "b"), ["a", "b"], "left_anti").select("a", "b", "next_a", "next_b", "w")
        moved = joined.select("a", "b", F.col("t_next_a").alias("next_a"), F.col("t_next_b").alias("next_b"), (F.col("w") + F.col("t_w")).alias("w"))
        live = scratch.save(kept.union(moved), f"rank-{turn}")
        scratch.drop(f"rank-{turn - 1}")
        count = live.count()
    step = 0
    while not live.where("next_a is not null").isEmpty():
        step += 1
        target = maybe_broadcast(live.select(F.col("a").alias("t_a"), F.col("b").alias("t_b"), F.col("next_a").alias("t_next_a"),
                                             F.col("next_b").alias("t_next_b"), F.col("w").alias("t_w")), count)
        on = (F.col("next_a") == F.col("t_a")) & (F.col("next_b") == F.col("t_b"))
        live = scratch.save(live.join(target, on, "left").select(
            "a", "b", F.col("t_next_a").alias("next_a"), F.col("t_next_b").alias("next_b"),
            (F.col("w") + F.coalesce("t_w", F.lit(0))).alias("w")), f"double-{step}")
        scratch.drop(f"rank-{turn}" if step == 1 else f"double-{step - 1}")
    ranks = live.select("a", "b", F.col("w").alias("rank"))
    for n, out in reversed(list(enumerate(gone))):
        known = ranks.select(F.col("a").alias("t_a"), F.col("b").alias("t_b"), F.col("rank").alias("t_rank"))
        on = (F.col("next_a") == F.col("t_a")) & (F.col("next_b") == F.col("t_b"))
        back = out.join(known, on, "left").select("a", "b", (F.col("w") + F.coalesce("t_rank", F.lit(0))).alias("rank"))
        ranks = scratch.save(ranks.union(back), f"undone-{n}")
    return ranks
