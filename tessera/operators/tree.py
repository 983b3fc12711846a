"""Hierarchies of any depth by pointer doubling, with broken ones reported.

``climb`` finds each node's root, its depth below it and, for every kind of
node asked for, the nearest ancestor of that kind. Each round joins the pointers
to themselves and doubles their reach, so a chain of length n takes log2(n)
rounds of one join each; nothing is walked row by row. Only nodes that still
climb are joined and stored again, and the rounds end as soon as one brings
nothing: a node that needs a further round has an ancestor that is settled by
this one, so what is left then climbs for ever. Nodes on a cycle, or
below one, and nodes whose parent isn't in the table come out as such instead of
without a row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import materialize

OK, CYCLE, ORPHAN = "OK", "CYCLE", "ORPHAN"


def climb(nodes: DataFrame, id_col: str, parent_col: str, kind_col: str | None = None, kinds: tuple[str, ...] = ()) -> DataFrame:
    """One row per node: id, root, depth, status and, for each of ``kinds``,
    ``nearest_<kind>`` (the node itself counts).

    A null parent makes a root. ORPHAN: some ancestor's parent isn't there; its
    root is that ancestor. CYCLE: the chain of parents never ends; root and
    depth are null. Ids must be unique; a null id is left out.
    """
    ids = nodes.where(F.col(id_col).isNotNull())
    known = ids.select(F.col(id_col).alias("known"))
    near = [F.when(F.col(kind_col) == k, F.col(id_col)).alias(f"nearest_{k}") for k in kinds]
    start = ids.select(F.col(id_col).alias("id"), F.col(parent_col).alias("up"), *near)
    start = start.join(known, F.col("up") == F.col("known"), "left").select(
        "id", F.col("known").alias("up"), F.col("id").alias("top"), F.col("known").isNotNull().cast("long").alias("depth"),
        (F.col("up").isNotNull() & F.col("known").isNull()).alias("orphan"), *[f"nearest_{k}" for k in kinds])
    # ``up`` is the node 2**round steps above (null beyond the top); ``top`` is
    # the highest node reached, ``depth`` how many steps that is.
    climbing = F.col("up").isNotNull()
    live = materialize(start.withColumn("top", F.coalesce("up", "top")), "tree")
    rounds, limit = 0, max(1, live.count()).bit_length() + 1     # the bound holds if an id repeats, too
    settled, live = live.where(~climbing), live.where(climbing)
    wanted = [F.count_if(F.col(f"nearest_{k}").isNull()) for k in kinds]
    before, left = None, live.agg(F.count(F.lit(1)), *wanted).first()
    while rounds < limit and left[0] and left != before:
        above = settled.unionByName(live)
        above = above.select(*[F.col(c).alias(f"a__{c}") for c in above.columns])
        climbed = materialize(live.join(above, F.col("up") == F.col("a__id"), "left").select(
            "id", F.col("a__up").alias("up"), F.coalesce("a__top", "top").alias("top"),
            (F.col("depth") + F.coalesce("a__depth", F.lit(0))).alias("depth"), (F.col("orphan") | F.coalesce("a__orphan", F.lit(False))).alias("orphan"),
            *[F.coalesce(f"nearest_{k}", f"a__nearest_{k}").alias(f"nearest_{k}") for k in kinds]), "tree")
        settled, live = settled.unionByName(climbed.where(~climbing)), climbed.where(climbing)
        before, left = left, live.agg(F.count(F.lit(1)), *wanted).first()
        rounds += 1
    cycle = climbing
    return settled.unionByName(live).select("id", F.when(~cycle, F.col("top")).alias("root"), F.when(~cycle, F.col("depth")).alias("depth"),
                       F.when(cycle, CYCLE).when(F.col("orphan"), ORPHAN).otherwise(OK).alias("status"), *[f"nearest_{k}" for k in kinds])
