"""Admin-unit hierarchy: every current unit mapped to its District ancestor.

Each unit type climbs a fixed number of parent links (``child_id`` holds the
parent's ``source_id``). Rather than one self-join chain per type unioned
together, all units climb together: three parent-pointer joins move every
unit one level per step, and a unit stops at the step its type requires.
The node table (one row per current unit, about 10^5 in practice) is
joined without a hint: AQE measures it at run time and broadcasts it when it
is under the threshold, else keeps the sort-merge join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# Parent links climbed per unit type to reach the District.
HOPS_TO_DISTRICT = {
    "Parish": 3,
    "Ward": 3,
    "Sub County": 2,
    "Town Council": 2,
    "County": 1,
    "Municipality": 1,
    "City": 1,
    "District": 0,
}
DISTRICT = "District"


def unit_to_district(units: DataFrame, id_col: str = "id", source_col: str = "source_id",
                     parent_col: str = "child_id", type_col: str = "admin_unit_type",
                     name_col: str = "name", current_col: str = "current_status") -> DataFrame:
    """HIR-01: (unit_dim_id, district_dim_id, district_name) per current unit.

    Intermediate parents are any current unit with the parent's source id
    (type-blind, as the warehouse does); the last step must land on a current
    District. Unknown types and broken chains yield no row.
    """
    cur = units.where(F.col(current_col))
    nodes = (cur.select(F.col(source_col).alias("__src"),
                                         F.col(parent_col).alias("__parent"),
                                         F.col(id_col).alias("__id"),
                                         F.col(type_col).alias("__type"),
                                         F.col(name_col).alias("__name")))
    hops = None
    for t, h in HOPS_TO_DISTRICT.items():
        hops = F.when(F.col(type_col) == t, h) if hops is None else hops.when(F.col(type_col) == t, h)
    frontier = cur.select(F.col(id_col).alias("unit_dim_id"),
                          hops.alias("__left"),
                          F.col(parent_col).alias("__ptr"),
                          F.col(id_col).alias("__at_id"),
                          F.col(type_col).alias("__at_type"),
                          F.col(name_col).alias("__at_name")).where(F.col("__left").isNotNull())
    done = frontier.where(F.col("__left") == 0)
    todo = frontier.where(F.col("__left") > 0)
    for _ in range(max(HOPS_TO_DISTRICT.values())):
        stepped = (todo.join(nodes, todo["__ptr"] == nodes["__src"], "inner")
                       .select("unit_dim_id", (F.col("__left") - 1).alias("__left"),
                               F.col("__parent").alias("__ptr"),
                               F.col("__id").alias("__at_id"),
                               F.col("__type").alias("__at_type"),
                               F.col("__name").alias("__at_name")))
        done = done.unionByName(stepped.where(F.col("__left") == 0))
        todo = stepped.where(F.col("__left") > 0)
    return (done.where(F.col("__at_type") == DISTRICT)
                .select("unit_dim_id", F.col("__at_id").alias("district_dim_id"),
                        F.col("__at_name").alias("district_name")))
