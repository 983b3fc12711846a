"""A unit id that two unit types share resolves a school once."""

from pyspark.sql import functions as F

from tessera.plans.marts import schools as S


def test_a_colliding_unit_id_keeps_one_row_per_school(spark):
    units = spark.createDataFrame([(1, 50, "Parish", True), (2, 50, "Ward", True), (3, 60, "Parish", False)],
                                  "id long, source_id long, admin_unit_type string, current_status boolean")
    flat = spark.createDataFrame([(7, 50), (8, 60), (9, None)], "source_id long, admin_unit_id long")
    for c in S.SCHOOL_TRACKED:
        if c not in flat.columns:
            flat = flat.withColumn(c, F.lit("x"))
    dim = S.schools_scd2(None, flat, units, "2025-01-01")
    got = {r["source_id"]: r["admin_unit_id"] for r in dim.collect()}
    assert dim.count() == 3 and got == {7: 1, 8: None, 9: None}
