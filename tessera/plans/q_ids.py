"""Dimensions and facts with the surrogate ids of their versions."""

from __future__ import annotations

from tessera.operators.version_ids import number_versions, with_version_id
from tessera.plans import q_edu as Q
from tessera.plans.registry import ORACLE, Tables, query


def _numbered(dims: list, keys: list[str]):
    """Ids after each run of a dimension, run by run."""
    ids = None
    for dim in dims:
        ids = number_versions(dim, keys, ids)
    return ids


def teacher_ids(spark, t):
    return _numbered(Q.teacher_dims(spark, t, 2), ["person_id"])


def school_ids(spark, t, dates):
    return _numbered([Q.schools_dim(spark, t, run, dates) for run in (1, 2)], ["source_id"])


def _ids_sql(dim: str, key: str) -> str:
    """Two runs number their versions one after the other: by date, then key."""
    return f"(SELECT {key}, effective_date, row_number() OVER (ORDER BY effective_date, {key}) AS id FROM {dim})"


@query("mart_teacher_dim_ids", sql=f"""WITH {Q.teacher_dim_sql(2)}
SELECT d.*, i.id FROM tdim2 d JOIN {_ids_sql('tdim2', 'person_id')} i USING (person_id, effective_date)""")
def q_teacher_dim_ids(spark, base):
    """SNK-07 / M-T2: teacher versions with ids; run 2 numbers only its own."""
    t = Tables(spark, base)
    dim = Q.teacher_dims(spark, t, 2)[-1]
    return with_version_id(dim, teacher_ids(spark, t), {"person_id": "person_id"}, "effective_date", "id")


@query("mart_schools_dim_ids", sql=f"""WITH {Q.schools_dim_sql(2)}
SELECT d.*, i.id FROM sdim2 d JOIN {_ids_sql('sdim2', 'source_id')} i USING (source_id, effective_date)""")
def q_schools_dim_ids(spark, base):
    """SNK-07 / M-S2: school versions with ids over two runs."""
    t = Tables(spark, base)
    dates = (Q.RUN1, Q.RUN2)
    return with_version_id(Q.schools_dim(spark, t, 2, dates), school_ids(spark, t, dates), {"source_id": "source_id"}, "effective_date", "id")


@query("mart_hr_fact_ids", sql=f"""WITH fact AS ({ORACLE['mart_hr_fact']}), {Q.teacher_dim_sql(2)}, {Q.E.LOOKUPS_SQL}, {Q.E.SUBTYPES_SQL},
{Q.schools_dim_sql(2, (Q.E_RUN1, Q.E_RUN2), shared=False)}
SELECT f.*, p.id AS teacher_dim_id, s.id AS school_dim_id FROM fact f
LEFT JOIN {_ids_sql('tdim2', 'person_id')} p ON p.person_id = f.person_id AND p.effective_date = f.teacher_version
LEFT JOIN {_ids_sql('sdim2', 'source_id')} s ON s.source_id = f.school_id AND s.effective_date = f.school_version""")
def q_hr_fact_ids(spark, base):
    """M-T3 with surrogate ids: every fact row names its teacher and school version."""
    t = Tables(spark, base)
    dates = (Q.E_RUN1, Q.E_RUN2)
    fact = Q.TE.hr_fact(Q.teachers_flat(spark, t, 2, Q.T_RUN2), Q.teacher_dims(spark, t, 2)[-1], Q.schools_dim(spark, t, 2, dates))
    fact = with_version_id(fact, teacher_ids(spark, t), {"person_id": "person_id"}, "teacher_version", "teacher_dim_id")
    return with_version_id(fact, school_ids(spark, t, dates), {"source_id": "school_id"}, "school_version", "school_dim_id")
