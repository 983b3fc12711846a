"""Education indicators: population bands, enrolment ratios, parity, ratios."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import rules


def age_bands(pop: DataFrame, total_col: str = "total_population") -> DataFrame:
    """D-25: school-age bands as rounded shares of the total (exact decimals)."""
    tot = F.col(total_col).cast("decimal(20,0)")
    out = pop
    for name, share in rules.AGE_BAND_SHARES.items():
        out = out.withColumn(name, F.round(tot * F.lit(share).cast("decimal(6,3)"), 0).cast("long"))
    return out


def normalise_text_key(c) -> F.Column:
    """J-16: UPPER(TRIM(x)) join key."""
    return F.upper(F.trim(F.col(c) if isinstance(c, str) else c))


def counts_with_total(df: DataFrame, keys: list[str], gender: str, counted: list[str],
                      total_label: str = "TOTAL", valid: tuple = ("M", "F")) -> DataFrame:
    """AGG-06: per-gender counts plus a TOTAL row per key, in one aggregate.

    ``GROUPING SETS ((keys, gender), (keys))``; the TOTAL counts only rows
    whose gender is one of ``valid`` (so TOTAL = M + F). ``counted`` are
    boolean columns counted with ``count_if`` (besides all rows).
    """
    ok = F.col(gender).isin(*valid)
    aggs = [F.count(F.lit(1)).alias("__all"), F.count_if(ok).alias("__valid")]
    for c in counted:
        aggs += [F.count_if(F.col(c)).alias(f"__all_{c}"), F.count_if(F.col(c) & ok).alias(f"__valid_{c}")]
    g = df.groupingSets([[*keys, gender], keys], *keys, gender).agg(
        *aggs, F.grouping(gender).alias("__is_total"))
    tot = F.col("__is_total") == 1
    return g.select(*keys,
                    F.when(tot, F.lit(total_label)).otherwise(F.col(gender)).alias(gender),
                    F.when(tot, F.col("__valid")).otherwise(F.col("__all")).alias("enrolment"),
                    *[F.when(tot, F.col(f"__valid_{c}")).otherwise(F.col(f"__all_{c}")).alias(c)
                      for c in counted])


def gender_parity(ind: DataFrame, keys: list[str], gender: str, rate_col: str,
                  out_col: str, female: str = "F", male: str = "M", total: str = "TOTAL") -> DataFrame:
    """J-15 / D-30: female rate / male rate on the TOTAL row, by conditional
    aggregation over the key (no self-join); needs both gender rows."""
    g = F.col(gender)
    piv = ind.groupBy(*keys).agg(
        F.max(F.when(g == female, F.col(rate_col))).alias("__f"),
        F.max(F.when(g == male, F.col(rate_col))).alias("__m"),
        F.count_if(g == female).alias("__nf"), F.count_if(g == male).alias("__nm"))
    piv = piv.where((F.col("__nf") > 0) & (F.col("__nm") > 0)).select(
        *keys, rules.parity("__f", "__m").alias(out_col))
    return (ind.join(piv, keys, "left")
               .withColumn(out_col, F.when(g == total, F.col(out_col))))
