"""As-of lookups: SCD2 version at a date, earliest version, latest-before.

``asof_version`` is an equi-join on the natural key with a range residual;
Catalyst keeps it a hash/sort-merge join (the residual is evaluated on the
matched pairs, whose number per key is the key's version count).

``latest_before`` never pairs rows with every earlier row of their key. Probes
and the per-time best candidates of a key are sorted together, and a running max
finds the latest candidate before each probe; the probes carry their columns and
cross the network once. Keys of more than ``HOT_ROWS`` rows (found by a count, per hash
first) go another way: the distinct probe times are unioned with the candidates and the
key is split by time bucket: the running max runs per (key, bucket), and a second running
max over the per-bucket maxima (one row per non-empty bucket) supplies the
part that lies in earlier buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.dedupe import pick_one
from tessera.session import materialize

# A key of more probes and candidates than this isn't sorted in one task.
HOT_ROWS = 100_000
# Rows are counted by so many hashes before they are counted by key.
SPOTS = 65_536
# Rank of a probe without a first key, beside those of probes and candidates; a day before all days.
NO_KEY = 2
NO_DAY = -2 ** 40


def asof_version(facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
                 date_col: str, take: list[str], prefix: str, closed: bool = True,
                 how: str = "left") -> DataFrame:
    """Attach ``take`` columns of the dim version valid at ``facts[date_col]``.

    ``closed=True`` treats ``[effective_date, expiration_date]`` as closed
    (expiry is the day before the next version starts, so this tiles days);
    ``closed=False`` reproduces the half-open ``< expiration_date`` test,
    under which a version's last day matches nothing.
    """
    d = dim.select(F.col(dim_key).alias(f"{prefix}__key"),
                   F.col("effective_date").alias(f"{prefix}__eff"),
                   F.col("expiration_date").alias(f"{prefix}__exp"),
                   *[F.col(c).alias(f"{prefix}_{c}") for c in take])
    day = F.col(date_col)
    upper = day <= F.col(f"{prefix}__exp") if closed else day < F.col(f"{prefix}__exp")
    cond = (F.col(fact_key) == F.col(f"{prefix}__key")) & (day >= F.col(f"{prefix}__eff")) & upper
    return facts.join(d, cond, how).drop(f"{prefix}__key", f"{prefix}__eff", f"{prefix}__exp")


def earliest_version(dim: DataFrame, key: str, take: list[str]) -> DataFrame:
    """J-06: first version per key (effective_date, then expiration_date)."""
    return pick_one(dim, [key], ["effective_date", "expiration_date"] +
                    [c for c in take if c not in (key, "effective_date", "expiration_date")],
                    columns=[c for c in take if c != key])


def current_version(dim: DataFrame, key: str, take: list[str], order=None,
                    current_col: str = "is_current") -> DataFrame:
    """J-19: one current version per key (DISTINCT ON .. WHERE is_current)."""
    cur = dim.where(F.col(current_col))
    order = order or [(c, "asc") for c in take if c != key]
    return pick_one(cur, [key], order, columns=[c for c in take if c != key])


def _ordinal(c: Column, kind: str) -> Column:
    if kind == "date":
        return F.unix_date(c).cast("long")
    return F.unix_micros(c.cast("timestamp")) if kind == "timestamp" else c.cast("long")


def latest_before(probes: DataFrame, cands: DataFrame, probe_keys: list[str],
                  cand_keys: list[str], probe_time: str, cand_time: str,
                  values: list[str] | None = None, strict: bool = True,
                  kind: str = "date", bucket: int | None = None,
                  out_time: str = "prev_time", hot_rows: int = HOT_ROWS) -> DataFrame:
    """For each probe row, the latest candidate of the same key before it.

    Adds ``out_time`` (the candidate's time) and ``values`` (taken from the
    candidate; among candidates sharing a time, the greatest value tuple).
    ``strict=True`` means candidate time < probe time, else <=.
    ``bucket`` is the width of a time bucket in ordinal units (days for dates,
    microseconds for timestamps); defaults to 32 days / 1 day.
    """
    parts = latest_before_parts(probes, cands, probe_keys, cand_keys, probe_time, cand_time, values, strict, kind, bucket, out_time, hot_rows)
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def latest_before_parts(probes: DataFrame, cands: DataFrame, probe_keys: list[str],
                        cand_keys: list[str], probe_time: str, cand_time: str,
                        values: list[str] | None = None, strict: bool = True,
                        kind: str = "date", bucket: int | None = None,
                        out_time: str = "prev_time", hot_rows: int = HOT_ROWS, deal: str | None = None) -> list[DataFrame]:
    """``latest_before`` as a list: the rows of keys that one task can sort,
    then those of hot keys, if there are any.

    With ``deal`` (for dates, and a first key that is a whole number) rows are
    dealt by the first key alone and not by all keys, so that a left join of a
    part to a table by that key shuffles the part no more: on
    ``part[deal] == table[key]`` and a first key that isn't null. The column
    ``deal`` is added for that; it holds the key or, where that is null, a hash
    of the row, which spreads such rows. A first key of more than ``hot_rows``
    rows is hot then.
    """
    values = values or []
    if bucket is None:
        bucket = 32 if kind == "date" else 86_400_000_000
    args = (probe_keys, cand_keys, probe_time, cand_time, values, strict, kind)
    n = 1 if deal else len(probe_keys)
    kcols = [f"__k{i}" for i in range(n)]
    together = (lambda p, c: _dealt(p, c, *args, out_time, deal)) if deal else (lambda p, c: _sorted_together(p, c, *args, out_time))
    named = (probes.select(*[F.col(a).alias(b) for a, b in zip(probe_keys, kcols)])
             .unionByName(cands.select(*[F.col(a).alias(b) for a, b in zip(cand_keys, kcols)])))
    hot = _hot_keys(named.dropna(), hot_rows)
    if hot is None:
        return [together(probes, cands)]
    # at most one key in ``hot_rows`` rows is hot: a broadcast of few rows
    hot = F.broadcast(hot)
    some = lambda df, keys, how: df.join(hot, [df[a] == hot[b] for a, b in zip(keys, kcols)], how)
    cold = together(some(probes, probe_keys, "left_anti"), some(cands, cand_keys, "left_anti"))
    found = _by_buckets(some(probes, probe_keys, "left_semi"), some(cands, cand_keys, "left_semi"), *args, bucket, out_time)
    return [cold, found.withColumn(deal, F.col(probe_keys[0])) if deal else found]


def _hot_keys(keys: DataFrame, hot_rows: int) -> DataFrame | None:
    """Keys of more than ``hot_rows`` rows, if there are any. Most keys have
    few rows, and a count of each would shuffle nearly as many counts as rows:
    rows are counted by hash first, and by key only where a hash has so many."""
    spots = keys.withColumn("__spot", F.pmod(F.xxhash64(*keys.columns), F.lit(SPOTS)).cast("int"))
    over = lambda df, by, name: materialize(df.groupBy(*by).agg(F.count(F.lit(1)).alias("__n"))
                                            .where(F.col("__n") > hot_rows).select(*by), name, drop_shuffles=True)
    full = over(spots, ["__spot"], "full_spots")
    if full.isEmpty():
        return None
    hot = over(spots.join(F.broadcast(full), "__spot"), keys.columns, "hot_keys")
    return None if hot.isEmpty() else hot


def _best_per_time(cands: DataFrame, cand_keys: list[str], kcols: list[str], cand_time: str, values: list[str], kind: str) -> DataFrame:
    """(keys, __o, __v): among candidates sharing a time, the greatest values."""
    c = (cands.select(*[F.col(a).alias(b) for a, b in zip(cand_keys, kcols)], _ordinal(F.col(cand_time), kind).alias("__o"),
                      F.col(cand_time).alias("__t"), *[F.col(v) for v in values]).dropna(subset=[*kcols, "__o"]))
    packed = [F.col("__o").alias("o"), F.col("__t").alias("t"), *[F.col(v) for v in values]]
    return c.groupBy(*kcols, "__o").agg(F.max(F.struct(*packed)).alias("__v"))


def _sorted_together(probes: DataFrame, cands: DataFrame, probe_keys: list[str], cand_keys: list[str], probe_time: str, cand_time: str,
                     values: list[str], strict: bool, kind: str, out_time: str) -> DataFrame:
    """``latest_before`` for keys that one task can sort: probe rows and
    candidates of a key in one window. Candidates that share a time need no
    reduction first: the running maximum takes the greatest of them."""
    kcols = [f"__k{i}" for i in range(len(probe_keys))]
    probe_rank, cand_rank = (0, 1) if strict else (1, 0)
    c = cands.select(*[F.col(a).alias(b) for a, b in zip(cand_keys, kcols)], _ordinal(F.col(cand_time), kind).alias("__o"),
                     F.lit(cand_rank).alias("__r"),
                     F.struct(_ordinal(F.col(cand_time), kind).alias("o"), F.col(cand_time).alias("t"),
                              *[F.col(v) for v in values]).alias("__v"), F.lit(None).alias("__row")).dropna(subset=[*kcols, "__o"])
    p = probes.select(*[F.col(a).alias(b) for a, b in zip(probe_keys, kcols)], _ordinal(F.col(probe_time), kind).alias("__o"),
                      F.lit(probe_rank).alias("__r"), F.lit(None).cast(c.schema["__v"].dataType).alias("__v"),
                      F.struct(*[F.col(x) for x in probes.columns]).alias("__row"))
    c = c.withColumn("__row", F.lit(None).cast(p.schema["__row"].dataType))
    known = F.lit(True)
    for k in [*kcols, "__o"]:       # a NULL key or time matches nothing: kept out of the window
        known = known & F.col(k).isNotNull()
    w = Window.partitionBy(*kcols).orderBy("__o", "__r").rowsBetween(Window.unboundedPreceding, -1)
    found = p.where(known).unionByName(c).withColumn("__best", F.max("__v").over(w)).where(F.col("__r") == probe_rank)
    rest = p.where(~known).withColumn("__best", F.col("__v"))
    return found.unionByName(rest).select(*[F.col("__row")[x].alias(x) for x in probes.columns], F.col("__best.t").alias(out_time),
                                          *[F.col(f"__best.{v}").alias(v) for v in values])


def _dealt(probes: DataFrame, cands: DataFrame, probe_keys: list[str], cand_keys: list[str], probe_time: str, cand_time: str,
           values: list[str], strict: bool, kind: str, out_time: str, deal: str) -> DataFrame:
    """``_sorted_together`` with rows dealt by the first key alone. The keys and
    the day cross the network once, outside the probe's row, and the day and the
    rank as one number: such rows are most of what a transfer table shuffles. A
    null key after the first and a null day need no way of their own: no
    candidate is in such a window or comes before such a day."""
    types = dict(probes.dtypes)
    if types[probe_keys[0]] not in ("int", "bigint") or (kind, types[probe_time], dict(cands.dtypes)[cand_time]) != ("date", "date", "date"):
        raise ValueError("rows are dealt by a whole number and ordered by dates only")
    kcols = [f"__k{i}" for i in range(len(probe_keys))]
    probe_rank, cand_rank = (0, 1) if strict else (1, 0)
    stamp = lambda c, rank: (F.coalesce(F.unix_date(c).cast("long"), F.lit(NO_DAY)) * 4 + rank).alias("__o")
    day = lambda c: F.when(c > NO_DAY, F.date_from_unix_date(F.shiftright(c, 2).cast("int")))
    rank, first = F.pmod(F.col("__o"), F.lit(4)), F.col(probe_keys[0])
    # Bigints first: rows whose columns of a kind stand together compress better.
    row = sorted((x for x in probes.columns if x not in (*probe_keys, probe_time)), key=lambda x: (types[x] != "bigint", types[x] == "string"))
    packed = lambda name, cols: [F.struct(*[F.col(x) for x in cols]).alias(name)] if cols else []
    spread = F.xxhash64(*[F.col(x) for x, t in probes.dtypes if "map<" not in t])
    p = probes.select(F.coalesce(first.cast("bigint"), spread).alias("__k0"), *[F.col(a).alias(b) for a, b in zip(probe_keys[1:], kcols[1:])],
                      stamp(probe_time, F.when(first.isNull(), NO_KEY).otherwise(probe_rank)), *packed("__row", row))
    c = cands.dropna(subset=[*cand_keys, cand_time]).select(*[F.col(a).alias(b) for a, b in zip(cand_keys, kcols)], stamp(cand_time, cand_rank),
                                                            *packed("__v", values))
    w = Window.partitionBy(*kcols).orderBy("__o").rowsBetween(Window.unboundedPreceding, -1)
    candidate = F.struct(F.col("__o").alias("o"), *[F.col("__v")[v].alias(v) for v in values])
    both = p.unionByName(c, allowMissingColumns=True).repartition("__k0")
    found = both.withColumn("__best", F.max(F.when(rank == cand_rank, candidate)).over(w)).where(rank != cand_rank)
    best = F.when(rank != NO_KEY, F.col("__best"))
    apart = {**dict(zip(probe_keys, map(F.col, kcols))), probe_keys[0]: F.when(rank != NO_KEY, F.col("__k0")), probe_time: day(F.col("__o"))}
    return found.select(*[(apart[x].cast(types[x]) if x in apart else F.col("__row")[x]).alias(x) for x in probes.columns],
                        day(best["o"]).alias(out_time), *[best[v].alias(v) for v in values], F.col("__k0").alias(deal))


def _by_buckets(probes: DataFrame, cands: DataFrame, probe_keys: list[str], cand_keys: list[str], probe_time: str, cand_time: str,
                values: list[str], strict: bool, kind: str, bucket: int, out_time: str) -> DataFrame:
    """``latest_before`` for hot keys: distinct probe times by time bucket."""
    kcols = [f"__k{i}" for i in range(len(probe_keys))]
    p = (probes.select(*[F.col(a).alias(b) for a, b in zip(probe_keys, kcols)],
                       _ordinal(F.col(probe_time), kind).alias("__o"))
               .dropna(subset=kcols)    # a NULL key matches nothing: keep it out of the windows
               .distinct())
    c = _best_per_time(cands, cand_keys, kcols, cand_time, values, kind)
    # At equal times a probe sorts before its candidate when strict, after otherwise.
    probe_rank, cand_rank = (0, 1) if strict else (1, 0)
    u = (p.select(*kcols, "__o", F.lit(probe_rank).alias("__r"),
                  F.lit(None).cast(c.schema["__v"].dataType).alias("__v"))
          .unionByName(c.select(*kcols, "__o", F.lit(cand_rank).alias("__r"), "__v"))
          .withColumn("__b", F.floor(F.col("__o") / F.lit(bucket))))
    w_in = (Window.partitionBy(*kcols, "__b").orderBy("__o", "__r")
                  .rowsBetween(Window.unboundedPreceding, -1))
    inside = (u.withColumn("__in", F.max("__v").over(w_in))
               .where(F.col("__r") == probe_rank)
               .select(*kcols, "__o", "__b", "__in"))
    # One row per non-empty (key, bucket) on either side, so that probes in a
    # bucket without candidates still see the earlier buckets.
    per_bucket = u.groupBy(*kcols, "__b").agg(F.max("__v").alias("__bm"))
    w_prev = (Window.partitionBy(*kcols).orderBy("__b")
                    .rowsBetween(Window.unboundedPreceding, -1))
    before = per_bucket.select(*kcols, "__b", F.max("__bm").over(w_prev).alias("__pb"))
    best = (inside.join(before, kcols + ["__b"], "left")
                  .select(*kcols, "__o", F.coalesce("__in", "__pb").alias("__best")))
    pk = probes.withColumn("__o", _ordinal(F.col(probe_time), kind))
    on = [pk[a] == best[b] for a, b in zip(probe_keys, kcols)] + [pk["__o"] == best["__o"]]
    out = pk.join(best, on, "left")
    return (out.select(*[pk[c] for c in probes.columns],
                       F.col("__best.t").alias(out_time),
                       *[F.col(f"__best.{v}").alias(v) for v in values]))
