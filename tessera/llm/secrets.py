"""Secret scan with corpus-wide ownership (DataFrame functions only).

Candidates are found by pattern in every text. The digests of their values are
counted by distinct repository and owner over the whole corpus: a value that
many owners hold is a copied example, one that stays with its owner and looks
random is reported as live.

Positions come from built-in functions: a pattern's matches and the pieces
between them alternate, so running sums of their lengths are the offsets. The
sums run over one text's own matches. Values are hashed in the first pass and
never stored in clear.

A null text counts as empty, a null owner or repository as one of its own name.
Rows of one id are scanned one by one. Further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import Scratch, let, text_or_empty


@dataclass(frozen=True)
class Kind:
    """``pattern``'s group ``group`` is the value; it ends where the match ends
    and must have ``least`` characters."""
    name: str
    pattern: str
    group: int = 0
    least: int = 1


ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
KINDS = (
    Kind("assign", "(?i)" + ASSIGN, 2, 6),
    Kind("access", "AKIA[A-Z0-9]+", 0, 20),
    Kind("hex", "[0-9a-f]{24,}", 0, 24),     # maximal runs: the same matches as one or more, then filtered
    Kind("issued", r"gh[pousr]_[A-Za-z0-9]{30,}|xox[abprs]-[A-Za-z0-9-]{20,}|sk_live_[A-Za-z0-9]{16,}"
                   r"|eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}|-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----"),
)
BASE = ("assign", "access", "hex")
LIVE = "live"
COPIED_OWNERS = 3       # from so many owners on a value counts as a copied example


def _looks_random(value: Column) -> Column:
    return (F.length(value) >= 12) & value.rlike("[0-9]") & (F.size(F.array_distinct(F.split(value, ""))) >= 8)


def _matches(text: Column, number: int, kind: Kind) -> Column:
    """Array of (kind, n, gap, len, vlen, digest, random): gap is the length of
    what lies between the previous match and this one."""
    pattern = F.lit(kind.pattern)

    def rows(found: Column) -> Column:
        return let(F.split(text, kind.pattern, -1), lambda pieces: let(
            F.regexp_extract_all(text, pattern, F.lit(kind.group)), lambda values: F.transform(found, lambda m, i: F.struct(
                F.lit(number).alias("kind"), i.alias("n"), F.length(F.get(pieces, i)).alias("gap"), F.length(m).alias("len"),
                F.length(F.get(values, i)).alias("vlen"), F.sha2(F.get(values, i), 256).alias("digest"),
                _looks_random(F.get(values, i)).alias("random")))))

    none = F.array().cast("array<struct<kind:int,n:int,gap:int,len:int,vlen:int,digest:string,random:boolean>>")
    return let(F.regexp_extract_all(text, pattern, F.lit(0)), lambda found: F.when(F.size(found) == 0, none).otherwise(rows(found)))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner: Column | None = None,
         repository: Column | None = None, copied_owners: int = COPIED_OWNERS) -> tuple[DataFrame, DataFrame]:
    """(rows, spans). rows: row_id, doc_id. spans: row_id, kind, start, stop,
    digest, n_owners, n_repositories, live - one per candidate; offsets count
    code points, ``stop`` is exclusive. ``kind`` is a number into ``KINDS``."""
    scratch = Scratch(docs.sparkSession, "secrets")
    name = lambda c: F.coalesce(c.cast("string"), F.lit("\0null"))
    owner = name(F.col("source") if owner is None else owner)
    repository = name(F.concat_ws("/", "source", "lang") if repository is None else repository)
    hits = let(text_or_empty(text_col), lambda t: F.concat(*[_matches(t, i, k) for i, k in enumerate(KINDS)]))
    rows = scratch.save(docs.select(F.col(id_col).cast("long").alias("doc_id"), owner.alias("owner"),
                                    repository.alias("repository"), hits.alias("hits"))
                        .withColumn("row_id", F.monotonically_increasing_id()), "rows")
    before = Window.partitionBy("row_id", "kind").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    found = rows.select("row_id", "owner", "repository", F.inline("hits"))
    found = found.withColumn("stop", F.sum(F.col("gap") + F.col("len")).over(before))
    least = F.element_at(F.array(*[F.lit(k.least) for k in KINDS]), F.col("kind") + 1)
    spans = scratch.save(found.where(F.col("vlen") >= least).select(
        "row_id", "owner", "repository", "kind", (F.col("stop") - F.col("len")).alias("start"), "stop", "vlen", "digest", "random"), "spans")
    # One row per (value, owner, repository) first: what a hot value adds shrinks before each shuffle.
    held = spans.groupBy("digest", "owner", "repository").agg(F.count("*").alias("n"))
    held = held.groupBy("digest", "owner").agg(F.count("*").alias("repositories"))
    held = scratch.save(held.groupBy("digest").agg(F.count("*").alias("n_owners"), F.sum("repositories").alias("n_repositories")), "held")
    spans = spans.join(held, "digest").withColumn("live", F.col("random") & (F.col("n_owners") < copied_owners))
    return rows.select("row_id", "doc_id"), spans


def _joined(spans: Column) -> Column:
    """kind:start:stop by start, then kind, comma-joined."""
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["name"], s["start"], s["stop"])), ",")


def report(rows: DataFrame, spans: DataFrame) -> DataFrame:
    """Per row: counts by base kind, live and copied values, base_sha256 and
    all spans as text (a live value's own span is added as kind ``live``)."""
    names = F.array(*[F.lit(k.name) for k in KINDS])
    whole = F.struct("start", F.col("kind").alias("order"), F.element_at(names, F.col("kind") + 1).alias("name"), "stop")
    value = F.struct((F.col("stop") - F.col("vlen")).alias("start"), F.lit(len(KINDS)).alias("order"), F.lit(LIVE).alias("name"), "stop")
    base = F.col("kind") < len(BASE)
    per_row = spans.groupBy("row_id").agg(
        *[F.count_if(F.col("kind") == i).alias(f"n_{k}") for i, k in enumerate(BASE)],
        F.count_if("live").alias("n_live"), F.count_if(~F.col("live")).alias("n_copied"),
        F.collect_list(F.when(base, whole)).alias("base"),
        F.collect_list(whole).alias("all"),
        F.array_distinct(F.collect_list(F.when(F.col("live"), value))).alias("values"))
    counts = [f"n_{k}" for k in BASE] + ["n_live", "n_copied"]
    return rows.join(per_row, "row_id", "left").select(
        "doc_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts],
        F.sha2(F.coalesce(_joined(F.col("base")), F.lit("")), 256).alias("base_sha256"),
        F.coalesce(_joined(F.concat("all", "values")), F.lit("")).alias("spans"))
