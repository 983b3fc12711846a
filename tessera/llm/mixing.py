"""Mixing sources to target weights (DataFrame functions only).

Documents fall into cells of source, language and topic; categories that the
targets do not name share one further category per dimension, so the number of
cells is bounded by the targets. Iterative proportional fitting rakes the
cells' token weights to each marginal in turn, never above the tokens a cell
has. A cell's weight over its tokens is then the probability with which its
documents are kept: expected token shares meet the targets where the corpus
can, and 1 / probability is the weight for unbiased estimates.

Keeping is decided by a hash of id and seed, so it is repeatable and needs no
order. Token sums are reduced per task; a hot source costs one row per task and
cell. The fitted cells (bounded as said) are broadcast.

Null or unnamed categories count as the further one. A target of a category
without any tokens is spread over the others. Documents without words weigh
nothing and are kept with their cell's probability (1 if the cell has no
words). Rows of one id are kept or left together; other columns pass unchanged.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import SPACE_CLASS, Scratch, let, text_or_empty

OTHER_SHARE = 0.02      # of categories that a target does not name


@dataclass(frozen=True)
class Targets:
    """Shares by category; ``budget`` is the share of all tokens to keep."""
    source: dict[str, float]
    language: dict[str, float]
    topic: dict[str, float]
    budget: float = 0.85
    sweeps: int = 60

    def dimensions(self) -> list[dict[str, float]]:
        return [self.source, self.language, self.topic]


# The mixture of the registered query and the pipeline.
TOPIC_MARKS = {"legal": ["rights reserved", "icense", "opyright"], "tabular": [" | "]}
DEFAULT = Targets(
    source={"src0": 0.30, **{f"src{i}": 0.70 / 19 for i in range(1, 20)}},
    language={"en": 0.58, "fr": 0.16, "de": 0.15, "es": 0.11},
    topic={"general": 0.90, "legal": 0.07, "tabular": 0.03},
)


def topic_of(text: Column) -> Column:
    """First topic with a mark in the text, else ``general``."""
    chain = None
    for topic, marks in TOPIC_MARKS.items():
        hit = F.contains(text, F.lit(marks[0]))
        for mark in marks[1:]:
            hit = hit | F.contains(text, F.lit(mark))
        chain = F.when(hit, topic) if chain is None else chain.when(hit, topic)
    return chain.otherwise("general")


def n_words(text: Column) -> Column:
    return F.size(F.array_remove(F.split(text, f"[{SPACE_CLASS}]+"), "")).cast("long")


def _category(value: Column, names: dict[str, float]) -> Column:
    """Number of the category; unnamed and null ones share the last number."""
    numbers = F.create_map(*[x for i, name in enumerate(names) for x in (F.lit(name), F.lit(i))])
    return F.coalesce(F.try_element_at(numbers, value.cast("string")), F.lit(len(names))) if names else F.lit(0)


def _raked(cells: Column, field: str, shares: dict[str, float], total: Column) -> Column:
    """Cells with weights scaled so that each category has its target."""
    wanted = F.array(*[F.lit(float(s)) for s in shares.values()], F.lit(OTHER_SHARE if shares else 1.0))
    sums = F.transform(F.sequence(F.lit(0), F.lit(len(shares))), lambda k: F.aggregate(
        cells, F.lit(0.0), lambda acc, c: acc + F.when(c[field] == k, c["w"]).otherwise(0.0)))

    def scaled(have: Column) -> Column:
        # Targets of categories that have tokens, brought to one in sum.
        live = F.aggregate(F.zip_with(have, wanted, lambda h, t: F.when(h > 0, t).otherwise(0.0)), F.lit(0.0), lambda a, t: a + t)
        return let(live, lambda s: let(
            F.zip_with(have, wanted, lambda h, t: F.when((h > 0) & (s > 0), t / s * total / h).otherwise(1.0)),
            lambda factor: F.transform(cells, lambda c: c.withField("w", c["w"] * F.get(factor, c[field])))))

    return let(sums, scaled)


def fitted(cells: DataFrame, targets: Targets) -> DataFrame:
    """(c0, c1, c2, tokens, probability) of (c0, c1, c2, tokens) rows, whose
    number the targets bound."""
    dims = targets.dimensions()
    one = cells.agg(F.array_sort(F.collect_list(F.struct("c0", "c1", "c2", F.col("tokens").cast("double").alias("tokens"),
                                                         F.col("tokens").cast("double").alias("w")))).alias("cells"))
    one = one.withColumn("total", F.aggregate("cells", F.lit(0.0), lambda a, c: a + c["tokens"]) * F.lit(targets.budget))

    def rake_one(name: str, shares: dict[str, float]):
        return lambda x: _raked(x, name, shares, F.col("total"))

    def sweep(c: Column) -> Column:
        for i, shares in enumerate(dims):
            c = let(c, rake_one(f"c{i}", shares))
        return F.transform(c, lambda x: x.withField("w", F.least(x["w"], x["tokens"])))

    done = one.select(F.aggregate(F.sequence(F.lit(1), F.lit(targets.sweeps)), F.col("cells"), lambda c, _: sweep(c)).alias("cells"))
    return done.select(F.inline("cells")).select(
        "c0", "c1", "c2", "tokens", F.when(F.col("tokens") > 0, F.col("w") / F.col("tokens")).otherwise(1.0).alias("probability"))


def chance(id_col: Column, seed: int) -> Column:
    """A uniform number in [0, 1) that id and seed determine."""
    return F.shiftrightunsigned(F.xxhash64(id_col, F.lit(seed)), 11) / F.lit(float(2**53))


def _cells(targets: Targets, source: Column, language: Column, topic: Column) -> list[Column]:
    return [_category(v, names).alias(f"c{i}") for i, (v, names) in enumerate(zip((source, language, topic), targets.dimensions()))]


def probabilities(docs: DataFrame, targets: Targets = DEFAULT, text_col: str = "text", source: Column | None = None,
                  language: Column | None = None, topic: Column | None = None) -> DataFrame:
    """The fitted cells of ``docs`` (see ``fitted``), stored."""
    scratch = Scratch(docs.sparkSession, "mix")
    text = text_or_empty(text_col)
    parts = _cells(targets, *_columns(source, language, topic, text))
    sums = docs.select(*parts, n_words(text).alias("n")).groupBy("c0", "c1", "c2").agg(F.sum("n").alias("tokens"))
    return scratch.save(fitted(sums, targets), "cells")


def _columns(source, language, topic, text) -> tuple[Column, Column, Column]:
    return (F.col("source") if source is None else source, F.col("lang") if language is None else language,
            topic_of(text) if topic is None else topic)


def mixed(docs: DataFrame, targets: Targets = DEFAULT, id_col: str = "doc_id", text_col: str = "text", seed: int = 5,
          **columns: Column) -> DataFrame:
    """Per row: doc_id, source, language, topic (category or null for the
    further one), n_tokens, probability, kept."""
    cells = probabilities(docs, targets, text_col, **columns)
    text = text_or_empty(text_col)
    parts = _cells(targets, *_columns(columns.get("source"), columns.get("language"), columns.get("topic"), text))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), *parts, n_words(text).alias("n_tokens"))
    names = [F.get(F.array(*[F.lit(n) for n in d]), F.col(f"c{i}")).alias(a)
             for i, (d, a) in enumerate(zip(targets.dimensions(), ("source", "language", "topic")))]
    return rows.join(F.broadcast(cells.drop("tokens")), ["c0", "c1", "c2"]).select(
        "doc_id", *names, "n_tokens", "probability", (chance(F.col("doc_id"), seed) < F.col("probability")).alias("kept"))


def sampled(docs: DataFrame, targets: Targets = DEFAULT, id_col: str = "doc_id", text_col: str = "text", seed: int = 5) -> DataFrame:
    """The kept rows of ``docs``, unchanged."""
    cells = probabilities(docs, targets, text_col).select(
        F.struct("c0", "c1", "c2").alias("__cell"), F.col("probability").alias("__probability"))
    parts = _cells(targets, *_columns(None, None, None, text_or_empty(text_col)))
    rows = docs.withColumn("__cell", F.struct(*parts)).join(F.broadcast(cells), "__cell")
    return rows.where(chance(F.col(id_col).cast("long"), seed) < F.col("__probability")).select(*docs.columns)
