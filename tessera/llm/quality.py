"""Quality rules as a short-circuit cascade (DataFrame functions only).

Every rule is a column expression that rejects a text. On a sample of bounded
size each rule is run alone: its time is its cost, its share of rejected rows
its selectivity. The rules are then chained in one CASE expression by rejected
rows per second, so a cheap rule that rejects much spares the others their
work. The order decides the time only; a text is kept if no rule rejects it, so
the verdicts are the same in any order.

A null text counts as empty. Rows are judged one by one: ties, repeated rows
and further columns change nothing.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import SPACE_CLASS, Scratch, let, text_or_empty

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SAMPLE_ROWS = 2000
SYMBOLS = r"[#*$%&|<>]"


@dataclass(frozen=True)
class Parts:
    """What rules can look at: the text, its words, its lines with a word."""
    text: Column
    words: Column
    lines: Column

    def length_without(self, pattern: str) -> Column:
        return F.length(F.regexp_replace(self.text, pattern, ""))

    def count(self, pattern: str) -> Column:
        """Characters of a one-character pattern."""
        return F.length(self.text) - self.length_without(pattern)

    @property
    def n_words(self) -> Column:
        return F.size(self.words).cast("long")

    @property
    def word_chars(self) -> Column:
        return F.length(F.array_join(self.words, "")).cast("long")

    @property
    def n_dup_lines(self) -> Column:
        return (F.size(self.lines) - F.size(F.array_distinct(self.lines))).cast("long")

    @property
    def n_repeat_words(self) -> Column:
        """Words inside 3-word windows that the text has twice or more.

        Windows are compared by 64-bit hash: sorted together with their place,
        equal ones are neighbours, so the work is n log n in the words.
        """
        def covered(hashes: Column) -> Column:
            placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
            return let(placed, lambda p: let(
                F.filter(F.transform(p, lambda x, j: F.when(
                    (F.get(p, j - 1)["h"] == x["h"]) | (F.get(p, j + 1)["h"] == x["h"]), x["i"])), lambda i: i.isNotNull()),
                lambda at: F.size(F.array_distinct(F.concat(at, F.transform(at, lambda i: i + 1), F.transform(at, lambda i: i + 2))))))

        windows = let(self.words, lambda w: F.transform(
            F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(w[i], w[i + 1], w[i + 2])))
        found = let(windows, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(0))
        return F.when(F.size(self.words) >= 3, found).otherwise(0).cast("long")


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Parts], Column]


# Thresholds of the method's own rules. They take shares, so no rule depends on
# a text's length, and all lie well outside what ordinary prose reaches.
RULES = (
    Rule("symbols", lambda p: p.count(SYMBOLS) * 10 > F.size(p.words)),
    Rule("capitals", lambda p: p.count(r"\p{Lu}") * 10 > p.word_chars * 3),
    Rule("exclamations", lambda p: p.count("!") * 2 > F.size(p.words)),
    Rule("repeated_lines", lambda p: p.n_dup_lines * 2 > F.size(p.lines)),
    Rule("word_length", lambda p: (p.word_chars < F.size(p.words) * 2) | (p.word_chars > F.size(p.words) * 12)),
    Rule("letters", lambda p: p.count(r"\p{L}") * 2 < p.word_chars),
    Rule("ellipses", lambda p: F.size(F.filter(p.lines, lambda x: x.rlike(r"(\.\.\.|…)[\x20\x09-\x0D]*$"))) * 2 > F.size(p.lines)),
)


def with_parts(text: Column, body: Callable[[Parts], Column]) -> Column:
    """``body`` over a text's parts, each computed once."""
    words = lambda t: F.array_remove(F.split(t, f"[{SPACE_CLASS}]+"), "")
    lines = lambda t: F.filter(F.split(t, "\n"), lambda x: x.rlike(f"[^{SPACE_CLASS}]"))
    return let(text, lambda t: let(words(t), lambda w: let(lines(t), lambda ls: body(Parts(t, w, ls)))))


def cascade(parts: Parts, rules) -> Column:
    """Number (from 1) of the first rule in order that rejects, else 0. Rules
    after it are not evaluated."""
    if not rules:
        return F.lit(0)
    chain = F.when(rules[0].rejects(parts), 1)
    for n, rule in enumerate(rules[1:], 2):
        chain = chain.when(rule.rejects(parts), n)
    return chain.otherwise(0)


@dataclass(frozen=True)
class Estimate:
    rule: Rule
    seconds: float
    rejected: int
    rows: int

    @property
    def worth(self) -> float:
        """Rejected rows per second; rules that reject nothing come last, cheap first."""
        return self.rejected / max(self.seconds, 1e-6) if self.rejected else -self.seconds


def estimate_rules(docs: DataFrame, text_col: str, rules=RULES, sample_rows: int = SAMPLE_ROWS, seed: int = 11) -> list[Estimate]:
    """Time and rejections of each rule alone on about ``sample_rows`` rows."""
    total = docs.count()
    sample = docs.select(text_or_empty(text_col).alias("text")).sample(fraction=min(1.0, sample_rows / max(total, 1)), seed=seed)
    sample = Scratch(docs.sparkSession, "rule-sample").save(sample, "texts")

    def run(rules_: tuple) -> tuple[float, int, int]:
        began = time.perf_counter()
        got = sample.select(with_parts(F.col("text"), lambda p: cascade(p, rules_)).alias("r")).agg(
            F.count_if(F.col("r") > 0), F.count("*")).first()
        return time.perf_counter() - began, got[0], got[1]

    run(())     # compiles and reads; not counted
    floor = run(())[0]
    out = []
    for rule in rules:
        seconds, rejected, rows = run((rule,))
        out.append(Estimate(rule, max(seconds - floor, 1e-3), rejected, rows))
    return out


def order_rules(estimates: list[Estimate]) -> list[Rule]:
    return [e.rule for e in sorted(estimates, key=lambda e: (-e.worth, e.rule.name))]


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < MIN_WORDS) | (n_repeat_words * 100 > n_words * MAX_REPEAT_PERCENT)


def judged(docs: DataFrame, text_col: str = "text", rules=RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` with a struct column ``quality``: n_words, word_chars,
    n_symbols, n_dup_lines, n_repeat_words, base_failed, kept."""
    ordered = order_rules(estimate_rules(docs, text_col, rules, sample_rows))

    def measures(p: Parts) -> Column:
        first = F.struct(p.n_words.alias("n_words"), p.word_chars.alias("word_chars"),
                         p.count(SYMBOLS).cast("long").alias("n_symbols"), p.n_dup_lines.alias("n_dup_lines"),
                         p.n_repeat_words.alias("n_repeat_words"))
        return let(first, lambda f: let(base_failed(f["n_words"], f["n_repeat_words"]), lambda failed: F.struct(
            *[f[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
            failed.alias("base_failed"), F.when(failed, False).otherwise(cascade(p, ordered) == 0).alias("kept"))))

    return docs.withColumn("quality", with_parts(text_or_empty(text_col), measures))


def kept_documents(docs: DataFrame, text_col: str = "text", rules=RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Rows that pass, unchanged. Only the verdict is computed: the base checks
    lead the cascade as its first two rules."""
    ordered = order_rules(estimate_rules(docs, text_col, rules, sample_rows))
    chain = [Rule("few_words", lambda p: p.n_words < MIN_WORDS), *ordered,
             Rule("repeated_words", lambda p: p.n_repeat_words * 100 > p.n_words * MAX_REPEAT_PERCENT)]
    return docs.where(with_parts(text_or_empty(text_col), lambda p: cascade(p, chain)) == 0)
