"""URL filter: blocked Bloom filter in front of an exact hash join.

Listed URLs are brought to a canonical form and set in a Bloom filter of
256-bit blocks: one hash picks a block, another sets two bits in each of its
four words, so a probe looks at one row. The filter has a fixed maximal size
and is broadcast. Pages it rules out are done; the others are possible hits
and are joined with the list on the whole canonical URL, which removes the
false positives. A longer list than the filter is made for costs more false
positives, never a wrong verdict.

Prefix rules (host suffix and path prefix) come before the list; the longest
rule that fits decides. A null URL, or one without ``://``, has an empty host
and path, fits no rule and is allowed. Rows are judged one by one, repeated
ones alike. Further columns are ignored.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Scratch

BITS_PER_KEY = 16
MAX_BLOCKS = 1 << 16        # 2 MiB of bits; broadcast at most
ALLOW, BLOCK = "allow", "block"
TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid)(=|$)"


@dataclass(frozen=True)
class PrefixRule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    host = F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    url = F.coalesce(url.cast("string"), F.lit(""))
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def canonical(url: Column) -> Column:
    """host + path + query without scheme, ``www.``, fragment, final slash and
    tracking parameters, the other parameters sorted; empty without a host."""
    host = F.regexp_replace(host_of(url), r"^www\.", "")
    query = F.regexp_extract(_after_scheme(url), r"^[^?#]*\?([^#]*)", 1)
    kept = F.array_join(F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING))), "&")
    return F.when(host == "", "").otherwise(F.concat(
        host, F.regexp_replace(path_of(url), "/+$", ""), F.when(kept == "", "").otherwise(F.concat(F.lit("?"), kept))))


def deciding_rule(host: Column, path: Column, rules: list[PrefixRule]) -> Column:
    """Number of the longest rule that fits (of equal lengths the longer host), else null."""
    order = sorted(range(len(rules)), key=lambda i: (-len(rules[i].text), -len(rules[i].host), rules[i].text))
    fits = [F.when(((host == rules[i].host) | host.endswith("." + rules[i].host)) & path.startswith(rules[i].path), i) for i in order]
    return F.coalesce(*fits) if fits else F.lit(None).cast("int")


def _bits(key: Column) -> list[Column]:
    """Masks of the four 64-bit words of a block that belong to a key."""
    bits = F.xxhash64(key, F.lit(1))
    one = F.lit(1).cast("long")
    return [F.call_function("shiftleft", one, F.shiftrightunsigned(bits, 12 * w).bitwiseAND(63).cast("int")).bitwiseOR(
        F.call_function("shiftleft", one, F.shiftrightunsigned(bits, 12 * w + 6).bitwiseAND(63).cast("int"))) for w in range(4)]


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def filter_blocks(listed: DataFrame, n_listed: int, max_blocks: int = MAX_BLOCKS) -> tuple[DataFrame, int]:
    """(block, w0..w3) of the listed keys, and the number of blocks: a power of
    two, ``max_blocks`` at most, whatever the list's length."""
    blocks = 1
    while blocks < max_blocks and blocks * 256 < n_listed * BITS_PER_KEY:
        blocks *= 2
    masks = listed.select(_block(F.col("key"), blocks).alias("block"), *[m.alias(f"m{w}") for w, m in enumerate(_bits(F.col("key")))])
    return masks.groupBy("block").agg(*[F.bit_or(f"m{w}").alias(f"w{w}") for w in range(4)]), blocks


def possible_hits(rows: DataFrame, key: str, blocks: DataFrame, n_blocks: int) -> DataFrame:
    """``rows`` with a boolean column ``possible``: the filter's answer for ``key``."""
    probed = rows.withColumn("block", _block(F.col(key), n_blocks)).join(F.broadcast(blocks), "block", "left")
    hit = F.lit(True)
    for w, mask in enumerate(_bits(F.col(key))):
        hit = hit & (F.col(f"w{w}").bitwiseAND(mask) == mask)
    return probed.withColumn("possible", F.coalesce(hit, F.lit(False))).drop("block", *[f"w{w}" for w in range(4)])


def judge_urls(pages: DataFrame, listed: DataFrame, rules: list[PrefixRule], id_col: str = "page_id", url_col: str = "url",
               listed_col: str = "url", max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, listed (whether its
    canonical URL is in the list). ``listed`` holds URLs in any form."""
    scratch = Scratch(pages.sparkSession, "urls")
    keys = scratch.save(listed.select(canonical(F.col(listed_col)).alias("key")).where("key <> ''").distinct(), "listed")
    blocks, n_blocks = filter_blocks(keys, keys.count(), max_blocks)
    blocks = scratch.save(blocks, "filter")

    url = F.col(url_col)
    rows = pages.select(F.col(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"), canonical(url).alias("key"))
    rows = scratch.save(possible_hits(rows, "key", blocks, n_blocks), "probed")
    exact = rows.where("possible").join(keys.withColumn("found", F.lit(True)).hint("shuffle_hash"), "key", "left")
    told = rows.where("not possible").withColumn("found", F.lit(False)).unionByName(exact)
    number = deciding_rule(F.col("host"), F.col("path"), rules)
    pick = lambda values: F.get(F.array(*[F.lit(v) for v in values]), F.col("n")) if rules else F.lit(None).cast("string")
    return told.withColumn("n", number).select(
        "page_id", "host", "path", pick([r.text for r in rules]).alias("rule"),
        F.coalesce(pick([r.verdict for r in rules]), F.when(F.col("found"), BLOCK).otherwise(ALLOW)).alias("verdict"),
        F.coalesce("found", F.lit(False)).alias("listed"))
