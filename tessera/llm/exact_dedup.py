"""Exact deduplication by deterministic block naming (DataFrame functions only).

Texts are cut into blocks of a fixed number of code points. The distinct blocks
are sorted and numbered: a block's name is an integer and two blocks have the
same name only if they are the same block. Then names of adjacent blocks are
paired, the distinct pairs sorted and numbered, and so on; each level halves a
text's names until one is left. That name together with the number of blocks
identifies the text without any chance of collision.

Texts cross the network once, as distinct blocks (reduced before the shuffle,
so a block of a third of all rows costs one row per task). A row's blocks find
their names by 64-bit hash; hashes that stand for two different blocks are
detected and those blocks are named by their text. A hot name is split by the
skew handling of the joins.

A null text counts as empty; an empty text is one empty block. Texts are equal
when identical after replacing each run of white space by one space. Of equal
texts the smallest id stays (all rows of that id, if it repeats); a row without
an id stays only if no row of its text has one. Further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Scratch, let, text_or_empty

BLOCK = 1024
OTHER_SPACES = "\t\n\v\f\r"    # with the space, all of SPACE_CLASS


def normalised(text_col: str) -> Column:
    """Each run of white space as one space. Single characters are replaced
    without a regular expression; only texts with a run of spaces need one."""
    text = text_or_empty(text_col)
    for c in OTHER_SPACES:
        text = F.replace(text, F.lit(c), F.lit(" "))
    return let(text, lambda t: F.when(F.contains(t, F.lit("  ")), F.regexp_replace(t, " {2,}", " ")).otherwise(t))


def cut_blocks(text: Column, size: int) -> Column:
    """Array of the consecutive blocks of ``size`` code points (the last is
    shorter); an empty text has one empty block."""
    return let(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{size}}}"), F.lit(0)),
               lambda b: F.when(F.size(b) == 0, F.array(F.lit(""))).otherwise(b))


def _numbered(distinct: DataFrame, *keys: str) -> DataFrame:
    """Distinct rows, sorted within their partition and numbered: integers that
    are unique over all partitions."""
    return distinct.sortWithinPartitions(*keys).withColumn("name", F.monotonically_increasing_id())


def identities(docs: DataFrame, scratch: Scratch, id_col: str, text_col: str, block: int = BLOCK,
               hash_of=F.xxhash64) -> DataFrame:
    """(row_id, doc_id, text_sha256, n_blocks, name) per row; equal texts have
    equal (n_blocks, name)."""
    norm = docs.select(F.col(id_col).cast("long").alias("doc_id"), normalised(text_col).alias("norm"))
    blocks_of = cut_blocks(F.col("norm"), block)

    def stored_rows(with_blocks: bool, step: str) -> DataFrame:
        found = norm.select("doc_id", F.sha2("norm", 256).alias("text_sha256"),
                            F.transform(blocks_of, lambda b: hash_of(b)).alias("hashes"),
                            *[blocks_of.alias("blocks")] * with_blocks)
        return scratch.save(found.withColumn("row_id", F.monotonically_increasing_id()), step)

    rows = stored_rows(False, "rows")
    distinct = norm.select(F.explode(blocks_of).alias("block")).select(hash_of("block").alias("hash"), "block").distinct()
    # The names are a small part of the blocks' bytes: gathered into few files. A
    # task that writes a file starts processes where Hadoop's native library is missing.
    names = scratch.save(_numbered(distinct, "block").select("hash", "name").hint("rebalance"), "names-0")
    clashes = names.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash")
    at = ("row_id", F.size("hashes").alias("n_blocks"))
    if clashes.isEmpty():
        cells = rows.select(*at, F.posexplode("hashes").alias("pos", "hash")).join(names, "hash")
    else:  # some hash stands for two blocks: join on the blocks themselves
        rows = stored_rows(True, "rows-with-blocks")
        names = scratch.save(_numbered(rows.select(F.explode("blocks").alias("block")).distinct(), "block"), "names-exact")
        cells = rows.select(*at, F.posexplode("blocks").alias("pos", "block")).join(names, "block")
    cells = scratch.save(cells.select("row_id", "n_blocks", "pos", "name"), "cells-0")
    level, finished = 0, []
    while True:
        finished.append(cells.where("n_blocks <= 1").select("row_id", "name"))
        longer = cells.where("n_blocks > 1")
        if longer.isEmpty():
            break
        first, second = (F.max(F.when(F.col("pos") % 2 == k, F.col("name"))) for k in (0, 1))
        # Not stored: the stored cells give the same pairs each time.
        pairs = longer.groupBy("row_id", F.floor(F.col("pos") / 2).cast("int").alias("pos")).agg(
            F.max("n_blocks").alias("n_blocks"), first.alias("first"), F.coalesce(second, F.lit(-1)).alias("second"))
        level += 1
        names = scratch.save(_numbered(pairs.select("first", "second").distinct(), "first", "second"), f"names-{level}")
        cells = scratch.save(pairs.join(names, ["first", "second"]).select(
            "row_id", F.ceil(F.col("n_blocks") / 2).cast("int").alias("n_blocks"), "pos", "name"), f"cells-{level}")
        scratch.drop(f"names-{level}")
    last = finished[0]
    for more in finished[1:]:
        last = last.union(more)
    return scratch.save(rows.select("row_id", "doc_id", "text_sha256", F.size("hashes").alias("n_blocks"))
                        .join(last, "row_id"), "identities")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK,
                     hash_of=F.xxhash64) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    scratch = Scratch(docs.sparkSession, "exact")
    table = identities(docs, scratch, id_col, text_col, block, hash_of)
    groups = table.groupBy("n_blocks", "name").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    groups = scratch.save(groups, "groups")     # stored, so that the join can split a large group's rows
    return table.join(groups, ["n_blocks", "name"]).select(
        "doc_id", "keep_id", "group_size",
        F.coalesce(F.col("doc_id") == F.col("keep_id"), F.col("keep_id").isNull()).alias("kept"), "text_sha256")
