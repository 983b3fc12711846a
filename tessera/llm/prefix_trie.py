"""The prefix trie of conversations, summed over subtrees by an Euler tour.

1. Turns get their place in their conversation; conversations are rebuilt on
   the first turns of their group's base.
2. A node is a distinct sequence of first turns. Sequences are told apart by
   their length and four running sums of 32-bit digests of (place, role, text),
   128 bits in all. A node is named by its smallest member and its depth.
3. Every node has an enter and an exit arc. An enter arc is followed by the
   enter arc of the node's first child, else by its own exit arc; an exit arc by
   the enter arc of the next sibling, else by the parent's exit arc.
4. List ranking gives each arc's place in the tour. A subtree is what lies
   between a node's arcs, so its leaves and savings are differences of prefix
   sums at their places.

Conversations, nodes and children are never gathered in one task: places,
siblings and prefix sums come from tables dealt by ranges (``ordered``), and
digests of members are hashed from packed chunks, in order, in one pass.

Defined results: a null turn comes first; null roles and texts are empty; turns
that tie are ordered by role, then by the text's MD5, and repeated rows are
turns of their own. Rows without a conv_id belong to no conversation and are
left out. No conversations give no rows. Further columns are ignored.
"""

from __future__ import annotations

from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Scratch, maybe_broadcast, split_words
from tessera.llm.ordered import SMALL_LIST, list_ranks, next_rows, running_sums

GROUP = 20          # conversations of a group share its base's first turns
HEADS = 4           # fewer than so many
LANES = ("s0", "s1", "s2", "s3")
CHUNK = 4096        # members packed into one row before they are hashed


def turns_in_order(rows: DataFrame, scratch: Scratch, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv, place, content, words) of every turn: its place from 1 on, the
    digest of role and text, and the number of words."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    turns = rows.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).cast("long").alias("turn"), role.alias("role"),
        F.md5(text.cast("binary")).alias("text_md5"),
        F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")).alias("content"),
        F.size(split_words(text)).cast("long").alias("words"))
    placed = running_sums(turns, scratch, "turns", ["conv"], ["turn", "role", "text_md5"], {"place": F.lit(1).cast("long")})
    return scratch.save(placed.select("conv", "place", "content", "words"), "turns")


def head_length(conv):
    """Turns that a conversation takes from its base: crc32 of its decimal id."""
    return (F.crc32(conv.cast("string").cast("binary")) % HEADS).cast("long")


def rebuilt(turns: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Turns after rebuilding, and all conversations (conv)."""
    lengths = scratch.save(turns.groupBy("conv").agg(F.max("place").alias("own")), "lengths")
    convs = lengths.select("conv", (F.col("conv") - F.col("conv") % GROUP).alias("base"), head_length(F.col("conv")).alias("h"))
    heads = turns.where((F.col("conv") % GROUP == 0) & (F.col("place") < HEADS)).select(F.col("conv").alias("base"), "place", "content", "words")
    taken = convs.where("h > 0").join(heads, "base").where("place <= h").select("conv", "place", "content", "words")
    bases = lengths.where(F.col("conv") % GROUP == 0).select(F.col("conv").alias("base"), F.least("own", F.lit(HEADS)).alias("n"))
    # Conversations whose base is shorter than the head: what follows moves up.
    short = scratch.save(convs.where("h > 0").join(bases, "base", "left").where("coalesce(n, 0) < h")
                         .select(F.col("conv").alias("short"), (F.col("h") - F.coalesce("n", F.lit(0))).alias("less")), "short")
    own = turns.where(F.col("place") > head_length(F.col("conv")))
    own = own.join(maybe_broadcast(short), own["conv"] == short["short"], "left").select(
        "conv", (F.col("place") - F.coalesce("less", F.lit(0))).alias("place"), "content", "words")
    return scratch.save(taken.union(own), "rebuilt"), lengths.select("conv")


def trie_nodes(turns: DataFrame, convs: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Nodes (conv, depth, parent, n_convs, words) and, for every conversation,
    the node at which it ends (conv, depth, member)."""
    lane = F.md5(F.concat_ws(":", F.col("place").cast("string"), "content").cast("binary"))
    sums = {s: F.conv(F.substring(lane, 8 * k + 1, 8), 16, 10).cast("long") for k, s in enumerate(LANES)}
    paths = running_sums(turns.withColumn("last", lane), scratch, "paths", ["conv"], ["place"], sums)
    before = [(F.col(s) - F.conv(F.substring("last", 8 * k + 1, 8), 16, 10).cast("long")).alias(f"p{k}") for k, s in enumerate(LANES)]
    none = [F.lit(0).cast("long") for _ in LANES]
    paths = scratch.save(paths.select("conv", F.col("place").alias("depth"), "words", *LANES, *before).union(
        convs.select("conv", F.lit(0).cast("long"), F.lit(0).cast("long"), *none, *none)), "paths")
    nodes = scratch.save(paths.groupBy("depth", *LANES).agg(
        F.min("conv").alias("conv"), F.count("*").alias("n_convs"), F.max("words").alias("words"),
        *[F.max(f"p{k}").alias(f"p{k}") for k in range(len(LANES))]), "sequences")
    above = nodes.select(F.col("conv").alias("parent"), (F.col("depth") + 1).alias("u"), *[F.col(s).alias(f"u{k}") for k, s in enumerate(LANES)])
    same = [nodes["depth"] == above["u"], *[nodes[f"p{k}"] == above[f"u{k}"] for k in range(len(LANES))]]
    named = nodes.where("depth > 0").join(maybe_broadcast(above, limit=SMALL_LIST // 2), same).select("conv", "depth", "parent", "n_convs", "words", *LANES)
    named = scratch.save(named.union(nodes.where("depth = 0").select("conv", "depth", F.lit(None).cast("long"), "n_convs", "words", *LANES)), "nodes")
    last = paths.groupBy(F.col("conv").alias("member")).agg(F.max(F.struct("depth", *LANES)).alias("end")).select("member", "end.*")
    ended = last.join(named.select("conv", "depth", *LANES), ["depth", *LANES]).select("conv", "depth", "member")
    return named.drop(*LANES), scratch.save(ended, "ended")


def euler_tour(nodes: DataFrame, scratch: Scratch, small: int) -> DataFrame:
    """(conv, depth, n_children, n_leaves, saved_tokens) of every node.

    Arcs are named (a, b): the enter arc of (conv, depth) is itself, the exit
    arc (conv, -1 - depth).
    """
    sibling = next_rows(nodes.where("depth > 0").select("conv", "depth", "parent"), scratch, "siblings", ["parent", "depth"], "conv", "after")
    sibling = scratch.save(sibling, "siblings")
    children = nodes.where("depth > 0").groupBy(F.col("parent").alias("conv"), (F.col("depth") - 1).alias("depth")).agg(
        F.min("conv").alias("first"), F.count("*").alias("n_children"))
    children = scratch.save(nodes.join(children, ["conv", "depth"], "left").select(
        "conv", "depth", "first", F.coalesce("n_children", F.lit(0)).alias("n_children"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved")), "children")
    out = F.lit(-1) - F.col("depth")
    leaf = F.col("n_children") == 0
    enter = children.select(
        F.col("conv").alias("a"), F.col("depth").alias("b"),
        F.when(leaf, F.col("conv")).otherwise(F.col("first")).alias("next_a"), F.when(leaf, out).otherwise(F.col("depth") + 1).alias("next_b"))
    last = F.col("after").isNull()
    leave = sibling.select(
        F.col("conv").alias("a"), out.alias("b"),
        F.when(last, F.col("parent")).otherwise(F.col("after")).alias("next_a"), F.when(last, -F.col("depth")).otherwise(F.col("depth")).alias("next_b"))
    end = nodes.where("depth = 0").select(F.col("conv").alias("a"), F.lit(-1).cast("long").alias("b"), F.lit(None).cast("long"), F.lit(None).cast("long"))
    ranks = list_ranks(enter.union(leave).union(end), scratch, small)
    at = ranks.select(F.col("a").alias("conv"), F.when(F.col("b") < 0, -1 - F.col("b")).otherwise(F.col("b")).alias("depth"),
                      (F.col("b") >= 0).alias("enter"), (-F.col("rank")).alias("at"))
    weighed = at.join(children, ["conv", "depth"], "left").select(
        "conv", "depth", "enter", "at", F.when(F.col("enter") & leaf, 1).otherwise(0).cast("long").alias("leaves"),
        F.when(F.col("enter"), F.col("saved")).otherwise(0).alias("saved"))
    sums = running_sums(weighed, scratch, "tour", [], ["at"], {"n": F.col("leaves"), "s": F.col("saved")})
    # Between the arcs: the sum at the exit less what came before the enter arc.
    sign = lambda c, own: F.sum(F.when(F.col("enter"), F.col(own) - F.col(c)).otherwise(F.col(c)))
    subtrees = scratch.save(sums.groupBy("conv", "depth").agg(sign("n", "leaves").alias("n_leaves"), sign("s", "saved").alias("saved_tokens")), "subtrees")
    return children.select("conv", "depth", "n_children").join(subtrees, ["conv", "depth"])


def member_digests(ended: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv, depth, ends_sha256) of nodes at which conversations end. Members
    are packed in order, CHUNK to a row; a node's rows then follow each other in
    one task, which keeps one running digest."""
    numbered = running_sums(ended, scratch, "ended", ["conv", "depth"], ["member"], {"n": F.lit(1).cast("long")})
    chunks = numbered.groupBy("conv", "depth", F.floor((F.col("n") - 1) / CHUNK).alias("chunk")).agg(
        F.array_join(F.sort_array(F.collect_list("member")), ",").alias("members"))

    def run(batches):
        held, sha = None, None
        for batch in batches:
            done: list[tuple] = []
            for conv, depth, _, members in zip(*(c.to_pylist() for c in batch.columns)):
                if held == (conv, depth):
                    sha.update(b"," + members.encode())
                    continue
                if held:
                    done.append((*held, sha.hexdigest()))
                held, sha = (conv, depth), sha256(members.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=["conv", "depth", "ends_sha256"])
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([held[0]]), pa.array([held[1]]), pa.array([sha.hexdigest()])],
                                             names=["conv", "depth", "ends_sha256"])

    chunks = chunks.repartition("conv", "depth").sortWithinPartitions("conv", "depth", "chunk").select("conv", "depth", "chunk", "members")
    return scratch.save(chunks.mapInArrow(run, "conv long, depth long, ends_sha256 string"), "digests")


def prefix_trie(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
                small: int = SMALL_LIST) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256."""
    scratch = Scratch(rows.sparkSession, "trie")
    turns, convs = rebuilt(turns_in_order(rows, scratch, conv_col, turn_col, role_col, text_col), scratch)
    nodes, ended = trie_nodes(turns, convs, scratch)
    tour = euler_tour(nodes, scratch, small)
    digests = member_digests(ended, scratch)
    out = nodes.join(tour, ["conv", "depth"]).join(digests, ["conv", "depth"], "left")
    return out.select(F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
                      "saved_tokens", F.coalesce("ends_sha256", F.lit(sha256(b"").hexdigest())).alias("ends_sha256"))
