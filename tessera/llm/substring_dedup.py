"""Removal of repeated passages by doubling of windows.

A window of ``length`` words can repeat only if the windows of half that length
inside it repeat. So the first level looks at half-length windows, and only
where one repeats across documents are the windows of the full length formed
and compared. These two levels stand for the loop: ``length`` is what is judged,
and a level in between could only drop candidates earlier.

The first level need not look at every half-length window: of those inside a
full window only the one with the smallest hash is taken, which is the same one
wherever the full window stands. That is a quarter of all windows, and a full
window whose taken half is unique is unique itself.

Rows that cross the network are (hash, id) pairs, reduced per task to the
smallest and largest id first, so a passage of a third of all documents costs a
row per task. Joins on hashes hold no more than that and are split when skewed.
Candidates of the first level pass a Bloom filter of fixed maximal size before
they are joined. Texts are shuffled only for documents that hold candidates,
as long as their ids are few enough to broadcast, else all are.

Null texts count as empty. Rows of one id are one document: none removes words
of another. A document without an id counts as the last one. Windows are told
apart by 64-bit hash. Further columns are ignored.
"""

from __future__ import annotations

from hashlib import sha256
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import BROADCAST_ROWS, Scratch
from tessera.llm.url_filter import filter_blocks, possible_hits
from tessera.llm.wordhash import text_blocks, window_hashes, word_hashes, words

_LAST = 2**63 - 1
BLOOM_BLOCKS = 1 << 17


def _level_hashes(hashes: np.ndarray, half: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Of every full window: its own hash and the smallest of its halves'."""
    full = window_hashes(hashes, length)
    parts = window_hashes(hashes, half)
    least = parts[:len(full)].copy()
    for k in range(1, length - half + 1):
        np.minimum(least, parts[k:k + len(full)], out=least)
    return full, least


def _anchors(docs: DataFrame, half: int, length: int) -> DataFrame:
    """Per row (key, anchors): the taken half-length windows."""
    def run(batches):
        for batch in batches:
            keys = batch.column(0)
            for lo, hi, data, offsets in text_blocks(batch.column(1)):
                starts, ends, first = words(data, offsets)
                _, least = _level_hashes(word_hashes(data, starts, ends, fold=False), half, length)
                place = np.arange(len(least))
                owner = np.searchsorted(first, place, side="right") - 1
                inside = place + length <= first[np.minimum(owner + 1, len(first) - 1)]
                new = inside.copy()
                new[1:] &= (least[1:] != least[:-1]) | (owner[1:] != owner[:-1]) | ~inside[:-1]
                at = np.flatnonzero(new)
                bounds = np.searchsorted(owner[at], np.arange(hi - lo + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(least[at].view(np.int64)))
                yield pa.RecordBatch.from_arrays([keys.slice(lo, hi - lo), lists], names=["key", "anchors"])

    return docs.mapInArrow(run, "key long, anchors array<long>")


def _windows(docs: DataFrame, half: int, length: int) -> DataFrame:
    """Per (key, text, survivors, mark) row the full windows whose taken half
    is among ``survivors``: parallel arrays of start and hash."""
    def run(batches):
        for batch in batches:
            for lo, hi, data, offsets in text_blocks(batch.column(1)):
                starts, ends, first = words(data, offsets)
                full, least = _level_hashes(word_hashes(data, starts, ends, fold=False), half, length)
                full, least = full.view(np.int64), least.view(np.int64)
                survivors = batch.column(2).slice(lo, hi - lo)
                places, found = [], []
                for i in range(hi - lo):
                    a, b = int(first[i]), int(first[i + 1]) - length + 1
                    keep = np.flatnonzero(np.isin(least[a:max(a, b)], survivors[i].values.to_numpy()))
                    places.append(keep.astype(np.int32))
                    found.append(full[a + keep])
                bounds = pa.array(np.cumsum([0, *map(len, places)]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), batch.column(3).slice(lo, hi - lo),
                     pa.ListArray.from_arrays(bounds, pa.array(np.concatenate(places))),
                     pa.ListArray.from_arrays(bounds, pa.array(np.concatenate(found)))], names=["key", "mark", "starts", "hashes"])

    return docs.mapInArrow(run, "key long, mark long, starts array<int>, hashes array<long>")


def _without(docs: DataFrame, length: int) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of (doc_id, text, starts)
    rows; ``starts`` (may be null) are the windows to remove."""
    def run(batches):
        for batch in batches:
            out: list[tuple[int, int, str]] = []
            for text, starts in zip(batch.column(1), batch.column(2)):
                found = (text.as_py() or "").encode().split()
                removed = 0
                total = len(found)
                if starts.is_valid and len(starts.values):
                    at = starts.values.to_numpy()
                    cover = np.zeros(total + 1, np.int64)
                    np.add.at(cover, at, 1)
                    np.add.at(cover, at + length, -1)
                    kept = np.cumsum(cover)[:total] == 0
                    removed = int(total - kept.sum())
                    found = list(compress(found, kept.tolist()))
                out.append((total, removed, sha256(b" ".join(found)).hexdigest()))
            n, r, h = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(r, pa.int64()), pa.array(h, pa.string())],
                                             names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    return docs.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def _repeated(rows: DataFrame) -> DataFrame:
    """(hash, first): hashes that occur under two ids, with the smaller id."""
    return (rows.groupBy("hash").agg(F.min("key").alias("first"), F.max("key").alias("last"))
            .where("first < last").select("hash", "first"))


def repeated_windows(docs: DataFrame, scratch: Scratch, length: int, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(key, mark, starts): starts of the windows of (key, text, mark) rows that
    also stand in a document with a smaller key. ``mark`` tells texts of one
    key apart."""
    half = (length + 1) // 2
    anchors = scratch.save(_anchors(docs.select("key", "text"), half, length), "anchors")
    singles = anchors.select("key", F.explode("anchors").alias("hash"))
    halves = scratch.save(_repeated(singles), "halves")
    n = halves.count()
    empty = docs.sparkSession.createDataFrame([], "key long, mark long, starts array<int>")
    if n == 0:
        return empty
    blocks, n_blocks = filter_blocks(halves.select(F.col("hash").alias("key")), n, BLOOM_BLOCKS)
    hits = possible_hits(singles, "hash", scratch.save(blocks, "bloom"), n_blocks).where("possible").select("key", "hash")
    survivors = scratch.save(hits.join(halves.select("hash"), "hash").groupBy("key").agg(F.collect_set("hash").alias("survivors")), "survivors")
    scratch.drop("anchors", "halves")
    texts = docs
    if survivors.count() <= broadcast_rows:
        texts = docs.join(F.broadcast(survivors.select("key")), "key", "left_semi")
    full = scratch.save(_windows(texts.join(survivors, "key").select("key", "text", "survivors", "mark"), half, length), "windows")
    singles = full.select("key", F.explode("hashes").alias("hash"))
    twice = scratch.save(_repeated(singles), f"repeated-{length}")
    placed = full.select("key", "mark", F.explode(F.arrays_zip("starts", "hashes")).alias("w")).select("key", "mark", "w.starts", F.col("w.hashes").alias("hash"))
    return scratch.save(placed.join(twice, "hash").where("key > first").groupBy("key", "mark").agg(F.collect_set("starts").alias("starts")), "removals")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 13,
                   broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept_sha256 (of the
    kept words joined by one space)."""
    scratch = Scratch(docs.sparkSession, "repeats")
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST))
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), key.alias("key"), text.alias("text"), F.xxhash64(text).alias("mark"))
    removals = repeated_windows(rows.select("key", "text", "mark"), scratch, length, broadcast_rows)
    none = F.lit(None).cast("array<int>")
    if removals.count() <= broadcast_rows:
        ids = F.broadcast(removals.select("key", "mark"))
        touched = rows.join(ids, ["key", "mark"], "left_semi").join(removals, ["key", "mark"])
        untouched = rows.join(ids, ["key", "mark"], "left_anti").withColumn("starts", none)
        return _without(touched.select("doc_id", "text", "starts"), length).union(_without(untouched.select("doc_id", "text", "starts"), length))
    return _without(rows.join(removals, ["key", "mark"], "left").select("doc_id", "text", "starts"), length)
