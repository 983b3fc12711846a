"""MinHash near-duplicate detection with min-max hashing.

Under each permutation both the smallest and the largest value of a set are
kept, so ``permutations`` hash evaluations per shingle give twice as many
signature values. Both are unbiased agreement estimators and, being negatively
correlated, together vary less than two independent minima. The values are
banded; sets that agree in a whole band share a bucket.

1. Every text is hashed once: shingle set, digest of the set, bands and a
   one-byte-per-value sketch are stored. Texts of equal sets are one class,
   stood for by its smallest id, so exact copies never meet in a bucket.
2. Each set is first paired with one centre: the smallest of its buckets'
   smallest ids, so a tight group gets about one link a member however many
   buckets it shares. Pairs whose sketch agreement or sizes rule out the
   threshold are skipped, all others are confirmed on the full sets.
3. Confirmed links give components. A bucket inside one component is settled:
   more links there could not change the result. Every other bucket is taken
   up again: small ones with all pairs across components, large ones with new
   centres, until a round of them finds no link any more.
4. Small sets, for which bands are too coarse, and the sets of large buckets
   that still hold several components are settled exactly, by a prefix filter
   with size and position bounds on the shingles that components share, rarest
   first (``prefix_pairs``): what a whole template has in common stays out.

Null texts count as empty; sets without shingles are linked with nothing. Rows
of one id count as one document. A row without an id belongs to its class but
never stands for it. Further columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import Scratch, maybe_broadcast
from tessera.llm.components import connected_components
from tessera.llm.wordhash import mix, text_blocks, window_hashes, word_hashes, words

SKETCH_SCHEMA = "doc_id long, n_shingles long, digest binary, bands array<long>, sketch binary, small binary"
_HASH_RUN = 1 << 16     # shingles hashed at a time: the run stays in the CPU's cache
_SEED = 7321
SKETCH = 256            # signature values of which one byte each is kept to compare pairs
SMALL_SET = 20          # sets of up to so many shingles are settled exactly


def shingle_sets(column: pa.Array, k: int) -> Iterator[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text, in order. A text of
    fewer than ``k`` words has its whole word sequence as its one shingle."""
    for lo, hi, data, offsets in text_blocks(column):
        starts, ends, first = words(data, offsets)
        hashes = word_hashes(data, starts, ends, fold=True)
        runs = window_hashes(hashes, k)
        for i in range(hi - lo):
            a, b = int(first[i]), int(first[i + 1])
            if b - a >= k:
                yield np.unique(runs[a:b - k + 1])
            elif b > a:
                yield mix(window_hashes(hashes[a:b], b - a) + np.uint64(b - a))
            else:
                yield np.zeros(0, np.uint64)


def min_max_signatures(sets: list[np.ndarray], permutations: int) -> np.ndarray:
    """One row per non-empty set: minimum and maximum under each permutation."""
    rng = np.random.Generator(np.random.PCG64(_SEED))
    keys = rng.integers(0, 2**63, size=(2, permutations), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    out = np.zeros((len(sets), 2 * permutations), np.uint64)
    lo = 0
    while lo < len(sets):
        hi, size = lo, 0
        while hi < len(sets) and (hi == lo or size + len(sets[hi]) <= _HASH_RUN):
            size += len(sets[hi])
            hi += 1
        values = np.concatenate(sets[lo:hi])
        starts = np.concatenate([[0], np.cumsum([len(s) for s in sets[lo:hi - 1]], dtype=np.int64)]).astype(np.int64)
        for p in range(permutations):
            hashed = (values ^ keys[0, p]) * keys[1, p]
            out[lo:hi, 2 * p] = np.minimum.reduceat(hashed, starts)
            out[lo:hi, 2 * p + 1] = np.maximum.reduceat(hashed, starts)
        lo = hi
    return out


def band_keys(signatures: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key per band, which also tells the band."""
    bands = signatures.shape[1] // rows
    out = np.zeros((len(signatures), bands), np.uint64)
    for b in range(bands):
        key = np.full(len(signatures), b + 1, np.uint64)
        for r in range(rows):
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + signatures[:, b * rows + r])
        out[:, b] = key
    return out


def sketch_documents(docs: DataFrame, id_col: str, text_col: str, k: int, permutations: int, rows: int) -> DataFrame:
    """Set size, digest, band keys, sketch and, if small, the whole set of every
    row (``SKETCH_SCHEMA``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                sets = list(shingle_sets(part.column(1), k))
                full = [i for i, s in enumerate(sets) if len(s)]
                signatures = min_max_signatures([sets[i] for i in full], permutations)
                keys = band_keys(signatures, rows).view(np.int64)
                marks = (mix(signatures[:, :SKETCH]) >> np.uint64(56)).astype(np.uint8)
                bands: list = [[]] * len(sets)
                sketch: list = [b""] * len(sets)
                for row, i in enumerate(full):
                    bands[i], sketch[i] = keys[row], marks[row].tobytes()
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())), pa.array(sketch, pa.binary()),
                    pa.array([x.tobytes() if 0 < len(x) <= SMALL_SET else None for x in sets], pa.binary())],
                    names=["doc_id", "n_shingles", "digest", "bands", "sketch", "small"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(run, SKETCH_SCHEMA)


def _agreeing(pairs: DataFrame, sketches: DataFrame, numerator: int, denominator: int, slack: float) -> DataFrame:
    """Pairs whose sizes and sketches leave the threshold possible.

    Sizes decide exactly. Of 256 sketch values a pair at similarity 0.75 agrees
    in 0.75 with a standard deviation under 0.028; a pair is left out when it
    agrees in fewer than the threshold less ``slack`` (0.14: five deviations).
    """
    def keep(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            na, nb = batch.column(2).to_numpy(zero_copy_only=False), batch.column(3).to_numpy(zero_copy_only=False)
            ok = np.minimum(na, nb) * denominator >= np.maximum(na, nb) * numerator
            a = np.frombuffer(b"".join(batch.column(4).to_pylist()), np.uint8).reshape(batch.num_rows, -1)
            b = np.frombuffer(b"".join(batch.column(5).to_pylist()), np.uint8).reshape(batch.num_rows, -1)
            ok &= (a == b).mean(axis=1) >= numerator / denominator - slack
            yield batch.select([0, 1]).filter(pa.array(ok))

    left = sketches.select(F.col("doc_id").alias("a"), F.col("n_shingles").alias("na"), F.col("sketch").alias("sa"))
    right = sketches.select(F.col("doc_id").alias("b"), F.col("n_shingles").alias("nb"), F.col("sketch").alias("sb"))
    return (pairs.join(left, "a").join(right, "b").select("a", "b", "na", "nb", "sa", "sb")
            .mapInArrow(keep, "a long, b long"))


def _confirmed(pairs: DataFrame, sets: DataFrame, numerator: int, denominator: int) -> DataFrame:
    """Pairs with denominator * |A and B| >= numerator * |A or B| on full sets."""
    def keep(batches):
        for batch in batches:
            ok = []
            for x, y in zip(batch.column(2), batch.column(3)):
                a, b = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                at = np.searchsorted(a, b)
                common = int((a[np.minimum(at, len(a) - 1)] == b).sum())
                ok.append(denominator * common >= numerator * (len(a) + len(b) - common))
            yield batch.select([0, 1]).filter(pa.array(ok, pa.bool_()))

    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(keep, "a long, b long")


def _sets_of(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """Shingle sets of the rows whose id is in ``ids``, from their whole texts."""
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([s.tobytes() for s in shingle_sets(part.column(1), k)], pa.binary())],
                    names=["doc_id", "shingles"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.join(maybe_broadcast(ids), "doc_id", "left_semi").mapInArrow(run, "doc_id long, shingles binary")


def _exploded(sets: DataFrame, block: int) -> DataFrame:
    """(doc_id, own, n, token) of (doc_id, own, shingles) rows."""
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, block):
                part = batch.slice(at, block)
                held = [np.unique(np.frombuffer(x.as_py(), np.int64)) for x in part.column(2)]
                n = np.array([len(x) for x in held], np.int64)
                ids, own = (np.repeat(part.column(c).to_numpy(), n) for c in (0, 1))
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(own), pa.array(np.repeat(n, n)), pa.array(np.concatenate(held))],
                                                 names=["doc_id", "own", "n", "token"])

    return sets.select("doc_id", "own", "shingles").mapInArrow(run, "doc_id long, own long, n long, token long")


def prefix_pairs(sets: DataFrame, scratch: Scratch, numerator: int, denominator: int, block: int = 256) -> DataFrame:
    """(a, b): all pairs of (doc_id, own, shingles) rows of different components
    ``own`` that sizes and positions leave the threshold, each at least once.

    Shingles are put in one order for all sets: first those that only one
    component holds, which lead to no pair, then the others, rarest first. Let
    the smaller set of a pair over the threshold have n shingles: the two share
    at least 2t/(1+t) n of them and t times the larger one's, so the first that
    they share lies before those last ones in either. Only these places are
    joined. The component that most of a shingle's places belong to is never
    joined with itself.
    """
    tokens = scratch.save(_exploded(sets, block), "tokens")
    shared = tokens.groupBy("token").agg(F.count("*").alias("df"), F.min("own").alias("lo"), F.max("own").alias("hi"))
    shared = scratch.save(shared.where("lo < hi").select("token", "df"), "shared-tokens")
    held = tokens.join(maybe_broadcast(shared), "token")
    rank = Window.partitionBy("doc_id").orderBy("df", "token")
    placed = held.select("doc_id", "own", "n", "token", (F.row_number().over(rank) - 1).alias("rank"),
                         F.count("*").over(Window.partitionBy("doc_id")).alias("m"))
    placed = placed.withColumn("place", F.col("n") - F.col("m") + F.col("rank"))
    n, num, den = F.col("n"), numerator, denominator
    probe = placed.where(F.col("place") <= n - F.ceil(n * num / den)).select(
        "doc_id", "own", "n", "token", "place", (F.col("place") <= n - F.ceil(n * (2 * num) / (num + den))).alias("short"))
    probe = scratch.save(probe, "prefixes")
    per_own = probe.groupBy("token", "own").agg(F.count("*").alias("rows"))
    tops = per_own.groupBy("token").agg(F.max(F.struct("rows", "own")).alias("top"), F.count("*").alias("owns")).where("owns > 1")
    tops = scratch.save(tops.select("token", F.col("top.own").alias("most")), "most")
    probe = scratch.save(probe.join(maybe_broadcast(tops), "token"), "open-prefixes")
    x, y = probe.where("short").alias("x"), probe.alias("y")
    fits = ((F.col("x.own") != F.col("y.own"))
            & ((F.col("x.n") < F.col("y.n")) | (F.col("x.n") == F.col("y.n")) & (F.col("x.doc_id") < F.col("y.doc_id")))
            & (F.col("x.n") * den >= F.col("y.n") * num)
            & (F.least(F.col("x.n") - F.col("x.place"), F.col("y.n") - F.col("y.place")) * (num + den) >= (F.col("x.n") + F.col("y.n")) * num))
    same = F.col("x.token") == F.col("y.token")
    minor = x.where("own <> most").join(y, same & fits)
    major = x.where("own = most").join(y.where("own <> most"), same & fits)
    both = [q.select(F.least("x.doc_id", "y.doc_id").alias("a"), F.greatest("x.doc_id", "y.doc_id").alias("b")) for q in (minor, major)]
    return scratch.save(both[0].union(both[1]).distinct(), "prefix-pairs")


def _closing_links(reps: DataFrame, open_ids: DataFrame, labels: DataFrame, docs: DataFrame, scratch: Scratch, id_col: str,
                   text_col: str, k: int, numerator: int, denominator: int, block: int) -> DataFrame:
    """Links between components among all small sets, and among the sets whose
    id is in ``open_ids``."""
    large = open_ids.join(reps.where("small is null").select("doc_id"), "doc_id", "left_semi")
    held = reps.where("small is not null").select("doc_id", F.col("small").alias("shingles"))
    if not open_ids.isEmpty():
        held = held.union(_sets_of(docs, scratch.save(large, "open-ids"), id_col, text_col, k).where("length(shingles) > 0").dropDuplicates(["doc_id"]))
    own = held.join(maybe_broadcast(labels), held["doc_id"] == labels["node"], "left").select(
        "doc_id", F.coalesce("component", "doc_id").alias("own"), "shingles")
    sets = scratch.save(own, "closing-sets")
    pairs = prefix_pairs(sets, scratch, numerator, denominator, block)
    return scratch.save(_confirmed(pairs, sets.select("doc_id", "shingles"), numerator, denominator), "closing-links")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5,
                    numerator: int = 75, denominator: int = 100, permutations: int = 192, rows: int = 6,
                    small_bucket: int = 16, centres: int = 2, slack: float = 0.14, block: int = 256) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id (smallest id
    reachable over confirmed links), kept (doc_id = component_id).

    With 64 bands of 6 values a pair at similarity 0.75 misses every bucket
    with a probability of 4e-6 if the sets are large, and of 7e-6 at most if the
    larger has just over ``SMALL_SET`` shingles, as minimum and maximum of few
    shingles are correlated. The sketch filter skips such a pair with a
    probability under 4e-7. Pairs of smaller sets are settled exactly. ``block``
    is the number of sets taken apart at a time in that step.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "near")
    table = scratch.save(sketch_documents(docs, id_col, text_col, k, permutations, rows), "sketches")
    full = table.where("n_shingles > 0")
    classes = scratch.save(full.groupBy("digest").agg(F.min("doc_id").alias("rep")), "classes")
    reps = full.join(classes.where("rep is not null"), "digest").where("doc_id = rep").select(
        "doc_id", "n_shingles", "bands", "sketch", "small")
    reps = scratch.save(reps.dropDuplicates(["doc_id", "n_shingles"]), "reps")

    banded = reps.select("doc_id", F.explode("bands").alias("key"))
    shared = scratch.save(banded.groupBy("key").agg(F.min("doc_id").alias("centre"), F.count("*").alias("size"))
                          .where("size > 1"), "shared")
    members = scratch.save(banded.join(maybe_broadcast(shared), "key"), "members")

    pairs = members.where("centre <> doc_id").groupBy(F.col("doc_id").alias("b")).agg(F.min("centre").alias("a")).select("a", "b")
    links, tested, labels, turn = None, None, None, 0
    while True:
        close = scratch.save(_agreeing(pairs, reps, numerator, denominator, slack), f"close-{turn}")
        ids = scratch.save(close.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), f"ids-{turn}")
        sets = scratch.save(_sets_of(docs, ids, id_col, text_col, k), f"sets-{turn}")
        found = scratch.save(_confirmed(close, sets, numerator, denominator).distinct(), f"links-{turn}")
        scratch.drop(f"sets-{turn}", f"ids-{turn}")
        if turn and found.isEmpty():
            break
        links = found if links is None else links.union(found)
        tested = close if tested is None else tested.union(close)
        labels = connected_components(links, scratch, f"cc-{turn}")
        turn += 1
        labelled = (members.join(maybe_broadcast(labels), members["doc_id"] == labels["node"], "left")
                    .select("key", "size", "doc_id", F.coalesce("component", "doc_id").alias("component")))
        open_keys = labelled.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
        open_keys = scratch.save(open_keys.select("key"), f"open-keys-{turn}")
        left = scratch.save(labelled.join(maybe_broadcast(open_keys), "key"), f"open-{turn}")
        few = left.where(F.col("size") <= small_bucket)
        across = (few.alias("x").join(few.alias("y"), "key")
                  .where("x.doc_id < y.doc_id and x.component <> y.component")
                  .select(F.col("x.doc_id").alias("a"), F.col("y.doc_id").alias("b")))
        many = left.where(F.col("size") > small_bucket)
        drawn = [F.min_by(F.struct("doc_id", "component"), F.xxhash64("doc_id", F.lit(turn * 1000 + c))) for c in range(centres)]
        new_centres = many.groupBy("key").agg(F.array(*drawn).alias("cs")).select("key", F.explode(F.array_distinct("cs")).alias("c"))
        new_centres = scratch.save(new_centres, f"centres-{turn}")
        stars = (many.join(maybe_broadcast(new_centres), "key").where("component <> c.component")
                 .select(F.least("doc_id", "c.doc_id").alias("a"), F.greatest("doc_id", "c.doc_id").alias("b")))
        pairs = across.union(stars).distinct().join(maybe_broadcast(tested), ["a", "b"], "left_anti")

    open_ids = scratch.save(many.select("doc_id").distinct(), "open-large")
    closing = _closing_links(reps, open_ids, labels, docs, scratch, id_col, text_col, k, numerator, denominator, block)
    if not closing.isEmpty():
        labels = connected_components(links.union(closing), scratch, "cc-closed")

    result = table.join(classes, "digest", "left")
    result = result.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("rep")).otherwise(F.col("doc_id")).alias("rep"))
    result = result.join(maybe_broadcast(labels), result["rep"] == labels["node"], "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "rep", "doc_id").alias("component_id"))
    return result.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()))
