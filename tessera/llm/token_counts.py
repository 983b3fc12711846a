"""Token counts with a digest cache.

The cache is a Parquet table of (tokenizer, digest, n_tokens): the digest of a
text's content and that of the tokenizer file. A run joins its texts' digests
to it, encodes one text per digest that it lacks, appends those counts and
joins again. Texts never cross the network while the rows to encode (or to
leave out, whichever are fewer) are a table small enough to broadcast; beyond
that they are picked by a shuffled join.

A run writes its counts to a folder of its own inside the cache, so a failed or
repeated run leaves nothing half-written; digests that two runs added at the
same time are merged on reading. A null text counts as empty. Rows of one id
may differ in text: rows are told apart by id and digest. Further columns are
ignored.
"""

from __future__ import annotations

import uuid
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import BROADCAST_ROWS, Scratch, text_or_empty
from tessera.llm.pieces import MARK, segments

MEMO = 200_000          # segments remembered per worker process
CACHE_SCHEMA = "digest binary, n_tokens long"
_NO_ID = -(2**63)


class PieceCounter:
    """Token counts of the sentencepiece library. Where no piece crosses from
    one word into the next, a text's count is the sum over its segments, and
    the library encodes each distinct segment once per process."""

    def __init__(self, model: bytes):
        import sentencepiece
        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces = [self.sp.id_to_piece(i) for i in range(self.sp.get_piece_size())]
        plain = self.sp.encode("a  b ", out_type=str)
        self.by_segment = (not any(MARK in p.lstrip(MARK) for p in pieces)
                           and "".join(plain) == f"{MARK}a{MARK}{MARK}b{MARK}" and self._identity_normaliser())
        self.memo: dict[str, int] = {}

    def _identity_normaliser(self) -> bool:
        return all(self.sp.normalize(s) == MARK + s.replace(" ", MARK) for s in ("ﬁ  Ａ…", "é\t　x"))

    def count(self, texts: list[str]) -> list[int]:
        if not self.by_segment:
            return [len(x) for x in self.sp.encode(texts, num_threads=1)]
        if len(self.memo) > MEMO:
            self.memo.clear()
        cut = [segments(t) for t in texts]
        memo = self.memo
        new = list({s for parts in cut for s in parts if s not in memo})
        # The library puts a marker in front of what it is given; a lone marker is one piece.
        for s, ids in zip(new, self.sp.encode([s[1:].replace(MARK, " ") for s in new], num_threads=1)):
            memo[s] = len(ids) if len(s) > 1 else 1
        return [sum([memo[s] for s in parts]) for parts in cut]


class JsonCounter:
    """Token counts of the tokenizers library; special strings in a text are
    what its default makes of them."""

    def __init__(self, model: bytes):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_buffer(model)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()

    def count(self, texts: list[str]) -> list[int]:
        return [len(e.ids) for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]


COUNTERS = {".model": PieceCounter, ".json": JsonCounter}
_LOADED: dict = {}


def _counter(kind: str, model: bytes):
    key = (kind, hash(model))
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = COUNTERS[kind](model)
    return _LOADED[key]


def counted(texts: DataFrame, kind: str, model: bytes) -> DataFrame:
    """(digest, n_tokens) of (digest, text) rows."""
    def run(batches):
        counter = _counter(kind, model)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(counter.count([t or "" for t in part.column(1).to_pylist()]), pa.int64())],
                    names=["digest", "n_tokens"])

    return texts.mapInArrow(run, CACHE_SCHEMA)


def _stored(spark: SparkSession, folder: str) -> DataFrame:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], CACHE_SCHEMA)
    counts = spark.read.schema(CACHE_SCHEMA).option("recursiveFileLookup", "true").parquet(folder)
    return counts.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def token_counts(docs: DataFrame, tokenizer: str, cache: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 4096, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_tokens, over_limit."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "tokens")
    kind = "." + tokenizer.rsplit(".", 1)[1]
    with open(tokenizer, "rb") as f:
        model = f.read()
    folder = f"{cache.rstrip('/')}/tokenizer-{sha256(kind.encode() + model).hexdigest()}"

    text = text_or_empty(text_col)
    digest = F.unhex(F.sha2(text, 256)).alias("digest")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("key"),
                       digest, text.alias("text"))
    keys = scratch.save(rows.select("doc_id", "key", "digest", F.octet_length("text").cast("long").alias("n_bytes")), "keys")
    misses = scratch.save(keys.groupBy("digest").agg(F.min("key").alias("rep"))
                          .join(_stored(spark, folder).select("digest"), "digest", "left_anti"), "misses")
    picked = scratch.save(keys.join(misses, "digest", "left").groupBy("key").agg(
        F.max(F.coalesce(F.col("rep") == F.col("key"), F.lit(False))).alias("encode")), "picked")
    wanted, unwanted = picked.where("encode").select("key"), picked.where("not encode").select("key")
    n_wanted, n_unwanted = wanted.count(), unwanted.count()
    if n_wanted:
        if n_unwanted <= min(n_wanted, broadcast_rows):
            chosen = rows.join(F.broadcast(unwanted), "key", "left_anti")
        else:
            chosen = rows.join(F.broadcast(wanted) if n_wanted <= broadcast_rows else wanted, "key", "left_semi")
        new = counted(chosen.select("digest", "text"), kind, model).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
        new.join(misses.select("digest"), "digest", "left_semi").write.parquet(f"{folder}/run-{uuid.uuid4().hex[:12]}")
    counts = scratch.save(_stored(spark, folder), "counts")     # stored, so that the join can split a frequent text's rows
    return (keys.join(counts, "digest")
            .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")))
