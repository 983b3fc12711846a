"""SentencePiece encoding and decoding of a text column.

The model file is read once on the driver (half a megabyte) and travels with
the job. Texts are encoded in batches inside Arrow tasks; nothing is shuffled.
A null text counts as empty and has no pieces. The marker character itself, if
a text holds it, decodes to a space, as in the library; everything else comes
back exactly. Rows are independent; further columns pass unchanged.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StringType, StructField, StructType

from tessera.llm.pieces import MARK, MEMO, vocabulary

ROWS = 256   # texts handled at a time: more of them make longer batches of equal length


def read_model(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def _fresh(schema: StructType, *names: str) -> None:
    taken = {f.name.lower() for f in schema}
    clash = [n for n in names if n in taken]
    if clash:
        raise ValueError(f"the input already has columns {clash}: rename them first")


def encoded(docs: DataFrame, model: bytes, text_col: str = "text", ids_col: str = "piece_ids", keep_text: bool = True,
            memo_size: int = MEMO) -> DataFrame:
    """``docs`` with an array column of piece ids; without ``keep_text`` the
    text does not travel back from Python. ``memo_size`` bounds the segments that
    a worker process remembers: memory and time depend on it, the ids don't."""
    _fresh(docs.schema, ids_col)
    at = docs.columns.index(text_col)
    kept = [i for i in range(len(docs.columns)) if keep_text or i != at]
    schema = StructType([*(docs.schema.fields[i] for i in kept), StructField(ids_col, ArrayType(IntegerType(), False), False)])

    def run(batches):
        vocab = vocabulary(model, memo_size)
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                part = batch.slice(lo, ROWS)
                ids = vocab.encode_batch([t or "" for t in part.column(at).to_pylist()])
                ends = np.cumsum([0, *(len(x) // 4 for x in ids)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), "<i4")))
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in kept), lists], names=schema.names)

    return docs.mapInArrow(run, schema)


def decoded(docs: DataFrame, model: bytes, ids_col: str = "piece_ids", text_col: str = "decoded") -> DataFrame:
    """``docs`` with the text of an array column of piece ids; null ids give an
    empty text."""
    _fresh(docs.schema, text_col)
    at = docs.columns.index(ids_col)
    schema = StructType([*docs.schema.fields, StructField(text_col, StringType(), False)])

    def run(batches):
        vocab = vocabulary(model)
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                part = batch.slice(lo, ROWS)
                texts = [vocab.decode(np.array(x or [], "<i4").tobytes()) for x in part.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*part.schema.names, text_col])

    return docs.mapInArrow(run, schema)


def round_trip(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_pieces, ids_sha256 (of the model's own ids as
    little-endian int32) and whether decoding gives the text back."""
    schema = StructType([StructField("doc_id", LongType()), StructField("n_pieces", LongType()),
                         StructField("ids_sha256", StringType()), StructField("round_trip", BooleanType())])

    def run(batches):
        vocab = vocabulary(model)
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                part = batch.slice(lo, ROWS)
                texts = [t or "" for t in part.column(1).to_pylist()]
                ids = vocab.encode_batch(texts)
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array([sha256(x).hexdigest() for x in ids], pa.string()),
                    pa.array([vocab.decode(x) == t.replace(MARK, " ") for x, t in zip(ids, texts)], pa.bool_())],
                    names=schema.names)

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(run, schema)
