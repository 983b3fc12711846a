"""Alignment of two tokenizers' tokens over the bytes of a text.

A byte-level BPE (A) and a SentencePiece model (B) cut the same bytes. The
incidence of tokens and bytes is a sparse matrix in CSR form, built by hand
from the tokens' lengths: a row per token, a stored entry per byte. Gustavson's
row products of A's matrix with the transpose of B's give the overlap links
with the number of bytes shared; bytes at which both end cut the tokens into
groups, and the product of the group incidences gives the pairs of one group.

Texts are cut into units at every single space between characters that are no
white space. Tokens of both sides end there in any case, so links and groups
never cross a unit: distinct units are encoded and multiplied together, once
per worker process, and a document is the sum of its units. A text without such
a place is one unit.

Counts of id pairs are summed over the corpus per task before the shuffle. The
pairs of each document are stored once as (pair, times); the table of counted
pairs, bounded by the two vocabularies, is broadcast if it is small and joined
by a shuffle otherwise.

Defined results: null and empty texts, and texts whose tokens don't spell the
text after one space, have no tokens: zeros and an empty digest. Rows are
independent: repeated rows and ids are counted each; further columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Scratch, maybe_broadcast

PIECE = 1 << 20             # characters of a text that are cut into units at a time
BLOCK = 1 << 18             # characters encoded and multiplied at a time, about; a longer unit is a block of its own
MEMO = 20_000_000           # characters and, 24 a unit, units remembered per worker process: about 200 MB
CUT = re.compile(r"(?<=\S) (?=\S)")
B_BITS = 20                 # bits of B's id in a pair
DOC_SCHEMA = ("row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, n_overlaps long, n_shared long, "
              "groups_sha256 string, pairs array<long>, times array<long>")


@dataclass
class CSR:
    """A sparse matrix of ones: the columns of row i are indices[indptr[i]:indptr[i + 1]]."""
    indptr: np.ndarray
    indices: np.ndarray
    columns: int


def incidence(lengths: np.ndarray) -> CSR:
    """Rows that hold ``lengths`` consecutive columns each, one after another."""
    indptr = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
    return CSR(indptr, np.arange(indptr[-1]), int(indptr[-1]))


def transpose(m: CSR) -> CSR:
    order = np.argsort(m.indices, kind="stable")
    rows = np.repeat(np.arange(len(m.indptr) - 1), np.diff(m.indptr))
    indptr = np.concatenate([[0], np.cumsum(np.bincount(m.indices, minlength=m.columns), dtype=np.int64)])
    return CSR(indptr, rows[order], len(m.indptr) - 1)


def row_products(a: CSR, b: CSR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, column and value of the entries of a·b, by row, then column.

    Gustavson: a row of the product is the sum of those rows of ``b`` that the
    row's columns in ``a`` name. They are laid out behind each other for all
    rows at once, and equal columns of one row are added up.
    """
    taken = np.diff(b.indptr)[a.indices]
    total = int(taken.sum())
    if not total:
        none = np.zeros(0, np.int64)
        return none, none, none
    first = np.cumsum(taken) - taken
    at = np.arange(total) - np.repeat(first - b.indptr[a.indices], taken)
    per_row = np.add.reduceat(np.append(taken, 0), np.minimum(a.indptr[:-1], len(taken))) * (np.diff(a.indptr) > 0)
    key = np.repeat(np.arange(len(per_row)), per_row) * b.columns + b.indices[at]
    if (key[1:] < key[:-1]).any():
        key.sort()
    edge = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    return key[edge] // b.columns, key[edge] % b.columns, np.diff(np.append(edge, total))


@dataclass
class Aligned:
    """Tokens of a block: ids, lengths in bytes and groups of both sides."""
    a: np.ndarray
    b: np.ndarray
    a_len: np.ndarray
    b_len: np.ndarray
    a_end: np.ndarray
    b_end: np.ndarray
    a_group: np.ndarray
    b_group: np.ndarray
    overlap: tuple[np.ndarray, np.ndarray, np.ndarray]     # A's place, B's place, bytes shared

    def linked(self) -> tuple[np.ndarray, np.ndarray]:
        """Overlapping tokens that end together."""
        i, j, _ = self.overlap
        same = self.a_end[i] == self.b_end[j]
        return i[same], j[same]

    def shared(self, rows: int = 4096, pairs: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of one group, from products of the group incidences in row
        blocks of at most ``pairs`` pairs (or one row)."""
        groups = int(self.a_group[-1]) + 1 if len(self.a_group) else 0
        right = transpose(CSR(np.arange(len(self.b) + 1), self.b_group, groups))
        width = np.cumsum(np.diff(right.indptr)[self.a_group])
        lo = 0
        while lo < len(self.a):
            hi = min(lo + rows, max(lo + 1, int(np.searchsorted(width, (width[lo - 1] if lo else 0) + pairs, side="right"))))
            i, j, _ = row_products(CSR(np.arange(hi - lo + 1), self.a_group[lo:hi], groups), right)
            yield i + lo, j
            lo = hi


def aligned(a: np.ndarray, b: np.ndarray, a_len: np.ndarray, b_len: np.ndarray) -> Aligned:
    """Both sides cover the same bytes from their first on."""
    a_end, b_end = np.cumsum(a_len, dtype=np.int64), np.cumsum(b_len, dtype=np.int64)
    overlap = row_products(incidence(a_len), transpose(incidence(b_len)))
    n = int(a_end[-1]) if len(a_end) else 0
    ends = np.zeros((2, n + 1), bool)
    ends[0, a_end], ends[1, b_end] = True, True
    group = np.cumsum(ends[0] & ends[1])            # groups that end at or before an offset
    return Aligned(a, b, a_len, b_len, a_end, b_end, group[a_end - a_len], group[b_end - b_len], overlap)


def _digits(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of 0 .. n-1, from the left, with room for a separator,
    and how many digits each has."""
    text = [str(i).encode() for i in range(n)]
    width = max(map(len, text)) + 1
    return (np.frombuffer(b"".join(t.ljust(width, b"\0") for t in text), np.uint8).reshape(n, width).copy(),
            np.array([len(t) for t in text], np.int64))


def _vocabulary_bytes(entries: list[str]) -> list[bytes]:
    """Bytes of byte-level entries: printable Latin-1 characters stand for
    themselves, the other bytes for the code points from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in plain}
    byte_of |= {chr(256 + n): b for n, b in enumerate(sorted(set(range(256)) - set(plain)))}
    return [bytes(byte_of[c] for c in e) if all(c in byte_of for c in e) else e.encode() for e in entries]


class Tables:
    """Bytes of every entry: lengths, and all of them behind each other."""

    def __init__(self, entries: list[bytes]):
        self.length = np.array([len(e) for e in entries], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.data = np.frombuffer(b"".join(entries), np.uint8)
        self.digits, self.n_digits = _digits(len(entries))

    def spelt(self, ids: np.ndarray) -> np.ndarray:
        n = self.length[ids]
        first = np.cumsum(n) - n
        return self.data[np.arange(int(n.sum())) + np.repeat(self.start[ids] - first, n)]


class Aligner:
    """The two tokenizers, from their files' contents; one per worker process."""

    def __init__(self, a_model: bytes, b_model: bytes):
        import os

        import sentencepiece
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_buffer(a_model)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        size = self.a.get_vocab_size(with_added_tokens=True)
        added = {t["content"] for t in json.loads(a_model).get("added_tokens", [])}
        entries = [self.a.id_to_token(i) or "" for i in range(size)]
        spelt = _vocabulary_bytes(entries)
        self.a_table = Tables([e.encode() if e in added else s for e, s in zip(entries, spelt)])
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if len(pieces) >= 1 << B_BITS:
            raise ValueError("the second vocabulary is too large for a pair of ids in one number")
        self.forget()
        self.b_table = Tables([bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)])

    def encode(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Whether the tokens of both sides spell each unit after a space, and
        for those that they do: ids of A and how many a unit, the same of B."""
        left = [e.ids for e in self.a.encode_batch([" " + u for u in units], add_special_tokens=False)]
        sides = ((self.a_table, left), (self.b_table, self.b.encode(units, num_threads=1)))
        want = [b" " + u.encode() for u in units]
        size = np.array([len(w) for w in want], np.int64)
        good = np.ones(len(units), bool)
        flat = []
        for table, found in sides:
            n = np.array([len(x) for x in found], np.int64)
            ids = np.fromiter(chain.from_iterable(found), np.int64, int(n.sum()))
            flat.append((ids, n))
            end = np.concatenate([[0], np.cumsum(table.length[ids])])[np.cumsum(n)]
            good &= np.diff(end, prepend=0) == size
        text = np.frombuffer(b"".join(want), np.uint8)[np.repeat(good, size)]
        for (table, _), (ids, n) in zip(sides, flat):
            differs = np.concatenate([[0], np.cumsum(table.spelt(ids[np.repeat(good, n)]) != text)])
            good[good] = np.diff(differs[np.cumsum(size[good])], prepend=0) == 0
            text = np.frombuffer(b"".join(want), np.uint8)[np.repeat(good, size)]
        (a, a_n), (b, b_n) = ((ids[np.repeat(good, n)], n[good]) for ids, n in flat)
        return good, a, a_n, b, b_n

    def align(self, a: np.ndarray, b: np.ndarray) -> Aligned:
        return aligned(a, b, self.a_table.length[a], self.b_table.length[b])

    def groups_text(self, x: Aligned, a_first: np.ndarray, b_first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """`a1,a2|b1;a3|b2,b3;` of a block as bytes, and where each of the parts
        begins whose first tokens are given (one entry more than parts)."""
        groups = int(x.a_group[-1]) + 1
        in_a, in_b = np.bincount(x.a_group, minlength=groups), np.bincount(x.b_group, minlength=groups)
        before_b, upto_a = np.cumsum(in_b) - in_b, np.cumsum(in_a)
        place_a = np.arange(len(x.a)) + before_b[x.a_group]
        place_b = np.arange(len(x.b)) + upto_a[x.b_group]
        width = max(self.a_table.digits.shape[1], self.b_table.digits.shape[1])
        cells = np.zeros((len(x.a) + len(x.b), width), np.uint8)
        digits = np.zeros(len(cells), np.int64)
        for table, ids, place in ((self.a_table, x.a, place_a), (self.b_table, x.b, place_b)):
            cells[place, :table.digits.shape[1]] = table.digits[ids]
            digits[place] = table.n_digits[ids]
        mark = np.full(len(cells), ord(","), np.uint8)
        mark[place_a[upto_a - 1]] = ord("|")
        mark[place_b[np.cumsum(in_b) - 1]] = ord(";")
        cells[np.arange(len(cells)), digits] = mark
        text = cells[np.arange(width) <= digits[:, None]]
        start = np.concatenate([[0], np.cumsum(digits + 1)])
        return text, start[a_first + b_first]


    def learn(self, units: set[str]) -> None:
        """Align units that aren't remembered yet."""
        new, lo = sorted(units - self.index.keys()), 0
        while lo < len(new):
            hi, size = lo, 0
            while hi < len(new) and (hi == lo or size + len(new[hi]) <= BLOCK):
                size += len(new[hi])
                hi += 1
            self._remember(new[lo:hi])
            self.held += size + 24 * (hi - lo)
            lo = hi

    def _remember(self, units: list[str]) -> None:
        good, a, a_n, b, b_n = self.encode(units)
        base = len(self.texts)
        self.index.update(zip(units, np.where(good, base + np.cumsum(good) - 1, -1).tolist()))
        if not good.any():
            return
        x = self.align(a, b)
        a_first, b_first = np.concatenate([[0], np.cumsum(a_n)]), np.concatenate([[0], np.cumsum(b_n)])
        text, text_at = self.groups_text(x, a_first, b_first)
        i, j = x.linked()
        groups = np.append(x.a_group, x.a_group[-1] + 1)[a_first]
        group_a, group_b = (np.bincount(g, minlength=int(groups[-1])) for g in (x.a_group, x.b_group))
        shared = np.concatenate([[0], np.cumsum(group_a * group_b)])[groups]
        links, overlaps = (np.searchsorted(k, a_first) for k in (i, x.overlap[0]))     # by A's place, so by unit
        counts = np.stack([np.diff(z) for z in (a_first, b_first, groups, links, overlaps, shared)], axis=1)
        raw = text.tobytes()
        self.texts += [raw[p:q] for p, q in zip(text_at.tolist(), text_at[1:].tolist())]
        self.counts.append(counts)
        self.keys.append(x.a[i] << B_BITS | x.b[j])

    def settle(self) -> None:
        """Put what was learnt behind what was known."""
        if len(self.counts) > 1:
            self.counts, self.keys = [np.concatenate(self.counts)], [np.concatenate(self.keys)]
        self.key_end = np.cumsum(self.counts[0][:, 3])

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.texts: list[bytes] = []
        self.counts, self.keys = [np.zeros((0, 6), np.int64)], [np.zeros(0, np.int64)]
        self.held = 0


_LOADED: dict = {}


def _aligner(a_model: bytes, b_model: bytes) -> Aligner:
    key = (hash(a_model), hash(b_model))
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Aligner(a_model, b_model)
    return _LOADED[key]


def pieces_of(text: str, size: int = PIECE) -> Iterator[list[str]]:
    """The units of a text, in lists of bounded size."""
    lo = 0
    while len(text) - lo > size and (m := CUT.search(text, lo + size)):
        yield CUT.split(text[lo:m.start()])
        lo = m.end()
    yield CUT.split(text[lo:])


class _Document:
    """What is known of one document, list of units by list of units."""

    def __init__(self):
        self.counts, self.sha, self.pairs, self.spelt, self.open = np.zeros(6, np.int64), sha256(), [], True, False

    def add(self, aligner: Aligner, units: list[str]) -> None:
        index = aligner.index
        at = np.array([index[u] for u in units], np.int64)
        self.spelt = self.spelt and at.min() >= 0
        if not self.spelt:
            return
        counts = aligner.counts[0][at]
        self.counts += counts.sum(axis=0)
        texts = aligner.texts
        text = b"".join([texts[n] for n in at.tolist()])
        self.sha.update(b";" + text[:-1] if self.open else text[:-1])
        self.open = True
        n = counts[:, 3]
        first = aligner.key_end[at] - n - (np.cumsum(n) - n)
        self.pairs.append(np.unique(aligner.keys[0][np.arange(int(n.sum())) + np.repeat(first, n)], return_counts=True))
        if len(self.pairs) > 8:
            self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct pairs and how often each is linked."""
        if not self.pairs or not self.spelt:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        if len(self.pairs) > 1:
            keys, at = np.unique(np.concatenate([p for p, _ in self.pairs]), return_inverse=True)
            times = np.bincount(at, weights=np.concatenate([t for _, t in self.pairs])).astype(np.int64)
            self.pairs = [(keys, times)]
        return self.pairs[0]


def _add_all(aligner: Aligner, held: list[tuple[_Document, list[str]]]) -> None:
    wanted = {u for _, units in held for u in units}
    if aligner.held > MEMO:
        aligner.forget()
    aligner.learn(wanted)
    aligner.settle()
    for document, units in held:
        document.add(aligner, units)


def aligned_documents(docs: DataFrame, a_model: bytes, b_model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``DOC_SCHEMA`` of every row: numbers of tokens, groups, links that end
    together, overlap links and shared-group links, the digest of the groups,
    and the linked id pairs (A's id times 2**20 plus B's) with their number."""
    def run(batches):
        aligner = _aligner(a_model, b_model)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                documents = [_Document() for _ in range(part.num_rows)]
                held: list = []
                size = 0
                for document, text in zip(documents, part.column(2)):
                    for units in pieces_of(text) if (text := text.as_py()) else ():
                        held.append((document, units))
                        size += sum(map(len, units))
                        if size >= PIECE:
                            _add_all(aligner, held)
                            held, size = [], 0
                _add_all(aligner, held)
                merged = [x.merge() for x in documents]
                ends = pa.array(np.concatenate([[0], np.cumsum([len(p) for p, _ in merged])]).astype(np.int32))
                lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate([m[k] for m in merged]))) for k in (0, 1)]
                counts = np.stack([x.counts if x.spelt else np.zeros(6, np.int64) for x in documents])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), *(pa.array(counts[:, k]) for k in range(6)),
                     pa.array([x.sha.hexdigest() if x.spelt and x.open else "" for x in documents], pa.string()), *lists],
                    names=[f.split()[0] for f in DOC_SCHEMA.split(", ")])

    return docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(run, DOC_SCHEMA)


def token_links(docs: DataFrame, a_model: bytes, b_model: bytes, kind: str = "overlap", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per link: doc_id, a_at and b_at (places of the tokens in the
    document), a_id, b_id. ``kind``: ``overlap`` (tokens that share bytes) or
    ``group`` (tokens of one group, which can be many in a text whose cuts
    rarely meet; they are made in batches of bounded size)."""
    if kind not in ("overlap", "group"):
        raise ValueError(f"no such kind of link: {kind}")

    def run(batches):
        aligner = _aligner(a_model, b_model)
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                cut = [aligner.encode(units) for units in (pieces_of(text) if text else ())]
                if not all(good.all() for good, *_ in cut):
                    continue
                a_at = b_at = 0
                for _, a, _, b, _ in cut:
                    x = aligner.align(a, b)
                    for i, j in ([x.overlap[:2]] if kind == "overlap" else x.shared()):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([doc] * len(i), pa.int64()), pa.array(i + a_at), pa.array(j + b_at), pa.array(x.a[i]), pa.array(x.b[j])],
                            names=["doc_id", "a_at", "b_at", "a_id", "b_id"])
                    a_at, b_at = a_at + len(x.a), b_at + len(x.b)

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(
        run, "doc_id long, a_at long, b_at long, a_id long, b_id long")


def alignments(docs: DataFrame, a_model: bytes, b_model: bytes, id_col: str = "doc_id", text_col: str = "text",
               broadcast_rows: int = 1_000_000) -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256, n_overlaps, n_shared."""
    scratch = Scratch(docs.sparkSession, "alignment")
    documents = scratch.save(aligned_documents(docs, a_model, b_model, id_col, text_col), "documents")
    held = documents.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select(
        "row", F.col("p.pairs").alias("pair"), F.col("p.times").alias("times"))
    b_id = F.col("pair").bitwiseAND((1 << B_BITS) - 1)
    counts = scratch.save(held.groupBy("pair").agg(F.sum("times").alias("count")).withColumn("b_id", b_id), "counts")
    most = counts.groupBy("b_id").agg(F.max("count").alias("most"))
    ranked = scratch.save(counts.join(maybe_broadcast(most, counts.count(), broadcast_rows), "b_id")
                          .select("pair", "count", (F.col("count") == F.col("most")).alias("best")), "ranked")
    scores = held.join(maybe_broadcast(ranked, limit=broadcast_rows), "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times"))).alias("n_best"), F.sum(F.col("times") * F.col("count")).alias("count_sum"))
    scores = scratch.save(scores, "scores").withColumnRenamed("row", "scored")
    rows = documents.join(maybe_broadcast(scores, limit=broadcast_rows), documents["row"] == scores["scored"], "left")
    return rows.select("doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)).alias("n_best"),
                       F.coalesce("count_sum", F.lit(0)).alias("count_sum"), "groups_sha256", "n_overlaps", "n_shared")
