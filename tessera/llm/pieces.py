"""A SentencePiece vocabulary and its batched numpy Viterbi.

Encoding: spaces become the marker U+2581 and one marker is put in front. No
piece has a marker after another character, so the segmentation of a text is
that of its segments (markers and what follows them) side by side. Distinct
segments of equal length advance together: substrings of all lengths are hashed
from one running sum, the hashes probe the sorted piece keys, and at each
position one vectorised maximum over the piece lengths stores the backpointer.

The scores of a BPE model are merge ranks, whose best sum is not the model's
encoding. What the maximum is taken over are therefore the pieces that the model
itself can end a prefix with: a prefix has one encoding, so its last piece is
one, and a piece may follow the one before it if no merge would join their
edges while the two are built (``_apart``). Of such pieces the longest is taken;
there is one. A character no piece covers is written as its bytes, and nothing
merges across it. Very long segments are merged alone, by a heap.
"""

from __future__ import annotations

import heapq
import re

import numpy as np

MARK = "▁"
SEGMENT = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+$")
CELLS = 1 << 16         # characters of a batch of equal-length segments
LONG = 256              # characters from which a segment is merged alone, by a heap
MEMO = 400_000          # segments remembered per worker process: about 110 MB

_BASE = 0x9E3779B97F4A7C13
_U = np.uint64


def segments(text: str) -> list[str]:
    return SEGMENT.findall(MARK + text.replace(" ", MARK)) if text else []


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    if n > 1:
        out[1:] = np.multiply.accumulate(np.full(n - 1, base, np.uint64))
    return out


def _key(raw: np.ndarray, length) -> np.ndarray:
    x = (raw + (_U(length) if isinstance(length, int) else length)) * _U(0xD6E8FEB86659FD93)
    x ^= x >> _U(32)
    return x * _U(0xD6E8FEB86659FD93)


class Vocabulary:
    """Pieces of a model file, given as bytes so that they travel with a job."""

    def __init__(self, model: bytes):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = sp.get_piece_size()
        pieces = [sp.id_to_piece(i) for i in range(n)]
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) for i in range(n)]
        self.byte_ids = np.full(256, -1, np.int32)
        self.bytes_of: list[bytes] = []
        normal = []
        for i, piece in enumerate(pieces):
            if sp.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_ids[value] = i
                self.bytes_of.append(bytes([value]))
            elif special[i]:
                self.bytes_of.append(b"")
            else:
                self.bytes_of.append(piece.replace(MARK, " ").encode())
                normal.append(i)
        if any(MARK in pieces[i].lstrip(MARK) for i in normal):
            raise ValueError("pieces cross word boundaries: segments cannot be encoded apart")
        if (self.byte_ids < 0).any():
            raise ValueError("the vocabulary has no byte pieces")
        self.longest = max(len(pieces[i]) for i in normal)
        scores = np.array([sp.get_score(i) for i in normal], np.float64)
        sizes = np.array([len(pieces[i]) for i in normal], np.int64)
        raw = np.array([self._sums(np.array([[ord(c) for c in pieces[i]]]))[0, -1] for i in normal], np.uint64)
        keys = _key(raw, sizes.astype(np.uint64))
        order = np.argsort(keys)
        self.keys, self.ids, self.scores = keys[order], np.array(normal, np.int32)[order], scores[order]
        if (self.keys[1:] == self.keys[:-1]).any():
            raise ValueError("two pieces have the same key")
        self.present = np.zeros(1 << 20, bool)      # first bits of the keys: most probes end here
        self.present[self.keys >> _U(44)] = True
        self.ranks = np.append(self.scores, -np.inf)            # the last one for no piece (-1)
        self.memo: dict[str, bytes] = {}
        self.memo_size = MEMO
        self.raw, self.size, self.power = raw[order], sizes[order], _powers(_BASE, self.longest + 1)
        self.pair, self.answer = np.full(1 << 20, -1, np.int64), np.zeros(1 << 20, bool)
        self._take_apart([pieces[i] for i in self.ids])

    def _take_apart(self, names: list[str]) -> None:
        """What the last merge of each piece joined, when it was made (merge
        rank; -1 for characters) and whether merges give it at all."""
        n = len(names)
        self.left, self.right = np.full(n, -1, np.int32), np.full(n, -1, np.int32)
        self.made, self.whole = np.where(self.size > 1, -self.scores, -1.0), np.zeros(n, bool)
        for length in np.unique(self.size).tolist():
            at = np.flatnonzero(self.size == length)
            codes = np.array([[ord(c) for c in names[i]] for i in at], np.int64)
            halves = np.zeros(len(at), np.int64)
            out = self.merge(codes, halves)
            self.whole[at] = [len(x) == 4 for x in out]
            found = self._found(codes)
            rows = np.flatnonzero(self.whole[at] & (length > 1))
            self.left[at[rows]] = found[halves[rows] - 1, rows, 0]
            self.right[at[rows]] = found[length - halves[rows] - 1, rows, halves[rows]]

    @staticmethod
    def _sums(codes: np.ndarray) -> np.ndarray:
        """Running polynomial sums over each row, one more than characters."""
        out = np.zeros((codes.shape[0], codes.shape[1] + 1), np.uint64)
        mixed = (codes.astype(np.uint64) + _U(1)) * _U(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> _U(29)
        np.cumsum(mixed * _powers(_BASE, codes.shape[1]), axis=1, out=out[:, 1:])
        return out

    def _found(self, codes: np.ndarray) -> np.ndarray:
        """Place of the piece, or -1, by length - 1, row and start."""
        rows, n = codes.shape
        sums, inverse = self._sums(codes), _powers(pow(_BASE, -1, 2**64), n)
        longest = min(self.longest, n)
        found = np.full((longest, rows, n), -1, np.int32)
        for k in range(1, longest + 1):
            keys = _key((sums[:, k:] - sums[:, :n - k + 1]) * inverse[:n - k + 1], k)
            r, s = np.nonzero(self.present[keys >> _U(44)])
            wanted = keys[r, s]
            at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
            hit = self.keys[at] == wanted
            found[k - 1, r[hit], s[hit]] = at[hit]
        return found

    def _joined(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Merge rank of the piece that x and y make together, or infinity."""
        size = self.size[x] + self.size[y]
        key = _key(self.raw[x] + self.power[self.size[x]] * self.raw[y], size.astype(np.uint64))
        rank = np.full(len(x), np.inf)
        maybe = np.flatnonzero(self.present[key >> _U(44)] & (size <= self.longest))
        at = np.minimum(np.searchsorted(self.keys, key[maybe]), len(self.keys) - 1)
        hit = self.keys[at] == key[maybe]
        rank[maybe[hit]] = -self.scores[at[hit]]
        return rank

    def _apart(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Whether merges leave piece x beside piece y. The two are taken apart
        again, the one made later first; at no time may their edges make a piece
        of a lower rank than the merge that ends that time. Of equal ranks the
        left merge comes first: that of the edges, where y's side ends the time."""
        ok = np.ones(len(x), bool)
        live, end, tie = np.arange(len(x)), np.full(len(x), np.inf), np.zeros(len(x), bool)
        while len(live):
            rank = self._joined(x, y)
            crossing = (rank < end) | tie & (rank == end) & (rank < np.inf)
            ok[live[crossing]] = False
            from_x, from_y = self.made[x], self.made[y]
            by_x = from_x > from_y
            on = ~crossing & (np.maximum(from_x, from_y) >= 0)
            end, tie = np.where(by_x, from_x, from_y)[on], ~by_x[on]
            x, y = np.where(by_x, self.right[x], x)[on], np.where(by_x, y, self.left[y])[on]
            live = live[on]
        return ok

    def _follows(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """``_apart`` of pairs of places, most of which are known from before: a
        table of fixed size keeps the last answer that fell on each slot."""
        pair = x.astype(np.int64) << 32 | y
        slot = (pair.astype(np.uint64) * _U(0x9E3779B97F4A7C15) >> _U(44)).astype(np.int64)
        new = np.flatnonzero(self.pair[slot] != pair)
        out = self.answer[slot]
        if len(new):
            out[new] = self._apart(x[new], y[new])
            self.pair[slot[new]], self.answer[slot[new]] = pair[new], out[new]
        return out

    def viterbi(self, codes: np.ndarray) -> list[bytes]:
        """Piece ids (little-endian int32) of each row of an array of code
        points: rows are segments of one length and advance together."""
        rows, n = codes.shape
        found = self._found(codes)
        if n >= LONG:
            return [self._pieces(codes[r], found[:, r], self._merge_alone(found[:, r])) for r in range(rows)]
        longest = len(found)
        last = np.full((rows, n + 1), -1, np.int32)
        step = np.zeros((rows, n + 1), np.int8 if longest < 128 else np.int32)
        every = np.arange(rows)
        for end in range(1, n + 1):
            lengths = np.arange(1, min(longest, end) + 1)
            at = found[lengths - 1, :, end - lengths]
            k, r = np.nonzero((at >= 0) & self.whole[at])
            place, before = at[k, r], last[r, end - lengths[k]]
            free = before < 0                                   # a start, or after a character no piece covers
            fits = free.copy()
            fits[~free] = self._follows(before[~free], place[~free])
            best = np.ones(rows, np.int64)                      # a character no piece covers stands alone
            np.maximum.at(best, r[fits], lengths[k[fits]])
            step[:, end] = best
            last[:, end] = found[best - 1, every, end - best]
        return self._paths(codes, found, step)

    def _paths(self, codes: np.ndarray, found: np.ndarray, step: np.ndarray) -> list[bytes]:
        """Walk all rows' backpointers together; rows with an unknown character
        are walked again alone, as those become several bytes."""
        rows, n = codes.shape
        out = np.zeros((rows, n), "<i4")
        end, begin = np.full(rows, n), np.full(rows, n)
        unknown = np.zeros(rows, bool)
        live = np.arange(rows)
        while len(live):
            k = step[live, end[live]].astype(np.int64)
            at = found[k - 1, live, end[live] - k]
            begin[live] -= 1
            out[live, begin[live]] = self.ids[at]
            unknown[live] |= at < 0
            end[live] -= k
            live = live[end[live] > 0]
        return [self._path(codes[r], found[:, r], step[r]) if unknown[r] else out[r, begin[r]:].tobytes() for r in range(rows)]

    def _path(self, codes: np.ndarray, found: np.ndarray, step: np.ndarray) -> bytes:
        out, end = [], len(codes)
        while end:
            k = int(step[end])
            at = int(found[k - 1, end - k])
            if at >= 0:
                out.append(int(self.ids[at]))
            else:
                out.extend(int(self.byte_ids[b]) for b in reversed(chr(int(codes[end - 1])).encode()))
            end -= k
        return np.array(out[::-1], "<i4").tobytes()

    def merge(self, codes: np.ndarray, halves: np.ndarray) -> list[bytes]:
        """Piece ids of each row by merges; ``halves`` gets where the last merge
        of a row joined. All rows that still merge have as many parts, as each
        loses one a round."""
        rows, n = codes.shape
        found = self._found(codes)

        def rank(row: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
            k = end - start
            return self.ranks[np.where(k <= len(found), found[np.minimum(k, len(found)) - 1, row, start], -1)]

        out: list = [b""] * rows
        live, cuts = np.arange(rows), np.tile(np.arange(n + 1), (rows, 1))
        pairs = rank(live[:, None], cuts[:, :-2], cuts[:, 2:])
        while True:
            best = pairs.argmax(axis=1) if pairs.shape[1] else np.zeros(len(live), np.int64)
            on = pairs[np.arange(len(live)), best] > -np.inf if pairs.shape[1] else np.zeros(len(live), bool)
            done = np.flatnonzero(~on)
            if len(done):
                self._write(codes, found, live[done], cuts[done], out)
                live, cuts, pairs, best = live[on], cuts[on], pairs[on], best[on]
            if not len(live):
                return out
            if cuts.shape[1] == 3:
                halves[live] = cuts[:, 1]
            every, m = np.arange(len(live)), pairs.shape[1]
            keep = np.ones(cuts.shape, bool)
            keep[every, best + 1] = False
            cuts = cuts[keep].reshape(len(live), -1)
            keep = np.ones(pairs.shape, bool)
            keep[every, best] = False
            pairs = pairs[keep].reshape(len(live), -1)
            for j in (best - 1, best):                          # the pairs beside the merged part
                r = np.flatnonzero((j >= 0) & (j < m - 1))
                pairs[r, j[r]] = rank(live[r], cuts[r, j[r]], cuts[r, j[r] + 2])

    def _write(self, codes: np.ndarray, found: np.ndarray, rows: np.ndarray, cuts: np.ndarray, out: list) -> None:
        """Ids between the cuts of rows that have as many parts."""
        at = found[np.diff(cuts) - 1, rows[:, None], cuts[:, :-1]]
        ids = self.ids[at].astype("<i4")
        unknown = (at < 0).any(axis=1)
        for i, r in enumerate(rows.tolist()):
            out[r] = self._pieces(codes[r], found[:, r], cuts[i].tolist()) if unknown[i] else ids[i].tobytes()

    def _merge_alone(self, found: np.ndarray) -> list[int]:
        """Cuts of one long segment after all merges."""
        longest, n = found.shape
        after, before, rank = list(range(1, n + 1)), list(range(-1, n - 1)), self.ranks[found]
        gone, heap = [False] * n, []

        def push(start: int) -> None:
            if start >= 0 and (middle := after[start]) < n and (end := after[middle]) - start <= longest:
                if (x := rank[end - start - 1, start]) > -np.inf:
                    heapq.heappush(heap, (-x, start, middle, end))

        for start in range(n):
            push(start)
        while heap:
            _, start, middle, end = heapq.heappop(heap)
            if gone[start] or after[start] != middle or after[middle] != end:
                continue
            gone[middle], after[start] = True, end
            if end < n:
                before[end] = start
            push(before[start])
            push(start)
        return [s for s in range(n) if not gone[s]] + [n]

    def _pieces(self, codes: np.ndarray, found: np.ndarray, cuts: list[int]) -> bytes:
        out: list[int] = []
        for start, end in zip(cuts, cuts[1:]):
            at = int(found[end - start - 1, start])
            out.extend([int(self.ids[at])] if at >= 0 else [int(self.byte_ids[b]) for b in chr(int(codes[start])).encode()])
        return np.array(out, "<i4").tobytes()

    def learn(self, wanted: set[str]) -> None:
        """Encode segments that are not remembered yet, batched by length."""
        new = [s for s in wanted if s not in self.memo]
        new.sort(key=len)
        lo = 0
        while lo < len(new):
            n = len(new[lo])
            hi = lo + 1
            while hi < len(new) and len(new[hi]) == n and (hi - lo) * n < CELLS:
                hi += 1
            codes = np.frombuffer("".join(new[lo:hi]).encode("utf-32-le"), "<u4").reshape(hi - lo, n)
            self.memo.update(zip(new[lo:hi], self.viterbi(codes)))
            lo = hi

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """The ids the model itself gives whole texts, as little-endian int32."""
        memo = self.memo
        if len(memo) > self.memo_size:
            memo.clear()
        cut = [segments(t) for t in texts]
        self.learn({s for parts in cut for s in parts})
        return [b"".join([memo[s] for s in parts]) for parts in cut]

    def decode(self, ids: bytes) -> str:
        table = self.bytes_of
        raw = b"".join([table[i] for i in np.frombuffer(ids, "<i4").tolist()])
        return raw.decode("utf-8", "replace")[1:] if raw[:1] == b" " else raw.decode("utf-8", "replace")


_LOADED: dict[int, Vocabulary] = {}


def vocabulary(model: bytes, memo_size: int = MEMO) -> Vocabulary:
    """One per worker process, so its memo serves all tasks that run there."""
    key = hash(model)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Vocabulary(model)
    _LOADED[key].memo_size = memo_size
    return _LOADED[key]
