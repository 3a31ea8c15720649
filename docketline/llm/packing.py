"""Operator 13: token ids of texts packed into windows by minimum bin slack.

One narrow pass: a task tokenises its texts, cuts each document's ids into whole windows and a rest, and packs the
rests of a bounded block. For each window, a subset-sum dynamic programme over the multiset of remaining
lengths (a bitset: bit s is set if some lengths sum to s) finds the fullest filling that holds the longest rest;
walking back through the bitsets gives how many of each length it takes. Nothing is shuffled, and no block depends on another.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketline.llm.common import Chunk, hash_spans, text_chunks

END = 0
_GAP = np.zeros(256, bool)
_GAP[[9, 10, 13, 32]] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_SIGN = np.zeros(256, bool)
_SIGN[33:48] = _SIGN[58:65] = _SIGN[91:97] = _SIGN[123:127] = True


# ---------------------------------------------------------------- token ids
def unit_starts(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Places where the pre-tokenizer of a byte-level BPE always cuts, starts of texts included.

    A cut is sure before ASCII white space that follows something else (a byte that may end white space
    beyond ASCII counts as white space), and before ASCII punctuation that follows an ASCII letter.
    """
    n = int(offs[-1])
    b = data[:n]
    cut = np.zeros(n, bool)
    if n > 1:
        before = b[:-1]
        two, three = np.zeros(n - 1, np.uint8), np.zeros(n - 1, np.uint8)
        two[1:], three[2:] = b[:-2], b[:-3]
        blank = (before < 33) | (two == 0xC2) | ((three >= 0xE1) & (three <= 0xE3))
        cut[1:] = (_GAP[b[1:]] & ~blank) | (_LETTER[before] & _SIGN[b[1:]])
    cut[offs[:-1][offs[:-1] < n]] = True
    return np.flatnonzero(cut)


class UnitCoder:
    """Ids of texts by way of their distinct units, of which the newest million are remembered.

    A unit's ids do not depend on its neighbours. Texts that hold an added token are coded whole.
    """

    MOST = 1_000_000
    _kept: dict[str, "UnitCoder"] = {}

    def __init__(self, spec: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.added = [t["content"].encode() for t in json.loads(spec)["added_tokens"]]
        self._forget()

    @classmethod
    def of(cls, spec: str) -> "UnitCoder":
        """The worker's coder for a tokenizer; workers live on from task to task."""
        name = hashlib.sha256(spec.encode()).hexdigest()
        if name not in cls._kept:
            cls._kept.clear()
            cls._kept[name] = cls(spec)
        return cls._kept[name]

    def _forget(self) -> None:
        self.keys, self.at, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, keys: np.ndarray, spans: list[bytes]) -> None:
        if len(self.keys) + len(keys) > self.MOST:
            self._forget()
        new = self._encode([s.decode() for s in spans])
        size = np.fromiter(map(len, new), np.int64, len(new))
        flat = np.fromiter((i for ids in new for i in ids), np.uint32, int(size.sum()))
        keys, at = np.r_[self.keys, keys], np.r_[self.at, len(self.ids) + np.cumsum(size) - size]
        order = np.argsort(keys, kind="stable")
        self.keys, self.at, self.size = keys[order], at[order], np.r_[self.size, size][order]
        self.ids = np.r_[self.ids, flat]

    def encode(self, c: Chunk) -> list[np.ndarray]:
        """The ids of each text of a chunk, without an end id."""
        out: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(c)
        starts = unit_starts(c.data, c.offs)
        if not len(starts):
            return out
        ends = np.r_[starts[1:], c.offs[-1]]
        keys, first, place = np.unique(hash_spans(c.data, starts, ends), return_index=True, return_inverse=True)
        known = np.zeros(len(keys), bool)
        if len(self.keys):
            known = self.keys[np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)] == keys
        if len(self.keys) + int((~known).sum()) > self.MOST:
            known[:] = False                                # _learn starts anew
        raw = c.data.tobytes()
        if not known.all():
            self._learn(keys[~known], [raw[starts[i]:ends[i]] for i in first[~known]])
        row = np.searchsorted(self.keys, keys)[place]
        size = self.size[row]
        upto = np.cumsum(size)
        flat = self.ids[np.arange(int(upto[-1])) + np.repeat(self.at[row] - (upto - size), size)]
        cuts = np.r_[0, upto][np.searchsorted(starts, c.offs)]
        out = [flat[cuts[i]:cuts[i + 1]] for i in range(len(c))]
        if any(a in raw for a in self.added):
            for i in range(len(c)):
                text = raw[c.offs[i]:c.offs[i + 1]]
                if any(a in text for a in self.added):
                    out[i] = np.array(self._encode([text.decode()])[0], np.uint32)
        return out


# ---------------------------------------------------------------- minimum bin slack
def fullest(counts: dict[int, int], capacity: int, first: int) -> dict[int, int]:
    """How many of each length fill ``capacity`` best, with at least one of length ``first``.

    Bit s of a bitset: some of the lengths so far, with ``first``, sum to s. Copies of a length enter in
    powers of two, so a length costs one shift per power. Stops at the first filling without slack.
    """
    reach, mask, steps = 1 << first, (1 << capacity + 1) - 1, []
    for length in sorted(counts, reverse=True):
        left = min(counts[length] - (length == first), (capacity - first) // length)
        power = 1
        while left > 0 and not reach >> capacity & 1:
            take = min(power, left)
            steps.append((length, take, reach))
            reach |= reach << length * take & mask
            left, power = left - take, power * 2
        if reach >> capacity & 1:
            break
    total, chosen = reach.bit_length() - 1, {first: 1}
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            chosen[length] = chosen.get(length, 0) + take
            total -= length * take
    return chosen


Piece = tuple[int, int, int]                                # (document, first id, number of ids)


def pack_rests(rests: list[Piece], window: int) -> list[list[Piece]]:
    """Pieces shorter than ``window`` as sequences: full ones, then at the end ones whose lengths are powers of two.

    Each window takes the filling with the least slack. Where that is not 0, it also takes the first ids of the
    longest piece that is left; what remains of that piece is a piece again.
    """
    free: dict[int, list[Piece]] = {}
    for p in sorted(rests, key=lambda p: (-p[2], p[0], p[1]), reverse=True):
        free.setdefault(p[2], []).append(p)
    left, out = sum(p[2] for p in rests), []

    def pop(length: int) -> Piece:
        p = free[length].pop()
        if not free[length]:
            del free[length]
        return p

    while left >= window:
        counts = {k: len(v) for k, v in free.items()}
        chosen = fullest(counts, window, max(free))
        slack = window - sum(k * n for k, n in chosen.items())
        for _ in range(min(counts[k] // n for k, n in chosen.items()) if not slack else 1):
            seq = [pop(k) for k, n in chosen.items() for _ in range(n)]
            if slack:
                doc, start, length = pop(max(free))
                cut = min(slack, length)
                seq.append((doc, start, cut))
                while cut < slack:                          # shorter ones are used up whole, then the last is cut
                    slack -= cut
                    doc, start, length = pop(max(free))
                    cut = min(slack, length)
                    seq.append((doc, start, cut))
                if cut < length:
                    free.setdefault(length - cut, []).append((doc, start + cut, length - cut))
            out.append(seq)
            left -= window
    tail = [p for k in sorted(free, reverse=True) for p in free[k]]
    while left:
        room, seq = 1 << left.bit_length() - 1, []
        left -= room
        while room:
            doc, start, length = tail.pop(0)
            cut = min(room, length)
            seq.append((doc, start, cut))
            if cut < length:
                tail.insert(0, (doc, start + cut, length - cut))
            room -= cut
        out.append(seq)
    return out


# ---------------------------------------------------------------- the operator
SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def pack_sequences(docs: DataFrame, tokenizer_path: str, window: int = 1024, block_tokens: int = 1 << 22) -> DataFrame:
    """A row per piece: (doc_id, start, length, ids, doc_tokens, sequence_id, offset).

    A document's ids are those of its text (null: empty) without special tokens, then id 0. ``ids`` holds a
    piece's ids as little-endian unsigned 32-bit numbers; ``start`` is the number of the document's ids before it, ``offset``
    its place in its sequence. Every id is in one piece. A sequence has ``window`` ids, or a power of two of them at the end of a
    block: no padding is needed. The rests of about ``block_tokens`` ids (at most) are packed together in memory.

    A document is a row: rows that repeat an id or a text, and rows without an id, are packed each for itself. An
    empty text is the end id alone; a text of any length is cut, never shortened. An empty table gives no rows. Other columns
    are not looked at. Sequence ids are those of task and place; read ``docs`` from files, so that a task run anew sees the same rows.
    """
    spec = docs.sparkSession.sparkContext.broadcast(Path(tokenizer_path).read_text())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part = UnitCoder.of(spec.value), TaskContext.get().partitionId() << 33
        serial, rests, held, waiting = 0, [], {}, 0

        def rows(pieces, names):
            """pieces: (doc, start, ids, sequence, offset); names: the documents' (id, number of ids)."""
            for at in range(0, len(pieces), 4096):
                some = pieces[at:at + 4096]
                lengths = [len(p[2]) for p in some]
                yield pa.record_batch([
                    pa.array([names[p[0]][0] for p in some], pa.int64()), pa.array([p[1] for p in some], pa.int64()),
                    pa.array(lengths, pa.int64()), pa.array([p[2].astype("<u4").tobytes() for p in some], pa.binary()),
                    pa.array([names[p[0]][1] for p in some], pa.int64()),
                    pa.array([part + p[3] for p in some], pa.int64()), pa.array([p[4] for p in some], pa.int64())],
                    names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

        def flush():
            nonlocal serial
            pieces = []
            for seq in pack_rests(rests, window):
                offset = 0
                for doc, start, length in seq:
                    ids, base = held[doc][2], held[doc][3]
                    pieces.append((doc, start, ids[start - base:start - base + length], serial, offset))
                    offset += length
                serial += 1
            yield from rows(pieces, held)
            rests.clear()
            held.clear()

        number = 0
        for c in text_chunks(batches, max_bytes=8 << 20):
            whole, names = [], {}
            doc_ids = c.rows.column("doc_id").to_pylist()
            for doc_id, ids in zip(doc_ids, coder.encode(c)):
                ids = np.r_[ids, np.uint32(END)]
                cut = len(ids) - len(ids) % window
                names[number] = (doc_id, len(ids))
                for start in range(0, cut, window):
                    whole.append((number, start, ids[start:start + window], serial, 0))
                    serial += 1
                if cut < len(ids):
                    rests.append((number, cut, len(ids) - cut))
                    held[number] = (doc_id, len(ids), ids[cut:].copy(), cut)
                    waiting += len(ids) - cut
                number += 1
            yield from rows(whole, names)
            if waiting >= block_tokens:
                yield from flush()
                waiting = 0
        yield from flush()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, SCHEMA)
