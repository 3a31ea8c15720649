"""Line dedup over range-partitioned line hashes; documents get keep bitmaps."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketline.llm.common import LOWER, Chunk, carried, hash_spans, keyed, text_chunks, word_spans

_KEY = ["h", "len"]
_ROW = "h long, len int, kid long, kth long, pos int"


def line_table(c: Chunk) -> tuple[np.ndarray, ...]:
    """(text index, line number, raw start, raw end, key start, key end) of every line of a chunk."""
    breaks = np.flatnonzero(c.data[:int(c.offs[-1])] == 10)
    starts = np.concatenate([c.offs[:-1], breaks + 1])
    doc = np.concatenate([np.arange(len(c)), np.searchsorted(c.offs, breaks, "right") - 1])
    # by text, then place: a text that ends with a break has its last start where the next text begins
    order = np.lexsort((starts, doc))
    doc, starts = doc[order], starts[order]
    last = np.r_[doc[1:] != doc[:-1], True]
    ends = np.empty_like(starts)
    ends[:-1] = starts[1:] - 1
    ends[last] = c.offs[1:][doc[last]]
    first = np.searchsorted(doc, np.arange(len(c)))
    ws, we, _ = word_spans(c.data, c.offs)
    i, j = np.searchsorted(ws, starts), np.searchsorted(we, ends, "right")
    some = j > i
    ks, ke = starts.copy(), starts.copy()
    ks[some], ke[some] = ws[i[some]], we[j[some] - 1]
    return doc, np.arange(len(doc)) - first[doc], starts, ends, ks, ke


def _line_rows(min_chars: int):
    def emit(batches):
        for c in text_chunks(batches):
            doc, pos, _, _, ks, ke = line_table(c)
            lower = LOWER[c.data]
            points = np.r_[0, np.cumsum((lower & 0xC0) != 0x80)]
            use = points[ke] - points[ks] >= max(1, min_chars)
            doc, pos, ks, ke = doc[use], pos[use], ks[use], ke[use]
            kid, kth = c.column("kid"), c.column("kth")
            yield pa.record_batch({
                "h": pa.array(hash_spans(lower, ks, ke).view(np.int64)), "len": pa.array((ke - ks).astype(np.int32)),
                "kid": pa.array(kid[doc]), "kth": pa.array(kth[doc]), "pos": pa.array(pos.astype(np.int32))})
    return emit


class _Runs:
    """Rows of one sorted partition as arrays, and the runs of equal keys in them."""

    def __init__(self, batch: pa.RecordBatch):
        self.h, self.len, self.kid, self.kth, self.pos = (
            batch.column(c).to_numpy(zero_copy_only=False) for c in ("h", "len", "kid", "kth", "pos"))
        new = np.r_[True, (self.h[1:] != self.h[:-1]) | (self.len[1:] != self.len[:-1])]
        self.newdoc = new | np.r_[True, (self.kid[1:] != self.kid[:-1]) | (self.kth[1:] != self.kth[:-1])]
        self.start = np.flatnonzero(new)
        self.end = np.r_[self.start[1:], len(self.h)]
        self.docs = np.add.reduceat(self.newdoc.astype(np.int64), self.start)

    def key(self, r):
        i = self.start[r]
        return int(self.h[i]), int(self.len[i])

    def same_as(self, i):
        return (self.kid == self.kid[i]) & (self.kth == self.kth[i]) & (self.pos == self.pos[i])

    def at(self, i):
        return int(self.kid[i]), int(self.kth[i]), int(self.pos[i])


def _edges(batches):
    """The first and the last run of a partition, which may go on in its neighbours:
    key, number of documents, first occurrence."""
    first = cur = None
    for b in batches:
        if not b.num_rows:
            continue
        t = _Runs(b)
        for r in range(len(t.start)) if len(t.start) < 3 else (0, len(t.start) - 1):
            key, docs, i, j = t.key(r), int(t.docs[r]), t.start[r], t.end[r] - 1
            if cur and cur["key"] == key:
                cur["docs"] += docs - (cur["last"][:2] == t.at(i)[:2])
                cur["last"] = t.at(j)
            else:
                first = first or cur
                cur = {"key": key, "docs": docs, "first": t.at(i), "last": t.at(j)}
    out = [x for x in (first, cur) if x]
    yield pa.record_batch({
        "h": pa.array([x["key"][0] for x in out], pa.int64()), "len": pa.array([x["key"][1] for x in out], pa.int32()),
        "docs": pa.array([x["docs"] for x in out], pa.int64()),
        **{n: pa.array([x["first"][k] for x in out], t) for k, (n, t) in enumerate(
            (("kid", pa.int64()), ("kth", pa.int64()), ("pos", pa.int32())))}})


def _drops(edge: dict, min_docs: int, keep_first: bool):
    """Rows to drop, streamed in order. ``edge`` has the whole count and first occurrence of the runs at borders."""
    def emit(batches):
        cur, docs, last, first, held = None, 0, None, None, []
        for b in batches:
            if not b.num_rows:
                continue
            t = _Runs(b)
            drop = np.repeat(t.docs >= min_docs, t.end - t.start)
            if keep_first:  # a row that repeats the first occurrence (a repeated document) stays with it
                drop[t.same_as(np.repeat(t.start, t.end - t.start))] = False
            for r in {0, len(t.start) - 1}:  # runs that can go on in another batch or partition
                key, i, j = t.key(r), t.start[r], t.end[r]
                if key != cur:
                    cur, docs, last, first, held = key, 0, None, t.at(i), []
                docs += int(t.docs[r]) - (last == t.at(i)[:2])
                last = t.at(j - 1)[:2]
                total, origin = edge.get(key, (docs, first))
                drop[i:j] = total >= min_docs
                if keep_first:
                    drop[i:j][(t.kid[i:j] == origin[0]) & (t.kth[i:j] == origin[1]) & (t.pos[i:j] == origin[2])] = False
                if total < min_docs:
                    held.append((t.kid[i:j], t.kth[i:j], t.pos[i:j]))  # fewer than min_docs documents
                elif held:
                    kid, kth, pos = (np.concatenate([x[k] for x in held]) for k in range(3))
                    stay = (kid == origin[0]) & (kth == origin[1]) & (pos == origin[2]) & keep_first
                    held = []
                    yield pa.record_batch({"kid": pa.array(kid[~stay]), "kth": pa.array(kth[~stay]),
                                           "pos": pa.array(pos[~stay])})
            yield pa.record_batch({"kid": pa.array(t.kid[drop]), "kth": pa.array(t.kth[drop]),
                                   "pos": pa.array(t.pos[drop])})
    return emit


def _bitmaps(batches):
    """Position lists to compressed bitmaps: bit i is 0 where line i goes; later lines stay."""
    for b in batches:
        out = []
        for pos in b.column("pos").to_pylist():
            keep = np.ones(-(-(max(pos) + 1) // 8) * 8, bool)
            keep[pos] = False
            out.append(zlib.compress(np.packbits(keep, bitorder="little").tobytes(), 6))
        yield pa.record_batch({"kid": b.column("kid"), "kth": b.column("kth"), "keep_bitmap": pa.array(out, pa.binary())})


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 10,
                 min_chars: int = 1, keep_first: bool = False) -> DataFrame:
    """(kid, kth, keep_bitmap) for each document that loses lines (see ``common.keyed`` for the key).

    A line's key is the line without ASCII white space at its ends, A-Z lowered.
    Keys of at least ``min_chars`` code points in at least ``min_docs`` documents
    go: all their lines, or all but the first occurrence in (id, line) order
    with ``keep_first``. The bitmap is zlib-compressed, little-endian.

    Lines become (hash, length, document, line number) rows, range-partitioned by
    hash and document and sorted within, so a hot line spans many partitions.
    The partitions are pinned by a reliable checkpoint. A first pass reports only
    the runs at partition borders (two a partition); with their totals the second
    pass streams each partition and knows every run's verdict.
    Empty lines have no key and stay; null texts are one empty line; an empty table gives no rows.
    """
    src = keyed(docs, id_col, text_col).select("kid", "kth", F.col("text").cast("binary").alias("text"))
    lines = (src.mapInArrow(_line_rows(min_chars), _ROW)
             .repartitionByRange(*_KEY, "kid", "kth").sortWithinPartitions(*_KEY, "kid", "kth", "pos").checkpoint())
    edges = (lines.mapInArrow(_edges, "h long, len int, docs long, kid long, kth long, pos int")
             .groupBy(*_KEY).agg(F.sum("docs").alias("docs"), F.min(F.struct("kid", "kth", "pos")).alias("f")))
    edge = {(r["h"], r["len"]): (r["docs"], tuple(r["f"])) for r in edges.collect()}
    drops = lines.mapInArrow(_drops(edge, min_docs, keep_first), "kid long, kth long, pos int")
    return (drops.groupBy("kid", "kth").agg(F.collect_set("pos").alias("pos"))
            .mapInArrow(_bitmaps, "kid long, kth long, keep_bitmap binary"))


def _apply(batches):
    for c in text_chunks(batches):
        doc, pos, starts, ends, _, _ = line_table(c)
        cuts = np.searchsorted(doc, np.arange(len(c) + 1))
        n_lines = np.diff(cuts)
        kept, n_dropped = [], []
        for d, bitmap in enumerate(c.rows.column("keep_bitmap").to_pylist()):
            raw = c.data[c.offs[d]:c.offs[d + 1]].tobytes()
            gone = 0
            if bitmap is not None:
                keep = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), bitorder="little").astype(bool)
                lines = raw.split(b"\n")
                stays = [x for k, x in enumerate(lines) if k >= len(keep) or keep[k]]
                gone, raw = len(lines) - len(stays), b"\n".join(stays)
            kept.append(raw)
            n_dropped.append(gone)
        yield pa.record_batch({
            "doc_id": c.rows.column("doc_id"), "n_lines": pa.array(n_lines.astype(np.int64)),
            "n_dropped": pa.array(n_dropped, pa.int64()), "kept": pa.array(kept, pa.binary()).cast(pa.string()),
            "row": c.rows.column("row")})


def drop_common_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None,
                      **how) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept[, row]), one row per input row: bitmaps applied to the texts.

    The bitmaps join the texts by document key, so each text moves once. Rows
    that repeat id and text count as one document and all lose the same lines.
    """
    src = docs.withColumn("_carried", carried(carry))
    src = keyed(src, id_col, text_col, "_carried").withColumnRenamed("_carried", "row")
    marked = (src.join(keep_bitmaps(docs, id_col, text_col, **how).hint("shuffle_hash"), ["kid", "kth"], "left")
              .select("doc_id", F.col("text").cast("binary").alias("text"), "keep_bitmap", "row"))
    kind = marked.schema["row"].dataType.simpleString()
    out = marked.mapInArrow(_apply, f"doc_id long, n_lines long, n_dropped long, kept string, row {kind}")
    return out.select("doc_id", "n_lines", "n_dropped", "kept", *(["row"] if carry else []))
