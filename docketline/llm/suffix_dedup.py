"""Removal of repeated byte strings: suffix arrays of shards, common prefixes, merging by binary search."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketline.llm.common import (U64, Chunk, KeyFilter, buckets_log2, hash_spans, keyed, materialise, mix, repeated_keys,
                                   text_bytes, text_chunks)

_LAST = (1 << 63) - 1
_GRAM = 24        # bytes of an anchor gram
_WINDOWS = 64     # windows of a segment at most


# ---------------------------------------------------------------- suffix arrays
def suffix_array(text: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """All suffixes of ``text`` (with ``depth`` + 8 spare bytes) in the order of their first ``depth`` bytes
    or more, restricted to ``starts``.

    Larsson-Sadakane refinement: suffixes are sorted by eight bytes, then only groups of
    equal ones are sorted again, by the group of the suffix ``h`` bytes on, doubling ``h``.
    """
    n = len(text) - depth - 8
    key = np.ascontiguousarray(np.ndarray((n + depth,), ">u8", buffer=text, strides=(1,))).astype(U64)
    sa = np.argsort(key)
    k = key[sa]
    head = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
    size = np.diff(np.r_[head, len(sa)])
    group = np.empty(len(sa), np.int64)   # of each suffix: the place in sa where its group begins
    group[sa] = np.repeat(head, size)
    places = np.flatnonzero(np.repeat(size > 1, size))
    h = 8
    while h < depth and len(places):
        at = sa[places]
        inside = at + h < len(group)
        follow = np.where(inside, group[np.minimum(at + h, len(group) - 1)], -1)
        old = group[at]
        # old groups are runs of neighbouring places in order, so one stable sort by (old, follow) keeps them
        order = np.lexsort((follow, old))
        at, old, follow = at[order], old[order], follow[order]
        sa[places] = at
        new = np.r_[True, (old[1:] != old[:-1]) | (follow[1:] != follow[:-1])]
        head = np.flatnonzero(new)
        size = np.diff(np.r_[head, len(at)])
        group[at] = np.repeat(places[head], size)
        places = places[np.repeat(size > 1, size)]
        h *= 2
    use = np.zeros(n + depth, bool)
    use[starts] = True
    return sa[use[sa]]


def common_prefixes(text: np.ndarray, sa: np.ndarray, most: int) -> np.ndarray:
    """Kasai's rule on arrays: lcp[k] of sa[k - 1] and sa[k], up to ``most``; lcp[0] = 0.

    In text order, a suffix whose predecessor in the suffix array is one on from that of the
    suffix before has a common prefix one shorter. Only the others are compared, eight bytes at a time.
    """
    if not len(sa):
        return np.zeros(0, np.int64)
    before = np.full(len(text), -2, np.int64)
    before[sa[1:]] = sa[:-1]
    order = np.sort(sa)
    phi = before[order]
    follows = np.zeros(len(order), bool)
    follows[1:] = (order[1:] == order[:-1] + 1) & (phi[1:] == phi[:-1] + 1) & (phi[:-1] >= 0)
    lanes = np.ndarray((len(text) - 7,), "<u8", buffer=text, strides=(1,))
    lcp = np.zeros(len(order), np.int64)
    enough = 2 * most

    def compare(todo: np.ndarray) -> None:
        lcp[todo] = 0
        for step in range(0, enough, 8):
            a, b = order[todo] + step, phi[todo] + step
            inside = np.maximum(a, b) < len(lanes)
            x = np.full(len(todo), U64(1))
            x[inside] = lanes[a[inside]] ^ lanes[b[inside]]
            low = x & (~x + U64(1))          # the lowest differing bit tells the first differing byte
            lcp[todo] += np.where(x == 0, 8, np.log2(np.maximum(low, U64(1)).astype(np.float64)).astype(np.int64) // 8)
            todo = todo[x == 0]

    compare(np.flatnonzero(~follows & (phi >= 0)))
    place = np.arange(len(order))
    origin = np.maximum.accumulate(np.where(follows, 0, place))
    less = lcp[origin] - (place - origin)
    # what is left of a prefix tells nothing where it is used up, or was not followed to its end
    unsure = follows & ((less <= 0) | ((lcp[origin] >= enough) & (less < most)))
    lcp = np.where(follows, less, lcp)
    compare(np.flatnonzero(unsure))
    lcp = np.minimum(lcp, most)
    back = np.empty(len(text), np.int64)
    back[order] = lcp
    return back[sa]


class Shard:
    """A sorted list of distinct byte strings of one length with the smallest document of each."""

    def __init__(self, keys: np.ndarray, least: np.ndarray):
        self.keys, self.least = keys, least

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """By binary search: where each key stands, and whether it is there."""
        i = np.searchsorted(self.keys, keys)
        i[i == len(self.keys)] = 0
        return i, (self.keys[i] == keys) if len(self.keys) else np.zeros(len(keys), bool)


def _shard_windows(parts: list[np.ndarray], sizes: np.ndarray, doc: np.ndarray, length: int):
    """Suffix array of the windows of some segments. (window starts, class of each window, Shard of classes)"""
    pad = length + 8
    text = np.concatenate([*parts, np.zeros(2 * pad, np.uint8)])
    end = np.cumsum(sizes)
    begin = end - sizes
    count = np.maximum(sizes - length + 1, 0)
    seg = np.repeat(np.arange(len(sizes), dtype=np.int32), count)
    starts = (begin[seg] + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)).astype(np.int32)
    sa = suffix_array(text, starts, length)
    lcp = common_prefixes(text, sa, length)
    first = np.flatnonzero(lcp < length)
    cls = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(sa)]))
    owner = np.zeros(len(text), np.int32)
    owner[starts] = seg
    least = np.minimum.reduceat(doc[owner[sa]], first) if len(first) else np.zeros(0, np.int64)
    of = np.zeros(len(text), np.int32)
    of[sa] = cls
    keys = np.lib.stride_tricks.sliding_window_view(text, length)[sa[first]].view(f"S{length}").ravel() if len(first) else np.zeros(0, f"S{length}")
    return starts, seg, of[starts], Shard(keys, least), begin


# ---------------------------------------------------------------- segments of the texts
def anchor_runs(c: Chunk, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, end window, anchor) of runs of windows with one anchor, within texts.

    A window is ``length`` bytes; its anchor is the least hash of the 24-byte grams in it, so equal
    windows have equal anchors, wherever they are.
    """
    n, gram = int(c.offs[-1]), min(_GRAM, length)
    if n < length:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, U64),)
    span = length - gram + 1
    at_change, least = [], []
    data = np.concatenate([c.data, np.zeros(length + 32, np.uint8)])
    # a gram's hash: its eight-byte lanes from the first to the last, folded
    lanes = sorted({*range(0, max(gram - 8, 0), 8), max(gram - 8, 0)})
    for at in range(0, n, 1 << 16):                  # small blocks stay in the processor's cache
        to = min(n, at + (1 << 16))
        size = to - at + span
        v = np.ndarray((size + lanes[-1],), "<u8", buffer=data, offset=at, strides=(1,)).copy()
        if gram < 8:
            v &= U64((1 << (8 * gram)) - 1)
        m = v[:size] * U64(0x9E3779B97F4A7C15)
        for k in lanes[1:]:
            m = (m ^ v[k:k + size]) * U64(0xC2B2AE3D27D4EB4F)
        m = mix(m)
        done = 1
        while done * 2 <= span:
            m, done = np.minimum(m[:-done], m[done:]), done * 2
        if done < span:
            m = np.minimum(m[:-(span - done)], m[span - done:])
        m = m[:to - at]
        new = np.flatnonzero(np.r_[True, m[1:] != m[:-1]])
        at_change.append(new + at)
        least.append(m[new])
    at_change, least = np.concatenate(at_change), np.concatenate(least)
    some = c.offs[1:] - c.offs[:-1] >= length
    bounds = np.unique(np.concatenate([at_change, c.offs[:-1][some], c.offs[1:][some] - length + 1]))
    a, b = bounds, np.r_[bounds[1:], n]
    use = a + length <= c.offs[np.minimum(np.searchsorted(c.offs, a, "right"), len(c.offs) - 1)]
    a, b = a[use], b[use]
    value = least[np.searchsorted(at_change, a, "right") - 1]
    # a run goes on over the border of a block, but not of a text
    if len(a):
        joined = np.r_[False, (a[1:] == b[:-1]) & (value[1:] == value[:-1])
                       & (np.searchsorted(c.offs, a[1:], "right") == np.searchsorted(c.offs, a[:-1], "right"))]
        first = np.flatnonzero(~joined)
        a, value, b = a[first], value[first], b[np.r_[first[1:] - 1, len(b) - 1]]
    pieces = -(-(b - a) // _WINDOWS)
    if len(pieces) and pieces.max() > 1:             # periodic text: the windows stay, in shorter segments
        r = np.repeat(np.arange(len(a)), pieces)
        k = np.arange(len(r)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        a, b, value = a[r] + k * _WINDOWS, np.minimum(a[r] + (k + 1) * _WINDOWS, b[r]), value[r]
    return a, b, mix(value)                          # least values crowd at the low end; mixed, they deal evenly



def _union(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Disjoint ranges in order that cover the same; ranges that touch become one."""
    order = np.argsort(a, kind="stable")
    a, high = a[order], np.maximum.accumulate(b[order])
    new = np.flatnonzero(np.r_[True, a[1:] > high[:-1]])
    return np.stack([a[new], high[np.r_[new[1:] - 1, len(a) - 1]]], 1).astype(np.int32)


def _doc_spans(doc: np.ndarray, a: np.ndarray, b: np.ndarray) -> list[tuple[int, bytes]]:
    order = np.argsort(doc, kind="stable")
    doc, a, b = doc[order], a[order], b[order]
    cuts = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]]) if len(doc) else []
    return [(int(doc[i]), _union(a[i:j], b[i:j]).tobytes()) for i, j in zip(cuts, np.r_[cuts[1:], len(doc)].astype(int))] if len(doc) else []


class _Segments:
    """A chunk's segments whose anchors pass a filter, equal ones together and in document order.

    An occurrence in a document larger than another one with the same segment in this chunk is decided
    here: ``done`` has its finished spans by document. ``stay`` are the others, by bucket. So
    a hot passage ships once a chunk.
    """

    def __init__(self, c: Chunk, filt, length: int, log2: int):
        a, b, anchor = anchor_runs(c, length)
        use = filt.has(anchor)
        a, b, anchor = a[use], b[use] + length - 1, anchor[use]
        owner = np.searchsorted(c.offs, a, "right") - 1
        self.kid, self.kth = c.column("kid"), c.column("kth")
        oid = _order_id(self.kid)
        content = hash_spans(c.data, a, b) ^ mix(anchor.copy())
        order = np.lexsort((oid[owner], content))
        self.a, self.b, self.anchor, self.owner, self.content = (x[order] for x in (a, b, anchor, owner, content))
        self.local = self.a - c.offs[self.owner]
        new = np.r_[True, self.content[1:] != self.content[:-1]][:len(order)]
        self.group = np.cumsum(new) - 1
        late = oid[self.owner] > oid[self.owner[np.flatnonzero(new)]][self.group] if len(order) else new
        self.rows: dict[int, dict] = {}
        for d, spans in _doc_spans(self.owner[late], self.local[late], (self.local + self.b - self.a)[late]):
            self.rows.setdefault(int(self.kth[d]) % (1 << log2), {}).setdefault("done", []).append((d, spans))
        bucket = (self.anchor >> U64(64 - log2)).astype(np.int64)
        stay = np.flatnonzero(~late)
        stay = stay[np.argsort(bucket[stay], kind="stable")]
        cuts = np.flatnonzero(np.r_[True, np.diff(bucket[stay]) != 0][:len(stay)])
        for i, j in zip(cuts, np.r_[cuts[1:], len(stay)].astype(int)):
            self.rows.setdefault(int(bucket[stay[i]]), {})["stay"] = stay[i:j]

    def packed(self):
        """(bucket, kept occurrences, columns on where they are and on the finished spans)"""
        for k, r in self.rows.items():
            s, done = r.get("stay", np.zeros(0, np.int64)), r.get("done", [])
            docs, own = np.unique(self.owner[s], return_inverse=True)
            docs = np.concatenate([docs, np.array([d for d, _ in done], np.int64)]).astype(np.int64)
            yield k, s, {"bucket": k, "owner": own.astype(np.int32).tobytes(), "at": self.local[s].astype(np.int32).tobytes(),
                         "kids": self.kid[docs].tobytes(), "kths": self.kth[docs].tobytes(), "spans": [x for _, x in done]}


def _order_id(kid: np.ndarray) -> np.ndarray:
    """Ids in order; the key of a null id counts as larger than any id."""
    return np.where(kid == -(1 << 63), _LAST, kid)


def _schema(*columns: str) -> tuple[pa.Schema, str]:
    names = [*columns, "owner", "at", "kids", "kths"]
    return (pa.schema([("bucket", pa.int32()), *[(x, pa.binary()) for x in names], ("spans", pa.list_(pa.binary()))]),
            ", ".join(["bucket int", *[f"{x} binary" for x in names], "spans array<binary>"]))


_DIGESTS, _TEXTS = _schema("content", "anchor", "sizes"), _schema("text", "sizes", "seg")
_SPANS = "bucket int, kid long, kth long, spans binary"


def _ship_digests(filt, length: int, log2: int):
    """Segments whose anchors repeat, as digests."""
    def emit(batches):
        for c in text_chunks(batches):
            g = _Segments(c, filt.value, length, log2)
            yield pa.RecordBatch.from_pylist([
                {**where, "content": g.content[s].tobytes(), "sizes": (g.b - g.a)[s].astype(np.int32).tobytes(),
                 "anchor": (g.anchor[s] >> U64(32 - log2)).astype(np.uint32).tobytes()} for _, s, where in g.packed()], _DIGESTS[0])
    return emit


def _ship_texts(filt, length: int, log2: int):
    """Segments whose anchors stand in different segments, as texts: the distinct ones of a chunk once."""
    def emit(batches):
        for c in text_chunks(batches):
            g = _Segments(c, filt.value, length, log2)
            out = []
            for _, s, where in g.packed():
                _, first, seg = np.unique(g.group[s], return_index=True, return_inverse=True)
                f = s[first]
                out.append({**where, "text": b"".join(c.data[x:y].tobytes() for x, y in zip(g.a[f], g.b[f])),
                            "sizes": (g.b - g.a)[f].astype(np.int32).tobytes(), "seg": seg.astype(np.int32).tobytes()})
            yield pa.RecordBatch.from_pylist(out, _TEXTS[0])
    return emit


def _gathered(t: pa.Table, kinds: dict[str, type]):
    """A bucket's occurrences: arrays of kid, kth, at and the named columns, and the finished spans."""
    out, done = {k: [] for k in ("kid", "kth", "at", *kinds)}, []
    for r in t.to_pylist():
        kids, kths = np.frombuffer(r["kids"], np.int64), np.frombuffer(r["kths"], np.int64)
        own, spans = np.frombuffer(r["owner"], np.int32), r["spans"] or []
        n = len(kids) - len(spans)
        done += list(zip(kids[n:].tolist(), kths[n:].tolist(), spans))
        out["kid"].append(kids[own])
        out["kth"].append(kths[own])
        out["at"].append(np.frombuffer(r["at"], np.int32).astype(np.int64))
        for name, kind in kinds.items():
            out[name].append(np.frombuffer(r[name], kind))
    return out, done


def _spans_table(bucket: int, rows: list[tuple]) -> pa.Table:
    return pa.table({"bucket": pa.array([bucket] * len(rows), pa.int32()), "kid": pa.array([x[0] for x in rows], pa.int64()),
                     "kth": pa.array([x[1] for x in rows], pa.int64()), "spans": pa.array([x[2] for x in rows], pa.binary())})


def _by_document(kid, kth, a, b) -> list[tuple]:
    keys = np.stack([kid, kth], 1)
    if not len(keys):
        return []
    who, inv = np.unique(keys, axis=0, return_inverse=True)
    return [(int(who[d, 0]), int(who[d, 1]), s) for d, s in _doc_spans(inv.ravel(), a, b)]


def _settle(log2: int, log2_filter: int):
    """By digest: occurrences after a smaller document with the same segment go whole. The anchors
    that stand in different segments are marked in the bucket's slice of a filter (a row without a key)."""
    def run(t: pa.Table) -> pa.Table:
        bucket = t.column("bucket")[0].as_py()
        cols, out = _gathered(t, {"content": U64, "anchor": np.uint32, "sizes": np.int32})
        kid, kth, at, content, anchor, size = (np.concatenate(cols[x]) for x in ("kid", "kth", "at", "content", "anchor", "sizes"))
        oid = _order_id(kid)
        _, first, one = np.unique(content, return_index=True, return_inverse=True)
        least = np.full(len(first), _LAST)
        np.minimum.at(least, one, oid)
        late = oid > least[one]
        out += _by_document(kid[late], kth[late], at[late], at[late] + size[late])
        several, n = np.unique(anchor[first], return_counts=True)
        marks = np.zeros(1 << (log2_filter - log2), bool)
        marks[several[n > 1] >> np.uint32(32 - (log2_filter - log2))] = True
        return _spans_table(bucket, [*out, (None, None, np.packbits(marks, bitorder="little").tobytes())])
    return run


def _resolve(length: int, shard_bytes: int):
    """A bucket holds all windows of its anchors. Its distinct segments go into shards of bounded size, each with
    a suffix array; classes of equal windows meet across shards by binary search."""
    def run(t: pa.Table) -> pa.Table:
        base, parts, sizes, content, seg = 0, [], [], [], []
        cols, out = _gathered(t, {})
        for r in t.select(["text", "sizes", "seg"]).to_pylist():
            size = np.frombuffer(r["sizes"], np.int32).astype(np.int64)
            data = np.frombuffer(r["text"] + bytes(8), np.uint8)
            end = np.cumsum(size)
            parts.append(data[:-8])
            content.append(hash_spans(data, end - size, end))
            sizes.append(size)
            seg.append(np.frombuffer(r["seg"], np.int32) + base)
            base += len(size)
        kid, kth, at, sizes, content, seg = (np.concatenate(x) for x in (cols["kid"], cols["kth"], cols["at"], sizes, content, seg))
        ids, text, end = _order_id(kid), np.concatenate(parts), np.cumsum(sizes)
        # equal segments of different chunks become one, with its smallest document
        _, first, one = np.unique(content + mix(sizes.astype(U64)), return_index=True, return_inverse=True)
        one = one[seg]
        least = np.full(len(first), _LAST)
        np.minimum.at(least, one, ids)
        gone = _removed([text[end[f] - sizes[f]:end[f]] for f in first], sizes[first], least, length, shard_bytes)
        late = ids > least[one]
        early = np.flatnonzero(~late)
        lo, hi = np.searchsorted(gone[0], one[early]), np.searchsorted(gone[0], one[early], "right")
        n = hi - lo
        row = np.repeat(early, n)
        g = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        o = np.concatenate([np.flatnonzero(late), row])
        a = np.concatenate([at[late], at[row] + gone[1][g]])
        b = np.concatenate([at[late] + sizes[first][one[late]], at[row] + gone[2][g]])
        out += _by_document(kid[o], kth[o], a, b)
        return _spans_table(t.column("bucket")[0].as_py(), out)
    return run


def _removed(parts: list[np.ndarray], sizes: np.ndarray, least: np.ndarray, length: int, shard_bytes: int):
    """(segment, from, to): the byte ranges of segments covered by windows that a smaller document has too."""
    shard = np.cumsum(sizes) // max(1, shard_bytes)
    cuts = np.r_[0, np.flatnonzero(np.diff(shard)) + 1, len(sizes)]
    made = [(int(i), _shard_windows(parts[i:j], sizes[i:j], least[i:j], length)) for i, j in zip(cuts, cuts[1:]) if j > i]
    for x in range(len(made)):                       # cross-shard: each class learns the smallest document of all shards
        for y in range(x + 1, len(made)):
            one, two = made[x][1][3], made[y][1][3]
            at, there = two.find(one.keys)
            both = np.minimum(one.least[there], two.least[at[there]])
            one.least[there], two.least[at[there]] = both, both
    seg_out, a_out, b_out = [], [], []
    for i, (starts, seg, cls, classes, begin) in made:
        hit = classes.least[cls] < least[i + seg]
        s, p = seg[hit], (starts - begin[seg])[hit]
        if len(s):
            new = np.r_[True, (s[1:] != s[:-1]) | (p[1:] > p[:-1] + length)]
            head = np.flatnonzero(new)
            tail = np.r_[head[1:] - 1, len(s) - 1]
            seg_out.append(s[head] + i), a_out.append(p[head]), b_out.append(p[tail] + length)
    return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in (seg_out, a_out, b_out))


def _cut(batches):
    for b in batches:
        texts, spans = b.column("text"), b.column("spans").to_pylist()
        n_bytes, n_removed, n_spans, kept = [], [], [], []
        for k, parts in enumerate(spans):
            raw = texts[k].as_py()
            n_bytes.append(len(raw))
            if parts:
                s = np.frombuffer(b"".join(parts), np.int32).reshape(-1, 2)
                s = _union(s[:, 0], s[:, 1])
                edge = np.r_[0, s.ravel(), len(raw)]
                raw = b"".join(raw[x:y] for x, y in zip(edge[::2].tolist(), edge[1::2].tolist()))
            n_spans.append(len(s) if parts else 0)
            n_removed.append(n_bytes[-1] - len(raw))
            kept.append(raw)
        yield pa.record_batch({"doc_id": b.column("doc_id"), "n_bytes": pa.array(n_bytes, pa.int64()),
                               "n_removed": pa.array(n_removed, pa.int64()), "n_spans": pa.array(n_spans, pa.int64()),
                               "kept": pa.array(kept, pa.binary())})


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 50,
                   shard_bytes: int = 1 << 20) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept), one row per input row; ``kept`` is binary.

    Each byte covered by a ``length``-byte string that also starts in a document
    with a smaller id goes, judged on the input.

    1. Every window has an anchor, the least hash of its 24-byte grams; equal windows have equal anchors.
       Anchors that occur once cannot repeat (``repeated_keys``, a bitmap of bounded size). The windows
       with a repeating anchor make segments, dealt by anchor, so that equal windows meet.
    2. Segments travel as digests first. A segment that a smaller document has too goes whole. An anchor all
       of whose segments are equal is settled by that; the others are marked in a second bitmap.
    3. Only their segments travel as texts. A bucket's distinct segments form shards of at most ``shard_bytes``
       (suffix array, common prefixes); shards meet by binary search.
    4. Ranges go back to the texts by document key.

    A chunk ships equal segments once, for its smallest document: the others are decided there.
    Null ids count as larger than any id; rows of equal ids remove nothing from
    each other. Null texts are empty; an empty table gives no rows.
    """
    spark = docs.sparkSession
    src = keyed(docs, id_col, text_col).select("doc_id", "kid", "kth", F.col("text").cast("binary").alias("text"))
    total = text_bytes(src)
    first = repeated_keys(src, lambda c: anchor_runs(c, length)[2], total)
    log2 = min(buckets_log2(total, 64 << 20), 16, first.log2 - 3)
    settled = materialise(
        src.mapInArrow(_ship_digests(spark.sparkContext.broadcast(first), length, log2), _DIGESTS[1]).groupBy("bucket")
        .applyInArrow(_settle(log2, first.log2), _SPANS), "settled")
    second = KeyFilter(np.zeros(1 << (first.log2 - 3), np.uint8), first.log2)
    step = len(second.bits) >> log2
    for r in settled.where("kid is null").select("bucket", "spans").toLocalIterator():
        second.bits[r["bucket"] * step:(r["bucket"] + 1) * step] = np.frombuffer(r["spans"], np.uint8)
    log2 = min(buckets_log2(total, 8 << 20), 20, first.log2)
    resolved = (src.mapInArrow(_ship_texts(spark.sparkContext.broadcast(second), length, log2), _TEXTS[1]).groupBy("bucket")
                .applyInArrow(_resolve(length, shard_bytes), _SPANS))
    spans = (settled.where("kid is not null").unionByName(resolved)
             .groupBy("kid", "kth").agg(F.collect_list("spans").alias("spans")))
    marked = src.join(spans.hint("shuffle_hash"), ["kid", "kth"], "left").select("doc_id", "text", "spans")
    return marked.mapInArrow(_cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
