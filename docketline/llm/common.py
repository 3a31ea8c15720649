"""Helpers shared by the text operators: folders, row keys, Arrow text chunks,
vectorised word hashing and the bounded filter of keys that repeat."""

from __future__ import annotations

import contextlib
import ctypes
import math
import sys
import tempfile
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docketline.session import shuffles_dropped

U64 = np.uint64
_CKPT = "spark.checkpoint.dir"
_C1, _C2, _C3 = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB), U64(0x9E3779B97F4A7C15)

#: byte tables: A-Z lowered; ASCII white space (space, tab to carriage return)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
_MASK = np.array([(1 << (8 * k)) - 1 for k in range(8)], dtype=U64)


# ---------------------------------------------------------------- folders
def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder named by ``spark.checkpoint.dir``.

    Where the setting is absent, a local session gets a temporary folder; on a
    cluster that would lose data with its machine, so it raises instead.
    """
    sc = spark.sparkContext
    base = sc.getConf().get(_CKPT, None) or sc.getCheckpointDir()
    if not base:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="docketline-llm-")
        sc.setCheckpointDir(base)
    return f"{base.rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def mounted(spark: SparkSession, path: str) -> str | None:
    """The plain path under which every machine sees ``path``, or None if it is not on a mounted file system."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    scheme = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getUri().getScheme()
    return p.toUri().getPath() if scheme == "file" else None


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts the lineage,
    pins generated ids, and survives lost executors. The shuffles behind it are not needed again and go."""
    path = scratch(df.sparkSession, name)
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keyed(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more: str) -> DataFrame:
    """(doc_id, text, kid, kth[, more]): the text with null as empty, and a non-null row key.

    Rows that repeat both id and text share a key (they are one document); rows
    that repeat an id with another text do not. Other columns are left out.
    """
    doc, text = F.col(id_col).cast("long"), F.coalesce(F.col(text_col), F.lit(""))
    return df.select(doc.alias("doc_id"), text.alias("text"),
                     F.coalesce(doc, F.lit(-(1 << 63))).alias("kid"),
                     F.xxhash64(text, doc.isNull()).alias("kth"), *more)


def carried(columns: list[str] | None) -> Column:
    """The columns that an operator passes on untouched, as one struct, so that no name can clash."""
    return F.struct(*[F.col(f"`{c}`") for c in columns]) if columns else F.lit(None).cast("struct<none:int>")


def text_bytes(df: DataFrame, col: str = "text") -> int:
    return df.agg(F.coalesce(F.sum(F.octet_length(col)), F.lit(0)).alias("n")).first()["n"]


# ---------------------------------------------------------------- Arrow text chunks
@dataclass
class Chunk:
    """Some whole texts of a batch. ``data`` has 8 zero bytes after the last text."""

    rows: pa.RecordBatch
    offs: np.ndarray
    data: np.ndarray

    def __len__(self) -> int:
        return len(self.offs) - 1

    def column(self, name: str) -> np.ndarray:
        return self.rows.column(name).to_numpy(zero_copy_only=False)


def free_large_arrays() -> None:
    """Let the C library give arrays of 2 MB or more back to the system when they are freed: workers live on
    from stage to stage. Without glibc nothing changes."""
    if sys.platform == "linux":
        with contextlib.suppress(OSError, AttributeError):
            ctypes.CDLL(None).mallopt(-3, 2 << 20)       # M_MMAP_THRESHOLD


def text_chunks(batches: Iterator[pa.RecordBatch], col: str = "text", max_bytes: int = 2 << 20) -> Iterator[Chunk]:
    """Cut batches into runs of whole texts of about ``max_bytes``; a longer text is a chunk alone."""
    free_large_arrays()
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = batch.column(col).cast(pa.binary())
        _, offs, data = texts.buffers()
        offs = np.frombuffer(offs, np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
        raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        at = 0
        while at < len(texts):
            to = max(at + 1, int(np.searchsorted(offs, offs[at] + max_bytes, "right")) - 1)
            buf = np.zeros(offs[to] - offs[at] + 8, np.uint8)
            buf[:-8] = raw[offs[at]:offs[to]]
            yield Chunk(batch.slice(at, to - at), offs[at:to + 1] - offs[at], buf)
            at = to


# ---------------------------------------------------------------- words and hashes
def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser; works in place on a fresh array."""
    x ^= x >> U64(30)
    x *= _C1
    x ^= x >> U64(27)
    x *= _C2
    x ^= x >> U64(31)
    return x


def word_spans(data: np.ndarray, offs: np.ndarray, gap: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text index) of each maximal run of bytes outside ``gap``, within texts."""
    n = int(offs[-1])
    word = ~gap[data[:n]]
    before = np.empty_like(word)
    before[:1], before[1:] = False, word[:-1]
    before[offs[:-1][offs[:-1] < n]] = False
    after = np.empty_like(word)
    after[-1:], after[:-1] = False, word[1:]
    after[(offs[1:] - 1)[offs[1:] > offs[:-1]]] = False
    starts, ends = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1
    return starts, ends, np.searchsorted(offs, starts, "right") - 1


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans, eight bytes at a time."""
    lanes = np.ndarray((len(data) - 7,), "<u8", buffer=data, strides=(1,))
    h = mix((ends - starts).astype(U64) * _C3 + _C2)
    todo, pos, left = np.arange(len(starts)), starts, ends - starts
    while len(todo):
        v = lanes[pos]
        part = left < 8
        v[part] &= _MASK[left[part]]
        h[todo] = mix(h[todo] ^ v)
        more = left > 8
        todo, pos, left = todo[more], pos[more] + 8, left[more] - 8
    return h


def shingle_hashes(words: np.ndarray, doc: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text index) of every k-word shingle; a text with fewer words, but some, has one of all its words."""
    def fold(parts):
        acc = np.full(len(parts[0]), U64(len(parts)))
        for p in parts:
            acc = mix((acc ^ p) + _C3)
        return acc

    n = len(words) - k + 1
    out, at = [], []
    if n > 0:
        whole = doc[:n] == doc[k - 1:]
        out.append(fold([words[j:j + n] for j in range(k)])[whole])
        at.append(doc[:n][whole])
    if len(doc):
        first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
        count = np.diff(np.r_[first, len(doc)])
        for c in range(1, k):
            f = first[count == c]
            if len(f):
                out.append(fold([words[f + j] for j in range(c)]))
                at.append(doc[f])
    if not out:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    return np.concatenate(out), np.concatenate(at)


def sorted_counts(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and how often each occurs."""
    keys = np.sort(keys)
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.diff(np.r_[first, len(keys)])


# ---------------------------------------------------------------- keys that repeat
class KeyFilter:
    """A bitmap of fixed size over 64-bit keys. It holds every key that occurs at
    least twice; other keys may pass by chance, so what it passes is checked exactly later."""

    def __init__(self, bits: np.ndarray, log2: int):
        self.bits, self.log2 = bits, log2

    def __contains__(self, key) -> bool:
        return bool(self.has(np.array([key], U64))[0])

    def has(self, keys: np.ndarray) -> np.ndarray:
        i = keys >> U64(64 - self.log2)
        return (self.bits[(i >> U64(3)).astype(np.int64)] >> (i & U64(7)).astype(np.uint8) & 1).astype(bool)


def buckets_log2(total_bytes: int, per_bucket: int = 16 << 20) -> int:
    """log2 of a number of buckets that grows with the input."""
    return max(3, math.ceil(math.log2(max(1, total_bytes / per_bucket))))


def pack_buckets(keys: np.ndarray, log2: int) -> list[tuple[int, np.ndarray]]:
    """Sorted 64-bit keys cut by their top ``log2`` bits; each kept as its next 32 bits."""
    cuts = np.searchsorted(keys, np.arange(1 << log2, dtype=U64) << U64(64 - log2))
    low = (keys >> U64(32 - log2)).astype(np.uint32)
    return [(b, low[i:j]) for b, (i, j) in enumerate(zip(cuts, np.r_[cuts[1:], len(keys)])) if j > i]


def repeated_keys(texts: DataFrame, keys_of: Callable[[Chunk], np.ndarray | tuple[np.ndarray, np.ndarray]],
                  total_bytes: int, max_log2: int = 26) -> KeyFilter:
    """The filter of one kind of keys, see ``repeated_kinds``."""
    return repeated_kinds(texts, lambda c: [keys_of(c)], 1, total_bytes, max_log2)[0]


def repeated_kinds(texts: DataFrame, keys_of: Callable[[Chunk], list], kinds: int, total_bytes: int,
                   max_log2: int = 26) -> list[KeyFilter]:
    """For each of ``kinds`` kinds of keys, from one pass over ``texts`` (column ``text``, binary): the filter of
    those that occur twice or more. Where ``keys_of`` gives (keys, tags) for a kind, of the keys that occur with two
    different tags (32 bits).

    Each task reduces a chunk's keys to distinct ones and ships four bytes for
    each (and the tag), dealt by the key's top bits; keys that repeat within the chunk are
    marked, so a hot key costs a few bytes a chunk. Each bucket sets its own
    slice of the bitmap. The bitmap never exceeds 2**max_log2 bits (8 MB), so
    gathering and broadcasting it is bounded; a fuller one only passes more keys.
    Rows of all kinds are grouped by (kind, bucket).
    """
    log2b = min(buckets_log2(total_bytes), 16)
    log2 = min(max_log2, max(20, log2b + 3, math.ceil(math.log2(max(1, total_bytes / 4)))))

    def emit(batches):
        for c in text_chunks(batches):
            parts = {}
            for kind, found in enumerate(keys_of(c)):
                deal(parts, kind << log2b, *(found if isinstance(found, tuple) else (found, None)))
            yield pa.record_batch({
                "bucket": pa.array(list(parts), pa.int32()),
                **{n: pa.array([p.get(n, b"") for p in parts.values()], pa.binary()) for n in ("once", "tags", "many")}})

    def deal(parts, base, keys, tags):
        if tags is not None:                       # the first tag of each key; another one marks the key
            order = np.lexsort((tags, keys))
            keys, tags = keys[order], tags[order]
            head = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][:len(keys)])
            last = np.r_[head[1:] - 1, len(keys) - 1][:len(head)]
            many = tags[head] != tags[last]
            keys, tags = keys[head], tags[head]
        else:
            keys, count = sorted_counts(keys)
            many = count > 1
        once = keys[~many]
        for b, low in pack_buckets(keys[many], log2b):
            parts.setdefault(base + b, {})["many"] = low.tobytes()
        at, tag = 0, tags[~many] if tags is not None else None
        for b, low in pack_buckets(once, log2b):
            p = parts.setdefault(base + b, {})
            p["once"] = low.tobytes()
            p["tags"] = tag[at:at + len(low)].tobytes() if tag is not None else b""
            at += len(low)

    def gather(t: pa.Table) -> pa.Table:
        read = lambda col, kind: np.frombuffer(b"".join(t.column(col).to_pylist()), kind)
        once, many, tags = read("once", np.uint32), np.unique(read("many", np.uint32)), read("tags", np.uint32)
        if len(tags):                                  # a key and a tag count once
            both = np.unique(once.astype(U64) << U64(32) | tags)
            once = (both >> U64(32)).astype(np.uint32)
        keys, count = sorted_counts(np.concatenate([once, many]))
        hit = np.union1d(keys[count > 1], many) >> np.uint32(32 - (log2 - log2b))
        seg = np.zeros(1 << (log2 - log2b), bool)
        seg[hit] = True
        packed = np.packbits(seg, bitorder="little").tobytes()
        return pa.table({"bucket": t.column("bucket")[:1], "seg": pa.array([packed], pa.binary())})

    with shuffles_dropped(texts.sparkSession):
        rows = (texts.select("text").mapInArrow(emit, "bucket int, once binary, tags binary, many binary")
                .groupBy("bucket").applyInArrow(gather, "bucket int, seg binary")).collect()
    bits = np.zeros(kinds << (log2 - 3), np.uint8)         # kind after kind
    step = 1 << (log2 - log2b - 3)
    for r in rows:
        bits[r["bucket"] * step:(r["bucket"] + 1) * step] = np.frombuffer(r["seg"], np.uint8)
    del rows
    return [KeyFilter(part, log2) for part in np.split(bits, kinds)]


def listed_keys(keys: DataFrame, col: str, total_bytes: int, max_log2: int = 26) -> KeyFilter:
    """The filter of the 64-bit keys (``col``, long) that ``keys`` lists, one place for 64 bytes of text at least, and
    never over 2**max_log2 (8 MB)."""
    log2 = min(max_log2, max(18, math.ceil(math.log2(max(1, total_bytes / 64)))))
    place = F.shiftrightunsigned(col, 64 - log2)
    rows = (keys.groupBy(F.shiftright(place, 15).alias("bucket"))
            .agg(F.bitmap_construct_agg(place.bitwiseAND(F.lit((1 << 15) - 1))).alias("bits"))).collect()
    bits = np.zeros((1 << (log2 - 15), 1 << 12), np.uint8)
    for r in rows:
        bits[r["bucket"]] = np.frombuffer(r["bits"], np.uint8)
    return KeyFilter(bits.ravel(), log2)
