"""Operator 12: the trie of conversations that share first turns, by double arrays.

A turn is known by two 64-bit hashes of (role, text), a node by its depth and the xor of its turns' hashes mixed with
their places. Equal conversations are one sequence with a count. Sequences are dealt by range of their turns, so
a task gets the sequences of neighbouring prefixes (a shard), and only nodes on the paths at a shard's two ends can be in another shard too. A
task packs its shard into BASE and CHECK over turn ids that are dense in it, walks all sequences through the
arrays, and sums up subtrees. What shards share is merged by node, and its subtrees by pointer doubling.
Sequences longer than a segment go on in the shard of the node that their segment ends in.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docketline.llm.common import U64, materialise, mix
from docketline.llm.ranking import ranked

#: turns of a segment, and sequences times their longest length in one shard's arrays, at most
SEGMENT = 64
SHARD_CELLS = 1_000_000
NO_ID = (1 << 63) - 1                                        # stands for a null conv_id; sorts last
_SALT = (U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F))
NODE = "a long, b long, depth long"


# ---------------------------------------------------------------- double arrays
class DoubleArray:
    """A trie: from state s, symbol c leads to t = base[s] + c if check[t] == s. State 0 is the root."""

    def __init__(self, rows: np.ndarray):
        """``rows``: symbols (0, 1, ...) by sequence, one sequence a row in sorted order, padded with -1."""
        n, width = rows.shape
        size = 2 * (int((rows >= 0).sum()) + int(rows.max(initial=0))) + 16
        self.base, self.check = np.zeros(size, np.int64), np.full(size, -1, np.int64)
        self.check[0] = -2
        self.state, self.free = np.zeros(n, np.int64), 1      # each sequence's state; no free slot lies before ``free``
        for d in range(width):
            c = rows[:, d]
            on = np.flatnonzero(c >= 0)
            if not len(on):
                break
            s = self.state[on]
            # rows of one state and one symbol stand together
            new = np.r_[True, (s[1:] != s[:-1]) | (c[on][1:] != c[on][:-1])]
            child, parent = c[on][new], s[new]
            head = np.flatnonzero(np.r_[True, parent[1:] != parent[:-1]])
            for i, j in zip(head, np.r_[head[1:], len(parent)]):
                self._place(int(parent[i]), child[i:j])
            self.state[on] = self.base[s] + c[on]

    def _place(self, s: int, symbols: np.ndarray) -> None:
        """Find the first base whose slots for all symbols are free, and take them."""
        self._grow(self.free)
        while self.check[self.free] != -1:
            self.free += 1
            self._grow(self.free)
        low, reach = int(symbols.min()), int(symbols.max()) - int(symbols.min())
        slot, window = self.free, 256
        while len(symbols) > 1:                             # slots for the least symbol, by windows, then tried with the others
            self._grow(slot + window + reach)
            fit = slot + np.flatnonzero(self.check[slot:slot + window] == -1)
            for c in symbols - low:
                fit = fit[self.check[fit + c] == -1]
                if not len(fit):
                    break
            if len(fit):
                slot = int(fit[0])
                break
            slot, window = slot + window, min(2 * window, 1 << 16)
        self.base[s] = slot - low
        self.check[slot - low + symbols] = s

    def _grow(self, upto: int) -> None:
        if upto >= len(self.check):
            more = max(upto + 1, 2 * len(self.check)) - len(self.check)
            self.base = np.r_[self.base, np.zeros(more, np.int64)]
            self.check = np.r_[self.check, np.full(more, -1, np.int64)]

    def walk(self, states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """The states that symbols lead to, -1 where there is no such edge."""
        to = self.base[states] + symbols
        ok = (to >= 0) & (to < len(self.check))
        ok[ok] = self.check[to[ok]] == states[ok]
        return np.where(ok, to, -1)


def node_keys(a: np.ndarray, b: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What a turn at a depth adds (by xor) to a node's two hashes."""
    d = depth.astype(U64)
    return tuple(mix(mix(h.view(U64) + _SALT[i]) ^ (d * _SALT[1 - i])).view(np.int64) for i, h in enumerate((a, b)))


SHARD_NODE = ("a long, b long, depth long, pa long, pb long, shared boolean, conv_id long, n_convs long, n_children long, n_leaves long, "
              "saved long, weight long, parent_conv long")


def shard_nodes(rows: dict) -> dict[str, np.ndarray]:
    """The nodes of some sorted sequences of one root. ``rows``: root (a, b, depth) and, by sequence, turns (list of arrays (a, b, n_chars)),
    count, conv_id, more (the sequence goes on in another shard).

    Nodes that another shard may have too (the paths of the first and the last sequence, and of those that go on) are
    ``shared``: their sums hold what hangs below in nodes that are not, and their own share is left out.
    """
    lens = np.array([len(t) for t in rows["turns"]], np.int64)
    flat = np.concatenate(rows["turns"]) if len(lens) else np.zeros(0, [("a", "i8"), ("b", "i8"), ("n", "i4")])
    _, ids = np.unique(flat[["a", "b"]], return_inverse=True)
    n, width = len(lens), int(lens.max(initial=0))
    where = np.repeat(np.arange(n), lens), np.arange(len(flat)) - np.repeat(np.cumsum(lens) - lens, lens)
    grid = np.full((n, width), -1, np.int64)
    grid[where] = ids
    ka, kb = np.zeros((n, width), np.int64), np.zeros((n, width), np.int64)
    ka[where], kb[where] = node_keys(flat["a"], flat["b"], rows["depth"] + 1 + where[1])
    ka, kb = np.bitwise_xor.accumulate(ka, axis=1) ^ rows["a"], np.bitwise_xor.accumulate(kb, axis=1) ^ rows["b"]
    chars = np.zeros((n, width), np.int64)
    chars[where] = flat["n"]

    trie = DoubleArray(grid)
    size = len(trie.check)
    out = {k: np.zeros(size, np.int64) for k in ("a", "b", "depth", "parent", "n_convs", "n_chars")}
    out["conv_id"], shared = np.full(size, NO_ID, np.int64), np.zeros(size, bool)
    shared[0] = True
    out["parent"][0] = -1
    out["a"][0], out["b"][0], out["depth"][0] = rows["a"], rows["b"], rows["depth"]
    if rows["depth"] == 0:                                  # elsewhere the root is counted where its own segment ends
        out["n_convs"][0], out["conv_id"][0] = rows["count"].sum(), rows["conv_id"].min(initial=NO_ID)
    ends = np.zeros(n, bool)
    ends[[0, -1]] = True
    state = np.zeros(n, np.int64)
    seen = [np.zeros(1, np.int64)]
    for d in range(width):
        on = np.flatnonzero(grid[:, d] >= 0)
        to = trie.walk(state[on], grid[on, d])
        out["parent"][to] = state[on]
        out["a"][to], out["b"][to], out["n_chars"][to] = ka[on, d], kb[on, d], chars[on, d]
        out["depth"][to] = rows["depth"] + 1 + d
        np.add.at(out["n_convs"], to, rows["count"][on])
        np.minimum.at(out["conv_id"], to, rows["conv_id"][on])
        shared[to[ends[on] | rows["more"][on]]] = True
        state[on] = to
        seen.append(np.unique(to))
    nodes = np.concatenate(seen)                            # by depth
    children, leaves, saved = (np.zeros(size, np.int64) for _ in range(3))
    own_saved = (out["n_convs"] - 1) * out["n_chars"]
    for level in reversed(seen[1:]):                        # a node's children come before it
        private = level[~shared[level]]
        leaves[private] += children[private] == 0
        saved[private] += own_saved[private]
        np.add.at(children, out["parent"][private], 1)
        np.add.at(leaves, out["parent"][private], leaves[private])
        np.add.at(saved, out["parent"][private], saved[private])
        # what hangs below a shared node stays there: shared parents get it from the merge
    parent = out["parent"][nodes]
    up = np.maximum(parent, 0)
    top = nodes == 0
    return {"a": out["a"][nodes], "b": out["b"][nodes], "depth": out["depth"][nodes],
            "pa": np.where(top, 0, out["a"][up]), "pb": np.where(top, 0, out["b"][up]), "shared": shared[nodes],
            "conv_id": out["conv_id"][nodes], "n_convs": out["n_convs"][nodes], "n_children": children[nodes],
            "n_leaves": leaves[nodes], "saved": saved[nodes], "weight": out["n_chars"][nodes],
            "parent_conv": np.where(top | shared[up], NO_ID, out["conv_id"][up])}


# ---------------------------------------------------------------- conversations
def _turn(alias: str = "") -> list[Column]:
    return [F.col(f"{alias}{c}") for c in ("a", "b", "n")]


def turns_in_order(rows: DataFrame) -> DataFrame:
    """(c, rank, a, b, n): each conversation's turns by ``turn`` (null first; ties by the hashes of role and text)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    narrow = rows.select(F.coalesce(F.col("conv_id").cast("long"), F.lit(NO_ID)).alias("c"), "turn",
                         F.xxhash64(F.lit(1), role, text).alias("a"), F.xxhash64(F.lit(2), role, text).alias("b"), F.length(text).alias("n"))
    return ranked(narrow, ["c"], ["turn", "a", "b"], "trie-turns").drop("turn")


def rebuilt(turns: DataFrame, most: int = 5, every: int = 100) -> tuple[DataFrame, DataFrame]:
    """(c, place, a, b, n) and (c, size): every conversation with the first h turns of conversation c - c % ``every``, then its own
    turns from the h-th on; h = crc32(c as text) % (``most`` + 1). Rows without an id get no other's turns.
    """
    h = F.when(F.col("c") == NO_ID, F.lit(0)).otherwise(F.crc32(F.col("c").cast("string").cast("binary")) % (most + 1)).cast("long")
    convs = turns.groupBy("c").agg(F.count(F.lit(1)).alias("own")).withColumn("h", h).withColumn("donor", F.col("c") - F.col("c") % every)
    heads = (turns.where((F.col("rank") < most) & (F.col("c") % every == 0) & (F.col("c") != NO_ID)).groupBy(F.col("c").alias("donor"))
             .agg(F.array_sort(F.collect_list(F.struct("rank", "a", "b", "n"))).alias("head")))   # at most ``most`` each
    convs = convs.join(heads, "donor", "left").withColumn("head", F.slice(F.coalesce("head", F.array().cast(
        "array<struct<rank:bigint,a:bigint,b:bigint,n:int>>")), F.lit(1), F.col("h").cast("int")))
    convs = convs.withColumn("lent", F.size("head").cast("long"))
    convs = materialise(convs.withColumn("size", F.col("lent") + F.greatest(F.col("own") - F.col("h"), F.lit(0))), "trie-convs")
    given = convs.select("c", "size", F.explode("head").alias("t")).select("c", "size", F.col("t.rank").alias("place"), *_turn("t."))
    own = turns.join(convs.select("c", "h", "lent", "size"), "c").where("rank >= h").select(
        "c", "size", (F.col("rank") - F.col("h") + F.col("lent")).alias("place"), *_turn())
    return given.unionByName(own), convs.select("c", "size")


def segments(turns: DataFrame, length: int) -> DataFrame:
    """(c, size, seg, ra, rb, turns, da, db): each conversation cut into segments; ``ra``/``rb`` is the node that a segment starts from,
    ``turns`` its turns as bytes that sort by prefix, ``da``/``db`` what it adds to the node."""
    kind = np.dtype([("a", "<i8"), ("b", "<i8"), ("n", "<i4")])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = batch.column("t")
            offs = np.asarray(col.offsets).astype(np.int64)
            t = col.flatten()
            place, a, b, n = (t.field(f).to_numpy() for f in ("place", "a", "b", "n"))
            flat = np.zeros(len(a), kind)
            flat["a"], flat["b"], flat["n"] = a, b, n
            ka, kb = node_keys(a, b, place + 1)
            offs = offs - offs[0]
            add = lambda k: np.bitwise_xor.reduceat(k, offs[:-1]) if len(k) else np.zeros(0, np.int64)
            raw = flat.tobytes()
            yield pa.record_batch([*(batch.column(c) for c in ("c", "size", "seg")),
                                   pa.array([raw[kind.itemsize * i:kind.itemsize * j] for i, j in zip(offs, offs[1:])], pa.binary()),
                                   pa.array(add(ka), pa.int64()), pa.array(add(kb), pa.int64())],
                                  names=["c", "size", "seg", "turns", "da", "db"])

    grouped = turns.withColumn("seg", F.floor(F.col("place") / length)).groupBy("c", "size", "seg").agg(
        F.array_sort(F.collect_list(F.struct("place", "a", "b", "n"))).alias("t"))
    segs = materialise(grouped.mapInArrow(pack, "c long, size long, seg long, turns binary, da long, db long"), "trie-segments")
    spec = "OVER (PARTITION BY c ORDER BY seg ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    long = segs.where(F.col("size") > length).selectExpr("*", f"coalesce(bit_xor(da) {spec}, 0L) AS ra", f"coalesce(bit_xor(db) {spec}, 0L) AS rb")
    return segs.where(F.col("size") <= length).selectExpr("*", "0L AS ra", "0L AS rb").unionByName(long)


def trie_shards(segs: DataFrame, length: int, shard_cells: int = SHARD_CELLS) -> DataFrame:
    """Nodes of all shards (SHARD_NODE), from segments dealt by range of their prefixes."""
    kind = np.dtype([("a", "<i8"), ("b", "<i8"), ("n", "<i4")])
    same = segs.withColumn("more", F.col("size") > (F.col("seg") + 1) * length).groupBy(
        "ra", "rb", "seg", "turns", "more").agg(F.count(F.lit(1)).alias("count"), F.min("c").alias("conv_id"))
    keys = ["seg", "ra", "rb", "turns", "more"]
    n = int(segs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = materialise(same, "trie-sequences").repartitionByRange(n, *keys).sortWithinPartitions(*keys)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, root, size = [], None, 0

        def shard():
            turns, count, conv, more = zip(*held)
            nodes = shard_nodes({"depth": root[0] * length, "a": root[1], "b": root[2], "turns": turns, "count": np.array(count, np.int64),
                                 "conv_id": np.array(conv, np.int64), "more": np.array(more, bool)})
            top = (nodes["depth"] == root[0] * length) & (root[0] > 0)     # its parent is known where its own segment ends
            out = pa.record_batch({k: pa.array(v, mask=top if k in ("pa", "pb") else None) for k, v in nodes.items()})
            for at in range(0, out.num_rows, 50_000):
                yield out.slice(at, 50_000)

        for batch in batches:
            for seg, ra, rb, turns, more, count, conv in zip(*(batch.column(c).to_pylist() for c in (*keys, "count", "conv_id"))):
                turns = np.frombuffer(turns, kind)
                size = max(size, len(turns))
                if held and (root != (seg, ra, rb) or (len(held) + 1) * size > shard_cells):
                    yield from shard()
                    held, size = [], len(turns)
                root = (seg, ra, rb)
                held.append((turns, count, conv, more))
        if held:
            yield from shard()

    return dealt.mapInArrow(build, SHARD_NODE)


# ---------------------------------------------------------------- merging
def merge_shared(shared: DataFrame) -> DataFrame:
    """Shared nodes, one row each, with the sums of their whole subtrees.

    First the shards' parts of a node are added up. Then sums run up the tree of shared nodes by pointer doubling: after round i a
    node holds what lies less than 2**i below it, and points 2**i up.
    """
    key = ["a", "b", "depth"]
    one = materialise(shared.groupBy(*key).agg(
        F.max("pa").alias("pa"), F.max("pb").alias("pb"), F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"),
        F.max("weight").alias("weight"), F.sum("n_children").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved")),
        "trie-shared")
    kids = one.where("depth > 0").groupBy(F.col("pa").alias("a"), F.col("pb").alias("b"), (F.col("depth") - 1).alias("depth")).agg(
        F.count(F.lit(1)).alias("more"))
    one = materialise(one.join(kids, key, "left").withColumn("n_children", F.col("n_children") + F.coalesce("more", F.lit(0))).drop("more")
                      .withColumn("n_leaves", F.col("n_leaves") + (F.col("n_children") == 0).cast("long"))
                      .withColumn("saved", F.col("saved") + (F.col("n_convs") - 1) * F.col("weight")), "trie-shared")
    deepest, step = one.agg(F.max("depth").alias("d")).first()["d"] or 0, 1
    up = one.select(*key, "n_leaves", "saved", F.col("pa").alias("ua"), F.col("pb").alias("ub"))
    while step <= deepest:
        higher = up.where(F.col("depth") >= step)
        gain = higher.groupBy(F.col("ua").alias("a"), F.col("ub").alias("b"), (F.col("depth") - step).alias("depth")).agg(
            F.sum("n_leaves").alias("l"), F.sum("saved").alias("s"))
        over = up.select(F.col("a").alias("ua"), F.col("b").alias("ub"), (F.col("depth") + step).alias("depth"),
                         F.col("ua").alias("na"), F.col("ub").alias("nb"))
        up = materialise(up.join(gain, key, "left").join(over, ["ua", "ub", "depth"], "left").select(
            *key, (F.col("n_leaves") + F.coalesce("l", F.lit(0))).alias("n_leaves"), (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved"),
            F.coalesce("na", F.lit(0)).alias("ua"), F.coalesce("nb", F.lit(0)).alias("ub")), "trie-doubling")
        step *= 2
    return one.drop("n_leaves", "saved").join(up.select(*key, "n_leaves", "saved"), key)


def end_lists(ends: DataFrame, chunk: int = 50_000) -> DataFrame:
    """(a, b, depth, ends_sha256) of (a, b, depth, c): SHA-256 of ascending ids joined by commas.

    Ids are dealt by range of (node, id) and joined into chunks; then a task hashes a node's chunks in order as they stream
    past, holding one chunk and the state of the hash.
    """
    key = ["a", "b", "depth"]
    n = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def runs(batches, columns):
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in columns]
            yield from zip(*cols)

    def join(batches):
        rows, held, now, size = [], [], None, 0

        def out():
            cols = list(zip(*rows))
            return pa.record_batch([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()))],
                                   names=[*key, "first", "ids"])

        def close():
            nonlocal size
            rows.append((*now, held[0], ",".join("" if c == NO_ID else str(c) for c in held if c != NO_ID)))
            size += len(held)
            held.clear()

        for a, b, d, c in runs(batches, [*key, "c"]):
            if held and (now != (a, b, d) or len(held) >= chunk):
                close()
                if size >= chunk:
                    yield out()
                    rows.clear()
                    size = 0
            now = (a, b, d)
            held.append(c)
        if held:
            close()
        if rows:
            yield out()

    def digest(batches):
        rows, now, state, empty = [], None, None, True

        def out():
            cols = list(zip(*rows))
            return pa.record_batch([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.string()))],
                                   names=[*key, "ends_sha256"])

        for a, b, d, ids in runs(batches, [*key, "ids"]):
            if now != (a, b, d):
                if now is not None:
                    rows.append((*now, state.hexdigest()))
                    if len(rows) >= 10_000:
                        yield out()
                        rows.clear()
                now, state, empty = (a, b, d), hashlib.sha256(), True
            if ids:
                state.update(ids.encode() if empty else b"," + ids.encode())
                empty = False
        if now is not None:
            rows.append((*now, state.hexdigest()))
            yield out()

    chunks = ends.select(*key, "c").repartitionByRange(n, *key, "c").sortWithinPartitions(*key, "c").mapInArrow(
        join, f"{NODE}, first long, ids string")
    return chunks.repartition(n, *key).sortWithinPartitions(*key, "first").mapInArrow(digest, f"{NODE}, ends_sha256 string")


def conversation_trie(rows: DataFrame, segment: int = SEGMENT, shard_cells: int = SHARD_CELLS, most: int = 5, every: int = 100) -> DataFrame:
    """One row per distinct sequence of first turns of the rebuilt conversations (see ``rebuilt``), the empty one included: (conv_id, depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256), and the node's key (a, b).

    ``conv_id`` is the smallest member, ``n_convs`` the number of members, ``n_leaves`` the childless nodes of the subtree,
    ``saved_tokens`` the sum over the subtree of (n_convs - 1) times the code points of the node's last text,
    ``ends_sha256`` the digest of the ids of the conversations that end in the node.

    Null roles and texts are empty. Rows with the same turn are ordered by hashes of role and text; repeated rows are turns of their own. Rows
    without a conv_id are one conversation without an id: it counts, its id is null where it is the only member, and it
    is in no list of ids (the id 2**63 - 1 is taken for it). Without rows there is no node.
    Conversations of any length are cut into segments, equal ones are counted once; only what SHA-256 needs in
    order, the ids of the conversations that end in one node, streams through one task per node.
    """
    turns, convs = rebuilt(turns_in_order(rows), most, every)
    segs = materialise(segments(turns, segment), "trie-prefixes")
    nodes = materialise(trie_shards(segs, segment, shard_cells), "trie-nodes")
    key = ["a", "b", "depth"]
    last = segs.where(F.col("size") <= (F.col("seg") + 1) * segment).select(
        F.col("ra").bitwiseXOR(F.col("da")).alias("a"), F.col("rb").bitwiseXOR(F.col("db")).alias("b"), F.col("size").alias("depth"), "c")
    none = convs.where("size = 0")
    silent = none.select(F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"), F.lit(0).cast("long").alias("depth"), "c")
    zero = F.lit(0).cast("long")
    empty = silent.groupBy(*key).agg(F.min("c").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).select(
        *key, zero.alias("pa"), zero.alias("pb"), F.lit(True).alias("shared"), "conv_id", "n_convs", zero.alias("n_children"),
        zero.alias("n_leaves"), zero.alias("saved"), zero.alias("weight"), F.lit(NO_ID).alias("parent_conv"))
    shared = materialise(merge_shared(nodes.where("shared").unionByName(empty)), "trie-merged")
    private = nodes.where("NOT shared")
    whole = private.drop("shared", "weight").unionByName(shared.drop("weight").withColumn("parent_conv", F.lit(NO_ID)))
    above = shared.select(F.col("a").alias("pa"), F.col("b").alias("pb"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("up"))
    ends = end_lists(last.unionByName(silent))
    null = lambda c: F.nullif(c, F.lit(NO_ID))
    out = whole.join(above, ["pa", "pb", "depth"], "left").join(ends, key, "left")
    return out.select(
        null(F.col("conv_id")).alias("conv_id"), "depth",
        F.when(F.col("depth") > 0, null(F.coalesce("up", "parent_conv"))).alias("parent_conv_id"),
        "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"), "a", "b")
