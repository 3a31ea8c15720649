"""Operator 11: a Merkle manifest of a table, kept as postorder append logs.

Leaves are numbered within their group (``ranked``) and dealt to aligned builders: builder b of a group has leaves
b * 2**k to (b + 1) * 2**k - 1, whatever the group's size, so no task holds a group. A builder appends nodes in the order in which they
are completed, that is in postorder. Where a node stands in that log follows from the sizes of the subtrees
before it alone, so a proof reads its siblings by place. The builders' last nodes are the leaves of the next tier of builders.
"""

from __future__ import annotations

from collections.abc import Sequence
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketline.llm.common import materialise
from docketline.llm.ranking import ranked

EMPTY = sha256(b"").hexdigest()


def digest_of(columns: Sequence[str | Column]) -> Column:
    """SHA-256 (hex) of values one after the other: ``-`` for null, else UTF-8 byte count, ``:`` and the value."""
    text = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in columns]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text]), 256)


# ---------------------------------------------------------------- a log
def joined(*digests: bytes) -> bytes:
    """A node: the hash of its children's digests as hex text."""
    return sha256("".join(d.hex() for d in digests).encode()).digest()


def place(level: int, index: int, n: int) -> int:
    """The place of node ``index`` of a level in the log of a tree over ``n`` leaves.

    After m leaves, 2m - popcount(m) nodes of whole subtrees are complete; a whole subtree's node follows its
    last leaf by its level. Nodes over fewer leaves come last, the lower ones first.
    """
    if (index + 1) << level <= n:
        last = ((index + 1) << level) - 1
        return 2 * last - last.bit_count() + level
    return 2 * n - n.bit_count() + sum(1 for h in range(1, level) if n & ((1 << h) - 1))


def append_log(leaves: Sequence[bytes], height: int) -> list[bytes]:
    """All nodes up to level ``height`` in the order of completion; the last one is the root."""
    log, whole = [], []                                     # whole: roots of complete subtrees, falling sizes
    for i, leaf in enumerate(leaves):
        log.append(leaf)
        whole.append(leaf)
        for _ in range((~i & (i + 1)).bit_length() - 1):
            right, left = whole.pop(), whole.pop()
            log.append(joined(left, right))
            whole.append(log[-1])
    n = len(leaves)
    for level in range(1, height + 1):
        if n & ((1 << level) - 1):
            index = n >> level
            children = [log[place(level - 1, j, n)] for j in (2 * index, 2 * index + 1) if j << (level - 1) < n]
            log.append(joined(*children))
    return log


def height_of(n: int, block: int, k: int) -> int:
    """Levels above the leaves of a builder: all k where the group has other builders, else as far as one node is left."""
    return k if block > 0 or n == 1 << k else (n - 1).bit_length()


def siblings(log: bytes, index: int, n: int, height: int) -> list[tuple[int, bytes]]:
    """(side, digest) of the other node of the run, by level: side 0 is left, 1 right, 2 none."""
    out = []
    for level in range(height):
        j = index >> level
        other = j ^ 1
        if other << level < n:
            p = place(level, other, n) * 32
            out.append((other & 1, log[p:p + 32]))
        else:
            out.append((2, bytes(32)))
    return out


def fold(digest: bytes, path: Sequence[tuple[int, bytes]]) -> bytes:
    for side, other in path:
        digest = joined(digest) if side == 2 else joined(other, digest) if side == 0 else joined(digest, other)
    return digest


def pack_path(path: Sequence[tuple[int, bytes]]) -> bytes:
    return b"".join(bytes([side]) + other for side, other in path)


def unpack_path(data: bytes) -> list[tuple[int, bytes]]:
    return [(data[i], data[i + 1:i + 33]) for i in range(0, len(data), 33)]


# ---------------------------------------------------------------- builders
LOG = "part string, block long, n long, height int, log binary"


def build_logs(nodes: DataFrame, k: int) -> DataFrame:
    """A row per builder from (part, rank, digest): its log, ``n`` leaves and ``height``. At most 2**k rows meet."""
    def build(t: pa.Table) -> pa.Table:
        t = t.sort_by("rank")
        block, n = t.column("block")[0].as_py(), t.num_rows
        height = height_of(n, block, k)
        log = append_log(t.column("digest").to_pylist(), height)
        return pa.table({"part": t.column("part")[:1], "block": pa.array([block], pa.int64()), "n": pa.array([n], pa.int64()),
                         "height": pa.array([height], pa.int32()), "log": pa.array([b"".join(log)], pa.binary())})

    return nodes.select("part", F.shiftright("rank", k).alias("block"), "rank", "digest").groupBy("part", "block").applyInArrow(build, LOG)


def build_tiers(nodes: DataFrame, k: int, name: str) -> list[DataFrame]:
    """Logs over (part, rank, digest), then over the builders' roots, until each part has one builder."""
    tiers = []
    while True:
        tiers.append(materialise(build_logs(nodes, k), f"{name}-{len(tiers)}"))
        if not (tiers[-1].agg(F.max("block").alias("b")).first()["b"] or 0):
            return tiers
        nodes = tiers[-1].select("part", F.col("block").alias("rank"), root_of().alias("digest"))


def root_of() -> Column:
    return F.expr("substring(log, -32, 32)")


def paths_down(tiers: list[DataFrame], top: DataFrame, k: int) -> DataFrame:
    """(part, block, path) of the lowest tier's builders: siblings from the builder's root to the end of ``top``'s paths.

    ``top`` has a path for each part's own root.
    """
    paths = top.select("part", F.lit(0).cast("long").alias("block"), "path")
    for tier in reversed(tiers[1:]):
        def extract(log: pa.Table, upper: pa.Table) -> pa.Table:
            n, height, data = log.column("n")[0].as_py(), log.column("height")[0].as_py(), log.column("log")[0].as_py()
            block, above = log.column("block")[0].as_py(), upper.column("path")[0].as_py()
            return pa.table({"part": pa.array([log.column("part")[0].as_py()] * n, pa.string()),
                             "block": pa.array(range(block << k, (block << k) + n), pa.int64()),
                             "path": pa.array([pack_path(siblings(data, i, n, height)) + above for i in range(n)], pa.binary())})

        paths = tier.groupBy("part", "block").cogroup(paths.groupBy("part", "block")).applyInArrow(
            extract, "part string, block long, path binary")
    return paths


# ---------------------------------------------------------------- the manifest
def manifest(rows: DataFrame, k: int = 12) -> DataFrame:
    """Merkle proofs of every row, from (doc_id, lang, leaf, tampered): the digests (hex) of the row as stored and as presented.

    Per ``lang``, leaves ascend by (doc_id, leaf), nulls first; two neighbours make a node, the last one alone if need be, up to
    one node, the subroot. Subroots, ordered by lang (null first, bytewise), make the root alike. Returns (doc_id, lang, leaf,
    subroot, root, proof, proof_sha256, folded_root, verified): ``proof`` is the list of siblings (hex) from the leaf up, left to
    right; ``folded_root`` comes from ``tampered`` and the siblings.

    Rows that repeat are leaves of their own, next to each other; a null doc_id comes first, a null lang is a group
    of its own. A lone leaf is its group's subroot; with one group the root is its subroot. An empty table gives no rows.
    At most 2**k leaves (or nodes of a tier) meet in a task.
    """
    part = F.when(F.col("lang").isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), F.col("lang")))
    leaves = ranked(rows.select("doc_id", "lang", F.unhex("leaf").alias("digest"), F.unhex("tampered").alias("tampered"), part.alias("part")),
                    ["part"], ["doc_id", "digest"], "merkle-leaves")
    tiers = build_tiers(leaves, k, "merkle-tier")
    subroots = materialise(tiers[-1].select("part", root_of().alias("digest")), "merkle-subroots")
    langs = ranked(subroots.select(F.col("part").alias("name"), "digest", F.lit("").alias("part")), ["part"], ["name"], "merkle-langs")
    upper = build_tiers(langs, k, "merkle-upper")
    top = langs.sparkSession.createDataFrame([("", b"")], "part string, path binary")
    above = paths_down([None, *upper], top, k).select("part", F.col("block").alias("rank"), "path")
    above = langs.join(above, ["part", "rank"]).select(F.col("name").alias("part"), "path", F.col("digest").alias("subroot"))
    root = upper[-1].select(root_of().alias("root")).first()         # one digest; none in an empty table
    below = paths_down(tiers, above, k)
    log = tiers[0].join(below, ["part", "block"]).join(above.select("part", "subroot"), "part").withColumn(
        "root", F.lit(bytes(root["root"]) if root else None).cast("binary"))

    def prove(leaf: pa.Table, log: pa.Table) -> pa.Table:
        one = {c: log.column(c)[0].as_py() for c in log.column_names}
        upper, n, height = unpack_path(one["path"]), one["n"], one["height"]
        ends = {}
        out = {"proof": [], "proof_sha256": [], "folded_root": [], "verified": []}
        shared = [d.hex() for side, d in upper if side != 2]
        for rank, digest in zip(leaf.column("rank").to_pylist(), leaf.column("tampered").to_pylist()):
            path = siblings(one["log"], rank - (one["block"] << k), n, height)
            proof = [d.hex() for side, d in path if side != 2] + shared
            end = fold(digest, path)
            if end not in ends:
                ends[end] = fold(end, upper)
            out["proof"].append(proof)
            out["proof_sha256"].append(sha256("".join(proof).encode()).hexdigest())
            out["folded_root"].append(ends[end].hex())
            out["verified"].append(ends[end] == one["root"])
        size = leaf.num_rows
        hexes = [d.hex() for d in leaf.column("digest").to_pylist()]
        return pa.table({
            "doc_id": leaf.column("doc_id"), "lang": leaf.column("lang"), "leaf": pa.array(hexes),
            "subroot": pa.array([one["subroot"].hex()] * size), "root": pa.array([one["root"].hex()] * size),
            "proof": pa.array(out["proof"], pa.list_(pa.string())), "proof_sha256": pa.array(out["proof_sha256"]),
            "folded_root": pa.array(out["folded_root"]), "verified": pa.array(out["verified"], pa.bool_())})

    kind = dict(rows.dtypes)["doc_id"]
    blocks = leaves.withColumn("block", F.shiftright("rank", k))
    return blocks.groupBy("part", "block").cogroup(log.groupBy("part", "block")).applyInArrow(
        prove, f"doc_id {kind}, lang string, leaf string, subroot string, root string, proof array<string>, proof_sha256 string, "
               "folded_root string, verified boolean")


def document_leaves(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, leaf, tampered) of ``documents``: the record as it is, and, where 7 divides crc32(doc_id as
    text), with n_chars one higher (a null n_chars or doc_id: as it is)."""
    fields = lambda n: digest_of(["doc_id", "source", "lang", n, "text"])
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.lit(False))
    return docs.select("doc_id", "lang", fields("n_chars").alias("leaf"), hit.alias("hit"), F.when(
        hit, fields(F.col("n_chars") + 1)).alias("other")).select("doc_id", "lang", "leaf", F.coalesce("other", "leaf").alias("tampered"))
