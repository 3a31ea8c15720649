import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from docketline.llm.prefix_trie import DoubleArray, conversation_trie

SCHEMA = "conv_id long, turn long, role string, text string, a string, c int, rank string, depth int"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(*r, "x", 1, "y", 2) for r in rows], SCHEMA).repartition(parts)


def test_double_array_holds_exactly_its_paths():
    rng = random.Random(3)
    for n, alphabet in ((400, 5), (300, 200), (50, 1), (1, 3), (2000, 2000)):
        paths = sorted({tuple(rng.randrange(alphabet) if rng.random() < 0.7 else 0 for _ in range(rng.randint(1, 6))) for _ in range(n)})
        ids = {x: i for i, x in enumerate(sorted({x for p in paths for x in p}))}
        paths = sorted(tuple(ids[x] for x in p) for p in paths)
        grid = np.full((len(paths), 6), -1, np.int64)
        for i, p in enumerate(paths):
            grid[i, :len(p)] = p
        trie = DoubleArray(grid)
        states = {(): 0}
        for p in paths:
            for d in range(1, len(p) + 1):
                to = int(trie.walk(np.array([states[p[:d - 1]]]), np.array([p[d - 1]]))[0])
                assert to > 0
                states[p[:d]] = to
        assert len(set(states.values())) == len(states)          # no slot serves two nodes
        for prefix, s in states.items():                         # and no other edge exists
            to = trie.walk(np.full(len(ids), s), np.arange(len(ids)))
            assert {c for c in range(len(ids)) if to[c] >= 0} == {p[len(prefix)] for p in states if len(p) == len(prefix) + 1 and p[:-1] == prefix}


def brute(rows, most=5, every=100):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        convs[c].append(((turn is not None, turn or 0), (role or "", text or "")))
    convs = {c: [t for _, t in sorted(ts, key=lambda x: x[0])] for c, ts in convs.items()}
    built = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % (most + 1) if c is not None else 0
        built[c] = tuple((convs.get(c - c % every, []) if c is not None else [])[:h] + own[h:])
    members = defaultdict(list)
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    least = lambda k: min((c for c in members[k] if c is not None), default=None)
    children = defaultdict(int)
    leaves, saved = defaultdict(int), defaultdict(int)
    for k in members:
        if k:
            children[k[:-1]] += 1
    for k, m in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += children[k] == 0
            saved[k[:d]] += (len(m) - 1) * len(k[-1][1]) if k else 0
    return sorted(((least(k), len(k), least(k[:-1]) if k else None, len(m), children[k], leaves[k], saved[k],
                    hashlib.sha256(",".join(str(c) for c in sorted(c for c in m if c is not None and len(built[c]) == len(k))).encode()).hexdigest())
                   for k, m in members.items()), key=repr)


def trie(spark, rows, **more):
    out = conversation_trie(frame(spark, rows), **more).drop("a", "b")
    return sorted(map(tuple, out.collect()), key=repr)


def conversations(seed, n, longest, vocabulary, start=0):
    rng = random.Random(seed)
    return [(start + c, t, rng.choice(["user", "assistant"]), "t%d é" % rng.randrange(vocabulary) * rng.randint(1, 2))
            for c in range(n) for t in range(rng.randint(1, longest))]


HOT = [(c, t, "user", f"same {t}") for c in range(2000, 2400) for t in range(4)] + [(c, 9, "user", f"own {c}") for c in range(2100, 2400)]


@pytest.mark.parametrize("segment,cells", [(64, 1_000_000), (3, 12)])
def test_equals_brute_force(spark, segment, cells):
    rows = conversations(1, 300, 6, 3) + conversations(2, 30, 9, 40, 990) + HOT
    assert trie(spark, rows, segment=segment, shard_cells=cells) == brute(rows)


def test_nulls_repeats_and_gaps(spark):
    rows = [(None, 1, "u", "lost"), (None, None, "u", "found"), (7, None, None, None), (7, 2, "u", ""), (7, 2, "u", ""), (8, 5, "u", "x"),
            (205, 0, "user", "a"), (206, 0, "user", "a"), (206, 1, None, "b"), (206, 1, None, "b")]
    rows += [(c, 0, "u", "one turn") for c in range(300, 330)]                # turnless ones among them
    rows += [(400, t, "u", "deep") for t in range(200)] + [(401, t, "u", "deep") for t in range(150)]
    want = brute(rows)
    assert trie(spark, rows) == want
    assert trie(spark, rows, segment=7, shard_cells=50) == want


def test_only_rows_without_id_and_empty_table(spark):
    rows = [(None, 0, "u", "a"), (None, 1, "u", None)]
    assert trie(spark, rows) == brute(rows)
    assert conversation_trie(frame(spark, rows).limit(0)).count() == 0
