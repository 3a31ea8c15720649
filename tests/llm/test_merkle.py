import random
import zlib
from collections import defaultdict
from hashlib import sha256

import pytest

from docketline.llm.merkle import append_log, document_leaves, fold, height_of, joined, manifest, place, siblings
from docketline.llm.ranking import ranked

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, part string, rank int, leaf string"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(*r, "p", 3, "x") for r in rows], SCHEMA).repartition(parts)


def sha(t):
    return sha256(t.encode()).hexdigest()


@pytest.mark.parametrize("n", [1, 2, 3, 5, 8, 13, 31, 32, 33, 64, 100])
def test_places_in_the_log(n):
    leaves = [bytes([i]) * 32 for i in range(n)]
    for block in (0, 1):
        height = height_of(n, block, 7)
        log, level = append_log(leaves, height), leaves
        total = 0
        for h in range(height + 1):
            assert [log[place(h, j, n)] for j in range(len(level))] == level
            total += len(level)
            level = [joined(*level[i:i + 2]) for i in range(0, len(level), 2)]
        assert len(log) == total
        assert all(fold(d, siblings(b"".join(log), i, n, height)) == log[-1] for i, d in enumerate(leaves))


def brute(rows):
    def leaf(r, more=0):
        r = (*r[:3], None if r[3] is None else r[3] + more, r[4])
        return sha("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in r))

    def climb(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([sha("".join(levels[-1][i:i + 2])) for i in range(0, len(levels[-1]), 2)])
        return levels

    def path(levels, i):
        return [(levels[h][i >> h ^ 1], i >> h & 1) if i >> h ^ 1 < len(levels[h]) else None for h in range(len(levels) - 1)]

    groups = defaultdict(list)
    for r in rows:
        groups[r[2]].append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    sorted_rows = {g: sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for g in order}
    trees = {g: climb([leaf(r) for r in sorted_rows[g]]) for g in order}
    top = climb([trees[g][-1][0] for g in order])
    root = top[-1][0] if order else None
    out = []
    for at, g in enumerate(order):
        for i, r in enumerate(sorted_rows[g]):
            steps = path(trees[g], i) + path(top, at)
            now = leaf(r, int(r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0))
            for s in steps:
                now = sha(now) if s is None else sha(s[0] + now) if s[1] else sha(now + s[0])
            out.append((r[0], leaf(r), trees[g][-1][0], root, sha("".join(s[0] for s in steps if s)), now, now == root))
    return sorted(out, key=repr)


def proofs(df, k=12):
    out = manifest(document_leaves(df), k).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted(map(tuple, out.collect()), key=repr)


HARD = [(i, "s", "en", 10, f"text {i}") for i in range(150)] + [
    (None, None, None, None, None), (None, "s", None, 3, "x"), (500, "é", "ü", 1, "中文 😀"), (501, "", "", None, ""), (502, "s", "", 5, None),
    (7, "s", "en", 10, "other text"), (7, "s", "en", 10, "other text"), (7, "s", "en", 10, "other text"), (600, "s", "solo", 1, "y" * 100_000)]


@pytest.mark.parametrize("k", [12, 2, 1])
def test_equals_brute_force(spark, k):
    assert proofs(frame(spark, HARD), k) == brute(HARD)


def test_many_groups_and_tampered_rows(spark):
    rows = [(i, "s", f"l{i % 23}", i, "t") for i in range(200)]
    got = proofs(frame(spark, rows), 2)
    assert got == brute(rows)
    assert {r[-1] for r in got if zlib.crc32(str(r[0]).encode()) % 7} == {True} and any(not r[-1] for r in got)


def test_one_row_one_group_and_empty_table(spark):
    for rows in (HARD[:1], HARD[:6]):
        assert proofs(frame(spark, rows), 1) == brute(rows)
    assert proofs(frame(spark, HARD).limit(0)) == []


def test_ranks_of_a_hot_group_spread_over_tasks(spark):
    rng = random.Random(4)
    rows = [(i, "s", rng.choice(["hot"] * 8 + ["a", None]), rng.randrange(5), "t") for i in range(3000)]
    df = ranked(frame(spark, rows).select("doc_id", "lang", "n_chars"), ["lang"], ["n_chars"], "test-ranks")
    got = df.collect()
    groups = defaultdict(list)
    for r in got:
        groups[r.lang].append((r["rank"], r.n_chars))
    for lang, found in groups.items():
        assert [i for i, _ in sorted(found)] == list(range(len(found)))
        assert [x for _, x in sorted(found)] == sorted(r[3] for r in rows if r[2] == lang)
