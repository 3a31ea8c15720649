import hashlib
import itertools
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from docketline.llm import suffix_dedup as S
from docketline.llm.common import listed_keys, materialise
from docketline.llm.exact_dedup import exact_duplicates
from docketline.llm.jaccard_join import _by_prefix, _fits, jaccard_components, links, plain_entries
from docketline.llm.line_dedup import drop_common_lines
from docketline.llm.substring_dedup import remove_passages, tune_bands
from docketline.llm.suffix_dedup import remove_repeats
from tests.llm.util import HARD, SPACES, frame, lower, prose, words


def sha(t):
    return hashlib.sha256(t.encode() if isinstance(t, str) else t).hexdigest()


# ---- exact dedup
@pytest.mark.parametrize("keep,rounds", [("largest", 1), ("smallest", 1), ("largest", 3), ("smallest", 3)])
def test_exact_groups(spark, keep, rounds):
    rows = HARD + [(20 + i, "hot") for i in range(50)]
    got = exact_duplicates(frame(spark, rows), keep=keep, fan_log2=1, rounds=rounds).collect()
    assert len(got) == len(rows)
    best = max if keep == "largest" else min
    for text in {t or "" for _, t in rows}:
        ids = [i for i, t in rows if (t or "") == text]
        own = [r for r in got if r.text_sha256 == sha(text)]
        known = [i for i in ids if i is not None]
        assert sorted(map(repr, ids)) == sorted(repr(r.doc_id) for r in own)
        assert {r.keep_id for r in own} == {best(known) if known else None}
        assert {r.group_size for r in own} == {len(ids)}
        kept = [r.doc_id for r in own if r.kept]
        assert kept == [best(known) if known else None]      # exactly one row, ties included


def test_exact_empty(spark):
    assert exact_duplicates(frame(spark, []).limit(0)).count() == 0


# ---- line dedup
def brute_lines(rows, least, first=False):
    docs = {}
    for r in rows:
        docs.setdefault(r, None)
    found = {}
    key = lambda line: lower(line.strip(SPACES))
    order = lambda d: (-(1 << 63) if d[0] is None else d[0],)
    for d in docs:
        for line in (d[1] or "").split("\n"):
            if key(line):
                found.setdefault(key(line), set()).add(d)
    out = []
    for d in rows:
        lines = (d[1] or "").split("\n")
        stay, seen = [], set()
        for line in lines:
            k = key(line)
            gone = bool(k) and len(found[k]) >= least
            if gone and first and k not in seen and d == min(found[k], key=order):
                gone = False
            seen.add(k)
            stay += [] if gone else [line]
        out.append((d[0], len(lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("least,first", [(3, False), (2, True)])
def test_lines(spark, least, first):
    rng = random.Random(1)
    pool = [prose(k, 4, 50) for k in range(30)]
    rows = [(100 + i, "\n".join(rng.choice([" {} ", "{}", "{}\r"]).format(rng.choice(pool)).upper() for _ in range(rng.randint(0, 9))))
            for i in range(60)] + [(i, t) for i, t in HARD if i is not None]
    rows += [(300 + i, "hot line\nown %d" % i) for i in range(200)]
    got = drop_common_lines(frame(spark, rows, 5), min_docs=least, keep_first=first)
    assert sorted(map(tuple, got.collect()), key=repr) == brute_lines(rows, least, first)


def test_lines_null_ids_and_empty(spark):
    rows = [(None, "a\nb"), (None, "a\nb"), (None, "a\nc"), (1, "a")]
    got = drop_common_lines(frame(spark, rows), min_docs=3)       # equal rows are one document
    assert sorted(map(tuple, got.collect()), key=repr) == brute_lines(rows, 3)
    assert drop_common_lines(frame(spark, []).limit(0)).count() == 0
    kept = drop_common_lines(frame(spark, rows), min_docs=3, carry=["doc_id", "row", "text"]).select("row.*").columns
    assert kept == ["doc_id", "row", "text"]


# ---- n-gram Jaccard join
def brute_components(rows, k=5, percent=80):
    sets = [{tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if (w := words(t)) else set() for _, t in rows]
    group = list(range(len(rows)))
    for a, b in itertools.combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            old, new = max(group[a], group[b]), min(group[a], group[b])
            group = [new if g == old else g for g in group]
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if group[j] == group[i] and rows[j][0] is not None]
        out.append((d, len(sets[i]), min(ids) if ids else None))
    return sorted(out, key=repr)


def test_jaccard_components(spark):
    rng = random.Random(2)
    rows = list(HARD)
    boiler = prose(99, 40)
    for base in range(6):                      # near copies with one to eight edits, chains and shared passages
        w = prose(1000 + base, 80).split()
        for c in range(14):
            v = list(w)
            for _ in range(rng.randint(0, 8) if base % 2 else c // 2):
                v[rng.randrange(len(v))] = f"e{rng.randrange(10**6)}"
            rows.append((1000 + 50 * base + c, " ".join(v) + (" " + boiler if base == 5 else "")))
    rows += [(2000 + i, boiler + f" tail{i % 3}") for i in range(8)] + [(2100, "four words only here"), (2101, "Four  words ONLY here")]
    got = jaccard_components(frame(spark, rows, 4)).select("doc_id", "n_shingles", "component_id")
    assert sorted(map(tuple, got.collect()), key=repr) == brute_components(rows)


def test_jaccard_empty(spark):
    assert jaccard_components(frame(spark, []).limit(0)).count() == 0
    assert [tuple(r)[:3] for r in jaccard_components(frame(spark, [(1, None)])).collect()] == [(1, 0, 1)]


# ---- suffix arrays
def test_suffix_array_and_prefixes():
    rng = random.Random(3)
    for length, trial in itertools.product((4, 9, 50), range(12)):
        t = bytes(rng.choice(b"ab" if trial % 2 else b"abcdefgh\0") for _ in range(rng.randint(length, 300)))
        arr = np.frombuffer(t + bytes(2 * (length + 8)), np.uint8)
        sa = S.suffix_array(arr, np.arange(len(t) - length + 1), length)
        keys = [arr[i:i + length].tobytes() for i in sa]
        assert keys == sorted(keys) and sorted(sa) == list(range(len(t) - length + 1))
        for x, lcp in enumerate(S.common_prefixes(arr, sa, length)):
            same = 0
            while x and same < length and arr[sa[x] + same] == arr[sa[x - 1] + same]:
                same += 1
            assert lcp == same


def brute_repeats(rows, length):
    last, first = 1 << 63, {}
    for d, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - length + 1):
            w = b[i:i + length]
            first[w] = min(first.get(w, last + 1), last if d is None else d)
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if first[b[i:i + length]] < (last if d is None else d):
                gone[i:i + length] = True
        spans = int((np.diff(np.r_[0, gone.astype(int), 0]) == 1).sum())
        out.append((d, len(b), int(gone.sum()), spans, bytes(np.frombuffer(b, np.uint8)[~gone])))
    return sorted(out, key=repr)


@pytest.mark.parametrize("length,shard", [(50, 16 << 20), (50, 3000), (20, 800)])
def test_repeats(spark, length, shard):
    rng = random.Random(5)
    passages = [prose(70 + k, 40) for k in range(5)]
    rows = [x for x in HARD if x[0] != 7] + [(7, prose(7, 900))]
    for i in range(60):
        t = prose(200 + i, rng.randint(0, 60))
        if i % 2:
            p, k = rng.choice(passages), rng.randint(0, len(t))
            a = rng.randint(0, len(p) // 2)
            t = t[:k] + p[a:a + rng.randint(20, 150)] + t[k:]
        rows.append((100 + i, t))
    rows += [(203, "a" * 3000), (202, "a" * 500 + "b" + "a" * 700), (204, "ab" * 400), (205, "é" * 100)]
    got = remove_repeats(frame(spark, rows, 4), length=length, shard_bytes=shard).collect()
    assert sorted(((r[0], r[1], r[2], r[3], bytes(r[4])) for r in got), key=repr) == brute_repeats(rows, length)


def test_repeats_empty(spark):
    assert remove_repeats(frame(spark, []).limit(0)).count() == 0


# ---- passages
def test_bands_reach_the_recall():
    for rows in (1, 2, 3):
        bands = tune_bands(0.8, 0.999, rows)
        assert 1 - (1 - 0.8 ** rows) ** bands >= 0.999 > 1 - (1 - 0.8 ** rows) ** (bands - 1)


def test_passages(spark):
    rng = random.Random(6)
    passage = prose(900, 70, 10**6)
    own = [(300 + i, prose(3000 + i, 150, 10**6)) for i in range(40)]
    rows, planted = [x for x in HARD if x[0] != 8], []
    for i, t in own:
        w = t.split()
        if i % 4 == 0:
            at = rng.randint(0, len(w))
            w[at:at] = passage.split()
            planted.append(i)
        rows.append((i, " ".join(w)))
    near = rows[-1][1].split()
    near[20] = "changed"
    rows.append((500, " ".join(near)))
    got = {(r.doc_id, r.n_bytes): r for r in remove_passages(frame(spark, rows, 4)).collect()}
    touched = {d for (d, _), r in got.items() if r.n_removed and 300 <= (d or 0) < 500}
    assert touched == set(planted[1:])                        # the first keeps it, clean texts stay whole
    for d in planted[1:]:
        r = next(r for (x, _), r in got.items() if x == d)
        # at its edges a passage can stand with a near copy that came later than the first
        assert planted[0] in r.source_ids and set(r.source_ids) <= set(planted) and 150 < r.n_removed <= len(passage) + 40
    copy = next(r for (d, _), r in got.items() if d == 500)
    assert copy.n_removed > 0.7 * copy.n_bytes and copy.source_ids == [rows[-2][0]]
    for (d, _), r in got.items():
        assert r.n_bytes - r.n_removed == len(r.kept)


@pytest.mark.parametrize("width", [6, 10, 12, 15, 20])
def test_repeats_in_short_lines(spark, width):
    def wrapped(w):
        return "\n".join(" ".join(w[i:i + width]) for i in range(0, len(w), width))

    rows, long = [], {}
    for i, n in enumerate([50, 60, 110, 300] * 6):           # each passage in two documents, at another place in the lines
        passage = prose(5000 + i, n, 10**6).split()
        for copy in (0, 1):
            own = prose(6000 + 2 * i + copy, 90, 10**6).split()
            own[35 + 7 * copy:35 + 7 * copy] = passage
            rows.append((2 * i + copy, wrapped(own)))
            long[2 * i + copy] = len(" ".join(passage))
    got = {r.doc_id: r for r in remove_passages(frame(spark, rows, 4)).collect()}
    assert all(got[d].n_removed == 0 for d in got if d % 2 == 0)
    found = {d: got[d].n_removed for d in got if d % 2 and got[d].n_removed}
    assert all(found[d] == long[d] and got[d].source_ids == [d - 1] for d in found)       # to the true ends, not a word more
    assert all(d in found for d in long if d % 2 and long[d] > 700) and len(found) >= 20


def test_near_copies_of_paragraphs_go_whole(spark):
    rng, rows, near = random.Random(9), [], {}
    for i, (n, changes) in enumerate([(60, 1), (110, 2), (200, 4)] * 8):
        w = prose(7000 + i, n, 10**6).split()
        v = list(w)
        for c in range(changes):
            v[n * (2 * c + 1) // (2 * changes) + rng.randint(-3, 3)] = "changed"
        near[1000 + i] = " ".join(v)
        rows += [(i, prose(8000 + i, 30, 10**6) + "\n" + " ".join(w)), (1000 + i, prose(9000 + i, 30, 10**6) + "\n" + near[1000 + i])]
    wrapped = near[1000 + 1].split()
    rows.append((2000, "own words of it\n\n" + "\n".join(" ".join(wrapped[k:k + 9]) for k in range(0, len(wrapped), 9))))
    got = {r.doc_id: r for r in remove_passages(frame(spark, rows, 4)).collect()}
    assert all(got[d].n_removed == len(t.encode()) and got[d].source_ids == [d - 1000] for d, t in near.items())
    assert bytes(got[2000].kept).strip() == b"own words of it"


@pytest.mark.parametrize("split", [64, 1])
def test_paragraphs_against_all_pairs(spark, split):
    """Clusters of paragraphs by brute force: all pairs, exact Jaccard, components; the smallest document keeps its own."""
    rng, paras = random.Random(12), {}
    for i in range(40):                                       # (document, place) -> words; later ones copy earlier ones
        for j in range(3):
            w = prose(40_000 + 3 * i + j, rng.randint(25, 120), 10**6).split()
            if i > 3 and rng.random() < 0.6:
                w = list(paras[rng.randrange(i), rng.randrange(3)])
                for _ in range(rng.choice([0, 0, 1, 1, 2, 4, 9])):
                    w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
            paras[i, j] = w
    sets = {x: {tuple(w[a:a + 5]) for a in range(len(w) - 4)} for x, w in paras.items()}
    first, linked = {x: x for x in paras}, 0
    for a, b in itertools.combinations(paras, 2):
        both = len(sets[a] & sets[b])
        if 100 * both >= 80 * len(sets[a] | sets[b]):
            linked += 1
            old, new = sorted([first[a], first[b]])[::-1]
            first = {x: new if f == old else f for x, f in first.items()}
    got = {r.doc_id: bytes(r.kept).decode() for r in remove_passages(frame(
        spark, [(i, "\n\n".join(" ".join(paras[i, j]) for j in range(3))) for i in range(40)], 4), split=split).collect()}
    assert linked > 40
    runs = lambda w: {tuple(w[a:a + 7]) for a in range(len(w) - 6)}
    gone = whole = 0
    for (i, j), w in paras.items():
        kept = set(got[i].split())
        if first[i, j][0] < i:
            elsewhere = {x for k in range(3) if first[i, k][0] == i for x in paras[i, k]}
            assert not (set(w) - elsewhere) & kept
            gone += 1
        elif not any(runs(w) & runs(v) for (k, _), v in paras.items() if k < i):
            assert " ".join(w) in got[i]
            whole += 1
    assert gone > 20 and whole > 20


def test_long_lists_fall_into_short_ones(spark):
    """120 sets that share a band and seven tenths of their elements, and a chain of near copies among them: every link
    is found with the list taken apart, and the list's pairs are few."""
    rng = random.Random(5)
    base, sets = list(range(1, 71)), []
    for i in range(120):
        sets.append(set(base) | {1000 * (i + 1) + j for j in range(30)})
    for i in range(10):                                       # near copies: four elements changed, from one to the next
        prior = sets[-1] if i else sets[0]
        sets.append(prior - set(rng.sample(sorted(prior), 4)) | {10**6 + 10 * i + j for j in range(4)})
    mixed_hash = lambda v: (v * 0x9E3779B97F4A7C15 + 0x123456789) % 2**63
    rows = [(i, len(s), sorted(mixed_hash(v) for v in s)) for i, s in enumerate(sets)]
    rows = [(i, n, hs, [sum(1 for h in hs if (h >> 58) % 32 == b) for b in range(32)]) for i, n, hs in rows]
    frame_ = spark.createDataFrame(rows, "rid long, n int, hs array<long>, bins array<int>")
    entries = plain_entries(frame_.select(F.lit(7).cast("long").alias("h"), "rid", "n", "bins"))
    want = {x: x for x in range(len(sets))}
    for a, b in itertools.combinations(range(len(sets)), 2):
        if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            old, new = sorted([want[a], want[b]])[::-1]
            want = {x: new if f == old else f for x, f in want.items()}
    for split in (None, 16):
        _, comp = links(entries, frame_, 80, 32, split)
        got = {r.node: r.comp for r in comp.collect()}
        assert {x: got.get(x, x) for x in want} == want
    assert len(set(want.values())) == 120
    mixed = entries.withColumn("comp", F.col("rid"))
    apart = _by_prefix(mixed, frame_, 80, 16)
    most = apart.groupBy("h", "e").count().agg(F.max("count")).first()[0]
    assert most <= 16 < mixed.count()


def test_passages_empty(spark):
    assert remove_passages(frame(spark, []).limit(0)).count() == 0
    assert remove_passages(frame(spark, [(1, None)])).first().n_removed == 0


def test_shuffles_go_with_their_query(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles
    left = files().size()
    kept = materialise(spark.range(2000, numPartitions=4).groupBy((F.col("id") % 7).alias("k")).count(), "kept")
    until = time.time() + 10
    while files().size() > left and time.time() < until:
        time.sleep(0.1)
    assert files().size() <= left and kept.count() == 7
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) is None


def test_filter_of_counts_does_not_grow_with_the_classes(spark):
    """32 classes written out make a method that the JVM does not compile; the sum is the same."""
    assert str(_fits("x", "y", 80, 32)).count("least") == str(_fits("x", "y", 80, 320)).count("least")
    rng, rows = random.Random(3), []
    for _ in range(200):
        a = [rng.randrange(4) for _ in range(32)]
        b = [max(0, v + rng.choice([0, 0, 0, 0, 1, -1])) for v in a]
        rows.append((sum(a), sum(b), sum(a), sum(b), 0, 0, a, b))
    pairs = spark.createDataFrame(rows, "xn int, yn int, xpos int, ypos int, xown int, yown int, xlow array<int>, ylow array<int>")
    got = [r[0] for r in pairs.select(_fits("x", "y", 80, 32)).collect()]
    want = [n * 100 >= m * 80 and m * 100 >= n * 80 and sum(map(min, a, b)) >= -(-80 * (n + m) // 180) for n, m, *_, a, b in rows]
    assert got == want and 0 < sum(want) < 200


def test_listed_keys(spark):
    rng = random.Random(4)
    keys = [rng.randrange(-(1 << 63), 1 << 63) for _ in range(3000)]
    table = spark.createDataFrame([(k,) for k in keys[:1000] * 2], "key long")
    seen = listed_keys(table, "key", 0)
    told = seen.has(np.array(keys, np.int64).view(np.uint64))
    assert told[:1000].all() and told[1000:].sum() < 50
    assert not listed_keys(table.limit(0), "key", 0).has(np.array(keys, np.int64).view(np.uint64)).any()
