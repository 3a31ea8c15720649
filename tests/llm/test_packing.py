import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from docketline.llm.packing import UnitCoder, fullest, pack_rests, pack_sequences
from tests.llm.util import HARD, frame, prose

PATH = public_tokenizers.path("byte_bpe_50k.json")


def best_sum(counts, capacity, first):
    sums = {first}
    for k, n in counts.items():
        for _ in range(n - (k == first)):
            sums |= {s + k for s in sums if s + k <= capacity}
    return max(sums)


def test_fullest_is_the_best_subset_sum():
    rng = random.Random(5)
    for _ in range(300):
        counts = Counter(rng.randint(1, 60) for _ in range(rng.randint(1, 12)))
        first, capacity = max(counts), 64
        got = fullest(counts, capacity, first)
        assert got[first] >= 1 and all(n <= counts[k] for k, n in got.items())
        assert sum(k * n for k, n in got.items()) == best_sum(counts, capacity, first)


def test_rests_are_packed_without_padding():
    rng = random.Random(6)
    for lengths in ([600] * 500, [1023] * 90, [1] * 3000, [rng.randint(1, 1023) for _ in range(3000)], [7], [], [512, 512]):
        rests = [(i, 0, n) for i, n in enumerate(lengths)]
        out = pack_rests(rests, 1024)
        sizes = [sum(p[2] for p in seq) for seq in out]
        short = [n for n in sizes if n < 1024]
        assert max(sizes, default=0) <= 1024 and all(n & (n - 1) == 0 for n in short) and len(short) == len(set(short))
        seen = defaultdict(list)
        for doc, start, n in (p for seq in out for p in seq):
            seen[doc].append((start, n))
        assert len(seen) == len(lengths)
        for doc, parts in seen.items():
            at = 0
            for start, n in sorted(parts):
                assert start == at and n > 0
                at += n
            assert at == lengths[doc]


TEXTS = ["don't it's I'll we've 'tis x.'s ''s", "a<|endoftext|> b <|endoftext|>", "nbsp  x  y　\n z\u0085 q", "tab\t\tx  y \n\n z ",
         "é è. ça, où? ñ! 中文 字，x", "a1b2 3.14 -- ... !? (x) [y] {z} ~`", " lead", "trail ", "​ ﻿ á .", "x\x1f \x7f y\x00 z", "I'M DON'T 's"]


def test_ids_are_those_of_the_library(spark):
    t = Tokenizer.from_file(PATH)
    rng = random.Random(9)
    alphabet = "ab'Zé .,\n\t  　中1!\x1c"
    rows = [(i, x) for i, x in enumerate(TEXTS + ["".join(rng.choice(alphabet) for _ in range(80)) for _ in range(400)])]
    got = defaultdict(list)
    for r in pack_sequences(frame(spark, rows, 2), PATH).collect():
        got[r.doc_id].append((r.start, np.frombuffer(r.ids, "<u4").tolist()))
    for i, text in rows:
        assert sum((ids for _, ids in sorted(got[i])), []) == [*t.encode(text, add_special_tokens=False).ids, 0], text


def check(rows, out, window):
    t = Tokenizer.from_file(PATH)
    want = Counter((i, tuple(t.encode(x or "", add_special_tokens=False).ids) + (0,)) for i, x in rows)
    seqs, docs = defaultdict(list), defaultdict(list)
    for r in out:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert r.length == len(ids) > 0
        seqs[r.sequence_id].append((r.offset, r.length))
        docs[(r.doc_id, r.doc_tokens)].append((r.start, ids))
    for parts in seqs.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at == window or (at < window and at & (at - 1) == 0)
    # rows may repeat an id: their pieces together hold each id's place as often as there are rows
    places = Counter((k[0], s + j, x) for k, parts in docs.items() for s, ids in parts for j, x in enumerate(ids))
    assert places == Counter((i, j, x) for (i, ids), n in want.items() for _ in range(n) for j, x in enumerate(ids))


def test_hard_rows_and_small_blocks(spark):
    rows = HARD + [(100 + i, prose(i, i % 90)) for i in range(200)] + [(900 + i, "copy of one text") for i in range(100)]
    for window, block in ((1024, 1 << 22), (64, 500)):
        check(rows, pack_sequences(frame(spark, rows), PATH, window, block).collect(), window)


def test_empty_table(spark):
    assert pack_sequences(frame(spark, []).limit(0), PATH).count() == 0


def test_memory_of_units_starts_anew_when_full(spark, monkeypatch):
    from docketline.llm.common import text_chunks
    import pyarrow as pa
    coder = UnitCoder(open(PATH).read())
    coder.MOST = 50
    texts = [prose(k, 40) for k in range(30)]
    t = Tokenizer.from_file(PATH)
    for c in text_chunks(iter([pa.record_batch({"text": pa.array(texts)})]), max_bytes=300):
        for text, ids in zip(c.column("text"), coder.encode(c)):
            assert ids.tolist() == t.encode(text, add_special_tokens=False).ids
