import collections
import math
import os
import random
import zlib

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece

from docketline.llm.lm_score import COUNT, LEAST, LogFrequencyFilter, _reduce, first_level, score_texts
from docketline.llm.piece_codec import PieceCodec, encode_decode, read_vocabulary
from docketline.llm.toxicity import ConvClassifier, Params, calibrate, score_toxicity
from tests.llm.util import HARD, frame, prose, words

MODEL = public_tokenizers.path("piece_bpe_32k.model")


# ---- SentencePiece
@pytest.fixture(scope="module")
def codec():
    return PieceCodec(read_vocabulary(MODEL), cache_size=500)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_codec_equals_the_library(codec, library):
    rng = random.Random(1)
    pieces = [p for p, _, k in read_vocabulary(MODEL) if k == "piece"]
    letters = "abcdefghijklmnop ▁\n\té中😀ththeingtion 0123<>"
    texts = ["", " ", "\n", "▁a", "<s>a</s>", "<0x0A>", "ﬁ½", "\0a", "﻿a", "x" * 5000, " " * 700]
    texts += [" " * k for k in range(40)] + ["x" + " " * k + "y" for k in range(40)]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randint(1, 60))) for _ in range(1500)]
    texts += ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 6))) for _ in range(4000)]
    for t in texts:
        ids = codec.encode(t).tolist()
        assert ids == library.encode(t, add_eos=True), t
        assert codec.decode(ids) == library.decode(ids), t


def test_decode_of_any_ids(codec, library):
    rng = random.Random(2)
    for _ in range(1500):
        ids = [rng.randrange(32_000) for _ in range(rng.randint(0, 8))] + [rng.randint(3, 258) for _ in range(rng.randint(0, 3))]
        assert codec.decode(ids) == library.decode(ids)


def test_encode_rows(spark, library):
    got = encode_decode(frame(spark, HARD), MODEL).collect()
    assert len(got) == len(HARD)
    want = sorted(((d, library.encode(t or "", add_eos=True)) for d, t in HARD), key=repr)
    assert sorted(((r.doc_id, r.ids) for r in got), key=repr) == want
    assert all(r.decoded == library.decode(r.ids) for r in got)
    assert encode_decode(frame(spark, []).limit(0), MODEL).count() == 0


# ---- language model
def test_filter_tells_quantised_counts():
    import numpy as np
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 1 << 63, 2000, dtype=np.uint64) * np.uint64(2)
    count = np.concatenate([np.arange(1, 1001), rng.integers(1, 10**6, 1000)])
    f = LogFrequencyFilter(np.zeros(1 << 14, np.uint64), 3)
    for b in range(8):
        own = keys >> np.uint64(61) == b
        low = ((keys[own] >> np.uint64(29)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        f.fill(f.words[b << f.log2_slice:(b + 1) << f.log2_slice], b, low, count[own])
    level = f.level(keys)
    assert (level >= np.searchsorted(LEAST, count, "right")).all()            # never too low
    assert (level == np.searchsorted(LEAST, count, "right")).mean() > 0.9
    assert all(abs(COUNT[k + 1] / c - 1) < 0.1 for k, c in enumerate(LEAST[:12].tolist()))
    assert (f.level(rng.integers(0, 1 << 63, 5000, dtype=np.uint64)) == 0).mean() > 0.8


def held(d):
    return d is not None and zlib.crc32(str(d).encode()) % 10 == 0


def test_scores(spark):
    text = [(i, prose(i % 97, 40, 300) + f" own{i}") for i in range(400)]
    rows = [x for x in HARD if x[0] is None or x[0] < 100] + [(i + 1000, t) for i, t in text]
    got = score_texts(frame(spark, rows, 4), table_words=100).collect()      # most words go the way of the join
    counts = collections.Counter()
    for d, t in rows:
        if not held(d):
            counts.update([*words(t), "\n"])
    n, v = sum(counts.values()), len(counts)
    norm = math.log10(n + 0.1 * (v + 1))
    want = sorted(((d, held(d), len(w), sum(counts[x] > 0 for x in w), n, round(sum(math.log10(counts[x] + 0.1) for x in w) - len(w) * norm, 4))
                   for d, t in rows for w in [[*words(t), "\n"]]), key=repr)
    assert sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got), key=repr) == want
    out = [r for r in got if r.held_out and r.n_tokens > 20]
    assert len(out) > 10 and sum(r.score for r in out) > sum(r.base_score for r in out)
    assert all(r.score < 0 for r in got)


@pytest.mark.parametrize("n", [2_000, 200_000])
def test_error_rate_does_not_grow_with_the_ngrams(n):
    import numpy as np
    rng = np.random.default_rng(3)
    low = np.unique(rng.integers(0, 1 << 32, n, dtype=np.uint64).astype(np.uint32))
    count = rng.integers(2, 40, len(low)).astype(np.uint32)
    t = pa.table({"bucket": pa.array([5], pa.int32()), "words": [b""], "counts": [b""], "keys2": [low.tobytes()], "n2": [count.tobytes()],
                  "keys3": [b""], "n3": [b""]})
    words = np.frombuffer(_reduce(3, 2)(t).column("slice")[0].as_py(), np.uint64)
    level = lambda x: LogFrequencyFilter.probe(words, LogFrequencyFilter.base(np.uint64(5), x), np.zeros(len(x), np.int64),
                                               np.full(len(x), np.uint64(len(words))), first_level(2, 2))
    true = np.searchsorted(LEAST, count, "right")
    assert (level(low) >= true).all() and (level(low) == true).mean() > 0.97
    other = np.setdiff1d(rng.integers(0, 1 << 32, 50_000, dtype=np.uint64).astype(np.uint32), low)
    assert (level(other) == 0).mean() > 0.97


def test_slices_score_as_the_broadcast_filter(spark):
    rows = [x for x in HARD if x[0] is None or x[0] < 100] + [(i + 1000, prose(i % 97, 40, 300) + f" own{i}") for i in range(300)]
    near, far = (sorted(map(tuple, score_texts(frame(spark, rows, 4), table_words=100, broadcast_bytes=b).collect()), key=repr)
                 for b in (64 << 20, 0))
    assert len(near) == len(rows) and near == far
    assert score_texts(frame(spark, []).limit(0), broadcast_bytes=0).count() == 0


def test_a_filter_over_the_broadcast_limit_is_mapped(spark, monkeypatch):
    import numpy as np

    from docketline.llm import lm_score
    rows = [(i, prose(i % 97, 40, 300) + f" own{i}") for i in range(300)]
    ways, files = [], []
    mapped, broadcast = lm_score.MappedFilter.write, type(spark.sparkContext).broadcast
    monkeypatch.setattr(lm_score.MappedFilter, "write", lambda f, slices: (files.append(f.path), mapped(f, slices)))
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda sc, x: (ways.append(type(x)), broadcast(sc, x))[1])
    score = lambda **kw: sorted(map(tuple, score_texts(frame(spark, rows, 4), table_words=100, **kw).collect()), key=repr)
    found = score(broadcast_bytes=64 << 10)                                  # larger than the broadcast limit: no worker loads it
    assert len(files) == 1 and lm_score.LogFrequencyFilter not in ways
    assert not any(map(os.path.exists, files))                               # and it goes when it was read
    assert found == score(broadcast_bytes=64 << 20, mapped=0) == score(broadcast_bytes=0)
    assert lm_score.LogFrequencyFilter in ways and len(files) == 1
    starts = np.array([0, 2, 3])
    f = lm_score.MappedFilter(f"{os.path.dirname(files[0])}/own", 1, starts)
    mapped(f, [{"bucket": 1, "slice": np.array([7], np.uint64).tobytes()}])
    assert f.value.words.tolist() == [0, 0, 7] and isinstance(f.value.words.base, np.memmap)
    os.unlink(f.path)


def test_scores_without_rows(spark):
    assert score_texts(frame(spark, []).limit(0)).count() == 0
    none = [i for i in range(200) if held(i)][:3]
    got = score_texts(frame(spark, [(i, "some words") for i in none])).collect()
    assert {(r.train_tokens, r.n_known, r.n_tokens) for r in got} == {(0, 0, 3)}


# ---- toxicity
def toxic_rows(n=900):
    rng, rows = random.Random(4), []
    for i in range(n):
        w = prose(i, rng.randint(5, 120), 3000).split()
        bad = rng.random() < 0.2
        for _ in range(rng.randint(2, 5) if bad else 0):
            w.insert(rng.randint(0, len(w)), rng.choice(["grunk", "blargh", "vexor", "vexoid"]))
        rows.append((i, " ".join(w), int(bad)))
    return rows


def test_toxicity_on_held_out_rows(spark):
    rows = toxic_rows()
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    docs = frame(spark, [(i, t) for i, t, _ in rows] + [(10_000, None), (10_001, ""), (None, "plain"), (10_002, "grunk " * 20_000)])
    got = {r.doc_id: r for r in score_toxicity(docs, labels, params=Params(steps=600)).collect()}
    assert len(got) == len(rows) + 4
    label = {i: y for i, _, y in rows}
    test = [r for d, r in got.items() if d in label and r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got.values() if r.doc_id is not None)
    right = sum(r.predicted == label[r.doc_id] for r in test) / len(test)
    assert right > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got.values())
    assert got[10_000].score == got[10_001].score and got[10_000].predicted == 0 and got[10_002].predicted == 1


def test_language_is_no_input_of_the_score(spark):
    rows = toxic_rows(300)
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows], "doc_id long, quality int, toxic int")
    one, two = (score_toxicity(frame(spark, [(i, t) for i, t, _ in rows], lang=g), labels, params=Params(steps=50)) for g in ("en", None))
    pick = lambda df: sorted((r.doc_id, r.score) for r in df.collect())
    assert pick(one) == pick(two)


def test_thresholds_come_from_all_labelled_rows(spark):
    rows = toxic_rows(900)
    rng = random.Random(5)
    few = [(5000 + i, prose(5000 + i, 30, 3000) + (" grunk blargh" if i % 4 == 0 else ""), int(i % 4 == 0)) for i in range(60)]
    long = [(7000 + i, prose(7000 + i, 3000, 3000) + (" vexor grunk" if i % 2 else ""), i % 2) for i in range(40)]  # over sample_bytes
    rng.shuffle(few)
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows + few + long], "doc_id long, quality int, toxic int")
    docs = frame(spark, [(i, t) for i, t, _ in rows]).unionByName(frame(spark, [(i, t) for i, t, _ in few], lang="xx")).unionByName(
        frame(spark, [(i, t) for i, t, _ in long], lang="yy"))
    got = {r.doc_id: r for r in score_toxicity(docs, labels, params=Params(steps=600, sample=400)).collect()}
    cut = {g: {got[i].lang_threshold for i, _, _ in part} for g, part in (("xx", few), ("yy", long))}
    assert all(len(c) == 1 and c != {0.7} for c in cut.values())
    for part in (few, long):
        train = [(got[i], y) for i, _, y in part if not got[i].held_out]
        right = lambda t: sum((r.score >= t) == y for r, y in train)  # noqa: B023, E731
        assert right(train[0][0].lang_threshold) > 0.9 * len(train)


def test_calibration_finds_the_best_cut():
    import numpy as np
    rng = np.random.default_rng(8)
    y = rng.random(3000) < 0.3
    logit = np.round((rng.standard_normal(3000) + 2 * y) * 8) / 8
    x, at = np.unique(logit, return_inverse=True)
    model = ConvClassifier(Params())
    calibrate(model, np.array([None] * len(x), object), x, np.bincount(at, y), np.bincount(at))
    f1 = lambda p: 2 * (p & y).sum() / (p.sum() + y.sum())
    assert f1(model.score(logit) >= 0.7) == max(f1(logit >= c) for c in x)


def test_toxicity_without_labels(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.predicted for r in score_toxicity(frame(spark, HARD), none).collect()} == {0}
    assert score_toxicity(frame(spark, []).limit(0), none).count() == 0
