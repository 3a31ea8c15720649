"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy."""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketline.llm.common import LOWER, U64, Chunk, carried, hash_spans, text_chunks, word_spans

#: a word's letters: 0-9, a-z (after lowering A-Z) and bytes of non-ASCII characters
GAP = np.ones(256, bool)
GAP[48:58] = GAP[97:123] = GAP[128:256] = False


@dataclass
class Params:
    """Shape and training of the classifier. ``sample`` and ``sample_bytes`` bound the labelled
    rows it is fitted on, and their texts."""

    buckets_log2: int = 16
    dim: int = 8
    widths: tuple[int, ...] = (1, 2, 3)
    filters: int = 8
    prefix_bytes: int = 4
    sample: int = 12_000
    sample_bytes: int = 8_000
    max_words: int = 400      # training windows: a text is cut into pieces of so many words
    epochs: int = 6
    steps: int = 2000         # at least so many batches, however few the rows
    batch: int = 32
    rate: float = 0.02
    seed: int = 7
    target: float = 0.7       # the score at which a text counts as toxic


def features(c: Chunk, p: Params) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word bucket, prefix bucket, text index) of each word of a chunk."""
    lower = LOWER[c.data]
    starts, ends, doc = word_spans(lower, c.offs, GAP)
    shift = U64(64 - p.buckets_log2)
    word = hash_spans(lower, starts, ends) >> shift
    head = hash_spans(lower, starts, np.minimum(ends, starts + p.prefix_bytes)) >> shift
    return word.astype(np.int64), (head ^ U64(1)).astype(np.int64), doc


class ConvClassifier:
    """score = sigmoid(v . max over positions of relu(conv_w(embeddings)) + b), for several widths w.

    A word's embedding is the sum of its hashed word vector and its hashed prefix vector, so that
    inflected or compounded forms share what their beginning tells.
    """

    def __init__(self, p: Params):
        rng = np.random.default_rng(p.seed)
        self.p = p
        n = 1 << p.buckets_log2
        self.emb = np.zeros((2 * n, p.dim), np.float32)   # words never trained on say nothing, however many
        self.conv = [(rng.standard_normal((w, p.dim, p.filters)) / np.sqrt(w * p.dim)).astype(np.float32) for w in p.widths]
        self.bias = [np.full(p.filters, 0.1, np.float32) for _ in p.widths]
        self.out = (rng.standard_normal(len(p.widths) * p.filters) * 0.3).astype(np.float32)
        self.b = np.zeros(1, np.float32)
        self.scale, self.shift = 1.0, 0.0

    # ---- training: padded batches of word windows, Adam with lazily updated embedding rows
    def fit(self, words: list[np.ndarray], heads: list[np.ndarray], label: np.ndarray) -> None:
        p, rng, n = self.p, np.random.default_rng(self.p.seed), 1 << self.p.buckets_log2
        dense = [*self.conv, *self.bias, self.out, self.b]
        m1, m2 = [np.zeros_like(x) for x in dense], [np.zeros_like(x) for x in dense]
        g2 = np.zeros(2 * n, np.float32)
        step = 0
        size = np.array([len(w) for w in words])
        epochs = max(p.epochs, -(-p.steps // max(1, -(-len(words) // p.batch))))
        for epoch in range(epochs):
            order = rng.permutation(len(words))
            order = order[np.argsort(size[order] // 64, kind="stable")]  # like lengths share a batch
            cuts = rng.permutation(range(0, len(order), p.batch))
            rate = p.rate * (1 - epoch / epochs)
            for at in cuts:
                rows = order[at:at + p.batch]
                width = max(max(p.widths), int(size[rows].max(initial=0)))
                idx = np.zeros((2, len(rows), width), np.int64)
                real = np.zeros((len(rows), width), np.float32)
                for k, r in enumerate(rows):
                    idx[0, k, :size[r]], idx[1, k, :size[r]], real[k, :size[r]] = words[r], heads[r] + n, 1
                e = (self.emb[idx[0]] + self.emb[idx[1]]) * real[..., None]
                pooled, cache = [], []
                for w, k, b in zip(p.widths, self.conv, self.bias):
                    span = width - w + 1
                    z = sum(e[:, j:j + span] @ k[j] for j in range(w)) + b
                    best = z.argmax(1)
                    top = np.take_along_axis(z, best[:, None], 1)[:, 0]
                    pooled.append(np.maximum(top, 0))
                    cache.append((best, top > 0))
                h = np.concatenate(pooled, 1)
                drop = (rng.random(h.shape) > 0.2).astype(np.float32) / 0.8
                z = h * drop @ self.out + self.b
                prob = 1 / (1 + np.exp(-z))
                dz = (prob - label[rows]) / len(rows)
                grads_out, dh = (h * drop).T @ dz, np.outer(dz, self.out) * drop
                ge = np.zeros_like(e)
                g_conv, g_bias = [], []
                i = np.arange(len(rows))[:, None]
                for q, (w, k) in enumerate(zip(p.widths, self.conv)):
                    best, on = cache[q]
                    d = dh[:, q * p.filters:(q + 1) * p.filters] * on
                    g_bias.append(d.sum(0))
                    gk = np.zeros_like(k)
                    for j in range(w):
                        seen = e[i, best + j]                      # rows, filters, dim
                        gk[j] = np.einsum("rfd,rf->df", seen, d)
                        np.add.at(ge, (i, best + j), d[..., None] * k[j].T[None])
                    g_conv.append(gk)
                ge *= real[..., None]
                step += 1
                for x, g, a, b2 in zip(dense, [*g_conv, *g_bias, grads_out, dz.sum(keepdims=True)], m1, m2):
                    a += 0.1 * (g - a)
                    b2 += 0.001 * (g * g - b2)
                    x -= rate * (a / (1 - 0.9 ** step)) / (np.sqrt(b2 / (1 - 0.999 ** step)) + 1e-7)
                used = np.flatnonzero(np.abs(ge).sum(-1).ravel())
                flat = ge.reshape(-1, p.dim)[used]
                for side in range(2):
                    at_rows, inv = np.unique(idx[side].ravel()[used], return_inverse=True)
                    g = np.zeros((len(at_rows), p.dim), np.float32)
                    np.add.at(g, inv, flat)
                    g2[at_rows] += (g * g).mean(1)
                    self.emb[at_rows] -= 5 * rate * g / (np.sqrt(g2[at_rows])[:, None] + 1e-7)

    # ---- scoring: each filter tap becomes a table over buckets, so a convolution is a sum of look-ups
    def tables(self) -> list[list[np.ndarray]]:
        n = 1 << self.p.buckets_log2
        return [[(self.emb @ k[j]).reshape(2, n, -1) for j in range(len(k))] for k in self.conv]

    def raw(self, word, head, doc, n_docs: int, tables) -> np.ndarray:
        """The logit of each text of a chunk, before calibration; texts without words get the bias."""
        pooled = np.zeros((n_docs, len(self.p.widths) * self.p.filters), np.float32)
        for q, (w, taps) in enumerate(zip(self.p.widths, tables)):
            span = len(word) - w + 1
            cols = slice(q * self.p.filters, (q + 1) * self.p.filters)
            if span <= 0:
                starts = np.zeros(0, np.int64)
            else:
                z = np.zeros((span, self.p.filters), np.float32)
                for j, t in enumerate(taps):
                    z += t[0][word[j:j + span]]
                    z += t[1][head[j:j + span]]
                whole = doc[:span] == doc[w - 1:]
                z, at = z[whole], doc[:span][whole]
                starts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]]) if len(at) else np.zeros(0, np.int64)
            if len(starts):
                pooled[at[starts], cols] = np.maximum(np.maximum.reduceat(z, starts, 0) + self.bias[q], 0)
        return pooled @ self.out + self.b[0]

    def score(self, logit: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * logit.astype(np.float64) + self.shift, -40, 40)))


#: calibration counts logits in steps of 1 / _STEPS up to _REACH on both sides
_STEPS, _REACH = 128, 64


def _best_cut(logit: np.ndarray, toxic: np.ndarray, n: np.ndarray) -> float:
    """The logit that parts the labels best (F1), of ``n`` rows at each distinct logit, ``toxic`` of them toxic; between
    two logits, in the middle."""
    order = np.argsort(-logit)
    hits = np.cumsum(toxic[order])
    f1 = 2 * hits / (np.cumsum(n[order]) + max(1, toxic.sum()))
    x = logit[order]
    k = int(np.argmax(f1))
    return float((x[k] + x[k + 1]) / 2 if k + 1 < len(x) else x[k] - 1)


def calibrate(model: ConvClassifier, lang: np.ndarray, logit: np.ndarray, toxic: np.ndarray, n: np.ndarray) -> dict[str, float]:
    """Sets the model's scale and shift, so that ``target`` is the cut with the best F1 over all rows, and gives
    the cut by language where it has 5 toxic rows and others. The rows come as counts by language and logit."""
    def merged(own):
        x, at = np.unique(logit[own], return_inverse=True)
        return x, np.bincount(at, toxic[own]), np.bincount(at, n[own])

    x, t, every = merged(np.ones(len(logit), bool))
    cut = _best_cut(x, t, every)
    inside = x[np.searchsorted(np.cumsum(t), t.sum() / 2)] - cut
    model.scale = float(min(8.0, 2.0 / max(inside, 1e-3))) if inside < 2 else 1.0
    target = model.p.target
    model.shift = float(np.log(target / (1 - target)) - model.scale * cut)
    by_lang = {}
    for g in sorted({g for g in lang if g is not None}):
        x, t, every = merged(lang == g)
        if t.sum() >= 5 and every.sum() > t.sum():
            by_lang[g] = float(model.score(np.array([_best_cut(x, t, every)]))[0])
    return by_lang


def train(rows: pa.Table, p: Params) -> ConvClassifier:
    """The classifier, not yet calibrated. ``rows`` has text and y. A fifth of the rows (by position) is left out of the fit."""
    model = ConvClassifier(p)
    label = rows.column("y").to_numpy().astype(np.float32)
    if not len(label) or label.min() == label.max():
        return model
    texts = rows.select(["text"]).combine_chunks().to_batches()
    words, heads, owner = [], [], []
    base = 0
    for c in text_chunks(iter(texts), max_bytes=1 << 20):
        w, h, doc = features(c, p)
        cuts = np.searchsorted(doc, np.arange(len(c) + 1))
        for d in range(len(c)):
            for at in range(int(cuts[d]), max(int(cuts[d + 1]), int(cuts[d]) + 1), p.max_words):
                to = min(at + p.max_words, int(cuts[d + 1]))
                words.append(w[at:to].astype(np.int32))
                heads.append(h[at:to].astype(np.int32))
                owner.append(base + d)
        base += len(c)
    owner = np.array(owner)
    held = owner % 5 == 4
    # of a long toxic text's pieces, which one is toxic is not known: long toxic texts are left to calibration
    pieces = np.bincount(owner, minlength=len(label))
    use = np.flatnonzero(~held & ((label[owner] == 0) | (pieces[owner] == 1)))
    model.fit([words[i] for i in use], [heads[i] for i in use], label[owner[use]])
    return model


def _labelled(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """(id, y) of the labelled training ids (crc32 of the id mod 3 is not 1)."""
    train_ids = F.pmod(F.crc32(F.col("id").cast("string")), F.lit(3)) != 1
    return (labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("y"))
            .where(F.col("y").isin(0, 1) & F.col("id").isNotNull() & train_ids).distinct())


def labelled_sample(docs: DataFrame, labels: DataFrame, p: Params, id_col: str = "doc_id", text_col: str = "text",
                    label_col: str = "toxic") -> DataFrame:
    """At most ``p.sample`` labelled rows of training ids (crc32 of the id mod 3 is not 1), in a fixed order, whose
    texts have at most ``p.sample_bytes`` bytes: the sample's size is bounded."""
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    order = F.xxhash64("id")
    picked = _labelled(labels, id_col, label_col).orderBy(order, "id", "y").limit(p.sample)
    # the sampled ids are few (bounded by p.sample), so the texts are not moved to find them
    return (src.where(F.octet_length("text") <= p.sample_bytes).join(F.broadcast(picked), "id")
            .select("text", "y", "id", F.xxhash64("id", F.lit(1)).alias("turn")))


def fit(sample: DataFrame, p: Params) -> tuple[ConvClassifier, bool]:
    """(classifier, whether labels of both kinds were there), trained by one task on the bounded sample."""
    def run(batches):
        parts = [pa.Table.from_batches([b]) for b in batches if b.num_rows]
        if parts:
            rows = pa.concat_tables(parts).sort_by([("turn", "ascending"), ("id", "ascending"), ("y", "ascending"), ("text", "ascending")])
            both = len(rows.column("y").unique()) == 2
            yield pa.record_batch({"model": pa.array([pickle.dumps((train(rows, p), both))], pa.binary())})

    got = sample.repartition(1).mapInArrow(run, "model binary").collect()
    return pickle.loads(got[0]["model"]) if got else (ConvClassifier(p), False)


def logit_counts(src: DataFrame, labelled: DataFrame, model) -> DataFrame:
    """(lang, bin, toxic, n) of all labelled rows of ``src`` (doc_id, text, lang), by logit in steps of 1 / _STEPS. The texts
    are scored where they lie; only ids and logits meet the labels."""
    def run(batches):
        m = model.value
        tables = m.tables()
        for c in text_chunks(batches, max_bytes=1 << 20):
            logit = np.clip(m.raw(*features(c, m.p), len(c), tables), -_REACH, _REACH)
            yield pa.record_batch({"id": c.rows.column("doc_id"), "lang": c.rows.column("lang"),
                                   "bin": pa.array(np.round(logit * _STEPS).astype(np.int32))})

    train_ids = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) != 1
    return (src.where(train_ids).select("doc_id", "text", "lang").mapInArrow(run, "id long, lang string, bin int")
            .join(labelled, "id").groupBy("lang", "bin").agg(F.sum("y").alias("toxic"), F.count("*").alias("n")))


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "toxic", lang_col: str | None = "lang", params: Params | None = None,
                   carry: list[str] | None = None) -> DataFrame:
    """(doc_id, held_out, score, predicted, lang_threshold, toxic_in_lang[, row]), one row per input row.

    The classifier is fitted on a bounded sample (``Params``). All labelled training rows, of any length, are then scored
    and counted by language and logit; the counts set what 0.7 means and the thresholds by language.

    Whole texts are scored in a narrow pass; only words enter the score. The
    training rows are those whose crc32(id as text) mod 3 is not 1. ``predicted`` is
    score >= 0.7. ``lang_threshold`` is the threshold calibrated for the row's
    language (0.7 where too few labels exist); ``toxic_in_lang`` compares the score with it.

    Null and empty texts get the score of no words. A null id is never held out. Without
    labels of both kinds the model is untrained and ``predicted`` is 0.
    """
    p = params or Params()
    spark = docs.sparkSession
    lang = F.col(lang_col).cast("string") if lang_col and lang_col in docs.columns else F.lit(None).cast("string")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), lang.alias("lang"))
    model, trained = fit(labelled_sample(docs, labels, p, id_col, text_col, label_col), p)
    by_lang = {}
    if trained:
        raw = spark.sparkContext.broadcast(model)
        counts = logit_counts(texts, _labelled(labels, id_col, label_col), raw).collect()
        column = lambda name, kind: np.array([r[name] for r in counts], kind)
        by_lang = calibrate(model, column("lang", object), column("bin", float) / _STEPS, column("toxic", np.int64), column("n", np.int64))
        raw.unpersist()
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        tables = model.tables()
        for c in text_chunks(batches, max_bytes=1 << 20):
            s = model.score(model.raw(*features(c, p), len(c), tables)) if trained else np.zeros(len(c))
            yield pa.record_batch({"doc_id": c.rows.column("doc_id"), "score": pa.array(s),
                                   "lang": c.rows.column("lang"), "row": c.rows.column("row")})

    more = carried(carry)
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                      lang.alias("lang"), more.alias("row"))
    kind = src.schema["row"].dataType.simpleString()
    out = src.mapInArrow(run, f"doc_id long, score double, lang string, row {kind}")
    cut = F.lit(p.target)
    for g, t in by_lang.items():
        cut = F.when(F.col("lang") == g, F.lit(t)).otherwise(cut)
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 1, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= p.target).cast("int").alias("predicted"),
                      cut.alias("lang_threshold"), (F.col("score") >= cut).alias("toxic_in_lang"), *(["row"] if carry else []))
