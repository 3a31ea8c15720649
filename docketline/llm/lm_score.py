"""Language-model scoring with a log-frequency Bloom filter of quantised n-gram counts."""

from __future__ import annotations

import math
import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketline.llm.common import (LOWER, U64, Chunk, buckets_log2, hash_spans, materialise, mix, mounted, pack_buckets,
                                   scratch, sorted_counts, text_bytes, text_chunks, word_spans)

ORDER = 3
DELTA = 0.1
#: filter bits for each (n-gram, level) pair: about one probe in a hundred of what is not there hits
BITS_PER_PAIR = 12
_BEGIN, _END = U64(0x5851F42D4C957F2D), U64(0x14057B7EF767814F)
_ORDERS = range(2, ORDER + 1)


def levels() -> np.ndarray:
    """Least count of each quantisation level: all small counts, then steps of a quarter octave."""
    out = [1]
    while out[-1] < 1 << 56:
        out.append(max(out[-1] + 1, math.ceil(out[-1] * 2 ** 0.25)))
    return np.array(out, np.int64)


LEAST = levels()
#: the count that a level stands for (level 0: unseen)
COUNT = np.r_[0.0, np.sqrt(LEAST[:-1] * (LEAST[1:] - 1.0)), float(LEAST[-1])]


class LogFrequencyFilter:
    """A Bloom filter of (n-gram, level) pairs: an n-gram with count c is put in at every level whose
    least count is at most c. Probing level 1, 2, ... up to the first miss tells the quantised count. Where counts
    below a cut-off do not occur, the levels start at ``first``, that of the cut-off.

    Each pair sets four bits of one 64-bit word. An n-gram's words lie in the slice of its bucket, so that a
    bucket of the counting shuffle fills its own slice. A slice has the size that its pairs ask for
    (``BITS_PER_PAIR`` each), so the error rate does not depend on how many there are; ``starts`` tells where each
    begins (without it, all have the same size).
    """

    def __init__(self, words: np.ndarray, log2_buckets: int, starts: np.ndarray | None = None):
        self.words, self.log2b = words, log2_buckets
        self.log2_slice = int(len(words)).bit_length() - 1 - log2_buckets
        if starts is None:
            starts = np.arange((1 << log2_buckets) + 1, dtype=np.int64) * (len(words) >> log2_buckets)
        self.starts, self.sizes = starts, np.diff(starts).astype(U64)

    @staticmethod
    def pairs(count: np.ndarray, first: int = 1) -> int:
        """The number of pairs that n-grams of these counts make."""
        return int((np.searchsorted(LEAST, count, "right") - first + 1).sum())

    @staticmethod
    def base(bucket, low: np.ndarray) -> np.ndarray:
        """What an n-gram's 32 bits contribute to its places, at any level."""
        return mix(((bucket << U64(32)) | low.astype(U64)) * U64(0x9E3779B97F4A7C15))

    @staticmethod
    def place(base: np.ndarray, level: int, size) -> tuple[np.ndarray, np.ndarray]:
        """(word in the slice of ``size`` words, four bits) of an n-gram at a level."""
        x = base + U64(level * 0xD1342543DE82EF95 & (1 << 64) - 1)
        x ^= x >> U64(32)
        x *= U64(0xD6E8FEB86659FD93)
        low = x >> U64(8)
        bits = U64(1) << (low & U64(63))
        for shift in (6, 12, 18):
            bits |= U64(1) << ((low >> U64(shift)) & U64(63))
        return ((x >> U64(32)) * size >> U64(32)).astype(np.int64), bits

    @classmethod
    def probe(cls, words: np.ndarray, base: np.ndarray, slot: np.ndarray, size: np.ndarray, first: int = 1) -> np.ndarray:
        """The level of each n-gram by its base, 0 where it is not in; its slice starts at ``slot``."""
        out, todo = np.zeros(len(base), np.int64), np.arange(len(base))
        for level in range(first, len(LEAST) + 1):
            at, bits = cls.place(base, level, size)
            hit = words[slot + at] & bits == bits
            todo, base, slot, size = todo[hit], base[hit], slot[hit], size[hit]
            if not len(todo):
                break
            out[todo] = level
        return out

    def level(self, keys: np.ndarray, where: np.ndarray | None = None, first: int = 1) -> np.ndarray:
        """The level of each 64-bit n-gram key, 0 where it is not in the filter; only ``where`` is probed."""
        out = np.zeros(len(keys), np.int64)
        todo = np.arange(len(keys)) if where is None else np.flatnonzero(where)
        bucket = keys[todo] >> U64(64 - self.log2b)
        base = self.base(bucket, (keys[todo] >> U64(32 - self.log2b)) & U64(0xFFFFFFFF))
        bucket = bucket.astype(np.int64)
        out[todo] = self.probe(self.words, base, self.starts[bucket], self.sizes[bucket], first)
        return out

    @classmethod
    def fill(cls, slice_words: np.ndarray, bucket: int, low: np.ndarray, count: np.ndarray, first: int = 1) -> None:
        top = np.searchsorted(LEAST, count, "right")
        base = cls.base(U64(bucket), low)
        for level in range(first, int(top.max(initial=0)) + 1):
            at, bits = cls.place(base[top >= level], level, U64(len(slice_words)))
            np.bitwise_or.at(slice_words, at, bits)


class MappedFilter:
    """A filter in a file that all machines see under the same path. Its words are mapped, not read: the workers of a machine
    share the pages, so a worker needs no memory of its own for them."""

    def __init__(self, path: str, log2_buckets: int, starts: np.ndarray):
        self.path, self.log2b, self.starts = path, log2_buckets, starts

    def write(self, slices) -> None:
        """Fill the file from rows (bucket, slice), one at a time; a bucket without a row stays empty."""
        os.makedirs(os.path.dirname(self.path), exist_ok=True)
        with open(self.path, "wb") as f:
            f.truncate(8 * int(self.starts[-1]))
            for r in slices:
                f.seek(8 * int(self.starts[r["bucket"]]))
                f.write(r["slice"])

    @property
    def value(self) -> LogFrequencyFilter:
        return LogFrequencyFilter(np.memmap(self.path, U64, "r").view(np.ndarray), self.log2b, self.starts)


def first_level(n: int, cutoff: int) -> int:
    """The level at which the n-grams of n words start: words are all in, longer ones from ``cutoff`` occurrences."""
    return 1 if n == 1 else int(np.searchsorted(LEAST, max(1, cutoff), "right"))


def tokens(c: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token hash, text index, cuts) of a chunk: each text's words and one end token."""
    lower = LOWER[c.data]
    starts, ends, doc = word_spans(lower, c.offs)
    n = len(c)
    cuts = np.searchsorted(doc, np.arange(1, n + 1))
    tok = np.insert(hash_spans(lower, starts, ends), cuts, _END)
    return tok, np.insert(doc, cuts, np.arange(n)), np.r_[0, cuts + np.arange(1, n + 1)]


def ngrams(tok: np.ndarray, cuts: np.ndarray) -> list[np.ndarray]:
    """Keys of the n-gram that ends at each token, for n = 1 to ORDER; begin marks stand before a text."""
    at = np.arange(len(tok))
    first = cuts[:-1][np.searchsorted(cuts, at, "right") - 1] if len(tok) else at
    out = [tok]
    for n in _ORDERS:
        key = np.full(len(tok), U64(n))
        for back in range(n - 1, -1, -1):
            inside = at - back >= first
            key = mix(key * U64(0x2545F4914F6CDD1D) + np.where(inside, tok[np.maximum(at - back, 0)], _BEGIN))
        out.append(key)
    return out


def _empty(n: int) -> np.ndarray:
    """The key of the n-gram of begin marks, the context of a text's first token."""
    if n == 1:
        return np.full(1, _BEGIN)
    key = np.full(1, U64(n))
    for _ in range(n):
        key = mix(key * U64(0x2545F4914F6CDD1D) + _BEGIN)
    return key


_COUNTED = "bucket int, words binary, counts binary, keys2 binary, n2 binary, keys3 binary, n3 binary"


def _count(log2b: int):
    """Per chunk of training texts: distinct n-grams and their counts, by bucket."""
    def emit(batches):
        for c in text_chunks(batches):
            tok, _, cuts = tokens(c)
            rows: dict[int, dict] = {}
            grams = ngrams(tok, cuts)
            # the context of a text's first token is a begin mark, or several: counted as n-grams of their own
            for n in range(1, ORDER):
                grams[n - 1] = np.concatenate([grams[n - 1], np.repeat(_empty(n), len(c))])
            for n, g in enumerate(grams, 1):
                keys, count = sorted_counts(g)
                at = 0
                for b, low in pack_buckets(keys, log2b):
                    r = rows.setdefault(b, {})
                    r[f"n{n}"] = count[at:at + len(low)].astype(np.uint32).tobytes()
                    r[f"keys{n}"] = (keys[at:at + len(low)] if n == 1 else low).tobytes()
                    at += len(low)
            cols = [("words", "keys1"), ("counts", "n1"), *[(x, x) for n in _ORDERS for x in (f"keys{n}", f"n{n}")]]
            yield pa.record_batch({"bucket": pa.array(list(rows), pa.int32()),
                                   **{o: pa.array([r.get(x, b"") for r in rows.values()], pa.binary()) for o, x in cols}})
    return emit


def _summed(t: pa.Table, keys: str, counts: str, kind) -> tuple[np.ndarray, np.ndarray]:
    k = np.frombuffer(b"".join(t.column(keys).to_pylist()), kind)
    n = np.frombuffer(b"".join(t.column(counts).to_pylist()), np.uint32).astype(np.int64)
    order = np.argsort(k, kind="stable")
    k, n = k[order], n[order]
    head = np.flatnonzero(np.r_[True, k[1:] != k[:-1]]) if len(k) else np.zeros(0, np.int64)
    return k[head], np.add.reduceat(n, head) if len(head) else n


def _reduce(log2b: int, cutoff: int):
    """A bucket's counts: exact word counts, and its slice of the filter (n-grams from ``cutoff`` occurrences),
    as large as its own pairs ask for."""
    def run(t: pa.Table) -> pa.Table:
        bucket = t.column("bucket")[0].as_py()
        words, count = _summed(t, "words", "counts", U64)
        grams = [(((words >> U64(32 - log2b)) & U64(0xFFFFFFFF)).astype(np.uint32), count, 1)]
        for n in _ORDERS:
            keys, c = _summed(t, f"keys{n}", f"n{n}", np.uint32)
            grams.append((keys[c >= cutoff], c[c >= cutoff], first_level(n, cutoff)))
        pairs = sum(LogFrequencyFilter.pairs(c, first) for _, c, first in grams)
        slice_words = np.zeros(max(16, -(-pairs * BITS_PER_PAIR // 64)), U64)
        for keys, c, first in grams:
            LogFrequencyFilter.fill(slice_words, bucket, keys, c, first)
        real = words != _BEGIN
        words, count = words[real], count[real]
        return pa.table({"bucket": pa.array([bucket], pa.int32()), "slice": pa.array([slice_words.tobytes()], pa.binary()),
                         "size": pa.array([len(slice_words)], pa.int64()),
                         "words": pa.array([words.tobytes()], pa.binary()), "counts": pa.array([count.tobytes()], pa.binary()),
                         "n": pa.array([int(count.sum())], pa.int64()), "v": pa.array([len(words)], pa.int64())})
    return run


def _unpack(batches):
    for b in batches:
        for w, c in zip(b.column("words").to_pylist(), b.column("counts").to_pylist()):
            yield pa.record_batch({"h": pa.array(np.frombuffer(w, np.int64)), "c": pa.array(np.frombuffer(c, np.int64))})


class ChunkLevels:
    """The quantised counts of a chunk's n-grams and of their contexts.

    An n-gram in the filter has parts in it, so a longer one counts only where its
    last and its first n - 1 tokens are there. The context of a token is the (n - 1)-gram before it, already probed.
    ``look(n, where)`` gives the level of the n-gram that ends at each token (``where`` it matters), ``begin(n)``
    that of n begin marks.
    """

    def __init__(self, tok: np.ndarray, cuts: np.ndarray, look, begin):
        self.tok, self.cuts, self.doc = tok, cuts, np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
        first = cuts[:-1]
        level = look(1, None)
        self.levels, self.context = {1: level}, {}
        for n in _ORDERS:
            ctx = np.empty(len(tok), np.int64)
            ctx[1:] = level[:-1]
            ctx[first] = begin(n - 1)
            # words are in the filter from one occurrence on, longer n-grams from two
            least = 2 if n == 2 else 1
            level = look(n, (ctx >= least) & (level >= least))
            self.levels[n], self.context[n] = level, ctx


def _whole_filter(filt, cutoff: int):
    """(levels, doc ids, training texts) of each chunk of texts, by the filter that a worker sees whole (mapped or broadcast)."""
    def read(batches):
        f = filt.value
        for c in text_chunks(batches, max_bytes=2 << 20):
            tok, _, cuts = tokens(c)
            grams = ngrams(tok, cuts)

            def look(n, where, grams=grams):
                if n > 1:
                    return f.level(grams[n - 1], where, first_level(n, cutoff))
                keys, inv = np.unique(grams[0], return_inverse=True)
                return f.level(keys)[inv]

            yield ChunkLevels(tok, cuts, look, lambda n: f.level(_empty(n), None, first_level(n, cutoff))[0]), c.rows.column("doc_id"), ~c.column("held_out").astype(bool)
    return read


# ---- a filter too large for a broadcast: the distinct n-grams of each chunk go to the slices, and their levels back
_CHUNK = "doc_id array<long>, held_out array<boolean>, tok binary, cuts binary"
_NAMES = [str(n) for n in range(1, ORDER + 1)]
_ASKED = ", ".join(["bucket int, chunk long", *[f"keys{n} binary" for n in _NAMES]])
_ANSWERED = ", ".join(["bucket int, chunk long", *[f"level{n} binary" for n in _NAMES]])
_LEVELLED = ", ".join([_CHUNK, *[f"level{n} binary" for n in _NAMES]])


def _tokenised(batches):
    """A row per chunk of texts: its tokens."""
    for c in text_chunks(batches):
        tok, _, cuts = tokens(c)
        whole = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
        yield pa.record_batch({"doc_id": whole(c.rows.column("doc_id")), "held_out": whole(c.rows.column("held_out")),
                               "tok": pa.array([tok.tobytes()], pa.binary()),
                               "cuts": pa.array([cuts.astype(np.int64).tobytes()], pa.binary())})


def _asked_keys(tok: np.ndarray, cuts: np.ndarray):
    """For each n: the distinct n-grams of a chunk and of begin marks, in order, and which one each token has (the
    begin marks come last)."""
    return [np.unique(np.r_[g, _empty(n)], return_inverse=True) for n, g in enumerate(ngrams(tok, cuts), 1)]


def _ask(log2b: int):
    def emit(batches):
        for b in batches:
            for chunk, tok, cuts in zip(b.column("chunk").to_pylist(), b.column("tok"), b.column("cuts")):
                rows: dict[int, dict] = {}
                for n, (keys, _) in zip(_NAMES, _asked_keys(np.frombuffer(tok.as_py(), U64), np.frombuffer(cuts.as_py(), np.int64))):
                    for bucket, low in pack_buckets(keys, log2b):
                        rows.setdefault(bucket, {})[n] = low.tobytes()
                yield pa.record_batch({"bucket": pa.array(list(rows), pa.int32()), "chunk": pa.array([chunk] * len(rows), pa.int64()),
                                       **{f"keys{n}": pa.array([r.get(n, b"") for r in rows.values()], pa.binary()) for n in _NAMES}})
    return emit


def _answer(cutoff: int):
    """The levels of the n-grams that fall in one slice."""
    def run(slices: pa.Table, asked: pa.Table) -> pa.Table:
        words = np.frombuffer(slices.column("slice")[0].as_py(), U64) if slices.num_rows else np.zeros(1, U64)
        bucket = U64(asked.column("bucket")[0].as_py()) if asked.num_rows else U64(0)
        out = {"bucket": asked.column("bucket"), "chunk": asked.column("chunk")}
        for n in _NAMES:
            parts = asked.column(f"keys{n}").to_pylist()
            low = np.frombuffer(b"".join(parts), np.uint32)
            level = LogFrequencyFilter.probe(words, LogFrequencyFilter.base(bucket, low), np.zeros(len(low), np.int64),
                                             np.full(len(low), U64(len(words))), first_level(int(n), cutoff)).astype(np.uint8)
            at = np.cumsum([0, *[len(x) // 4 for x in parts]])
            out[f"level{n}"] = pa.array([level[i:j].tobytes() for i, j in zip(at[:-1], at[1:])], pa.binary())
        return pa.table(out)
    return run


def _levelled(chunk: pa.Table, answers: pa.Table) -> pa.Table:
    """A chunk with the level of the n-gram that ends at each token; the last level is that of begin marks."""
    answers = answers.sort_by("bucket")                 # buckets are the keys' top bits, so this is the keys' order
    asked = _asked_keys(np.frombuffer(chunk.column("tok")[0].as_py(), U64), np.frombuffer(chunk.column("cuts")[0].as_py(), np.int64))
    out = chunk.drop_columns(["chunk"])
    for n, (_, inv) in zip(_NAMES, asked):
        level = np.frombuffer(b"".join(answers.column(f"level{n}").to_pylist()), np.uint8)
        out = out.append_column(f"level{n}", pa.array([level[inv].tobytes()], pa.binary()))
    return out


def _by_slices(batches):
    """As ``_whole_filter`` gives, from chunks with levels."""
    for b in batches:
        for k in range(b.num_rows):
            read = lambda c, kind: np.frombuffer(b.column(c)[k].as_py(), kind)  # noqa: B023, E731
            level = {int(n): read(f"level{n}", np.uint8).astype(np.int64) for n in _NAMES}
            yield (ChunkLevels(read("tok", U64), read("cuts", np.int64),
                               lambda n, where, lv=level: lv[n][:-1] if where is None else np.where(where, lv[n][:-1], 0),
                               lambda n, lv=level: lv[n][-1]),
                   b.column("doc_id")[k].values, ~b.column("held_out")[k].values.to_numpy(zero_copy_only=False))


def _probed(read, shared):
    """One pass over all texts: a row per text with its exact base over the words of the broadcast table, the other words
    with their counts, and ``lv``: by order, the level of the begin marks and of the n-gram that ends at each token, a byte each."""
    def run(batches):
        words, counts = shared.value
        for x, doc_id, train in read(batches):
            doc, cuts, n_docs = x.doc, x.cuts, len(x.cuts) - 1
            keys, inv = np.unique(x.tok, return_inverse=True)
            i = np.searchsorted(words, keys)
            i[i == len(words)] = 0
            common = (words[i] == keys) if len(words) else np.zeros(len(keys), bool)
            exact = np.where(common, np.log10((counts[i] if len(words) else 0) + DELTA), 0.0)
            known = common[inv]
            base = np.bincount(doc, weights=exact[inv], minlength=n_docs)
            rare = np.flatnonzero(~known)
            pairs = np.stack([doc[rare], inv[rare]], 1)
            pairs, tf = np.unique(pairs, axis=0, return_counts=True) if len(rare) else (pairs, np.zeros(0, np.int64))
            at = np.searchsorted(pairs[:, 0], np.arange(n_docs + 1))
            h = pa.array(keys[pairs[:, 1]].view(np.int64))
            lists = lambda v, t: pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), v.cast(t))
            size = np.diff(cuts)
            offs = np.r_[0, np.cumsum(ORDER * (size + 1))]
            place = offs[doc] + 1 + np.arange(len(doc)) - cuts[:-1][doc]
            lv = np.zeros(int(offs[-1]), np.uint8)
            for n in range(1, ORDER + 1):
                lv[place + (n - 1) * (size + 1)[doc]] = x.levels[n]
                if n < ORDER:                               # the context of a text's first token
                    lv[offs[:-1] + (n - 1) * (size + 1)] = x.context[n + 1][cuts[:-1]]
            yield pa.record_batch({
                "doc_id": doc_id, "held_out": pa.array(~train), "n_tokens": pa.array(size.astype(np.int64)),
                "n_common": pa.array(np.bincount(doc, weights=known, minlength=n_docs).astype(np.int64)),
                "base": pa.array(base), "rare": lists(h, pa.int64()), "tf": lists(pa.array(tf), pa.int64()),
                "lv": pa.Array.from_buffers(pa.binary(), n_docs, [None, pa.py_buffer(offs.astype(np.int32)), pa.py_buffer(lv)])})
    return run


def _stored_levels(batches):
    """(rows, text index of each token, levels and contexts by order) of some stored texts at a time."""
    for c in text_chunks(batches, col="lv"):
        size = np.diff(c.offs) // ORDER - 1
        cuts = np.r_[0, np.cumsum(size)]
        doc = np.repeat(np.arange(len(c)), size)
        place = c.offs[:-1][doc] + 1 + np.arange(len(doc)) - cuts[:-1][doc]
        step = (size + 1)[doc]
        level = {n: c.data[place + (n - 1) * step] for n in range(1, ORDER + 1)}
        yield c.rows, doc, level, {n: c.data[place - 1 + (n - 2) * step] for n in _ORDERS}


def _seen(batches):
    """How often a context's continuation occurs elsewhere too, by order and level of the context; over training texts."""
    total = np.zeros((ORDER + 1, len(COUNT)), np.int64)
    seen = np.zeros_like(total)
    for rows, doc, level, context in _stored_levels(batches):
        own = ~rows.column("held_out").to_numpy(zero_copy_only=False).astype(bool)[doc]
        for n in _ORDERS:
            total[n] += np.bincount(context[n][own], minlength=len(COUNT))
            seen[n] += np.bincount(context[n][own & (level[n] > 0)], minlength=len(COUNT))
    n, lv = np.nonzero(total)
    yield pa.record_batch({"n": pa.array(n), "level": pa.array(lv), "total": pa.array(total[n, lv]), "seen": pa.array(seen[n, lv])})


def _score(weight: np.ndarray, norm: float):
    """The model's score from stored levels: orders interpolated by how often contexts of a level go on as seen."""
    def run(batches):
        for rows, doc, level, context in _stored_levels(batches):
            n_docs = rows.num_rows
            p = (COUNT[level[1]] + DELTA) / norm
            per_order = [np.bincount(doc, weights=np.log10(p), minlength=n_docs)]
            for n in _ORDERS:
                lv = context[n]
                share = np.minimum(COUNT[level[n]] / np.maximum(COUNT[lv], 1), 1.0)
                w = weight[n][lv]
                p = w * share + (1 - w) * p
                per_order.append(np.bincount(doc, weights=np.log10(p), minlength=n_docs))
            # each order explains a text as a whole, with equal prior weight
            top = np.max(per_order, axis=0)
            score = top + np.log10(sum(10 ** (x - top) for x in per_order) / len(per_order))
            yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in ("row", "doc_id", "n_tokens", "n_common", "base")),
                                              pa.array(score.astype(np.float64))], names=["row", "doc_id", "n_tokens", "n_common", "base", "score"])
    return run


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 10, held_fold: int = 0,
                cutoff: int = 2, table_words: int = 1 << 19, broadcast_bytes: int = 128 << 20, mapped: int = 32) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), one row per input row.

    Texts whose crc32(id as text) mod ``folds`` is ``held_fold`` are held out; the
    others train. ``base_score`` is the add-0.1 unigram log10 probability from exact counts;
    ``score`` is the model's.

    1. Counting: distinct n-grams of each chunk, dealt by hash; a bucket sums exact word counts, and fills
       its slice of the filter with all words and with n-grams of at least ``cutoff`` occurrences (as count
       cut-offs do; cut ones fall back to the shorter n-gram).
    2. One narrow pass over all texts probes every n-gram once and writes the levels found, a byte each. The words from a
       count on, at most ``table_words``, are broadcast with exact counts; the others of a text are joined with the counts by hash.
    3. The levels of the training texts give each context level the weight of its continuations, and with these weights
       the levels of all texts give the scores.

    The filter grows with the distinct (n-gram, level) pairs counted, ``BITS_PER_PAIR`` each, so its error rate does not
    depend on the input. Where the shared folder is mounted on every machine, it is a file there that the workers map, up to
    ``mapped`` times ``broadcast_bytes``; elsewhere it is broadcast, a copy for each worker, up to ``broadcast_bytes``. A larger one
    stays in its slices, a bucket of the counting shuffle each: the distinct n-grams of each chunk are dealt to them and
    the levels come back. All ways give the same result.
    Null and empty texts are the end token alone. Null ids count as training. An empty table gives
    no rows; without training texts all counts are 0.
    """
    spark = docs.sparkSession
    sc = spark.sparkContext
    doc = F.col(id_col).cast("long")
    src = docs.select(doc.alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"),
                      F.coalesce(F.pmod(F.crc32(doc.cast("string")), F.lit(folds)) == held_fold, F.lit(False)).alias("held_out"))
    train = src.where(~F.col("held_out")).select("text")
    total = text_bytes(src)
    log2b = min(buckets_log2(total), 14)

    counted = materialise(train.mapInArrow(_count(log2b), _COUNTED).groupBy("bucket").applyInArrow(
        _reduce(log2b, cutoff), "bucket int, slice binary, size long, words binary, counts binary, n long, v long"), "counts")
    sizes = np.ones(1 << log2b, np.int64)                # a bucket without n-grams has an empty word
    n_total = n_words = 0
    for r in counted.select("bucket", "size", "n", "v").collect():
        sizes[r["bucket"]] = r["size"]
        n_total, n_words = n_total + r["n"], n_words + r["v"]
    slices = counted.select("bucket", "slice")
    rows = src.select("doc_id", "held_out", "text")
    starts, file = np.r_[0, np.cumsum(sizes)], mounted(spark, scratch(spark, "filter"))
    if file and 8 * int(starts[-1]) <= mapped * broadcast_bytes:
        filt = MappedFilter(file, log2b, starts)
        filt.write(slices.toLocalIterator())
        read = _whole_filter(filt, cutoff)
    elif 8 * int(starts[-1]) <= broadcast_bytes:
        file, words = None, np.zeros(starts[-1], U64)
        for r in slices.toLocalIterator():
            words[starts[r["bucket"]]:starts[r["bucket"] + 1]] = np.frombuffer(r["slice"], U64)
        read = _whole_filter(sc.broadcast(LogFrequencyFilter(words, log2b, starts)), cutoff)
    else:
        file = None
        chunks = materialise(rows.mapInArrow(_tokenised, _CHUNK).withColumn("chunk", F.monotonically_increasing_id()), "chunks")
        asked = chunks.select("chunk", "tok", "cuts").mapInArrow(_ask(log2b), _ASKED)
        answers = slices.groupBy("bucket").cogroup(asked.groupBy("bucket")).applyInArrow(_answer(cutoff), _ANSWERED)
        rows = materialise(chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_levelled, _LEVELLED), "levels")
        read = _by_slices

    exact = counted.select("words", "counts").mapInArrow(_unpack, "h long, c long")
    cut = _table_cut(exact, table_words)
    common = np.array([(r["h"], r["c"]) for r in exact.where(_octave() >= cut).toLocalIterator()], np.int64).reshape(-1, 2)
    keys = common[:, 0].copy().view(U64)
    order = np.argsort(keys)
    shared = sc.broadcast((keys[order], common[order, 1]))
    scored = materialise(rows.mapInArrow(
        _probed(read, shared), "doc_id long, held_out boolean, n_tokens long, n_common long, base double, rare array<long>, tf array<long>, lv binary")
        .withColumn("row", F.monotonically_increasing_id()), "probed")
    if file:
        os.unlink(file)                                  # all levels are written

    weight = np.zeros((ORDER + 1, len(COUNT)))
    for r in (scored.select("held_out", "lv").mapInArrow(_seen, "n long, level long, total long, seen long")
              .groupBy("n", "level").agg(F.sum("total").alias("total"), F.sum("seen").alias("seen")).collect()):
        weight[r["n"], r["level"]] = 0.0 if r["level"] == 0 else min(0.999, r["seen"] / (r["total"] + 1))
    rest = (scored.select("row", F.explode(F.arrays_zip("rare", "tf")).alias("x")).select("row", F.col("x.rare").alias("h"), F.col("x.tf").alias("tf"))
            .join(exact.where(_octave() < cut), "h", "left").withColumn("c", F.coalesce("c", F.lit(0)))
            .groupBy("row").agg(F.sum(F.col("tf") * F.log10(F.col("c") + DELTA)).alias("more"),
                                F.sum(F.when(F.col("c") > 0, F.col("tf")).otherwise(0)).alias("n_more")))
    norm = math.log10(n_total + DELTA * (n_words + 1))
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(folds)) == held_fold, F.lit(False))
    model = scored.select("row", "doc_id", "n_tokens", "n_common", "base", "lv").mapInArrow(
        _score(weight, n_total + DELTA * (n_words + 1)), "row long, doc_id long, n_tokens long, n_common long, base double, score double")
    return (model.join(rest, "row", "left")
            .select("doc_id", held.alias("held_out"), "n_tokens",
                    (F.col("n_common") + F.coalesce("n_more", F.lit(0))).alias("n_known"),
                    F.lit(n_total).cast("long").alias("train_tokens"),
                    (F.col("base") + F.coalesce("more", F.lit(0.0)) - F.col("n_tokens") * F.lit(norm)).alias("base_score"), "score"))


def _octave():
    return F.floor(F.log2(F.col("c")) * 4)


def _table_cut(exact: DataFrame, table_words: int) -> int:
    """The first quarter octave of counts from which at most ``table_words`` words remain, over all words."""
    counts = {r["o"]: r["n"] for r in exact.groupBy(_octave().alias("o")).agg(F.count("*").alias("n")).collect()}
    room, cut = table_words, 1 << 20
    for o in sorted(counts, reverse=True):
        room -= counts[o]
        if room < 0:
            break
        cut = o
    return cut
