"""Benchmark decontamination with a generalised suffix automaton of item words."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketline.llm.common import LOWER, U64, Chunk, carried, hash_spans, text_bytes, text_chunks, word_spans

#: words are runs of 0-9, a-z (after lowering A-Z) and bytes of non-ASCII characters
GAP = np.ones(256, bool)
GAP[48:58] = GAP[97:123] = GAP[128:256] = False


class SuffixAutomaton:
    """All factors of a set of word sequences, with the items each window occurs in.

    A state stands for factors with the same ends; ``link`` leads to its longest
    proper suffix with more ends. ``step`` keeps the longest suffix of the text
    read so far that is a factor of some item.
    """

    def __init__(self, items: list[tuple[str, list[int]]], window: int):
        self.window, self.next, self.link, self.len = window, [{}], [-1], [0]
        ends = []
        for _, words in items:
            last = 0
            for w in words:
                last = self._extend(last, w)
            ends.append(last)
        n = len(self.len)
        self.own: list[list[str]] = [[] for _ in range(n)]      # items in which the state's window occurs
        self.short: list[list[tuple[int, int]]] = [[] for _ in range(n)]  # whole short items that end here
        seen = [-1] * n
        self.names = [name for name, _ in items]
        for k, (_, words) in enumerate(items):
            v = 0
            for w in words:
                v = self.next[v][w]
                u = v
                while u > 0 and seen[u] != k and self.len[u] >= window:
                    seen[u] = k
                    if self.len[self.link[u]] < window:
                        self.own[u].append(k)
                    u = self.link[u]
            if 0 < len(words) < window:
                u = ends[k]
                while self.len[self.link[u]] >= len(words):
                    u = self.link[u]
                self.short[u].append((len(words), k))
        # the ancestor that holds the suffix of `window` words; the nearest state with short items
        self.at, self.up = [0] * n, [0] * n
        for v in sorted(range(1, n), key=self.len.__getitem__):
            p = self.link[v]
            self.at[v] = v if self.len[p] < window <= self.len[v] else self.at[p]
            self.up[v] = v if self.short[v] else self.up[p]

    def _extend(self, last: int, w: int) -> int:
        if w in self.next[last]:
            q = self.next[last][w]
            return q if self.len[q] == self.len[last] + 1 else self._clone(last, w, q)
        cur = self._state(self.len[last] + 1, {})
        p = last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = cur
            p = self.link[p]
        if p < 0:
            self.link[cur] = 0
        else:
            q = self.next[p][w]
            self.link[cur] = q if self.len[q] == self.len[p] + 1 else self._clone(p, w, q)
        return cur

    def _state(self, length: int, out: dict) -> int:
        self.next.append(out)
        self.link.append(-1)
        self.len.append(length)
        return len(self.len) - 1

    def _clone(self, p: int, w: int, q: int) -> int:
        c = self._state(self.len[p] + 1, dict(self.next[q]))
        self.link[c], self.link[q] = self.link[q], c
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = c
            p = self.link[p]
        return c

    def scan(self, words: list[int]) -> tuple[list[tuple[int, int]], set[int]]:
        """Covered word ranges (merged) and the items whose windows occur."""
        nxt, link, length = self.next, self.link, self.len
        spans: list[tuple[int, int]] = []
        found: set[int] = set()
        v = run = 0
        for i, w in enumerate(words):
            while v and w not in nxt[v]:
                v = link[v]
                run = length[v]
            if w not in nxt[v]:
                run = 0
                continue
            v, run = nxt[v][w], run + 1
            back = 0
            if run >= self.window:
                back = self.window
                found.update(self.own[self.at[v]])
            u = self.up[v]
            while u:
                for m, k in self.short[u]:
                    if m <= run:
                        found.add(k)
                        back = max(back, m)
                u = self.up[link[u]]
            if back:
                a = i + 1 - back
                while spans and spans[-1][1] >= a:
                    a = min(a, spans.pop()[0])
                spans.append((a, i + 1))
        return spans, found


class Matcher:
    """An automaton with the tables that skip text which cannot match: item words,
    and pairs of adjacent item words, by 64-bit hash."""

    def __init__(self, items: list[tuple[str, str | None]], window: int):
        chunk_words = [self._words((text or "").encode()) for _, text in items]
        self.vocab = np.unique(np.concatenate([np.zeros(0, U64), *chunk_words]))
        seqs = [np.searchsorted(self.vocab, w) for w in chunk_words]
        pairs = [a[:-1] * len(self.vocab) + a[1:] for a in seqs if len(a) > 1]
        self.pairs = np.unique(np.concatenate([np.zeros(0, np.int64), *pairs]))
        self.shortest = min([window, *(len(s) for s in seqs if len(s))])
        self.hint = np.zeros(1 << 20, bool)
        self.hint[(self.vocab >> U64(44)).astype(np.int64)] = True
        self.automaton = SuffixAutomaton([(n, s.tolist()) for (n, _), s in zip(items, seqs) if len(s)], window)

    @staticmethod
    def _words(raw: bytes) -> np.ndarray:
        data = LOWER[np.frombuffer(raw + bytes(8), np.uint8)]
        starts, ends, _ = word_spans(data, np.array([0, len(raw)]), GAP)
        return hash_spans(data, starts, ends)

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """Word numbers, -1 where no item has the word."""
        out = np.full(len(hashes), -1, np.int64)
        maybe = np.flatnonzero(self.hint[(hashes >> U64(44)).astype(np.int64)])
        i = np.searchsorted(self.vocab, hashes[maybe])
        i[i == len(self.vocab)] = 0
        out[maybe] = np.where(self.vocab[i] == hashes[maybe], i, -1) if len(self.vocab) else -1
        return out

    def stretches(self, ids: np.ndarray, doc: np.ndarray) -> list[tuple[int, int]]:
        """Maximal stretches of one text whose words, and adjacent pairs, all occur in items."""
        if not len(ids) or not len(self.vocab):
            return []
        good = ids >= 0
        pair = good[:-1] & good[1:] & (doc[:-1] == doc[1:])
        at = np.flatnonzero(pair)
        code = ids[at] * len(self.vocab) + ids[at + 1]
        i = np.searchsorted(self.pairs, code)
        i[i == len(self.pairs)] = 0
        pair[at] = (self.pairs[i] == code) if len(self.pairs) else False
        joined = np.r_[False, pair]
        start = np.flatnonzero(good & ~joined)
        end = np.flatnonzero(good & ~np.r_[pair, False]) + 1
        long = end - start >= self.shortest
        return list(zip(start[long].tolist(), end[long].tolist()))


def _pass(matcher, last: bool, min_words: int, drop_share: float):
    """Adds one block's hits; after the last block, cuts the texts."""
    def scan(batches):
        m: Matcher = matcher.value
        for c in text_chunks(batches):
            lower = LOWER[c.data]
            starts, ends, doc = word_spans(lower, c.offs, GAP)
            ids = m.ids(hash_spans(lower, starts, ends))
            first = np.searchsorted(doc, np.arange(len(c) + 1))
            old_spans, old_items = c.rows.column("spans").to_pylist(), c.rows.column("items").to_pylist()
            spans: dict[int, list] = {d: list(np.frombuffer(x, np.int64).reshape(-1, 2)) for d, x in enumerate(old_spans) if x}
            items = {d: set(x) for d, x in enumerate(old_items) if x}
            for a, b in m.stretches(ids, doc):
                got, found = m.automaton.scan(ids[a:b].tolist())
                if got:
                    d = int(doc[a])
                    spans.setdefault(d, []).extend(np.array(got) + (a - first[d]))
                    items.setdefault(d, set()).update(m.automaton.names[k] for k in found)
            merged = {d: _merge(x) for d, x in spans.items()}
            cols = {"doc_id": c.rows.column("doc_id"), "text": c.rows.column("text"),
                    "spans": pa.array([merged[d].tobytes() if d in merged else None for d in range(len(c))], pa.binary()),
                    "items": pa.array([sorted(items[d]) if d in items else [] for d in range(len(c))], pa.list_(pa.string())),
                    "row": c.rows.column("row")}
            if last:
                cols |= _finish(c, cols, merged, starts, ends, first, min_words, drop_share)
                del cols["spans"]
            yield pa.record_batch(cols)
    return scan


def _merge(spans: list) -> np.ndarray:
    """Union of word ranges, in order; ranges that touch become one."""
    s = np.array(spans, np.int64)
    s = s[np.argsort(s[:, 0], kind="stable")]
    high = np.maximum.accumulate(s[:, 1])
    new = np.flatnonzero(np.r_[True, s[1:, 0] > high[:-1]])
    return np.stack([s[new, 0], high[np.r_[new[1:] - 1, len(s) - 1]]], 1)


def _finish(c: Chunk, cols, merged, starts, ends, first, min_words, drop_share) -> dict:
    n_words = np.diff(first)
    n_hit, clean, keep, cut = np.zeros(len(c), np.int64), [], np.ones(len(c), bool), []
    for d in range(len(c)):
        raw = c.data[c.offs[d]:c.offs[d + 1]]
        if d in merged:
            n_hit[d] = (merged[d][:, 1] - merged[d][:, 0]).sum()
            keep[d] = n_hit[d] < drop_share * n_words[d]
            stay = np.ones(len(raw), bool)
            for a, b in merged[d]:
                if b - a >= min_words:
                    stay[starts[first[d] + a] - c.offs[d]:ends[first[d] + b - 1] - c.offs[d]] = False
            cut.append(int((~stay).sum()))
            raw = raw[stay]
        else:
            cut.append(0)
        clean.append(raw.tobytes())
    words = [merged[d].tolist() if d in merged else [] for d in range(len(c))]
    return {"text": pa.array(clean, pa.binary()).cast(pa.string()), "n_words": pa.array(n_words.astype(np.int64)),
            "n_hit": pa.array(n_hit), "hit_spans": pa.array(words, pa.list_(pa.list_(pa.int64()))),
            "n_cut": pa.array(cut, pa.int64()), "keep": pa.array(keep)}


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text", window: int = 10, min_words: int = 1,
                  drop_share: float = 0.5, block_bytes: int = 8 << 20, carry: list[str] | None = None) -> DataFrame:
    """(doc_id, text, items, n_words, n_hit, hit_spans, n_cut, keep[, row]), one row per input row.

    A document word is hit when a window of ``window`` consecutive item words
    (or a whole shorter item) covers it. ``items`` are the ids, as strings, of
    the items with occurring windows; ``hit_spans`` the word ranges; ``text`` the text
    without the hit ranges of at least ``min_words`` words; ``keep`` is false
    where hits cover ``drop_share`` of the words or more.

    Items go in blocks of about ``block_bytes`` of text, each an automaton that
    is broadcast (its size is bounded by the block); every block reads all
    documents in one narrow pass, without a shuffle. Texts without a stretch of
    item word pairs are skipped by array look-ups; only such stretches walk the automaton.

    Null texts have no words; null or empty items have no windows; a null item id
    is listed as "null"; equal items are each listed. Empty tables give no rows or no hits.
    """
    total = text_bytes(items, item_text)
    blocks = -(-max(1, total) // block_bytes)
    picked = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("id"), F.col(item_text).alias("t"))
    sc = docs.sparkSession.sparkContext
    more = carried(carry)
    out = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                      F.lit(None).cast("binary").alias("spans"), F.lit(None).cast("array<string>").alias("items"),
                      more.alias("row"))
    kind = out.schema["row"].dataType.simpleString()
    for b in range(blocks):
        part = picked.where(F.pmod(F.xxhash64("id", "t"), F.lit(blocks)) == b)
        matcher = sc.broadcast(Matcher([(r["id"], r["t"]) for r in part.collect()], window))
        last = b == blocks - 1
        schema = f"doc_id long, text string, {'' if last else 'spans binary, '}items array<string>, row {kind}"
        if last:
            schema += ", n_words long, n_hit long, hit_spans array<array<long>>, n_cut long, keep boolean"
        out = out.mapInArrow(_pass(matcher, last, min_words, drop_share), schema)
    return out.select("doc_id", "text", "items", "n_words", "n_hit", "hit_spans", "n_cut", "keep", *(["row"] if carry else []))
