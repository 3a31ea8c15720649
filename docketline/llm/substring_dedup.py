"""Substring dedup: MinHash bands of passages, exact Jaccard, removal by components."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docketline.llm.common import (_C3, LOWER, U64, Chunk, hash_spans, keyed, listed_keys, materialise, mix,
                                   repeated_kinds, text_bytes, text_chunks, word_spans)
from docketline.llm.jaccard_join import links, plain_entries
from docketline.llm.suffix_dedup import _LAST, _cut

_TOP = U64((1 << 64) - 1)


def tune_bands(similarity: float, recall: float, rows: int = 2) -> int:
    """The least number of bands of ``rows`` minima by which a pair of that similarity collides with
    probability ``recall`` or more: 1 - (1 - s**rows)**bands."""
    miss = 1 - similarity ** rows
    bands = 1
    while 1 - miss ** bands < recall:
        bands += 1
    return bands


def _factors(n: int) -> np.ndarray:
    """Odd 64-bit factors without a pattern."""
    return mix(np.arange(1, n + 1, dtype=U64) * _C3) | U64(1)


class Cuts:
    """A chunk's words and where its texts are cut into pieces.

    Pieces run over line breaks, cut at words whose pair hash is the least within ``reach`` words. Such cuts depend on
    the near words only, so a passage repeated within other text is cut alike; they are more than ``reach`` words
    apart, so only a text's first and last piece can be shorter.
    """

    def __init__(self, c: Chunk, reach: int):
        lower = LOWER[c.data]
        self.starts, ends, doc = word_spans(lower, c.offs)
        h = hash_spans(lower, self.starts, ends)
        n = len(h)
        pair = mix(h * U64(3) + np.r_[h[1:], U64(0)][:n]) if n else h
        pair[np.flatnonzero(np.r_[doc[1:] != doc[:-1], True][:n])] = _TOP
        at = np.arange(n) + (doc + 1) * reach                  # texts stand apart, so that none sees its neighbour
        room = np.full(n + (len(c) + 1) * reach + 1, _TOP)
        room[at] = pair
        least = room                                           # of the next ``have`` places
        have = 1
        while have < reach:
            step = min(have, reach - have)
            least = np.minimum(least[:-step], least[step:])
            have += step
        left, right = least[at - reach], least[at + 1]
        self.text = np.r_[True, doc[1:] != doc[:-1]][:n]       # words that begin a text, and those that begin a piece
        self.cut = self.text | ((pair < left) & (pair <= right) & (pair < _TOP))
        self.words, self.doc, self.reach = h, doc, reach
        self.piece_at = np.r_[np.flatnonzero(self.cut), n]
        self.text_at = np.searchsorted(doc, np.arange(len(c) + 1))

    def around(self, text: int, number: int, size: int) -> tuple[bytes, bytes]:
        """The words before (nearest first) and after a piece of a text, as 32 bits each, so far as a repeat can go on
        without the next piece being equal too: to the next cut and the words that it depends on."""
        a = int(self.text_at[text]) + number
        b = a + size
        reach = self.reach + 2
        p, q = np.searchsorted(self.piece_at, [a, b])
        low = max(int(self.text_at[text]), int(self.piece_at[max(p - 1, 0)]) - reach)
        high = min(int(self.text_at[text + 1]), int(self.piece_at[min(q + 1, len(self.piece_at) - 1)]) + reach)
        short = lambda x: (x >> U64(32)).astype(np.uint32).tobytes()
        return short(self.words[low:a][::-1]), short(self.words[b:high])


class Passages(Cuts):
    """A chunk's units: paragraphs, and pieces for repeats inside them.

    A paragraph is a block of lines between blank lines; in a text without blank lines, each line. Units under
    ``least_words`` words are left out.
    """

    def __init__(self, c: Chunk, reach: int, least_words: int, k: int = 5):
        super().__init__(c, reach)
        h, doc, text = self.words, self.doc, self.text
        n = len(h)
        line = np.searchsorted(np.flatnonzero(c.data[:int(c.offs[-1])] == 10), self.starts)
        breaks = np.where(text, 0, np.r_[0, line[1:] - line[:-1]][:n])
        blank = np.bincount(doc[breaks > 1], minlength=len(c)) > 0
        self.k = k
        m = max(0, n - k + 1)
        self.shingles = np.full(m, U64(k))                     # that start at each word; a unit's are those that end in it
        for j, f in enumerate(_factors(k)):
            self.shingles += h[j:j + m] * f                    # words are hashes, so a sum with other factors tells their order
        self.shingles = mix(self.shingles)
        first, last, content = [], [], []
        for kind, new in enumerate((self.cut, text | (breaks > np.where(blank, 1, 0)[doc]))):
            a = np.flatnonzero(new)
            b = np.r_[a[1:], n][:len(a)]
            # equal word sequences have equal content keys
            place = (np.arange(n) - np.repeat(a, b - a))[:m].astype(U64)
            terms = mix(self.shingles * U64(0x9E3779B97F4A7C15) + place)
            use = b - a >= max(least_words, k)
            a, b = a[use], b[use]
            first.append(a), last.append(b)
            content.append(mix(self._over(np.add, terms, a, b) + U64(kind)))
        self.n_pieces = len(first[0])
        self.first, self.last, self.content = np.concatenate(first), np.concatenate(last), np.concatenate(content)
        self.owner, self.size = doc[self.first], self.last - self.first
        self.number = self.first - self.text_at[self.owner]    # the unit's first word within its text

    def _over(self, fold, values: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``values``, one per shingle, folded over each unit's shingles."""
        if not len(a):
            return np.zeros(0, U64)
        return fold.reduceat(np.r_[values, U64(0)], np.stack([a, b - self.k + 1], 1).ravel())[::2]

    def band_keys(self, bands: int, rows: int) -> np.ndarray:
        """One key per paragraph and band, from ``rows`` minima each of the shingles, permuted by odd factors."""
        a, b = self.first[self.n_pieces:], self.last[self.n_pieces:]
        out = np.empty((len(a), bands), U64)
        at = np.stack([a, b - self.k + 1], 1).ravel()
        room = np.r_[self.shingles, U64(0)]
        held = np.empty_like(room)
        for band, factors in enumerate(_factors(bands * rows).reshape(bands, rows)):
            key = np.full(len(a), U64(band))
            for f in factors:
                if len(key):
                    least = np.minimum.reduceat(np.multiply(room, f, out=held), at)[::2]
                    key = mix(key * U64(0x2545F4914F6CDD1D) + least)
            out[:, band] = key
        return out


_UNITS = ("kid long, kth long, oid long, number int, words int, piece boolean, content long, n int, "
          "hs array<long>, bins array<int>, bands array<long>")


def _units(same, near, p: dict):
    """The units that repeat, and the paragraphs that have a band key that another one has too; the latter with their
    shingles and such keys, once per distinct paragraph of a chunk."""
    def emit(batches):
        equal, seen = same.value, near.value
        for c in text_chunks(batches):
            u = Passages(c, p["reach"], p["least_words"], p["k"])
            keys = u.band_keys(p["bands"], p["rows"])
            hit = seen.has(keys.ravel()).reshape(keys.shape)
            meets = np.r_[np.zeros(u.n_pieces, bool), hit.any(1)]
            rows = np.flatnonzero(meets | equal.has(u.content))
            lead = np.flatnonzero(meets)
            lead = lead[np.unique(u.content[lead], return_index=True)[1]]
            sets = [np.unique(u.shingles[u.first[i]:u.last[i] - u.k + 1]) for i in lead]
            slot = np.full(len(u.content), -1)
            slot[lead] = np.arange(len(lead))
            slot = pa.array(slot[rows], mask=slot[rows] < 0)
            with_sets = {                                      # null but for the leading rows
                "n": pa.array([len(s) for s in sets], pa.int32()),
                "hs": pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                "bins": pa.array([np.bincount((s >> U64(59)).astype(np.int64), minlength=32) for s in sets], pa.list_(pa.int32())),
                "bands": pa.array([np.unique(keys[i][hit[i]]).view(np.int64) for i in lead - u.n_pieces], pa.list_(pa.int64()))}
            own = u.owner[rows]
            i32 = lambda x: pa.array(x[rows].astype(np.int32))  # noqa: B023, E731
            yield pa.record_batch({
                **{x: pa.array(c.column(x)[own]) for x in ("kid", "kth", "oid")}, "number": i32(u.number), "words": i32(u.size),
                "piece": pa.array(rows < u.n_pieces), "content": pa.array(u.content[rows].view(np.int64)),
                **{name: x.take(slot) for name, x in with_sets.items()}})
    return emit


_CONTEXT = "kid long, kth long, content long, number int, words int, source long, before binary, after binary"


def _contexts(reach: int):
    """The words around the pieces listed in ``places``, per text."""
    def emit(batches):
        for c in text_chunks(batches):
            u = Cuts(c, reach)
            rows, around, places = [], [], c.rows.column("places").to_pylist()
            for i, listed in enumerate(places):
                for x in listed:
                    rows.append(i), around.append(u.around(i, x["number"], x["words"]))
            flat = [x for listed in places for x in listed]
            col = lambda name, kind: pa.array([x[name] for x in flat], kind)  # noqa: B023, E731
            yield pa.record_batch({
                **{x: c.rows.column(x).take(pa.array(rows, pa.int64())) for x in ("kid", "kth")},
                "content": col("content", pa.int64()), "number": col("number", pa.int32()), "words": col("words", pa.int32()),
                "source": col("source", pa.int64()), "before": pa.array([x for x, _ in around], pa.binary()),
                "after": pa.array([x for _, x in around], pa.binary())})
    return emit


def _alike(x: bytes, y: bytes) -> int:
    """How many words two rows of words have in common at their beginning."""
    n = min(len(x), len(y)) // 4
    differ = np.flatnonzero(np.frombuffer(x, np.uint32, n) != np.frombuffer(y, np.uint32, n))
    return int(differ[0]) if len(differ) else n


def _extended(batches):
    """Units as intervals of words, pieces extended word by word while the source goes on alike."""
    for b in batches:
        col = lambda name: b.column(name).to_pylist()  # noqa: B023, E731
        left = np.array([_alike(x, y) for x, y in zip(col("before"), col("before0"))], np.int32)
        right = np.array([_alike(x, y) for x, y in zip(col("after"), col("after0"))], np.int32)
        low = b.column("number").to_numpy()
        yield pa.record_batch({"kid": b.column("kid"), "kth": b.column("kth"), "low": pa.array(low - left),
                               "high": pa.array(low + b.column("words").to_numpy() + right), "source": b.column("source"), "comp": b.column("content")})


def _runs(min_words: int, gap: int):
    """Per document: repeated units that touch make a run, also over less than ``gap`` words between two of one source;
    runs with enough repeated words become spans of words."""
    def emit(batches):
        for b in batches:
            spans, sources, comps = [], [], []
            for units in b.column("units").to_pylist():
                runs = []                                       # [low, high, repeated words, units]
                for x in sorted(units, key=lambda x: (x["low"], x["high"])):
                    last = runs[-1] if runs else None
                    if last and (x["low"] <= last[1] or (x["low"] < last[1] + gap and x["source"] in last[3])):
                        last[2] += max(0, x["high"] - max(x["low"], last[1]))
                        last[1] = max(last[1], x["high"])
                    else:
                        last = [x["low"], x["high"], x["high"] - x["low"], set(), set()]
                        runs.append(last)
                    last[3].add(x["source"]), last[4].add(x["comp"])
                runs = [r for r in runs if r[2] >= min_words]
                spans.append([np.array([r[:2] for r in runs], np.int32).tobytes()] if runs else [])
                sources.append(sorted(set().union(*[r[3] for r in runs])))
                comps.append(sorted(set().union(*[r[4] for r in runs])))
            yield pa.record_batch({"kid": b.column("kid"), "kth": b.column("kth"), "spans": pa.array(spans, pa.list_(pa.binary())),
                                   "source_ids": pa.array(sources, pa.list_(pa.int64())),
                                   "components": pa.array(comps, pa.list_(pa.int64()))})
    return emit


def _told(seen, there: bool):
    """The rows whose ``key`` the filter passes, or the other ones; the last column, the key, goes."""
    def emit(batches):
        for b in batches:
            keys = b.column("key").to_numpy().view(U64)
            yield b.filter(pa.array(seen.value.has(keys) == there)).select(b.schema.names[:-1])
    return emit


def _byte_spans(b: pa.RecordBatch) -> pa.Array:
    """Spans of words as spans of bytes."""
    out = []
    for text, spans in zip(b.column("text"), b.column("spans").to_pylist()):
        if spans:
            raw = np.frombuffer(text.as_py(), np.uint8)
            starts, ends, _ = word_spans(raw, np.array([0, len(raw)]))
            s = np.frombuffer(b"".join(spans), np.int32).reshape(-1, 2)
            spans = [np.stack([starts[s[:, 0]], ends[s[:, 1] - 1]], 1).astype(np.int32).tobytes()]
        out.append(spans)
    return pa.array(out, pa.list_(pa.binary()))


def remove_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80,
                    recall: float = 0.999, rows: int = 2, reach: int = 6, least_words: int = 7,
                    min_words: int = 20, split: int = 64) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept, source_ids, components), one row per input row.

    Units are paragraphs, whole, and content-cut pieces for repeats inside paragraphs and across them (``Passages``). A
    unit whose cluster also occurs in a document with a smaller id goes, where it makes a run of ``min_words`` repeated
    words or more with what it touches. ``source_ids`` are the documents that keep the passages.

    1. Paragraphs' MinHash bands (``tune_bands``: pairs at the threshold collide with probability ``recall``).
       Bounded bitmaps (``repeated_kinds``, one pass for both) tell the units that repeat, and the band keys of different paragraphs;
       the other ones collide with nothing.
    2. Equal units become one class; classes of paragraphs that share a band are joined where their counts by hash range
       allow the similarity, and verified by exact Jaccard similarity of their ``k``-word shingles (``percent``), each
       against a pivot and then across what is still apart (``links``), where more than ``split`` that share a band
       must also share a prefix element. Pieces meet as equal ones only.
    3. Components are clusters; the first occurrence by (id, place) stays. Pieces that have no such neighbour in their
       document are compared word by word with what stands around the first occurrence, to where the repeat ends: a second
       narrow pass reads the words around these pieces only. Runs go on over less than ``least_words`` words between two
       repeats of one source.
    4. Of the texts only those are moved that such pieces or removed spans may lie in, by bounded bitmaps of their keys
       (``listed_keys``); a join tells exactly.

    Repeats within one document, and between rows of equal ids, stay. Null ids count as larger than any id.
    Null and empty texts have no passages; an empty table gives no rows.
    """
    spark = docs.sparkSession
    p = {"k": k, "rows": rows, "bands": tune_bands(percent / 100, recall, rows), "reach": reach, "least_words": least_words}
    src = keyed(docs, id_col, text_col).select(
        "doc_id", "kid", "kth", F.coalesce("doc_id", F.lit(_LAST)).alias("oid"), F.col("text").cast("binary").alias("text"))
    total = text_bytes(src)

    def unit_keys(c):
        u = Passages(c, reach, least_words, k)
        tag = (u.content[u.n_pieces:] & U64(0xFFFFFFFF)).astype(np.uint32)
        return [u.content, (u.band_keys(p["bands"], rows).ravel(), np.repeat(tag, p["bands"]))]

    same, near = (spark.sparkContext.broadcast(x) for x in repeated_kinds(src, unit_keys, 2, total))
    units = materialise(src.mapInArrow(_units(same, near, p), _UNITS), "passages")

    # only paragraphs that share a key with another one can be near copies
    keys = (units.where("bands is not null").groupBy("content").agg(F.first("bands").alias("bands"))
            .select("content", F.explode("bands").alias("h")))
    met = keys.groupBy("h").agg(F.count("*").alias("c")).where("c > 1").select("h")
    keys = materialise(keys.join(met, "h", "left_semi"), "met")
    sets = materialise(units.where("hs is not null").join(keys.select("content").distinct(), "content", "left_semi")
                       .groupBy(F.col("content").alias("rid")).agg(F.first(F.struct("n", "hs", "bins")).alias("x")).select("rid", "x.*"), "sets")
    entries = plain_entries(keys.withColumnRenamed("content", "rid").join(sets.select("rid", "n", "bins"), "rid"))
    _, comp = links(materialise(entries, "bands"), sets, percent, 32, split)

    # equal units (key and size) are one class; a class is its own cluster, but for linked paragraphs
    classes = units.groupBy("content", "words").agg(F.min("oid").alias("source"), F.max("oid").alias("most"))
    linked = classes.join(comp.select(F.col("node").alias("content"), "comp"), "content")
    cluster = linked.groupBy("comp").agg(F.min("source").alias("source"), F.max("most").alias("most"))
    linked = linked.select("content", "words", "comp").join(cluster, "comp")
    alone = classes.join(comp.select(F.col("node").alias("content")), "content", "left_anti").withColumn("comp", F.col("content"))
    late = alone.unionByName(linked).where("source < most").drop("most")
    beside = Window.partitionBy("kid", "kth", "source", "piece").orderBy("number")
    gone = materialise(
        units.select("kid", "kth", "oid", "number", "words", "piece", "content").join(late, ["content", "words"])
        .where("oid > source").drop("oid").repartition("kid", "kth")
        .withColumn("end", F.col("number") + F.col("words"))
        .withColumn("outer", F.expr("piece") & (~F.lag("end").over(beside).eqNullSafe(F.col("number"))
                                                | ~F.lead("number").over(beside).eqNullSafe(F.col("end")))), "gone")

    # what stands around the outer pieces of runs and around the first occurrences of these
    ends = gone.where("outer").select("kid", "kth", "content", "number", "words", "source")
    firsts = (units.where("piece").select("kid", "kth", "content", "number", "words", "oid")
              .join(ends.select("content", "words", F.col("source").alias("oid")).distinct(), ["content", "words", "oid"], "left_semi")
              .groupBy("content", "words").agg(F.min(F.struct("kid", "kth", "number")).alias("at"))
              .select("at.*", "content", "words", F.lit(None).cast("long").alias("source")))
    # of the texts, those that a list of rows names, and those that it surely does not
    row = F.xxhash64("kid", "kth").alias("key")

    def told(rows: DataFrame, *columns: str) -> list[DataFrame]:
        seen = spark.sparkContext.broadcast(listed_keys(rows.select(row), "key", total))
        texts = src.select(*columns, row)
        return [texts.mapInArrow(_told(seen, there), texts.drop("key").schema) for there in (True, False)]

    places = materialise(ends.unionByName(firsts), "places")
    named, _ = told(places, "kid", "kth", "text")
    places = places.groupBy("kid", "kth").agg(F.collect_set(F.struct("content", "number", "words", "source")).alias("places"))
    around = materialise(named.join(places.hint("shuffle_hash"), ["kid", "kth"]).select("kid", "kth", "text", "places")
                         .mapInArrow(_contexts(reach), _CONTEXT), "around")
    first = (around.where("source is null").select("content", "words", F.col("before").alias("before0"), F.col("after").alias("after0"))
             .dropDuplicates(["content", "words"]))
    span = "kid long, kth long, low int, high int, source long, comp long"
    longer = around.where("source is not null").join(first, ["content", "words"]).mapInArrow(_extended, span)
    plain = gone.select("kid", "kth", F.col("number").alias("low"), F.col("end").alias("high"), "source", "comp")
    gone = plain.unionByName(longer).groupBy("kid", "kth").agg(F.collect_set(F.struct("low", "high", "source", "comp")).alias("units"))
    runs = gone.mapInArrow(_runs(min_words, least_words), "kid long, kth long, spans array<binary>, source_ids array<long>, components array<long>")
    runs = materialise(runs.where(F.size("spans") > 0), "runs")
    named, whole = told(runs, "doc_id", "kid", "kth", "text")
    marked = named.join(runs.hint("shuffle_hash"), ["kid", "kth"], "left").unionByName(whole, allowMissingColumns=True)

    def cut(batches):
        for b in batches:
            for out in _cut([b.set_column(b.schema.get_field_index("spans"), "spans", _byte_spans(b))]):
                yield pa.RecordBatch.from_arrays([*out.columns, b.column("source_ids"), b.column("components")],
                                                 names=[*out.schema.names, "source_ids", "components"])

    out = marked.select("doc_id", "text", "spans", "source_ids", "components").mapInArrow(
        cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, source_ids array<long>, components array<long>")
    none = F.array().cast("array<long>")
    return out.withColumns({c: F.coalesce(c, none) for c in ("source_ids", "components")})
