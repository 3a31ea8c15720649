"""N-gram Jaccard join: rare-first prefix filtering, then one verification per pair."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketline.llm.common import (LOWER, U64, Chunk, hash_spans, keyed, materialise, mix, repeated_keys,
                                   shingle_hashes, text_bytes, text_chunks, word_spans)
from docketline.llm.components import components

_BINS = 32
_CLASSES = 12
_SETS = "doc_id long, kid long, kth long, n int, d1 long, d2 long, hs array<long>, bins array<int>"


def chunk_shingles(c: Chunk, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(shingle hash, text index) of a chunk's lower-cased texts; repeats included."""
    lower = LOWER[c.data]
    starts, ends, doc = word_spans(lower, c.offs)
    return shingle_hashes(hash_spans(lower, starts, ends), doc, k)


def _distinct(h: np.ndarray, doc: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, hash) rows in that order, and the cuts between texts."""
    order = np.argsort(h)
    order = order[np.argsort(doc[order], kind="stable")]
    h, doc = h[order], doc[order]
    if len(h):
        new = np.r_[True, (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])]
        h, doc = h[new], doc[new]
    return h, doc, np.searchsorted(doc, np.arange(n_docs + 1))


def _set_rows(seen, k: int, percent: int):
    """Per text: size and digest of its set; the set itself only where ``percent`` of it
    repeats in the corpus, once per distinct set of the chunk."""
    def emit(batches):
        repeats = seen.value
        for c in text_chunks(batches):
            h, doc, cuts = _distinct(*chunk_shingles(c, k), len(c))
            n = np.diff(cuts)
            shared = np.bincount(doc, weights=repeats.has(h), minlength=len(c)).astype(np.int64)
            # sums of two mixes of the distinct hashes: equal sets have equal digests
            d1, d2 = (np.r_[U64(0), np.cumsum(mix(h ^ U64(s)))] for s in (0x1234567, 0x9ABCDEF01))
            d1, d2 = d1[cuts[1:]] - d1[cuts[:-1]], d2[cuts[1:]] - d2[cuts[:-1]]
            alive = (n > 0) & (shared * 100 >= n * percent)
            told, hs, bins = set(), [], []
            for d in range(len(c)):
                own = (int(d1[d]), int(d2[d]))
                some = h[cuts[d]:cuts[d + 1]] if alive[d] and own not in told else None
                hs.append(None if some is None else some.view(np.int64))
                # elements by equal ranges of the hash, for the suffix filter
                bins.append(None if some is None else np.bincount((some >> U64(59)).astype(np.int64), minlength=_BINS))
                if alive[d]:
                    told.add(own)
            yield pa.record_batch({
                "doc_id": c.rows.column("doc_id"), "kid": c.rows.column("kid"), "kth": c.rows.column("kth"),
                "n": pa.array(n.astype(np.int32)), "d1": pa.array(np.where(alive, d1.view(np.int64), 0)),
                "d2": pa.array(np.where(alive, d2.view(np.int64), 0), mask=~alive),
                "hs": pa.array(hs, pa.list_(pa.int64())), "bins": pa.array(bins, pa.list_(pa.int32()))})
    return emit


def _least(n: Column, m: Column, percent: int) -> Column:
    """The smallest intersection of sets of n and m elements that link:
    100 * i >= percent * (n + m - i), so i >= percent * (n + m) / (100 + percent)."""
    return F.ceil(F.lit(percent) * (n + m) / F.lit(100 + percent))


def _entries(sets: DataFrame, percent: int) -> DataFrame:
    """(h, rid, n, pos, low, own, mass): each set's prefix, rarest first, without what occurs in one set only.

    An element of frequency one comes first in the order and joins with nothing,
    so it takes up prefix places without a row. The order is (frequency, hash). Of the shared elements before an
    entry, ``low`` counts those of each lower class of frequencies (octaves), ``own`` those of its own class.
    """
    grams = sets.select("rid", "n", F.explode("hs").alias("h"))
    df = grams.groupBy("h").agg(F.count("*").alias("df")).where("df > 1")
    octave = F.least(F.floor(F.log2("df")) - 1, F.lit(_CLASSES - 1)).cast("int")
    ranked = (grams.join(df, "h").withColumn("octave", octave).groupBy("rid", "n")
              .agg(F.array_sort(F.collect_list(F.struct("df", "h"))).alias("shared"), F.sum("df").alias("mass"),
                   F.array(*[F.count(F.when(F.col("octave") == c, 1)).cast("int") for c in range(_CLASSES)]).alias("classes")))
    least = F.ceil(F.lit(percent) * F.col("n") / F.lit(100))
    rows = (ranked.withColumn("prefix", (F.col("n") - least + 1).cast("int")).withColumn("alone", F.col("n") - F.size("shared"))
            .where("alone < prefix")
            .select("rid", "n", "mass", "alone", "classes", F.posexplode(F.expr("slice(shared, 1, prefix - alone)")).alias("i", "x"))
            .withColumn("df", F.col("x.df")).withColumn("octave", octave))
    low = [F.when(F.col("octave") > c, F.col("classes")[c]).otherwise(0) for c in range(_CLASSES)]
    return rows.select(F.col("x.h").alias("h"), "rid", "n", (F.col("alone") + F.col("i")).alias("pos"), F.array(*low).alias("low"),
                       (F.col("i") - sum(low[1:], low[0])).alias("own"), "mass")


def plain_entries(keys: DataFrame) -> DataFrame:
    """Entries of candidates by other keys than prefix elements: rows (h, rid, n, bins) without an order. The counts
    by hash range take the place of those by frequency class."""
    zero = F.lit(0)
    return keys.select("h", "rid", "n", F.col("n").alias("pos"), F.col("bins").alias("low"), zero.alias("own"),
                       zero.cast("long").alias("mass"))


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that link. The suffix filter compares how many elements each hash range
    can have in common; what passes is intersected in full, once a pair."""
    a = sets.select(F.col("rid").alias("a"), F.col("n").alias("na"), F.col("hs").alias("ha"), F.col("bins").alias("ba"))
    b = sets.select(F.col("rid").alias("b"), F.col("n").alias("nb"), F.col("hs").alias("hb"), F.col("bins").alias("bb"))
    most = F.aggregate(F.zip_with("ba", "bb", lambda x, y: F.least(x, y)), F.lit(0), lambda s, x: s + x)
    common = F.size(F.array_intersect("ha", "hb"))
    return (pairs.join(b.hint("merge"), "b").join(a.hint("merge"), "a")
            .where(most >= _least(F.col("na"), F.col("nb"), percent))
            .withColumn("i", common)
            .where(F.col("i") * 100 >= percent * (F.col("na") + F.col("nb") - F.col("i")))
            .select("a", "b", (F.col("i") / (F.col("na") + F.col("nb") - F.col("i"))).alias("jaccard")))


def _fits(x: str, y: str, percent: int, classes: int) -> Column:
    """Length and positional filter of two prefix entries of the same element. The intersection is at most
    what follows the element in both, and what stands before it in both, class by class of frequencies. More
    classes than ``_CLASSES`` are summed as arrays: written out, they make a method too long for the JVM to compile."""
    n, m, i, j = F.col(f"{x}n"), F.col(f"{y}n"), F.col(f"{x}pos"), F.col(f"{y}pos")
    after = F.least(n - i, m - j)
    most = after + F.least(f"{x}own", f"{y}own")
    if classes > _CLASSES:
        most = F.aggregate(F.zip_with(f"{x}low", f"{y}low", lambda a, b: F.least(a, b)), most, lambda s, a: s + a)
    else:
        for c in range(classes):
            most = most + F.least(F.col(f"{x}low")[c], F.col(f"{y}low")[c])
    return (n * 100 >= m * percent) & (m * 100 >= n * percent) & (most >= _least(n, m, percent))


def _side(entries: DataFrame, p: str) -> DataFrame:
    return entries.select("h", *[F.col(c).alias(f"{p}{c}") for c in entries.columns if c != "h"])


def _pair(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _by_prefix(mixed: DataFrame, sets: DataFrame, percent: int, split: int) -> DataFrame:
    """``mixed`` with a second key ``e``: a list of at most ``split`` entries stays one list (0); in a longer one an entry
    stands once for each element of its set's prefix, rarest first among the sets of such lists. Sets that link share
    one of these, and sets that are only alike seldom do, so a long list falls into short ones."""
    long = mixed.groupBy("h").agg(F.count("*").alias("c")).where(F.col("c") > split).select("h", F.lit(True).alias("long"))
    mixed = materialise(mixed.join(long, "h", "left").withColumn("long", F.coalesce("long", F.lit(False))), "split")
    own = sets.join(mixed.where("long").select("rid").distinct(), "rid", "left_semi")
    e = _entries(own, percent).select("rid", F.col("h").alias("e"))
    cols = [*mixed.drop("long").columns, "e"]
    return (mixed.where("not long").withColumn("e", F.lit(0).cast("long")).select(*cols)
            .unionByName(mixed.where("long").join(e, "rid").select(*cols)))


def links(entries: DataFrame, sets: DataFrame, percent: int, classes: int = _CLASSES,
          split: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(links, components) of the distinct sets ``sets`` (rid, n, hs, bins), whose candidates share
    an element of ``entries`` (h, rid, n, pos, low, own, mass); ``low`` has ``classes`` counts.

    First every element's prefix list is joined to one pivot only, the set with the most
    frequent elements (the centre of a group of copies), and the verified links give components.
    Then the pairs of an element's list that are still in different components are
    joined and verified: pairs of one component need no test, and no pair is lost otherwise. With ``split``, for
    elements that are no prefix elements themselves, lists longer than that are taken apart first (``_by_prefix``).
    """
    pivot = (entries.groupBy("h").agg(F.max(F.struct("mass", "rid", "n", "pos", "low", "own")).alias("p"), F.count("*").alias("c"))
             .where("c > 1").select("h", *[F.col(f"p.{c}").alias(f"p{c}") for c in ("rid", "n", "pos", "low", "own")]))
    near = (_side(entries, "x").join(pivot, "h").where("xrid <> prid").where(_fits("x", "p", percent, classes))
            .select(*_pair("xrid", "prid")).distinct())
    first = materialise(_verify(near, sets, percent), "links")
    comp = components(first.select("a", "b"), "pivots")

    placed = (entries.join(comp.select(F.col("node").alias("rid"), "comp"), "rid", "left")
              .withColumn("comp", F.coalesce("comp", "rid")))
    # in each list, what is outside its largest component meets the whole list
    lists = placed.groupBy("h", "comp").agg(F.count("*").alias("c"))
    main = lists.groupBy("h").agg(F.max(F.struct("c", "comp")).alias("m"), F.count("*").alias("k")).where("k > 1").select("h", F.col("m.comp").alias("main"))
    mixed = placed.join(main, "h")
    mixed = materialise(mixed.withColumn("e", F.lit(0).cast("long")) if split is None else _by_prefix(mixed, sets, percent, split), "mixed")
    minor = _side(mixed.where("comp <> main"), "x")
    rest = (minor.withColumnRenamed("xe", "e").join(_side(mixed, "y").withColumnRenamed("ye", "e").hint("merge"), ["h", "e"])
            .where((F.col("xcomp") != F.col("ycomp")) & ((F.col("ycomp") == F.col("ymain")) | (F.col("xrid") < F.col("yrid"))))
            .where(_fits("x", "y", percent, classes)).select(*_pair("xrid", "yrid")).distinct())
    second = materialise(_verify(rest, sets, percent), "links")
    # links between components join whole components
    of = comp.select(F.col("node"), "comp")
    ends = second.select("a", "b")
    for e in ("a", "b"):
        ends = ends.join(of.withColumnRenamed("node", e), e, "left").withColumn(e, F.coalesce("comp", e)).drop("comp")
    joined = components(ends, "joined")
    both = of.unionByName(joined.select("node", F.col("node").alias("comp")).join(of, "node", "left_anti"))
    whole = (both.join(joined.select(F.col("node").alias("comp"), F.col("comp").alias("top")), "comp", "left")
             .select("node", F.coalesce("top", "comp").alias("comp")))
    return first.unionByName(second), whole


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5,
                       percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kid, kth), one row per input row; (kid, kth) is the row's key.

    A text's set is its distinct k-word shingles (words between ASCII white
    space, A-Z lowered), as 64-bit hashes; a shorter text is one shingle. Two
    documents link when 100 * |intersection| >= percent * |union|; the component id
    is the smallest id reachable by links.

    1. A bounded bitmap of shingles that repeat in the corpus (``repeated_keys``): a
       linked text has at least ``percent`` of its set in it. Other texts cannot
       link; their sets are never moved.
    2. Equal sets become one class by digest; only distinct sets go on.
    3. Prefix join with length and positional filters, suffix filter, one verification a pair (``links``).

    Null and empty texts have an empty set and link with nothing. Null ids never name a
    component unless it has no other id (then it is null). Rows that repeat an id each get a row.
    """
    spark = docs.sparkSession
    src = keyed(docs, id_col, text_col).withColumn("text", F.col("text").cast("binary"))
    total = text_bytes(src)
    seen = spark.sparkContext.broadcast(repeated_keys(src, lambda c: _distinct(*chunk_shingles(c, k), len(c))[0], total))
    rows = materialise(src.mapInArrow(_set_rows(seen, k, percent), _SETS), "sets")
    cid = ["d1", "d2", "n"]
    alive = rows.where("d2 is not null")
    classes = alive.groupBy(*cid).agg(F.min("doc_id").alias("least"))
    # of the copies that chunks shipped, one set per class: dealt by digest, so that a row a chunk meets
    kept = alive.where("hs is not null").groupBy(*cid).agg(F.first("hs").alias("hs"), F.first("bins").alias("bins"))
    sets = materialise(kept.withColumn("rid", F.monotonically_increasing_id()), "reps")
    _, comp = links(materialise(_entries(sets, percent), "prefix"), sets.select("rid", "n", "hs", "bins"), percent)
    named = (sets.select("rid", *cid).join(classes, cid)
             .join(comp.select(F.col("node").alias("rid"), "comp"), "rid", "left").withColumn("comp", F.coalesce("comp", "rid")))
    name = named.groupBy("comp").agg(F.min("least").alias("component_id"))
    tag = named.join(name, "comp").select(*cid, "component_id")
    out = rows.select("doc_id", "kid", "kth", *cid).join(tag, cid, "left")
    return out.select("doc_id", F.col("n").cast("long").alias("n_shingles"),
                      F.when(F.col("d2").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), "kid", "kth")
