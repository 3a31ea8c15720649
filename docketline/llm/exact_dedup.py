"""Exact dedup by a tree merge of sorted digest runs."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketline.llm.common import materialise



def _merge_round(runs: DataFrame, shift: int, fan: int, slots: int, largest: bool) -> DataFrame:
    """One round: each partition keeps the entries whose digest digit is its own and
    gets the others' share of it. The received runs are merged in digest order, and
    each digest is reduced to one entry."""
    digit = F.pmod(F.shiftright("slot", shift), F.lit(fan))
    own = F.pmod(F.shiftright("part", shift), F.lit(fan))
    dealt = runs.withColumn("part", F.col("part") + (digit - own) * F.lit(1 << shift))
    merged = dealt.repartition(slots, "part").sortWithinPartitions("part", "digest", "n_bytes")

    def reduce(batches):
        tail = None

        def close(t: pa.Table) -> pa.Table:
            order = "descending" if largest else "ascending"
            t = t.sort_by([("part", "ascending"), ("digest", "ascending"), ("n_bytes", "ascending"),
                           ("keep_id", order), ("keep_row", order)])
            return t.group_by(["part", "digest", "n_bytes", "slot"], use_threads=False).aggregate(
                [("keep_id", "first"), ("keep_row", "first"), ("n", "sum")]).rename_columns(
                ["part", "digest", "n_bytes", "slot", "keep_id", "keep_row", "n"])

        for b in batches:
            if not b.num_rows:
                continue
            t = pa.Table.from_arrays([b.column(n) for n in names], names=names)
            t = close(t if tail is None else pa.concat_tables([tail, t])).select(names)
            last = pc.and_(pc.equal(t["digest"], t["digest"][-1]), pc.equal(t["part"], t["part"][-1]))
            tail = t.filter(last)
            yield from t.filter(pc.invert(last)).to_batches()
        if tail is not None:
            yield from tail.to_batches()

    names = ["part", "slot", "digest", "n_bytes", "keep_id", "keep_row", "n"]
    return merged.select(names).mapInArrow(
        reduce, "part long, slot long, digest binary, n_bytes long, keep_id long, keep_row long, n long")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest",
                     fan_log2: int = 3, rounds: int | None = None) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row per input row.

    Texts are equal when their bytes are; null counts as empty. A run entry is a
    SHA-256 digest with the text's length, the identifier that stays (the
    smallest or largest, by ``keep``) and the number of rows. Every task first
    sorts and reduces its own rows to a run. The runs then meet in binomial
    rounds: with ``p = 2**(rounds * fan_log2)`` partitions, round r lets
    ``2**fan_log2`` partners swap the entries that differ in the r-th digit of
    the digest, merge what they get and keep one entry per digest. A hot text
    is thus one entry per partition from the first round on, and no task ever
    holds more than its share of the digests. Unless given, ``rounds`` grows with the rows,
    so that a partition has about 16 MB of entries. Texts of any length enter as digests only.

    A null id never stays where an id exists; among rows that tie (repeated ids,
    or only null ids) exactly one row is kept. An empty table gives no rows.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep: smallest or largest")
    largest = keep == "largest"
    text = F.coalesce(F.col(text_col), F.lit(""))
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    rows = materialise(src.select(
        "doc_id", F.unhex(F.sha2("text", 256)).alias("digest"), F.octet_length("text").cast("long").alias("n_bytes"),
        F.monotonically_increasing_id().alias("row")), "digests")

    total = rows.count() * 64
    rounds = rounds or max(1, -(-max(1, (total >> 24).bit_length()) // fan_log2))
    slots = 1 << (rounds * fan_log2)
    worst = -(1 << 63) if largest else (1 << 63) - 1
    best = F.max if largest else F.min
    slot = F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("long") % slots
    # a null id is worse than any other, and the row number breaks ties
    pick = F.struct(F.coalesce("doc_id", F.lit(worst)).alias("keep_id"), F.col("row").alias("keep_row"))
    runs = (rows.withColumn("part", F.spark_partition_id().cast("long") % slots)
            .groupBy("part", "digest", "n_bytes").agg(best(pick).alias("k"), F.count("*").alias("n"))
            .select("part", slot.alias("slot"), "digest", "n_bytes", "k.keep_id", "k.keep_row", "n"))
    for r in range(rounds):
        runs = _merge_round(runs, r * fan_log2, 1 << fan_log2, slots, largest)
    groups = materialise(runs, "groups").select("digest", "n_bytes", "keep_id", "keep_row", "n")
    return (rows.join(groups.hint("merge"), ["digest", "n_bytes"])
            .select("doc_id", F.when(F.col("keep_id") != worst, F.col("keep_id")).alias("keep_id"),
                    F.col("n").alias("group_size"), (F.col("row") == F.col("keep_row")).alias("kept"),
                    F.lower(F.hex("digest")).alias("text_sha256")))
