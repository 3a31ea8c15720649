"""From raw documents to token ids: five stages, each a text operator whose decisions take effect.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a
DataFrame, which is written as Parquet and read again as the next one's docs. All but the last return
the columns of ``documents``; a null text comes out of a rewriting stage as an empty one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docketline.llm.common import scratch, table
from docketline.llm.decontaminate import decontaminate
from docketline.llm.jaccard_join import jaccard_components
from docketline.llm.line_dedup import drop_common_lines
from docketline.llm.piece_codec import encode_decode
from docketline.llm.toxicity import score_toxicity

#: SQL can express neither a trained classifier nor BPE; tests hold the stages against brute force
ORACLE_SQL = None


def _rewritten(docs: DataFrame, out: DataFrame, text: str) -> DataFrame:
    """The columns of ``docs`` with the new text and its number of characters."""
    new = {"text": F.col(text), "n_chars": F.length(text).cast("long")}
    return out.select(*[new[c].alias(c) if c in new else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def _others(docs: DataFrame) -> list[str]:
    return [c for c in docs.columns if c not in ("text", "n_chars")]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score of 0.7 or more go. Every row is scored for itself: null ids, repeated rows
    and ties make no difference; null and empty texts have a score too. An empty table gives no rows."""
    out = score_toxicity(docs, table(spark, sf_dir, "labels"), carry=docs.columns)
    return out.where("predicted = 0").select("row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten documents or more go from all of them. Rows that repeat id and text count as one document and
    each stay; a null text comes out empty. An empty table gives no rows."""
    return _rewritten(docs, drop_common_lines(docs, min_docs=10, min_chars=1, carry=_others(docs)), "kept")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at 0.8, one stays: the one with the smallest id (null ids last; ties by a hash of the text).

    Rows that repeat both id and text are one document, of which one row stays, the least by its columns. Null and
    empty texts are linked with nothing; an empty table gives no rows.
    """
    text = F.coalesce("text", F.lit(""))
    named = docs.withColumn("_document", F.xxhash64(F.col("doc_id").isNull(), "doc_id", text))
    groups = jaccard_components(named, id_col="_document", k=5, percent=80).select(F.col("doc_id").alias("_document"), "component_id")
    order = named.select("_document", F.struct(F.col("doc_id").isNull(), "doc_id", F.xxhash64(text), "_document").alias("at"))
    stay = groups.join(order, "_document").groupBy("component_id").agg(F.min("at").alias("at")).select("at._document")
    first = Window.partitionBy("_document").orderBy(*[F.col(f"`{c}`") for c in docs.columns])
    return (named.join(stay, "_document", "left_semi").withColumn("_row", F.row_number().over(first)).where("_row = 1")
            .select(*[F.col(f"`{c}`") for c in docs.columns]))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark windows of ten words are cut out; documents of which they cover half or more go. Every row is cut for
    itself, whatever its id; null and empty texts stay, as empty ones. An empty table gives no rows."""
    out = decontaminate(docs, table(spark, sf_dir, "benchmark"), window=10, drop_share=0.5, carry=_others(docs))
    return _rewritten(docs, out.where("keep"), "text")


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids): the token ids with an end id. A row per row, whatever its id; null and empty texts have the
    end id alone. An empty table gives no rows."""
    out = encode_decode(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [("toxicity", toxicity), ("line_dedup", line_dedup), ("near_duplicates", near_duplicates),
          ("benchmark_decontamination", benchmark_decontamination), ("sentencepiece", sentencepiece)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
