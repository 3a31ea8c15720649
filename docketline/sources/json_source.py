"""Raw JSON landing files -> bronze.

Landing layout: ``<root>/<tribunal>/...json`` (or Spark's ``tribunal=<x>``
folders). A file is either one JSON array of hits (the search API's page
dump; ``multiLine``, so one task per file: land many small files) or JSON
Lines (splittable; what ``write_hits`` produces by default at scale).
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.parse import parse_filing_ts
from ..schemas import BRONZE, CHANGED, CORRUPT, HIT
from ..session import child_names, complete_children, delete_path, folder_bytes, shuffles_dropped

# Hits per landed array file (the search API's page size).
HITS_PER_FILE = 500
# Lines per compressed file.
PACKED_HITS = 100_000
_KEYED_TAG = r"/tribunal=([^/]+)/"
_PARENT_TAG = r"/([^/]+)/[^/]+$"


def source_tag_from_path(path_col: Column | None = None) -> Column:
    """A3: the source of a landed file: a ``tribunal=<x>`` folder anywhere in the
    path, else the file's parent folder (``.../<x>/file``)."""
    p = F.col("_metadata.file_path") if path_col is None else path_col
    keyed = F.nullif(F.regexp_extract(p, _KEYED_TAG, 1), F.lit(""))
    # file paths are URIs: '%20' and friends are decoded
    return F.url_decode(F.coalesce(keyed, F.regexp_extract(p, _PARENT_TAG, 1)))


def evolved(known: T.DataType, seen: T.DataType) -> T.DataType:
    """``known`` with the fields that only ``seen`` has; known fields keep their types."""
    if isinstance(known, T.StructType) and isinstance(seen, T.StructType):
        types = {f.name: f.dataType for f in seen.fields}
        fields = [T.StructField(f.name, evolved(f.dataType, types[f.name]) if f.name in types else f.dataType)
                  for f in known.fields]
        return T.StructType(fields + [f for f in seen.fields if f.name not in known.names])
    if isinstance(known, T.ArrayType) and isinstance(seen, T.ArrayType):
        return T.ArrayType(evolved(known.elementType, seen.elementType))
    return known


def read_hits(spark: SparkSession, path: str | list[str], multiline: bool = True,
              schema: T.StructType | None = HIT, ingest_ts: str | Column | None = None,
              tag: str | Column | None = None, evolve: bool = False) -> DataFrame:
    """A1 + A3: read every JSON file under ``path`` into bronze rows.

    An explicit schema is the default (no inference pass over the data, and
    mixed shapes cannot turn arrays into strings); pass ``schema=None`` to
    infer, or ``evolve=True`` to add fields the schema does not know. A line that is
    no JSON object is kept in ``_corrupt_record``. ``tag`` defaults to the folder name;
    ``ingest_ts`` to now. The filing time is parsed once, into ``filed_at``.
    """
    r = spark.read.option("multiLine", multiline).option("recursiveFileLookup", True)
    if schema is None or evolve:
        seen = T.StructType([f for f in r.json(path).schema.fields if f.name != CORRUPT])
        schema = seen if schema is None else evolved(schema, seen)
    schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    df = r.schema(schema).option("columnNameOfCorruptRecord", CORRUPT).json(path)
    tag_col = source_tag_from_path() if tag is None else (F.lit(tag) if isinstance(tag, str) else tag)
    if ingest_ts is None:
        ts = F.current_timestamp()
    elif isinstance(ingest_ts, str):
        ts = F.to_timestamp(F.lit(ingest_ts))
    else:
        ts = ingest_ts
    return (df.withColumn("tribunal", tag_col).withColumn("data_ingestao", ts)
            .withColumn("filed_at", parse_filing_ts(F.col("_source.dataAjuizamento"))))


# ---- lines whose field types change (A2, B1)

def read_variants(spark: SparkSession, path: str | list[str], ingest_ts: str | None = None) -> DataFrame:
    """JSON lines as (hit variant, _corrupt_record, tribunal, data_ingestao): each is parsed once, whatever its fields' types.

    A line that is no JSON object is kept as text in ``_corrupt_record``; an array of hits is taken apart.
    """
    v = (spark.read.schema(f"hit variant, {CORRUPT} string").option("singleVariantColumn", "hit").option("recursiveFileLookup", True)
         .option("columnNameOfCorruptRecord", CORRUPT).json(path))
    ts = F.current_timestamp() if ingest_ts is None else F.to_timestamp(F.lit(ingest_ts))
    many = F.try_variant_get("hit", "$", "array<variant>")
    v = v.select(F.explode(F.coalesce(many, F.array("hit"))).alias("hit"), CORRUPT, source_tag_from_path().alias("tribunal"), ts.alias("data_ingestao"))
    is_object = F.try_variant_get("hit", "$", "struct<_id:variant>").isNotNull()
    return v.select(F.when(is_object, F.col("hit")).alias("hit"),
                    F.coalesce(CORRUPT, F.when(~is_object, F.coalesce(F.to_json("hit"), F.lit("null")))).alias(CORRUPT), "tribunal", "data_ingestao")


def _at(path: str, name: str) -> str:
    return f"{path}['{name}']"


def _ddl(kind: T.DataType) -> str:
    """A type as text, its field names quoted."""
    if isinstance(kind, T.StructType):
        return "struct<" + ",".join(f"`{f.name.replace('`', '``')}`:{_ddl(f.dataType)}" for f in kind.fields) + ">"
    return f"array<{_ddl(kind.elementType)}>" if isinstance(kind, T.ArrayType) else kind.simpleString()


def _typed(v: Column, path: str, kind: T.DataType) -> Column:
    """A field of a variant as a type, taken out at once; within it, each value of another kind is null."""
    return F.try_variant_get(v, path, _ddl(kind))


def _gap(c: Column, kind: T.DataType) -> Column:
    """True where a typed value, or a known field within it, is null: only there can a value of another kind have been."""
    if isinstance(kind, T.StructType):
        out = c.isNull()
        for f in kind.fields:
            out = out | _gap(c.getField(f.name), f.dataType)
        return out
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
        return c.isNull() | F.exists(c, lambda x: _gap(x, kind.elementType))
    return c.isNull()


def _changed(v: Column, path: str, kind: T.DataType, name: str = "", typed: Column | None = None) -> list[Column]:
    """The name of each field that has a value of another kind than ``kind``, else null.

    ``typed``: the value as ``kind``, if it is known; the variant is looked into only where that is null.
    """
    value = F.try_variant_get(v, path, "variant")
    there = value.isNotNull() & ~F.is_variant_null(value)

    def within(fields: list[T.StructField], x: Column, at: str, t: Column | None = None) -> list[Column]:
        return [c for f in fields for c in _changed(x, _at(at, f.name), f.dataType, f"{name}.{f.name}".lstrip("."),
                                                    None if t is None else t.getField(f.name))]

    def if_null(c: Column, where: Column | None = None) -> Column:
        return c if typed is None else F.when(typed.isNull() if where is None else where, c)

    if isinstance(kind, T.StructType):
        other = F.when(there & F.try_variant_get(v, path, "map<string,variant>").isNull(), F.lit(name))
        return [if_null(other), *within(kind.fields, v, path, typed)]
    if not isinstance(kind, T.ArrayType):
        return [if_null(F.when(there & F.try_variant_get(v, path, kind.simpleString()).isNull(), F.lit(name)))]
    items, out = F.try_variant_get(v, path, "array<variant>"), []
    if isinstance(kind.elementType, T.StructType):
        def has(field: T.StructField) -> Column:
            return F.exists(items, lambda x: F.coalesce(*within([field], x, "$")).isNotNull())

        odd = None if typed is None else _gap(typed, kind)
        out = [if_null(F.when(has(f), F.lit(f"{name}.{f.name}")), odd) for f in kind.elementType.fields]
    return [if_null(F.when(there & items.isNull(), F.lit(name))), *out]


def _as_text(known: T.DataType, seen: T.DataType) -> T.DataType:
    """``known`` with the fields that only ``seen`` has, as text: their types may change from batch to batch."""
    if isinstance(known, T.StructType) and isinstance(seen, T.StructType):
        types = {f.name: f.dataType for f in seen.fields}
        fields = [T.StructField(f.name, _as_text(f.dataType, types.get(f.name, f.dataType))) for f in known.fields]
        return T.StructType(fields + [T.StructField(f.name, T.StringType()) for f in seen.fields if f.name not in known.names])
    if isinstance(known, T.ArrayType) and isinstance(seen, T.ArrayType):
        return T.ArrayType(_as_text(known.elementType, seen.elementType))
    return known


def typed_hits(variants: DataFrame, schema: T.StructType = HIT) -> DataFrame:
    """Bronze rows of ``read_variants`` (best of a stored table: it is read twice, once for its fields).

    A known field whose value has another type is null, and its name is in ``_changed_fields``; the rest of the
    hit is kept. Fields that ``schema`` does not know are added as text (objects as JSON). Unreadable lines are kept.
    """
    found = variants.where(F.col("hit").isNotNull()).agg(F.schema_of_variant_agg("hit").alias("s")).first()["s"]
    seen = T.DataType.fromDDL(found.replace("OBJECT<", "STRUCT<")) if found and found.startswith("OBJECT<") else schema
    known, v = _as_text(schema, seen), F.col("hit")
    rows = variants.select(*[_typed(v, _at("$", f.name), f.dataType).alias(f.name) for f in known.fields], CORRUPT, "tribunal",
                           "data_ingestao", "hit")
    gap = F.lit(False)
    for f in schema.fields:
        gap = gap | _gap(F.col(f.name), f.dataType)
    found = [F.when(v.isNotNull() & F.try_variant_get(v, "$", "struct<_id:variant>").isNull(), F.lit(""))]
    for f in schema.fields:
        found += _changed(v, _at("$", f.name), f.dataType, f.name, F.col(f.name))
    changed = F.filter(F.array(*found), lambda x: x.isNotNull())
    return rows.select(*known.names, CORRUPT, F.when(gap, changed).otherwise(F.array().cast("array<string>")).alias(CHANGED), "tribunal", "data_ingestao",
                       parse_filing_ts(F.col("_source.dataAjuizamento")).alias("filed_at"))


def write_hits(hits: DataFrame, path: str, layout: str = "lines",
               hits_per_file: int = HITS_PER_FILE, compression: str = "none") -> None:
    """Land hits under ``path/tribunal=<x>/`` as JSON Lines or as JSON-array files.

    ``array`` groups about ``hits_per_file`` hits of a source per file by a hash of the
    hit id; the file count grows with the data, so each group stays bounded. ``compression``
    is the text writer's; a compressed file cannot be split, so it takes ``PACKED_HITS`` lines at most.
    """
    cols = [c for c in hits.columns if c not in ("tribunal", "data_ingestao", "filed_at", CORRUPT)]
    if layout == "lines":
        w = hits.select(*cols, "tribunal").write.mode("overwrite").partitionBy("tribunal").option("compression", compression)
        with shuffles_dropped(hits.sparkSession):
            (w if compression == "none" else w.option("maxRecordsPerFile", PACKED_HITS)).json(path)
        return
    if layout != "array":
        raise ValueError(layout)
    # files per source; a source without a count (its rows changed meanwhile) has one
    files = F.lit(1)
    for r in hits.groupBy("tribunal").count().collect():           # a row per source
        files = F.when(F.col("tribunal").eqNullSafe(F.lit(r["tribunal"])), F.lit(max(1, math.ceil(r["count"] / hits_per_file)))).otherwise(files)
    grouped = (hits.select(*cols, "tribunal", F.pmod(F.xxhash64("_id"), files).alias("__file"))
               .groupBy("tribunal", "__file")
               .agg(F.to_json(F.collect_list(F.struct(*cols))).alias("value")))
    # a row is a file's whole array: files of one row, so that a source is one folder, not a folder per file
    with shuffles_dropped(hits.sparkSession):
        (grouped.select("value", "tribunal").write.mode("overwrite").partitionBy("tribunal").option("maxRecordsPerFile", 1)
         .option("compression", compression).text(path))


class BronzeTable:
    """Bronze as plain parquet, a folder per batch: ``<path>/batch=<number>~<tag>``.

    A tag (a stream's batch id, or a reload's name) keeps its number, so a replayed
    batch overwrites its own folder. Rows that could not be
    read are in the same folders, with ``_corrupt_record``.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _names(self, complete: bool) -> dict[int, str]:
        names = (complete_children if complete else child_names)(self.spark, self.path)
        return {int(n.removeprefix("batch=").split("~")[0]): n for n in names if n.startswith("batch=")}

    def batches(self) -> list[int]:
        return sorted(self._names(True))

    def put(self, tag: str, hits: DataFrame) -> int:
        """A2 append: write one batch; its number is returned. One writer at a time.

        Numbers tell the order in which writes began: what is read downstream goes by which batches are
        complete, never by the greatest number.
        """
        if not re.fullmatch(r"[\w.-]+", tag):
            raise ValueError(f"a tag is letters, digits, '_', '-' and '.': {tag}")
        names = self._names(False)
        number = next((i for i, n in names.items() if n.split("~")[1] == tag), max(names, default=-1) + 1)
        with shuffles_dropped(self.spark):
            hits.write.mode("overwrite").parquet(f"{self.path}/batch={number}~{tag}")
        return number

    def read(self, batch: int | None = None) -> DataFrame:
        """Readable hits with the schema merged over all batches, or of one batch (A2)."""
        return self._all(batch).where(F.col(CORRUPT).isNull()).drop(CORRUPT)

    def size(self, batch: int) -> int:
        """Bytes of a batch's files."""
        return folder_bytes(self.spark, f"{self.path}/{self._names(True)[batch]}")

    def rejects(self, batch: int | None = None) -> DataFrame:
        """Landed lines that could not be read, with their source and ingest time."""
        return self._all(batch).where(F.col(CORRUPT).isNotNull()).select("tribunal", "data_ingestao", CORRUPT)

    def put_lines(self, tag: str, path: str | list[str], schema: T.StructType = HIT, ingest_ts: str | None = None) -> int:
        """A2 append of landed JSON lines, each parsed once: as variants into a folder aside, then typed into the batch."""
        stage = f"{self.path}/_stage/{tag}"
        read_variants(self.spark, path, ingest_ts).write.mode("overwrite").parquet(stage)
        number = self.put(tag, typed_hits(self.spark.read.parquet(stage), schema))
        delete_path(self.spark, stage)
        return number

    def changed_fields(self) -> DataFrame:
        """(tribunal, field, hits): values of another type than the field's, which are null in bronze."""
        rows = self._all(None)
        if CHANGED not in rows.columns:
            return self.spark.createDataFrame([], "tribunal string, field string, hits bigint")
        return rows.select("tribunal", F.explode(CHANGED).alias("field")).groupBy("tribunal", "field").agg(F.count(F.lit(1)).alias("hits"))

    def _all(self, batch: int | None) -> DataFrame:
        names = self._names(True)
        picked = [names[i] for i in (sorted(names) if batch is None else [batch])]
        if not picked:
            return self.spark.createDataFrame([], BRONZE)
        return self.spark.read.option("mergeSchema", True).parquet(*[f"{self.path}/{n}" for n in picked])


def hits_per_case(bronze: DataFrame, *more: str) -> DataFrame:
    """One row per (source, case, instance) with the latest ingest time: a large case comes in several hits."""
    s = "_source."
    return bronze.groupBy("tribunal", F.col(s + "numeroProcesso").alias("numero_processo"), F.col(s + "grau").alias("grau"), *more).agg(
        F.max("data_ingestao").alias("data_ingestao"))


def source_summary(bronze: DataFrame) -> DataFrame:
    """Cases per instance and latest ingest time per source."""
    return hits_per_case(bronze).groupBy("tribunal").agg(
        F.count(F.lit(1)).alias("total"), F.max("data_ingestao").alias("ultima_ingestao"))


def ensure_database(spark: SparkSession, name: str) -> None:
    """A10: create a database (schema) if missing."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")
