"""Build and materialise the gold layer (silver, dimensions, fact).

Tables are written as parquet under the shared checkpoint folder
(``session.work_dir``) and read back: lineage is cut, an executor loss only
recomputes from the written files, and every report reads the same files.
The folder name is a hash of the input paths, sizes and modification times,
so a changed input builds a new set. A build is a version of its own; a pointer moves to
it when its tests have passed.

Physical layout: the fact is partitioned by ``is_ultimo_movimento``. Eight of
the eleven dashboard queries read only latest events, so they prune to one
directory, which at scale is the small side (one row per case).
"""

from __future__ import annotations

import hashlib
import threading
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import BROADCAST_BYTES, frame_bytes
from ..operators.merge import bucket_of
from ..schemas import FACT_COLUMNS, FACT_DDL, SILVER_COLUMNS, SILVER_DDL
from ..session import complete_children, path_exists, path_stamp, shuffles_dropped, work_dir
from ..sources import fixtures
from . import dims as D
from .checks import RESULT_DDL, Test, gate, run_tests
from .dims import silver_groups
from .fact import build_fact
from .observed import Watch
from .silver import silver_columns, silver_events

LAYOUT_VERSION = "7"
POINTER_DDL = "version string, upto bigint, published_at timestamp"
# Folders of the batch-built silver: a case is looked up in one of them.
SILVER_BUCKETS = 32
PROCESSED_AT = "2001-12-01 00:00:00"
_TABLES = ("silver", "fato_movimentos", "dim_tribunais", "dim_classes", "dim_orgaos",
           "dim_calendario", "dim_assuntos")


@dataclass
class Gold:
    """One version of the gold tables. ``fact``, ``stored_silver``: given where they are not folders of ``root``."""

    spark: SparkSession
    root: str
    fact: DataFrame | None = None
    stored_silver: DataFrame | None = None
    sizes: dict[str, int] = field(default_factory=dict)

    def table(self, name: str) -> DataFrame:
        if name == "fato_movimentos":
            # explicit schema: the partition column is typed boolean, not inferred
            return self.fact if self.fact is not None else (
                self.spark.read.schema(FACT_DDL).parquet(f"{self.root}/{name}").select(*FACT_COLUMNS))
        if name == "silver":
            return self.stored_silver if self.stored_silver is not None else self.silver_by_bucket.select(*SILVER_COLUMNS)
        return self.spark.read.parquet(f"{self.root}/{name}")

    @property
    def fato(self) -> DataFrame:
        return self.table("fato_movimentos")

    @property
    def silver(self) -> DataFrame:
        return self.table("silver")

    @property
    def silver_by_bucket(self) -> DataFrame:
        """The batch-built silver with its ``bucket`` column, for look-ups of a case."""
        return self.spark.read.schema(f"{SILVER_DDL}, bucket int").parquet(f"{self.root}/silver")

    def tables(self) -> dict[str, DataFrame]:
        return {t: self.table(t) for t in _TABLES}

    def test_results(self) -> DataFrame:
        """The results of the data tests that this version passed."""
        return self.spark.read.schema(RESULT_DDL).parquet(f"{self.root}/tests")

    def dim(self, name: str, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
        """A dimension, broadcast only if its measured size is within bounds."""
        df = self.table(f"dim_{name}")
        if name not in self.sizes:
            self.sizes[name] = frame_bytes(df)
        return F.broadcast(df) if self.sizes[name] <= max_bytes else df


def _fingerprint(spark: SparkSession, sf_dir: str) -> str:
    h = hashlib.sha1(f"{LAYOUT_VERSION}:{sf_dir.rstrip('/')}".encode())
    for name in ("lineitem", "orders", "customer", "nation", "region"):
        h.update(f"{name}:{path_stamp(spark, f'{sf_dir}/{name}.parquet')}".encode())
    return h.hexdigest()[:16]


class Published:
    """The published version of a set of tables: numbered one-row files, of which the highest counts.

    A new version is a new file, so a reader or a crash never meets a missing pointer."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _numbers(self) -> list[int]:
        return sorted(int(n.removeprefix("n=")) for n in complete_children(self.spark, self.path))

    def current(self) -> dict | None:
        done = self._numbers()
        if not done:
            return None
        return self.spark.read.schema(POINTER_DDL).json(f"{self.path}/n={done[-1]}").first().asDict()

    def move(self, version: str, upto: int | None = None) -> None:
        done = self._numbers()
        (self.spark.range(1).select(F.lit(version).alias("version"), F.lit(upto).cast("long").alias("upto"),
                                    F.current_timestamp().alias("published_at"))
         .coalesce(1).write.mode("overwrite").json(f"{self.path}/n={done[-1] + 1 if done else 0}"))


def write_dims(spark: SparkSession, silver: DataFrame, bronze: DataFrame, root: str) -> None:
    """M1-M5 of a written silver and bronze: silver is read once, for its groups."""
    with shuffles_dropped(spark):
        silver_groups(silver).write.parquet(f"{root}/groups")
        groups = spark.read.parquet(f"{root}/groups")
        D.dim_tribunais(groups).write.parquet(f"{root}/dim_tribunais")
        D.dim_classes(groups).write.parquet(f"{root}/dim_classes")
        D.dim_orgaos(groups, spark.read.parquet(f"{root}/dim_tribunais")).write.parquet(f"{root}/dim_orgaos")
        D.dim_calendario(D.calendar_bounds(groups)).write.parquet(f"{root}/dim_calendario")
        D.dim_assuntos(bronze).write.parquet(f"{root}/dim_assuntos")


def check_gold(g: Gold, seen: Mapping[Test, int] | None = None) -> None:
    """Runs the data tests but for those ``seen`` while writing, and keeps the results with the version. Raises if
    an error-severity test fails (Q5); the caller publishes only after this returns."""
    with shuffles_dropped(g.spark):
        results = run_tests({t: g.table(t) for t in _TABLES if t != "silver"}, seen=seen)
        results.coalesce(1).write.mode("overwrite").parquet(f"{g.root}/tests")
    verdict = gate(g.test_results()).first()
    if not verdict["publish"]:
        raise RuntimeError(f"gold tests failed: {verdict['errors']} error test(s); not published")


def materialize(spark: SparkSession, sf_dir: str, hot_case_rows: int | None = 5_000_000,
                force: bool = False, fact=build_fact) -> Gold:
    """Write silver, then dimensions and fact from the written silver, as a new version that is
    published only after the data tests. A failed build leaves the version before it in place."""
    root = work_dir(spark, "gold", _fingerprint(spark, sf_dir))
    pointer = Published(spark, f"{root}/published")
    now = pointer.current()
    if now and not force:
        return Gold(spark, f"{root}/{now['version']}")
    version = uuid.uuid4().hex
    # hot cases are counted on lineitem's key column (cheap), so the joined
    # events are produced once, straight into the silver pass
    flat = fixtures.movements(spark, sf_dir)
    hot = None if hot_case_rows is None else fixtures.hot_cases(spark, sf_dir, hot_case_rows)
    events = silver_events(flat, hot_case_rows=hot_case_rows, hot=hot)
    # dealt and sorted before the columns that follow from a row alone are added
    dealt = (events.withColumn("bucket", bucket_of(F.col("numero_processo"), SILVER_BUCKETS)).hint("rebalance", "bucket")
             .sortWithinPartitions("bucket", "numero_processo"))
    with shuffles_dropped(spark):
        silver_columns(dealt, PROCESSED_AT, "bucket").write.partitionBy("bucket").parquet(f"{root}/{version}/silver")
    g = Gold(spark, f"{root}/{version}")
    write_dims(spark, g.silver, fixtures.subject_hits(spark, sf_dir), g.root)
    # the fact's tests are counted by the pass that writes it
    watch = Watch("fato_movimentos", {t: g.table(t) for t in _TABLES if t.startswith("dim_")})
    watch.over(fact(g.silver)).write.partitionBy("is_ultimo_movimento").parquet(f"{g.root}/fato_movimentos")
    check_gold(g, watch.seen())
    pointer.move(version)
    return g


_CACHE: dict[tuple[int, str], Gold] = {}
_LOCK = threading.Lock()


def gold(spark: SparkSession, sf_dir: str) -> Gold:
    """Materialised gold for ``sf_dir``, built once per session and input
    (queries issued from several threads wait for the one build)."""
    key = (id(spark), sf_dir.rstrip("/"))
    with _LOCK:
        g = _CACHE.get(key)
        if g is None or not path_exists(spark, f"{g.root}/fato_movimentos"):
            g = _CACHE[key] = materialize(spark, sf_dir)
        return g
