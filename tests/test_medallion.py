import json
import os
import tempfile
import uuid

import pytest
from pyspark.sql import functions as F

from docketline.operators.merge import CaseTable
from docketline.plans.fact import build_fact
from docketline.plans.medallion import Medallion
from docketline.plans.silver import build_silver
from docketline.plans.warehouse import materialize
from docketline.schemas import SILVER_DDL
from docketline.session import ensure_checkpoint_dir, work_dir
from docketline.sources import fixtures

from .conftest import SF_SMALL
from .helpers import ev, flat

STAMP = "2022-01-01"


def hit(case, *movs, court="TJRS", **more):
    return {"_id": f"{case}-{uuid.uuid4().hex}", "sort": [1], "_source": {
        "numeroProcesso": case, "tribunal": court, "grau": "G1", "dataAjuizamento": "2020-01-01",
        "classe": {"codigo": 1, "nome": "Classe"}, "orgaoJulgador": {"codigo": 10, "nome": "Vara"}, "nivelSigilo": 0,
        "movimentos": [{"codigo": c, "nome": n, "dataHora": f"{d}T00:00:00.000Z"} for c, n, d in movs],
        "assuntos": ['{"codigo": 5, "nome": "Assunto"}'], **more}}


def land(root, name, *lines, court="TJRS"):
    folder = f"{root}/landing/{court}"
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.json", "w") as f:
        f.write("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines) + "\n")
    return f"{folder}/{name}.json"


@pytest.fixture
def root(tmp_path):
    return str(tmp_path)


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def test_new_field_reload_and_rejects_through_the_flow(spark, root):
    first = land(root, "one", hit("A", (1, "alt", "2020-01-01")), '{"_id": "broken', hit("B", (1, "b", "2020-01-02")))
    p = Medallion(spark, root, STAMP)
    p.ingest(f"{root}/landing/*/*.json")
    assert p.silver().count() == 2 and p.rejects().count() == 1
    assert p.bronze_report().first().failures == 1
    land(root, "two", hit("A", (2, "c", "2020-02-01"), nova="x"))
    p = Medallion(spark, root, STAMP)                          # as in a new session
    p.ingest(f"{root}/landing/*/*.json")
    p.ingest(f"{root}/landing/*/*.json")                       # nothing new
    assert p.bronze_table.batches() == [0, 1]
    assert rows(p.bronze(), "_source.nova") == [("x",), (None,), (None,)]
    land(root, "one", hit("A", (1, "neu", "2020-01-01")))      # the file is replaced, and loaded by force
    p.reload(first)
    assert p.bronze().count() == 4
    assert rows(p.silver(), "numero_processo", "codigo_movimento", "nome_movimento", "dias_desde_ultimo_movimento") == [
        ("A", 1, "neu", None), ("A", 2, "c", 31), ("B", 1, "b", None)]
    p.publish()
    fact = p.gold().fato
    p.fold()
    assert rows(p.fact_table.read(), *fact.columns) == rows(fact, *fact.columns) and fact.count() == 3


def test_failed_tests_keep_published_version(spark, root):
    land(root, "one", hit("A", (1, "a", "2020-01-01")))
    p = Medallion(spark, root, STAMP)
    p.ingest(f"{root}/landing/*/*.json")
    v1 = p.publish()
    assert p.gold().root.endswith(v1) and p.gold().fato.count() == 1
    # a case without a court breaks the fact's not_null(fk_tribunal) error test
    land(root, "two", hit("B", (1, "b", "2020-01-01"), court=None))
    p.ingest(f"{root}/landing/*/*.json")
    with pytest.raises(RuntimeError):
        p.publish()
    assert p.gold().root.endswith(v1) and p.gold().fato.count() == 1   # the fact as of that version, too


def test_failed_rebuild_is_not_served(spark):
    good = materialize(spark, SF_SMALL)
    with pytest.raises(RuntimeError):
        materialize(spark, SF_SMALL, force=True, fact=lambda s: build_fact(s).withColumn("fk_tribunal", F.lit(None).cast("string")))
    assert materialize(spark, SF_SMALL).root == good.root
    assert good.fato.where("fk_tribunal is null").count() == 0


def table(spark):
    return CaseTable(spark, work_dir(spark, "t", uuid.uuid4().hex), "numero_processo", SILVER_DDL)


def rebuild(rows):
    return build_silver(rows, processed_at=STAMP)


def everything(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_merges_are_null_safe_and_order_free(spark):
    old = flat(spark, [ev(None, 1, "2020-01-01", name="OLD"), ev("A", 1, "2020-01-01", name="OLD"), ev("A", 2, "2020-01-05"),
                       ev("B", 1, None)], "2021-01-01")
    new = flat(spark, [ev(None, 1, "2020-01-01", name="NEW"), ev("A", 1, "2020-01-01", name="NEW"), ev(None, 2, "2020-02-01")],
               "2021-02-01")
    full = everything(rebuild(old.unionByName(new)))
    for order in ((old, new), (new, old), (old.limit(0), new, old, new)):
        t = table(spark)
        for i, b in enumerate(order):
            t.merge(i, b, rebuild)
        assert everything(t.read()) == full
        t.fold()
        assert everything(t.read()) == full
        t.merge(len(order), old, rebuild)                      # a delta over a base
        assert everything(t.read()) == full


def test_interrupted_write_and_replay(spark):
    t = table(spark)
    t.merge(0, flat(spark, [ev("A", 1, "2020-01-01"), ev("B", 1, "2020-01-01")], "2021-01-01"), rebuild)
    before = everything(t.read())
    second = flat(spark, [ev("A", 2, "2020-02-01")], "2021-02-01")
    t.merge(1, second, rebuild)
    after = everything(t.read())
    # a crash after the rows were written but before the commit: the batch is not seen, and a replay completes it
    from docketline.session import delete_path
    delete_path(spark, f"{t.path}/delta/seq=1~1/_SUCCESS")
    assert everything(t.read()) == before and t.sources() == {"0"}
    t.merge(1, second, rebuild)
    assert everything(t.read()) == after
    t.merge(1, second, rebuild)
    assert everything(t.read()) == after


def test_small_batch_writes_little(spark):
    t = table(spark)
    m = fixtures.movements(spark, SF_SMALL).withColumn("data_ingestao", F.to_timestamp(F.lit("2021-01-01")))
    t.merge(0, m, rebuild)
    some = [r[0] for r in m.select("numero_processo").distinct().orderBy("numero_processo").limit(15).collect()]
    t.merge(1, m.where(F.col("numero_processo").isin(some)).withColumn("data_ingestao", F.to_timestamp(F.lit("2021-02-01"))), rebuild)
    written = t.delta(1).count()
    assert written == m.where(F.col("numero_processo").isin(some)).count() < 0.02 * t.read().count()
    t.fold()
    t.clean()
    assert t.deltas() == [] and t.read().count() == m.count()
    case = some[3]
    assert everything(t.read_case(case)) == everything(t.read().where(F.col("numero_processo") == case))


def test_streamed_dominant_case_is_split(spark, root):
    movs = [(k % 90, f"m{k}", f"20{10 + k // 300}-{1 + k // 28 % 12:02d}-{1 + k % 28:02d}") for k in range(2000)]
    land(root, "one", *[hit("HOT", *movs[i:i + 100]) for i in range(0, 1500, 100)], *[hit(f"C{i}", (1, "x", "2020-01-01")) for i in range(30)])
    p = Medallion(spark, root, STAMP, hot_case_rows=200, slice_rows=150)
    p.ingest(f"{root}/landing/*/*.json")
    land(root, "two", *[hit("HOT", *movs[i:i + 100]) for i in range(1500, 2000, 100)], hit(None, (1, "n", "2020-01-01")))
    p.ingest(f"{root}/landing/*/*.json")
    plain = Medallion(spark, tempfile.mkdtemp(dir=root), STAMP, hot_case_rows=None)
    plain.ingest(f"{root}/landing/*/*.json")
    cols = [c for c in p.silver().columns if c != "data_ingestao"]
    assert rows(p.silver(), *cols) == rows(plain.silver(), *cols)


def test_checkpoint_dir_is_required_off_local_mode(spark):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext, conf = Context(), {}

    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(Session())


def test_changed_input_changes_the_fingerprint(spark, root):
    from docketline.plans.warehouse import _fingerprint
    spark.range(5).write.parquet(f"{root}/orders.parquet")
    one = _fingerprint(spark, root)
    assert one == _fingerprint(spark, f"file://{root}".replace("file://", ""))
    spark.range(500).write.mode("overwrite").parquet(f"{root}/orders.parquet")
    assert _fingerprint(spark, root) != one
