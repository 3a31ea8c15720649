import random

import duckdb
import pandas as pd
import pytest
import sentencepiece

import corpus_pipeline as C
from docketline.llm.components import components
from docketline.llm.queries import ORACLE, QUERIES
from tests.llm.test_dedup import brute_components, brute_lines
from tests.llm.test_models import MODEL, toxic_rows
from tests.llm.test_warc_decontaminate import brute_hits, item_words
from tests.llm.util import prose

SMALL = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_match_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    want = con.execute(ORACLE[name])
    cols = [c[0] for c in want.description]
    got = QUERIES[name](spark, SMALL)
    assert sorted(got.columns) == sorted(cols)
    assert sorted(map(tuple, got.select(*cols).collect()), key=repr) == sorted(want.fetchall(), key=repr)



def test_components_of_chains_and_stars(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 200)] + [(1000 + rng.randrange(40), 1000 + rng.randrange(40)) for _ in range(25)]
    group = {x: x for e in edges for x in e}
    for _ in range(70):
        for a, b in edges:
            group[a] = group[b] = min(group[a], group[b])
    got = components(spark.createDataFrame([*edges, *[(b, a) for a, b in edges]], "a long, b long"), "test").collect()
    loops = {a for a, b in edges if a == b} - {x for a, b in edges if a != b for x in (a, b)}
    assert sorted(map(tuple, got)) == sorted((x, g) for x, g in group.items() if x not in loops)
    assert components(spark.createDataFrame([], "a long, b long"), "test").count() == 0


@pytest.fixture(scope="module")
def corpus(tmp_path_factory):
    """A small folder of tables: clean and toxic texts, shared lines, near copies, benchmark passages."""
    folder = tmp_path_factory.mktemp("corpus")
    toxic = toxic_rows(400)
    docs = [(i, t) for i, t, _ in toxic]
    items = [(k, prose(7000 + k, 15, 10**6)) for k in range(5)]
    for i in range(400, 460):
        t = prose(i, 60, 10**6)
        if i % 3 == 0:
            t = "shared line of all\n" + t
        if i % 7 == 0:
            w = t.split(" ")
            w[30:30] = items[i % 5][1].split()
            t = " ".join(w)
        docs.append((i, t))
        if i % 5 == 0:
            docs.append((i + 1000, t + " more"))
    docs += [(3000, None), (3001, ""), (3002, items[0][1])]
    frame = pd.DataFrame(docs, columns=["doc_id", "text"])
    frame["lang"], frame["source"], frame["n_chars"] = "en", "s", [len(t or "") for _, t in docs]
    frame.to_parquet(folder / "documents.parquet", index=False)
    pd.DataFrame([(i, 1, y) for i, _, y in toxic], columns=["doc_id", "quality", "toxic"]).to_parquet(folder / "labels.parquet", index=False)
    pd.DataFrame(items, columns=["item_id", "text"]).to_parquet(folder / "benchmark.parquet", index=False)
    return str(folder), items, {i: y for i, _, y in toxic}


def test_stages_against_brute_force(spark, corpus):
    folder, items, label = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    at = {}
    for name, stage in C.STAGES:
        docs = stage(spark, docs, folder).cache()
        at[name] = {r.doc_id: r for r in docs.collect()}
        if name != "sentencepiece":
            assert docs.columns == COLUMNS
            assert all(r.n_chars == len(r.text or "") for r in at[name].values())
    first = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    clean = [d for d, _ in first if not label.get(d)]
    left = at["toxicity"]
    assert len([d for d in clean if d in left]) >= 0.97 * len(clean)
    assert len([d for d in label if label[d] and d in left]) <= 0.05 * sum(label.values())
    rows = [(d, t) for d, t in first if d in left]
    want = {d: kept for d, _, _, kept in brute_lines(rows, 10)}
    assert {d: r.text for d, r in at["line_dedup"].items()} == want and any("shared line" in (t or "") for _, t in rows)
    comp = {d: c for d, _, c in brute_components([(d, r.text) for d, r in at["line_dedup"].items()])}
    assert set(at["near_duplicates"]) == {d for d, c in comp.items() if d == c} != set(comp)
    before = at["near_duplicates"]
    hits = {d: (n, h) for d, n, h, _ in brute_hits([(d, r.text) for d, r in before.items()], items, 10)}
    after = at["benchmark_decontamination"]
    assert set(after) == {d for d, (n, h) in hits.items() if not h or h < 0.5 * n} and 3002 not in after
    for d, r in after.items():
        n, h = hits[d]
        assert len(item_words(r.text)) == n - h and (h or r.text == (before[d].text or ""))
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    assert {d: r.ids for d, r in at["sentencepiece"].items()} == {d: sp.encode(r.text or "", add_eos=True) for d, r in after.items()}


def test_run_gives_the_last_stage(spark, corpus):
    got = C.run(spark, corpus[0])
    assert got.columns == ["doc_id", "n_tokens", "ids"] and got.count() > 300
    assert got.where("n_tokens <> size(ids)").count() == 0


def test_near_duplicates_keep_one_row_of_each_group(spark):
    base = prose(1, 100, 10**6)
    near = base.replace(base.split()[50], "changed")
    other = prose(2, 100, 10**6)
    rows = [(None, base), (None, near), (None, base), (5, other), (5, other), (5, other.replace(other.split()[20], "x")), (6, other),
            (7, None), (7, None), (8, ""), (None, ""), (9, "short text"), (10, "Short text"), (3, prose(3, 50))]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = C.near_duplicates(spark, docs, SMALL).collect()
    ids = sorted((r.doc_id for r in got), key=repr)
    assert ids == sorted([None, 5, 7, 8, None, 9, 3], key=repr) and got[0].__fields__ == COLUMNS
    assert len({r.text for r in got if r.doc_id is None}) == 2


@pytest.mark.parametrize("name,stage", C.STAGES)
def test_stages_take_an_empty_table(spark, name, stage):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    assert stage(spark, docs, SMALL).count() == 0
