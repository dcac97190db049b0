"""The registered queries on the smallest tables, against DuckDB where SQL can say what they do, and the pipeline."""

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline
from period_etl.llm.queries import ORACLE_SQL, QUERIES
from tests.llm.test_native import brute_leaks
from tests.llm.test_near_dup import brute as groups
from tools.check_oracle import TABLES, digest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_all_are_registered():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(E.queries())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(ORACLE_SQL[name])
    columns = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(columns) and digest(df.columns, rows) == digest(columns, cur.fetchall())


def test_pipeline_equals_its_stages_by_brute_force(spark, duck, monkeypatch):
    kept, docs = {}, spark.read.parquet(f"{SF}/documents.parquet")
    store = corpus_pipeline.stored
    monkeypatch.setattr(corpus_pipeline, "stored", lambda df, label: kept.setdefault(label.removeprefix("pipeline-"), store(df, label)))
    encoded = corpus_pipeline.run(spark, SF)
    assert [name for name, _ in corpus_pipeline.STAGES] == list(kept)
    assert all(kept[name].columns == docs.columns for name, _ in corpus_pipeline.STAGES[:-1])
    left = [(r.doc_id, r.text) for r in kept["quality_rules"].collect()]
    want = {d for d, _, _, first in groups(left, 5) if first}
    assert {r.doc_id for r in kept["near_dedup"].collect()} == want
    items = [(i, (t or "").lower()) for i, t in duck.execute("SELECT item_id, text FROM benchmark").fetchall()]
    want -= {d for d, _ in brute_leaks([(d, t.lower()) for d, t in left if d in want], items)}
    assert {r.doc_id for r in kept["decontamination"].collect()} == want == {r.doc_id for r in encoded.collect()}
    labels = dict(duck.execute("SELECT doc_id, quality FROM labels").fetchall())
    assert all(labels.get(d, 1) == 1 for d, _ in left)
