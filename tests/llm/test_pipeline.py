from pathlib import Path

import duckdb
import pytest

import corpus_pipeline
from tests.llm.conftest import ODD
from tramline.llm import queries
from tramline.llm.common import materialise

DATA = Path("/root/testdata/sf0.001")
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "quality classifier", "near-duplicates", "mixing", "tokens"]
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id for r in docs.select("doc_id").collect()}
        docs = materialise(stage(spark, docs, str(DATA)))
        after = {r.doc_id for r in docs.select("doc_id").collect()}
        assert docs.columns == COLUMNS and after <= before and after
    texts = [r.text for r in docs.collect()]
    out = corpus_pipeline.STAGES[-1][1](spark, docs, str(DATA))
    assert out.filter("sample = 1").count() == len(texts) and out.filter("not round_trip").count() == 0


def test_odd_documents(spark, odd, empty):
    for docs in (odd.select(*COLUMNS), empty.select(*COLUMNS)):
        for _, stage in corpus_pipeline.STAGES:
            docs = materialise(stage(spark, docs, str(DATA)))
    assert docs.count() == 0


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    plain = lambda df: sorted(tuple(None if v is None or v != v else round(v, 6) if isinstance(v, float) else v for v in r) for r in df[sorted(df.columns)].itertuples(index=False))
    assert plain(queries.QUERIES[name](spark, str(DATA)).toPandas()) == plain(con.execute(queries.SQL[name]).df())


def test_odd_rows_have_unique_meaning():
    assert len({i for i, *_ in ODD}) == len(ODD) - 1
