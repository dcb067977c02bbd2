"""The queries on supplied tables: SQL oracles, columns and row counts."""

import duckdb
import pytest

from martcraft.llm import registry
from tests.helpers import bag

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op2_simhash": ["doc_id", "fingerprint", "component_id"],
    "op3_secrets": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op5_langid": ["doc_id", "held_out", "lang_pred", "score"],
    "op6_packing": ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
    "op7_topk": ["query_id", "rank", "vec_id", "score"],
    "op10_quality": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op11_chat": ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
    "op12_periodic": ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"],
    "op13_negatives": ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"],
}
#: One row a document.
PER_DOCUMENT = {"op1_toxicity", "op2_simhash", "op3_secrets", "op4_lm", "op5_langid", "op8_mixing", "op9_sharding", "op10_quality", "op12_periodic"}


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = registry.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(registry.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    assert bag(rows, df.columns) == bag(res.fetchall(), cols)


def test_columns_and_rows(spark):
    ids = sorted(r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect())
    queries = registry.queries()
    assert {n.split("_")[0] for n in queries} == {f"op{i}" for i in range(1, 14)}
    for name, query in queries.items():
        df = query(spark, SF)
        assert df.columns[:len(COLUMNS.get(name, []))] == COLUMNS.get(name, []), name
        if name in PER_DOCUMENT:
            assert sorted(r.doc_id for r in df.select("doc_id").collect()) == ids, name
