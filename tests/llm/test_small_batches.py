"""What the pipeline holds at once: Arrow batches bounded by bytes."""

import pyarrow as pa

import corpus_pipeline as C
from martcraft.llm.common import small_batches

CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def sizes(df):
    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], names=["rows", "bytes"])

    return df.mapInArrow(run, "rows long, bytes long").collect()


def test_stages_bound_batches_by_bytes(spark):
    docs = spark.range(6000).selectExpr(
        "id doc_id", "concat(id, repeat(' some words', 100)) text", "'en' lang", "'s' source", "1100 n_chars").coalesce(1)
    was = spark.conf.get(CONF)
    try:
        assert max(r.bytes for r in sizes(docs)) > 6_000_000
        C.secrets_stage(spark, docs, "").count()
        found = sizes(docs)
        assert sum(r.rows for r in found) == 6000 and max(r.bytes for r in found) < 2_100_000
        # a longer text is a batch alone; a session's smaller bound stays
        assert [r.rows for r in sizes(spark.range(3).selectExpr("repeat('x', 3000000) text").coalesce(1))] == [1, 1, 1]
        spark.conf.set(CONF, 500_000)
        small_batches(spark)
        assert spark.conf.get(CONF) == "500000"
    finally:
        spark.conf.set(CONF, was)
