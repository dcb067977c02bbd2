"""One query for each operator, over whole tables, with production parameters."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martcraft.llm import (
    chat,
    langid,
    lm,
    mixing,
    negatives,
    oracle,
    packing,
    periodic,
    quality,
    secrets,
    sharding,
    simhash,
    topk,
    toxicity,
)
from martcraft.llm.common import read


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"), words=4, max_distance=4)
    return found.select("doc_id", simhash.hex_digits().alias("fingerprint"), "component_id")


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random")


def op4_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(read(spark, sf_dir, "documents"))


def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(read(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"))


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.quantize(read(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors, F.col("vec_id") % 50 == 0, topk.SearchRules(k=5))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(read(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(read(spark, sf_dir, "documents"))


def op11_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = ["conv_id", "turn", "role", "text"]
    marks = F.lit("</s>[INST] ok [/INST]")
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), marks.alias("text"))
    template = chat.Template()
    chats = chat.format_chats(read(spark, sf_dir, "conversations").select(*cols).unionByName(extra), template)
    back = chats.select("conv_id", template.read_back(F.col("formatted")).alias("turns"), template.learned(F.col("segments")).alias("learned"),
                        F.length("formatted").cast("long").alias("formatted_chars"), "in_order")
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                       F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
                       "formatted_chars", "in_order")


def repeats(doc_id, n: int) -> np.ndarray | None:
    """The contract's planted repetitions: word numbers in a tenth of the
    documents, chosen by crc32 of the id; a null id has none."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    order = np.arange(n)
    order[a:] = a + (order[a:] - a) % p
    return order


def op12_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.find_runs(read(spark, sf_dir, "documents"), rewrite=repeats).withColumn("best", periodic.strongest())
    listed = F.array_join(F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))), "")
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
                        F.expr("1000L * best.length div best.period").alias("exponent_milli"),
                        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = negatives.labelled(read(spark, sf_dir, "embeddings"), label)
    return negatives.mine(rows, F.col("vec_id") % 50 == 0)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_toxicity": op1_toxicity,
        "op2_simhash": op2_simhash,
        "op3_secrets": op3_secrets,
        "op4_lm": op4_lm,
        "op5_langid": op5_langid,
        "op6_packing": op6_packing,
        "op7_topk": op7_topk,
        "op8_mixing": op8_mixing,
        "op9_sharding": op9_sharding,
        "op10_quality": op10_quality,
        "op11_chat": op11_chat,
        "op12_periodic": op12_periodic,
        "op13_negatives": op13_negatives,
    }


def oracle_sql() -> dict[str, str]:
    """The others have a hash, a tokenizer or a trained model that SQL lacks;
    their tests compare them with brute force."""
    return {
        "op7_topk": oracle.top_k_sql(50),
        "op10_quality": oracle.quality_sql(),
        "op11_chat": oracle.chat_sql(),
        "op13_negatives": oracle.negatives_sql(50),
    }
