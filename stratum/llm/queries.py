"""Named queries of this package: whole driver table in, full result out; and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracle
from .chat import formatted, read_back
from .chunks import repeated_spans
from .decontaminate import contaminated
from .licences import licence_paragraphs
from .lm import pseudo_likelihood
from .minhash import near_duplicates
from .negatives import hard_negatives
from .packing import packed
from .quality import quality
from .ranked import ranked
from .sharding import sharded
from .tokens import token_counts
from .urls import filter_urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = dict(oracle.SQL)


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op5_bbit_minhash(spark, sf_dir):
    return near_duplicates(_table(spark, sf_dir, "documents"), width=2, percent=80)


@query
def op9_spaced_seeds(spark, sf_dir):
    return contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@query
def op10_gear_chunks(spark, sf_dir):
    return repeated_spans(_table(spark, sf_dir, "documents"))


@query
def op1_length_buckets(spark, sf_dir):
    return packed(_table(spark, sf_dir, "documents"), buckets=8, token_budget=16384)


@query
def op4_token_counts(spark, sf_dir):
    import public_tokenizers

    return token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=1024)


@query
def op7_pseudo_likelihood(spark, sf_dir):
    return pseudo_likelihood(_table(spark, sf_dir, "documents"))


@query
def op2_adaptive_quality(spark, sf_dir):
    return quality(_table(spark, sf_dir, "documents"))


@query
def op6_boosted_urls(spark, sf_dir):
    return filter_urls(_table(spark, sf_dir, "pages").select("page_id", "url"))


@query
def op8_chat_machine(spark, sf_dir):
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = "</s>[INST] ok [/INST]"
    turns = turns.unionByName(spark.createDataFrame(
        [(-1, 0, "user", probe), (-1, 1, "assistant", probe)], "conv_id long, turn long, role string, text string"))
    return read_back(formatted(turns))


@query
def op3_licence_paragraphs(spark, sf_dir):
    return licence_paragraphs(_table(spark, sf_dir, "documents"))


@query
def op11_dual_tree(spark, sf_dir):
    return ranked(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), k=50)


@query
def op12_best_fit(spark, sf_dir):
    return sharded(_table(spark, sf_dir, "documents"), shards=40).drop("text_md5")


@query
def op13_residue_negatives(spark, sf_dir):
    vectors = _table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.withColumn("label", label), F.col("vec_id") % 50 == 0)
