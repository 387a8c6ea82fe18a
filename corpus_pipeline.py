"""The corpus pipeline: documents in, sharded training documents out.

Every stage calls one operator of ``ledgerline.llm`` and works on all rows
that the stage before it kept. Stages read Parquet and return a DataFrame
that is written as Parquet for the next one; all but the last return the
columns of ``documents``. A stage's result must be written before the next
stage is called: the call deletes the tables that the stage before it left in
the shared folder, so that disk does not add up over the stages.

1. ``quality_rules``: weak supervision; documents that the base rules or the
   posterior reject go.
2. ``simhash_near_dedup``: three-word shingles, two bits; the document with
   the smallest id of each group stays.
3. ``benchmark_decontamination``: documents that hold a benchmark item (0.8 of
   its five-word shingles) go.
4. ``mix_sources``: every document is repeated as often as the mix takes it.
5. ``hash_ring_shards``: adds size, shard and slot.

Null columns, empty texts, repeated rows, empty tables and extra columns are
treated as each operator's docstring says. SQL cannot express the stages
(expectation-maximisation, connected components, the knapsack and the ring),
so there is no ``ORACLE_SQL``; ``tests/llm`` holds the whole run against a
brute-force version.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from threading import get_ident

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import decontamination, mixing, quality, ring, simhash
from ledgerline.llm.common import col, drop_tables, recorded, stage_table, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: Tables that the last stage of a thread wrote on its way.
_LEFT: dict[int, list[str]] = {}


def _stage(f: Stage) -> Stage:
    @wraps(f)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        drop_tables(spark, _LEFT.pop(get_ident(), []))
        with recorded() as tables:
            out = f(spark, docs, sf_dir)
        _LEFT[get_ident()] = tables
        return out

    return run


@_stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


@_stage
def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_duplicates(docs)


@_stage
def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


@_stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


@_stage
def hash_ring_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    placed = ring.assign(docs)
    p = col(placed.columns[-1])
    return placed.select(*[col(c) for c in docs.columns], F.lit("rows").alias("law"),
                         *[p[c].alias(c) for c in ("size", "shard", "slot")])


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("mix_sources", mix_sources),
    ("hash_ring_shards", hash_ring_shards),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each result is written to the shared folder and read again."""
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES:
        with recorded() as mine:
            docs = stage_table(stage(spark, docs, sf_dir), name)
        drop_tables(spark, before)
        before = mine
    return docs
