"""A training-data pipeline over ``documents``: rules, near-duplicates, benchmark
passages, mixing, token files.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor
kept, and returns a DataFrame; all but the last return the columns of ``documents``.
``run`` writes each stage's result to the shared folder and reads it again.
"""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cardsentry.llm import decontaminate, mixing, neardup, quality, queries, tokens
from cardsentry.llm.common import stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor the learned ones reject.

    Null and empty texts fail the base rules; long texts are measured whole; repeated
    rows go or stay together.  Without labels only the base rules hold; an empty table
    gives no rows.  All columns of ``docs`` are returned, whatever their names."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each group of near copies.

    A row goes by its own id and text: two texts under one id are two documents, and
    each keeps a row.  Rows without id and rows without words stay; identical rows
    stay together.  An empty table gives no rows."""
    return neardup.distinct_documents(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark windows cover less than a twentieth.

    Null and empty texts stay; items without id count as items, items without words
    don't; long texts are matched whole; repeated rows have one fate.  An empty
    benchmark removes nothing."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the target weights ask for: up to 4 epochs, 90 % of the tokens there are.

    A null language or source is a leaf of its own; texts without words come with each
    epoch; identical rows are taken together; rows without id spread over the order.
    An empty table gives no rows."""
    return mixing.mixed(docs, queries.mix_domain(), queries.MIX_WEIGHTS, budget_permille=900, max_epochs=4, seed=1)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mixture; a row for each document read back.

    Null and empty texts are the end id alone; repeated rows are written as often as
    they come; rows without id are first.  An empty table gives no rows."""
    return tokens.token_output(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)


STAGES = [("quality_rules", quality_rules), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("mix_sources", mix_sources), ("token_ids", token_ids)]

#: Rules are learned and near-duplicates need components: tests/llm/test_pipeline_run.py holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
