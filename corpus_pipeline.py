"""From raw documents to token ids: five stages, each on all that the one before kept.

Rows are named by ``doc_id`` and a key of all their columns, so documents that share an id
are judged each by itself. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankfold.llm import disguised_data, edit_matches, host_rules, piece_merging, simhash_groups
from rankfold.llm.common import inner_tables, only_rows, with_row_key, written
from rankfold.sources.tables import read_table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the rules go, and those of suspect hosts that fail stricter ones."""
    keyed, key = with_row_key(docs)
    kept = host_rules.judge(keyed, host="source", keys=("doc_id", key)).where("kept")
    return only_rows(keyed, key, kept, "left_semi")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of fingerprints within two bits the document with the least id stays.

    A null id counts as the greatest; documents with equal ids go by a hash of their columns,
    and of rows repeated whole one stays.
    """
    keyed, key = with_row_key(docs)
    linked = simhash_groups.link_fingerprints(keyed, max_bits=2, keys=("doc_id", key))
    least = F.min(F.struct(F.isnull("doc_id").alias("no_id"), F.col("doc_id"), F.col(key))).alias("least")
    kept = linked.groupBy("root").agg(least).select("least.*")
    rows = only_rows(keyed, key, kept, "left_semi")
    if linked.groupBy("doc_id", key).count().where("count > 1").limit(1).count():
        again, name = with_row_key(rows)
        rows = again.dropDuplicates(["doc_id", name]).drop(name)
    return rows


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, with edits or without, go."""
    keyed, key = with_row_key(docs)
    items = read_table(spark, sf_dir, "benchmark")
    found = edit_matches.find_items(keyed, items, share=5, keys=("doc_id", key))
    return only_rows(keyed, key, found.select("doc_id", key).distinct(), "left_anti")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data, plain or disguised, is masked."""
    return disguised_data.mask_texts(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, token ids, their number, and digests of ids and of what they decode to."""
    return piece_merging.encode_texts(docs, public_tokenizers.path("piece_bpe_32k.model"), ids=True)


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal data", personal_data),
    ("encoding", encoding),
]

#: Encoding and fingerprints cannot be said in SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with inner_tables(spark):
            docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"), keep=True)
    return STAGES[-1][1](spark, docs, sf_dir)
