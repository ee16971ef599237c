"""The corpus pipeline: documents through five operators of the training-data
subpackage, each stage written as Parquet and read again by the next.

Language ID rejects texts in no learned language; line dedup takes out lines
that repeat an earlier one; the n-gram Jaccard join keeps one document of each
group; decontamination drops documents with a benchmark passage; byte-level
BPE encodes what is left and decodes it again. All stages but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tramline.llm import bpe, decontaminate, jaccard_join, language_id, line_dedup
from tramline.llm.common import stored, table


def _tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.token_digests(docs)


STAGES = [
    ("language_id", language_id.keep_languages),
    ("line_dedup", line_dedup.drop_repeated_lines),
    ("jaccard_join", jaccard_join.keep_first),
    ("decontaminate", decontaminate.drop_contaminated),
    ("bpe", _tokens),
]

#: No twin in SQL: learned languages, edit distances and merges are not
#: expressible there. tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
