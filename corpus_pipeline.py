"""From raw documents to encoded training text, in five stages.

Every stage is one operator of ``opsreport.llm`` and takes ``(spark, docs, sf_dir)``; what it
returns is written as Parquet in the folder that the executors share, and read again as the
next one's ``docs``. Each stage works on all rows its predecessor kept.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from opsreport.llm.common import table, written
from opsreport.llm.line_dedup import drop_boilerplate
from opsreport.llm.mixing import mixed_documents, quality_domains
from opsreport.llm.order_minhash import keep_one_of_each
from opsreport.llm.quality import keep_good
from opsreport.llm.queries import WEIGHTS
from opsreport.llm.segmentation import segmentations

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the compression bands."""
    return keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the boilerplate lines of their source; copies are one page, as near dedup
    has yet to drop them."""
    return drop_boilerplate(docs, by_text=True)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return keep_one_of_each(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its rate asks for, so that the words of the domains match the
    target weights."""
    return mixed_documents(docs, quality_domains(table(spark, sf_dir, "labels")), WEIGHTS)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id and the digest of the N best segmentations of each text."""
    return segmentations(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("mixing", mixing),
    ("encoding", encoding),
]

#: The bands, the alignment and the encoding have no equal in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
