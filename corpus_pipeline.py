"""A training-text pipeline over ``documents``: five stages, each one operator of ``statforge.llm``.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which
:func:`run` writes to the shared folder and reads again as the next stage's
documents. All stages but the last return the columns of ``documents``.

1. ``quality``      documents that the quality classifier predicts bad are dropped
2. ``near_copies``  of each group of documents linked by five-word shingles one stays
3. ``benchmark``    documents that hold a passage of a test item are dropped
4. ``personal``     personal data are replaced by the name of their kind
5. ``pieces``       texts are encoded, and decoded again

Documents without a text pass stages 2 to 5; rows that repeat a document id share
what is decided about that id, and of rows that repeat the id that a group keeps,
all stay. Empty tables pass through; extra columns are dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statforge.llm import decontaminate, pieces, pii_bootstrap, quality_svm, shingle_join
from statforge.llm.common import materialise, on_workers, table
from statforge.llm.queries import piece_model

#: Columns of ``documents``.
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _with(docs: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """Documents whose id is (``left_semi``) or is not (``left_anti``) among ``ids``; a null id equals a null id."""
    named = ids.select(F.col(ids.columns[0]).alias("chosen")).distinct()
    return docs.join(named, docs["doc_id"].eqNullSafe(named["chosen"]), how).select(*COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the quality classifier, trained on the given documents' labels, predicts bad."""
    on_workers(spark)
    model = quality_svm.fit(docs, table(spark, sf_dir, "labels"))
    return quality_svm.filtered(docs, model).select(*COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of every group."""
    on_workers(spark)
    groups = shingle_join.link_groups(docs)
    return _with(docs, groups.where(~F.col("doc_id").eqNullSafe(F.col("component_id"))), "left_anti")


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that a test item contaminates."""
    on_workers(spark)
    return _with(docs, decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark")), "left_anti")


def personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Put the name of its kind in place of every span of personal data."""
    on_workers(spark)
    return pii_bootstrap.redacted(docs).select(*COLUMNS)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode and decode: number of ids, digests of the ids and of the decoded text."""
    on_workers(spark)
    return pieces.digest(docs, piece_model())


STAGES = [("quality", quality), ("near_copies", near_copies), ("benchmark", benchmark), ("personal", personal), ("pieces", encoded)]

#: SQL can express neither the trained classifier nor the encoding; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
