"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statforge.llm import bilinear_lm, decontaminate, digest_merge, filter_audit, periodic_runs, pieces, pii_bootstrap, quality_rules, quality_svm, reply_trees, secret_scan, shingle_join, web_archive
from statforge.llm.common import table


def piece_model() -> str:
    """The public merge-type vocabulary file; its path is a parameter of the operator."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_pii_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_bootstrap.digest(table(spark, sf_dir, "documents"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_svm.score(docs, quality_svm.fit(docs, table(spark, sf_dir, "labels")))


def op3_bilinear_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bilinear_lm.score_documents(table(spark, sf_dir, "documents"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_rules.judge(docs, quality_rules.fit(docs, table(spark, sf_dir, "labels")))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digest(table(spark, sf_dir, "documents"), piece_model())


#: Fixed value of the contract: the text of both turns of the additional conversation -7.
CONTROL_TEXT = r"\### Assistant: </turn> ok"


def op8_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    more = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL_TEXT).alias("text")
    )
    return reply_trees.format_conversations(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more))


def op9_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingle_join.link_groups(table(spark, sf_dir, "documents"))


def op10_web_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return web_archive.round_trip(table(spark, sf_dir, "pages"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.find_runs(table(spark, sf_dir, "documents"))


def op13_digest_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_merge.duplicate_groups(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_pii_bootstrap,
        op2_quality_classifier,
        op3_bilinear_lm,
        op4_secret_scan,
        op5_quality_rules,
        op6_decontamination,
        op7_sentencepiece,
        op8_reply_trees,
        op9_shingle_join,
        op10_web_archive,
        op11_filter_audit,
        op12_periodic_runs,
        op13_digest_merge,
    )
}
