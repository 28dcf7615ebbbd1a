from __future__ import annotations

import pytest

SF = "/root/testdata/sf0.001"

#: Extra columns whose names operators use inside.
CLASH = "n LONG, sig LONG, key STRING, word STRING, row STRING, rid LONG, chunk INT, spans STRING, c LONG"


@pytest.fixture(autouse=True)
def package_on_workers(spark):
    from statforge.llm.common import on_workers

    on_workers(spark)


@pytest.fixture()
def docs_of(spark):
    """Documents from ``(doc_id, text)`` rows, with clashing extra columns."""

    def make(rows):
        more = (1, 2, "k", "w", "r", 3, 4, "s", 5)
        return spark.createDataFrame([(i, t, "en", "s", len(t or ""), *more) for i, t in rows], f"doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG, {CLASH}")

    return make


@pytest.fixture(scope="session")
def documents(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
