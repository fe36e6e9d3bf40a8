import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows, parts=3):
    """documents with clashing extra columns from (doc_id, text[, source])."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
    df = spark.createDataFrame(full, DOCS)
    return df.selectExpr("*", "1 AS unit", "2 AS size", "3 AS key", "'x' AS part").repartition(parts) if rows \
        else df.selectExpr("*", "1 AS unit", "2 AS size", "3 AS key", "'x' AS part")


def prose(seed, n, vocab=400):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocab)}{'.' if r.random() < .1 else ''}" for _ in range(n))


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
