import random

import pytest
from pyspark.sql import functions as F

CLASHES = ("_row", "_at", "size", "score", "keep_id", "whole", "class", "id", "n", "h", "rank", "label", "taken", "begin", "stats")


def words(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def nasty_rows():
    """Null, empty, blank, short, long, equal, near, repeated and marked-up texts."""
    rng = random.Random(3)
    base = words(rng, 120)
    near = base.split()
    near[5] = "other"
    passage = words(rng, 60, 100_000)
    rows = [
        (0, None, "a"), (1, "", "a"), (2, " \t\n", None), (3, "one", "b"), (4, "One ", "b"), (5, "a b c", "b"), (6, "A b  c", "c"),
        (7, base, "a"), (8, base + " ", "a"), (9, base, None), (10, " ".join(near), "a"), (11, words(rng, 15_000, 50_000), "hot"),
        (12, "x" * 5000, "hot"), (13, "é ü " * 300, "hot"), (14, passage + "\n" + words(rng, 30), "hot"),
        (15, words(rng, 30) + "\n" + passage, "hot"), (16, "line one\n\nline two\nline three", "hot"), (17, "<|endoftext|> it's 123!!", "hot"),
        (18, "tail " + words(rng, 400), None), (19, "tail " + words(rng, 400), None), (None, "no id at all " + words(rng, 20), "z"),
    ]
    return rows + [rows[7]]  # a row that is there twice


@pytest.fixture(scope="session")
def nasty(spark):
    df = spark.createDataFrame(nasty_rows(), "doc_id long, text string, source string")
    df = df.withColumn("lang", F.lit("en")).withColumn("n_chars", F.length("text").cast("long"))
    return df.select("*", *[F.lit(7).alias(x) for x in CLASHES]).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(nasty):
    return nasty.limit(0)


@pytest.fixture(scope="session")
def docs(spark, data):
    return spark.read.parquet(f"{data}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark, data):
    return spark.read.parquet(f"{data}/labels.parquet")
