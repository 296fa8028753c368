import random

import pytest


def edge_rows():
    """(doc_id, text): nulls, empty and very long texts, ties, repeated rows, odd white space."""
    rng = random.Random(3)
    words = ["alpha", "beta", "Gamma", "delta", "été", "straße", "中文", "x1", "the", "of"]
    sentence = [" ".join(rng.choice(words) for _ in range(rng.randint(3, 30))) for _ in range(12)]
    rows = [(i, s) for i, s in enumerate(sentence)]
    rows += [(20, sentence[0]), (21, sentence[0].replace(" ", "\t ")), (22, sentence[1] + " "), (23, " " + sentence[1])]
    rows += [(30, None), (31, None), (32, ""), (33, " "), (34, "\n\n"), (35, " \x0b\x0c"), (36, "\x1c \x85 \xa0")]
    rows += [(40, sentence[2]), (40, sentence[2]), (None, sentence[3]), (None, sentence[3]), (None, None)]
    rows += [(50, "word " * 60_000), (51, "y" * 200_000), (52, "🙂 ﬁ İ ǅ <|endoftext|> <|startoftext|> é")]
    rows += [(60 + i, f"head {i}\n  This line is shared by many of them  \ntail {i}") for i in range(5)]
    rows += [(70, "THIS LINE is shared by many of them\nTHIS LINE is shared by many of them\nown line of seventy here")]
    return rows


@pytest.fixture(scope="session")
def edge_docs(spark):
    """The edge rows over a few partitions, with extra columns whose names the operators use inside."""
    rows = [(i, t, i, "a", 1, t, True, 0, 2.0, "n") for i, t in edge_rows()]
    return spark.createDataFrame(
        rows, "doc_id long, text string, id long, run string, owner int, norm string, kept boolean, row int, "
              "score double, n string").repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")


@pytest.fixture(scope="session")
def small_docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
