import pytest


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls, empty and long texts, ties, repeated rows, and extra columns with clashing names."""
    long = " ".join(f"wort{i % 977} text{i % 13}," for i in range(20_000))
    rows = [(1, "a b c d", "x", 0.5), (1, "a b c d", "x", 0.5), (2, None, None, None), (None, "a b c d", "y", 1.0), (3, "", "z", 0.1), (4, long, "z", 0.1), (5, long + " end", "z", None), (6, "\x00 ▁ é😀 <|endoftext|> token = 'abcdefghij0123456789'", "q", 2.0), (7, "A B C D", None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, score string, node double")


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string, score string, node double")
