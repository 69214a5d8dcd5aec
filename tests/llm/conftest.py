import random

import pytest

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


def _odd_texts():
    rng = random.Random(5)
    words = ["the", "of", "und", "Haus", "maison,", "été", "ñandú", "x", "1.5", "\u3000", "<|endoftext|>", "a\u00a0b", "emoji\U0001f600"]
    prose = " ".join(rng.choice(words) for _ in range(300))
    passage = "This passage stands in several of these documents, word for word, and is longer than fifty bytes. "
    return [
        None, "", " ", "\n\n \t ", "a", "one two", prose, prose, prose + " end", passage + "head " + prose[:200], "tail " + passage * 2,
        passage, passage, "aaaa" * 200, "aaaa" * 190 + "b", "ab " * 300, "12 34 !!! ###", "x" * 70_000, prose * 40, "line one\nline two\nline one\n\nline two",
        "\u0130stanbul \u00df \u01c5 " * 30, passage.upper(), "same words here again " * 40, "a\x00b\x00" * 60, "\u00e9" * 120, "\u00e9" * 121, "z" + "\u00e9" * 120,
    ]


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and very long texts, ties, repeated rows, and ids that are far apart."""
    texts = _odd_texts()
    rows = [(i * 7 - 20, t, [None, "en", "fr", "", "de"][i % 5], None if i % 3 else "s", None if i % 4 else 0) for i, t in enumerate(texts)]
    return [*rows, (2**62, "one two", None, None, None)]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """The same with extra columns whose names the operators use themselves."""
    from pyspark.sql import functions as F

    names = ["id", "a", "b", "batch", "length", "label", "group", "range", "size", "slot", "rank", "text_crc32", "kept", "node", "h1"]
    return spark.createDataFrame(odd_rows, SCHEMA).select("*", *[F.lit(1).alias(n) for n in names]).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def nulls(spark):
    """Rows without an id, one of them twice, and a repeated row."""
    return spark.createDataFrame(
        [(None, None, None, None, None), (None, "a b c d e f g", None, None, 3), (None, "a b c d e f g", None, None, 3), (4, "x y", "en", "s", 1), (4, "x y", "en", "s", 1)], SCHEMA
    )
