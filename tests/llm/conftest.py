"""Odd rows that every text operator has to take: nulls, empty and long texts, ties, repeats, clashing columns."""

import pytest

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu nu xi omicron pi".split()


def prose(n: int, start: int = 0) -> str:
    return " ".join(f"{WORDS[(i * i + start) % 16]}{(i * 7 + start) % 89}" for i in range(n))


ROWS = [
    (1, prose(60), "en", "b"), (2, prose(60).replace(" ", "\n\t"), "en", "b"), (3, prose(60) + " tail", None, None),
    (4, None, "en", "a"), (5, "", "en", "a"), (6, " \n ", "de", "a"), (7, "Word", "de", "c"), (8, "word", None, "é"),
    (9, prose(4000, 5), "fr", "a"), (10, "x " + prose(4000, 5), "fr", None), (11, "é" * 3000 + " <|endoftext|>", "fr", "c"),
    (12, prose(90, 3) + " " + prose(90, 3), "es", "b"), (None, prose(60), "en", "b"), (7, "Word", "de", "c"),
    (13, "a\n a\na\n\n  \nb\nb " + prose(30), "es", "b"), (14, "aaaa" * 500, "es", "c"), (15, prose(200, 9)[:1500], "en", "a"),
]


@pytest.fixture(scope="session")
def odd(spark, tmp_path_factory):
    """The rows as a table with columns named like the operators' own."""
    path = str(tmp_path_factory.mktemp("odd") / "documents.parquet")
    rows = [(i, t, lang, s, None if t is None else len(t), 99, "x", 0.5, "k") for i, t, lang, s in ROWS]
    names = "doc_id long, text string, lang string, source string, n_chars long, rid int, name string, score double, kept string"
    spark.createDataFrame(rows, names).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def none(odd):
    return odd.filter("doc_id < 0")
