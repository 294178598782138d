import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, n_words string, size string"


def rows():
    """Nulls in every column, empty and blank texts, ties, repeated rows, one long text."""
    import random

    rng = random.Random(4)
    vocabulary = [a + b for a in ("ba", "ké", "Lo", "mu", "ti") for b in ("ra", "s", "n,", "zü", "x.")]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    shared = prose(80)
    out = [
        (1, shared + "\nline two is here\n\n" + prose(60), "en", "b"),
        (2, prose(40) + " " + shared, "en", "b"),
        (3, prose(40) + " " + shared, "de", None),
        (4, None, None, "a"),
        (5, "", "fr", "a"),
        (6, " \n\t \r\n", "fr", None),
        (7, "one", None, "a"),
        (8, "same text of a few words " * 12, "en", "a"),
        (8, "same text of a few words " * 12, "en", "a"),
        (9, "same text of a few words " * 12, "en", "a"),
        (None, prose(30), None, None),
        (None, prose(30), "de", "c"),
        (10, "123 456 !!! ###", "en", "c"),
        (11, "line two is here\n\nand a second line\n" * 3 + prose(25), "en", "c"),
        (12, prose(40_000), "de", "a"),
        (13, "\x01 mark <|endoftext|> and sep \x00 é́ ÀÉ " + prose(20), "fr", "b"),
        (14, "x" * 30_000, "en", "b"),
    ]
    return [(i, t, lang, s, None, "clash", None) for i, t, lang, s in out]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
