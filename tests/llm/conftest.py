import pytest

WORDS = "the of and to in is that for it was on are as with they at be this from have or by one had not but what all were when we there can an your which".split()


def prose(seed, n):
    """n words without long repeats."""
    out, x = [], seed * 7919 + 13
    for _ in range(n):
        x = (x * 1103515245 + 12345) % 2**31
        out.append(WORDS[x // 65536 % len(WORDS)] + "aeiou"[x // 7 % 5] * (x // 1000 % 3))
    return " ".join(out)


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words string, h string, size string, host string, bucket string, node string, label string, target string"


def frame(spark, rows):
    """Documents with extra columns whose names operators might use themselves."""
    return spark.createDataFrame([(i, t, lang, s, None if t is None else len(t), *["x"] * 8) for i, t, lang, s in rows], SCHEMA)


ODD = [
    (1, None, None, None), (2, "", "en", "a"), (3, " \t\n ", "en", "a"), (4, "one", "en", "a"), (5, "one", "en", "b"), (6, prose(1, 60), "en", "a"), (6, prose(1, 60), "en", "a"),
    (7, prose(1, 60), "de", None), (8, prose(2, 30_000), "en", "b"), (9, "é▁ü\n\x00漢字 🙂\u2028 end", "xx", "b"), (10, "same line here now\n" * 40, "en", "a"), (11, "w" * 50_000, "en", "a"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and very long texts, ties, a repeated row, odd characters, clashing columns."""
    return frame(spark, ODD).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return frame(spark, [])
