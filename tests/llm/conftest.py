import random

import pytest

# Names that the operators use themselves.
CLASHING = "score predicted doc th remains kept spans node component u v band key label ids piece rank task share offset part record sha256 text_u".split()


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls, empty and long texts, repeats, ties and clashing columns."""
    rnd = random.Random(5)
    words = ["".join(rnd.choice("abcdeéß") for _ in range(rnd.randint(2, 7))) for _ in range(50)]

    def prose(n):
        return " ".join(rnd.choice(words) for _ in range(n))

    shared, long = prose(60), prose(40_000)
    rows = [
        (1, None, "en"),
        (2, "", None),
        (3, " \n\t ", "en"),
        (4, "one two three", "en"),
        (5, "one two three", "de"),
        (5, "one two three", "de"),
        (None, shared, "en"),
        (None, None, None),
        (6, prose(30) + " " + shared + " " + prose(30), "en"),
        (7, shared + " " + prose(20), "en"),
        (8, long, "en"),
        (9, long[:150_000] + " " + prose(10), "en"),
        (10, "a" * 5_000, "en"),
        (11, "日本語 テキスト  <|endoftext|> \x1c it's ", "ja"),
    ]
    rows += [(20 + k, prose(rnd.randint(1, 80)), "fr") for k in range(20)]
    rows = [(*row, *[f"own {k}" for k in range(len(CLASHING))]) for row in rows]
    schema = "doc_id long, text string, lang string, " + ", ".join(f"{c} string" for c in CLASHING)
    return spark.createDataFrame(rows, schema).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.limit(0)
