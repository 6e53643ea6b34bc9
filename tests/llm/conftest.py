import random
import re

import pytest

WORDS = [f"{a}{b}" for a in ("ta", "ke", "mi", "so", "ru", "él") for b in ("n", "la", "ro", "shi", "que", "d")]
EXTRA = ("id string, x int, h int, spans string, leaks string, language string, block int, tokens string, "
         "m string, f string, part int, n long, d1 long, rep long, component long")


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", ",", ".", "\n"]) for _ in range(n))


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows, clashing columns."""
    rng = random.Random(1)
    same, long = prose(rng, 60), prose(rng, 60_000)
    texts = [(1, None), (2, ""), (3, " \n\t\r "), (None, same), (None, None), (4, long), (5, same), (5, same),
             (6, same), (7, same + " extra"), (8, "one"), (9, "\n\n"), (10, "x" * 200_000), (11, "é▁ü 漢字  z"),
             (12, "ONE"), (13, "12 345 !!")]
    rows = [(i, t, "en" if i and i % 2 else None, None, None) + (None,) * 15 for i, t in texts]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + EXTRA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


def lowered(s):
    return re.sub("[A-Z]", lambda m: m[0].lower(), s or "")
