import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Documents with every awkward case: nulls, empty and very long texts, repeated rows, odd characters.
ODD = [
    (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \t\n ", "en", "a", 4), (4, "Word", "en", None, 4), (4, "Word", "en", None, 4), (None, "no id here at all", "en", "b", 17),
    (5, "The cat sat on the mat. " * 4000, "en", "b", 96000), (6, "Élan vital ŒUVRE naïve İ Σας H̱ <|endoftext|> x<|ENDOFTEXT|>", "fr", "b", 40), (7, "123 !!! ...", "en", "c", 11), (8, "nul\x00byte\x1c odd space", None, "c", 20), (-9, "minus nine", "en", "c", 10),
]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)


def prose(seed: int, n: int) -> list[str]:
    rnd = random.Random(seed)
    parts = "ba ce di fo gu ha je ki lo mu na pe ri so tu va we xi yo zu".split()
    return ["".join(rnd.choice(parts) for _ in range(rnd.randint(1, 4))) for _ in range(n)]
