import random

import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    # Names that the operators use themselves.
    "_row string, _text string, _id long, digest string, hash string, start string, code string, "
    "component_id string, score string, kept string, removed string, tokens string, n_replaced string, `a.b` string"
)
EXTRA = tuple(f"x{i}" for i in range(14))
EXTRA = (*EXTRA[:2], 7, *EXTRA[3:])


def prose(seed, n):
    """Invented prose: n words with sentences and lines."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        word = "".join(rng.choice("aeioubcdlmnrst") for _ in range(rng.randint(2, 7)))
        out.append(word + (".\n" if i % 37 == 36 else ". " if i % 9 == 8 else " "))
    return "".join(out)


def row(doc_id, text, lang="en", source="src1"):
    return (doc_id, text, lang, source, len(text) if text is not None else None, *EXTRA)


EDGE_TEXTS = [
    (None, prose(1, 60)),
    (1, None),
    (2, ""),
    (3, " \n\t  "),
    (4, prose(2, 20_000)),
    (5, prose(3, 90)),
    (5, prose(3, 90)),  # a repeated row
    (5, prose(4, 90)),  # the same id, another text
    (6, prose(3, 90)),
    (7, "word"),
    (8, "two words"),
    (9, "Ünïcödé 日本 🙂 text with odd spaces"),
    (None, None),
]


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame([row(i, t) for i, t in EDGE_TEXTS], SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def make(spark):
    def documents(texts, **columns):
        return spark.createDataFrame([row(i, t, **columns) for i, t in texts], SCHEMA)

    return documents
