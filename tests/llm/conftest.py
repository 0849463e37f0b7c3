import random

import pytest
from llm_rows import SCHEMA, document

@pytest.fixture(scope="session")
def words():
    rng = random.Random(3)
    return ["".join(rng.choice("abcdefghijklmno") for _ in range(rng.randint(2, 9))) for _ in range(400)]


@pytest.fixture(scope="session")
def edge_rows(words):
    """Nulls, empty and blank texts, repeated rows and ids, non-ASCII words, a very long text, near and exact copies."""
    rng = random.Random(4)
    rows = [
        document(0, None), document(1, ""), document(2, " \n\t "), document(3, "One two"), document(3, "One two"),
        document(3, "other text under the same id"), document(None, "a text without id", None), document(None, None, None),
        document(4, "Ünïcode wörter größe 漢字 🙂 naïve", None), document(5, " ".join(rng.choice(words) for _ in range(30_000)), "s1"),
        document(6, "x" * 50_000, "s2"), document(7, "same " * 500),
    ]
    base = [rng.choice(words) for _ in range(120)]
    for k in range(12):
        near = list(base)
        near[rng.randrange(120)] = "changed"
        rows.append(document(100 + k, " ".join(near if k % 3 else base), f"s{k % 5}"))
    for k in range(60):
        rows.append(document(200 + k, "\n".join(" ".join(rng.choice(words) for _ in range(rng.randint(1, 25))) for _ in range(5)), f"s{k % 7}"))
    return rows


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    return spark.createDataFrame(edge_rows, SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
