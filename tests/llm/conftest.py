import pytest

from dwellmart.llm.queries import importable

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, `row` string, size string, print string, "
    "doc string, kept string, score string, words string, number string, token string, label string, place string"
)
LONG = " ".join(f"word{i % 997} of{i}" for i in range(30_000)) + "."
CLASH = ("x",) * 11


@pytest.fixture(scope="session")
def on_workers(spark):
    importable(spark)
    return spark


def documents(spark, rows, schema=SCHEMA):
    """(doc_id, text) or (doc_id, text, source) rows as documents with extra columns of clashing names."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", 7, *CLASH) for r in rows]
    return spark.createDataFrame(full, schema)


ODD = [
    (1, None), (2, ""), (3, " \n\t \x0b"), (4, "Same words here. Again and again, same words."),
    (4, "Same words here. Again and again, same words."), (None, "a text without an id"), (5, LONG),
    (6, "same words here. AGAIN and again, same words."), (7, "Ünï cödé – 日本語 \U0001f600", None),
]


@pytest.fixture(scope="session")
def odd(on_workers):
    return documents(on_workers, ODD).cache()


@pytest.fixture(scope="session")
def nothing(on_workers):
    return documents(on_workers, [])
