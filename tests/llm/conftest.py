import pytest

from tripmill.llm.tables import ship_code

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, row_id int, id string, key int, bucket int"


@pytest.fixture(scope="session", autouse=True)
def code(spark):
    ship_code(spark)


def rows_of(texts, first=0):
    """Rows of SCHEMA, whose last columns clash with names that operators use inside."""
    return [
        (first + i, t, "en", f"s{i % 3}" if i % 7 else None, None if t is None else len(t), i, "x", 1, 2)
        for i, t in enumerate(texts)
    ]


PASSAGE = " ".join(f"word{i} of the passage." if i % 5 == 0 else f"word{i}" for i in range(60))
ODD_TEXTS = [
    None,
    "",
    "   \n\t ",
    "one",
    "ONE",
    "four words of text",
    "four words of text",
    "a b c d e f g h i j k l m n o p q r s t u v w x y z",
    "A b c d e f g h i j k l m n o p q r s t u v w x y zz",
    "\x1c\x85 non breaking ​ zero 🙂 漢字 é",
    PASSAGE,
    "Before it. " + PASSAGE + " After it all.",
    "the " * 30_000,
    "x" * 100_000,
]


@pytest.fixture(scope="session")
def odd(spark):
    """Null ids and texts, empty, blank, tiny and very long texts, ties and repeated rows."""
    rows = rows_of(ODD_TEXTS)
    rows += [rows[6], rows[10], (None, "four words of text", None, None, None, 0, "y", 0, 0), (None, None, None, None, None, 0, "z", 0, 0)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def small(spark):
    return "/root/testdata/sf0.001"
