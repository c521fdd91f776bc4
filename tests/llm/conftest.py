import pytest

LONG = " ".join(f"w{i % 997} and{i % 31}" for i in range(30_000))
EDGES = [
    (1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "One  TWO"), (6, "a b c d e f g h i j"), (7, "A b C d e f g h\ti\nj"), (8, "a b c d e f g h i j"),
    (9, "ünï çödé 日本語 😀 é ǅ x\x1cy\x85z"), (10, LONG), (11, LONG + " end"), (12, "!!! ... 123"), (13, "it's <|endoftext|> don't"), (14, "x" * 5000), (14, "x" * 5000), (15, "\n\n"), (-3, "negative id words here now"), (None, "no id at all here"),
]


@pytest.fixture(scope="session")
def edges(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and extra columns with clashing names."""
    rows = [(i, t, "en", "s", 1, "x", 2.0, 3, True) for i, t in EDGES]
    return spark.createDataFrame(rows, "doc_id long, text string, key string, id string, n int, label string, size double, cluster int, kept boolean")


@pytest.fixture(scope="session")
def nothing(edges):
    return edges.where("false")


def rows_of(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
