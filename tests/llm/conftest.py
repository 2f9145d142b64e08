import pytest

#: Columns whose names the operators use inside.
CLASH = "id long, kept boolean, node string, bucket long, size long, place int, range int, fp string, path string, spans string, n string, sha string, words string, w string, h string, t string"


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls, repeats, ties, a long text and clashing columns."""
    long = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
    base = "the quick brown fox jumps over the lazy dog and runs into the deep green wood today"
    rows = [
        (1, base, "en", "a"), (2, base.replace(" ", "\t\n"), "en", "a"), (3, base + " again", "en", "b"), (4, None, None, None), (5, "", "en", "b"),
        (6, " \n ", None, "b"), (7, "12 34 !!", "de", "c"), (8, long, "en", "a"), (9, long + " tail", "en", "a"), (10, "ein kurzer Satz", "de", "c"),
        (10, "ein kurzer Satz", "de", "c"), (None, "row without an id", "en", None), (None, base, "en", "a"), (11, "Ein Kurzer satz", "de", "c"),
        (12, "a", None, "c"), (13, "\U0001f600 é ü", "fr", "d"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    for part in CLASH.split(", "):
        name, kind = part.split()
        docs = docs.selectExpr("*", f"CAST(1 AS {kind}) AS {name}" if kind != "string" else f"'x' AS {name}")
    return docs


@pytest.fixture(scope="session")
def empty(odd):
    return odd.where("false")


