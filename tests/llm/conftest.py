import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"

LONG = " ".join(f"word{i % 977}x{i % 31}" for i in range(30000))
PASSAGE = ("it was agreed by all who met there that the old mill by the river would be "
           "mended before the first snow of the year came down upon the hills again")


def rows():
    """Nulls in every column, empty, blank and long texts, ties and repeated rows."""
    return [
        (1, f"One {PASSAGE} and so it went on for many days.", "en", "a", 5),
        (2, f"Two {PASSAGE} and so it went on for many days.", "en", "a", 5),
        (3, None, "en", "b", None), (4, "", None, "b", 0), (5, " \t\r\n\x0b\x0c ", "de", None, 6),
        (6, "short text", "de", None, 10), (7, "short text", "fr", "c", 10),
        (8, LONG, "en", "a", len(LONG)), (9, LONG, "en", "c", len(LONG)),
        (10, "x " * 400, "es", "d", 800), (11, "café  naïve \U0001f600 end", "fr", "d", 9),
        (12, "repeat me please, all of it", "en", "e", 3),
        (12, "repeat me please, all of it", "en", "e", 3),
        (None, "no id here at all, none", "en", "a", 1), (None, None, None, None, None),
        (13, "\n".join(["same line of text"] * 30 + ["", " ", "other"]), "en", "é", 1),
        (14, "#*$% " * 100, "en", "z", 1), (15, "a\x00b \x1c c　d", "en", "z", 1),
    ]


@pytest.fixture(scope="session")
def edge_docs(spark):
    return spark.createDataFrame(rows(), DOCS).repartition(3)


@pytest.fixture(scope="session")
def clash_docs(edge_docs):
    """The same with extra columns named as the operators name theirs."""
    from pyspark.sql import functions as F
    names = ["size", "kept", "m", "stratum", "_s", "_cuts", "target", "key", "keys", "set_a", "row",
             "ids", "tie", "component_id", "_gone", "item_id", "n_words", "unit", "licence", "_p",
             "shard", "row_number", "start", "n_bytes", "n_removed", "spans", "_id", "_n", "_pid"]
    return edge_docs.select("*", *[F.lit(f"extra {n}").alias(n) for n in names])


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


def all_rows(df):
    return sorted(map(tuple, df.collect()), key=repr)
