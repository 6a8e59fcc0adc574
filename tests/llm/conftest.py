import os

import pytest

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(SF_DIR):
        pytest.skip("the driver's tables are not here")
    return SF_DIR


DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def awkward(spark):
    """Documents with nulls in every column, empty, blank and long texts, repeated rows, and columns with clashing names."""
    rows = [
        (1, "The cat sat on the mat and looked at the big dog.", "en", "a", 10),
        (1, "The cat sat on the mat and looked at the big dog.", "en", "a", 10),
        (2, None, "en", "a", None),
        (3, "", None, "b", 0),
        (4, " \t\n ", "de", None, 3),
        (None, "Der Hund lief schnell durch den Wald nach Hause.", "de", "b", 5),
        (None, None, None, None, None),
        (5, "12345 67890 !!!", "en", "a", 3),
        (6, "word " * 30_000, "en", "c", 1),
        (7, "x" * 100_000, None, "c", 1),
        (8, "Élan ÀÉÎ naïve \u0130 \U0001f600 \x00 end\nline two\r\n\nline", "fr", "a", 1),
        (9, "The cat sat on the mat and looked at the big dog.", "en", "b", 10),
    ]
    frame = spark.createDataFrame(rows, DOCUMENTS)
    names = ("score", "Shard", "fingerprint", "kept", "weight", "row", "c0", "id", "source_", "_row")
    for name in names:
        frame = frame.selectExpr("*", f"'extra' AS `{name}`")
    return frame


@pytest.fixture(scope="session")
def no_documents(awkward):
    return awkward.filter("false")
