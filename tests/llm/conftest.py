import duckdb
import pytest

SF = "/root/testdata/sf0.001"
EXTRA = ("row", "th", "rid", "kept", "rate", "h", "n_tokens", "fingerprint", "word", "component_id", "text_sha256", "has", "id", "n_lines", "n_removed")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in EXTRA)
LABELS = "doc_id long, quality int, toxic int"

LONG = " ".join(f"w{k % 977}" for k in range(30_000))
POEM = "one two three four.\nfive six seven eight.\nnine ten eleven twelve.\nthirteen fourteen."
ODD = [
    (None, "a text without a name, of a few words."),
    (None, None),
    (1, None),
    (2, ""),
    (3, " \t\n \x0b\x0c\r "),
    (4, LONG),
    (5, "x" * 20_000),
    (6, POEM),
    (7, POEM),
    (7, POEM),  # a repeated row
    (7, "another text under the same name, which is not a copy."),
    (8, "!!! ??? ###"),
    (9, "ÀÉÎ ß İ 中文 é \U0001f600 <|endoftext|> it's"),
    (10, "one"),
    (-5, "All rights reserved.\n\nReleased under the MIT License.\nlast line here."),
    (9_000_000_000_000_000_000, POEM + "\nan extra line."),
]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, None, None, None, *["7"] * len(EXTRA)) for i, t in rows], SCHEMA)


@pytest.fixture(scope="session")
def odd(spark):
    return frame(spark, ODD)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(4, 1, 0), (6, 1, 0), (7, 0, 1), (8, 0, None), (None, 1, 0), (7, 1, 0)], LABELS)


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], LABELS)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def texts():
    return dict(duckdb.connect().execute(f"select doc_id, text from '{SF}/documents.parquet'").fetchall())
