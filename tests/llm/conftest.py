import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long, score double, key string"

PROSE = (
    "the river ran past an old mill and nobody in town could say who had built it "
    "first while children kept fishing from its broken wheel every summer until rain "
    "came again and washed the narrow bridge far down into the valley below"
)


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls, empty and long texts, repeated rows, and columns that operators use themselves."""
    rows = [
        (1, PROSE, "en", "a", 1, 0.5, "k"),
        (2, PROSE.replace("river", "stream"), None, "a", 1, 0.5, "k"),
        (3, PROSE, "en", "b", 1, None, None),
        (3, PROSE, "en", "b", 1, None, None),
        (4, None, None, None, None, None, None),
        (5, "", "en", "b", 0, 0.1, "x"),
        (None, "a null key", "en", None, 10, 0.1, "x"),
        (6, " ".join(f"w{i}" for i in range(9000)), "en", "c", 1, 0.1, "x"),
        (7, "Licensed under CC BY-NC 4.0.\nAll rights reserved. ALL  RIGHTS, reserved", "en", "c", 1, 0.1, "x"),
        (8, "ünï «cödé» 漢字 \U0001f600 é \x1c\xa0x", "en", "c", 1, 0.1, "x"),
    ]
    return spark.createDataFrame(rows, DOC).repartition(3)


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], DOC)
