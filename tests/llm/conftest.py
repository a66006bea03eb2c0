import pytest

from cadenza.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture(scope="session")
def documents(spark):
    """Rows with every odd case: NULLs, empty and very long texts, repeated rows, copies, clashing column names."""
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split()
    prose = " ".join(words[i * i % 12] + str(i) for i in range(120))
    rows = [
        (1, prose, "en", "a", 1), (2, prose, "en", "a", 1), (2, prose, "en", "a", 1),
        (3, None, None, None, None), (4, "", "en", "b", 0), (5, "  \n\t ", "en", "b", 0),
        (6, prose + " one more", "en", None, 2), (7, "x " * 30_000, "en", "c", 3), (8, "Füße — naïve 𝄞 text", "de", "c", 4),
        (None, "no id here at all", "en", "a", 5), (9, "line one is here and long\nline two is here and long\nline one is here and long",
                                                    "en", "b", 6),
        (10, "line one is here and long\nline onE is here and lung", "en", "b", 6), (11, "### $$$ *** %%% " * 10, "en", "d", 7),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.selectExpr("*", "1 AS size", "'x' AS key", "2 AS row", "3 AS bucket", "4 AS class").repartition(3).cache()


@pytest.fixture(scope="session")
def no_documents(documents):
    return documents.limit(0)
