import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Names that operators give their own columns, in a table that has them already.
CLASHING = (
    "own digest keep_id group_size kept text_sha256 size taken target source_size words place bucket bucket_slot "
    "shard slot start of n row rep key head own2 component component_id node gone lang_pred score host path rule "
    "verdict piece length ids sequence_id offset a b _in0"
).split()


@pytest.fixture(scope="session")
def documents(spark):
    """A small table with NULLs, empty, blank and very long texts, copies and repeated rows."""
    long = " ".join(f"w{i % 977}x{i % 13}" for i in range(60_000))
    base = " ".join(f"wort{i}" for i in range(100))
    rows = [
        (1, "The quick brown fox jumps over the lazy dog and the other one", "en", "a", 1),
        (2, "The quick brown fox jumps over the lazy dog and the other one", "en", "b", 1),
        (3, None, "en", "a", None),
        (4, "", None, None, 0),
        (5, " \t\n ", "de", "c", 4),
        (6, "Kurz", "de", "c", 4),
        (7, long, "en", "a", len(long)),
        (8, base, "de", "c", 1),
        (9, base.replace("wort50", "Wort50 "), "de", "c", 1),
        (10, base.replace("wort10", "anders"), "de", None, 1),
        (10, base.replace("wort10", "anders"), "de", None, 1),
        (11, "12345 !!! 678", "en", "b", 1),
        (None, "row without a key that has more than five words", "en", "b", 1),
        (None, None, None, None, None),
        (12, "kurz", "de", "c", 4),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def clashing(documents):
    from pyspark.sql import functions as F

    return documents.select("*", *[F.lit(f"own {name}").alias(name) for name in CLASHING])


@pytest.fixture(scope="session")
def no_documents(documents):
    return documents.limit(0)
