import numpy as np
import pytest
from pyspark.sql import types as T

WORDS = [a + b for a in ("ba", "ke", "li", "mo", "nu", "ra", "se", "ti") for b in ("den", "fol", "gar", "hint", "jak", "lom", "pest", "rix")]

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that operators might be tempted to use themselves.
        *[T.StructField(name, T.StringType()) for name in ("id", "n", "size", "kept", "label", "score", "place", "part")],
    ]
)


def prose(seed, n):
    """``n`` words drawn from a small vocabulary."""
    return " ".join(np.random.default_rng(seed).choice(WORDS, n))


@pytest.fixture
def documents(spark):
    """A frame of documents from (doc_id, text[, lang[, source]]) rows, with extra columns of clashing names."""

    def build(rows):
        full = [(*r, *[None] * (4 - len(r))) for r in rows]
        return spark.createDataFrame([(*r, len(r[1] or ""), *["x"] * 8) for r in full], DOCS)

    return build


@pytest.fixture
def hard_rows():
    """Nulls in every column, empty and very long texts, ties and repeated rows."""
    long = prose(1, 60_000)
    return [
        (None, None, None, None),
        (None, prose(2, 30), "en", "a"),
        (1, None, "en", "a"),
        (2, "", "de", None),
        (3, " \n\t ", None, "b"),
        (4, long, "en", "b"),
        (5, long, "en", "b"),
        (6, "one", "en", "b"),
        (7, "é — ü x　y", "fr", "a"),
        (8, prose(3, 80), "en", "a"),
        (8, prose(3, 80), "en", "a"),
        (9, prose(3, 80), "en", "c"),
        (-5, "x" * 200_000, "de", "c"),
    ]
