import re
from pathlib import Path

import pytest

from tests.oracle import connect
from tillroll import llm

SF_DIR = "/root/testdata/sf0.001"
#: Columns of the tables, which the tests fill.
FIELDS = "doc_id text lang source n_chars vec_id embedding label page_id url html conv_id turn role domain quality toxic".split()

#: Names that the operators use inside; a table may have them as well.
CLASHING = sorted(
    {
        name.lower()
        for module in Path(llm.__file__).parent.glob("*.py")
        for name in re.findall(r"""["'](?:[a-z]\.)?([A-Za-z_][A-Za-z_0-9]{0,24})["']""", module.read_text())
        if name.lower() not in FIELDS
    }
)


def with_clashes(df):
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit(f"x{i}") for i, c in enumerate(CLASHING) if c not in df.columns})


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows, ties, and columns with clashing names."""
    long = " ".join(f"word{i % 977} other{i % 331}" for i in range(150_000))
    rows = [
        (1, "the cat sat on the mat and looked at the big dog over there", "en", "a"),
        (2, "the cat sat on the mat and looked at the big dog over there", "en", "b"),
        (2, "the cat sat on the mat and looked at the big dog over there", "en", "b"),
        (3, "The  cat sat on the mat and looked at the big dog over\tthere ", "en", None),
        (4, None, None, None),
        (5, "", "en", "a"),
        (6, " \t\n", "en", "a"),
        (7, "1234 5678 !!", None, "c"),
        (8, long, "en", "c"),
        (9, long + " end", "en", "d"),
        (10, "le chat est sur la table et il regarde le grand chien là-bas", "fr", "d"),
        (None, "un autre texte en français que personne ne connaît", "fr", "e"),
        (None, None, None, None),
        (11, "x", "en", "f"),
        (12, "X", "en", "g"),
        (13, "ß\U0001f600 \x85   mixed\x1cwhite", "de", "g"),
    ]
    df = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    return with_clashes(df).cache()


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)


@pytest.fixture(scope="session")
def duck():
    return connect(SF_DIR)
