"""Fixtures and row order, imported by the tests of this folder."""

import pytest

SF0001 = "/root/testdata/sf0.001"
#: Nulls in any column, empty and long texts, ties, repeated rows.
HARD = [(1, None), (2, ""), (None, "a b c d e"), (3, "word " * 4000), (3, "word " * 4000), (4, " \t\n"), (5, "é́ß Straße ½ 漢字 😀"),
        (6, "word " * 4000 + "tail"), (7, "a b c d e"), (8, "A  b\tc d e"), (9, "x" * 700), (10, "<|endoftext|> </s> [INST]")]


@pytest.fixture
def hard(spark):
    """Documents with every hard case and columns whose names clash."""
    return spark.createDataFrame([(i, t, "en", True, "x") for i, t in HARD],
                                 "doc_id long, text string, lang string, kept boolean, sequence_id string")


@pytest.fixture
def none(hard):
    return hard.limit(0)


def rows(df, *columns):
    """Rows as tuples in a fixed order, nulls first."""
    got = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    return sorted(got, key=lambda r: tuple((v is not None, str(v)) for v in r))
