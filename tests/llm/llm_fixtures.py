"""Tables for the tests of the subpackage."""

from __future__ import annotations

import pytest

SHAPE = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """A table of documents from (doc_id, text[, lang[, source]])."""

    def made(rows, extra=""):
        full = [(*row, *[None] * (4 - len(row)), None)[:5] for row in rows]
        frame = spark.createDataFrame(full, SHAPE)
        if extra:
            for name in extra.split(","):
                frame = frame.selectExpr("*", f"'x' AS {name}")
        return frame

    return made


AWKWARD = [
    (1, None),
    (2, ""),
    (None, "the of and to in is that it for on " * 8),
    (4, "the of and to in is that it for on " * 8),
    (4, "the of and to in is that it for on " * 8),
    (5, "\n\n \t\r\n"),
    (6, "Ünïcödé 漢字 🙂 'tis 12,5 | a | b\nwas it?"),
    (7, "word " * 30_000),
    (8, "x" * 20_000),
]


@pytest.fixture
def awkward(documents):
    """Nulls, empty and long texts, repeated rows, and columns with clashing names."""
    return documents(AWKWARD, extra="node,component,score,h,_text,size,block")
