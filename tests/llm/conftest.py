"""Small tables with everything that may go wrong in one: nulls, ties, repeats, odd columns."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"


@pytest.fixture
def frame(spark):
    def make(rows, schema=DOCUMENTS):
        return spark.createDataFrame(rows, schema)

    return make


@pytest.fixture
def odd(frame):
    """Documents with nulls in any column, empty texts, repeated rows and clashing column names."""
    base = " ".join(f"word{i}" for i in range(80))
    rows = [
        (1, base, "en", "a", 1, "x", None),
        (1, base, "en", "a", 1, "x", None),
        (2, base, "en", None, None, None, 3),
        (3, None, None, None, None, None, None),
        (4, "", "en", "b", 0, "", 0),
        (5, "   \n\t ", "en", "b", 0, "", 0),
        (None, "no id here", "en", "a", 2, "y", 1),
        (None, None, None, None, None, None, None),
        (6, "short", "de", "b", 5, "z", 1),
        (7, "é" * 3 + " 日本 \x1c 😀 \x00", "de", "c", 5, "z", 1),
        (8, base + " and a little more", "en", "c", 5, "z", 1),
    ]
    # Names that the operators use inside.
    extra = ", size string, nth int, digest string, n long, row int, copies long, node long"
    rows = [(*r, None, 1, 2, None, 3) for r in rows]
    return frame(rows, DOCUMENTS + extra)


@pytest.fixture
def empty(frame):
    return frame([])
