import pytest

SF01 = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def sf01():
    return SF01


def awkward_texts() -> list:
    """Nulls, empty, blank, very long, repeated, other scripts, odd separators."""
    return [None, "", "   \n\t ", "a", "one two three four", "Ünïcode ßtraße ЖУК 漢字 漢字 漢字 漢字 漢字 漢字",
            "x" * 50_000, "long words here " * 20_000, "\n\n\n", "tab\tsep\x0bvt\x0cff\rcr",
            "same line here\nsame line here\nother\n\nsame line here", "A B C D E F A B C D E F",
            "a b c d e f a b c d e f", "trailing space ", " nbsp is not ascii space"]


@pytest.fixture(scope="session")
def awkward(spark):
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(awkward_texts())]
    rows += [(None, "null id text with some words in it", None, None, None), (3, "a", "de", None, 1),
             (4, "another text under the id four", "en", "s", 2)]
    return spark.createDataFrame(rows, SCHEMA)
