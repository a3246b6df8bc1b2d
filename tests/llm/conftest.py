from __future__ import annotations

import pytest

LONG = " ".join(f"w{i % 7}x{i}" for i in range(400))

# Ids, texts, languages and sources with every defined case, and columns that clash with names
# the operators use or make.
ROWS = [
    (1, None, "en", "a"),
    (2, "", None, "a"),
    (3, " \n\t ", "en", None),
    (4, "one", "de", "b"),
    (5, "ONE two", None, None),
    (6, LONG, "en", "b"),
    (7, LONG, "en", "b"),
    (8, LONG + "\n" + LONG, "de", "c"),
    (9, "Ünïcode — ’quoted’ <|endoftext|> 12 ½ 漢字 \x1c\x85 it's we'll\r\n\n  end", "de", "c"),
    (10, "same line here\n" * 30, "de", "c"),
    (10, "same line here\n" * 30, "de", "c"),
    (None, LONG, None, "c"),
]
CLASHING = ["id", "n", "score", "value", "shard", "position", "n_words", "block", "size", "token_ids", "kept", "draws"]


@pytest.fixture(scope="session")
def edge_docs(spark):
    columns = "doc_id long, text string, lang string, source string"
    extra = ", ".join(f"{c} string" for c in CLASHING)
    rows = [(*r, *["own"] * len(CLASHING)) for r in ROWS]
    return spark.createDataFrame(rows, f"{columns}, {extra}").cache()


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.filter("doc_id < 0")
