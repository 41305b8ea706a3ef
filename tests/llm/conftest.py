from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table of texts, or of (doc_id, text) pairs; extra columns carry clashing names."""

    def make(*rows):
        full = []
        for i, row in enumerate(rows):
            doc_id, text = row if isinstance(row, tuple) else (i, row)
            full.append((doc_id, text, "en", "src0", None if text is None else len(text)))
        df = spark.createDataFrame(full, DOCS).repartition(3)
        clash = ("ids", "place", "file", "row", "start", "id", "key", "hub", "component", "line", "block", "body",
                 "piece_id", "host", "n_words", "bytes", "digest", "shard")
        return df.selectExpr("*", *(f"'x' AS `{c}`" for c in clash))

    return make


@pytest.fixture(scope="session")
def small_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def small_docs(spark, small_dir):
    table = spark.read.parquet(f"{small_dir}/documents.parquet")
    return [(r["doc_id"], r["text"]) for r in table.select("doc_id", "text").collect()]


#: Texts at the edges: null, empty, blank, one character, non-Latin, special strings, long words.
EDGE_TEXTS = [
    None, "", "   ", "\n\n", "a", "It's THE end, isn't it?", "don't 12 345\t67\x0b8", "日本語 テスト！！", "İΣσς ΑΣ",
    "<|endoftext|> stays text", "é é à Å ﬁ", "x\x85y\xa0z​w \x1c\x1d",
    "🙂🙂 ok 🙂", "word " * 3000, "z" * 5000, "Ünïcödé straße ß", "a  b\n\n  c \r\n d",
]
