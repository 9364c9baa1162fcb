import math

import duckdb
import pytest

# Names the operators use inside, as extra columns of the caller.
CLASHES = [
    "rid", "doc", "id", "n", "head", "key", "keep", "size", "fingerprint", "root", "t", "words", "origin", "tokens",
    "weight", "block", "turn", "times", "spans", "score", "lang_pred", "kept", "group_size", "text_", "sequence_id", "judged", "work", "form", "output",
    "prefix_chars", "middle_chars",
]
VECTOR_CLASHES = ["doc", "id", "vec", "vector", "cid", "key", "root", "n", "size", "cluster", "distance", "cells", "full", "digest", "kept", "n_links"]
PROSE = "the cat sat on the mat and then it went to see an old friend in the village by the river where all was calm "


def document_rows():
    """Nulls in every column, empty and white texts, a long text, ties, repeated rows and ids."""
    good = " ".join(f"{w}{i}" for i, w in enumerate(PROSE.split() * 4))
    rows = [
        (1, good, "en", "a", 1),
        (2, good.replace(" ", "\t ", 5), "en", "a", 2),
        (2, good, "en", "b", 3),
        (3, "", "de", "b", 0),
        (4, None, "de", None, None),
        (5, " \n\t ", None, "c", 4),
        (None, good + " but this one has no id at all", "en", "a", 5),
        (None, None, None, None, None),
        (6, "one", "fr", "a", 3),
        (7, "one two", "fr", "a", 7),
        (8, "word " * 60_000, "en", "hot", 300_000),
        (9, "word " * 60_000 + "x", "en", "hot", 300_001),
        (10, "word " * 60_000 + "x", "en", "hot", 300_001),
        (11, "ÄÖ ß É " + good.upper(), "de", "c", 9),
        (12, "日本語のテキスト 1234 🙂", "ja", "c", 9),
    ]
    return rows + [rows[0], rows[8]]


def documents(spark, rows, clashes=True):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    if not clashes:
        return spark.createDataFrame(rows, schema)
    schema += "".join(f", `{c}` string" for c in CLASHES)
    return spark.createDataFrame([r + ("own",) * len(CLASHES) for r in rows], schema)


def vector_rows():
    """Nulls, other lengths, no length, zeros, values that are no numbers, repeated rows and ids, scaled copies."""
    def at(k, scale=1.0):
        return [scale * math.sin(k * 7 + d * d) for d in range(64)]

    odd = at(5)
    rows = [(k, at(k), k % 3) for k in range(20)]
    rows += [(1, at(1), 1), (1, at(2), None), (20, at(3, 2.0), 0), (21, at(3, -1.0), 0), (None, at(4), 1), (None, None, None), (22, None, 0)]
    rows += [(23, [], 0), (24, [1.0] * 63, 0), (25, [1.0] * 65, 0), (26, [0.0] * 64, 0), (27, [-0.0] * 64, 0), (28, [2.0] * 63, 0)]
    rows += [(29 + i, odd[:9] + [x] + odd[10:], 0) for i, x in enumerate((None, math.nan, math.inf, -math.inf))]
    return rows


def vectors(spark, rows):
    schema = "vec_id long, embedding array<double>, label int" + "".join(f", `{c}` string" for c in VECTOR_CLASHES)
    return spark.createDataFrame([r + ("own",) * len(VECTOR_CLASHES) for r in rows], schema)


@pytest.fixture(scope="session")
def edge_rows():
    return document_rows()


@pytest.fixture(scope="session")
def edge_vectors():
    return vector_rows()


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    return documents(spark, edge_rows)


@pytest.fixture(scope="session")
def no_docs(spark):
    return documents(spark, [])


@pytest.fixture(scope="session")
def edge_dir(spark, edge_rows, tmp_path_factory):
    """The edge rows as a folder of tables, as the registered queries read it."""
    folder = tmp_path_factory.mktemp("edge")
    documents(spark, edge_rows).write.parquet(f"{folder}/documents.parquet")
    labels = [(1, 1, 0), (3, 0, 0), (6, 0, 1), (6, 0, 1), (None, 1, None), (8, None, None), (99, 1, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    pages = [
        (1, "http://www.Example.com/en/a?x#y", "h"), (1, "http://www.Example.com/en/a?x#y", "h"), (2, None, None), (3, "", ""),
        (None, "no scheme", "h"), (4, "http://a.net/es/1", None), (5, "http://x.org/" + "a" * 5000, "h"), (6, "ftp://é.net/日本\n/x", "h"),
    ]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{folder}/pages.parquet")
    vectors(spark, vector_rows()).write.parquet(f"{folder}/embeddings.parquet")
    return str(folder)


@pytest.fixture(scope="session")
def empty_dir(spark, edge_dir, tmp_path_factory):
    folder = tmp_path_factory.mktemp("empty")
    for table in ("documents", "labels", "pages", "embeddings"):
        spark.read.parquet(f"{edge_dir}/{table}.parquet").limit(0).write.parquet(f"{folder}/{table}.parquet")
    return str(folder)


@pytest.fixture(scope="session")
def small_texts(sf_dir):
    """(doc_id, text) of the small table."""
    return duckdb.execute(f"SELECT doc_id, text FROM '{sf_dir}/documents.parquet' ORDER BY doc_id").fetchall()
