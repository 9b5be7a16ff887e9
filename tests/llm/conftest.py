"""Small tables with everything that may go wrong in real ones."""

import pytest
from pyspark.sql import types as T

SMALL = "/root/testdata/sf0.001"
DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use inside; they have to stay apart from them.
CLASHING = "rk1 string, rk2 string, spans string, places string, score string, part string, id string, label string, sketch string, c0 string"


def plain_documents():
    import duckdb

    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet' ORDER BY 1 LIMIT 40").fetchall()
    return rows


def odd_documents():
    rows = plain_documents()
    texts = [t for _, t in rows]
    bench = "one two three four five six seven eight nine ten eleven twelve"
    passage = " ".join(f"word{i}x" for i in range(70))
    long = " ".join(f"lang{i % 977} {i * i % 7919}" for i in range(30_000))
    more = [
        None,
        "",
        " \t\n ",
        "a",
        "two words",
        "Ünïcödé façade 漢字 — “quotes”",
        "x" * 3000,
        "ab " * 900,
        long,
        long + " tail",
        texts[0],
        texts[0],
        texts[1] + " edited at the end",
        f"before {bench} after",
        f"BEFORE, {bench.upper()}! after",
        "tiny",
        f"first {passage} one",
        f"second {passage} two",
        f"third {passage} three",
        "under the MIT License or the GNU General Public License and CC BY",
        "SPDX-License-Identifier: (MIT OR GPL-2.0-only WITH Classpath-exception-2.0) AND Apache-2.0\nmit license mit license",
        "<|endoftext|> it's DON'T 12.5% 'll",
    ]
    rows += [(1000 + i, t) for i, t in enumerate(more)]
    rows.append((1010, texts[0]))  # a repeated row
    return rows


def odd_vectors():
    """Vectors with common beginnings, copies, ties, and some that cannot be used."""
    rows = []
    for k in range(700):
        x = [((k * (i + 3) * 7919) % 41 - 20) / 64 for i in range(16)]
        if k % 3 == 0:
            x[:3] = [0.25, -0.125, k % 2 / 8]
        if k % 50 == 0:
            x = [0.5] * 16
        rows.append((k, x, None if k % 7 == 0 else k % 5))
    rows += [(3, [0.1] * 16, 1), (3, [0.1] * 16, 1), (None, [-0.3] * 16, 2), (800, None, 1), (801, [None] + [0.0] * 15, 1)]
    return rows + [(802, [float("nan")] * 16, 1), (803, [float("-inf")] * 16, None), (804, [], 1), (805, [1.0] * 9, 4)]


def frame(spark, rows):
    schema = T.StructType.fromDDL(f"{DOCUMENT}, {CLASHING}")
    return spark.createDataFrame([(k, t, None, None, None, *["x"] * 10) for k, t in rows], schema)


def write(spark, folder, documents):
    bench = [
        (1, "One two three four five six seven eight nine ten eleven twelve"),
        (2, "tiny"),
        (2, "tiny"),
        (3, None),
        (4, "..."),
        (None, "two words"),
        (10, "one two three four five six seven eight nine ten"),
    ]
    labels = [(k, int(k % 3 != 0), 0) for k, _ in documents[:30] if k is not None] + [(None, 1, 0), (3, None, None)]
    page = "<p>" + "same page " * 200 + "</p>"
    pages = [(1, "http://a/é b", page), (2, None, page), (3, "u\r\nX: 1", "short"), (4, "u", "short"), (5, "u", None), (6, "u", ""), (7, "u", page), (7, "u", page), (8, "u", "ü" * 700)]
    vectors = odd_vectors()
    if not documents:
        bench, labels, pages, vectors = [], [], [], []
    frame(spark, documents).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{folder}/pages.parquet")
    kinds = T.StructType.fromDDL("vec_id long, embedding array<float>, label int, code string, tries string, vector string, n string")
    spark.createDataFrame([(*v, *["x"] * 4) for v in vectors], kinds).write.parquet(f"{folder}/embeddings.parquet")
    return documents


@pytest.fixture(scope="session")
def odd(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("odd") / "data")
    return folder, write(spark, folder, odd_documents())


@pytest.fixture(scope="session")
def nothing(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("nothing") / "data")
    return folder, write(spark, folder, [])
