"""Vector codes, SuperMinHash groups and spelling variants, against brute force."""

import numpy as np
import pytest

from quartermark.llm import part_codes, spelling, super_minhash
from quartermark.llm.forests import spanning_forest
from quartermark.llm.queries import ORACLE, QUERIES
from tests import compare
from tests.llm import brute


def same(actual, expected):
    assert sorted(map(tuple, actual), key=repr) == sorted(expected, key=repr)


def test_vector_codes(spark, odd):
    rows = [tuple(r)[:3] for r in spark.read.parquet(f"{odd[0]}/embeddings.parquet").collect()]
    same(QUERIES["op11_vector_codes"](spark, odd[0]).collect(), brute.vector_codes(rows))


def test_vector_codes_match_sql(spark, sf_dir):
    con = compare.connect(sf_dir)
    assert compare.differences(QUERIES["op11_vector_codes"](spark, sf_dir), con, ORACLE["op11_vector_codes"]) is None


def test_vectors_of_other_kinds(spark):
    """Doubles, a dimension that four does not divide, huge components, names of labels."""
    rows = [(k, [float(k % 9) / 8, 1e12 * (k % 4), -0.5, k / 3, 2.0, 0.0], f"l{k % 3}") for k in range(40)]
    docs = spark.createDataFrame(rows, "id long, v array<double>, kind string")
    out = part_codes.code_report(docs, key="id", vector="v", label="kind").collect()
    assert len(out) == 40 and all(len(r.code) == 8 for r in out) and sum(r.error for r in out) == 0
    nothing = spark.createDataFrame([(1, []), (2, [])], "vec_id long, embedding array<float>").selectExpr("*", "1 AS label")
    assert [tuple(r)[1:4] for r in part_codes.code_report(nothing).collect()] == [("00000000", 0, 0)] * 2


@pytest.mark.parametrize("width,spread,count", [(16, 2, 5000), (5, 3, 3000), (1, 50, 2500), (9, 700, 3000)])
def test_trie_finds_the_nearest_entries(width, spread, count):
    random = np.random.default_rng(width)
    values = random.integers(-spread, spread, (count, width))
    rows, often, place = part_codes.distinct_parts(values)
    assert (rows[place] == values).all() and often.sum() == count
    book = values[:256]
    distance = ((rows[:, None, :] - book[None]) ** 2).sum(axis=2)
    best, least = part_codes.Trie(rows).nearest(book)
    assert (best == distance.argmin(axis=1)).all() and (least == distance.min(axis=1)).all()


def test_super_minhash(spark, odd):
    folder, docs = odd
    wanted = [(k, n, c, k == c) for k, n, c in brute.groups(docs, 3, 85)]
    same(QUERIES["op12_super_minhash"](spark, folder).collect(), wanted)


def test_super_minhash_on_a_whole_table(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    wanted = [(k, n, c, k == c) for k, n, c in brute.groups(docs, 3, 85)]
    same(QUERIES["op12_super_minhash"](spark, sf_dir).collect(), wanted)


def test_super_minhash_in_several_blocks(spark):
    """Chains of near copies in one tie, with blocks far smaller than the tie."""
    words = [f"w{i}" for i in range(4000)]
    chain = [(k, " ".join(words[2 * k : 2 * k + 60])) for k in range(90)]
    other = [(1000 + k, " ".join([*words[3000:3060], f"x{k}"])) for k in range(40)] + [(2000, None), (7, "w1 w2")]
    docs = spark.createDataFrame(chain + other, "doc_id long, text string")
    wanted = [(k, n, c, k == c) for k, n, c in brute.groups(chain + other, 3, 85)]
    # The document 7 occurs twice, with different texts.
    merged = {k: c for k, n, c, _ in wanted}
    out = super_minhash.near_duplicates(docs, block=16).collect()
    assert {(r.doc_id, r.component_id) for r in out} == {(k, merged[k]) for k in merged}


def test_signature_slots_agree_as_often_as_sets(spark):
    random = np.random.default_rng(5)
    for n in (8, 60, 900):
        errors = []
        for _ in range(200):
            common = 3 * n // 4
            pool = random.integers(0, 1 << 63, 2 * n - common).astype(np.uint64)
            sets = np.concatenate([pool[:n], pool[n - common :]])
            one, two = super_minhash.signatures(sets, np.array([n, n]))
            errors.append((one == two).mean() - common / (2 * n - common))
        true = common / (2 * n - common)
        assert abs(np.mean(errors)) < 0.012 and np.std(errors) < 1.1 * (true * (1 - true) / 120) ** 0.5


def test_spanning_forest():
    random = np.random.default_rng(2)
    for _ in range(100):
        n = int(random.integers(1, 50))
        key, node = random.integers(0, n, n).astype(np.uint64), random.integers(0, n, n)
        label, edges = spanning_forest(key, node)
        root = {x: x for x in node.tolist()}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        first = {}
        for k, x in zip(key.tolist(), node.tolist()):
            small, large = sorted((find(first.setdefault(k, x)), find(x)))
            root[large] = small
        assert label.tolist() == [find(x) for x in node.tolist()]
        assert len(edges) == len(root) - len(set(label.tolist()))


def test_spelling(spark, odd):
    folder, docs = odd
    same(QUERIES["op13_spelling"](spark, folder).collect(), brute.spelling(docs))


def test_spelling_on_a_whole_table(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    wanted = brute.spelling(docs)
    same(QUERIES["op13_spelling"](spark, sf_dir).collect(), wanted)
    assert sum(w[1] is not None for w in wanted) > 3


@pytest.mark.parametrize("most", [10, 100, 100_000])
def test_spelling_of_close_words(spark, most):
    """Words over few letters, most of which are near many others; chains of forms; long words."""
    random = np.random.default_rng(most)
    words = ["".join(random.choice(list("abé"), random.integers(6, 9))) for _ in range(300)]
    text = " ".join(w for i, w in enumerate(words) for _ in range(5 + 23 * (i % 7) ** 2))
    chain = " ".join(w for i, w in enumerate(["colouring", "colourings", "xcolourings", "xcolouringss"]) for _ in range(5 ** (4 - i)))
    docs = [(1, text), (2, chain.upper()), (None, "z" * 5000 + " "), (3, " ".join(["z" * 5000, "z" * 4999] * 5)), (4, None), (5, "")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    same(spelling.variants(frame, most=most).collect(), brute.spelling(docs))


def test_long_texts_are_read_in_pieces():
    data = b" ".join([b"ab", "é".encode() * 5] * 300_000)
    parts = list(spelling.pieces(data))
    assert b"".join(parts) == data and len(parts) > 1
    assert sum(len(spelling.RUN.findall(p)) for p in parts) == 600_000
