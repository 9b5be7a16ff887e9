"""Inner parts, and ways that only hot or large groups take."""

import functools
import random
import time
import zlib

import numpy as np
import pytest

from quartermark.llm import fm_dedup, jaccard_trees, kneser_ney, licences, packing, quality_mil, shared, sketches, suffix_dedup, warc
from quartermark.llm.queries import public_tokenizer
from quartermark.llm.suffix_arrays import common_prefixes, suffix_array, with_sentinels
from tests.llm import brute
from tests.llm.conftest import frame


def test_suffix_arrays():
    rng = random.Random(3)
    for _ in range(100):
        strings = ["".join(rng.choice("ab") for _ in range(rng.randint(1, rng.choice([3, 30])))) for _ in range(rng.randint(1, 8))]
        symbols = np.array([ord(c) - 96 for s in strings for c in s], np.int64)
        text, first, ends = with_sentinels(symbols, np.array([len(s) for s in strings]))
        order, rank = suffix_array(text, first, ends)
        full = [tuple([ord(c) for c in s[i:]] + [k]) for k, s in enumerate(strings) for i in range(len(s) + 1)]
        assert order.tolist() == sorted(range(len(text)), key=lambda i: full[i])
        prefix = common_prefixes(text, first, ends, order, rank)
        for a, b in zip(order[1:], order[:-1]):
            x, y = full[a][:-1], full[b][:-1]
            k = 0
            while k < min(len(x), len(y)) and x[k] == y[k]:
                k += 1
            assert prefix[a] == k


def test_common_prefixes_of_long_strings():
    rng = np.random.default_rng(7)
    sizes = np.array([200_000, 0, 70, 200_000])
    symbols = rng.integers(1, 5, sizes.sum())
    symbols[-150_000:] = symbols[:150_000]
    text, first, ends = with_sentinels(symbols, sizes)
    order, rank = suffix_array(text, first, ends)
    begun = time.process_time()
    prefix = common_prefixes(text, first, ends, order, rank)
    assert time.process_time() - begun < 4  # one step for each place of the longest string takes more than twice that
    for place in rng.integers(0, 130_000, 20) + first[3] + 50_000:
        assert prefix[place] == ends[3] - place or prefix[order[rank[place] + 1]] == ends[3] - place

def test_backward_search():
    rng = np.random.default_rng(5)
    sizes = np.array([40, 7, 60])
    numbers = rng.integers(1, 4, sizes.sum())
    marks = np.array([4, 0, 2])
    index = fm_dedup.Index(numbers, sizes, marks)
    first = np.cumsum(sizes) - sizes
    places = np.array([f + i for f, s in zip(first, sizes) for i in range(s - 4)])
    owner = np.repeat(marks, sizes - 4)
    length, low, high = index.statistics(numbers, places, 5)
    windows = [tuple(numbers[p : p + 5]) for p in places]
    for w, n, a, b in zip(windows, length, low, high):
        assert (n == 5) == (windows.count(w) > 1)
        assert b - a == (windows.count(w) if n == 5 else 0)
        if n == 5:
            assert index.marks.least(np.array([a]), np.array([b]))[0] == min(o for v, o in zip(windows, owner) if v == w)


def test_index_keeps_no_text_and_no_suffix_array():
    rng = np.random.default_rng(6)
    sizes = np.full(200, 500)
    index = fm_dedup.Index(rng.integers(1, 256, sizes.sum()), sizes, np.arange(200))
    held = sum(a.nbytes for m in (index.transform, index.marks) for a in (*m.words, *m.counts)) + index.shift.nbytes
    assert held < 4 * index.n  # eight bits of symbol and eight of mark, and half as much for counts


def test_least_value_of_intervals():
    rng = np.random.default_rng(8)
    values = rng.integers(0, 37, 300)
    low = rng.integers(0, 299, 500)
    high = low + 1 + rng.integers(0, 300, 500) % (300 - low)
    got = fm_dedup.WaveletMatrix(values).least(low, high)
    assert got.tolist() == [values[a:b].min() for a, b in zip(low, high)]


@pytest.mark.parametrize("hot", [1, 3])
def test_hot_anchors_are_merged_across_shards(spark, odd, monkeypatch, hot):
    _, docs = odd
    monkeypatch.setattr(shared, "HOT_RUNS", hot)
    for module, expected, columns in ((suffix_dedup, brute.byte_dedup(docs), 5), (fm_dedup, brute.word_dedup(docs), 4)):
        monkeypatch.setattr(module, "repeated_spans", functools.partial(module.repeated_spans, shard_bytes=3000))
        rows = [tuple(r)[:columns] for r in module.remove_repeats(frame(spark, docs).repartition(3)).collect()]
        assert sorted(rows, key=repr) == sorted(expected, key=repr)


def test_ties_of_several_blocks(spark):
    rng = random.Random(1)
    base = [f"w{i}" for i in range(60)]
    docs = []
    for i in range(60):
        words = list(base)
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(60)] = f"x{rng.randrange(30)}"
        docs.append((i, " ".join(words)))
    docs += [(100 + i, " ".join(base[:20] + [f"y{i}{j}" for j in range(60)])) for i in range(20)]
    docs += [(None, " ".join(base))]
    for size, percent in ((4, 85), (5, 80)):
        rows = [tuple(r) for r in jaccard_trees.similar(frame(spark, docs), block=5, size=size, percent=percent).collect()]
        assert sorted(rows, key=repr) == sorted(brute.groups(docs, size, percent), key=repr)


def test_rows_without_id(spark):
    text = " ".join(f"v{i}" for i in range(80))
    docs = [(None, text), (None, text), (5, text), (7, text + " more")]
    rows = [tuple(r)[:4] for r in fm_dedup.remove_repeats(frame(spark, docs)).collect()]
    assert sorted(rows, key=repr) == sorted(brute.word_dedup(docs), key=repr)
    assert len(suffix_dedup.remove_repeats(frame(spark, docs)).collect()) == 4
    assert len(sketches.fingerprints(frame(spark, docs)).collect()) == 4
    assert len(packing.pack(frame(spark, docs), public_tokenizer("word_bpe_49k.json")).collect()) >= 4
    assert licences.scan(frame(spark, docs)).count() == 4


def test_encoder_agrees_with_the_tokenizer():
    encoder = packing.Encoder(public_tokenizer("word_bpe_49k.json"))
    rng = random.Random(2)
    letters = "aB1 '.,-\t é́ßΣ’— st re's'LL0٣"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 14))) for _ in range(3000)]
    ids = encoder.encode([t.encode() for t in texts])
    for text, found in zip(texts, ids):
        assert found.tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids, text


def test_differencing_gives_near_equal_bins():
    rng = random.Random(4)
    sizes = [rng.randint(1, 256) for _ in range(800)]
    home, fullest = packing.differencing(sizes, 25)
    sums = np.bincount(home, sizes, minlength=25)
    assert fullest == sums.max() and sums.max() - sums.min() <= 8


def test_expressions():
    value = lambda e: licences.evaluate(licences.postfix(e))[1]
    assert licences.postfix("a or b and c") == ["a", "b", "c", "and", "or"]
    assert licences.postfix("(a or b) and c") == ["a", "b", "or", "c", "and"]
    assert licences.postfix("MIT. some words") == ["MIT."]
    assert licences.postfix("and or") is None and licences.postfix("") is None
    assert value("MIT OR Unknown") == 1.0 and value("MIT AND Unknown") == 0.5


def test_records_survive_any_chunks():
    pages = [(1, "http://a", b"x" * 5000, "d", None), (2, None, b"", "e", None), (3, "u", b"\r\n\r\nWARC/1.1", "f", 1)]
    data = [warc.record(*p) for p in pages]
    whole = b"".join(data)
    for size in (1, 7, 1000, len(whole)):
        assert list(warc.records(whole[i : i + size] for i in range(0, len(whole), size))) == data


def test_one_member_for_each_record(spark, odd):
    folder, _ = odd
    index = warc.archive(spark.read.parquet(f"{folder}/pages.parquet"))
    assert index.count() == 9 and index.select("path", "at").distinct().count() == 9
    found = {r["id"]: r for r in warc.read_records(index).collect()}
    assert bytes(found["8"]["payload"]).decode() == "ü" * 700


def test_sketches_merge_and_estimate(spark):
    words = [f"t{i}" for i in range(3000)]
    rows = [(1, " ".join(words), " ".join(words[:1500])), (2, "a b", "")]
    df = spark.createDataFrame(rows, "k int, a string, b string")
    from pyspark.sql import functions as F

    a, b = sketches.sketch(F.col("a")), sketches.sketch(F.col("b"))
    out = df.select(
        "k",
        (sketches.merged(a, b) == a).alias("whole"),
        sketches.distinct_count(a).alias("n"),
        sketches.containment(b, a).alias("inside"),
        sketches.resemblance(a, b).alias("alike"),
    )
    one, two = sorted(out.collect())
    assert one.whole and two.whole
    assert abs(one.n - 2996) < 800 and one.inside > 0.75 and abs(one.alike - 0.5) < 0.2
    assert two.n == 1 and two.inside == 1.0 and two.alike == 0.0


def test_no_python_in_fingerprints(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plan = sketches.fingerprints(docs)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_model_without_training_rows(spark):
    model = kneser_ney.train(frame(spark, []))
    row = kneser_ney.score(frame(spark, [(1, "a b")]), model).first()
    assert (row.n_tokens, row.n_known, row.train_tokens) == (3, 0, 0) and row.score == 0.0


@pytest.mark.parametrize("block", [3, 2048])
def test_links_inside_groups(spark, block):
    words = [f"w{i}" for i in range(400)]
    near = [" ".join(words[:k] + [f"new{k}"] + words[k + 1 :]) for k in (50, 120, 200, 280, 350)]
    odd = [(1, near[0]), (1, near[1]), (7, near[0]), (7, near[0]), (8, "a b"), (9, "a b"), (None, near[2]), (10, None), (11, "alone")]
    rows = [(20 + i, t) for i, t in enumerate(near)] + odd
    sets = [(k, brute.shingle_set(t)) for k, t in rows]
    wanted = []
    for k, x in sets:
        linked = {o for o, y in sets if o not in (k, None) and x and y and 100 * len(x & y) >= 85 * len(x | y)}
        wanted.append((k, len(x), 0 if k is None else len(linked)))
    found = jaccard_trees.link_counts(frame(spark, rows), block=block).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(wanted, key=repr)
    assert jaccard_trees.links(frame(spark, rows), block=block).count() == 10


def test_traversal_prunes_node_pairs():
    """Ties that share a tree: dual traversal leaves less than half of all pairs of leaves."""
    random = np.random.default_rng(4)
    sets = []
    for size in random.integers(40, 900, 64):
        base = np.unique(random.integers(0, 1 << 63, size).astype(np.uint64))
        sets += [np.unique(np.concatenate([base[k:], random.integers(0, 1 << 63, k).astype(np.uint64)])) for k in range(8)]
    tree = jaccard_trees.Tree(sets)
    visited = len(tree.leaf_pairs(85)[0])
    leaves = len(tree.levels[0][1])
    assert visited < 0.5 * leaves * (leaves + 1) / 2
    groups = {frozenset(p) for p in jaccard_trees.linked(sets)}
    assert len(groups) == 64 * 7


def test_tables_keep_a_bounded_number_of_files(tmp_path, monkeypatch):
    keys = np.sort(np.random.default_rng(4).integers(0, 1 << 63, 500).astype(np.uint64) * np.uint64(2))
    home = kneser_ney.range_of(keys, 7)
    sizes = np.bincount(home, minlength=7).tolist()
    for r in range(7):
        keys[home == r].tofile(tmp_path / f"key-{r:05d}")
        keys[home == r].tofile(tmp_path / f"count-{r:05d}")
    table = kneser_ney.Ranges(str(tmp_path), sizes, {"key": "<u8", "count": "<u8"})
    wanted = np.sort(np.concatenate([keys, keys[::3] + np.uint64(1)]))
    place = table.find(wanted)
    assert len(table.open) == 7
    monkeypatch.setattr(kneser_ney, "OPEN_FILES", 2)
    few = kneser_ney.Ranges(str(tmp_path), sizes, table.kinds)
    for _ in range(2):
        assert (few.find(wanted) == place).all() and len(few.open) == 2
        assert (few.take("count", place[place >= 0]) == keys).all() and len(few.open) == 2
    # Files that had to be read count by their bytes.
    monkeypatch.setattr(kneser_ney, "READ_BYTES", 8 * max(sizes))
    monkeypatch.setattr(kneser_ney, "array_at", lambda uri, kind: np.fromfile(uri, kind))
    few = kneser_ney.Ranges(str(tmp_path), sizes, table.kinds)
    assert (few.find(wanted) == place).all()
    assert few.read == sum(a.nbytes for a in few.open.values()) <= 8 * max(sizes)


def test_counting_within_homes():
    keys = np.array([5, 1, 5, 5, 1, 7], np.uint64)
    home = np.array([1, 0, 0, 1, 1, 0])
    got = kneser_ney.counted(keys, home=home)
    assert [g.tolist() for g in got] == [[1, 5, 7, 1, 5], [1, 1, 1, 1, 2], [0, 0, 0, 1, 1]]
    again = kneser_ney.counted(np.tile(got[0], 2), np.tile(got[1], 2), np.tile(got[2], 2))
    assert [g.tolist() for g in again] == [[1, 5, 7, 1, 5], [2, 2, 2, 2, 4], [0, 0, 0, 1, 1]]
    assert [len(g) for g in kneser_ney.counted(keys[:0], home=home[:0])] == [0, 0, 0]


def test_counting_sorts_values_where_they_fit(monkeypatch):
    rng = np.random.default_rng(8)
    for largest in (9, 1 << 40, (1 << 64) - 1):
        keys = rng.integers(0, largest, 300, dtype=np.uint64)
        keys = np.concatenate([keys, keys[:100]])
        home = rng.integers(0, 5, 400).astype(np.uint16)
        counts = rng.integers(1, 9, 400)
        found, sums, homes = kneser_ney.counted(keys, counts, home)
        expected = {}
        for h, k, c in zip(home.tolist(), keys.tolist(), counts.tolist()):
            expected[h, k] = expected.get((h, k), 0) + c
        assert dict(zip(zip(homes.tolist(), found.tolist()), sums.tolist())) == expected
        assert list(zip(homes.tolist(), found.tolist())) == sorted(expected) and found.dtype == np.uint64
        for values in (home.astype(np.int64), (keys >> np.uint64(2)).astype(np.int64)):
            in_order, row = kneser_ney.in_order(values)
            assert (values[row] == in_order).all() and (row == np.argsort(values, kind="stable")).all()
        known, code = kneser_ney.distinct(keys)
        assert (known == np.unique(keys)).all() and (known[code] == keys).all()
    few = keys >> np.uint64(30)
    plain, within = kneser_ney.counted(few), kneser_ney.counted(few, home=home)

    def refuse(*_, **__):
        raise AssertionError("an order of rows takes several times as long to sort as values")

    monkeypatch.setattr(np, "argsort", refuse)
    monkeypatch.setattr(np, "lexsort", refuse)
    assert all((a == b).all() for a, b in zip(plain, kneser_ney.counted(few)))
    assert all((a == b).all() for a, b in zip(within, kneser_ney.counted(few, home=home)))


def test_gradients_agree_with_differences():
    rng = np.random.default_rng(12)
    counts = np.array([1, 4, 2, 7])
    x, y = rng.normal(size=(counts.sum(), quality_mil.N_FEATURES)), np.array([1.0, 0.0, 0.0, 1.0])
    network = quality_mil.Network()

    def loss():
        score = network.forward(x, counts)[0]
        return -np.mean(y * np.log(score) + (1 - y) * np.log(1 - score))

    for name, found in network.gradients(x, counts, y).items():
        weights = network.weights[name].reshape(-1)
        for i in rng.choice(weights.size, min(6, weights.size), replace=False):
            kept = weights[i]
            weights[i] = kept + 1e-6
            above = loss()
            weights[i] = kept - 1e-6
            below = loss()
            weights[i] = kept
            assert found.reshape(-1)[i] == pytest.approx((above - below) / 2e-6, rel=1e-4, abs=1e-8), name


def test_training_sample_is_bounded_in_passages(spark, monkeypatch):
    texts = [(i, "word " * (64 * (500 if i % 10 == 3 else 2))) for i in range(60)]
    docs = spark.createDataFrame(texts, "doc_id int, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id int, quality int")
    bags = []
    monkeypatch.setattr(quality_mil.Network, "fit", lambda self, found, y: bags.append((found, y)) or self)
    quality_mil.train(docs, labels, passages=40)
    quality_mil.train(docs, labels)
    trained = sum(zlib.crc32(str(i).encode()) % 5 != 0 for i in range(60))
    (few, y), (every, _) = bags
    assert len(few) == len(y) == 20 and all(len(b) == 2 for b in few)
    assert len(every) == trained
