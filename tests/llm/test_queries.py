"""The registered queries on odd and empty tables, against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from quartermark.llm import kneser_ney, quality_mil, queries
from quartermark.llm.queries import QUERIES, ORACLE, public_tokenizer
from tests import compare
from tests.llm import brute


def got(spark, name, folder):
    return sorted((tuple(r) for r in QUERIES[name](spark, folder).collect()), key=repr)


def same(actual, expected):
    assert sorted(actual, key=repr) == sorted(expected, key=repr)


def items(spark, folder):
    return [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]


@pytest.mark.parametrize("name", list(QUERIES))
def test_empty_tables(spark, nothing, name):
    assert got(spark, name, nothing[0]) == []


def test_decontamination(spark, odd):
    folder, docs = odd
    same(got(spark, "op1_decontamination", folder), brute.decontamination(docs, items(spark, folder)))


def test_packing(spark, odd):
    from tokenizers import Tokenizer

    folder, docs = odd
    tokenizer = Tokenizer.from_file(public_tokenizer("word_bpe_49k.json"))
    wanted = Counter()
    for key, text in docs:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], np.uint32)
        wanted[key, ids.tobytes()] += 1
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in QUERIES["op2_packing"](spark, folder).collect():
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for (key, data), copies in wanted.items():
        ids = np.frombuffer(data, np.uint32)
        pieces = sorted((r.start, r.length, r.ids_crc32) for r in by_doc[key])
        assert all(r.doc_tokens == len(ids) for r in by_doc[key])
        assert all(c == zlib.crc32(ids[s : s + n].tobytes()) for s, n, c in pieces)
        cover = np.zeros(len(ids), int)
        for start, length, _ in pieces:
            cover[start : start + length] += 1
        assert (cover == copies).all()
    padding = 0
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 4096
        padding += 4096 - at if at & (at - 1) else 0
    assert padding < 0.01 * 4096 * len(by_sequence)


def test_suffix_dedup(spark, odd):
    folder, docs = odd
    same(got(spark, "op3_suffix_dedup", folder), brute.byte_dedup(docs))


def test_jaccard_join(spark, odd):
    folder, docs = odd
    same(got(spark, "op4_jaccard_join", folder), brute.groups(docs))


def test_fingerprints(spark, odd):
    folder, docs = odd
    rows = QUERIES["op5_fingerprints"](spark, folder).collect()
    assert len(rows) == len(docs)
    by_text = defaultdict(set)
    texts = dict(docs)
    ordered = sorted(docs, key=lambda d: d[0])
    following = {k: [t or "" for j, t in ordered[i + 1 : i + 2]] or [ordered[0][1] or ""] for i, (k, _) in enumerate(ordered)}
    for r in rows:
        text = texts[r.doc_id] or ""
        by_text[text].add(r.fingerprint)
        n = len(text) // 4
        assert r.n_chars == len(text)
        if r.doc_id != 1010:  # its copies follow one another
            edited = text[: len(text) - n] + following[r.doc_id][0][:n]
            assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert all(len(f) == 1 for f in by_text.values())


def test_substring_dedup(spark, odd):
    folder, docs = odd
    same(got(spark, "op6_substring_dedup", folder), brute.word_dedup(docs))


def test_licence_scan(spark, odd):
    folder, docs = odd
    rows = QUERIES["op7_licence_scan"](spark, folder).collect()
    same([tuple(r)[:6] for r in rows], brute.licences(docs))
    for r in rows:
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert 0 <= r.score <= 1
    tagged = next(r for r in rows if r.doc_id == 1020)
    assert "gpl-2.0-only with classpath-exception-2.0" in tagged.labels


def test_warc(spark, odd):
    folder, _ = odd
    rows = got(spark, "op8_warc", folder)
    pages = [tuple(r) for r in spark.read.parquet(f"{folder}/pages.parquet").collect()]
    bodies = [(k, (h or "").encode()) for k, _, h in pages]
    wanted = []
    for key, body in bodies:
        kept = max(k for k, b in bodies if b == body)
        again = len(body) >= 1000 and kept != key
        wanted.append((key, len(body), hashlib.sha1(body).hexdigest(), "revisit" if again else "response", kept if again else None))
    same(rows, wanted)


def test_warc_against_sql(spark, sf_dir):
    assert compare.differences(QUERIES["op8_warc"](spark, sf_dir), compare.connect(sf_dir), ORACLE["op8_warc"]) is None


def test_quality(spark, odd, sf_dir):
    folder, docs = odd
    rows = QUERIES["op9_quality"](spark, folder).collect()
    assert sorted(r.doc_id for r in rows) == sorted(k for k, _ in docs)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)


def test_quality_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = QUERIES["op9_quality"](spark, folder).join(labels, "doc_id").filter("held_out").collect()
    right = sum(r.predicted == r.quality for r in rows)
    assert right >= 0.95 * len(rows)


def model_scores(docs, held):
    """The base score, and interpolated modified Kneser-Ney from its formulas."""
    texts = [brute.blank_words(brute.lower(t)) + ["\n"] for _, t in docs]
    train = [w for (k, _), w in zip(docs, texts) if not held(k)]
    words = Counter(x for w in train for x in w)
    total, kinds = sum(words.values()), len(words)
    pairs = Counter(p for w in train for p in zip(["\t", *w], w))

    def discounts(counts):
        n = [sum(c == i for c in counts.values()) for i in range(1, 5)]
        if min(n) <= 0:
            return [0, 0.5, 0.75, 1.0]
        y = n[0] / (n[0] + 2 * n[1])
        return [0, *(min(max(i - (i + 1) * y * n[i] / n[i - 1], 0.05), i - 0.05) for i in (1, 2, 3))]

    before = Counter(v for _, v in pairs)
    d2, d1 = discounts(pairs), discounts(before)
    rest = sum(d1[min(c, 3)] for c in before.values()) / len(pairs)
    after, lost = Counter(), Counter()
    for (u, _), c in pairs.items():
        after[u] += c
        lost[u] += d2[min(c, 3)]

    def single(v):
        return max(before.get(v, 0) - d1[min(before.get(v, 0), 3)], 0) / len(pairs) + rest / (kinds + 1)

    def chance(u, v):
        if u not in after:
            return single(v)
        c = pairs.get((u, v), 0)
        return max(c - d2[min(c, 3)], 0) / after[u] + lost[u] / after[u] * single(v)

    assert abs(sum(chance("\t", v) for v in words) + lost["\t"] / after["\t"] * rest / (kinds + 1) - 1) < 1e-9
    for w in texts:
        base = sum(math.log10((words.get(x, 0) + 0.1) / (total + 0.1 * (kinds + 1))) for x in w)
        yield len(w), sum(x in words for x in w), total, base, sum(math.log10(chance(u, v)) for u, v in zip(["\t", *w], w))


def trigram_scores(docs, held):
    """log10 of interpolated modified Kneser-Ney over three words, level by level from the formulas."""
    texts = [["\t", *brute.blank_words(brute.lower(t)), "\n"] for _, t in docs]
    train = [w for (k, _), w in zip(docs, texts) if not held(k)]
    triples = Counter(g for w in train for g in zip(w, w[1:], w[2:]))
    raw = Counter(g for w in train for g in zip(w, w[1:]))
    pairs = Counter(g[1:] for g in triples)
    pairs.update({g: c for g, c in raw.items() if g[0] == "\t"})
    words = Counter(g[1] for g in raw)

    def level(counts):
        n = [sum(c == i for c in counts.values()) for i in range(1, 5)]
        y = n[0] / (n[0] + 2 * n[1]) if min(n) > 0 else 0
        few = [min(max(i - (i + 1) * y * n[i] / n[i - 1], 0.05), i - 0.05) for i in (1, 2, 3)] if min(n) > 0 else [0.5, 0.75, 1.0]
        d, after, lost = [0, *few], Counter(), Counter()
        for g, c in counts.items():
            after[g[:-1]] += c
            lost[g[:-1]] += d[min(c, 3)]
        return counts, d, after, lost

    levels = [level(Counter({(w,): c for w, c in words.items()})), level(pairs), level(triples)]

    def chance(gram):
        if not gram:
            return 1 / (len(words) + 1)
        counts, d, after, lost = levels[len(gram) - 1]
        if not after[gram[:-1]]:
            return chance(gram[1:])
        c = counts.get(gram, 0)
        return (max(c - d[min(c, 3)], 0) + lost[gram[:-1]] * chance(gram[1:])) / after[gram[:-1]]

    for context in [("\t",), next(g for g in raw if g[1] != "\n"), max(raw, key=raw.get)]:
        assert abs(sum(chance((*context, v)) for v in [*words, "never seen"]) - 1) < 1e-9
    return [sum(math.log10(chance(tuple(w[max(i - 2, 0) : i + 1]))) for i in range(1, len(w))) for w in texts]


def test_language_model_of_three_words(spark, odd):
    folder, docs = odd

    def held(key):
        return zlib.crc32(str(key).encode()) % 10 == 0

    # The base columns do not depend on the order of the model.
    base = [s[:4] for s in model_scores(docs, held)]
    wanted = sorted((k, held(k), *b, s) for (k, _), b, s in zip(docs, base, trigram_scores(docs, held)))
    rows = sorted(tuple(r) for r in QUERIES["op10_language_model"](spark, folder).collect())
    assert [r[:5] for r in rows] == [w[:5] for w in wanted]
    np.testing.assert_allclose([r[5:] for r in rows], [w[5:] for w in wanted], rtol=1e-9)


def test_language_model_of_pairs(spark, odd):
    folder, docs = odd

    def held(key):
        return zlib.crc32(str(key).encode()) % 10 == 0

    frame = spark.read.parquet(f"{folder}/documents.parquet")
    model = kneser_ney.train(frame.filter(~quality_mil.held_out("doc_id", 10)), order=2)
    wanted = sorted((k, *s) for (k, _), s in zip(docs, model_scores(docs, held)))
    rows = sorted(tuple(r)[:6] for r in kneser_ney.score(frame, model).collect())
    assert [r[:4] for r in rows] == [w[:4] for w in wanted]
    np.testing.assert_allclose([r[4:] for r in rows], [w[4:] for w in wanted], rtol=1e-9)


def test_all_numbers_are_registered():
    assert sorted(int(q.split("_")[0][2:]) for q in queries.QUERIES) == list(range(1, 14))


def test_decontamination_in_blocks(spark, odd):
    """Several blocks, more than a task keeps open, and items cut into pieces give the rows of one block."""
    from quartermark.llm import decontaminate

    folder, docs = odd
    documents, benchmark = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "benchmark"))
    whole = decontaminate.hit_report(decontaminate.mark_hits(documents, benchmark, block_words=3))
    wanted = brute.decontamination(docs, items(spark, folder))
    same([tuple(r) for r in whole.collect()], wanted)
    kept = decontaminate.clean_documents(documents, benchmark, block_words=3)
    clean = Counter(row[0] for row in wanted if not row[5])
    assert Counter(r.doc_id for r in kept.collect()) == clean
    pieces = decontaminate.item_pieces(benchmark, window=4, windows=2).collect()
    joined = defaultdict(set)
    for r in pieces:
        words = np.frombuffer(r.words, np.uint64).tolist()
        assert len(words) == r.n_words <= 5
        joined[r.item] |= {tuple(words[i : i + 4]) for i in range(max(1, len(words) - 3))}
    assert len(joined["1"]) == 9 and len(joined["2"]) == 1 and "4" not in joined


def test_fingerprints_likeness(spark, odd):
    """Exact below the sketch size, near the true share above it."""
    folder, docs = odd
    texts = dict(docs)
    ordered = [t or "" for _, t in sorted(docs, key=lambda d: d[0])]
    keys = sorted(k for k, _ in docs)

    def likeness(a, b):
        one, two = ({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for w in (brute_words(a), brute_words(b)))
        return (len(one & two) / len(one | two) if one | two else 1.0), len(one | two)

    seen = 0
    for r in QUERIES["op5_fingerprints"](spark, folder).collect():
        if r.doc_id == 1010:  # its copies follow one another
            continue
        text, following = texts[r.doc_id] or "", ordered[(keys.index(r.doc_id) + 1) % len(keys)]
        n = len(text) // 4
        for value, other in ((r.near_edited, text[: len(text) - n] + following[:n]), (r.near_next, following)):
            wanted, size = likeness(text, other)
            assert abs(value - wanted) < (1e-9 if size <= 128 else 0.2), (r.doc_id, value, wanted)
            seen += size > 128
    assert seen


def brute_words(text):
    return [w for w in re.split("[ \\t-\\r]+", text) if w]


@pytest.mark.parametrize("hot", ["CAST(NULL AS BIGINT)", "7L"])
def test_fingerprint_ranges_are_even(spark, hot):
    from pyspark.sql import functions as F

    from quartermark.llm import sketches

    rows = spark.range(0, 4000, 1, 4).selectExpr(f"IF(id % 3 < 2, {hot}, id) AS doc_id", "CONCAT('text ', id) AS text")
    bounds, late = sketches.range_bounds(rows, "doc_id", 32)
    tie = F.xxhash64("text")
    placed = rows.select("*", sketches.range_of(F.col("doc_id"), tie, bounds, late).alias("part"), tie.alias("tie")).collect()
    assert max(Counter(r.part for r in placed).values()) < 4 * 4000 / 32
    ordered = sorted(placed, key=lambda r: (r.doc_id is None, r.doc_id or 0, r.tie))
    assert [r.part for r in ordered] == sorted(r.part for r in placed)
    wanted = {r.text: n.text for r, n in zip(ordered, ordered[1:] + ordered[:1])}
    got_next = sketches.with_next(rows, "doc_id", ["text"]).collect()
    assert len(got_next) == 4000 and {r.text: r.next_text for r in got_next} == wanted


def test_fingerprint_plan_holds_the_bounds_once(spark):
    from pyspark.sql import functions as F

    from quartermark.llm import sketches

    rows = spark.range(10).selectExpr("id AS doc_id", "'a' AS text")

    def length(n):
        column = sketches.range_of(F.col("doc_id"), F.xxhash64("text"), list(range(n)), 1)
        return len(rows.select(column)._jdf.queryExecution().analyzed().toString())

    assert length(4000) < length(40) + 4000 * 8


def test_licence_expressions():
    import random
    import time

    from quartermark.llm import licences

    pick = random.Random(5)

    def tree(depth):
        if depth == 0 or pick.random() < 0.2:
            return pick.choice(["MIT", "GPL-2.0-only", "Apache-2.0", "X11", ("with", "GPL-2.0-only", "Bison-exception")])
        return (pick.choice(["and", "or"]), tree(depth - 1), tree(depth - 1))

    def text(node, above=0):
        if isinstance(node, str):
            return node
        rank = licences.PRECEDENCE[node[0]]
        inner = f"{text(node[1], rank)} {node[0].upper()} {text(node[2], rank + 1)}"
        return f"({inner})" if rank < above or pick.random() < 0.3 else inner

    def value(node):
        if isinstance(node, str):
            return {node.lower()}, licences.evaluate([node])[1]
        (left, a), (right, b) = value(node[1]), value(node[2])
        if node[0] == "with":
            return {f"{min(left)} with {min(right)}"}, a
        return left | right, max(a, b) if node[0] == "or" else min(a, b)

    for _ in range(300):
        node = tree(5)
        assert licences.evaluate(licences.postfix(text(node))) == value(node)
    # Of a broken expression the longest valid beginning counts.
    assert licences.postfix("MIT OR X11 AND (GPL") == ["MIT", "X11", "or"]
    assert licences.postfix("MIT)") == ["MIT"] and licences.postfix("OR MIT") is None and licences.postfix("(MIT") is None
    begun = time.time()
    for long in (
        " OR ".join(f"L{i}" for i in range(100_000)),
        "(" * 100_000 + "MIT" + ")" * 100_000,
        " WITH ".join(["a"] * 100_000),
        f"({' OR '.join(f'A{i}' for i in range(5_000))}) WITH ({' OR '.join(f'B{i}' for i in range(5_000))})",
    ):
        assert licences.evaluate(licences.postfix(long))[0]
    assert time.time() - begun < 20
