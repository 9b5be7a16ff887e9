"""Spelling variants by an index of variable-length grams.

Gram dictionary: all grams of ``SHORTEST`` to ``LONGEST`` characters of the
words are counted. A gram is pruned, that is only kept as the beginning of
longer ones, if it is frequent: if more than one in ``FREQUENT`` of all grams
are equal to it. So at most ``FREQUENT`` grams are frequent, however many words
there are, and that bounds what workers get.

Decomposition: at each place of a word stands the shortest gram that is not
frequent (or one of ``LONGEST`` characters). Blanks beyond the end of the word
count as characters, so every place has a gram. A gram depends on its own
characters only.

Bound: an edit changes no gram but those that contain the edited place (for an
insertion, those that reach over the gap). The most grams that one place lies
in, the affected grams, are counted for each word: of so many grams and one
more, at least one is left alone wherever the edit is. So with the grams of a
word in one order for all words (frequent ones last), the first one that a
given edit leaves alone is among those, and it is the same gram in both words.
A word is listed under that gram for each of its places.

Merging: all that stands on the far side of the edited place from the gram is
not known to be equal, but all on the gram's own side up to it is, and so are
the characters beyond the place. A list therefore is kept by gram, by all
that stands between it and its end of the word, by up to ``BEYOND`` characters
at the other end, and by the length of the word. Lists of equal key are merged
with those of equal and of next larger length. What meets is verified by the
edit distance, and each pair counts once.

Words need more than ``LONGEST`` characters, else an edit may change all grams.

Defined results: null and blank texts have no runs. A null id is written as
blank text in the hashed name. Repeated rows count each. A word that no other
one is near to has no form and is its own root. An empty table, or one without
a word that is frequent enough, gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartermark.llm.words import binary
from quartermark.session import written_once

# Fixed values of the contract.
RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")
DAMAGED_ONE_IN = 199
LEAST_LENGTH = 6
LEAST_COUNT = 5
FORM_FACTOR = 5

SHORTEST = 2
LONGEST = 5
FREQUENT = 100_000
BEYOND = 2
# Words up to this length travel in the lists and are compared there; others are looked up.
CARRIED = 64
# Lists below this length are short enough, whatever share of all grams they are.
SHORT_LIST = 8
END = " "

# Distinct words that a task holds, and the bytes of text it looks at, at once.
HELD_WORDS = 200_000
PIECE_BYTES = 4 << 20


def pieces(data: bytes) -> Iterator[bytes]:
    """A long text in pieces that do not cut a run; a run longer than a piece stays whole."""
    at = 0
    while at < len(data):
        to = at + PIECE_BYTES
        while to < len(data) and (data[to] >= 0x80 or 0x61 <= data[to] <= 0x7A):
            to += 1
        yield data[at:to]
        at = to


def without(run: bytes, place: int) -> bytes:
    text = run.decode()
    at = place % len(text)
    return (text[:at] + text[at + 1 :]).encode()


def run_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST_LENGTH) -> DataFrame:
    """(word, n): results of at least ``least`` code points, with the damage of the contract."""
    chosen = docs.select(
        F.coalesce(F.col(key).cast("string"), F.lit("")).alias("doc_id"), F.col(text).cast("string").alias("text")
    )

    def run(batches):
        held: Counter[bytes] = Counter()

        def flush():
            long_enough = {w.decode(): n for w, n in held.items() if len(w) >= least}
            long_enough = {w: n for w, n in long_enough.items() if len(w) >= least}
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(long_enough.keys(), pa.string()), pa.array(long_enough.values(), pa.int64())], ["word", "n"]
            )

        for batch in batches:
            texts = binary(batch.column("text"))
            for i, name in enumerate(batch.column("doc_id").to_pylist()):
                start = zlib.crc32(f"{name}:".encode())
                for piece in pieces(texts[i].as_py().lower()):
                    # Damage only shortens a run, and a code point has at least a byte.
                    for word, n in Counter([w for w in RUN.findall(piece) if len(w) >= least]).items():
                        h = zlib.crc32(word, start)
                        held[word if h % DAMAGED_ONE_IN else without(word, h)] += n
                    if len(held) >= HELD_WORDS:
                        yield flush()
        if held:
            yield flush()

    return chosen.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def frequent_grams(words: DataFrame, shortest: int = SHORTEST, longest: int = LONGEST, most: int = FREQUENT) -> dict[str, int]:
    """Grams above the bound of frequency, with their counts; fewer than ``most``."""
    if longest < shortest:
        raise ValueError("the longest gram is shorter than the shortest")
    padded = F.concat("word", F.lit(END * (longest - 1)))
    grams = words.select(F.length("word").alias("len"), padded.alias("w"))
    total = grams.agg(F.coalesce(F.sum("len"), F.lit(0)).alias("n")).first()["n"] * (longest - shortest + 1)
    every = F.flatten(
        F.transform(
            F.sequence(F.lit(1), F.col("len")),
            lambda p: F.transform(F.sequence(F.lit(shortest), F.lit(longest)), lambda q: F.substring(F.col("w"), p, q)),
        )
    )
    counted = grams.select(F.explode(every).alias("gram")).groupBy("gram").agg(F.count("*").alias("n"))
    return {r["gram"]: r["n"] for r in counted.filter(F.col("n") > max(SHORT_LIST, total // most)).collect()}


def decompose(word: str, frequent: dict[str, int], shortest: int = SHORTEST, longest: int = LONGEST) -> list[tuple[int, str]]:
    """(end, gram) at each place of the word."""
    padded = word + END * (longest - 1)
    out = []
    for at in range(len(word)):
        size = shortest
        while size < longest and padded[at : at + size] in frequent:
            size += 1
        out.append((at + size, padded[at : at + size]))
    return out


def most_affected(ends: list[int], length: int) -> int:
    """The largest number of grams that contain one place; gram i reaches from i up to its end."""
    change = [0] * (length + 1)
    for start, end in enumerate(ends):
        change[start] += 1
        change[min(end, length)] -= 1
    most = now = 0
    for step in change[:length]:
        now += step
        most = max(most, now)
    return most


_BASE, _PRIME = 0x100000001B3, (1 << 61) - 1


def longer_hash(start: int, text: str) -> int:
    for c in text:
        start = (start * _BASE + ord(c) + 1) % _PRIME
    return start


def reach_hashes(text: str) -> list[int]:
    """A hash of each beginning of a text, by its length."""
    out = [0]
    for c in text:
        out.append(longer_hash(out[-1], c))
    return out


def list_keys(word: str, frequent: dict[str, int], shortest: int = SHORTEST, longest: int = LONGEST) -> set[int]:
    """The lists in which a word stands, for each place where an edit may be: those of the first gram it leaves alone."""
    length = len(word)
    grams = decompose(word, frequent, shortest, longest)
    order = sorted((frequent.get(gram, 0), gram, start, end) for start, (end, gram) in enumerate(grams))
    # At most so many grams contain one place, so one more always has one that does not.
    first = [(start, end) for _, _, start, end in order[: most_affected([end for end, _ in grams], length) + 1]]
    ahead, behind = reach_hashes(word), reach_hashes(word[::-1])
    keys = set()
    # The edit replaces or deletes a character, or inserts one between two.
    for left, right in [(i, i + 1) for i in range(length)] + [(i, i) for i in range(length + 1)]:
        start, end = next((s, e) for s, e in first if e <= left or s >= right)
        if end <= left:
            key, beyond = 2 * ahead[end], word[max(right, length - BEYOND) :]
        else:
            key, beyond = 2 * behind[length - start] + 1, word[: min(left, BEYOND)]
        keys.add(longer_hash(key % _PRIME, beyond) * (BEYOND + 1) + len(beyond))
    return keys


def near_pairs(words: DataFrame, shortest: int = SHORTEST, longest: int = LONGEST, most: int = FREQUENT) -> DataFrame:
    """(a, an, b, bn): every pair of words one edit apart, once; ``words`` has word and n."""
    frequent = words.sparkSession.sparkContext.broadcast(frequent_grams(words, shortest, longest, most))

    def lists(batches):
        for batch in batches:
            keys, owners = [], []
            for i, word in enumerate(batch.column("word").to_pylist()):
                found = list_keys(word, frequent.value, shortest, longest)
                keys += found
                owners += [i] * len(found)
            at = pa.array(owners, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), *(batch.column(c).take(at) for c in ("id", "len", "short"))],
                ["key", "id", "len", "short"],
            )

    named = words.select("word", "n", F.xxhash64("word").alias("id"), F.length("word").alias("len"))
    short = F.when(F.col("len") <= CARRIED, F.col("word")).alias("short")
    entries = written_once(
        named.select("word", "id", "len", short).mapInArrow(lists, "key long, id long, len int, short string"), "gram-lists"
    )
    probes = entries.select(
        "key", F.col("id").alias("ida"), F.col("short").alias("a"), F.col("len").alias("own"), F.explode(F.array("len", F.col("len") + 1)).alias("len")
    )
    index = entries.select("key", "len", F.col("id").alias("idb"), F.col("short").alias("b"))
    # Of two words of one length, one probes. The edit distance of a word that is looked up is not known yet.
    near = F.coalesce(F.levenshtein("a", "b", 1) == 1, F.lit(True))
    met = probes.join(index, ["key", "len"]).filter(F.expr("own < len OR ida <= idb") & near).select("ida", "idb").distinct()
    one = named.select(F.col("id").alias("ida"), F.col("word").alias("a"), F.col("n").alias("an"))
    two = named.select(F.col("id").alias("idb"), F.col("word").alias("b"), F.col("n").alias("bn"))
    ordered = (F.col("ida") != F.col("idb")) | (F.col("a") < F.col("b"))
    pairs = met.join(one, "ida").join(two, "idb").filter(ordered & (F.levenshtein("a", "b", 1) == 1))
    return pairs.select("a", "an", "b", "bn")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the end of the chain of forms (word, form). Chains end, since counts rise along them.

    Each round doubles the steps taken, so a few rounds do.
    """
    reached = forms.select("word", F.col("form").alias("root"))
    while True:
        ahead = reached.select(F.col("word").alias("root"), F.col("root").alias("further"))
        stepped = written_once(reached.join(ahead, "root", "left").select("word", "root", "further"), "roots")
        reached = stepped.select("word", F.coalesce("further", "root").alias("root"))
        if stepped.filter("further IS NOT NULL").isEmpty():
            return reached


def variants(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    least_count: int = LEAST_COUNT,
    factor: int = FORM_FACTOR,
    shortest: int = SHORTEST,
    longest: int = LONGEST,
    most: int = FREQUENT,
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word that occurs often enough."""
    words = written_once(run_counts(docs, key, text, max(LEAST_LENGTH, longest + 1)).filter(F.col("n") >= least_count), "words")
    pairs = written_once(near_pairs(words, shortest, longest, most), "near-words")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("bn").alias("an"), F.col("a").alias("b"), F.col("an").alias("bn")))
    near = both.groupBy(F.col("a").alias("word")).agg(
        F.count("*").alias("n_near"),
        # The largest count, then the smallest word.
        F.min(F.struct((-F.col("bn")).alias("less"), F.col("b").alias("form"))).alias("best"),
        F.first("an").alias("own"),
    )
    big = F.col("own") * factor <= -F.col("best.less")
    near = near.select(
        "word", "n_near", F.when(big, F.col("best.form")).alias("form"), F.when(big, -F.col("best.less")).alias("form_n")
    )
    near = written_once(near, "forms")
    ends = roots(near.filter("form IS NOT NULL"))
    return (
        words.join(near, "word", "left")
        .join(ends, "word", "left")
        .select(
            "word",
            "form",
            F.coalesce("root", "word").alias("root"),
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            "form_n",
        )
    )
