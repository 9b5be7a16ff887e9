"""Vector code compression: product codes learnt by rounds over lexicographic tries.

Components become integers, vectors are cut into consecutive parts, and each
part position has a codebook of at most 256 entries. The distinct parts of a
slice of vectors, in lexicographic order, are a trie. Depth-first traversal
carries one vector of squared distances to all entries; parts that begin alike
share it as far as they agree. Below the last branch a part is alone and its
remaining dimensions are added at once. Leaves take the nearest entry, and
parts weigh as often as they occur.

Vectors never shuffle. A slice (``SLICE`` vectors) becomes one written row with
its four tries; each round reads those rows and adds up at most one row for
each codebook entry and task. Only codebooks pass through the driver.

Defined results: vectors that are null or hold null or non-finite components
are left out. The dimension is that of the vector with the smallest id (a null
id comes last; the smaller vector of equal ids); a vector of another length
keeps its row, without a code and without an error. A dimension that four does
not divide gives the first parts one component more. Rows with equal ids are
rows of their own. Fewer than 256 vectors give fewer entries; copies among the
first ones give equal entries, of which only the first is ever used. An empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quartermark.llm.shared import pack, unpack
from quartermark.session import written_once

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
SLICE = 8192
# Leaves that are traversed together: their distances fill a few MB.
LEAVES = 1024


def integers(vector: Column) -> Column:
    """floor(1024 x) of each component; null where a vector is not usable."""
    def finite(x):
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    values = vector.cast("array<double>")
    return F.when(F.forall(values, finite), F.transform(values, lambda x: F.floor(x * SCALE)))


def cuts(dimension: int, parts: int = PARTS) -> list[slice]:
    """Consecutive parts of equal length, the first ones one longer if need be."""
    size = [dimension // parts + (k < dimension % parts) for k in range(parts)]
    return [slice(sum(size[:k]), sum(size[: k + 1])) for k in range(parts)]


def narrow(values: np.ndarray) -> np.ndarray:
    """The same numbers in the smallest signed type."""
    top = int(np.abs(values).max(initial=0))
    return values.astype(np.int16 if top < 1 << 15 else np.int32 if top < 1 << 31 else np.int64)


def distinct_parts(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct rows in lexicographic order, how often each occurs, and the place of each row among them."""
    n, width = values.shape
    order = np.lexsort(values.T[::-1]) if width else np.arange(n)
    rows = values[order]
    new = np.ones(n, bool)
    new[1:] = (rows[1:] != rows[:-1]).any(axis=1)
    place = np.empty(n, np.int32)
    place[order] = np.cumsum(new) - 1
    return rows[new], np.bincount(place, minlength=int(new.sum())), place


class Trie:
    """Distinct parts in lexicographic order, seen as a trie over their dimensions."""

    def __init__(self, rows: np.ndarray):
        self.rows = rows
        common = (rows[1:] == rows[:-1]).cumprod(axis=1).sum(axis=1) if len(rows) else np.empty(0, np.int64)
        # Dimensions that a leaf shares with the one before, and with either neighbour.
        self.before = np.concatenate([[0], common]).astype(np.int64)[: len(rows)]
        self.branch = np.maximum(self.before, np.append(self.before[1:], 0)) if len(rows) else self.before

    def nearest(self, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entry of each leaf (the first of equally near ones) and its squared distance."""
        count, width = self.rows.shape
        top = max(int(np.abs(self.rows).max(initial=0)), int(np.abs(book).max(initial=0)))
        # Floats are exact for all sums that occur; else whole numbers without bound.
        kind = np.float64 if 4 * top * top * max(width, 1) < 1 << 53 else object
        rows, book = self.rows.astype(kind), book.astype(kind)
        best, least = np.empty(count, np.int64), np.empty(count, np.int64)
        # Accumulated distances on the path to the leaf visited last, by depth.
        path = [np.zeros(len(book), kind)]
        for low in range(0, count, LEAVES):
            high = min(low + LEAVES, count)
            branch, before = self.branch[low:high], self.before[low:high]
            leaves = np.arange(high - low)
            node, sums, here = np.zeros(high - low, np.int64), path[0][None, :], [path[0]]
            for depth in range(int(branch.max(initial=0)) + 1):
                if depth:
                    inner = leaves[branch[leaves] >= depth]
                    starts = before[inner] < depth
                    starts[:1] |= inner[:1] == 0
                    first = inner[starts]
                    # One step down: what the children add to the sums of their parents.
                    step = rows[low + first, depth - 1][:, None] - book[:, depth - 1][None, :]
                    sums = sums[node[first]] + step * step
                    if first.size and first[0] == 0 and before[0] >= depth:
                        sums[0] = path[depth]
                    node[inner] = np.cumsum(starts) - 1
                    leaves = inner
                    if len(inner) and inner[-1] == high - low - 1:
                        here.append(sums[node[inner[-1]]])
                alone = leaves[branch[leaves] == depth]
                if len(alone):
                    rest, entries = rows[low + alone, depth:], book[:, depth:]
                    total = sums[node[alone]] + (rest * rest).sum(axis=1)[:, None]
                    total = total - 2 * (rest @ entries.T) + (entries * entries).sum(axis=1)[None, :]
                    chosen = total.argmin(axis=1)
                    best[low + alone] = chosen
                    least[low + alone] = total[np.arange(len(alone)), chosen]
            path = here
        return best, least


def slices_of(rows: DataFrame, dimension: int, keep: tuple[str, ...]) -> DataFrame:
    """One row for each slice of vectors: the kept columns as arrays, and the tries of all parts.

    Vectors of another length are listed with place -1.
    """
    places = cuts(dimension)

    def run(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, SLICE):
                part = batch.slice(low, SLICE)
                lists = part.column("vector")
                values = lists.flatten().to_numpy(zero_copy_only=False)
                sizes = np.asarray(lists.value_lengths())
                whole = sizes == dimension
                grid = values[np.repeat(whole, sizes)].reshape(int(whole.sum()), dimension)
                blob = {"whole": whole}
                for k, place in enumerate(places):
                    found, often, at = distinct_parts(grid[:, place])
                    blob |= {f"rows{k}": narrow(found.ravel()), f"often{k}": often.astype(np.int64), f"at{k}": at}
                ends = pa.array([0, part.num_rows], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [*(pa.ListArray.from_arrays(ends, part.column(c)) for c in keep), pa.array([pack(**blob)], pa.binary())],
                    [*keep, "tries"],
                )

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    schema = ", ".join([*(f"`{c}` array<{kinds[c]}>" for c in keep), "tries binary"])
    return rows.select(*keep, "vector").mapInArrow(run, schema)


def tries_of(blob: dict, dimension: int):
    """Each part's trie, weights and places, from a slice's row."""
    for k, place in enumerate(cuts(dimension)):
        width = place.stop - place.start
        rows = blob[f"rows{k}"].astype(np.int64).reshape(len(blob[f"often{k}"]), width)
        yield Trie(rows), blob[f"often{k}"], blob[f"at{k}"]


def first_books(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> list[np.ndarray]:
    """The codebooks to begin with: parts of the vectors with the smallest ids. At most ``entries`` rows are read."""
    first = rows.orderBy(F.asc_nulls_last("vec_id"), "vector").select("vector").limit(entries).collect()
    dimension = len(first[0]["vector"]) if first else 0
    same = [r["vector"] for r in first if len(r["vector"]) == dimension]
    grid = np.array(same, np.int64).reshape(len(same), dimension)
    return [grid[:, place] for place in cuts(dimension, parts)]


def next_books(tries: DataFrame, books: list[np.ndarray], dimension: int) -> list[np.ndarray]:
    """Each entry replaced by the mean, rounded down, of the parts nearest to it."""
    def run(batches):
        total = [(np.zeros(book.shape, np.int64), np.zeros(len(book), np.int64)) for book in books]
        for batch in batches:
            for blob in batch.column("tries").to_pylist():
                for (trie, often, _), book, (sums, count) in zip(tries_of(unpack(blob), dimension), books, total):
                    if not len(often):
                        continue
                    best, _ = trie.nearest(book)
                    np.add.at(sums, best, trie.rows * often[:, None])
                    np.add.at(count, best, often)
        for k, (sums, count) in enumerate(total):
            used = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(used), k), pa.int32()),
                    pa.array(used, pa.int32()),
                    pa.array(count[used], pa.int64()),
                    pa.array(list(sums[used]), pa.list_(pa.int64())),
                ],
                ["part", "entry", "n", "sums"],
            )

    found = tries.select("tries").mapInArrow(run, "part int, entry int, n long, sums array<long>")
    width = max(book.shape[1] for book in books)
    added = [F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(width)]
    out = [book.copy() for book in books]
    # At most one row for each entry.
    for row in found.groupBy("part", "entry").agg(F.sum("n").alias("n"), *added).collect():
        book = out[row["part"]]
        book[row["entry"]] = [row[f"s{i}"] // row["n"] for i in range(book.shape[1])]
    return out


def books_digest(books: list[np.ndarray]) -> str:
    text = ",".join(str(x) for book in books for entry in book.tolist() for x in entry)
    return hashlib.sha256(text.encode()).hexdigest()


def encoded(tries: DataFrame, books: list[np.ndarray], dimension: int, keep: tuple[str, ...]) -> DataFrame:
    """The kept columns of every vector, its code (two hex digits for each part) and its squared error."""
    def run(batches):
        for batch in batches:
            for i, blob in enumerate(batch.column("tries").to_pylist()):
                held = unpack(blob)
                whole = held["whole"]
                code = np.zeros((int(whole.sum()), len(books)), np.uint8)
                error = np.zeros(len(code), np.int64)
                for k, ((trie, often, at), book) in enumerate(zip(tries_of(held, dimension), books)):
                    if len(often):
                        best, least = trie.nearest(book)
                        code[:, k] = best[at]
                        error += least[at]
                codes, errors = np.full(len(whole), None, object), np.full(len(whole), None, object)
                codes[whole] = [c.tobytes().hex() for c in code]
                errors[whole] = error.tolist()
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c)[i].values for c in keep), pa.array(codes, pa.string()), pa.array(errors, pa.int64())],
                    [*keep, "code", "error"],
                )

    kinds = {f.name: f.dataType.elementType.simpleString() for f in tries.schema.fields if f.name in keep}
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "code string, error long"])
    return tries.mapInArrow(run, schema)


def compress(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", rounds: int = ROUNDS
) -> tuple[DataFrame, list[np.ndarray]]:
    """(vec_id, label, code, error) for every usable vector, and the final codebooks."""
    chosen = vectors.select(F.col(key).alias("vec_id"), F.col(label).alias("label"), integers(F.col(vector)).alias("vector"))
    rows = chosen.filter(F.col("vector").isNotNull())
    books = first_books(rows)
    dimension = sum(book.shape[1] for book in books)
    keep = ("vec_id", "label")
    tries = written_once(slices_of(rows, dimension, keep), "tries")
    for _ in range(rounds):
        books = next_books(tries, books, dimension)
    return encoded(tries, books, dimension, keep), books


def code_report(vectors: DataFrame, **options) -> DataFrame:
    """Codes with the error of all rows of their label, and a digest of the codebooks."""
    codes, books = compress(vectors, **options)
    codes = written_once(codes, "codes")
    # One row for each label and task is shuffled; a label with very many rows is split by adaptive execution.
    by_label = codes.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    return codes.join(by_label, F.col("label").eqNullSafe(F.col("of")), "left").select(
        "vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256")
    )
