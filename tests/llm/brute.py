"""Every contract computed directly, row by row, from its definition."""

import hashlib
import math
import re
import zlib
from collections import Counter

LETTERS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def letter_words(text):
    return LETTERS.findall(lower(text))


def blank_words(text):
    return [w.decode() for w in (text or "").encode().split()]


def sha(data):
    return hashlib.sha256(data).hexdigest()


def decontamination(docs, items):
    windows = {}
    for item, text in items:
        words = letter_words(text)
        for k in range(max(1, len(words) - 9) if words else 0):
            windows.setdefault(tuple(words[k : k + 10]), set()).add(None if item is None else str(item))
    out = []
    for key, text in docs:
        words, hit, found = letter_words(text), set(), set()
        for n in {len(w) for w in windows}:
            for k in range(len(words) - n + 1):
                items_here = windows.get(tuple(words[k : k + n]))
                if items_here is not None:
                    hit |= set(range(k, k + n))
                    found |= items_here - {None}
        out.append((key, len(words), len(hit), len(found), sha(",".join(sorted(found)).encode()), bool(hit)))
    return out


def byte_dedup(docs, window=200):
    texts = [(k, (t or "").encode()) for k, t in docs]
    seen = Counter(t[i : i + window] for _, t in texts for i in range(len(t) - window + 1))
    out = []
    for key, t in texts:
        gone = [False] * len(t)
        upto = 0
        for i in range(len(t) - window + 1):
            if seen[t[i : i + window]] > 1:
                for j in range(max(i, upto), i + window):
                    gone[j] = True
                upto = i + window
        runs = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((key, len(t), sum(gone), runs, sha(bytes(b for b, g in zip(t, gone) if not g))))
    return out


def word_dedup(docs, window=13):
    last = 1 << 63
    first = {}
    for key, text in docs:
        words, rank = blank_words(text), last if key is None else key
        for i in range(len(words) - window + 1):
            w = tuple(words[i : i + window])
            first[w] = min(first.get(w, last), rank)
    out = []
    for key, text in docs:
        words, rank = blank_words(text), last if key is None else key
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            if first[tuple(words[i : i + window])] < rank:
                gone[i : i + window] = [True] * window
        kept = [w for w, g in zip(words, gone) if not g]
        out.append((key, len(words), sum(gone), sha(" ".join(kept).encode())))
    return out


def shingle_set(text, size=4):
    words = blank_words(lower(text))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def groups(docs, size=4, percent=85):
    sets = [(k, shingle_set(t, size)) for k, t in docs]
    root = {k: k for k, _ in sets if k is not None}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and a is not None and b is not None and 100 * len(x & y) >= percent * len(x | y):
                one, two = sorted((find(a), find(b)))
                root[two] = one
    return [(k, len(x), None if k is None else find(k)) for k, x in sets]


PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def licences(docs):
    out = []
    for key, text in docs:
        words = letter_words(text)
        found = [(i, label) for i in range(len(words)) for p, label in PHRASES.items() if words[i : i + len(p.split())] == p.split()]
        places = [i for i, _ in found]
        out.append((key, len(words), len(found), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in found}))))
    return out


def vector_codes(rows):
    """(vec_id, code, error, label_error, digest) and the codebooks, entry by entry."""
    kept = [
        (k, tuple(math.floor(1024 * x) for x in v), label)
        for k, v, label in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:256]
    d = len(first[0][1])
    cuts = [(p * d // 4, (p + 1) * d // 4) for p in range(4)]
    whole = [r for r in kept if len(r[1]) == d]
    books = [[r[1][a:b] for r in first if len(r[1]) == d] for a, b in cuts]

    def nearest(part, book):
        return min((sum((x - y) ** 2 for x, y in zip(part, entry)), e) for e, entry in enumerate(book))

    for _ in range(4):
        for book, (a, b) in zip(books, cuts):
            near = {}
            for part, n in Counter(r[1][a:b] for r in whole).items():
                near.setdefault(nearest(part, book)[1], []).append((part, n))
            for e, found in near.items():
                count = sum(n for _, n in found)
                book[e] = tuple(sum(part[i] * n for part, n in found) // count for i in range(b - a))
    out, by_label = [], Counter()
    for k, v, label in kept:
        best = [nearest(v[a:b], book) for book, (a, b) in zip(books, cuts)] if len(v) == d else None
        error = sum(x for x, _ in best) if best else None
        by_label[label] += error or 0
        out.append((k, "".join(f"{e:02x}" for _, e in best) if best else None, error, label))
    digest = sha(",".join(str(x) for book in books for entry in book for x in entry).encode())
    return [(k, code, error, by_label[label], digest) for k, code, error, label in out]


def spelling(docs):
    counts = Counter()
    for key, text in docs:
        for run in re.findall(r"[A-Za-z\u00C0-\u00FF]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            counts[run if h % 199 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}

    def one_edit(a, b):
        if len(a) > len(b):
            a, b = b, a
        i = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
        return a != b and (a[i:] == b[i + 1 :] if len(a) < len(b) else len(a) == len(b) and a[i + 1 :] == b[i + 1 :])

    near = {w: [v for v in words if abs(len(v) - len(w)) < 2 and one_edit(w, v)] for w in words}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 5 * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return out
