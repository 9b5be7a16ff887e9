"""Licence scans: phrases and identifier tags found by Aho-Corasick, licence expressions by shunting-yard.

One automaton runs over every whole text in its word form (lower-case words
joined by one blank), so a phrase is found wherever its words stand
consecutively. Texts that hold the identifier tag are read once more: the
expression behind each tag is parsed by operator precedence (with, and, or)
and evaluated.

Score: how sure the scan is that the text is under a licence that may be used.
A parsed expression gives its value (or: the larger side, and: the smaller,
with: the licence's own), each place of a phrase adds half of what is missing
to 1. A text without any evidence has 0.

Defined results: null and blank texts have no words, no labels and score 0.
An expression that cannot be parsed gives no labels. Each input row gives one
row. Only key and text are read.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartermark.llm.words import LETTER_WORDS_LOWER, binary, slices

# The base phrases and their labels.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
NOTICE_PHRASES = {
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "bsd license": "bsd",
    "isc license": "isc",
    "eclipse public license": "epl",
    "creative commons attribution": "cc-by",
    "creative commons zero": "cc0",
    "public domain": "public-domain",
    "all rights reserved": "all-rights-reserved",
}
TAG = "spdx license identifier"
TAG_PATTERN = re.compile(r"spdx-license-identifier\s*:\s*([^\r\n]*)", re.IGNORECASE | re.ASCII)
TOKEN = re.compile(r"\(|\)|[A-Za-z0-9.+\-]+")
PRECEDENCE = {"or": 1, "and": 2, "with": 3}
# How freely a licence family may be used; other identifiers count as 0.5.
FREEDOM = {"mit": 1.0, "apache": 1.0, "bsd": 1.0, "isc": 1.0, "cc0": 1.0, "cc-by": 0.9, "mpl": 0.7, "lgpl": 0.6}


def postfix(expression: str) -> list[str] | None:
    """Shunting-yard: the expression's longest valid beginning in postfix order, or None."""
    out: list[str] = []
    stack: list[str] = []
    # Outside parentheses at most one operator of each precedence waits, and ``out`` only grows:
    # a valid beginning is its length and those few operators.
    best: tuple[int, list[str]] = (0, [])
    depth = 0
    operand = True  # what may come next
    at = 0

    def longest() -> list[str] | None:
        return out[: best[0]] + best[1] or None

    while True:
        while at < len(expression) and expression[at] in " \t":
            at += 1
        found = TOKEN.match(expression, at)
        if not operand and not depth:
            best = (len(out), stack[::-1])
        if not found:
            return longest()
        token, at = found.group(), found.end()
        if token == "(":
            if not operand:
                return longest()
            stack.append(token)
            depth += 1
        elif token == ")":
            if operand or not depth:
                return longest()
            while stack[-1] != "(":
                out.append(stack.pop())
            stack.pop()
            depth -= 1
        elif token.lower() in PRECEDENCE:
            if operand:
                return longest()
            operator = token.lower()
            while stack and stack[-1] != "(" and PRECEDENCE[stack[-1]] >= PRECEDENCE[operator]:
                out.append(stack.pop())
            stack.append(operator)
            operand = True
        else:
            if not operand:
                return longest()
            out.append(token)
            operand = False


def evaluate(rpn: list[str]) -> tuple[set[str], float]:
    """Labels of all licences named, and the value of the expression.

    ``with`` joins one licence and one exception to one label; elsewhere it names both sides.
    """
    stack: list[tuple[set[str], float]] = []
    for token in rpn:
        if token not in PRECEDENCE:
            name = token.lower()
            family = next((f for f in FREEDOM if name == f or name.startswith(f + "-")), None)
            stack.append(({name}, FREEDOM.get(family, 0.5)))
            continue
        (right, b), (left, a) = stack.pop(), stack.pop()
        if token == "with" and len(left) == len(right) == 1 and not any(" " in x for x in left | right):
            names = {f"{min(left)} with {min(right)}"}
        else:
            # The smaller side joins the larger, so long expressions cost no more than their length.
            names, few = (left, right) if len(left) >= len(right) else (right, left)
            names |= few
        stack.append((names, a if token == "with" else max(a, b) if token == "or" else min(a, b)))
    return stack[0]


def automaton(phrases):
    import ahocorasick

    machine = ahocorasick.Automaton()
    for number, phrase in enumerate(phrases):
        machine.add_word(f" {phrase} ", (number, len(phrase) + 2))
    machine.make_automaton()
    return machine


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document row: words, places of base phrases, their first and last word, labels and score.

    ``places`` holds every phrase found, base or not, as (phrase, word).
    """
    phrases = [*BASE_PHRASES, *NOTICE_PHRASES, TAG]
    labels = {**BASE_PHRASES, **NOTICE_PHRASES}
    chosen = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = chosen.schema["doc_id"].dataType.simpleString()
    place = pa.list_(pa.struct([("phrase", pa.string()), ("word", pa.int64())]))

    def look(raw: bytes, machine):
        words = raw.translate(LETTER_WORDS_LOWER).split()
        plain = f" {b' '.join(words).decode()} "
        places, base, named, missing, value = [], [], set(), 1.0, 0.0
        counted = word = 0
        for end, (number, size) in machine.iter(plain):
            start = end - size + 1
            # Matches come by their ends; the starts of shorter and longer phrases may cross.
            word += plain.count(" ", counted, start) if start >= counted else -plain.count(" ", start, counted)
            counted = start
            phrase = phrases[number]
            if phrase == TAG:
                continue
            places.append({"phrase": phrase, "word": word})
            named.add(labels[phrase])
            missing *= 0.5
            if phrase in BASE_PHRASES:
                base.append((word, labels[phrase]))
        if b"-" in raw and TAG in plain:
            for expression in TAG_PATTERN.findall(raw.decode()):
                rpn = postfix(expression)
                if rpn:
                    names, worth = evaluate(rpn)
                    named |= names
                    value = max(value, worth)
        starts = [w for w, _ in base]
        return (
            len(words),
            len(base),
            min(starts, default=None),
            max(starts, default=None),
            ",".join(sorted({x for _, x in base})),
            ",".join(sorted(named)),
            max(value, 1.0 - missing),
            places,
        )

    def run(batches):
        machine = automaton(phrases)
        for batch in batches:
            for part in slices(batch, "text"):
                found = [look(raw, machine) for raw in binary(part.column("text")).to_pylist()]
                columns = list(zip(*found))
                kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), place]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *(pa.array(c, t) for c, t in zip(columns, kinds))],
                    ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "places"],
                )

    schema = (
        f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, "
        "labels string, score double, places array<struct<phrase: string, word: long>>"
    )
    return chosen.mapInArrow(run, schema)
