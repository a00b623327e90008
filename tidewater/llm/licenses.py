"""License scans: identifier tags, notice phrases and license expressions.

One Aho-Corasick automaton over normalised words finds notice phrases and
identifier tags in a single pass. After a tag (``SPDX-License-Identifier``) the
original line, up to the next tag, holds a license expression; a shunting-yard parser turns it into
postfix order (``with`` binds tighter than ``and``, ``and`` than ``or``) and
evaluates it.

The score says how freely the text may be used, from 0 to 1. Each label has a
grade in ``GRADES``; in an expression ``or`` takes the better side, ``and`` the
worse, and ``with`` moves a grade halfway to 1. All findings of a text hold
together, so the text's score is the least of them; a text without finding has
no grant and scores 0.

A notice that stands inside a longer one says less than it ("cc by" in "cc by
nc") and does not count there; where it stands alone it does. Base phrases always
count. Phrases inside an expression give labels, but only the expression a grade.
Work is in proportion to the text, however many hits it holds.

Defined results: null and empty texts have no words, no labels and score 0;
repeated rows are judged row by row; a malformed expression gives the labels
that it names and the least of their grades; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import normalise, prepare, utf8, word_texts

#: The base phrases and their labels.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
#: Notice phrases of the method's own.
NOTICES = {
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "licensed under the apache license": "apache-2",
    "apache software license": "apache-2",
    "gnu general public license": "gpl",
    "gnu general public license version 2": "gpl-2",
    "gnu general public license version 3": "gpl-3",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "redistribution and use in source and binary forms": "bsd",
    "bsd license": "bsd",
    "isc license": "isc",
    "mit license": "mit",
    "cc by": "cc-by",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "cc by nc sa": "cc-by-nc-sa",
    "cc by nc nd": "cc-by-nc-nd",
    "creative commons attribution": "cc-by",
    "creative commons attribution sharealike": "cc-by-sa",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons zero": "cc0",
    "public domain": "public-domain",
    "all rights reserved": "all-rights-reserved",
}
_LABELS = {**NOTICES, **BASE}
TAGS = ("spdx license identifier", "license expression")
GRADES = {
    "public-domain": 1.0, "cc0": 1.0, "unlicense": 1.0, "mit": 0.95, "isc": 0.95, "bsd": 0.95, "zlib": 0.95, "apache-2": 0.9, "cc-by": 0.85,
    "mpl": 0.6, "epl": 0.6, "lgpl": 0.55, "cc-by-sa": 0.5, "gpl": 0.35, "gpl-2": 0.35, "gpl-3": 0.35, "agpl": 0.25,
    "cc-by-nd": 0.2, "cc-by-nc": 0.15, "cc-by-nc-sa": 0.1, "cc-by-nc-nd": 0.05, "all-rights-reserved": 0.0,
}
UNKNOWN_GRADE = 0.3
_STRENGTH = {"or": 1, "and": 2, "with": 3}
_TOKEN = re.compile(r"[()]|[A-Za-z0-9][A-Za-z0-9.+-]*")
#: Signs between words, those that may stand between a tag and its expression, and a
#: tag in the original text: its words with any such signs between, in one line or several.
_GAP, _LEAD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", r"[\x00-\x09\x0B\x0C\x0E-\x27\x29-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*"
_WORD_SIGN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
_TAG = re.compile(rf"(?<!{_WORD_SIGN})(?:{'|'.join(t.replace(' ', _GAP) for t in TAGS)})(?!{_WORD_SIGN}){_LEAD}", re.I | re.A)
_LINE_END = re.compile(r"[\r\n]")


def label_of(identifier: str) -> str:
    """An identifier's label: its family as in ``GRADES``, else itself in lower case."""
    name = re.sub(r"-(only|or-later)$|\+$", "", identifier.lower())
    if name in GRADES:
        return name
    families = [x for x in GRADES if name.startswith(f"{x}-") or name == f"{x}.0"]
    return max(families, key=len) if families else name


def parse(text: str, start: int = 0, end: int | None = None) -> tuple[list[tuple[str, str]], bool, int]:
    """Postfix order of the license expression in ``text[start:end]``, as (kind, text)
    pairs, whether it is well formed and where it ends. Reading stops at the first word that cannot follow."""
    output, stack, expect, whole, stop = [], [], True, True, start
    for m in _TOKEN.finditer(text, start, len(text) if end is None else end):
        token = m.group().rstrip(".")  # the end of a sentence
        word = token.lower()
        if expect:
            if token == "(":
                stack.append(token)
            elif token != ")" and word not in _STRENGTH:
                output.append(("name", token))
                expect = False
            else:
                whole = False
                break
        elif word in _STRENGTH:
            while stack and stack[-1] != "(" and _STRENGTH[stack[-1]] >= _STRENGTH[word]:
                output.append(("op", stack.pop()))
            stack.append(word)
            expect = True
        elif token == ")" and "(" in stack:
            while (top := stack.pop()) != "(":
                output.append(("op", top))
        else:
            break  # prose after the expression
        stop = m.end()
    whole &= not expect and "(" not in stack
    output += [("op", x) for x in reversed(stack) if x != "("]
    return output, whole, stop


def evaluate(text: str, start: int = 0, end: int | None = None) -> tuple[set[str], float | None, int]:
    """Labels named in the expression in ``text[start:end]``, its grade (None where it names none) and its end."""
    postfix, whole, stop = parse(text, start, end)
    stack: list[tuple[float, str]] = []
    labels: set[str] = set()
    exceptions = {i - 1 for i, (kind, text) in enumerate(postfix) if kind == "op" and text == "with" and i >= 2}
    for i, (kind, text) in enumerate(postfix):
        if kind == "name":
            label = text.lower() if i in exceptions else label_of(text)
            if i not in exceptions:
                labels.add(label)
            stack.append((GRADES.get(label, UNKNOWN_GRADE), label))
        elif whole:
            right, left = stack.pop(), stack.pop()
            grade = max(left[0], right[0]) if text == "or" else min(left[0], right[0]) if text == "and" else (left[0] + 1) / 2
            stack.append((grade, ""))
    return labels, min((x[0] for x in stack), default=None), stop


@lru_cache(maxsize=1)
def _automaton():
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for phrase in {*BASE, *NOTICES, *TAGS}:
        automaton.add_word(f" {phrase} ", phrase)
    automaton.make_automaton()
    return automaton


def expressions(original: str):
    """(start, end) of what follows each tag: up to the line's end or the next tag."""
    last = None
    for m in _TAG.finditer(original):
        if last is not None:
            yield last, m.start()
        last = m.end()
    if last is not None:
        yield last, len(original)


def findings(words: bytes) -> tuple[list[tuple[int, str]], bool]:
    """(start in words, phrase) of the hits that count, and whether there is a tag."""
    spaced = f" {words.decode('latin-1')} "
    tagged, hits, out = False, [], []
    for end, phrase in _automaton().iter(spaced):
        if phrase in TAGS:
            tagged = True
        else:
            hits.append((end - len(phrase), -end, phrase))
    hits.sort()
    word, counted, reach = -1, 0, 0
    for start, end, phrase in hits:
        # Where an earlier hit reaches as far, this one stands inside it.
        if phrase in BASE or -end > reach:
            word, counted = word + spaced.count(" ", counted, start), start
            out.append((word, phrase))
        reach = max(reach, -end)
    return out, tagged


def judge(words: bytes, original: str) -> tuple[list[int], set[str], set[str], float]:
    """Starts of base places (in words), base labels, all labels and the score."""
    found, tagged = findings(words)
    base = {BASE[p] for _, p in found if p in BASE}
    names, grades = {_LABELS[p] for _, p in found}, []
    outside = Counter(p for _, p in found)
    if tagged:
        for start, stop in expressions(original):
            line = _LINE_END.search(original, start, stop)
            labels, grade, stop = evaluate(original, start, line.start() if line else stop)
            names |= labels
            grades += [] if grade is None else [grade]
            # An expression's names are judged by it alone, also those that are phrases.
            outside.subtract(p for _, p in findings(normalise(original[start:stop].encode()))[0])
    grades += [GRADES[_LABELS[p]] for p, n in outside.items() if n > 0]
    return [i for i, p in found if p in BASE], base, names, min(grades, default=0.0)


def license_scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: its id, n_words, n_base (base places), first_word and
    last_word (smallest and largest start of a base place, else null),
    base_labels and labels (arrays, distinct and sorted) and score."""
    prepare(docs.sparkSession)

    def scan(batches):
        automaton = _automaton()
        for batch in batches:
            whole, offsets = utf8(batch.column(1))
            out = []
            for i, words in enumerate(word_texts(batch.column(1))):
                if words and next(automaton.iter(f" {words.decode('latin-1')} "), None) is not None:
                    starts, base, names, score = judge(words, whole[offsets[i] : offsets[i + 1]].tobytes().decode())
                else:
                    starts, base, names, score = [], (), (), 0.0
                out.append((words.count(b" ") + 1 if words else 0, len(starts), min(starts, default=None), max(starts, default=None), sorted(base), sorted(names), score))
            columns = list(zip(*out)) or [[]] * 7
            kinds = [pa.int64()] * 4 + [pa.list_(pa.string())] * 2 + [pa.float64()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(list(c), k) for c, k in zip(columns, kinds))], ["id", *NAMES])

    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    kinds = ["long"] * 4 + ["array<string>"] * 2 + ["double"]
    schema = ", ".join([f"id {rows.schema['id'].dataType.simpleString()}", *(f"{n} {k}" for n, k in zip(NAMES, kinds))])
    return rows.mapInArrow(scan, schema).withColumnRenamed("id", id_column)


NAMES = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
