"""License scans: expressions, phrases and places."""

import re

import pytest

from tidewater.llm import licenses as L

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, labels string, N_WORDS int"


@pytest.mark.parametrize("expression, labels, grade", [
    ("MIT", {"mit"}, 0.95),
    ("MIT OR GPL-3.0-only", {"mit", "gpl-3"}, 0.95),
    ("MIT AND GPL-3.0-only", {"mit", "gpl-3"}, 0.35),
    ("GPL-2.0-or-later WITH Classpath-exception-2.0", {"gpl-2"}, (0.35 + 1) / 2),
    ("MIT OR Apache-2.0 AND CC-BY-NC-4.0", {"mit", "apache-2", "cc-by-nc"}, 0.95),
    ("(MIT OR Apache-2.0) AND CC-BY-NC-4.0", {"mit", "apache-2", "cc-by-nc"}, 0.15),
    ("gpl-2.0+ with x OR bsd-3-clause and cc-by-nc-4.0", {"gpl-2", "bsd", "cc-by-nc"}, 0.675),
    ("MIT, see the file", {"mit"}, 0.95),
    ("MIT AND (GPL-3.0", {"mit", "gpl-3"}, 0.35),
    ("OR MIT", set(), None), ("", set(), None), ("()", set(), None),
])
def test_expressions(expression, labels, grade):
    got = L.evaluate(expression)
    assert got[0] == labels and got[1] == (None if grade is None else pytest.approx(grade))


def test_postfix_order():
    names = [t for _, t in L.parse("a or b and (c or d) with e")[0]]
    assert names == ["a", "b", "c", "d", "or", "e", "with", "and", "or"]


def base_by_hand(text):
    words = WORD.findall((text or "").translate(LOWER))
    places = [(i, label) for phrase, label in L.BASE.items() for i in range(len(words)) if words[i : i + len(p := phrase.split())] == p]
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), sorted({x for _, x in places})


def test_scan(spark):
    texts = [None, "", "!!", "no license here", "Released under the MIT License.", "Licensed under CC BY-NC 4.0.", "under-the MIT\nlicense under the mit license",
             "Apache License, Version 2.0; apache license version 2", "This work is licensed under the GNU General Public License, version 3.",
             "// SPDX-License-Identifier: MIT OR (GPL-2.0-only WITH x)\ncode", "mit license under the", "x " * 40_000 + "under the mit license", "cc by nc nd"]
    rows = [(i, t, "clash", 1) for i, t in enumerate(texts)] + [(None, "under the mit license", None, None), (4, texts[4], "clash", 1)]
    out = {(r.doc_id, r.n_words): r for r in L.license_scan(spark.createDataFrame(rows, SCHEMA)).collect()}
    for doc_id, text, *_ in rows:
        n, places, first, last, labels = base_by_hand(text)
        r = out[doc_id, n]
        assert (r.n_base, r.first_word, r.last_word, r.base_labels) == (places, first, last, labels)
        assert set(labels) <= set(r.labels) and list(r.labels) == sorted(set(r.labels)) and 0 <= r.score <= 1
    by_id = {r.doc_id: r for r in out.values()}
    assert by_id[8].labels == ["gpl-3"] and by_id[9].labels == ["gpl-2", "mit"] and by_id[9].score == 0.95
    assert by_id[5].labels == ["cc-by-nc"] and by_id[12].labels == ["cc-by-nc", "cc-by-nc-nd"] and by_id[3].score == 0
    assert L.license_scan(spark.createDataFrame([], SCHEMA)).collect() == []


def plain_grade(tokens):
    """A well-formed expression by recursive descent: or < and < with."""
    def atom():
        if tokens[0] == "(":
            tokens.pop(0)
            out = alternatives()
            tokens.pop(0)
            return out
        return L.GRADES.get(L.label_of(tokens.pop(0)), L.UNKNOWN_GRADE)

    def excepted():
        out = atom()
        while tokens and tokens[0] == "with":
            del tokens[:2]
            out = (out + 1) / 2
        return out

    def conjunction():
        out = excepted()
        while tokens and tokens[0] == "and":
            tokens.pop(0)
            out = min(out, excepted())
        return out

    def alternatives():
        out = conjunction()
        while tokens and tokens[0] == "or":
            tokens.pop(0)
            out = max(out, conjunction())
        return out

    return alternatives()


def random_expression(rng, depth=3):
    if not depth or rng.random() < 0.3:
        name = rng.choice(["MIT", "GPL-2.0-only", "Apache-2.0", "CC-BY-NC-4.0", "Foo-1", "cc0"])
        return [name, "with", "Ex-2"] if rng.random() < 0.2 else [name]
    inner = [*random_expression(rng, depth - 1), rng.choice(["and", "or"]), *random_expression(rng, depth - 1)]
    return ["(", *inner, ")"] if rng.random() < 0.5 else inner


def plain_judge(pieces):
    """Labels and score of a text made of (kind, value) pieces, every pair of hits compared."""
    words, names, grades = [], set(), []
    for kind, value in pieces:
        if kind == "tag":
            words.append("\0")
            inside = WORD.findall(" ".join(value).translate(LOWER))
            names |= {L._LABELS[p] for p in L._LABELS if f" {p} " in f" {' '.join(inside)} " and (p in L.BASE or not any(p != q and p in q and f" {q} " in f" {' '.join(inside)} " for q in L._LABELS))}
            names |= {L.label_of(t) for i, t in enumerate(value) if t not in ("and", "or", "with", "(", ")") and value[i - 1 : i] != ["with"]}
            grades.append(plain_grade(list(value)))
        else:
            words += WORD.findall(value.translate(LOWER))
    hits = [(i, i + len(p.split()), p) for p in {*L.BASE, *L.NOTICES} for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
    for a, b, p in hits:
        if p in L.BASE or not any(x <= a and b <= y and (x, y) != (a, b) for x, y, _ in hits):
            names.add(L.BASE.get(p) or L.NOTICES[p])
            grades.append(L.GRADES[L.BASE.get(p) or L.NOTICES[p]])
    return sorted(names), min(grades, default=0.0)


def test_labels_and_score_against_brute_force(spark):
    import random

    rng = random.Random(4)
    phrases = [*L.BASE, *L.NOTICES]
    tags = ["SPDX-License-Identifier: ", "spdx_license_identifier = ", "SPDX License  Identifier ", '"License-Expression": "']
    rows, want = [], {}
    for i in range(300):
        pieces, text = [], ""
        for _ in range(rng.randint(0, 6)):
            if rng.random() < 0.3:
                value = random_expression(rng)
                pieces.append(("tag", value))
                text += rng.choice(tags) + " ".join(value) + "\n"
            else:
                words = rng.choice(phrases).split()
                cut = rng.randint(0, len(words) - 1) if rng.random() < 0.3 else 0
                value = rng.choice([" ", "-", ", "]).join(words[cut:]).title() + rng.choice([" ", " x ", "\n"])
                pieces.append(("text", value))
                text += value
        rows.append((i, text, "", 0))
        want[i] = plain_judge(pieces)
    out = {r.doc_id: (list(r.labels), r.score) for r in L.license_scan(spark.createDataFrame(rows, SCHEMA)).collect()}
    for i, (labels, score) in want.items():
        assert out[i][0] == labels and out[i][1] == pytest.approx(score), rows[i]


def test_labels_that_stand_apart():
    judge = lambda t: L.judge(L.normalise(t.encode()), t)[2:]
    assert judge("CC BY here.\n\nCC BY-NC there")[0] == {"cc-by", "cc-by-nc"}
    assert judge("MIT License\n")[0] == {"mit"}
    assert judge("SPDX License Identifier: GPL-3.0-only") == ({"gpl-3"}, 0.35)
    assert judge("SPDX_License_Identifier: MIT. More") == ({"mit"}, 0.95)
    assert judge("SPDX-License-Identifier: MIT SPDX-License-Identifier: GPL-2.0-only") == ({"mit", "gpl-2"}, 0.35)
    assert judge("myspdx-license-identifier: MIT")[0] == set()


def test_many_hits_take_linear_time():
    import time

    for unit in ("cc by nc ", "under the mit license ", "SPDX-License-Identifier: MIT ", "license-expression ((( "):
        text, began = unit * 400_000, time.process_time()
        L.judge(L.normalise(text.encode()), text)
        assert time.process_time() - began < 30
