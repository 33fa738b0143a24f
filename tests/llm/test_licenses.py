"""The join against comparison of every block with every template."""

from __future__ import annotations

import random
import re

import pytest

from stayledger.llm import licenses

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def runs(w):
    return {" ".join(w[i : i + 3]) for i in range(len(w) - 2)}


def plain(rows, templates, containment):
    sets = {n: runs(words(t)) for n, t in templates.items()}
    out = []
    for i, text in rows:
        w, places, base, names, best = words(text), [], set(), set(), 0.0
        for phrase, label in licenses.PHRASES.items():
            p = phrase.split()
            at = [k for k in range(len(w)) if w[k : k + len(p)] == p]
            places += at
            base |= {label} if at else set()
        for start in range(0, max(len(w) - 32, 1), 32):
            block = runs(w[start : start + 64])
            for name, t in sets.items():
                share = len(block & t) / len(t)
                if share >= containment - 1e-12:
                    names.add(name)
                    best = max(best, share)
        score = 1.0 if places else best
        first, last = (min(places), max(places)) if places else (None, None)
        out.append((i, len(w), len(places), first, last, ",".join(sorted(base)), ",".join(sorted(base | names)), round(score, 9)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed,containment", [(1, 0.8), (2, 0.5), (3, 1.0)])
def test_all_blocks(spark, seed, containment):
    rng = random.Random(seed)
    pool = sorted({w for t in licenses.TEMPLATES.values() for w in words(t)}) + ["mit", "license", "é", "x", "y", "z"] * 3
    rows = [(i, " ".join(rng.choices(pool, k=rng.randrange(250)))) for i in range(40)]
    texts = list(licenses.TEMPLATES.values())
    for i in range(100, 140):  # pieces of notices, some words lost
        text = [x for t in rng.choices(list(licenses.TEMPLATES.values()), k=6) for x in t.split() if rng.random() < 0.97]
        rows.append((i, " ".join(text)))
    rows += [(50 + i, "q " * rng.randrange(90) + t.upper() + " r" * 70) for i, t in enumerate(texts)]
    rows += [(80, None), (81, ""), (82, " ?!"), (83, "MIT-License, mit license"), (84, "General Public License" * 2), (None, "the apache license"), (83, "MIT-License, mit license")]
    frame = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, score int, words string")
    got = licenses.scan(frame, containment=containment).collect()
    found = [tuple(r)[:7] + (round(r.score, 9),) for r in got]
    assert sorted(found, key=repr) == plain(rows, licenses.TEMPLATES, containment)


def test_empty_tables_and_no_templates(spark):
    frame = spark.createDataFrame([(1, "the MIT License")], "doc_id long, text string")
    assert licenses.scan(frame.limit(0)).count() == 0
    row = licenses.scan(frame, templates={}).first()
    assert (row.labels, row.n_base, row.first_word, row.score) == ("mit", 1, 1, 1.0)


@pytest.mark.parametrize(
    "text,labels",
    [
        ("Licensed under the GNU Affero General Public License version 3", "agpl-notice,gpl"),
        ("This work is licensed under the GNU General Public License, version 3", "gpl,gpl-notice"),
        ("licensed under the GNU Lesser General Public License, version 3", "gpl"),
        ("Licensed under CC BY 4.0", ""),
        ("Licensed under CC BY-NC 4.0", "cc-by-nc-notice"),
        ("Licensed under CC BY-NC-SA 4.0", ""),
        ("licensed under a Creative Commons Attribution 4.0 International License", ""),
        ("licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License", ""),
        ("licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", "cc-by-sa-notice"),
        ("Licensed under the Eclipse Public License, Version 2.0", ""),
        ("Licensed under the Apache License, Version 2.0", "apache,apache-notice"),
        ("Released under the Apache License", "apache"),
        ("the mit team released a license under which", ""),
        ("Released under the MIT License", "mit,mit-notice"),
    ],
)
def test_sister_licences(spark, text, labels):
    for whole in (text, "some words before it " * 9 + text + ". And after it." * 9):
        assert licenses.scan(spark.createDataFrame([(1, whole)], "doc_id long, text string")).first().labels == labels


def test_short_templates_are_an_error(spark):
    with pytest.raises(ValueError, match="fewer than 3"):
        licenses.scan(spark.createDataFrame([(1, "x")], "doc_id long, text string"), templates={"a": "two words"})
