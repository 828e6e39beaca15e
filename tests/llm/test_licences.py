import random

import pytest

from gleanery.llm import licences

from .helpers import clashing, documents


def plain(text, threshold, templates=licences.TEMPLATES):
    lines = (text or "").split("\n")
    matches, best = 0, None
    for at, line in enumerate(lines):
        own, found = licences.bigrams(line), []
        for name in templates:
            for template in templates[name]:
                other = licences.bigrams(template)
                shared = len(own & other)
                if shared and 2 * shared / (len(own) + len(other)) >= threshold:
                    found.append((-2 * shared / (len(own) + len(other)), len(other), name, shared, len(own) + len(other)))
        if found:
            matches += 1
            dice, _, name, shared, both = min(found)
            if best is None or -dice > best[4]:
                best = (name, at, shared, both, -dice)
    return (len(lines), matches, *(best or (None,) * 5))


def cases():
    r = random.Random(1)
    notices = [t for texts in licences.TEMPLATES.values() for t in texts]
    rows = []
    for i in range(120):
        words = r.choice(notices).split()
        for _ in range(r.randint(0, 5)):
            words[r.randrange(len(words))] = r.choice(["the", "work", "x"])
        rows.append((i, "Some prose of a document.\n" + " ".join(words).upper() + "\n" + r.choice(notices)[: r.randint(5, 200)]))
    return rows + [(200, None), (201, ""), (202, "one"), (None, notices[0]), (203, "prose " * 60_000 + "\n" + notices[1]), (3, rows[3][1])]


@pytest.mark.parametrize("threshold", [0.5, 0.8, 1.0])
def test_against_all_templates(spark, threshold):
    rows = cases()
    found = licences.scan_licences(clashing(documents(spark, rows)), threshold=threshold)
    assert sorted([tuple(r) for r in found.collect()], key=str) == sorted([(i, *plain(t, threshold)) for i, t in rows], key=str)


def test_notices_are_found_and_prose_is_not(spark):
    rows = [(1, "Text.\nReleased under the MIT License."), (2, "Licensed under CC BY-NC 4.0."), (3, "We talked about the licence.")]
    found = {r.doc_id: r.licence for r in licences.scan_licences(documents(spark, rows)).collect()}
    assert found == {1: "MIT", 2: "CC-BY-NC-4.0", 3: None}


def test_empty_table_and_no_templates(spark):
    docs = documents(spark, cases())
    assert licences.scan_licences(docs.limit(0)).collect() == []
    assert {r.n_matches for r in licences.scan_licences(docs, templates={}).collect()} == {0}


def plain_text(text, threshold, templates):
    """Every unit against every template."""
    found, lines, blocks = [], [], [[]]
    for line in (text or "").split("\n"):
        own = licences.words(line)
        lines.append((len(found), len(found) + len(own)))
        blocks[-1].append(lines[-1]) if line.strip() else blocks.append([])
        found += own
    units = [("line", *x) for x in lines] + [("paragraph", b[0][0], b[-1][1]) for b in blocks if b] + [("document", 0, len(found))]
    names, best = set(), []
    for name in templates:
        for template in templates[name]:
            size, other = len(licences.words(template)), licences.bigrams(template)
            has = set(licences.words(template))
            needed = {w for w in has if w in licences.DECIDING or (w.isdigit() and size <= licences.NOTICE)}
            windows = [("window", i, i + size) for i in range(len(found) - size + 1)]
            for kind, a, b in units + windows:
                own = frozenset(zip(found[a:b], found[a + 1 : b]))
                shared, both = len(own & other), len(own) + len(other)
                told = needed <= set(found[a:b]) and not set(found[a:b]) & (licences.DECIDING - has)
                if shared and told and 2 * shared / both >= threshold:
                    names.add(name)
                    best.append((-shared, -2 * shared / both, a, b - a, len(other), name, kind, both))
    if not best:
        return (len(found), [], *(None,) * 7)
    shared, dice, a, n, _, name, kind, both = min(best)
    return (len(found), sorted(names), name, kind, a, n, -shared, both, -dice)


@pytest.mark.parametrize("threshold", [0.5, 0.8, 1.0])
def test_texts_against_all_units(spark, threshold):
    rows = [(i, t) for i, t in cases() if i != 203]
    rows += [(i + 300, (t or "").replace(" ", "\n", i % 7).replace(". ", ".\n\n")) for i, t in rows if i is not None]
    found = licences.scan_licence_texts(clashing(documents(spark, rows)), licences.TEMPLATES, threshold)
    wanted = [(i, *plain_text(t, threshold, licences.TEMPLATES)) for i, t in rows]
    assert sorted([tuple(r) for r in found.collect()], key=str) == sorted(wanted, key=str)


def test_whole_and_wrapped_licences_are_found(spark):
    texts = licences.full_texts()
    rows = [(i, f"Copyright 2020 Foo Inc.\n\n{texts[name][0]}\nThe end.") for i, name in enumerate(texts)]
    rows += [(10 + i, "Some prose first. " + " ".join(texts[name][0].split())) for i, name in enumerate(texts)]
    rows += [(20, "Copyright 2020 Foo Inc. Released under the MIT License."), (21, "Released\nunder the\nMIT License."), (22, "prose " * 300)]
    found = {r.doc_id: r for r in licences.scan_licence_texts(documents(spark, rows)).collect()}
    assert all(found[i + j].licence == name and found[i + j].dice > 0.99 for j in (0, 10) for i, name in enumerate(texts))
    assert (found[20].licences, found[21].licences, found[22].licences) == (["MIT"], ["MIT"], [])


def test_a_text_may_end_with_blank_lines(spark):
    rows = [(1, "Released under the MIT License.\n\n"), (2, "Released under the MIT License.\n"), (3, "\n")]
    found = {r.doc_id: r.licences for r in licences.scan_licence_texts(documents(spark, rows)).collect()}
    assert found == {1: ["MIT"], 2: ["MIT"], 3: []}


def test_near_licences_are_told_apart(spark):
    gnu = (
        "This {0} is free software; you can redistribute it and/or modify it under the terms of the GNU {1} as published by the "
        "Free Software Foundation; either version {2} of the License, or (at your option) any later version."
    )
    cases = [
        ("GPL-2.0", gnu.format("program", "General Public License", "2")),
        ("GPL-3.0", gnu.format("program", "General Public License", "3")),
        ("LGPL-2.1", gnu.format("library", "Lesser General Public License", "2.1")),
        ("LGPL-3.0", gnu.format("program", "Lesser General Public License", "3")),
        ("AGPL-3.0", gnu.format("program", "Affero General Public License", "3")),
        ("ISC", licences.TEMPLATES["ISC"][0].replace("and/or ", "and ")),
        ("CC0-1.0", licences.TEMPLATES["CC0-1.0"][0].replace("the author", "Jane Doe")),
        ("MPL-2.0", licences.TEMPLATES["MPL-2.0"][0]),
    ]
    cases += [(name, text) for name, texts in licences.TEMPLATES.items() for text in texts]
    rows = [(i, f"Some prose of a program.\n\n{text}\n\nMore prose.") for i, (_, text) in enumerate(cases)]
    found = {r.doc_id: (r.licence, r.licences) for r in licences.scan_licence_texts(documents(spark, rows)).collect()}
    assert found == {i: (name, [name]) for i, (name, _) in enumerate(cases)}
    lines = {r.doc_id: r.licence for r in licences.scan_licences(documents(spark, rows)).collect()}
    assert lines == {i: name for i, (name, _) in enumerate(cases)}
