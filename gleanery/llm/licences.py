"""Licence scans: text units compared to licence templates by the Dice coefficient of word bigrams."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import pick

#: Templates: common licence notices by SPDX-like name. Any mapping of name to texts can be given instead.
TEMPLATES: dict[str, list[str]] = {
    "AGPL-3.0": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "Affero General Public License as published by the Free Software Foundation, either version 3 of the License, "
        "or (at your option) any later version.",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
    ],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met:",
    ],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "CC0-1.0": [
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this "
        "software to the public domain worldwide. This software is distributed without any warranty.",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation; either version 2 of the License, "
        "or (at your option) any later version.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, "
        "or (at your option) any later version.",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "LGPL-2.1": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
        "Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, "
        "or (at your option) any later version.",
    ],
    "LGPL-3.0": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, "
        "or (at your option) any later version.",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ],
}

#: Words that tell near licences apart: a unit has to hold those of its template, and no others.
DECIDING = frozenset("affero lesser library nc noncommercial sa sharealike noderivatives nd mozilla apache".split())
#: Templates of up to this many words are notices, whose numbers (versions) have to stand in the unit too.
NOTICE = 100

_WORD = re.compile(r"[a-z0-9]+")
NAMES = ["doc_id", "n_units", "n_matches", "licence", "line", "shared", "bigrams", "dice"]
SCHEMA = "doc_id long, n_units long, n_matches long, licence string, line int, shared int, bigrams int, dice double"


def words(text: str) -> list[str]:
    """Normal form: ASCII lower case, runs of letters and digits."""
    return _WORD.findall(text.lower())


def bigrams(text: str) -> frozenset[tuple[str, str]]:
    """The set of neighbouring word pairs of the normal form."""
    found = words(text)
    return frozenset(zip(found, found[1:]))


class Scanner:
    """Templates ordered by size, so that size bounds leave a slice of them for each unit.

    2 |A n B| / (|A| + |B|) >= t needs t / (2 - t) |A| <= |B| <= (2 - t) / t |A|.
    """

    def __init__(self, templates: dict[str, list[str]], threshold: float):
        sets = [(name, bigrams(text)) for name in sorted(templates) for text in templates[name]]
        self.templates = sorted(((len(b), name, b) for name, b in sets if b), key=lambda x: x[:2])
        self.threshold = threshold
        factor = (2 - threshold) / threshold * (1 + 1e-9)  # rounded up: bounds never cost a match
        self.least = min((n for n, _, _ in self.templates), default=0) / factor
        self.most = max((n for n, _, _ in self.templates), default=0) * factor
        self.factor = factor

    def best(self, unit: str) -> tuple[str, int, int, float] | None:
        """The best template at or over the threshold: name, shared bigrams, bigrams of both, Dice."""
        # A unit of n characters has at most n / 2 words; a set too small or too large fits no template.
        if len(unit) / 2 < self.least:
            return None
        own = bigrams(unit)
        size = len(own)
        if not self.least <= size <= self.most:
            return None
        found = None
        for n, name, template in self.templates:
            if n * self.factor < size or n > size * self.factor:
                continue
            shared = len(own & template)
            dice = 2 * shared / (size + n)
            if shared and dice >= self.threshold and (found is None or dice > found[3]):
                found = (name, shared, size + n, dice)
        return found

    def document(self, text: str | None) -> tuple:
        """Units are the lines; the best match is the first of the highest Dice."""
        matches, top = 0, None
        units = (text or "").split("\n")
        for at, line in enumerate(units):
            if (hit := self.best(line)) is not None:
                matches += 1
                if top is None or hit[3] > top[4]:
                    top = (hit[0], at, hit[1], hit[2], hit[3])
        return (len(units), matches, *(top or (None, None, None, None, None)))


def scan_licences(
    docs: DataFrame, templates: dict[str, list[str]] | None = None, threshold: float = 0.8
) -> DataFrame:
    """Licence notices in the lines of whole texts: one row per row of ``docs``.

    Result: doc_id, n_units (lines), n_matches (lines at or over ``threshold``), and for the best line its
    licence, line number from 0, shared bigrams, bigrams of line and template together, and Dice
    coefficient. Ties go to the earlier line, then to the smaller template, then to the name.

    Defined cases: a null or empty text has one empty line and no match; lines of fewer than two words match
    nothing; without templates nothing matches; repeated rows come back as often as they went in; other
    columns play no part. Narrow map work: no shuffle, memory of one Arrow batch.
    """
    chosen = TEMPLATES if templates is None else templates

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(chosen, threshold)
        for batch in batches:
            found = list(zip(*[scanner.document(x.as_py()) for x in batch.column("text")])) or [()] * 7
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.float64())
            columns = [pa.array(v, kind) for v, kind in zip(found, kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=NAMES)

    return pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text").mapInArrow(scan, SCHEMA)


def full_texts() -> dict[str, list[str]]:
    """Whole licence texts by name, of the files beside this module."""
    files = sorted((Path(__file__).parent / "licence_texts").glob("*.txt"))
    return {f.stem: [f.read_text(encoding="utf-8")] for f in files}


def all_templates() -> dict[str, list[str]]:
    """The notices and the whole licence texts."""
    whole = full_texts()
    return {name: TEMPLATES.get(name, []) + whole.get(name, []) for name in sorted(TEMPLATES | whole)}


TEXT_NAMES = ["doc_id", "n_words", "licences", "licence", "unit", "first_word", "n_unit", "shared", "bigrams", "dice"]
TEXT_SCHEMA = (
    "doc_id long, n_words long, licences array<string>, licence string, unit string, first_word int, n_unit int, "
    "shared int, bigrams int, dice double"
)


class TextScanner:
    """Units over line ends: lines, paragraphs, the document, and windows of each template's words.

    A unit with s of the n bigrams of a template has a Dice of 2 s / (n + s) at most, so s >= t / (2 - t) n is needed:
    a template of which the document has fewer is left out, and so is a unit with fewer.
    """

    def __init__(self, templates: dict[str, list[str]], threshold: float):
        self.templates, self.homes, self.needed, self.barred = [], {}, [], []
        for name in sorted(templates):
            for text in templates[name]:
                if pairs := bigrams(text):
                    least = max(1, threshold / (2 - threshold) * len(pairs) * (1 - 1e-9))
                    for pair in pairs:
                        self.homes.setdefault(pair, []).append(len(self.templates))
                    own = words(text)
                    numbers = {w for w in own if w.isdigit() and len(own) <= NOTICE}
                    self.needed.append(numbers | DECIDING.intersection(own))
                    self.barred.append(DECIDING.difference(own))
                    self.templates.append((name, pairs, len(own), least))
        self.threshold = threshold

    def document(self, text: str | None) -> tuple:
        found, lines, paragraphs, open_at = [], [], [], None
        for line in (text or "").split("\n"):
            start = len(found)
            found += words(line)
            lines.append((start, len(found)))
            if line.strip():
                open_at = start if open_at is None else open_at
            elif open_at is not None:
                paragraphs.append((open_at, start))
                open_at = None
        if open_at is not None:
            paragraphs.append((open_at, len(found)))
        pairs = list(zip(found, found[1:]))
        has: dict[int, set] = {}
        for pair in pairs:
            for k in self.homes.get(pair, ()):
                has.setdefault(k, set()).add(pair)
        names, top = set(), None
        for k, shared in has.items():
            name, template, size, least = self.templates[k]
            if len(shared) < least:
                continue
            fixed = [("document", 0, len(found)), *[("paragraph", a, b) for a, b in paragraphs], *[("line", a, b) for a, b in lines]]
            for kind, a, b, common, own in [*self.fixed(pairs, template, fixed, least), *self.windows(pairs, template, size, least)]:
                dice = 2 * common / (own + len(template))
                if dice >= self.threshold and self._named(k, found[a:b]):
                    names.add(name)
                    rank = (-common, -dice, a, b - a, len(template), name, kind, own)
                    top = rank if top is None or rank < top else top
        if top is None:
            return (len(found), [], *(None,) * 7)
        common, dice, a, n, of, name, kind, own = top
        return (len(found), sorted(names), name, kind, a, n, -common, own + of, -dice)

    def _named(self, k: int, unit: list[str]) -> bool:
        """Whether a unit holds the words that tell a template from its near ones."""
        return self.needed[k].issubset(unit) and self.barred[k].isdisjoint(unit)

    def fixed(self, pairs, template, units, least) -> Iterator[tuple]:
        before = [0]
        for pair in pairs:
            before.append(before[-1] + (pair in template))
        for kind, a, b in units:
            # An empty unit at the end begins behind the last pair.
            last = max(a, b - 1)
            if b > a and before[last] - before[a] >= least:
                own = set(pairs[a:last])
                yield kind, a, b, len(own & template), len(own)

    def windows(self, pairs, template, size, least) -> Iterator[tuple]:
        """Every window of ``size`` words with enough shared bigrams; counts are carried from one to the next."""
        held, common = Counter(), 0
        for at, pair in enumerate(pairs):
            held[pair] += 1
            if held[pair] == 1 and pair in template:
                common += 1
            start = at - size + 2
            if start > 0:
                gone = pairs[start - 1]
                held[gone] -= 1
                if not held[gone]:
                    del held[gone]
                    common -= gone in template
            if start >= 0 and common >= least:
                yield "window", start, start + size, common, len(held)


def scan_licence_texts(
    docs: DataFrame, templates: dict[str, list[str]] | None = None, threshold: float = 0.8
) -> DataFrame:
    """Licence notices and whole licence texts anywhere in whole texts: one row per row of ``docs``.

    Units are the lines, the paragraphs (between blank lines), the whole document, and for each template all windows
    of as many words as it has, over line ends. Result: doc_id, n_words, licences (names with a unit at or over
    ``threshold``, sorted), and of the best unit its licence, kind, first word from 0, words, shared bigrams,
    bigrams of unit and template together, and Dice coefficient. The best unit is the one that shares most bigrams
    with a template, so that a whole licence text goes before a notice inside it; ties go to the higher Dice, the
    earlier unit, the shorter one, the smaller template, the name, then the kind.

    Near licences are told apart by ``DECIDING`` words (and, in notices, numbers): a unit has to hold those of the template and
    none of the others.

    Defined cases: a null or empty text has no word and no licence; units of fewer than two words match nothing;
    without templates nothing matches; repeated rows come back as often as they went in; other columns play no
    part. Narrow map work: no shuffle; linear in the words, and once more for each template that is mostly there.
    """
    chosen = all_templates() if templates is None else templates

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = TextScanner(chosen, threshold)
        for batch in batches:
            found = list(zip(*[scanner.document(x.as_py()) for x in batch.column("text")])) or [()] * 9
            kinds = (
                pa.int64(), pa.list_(pa.string()), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32(),
                pa.float64(),
            )
            columns = [pa.array(v, kind) for v, kind in zip(found, kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=TEXT_NAMES)

    return pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text").mapInArrow(scan, TEXT_SCHEMA)
