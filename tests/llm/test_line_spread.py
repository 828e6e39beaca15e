import hashlib
import re
from collections import defaultdict

import pytest

from gleanery.llm import line_spread

from .helpers import clashing, documents


def normal(line):
    return re.sub(r"[ \t\n\x0b\f\r]+", " ", line).strip(" ").lower()


def plain(rows, min_sites):
    """The report's rows, from :func:`plain_texts`."""
    n_lines = lambda text: 0 if text is None else len(text.split("\n"))
    sha = lambda text: hashlib.sha256((text or "").encode()).hexdigest()
    kept = plain_texts(rows, min_sites, in_order=True)
    return sorted([(i, n_lines(old), n, sha(text)) for (i, text, n), (_, old, _) in zip(kept, rows)], key=str)


def cases():
    rows = []
    for i in range(40):
        furniture = "Read more   HERE\n" if i % 2 else "read more here\n"
        near = "Nine sites only\n" if i < 9 else ""
        rows.append((i, furniture + near + f"own text of the document number {i} which is long enough\n\n last {i}", f"s{i % 15}"))
    copied = "\n".join(f"a copied line number {k}" for k in range(8))
    rows += [(100 + i, copied, f"s{i}") for i in range(15)]
    rows += [(200, None, "s1"), (201, "", "s1"), (202, "read more here", None), (203, "\n\n", "s2"), (None, "x\nread more here\n" + "y" * 60, "s3")]
    rows += [(0, rows[0][1], "s0"), (204, "read more here\n" * 5000 + "z" * 100_000, "s4")]
    return rows


@pytest.mark.parametrize("min_sites", [1, 9, 10, 11])
def test_against_counting(spark, min_sites):
    rows = cases()
    found = line_spread.line_spread_report(clashing(documents(spark, rows)), min_sites=min_sites)
    assert sorted([tuple(r) for r in found.collect()], key=str) == plain(rows, min_sites)


def test_many_sites_are_settled_by_sketches_and_near_ones_exactly(spark):
    rows = [(i, f"line a\nline b {i % 2}\n" + f"text {i} " * 10, f"site{i}") for i in range(600)]
    for min_sites in (299, 300, 301, 600):
        found = line_spread.line_spread_report(documents(spark, rows), min_sites=min_sites)
        assert sorted([tuple(r) for r in found.collect()], key=str) == plain(rows, min_sites)


def test_empty_table(spark):
    assert line_spread.line_spread_report(documents(spark, cases()).limit(0)).collect() == []


def plain_texts(rows, min_sites, in_order=False):
    """Every widespread line goes; equal texts count with one site."""
    first, sites = {}, defaultdict(set)
    for _, text, site in rows:
        if text is not None and site is not None:
            first[normal(text)] = min(site, first.get(normal(text), site))
    for _, text, site in rows:
        counted = first.get(normal(text or ""), site)
        for line in (text or "").split("\n"):
            if site is not None:
                sites[normal(line)].add(counted)
    out = []
    for i, text, _ in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not normal(x) or len(sites[normal(x)]) < min_sites]
        out.append((i, None if text is None else "\n".join(kept), len(lines) - len(kept)))
    return out if in_order else sorted(out, key=str)


@pytest.mark.parametrize("min_sites", [1, 9, 10, 11])
def test_all_widespread_lines_go(spark, min_sites):
    rows = cases()
    found = line_spread.drop_widespread_lines(clashing(documents(spark, rows)), min_sites=min_sites)
    assert sorted([(r.doc_id, r.text, r.n_removed) for r in found.collect()], key=str) == plain_texts(rows, min_sites)


def test_pages_of_mostly_furniture_lose_it_and_copies_stay(spark):
    furniture = "\n".join(f"a line of the page frame number {k}" for k in range(6))
    copied = "\n".join(f"a line of the copied text number {k}" for k in range(6))
    rows = [(i, f"{furniture}\nown {i}", f"s{i}") for i in range(12)]
    rows += [(100 + i, copied.replace(" ", " " * (1 + i % 2)), f"s{i}") for i in range(12)]
    found = {r.doc_id: r.text for r in line_spread.drop_widespread_lines(documents(spark, rows)).collect()}
    assert found == {i: f"own {i}" if i < 100 else text for i, text, _ in rows}
