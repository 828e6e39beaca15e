"""Sections, skills and titles on hand-made descriptions."""

import random

import pytest
from pyspark.sql import functions as F

from gleanery import fixed_values as fv
from gleanery.functions import skills


def sections(each, *texts):
    return [(r.responsibilities, r.skills, r.requirements) for r in each(skills.description_sections, list(texts))]


def test_headings_open_and_blank_lines_close(each):
    text = "Key Responsibilities:\n- Build\n* build\n• Ship\n\nloose\nRequired skills\r\nSQL\rGit"
    assert sections(each, text) == [(["Build", "Ship"], ["SQL", "Git"], [])]


@pytest.mark.parametrize("code, headings", [(0, fv.RESPONSIBILITY_HEADINGS), (1, fv.SKILL_HEADINGS), (2, fv.REQUIREMENT_HEADINGS)])
def test_every_heading(each, code, headings):
    for heading in headings:
        found = sections(each, f"** {heading.upper()} **\nline")[0]
        if "'" in heading:
            # Its apostrophe turns into a blank, so this heading never matches.
            assert found == ([], [], [])
        else:
            assert found[code] == ["line"], heading


def test_heading_words_may_be_separated_by_anything(each):
    assert sections(each, "what -- you... WILL/do\nx")[0][0] == ["x"]
    # A number before the heading leaves only the hint word.
    assert sections(each, "1. responsibilities\nx") == [(["1. responsibilities"], [], [])]


def test_content_after_heading_word_is_lost(each):
    assert sections(each, "Skills: a, b\nc") == [([], ["c"], [])]
    assert sections(each, "Experience with Python") == [([], [], [])]


def test_loose_lines_are_routed_by_hints(each):
    text = "You are responsible\nGood skillset\nWe require tea\nUnqualified\nnothing\n沟通能力\n其他要求"
    assert sections(each, text) == [
        (["You are responsible"], ["Good skillset", "沟通能力"], ["We require tea", "Unqualified", "其他要求"])
    ]


def test_missing_description(each):
    assert sections(each, None, "", " \n ") == [([], [], [])] * 3


def test_clean_skill_phrase(each):
    raw = [
        " - Knowledge of Spark skills. ",
        "EXPERIENCE WITH Python",
        "Proficiency in teamwork skill expertise",
        "Python expertise skill",
        "experience with",
        "x" * 80,
        "x" * 81,
        "a b c d e f g h",
        "a b c d e f g h i",
        "hands-on experience with knowledge of Go",
        "",
        None,
    ]
    want = ["Spark", "Python", "teamwork skill", "Python", None, "x" * 80, None, "a b c d e f g h", None, "knowledge of Go", None, None]
    assert each(skills.clean_skill_phrase, raw) == want


def test_normalize_skills(each):
    raw = [["Python, sql/Go; R", "PYTHON\nknowledge of Git", None, " . "]]
    assert each(skills.normalize_skills, raw, "array<string>") == [["Python", "sql", "Go", "R", "Git"]]


def local(each, *texts, hashtags=True):
    return each(lambda c: skills.local_skills(c, skills.no_strings(), hashtags), list(texts))


def test_local_skills_order_and_dictionary(each):
    text = "THE postgresql and Big Data with #Data-Science_x in NLP, golang. machine learning"
    assert local(each, text) == [["machine learning", "big data", "Data Science x", "THE", "PostgreSQL", "NLP", "Go"]]
    assert local(each, text, hashtags=False) == [["machine learning", "big data", "THE", "PostgreSQL", "NLP", "Go"]]


def test_tokens_that_never_match(each):
    assert local(each, "C++ R C# CI/CD powerBI. rest-") == [["Power BI", "REST"]]


def test_tokens_need_unicode_word_boundaries(each):
    assert local(each, "éAB ABé AB") == [["AB"]]


def test_section_skills_come_first(one):
    found = skills.local_skills("d", "s")
    assert one(found, "d string, s array<string>", "SQL", ["a, sql"]) == ["a", "sql"]


def test_titles(each):
    text = "Job title: Data Lead -\nWe need a SoftwareEngineer now\nSenior Software Engineer\n" + "hiring " + "x" * 120
    assert each(skills.guess_titles, [text, None]) == [["Job title: Data Lead", "SoftwareEngineer"], []]
    spaced = each(lambda c: skills.guess_titles(c, spaced_roles=True), ["A Senior Software Engineer here"])
    assert spaced == [["Senior Software Engineer"]]


def test_title_line_length_limit(each):
    keep, drop = "role " + "x" * 115, "role " + "x" * 116
    assert each(skills.guess_titles, [keep, drop]) == [[keep], []]


def test_modes(each):
    assert each(lambda c: skills.insight_for_mode(c, "none"), ["hiring"])[0].job_titles == []
    assert each(lambda c: skills.insight_for_mode(c, "local"), ["hiring"])[0].job_titles == ["hiring"]
    with pytest.raises(ValueError):
        skills.insight_for_mode("x", "other")


def brute_sections(text):
    """The rules again, line by line."""
    import re

    names = ["responsibilities", "skills", "requirements"]
    heads = [fv.RESPONSIBILITY_HEADINGS, fv.SKILL_HEADINGS, fv.REQUIREMENT_HEADINGS]
    hints = [fv.RESPONSIBILITY_HINTS, fv.SKILL_HINTS, fv.REQUIREMENT_HINTS]
    out, state = {n: {} for n in names}, None
    for raw in re.split(r"\r\n|\r|\n", text):
        line = raw.strip().strip(" -*•\t")
        key = " ".join(re.findall("[a-zA-Z0-9一-鿿]+", line)).lower()
        opened = [n for n, hs in zip(names, heads) if key.startswith(tuple(hs))]
        if not line:
            state = None
        elif opened:
            state = opened[0]
        else:
            target = state or next((n for n, hs in zip(names, hints) if any(h in key for h in hs)), None)
            if target:
                out[target].setdefault(line.lower(), line)
    return tuple(list(out[n].values()) for n in names)


def test_sections_against_brute_force(each):
    rng = random.Random(7)
    pieces = [
        "Skills", "skills:", "Key Responsibilities", "* What you will do", "must-have", "nice to have stuff",
        "", "  ", "-", "•", "plain line", "Plain Line", "we require it", "skillful", "responsibly", "要求", "岗位要求", "a\tb",
    ]
    texts = [
        "".join(rng.choice(pieces) + rng.choice(["\n", "\r\n", "\r", "\n\n"]) for _ in range(rng.randint(0, 25)))
        for _ in range(300)
    ]
    assert sections(each, *texts) == [brute_sections(t) for t in texts]


def test_normalizing_twice_changes_nothing_without_cuttable_parts(each):
    raw = [["Go, Rust/Zig", "Team work; go"], ["a, b", "B"]]
    once = each(skills.normalize_skills, raw, "array<string>")
    assert each(skills.normalize_skills, once, "array<string>") == once


def test_known_phrases_by_their_last_words(each):
    texts = [
        "big data science, xmachine learnings; Natural Language Processing", "data  science", "learning big\ndata", "", None,
        "go-to-market strategy go-to-market strategies", " data data data", "RİSK management Risk Management",
    ]
    found = each(lambda c: skills._skill_phrases(F.lower(F.coalesce(c, F.lit("")))), texts)
    assert found == [[p for p in fv.SKILL_PHRASES if p in (t or "").lower()] for t in texts]


def test_last_words_that_begin_others_stand_for_them():
    assert skills._last_words(["big data", "my database", "one"]) == {"big data": "data", "my database": "data"}


def test_titles_alone_need_no_skills(spark):
    rows = spark.createDataFrame([("hiring",)], "descr string").select(skills.insight_for_mode("descr", "local").alias("i"))
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "machine learning" in plan(rows)
    assert "machine learning" not in plan(rows.select("i.job_titles"))
