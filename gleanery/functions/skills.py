"""Sections, skills and job titles out of free text.

All of it is array expressions over one row: no shuffle, no Python, and work that grows
linearly with the text.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from .. import fixed_values as fv
from .arrays import distinct_ci, no_strings
from .text import as_col, content_lines, let, or_empty, string_map, trimmed_lines, word_count

SECTION_TYPE = (
    "struct<responsibilities:array<string>,skills:array<string>,requirements:array<string>>"
)
INSIGHT_TYPE = (
    "struct<job_titles:array<string>,responsibilities:array<string>,"
    "skills:array<string>,requirements:array<string>>"
)
INSIGHT_FIELDS = ["job_titles", "responsibilities", "skills", "requirements"]


def _any_of(words) -> str:
    return "(?:" + "|".join(re.escape(w) for w in words) + ")"


# A heading is compared with the line after every run of other characters has become one
# blank. The patterns say the same on the raw line: any such run may stand before and between
# the heading's words. Headings that hold other characters themselves can never match.
_OTHER = "[^a-zA-Z0-9\u4e00-\u9fff]"


def _opening(headings: list[str]) -> str:
    words = [h.split(" ") for h in headings if not re.search(_OTHER, h.replace(" ", ""))]
    return f"^(?i){_OTHER}*(?:" + "|".join(f"{_OTHER}+".join(w) for w in words) + ")"


_OPENS = [
    ("R", _opening(fv.RESPONSIBILITY_HEADINGS)),
    ("S", _opening(fv.SKILL_HEADINGS)),
    ("Q", _opening(fv.REQUIREMENT_HEADINGS)),
]
_ANY_OPENS = _opening(fv.RESPONSIBILITY_HEADINGS + fv.SKILL_HEADINGS + fv.REQUIREMENT_HEADINGS)
# Hints are single words, so they can be looked for in the raw line as well.
_HINTS = [
    ("R", "(?i)" + _any_of(fv.RESPONSIBILITY_HINTS)),
    ("S", "(?i)" + _any_of(fv.SKILL_HINTS)),
    ("Q", "(?i)" + _any_of(fv.REQUIREMENT_HINTS)),
]


def _first_match(line: Column, rules) -> Column:
    out = None
    for code, pattern in rules:
        out = (F if out is None else out).when(line.rlike(pattern), F.lit(code))
    return out


def tagged_lines(description: Column | str) -> Column:
    """Lines of a description with the section they belong to ('R', 'S', 'Q' or null), in
    order; heading and blank lines are left out.

    A heading line opens a section, a blank line closes it, other lines go to the open
    section or, outside any, are routed by hint words. Heading and blank lines become empty
    lines plus a code letter; as no other line is empty, splitting at empty lines yields one
    block per section, with its code in front. The state is thus carried forward without a
    window and without a running aggregate.
    """

    def mark(line: Column) -> Column:
        # One pattern for all headings first: most lines are none.
        event = F.when(line == "", F.lit("\nB")).when(
            line.rlike(_ANY_OPENS), F.concat(F.lit("\n"), _first_match(line, _OPENS))
        )
        return event.otherwise(line)

    lines = content_lines(description, fv.LINE_STRIP_CHARS)
    marked = F.concat(F.array(F.lit("B")), F.transform(lines, mark))
    blocks = F.transform(
        F.split(F.array_join(marked, "\n"), "\n\n", -1), lambda block: F.split(block, "\n", -1)
    )

    def tag(block: Column) -> Column:
        code = F.get(block, F.lit(0))
        return F.transform(
            F.slice(block, F.lit(2), F.size(block)),
            lambda line: F.struct(
                F.when(code == "B", _first_match(line, _HINTS)).otherwise(code).alias("code"),
                line.alias("line"),
            ),
        )

    return F.flatten(F.transform(blocks, tag))


def description_sections(description: Column | str) -> Column:
    """Responsibilities, skills and requirements of a description, as one struct; the first of
    equal lines (ignoring case) counts."""

    def collect(tagged: Column) -> Column:
        def section(code: str) -> Column:
            mine = F.filter(tagged, lambda t: t["code"] == code)
            return distinct_ci(F.transform(mine, lambda t: t["line"]))

        return F.struct(
            section("R").alias("responsibilities"),
            section("S").alias("skills"),
            section("Q").alias("requirements"),
        )

    return let(tagged_lines(description), collect)


_PREFIXES = "^(?i)" + _any_of(fv.SKILL_PREFIXES)
_ANY_CUT = _PREFIXES + "|(?i)" + _any_of(fv.SKILL_SUFFIXES) + r"\z"
# So many words need more characters than this.
_SURELY_FEW_WORDS = 2 * fv.MAX_SKILL_WORDS


def _trim_phrase(phrase: Column) -> Column:
    return F.btrim(phrase, F.lit(fv.SKILL_STRIP_CHARS))


def _shorten_phrase(phrase: Column) -> Column:
    """Cut lead-in and endings; one pattern tells whether there is anything to cut."""

    def cut(trimmed: Column) -> Column:
        out = _trim_phrase(F.regexp_replace(trimmed, _PREFIXES, ""))
        for suffix in fv.SKILL_SUFFIXES:
            out = _trim_phrase(F.regexp_replace(out, "(?i)" + re.escape(suffix) + r"\z", ""))
        return F.when(trimmed.rlike(_ANY_CUT), out).otherwise(trimmed)

    return let(_trim_phrase(phrase), cut)


def _phrase_fits(phrase: Column) -> Column:
    size = F.length(phrase)
    few = (size <= _SURELY_FEW_WORDS) | (word_count(phrase) <= fv.MAX_SKILL_WORDS)
    return (phrase != "") & (size <= fv.MAX_SKILL_CHARS) & few


def clean_skill_phrase(phrase: Column | str) -> Column:
    """A skill phrase without lead-in, ending and outer punctuation; null when nothing is
    left or when it is too long."""
    return let(_shorten_phrase(as_col(phrase)), lambda p: F.when(_phrase_fits(p), p))


def normalize_skills(skills: Column | str) -> Column:
    """Split a list of skill texts at separators, clean each piece, keep the first of equal
    ones."""
    pieces = F.flatten(
        F.transform(
            F.filter(as_col(skills), lambda s: s.isNotNull()),
            lambda s: F.split(s, r"[,/;•\r\n]+", -1),
        )
    )
    cleaned = F.filter(F.transform(pieces, _shorten_phrase), _phrase_fits)
    return distinct_ci(F.coalesce(cleaned, no_strings()))


_SKILL_TOKEN = "^(?:(?i:" + _any_of(fv.SKILL_WORDS) + ")|" + fv.ACRONYM + r")[-./]*\z"


def _skill_tokens(text: Column) -> Column:
    """Dictionary words in their reported spelling and acronyms, in text order.

    Repeats are dropped first, as only the first of equal skills counts in the end; one
    pattern then keeps the hits, and only those are trimmed and looked up.
    """
    spelling = string_map(fv.SKILL_WORDS)
    tokens = F.array_distinct(F.regexp_extract_all(text, F.lit(fv.SKILL_TOKEN_PATTERN), F.lit(0)))
    hits = F.transform(
        F.filter(tokens, lambda t: t.rlike(_SKILL_TOKEN)),
        lambda t: F.btrim(t, F.lit(fv.SKILL_TOKEN_STRIP_CHARS)),
    )
    return F.transform(hits, lambda t: F.coalesce(F.try_element_at(spelling, F.lower(t)), t))


def _last_words(phrases: list[str]) -> dict[str, str]:
    """For each phrase of several words its last word, or the shortest of these words that this begins with."""
    words = {p: p.rsplit(" ", 1)[1] for p in phrases if " " in p}
    return {p: min((w for w in words.values() if word.startswith(w)), key=len) for p, word in words.items()}


def _blank_and_word(words) -> str:
    """Pattern for a blank and one of some words; few characters are blanks, and one branch for each initial follows."""
    initials = sorted({w[0] for w in words})
    return " (?:" + "|".join(re.escape(c) + _any_of(sorted({w[1:] for w in words if w[0] == c})) for c in initials) + ")"


_LAST_WORDS = _last_words(fv.SKILL_PHRASES)


def _skill_phrases(lowered: Column) -> Column:
    """The known phrases that a text holds anywhere, in the order of the list.

    One pass looks for the last words of all phrases; only phrases whose last word stands in the text are looked for.
    """
    ends = F.regexp_extract_all(lowered, F.lit(_blank_and_word(_LAST_WORDS.values())), F.lit(0))

    def present(ends: Column) -> Column:
        def has(phrase: str) -> Column:
            held = F.contains(lowered, F.lit(phrase))
            return F.array_contains(ends, " " + _LAST_WORDS[phrase]) & held if phrase in _LAST_WORDS else held

        # One test per phrase: faster than a lambda over the phrase list.
        return F.array_compact(F.array(*[F.when(has(p), F.lit(p)) for p in fv.SKILL_PHRASES]))

    return let(F.array_distinct(ends), present)


def local_skills(description: Column | str, section_skills: Column | str, hashtags: bool = True) -> Column:
    """Skills found by rules: the skill section, known phrases, hashtags (optional), known
    words and acronyms; normalized."""
    text = or_empty(description)

    parts = [F.coalesce(as_col(section_skills), no_strings()), let(F.lower(text), _skill_phrases)]
    if hashtags:
        parts.append(
            F.transform(
                F.regexp_extract_all(text, F.lit(fv.HASHTAG_PATTERN), F.lit(1)),
                lambda h: F.translate(h, "_-", "  "),
            )
        )
    parts.append(_skill_tokens(text))
    return normalize_skills(F.concat(*parts))


def _title_pattern(spaced_roles: bool) -> str:
    word = fv.TITLE_WORD
    gap = r"\s+" if spaced_roles else ""
    # The look-ahead spares the costly boundary test at characters that cannot start a title.
    return rf"(?U)(?=[A-Z])\b({word}(?:\s+{word}){{0,5}}{gap}({'|'.join(fv.TITLE_ROLES)}))\b"


def guess_titles(description: Column | str, spaced_roles: bool = False) -> Column:
    """Likely job titles: whole lines with a hint word, else a capitalized phrase ending in a
    role. By default the role must be glued to the last word; ``spaced_roles`` asks for a
    space before it instead."""
    hint = _any_of(fv.TITLE_HINTS)
    lines = F.filter(
        trimmed_lines(description),
        lambda x: (x != "") & (F.length(x) <= fv.MAX_TITLE_LINE_CHARS),
    )
    titles = F.transform(
        lines,
        lambda x: F.when(F.lower(x).rlike(hint), F.btrim(x, F.lit(":- "))).otherwise(
            F.nullif(F.regexp_extract(x, _title_pattern(spaced_roles), 1), F.lit(""))
        ),
    )
    return distinct_ci(F.filter(titles, lambda t: t.isNotNull()))


def empty_insight() -> Column:
    return F.struct(*[no_strings().alias(n) for n in INSIGHT_FIELDS])


def local_insight(description: Column | str, spaced_roles: bool = False) -> Column:
    """Titles, responsibilities, skills and requirements by rules, as one struct."""

    text = or_empty(description)

    def others(sections: Column) -> Column:
        return F.struct(
            sections["responsibilities"].alias("responsibilities"),
            local_skills(text, sections["skills"]).alias("skills"),
            sections["requirements"].alias("requirements"),
        )

    # Titles stand apart: a query that reads only them computes no sections and skills.
    titles, rest = guess_titles(text, spaced_roles), let(description_sections(text), others)
    return F.struct(titles.alias("job_titles"), *[rest[name].alias(name) for name in INSIGHT_FIELDS[1:]])


def insight_for_mode(description: Column | str, mode: str | None = "local") -> Column:
    """Rule-based insight, or empty lists when the mode is none."""
    if mode in (None, "", "none"):
        return empty_insight()
    if mode in ("local", "heuristic"):
        return local_insight(description)
    raise ValueError(f"unknown mode: {mode}")
