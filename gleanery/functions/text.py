"""Text normalization as Spark expressions."""

from __future__ import annotations

import html

import pyarrow as pa
from pyspark.sql import Column, functions as F
from pyspark.sql.types import ArrayType, StringType

# Every character that counts as white space, for trimming (Unicode White_Space plus the
# four ASCII separators U+001C to U+001F).
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
SPACES = r"(?U)[\s\x1c-\x1f]+"
WORD = r"(?U)[^\s\x1c-\x1f]+"


def as_col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def let(value: Column, body) -> Column:
    """Bind ``value`` once and use it many times in ``body``.

    A lambda variable is evaluated once per row, whereas a column expression repeated
    inside a higher-order function would be evaluated once per element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def sql_text(value: str) -> str:
    """A text as a SQL literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def string_map(pairs: dict[str, str]) -> Column:
    """Constant map of texts, as one expression."""
    return F.expr(f"map({', '.join(f'{sql_text(k)}, {sql_text(v)}' for k, v in pairs.items())})")


def strip(value: Column | str) -> Column:
    """Trim Unicode white space at both ends."""
    return F.btrim(as_col(value), F.lit(WHITE_SPACE))


def nonblank(value: Column | str) -> Column:
    """Trimmed text, or null when nothing is left."""
    return F.nullif(strip(value), F.lit(""))


def nonempty(value: Column | str) -> Column:
    return F.nullif(as_col(value), F.lit(""))


def or_empty(value: Column | str) -> Column:
    return F.coalesce(as_col(value), F.lit(""))


def collapse(value: Column | str) -> Column:
    """Runs of white space to one blank, ends trimmed, null to ''."""
    return F.btrim(F.regexp_replace(or_empty(value), SPACES, " "))


def csv_safe(value: Column | str) -> Column:
    """One-line text: byte order marks removed, all white space (also CR, LF, TAB and the
    Unicode line separators) collapsed."""
    return collapse(F.replace(or_empty(value), F.lit("\ufeff"), F.lit("")))


def press_text(value: Column | str) -> Column:
    """Soft hyphens removed, no-break spaces to blanks, trimmed."""
    bare = F.replace(as_col(value), F.lit("\u00ad"), F.lit(""))
    return strip(F.replace(bare, F.lit("\u00a0"), F.lit(" ")))


def unix_newlines(value: Column | str) -> Column:
    """CR LF and CR to LF; texts without CR skip the regular expression."""

    def convert(text: Column) -> Column:
        return F.when(F.contains(text, F.lit("\r")), F.regexp_replace(text, r"\r\n?", "\n")).otherwise(text)

    return let(or_empty(value), convert)


def trimmed_lines(value: Column | str) -> Column:
    """Lines of a text, each trimmed of white space; blank lines stay as ''."""
    return F.transform(F.split(unix_newlines(value), "\n", -1), strip)


def content_lines(value: Column | str, strip_chars: str) -> Column:
    """Lines trimmed of white space and then of bullets."""
    return F.transform(
        F.split(unix_newlines(value), "\n", -1), lambda line: F.btrim(strip(line), F.lit(strip_chars))
    )


def word_count(value: Column | str) -> Column:
    return F.regexp_count(as_col(value), F.lit(WORD))


@F.arrow_udf(StringType())
def _unescape(texts: pa.Array) -> pa.Array:
    return pa.array([None if t is None else html.unescape(t) for t in texts.to_pylist()], pa.string())


def decode_entities(value: Column | str, source: Column | str | None = None) -> Column:
    """Character references to characters (the whole HTML5 table).

    Only texts that hold an ampersand travel to Python; the others are sent as null. When
    ``value`` is itself computed, ``source`` is the stored column to test for ampersands, so
    that the computation is not repeated for the test.
    """
    text = as_col(value)
    tested = text if source is None else as_col(source)
    return F.coalesce(_unescape(F.when(F.contains(tested, F.lit("&")), text)), text)


def decode_basic_entities(value: Column | str) -> Column:
    """The six most frequent references, without leaving the JVM; ``&amp;`` goes last so
    that nothing is decoded twice."""
    out = as_col(value)
    for ref, char in (
        ("&lt;", "<"),
        ("&gt;", ">"),
        ("&quot;", '"'),
        ("&#39;", "'"),
        ("&nbsp;", "\u00a0"),
        ("&amp;", "&"),
    ):
        out = F.replace(out, F.lit(ref), F.lit(char))
    return out


def _shown(page: str, sep: str, strip_parts: bool) -> str:
    """The texts of markup that a reader sees: comments, scripts, styles and templates left out."""
    from .html import parse_html

    found = parse_html(page).strings(skip=("script", "style", "template"))
    return sep.join([p for p in (x.strip() for x in found) if p] if strip_parts else found)


@F.arrow_udf(StringType())
def _markup_text(pages: pa.Array) -> pa.Array:
    return pa.array([None if p is None else _shown(p, " ", True) for p in pages.to_pylist()], pa.string())


@F.arrow_udf(StringType())
def _markup_lines(pages: pa.Array) -> pa.Array:
    return pa.array([None if p is None else _shown(p, "\n", False) for p in pages.to_pylist()], pa.string())


@F.arrow_udf(ArrayType(StringType()))
def _markup_texts(lists: pa.Array) -> pa.Array:
    def read(texts):
        return [None if t is None else _shown(t, " ", True) for t in texts]

    return pa.array([None if texts is None else read(texts) for texts in lists.to_pylist()], pa.list_(pa.string()))


def _is_markup(text: Column) -> Column:
    return F.contains(text, F.lit("<")) | F.contains(text, F.lit("&"))


def plain_text(value: Column | str, full_entities: bool = True) -> Column:
    """Markup to text: what a reader sees of the element tree, references decoded, white space
    collapsed. A ``<`` that begins no tag is text.

    Texts without ``<`` and ``&`` stay in the JVM. Without ``full_entities`` all do: tags then go
    by a pattern and only the most frequent references are decoded.
    """
    text = or_empty(value)
    if not full_entities:
        return collapse(decode_basic_entities(F.regexp_replace(text, r"<[^>]+>", " ")))
    return collapse(F.coalesce(_markup_text(F.when(_is_markup(text), text)), text))


def plain_texts(values: Column | str) -> Column:
    """``plain_text`` over an array of texts; lists without any markup stay in the JVM."""
    source = as_col(values)
    marked = F.exists(source, lambda x: _is_markup(or_empty(x)))
    decoded = F.coalesce(_markup_texts(F.when(marked, source)), source)
    return F.transform(decoded, collapse)


def article_clean(value: Column | str, fix_mojibake: bool = True, full_entities: bool = True) -> Column:
    """Clean an article body but keep its paragraphs; markup in it goes by its element tree."""
    decode = decode_entities if full_entities else decode_basic_entities
    text = F.replace(decode(or_empty(value)), F.lit("\u00a0"), F.lit(" "))
    if fix_mojibake:
        text = F.replace(text, F.lit("Â"), F.lit(" "))
    text = strip(text)
    markup = F.contains(text, F.lit("<")) & F.contains(text, F.lit(">"))
    text = F.coalesce(_markup_lines(F.when(markup, text)), text)
    text = F.regexp_replace(text, r"[ \t]+\n", "\n")
    text = F.regexp_replace(text, r"\n{3,}", "\n\n")
    text = F.regexp_replace(text, r"[ \t]{2,}", " ")
    return strip(text)
