"""Array expressions: ordered distinct, joining, and feed entry fields."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import as_col, let, nonblank, nonempty, or_empty, press_text, strip


def no_strings() -> Column:
    return F.array().cast("array<string>")


def distinct_ci(values: Column | str) -> Column:
    """Ordered distinct by lower case; the first spelling wins.

    Rows without repeats, the usual case, cost one hash pass. The others are sorted by key
    and position, so that long arrays stay n log n.
    """

    def first_of_each(items: Column) -> Column:
        keyed = F.array_sort(
            F.transform(items, lambda x, i: F.struct(F.lower(x).alias("k"), i.alias("i"), x.alias("v")))
        )
        heads = let(
            keyed,
            lambda s: F.filter(s, lambda e, i: (i == 0) | (e["k"] != F.get(s, i - 1)["k"])),
        )
        by_place = F.array_sort(F.transform(heads, lambda e: F.struct(e["i"].alias("i"), e["v"].alias("v"))))
        return F.transform(by_place, lambda e: e["v"])

    def dedupe(items: Column) -> Column:
        unique = F.size(F.array_distinct(F.transform(items, F.lower))) == F.size(items)
        return F.when(unique, items).otherwise(first_of_each(items))

    return let(as_col(values), dedupe)


def distinct_exact(values: Column | str) -> Column:
    return F.array_distinct(as_col(values))


def counted(values: Column | str) -> Column:
    """Each distinct item of an array with the number of times it stands there, as structs (item, n), sorted by
    item; null items count as equal."""

    def lengths(items: Column) -> Column:
        heads = F.filter(
            F.transform(items, lambda _, i: i),
            lambda i: (i == 0) | ~F.get(items, i).eqNullSafe(F.get(items, i - 1)),
        )

        def length(at: Column) -> Column:
            return F.transform(
                at,
                lambda a, k: F.struct(
                    F.get(items, a).alias("item"),
                    (F.coalesce(F.get(at, k + 1), F.size(items)) - a).cast("bigint").alias("n"),
                ),
            )

        return let(heads, length)

    return let(F.sort_array(as_col(values)), lengths)


def clean_items(values: Column | str) -> Column:
    """Items without soft hyphens and outer blanks; null and empty ones dropped."""
    items = F.filter(F.transform(as_col(values), press_text), lambda x: x.isNotNull() & (x != ""))
    return F.coalesce(items, no_strings())


def join_list(values: Column | str, sep: str = "; ") -> Column:
    return F.array_join(clean_items(values), sep)


def fields_of(structs: Column, field: str) -> Column:
    """Non-empty values of one field over an array of structs; null array to empty."""
    values = F.filter(
        F.transform(structs, lambda s: s[field]), lambda x: x.isNotNull() & (x != "")
    )
    return F.coalesce(values, no_strings())


def blocks_text(blocks: Column | str) -> Column:
    """Body of an article: its text blocks, cleaned, joined by a blank line."""
    texts = F.transform(F.filter(as_col(blocks), lambda b: b["Role"] == "text"), lambda b: b["Text"])
    return F.array_join(clean_items(texts), "\n\n")


def entry_text(*parts: Column) -> Column:
    """Parts (each an array of texts) joined by a blank line; empty ones dropped, repeats
    kept."""
    joined = F.concat(*[F.coalesce(p, no_strings()) for p in parts])
    return F.array_join(F.filter(joined, lambda x: x.isNotNull() & (x != "")), "\n\n")


def entry_author(names: Column | str, author: Column | str) -> Column:
    """Names joined by a comma, else the single author field, else ''."""
    kept = F.filter(F.transform(as_col(names), strip), lambda x: x.isNotNull() & (x != ""))
    return F.coalesce(nonempty(F.array_join(kept, ", ")), nonblank(author), F.lit(""))


def entry_categories(terms: Column | str) -> Column:
    """Trimmed distinct category names, in order."""
    kept = F.filter(F.transform(as_col(terms), strip), lambda x: x.isNotNull() & (x != ""))
    return F.coalesce(F.array_distinct(kept), no_strings())


def entry_link(link: Column | str, hrefs: Column | str) -> Column:
    """Own link, else the first non-blank link of the list, else ''."""
    others = F.filter(F.transform(as_col(hrefs), strip), lambda x: x.isNotNull() & (x != ""))
    return F.coalesce(nonblank(link), F.get(others, F.lit(0)), F.lit(""))


def string_list(value: Column, path: str = "$") -> Column:
    """A variant holding one string or a list, as a list of trimmed non-empty strings.

    A single string stays in the list even when it is blank; a missing value gives an empty
    list.
    """
    many = F.try_variant_get(value, path, "array<variant>")
    kept = F.filter(
        F.transform(many, lambda v: strip(F.try_variant_get(v, "$", "string"))),
        lambda x: x.isNotNull() & (x != ""),
    )
    one = strip(F.try_variant_get(value, path, "string"))
    return F.when(many.isNotNull(), kept).when(one.isNotNull(), F.array(one)).otherwise(no_strings())


def preview_list(items: Column | str, max_items: int, max_chars: int) -> Column:
    """First items joined by '; ', cut to a width, '-' when there are none."""
    joined = F.array_join(F.slice(as_col(items), 1, max_items), "; ")
    cut = F.when(
        F.length(joined) > max_chars,
        F.concat(F.substring(joined, 1, max_chars - 1), F.lit("…")),
    ).otherwise(joined)
    return F.when(F.size(F.coalesce(as_col(items), no_strings())) == 0, F.lit("-")).otherwise(cut)
