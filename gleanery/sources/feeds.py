"""Feed lists (OPML) and feed documents (RSS and Atom)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType, _parse_datatype_string

from .. import fixed_values as fv
from ..functions.arrays import clean_items, entry_link, no_strings
from ..functions.text import nonempty, strip
from ..operators.dedupe import first_wins

_OUTLINE_TAG = r"""<outline\b(?:[^>"']|"[^"]*"|'[^']*')*>"""
_OUTLINE_TYPE = StructType(
    [StructField(n, StringType()) for n in ("_title", "_text", "_xmlUrl", "_htmlUrl")]
)


def parse_opml(docs: DataFrame, raw: str = "value", *, keys: tuple[str, ...] = ()) -> DataFrame:
    """Feeds of OPML documents: every outline at any depth that has a feed link, in document
    order; the first of equal links wins within ``keys`` (a document id, say).

    Outline start tags are taken one by one, so that depth does not matter, and each tag is
    read by the XML expression, which decodes attribute values.
    """
    tags = docs.select(
        *keys,
        F.posexplode(
            F.regexp_extract_all(
                F.regexp_replace(F.col(raw), r"(?s)<!--.*?-->", ""), F.lit(_OUTLINE_TAG), F.lit(0)
            )
        ).alias("ord", "tag"),
    )
    # The test keeps group outlines, and duplicates of work, away from the XML reader.
    closed = F.concat(F.regexp_replace("tag", r"/?>$", ""), F.lit("/>"))
    outlines = tags.where(F.contains("tag", F.lit("xmlUrl"))).select(
        *keys, "ord", F.from_xml(closed, _OUTLINE_TYPE).alias("o")
    )
    title = F.coalesce(nonempty("o._title"), nonempty("o._text"), F.col("o._xmlUrl"))
    feeds = outlines.where(nonempty("o._xmlUrl").isNotNull()).select(
        *keys,
        F.col("ord").cast("bigint").alias("ord"),
        strip(title).alias("title"),
        F.col("o._xmlUrl").alias("raw_url"),
        strip("o._xmlUrl").alias("xml_url"),
        F.col("o._htmlUrl").alias("html_url"),
    )
    return first_wins(feeds, [*keys, "raw_url"], "ord").drop("raw_url")


def read_opml(spark: SparkSession, path: str) -> DataFrame:
    return parse_opml(spark.read.text(path, wholetext=True))


_ITEM = """
    title:string,
    link:array<struct<_VALUE:string,_href:string,_rel:string>>,
    description:string,
    summary:string,
    content:array<string>,
    `content:encoded`:array<string>,
    author:array<struct<_VALUE:string,name:string>>,
    `dc:creator`:array<string>,
    category:array<struct<_VALUE:string,_term:string,_label:string>>,
    pubDate:string,
    published:string,
    updated:string,
    `dc:date`:string,
    created:string
"""
# One schema reads RSS 2.0 (items in the channel), RSS 1.0 (items at the root) and Atom.
_FEED = (
    f"channel:struct<item:array<struct<{_ITEM}>>>,item:array<struct<{_ITEM}>>,"
    f"entry:array<struct<{_ITEM}>>"
)


def _feed_type() -> StructType:
    return _parse_datatype_string(f"struct<{_FEED}>".replace("\n", " "))


def feed_items(raw: Column) -> Column:
    """Items of one feed document as an array of structs; broken XML gives none."""
    schema = _feed_type()
    plain = F.from_xml(raw, schema)
    bare = F.from_xml(raw, schema, {"ignoreNamespace": "true"})
    prefixed = raw.rlike(r"^\s*(?:<\?[^>]*>\s*|<!--(?s:.*?)-->\s*)*<[A-Za-z][\w.-]*:feed\b")
    doc = F.when(prefixed, bare).otherwise(plain)
    return doc


def parse_feeds(
    docs: DataFrame, raw: str = "raw", *, max_items: int | None = None
) -> DataFrame:
    """Entries of feed documents (the first ``max_items`` of each, if given), one row per entry.

    All columns but ``raw`` are kept; ``entry_pos`` is the place in the feed and ``entry``
    holds title, summary, contents, summary_detail, link, hrefs, author names, terms and the
    date texts in their order of preference.
    """
    kept = [c for c in docs.columns if c != raw]
    parsed = docs.select(*kept, feed_items(F.col(raw)).alias("doc"))
    items = F.coalesce(F.col("doc.channel.item"), F.col("doc.item"), F.col("doc.entry"))
    wanted = items if max_items is None else F.slice(items, 1, max_items)
    rows = parsed.select(*kept, F.posexplode(wanted).alias("entry_pos", "item"))
    return rows.select(*kept, F.col("entry_pos").cast("bigint").alias("entry_pos"), _entry("item").alias("entry"))


def _entry(item: str) -> Column:
    def field(name: str) -> Column:
        return F.col(item).getField(name)

    def texts(name: str, sub: str | None = None) -> Column:
        array = field(name)
        values = array if sub is None else F.transform(array, lambda x: x[sub])
        return F.coalesce(F.filter(values, lambda x: x.isNotNull() & (x != "")), no_strings())

    links = F.coalesce(field("link"), F.array().cast("array<struct<_VALUE:string,_href:string,_rel:string>>"))
    own = F.get(F.filter(F.transform(links, lambda x: x["_VALUE"]), lambda x: strip(x) != ""), F.lit(0))
    alternate = F.get(
        F.transform(
            F.filter(links, lambda x: F.coalesce(x["_rel"], F.lit("alternate")) == "alternate"),
            lambda x: x["_href"],
        ),
        F.lit(0),
    )
    contents = F.concat(texts("content"), texts("content:encoded"))
    detail = F.coalesce(field("description"), field("summary"))
    terms = F.transform(
        field("category"), lambda c: F.coalesce(nonempty(c["_term"]), nonempty(c["_label"]), c["_VALUE"])
    )
    return F.struct(
        F.coalesce(field("title"), F.lit("")).alias("title"),
        F.coalesce(detail, F.get(contents, F.lit(0))).alias("summary"),
        contents.alias("contents"),
        detail.alias("summary_detail"),
        entry_link(F.coalesce(own, alternate), F.transform(links, lambda x: x["_href"])).alias("link"),
        texts("author", "name").alias("author_names"),
        F.coalesce(
            F.get(texts("author", "_VALUE"), F.lit(0)), F.get(texts("dc:creator"), F.lit(0))
        ).alias("author"),
        terms.alias("terms"),
        F.array(
            F.coalesce(field("pubDate"), field("published")),
            F.coalesce(field("updated"), field("dc:date")),
            field("created"),
        ).alias("dates"),
    )
