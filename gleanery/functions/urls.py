"""Links and identifiers held in links."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .. import fixed_values as fv
from .text import as_col, let, nonblank, nonempty, or_empty, strip

_URL_PARTS = r"^((?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//)([^/?#]*)(.*)$"


def post_id(link: Column | str, data_urn: Column | str) -> Column:
    """Activity id from a link, else from the card's own attribute, else null."""
    marker = F.lit(fv.POST_ID_MARKER)

    def after_marker(value: Column) -> Column:
        return F.when(F.contains(value, marker), F.substring_index(value, fv.POST_ID_MARKER, -1))

    from_link = F.replace(after_marker(strip(link)), F.lit("/"), F.lit(""))
    return F.coalesce(nonempty(from_link), nonempty(after_marker(as_col(data_urn))))


def absolute(link: Column | str, prefix: str, site: str = fv.POST_SITE) -> Column:
    """Prepend the site to links that start with ``prefix``."""
    url = strip(link)
    return F.when(url.startswith(prefix), F.concat(F.lit(site), url)).otherwise(url)


def candidate_urls(url: Column | str) -> Column:
    """Host variants under which a page may be stored, in order, without repeats."""
    source = as_col(url)
    scheme = F.lower(F.regexp_extract(source, _URL_PARTS, 1))
    host = F.regexp_extract(source, _URL_PARTS, 2)
    tail = F.regexp_extract(source, _URL_PARTS, 3)
    # An empty query or fragment is not kept.
    tail = F.regexp_replace(F.regexp_replace(tail, r"#$", ""), r"\?(?=#|$)", "")

    def build(h: Column) -> Column:
        rest = F.substr(h, F.lit(5))
        other = F.when(h.startswith("www."), rest).otherwise(F.concat(F.lit("www."), h))
        hosts = F.array(h, F.when(h.startswith("cdn."), rest), other)
        return F.array_distinct(F.filter(hosts, lambda x: x.isNotNull() & (x != "")))

    hosts = F.when(host != "", let(host, build)).otherwise(F.array().cast("array<string>"))
    return F.transform(hosts, lambda h: F.concat(scheme, h, tail))


def first_url(*sources: Column) -> Column:
    """First non-blank of ShareUrl, ArticleUrl, Url over the given structs, in order."""
    return F.coalesce(
        *[nonblank(s[name]) for s in sources for name in ("ShareUrl", "ArticleUrl", "Url")]
    )


def article_url(
    hit: Column, meta: Column, detail: Column, article_base: str = fv.PRESS_ARTICLE_BASE
) -> Column:
    """Link of an article: its own links first, else its issue's link plus id, else the base
    plus id, else ''."""
    region = F.coalesce(nonempty(hit["RegionId"]), nonempty(meta["Id"]))
    issue = F.coalesce(nonempty(meta["Issue"]["Url"]), nonempty(meta["Issue"]["ShareUrl"]))
    in_issue = F.when(issue.endswith("/"), F.concat(issue, region)).otherwise(
        F.concat(issue, F.lit("/"), region)
    )
    return F.coalesce(
        first_url(meta, detail, hit), in_issue, F.concat(F.lit(article_base), region), F.lit("")
    )


def article_id(region_id: Column | str, url: Column | str) -> Column:
    """Stored id, else the digits after ``/article/`` in the link, else null."""
    return F.coalesce(
        nonblank(region_id),
        nonempty(F.regexp_extract(or_empty(url), r"(?U)/article/(\d+)", 1)),
    )
