"""Press search hits, article metadata and article details as JSON at rest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import _parse_datatype_string

_LINKS = "ShareUrl:string,ArticleUrl:string,Url:string"
HIT = f"struct<RegionId:string,ProfileId:string,IsTopArticle:boolean,Rank:double,{_LINKS}>"
HIT_PAGE = f"struct<Items:array<{HIT}>,Highlights:array<string>>"
META = (
    "struct<Id:string,Page:string,PageName:string,Section:string,Title:string,Subtitle:string,"
    "HyphenatedTitle:string,Language:string,Byline:string,Rate:string,SimilarsCount:bigint,"
    "CurrentTextLength:bigint,TotalTextLength:bigint,"
    "Issue:struct<Id:string,Title:string,ShortDateString:string,Date:string,CountryCode:string,"
    "CID:string,Url:string,ShareUrl:string>,"
    "Classification:struct<Tags:array<struct<DisplayName:string>>>,"
    "Images:array<struct<Url:string>>,Related:array<struct<Title:string>>,"
    f"Bylines:array<struct<Text:string>>,{_LINKS}>"
)
META_PAGE = f"struct<Articles:array<{META}>>"
DETAIL = f"struct<Id:string,Blocks:array<struct<Role:string,Text:string>>,TotalTextLength:bigint,{_LINKS}>"


def _type(ddl: str):
    return _parse_datatype_string(ddl)


def read_json_texts(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Whole JSON files, one row each, as ``raw``."""
    return spark.read.text(path, wholetext=True).withColumnRenamed("value", "raw")


def parse_hits(pages: DataFrame, raw: str = "raw", page: str = "page") -> DataFrame:
    """Hits of search result pages in arrival order ``(page, pos)``."""
    items = F.from_json(raw, _type(HIT_PAGE)).getField("Items")
    return pages.select(F.col(page).alias("page"), F.posexplode(items).alias("pos", "hit"))


def parse_highlights(pages: DataFrame, raw: str = "raw", page: str = "page") -> DataFrame:
    """Highlight list of every result page."""
    return pages.select(
        F.col(page).alias("page"), F.from_json(raw, _type(HIT_PAGE)).getField("Highlights").alias("highlights")
    )


def parse_metadata(batches: DataFrame, raw: str = "raw", order: str = "batch") -> DataFrame:
    """Articles of metadata batches in arrival order ``(batch, pos)``."""
    articles = F.from_json(raw, _type(META_PAGE)).getField("Articles")
    return batches.select(F.col(order).alias("batch"), F.posexplode(articles).alias("pos", "meta"))


def parse_details(docs: DataFrame, raw: str = "raw") -> DataFrame:
    return docs.select(F.from_json(raw, _type(DETAIL)).alias("detail"))
