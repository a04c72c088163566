"""Fields of raw web pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The entities that are unescaped, the ampersand last.
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&"))


def _inner_text(html: Column, tag: str) -> Column:
    text = F.regexp_extract(html, rf"(?is)<{tag}[^>]*>(.*?)</{tag}>", 1)
    text = F.regexp_replace(text, "<[^>]*>", "")
    for entity, char in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(char))
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def extract_html_fields(pages: DataFrame) -> DataFrame:
    """Title and first heading of each page; empty text when the page has none."""
    html = F.col("html")
    return pages.select("page_id", "url", _inner_text(html, "title").alias("title"), _inner_text(html, "h1").alias("heading"))
