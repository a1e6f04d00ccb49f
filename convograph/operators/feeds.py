"""What feeds say about themselves, and what their configuration lacks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tidy(names: Column) -> Column:
    """Distinct names that are not blank, trimmed, in order."""
    return F.array_sort(F.array_distinct(F.filter(F.transform(names, lambda x: F.trim(x)), lambda x: x != "")))


def details(rows: DataFrame, xml: Column) -> DataFrame:
    """Adds categories (plain ones and those of the podcast extension), keywords (split at commas) and image (its reference, else its address, else the extension's, else '')
    of a channel as XML whose extension elements are named with an underscore."""
    get = lambda path: F.nullif(F.xpath_string(xml, F.lit(path)), F.lit(""))
    categories = F.concat(F.xpath(xml, F.lit("//category/text()")), F.xpath(xml, F.lit("//itunes_category/@text")))
    return rows.withColumns({
        "categories": tidy(categories), "keywords": tidy(F.split(F.coalesce(get("//keywords"), F.lit("")), ",")),
        "image": F.coalesce(get("//image/@href"), get("//image/url"), get("//itunes_image/@href"), F.lit("")),
    })


def config_errors(ident: Column, url: Column) -> Column:
    """What is wrong with a feed's identifier and address."""
    blank = lambda c: F.trim(F.coalesce(c, F.lit(""))) == ""
    found = F.array(
        F.when(blank(ident), "id: missing").when(~ident.rlike(r"^[a-zA-Z0-9_-]+$"), "id: not letters, digits, _ or -"),
        F.when(blank(url), "rss_url: missing").when(~url.rlike("^https?://"), "rss_url: not http"),
    )
    return F.filter(found, lambda x: x.isNotNull())
