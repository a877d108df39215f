"""Pluggable parsers and extractors over landed content.

A parser builds a column from a page (``site_id`` -> function of Column); an extractor turns texts into business fields. The default extractor uses
patterns alone; one that calls a model is passed as a function of Arrow batches and runs once for each distinct content.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnspark.functions import pages, reviews, rules, text, urls
from tarnspark.operators.merge import contact_overlay, logo_choice, once_by_content

FIELDS = ["business_name", "business_description", "services_offered", "contact_phone", "contact_email", "address", "business_city", "business_state", "supply_location"]
EXTRACT = "content_key string, " + ", ".join(f"{f} string" for f in [*FIELDS, "logo_url"])

Parser = Callable[[Column], Column]
Extractor = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]
PARSERS: dict[str, Parser] = {}


def parser(site_id: str) -> Callable[[Parser], Parser]:
    """Registers a parser: html -> struct<rating, reviews>."""

    def register(f: Parser) -> Parser:
        PARSERS[site_id] = f
        return f

    return register


def _result(rating: Column, found: Column) -> Column:
    return F.struct(rating.cast("double").alias("rating"), reviews.first_reviews(found, 100).alias("reviews"))


def _with_fallback(site: str) -> Parser:
    def parse(html: Column) -> Column:
        page = reviews.page_reviews(html)
        return _result(F.coalesce(page["rating"], reviews.fallback_rating(html, site)), page["reviews"])

    return parse


for _site in ("angi", "homeadvisor"):
    parser(_site)(_with_fallback(_site))


@parser("bbb")
def _listing(html: Column) -> Column:
    return _result(text.grade(reviews.listing_grade(html)), F.expr(f"cast(array() as {reviews.REVIEWS})"))


@parser("google_maps")
def _maps(html: Column) -> Column:
    page = reviews.page_reviews(html)
    return _result(F.coalesce(page["rating"], text.element_rating(F.regexp_extract(html, r'aria-label="([^"]*stars?[^"]*)"', 1))), page["reviews"])


@parser("yelp")
def _service(response: Column) -> Column:
    return _result(F.get_json_object(response, "$.rating").try_cast("double"), reviews.api_reviews(response))


def parse_pages(landed: DataFrame, sites=None) -> DataFrame:
    """Landed pages (row_idx, site_id, html, ...) with rating and reviews by their site's parser."""
    chosen = F.lit(None).cast(f"struct<rating:double,reviews:{reviews.REVIEWS}>")
    for s in sites or PARSERS:
        chosen = F.when(F.col("site_id") == s, PARSERS[s](F.col("html"))).otherwise(chosen)
    return landed.withColumn("_parsed", chosen).select(*landed.columns, "_parsed.rating", "_parsed.reviews")


def _nothing(batches):
    for b in batches:
        empty = pa.array([""] * b.num_rows)
        yield pa.RecordBatch.from_arrays([b.column("content_key"), *[empty] * (len(FIELDS) + 1)], ["content_key", *FIELDS, "logo_url"])


def extract(sites: DataFrame, extractor: Extractor = _nothing, cache: DataFrame | None = None) -> DataFrame:
    """Business fields of site content (url, homepage_html, contact_html, logo_url): junk sites are left out, each distinct text goes to
    the extractor once (or to ``cache``, a table of earlier results), and contacts found by patterns go over its answers. A logo is the site's own, or the
    first that its page names; the extractor's goes first in fresh answers and last in cached ones."""
    raw = F.concat(text.text_or_empty(F.col("homepage_html")), F.lit("\n"), text.text_or_empty(F.col("contact_html")))
    body = pages.combine_texts(pages.html_to_text(F.col("homepage_html")), F.when(text.text_or_empty(F.col("contact_html")) != "", pages.html_to_text(F.col("contact_html"))))
    named = urls.join_url(F.col("url"), F.nullif(pages.logo_source(text.text_or_empty(F.col("homepage_html"))), F.lit("")))
    ready = sites.select("url", text.first_filled(F.col("logo_url"), named).alias("own_logo"), pages.contacts(raw).alias("contacts"), body.alias("body")).where(~pages.junk(F.col("body")))

    def answers(one: DataFrame) -> DataFrame:
        short = one.withColumn("body", F.substring("body", 1, rules.MAX_TEXT))
        fresh = short if cache is None else short.join(cache.select("content_key"), "content_key", "left_anti")
        got = fresh.select("content_key", "body").mapInArrow(extractor, EXTRACT)
        names = got.columns
        got = got.withColumn("cached", F.lit(False))
        return got if cache is None else got.unionByName(cache.select(*names, F.lit(True).alias("cached")))

    out = once_by_content(ready, "body", answers, ["url", "own_logo", "contacts"])
    over = {"logo_url": logo_choice(F.col("logo_url"), F.col("own_logo"), F.col("cached")), "contact_email": contact_overlay(F.col("contact_email"), F.col("contacts.emails")), "contact_phone": contact_overlay(F.col("contact_phone"), F.col("contacts.phones"))}
    return out.withColumns(over).select(F.col("url").alias("website_url"), *FIELDS, "logo_url")
