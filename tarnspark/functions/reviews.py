"""Ratings and nested reviews from structured data, listing pages and cells."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tarnspark.functions import rules
from tarnspark.functions.text import clean_text, collapse, decode_entities, strip, text_or_empty, truncate

REVIEW = "struct<author:string,rating:double,date:string,text:string>"
REVIEWS = f"array<{REVIEW}>"
_BLOCK = r"""(?isU)<script[^>]+type=["']application/ld\+json["'][^>]*>([^<]+)</script>"""


#: Types of a business that stands alone in a script; in lists and graphs only the first counts.
BUSINESS_TYPES = ("LocalBusiness", "Organization", "ProfessionalService")


def jsonld_texts(html: Column) -> Column:
    """The bodies of a page's structured-data scripts."""
    return F.transform(F.regexp_extract_all(html, F.lit(_BLOCK), 1), strip)


def _get(v: Column, path: str, kind: str) -> Column:
    """What a VARIANT holds at a path, null if it isn't there or is of another kind."""
    return F.try_variant_get(v, path, kind)


def _items(v: Column, path: str) -> Column:
    return F.coalesce(_get(v, path, "array<variant>"), F.expr("cast(array() as array<variant>)"))


def _is_object(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))


def _typed(v: Column, names: tuple) -> Column:
    kind = F.coalesce(_get(v, "$['@type']", "string"), F.lit(""))  # a list of types as its text
    return _is_object(v) & kind.rlike("|".join(names))


def jsonld_values(html: Column) -> Column:
    """The values of the structured-data scripts of a page. A body can hold several objects, each begun on a new line; it
    counts if all of them parse. A body with one key twice in an object doesn't parse."""
    parts = F.transform(jsonld_texts(html), lambda body: F.transform(F.split(body, r"(?<=\})\n(?=\{)"), F.try_parse_json))
    return F.flatten(F.filter(parts, lambda values: F.forall(values, lambda v: v.isNotNull())))


def jsonld_business(html: Column) -> Column:
    """The first business of a page as VARIANT: a value of one of ``BUSINESS_TYPES``, or one of the first type in a list or graph."""

    def businesses(v: Column) -> Column:
        nested = F.when(_is_object(v), _items(v, "$['@graph']")).otherwise(_items(v, "$"))
        return F.concat(F.filter(F.array(v), lambda x: _typed(x, BUSINESS_TYPES)), F.filter(nested, lambda x: _typed(x, BUSINESS_TYPES[:1])))

    return F.try_element_at(F.flatten(F.transform(jsonld_values(html), businesses)), F.lit(1))


def _review(r: Column) -> Column:
    """A review of structured data; its author is an object with a name, or a word."""
    author = F.when(_is_object(_get(r, "$.author", "variant")), _get(r, "$.author.name", "string")).otherwise(F.when(F.schema_of_variant(_get(r, "$.author", "variant")) == "STRING", _get(r, "$.author", "string")))
    body = F.coalesce(F.nullif(_get(r, "$.reviewBody", "string"), F.lit("")), _get(r, "$.description", "string"))
    return F.struct(
        strip(text_or_empty(author)).alias("author"), _get(r, "$.reviewRating.ratingValue", "double").alias("rating"),
        F.substring(strip(text_or_empty(_get(r, "$.datePublished", "string"))), 1, 32).alias("date"), strip(decode_entities(text_or_empty(body))).alias("text"),
    )


def page_reviews(html: Column, most: int = 100) -> Column:
    """struct of rating (two decimals) and reviews, of the first ``most`` entries, of the business in a page's structured data."""
    business = jsonld_business(text_or_empty(html))
    one = F.filter(F.array(_get(business, "$.review", "variant")), _is_object)
    entries = F.slice(F.coalesce(_get(business, "$.review", "array<variant>"), one), 1, most)
    reviews = F.transform(F.filter(entries, _is_object), _review)
    return F.struct(F.round(_get(business, "$.aggregateRating.ratingValue", "double"), 2).alias("rating"), F.coalesce(reviews, F.expr(f"cast(array() as {REVIEWS})")).alias("reviews"))


def fallback_rating(html: Column, site: str) -> Column:
    """The rating a listing page shows outside its structured data."""
    patterns = {"angi": r'class="RatingsLockup_ratingNumber[^"]*"[^>]*>(\d(?:\.\d)?)<', "homeadvisor": r'"ratingValue"\s*:\s*"?(\d(?:\.\d{1,4})?)'}
    value = F.regexp_extract(html, patterns[site], 1).try_cast("double")
    return F.round(value, 2) if site == "homeadvisor" else value


def listing_grade(html: Column) -> Column:
    """The letter grade of a listing page."""
    hits = [F.nullif(F.regexp_extract(html, rf'class="{c}"[^>]*>([A-F][+\-]?)<', 1), F.lit("")) for c in ("bpr-letter-grade", "bpr-header-rating")]
    return F.coalesce(*hits)


def listing_name(html: Column) -> Column:
    """The business name of a listing page, unless it is no name."""
    hits = [F.nullif(F.regexp_extract(html, p, 1), F.lit("")) for p in (r'id="businessName"[^>]*>\s*([^<]+?)\s*<', r'class="[^"]*bpr-header-business-name[^"]*"[^>]*>\s*([^<]+?)\s*<')]
    name = decode_entities(collapse(F.coalesce(*hits)))
    return F.when((name != "") & (F.length(name) < 200) & (F.lower(name) != "about"), name)


def clean_reviews(reviews: Column) -> Column:
    """Reviews as exported: cleaned and cut."""
    return F.transform(
        F.filter(reviews, lambda r: r.isNotNull()),
        lambda r: F.struct(
            truncate(clean_text(r["author"]), rules.MAX_AUTHOR).alias("author"), r["rating"].alias("rating"),
            truncate(clean_text(r["date"]), rules.MAX_DATE).alias("date"), truncate(clean_text(r["text"]), rules.MAX_REVIEW).alias("text"),
        ),
    )


def to_cell(reviews: Column) -> Column:
    """A JSON cell; null reviews are an empty one, null ratings stay."""
    return F.when(reviews.isNull(), "").otherwise(F.to_json(clean_reviews(reviews), {"ignoreNullFields": "false"}))


def from_cell(cell: Column) -> Column:
    """Reviews of a JSON cell; what doesn't parse is none. Numeric ratings may be quoted."""
    raw = F.from_json(cell, "array<struct<author:string,rating:string,date:string,text:string>>")
    typed = F.transform(raw, lambda r: F.struct(r["author"].alias("author"), r["rating"].try_cast("double").alias("rating"), r["date"].alias("date"), r["text"].alias("text")))
    return F.coalesce(typed, F.lit(None).cast(REVIEWS), F.expr(f"cast(array() as {REVIEWS})"))


def rated(reviews: Column, rating: float) -> Column:
    """Whether any review has exactly this rating."""
    return F.coalesce(F.exists(reviews, lambda r: r["rating"] == rating), F.lit(False))


def first_reviews(reviews: Column, n: int = 100) -> Column:
    return F.slice(reviews, 1, n)


def links(html: Column, skip: tuple = ("duckduckgo.com", "duck.co")) -> Column:
    """Result links of a search page in order: plain ones, then decoded redirects, each once."""
    plain = F.regexp_extract_all(html, F.lit(r'href="(https?://[^"]+)"'), 1)
    plain = F.filter(plain, lambda u: ~u.rlike("|".join(map(re.escape, skip))))
    sent = F.regexp_extract_all(html, F.lit(r'href="(?://duckduckgo\.com)?/l/\?uddg=([^"&]+)'), 1)
    # a plus sign stays one in a path
    sent = F.filter(F.transform(sent, lambda u: F.try_url_decode(F.replace(u, F.lit("+"), F.lit("%2B")))), lambda u: u.isNotNull())
    sent = F.transform(sent, lambda u: F.when(u.startswith("//"), F.concat(F.lit("https:"), u)).otherwise(u))
    return F.array_distinct(F.concat(plain, sent))


def fenced_json(answer: Column) -> Column:
    """The JSON of an answer that may stand in a Markdown fence."""
    return strip(F.regexp_replace(F.regexp_replace(strip(answer), r"^```(?:json)?\s*", ""), r"\s*```$", ""))


def answer_fields(answer: Column, fields: list[str]) -> Column:
    """struct of ``fields`` of an extractor's JSON answer, empty where it lacks them, and ``parsed``, whether it is an object."""
    v = F.try_parse_json(fenced_json(text_or_empty(answer)))
    return F.struct(*[text_or_empty(_get(v, f"$.{f}", "string")).alias(f) for f in fields], _is_object(v).alias("parsed"))


def api_reviews(response: Column) -> Column:
    """Reviews of a listing service's JSON response."""
    raw = F.from_json(response, "struct<reviews:array<struct<user:struct<name:string>,rating:double,time_created:string,text:string>>>")["reviews"]
    word = lambda c: strip(text_or_empty(c))
    out = F.transform(raw, lambda r: F.struct(word(r["user"]["name"]).alias("author"), r["rating"].alias("rating"), F.substring(text_or_empty(r["time_created"]), 1, 10).alias("date"), word(r["text"]).alias("text")))
    return F.coalesce(out, F.expr(f"cast(array() as {REVIEWS})"))


def card_reviews(cards: Column) -> Column:
    """Extracted cards that have an author or a text."""
    return F.filter(cards, lambda r: (text_or_empty(r["author"]) != "") | (text_or_empty(r["text"]) != ""))
