"""URL and domain expressions. All are Column -> Column and stay in the JVM but ``join_url``."""

from __future__ import annotations

import re
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tarnspark.functions import rules

_NETLOC = r"^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?//([^/?#]*)"


def _alternatives(values) -> str:
    return "|".join(re.escape(v) for v in values)


def netloc(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _NETLOC, 1), F.lit(""))


def domain(url: Column) -> Column:
    """Lower-cased network location less one leading ``www.``; empty without a scheme."""
    return F.regexp_replace(F.lower(netloc(url)), r"^www\.", "")


def domain_of(url: Column) -> Column:
    """As ``domain``, for urls that may lack a scheme."""
    full = F.when(F.contains(url, F.lit("://")), url).otherwise(F.concat(F.lit("http://"), url))
    return F.when(F.coalesce(url, F.lit("")) == "", "").otherwise(domain(full))


def apex(url: Column, compound=rules.COMPOUND_TLDS) -> Column:
    """The label before the public suffix; a single label is itself."""
    parts = F.split(domain_of(url), r"\.")
    last_two = F.array_join(F.slice(parts, -2, 2), ".")
    return (
        F.when((F.size(parts) >= 3) & last_two.isin(*compound), F.try_element_at(parts, F.lit(-3)))
        .when(F.size(parts) >= 2, F.try_element_at(parts, F.lit(-2)))
        .otherwise(F.try_element_at(parts, F.lit(1)))
    )


def scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^([a-zA-Z][a-zA-Z0-9+.\-]*):", 1))


def path(url: Column) -> Column:
    """The path less the parameters of its last segment."""
    raw = F.regexp_extract(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)", 1)
    return F.coalesce(F.regexp_replace(raw, r";[^/]*$", ""), F.lit(""))


def clean_url(url: Column) -> Column:
    """scheme://netloc and path; query and fragment go, case and ``www.`` stay."""
    return F.concat(scheme(url), F.lit("://"), netloc(url), path(url))


def without_query(url: Column) -> Column:
    return F.split(url, r"\?")[0]


def without_fragment(url: Column) -> Column:
    return F.split(url, "#")[0]


def foreign_suffix(d: Column, suffixes=rules.FOREIGN_SUFFIXES) -> Column:
    return d.rlike(f"(?:{_alternatives(suffixes)})$")


def foreign_path(p: Column, segments=rules.FOREIGN_PATHS) -> Column:
    return F.lower(p).rlike(_alternatives(segments))


def excluded_domain(d: Column, entries=rules.EXCLUDED_DOMAINS) -> Column:
    """An entry matches itself and its subdomains; one with a leading dot matches as a suffix."""
    exact, suffix = [e for e in entries if e[0] != "."], [e for e in entries if e[0] == "."]
    tests = []
    if exact:
        tests.append(d.rlike(rf"(?:^|\.)(?:{_alternatives(exact)})$"))
    if suffix:
        tests.append(d.rlike(f"(?:{_alternatives(suffix)})$"))
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def excluded(url: Column, suffixes=rules.FOREIGN_SUFFIXES, segments=rules.FOREIGN_PATHS, entries=rules.EXCLUDED_DOMAINS) -> Column:
    """Whether a url is left out; what can't be judged is."""
    return url.isNull() | foreign_suffix(domain(url), suffixes) | foreign_path(path(url), segments) | excluded_domain(domain(url), entries)


def result_link(href: Column) -> Column:
    """Search results that lead out of the search site."""
    return F.coalesce(href.startswith("http") & ~F.contains(href, F.lit("google.com")), F.lit(False))


def quote_plus(text: Column) -> Column:
    return F.replace(F.replace(F.url_encode(text), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))


def quote(text: Column) -> Column:
    """Blanks as %20, slashes kept."""
    return F.replace(F.replace(quote_plus(text), F.lit("+"), F.lit("%20")), F.lit("%2F"), F.lit("/"))


def uule(location: Column) -> Column:
    """Location parameter: a length character and the base64 of the UTF-8 bytes, unbroken."""
    raw = location.cast("binary")
    length = F.substring(F.lit(rules.UULE_ALPHABET), F.octet_length(raw) % len(rules.UULE_ALPHABET) + 1, F.lit(1))
    return F.concat(F.lit("w+CAIQICI"), length, F.regexp_replace(F.base64(raw), r"\s", ""))


def search_url(keyword: Column, location: Column, page: Column) -> Column:
    return F.concat(F.lit("https://www.google.com/search?q="), quote_plus(keyword), F.lit("&uule="), uule(location), F.lit("&start="), (page * 10).cast("string"), F.lit("&num=10"))


def maps_url(keyword: Column, location: Column) -> Column:
    return F.concat(F.lit("https://www.google.com/maps/search/"), quote(F.concat(keyword, F.lit(" in "), location)))


def reviews_link(url: Column) -> Column:
    """The reviews tab of a maps place: a marker after the data value unless it is there."""
    return F.when(F.contains(url, F.lit("!9m1!1b1")), url).otherwise(F.regexp_replace(url, r"(data=[^?#]+)", "$1!9m1!1b1"))


def contact_url(base: Column, contact_path: Column) -> Column:
    return F.concat(scheme(base), F.lit("://"), netloc(base), contact_path)


def listing_search_url(name: Column, city: Column, state: Column) -> Column:
    place = F.concat(city, F.lit(", "), state)
    return F.concat(F.lit("https://www.bbb.org/search?find_text="), quote_plus(name), F.lit("&find_loc="), quote_plus(place))


def match_parameters(name: Column, address: Column, city: Column, state: Column) -> Column:
    """Parameters of a listing lookup, cut to their allowed lengths; the street is the address up to its first comma."""
    cut = lambda c, n: F.substring(F.trim(F.coalesce(c, F.lit(""))), 1, n)
    return F.struct(cut(name, 64).alias("name"), cut(F.split(F.coalesce(address, F.lit("")), ",")[0], 80).alias("address1"), cut(city, 40).alias("city"), cut(state, 3).alias("state"))


def listing_profile(href: Column) -> Column:
    """The profile url of a path in a listing site's results, without its query; else null."""
    return F.when(href.rlike(rules.LISTING_PROFILE_PATH), F.concat(F.lit("https://www.bbb.org"), without_query(href)))


def profile_link(href: Column, host: str, pattern: str) -> Column:
    """Candidate profile urls of a site."""
    return F.contains(domain_of(href), F.lit(host)) & href.rlike(pattern)


@F.pandas_udf(StringType())
def join_url(base: pd.Series, link: pd.Series) -> pd.Series:
    """``link`` resolved against ``base`` unless it is absolute."""
    from urllib.parse import urljoin

    def one(b, x):
        if not x or x.startswith("http"):
            return x
        try:
            return urljoin(b or "", x)
        except ValueError:
            return x

    return pd.Series([one(b, x) for b, x in zip(base, link, strict=True)], dtype=object)
