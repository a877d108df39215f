"""Names, text cleaning and ratings. Patterns are Unicode-aware, as ``(?U)``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tarnspark.functions import rules


def text_or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def strip(c: Column) -> Column:
    """Trims all Unicode white space, not blanks alone."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def collapse(c: Column) -> Column:
    return strip(F.regexp_replace(c, r"(?U)\s+", " "))


def slug(c: Column) -> Column:
    s = F.regexp_replace(F.lower(text_or_empty(c)), r"(?U)[^\w\s-]", "")
    return F.regexp_replace(F.regexp_replace(s, r"(?U)[\s_-]+", "-"), "^-+|-+$", "")


def normalize_name(c: Column, words=rules.LEGAL_WORDS) -> Column:
    s = F.regexp_replace(F.replace(text_or_empty(c), F.lit("&"), F.lit(" and ")), r"""[,.()"'\\:]""", " ")
    return F.lower(collapse(F.regexp_replace(s, rf"(?iU)\b(?:{'|'.join(words)})\b\.?", " ")))


def search_name(c: Column) -> Column:
    """A name for a search box: punctuation and legal suffixes go, case and order stay."""
    s = F.regexp_replace(F.replace(text_or_empty(c), F.lit("&"), F.lit("and")), r"""[,."'()]""", " ")
    return collapse(F.regexp_replace(s, r"(?iU)\b(?:LLC|Inc|Corp|Ltd|Co)\b\.?", " "))


def tokens(c: Column) -> Column:
    """The distinct words of a normalised name."""
    return F.array_distinct(F.regexp_extract_all(c, F.lit(r"(?U)(\w+)"), 1))


def match_key(state: Column, city: Column, name: Column) -> Column:
    return F.concat_ws("|", F.upper(text_or_empty(state)), slug(city), normalize_name(name))


def clean_text(c: Column) -> Column:
    return collapse(F.replace(F.replace(text_or_empty(c), F.lit("\0"), F.lit("")), F.lit("\r"), F.lit(" ")))


def truncate(c: Column, n: int) -> Column:
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit("…"))).otherwise(c)


def decode_entities(c: Column) -> Column:
    """The three entities of review texts."""
    return F.replace(F.replace(F.replace(c, F.lit("&amp;"), F.lit("&")), F.lit("&quot;"), F.lit('"')), F.lit("&#39;"), F.lit("'"))


def content_hash(c: Column) -> Column:
    return F.md5(F.encode(c, "utf-8"))


def grade(letter: Column, grades=None) -> Column:
    pairs = [x for k, v in (grades or rules.GRADES).items() for x in (F.lit(k), F.lit(v))]
    return F.try_element_at(F.create_map(*pairs), letter)


def first_rating(c: Column) -> Column:
    """The first number out of five in a text."""
    hits = F.regexp_extract_all(c, F.lit(r"(?iU)(\d(?:\.\d{1,2})?)\s*(?:/\s*5|out of 5|stars?\b|★)"), 1)
    values = F.transform(hits, lambda x: x.try_cast("double"))
    return F.try_element_at(F.filter(values, lambda v: (v > 0) & (v <= 5)), F.lit(1))


def element_rating(c: Column) -> Column:
    """``first_rating``, or the bare leading number of a short text."""
    short = strip(c)
    bare = F.regexp_extract(short, r"(?U)^\s*(\d(?:\.\d{1,2})?)\b", 1).try_cast("double")
    return F.coalesce(first_rating(c), F.when((F.length(short) <= 30) & bare.between(0.5, 5.0), bare))


def star_label(c: Column) -> Column:
    """The first digit of a label."""
    return F.regexp_extract(c, r"(\d)", 1).try_cast("int")


def backoff(attempt: Column, base: float = 3.0, most: float = 30.0) -> Column:
    return F.least(base * F.pow(F.lit(2.0), attempt - 1), F.lit(most))


def cooldown(failures: Column, base: float = 120.0, most: float = 300.0) -> Column:
    return F.least(base * failures, F.lit(most))


def first_filled(*columns: Column) -> Column:
    """The first column that isn't blank, trimmed; else empty."""
    return F.coalesce(*[F.nullif(strip(c), F.lit("")) for c in columns], F.lit(""))


def blank(c: Column) -> Column:
    return strip(text_or_empty(c)) == ""


def any_of(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests)
