"""Table functions over landed pages: the review cards of a page, and the links of a search page by kind, each with its place.

Both are Python table functions, since elements and their ancestors aren't within reach of regular expressions. They give rows for SQL
(``FROM pages, LATERAL review_cards(html, 'site')``) and for DataFrames (``lateralJoin``); a page is read once, in one task.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarnspark.functions.urls import clean_url, result_link

_VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr")


class Element:
    """An element with its attributes, its parent, the places of its text, and the number of the last element inside it."""

    __slots__ = ("tag", "attributes", "parent", "begin", "end", "last")

    def __init__(self, tag: str, attributes: dict[str, str], parent: int, begin: int) -> None:
        self.tag, self.attributes, self.parent, self.begin, self.end, self.last = tag, attributes, parent, begin, begin, 0

    def classes(self) -> list[str]:
        return self.attributes.get("class", "").split()


class Page(HTMLParser):
    """The elements of a page in document order. Unclosed elements end where one around them ends."""

    def __init__(self, html: str | None) -> None:
        super().__init__(convert_charrefs=True)
        self.elements: list[Element] = []
        self._open: list[int] = []
        self._text: list[str] = []
        self._size = 0
        self.feed(html or "")
        self.close()
        while self._open:
            self._end()
        self._whole = "".join(self._text)

    def handle_starttag(self, tag, attrs):
        names: dict[str, str] = {}
        for k, v in attrs:
            names.setdefault(k, v or "")
        self.elements.append(Element(tag, names, self._open[-1] if self._open else -1, self._size))
        self.elements[-1].last = len(self.elements) - 1
        if tag not in _VOID:
            self._open.append(len(self.elements) - 1)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self._end()

    def _end(self) -> None:
        e = self.elements[self._open.pop()]
        e.end, e.last = self._size, len(self.elements) - 1

    def handle_endtag(self, tag):
        if any(self.elements[i].tag == tag for i in self._open):
            while self.elements[self._open[-1]].tag != tag:
                self._end()
            self._end()

    def handle_data(self, data):
        if not (self._open and self.elements[self._open[-1]].tag in ("script", "style")):
            self._text.append(data)
            self._size += len(data)

    def text(self, e: Element) -> str:
        return self._whole[e.begin : e.end].strip()

    def inside(self, at: int) -> range:
        return range(at + 1, self.elements[at].last + 1)

    def ancestors(self, at: int) -> Iterator[int]:
        at = self.elements[at].parent
        while at >= 0:
            yield at
            at = self.elements[at].parent


Test = Callable[[Element], bool]


def has(name: str, value: str | None = None, tag: str | None = None) -> Test:
    """An attribute, of a value if one is given."""
    return lambda e: name in e.attributes and (value is None or e.attributes[name] == value) and (tag is None or e.tag == tag)


def holds(name: str, part: str, tag: str | None = None) -> Test:
    """An attribute whose value holds a part."""
    return lambda e: part in e.attributes.get(name, "") and (tag is None or e.tag == tag)


def of_class(name: str, tag: str | None = None) -> Test:
    return lambda e: name in e.classes() and (tag is None or e.tag == tag)


def named(tag: str) -> Test:
    return lambda e: e.tag == tag


#: What cards and their fields are marked with on each site. ``rating``: (element, attribute or text, pattern), the first that gives a number.
CARDS: dict[str, dict] = {
    "trustpilot": {
        "card": (has("data-testid", "service-review-card-v2"),),
        "author": (has("data-consumer-name-typography"),),
        "date": (named("time"),),
        "date_attribute_first": True,
        "text": (has("data-service-review-text-typography"),),
        "rating": ((holds("alt", "Rated", "img"), "alt", r"(?i)Rated\s+(\d(?:\.\d)?)\s+out of 5"), (has("data-service-review-rating"), "data-service-review-rating", r"^\s*(\d+(?:\.\d+)?)\s*$")),
    },
    "houzz": {
        "card": (of_class("pro-review", "div"), has("itemprop", "review", "div"), of_class("review", "article"), holds("class", "ReviewItem", "div")),
        "author": (of_class("author"), has("itemprop", "author"), of_class("reviewer-name")),
        "date": (of_class("date"), named("time"), has("itemprop", "datePublished")),
        "date_attribute_first": False,
        "text": (of_class("description"), has("itemprop", "reviewBody"), named("p")),
        "rating": ((lambda e: "star" in e.attributes.get("aria-label", "") or "rating" in e.classes(), "aria-label", r"(\d(?:\.\d)?)"),),
    },
}
CARD = "place int, author string, rating double, date string, text string"


def cards_of(html: str | None, site: str | None) -> Iterator[tuple[int, str, float | None, str, str]]:
    """(place among the page's cards, author, rating, date, text) of each card with an author or a text; none for a site without rules."""
    rules = CARDS.get(site or "")
    if not rules:
        return
    page = Page(html)

    def first(at: int, tests: tuple[Test, ...]) -> Element | None:
        return next((page.elements[i] for i in page.inside(at) if any(t(page.elements[i]) for t in tests)), None)

    cards = [i for i, e in enumerate(page.elements) if any(t(e) for t in rules["card"])]
    for place, at in enumerate(cards):
        author, text, when = (first(at, rules[k]) for k in ("author", "text", "date"))
        date = [page.text(when), when.attributes.get("datetime", "").strip()] if when else [""]
        if rules["date_attribute_first"]:
            date.reverse()
        rating = None
        for test, attribute, pattern in rules["rating"]:
            e = first(at, (test,))
            m = re.search(pattern, e.attributes.get(attribute) or page.text(e)) if e else None
            if m:
                rating = float(m[1])
                break
        row = (page.text(author) if author else "", page.text(text) if text else "")
        if any(row):
            yield place, row[0], rating, next((d for d in date if d), ""), row[1]


LINK = "kind int, place int, href string"


def links_of(html: str | None) -> Iterator[tuple[int, int, str]]:
    """(kind, place, href) of a search page's links by the seven ways in which results are marked, the surest first: headings in the result list, headings in the search
    part, older result boxes, cited sites, marked anchors, then all web links of the list and of the search part. A link can be of several kinds."""
    page = Page(html)
    elements = page.elements
    for at, e in enumerate(elements):
        if e.tag not in ("a", "h3", "cite"):
            continue
        above = list(page.ancestors(at))
        in_list = any(elements[i].attributes.get("id") == "rso" for i in above)
        in_search = any(elements[i].tag == "div" and elements[i].attributes.get("id") == "search" for i in above)
        if e.tag == "a":
            href = e.attributes.get("href", "")
            web = href.startswith("http") and "google.com" not in href
            boxed = any(elements[i].tag == "div" and "g" in elements[i].classes() and any(elements[j].tag == "div" and elements[j].attributes.get("id") == "search" for j in page.ancestors(i)) for i in above)
            if boxed and href and any(elements[i].tag == "h3" for i in page.inside(at)):
                yield 3, at, href
            if in_list and href and ("jsname" in e.attributes or "data-ved" in e.attributes):
                yield 5, at, href
            if in_list and web:
                yield 6, at, href
            if in_search and web:
                yield 7, at, href
            continue
        anchor = next((i for i in above if elements[i].tag == "a"), None)
        href = elements[anchor].attributes.get("href", "") if anchor is not None else ""
        if not href:
            continue
        if e.tag == "cite":
            if in_search and "." in page.text(e):
                yield 4, at, href
            continue
        listed = any(elements[i].tag == "div" and elements[i].parent >= 0 and elements[elements[i].parent].attributes.get("id") == "rso" for i in page.ancestors(anchor))
        if listed:
            yield 1, at, href
        if in_search:
            yield 2, at, href


class ReviewCards:
    def eval(self, html: str, site: str):
        yield from cards_of(html, site)


class SearchLinks:
    def eval(self, html: str):
        yield from links_of(html)


def table_functions() -> dict:
    """The table functions by their names in SQL."""
    return {"review_cards": F.udtf(ReviewCards, returnType=CARD), "search_links": F.udtf(SearchLinks, returnType=LINK)}


def register(spark: SparkSession) -> None:
    for name, f in table_functions().items():
        spark.udtf.register(name, f)


def review_cards(pages: DataFrame, html: str, site: Column) -> DataFrame:
    """pages with the columns of CARD, a row for each card."""
    return pages.lateralJoin(table_functions()["review_cards"](F.col(html).outer(), site))


def search_results(pages: DataFrame, key: str, html: str) -> DataFrame:
    """key, url, rank: the results of each search page in order of kind and place, each url once without its query, those that aren't results left out."""
    found = pages.select(key, html).lateralJoin(table_functions()["search_links"](F.col(html).outer())).select(key, F.struct("kind", "place").alias("at"), "href")
    kept = found.where(result_link(F.col("href"))).select(key, clean_url(F.col("href")).alias("url"), "at")
    first = kept.groupBy(key, "url").agg(F.min("at").alias("at"))
    return first.select(key, "url", F.row_number().over(Window.partitionBy(key).orderBy("at")).alias("rank"))
