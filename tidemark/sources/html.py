"""Posts from saved web pages.

Python only walks the tags of each page and returns texts and links; counters,
filters and joins of lists are column expressions.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import values
from tidemark.operators.clean import complete_records, external_urls

# Elements that never have content.
VOID_TAGS = frozenset((
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source",
    "track", "wbr",
))


@dataclass(frozen=True)
class Marked:
    """An element by tag and, where given, by the value of one attribute."""

    tag: str
    attribute: str | None = None
    value: str | None = None

    def fits(self, tag: str, attributes: dict) -> bool:
        return tag == self.tag and (
            self.attribute is None or attributes.get(self.attribute) == self.value
        )


@dataclass(frozen=True)
class Layout:
    """Where the parts of a post stand on a page. ``post=None`` makes the page one post."""

    # The default marks of a post.
    post: Marked | None = Marked("article", "data-testid", "tweet")
    content: Marked = Marked("div", "data-testid", "tweetText")
    time: Marked = Marked("time")
    time_attribute: str = "datetime"
    counters: dict = field(default_factory=lambda: {
        "replies": Marked("div", "data-testid", "reply"),
        "retweets": Marked("div", "data-testid", "retweet"),
        "likes": Marked("div", "data-testid", "like"),
    })
    user_link: str = r"^/[^/]+$"
    hashtag_link: str = r"/hashtag/"
    web_link: str = r"^https?://"
    excluded_host: str = "twitter.com"


class _Element:
    __slots__ = ("tag", "attributes", "texts", "text_end", "end")

    def __init__(self, tag: str, attributes: dict, texts: int):
        self.tag, self.attributes, self.texts = tag, attributes, texts


class _Outline(HTMLParser):
    """Elements in page order, each with the range of texts and elements inside it."""

    def __init__(self):
        super().__init__()
        self.elements, self.texts, self._open, self._pending = [], [], [], []

    def _flush(self):
        # Texts between two tags are one text; scripts and styles are not shown.
        text = "".join(self._pending).strip()
        self._pending = []
        if text and not (self._open and self._open[-1].tag in ("script", "style")):
            self.texts.append(text)

    def handle_starttag(self, tag, attrs):
        if self._pending:
            self._flush()
        element = _Element(tag, {name: value or "" for name, value in attrs}, len(self.texts))
        self.elements.append(element)
        if tag in VOID_TAGS:
            self._finish(element)
        else:
            self._open.append(element)

    def handle_endtag(self, tag):
        if self._pending:
            self._flush()
        for depth in range(len(self._open) - 1, -1, -1):
            if self._open[depth].tag == tag:
                for element in self._open[depth:]:
                    self._finish(element)
                del self._open[depth:]
                break

    def handle_data(self, data):
        self._pending.append(data)

    def handle_comment(self, data):
        self._flush()

    def _finish(self, element):
        element.text_end, element.end = len(self.texts), len(self.elements)

    def read(self, page: str):
        self.feed(page)
        self.close()
        self._flush()
        for element in self._open:
            self._finish(element)
        return self

    def text(self, element: _Element) -> str:
        return "".join(self.texts[element.texts:element.text_end])


def _parts(page: str | None, layout: Layout) -> Iterator[dict]:
    """The raw parts of every post of a page."""
    outline = _Outline().read(page or "")
    everything = outline.elements
    user_link, hashtag_link, web_link = map(
        re.compile, (layout.user_link, layout.hashtag_link, layout.web_link)
    )
    if layout.post is None:
        ranges = [everything]
    else:
        ranges = [
            everything[i + 1:e.end] for i, e in enumerate(everything)
            if layout.post.fits(e.tag, e.attributes)
        ]
    for inside in ranges:
        def first(mark):
            return next((e for e in inside if mark.fits(e.tag, e.attributes)), None)

        links = [(e.attributes["href"], e) for e in inside if e.tag == "a" and "href" in e.attributes]
        user_links = [(h, e) for h, e in links if user_link.search(h)]
        time, content = first(layout.time), first(layout.content)
        counters = {name: first(mark) for name, mark in layout.counters.items()}
        yield {
            "username": user_links[0][0].strip("/") if user_links else None,
            "timestamp": time.attributes.get(layout.time_attribute, "") if time else None,
            "content": outline.text(content) if content else None,
            **{name: outline.text(e) if e else None for name, e in counters.items()},
            "user_texts": [outline.text(e) for _, e in user_links],
            "tag_texts": [outline.text(e) for h, e in links if hashtag_link.search(h)],
            "links": [h for h, _ in links if web_link.search(h)],
        }


def page_parts(
    pages: DataFrame, keep: Sequence[str] = ("page_id",), html: str = "html", layout: Layout = Layout()
) -> DataFrame:
    """One row per post with its raw texts and links; the ``keep`` columns are repeated."""
    keep = list(keep)
    schema = ", ".join([
        *[f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in keep],
        "page_post int, username string, timestamp string, content string",
        *[f"{name} string" for name in layout.counters],
        "user_texts array<string>, tag_texts array<string>, links array<string>",
    ])
    names = [c.strip().split()[0].strip("`") for c in schema.split(",")]

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [
                {**{c: row[c] for c in keep}, "page_post": i, **parts}
                for row in batch.to_dict("records")
                for i, parts in enumerate(_parts(row[html], layout))
            ]
            yield pd.DataFrame(found, columns=names)

    return pages.select(*keep, html).mapInPandas(walk, schema)


def extract_posts(
    pages: DataFrame,
    keep: Sequence[str] = ("page_id",),
    html: str = "html",
    layout: Layout = Layout(),
    scraped_at: Column | None = None,
) -> DataFrame:
    """Raw posts; those without author or text are left out."""
    parts = page_parts(pages, keep, html, layout)
    seen = F.current_timestamp() if scraped_at is None else scraped_at
    posts = parts.select(
        *keep, "page_post", "username", "timestamp", "content",
        *[values.parse_metric(F.coalesce(c, F.lit(""))).alias(c) for c in layout.counters],
        F.array_join(F.filter("user_texts", lambda t: t.startswith("@")), ", ").alias("mentions"),
        F.array_join("tag_texts", ", ").alias("hashtags"),
        F.array_join(external_urls(F.col("links"), layout.excluded_host), ", ").alias("urls"),
        F.date_format(seen, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("scraped_at"),
    )
    return complete_records(posts)
