"""File links harvested from HTML listing pages."""

from __future__ import annotations

import functools
import html as html_references
import operator
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evallens.functions.text import last_segment
from evallens.schemas import HARVEST_SUFFIXES

# One token per comment, script or style element, or tag (attribute values may hold '>').
TOKEN_PATTERN = (r"""(?is)<!--.*?(?:-->|\z)|<(?:script|style)\b.*?</(?:script|style)\s*>"""
                 r"""|</?[a-z][^\s/>]*+(?:[^>"']++|"[^"]*+"|'[^']*+')*+>""")
# The name of a tag, with a slash before it for end tags.
NAME_PATTERN = r"^<(/?[A-Za-z][^\s/>]*)"
# One attribute of a tag after another: name and value (in double quotes, single quotes or none).
ATTRIBUTE_PATTERN = r"""[\s/]*+([^\s/>][^\s/=>]*+)(\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?"""
ORIGIN_PATTERN = r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)"
# Elements that never have content (no end tag to wait for).
VOID_TAGS = frozenset((
    "area", "base", "basefont", "bgsound", "br", "col", "command", "embed", "frame", "hr", "image", "img", "input", "isindex", "keygen",
    "link", "menuitem", "meta", "nextid", "param", "source", "spacer", "track", "wbr"))

_NAME, _ATTRIBUTE = re.compile(NAME_PATTERN), re.compile(ATTRIBUTE_PATTERN)


def href_of(tag: str) -> str | None:
    """The href of an `a` start tag, references decoded: the last one if there are
    several, '' if it has no value, None if there is none."""
    found, at = None, re.match(NAME_PATTERN, tag).end()
    while m := _ATTRIBUTE.match(tag, at):
        at = m.end()
        if m[1].lower() == "href":
            found = html_references.unescape(next((v for v in m.group(3, 4, 5) if v is not None), ""))
    return found


def item_links(tags: list[str]) -> list[dict]:
    """The first link of each <li> among a page's tags, as {i: number, href}, in one pass.

    `open` holds the names of the open elements and `starts` their places by name;
    `waiting` the items that are open and have no link yet, as (depth, number).  Each
    tag, element and item is put there once and taken away once.
    """
    out, opened, starts, waiting, items = [], [], {}, [], 0
    for tag in tags:
        m = _NAME.match(tag)
        if m is None:
            continue
        name = m[1].lower()
        if name[0] == "/":
            places = starts.get(name[1:])
            if places:  # closes the latest one of its name and all that was opened since
                depth = places[-1]
                while len(opened) > depth:
                    starts[opened.pop()].pop()
                while waiting and waiting[-1][0] >= depth:
                    waiting.pop()
            continue
        if name == "li":
            items += 1
        elif name == "a" and waiting:
            href = href_of(tag)
            if href is not None:
                out += [{"i": i, "href": href} for _, i in waiting]
                waiting.clear()
        if name not in VOID_TAGS and not tag.endswith("/>"):
            if name == "li":
                waiting.append((len(opened), items))
            starts.setdefault(name, []).append(len(opened))
            opened.append(name)
    return out


LINKS = T.ArrayType(T.StructType([T.StructField("i", T.IntegerType()), T.StructField("href", T.StringType())]))


@F.arrow_udf(LINKS)
def _item_links(tags: pa.Array) -> pa.Array:
    kind = pa.list_(pa.struct([("i", pa.int32()), ("href", pa.string())]))
    return pa.array([item_links(t or []) for t in tags.to_pylist()], kind)


def harvest_links(pages: DataFrame, html: str = "html", key: str = "page_id") -> DataFrame:
    """S10 + O4: for each <li>, the href of its first <a> that has one; an <li> without one is skipped.

    Returns (page_id, li_pos, href, page_url?) with li_pos counting all <li> from 1.
    Rules of a lenient parser: an end tag closes the latest open element of its name
    and everything opened inside it, stray end tags are ignored, unclosed elements
    stay open (so outer items see inner links), and comments, scripts and styles
    hold no tags.  Attributes are read one by one, so text that looks like one
    inside another's value is none; of two equal ones the last counts; character
    references are decoded; an empty href is the item's link, and the item is skipped.

    The JVM cuts pages into tags.  What is open takes a stack, which array functions
    copy at each step; a small Arrow function keeps it, in one pass over the tags
    of a page.  One page in, many rows out; nothing crosses a shuffle.
    """
    keep = [key] + (["url"] if "url" in pages.columns else [])
    tags = F.regexp_extract_all(F.col(html), F.lit(TOKEN_PATTERN), 0)
    tags = F.filter(tags, lambda t: ~t.rlike(r"(?i)^<(?:!--|script\b|style\b)"))
    listing = pages.where(F.col(html).rlike("(?i)<li"))
    rows = listing.select(*keep, F.explode(_item_links(tags)).alias("_l"))
    out = rows.select(*keep, F.col("_l.i").alias("li_pos"), F.col("_l.href").alias("href")).where(F.col("href") != "")
    return out.withColumnRenamed("url", "page_url") if "url" in keep else out


def suffix_filter(href: F.Column, suffixes=HARVEST_SUFFIXES) -> F.Column:
    """Non-empty href ending with one of the suffixes (case-sensitive)."""
    ends = functools.reduce(operator.or_, [href.endswith(s) for s in suffixes])
    return (href != "") & ends


def file_urls(links: DataFrame, suffixes=HARVEST_SUFFIXES, host: str | None = None, distinct: bool = False) -> DataFrame:
    """Keep file links, make absolute URLs, `/blob/` -> `/resolve/`, key = last segment.

    `distinct`: one row (url, key) per URL, however many items link to it.

    A root-relative href is prefixed with `host`, or with the page's own origin
    when no host is given; an absolute href is kept as it is.
    """
    href = F.col("href")
    prefix = F.lit(host) if host is not None else F.regexp_extract(F.col("page_url"), ORIGIN_PATTERN, 1)
    url = F.when(href.startswith("/"), F.concat(prefix, href)).otherwise(href)
    url = F.replace(url, F.lit("/blob/"), F.lit("/resolve/"))
    out = links.where(suffix_filter(href, suffixes)).withColumn("url", url).withColumn("key", last_segment(F.col("url")))
    return out.select("url", "key").distinct() if distinct else out
