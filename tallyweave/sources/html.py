"""Web pages to text lines, links and embedded URLs."""

from __future__ import annotations

import html as html_entities
import json
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tallyweave import constants as K
from tallyweave.functions.numbers import as_col

_LINE_ENDS = r"\r\n|[\n\r\u000B\f\u001C-\u001E\u0085\u2028\u2029]"
_SPACE_RUNS = r"(?U)\s+"
_LINK = r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)"""
_COMMENTS = r"(?s)<!--.*?-->"


@F.pandas_udf(T.StringType())
def _unescape(s: pd.Series) -> pd.Series:
    return s.map(html_entities.unescape, na_action="ignore")


# Entities that published tables and prose commonly carry.
COMMON_ENTITIES = ["amp", "lt", "gt", "quot", "apos", "nbsp", "ndash", "mdash", "copy", "middot", "hellip"]


def unescape(c: Column | str, exact: bool = False) -> Column:
    """Entities to characters.

    The default stays in the JVM: named entities from ``COMMON_ENTITIES`` and every
    Latin letter entity, and numeric ones. ``exact`` covers all names and the legacy
    forms without a semicolon in Arrow batches.
    """
    text = as_col(c)
    if exact:
        return _unescape(text)
    names = COMMON_ENTITIES + [
        n[:-1]
        for n, v in html_entities.entities.html5.items()
        if n.endswith(";") and len(v) == 1 and 0xC0 <= ord(v) < 0x180
    ]
    named = {n: html_entities.entities.html5[n + ";"] for n in names}
    table = F.create_map(*[F.lit(x) for pair in named.items() for x in pair])

    def decode(piece: Column) -> Column:
        body = F.regexp_extract(piece, "^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);", 1)
        rest = F.substring(piece, F.length(body) + 2, F.length(piece))
        code = (
            F.when(body.rlike("^#[0-9]"), F.substring(body, F.lit(2), F.length(body)).try_cast("bigint"))
            .when(
                body.rlike("^#[xX]"),
                F.conv(F.substring(body, F.lit(3), F.length(body)), 16, 10).try_cast("bigint"),
            )
        )
        usable = code.between(0xA0, 0xD7FF) | code.between(0xE000, 0x10FFFF) | code.between(0x20, 0x7E) | code.isin(9, 10)
        letter = F.when(usable, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
        found = F.coalesce(letter, F.try_element_at(table, body))
        return F.when((body != "") & found.isNotNull(), F.concat(found, rest)).otherwise(F.concat(F.lit("&"), piece))

    pieces = F.split(text, "&")
    first = F.get(pieces, 0)
    later = F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0)))
    decoded = F.concat(first, F.array_join(F.transform(later, decode), ""))
    return F.when(F.contains(text, F.lit("&")), decoded).otherwise(text)


def page_lines(c: Column | str, exact: bool = False) -> Column:
    """Clean non-blank text lines of a page, in order, as an array."""
    text = F.regexp_replace(as_col(c), K.SCRIPTS, "\n")
    text = F.regexp_replace(text, K.BREAKS, "\n")
    text = F.regexp_replace(text, K.BLOCK_ENDS, "\n")
    text = F.regexp_replace(text, K.TAGS, " ")
    text = unescape(text, exact)
    lines = F.transform(
        F.split(text, _LINE_ENDS), lambda line: F.btrim(F.regexp_replace(line, _SPACE_RUNS, " "))
    )
    return F.filter(lines, lambda line: line != "")


def html_to_lines(pages: DataFrame, key: str, html: str, exact: bool = False) -> DataFrame:
    """Rows ``(key, line_no, text)``."""
    return pages.select(key, F.posexplode(page_lines(html, exact)).alias("line_no", "text"))


def resolve_url(base: Column | str, href: Column | str) -> Column:
    """Absolute URL of ``href`` seen from ``base``, dot segments removed."""
    base, href = as_col(base), as_col(href)
    scheme = F.regexp_extract(base, "^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    site = F.regexp_extract(base, "^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    path = F.regexp_extract(base, "^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    query = F.regexp_extract(base, r"^[^?#]*(\?[^#]*)", 1)
    folder = F.when(path == "", F.lit("/")).otherwise(F.regexp_replace(path, "[^/]*$", ""))
    href_path = F.regexp_extract(href, "^([^?#]*)", 1)
    href_tail = F.regexp_extract(href, r"^[^?#]*([?#].*)$", 1)
    joined = F.when(F.startswith(href_path, F.lit("/")), href_path).otherwise(F.concat(folder, href_path))

    def step(done: Column, part: Column) -> Column:
        shorter = F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))
        return F.when(part == "..", shorter).when(part == ".", done).otherwise(F.array_append(done, part))

    parts = F.split(F.substring(joined, F.lit(2), F.length(joined)), "/")
    walked = F.aggregate(parts, F.array().cast("array<string>"), step)
    ends_in_dots = joined.rlike(r"/\.\.?$")
    clean = F.concat(
        F.lit("/"), F.array_join(walked, "/"), F.when(ends_in_dots & (F.size(walked) > 0), F.lit("/")).otherwise(F.lit(""))
    )
    return (
        F.when(href == "", base)
        .when(href.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(F.startswith(href, F.lit("//")), F.concat(scheme, F.lit(":"), href))
        .when(F.startswith(href, F.lit("#")), F.concat(site, path, query, href))
        .when(F.startswith(href, F.lit("?")), F.concat(site, path, href))
        .otherwise(F.concat(site, clean, href_tail))
    )


def _links(html: Column, base: Column, suffix: str | None, contains: Sequence[str]) -> Column:
    visible = F.regexp_replace(F.regexp_replace(html, _COMMENTS, " "), K.SCRIPTS, " ")
    raw = F.regexp_extract_all(visible, F.lit(_LINK), F.lit(1))
    hrefs = F.transform(raw, lambda h: unescape(F.regexp_replace(h, "^[\"']|[\"']$", "")))
    urls = F.transform(F.filter(hrefs, lambda h: h != ""), lambda h: resolve_url(base, h))

    def wanted(url: Column) -> Column:
        low = F.lower(url)
        keep = F.endswith(low, F.lit(suffix)) if suffix else F.lit(True)
        for text in contains:
            keep = keep & F.contains(low, F.lit(text))
        return keep

    return F.filter(urls, wanted)


def extract_links(
    pages: DataFrame, key: str, html: str, base: str, suffix: str | None = None, contains: Sequence[str] = ()
) -> DataFrame:
    """Rows ``(key, link_no, url)``: links of anchors, made absolute and filtered."""
    links = _links(F.col(html), F.col(base), suffix, contains)
    return pages.select(key, F.posexplode(links).alias("link_no", "url"))


def first_link(
    pages: DataFrame, key: str, html: str, base: str, suffix: str | None = None, contains: Sequence[str] = ()
) -> DataFrame:
    """First wanted link per page, NULL where there is none; no shuffle."""
    return pages.select(key, F.get(_links(F.col(html), F.col(base), suffix, contains), 0).alias("url"))


def harvest_embedded_urls(
    pages: DataFrame,
    key: str,
    html: str,
    script_id: str = "__NEXT_DATA__",
    path: Sequence[str] = ("props", "pageProps", "page"),
    hosts: Sequence[str] = ("powerbi.com", "dwcdn.net"),
    suffixes: Sequence[str] = (".xlsx", ".xls"),
) -> DataFrame:
    """Rows ``(key, url_no, title, url)`` from the JSON inside a script tag.

    Every ``url`` field that names a wanted host or ends in a wanted suffix counts;
    ``title`` comes from the nearest enclosing object that has one. The tree is of
    any depth, so the walk runs per page in Arrow batches.
    """
    pattern = f'(?s)<script id="{script_id}" type="application/json">(.*?)</script>'
    hosts, suffixes, path = tuple(hosts), tuple(suffixes), tuple(path)

    def walk(text: str | None) -> list[dict[str, str]]:
        found: list[dict[str, str]] = []
        try:
            node = json.loads(html_entities.unescape(text)) if text else {}
        except ValueError:
            node = {}
        for step in path:
            node = node.get(step, {}) if isinstance(node, dict) else {}
        todo = [(node, "")]
        while todo:
            value, title = todo.pop()
            if isinstance(value, dict):
                title = str(value.get("title") or title)
                url = value.get("url")
                if isinstance(url, str) and (any(h in url for h in hosts) or url.endswith(suffixes)):
                    found.append({"title": title, "url": url})
                children = list(value.values())
            else:
                children = value if isinstance(value, list) else []
            todo.extend((child, title) for child in reversed(children))
        return found

    @F.pandas_udf("array<struct<title: string, url: string>>")
    def urls(s: pd.Series) -> pd.Series:
        return s.map(walk)

    script = F.regexp_extract(F.col(html), pattern, 1)
    found = pages.select(key, script.alias("_s")).filter("_s <> ''").select(key, urls("_s").alias("_u"))
    return found.select(key, F.posexplode("_u").alias("url_no", "_e")).select(key, "url_no", "_e.title", "_e.url")
