"""Web pages to columns: a small standard-library parse per page, vectorised over Arrow batches.

The parse gives a page's parts (metas, links, headings, JSON-LD objects) as one struct; which part wins is decided
by column expressions, where the optimiser sees it.
"""

from __future__ import annotations

import html
import json
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

PARTS = (
    "title string, h1 string, og_title string, twitter_title string, og_description string, twitter_description string, meta_description string, "
    "website string, links array<string>, ld array<struct<types:array<string>,url:string,name:string,slogan:string,description:string,categories:array<string>>>, "
    "embedded struct<slug:string,name:string,tagline:string,description:string,website_url:string,categories:array<string>>"
)
_EMPTY = {"title": None, "h1": None, "og_title": None, "twitter_title": None, "og_description": None, "twitter_description": None, "meta_description": None, "website": None}
_METAS = {
    ("property", "og:title"): "og_title", ("name", "twitter:title"): "twitter_title", ("property", "og:description"): "og_description",
    ("name", "twitter:description"): "twitter_description", ("property", "twitter:description"): "twitter_description", ("name", "description"): "meta_description",
}


def cleaned(value: object) -> str | None:
    """Unescaped, white space collapsed; null for blanks and what is no string."""
    return (re.sub(r"\s+", " ", html.unescape(value)).strip() or None) if isinstance(value, str) else None


def _names(value: object) -> list[str]:
    some = value if isinstance(value, list) else [value]
    return list(dict.fromkeys(n for x in some if (n := cleaned(x.get("name") if isinstance(x, dict) else x))))


def _objects(value: object) -> Iterator[dict]:
    """Every object in a JSON value, outer ones first."""
    waiting = [value]
    while waiting:
        x = waiting.pop(0)
        if isinstance(x, dict):
            yield x
            waiting[:0] = list(x.values())
        elif isinstance(x, list):
            waiting[:0] = x


class _Page(HTMLParser):
    def __init__(self) -> None:
        super().__init__()
        self.found: dict = dict(_EMPTY)
        self.links: list[str] = []
        self.scripts: list[tuple[bool, str]] = []
        self._open: str | None = None
        self._text: list[str] = []

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        a = {k: v or "" for k, v in attrs}
        if tag == "meta":
            for (key, name), to in _METAS.items():
                if a.get(key, "").lower() == name and not self.found[to]:
                    self.found[to] = cleaned(a.get("content"))
        elif tag == "a" and (href := cleaned(a.get("href"))):
            self.links.append(href)
            visit = "visit" in a.get("data-test", "") or "website" in a.get("data-testid", "") or "website" in a.get("aria-label", "").lower()
            if visit and not self.found["website"] and re.match(r"https?://", href):
                self.found["website"] = href
        elif tag in ("title", "h1") and not self.found[tag] or tag == "script" and "src" not in a:
            self._open, self._text = ("ld" if a.get("type", "").lower() == "application/ld+json" else tag), []

    def handle_data(self, data: str) -> None:
        if self._open:
            self._text.append(data)

    def handle_endtag(self, tag: str) -> None:
        if self._open in ("ld", "script") and tag == "script":
            self.scripts.append((self._open == "ld", "".join(self._text)))
            self._open = None
        elif self._open == tag:
            self.found[tag] = cleaned("".join(self._text))
            self._open = None


def _loaded(text: str) -> object:
    try:
        return json.loads(text)
    except ValueError:
        return None


def _embedded(scripts: list[tuple[bool, str]], slug: str | None) -> dict | None:
    """The object in the page's scripts with the product's slug and the most of its fields; the first of equals."""
    best, most = None, -1
    decoder = json.JSONDecoder()
    for is_ld, text in scripts:
        if is_ld or not slug or f'"{slug}"' not in text:
            continue
        at = 0
        while (start := text.find("{", at)) >= 0:
            try:
                value, at = decoder.raw_decode(text, start)
            except ValueError:
                at = start + 1
                continue
            for x in _objects(value):
                if x.get("slug") == slug:
                    points = 5 * (x.get("__typename") == "Product") + 2 * sum(bool(x.get(k)) for k in ("name", "tagline", "description", "websiteUrl", "categories"))
                    if points > most:
                        best, most = x, points
    return best


def parse_parts(page: str | None, slug: str | None = None) -> dict:
    p = _Page()
    p.feed(page or "")
    p.close()
    ld = []
    for _, text in (s for s in p.scripts if s[0]):
        for x in _objects(_loaded(text)):
            kinds = x.get("@type")
            types = [str(t).lower() for t in (kinds if isinstance(kinds, list) else [kinds]) if t]
            ld.append({"types": types, "url": cleaned(x.get("url") or x.get("@id")), "name": cleaned(x.get("name")), "slogan": cleaned(x.get("slogan")), "description": cleaned(x.get("description")), "categories": _names(x.get("applicationCategory"))})
    e = _embedded(p.scripts, slug)
    embedded = e and {"slug": slug, **{k: cleaned(e.get(k)) for k in ("name", "tagline", "description")}, "website_url": cleaned(e.get("websiteUrl")) or cleaned(e.get("website_url")), "categories": _names(e.get("categories"))}
    return p.found | {"links": list(dict.fromkeys(p.links)), "ld": ld, "embedded": embedded}


def page_parts(page: Column, slug: Column) -> Column:
    """The parts of every page as a struct."""

    @F.pandas_udf(PARTS)
    def run(pages: pd.Series, slugs: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([parse_parts(a, b) for a, b in zip(pages, slugs, strict=True)], columns=[x.split()[0] for x in PARTS.split(", ")])

    return run(page, slug)


def product_fields(parts: Column, slug: Column, url: Column, own_title: str = "Catalogue") -> dict[str, Column]:
    """Name, tagline, description, web site and categories: embedded state first, then JSON-LD, metas and headings."""
    typed = F.filter(parts["ld"], lambda x: F.arrays_overlap(x["types"], F.array(F.lit("product"), F.lit("softwareapplication"), F.lit("webapplication"))))
    ranked = F.array_sort(F.transform(typed, lambda x, i: F.struct((-(F.coalesce((x["url"] == url).cast("int"), F.lit(0)) * 10 + x["name"].isNotNull().cast("int") + x["description"].isNotNull().cast("int") + (F.size(x["categories"]) > 0).cast("int"))).alias("s"), i.alias("i"), x.alias("x"))))
    ld, e = F.get(ranked, F.lit(0))["x"], parts["embedded"]
    name = F.coalesce(e["name"], ld["name"], parts["h1"])
    title = F.regexp_replace(F.coalesce(parts["og_title"], parts["twitter_title"]), rf"\s*\|\s*{own_title}\s*$", "")
    from_title = F.nullif(F.trim(F.when(F.startswith(title, F.concat(name, F.lit(":"))), F.substr(title, F.length(name) + 2))), F.lit(""))
    filled = lambda c: F.when(F.size(c) > 0, c)
    return {
        "name": name,
        "tagline": F.coalesce(e["tagline"], from_title),
        "description": F.coalesce(e["description"], ld["description"], parts["og_description"], parts["meta_description"]),
        "website_url": F.coalesce(e["website_url"], parts["website"]),
        "categories": F.coalesce(filled(e["categories"]), filled(ld["categories"]), F.array().cast("array<string>")),
    }


# Texts that are no copy.
_REJECTED = ("404", "404 not found", "access denied", "coming soon", "forbidden", "home", "homepage", "loading", "not found", "official website", "page not found", "untitled", "welcome")
_REJECTED_PREFIXES = ("cookie ", "privacy ", "terms of ", "welcome to ")
#: kind -> fewest and most characters, fewest words
_BOUNDS = {"tagline": (12, 160, 2), "description": (24, 2000, 4)}


def usable(text: Column, kind: str, product: Column) -> Column:
    """Whether a text can be a product's tagline or description."""
    low, high, words = _BOUNDS[kind]
    lower, letters = F.lower(text), F.regexp_count(text, F.lit(r"\p{L}"))
    rejected = lower.isin(*_REJECTED) | F.coalesce(lower == F.lower(product), F.lit(False))
    for prefix in _REJECTED_PREFIXES:
        rejected = rejected | F.startswith(lower, F.lit(prefix))
    return F.coalesce(F.length(text).between(low, high) & (F.regexp_count(text, F.lit(r"\w[\w'’.-]*")) >= words) & ~rejected & (letters >= 3) & (letters / F.length(text) >= 0.2), F.lit(False))


def _title_rest(title: Column, product: Column) -> Column:
    """A title without the product's name at its start or end."""
    out = title
    for mark in (": ", " - ", " — ", " | "):
        p = F.concat(product, F.lit(mark))
        s = F.concat(F.lit(mark), product)
        out = F.when(F.startswith(F.lower(title), F.lower(p)), F.trim(F.substr(title, F.length(p) + 1))).when(F.endswith(F.lower(title), F.lower(s)), F.trim(F.substr(title, F.lit(1), F.length(title) - F.length(s)))).otherwise(out)
    return F.coalesce(out, title)


def website_candidates(parts: Column, product: Column, kind: str) -> Column:
    """Usable (value, source) candidates in order of trust, the same text once."""
    one = lambda value, source: F.struct(value.alias("value"), F.lit(source).alias("source"))
    typed = F.filter(parts["ld"], lambda x: F.arrays_overlap(x["types"], F.array(F.lit("product"), F.lit("softwareapplication"), F.lit("webapplication"))))
    both = (lambda x: F.array(one(x["slogan"], "json_ld_slogan"), one(x["description"], "json_ld_description"))) if kind == "tagline" else (lambda x: F.array(one(x["description"], "json_ld_description")))
    rest = [one(parts[c], c) for c in ("og_description", "twitter_description", "meta_description")]
    if kind == "tagline":
        rest += [one(_title_rest(parts["title"], product), "title"), one(parts["h1"], "h1")]
    every = F.filter(F.concat(F.flatten(F.transform(typed, both)), F.array(*rest)), lambda x: usable(x["value"], kind, product))
    return F.filter(every, lambda x, i: F.array_position(F.transform(every, lambda y: F.lower(y["value"])), F.lower(x["value"])) == i + 1)
