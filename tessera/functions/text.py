"""Column expressions over URLs, texts, slugs and JSON; all run inside the engine."""

from __future__ import annotations

import functools

from pyspark.sql import Column
from pyspark.sql import functions as F

_HOST = r"^(?:[A-Za-z][A-Za-z0-9+.-]*://)?(?:www\.)?([^/:?#]+)"
PRODUCT_SLUG = r"^[a-z0-9]([a-z0-9._-]*[a-z0-9])?$"
LAUNCH_SLUG = r"^[a-z0-9][a-z0-9_-]*$"


def website_host(url: Column) -> Column:
    """Lower-case host without scheme and www; null if there is none."""
    return F.lower(F.nullif(F.regexp_extract(url, _HOST, 1), F.lit("")))


def trimmed_length(text: Column) -> Column:
    return F.length(F.trim(F.coalesce(text, F.lit(""))))


def present(text: Column) -> Column:
    return text.isNotNull() & (F.trim(text) != "")


def blank(text: Column) -> Column:
    return F.coalesce(F.trim(text), F.lit("")) == ""


def stripped(text: Column) -> Column:
    """Without white space of any kind at both ends; empty becomes null."""
    return F.nullif(F.regexp_replace(text, r"^\s+|\s+$", ""), F.lit(""))


def sql_content_hash(columns: list[Column], categories: Column) -> Column:
    """SHA-256 over the fields between unit separators, categories between record separators; nulls are skipped."""
    return F.sha2(F.concat_ws("\x1f", *columns, F.array_join(categories, "\x1e")), 256)


def json_content_hash(fields: dict[str, Column]) -> Column:
    """SHA-256 of the compact JSON object with sorted keys, nulls kept."""
    record = F.struct(*(fields[k].alias(k) for k in sorted(fields)))
    return F.sha2(F.to_json(record, {"ignoreNullFields": "false"}), 256)


def split_nonblank(text: Column, separator: str) -> Column:
    """Parts between separators, trimmed, blank ones left out; an empty array for null."""
    parts = F.transform(F.split(text, separator), lambda x: F.trim(x))
    return F.coalesce(F.filter(parts, lambda x: x != ""), F.array().cast("array<string>"))


def retry_delay(attempt: Column) -> Column:
    """Seconds until the next try: 15 doubled per attempt, an hour at most."""
    return F.least(F.lit(3600), 15 * F.pow(F.lit(2), F.greatest(F.lit(0), attempt - 1))).cast("long")


def http_outcome(status: Column, complete: Column) -> Column:
    """What a fetched product page means for its product."""
    return (
        F.when(status.isin(403, 429) | (status >= 500), "retry")
        .when(status >= 400, "unavailable")
        .when(~complete, "parse_failed")
        .otherwise("fetched")
    )


def website_outcome(status: Column, is_html: Column, has_metadata: Column) -> Column:
    """What a fetched web site means for its enrichment."""
    return (
        F.when(status.isin(401, 403, 429), "blocked")
        .when(status >= 500, "retry")
        .when(status >= 400, "unavailable")
        .when(~is_html, "non_html")
        .when(has_metadata, "enriched")
        .otherwise("no_metadata")
    )


def product_slug(url: Column, host: str, kind: str = "products", most: int = 300) -> Column:
    """The slug behind /kind/ in a URL of the host, decoded and lower-case; null for other hosts, assets and blanks."""
    found = F.regexp_extract(url, rf"(?i)^https?://(?:www\.)?{host.replace('.', chr(92) + '.')}(?::\d+)?/{kind}/([^/?#]+)", 1)
    decoded = F.lower(F.try_url_decode(F.nullif(found, F.lit(""))))
    asset = decoded.rlike(r"\.(js|css|png|jpe?g|gif|svg|ico|webp|json|xml|txt|map|tsx?|woff2?)$")
    return F.when(~asset & ~decoded.rlike(r"\s") & (decoded != "...") & (F.length(decoded) <= most), decoded)


def final_slug(url: Column, fallback: Column, kind: str = "products") -> Column:
    """The slug that a page's last address names: its path is /kind/slug and nothing more, else the fallback."""
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    parts = F.filter(F.split(path, "/"), lambda p: p != "")
    return F.when((F.size(parts) == 2) & (F.get(parts, F.lit(0)) == kind), F.lower(F.get(parts, F.lit(1)))).otherwise(fallback)


def safe_json_int(text: Column, path: str) -> Column:
    """A number in a JSON text; null if the text is no JSON or holds none there."""
    return F.get_json_object(text, path).try_cast("long")


def offset_cursor(offset: Column) -> Column:
    return F.base64(offset.cast("string").cast("binary"))


def without_prefix(text: Column, name: Column) -> Column:
    """A tagline without a leading 'name - ' or 'name: '."""
    for mark in (" - ", ": "):
        prefix = F.concat(name, F.lit(mark))
        text = F.when(F.startswith(text, prefix), F.substr(text, F.length(prefix) + 1)).otherwise(text)
    return text


def clean_entity(text: Column) -> Column:
    """Case folded, with runs of white space, _, /, . and - made one blank."""
    return F.trim(F.regexp_replace(folded(F.trim(text)), r"[\s_/.-]+", " "))


@functools.cache
def _folds() -> tuple[dict[str, str], str]:
    """What full case folding changes beyond lower case, by Unicode's own rule, and a pattern of such characters and of the runs between them."""
    every = {c: c.casefold() for c in map(chr, (*range(0xD800), *range(0xE000, 0x110000))) if c.lower() != c.casefold()}
    spans: list[list[int]] = []
    for c in map(ord, every):
        if spans and spans[-1][1] == c - 1:
            spans[-1][1] = c
        else:
            spans.append([c, c])
    those = "".join(rf"\x{{{a:x}}}-\x{{{b:x}}}" for a, b in spans)
    return every, rf"[\x00-\x7F[^{those}]]+|[{those}]"  # ASCII is told first, as most text is


def folded(text: Column) -> Column:
    """Unicode's full case folding: lower case, and ß as ss, a long or final s as any other. Only the characters that lower case leaves to change are looked up, not those between them."""
    folds, pattern = _folds()
    table = F.create_map(*(F.lit(x) for pair in folds.items() for x in pair))
    pieces = F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(0))
    return F.array_join(F.transform(pieces, lambda p: F.when(F.length(p) == 1, F.coalesce(F.try_element_at(table, p), p)).otherwise(p)), "")


def compact_name(text: Column) -> Column:
    return F.regexp_replace(folded(text), r"[^a-z0-9]", "")


def is_self_name(entity: Column, product: Column) -> Column:
    """An entity that only names the product: equal when compacted, or five characters or more and contained; a name without letters and digits names nothing."""
    e, p = compact_name(entity), compact_name(product)
    return ((e == p) & (e != "")) | ((F.length(e) >= 5) & F.contains(p, e))


def iso_timestamp(text: Column) -> Column:
    """An ISO date or time, with Z or an offset; null for anything else."""
    return F.try_to_timestamp(F.regexp_replace(F.trim(text), r"Z$", "+00:00"))


def retry_after(header: Column, now: Column) -> Column:
    """Seconds that a Retry-After header asks for, given as seconds or as an HTTP date; never negative."""
    date = F.try_to_timestamp(F.regexp_replace(header, r"^\w+, | GMT$", ""), F.lit("dd MMM yyyy HH:mm:ss"))
    return F.greatest(F.lit(0.0), F.coalesce(header.try_cast("double"), (F.unix_timestamp(date) - F.unix_timestamp(now)).cast("double")))


# Address ranges that are not public.
_PRIVATE = r"^(0|10|127)\.|^169\.254\.|^192\.168\.|^172\.(1[6-9]|2\d|3[01])\.|^100\.(6[4-9]|[7-9]\d|1[01]\d|12[0-7])\.|^192\.0\.[02]\.|^198\.(1[89]|51)\.|^203\.0\.113\.|^(22[4-9]|2[3-5]\d)\."


def public_url(url: Column) -> Column:
    """Whether an address may be fetched: http(s), no user, an ordinary port and no local name or private address."""
    parts = r"(?i)^(https?)://(?:([^/@?#]*)@)?(\[[^\]]*\]|[^/:?#]+)(?::(\d+))?(?:[/?#]|$)"
    get = lambda i: F.regexp_extract(url, parts, i)
    host = F.regexp_replace(F.lower(get(3)), r"\.$", "")
    local = host.rlike(r"(^|\.)(localhost|local|internal|home|lan)$") | ~F.contains(host, F.lit(".")) | host.rlike(_PRIVATE) | F.startswith(host, F.lit("["))
    return F.coalesce(url.rlike(parts) & (get(2) == "") & get(4).isin("", "80", "443") & ~local, F.lit(False))
