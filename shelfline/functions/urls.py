"""URL expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfline.functions.text import present

# Fixed value: what counts as a valid link.
URL_PATTERN = (
    r"^https?://"
    r"(?:(?:[A-Z0-9](?:[A-Z0-9-]{0,61}[A-Z0-9])?\.)+[A-Z]{2,6}\.?|"
    r"localhost|"
    r"\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3})"
    r"(?::\d+)?"
    r"(?:/?|[/?]\S+)$"
)

_SCHEME = r"^([A-Za-z][A-Za-z0-9+.\-]*):"


def has_web_scheme(c: Column) -> Column:
    return c.startswith("http://") | c.startswith("https://")


def validate_url(c: Column) -> Column:
    """Add a missing scheme; NULL for a host-relative or malformed address."""
    full = (
        F.when(has_web_scheme(c), c)
        .when(c.startswith("//"), F.concat(F.lit("https:"), c))
        .when(c.startswith("/"), F.lit(None))
        .otherwise(F.concat(F.lit("https://"), c))
    )
    return F.when(present(c), F.when(full.rlike(rf"(?iUd){URL_PATTERN}"), full)).otherwise(c)


def _fold_dots(path: Column) -> Column:
    """Resolve ``.`` and ``..`` segments of an absolute path."""
    parts = F.split(path, "/")
    last = F.element_at(parts, -1)
    # The first part is the empty text in front of the leading slash.
    inner = F.slice(parts, F.lit(2), F.size(parts) - 1)
    kept = F.aggregate(
        inner,
        F.array().cast("array<string>"),
        lambda acc, s: F.when(
            s == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0)))
        )
        .when(s == ".", acc)
        .otherwise(F.concat(acc, F.array(s))),
    )
    # A path that ends in a dot segment keeps its closing slash.
    closed = F.when(last.isin(".", ".."), F.concat(kept, F.array(F.lit("")))).otherwise(kept)
    return F.concat(F.lit("/"), F.array_join(closed, "/"))


def absolute_url(base: Column, link: Column) -> Column:
    """Resolve a link found on the page ``base``.

    The five reference forms of RFC 3986 are covered: full address, ``//host``, ``/path``,
    relative path, and a bare query or fragment.
    """
    root = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1)
    scheme = F.regexp_extract(base, _SCHEME, 1)
    no_fragment = F.regexp_replace(base, r"#.*$", "")
    no_query = F.regexp_replace(no_fragment, r"\?.*$", "")
    base_path = F.substring(no_query, F.length(root) + 1, F.length(no_query))
    folder = F.coalesce(
        F.nullif(F.regexp_extract(base_path, r"^(.*/)", 1), F.lit("")), F.lit("/")
    )
    link_path = F.regexp_extract(link, r"^([^?#]*)", 1)
    link_rest = F.substring(link, F.length(link_path) + 1, F.length(link))
    return (
        F.when(link.isNull() | (link == ""), base)
        .when(link.rlike(_SCHEME), link)
        .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
        .when(link.startswith("/"), F.concat(root, _fold_dots(link_path), link_rest))
        .when(link.startswith("?"), F.concat(no_query, link))
        .when(link.startswith("#"), F.concat(no_fragment, link))
        .otherwise(F.concat(root, _fold_dots(F.concat(folder, link_path)), link_rest))
    )


def prefix_host(link: Column, host: str) -> Column:
    """Put the host in front of a link that does not start with ``http``."""
    return F.when(~link.startswith("http"), F.concat(F.lit(host), link)).otherwise(link)


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#:]*)", 1))
