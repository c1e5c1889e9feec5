"""Links."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelftrack import fixed_values as fixed
from shelftrack.functions.text import as_column

_AUTHORITY = r"^([A-Za-z][A-Za-z0-9+.-]*:)//([^/?#]*)"


def valid_link(link: Column | str) -> Column:
    return as_column(link).rlike(fixed.LINK_PATTERN)


def host(url: Column | str) -> Column:
    return F.lower(F.regexp_extract(as_column(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def publisher_from_url(url: Column | str) -> Column:
    """Second-level label of the host, or the only label there is."""
    labels = F.split(F.nullif(host(url), F.lit("")), "[.]")
    return F.coalesce(F.try_element_at(labels, F.lit(-2)), F.try_element_at(labels, F.lit(1)))


def on_hosts(url: Column | str, hosts: list[str] | tuple[str, ...]) -> Column:
    """Whether a URL lies on one of the hosts or on a subdomain of one."""
    name = host(url)
    tests = [(name == h) | name.endswith("." + h) for h in (h.lower() for h in hosts)]
    return reduce(lambda a, b: a | b, tests)


def absolutize(link: Column | str, prefix: str) -> Column:
    """Put a site prefix before a link that has none."""
    link = as_column(link)
    joined = F.concat(F.lit(prefix.rstrip("/") + "/"), F.regexp_replace(link, r"^/+", ""))
    return F.when(F.lower(link).startswith("http"), link).otherwise(joined)


def _without_dots(path: Column) -> Column:
    """Resolve ``.`` and ``..`` segments of an absolute path."""

    def step(kept: Column, segment: Column) -> Column:
        return (
            F.when(segment == "..", F.when(F.size(kept) > 1, F.slice(kept, F.lit(1), F.size(kept) - 1)).otherwise(kept))
            .when(segment == ".", kept)
            .otherwise(F.concat(kept, F.array(segment)))
        )

    segments = F.split(path, "/")
    folded = F.aggregate(segments, F.array().cast("array<string>"), step)
    last_is_dot = F.element_at(segments, -1).isin(".", "..")
    return F.concat(F.array_join(folded, "/"), F.when(last_is_dot, "/").otherwise(""))


def resolve_link(link: Column | str, page_url: Column | str) -> Column:
    """A link as found on a page, made absolute against the page's own URL."""
    link, page_url = as_column(link), as_column(page_url)
    scheme = F.regexp_extract(page_url, _AUTHORITY, 1)
    root = F.regexp_extract(page_url, _AUTHORITY, 0)
    page_path = F.regexp_extract(page_url, _AUTHORITY + r"([^?#]*)", 3)
    folder = F.regexp_replace(page_path, r"[^/]*\z", "")
    folder = F.when(folder == "", F.lit("/")).otherwise(folder)
    path = F.regexp_extract(link, r"^[^?#]*", 0)
    rest = F.regexp_extract(link, r"(?s)[?#].*\z", 0)

    def dotted(full_path: Column) -> Column:
        has_dots = full_path.rlike(r"/\.{1,2}(/|\z)")
        return F.when(has_dots, _without_dots(full_path)).otherwise(full_path)

    return (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), link)
        .when(link.startswith("//"), F.concat(scheme, link))
        .when(link.startswith("/"), F.concat(root, dotted(path), rest))
        .when(link == "", page_url)
        .when(link.startswith("?"), F.concat(root, page_path, link))
        .when(link.startswith("#"), F.concat(F.regexp_replace(page_url, r"#.*\z", ""), link))
        .otherwise(F.concat(root, dotted(F.concat(folder, path)), rest))
    )
