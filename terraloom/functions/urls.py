"""Relative-reference resolution and link classification on columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:"
AUTHORITY = r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)"


def _without_dot_segments(path: Column) -> Column:
    segments = F.split(path, "/")
    last = F.element_at(segments, -1)
    folded = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda kept, seg: F.when(seg == ".", kept)
        .when(seg == "..", F.when(F.size(kept) > 1, F.slice(kept, F.lit(1), F.size(kept) - 1)).otherwise(kept))
        .otherwise(F.concat(kept, F.array(seg))),
    )
    joined = F.array_join(folded, "/")
    closed = F.when(last.isin(".", ".."), F.concat(joined, F.lit("/"))).otherwise(joined)
    return F.when(path.rlike(r"(^|/)\.\.?(/|$)"), closed).otherwise(path)


def resolve_url(base: Column, href: Column) -> Column:
    """Absolute form of ``href`` found on page ``base`` (RFC 3986 reference resolution)."""
    no_fragment = F.regexp_replace(base, r"#.*$", "")
    no_query = F.regexp_replace(no_fragment, r"\?.*$", "")
    root = F.regexp_extract(base, AUTHORITY, 1)
    scheme = F.regexp_extract(base, SCHEME, 0)
    base_path = F.regexp_replace(no_query, AUTHORITY, "")
    base_dir = F.when(base_path == "", F.lit("/")).otherwise(F.regexp_extract(base_path, r"^(.*/)", 1))
    ref_path = F.regexp_extract(href, r"^([^?#]*)", 1)
    ref_tail = F.regexp_replace(href, r"^[^?#]*", "")
    full_path = F.when(F.startswith(href, F.lit("/")), ref_path).otherwise(F.concat(base_dir, ref_path))
    return (
        F.when(href.rlike(SCHEME), href)
        .when(F.startswith(href, F.lit("//")), F.concat(scheme, href))
        .when(href == "", base)
        .when(F.startswith(href, F.lit("#")), F.concat(no_fragment, href))
        .when(F.startswith(href, F.lit("?")), F.concat(no_query, href))
        .otherwise(F.concat(root, _without_dot_segments(full_path), ref_tail))
    )


def link_kind(href: Column) -> Column:
    return F.when(F.endswith(href, F.lit("/")), F.lit("dir")).otherwise(F.lit("file"))


def is_listing_entry(href: Column) -> Column:
    """False for parent links and the bare root."""
    return href.isNotNull() & ~F.startswith(href, F.lit("../")) & (href != "/")


def last_path_part(url: Column) -> Column:
    return F.substring_index(F.regexp_replace(url, "/+$", ""), "/", -1)


def child_url(base: Column, name: Column) -> Column:
    return F.concat(F.regexp_replace(base, "/+$", ""), F.lit("/"), name, F.lit("/"))


def has_suffix(url: Column, suffix: str = ".tif") -> Column:
    return F.endswith(F.lower(url), F.lit(suffix.lower()))


def contains_any(text: Column, needles: list[str]) -> Column:
    return F.exists(F.array(*[F.lit(n) for n in needles]), lambda n: F.contains(text, n)) if needles else F.lit(False)
