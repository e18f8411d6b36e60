"""Text expressions: ids from names, safe and display names, pattern tests."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Patterns of file names and addresses that carry an id.
PRODUCT_FILE = r"^(\d+)(?:\.0)?\.json$"
PRODUCT_URL = r"/product/(\d+)/"
GRADED_FILE = r"^(.+)_([^_]+)\.json$"
SUMMARY_MARK = "_summary.json"
FOLDER_STAMP = r"(\d{6})_raw_jsons"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def extract(c: Column | str, pattern: str, group: int = 1) -> Column:
    """A regex group, NULL when the pattern does not match."""
    return F.nullif(F.regexp_extract(_col(c), pattern, group), F.lit(""))


def file_name(path: Column | str) -> Column:
    """Last part of a path."""
    return F.element_at(F.split(_col(path), "/"), -1)


def product_id_from_file(path: Column | str) -> Column:
    """Product id of ``123.json`` or ``123.0.json``; NULL for summaries and other names."""
    name = file_name(path)
    return F.when(~F.contains(name, F.lit(SUMMARY_MARK)), extract(name, PRODUCT_FILE))


def product_id_from_url(url: Column | str) -> Column:
    """Product id of a shop address; NULL when there is none."""
    return extract(url, PRODUCT_URL)


def safe_name(c: Column | str, length: int = 50) -> Column:
    """Every character that is no letter or digit becomes ``_``; at most ``length`` characters."""
    return F.substring(F.regexp_replace(_col(c), r"[^\p{L}\p{N}]", "_"), 1, length)


def keyword_of(stem: Column | str) -> Column:
    """File stem without its running number: ``0007_blue_card`` gives ``blue_card``."""
    return F.regexp_replace(_col(stem), r"^[^_]*_", "")


def display_name(name: Column | str, ident: Column | str, length: int = 40) -> Column:
    """``name (id)``, the name shortened to ``length`` characters and ``...`` when longer."""
    name, tail = _col(name), F.concat(F.lit(" ("), _col(ident).cast("string"), F.lit(")"))
    short = F.concat(F.substring(name, 1, length), F.lit("..."))
    return F.concat(F.when(F.length(name) > length, short).otherwise(name), tail)


def composite_key(*parts: Column | str, sep: str = "_") -> Column:
    """Parts joined by ``sep``; NULL when any part is NULL."""
    cols: list[Column] = []
    for i, p in enumerate(parts):
        cols += ([F.lit(sep)] if i else []) + [_col(p)]
    return F.concat(*cols)


def matches(c: Column | str, pattern: str) -> Column:
    """Case-insensitive pattern test by lower-casing; NULL text gives NULL."""
    return F.lower(_col(c)).rlike(pattern)


def mentions(c: Column | str, needle: str) -> Column:
    """Case-insensitive substring test; NULL text gives NULL."""
    return F.contains(F.lower(_col(c)), F.lit(needle))


def content_text(title: Column | str, body: Column | str, sep: str = " | ") -> Column:
    """Title, separator and body (or nothing) as one text."""
    return F.concat(_col(title), F.lit(sep), F.coalesce(_col(body), F.lit("")))


def json_get(text: Column | str, *path: str, default: Column | str | None = None) -> Column:
    """A nested field of JSON text, as text; the default where the text, the field or one above it is missing or null."""
    found = F.get_json_object(_col(text), "$" + "".join(f"['{name}']" for name in path))
    return found if default is None else F.coalesce(found, default if isinstance(default, Column) else F.lit(default))
