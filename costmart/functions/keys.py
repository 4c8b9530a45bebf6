"""Surrogate keys and identifier parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .cache import per_session

KEY_SEPARATOR = "||"


def surrogate_key(cols: list[str]) -> Column:
    """64-char lowercase hex SHA-256 of the columns joined by ``||``.

    Columns are taken in the given order (callers pass them sorted). NULLs are
    skipped by ``concat_ws``; an empty list or all-NULL row hashes ''.
    """
    return _surrogate_key(tuple(cols))


@per_session
def _surrogate_key(cols: tuple[str, ...]) -> Column:
    text = F.concat_ws(KEY_SEPARATOR, *[F.col(c) for c in cols]) if cols else F.lit("")
    return F.sha2(text, 256)


def _escaped(c: Column) -> Column:
    """``c`` with a backslash before backslashes, '&' and '='."""
    return F.regexp_replace(c, r"([\\&=])", r"\\$1")


def tag_set_text(tags: list[str]) -> Column:
    """The non-empty tags of a row as ``name=value&name=value``, names sorted
    and separators escaped: equal for the same tags whatever columns exist, and
    different for different tags. '' without tags."""
    parts = [
        F.when(F.col(f"`{t}`") != "", F.concat(_escaped(F.lit(t)), F.lit("="), _escaped(F.col(f"`{t}`"))))
        for t in sorted(tags)
    ]
    return F.concat_ws("&", *parts) if parts else F.lit("")


def tag_set_key(tags: list[str]) -> Column:
    """64-char lowercase hex SHA-256 of ``tag_set_text``."""
    return F.sha2(tag_set_text(tags), 256)


def short_resource_id(c: Column) -> Column:
    """Text after the last ':' (whole text without ':'); NULL stays NULL."""
    return F.substring_index(c, ":", -1)


def last_tag_value(tags: Column, key: str) -> Column:
    """Value of the last ``{Key, Value}`` element whose Key is ``key``; ''
    when there is none or the list is NULL."""
    matching = F.filter(tags, lambda t: t["Key"] == F.lit(key))
    return F.coalesce(F.get(F.reverse(matching), 0)["Value"], F.lit(""))
