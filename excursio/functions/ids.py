"""Repeatable identifiers: hashes of the page address, so retries agree."""

from __future__ import annotations

from excursio.functions.sql import Sql, coalesce, quote, when


def hash32(key: Sql) -> Sql:
    """First 32 bits of the MD5 of a text, as a number."""
    return f"CAST(conv(left(md5({key}), 8), 16, 10) AS BIGINT)"


def numeric_id(key: Sql) -> Sql:
    """Id in [1,000,000, 1,000,999,999], safe for a signed 32-bit column."""
    return f"CAST(1000000 + {hash32(key)} % 1000000000 AS INT)"


def caller_or(custom: Sql | None, generated: Sql) -> Sql:
    """The caller's id unless it is null or 0."""
    if custom is None:
        return generated
    return coalesce(when(f"{custom} <> 0", f"CAST({custom} AS INT)"), generated)


def activity_id(url: Sql) -> Sql:
    return numeric_id(url)


def product_id(kind: str, url: Sql) -> Sql:
    """Id in [10,000,000, 99,999,999], drawn separately for each kind."""
    key = f"concat({quote(kind + ':')}, {url})"
    return f"CAST(10000000 + {hash32(key)} % 90000000 AS INT)"


def poi_id(url: Sql, name: Sql) -> Sql:
    return f"CAST({numeric_id(f"concat('poi:', {url}, '#', {name})")} AS STRING)"


def gallery_base(url: Sql) -> Sql:
    return numeric_id(f"concat('gallery:', {url})")


def unique_id(kind: str, url: Sql) -> Sql:
    """UUID-shaped text."""
    h = f"md5(concat({quote(kind + ':')}, {url}))"
    return f"regexp_replace({h}, '^(.{{8}})(.{{4}})(.{{4}})(.{{4}})', '$1-$2-$3-$4-')"
