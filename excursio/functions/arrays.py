"""Ordered-array helpers. All of them are narrow: one row in, one row out."""

from __future__ import annotations

from collections.abc import Callable

from excursio.functions.sql import Sql, coalesce, each, keep, let, struct
from excursio.functions.text import clean


def first(items: Sql) -> Sql:
    return f"get({items}, 0)"


def last(items: Sql) -> Sql:
    return f"try_element_at({items}, -1)"


def empty(element: str = "STRING") -> Sql:
    return f"CAST(array() AS ARRAY<{element}>)"


def or_empty(items: Sql, element: str = "STRING") -> Sql:
    return coalesce(items, empty(element))


def clean_list(items: Sql) -> Sql:
    """Clean every string and drop the ones that end up empty."""
    return keep(each(or_empty(items), clean), lambda x: f"{x} <> ''")


def distinct_longer(items: Sql, n: int) -> Sql:
    """Distinct strings longer than ``n``, first occurrence first."""
    return f"array_distinct({keep(items, lambda t: f'length({t}) > {n}')})"


def _by_key(items: Sql, key: Callable[[Sql], Sql], sign: str) -> Sql:
    def pick(a: Sql) -> Sql:
        order = f"sort_array({each(a, lambda x, i: struct(k=key(x), i=f'{sign}{i}'))})"
        kept = let(
            order, lambda s: keep(s, lambda x, i: f"({i} = 0 OR get({s}, {i} - 1).k <> {x}.k)")
        )
        positions = f"sort_array({each(kept, lambda x: f'{sign}{x}.i')})"
        return each(positions, lambda i: f"get({a}, {i})")

    return let(items, pick)


def first_by_key(items: Sql, key: Callable[[Sql], Sql]) -> Sql:
    """Keep the first element of each key, in order (sorts: n log n per row)."""
    return _by_key(items, key, "")


def last_by_key(items: Sql, key: Callable[[Sql], Sql]) -> Sql:
    """Keep the last element of each key, in order."""
    return _by_key(items, key, "-")


def map_last_wins(entries: Sql) -> Sql:
    """Map from ``{key, value}`` entries; a later entry replaces an earlier one.

    Does not depend on the session's duplicate-key policy.
    """
    return f"map_from_entries({last_by_key(entries, lambda e: f'{e}.key')})"
