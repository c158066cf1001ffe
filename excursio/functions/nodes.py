"""Selectors over the element list of a page, as SQL expressions.

``nodes`` is in document order and ``pre`` is the position of an element in it,
so the elements inside another one are a slice and its parent is one look-up.
"""

from __future__ import annotations

from collections.abc import Callable

from excursio.functions.arrays import first, last
from excursio.functions.sql import Sql, all_of, any_of, coalesce, fold, keep, let, quote, when
from excursio.functions.text import clean, contains_any, text

Test = Callable[[Sql], Sql]


def _among(x: Sql, values) -> Sql:
    return f"coalesce({x} IN ({', '.join(map(quote, values))}), false)"


def tag(*names: str) -> Test:
    return lambda n: _among(f"{n}.tag", names)


def attr_or_null(n: Sql, name: str) -> Sql:
    return f"try_element_at({n}.attrs, {quote(name)})"


def attr(n: Sql, name: str) -> Sql:
    """Attribute value, '' where absent."""
    return text(attr_or_null(n, name))


def has_attr(name: str) -> Test:
    return lambda n: f"{attr_or_null(n, name)} IS NOT NULL"


def attr_is(name: str, *values: str) -> Test:
    return lambda n: _among(attr_or_null(n, name), values)


def attr_is_ci(name: str, *values: str) -> Test:
    """For attributes whose values HTML compares without case; values in lower case."""
    return lambda n: _among(f"lower({attr_or_null(n, name)})", values)


def attr_starts(name: str, start: str) -> Test:
    return lambda n: f"startswith({attr(n, name)}, {quote(start)})"


def attr_contains(name: str, *parts: str) -> Test:
    """Any of the parts occurs in the attribute."""
    return lambda n: contains_any(attr(n, name), parts)


def both(*tests: Test) -> Test:
    return lambda n: all_of(t(n) for t in tests)


def either(*tests: Test) -> Test:
    return lambda n: any_of(t(n) for t in tests)


def select(nodes: Sql, test: Test) -> Sql:
    """All matching elements in document order."""
    return keep(nodes, lambda n: test(n))


def select_first(nodes: Sql, test: Test) -> Sql:
    return first(select(nodes, test))


def inside(nodes: Sql, n: Sql) -> Sql:
    """Elements inside ``n``; empty when there is no ``n``."""
    return f"slice({nodes}, coalesce({n}.pre, 0) + 2, coalesce({n}.size, 0))"


def is_inside(n: Sql, outer: Sql) -> Sql:
    return f"({n}.pre > {outer}.pre AND {n}.pre <= {outer}.pre + {outer}.size)"


def parent(nodes: Sql, n: Sql) -> Sql:
    return f"get({nodes}, {n}.parent)"


def next_sibling(nodes: Sql, n: Sql) -> Sql:
    return let(
        f"get({nodes}, {n}.pre + {n}.size + 1)",
        lambda after: when(f"{after}.parent = {n}.parent", after),
    )


def next_of(items: Sql) -> Sql:
    """For every position of a page, which of the items comes at or after it (0-based); null behind the last."""
    def repeat(pres: Sql) -> Sql:
        return (
            f"flatten(transform({pres}, (p, k) -> "
            f"array_repeat(k, p - CASE WHEN k = 0 THEN -1 ELSE {pres}[k - 1] END)))"
        )

    return let(f"transform({items}, n -> n.pre)", repeat)


def nearest(nodes: Sql, n: Sql, test: Test) -> Sql:
    """Innermost element around ``n`` that passes the test."""
    before = f"slice({nodes}, 1, {n}.pre)"
    return last(keep(before, lambda a: f"{test(a)} AND {is_inside(n, a)}"))


def climb(nodes: Sql, start: Sql, steps: int, enough: Test) -> Sql:
    """Go up from ``start`` until an element passes, at most ``steps`` times.

    The element reached last counts even if it does not pass; null above the root.
    """
    return fold(
        f"sequence(1, {steps})", start, lambda at, _: when(enough(at), at, parent(nodes, at))
    )


def content(page_text: Sql, n: Sql) -> Sql:
    """Text content of an element, as it stands."""
    return f"CAST(substring({page_text}, {n}.t0 + 1, {n}.t1 - {n}.t0) AS STRING)"


def words(page_text: Sql, n: Sql) -> Sql:
    """Cleaned text content."""
    return clean(content(page_text, n))


def meta(metas: Sql, name: str) -> Sql:
    """Content of the first ``meta`` with that name or property."""
    found = select_first(metas, either(attr_is("name", name), attr_is("property", name)))
    return coalesce(f"try_element_at({found}.attrs, 'content')", "''")
