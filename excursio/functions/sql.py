"""Building blocks of SQL expressions.

Rules are written as SQL text and handed to ``expr`` once per field. Nested
higher-order expressions built from Column objects cost one driver round trip
per node, thousands for a page; as text they cost one.

Lambda variables are named by nesting depth (``v0``, ``v1``, ...), so an inner
lambda never hides a variable that its body uses.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from contextvars import ContextVar

Sql = str
_depth: ContextVar[int] = ContextVar("depth", default=0)


def quote(value: str) -> Sql:
    """String literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _lambda(body: Callable[..., Sql], arity: int) -> Sql:
    depth = _depth.get()
    names = [f"v{depth}", f"i{depth}"][:arity]
    mark = _depth.set(depth + 1)
    try:
        inner = body(*names)
    finally:
        _depth.reset(mark)
    return f"{names[0]} -> {inner}" if arity == 1 else f"({', '.join(names)}) -> {inner}"


def _higher(name: str, items: Sql, body: Callable[..., Sql]) -> Sql:
    return f"{name}({items}, {_lambda(body, body.__code__.co_argcount)})"


def each(items: Sql, body: Callable[..., Sql]) -> Sql:
    """``transform``: body of the element, or of the element and its position."""
    return _higher("transform", items, body)


def keep(items: Sql, test: Callable[..., Sql]) -> Sql:
    return _higher("filter", items, test)


def some(items: Sql, test: Callable[[Sql], Sql]) -> Sql:
    return _higher("exists", items, test)


def fold(items: Sql, start: Sql, step: Callable[[Sql, Sql], Sql]) -> Sql:
    return f"aggregate({items}, {start}, {_lambda(step, 2)})"


def let(value: Sql, body: Callable[[Sql], Sql]) -> Sql:
    """Evaluate ``value`` once and hand it to ``body``.

    A lambda body is evaluated per element, and so is every outer expression in
    it; binding keeps those at one evaluation per row.
    """
    return f"{each(f'array({value})', body)}[0]"


def struct(**fields: Sql) -> Sql:
    return "named_struct(" + ", ".join(f"{quote(k)}, {v}" for k, v in fields.items()) + ")"


def null(kind: str) -> Sql:
    return f"CAST(NULL AS {kind})"


def case(*pairs: tuple[Sql, Sql], other: Sql = "NULL") -> Sql:
    return "CASE " + " ".join(f"WHEN {c} THEN {v}" for c, v in pairs) + f" ELSE {other} END"


def when(test: Sql, value: Sql, other: Sql = "NULL") -> Sql:
    return case((test, value), other=other)


def any_of(tests: Iterable[Sql]) -> Sql:
    return "(" + " OR ".join(tests) + ")"


def all_of(tests: Iterable[Sql]) -> Sql:
    return "(" + " AND ".join(tests) + ")"


def coalesce(*options: Sql) -> Sql:
    return f"coalesce({', '.join(options)})"
