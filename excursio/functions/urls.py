"""URL rules: path parts, response keys, absolute addresses."""

from __future__ import annotations

from excursio.functions.arrays import first
from excursio.functions.sql import Sql, case, each, fold, keep, let, quote, struct, when
from excursio.functions.text import clean, fallback, leading_int, text

# Regular expressions instead of parse_url: that one refuses addresses with
# blanks or unescaped characters, which browsers accept.
_ORIGIN = quote(r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)")
_PARTS = quote(r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)(\?[^#]*)?")
# Already in the form a browser would print it.
_PLAIN = quote(r"^https?://[a-z0-9.-]+/[A-Za-z0-9_~!$&'()*+,;=:@%/?#.-]*$")
_PLAIN_PATH = quote(r"^/([A-Za-z0-9_~!$&'()*+,;=:@%?#.-][A-Za-z0-9_~!$&'()*+,;=:@%/?#.-]*)?$")
_HTTP = "'(?i)^https?://'"
_TRIMMED = r"^[\x00-\x20]+|[\x00-\x20]+$|[\t\n\r]"
# Characters that stay as they are in a path and in a query or fragment.
_PATH_CHARS = "!#-;=?-_a-z|~"
_REST_CHARS = "!#-;=?-~"


def origin(url: Sql) -> Sql:
    return f"regexp_extract({url}, {_ORIGIN}, 1)"


def path(url: Sql) -> Sql:
    return f"regexp_extract({url}, {_PARTS}, 1)"


def query(url: Sql) -> Sql:
    return f"regexp_extract({url}, {_PARTS}, 2)"


def path_parts(url: Sql) -> Sql:
    """Non-empty path segments."""
    return keep(f"split({path(text(url))}, '/')", lambda p: f"{p} <> ''")


def response_key(url: Sql) -> Sql:
    """Path and query without the host; null if the address has no host."""
    search = f"regexp_replace({query(url)}, {quote(r'^\?$')}, '')"
    return when(f"{url} RLIKE {_ORIGIN}", f"concat({fallback(path(url), "'/'")}, {search})")


def _escape(s: Sql, chars: str) -> Sql:
    runs = f"regexp_extract_all({s}, {quote(f'[{chars}]+|[^{chars}]+')}, 0)"
    kept = quote(f"^[{chars}]")
    escaped = each(
        runs, lambda r: when(f"{r} RLIKE {kept}", r, f"replace(url_encode({r}), '+', '%20')")
    )
    return f"array_join({escaped}, '')"


def _drop_dots(p: Sql) -> Sql:
    """Resolve ``.`` and ``..`` segments of an absolute path."""
    walked = fold(
        let(f"split({p}, '/')", lambda parts: f"slice({parts}, 2, size({parts}))"),
        "CAST(array() AS ARRAY<STRING>)",
        lambda acc, s: case(
            (f"{s} = '.'", acc),
            (f"{s} = '..'", f"slice({acc}, 1, greatest(size({acc}) - 1, 0))"),
            other=f"concat({acc}, array({s}))",
        ),
    )
    slash = when(f"{p} RLIKE {quote(r'/\.{1,2}$')}", "'/'", "''")
    return f"regexp_replace(concat('/', array_join({walked}, '/'), {slash}), '//$', '/')"


def _host(root: Sql) -> Sql:
    """Scheme and host the way a browser prints them: lower case, no usual port."""
    ports = quote(r"^(http://.*):80$|^(https://.*):443$")
    return f"regexp_replace(lower({root}), {ports}, '$1$2')"


def _printed(u: Sql, given: Sql) -> Sql:
    """An absolute http(s) address the way a browser prints it."""

    def build(root: Sql) -> Sql:
        rest = f"regexp_extract({u}, {quote(r'^[^?#]*(.*)$')}, 1)"
        walked = let(
            fallback(path(u), "'/'"),
            lambda p: when(f"{p} RLIKE {quote(r'/\.{1,2}(/|$)')}", _drop_dots(p), p),
        )
        return when(
            f"{root} RLIKE {quote(r'^[A-Za-z]+://$|\s')}",
            given,
            f"concat({_host(root)}, {_escape(walked, _PATH_CHARS)}, {_escape(rest, _REST_CHARS)})",
        )

    return let(origin(u), build)


def printed(url: Sql) -> Sql:
    """A page's own address the way a browser prints it."""
    def choose(u: Sql) -> Sql:
        return case((f"{u} RLIKE {_PLAIN} AND NOT contains({u}, '/.')", u), (f"{u} RLIKE {_HTTP}", _printed(u, u)), other=u)

    return let(f"regexp_replace({url}, {quote(_TRIMMED)}, '')", choose)


def base_parts(base: Sql) -> Sql:
    """What relative addresses need of the page address, worked out once per page."""
    return struct(
        root=_host(origin(base)),
        scheme=f"regexp_extract({base}, '^([^:/]+:)', 1)",
        path=path(base),
        query=query(base),
        dir=f"regexp_replace({fallback(path(base), "'/'")}, '[^/]*$', '')",
    )


def absolute_from(url: Sql, b: Sql) -> Sql:
    """Absolute address of ``url`` seen from a page with these ``base_parts``.

    '' for missing, ``data:`` and ``blob:`` addresses; what cannot be resolved
    comes back as it is.
    """

    def resolve(u: Sql) -> Sql:
        joined = case(
            (f"{u} RLIKE {_HTTP}", u),
            (f"{u} LIKE '//%'", f"concat({b}.scheme, {u})"),
            (f"{u} LIKE '/%'", f"concat({b}.root, {u})"),
            (f"{u} LIKE '?%'", f"concat({b}.root, {b}.path, {u})"),
            (f"{u} LIKE '#%'", f"concat({b}.root, {b}.path, {b}.query, {u})"),
            other=f"concat({b}.root, {b}.dir, {u})",
        )
        as_is = (
            f"NOT {u} RLIKE {_HTTP} AND "
            f"({u} RLIKE '^[A-Za-z][A-Za-z0-9+.-]*:' OR {b}.root = '')"
        )
        return when(as_is, u, let(joined, lambda j: _printed(j, u)))

    def choose(u: Sql) -> Sql:
        trimmed = f"regexp_replace({u}, {quote(_TRIMMED)}, '')"
        dotted = f"contains({u}, '/.')"
        return case(
            (f"{u} = '' OR {u} LIKE 'data:%' OR {u} LIKE 'blob:%'", "''"),
            # The two usual forms, already as they would be printed.
            (f"{u} RLIKE {_PLAIN} AND NOT {dotted}", u),
            (f"{u} RLIKE {_PLAIN_PATH} AND NOT {dotted} AND {b}.root <> ''", f"concat({b}.root, {u})"),
            other=let(trimmed, resolve),
        )

    return let(text(url), choose)


def absolute(url: Sql, base: Sql) -> Sql:
    """Absolute address of ``url`` seen from the address ``base``."""
    return let(base_parts(base), lambda b: absolute_from(url, b))


def srcset_pick(srcset: Sql) -> Sql:
    """Address of the candidate with the largest leading descriptor number.

    A missing descriptor counts as 0 and ties keep their order.
    """

    def candidate(s: Sql, i: Sql) -> Sql:
        return let(
            f"split({clean(s)}, ' ')",
            lambda parts: struct(
                w=f"-coalesce({leading_int(f'get({parts}, 1)')}, 0)", i=i, url=f"get({parts}, 0)"
            ),
        )

    return first(f"array_sort({each(f"split({srcset}, ',')", candidate)})") + ".url"
