"""Scalar text rules shared by every operator: SQL text in, SQL text out."""

from __future__ import annotations

from excursio.functions.sql import Sql, any_of, coalesce, each, quote, when

# Fixed value: the characters JavaScript's \s stands for, spelled out because
# neither Java's \s nor its Unicode variant is the same set.
_WS_NO_BLANK = (
    r"\x{09}-\x{0D}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}"
)
WS = f"[ {_WS_NO_BLANK}]"
# The intersection turns other characters away with one comparison instead of one
# per range, and it stands first, so that a character is looked at once; a single blank
# stays as it is, so ordinary prose is scanned, not rebuilt.
_ANY = r"[\x{00}-\x{20}\x{A0}-\x{3000}\x{FEFF}&&" + WS + "]"
_WS_TO_FIX = rf"{_ANY}(?:(?<! )|(?={_ANY})){_ANY}*+"


def text(x: Sql) -> Sql:
    """Null becomes the empty string."""
    return f"coalesce({x}, '')"


def clean(x: Sql) -> Sql:
    """Collapse runs of white space to one blank and trim; null becomes ''."""
    return f"trim(regexp_replace({text(x)}, {quote(_WS_TO_FIX)}, ' '))"


def collapse_ascii(x: Sql) -> Sql:
    """The same for ASCII white space only (document titles)."""
    return f"trim(regexp_replace({text(x)}, {quote(r'[\t\n\f\r ]+')}, ' '))"


def filled(x: Sql) -> Sql:
    """The value, or null when it is the empty string."""
    return when(f"{x} <> ''", x)


def fallback(*options: Sql) -> Sql:
    """First option that is neither null nor empty, else ''."""
    return coalesce(*[filled(o) for o in options], "''")


def prefix(x: Sql, n: int) -> Sql:
    return f"substring({x}, 1, {n})"


def title_case(segment: Sql) -> Sql:
    """URL segment to heading: dashes to blanks, first letter of each word upper.

    A word is a run of ASCII word characters; its other letters keep their case,
    which is why ``initcap`` does not serve.
    """
    words = (
        f"regexp_extract_all(replace({segment}, '-', ' '), '[A-Za-z0-9_]+|[^A-Za-z0-9_]+', 0)"
    )
    upper = each(
        words,
        lambda w: when(f"{w} RLIKE '^[a-z]'", f"upper(left({w}, 1)) || substring({w}, 2)", w),
    )
    return f"array_join({upper}, '')"


def contains(x: Sql, word: str) -> Sql:
    return f"contains({x}, {quote(word)})"


def contains_any(x: Sql, words) -> Sql:
    return any_of(contains(x, w) for w in words)


def contains_ci(x: Sql, word: str) -> Sql:
    """Case-insensitive substring test against a lower-case word."""
    return contains(f"lower({x})", word)


def _number(x: Sql, likely: str, pattern: str, group: int, kind: str) -> Sql:
    """Part of a text as a number; null if there is none.

    The guard keeps texts without a number away from the cast: a failing cast
    costs an exception, and most texts that come here are empty.
    """
    found = f"regexp_extract({x}, {quote(pattern)}, {group})"
    return when(f"{x} RLIKE {quote(likely)}", f"try_cast({found} AS {kind})")


def price_number(x: Sql) -> Sql:
    """Leading number of a price text once all but digits and dots is gone."""
    digits = f"regexp_replace({x}, '[^0-9.]', '')"
    amount = f"try_cast(regexp_extract({digits}, {quote(r'^[0-9]*\.?[0-9]*')}, 0) AS DOUBLE)"
    return when(f"{x} RLIKE '[0-9]'", amount)


def leading_number(x: Sql) -> Sql:
    """Leading decimal number with optional sign and exponent; null if none."""
    number = rf"^{WS}*([+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?)"
    return _number(x, rf"^{WS}*[+-]?\.?[0-9]", number, 1, "DOUBLE")


def leading_int(x: Sql) -> Sql:
    """Leading integer as ``parseInt`` reads it; null if none."""
    return _number(x, f"^{WS}*[+-]?[0-9]", f"^{WS}*([+-]?[0-9]+)", 1, "BIGINT")


def iso(ts: Sql) -> Sql:
    """UTC timestamp as ISO text with milliseconds."""
    # through microseconds since 1970: local time would be ambiguous when clocks change
    utc = f"timestampadd(MICROSECOND, unix_micros({ts}), TIMESTAMP_NTZ'1970-01-01')"
    return f"date_format({utc}, {quote("yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")})"


def json_or_null(x: Sql) -> Sql:
    """Parsed JSON, null where the text is not JSON or exceeds what a VARIANT holds.

    Of a key that an object repeats, the last value counts (see ``repeated_keys``).
    """
    return f"try_parse_json({x})"


def repeated_keys(spark) -> None:
    """Let JSON objects repeat a key, as browsers do; to be called where JSON is parsed."""
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
