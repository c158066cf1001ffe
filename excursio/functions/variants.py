"""Typed values out of a VARIANT, whatever stands in it: SQL text in, SQL text out."""

from __future__ import annotations

from pyspark.sql import types as T

from excursio.functions.sql import Sql, each, let, quote, struct, when

_NESTED = "'^(OBJECT|ARRAY)'"


def at(v: Sql, path: str) -> Sql:
    """What stands at a path, as VARIANT; null where the path leads nowhere."""
    return v if path == "$" else f"variant_get({v}, {quote(path)})"


def kind(v: Sql, path: str = "$") -> Sql:
    """Name of the JSON type, such as OBJECT<...>, ARRAY<...>, STRING; of a missing value null."""
    return f"schema_of_variant({at(v, path)})"


def is_list(v: Sql, path: str = "$") -> Sql:
    return f"coalesce({kind(v, path)} LIKE 'ARRAY%', false)"


def is_text(v: Sql, path: str = "$") -> Sql:
    return f"coalesce({kind(v, path)} = 'STRING', false)"


def is_number(v: Sql, path: str = "$") -> Sql:
    return f"coalesce({kind(v, path)} RLIKE '^(BIGINT|DECIMAL|DOUBLE|FLOAT)', false)"


def given(v: Sql, path: str = "$") -> Sql:
    """Neither missing nor null, nor an empty text, nor 0 or false, which all count as missing."""
    plain = f"try_variant_get({v}, {quote(path)}, 'string')"
    zero = f"({is_number(v, path)} AND try_variant_get({v}, {quote(path)}, 'double') = 0)"
    off = f"({kind(v, path)} = 'BOOLEAN' AND {plain} = 'false')"
    return f"coalesce({plain} <> '' AND NOT {zero} AND NOT {off}, false)"


def scalar(v: Sql, path: str = "$") -> Sql:
    """A text as it is, a number or true as text; 0, false, objects and lists count as missing."""
    plain = f"try_variant_get({v}, {quote(path)}, 'string')"
    return when(is_text(v, path), plain, when(f"NOT coalesce({kind(v, path)} RLIKE {_NESTED}, true) AND {given(v, path)}", plain))


def listed(v: Sql, path: str = "$") -> Sql:
    """Elements of a list as ARRAY<VARIANT>; null for anything else."""
    return f"try_variant_get({v}, {quote(path)}, 'array<variant>')"


def opened(v: Sql, names: list[str], kinds: dict[str, str] | None = None) -> Sql:
    """Fields of an object as a struct, in one pass over it; null for anything else.

    A field is a VARIANT unless ``kinds`` names another type; what does not fit that type is null.
    """
    fields = ", ".join(f"`{n}`: {(kinds or {}).get(n, 'variant')}" for n in names)
    return f"try_variant_get({v}, '$', {quote(f'struct<{fields}>')})"


def typed(v: Sql, to: T.DataType) -> Sql:
    """A VARIANT as a type; what does not fit counts as missing, its neighbours stay."""
    if isinstance(to, T.VariantType):
        return v
    if isinstance(to, T.StringType):
        return scalar(v)
    if isinstance(to, T.ArrayType):
        if isinstance(to.elementType, T.VariantType):
            return listed(v)
        return each(listed(v), lambda e: typed(e, to.elementType))
    if isinstance(to, T.MapType):
        whole = f"try_variant_get({v}, '$', 'map<string,variant>')"
        if isinstance(to.valueType, T.VariantType):
            return whole
        entries = each(f"map_entries({whole})", lambda e: struct(key=f"{e}.key", value=typed(f"{e}.value", to.valueType)))
        return f"map_from_entries({entries})"
    if isinstance(to, T.StructType):
        return let(opened(v, to.fieldNames()), lambda o: typed_fields(o, to))
    return f"try_variant_get({v}, '$', {quote(to.simpleString())})"


def typed_fields(o: Sql, to: T.StructType, own: dict[str, Sql] | None = None) -> Sql:
    """An object that is ``opened`` as a struct of types. ``own`` has expressions for fields with rules of their own."""
    fields = {f.name: (own or {}).get(f.name) or typed(f"{o}.`{f.name}`", f.dataType) for f in to.fields}
    return when(f"{o} IS NOT NULL", struct(**fields))
