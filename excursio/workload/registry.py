"""Registration of queries and the SQL dialect both engines share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from excursio.sources.pages import spread

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

_SPARK = {
    "list": "array", "texts": "ARRAY<STRING>", "join": "array_join", "string": "STRING",
    "range": "sequence", "each": "transform", "md5": "md5", "raw": "r",
}
_ORACLE = {
    "list": "list_value", "texts": "VARCHAR[]", "join": "array_to_string", "string": "VARCHAR",
    "range": "generate_series", "each": "list_transform", "md5": "md5", "raw": "",
}


def query(name: str, oracle: str | None = None):
    """Register a query under a name, with its oracle SQL if there is one."""
    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cores(spark: SparkSession) -> int:
    """Partitions for the small test tables, which have few splits."""
    return spark.sparkContext.defaultParallelism


def pick(number: str, *values: str) -> str:
    """SQL value chosen by a number; the same text in both engines."""
    arms = " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values))
    return f"CASE ({number}) % {len(values)} {arms} END"


def spark_facts(template: str, spark: SparkSession, sf_dir: str, *names: str, deal: str | None = None) -> DataFrame:
    """Run a shared SELECT on Spark; ``{t:name}`` marks the tables.

    ``deal`` names the column by which a table of few splits is dealt out: its few columns
    move, not the wide rows made of them.
    """
    text = template
    for key, value in _SPARK.items():
        text = text.replace(f"<{key}>", value)
    text = text.replace("{", "{{").replace("}", "}}")
    frames = {}
    for name in names:
        text = text.replace(f"<t:{name}>", "{" + name + "}")
        rows = table(spark, sf_dir, name)
        frames[name] = rows if deal is None else spread(rows, 4 * cores(spark), deal)
    return spark.sql(text, **frames)


def oracle_facts(template: str, *names: str) -> str:
    """The same SELECT for the oracle."""
    text = template
    for key, value in _ORACLE.items():
        text = text.replace(f"<{key}>", value)
    for name in names:
        text = text.replace(f"<t:{name}>", name)
    return text


def each_row(df: DataFrame, items: str, name: str) -> DataFrame:
    """One row per element, with ``pos``.

    The outer form, because for the plain one the optimizer first filters on the
    size of the array and so works out the array twice.
    """
    return df.select("page_id", F.posexplode_outer(items).alias("pos", name)).filter(
        F.col(name).isNotNull()
    )


def hash32_sql(x: str) -> str:
    """Oracle form of the 32-bit hash."""
    return f"CAST('0x' || substr(md5({x}), 1, 8) AS BIGINT)"


WS_SQL = (
    r"[\x{09}-\x{0D} \x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]+"
)


def clean_sql(x: str) -> str:
    """Oracle form of white-space cleaning."""
    return f"trim(regexp_replace(coalesce({x}, ''), '{WS_SQL}', ' ', 'g'))"


def title_sql(x: str) -> str:
    """Oracle form of title case."""
    runs = f"regexp_extract_all(replace({x}, '-', ' '), '[A-Za-z0-9_]+|[^A-Za-z0-9_]+')"
    return (
        f"array_to_string(list_transform({runs}, lambda w: CASE WHEN regexp_matches(w, '^[a-z]') "
        f"THEN upper(w[1]) || w[2:] ELSE w END), '')"
    )


def first_sql(*options: str) -> str:
    """Oracle form of the fallback chain."""
    return "coalesce(" + ", ".join(f"nullif({o}, '')" for o in options) + ", '')"


def distinct_sql(source: str, key: str, pos: str, value: str, sep: str) -> str:
    """Aggregate: first occurrences of ``value`` per key in order, joined.

    ``source`` must yield key, pos, value columns.
    """
    return (
        f"SELECT {key}, string_agg({value}, '{sep}' ORDER BY {pos}) AS joined FROM ("
        f"SELECT *, row_number() OVER (PARTITION BY {key}, {value} ORDER BY {pos}) AS seen "
        f"FROM ({source})) WHERE seen = 1 GROUP BY {key}"
    )
