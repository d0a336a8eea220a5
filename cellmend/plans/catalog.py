"""The registry of queries and what they share."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from textwrap import dedent

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Query
    oracle: str | None


CATALOG: dict[str, Entry] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without ``oracle`` only its rows are checked."""
    def register(run: Query) -> Query:
        if name in CATALOG:
            raise ValueError(f"query {name} is registered twice")
        CATALOG[name] = Entry(run, dedent(oracle).strip() if oracle else None)
        return run
    return register


def queries() -> dict[str, Query]:
    return {name: entry.run for name, entry in CATALOG.items()}


def oracles() -> dict[str, str]:
    return {name: entry.oracle for name, entry in CATALOG.items() if entry.oracle}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- Derived dirt -------------------------------------------------------------
# The test tables are clean, so both engines derive the same messy text from a
# key. These expressions are valid in Spark SQL and in the oracle's SQL alike.

def padded(key: str, width: int) -> str:
    return f"lpad(CAST({key} AS STRING), {width}, '0')"


def dirty_phone(key: str) -> str:
    area, line = padded(f"200 + {key} % 700", 3), padded(f"{key} % 10000", 4)
    return (f"CASE {key} % 7 WHEN 0 THEN concat('(', {area}, ') 555-', {line}) "
            f"WHEN 1 THEN concat('+1', {area}, '.555.', {line}) "
            f"WHEN 2 THEN concat(' ', {area}, ' 555 ', {line}, ' ') "
            f"WHEN 3 THEN '123' "
            f"WHEN 4 THEN concat('+91 98', {area}, '5', {line}) "
            f"WHEN 5 THEN concat('9198', {area}, '5', {line}) END")


def dirty_email(key: str) -> str:
    return (f"CASE {key} % 5 WHEN 0 THEN concat('User', CAST({key} AS STRING), '@Example.com') "
            f"WHEN 1 THEN concat('user', CAST({key} AS STRING), '@site.xyz') "
            f"WHEN 2 THEN 'bad' WHEN 3 THEN concat(' u', CAST({key} AS STRING), '@mail.co.uk ') "
            f"ELSE '' END")


def dirty_money(key: str) -> str:
    whole = f"CAST({key} % 900 + 100 AS STRING)"
    return (f"CASE {key} % 8 WHEN 0 THEN concat('$1,', {whole}, '.50') "
            f"WHEN 1 THEN concat('(', {whole}, '.00)') WHEN 2 THEN concat('-', {whole}) "
            f"WHEN 3 THEN 'n/a' WHEN 4 THEN concat('€', {whole}) "
            f"WHEN 5 THEN concat('$-', {whole}) WHEN 6 THEN concat(' ', {whole}, 'e-3') "
            f"ELSE concat({whole}, '-') END")


def dirty_percent(key: str) -> str:
    return (f"CASE {key} % 5 WHEN 0 THEN concat(CAST({key} % 120 AS STRING), '.5%') "
            f"WHEN 1 THEN concat('about ', CAST({key} % 90 AS STRING), ' %') "
            f"WHEN 2 THEN 'abc' WHEN 3 THEN concat('-', CAST({key} % 10 AS STRING)) ELSE '0' END")


def dirty_date(key: str) -> str:
    year, month = padded(f"1990 + {key} % 40", 4), padded(f"1 + {key} % 12", 2)
    day, late = padded(f"1 + {key} % 28", 2), padded(f"13 + {key} % 16", 2)
    return (f"CASE {key} % 7 WHEN 0 THEN concat({year}, '-', {month}, '-', {day}) "
            f"WHEN 1 THEN concat({month}, '/', {day}, '/', {year}) "
            f"WHEN 2 THEN concat({late}, '-', {month}, '-', {year}) "
            f"WHEN 3 THEN '02-30-2024' WHEN 4 THEN '' "
            f"WHEN 5 THEN concat({day}, '/', CAST(1 + {key} % 9 AS STRING), '-', {year}) "
            f"ELSE concat({year}, '/', {month}, '-30') END")


def dirty_zip(key: str) -> str:
    return (f"CASE {key} % 4 WHEN 0 THEN {padded(f'{key} % 100000', 5)} "
            f"WHEN 1 THEN concat({padded(f'{key} % 100000', 5)}, '-6789') "
            f"WHEN 2 THEN '1234' ELSE concat(' ', {padded(f'{key} % 100000', 5)}, ' ') END")


def dirty_address(key: str) -> str:
    number = f"CAST({key} AS STRING)"
    return (f"CASE {key} % 5 WHEN 0 THEN concat({number}, ' Main St.') "
            f"WHEN 1 THEN concat({number}, '   oak AVE apt 3') "
            f"WHEN 2 THEN concat('No.5 Elm rd ', {number}) "
            f"WHEN 3 THEN concat(' Dr Stone Blvd, suite ', {number}, ' ') ELSE ' ' END")


def dirty_name(key: str) -> str:
    number = f"CAST({key} AS STRING)"
    return (f"CASE {key} % 6 WHEN 0 THEN concat('DR.  SMITH jr', {number}) "
            f"WHEN 1 THEN 'mary-jane  o''brien' WHEN 2 THEN concat('it''s ', {number}) "
            f"WHEN 3 THEN {number} WHEN 4 THEN 'Mr. Ann (Architect) LEE' ELSE '  ' END")


def dirty_null(key: str, value: str) -> str:
    """Every third row holds one of the spellings of "no value"."""
    return (f"CASE WHEN {key} % 3 <> 0 THEN {value} ELSE CASE {key} % 13 WHEN 0 THEN '' "
            f"WHEN 1 THEN ' NaN ' WHEN 2 THEN 'None' WHEN 3 THEN 'NULL' WHEN 4 THEN 'na' "
            f"WHEN 5 THEN 'N/A' WHEN 6 THEN '#n/a' WHEN 7 THEN 'nil' WHEN 8 THEN '-' "
            f"WHEN 9 THEN '--' WHEN 10 THEN ',' WHEN 11 THEN 'n a' END END")


def dirty_mixed(key: str) -> str:
    """Mostly whole numbers, with decimals, words and odd spellings."""
    number = f"CAST({key} AS STRING)"
    return (f"CASE {key} % 11 WHEN 0 THEN 'x' WHEN 1 THEN concat({number}, '.25') "
            f"WHEN 2 THEN '1,234' WHEN 3 THEN concat('-', {number}) WHEN 4 THEN '+5' "
            f"WHEN 5 THEN '1e5' WHEN 6 THEN '.5' WHEN 7 THEN '' ELSE {number} END")
