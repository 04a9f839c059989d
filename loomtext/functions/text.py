"""Column functions on text: sizes, white space, lines, identifiers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def once(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is worked out a single time, also where f uses it often or inside another function's lambda."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def tokens(text: str | Column) -> Column:
    """The default token measure: UTF-8 bytes divided by 3, rounded down; null counts as empty."""
    return F.floor(F.octet_length(F.coalesce(_c(text), F.lit(""))) / 3).cast("long")


def strip(text: str | Column) -> Column:
    """Without Unicode white space at either end."""
    return F.regexp_replace(_c(text), r"(?U)^\s+|\s+$", "")


def rstrip(text: str | Column) -> Column:
    return F.regexp_replace(_c(text), r"(?U)\s+$", "")


def newlines(text: str | Column) -> Column:
    """CRLF and CR as LF."""
    return F.regexp_replace(_c(text), r"\r\n?", "\n")


def lines(text: str | Column) -> Column:
    return F.split(_c(text), "\n", -1)


def unlines(parts: str | Column) -> Column:
    return F.array_join(_c(parts), "\n")


def first_lines(text: str | Column, n: int) -> Column:
    return F.slice(lines(text), 1, n)


def item_id(text: str | Column) -> Column:
    """Item ids as file names have them: minus signs and の become -, ・ becomes _, 共 becomes _common."""
    return F.replace(F.translate(_c(text), "−－の・", "---_"), F.lit("共"), F.lit("_common"))


def to_api_num(article: str | Column) -> Column:
    return F.translate(_c(article), "-", "_")


def from_api_num(num: str | Column) -> Column:
    return F.translate(_c(num), "_", "-")


def url_key(text: str | Column) -> Column:
    """Percent-encoded, spaces as %20."""
    return F.replace(F.url_encode(_c(text)), F.lit("+"), F.lit("%20"))


def relative_url(url: str | Column, prefix: str) -> Column:
    """The url without the prefix, where it starts with it."""
    u = _c(url)
    return F.when(F.startswith(u, F.lit(prefix)), F.substr(u, F.lit(len(prefix) + 1))).otherwise(u)


def display_width(text: str | Column, least: int = 3) -> Column:
    return F.greatest(F.lit(least), F.length(_c(text)))


def shard_name(prefix: str, number: Column, total: Column) -> Column:
    """prefix-NN.txt with as many digits as the last number has, two at least."""
    digits = F.greatest(F.lit(2), F.length((total - 1).cast("string")))
    return F.concat(F.lit(prefix + "-"), F.lpad(number.cast("string"), digits, F.lit("0")), F.lit(".txt"))
