"""Pages of a report by its sort keys (SRC-6): each page starts after the last row of the one before.

A page is a filter on the sort keys and a limit, so it plans as TakeOrderedAndProject and reads nothing that lies
before it in a sorted or partitioned table; no offset is counted. The token holds the last row's keys, so reading can
go on later, in another session. All other columns are appended to the keys, so rows that tie are equal; the token
also says how many rows equal to the last were given, so none is lost or repeated at a page's end.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

Keys = list[tuple[str, bool]]  # (column, descending); nulls last either way


def keyset(df: DataFrame, keys: Keys) -> Keys:
    """The keys with all other columns, ascending, appended: rows that tie in all of them are equal."""
    named = {k for k, _ in keys}
    return [*keys, *((c, False) for c in df.columns if c not in named)]


def _order(keys: Keys) -> list[Column]:
    return [F.col(k).desc_nulls_last() if down else F.col(k).asc_nulls_last() for k, down in keys]


def _value(df: DataFrame, key: str, value: str | None) -> Column:
    return F.lit(value).cast(df.schema[key].dataType)


def _after(df: DataFrame, keys: Keys, last: list[str | None]) -> Column:
    """Whether a row comes after the one with the keys ``last`` in the order, key by key."""
    steps, equal = [], F.lit(True)
    for (key, down), value in zip(keys, last):
        if value is not None:  # after a null there is nothing in this key
            own = _value(df, key, value)
            further = F.col(key) < own if down else F.col(key) > own
            steps.append(equal & (further | F.col(key).isNull()))
        equal = equal & F.col(key).eqNullSafe(_value(df, key, value))
    return F.coalesce(reduce(Column.__or__, steps), F.lit(False)) if steps else F.lit(False)


def _equal(df: DataFrame, keys: Keys, last: list[str | None]) -> Column:
    return reduce(Column.__and__, [F.col(k).eqNullSafe(_value(df, k, v)) for (k, _), v in zip(keys, last)])


def page(df: DataFrame, keys: Keys, size: int, token: str | None = None) -> DataFrame:
    """The next ``size`` rows in the order of ``keys`` after ``token``; the first rows without one."""
    keys = keyset(df, keys)
    if token is None:
        return df.orderBy(*_order(keys)).limit(size)
    at = json.loads(token)
    rows = df.where(_after(df, keys, at["last"]) | _equal(df, keys, at["last"])).orderBy(*_order(keys)).limit(size + at["given"])
    place = F.row_number().over(Window.orderBy(*_order(keys)))  # over the page's few rows; the rows given come first
    return rows.withColumn("__place", place).where(F.col("__place") > at["given"]).drop("__place").orderBy(*_order(keys))


def token_of(df: DataFrame, keys: Keys, rows: list[Row], before: str | None = None) -> str:
    """The token to go on after a page's ``rows``; ``before`` is the token the page was read with."""
    names = [k for k, _ in keyset(df, keys)]
    one = df.sparkSession.createDataFrame([tuple(rows[-1][n] for n in names)], df.select(*names).schema)
    last = list(one.select(*[F.col(n).cast("string") for n in names]).first())
    given = sum(r == rows[-1] for r in rows)
    if before is not None and given == len(rows) and json.loads(before)["last"] == last:
        given += json.loads(before)["given"]
    return json.dumps({"last": last, "given": given})


def pages(df: DataFrame, keys: Keys, size: int, token: str | None = None) -> Iterator[tuple[list[Row], str]]:
    """(rows, token) of one page after the other."""
    while rows := page(df, keys, size, token).collect():  # at most ``size`` rows
        token = token_of(df, keys, rows, token)
        yield rows, token
