"""Declarative data tests: each yields (test_name, table_name, column_name, failures).

The functions of one test each serve a single table. ``run_tests`` folds any number of tests over any number of tables into one
grouped count, so that every table is read once whatever is asked of it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _result(df: DataFrame, test: str, table: str, column: str, failures: Column) -> DataFrame:
    return df.agg(F.coalesce(failures, F.lit(0)).cast("long").alias("failures")).select(
        F.lit(test).alias("test_name"), F.lit(table).alias("table_name"),
        F.lit(column).alias("column_name"), "failures")


def unique(df: DataFrame, table: str, column: str) -> DataFrame:
    """Number of non-null values that occur more than once."""
    per_value = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return _result(per_value, "unique", table, column, F.count_if(F.col("n") > 1))


def not_null(df: DataFrame, table: str, column: str) -> DataFrame:
    return _result(df, "not_null", table, column, F.count_if(F.col(column).isNull()))


def accepted_values(df: DataFrame, table: str, column: str, values: Sequence[str]) -> DataFrame:
    """Rows with a value outside the list; null passes."""
    return _result(df, "accepted_values", table, column, F.count_if(~F.col(column).isin(*values)))


def relationship(child: DataFrame, table: str, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Rows whose non-null foreign key has no parent.

    The child is first counted per key, so a hot key crosses the network once
    per task and the anti-join sees each key a single time.
    """
    per_key = child.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("_k")).agg(F.count("*").alias("n"))
    orphans = per_key.join(parent.select(F.col(key).alias("_k")), "_k", "left_anti")
    return _result(orphans, "relationships", table, column, F.sum("n"))


def duplicates(df: DataFrame, table: str, column: str) -> DataFrame:
    """Rows beyond the distinct non-null values of a column."""
    per_value = df.groupBy(column).agg(F.count("*").alias("n"))
    return _result(per_value, "no_duplicates", table, column, F.sum("n") - F.count(column))


def negative(df: DataFrame, table: str, column: str) -> DataFrame:
    return _result(df, "not_negative", table, column, F.count_if(F.col(column) < 0))


def orphans(child: DataFrame, table: str, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Rows whose foreign key has no parent; a null key counts as an orphan."""
    per_key = child.groupBy(F.col(column).alias("_k")).agg(F.count("*").alias("n"))
    lost = per_key.join(parent.select(F.col(key).alias("_k")), "_k", "left_anti")
    return _result(lost, "no_orphans", table, column, F.sum("n"))


def report(results: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, results)


@dataclass(frozen=True)
class Test:
    """A test to be folded: ``parent`` is (table, key) for relationships and orphans, ``values`` the accepted ones."""

    __test__ = False  # not a test class of the test runner

    kind: str
    table: str
    column: str
    parent: tuple[str, str] | None = None
    values: tuple[str, ...] = ()


BY_ROW = {  # tests that look at one row
    "accepted_values": lambda t: ~F.col(t.column).isin(*t.values),
    "not_negative": lambda t: F.col(t.column) < 0,
}


def _domains(tests: Sequence[Test]) -> dict[tuple[str, str], str]:
    """Columns whose values are compared with each other get the same name."""
    name: dict[tuple[str, str], str] = {}
    for t in tests:
        if t.kind not in BY_ROW:
            ends = [(t.table, t.column)] + ([t.parent] if t.parent else [])
            known = {name.setdefault(e, ".".join(e)) for e in ends}
            for column, domain in name.items():
                if domain in known:
                    name[column] = min(known)
    return name


def run_tests(table: Callable[[str], DataFrame], tests: Sequence[Test]) -> DataFrame:
    """(test_name, table_name, column_name, failures) of all tests, from one grouped count over all tables.

    Every tested column sends its values to its domain, the values it is compared with; a row that fails a test of its own sends
    one mark. How often each column holds each value of its domain then answers uniqueness, nulls, duplicates and relationships alike,
    without a join. Counts combine before the exchange, so a hot or null key travels once per task; a group has one count for each
    column of the largest domain, however many columns are tested.
    """
    domain = _domains(tests)
    number = {name: k for k, name in enumerate(sorted(set(domain.values())))}
    # a column's place among those of its domain: a value is held with as many counts as its domain has columns at most
    place: dict[tuple[str, str], int] = {}
    for column, name in domain.items():
        place[column] = sum(domain[c] == name for c in place)
    marks, sent = len(number), {}

    def entry(at: int, value: Column, column: int) -> Column:
        return F.struct(F.lit(at).alias("domain"), value.alias("value"), F.lit(column).alias("place"))

    for column, name in domain.items():
        sent.setdefault(column[0], []).append(entry(number[name], F.col(column[1]).cast("string"), place[column]))
    for k, t in enumerate(tests):
        if t.kind in BY_ROW:
            sent.setdefault(t.table, []).append(F.when(BY_ROW[t.kind](t), entry(marks, F.lit(str(k)), 0)))
    rows = reduce(DataFrame.unionByName, [
        table(name).select(F.explode(F.array(*entries)).alias("e")).where("e is not null").select("e.*") for name, entries in sent.items()])
    counts = [F.count_if(F.col("place") == p).alias(f"r{p}") for p in range(max(place.values(), default=0) + 1)]
    held = rows.groupBy("domain", "value").agg(*counts)

    def failures(k: int, t: Test) -> Column:
        if t.kind in BY_ROW:
            return F.sum(F.when((F.col("domain") == marks) & (F.col("value") == str(k)), F.col("r0")))
        column = t.table, t.column
        here, mine, null = F.col("domain") == number[domain[column]], F.col(f"r{place[column]}"), F.col("value").isNull()
        if t.kind == "unique":
            return F.count_if(here & ~null & (mine > 1))
        if t.kind == "not_null":
            return F.sum(F.when(here & null, mine))
        if t.kind == "no_duplicates":
            return F.sum(F.when(here, mine)) - F.count_if(here & ~null & (mine > 0))
        lost = F.col(f"r{place[t.parent]}") == 0
        return F.sum(F.when(here & (~null & lost if t.kind == "relationships" else null | lost), mine))

    one = held.agg(*[F.coalesce(failures(k, t), F.lit(0)).cast("long").alias(f"t{k}") for k, t in enumerate(tests)])
    told = [F.struct(F.lit(t.kind).alias("test_name"), F.lit(t.table).alias("table_name"), F.lit(t.column).alias("column_name"),
                     F.col(f"t{k}").alias("failures")) for k, t in enumerate(tests)]
    return one.select(F.inline(F.array(*told)))
