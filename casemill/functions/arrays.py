"""Array expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def let(value: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn(value)`` with ``value`` evaluated once per row, however often ``fn`` uses it. Without this the
    optimizer may put the whole expression of a derived array in every place that reads an element."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def counted(values: Column) -> Column:
    """``array<struct<term, n>>``: each value of an array and how often it occurs, in the order of the values."""
    def runs(s: Column) -> Column:
        begins = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)))
        return let(begins, lambda b: F.transform(b, lambda i, k: F.struct(
            F.get(s, i).alias("term"), (F.coalesce(F.get(b, k + 1), F.size(s)) - i).cast("long").alias("n"))))

    return F.when(F.size(values) > 0, let(F.sort_array(values), runs))


def key_of(*columns: Column) -> Column:
    """The key of a sorted table: values of any orderable type, null, NaN and -0.0 compared as grouping does."""
    return F.struct(*[c.alias(f"v{i}") for i, c in enumerate(columns)])


def sorted_match(table: Column, n: int, key: Column) -> Column:
    """The element with key ``k`` of an array of ``n`` structs, which ascends by ``k``; null if there is none. A binary search,
    in the types of the key."""
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(n.bit_length()))]).cast("array<int>")

    def search(t: Column) -> Column:
        def step(below: Column, width: Column) -> Column:
            at = below + width
            return F.when((at <= n) & (F.get(t, at - 1)["k"] <= key), at).otherwise(below)

        def found(below: Column) -> Column:
            last = F.get(t, below - 1)
            return F.when((below > 0) & last["k"].eqNullSafe(key), last)

        return let(F.aggregate(steps, F.lit(0), step), found)

    return let(table, search)
