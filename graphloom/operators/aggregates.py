"""Aggregates over solution groups.

Unlike SQL, an unbound or non-numeric value makes SUM, AVG, STDEV, MIN and GROUP_CONCAT of its group unbound.  All of
them are compositions of Spark aggregates, so they combine map-side before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from graphloom.functions.compare import sort_key
from graphloom.functions.terms import XSD, _c, make_term, number_text


def group_by(df: DataFrame, keys: Sequence[str | Column], **aggregates: Column) -> DataFrame:
    """GROUP BY; an unbound key is a group of its own, and no keys give exactly one row."""
    columns = [a.alias(n) for n, a in aggregates.items()]
    return df.groupBy(*keys).agg(*columns) if keys else df.agg(*columns)


def having(grouped: DataFrame, condition: Column) -> DataFrame:
    return grouped.where(condition)


def _distinct(function: str, x, over_array) -> Column:
    """An aggregate of the distinct values.

    For a named column Spark removes duplicates before it aggregates.  For an expression, which has no name that SQL could
    use, the distinct values of a group are gathered and ``over_array`` works on them.
    """
    if isinstance(x, str):
        return F.expr(f"{function}(DISTINCT `{x.replace('`', '``')}`)")
    return over_array(F.collect_set(x))


def _doubles(values: Column) -> Column:
    return F.transform(values, lambda v: v.cast("double"))


def _added(values: Column) -> Column:
    return F.reduce(F.slice(values, 2, F.greatest(F.size(values), F.lit(1))), F.get(values, F.lit(0)), F.try_add)


def _average(values: Column) -> Column:
    return F.when(F.size(values) > 0, _added(values) / F.size(values))


def _spread(values: Column) -> Column:
    """Sample deviation in two passes, so that a large mean does not swallow it."""
    squares = F.transform(values, lambda v: F.pow(v - _average(values), F.lit(2.0)))
    return F.when(F.size(values) > 1, F.sqrt(_added(squares) / (F.size(values) - 1)))


def _complete(x: Column) -> Column:
    return F.count(x) == F.count(F.lit(1))


def count(x=None, distinct: bool = False) -> Column:
    """COUNT(expression): bound values only; COUNT(*) without an argument."""
    if x is None:
        return F.count(F.lit(1))
    return F.count_distinct(_c(x)) if distinct else F.count(_c(x))


def count_distinct_rows(df: DataFrame) -> Column:
    """COUNT(DISTINCT *) over the visible columns, rows with unbound cells included."""
    return F.count_distinct(F.struct(*[F.col(c) for c in df.columns]))


def total(x, distinct: bool = False) -> Column:
    """SUM: 0 for an empty group; an overflow of integers is unbound and never fails the job."""
    value = _distinct("try_sum", x, _added) if distinct else F.try_sum(_c(x))
    x = _c(x)
    return F.when(F.count(F.lit(1)) == 0, 0).when(_complete(x), value)


def mean(x, distinct: bool = False) -> Column:
    """AVG: 0 for an empty group."""
    value = _distinct("avg", x, lambda s: _average(_doubles(s))) if distinct else F.avg(_c(x))
    x = _c(x)
    return F.when(F.count(F.lit(1)) == 0, 0.0).when(_complete(x), value)


def minimum(x) -> Column:
    """MIN: unbound sorts lowest, so one unbound value makes the result unbound."""
    x = _c(x)
    return F.when(_complete(x), F.min(x))


def maximum(x) -> Column:
    return F.max(_c(x))


def term_minimum(term) -> Column:
    """MIN over TERM values in the order of ORDER BY."""
    term = _c(term)
    return F.when(_complete(term), F.min_by(term, sort_key(term)))


def term_maximum(term) -> Column:
    term = _c(term)
    return F.max_by(term, sort_key(term))


def term_total(term) -> Column:
    """SUM over TERM values: an integer if all are integers, a double otherwise; booleans count as 0/1."""
    term = _c(term)
    whole = F.coalesce(term["i"], term["b"].cast("bigint"))
    real = F.coalesce(term["d"], term["b"].cast("double"))
    all_whole = _complete(whole)
    i = F.when(all_whole, F.when(F.count(whole) == 0, F.lit(0)).otherwise(F.try_sum(whole)))
    d = F.coalesce(F.sum(real), F.lit(0.0))
    return F.when(
        _complete(real),
        F.when(all_whole, F.when(i.isNotNull(), make_term("lit", i.cast("string"), XSD + "integer", i=i, d=i.cast("double"))))
        .otherwise(make_term("lit", number_text(d), XSD + "double", d=d)),
    )


def term_mean(term) -> Column:
    """AVG over TERM values, as a double."""
    term = _c(term)
    return mean(F.coalesce(term["d"], term["b"].cast("double")))


def group_concat(x, separator: str = " ", distinct: bool = False) -> Column:
    """GROUP_CONCAT in value order, so the result does not depend on partitioning.

    The result is one cell per group by definition; DISTINCT removes duplicates map-side first.
    """
    x = _c(x)
    items = F.collect_set(x) if distinct else F.collect_list(x)
    return F.when(_complete(x), F.array_join(F.array_sort(items), separator))


def sample(x) -> Column:
    """SAMPLE: some value of the group."""
    return F.first(_c(x))


def sample_lowest(x) -> Column:
    """SAMPLE with a reproducible choice."""
    return F.min(_c(x))


def stdev(x, distinct: bool = False) -> Column:
    """STDEV (n-1): 0.0 for fewer than two values."""
    value = _distinct("stddev_samp", x, lambda s: _spread(_doubles(s))) if distinct else F.stddev_samp(_c(x))
    x = _c(x)
    return F.when(_complete(x), F.coalesce(value, F.lit(0.0)))
