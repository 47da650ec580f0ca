"""Joins of solution tables on their shared variables.

An unbound (NULL) shared variable is compatible with every value and the output takes the bound side.  Shared variables
that are always bound use plain equi-joins.  Where NULLs can occur, each row is tagged with its *mask* (which shared variables
it binds) and copied once for each mask of the other side; one equi-join on the pair of masks and on the variables that both
of them bind then finds every partner once, in one pass over each input.  Only rows that have no commonly bound variable at
all form a product, because that product is the result; it is dealt over a grid of cells.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from graphloom.plans.skew import spread_join


def shared(left: DataFrame, right: DataFrame) -> list[str]:
    return [c for c in left.columns if c in right.columns]


def natural_join(left: DataFrame, right: DataFrame, spread: bool = False) -> DataFrame:
    """Join on all shared variables, which must be bound; a product if there is none.

    With ``spread`` values that very many rows of both sides share are dealt over many tasks.
    """
    on = shared(left, right)
    if on and spread:
        return spread_join(left, right, on)
    return left.join(right, on=on, how="inner") if on else product(left, right)


def product(left: DataFrame, right: DataFrame) -> DataFrame:
    """Cartesian product of unconnected patterns."""
    if shared(left, right):
        raise ValueError("a product needs disjoint variables")
    return left.crossJoin(right)


def _nullable(left: DataFrame, right: DataFrame, on: Sequence[str], given) -> list[str]:
    if given is not None:
        return [c for c in on if c in given]
    return [c for c in on if left.schema[c].nullable or right.schema[c].nullable]


def _subsets(columns: Sequence[str]) -> list[tuple[str, ...]]:
    return [s for n in range(len(columns), -1, -1) for s in combinations(columns, n)]


def _masks(df: DataFrame, optional: Sequence[str]) -> list[tuple[str, ...]]:
    """Which sets of optional columns are bound together in some row.

    Up to two columns all sets are taken as possible: at most four copies of a row cost less than a pass over the input.
    With more, one aggregate pass finds the few that occur; its result has at most 2^columns rows.
    """
    if len(optional) <= 2:
        return _subsets(optional)
    bits = F.array(*[F.col(c).isNotNull() for c in optional])
    found = df.select(bits.alias("bits")).distinct().collect()
    return [tuple(c for c, bit in zip(optional, row["bits"]) if bit) for row in found]


#: Cells of a product of rows without common variables: GRID by GRID.
GRID = 16


class _Plan:
    """The mask pairs of one compatible join.  A mask is an integer with a bit for each optional shared variable."""

    def __init__(self, left: DataFrame, right: DataFrame, nullable):
        self.left, self.right = left, right
        self.on = shared(left, right)
        self.optional = _nullable(left, right, self.on, nullable)
        self.sure = [c for c in self.on if c not in self.optional]
        self.trivial = not self.optional
        self.may_lack = {
            side: [c for c in self.optional if nullable is not None or df.schema[c].nullable] for side, df in (("l", left), ("r", right))}
        self.masks = {}

    def _find_masks(self) -> None:
        for side, df in (("l", self.left), ("r", self.right)):
            always = sum(self._bit(c) for c in self.optional if c not in self.may_lack[side])
            # An empty side keeps one mask, so the other side keeps its rows.
            self.masks[side] = [always + sum(map(self._bit, m)) for m in _masks(df, self.may_lack[side])] or [always]

    def _bit(self, column: str) -> int:
        return 1 << self.optional.index(column)

    def tagged(self, df: DataFrame, side: str, grid: bool = False) -> DataFrame:
        """A copy of each row for each mask of the other side, with the pair of masks and the variables that both bind.

        With ``grid`` pairs without any common variable are dealt to cells by a hash of the row.
        """
        if not self.masks:
            self._find_masks()
        other = "r" if side == "l" else "l"
        own = sum((F.when(F.col(c).isNotNull(), self._bit(c)).otherwise(0) if c in self.may_lack[side] else F.lit(self._bit(c))
                   for c in self.optional), F.lit(0))
        out = df.withColumn(f"__m{side}", own).withColumn(f"__m{other}", F.explode(F.array(*[F.lit(m) for m in self.masks[other]])))
        common = F.col("__ml").bitwiseAND(F.col("__mr"))
        for n, c in enumerate(self.optional):
            out = out.withColumn(f"__k{n}", F.when(common.bitwiseAND(F.lit(self._bit(c))) != 0, F.col(c)))
        if not self.sure and grid:
            # The row's own coordinate is fixed, the other one runs over the grid.
            mine = F.pmod(F.xxhash64(*df.columns), F.lit(GRID)).cast("int")
            cells = F.when(common == 0, F.sequence(F.lit(0), F.lit(GRID - 1))).otherwise(F.array(F.lit(0)))
            out = out.withColumn(f"__c{side}", F.when(common == 0, mine).otherwise(0)).withColumn(f"__c{other}", F.explode(cells))
        return out

    def keys(self, grid: bool = False) -> list[str]:
        return ["__ml", "__mr", *[f"__k{n}" for n in range(len(self.optional))], *(["__cl", "__cr"] if grid and not self.sure else [])]


def _meet(rows: DataFrame, others: DataFrame, keys: Sequence[str], sure: Sequence[str], how: str) -> DataFrame:
    """Join on tags (``others`` has them with a prefix); a variable that is not compared is NULL on both sides."""
    same = [F.col(k).eqNullSafe(F.col(f"__o{k}")) if k.startswith("__k") else F.col(k) == F.col(f"__o{k}") for k in keys]
    return rows.join(others, reduce(Column.__and__, [*same, *[F.col(c) == F.col(f"__r_{c}") for c in sure]]), how)


def compat_join(left: DataFrame, right: DataFrame, nullable: Sequence[str] | None = None) -> DataFrame:
    """Inner join under compatibility.

    ``nullable`` names the shared variables that may be unbound; by default the schema decides.
    """
    plan = _Plan(left, right, nullable)
    if plan.trivial:
        return natural_join(left, right)
    extra, keys = [c for c in right.columns if c not in plan.on], plan.keys(grid=True)
    others = plan.tagged(right, "r", grid=True).select(
        *[F.col(c).alias(f"__r_{c}") for c in plan.on], *extra, *[F.col(k).alias(f"__o{k}") for k in keys])
    joined = _meet(plan.tagged(left, "l", grid=True), others, keys, plan.sure, "inner")
    return joined.select(*[F.coalesce(c, f"__r_{c}").alias(c) if c in plan.optional else F.col(c) for c in left.columns], *extra)


def _one_row(df: DataFrame) -> DataFrame:
    return df.limit(1).select(F.lit(1).alias("__any"))


def _drop_matching(part: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``part`` without a partner in ``other`` on ``keys``; no keys means ``other`` must be empty."""
    if keys:
        return part.join(other.select(*keys), on=list(keys), how="left_anti").select(part.columns)
    return part.join(_one_row(other), F.lit(True), "left_anti")


def _flagged(plan: _Plan, name: str, need_common: bool) -> DataFrame:
    """Left rows with a flag: is there a compatible right row (one that shares a bound variable if ``need_common``).

    Every left row has one copy for each right mask, and equal rows fare alike.  So the copies of equal rows are put
    together again by their content: no row number that a repeated task might give differently.
    """
    keys = plan.keys()
    others = plan.tagged(plan.right, "r")
    if need_common and not plan.sure:
        others = others.where(F.col("__ml").bitwiseAND(F.col("__mr")) != 0)
    others = others.select(*[F.col(c).alias(f"__r_{c}") for c in plan.sure], *[F.col(k).alias(f"__o{k}") for k in keys]).distinct().withColumn("__hit", F.lit(True))
    copies = _meet(plan.tagged(plan.left, "l"), others, keys, plan.sure, "left")
    rows = copies.groupBy(*plan.left.columns).agg(F.coalesce(F.bool_or("__hit"), F.lit(False)).alias(name), F.count(F.lit(1)).alias("__copies"))
    each = F.sequence(F.lit(1).cast("bigint"), F.floor(F.col("__copies") / len(plan.masks["r"])))
    return rows.withColumn("__copy", F.explode(each)).select(*plan.left.columns, name)


def _without_partner(plan: _Plan, need_common: bool) -> DataFrame:
    """Left rows without a compatible right row (one that shares a bound variable if ``need_common``)."""
    return _flagged(plan, "__hit_any", need_common).where("not __hit_any").drop("__hit_any")


def optional_join(left: DataFrame, right: DataFrame, nullable: Sequence[str] | None = None) -> DataFrame:
    """OPTIONAL: keep left rows without a partner, with the right variables unbound."""
    plan = _Plan(left, right, nullable)
    if not plan.on:
        return neutral_optional(left, right)
    if plan.trivial:
        return left.join(right, on=plan.on, how="left")
    matched = compat_join(left, right, nullable)
    return matched.unionByName(_without_partner(plan, need_common=False), allowMissingColumns=True)


def neutral_optional(left: DataFrame, right: DataFrame) -> DataFrame:
    """OPTIONAL without shared variables: every left row with every right row, or with nothing if right is empty."""
    # The product can be split into tasks; a left join on TRUE would send the whole right side to every task.
    alone = _drop_matching(left, right, [])
    return left.crossJoin(right).unionByName(alone, allowMissingColumns=True)


def minus(left: DataFrame, right: DataFrame, nullable: Sequence[str] | None = None) -> DataFrame:
    """MINUS: drop left rows with a compatible right row that agrees on at least one bound variable."""
    plan = _Plan(left, right, nullable)
    if not plan.on:
        return left
    if plan.trivial:
        return _drop_matching(left, right, plan.on)
    return _without_partner(plan, need_common=True)


def where_exists(left: DataFrame, right: DataFrame, nullable: Sequence[str] | None = None) -> DataFrame:
    """FILTER EXISTS: keep left rows with a compatible right row; unbound is a match."""
    plan = _Plan(left, right, nullable)
    if not plan.on:
        return left.join(_one_row(right), F.lit(True), "left_semi")
    if plan.trivial:
        return left.join(right.select(plan.on), on=plan.on, how="left_semi").select(left.columns)
    return exists_flag(left, right, "__hit", nullable).where("__hit").drop("__hit")


def where_not_exists(left: DataFrame, right: DataFrame, nullable: Sequence[str] | None = None) -> DataFrame:
    """FILTER NOT EXISTS."""
    plan = _Plan(left, right, nullable)
    if not plan.on:
        return _drop_matching(left, right, [])
    if plan.trivial:
        return _drop_matching(left, right, plan.on)
    return _without_partner(plan, need_common=False)


def exists_flag(left: DataFrame, right: DataFrame, name: str, nullable: Sequence[str] | None = None) -> DataFrame:
    """EXISTS as a boolean column that expressions can use."""
    plan = _Plan(left, right, nullable)
    if not plan.on:
        hit = _one_row(right).select(F.lit(True).alias("__any"))
        return left.join(hit, F.lit(True), "left").select(*left.columns, F.col("__any").isNotNull().alias(name))
    if plan.trivial:
        hits = right.select(plan.on).dropDuplicates().withColumn("__any", F.lit(True))
        return left.join(hits, plan.on, "left").select(*left.columns, F.col("__any").isNotNull().alias(name))
    return _flagged(plan, name, need_common=False)
