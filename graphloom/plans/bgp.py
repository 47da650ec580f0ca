"""Basic graph patterns: joins of several triple patterns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from graphloom.functions.terms import canonical, typed
from graphloom.operators.joins import natural_join
from graphloom.operators.scan import as_quads, is_var, pattern
from graphloom.plans.property_paths import Path, edges
from graphloom.session import cut_lineage
from graphloom.sources.mapping import MappedGraph, TableMap


def _vars(triple: Sequence) -> set[str]:
    return {x for x in triple[:3] if is_var(x)}


def _size(triple: Sequence, counts: Mapping[str, int]) -> float:
    """Rough number of matches: the predicate's count, less for a constant subject or object."""
    size = float(counts.get(triple[1], max(counts.values(), default=1)))
    for position in (0, 2):
        if not is_var(triple[position]):
            size = size ** 0.5
    return size


def _connected(groups: Sequence[Sequence[Sequence]], counts: Mapping[str, int] | None) -> list:
    rest, ordered, seen = list(groups), [], set()
    names = lambda group: set().union(*map(_vars, group))
    rank = (lambda group: min(_size(t, counts) for t in group)) if counts else (lambda group: 0.0)
    while rest:
        linked = [g for g in rest if names(g) & seen] or rest
        best = min(linked, key=rank)
        rest.remove(best)
        ordered.append(best)
        seen |= names(best)
    return ordered


def join_order(triples: Sequence[Sequence], counts: Mapping[str, int] | None = None) -> list[Sequence]:
    """Smallest connected pattern next; without counts the given order, moved only to stay connected."""
    return [group[0] for group in _connected([[t] for t in triples], counts)]


def _row_groups(graph, triples: Sequence[Sequence]) -> list[list[Sequence]]:
    """Patterns on the same subject that one row of one mapped table answers belong together."""
    groups: dict = {}
    for n, triple in enumerate(triples):
        s, p, o = triple[:3]
        table = graph.owner(p) if isinstance(graph, MappedGraph) and is_var(s) and not is_var(p) and s != o else None
        key = (s, table.name, table.graph) if table is not None else n
        # A variable used twice within a row is an equality, which the join of separate patterns expresses.
        if any(is_var(o) and o == other[2] for other in groups.get(key, [])):
            key = n
        groups.setdefault(key, []).append(triple)
    return list(groups.values())


def bgp(graph, triples: Sequence[Sequence], counts: Mapping[str, int] | None = None, g: str | None = None) -> DataFrame:
    """Join of triple patterns ``(s, p, o)`` or ``(s, p, o, as_type)``; adaptive execution picks the join methods.

    A ``Path`` may stand for the predicate; what the patterns before it have bound seeds its repetitions, so plain
    patterns come first.  ``g`` is a constant graph or a variable: all patterns then match within one named graph.
    On a mapped graph the patterns that describe one row are one scan, so only joins between tables shuffle.
    """
    plain = [t for t in triples if not isinstance(t[1], Path)]
    paths = [t for t in triples if isinstance(t[1], Path)]
    groups = _row_groups(graph, plain) if g is None else [[t] for t in plain]
    result = None
    for group in _connected(groups, counts):
        if len(group) > 1:
            part = _row_scan(graph.owner(group[0][1]), group)
        else:
            triple = group[0]
            part = pattern(graph, *triple[:3], g=g, as_type=triple[3] if len(triple) > 3 else None)
        result = part if result is None else natural_join(result, part)
    for group in _connected([[t] for t in paths], None):
        result = _with_path(graph, result, group[0], g)
    return result


def _with_path(graph, result: DataFrame | None, triple: Sequence, g: str | None) -> DataFrame:
    s, path, o = triple[:3]
    known = result.columns if result is not None else []
    if result is not None and {s, o} & {f"?{c}" for c in known}:
        # The rows so far are read for the seeds and again for the join.
        result = cut_lineage(result, "bgp")
    bound = [x if not is_var(x) else result.select(x[1:]).distinct() if x[1:] in known else None for x in (s, o)]
    # One bound side is enough for a search; a graph variable keeps graphs apart by itself.
    start, end = bound if bound[0] is None or isinstance(bound[1], str) else (bound[0], None)
    part = edges(graph, path, g, start, end)
    if s == o:
        part = part.where("start = end")
    cells = {x[1:]: F.col(c) for c, x in (("start", s), ("end", o)) if is_var(x)}
    if g is not None and is_var(g):
        cells[g[1:]] = F.col(g[1:])
    part = part.select(*[c.alias(n) for n, c in cells.items()]) if cells else part.select(F.lit(True).alias("matched"))
    return part if result is None else natural_join(result, part)


def _row_scan(table: TableMap, group: Sequence[Sequence]) -> DataFrame:
    columns, rows, cells = table.columns(), table.df, []
    for triple in group:
        column, o = columns[triple[1]], triple[2]
        if not is_var(o):
            rows = rows.where(table.equals(column, o))
            continue
        rows = rows.where(F.col(column).isNotNull())
        term = table.term(column)
        as_type = triple[3] if len(triple) > 3 else None
        cells.append((typed(term, as_type) if as_type else canonical(term)).alias(o[1:]))
    return rows.select(table.subject().alias(group[0][0][1:]), *cells)


def star(graph, subject: str, predicates: Mapping[str, tuple[str, str | None]]) -> DataFrame:
    """Several predicates of one subject in one pass: one shuffle instead of one per predicate.

    ``predicates`` maps a predicate to ``(variable, as_type)``.  Subjects lacking a predicate drop out and several values
    give several rows, as in a join.  The values of one subject are gathered in one row before they are combined.
    """
    if isinstance(graph, MappedGraph):
        owners = [t for t in graph.tables if any(p in t.columns() for p in predicates)]
        if len(owners) == 1 and all(p in owners[0].columns() for p in predicates):
            return _row_star(owners[0], subject, predicates)
    quads = as_quads(graph, list(predicates))
    cells, names = [], []
    for predicate, (name, as_type) in predicates.items():
        value = typed(F.col("o_term"), as_type) if as_type else F.col("o")
        # A value that has not the type is unbound but there, so it is wrapped.
        cells.append(F.collect_list(F.when(F.col("p") == predicate, F.struct(value.alias("v")))).alias(name.lstrip("?")))
        names.append(name.lstrip("?"))
    rows = quads.groupBy(F.col("s").alias(subject.lstrip("?"))).agg(*cells)
    for name in names:
        rows = rows.withColumn(name, F.explode(name))
    return rows.select(subject.lstrip("?"), *[F.col(f"{n}.v").alias(n) for n in names])


def _row_star(table: TableMap, subject: str, predicates: Mapping[str, tuple[str, str | None]]) -> DataFrame:
    """A star on the rows of one mapped table is a projection: no shuffle at all."""
    subject = "?" + subject.lstrip("?")
    return _row_scan(table, [(subject, p, "?" + name.lstrip("?"), as_type) for p, (name, as_type) in predicates.items()])
