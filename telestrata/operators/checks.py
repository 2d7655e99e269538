"""Declarative data-quality checks.

A rule asks for named measures of one or more tables and states a condition over
them. ``run_checks`` gathers the measures of each table in one aggregate, brings
the few resulting numbers together in one row, and evaluates every condition
there. Only a uniqueness rule needs a second aggregate on its table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Measure:
    """One number about one table; ``keys`` asks for a count of repeated keys."""

    table: str
    name: str
    value: Column | None = None
    keys: tuple[str, ...] = ()

    @property
    def id(self) -> str:
        return f"{self.table}|{self.name}"


@dataclass(frozen=True)
class Rule:
    check: str
    layer: str
    observed: Column
    passed: Column
    expected: str
    measures: tuple[Measure, ...] = field(default=())


def _rows(table: str) -> Measure:
    return Measure(table, "rows", F.count(F.lit(1)))


def _ref(m: Measure) -> Column:
    return F.col(f"`{m.id}`")


def row_count(table: str, at_least: int | None = None, exactly: int | None = None) -> Rule:
    m = _rows(table)
    if exactly is not None:
        return Rule("row_count", table, _ref(m), _ref(m) == exactly, f"= {exactly}", (m,))
    least = 1 if at_least is None else at_least
    return Rule("row_count", table, _ref(m), _ref(m) >= least, f">= {least}", (m,))


def not_more_rows(table: str, than: str) -> Rule:
    """A later layer must not hold more rows than an earlier one."""
    a, b = _rows(table), _rows(than)
    return Rule(
        "not_more_rows", table, _ref(a) - _ref(b), _ref(a) <= _ref(b), f"<= {than}", (a, b)
    )


def unique(table: str, keys: Sequence[str]) -> Rule:
    m = Measure(table, f"repeated {','.join(keys)}", keys=tuple(keys))
    return Rule(f"unique({','.join(keys)})", table, _ref(m), _ref(m) == 0, "= 0", (m,))


def no_nulls(table: str, columns: Sequence[str]) -> list[Rule]:
    rules = []
    for c in columns:
        m = Measure(table, f"nulls {c}", F.count_if(F.col(c).isNull()))
        rules.append(Rule(f"no_nulls({c})", table, _ref(m), _ref(m) == 0, "= 0", (m,)))
    return rules


def in_range(table: str, column: str, low: float, high: float) -> Rule:
    bad = ~F.col(column).between(low, high)
    m = Measure(table, f"outside {column}", F.count_if(bad))
    return Rule(
        f"in_range({column})", table, _ref(m), _ref(m) == 0, f"{low}..{high}", (m,)
    )


def in_set(table: str, column: str, allowed: Sequence[str]) -> Rule:
    m = Measure(table, f"not allowed {column}", F.count_if(~F.col(column).isin(*allowed)))
    return Rule(
        f"in_set({column})", table, _ref(m), _ref(m) == 0, ",".join(allowed), (m,)
    )


def has_columns(table: str, df: DataFrame, columns: Sequence[str]) -> list[Rule]:
    """Columns that must exist; the observed number is how many rows fill them."""
    rules = []
    for c in columns:
        value = F.count(F.col(c)) if c in df.columns else F.lit(None).cast("bigint")
        m = Measure(table, f"filled {c}", value)
        rules.append(
            Rule(f"has_column({c})", table, _ref(m), _ref(m).isNotNull(), "present", (m,))
        )
    return rules


def lacks_columns(table: str, df: DataFrame, columns: Sequence[str]) -> list[Rule]:
    """Columns that must be gone."""
    rules = []
    for c in columns:
        value = F.count(F.col(c)) if c in df.columns else F.lit(None).cast("bigint")
        m = Measure(table, f"filled {c}", value)
        rules.append(
            Rule(f"lacks_column({c})", table, _ref(m), _ref(m).isNull(), "absent", (m,))
        )
    return rules


def reconciles(table: str, column: str, with_rows_of: str) -> Rule:
    """``sum(column)`` must equal the row count of another table."""
    m, rows = Measure(table, f"sum {column}", F.sum(column)), _rows(with_rows_of)
    return Rule(
        f"reconciles({column})",
        table,
        _ref(m) - _ref(rows),
        _ref(m) == _ref(rows),
        f"= rows of {with_rows_of}",
        (m, rows),
    )


def covers(table: str, column: str, of: str) -> Rule:
    """Both tables must hold the same set of values of ``column``.

    Sets are compared by their size and by the sum of the hashes of their values, so
    different values in equal numbers don't pass.
    """
    a, b = _distinct(table, column), _distinct(of, column)
    x, y = _hashed(table, column), _hashed(of, column)
    return Rule(
        f"covers({column})",
        table,
        _ref(a) - _ref(b),
        (_ref(a) == _ref(b)) & _ref(x).eqNullSafe(_ref(y)),
        f"= distinct in {of}",
        (a, b, x, y),
    )


def _hashed(table: str, column: str) -> Measure:
    hashed = F.expr(f"sum(DISTINCT cast(xxhash64(`{column}`) AS decimal(20, 0)))")
    return Measure(table, f"hashes of {column}", hashed)


def _distinct(table: str, column: str) -> Measure:
    return Measure(table, f"distinct {column}", F.count_distinct(column))


def rate_between(table: str, flag: str, low: float, high: float) -> Rule:
    """Share of rows whose flag is raised."""
    rate = F.try_divide(F.count_if(F.col(flag)).cast("double"), F.count(F.lit(1)))
    m = Measure(table, f"rate {flag}", rate)
    return Rule(
        f"rate_between({flag})", table, _ref(m), _ref(m).between(low, high), f"{low}..{high}", (m,)
    )


def spread_over(table: str, column: str, least: float) -> Rule:
    m = Measure(table, f"spread {column}", F.max(column) - F.min(column))
    return Rule(f"spread({column})", table, _ref(m), _ref(m) > least, f"> {least}", (m,))


def distinct_over(table: str, column: str, least: int) -> Rule:
    m = _distinct(table, column)
    return Rule(f"distinct({column})", table, _ref(m), _ref(m) > least, f"> {least}", (m,))


def run_checks(tables: Mapping[str, DataFrame], rules: Sequence[Rule]) -> DataFrame:
    """``(check, layer, status, observed, expected)``, one row per rule."""
    wanted: dict[str, dict[str, Measure]] = {}
    for rule in rules:
        for m in rule.measures:
            wanted.setdefault(m.table, {})[m.id] = m
    long = None
    for table, measures in wanted.items():
        df = tables[table]
        plain = {i: m.value for i, m in measures.items() if not m.keys}
        parts = [_measured(df, plain)] if plain else []
        parts += [_repeated(df, m) for m in measures.values() if m.keys]
        for part in parts:
            long = part if long is None else long.unionByName(part)
    ids = [i for measures in wanted.values() for i in measures]
    numbers = long.agg(
        *[F.max(F.when(F.col("measure") == i, F.col("value"))).alias(i) for i in ids]
    )
    verdicts = [
        F.struct(
            F.lit(r.check).alias("check"),
            F.lit(r.layer).alias("layer"),
            F.when(F.coalesce(r.passed, F.lit(False)), "pass").otherwise("fail").alias("status"),
            r.observed.cast("double").alias("observed"),
            F.lit(r.expected).alias("expected"),
        )
        for r in rules
    ]
    return numbers.select(F.inline(F.array(*verdicts)))


def _measured(df: DataFrame, measures: Mapping[str, Column]) -> DataFrame:
    one_row = df.agg(*[v.cast("double").alias(i) for i, v in measures.items()])
    return one_row.unpivot([], [f"`{i}`" for i in measures], "measure", "value")


def _repeated(df: DataFrame, m: Measure) -> DataFrame:
    groups = df.groupBy(*m.keys).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(F.count_if(F.col("n") > 1).cast("double").alias("value")).select(
        F.lit(m.id).alias("measure"), "value"
    )
