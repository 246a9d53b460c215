"""Run checks, turn failures into pass / warn / error, and gate a layer."""

from __future__ import annotations

import logging
import operator
from collections.abc import Callable
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from fiscalmill.quality import checks as c

logger = logging.getLogger(__name__)

Tables = dict[str, DataFrame]

_COMPARE = {
    "!=": operator.ne, "<>": operator.ne, "=": operator.eq, "==": operator.eq,
    ">": operator.gt, ">=": operator.ge, "<": operator.lt, "<=": operator.le,
}


class QualityError(Exception):
    """A check of severity 'error' failed; later layers must not be built."""


@dataclass(frozen=True)
class Check:
    """One configured check.

    ``condition`` marks failing rows of a row-level check.  ``measure`` gives the
    number of failures as one aggregate of the rows for which its argument holds.
    Checks of both kinds on one table are counters of a single pass, which may be
    the one that writes the table.  ``key`` is what a check on values groups by,
    NULL for rows that take no part; its failures are the keys that occur more than
    once (``repeated``) or at all.  Such checks of a table share one aggregation.
    ``failing`` builds the failing rows of every check without a condition.
    """

    name: str
    table: str
    column: str = ""
    severity: str = "error"
    condition: Callable[[], Column] | None = None
    failing: Callable[[DataFrame, Tables], DataFrame] | None = None
    count: Callable[[], Column] = field(default=lambda: F.count("*"))
    where: str | None = None
    measure: Callable[[Column], Column] | None = None
    key: Callable[[], Column] | None = None
    repeated: bool = False
    error_if: tuple[str, float] = ("!=", 0)
    warn_if: tuple[str, float] = ("!=", 0)

    def warn(self) -> Check:
        return replace(self, severity="warn")

    def rows(self, tables: Tables) -> DataFrame:
        """The failing rows themselves."""
        df = tables[self.table]
        df = df.filter(self.where) if self.where else df
        return df.filter(self.condition()) if self.condition else self.failing(df, tables)

    def taken(self) -> Column:
        """Whether the check looks at a row."""
        return F.coalesce(F.expr(self.where), F.lit(False)) if self.where else F.lit(True)

    def counter(self) -> Column | None:
        """The number of failures as an aggregate, if one pass without grouping can tell it."""
        if self.condition:
            return F.count_if(self.condition() & self.taken())
        return F.coalesce(self.measure(self.taken()), F.lit(0)).cast("bigint") if self.measure else None

    def status(self, failures: int) -> str:
        error = _COMPARE[self.error_if[0]](failures, self.error_if[1])
        warn = _COMPARE[self.warn_if[0]](failures, self.warn_if[1])
        if self.severity == "error" and error:
            return "error"
        return "warn" if warn else "pass"


def _folded() -> Column:
    return F.sum(c.N_ROWS)


def _row_check(name, table, column, condition, severity="error", **kw) -> Check:
    return Check(name, table, column, severity, condition=condition, **kw)


def not_null(table: str, column: str, **kw) -> Check:
    return _row_check("not_null", table, column, lambda: c.null_rows(column), **kw)


def accepted_range(table: str, column: str, min_value=None, max_value=None, inclusive=True, **kw) -> Check:
    return _row_check("accepted_range", table, column, lambda: c.out_of_range(column, min_value, max_value, inclusive), **kw)


def expression_is_true(table: str, expression: str, column: str | None = None, **kw) -> Check:
    return _row_check("expression_is_true", table, column or "", lambda: c.not_true(expression, column), **kw)


def not_empty_string(table: str, column: str, trim_whitespace=True, **kw) -> Check:
    return _row_check("not_empty_string", table, column, lambda: c.empty_text(column, trim_whitespace), **kw)


def assert_equal(table: str, actual: str, expected: str, **kw) -> Check:
    return _row_check("assert_equal", table, actual, lambda: c.unequal(actual, expected), **kw)


def _one_if(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def has_rows(table: str, **kw) -> Check:
    return Check("has_rows", table, failing=lambda df, _: c.has_rows(df), measure=lambda taken: _one_if(F.count_if(taken) == 0), **kw)


def at_least_one(table: str, column: str, **kw) -> Check:
    return Check(
        "at_least_one", table, column, failing=lambda df, _: c.at_least_one(df, column),
        measure=lambda taken: _one_if(F.count_if(taken & F.col(column).isNotNull()) == 0), **kw,
    )


def not_constant(table: str, column: str, **kw) -> Check:
    def measure(taken: Column) -> Column:
        value = F.when(taken, F.col(column))
        return _one_if(F.min(value) == F.max(value))

    return Check("not_constant", table, column, failing=lambda df, _: c.not_constant(df, column), measure=measure, **kw)


def not_null_proportion(table: str, column: str, at_least: float, at_most: float = 1.0, **kw) -> Check:
    def measure(taken: Column) -> Column:
        share = F.try_divide(F.count_if(taken & F.col(column).isNotNull()), F.count_if(taken))
        return _one_if((share < at_least) | (share > at_most))

    failing = lambda df, _: c.not_null_proportion(df, column, at_least, at_most)
    return Check("not_null_proportion", table, column, failing=failing, measure=measure, **kw)


def unique(table: str, column: str, **kw) -> Check:
    key = lambda: F.when(F.col(column).isNotNull(), F.struct(column))
    return Check("unique", table, column, failing=lambda df, _: c.unique(df, column), key=key, repeated=True, **kw)


def unique_combination_of_columns(table: str, columns: list[str], **kw) -> Check:
    failing = lambda df, _: c.unique_combination_of_columns(df, columns)
    return Check("unique_combination_of_columns", table, failing=failing, key=lambda: F.struct(*columns), repeated=True, **kw)


def accepted_values(table: str, column: str, values: list, **kw) -> Check:
    key = lambda: F.when(~F.col(column).isin(values), F.struct(column))
    return Check("accepted_values", table, column, failing=lambda df, _: c.accepted_values(df, column, values), key=key, **kw)


def not_accepted_values(table: str, column: str, values: list, **kw) -> Check:
    key = lambda: F.when(F.col(column).isin(values), F.struct(column))
    return Check("not_accepted_values", table, column, failing=lambda df, _: c.not_accepted_values(df, column, values), key=key, **kw)


def relationships(table: str, column: str, to: str, to_column: str, **kw) -> Check:
    return Check(
        "relationships", table, column,
        failing=lambda df, tables: c.relationships(df, column, tables[to], to_column), count=_folded, **kw,
    )


def equal_rowcount(table: str, compare: str, group_by: list[str] | None = None, **kw) -> Check:
    return Check(
        "equal_rowcount", table,
        failing=lambda df, tables: c.equal_rowcount(df, tables[compare], group_by), count=lambda: F.sum("diff_count"), **kw,
    )


def fewer_rows_than(table: str, compare: str, group_by: list[str] | None = None, **kw) -> Check:
    return Check(
        "fewer_rows_than", table,
        failing=lambda df, tables: c.fewer_rows_than(df, tables[compare], group_by),
        count=lambda: F.sum("row_count_delta"), **kw,
    )


def equality(table: str, compare: str, columns: list[str] | None = None, **kw) -> Check:
    """Failures: differing rows plus the imbalance between the two sides."""

    def side(name: str) -> Column:
        return F.sum(F.when(F.col("which_diff") == name, 1).otherwise(0))

    return Check(
        "equality", table,
        failing=lambda df, tables: c.equality(df, tables[compare], columns),
        count=lambda: F.count("*") + F.coalesce(F.abs(side("a_minus_b") - side("b_minus_a")), F.lit(0)), **kw,
    )


def custom(name: str, table: str, failing, column: str = "", folded: bool = False, **kw) -> Check:
    """Any other check, from a function (df, tables) -> failing rows."""
    if folded:
        kw["count"] = _folded
    return Check(name, table, column, failing=failing, **kw)


class Watch:
    """Counters of a layer's checks, collected while its tables are written.

    The counters ride on the write itself, so a watched table is not read again for
    them.  They are taken in the last stage, whose tasks count once even if they run
    again after a lost executor.
    """

    def __init__(self, checks: list[Check]):
        self.checks = checks
        self._seen: dict[str, tuple[list[int], Observation]] = {}

    def on(self, table: str, df: DataFrame) -> DataFrame:
        """``df`` with the counters of its table's checks; write just this DataFrame, once."""
        counters = [(i, counter) for i, check in enumerate(self.checks) if check.table == table and (counter := check.counter()) is not None]
        if not counters:
            return df
        observation = Observation()
        self._seen[table] = ([i for i, _ in counters], observation)
        return df.observe(observation, *[counter.alias(str(i)) for i, counter in counters])

    def failures(self) -> dict[int, int]:
        """Failures by position of the checks whose tables have been written."""
        out: dict[int, int] = {}
        for positions, observation in self._seen.values():
            metrics = observation.get
            out |= {i: metrics[str(i)] for i in positions if str(i) in metrics}
        return out


def _pairs(counted: DataFrame, positions: list[int]) -> DataFrame:
    """One row of counters named by position -> rows (position, failures)."""
    pairs = [F.struct(F.lit(i).alias("position"), F.col(f"`{i}`").alias("failures")) for i in positions]
    return counted.select(F.inline(F.array(*pairs)))


def _keyed(df: DataFrame, checks: dict[int, Check]) -> DataFrame:
    """Failures of all checks on values of a table by one aggregation over grouping sets."""
    names = {i: f"_k{i}" for i in checks}
    keys = df.select(*[F.when(check.taken(), check.key()).alias(names[i]) for i, check in checks.items()])
    sets = keys.groupingSets([[F.col(n)] for n in names.values()], *names.values())
    groups = sets.agg(F.count("*").alias("_n"), F.grouping_id().alias("_set"))
    every = (1 << len(names)) - 1
    counters = []
    for place, (i, check) in enumerate(checks.items()):
        # the grouping id has a one for each key that is not grouped by
        own = F.col("_set") == every - (1 << (len(names) - 1 - place))
        bad = own & F.col(names[i]).isNotNull()
        counters.append(F.count_if(bad & (F.col("_n") > 1) if check.repeated else bad).alias(str(i)))
    return _pairs(groups.agg(*counters), list(checks))


def failure_counts(tables: Tables, checks: list[Check], positions: list[int] | None = None) -> DataFrame:
    """One row (position, failures) per check (of ``positions``, if given), as one job.

    A table is read once for all its counters and once for all its keys; only checks
    that compare tables or need an order read it again.
    """
    parts = []
    counted: dict[str, dict[int, Column]] = {}
    keyed: dict[str, dict[int, Check]] = {}
    for i in range(len(checks)) if positions is None else positions:
        check = checks[i]
        if (counter := check.counter()) is not None:
            counted.setdefault(check.table, {})[i] = counter
        elif check.key:
            keyed.setdefault(check.table, {})[i] = check
        else:
            failures = F.coalesce(check.count(), F.lit(0)).cast("bigint").alias("failures")
            parts.append(check.rows(tables).agg(failures).select(F.lit(i).alias("position"), "failures"))
    for table, counters in counted.items():
        wide = tables[table].agg(*[counter.alias(str(i)) for i, counter in counters.items()])
        parts.append(_pairs(wide, list(counters)))
    parts += [_keyed(tables[table], own) for table, own in keyed.items()]
    return reduce(DataFrame.unionAll, parts)


def run_checks(tables: Tables, checks: list[Check], watch: Watch | None = None) -> list[dict]:
    """Results of all checks; one small row per check reaches the driver."""
    if not checks:
        return []
    failures = watch.failures() if watch else {}
    left = [i for i in range(len(checks)) if i not in failures]
    if left:
        failures |= {r["position"]: r["failures"] for r in failure_counts(tables, checks, left).collect()}
    return [
        {
            "check": check.name, "table": check.table, "column": check.column, "severity": check.severity,
            "failures": failures[i], "status": check.status(failures[i]),
        }
        for i, check in enumerate(checks)
    ]


def gate(layer: str, tables: Tables, checks: list[Check], watch: Watch | None = None) -> list[dict]:
    """Run a layer's checks; warnings are logged, any error stops the build."""
    results = run_checks(tables, checks, watch)
    for r in results:
        if r["status"] != "pass":
            logger.warning("%s: %s on %s.%s: %d failures (%s)", layer, r["check"], r["table"], r["column"], r["failures"], r["status"])
    errors = [r for r in results if r["status"] == "error"]
    if errors:
        names = ", ".join(f"{r['check']}({r['table']}.{r['column']})" for r in errors)
        raise QualityError(f"layer {layer} failed: {names}")
    return results
