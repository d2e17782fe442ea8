"""Rule tables as data, evaluated as native Catalyst expressions.

A rule is a predicate written in Spark SQL expression syntax over named columns
plus the value it yields. ``Cascade`` folds an ordered rule list into one
first-match ``CASE`` (a ``when`` chain); ``FlagSet`` yields one boolean column per
rule, overlapping or mutually exclusive; ``ScoreSet`` sums several cascades into
a total. The same objects render to ANSI SQL text for the DuckDB oracle, so rule
tables live in one place. Nothing here runs Python per row.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Expr:
    """A SQL expression used as a rule output instead of a literal."""
    sql: str


def _lit_sql(v: Any) -> str:
    if isinstance(v, Expr):
        return v.sql
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, (int, float)):
        return repr(v)
    return "'" + str(v).replace("'", "''") + "'"


def _lit_col(v: Any) -> Column:
    if isinstance(v, Expr):
        return F.expr(v.sql)
    return F.lit(v)


@dataclass(frozen=True)
class Rule:
    when: str
    then: Any


@dataclass(frozen=True)
class Cascade:
    """First-match rule list: the value of the first rule whose predicate holds."""
    name: str
    rules: tuple[Rule, ...]
    default: Any = None

    def column(self) -> Column:
        if not self.rules:
            return _lit_col(self.default).alias(self.name)
        out = None
        for r in self.rules:
            cond = F.expr(r.when)
            out = F.when(cond, _lit_col(r.then)) if out is None else out.when(cond, _lit_col(r.then))
        return out.otherwise(_lit_col(self.default)).alias(self.name)

    def sql(self) -> str:
        if not self.rules:
            return f"{_lit_sql(self.default)} AS {self.name}"
        arms = " ".join(f"WHEN {r.when} THEN {_lit_sql(r.then)}" for r in self.rules)
        return f"CASE {arms} ELSE {_lit_sql(self.default)} END AS {self.name}"

    def apply(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.name, self.column())


@dataclass(frozen=True)
class FlagSet:
    """Boolean flag per rule. ``exclusive`` makes each flag also require that no
    earlier flag fired (the cascade-of-flags form). A null predicate is false."""
    flags: tuple[tuple[str, str], ...]
    exclusive: bool = False

    def _conds(self) -> list[tuple[str, str]]:
        out, earlier = [], []
        for name, pred in self.flags:
            cond = f"({pred})"
            if self.exclusive and earlier:
                cond = " AND ".join([f"NOT {e}" for e in earlier] + [cond])
            out.append((name, f"COALESCE({cond}, FALSE)"))
            earlier.append(name)
        return out

    def apply(self, df: DataFrame) -> DataFrame:
        # Flags are added one by one so an exclusive flag can read earlier ones.
        for name, cond in self._conds():
            df = df.withColumn(name, F.expr(cond))
        return df

    def sql_columns(self) -> list[str]:
        """Inline SQL (earlier flags expanded) for a single SELECT list."""
        out, done = [], {}
        for name, cond in self._conds():
            text = cond
            for prev, prev_text in done.items():
                text = text.replace(f"NOT {prev}", f"NOT ({prev_text})")
            done[name] = text
            out.append(f"{text} AS {name}")
        return out


@dataclass(frozen=True)
class ScoreSet:
    """Additive score: one cascade per dimension, summed into ``total``."""
    dimensions: tuple[Cascade, ...]
    total: str = "score_total"

    @property
    def names(self) -> list[str]:
        return [d.name for d in self.dimensions]

    def apply(self, df: DataFrame) -> DataFrame:
        df = df.withColumns({d.name: d.column() for d in self.dimensions})
        tot = None
        for n in self.names:
            tot = F.col(n) if tot is None else tot + F.col(n)
        return df.withColumn(self.total, tot)

    def sql_columns(self) -> list[str]:
        return [d.sql() for d in self.dimensions]

    def total_sql(self) -> str:
        return " + ".join(self.names)


@dataclass(frozen=True)
class Segmentation:
    """A label cascade and its rank cascade generated from one rule list, so the
    two can never disagree (the reference writes the predicates twice)."""
    label: str
    rank: str
    rules: tuple[tuple[str, str], ...]   # (label, predicate) in priority order
    default: str = field(default="")

    def label_cascade(self) -> Cascade:
        return Cascade(self.label, tuple(Rule(p, lab) for lab, p in self.rules), self.default)

    def rank_cascade(self) -> Cascade:
        return Cascade(self.rank, tuple(Rule(p, i + 1) for i, (_, p) in enumerate(self.rules)),
                       len(self.rules) + 1)

    def apply(self, df: DataFrame) -> DataFrame:
        return df.withColumns({self.label: self.label_cascade().column(),
                               self.rank: self.rank_cascade().column()})

    def sql_columns(self) -> list[str]:
        return [self.label_cascade().sql(), self.rank_cascade().sql()]
