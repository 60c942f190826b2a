"""The serving interface: listed relations, sampled, queried, described and searched."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.column import Column

from tracewell.config import SERVED_RELATIONS, Limits
from tracewell.functions.predicates import any_column_contains
from tracewell.sinks import records
from tracewell.sources.catalog import described


class Server:
    """relations: DataFrames by name; only names of `allowed` are served."""

    def __init__(self, relations: dict[str, DataFrame], allowed: tuple[str, ...] = SERVED_RELATIONS, limits: Limits = Limits()):
        self.allowed, self.limits = {a.upper() for a in allowed}, limits
        self.relations = {k.upper(): v for k, v in relations.items() if k.upper() in self.allowed}

    def relation(self, name: str) -> DataFrame:
        if name.upper() not in self.relations:
            raise KeyError(f"{name} is not served")
        return self.relations[name.upper()]

    def resources(self) -> list[str]:
        return sorted(self.relations)

    def predicate(self, df: DataFrame, clause: str) -> Column:
        """A condition on the relation's own columns; Spark's parser takes one expression, and subqueries are refused."""
        parsed = df.sparkSession._jsparkSession.sessionState().sqlParser().parseExpression(clause).toJSON()
        if re.search(r"\.(?:ListQuery|ScalarSubquery|Exists|InSubquery|LateralSubquery)\b", parsed):
            raise ValueError("a condition may not hold a subquery")
        return F.expr(clause)

    def rows(self, name: str, where: str | None = None) -> DataFrame:
        """All rows that meet the condition, for work in Spark; what a client is sent comes from query(), which has a limit."""
        df = self.relation(name)
        return df.where(self.predicate(df, where)) if where else df

    def query(self, name: str, limit: int | None = None, where: str | None = None) -> DataFrame:
        n = self.limits.default_rows if limit is None else limit
        if not 1 <= n <= self.limits.most_rows:
            raise ValueError(f"limit must be 1 to {self.limits.most_rows}")
        return self.rows(name, where).limit(n)

    def query_json(self, name: str, limit: int | None = None, where: str | None = None) -> str:
        return records(self.query(name, limit, where), self.limits.most_rows)

    def read(self, name: str) -> str:
        return records(self.relation(name), self.limits.sample_rows)

    def schema(self, name: str) -> list[tuple[str, str, bool]]:
        return described(self.relation(name))

    def search(self, term: str, names: list[str] | None = None) -> dict[str, dict]:
        """By relation: how many rows of the whole relation have the term in any column, and the first of them in order."""
        found = {}
        for name in names or self.resources():
            df = self.relation(name)
            hits = df.where(any_column_contains(df.columns, term))
            if total := hits.count():
                found[name] = {"total": total, "matches": [r.asDict(recursive=True) for r in hits.orderBy(*df.columns).limit(self.limits.matches).collect()]}
        return found
