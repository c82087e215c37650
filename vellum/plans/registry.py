"""Operators by name: a plan is a list of names with parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame


class OperatorRegistry:
    """Names to functions of a DataFrame and keyword parameters."""

    def __init__(self) -> None:
        self._operators: dict[str, Callable[..., DataFrame]] = {}

    def register(self, name: str, operator: Callable[..., DataFrame] | None = None) -> Callable:
        """Add an operator, directly or as a decorator; a taken name is an error."""
        if operator is None:
            return lambda f: self.register(name, f)
        if name in self._operators:
            raise ValueError(f"{name} is registered")
        self._operators[name] = operator
        return operator

    def names(self, chosen: str = "all") -> list[str]:
        """All names, or those of a comma list; an unknown one is an error."""
        wanted = list(self._operators) if chosen == "all" else [n.strip() for n in chosen.split(",") if n.strip()]
        if missing := [n for n in wanted if n not in self._operators]:
            raise KeyError(f"no operator {', '.join(missing)}")
        return wanted

    def apply(self, rows: DataFrame, *steps: tuple[str, dict] | str) -> DataFrame:
        """Run operators one after the other."""
        for step in steps:
            name, parameters = (step, {}) if isinstance(step, str) else step
            rows = self._operators[self.names(name)[0]](rows, **parameters)
        return rows
