"""Functions over grids of parameters, as tables with the parameters in columns.

A grid has named axes. A step is a function of axes and of other steps, taken by the names of its parameters, so what a step
depends on is read from the function; it is computed once for each point of those axes and shared by all points of the others.
"""

from __future__ import annotations

import inspect
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .evaluate import best_of_grid

#: The parameter by which a step is told the axes that its tables have as columns: what it must group by.
BY = "by"


@dataclass(frozen=True)
class Step:
    function: Callable[..., DataFrame]
    #: axes whose values the function is called with one by one, and axes that it lays out as rows itself
    each: tuple[str, ...]
    rows: tuple[str, ...]
    uses: tuple[str, ...]
    told: bool


def opened(df: DataFrame, name: str, values: Sequence) -> DataFrame:
    """Each row once for each value, in the column ``name``: an array opened beside the row, nothing is shuffled."""
    return df.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))


class Grid:
    """Steps over named axes.

    A parameter of a step's function that is an axis gets one value of it; the tables of all values are united, with the
    value in a column of the axis' name. An axis in ``rows`` is given as the whole list, and the function makes the column
    itself, which costs one job for all of its values. A parameter that is a step gets that step's table, of the
    points where axes taken by both are equal. The parameter ``by`` gets the names of the axes that these tables have.
    """

    def __init__(self, **axes: Iterable):
        self.axes = {name: list(values) for name, values in axes.items()}
        for name, values in self.axes.items():
            if not values or len(set(map(repr, values))) != len(values):
                raise ValueError(f"axis {name} must have values, each once")
        self.steps: dict[str, Step] = {}
        self.calls: dict[str, int] = {}
        self._tables: dict[str, DataFrame] = {}

    def step(self, function: Callable[..., DataFrame] | None = None, *, rows: tuple[str, ...] = ()) -> Callable:
        """Register a function under its name; a decorator, with or without ``rows``."""
        if function is None:
            return lambda f: self.step(f, rows=rows)
        name, parameters = function.__name__, list(inspect.signature(function).parameters)
        unknown = [p for p in parameters if p != BY and p not in self.axes and p not in self.steps]
        if unknown or name in self.axes or name in self.steps or set(rows) - set(parameters):
            raise ValueError(f"step {name}: {unknown or name} is no axis and no earlier step, or its name is taken, or rows are no parameters")
        each = tuple(p for p in parameters if p in self.axes and p not in rows)
        self.steps[name] = Step(function, each, tuple(rows), tuple(p for p in parameters if p in self.steps), BY in parameters)
        return function

    def depends(self, name: str) -> tuple[str, ...]:
        """The axes that a step's table has as columns, in the order of the grid's."""
        step = self.steps[name]
        own = {*step.each, *step.rows}.union(*(self.depends(u) for u in step.uses))
        return tuple(a for a in self.axes if a in own)

    def table(self, name: str) -> DataFrame:
        """A step's rows at all points of the axes that it depends on."""
        if name not in self._tables:
            self._tables[name] = self._united(name)
        return self._tables[name]

    def _united(self, name: str) -> DataFrame:
        step, self.calls[name] = self.steps[name], 0
        given = {u: self.table(u) for u in step.uses}
        out = []
        for point in product(*(self.axes[a] for a in step.each)):
            values = dict(zip(step.each, point))
            tables = {u: self._at(df, {a: v for a, v in values.items() if a in self.depends(u)}) for u, df in given.items()}
            by = {BY: [a for a in self.axes if a not in values and any(a in self.depends(u) for u in step.uses)]} if step.told else {}
            df = step.function(**values, **{a: self.axes[a] for a in step.rows}, **tables, **by)
            self.calls[name] += 1
            out.append(df.withColumns({a: F.lit(v) for a, v in values.items()}))
        whole = reduce(lambda a, b: a.unionByName(b), out)
        missing = [a for a in self.depends(name) if a not in whole.columns]
        if missing:
            raise ValueError(f"step {name} lost the axes {missing}")
        return whole

    @staticmethod
    def _at(df: DataFrame, values: dict) -> DataFrame:
        same: list[Column] = [F.col(a).eqNullSafe(F.lit(v)) for a, v in values.items()]
        return reduce(lambda x, c: x.where(c), same, df).drop(*values)

    def points(self, df: DataFrame) -> DataFrame:
        """Each row of ``df`` at every point of the grid."""
        return reduce(lambda x, a: opened(x, a, self.axes[a]), self.axes, df)

    def best(self, name: str, score: str, per: Sequence[str] = (), largest: bool = True) -> DataFrame:
        """The point of the largest (or least) score of each key, ties to the first point in the order of its values."""
        table, axes = self.table(name), list(self.depends(name))
        if not largest:
            table = table.withColumn(score, -F.col(score))
        out = best_of_grid(table, list(per), score, axes)
        return out if largest else out.withColumn(score, -F.col(score))
