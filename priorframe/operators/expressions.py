"""Attack expressions: a validated tree of operations to DataFrame columns.

Scalar nodes become one Column each. A join or group node aggregates donors to one row
per key and joins them back. Missing, non-finite and ambiguous operands give NULL.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from priorframe.functions.dates import iso_day, strict_months
from priorframe.functions.numbers import finite, lenient_number, rounded_count

NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")


class Term(NamedTuple):
    col: Column
    kind: str  # "number", "text" or "missing"


def _none(kind: str = "number") -> Term:
    return Term(F.lit(None).cast("double" if kind == "number" else "string"), kind)


def _both(a: Column, b: Column, result: Column) -> Column:
    return F.when(a.isNotNull() & b.isNotNull(), result)


def _logic(op: str, a: Column, b: Column | None = None) -> Column:
    """Two-valued logic on 0/1; any other operand, or a missing one, gives NULL."""
    bits = a.isin(0, 1) if b is None else a.isin(0, 1) & b.isin(0, 1)
    if op == "not":
        result = 1 - a
    elif op == "and":
        result = a * b
    else:
        result = F.greatest(a, b)
    return F.when(bits, result.cast("double"))


_ARITHMETIC = {
    "add": lambda a, b: a + b,
    "sub": lambda a, b: a - b,
    "mul": lambda a, b: a * b,
    "div": lambda a, b: F.try_divide(a, b),
    # Floored remainder: the sign follows the divisor.
    "mod": lambda a, b: F.when(b != 0, a - b * F.floor(F.try_divide(a, b))),
}
_COMPARE = {
    "lt": lambda a, b: a < b,
    "le": lambda a, b: a <= b,
    "gt": lambda a, b: a > b,
    "ge": lambda a, b: a >= b,
}


def _scalar(op: str, args: list[Term]) -> Term:
    a = args[0]
    b = args[1] if len(args) > 1 else None
    if op == "missing":
        empty = a.col.isNull() if a.kind != "text" else a.col.isNull() | (a.col == "")
        return Term(empty.cast("double"), "number")
    if op == "coalesce":
        if a.kind == "missing" or a.kind == b.kind:
            return Term(F.coalesce(a.col.cast("double" if b.kind == "number" else "string"), b.col), b.kind)
        raise ValueError("coalesce needs operands of one kind")
    if op == "if":
        c = args[2]
        if "missing" not in (b.kind, c.kind) and b.kind != c.kind:
            raise ValueError("if needs branches of one kind")
        kind = c.kind if b.kind == "missing" else b.kind
        cast = "string" if kind == "text" else "double"
        test = a.col if a.kind == "number" else F.lit(None)
        return Term(F.when(test == 1, b.col.cast(cast)).when(test == 0, c.col.cast(cast)), kind)
    if op == "number":
        return Term(lenient_number(a.col), "number")
    if op == "date":
        day = iso_day(a.col) if a.kind == "text" else F.lit(None).cast("date")
        return Term(F.unix_date(day).cast("double"), "number")
    if op in ("length", "lower"):
        if a.kind != "text":
            return _none("number" if op == "length" else "text")
        return Term(F.length(a.col).cast("double"), "number") if op == "length" else Term(F.lower(a.col), "text")
    if op == "contains":
        if a.kind != "text" or b.kind != "text":
            return _none()
        return Term(F.contains(a.col, b.col).cast("double"), "number")
    if op == "eq":
        same = (a.col == b.col) if a.kind == b.kind else F.lit(False)
        return Term(_both(a.col, b.col, same.cast("double")), "number")
    if any(t.kind != "number" for t in args):
        return _none()
    if op == "abs":
        return Term(F.abs(a.col), "number")
    if op in ("not", "and", "or"):
        return Term(_logic(op, a.col, b.col if b else None), "number")
    if op == "rounded_count":
        places = args[2].col
        whole = (places == F.floor(places)) & places.between(0, 12)
        count = rounded_count(a.col, b.col, F.when(whole, places).cast("int"))
        return Term(F.when(whole, count.cast("double")), "number")
    if op in _COMPARE:
        return Term(_COMPARE[op](a.col, b.col).cast("double"), "number")
    if op in _ARITHMETIC:
        return Term(finite(_ARITHMETIC[op](a.col, b.col)), "number")
    raise ValueError(f"unknown operation {op!r}")


class Evaluator:
    """Adds one column per expression to a label-free panel.

    ``donors`` limits which rows of the panel may answer a join or feed a group.
    """

    def __init__(self, panel: DataFrame, target: str, donors: Column | None = None):
        if target in panel.columns:
            raise ValueError("target column entered the feature panel")
        self._features = list(panel.columns)
        self._frame = panel
        self._donors = F.lit(True) if donors is None else donors
        self._made = 0

    def add(self, name: str, expression: dict) -> Evaluator:
        term = self._run(expression)  # may add joined columns to the frame first
        self._frame = self._frame.withColumn(name, term.col)
        self._features.append(name)
        return self

    def result(self) -> DataFrame:
        return self._frame.select(*self._features)

    def _fresh(self) -> str:
        self._made += 1
        return f"_x{self._made}"

    def _run(self, e: dict) -> Term:
        op = e["op"]
        if op == "column":
            if e["name"] not in self._features:
                raise ValueError(f"unavailable column {e['name']!r}")
            kind = self._frame.schema[e["name"]].dataType.simpleString().split("(")[0]
            c = F.col(e["name"])
            return Term(c.cast("double"), "number") if kind in NUMERIC else Term(c.cast("string"), "text")
        if op == "constant":
            v = e["value"]
            if v is None:
                return _none("missing")
            return Term(F.lit(v), "text") if isinstance(v, str) else Term(F.lit(float(v)), "number")
        if op == "slice":
            return self._slice(self._run(e["value"]), e["start"], e["stop"])
        if op == "join":
            return self._join(e)
        if op == "group":
            return self._group(e)
        return _scalar(op, [self._run(x) for x in e["args"]])

    @staticmethod
    def _slice(t: Term, start: int, stop: int) -> Term:
        if t.kind != "text":
            return _none("text")
        n = F.length(t.col)
        edge = lambda k: F.greatest(n + k, F.lit(0)) if k < 0 else F.least(F.lit(k), n)
        a, b = edge(start), edge(stop)
        return Term(F.substring(t.col, a + 1, F.greatest(b - a, F.lit(0))), "text")

    def _keyed(self, keys: list[str]) -> Column:
        ok = F.lit(True)
        for k in keys:
            ok = ok & F.col(k).isNotNull() & (F.col(k).cast("string") != "")
        return ok

    def _join(self, e: dict) -> Term:
        keys, unit = e["keys"], e["unit"]
        value, offset = self._run(e["value"]), self._run(e["offset"])
        v, day, at, n = self._fresh(), self._fresh(), self._fresh(), self._fresh()
        own = iso_day(F.col(e["time"]).cast("string"))
        k = F.when((offset.col == F.floor(offset.col)) & (F.abs(offset.col) <= 36600), offset.col.cast("int"))
        if unit == "days":
            moved = F.date_add(own, k)
        else:
            moved = strict_months(own, k * (12 if unit == "years" else 1))
        frame = self._frame.withColumns({v: value.col, day: own, at: moved})
        donors = (
            frame.where(self._donors & self._keyed(keys) & F.col(day).isNotNull())
            .groupBy(*keys, F.col(day).alias(at))
            .agg(F.count(F.lit(1)).alias(n), F.max(v).alias(v))
            .where(F.col(n) == 1)
            .drop(n)
        )
        self._frame = frame.drop(v, day).join(donors, [*keys, at], "left").drop(at)
        return Term(F.col(v), value.kind)

    def _group(self, e: dict) -> Term:
        keys, how = e["keys"], e["aggregate"]
        value = self._run(e["value"])
        v, n, bad = self._fresh(), self._fresh(), self._fresh()
        frame = self._frame.withColumn(v, value.col)
        invalid = F.count(F.lit(1)) != F.count(v)
        if how in ("sum", "min", "max") and value.kind != "number":
            invalid = F.lit(True)
        elif how == "unique":
            invalid = invalid | (F.min(v) != F.max(v))
        result = {
            "count": F.count(v).cast("double"),
            "sum": F.sum(v) if value.kind == "number" else F.lit(None),
            "min": F.min(v),
            "max": F.max(v),
            "unique": F.max(v),
        }[how]
        groups = (
            frame.where(self._donors & self._keyed(keys))
            .groupBy(*keys)
            .agg(result.alias(n), invalid.alias(bad))
            .select(*keys, F.when(~F.col(bad), F.col(n)).alias(v))
        )
        self._frame = frame.drop(v).join(groups, keys, "left")
        return Term(F.col(v), "number" if how == "count" else value.kind)
