"""Conditions that a user writes as text, rebuilt out of listed operations only.

Rules arrive as messages, so their text is not trusted. Spark's parser reads it (nothing is analysed or run by that), and
a new column is built from the tree, node by node, out of the operations below. Whatever else stands in the text, however
it is quoted, spaced or commented, has no counterpart here and makes the text unusable: other functions, subqueries,
lambdas, aggregates, windows, casts to what a reading does not hold.

What is built never stops a job either: arithmetic that overflows and division by zero give null, and a null condition
does not fire. Texts are compared with texts and numbers with numbers; other comparisons are refused, as they may fail on
some row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The longest text that is read.
LONGEST = 4_096
#: The deepest nesting that is built.
DEEPEST = 64


class Unusable(ValueError):
    """A text that is not a condition over the given columns."""


def _nonzero(a: Column, b: Column, result: Column) -> Column:
    return F.when(b != 0, result)


_ARITHMETIC: dict[str, Callable[..., Column]] = {
    "Add": F.try_add, "Subtract": F.try_subtract, "Multiply": F.try_multiply, "Divide": F.try_divide, "Remainder": F.try_mod,
    "IntegralDivide": lambda a, b: F.try_divide(a, b).cast("double").try_cast("bigint"),
    "UnaryMinus": lambda a: F.try_subtract(F.lit(0), a), "UnaryPositive": lambda a: a,
}
_COMPARISONS: dict[str, Callable[[Column, Column], Column]] = {
    "EqualTo": lambda a, b: a == b, "EqualNullSafe": lambda a, b: a.eqNullSafe(b), "LessThan": lambda a, b: a < b,
    "LessThanOrEqual": lambda a, b: a <= b, "GreaterThan": lambda a, b: a > b, "GreaterThanOrEqual": lambda a, b: a >= b,
}
_LOGIC: dict[str, Callable[..., Column]] = {
    "And": lambda a, b: a & b, "Or": lambda a, b: a | b, "Not": lambda a: ~a, "IsNull": F.isnull, "IsNotNull": F.isnotnull,
}
#: Functions by name: of numbers, then of anything.
_OF_NUMBERS: dict[str, Callable[..., Column]] = {
    "abs": lambda a: F.abs(a.cast("double")), "greatest": F.greatest, "least": F.least, "floor": lambda a: F.floor(a.cast("double")).cast("double"),
    "ceil": lambda a: F.ceil(a.cast("double")).cast("double"), "sqrt": F.sqrt, "pow": F.pow, "power": F.pow, "exp": F.exp, "ln": F.log,
    "log": lambda a: F.log(a), "log10": F.log10, "sign": F.signum, "isnan": F.isnan, "mod": F.try_mod,
    "pmod": lambda a, b: _nonzero(a, b, F.pmod(a.cast("double"), b.cast("double"))),
    "round": lambda a: F.round(a.cast("double")),
}
_OF_TEXT: dict[str, Callable[..., Column]] = {"lower": F.lower, "upper": F.upper, "length": F.length}
_ALIKE: dict[str, Callable[..., Column]] = {
    "coalesce": F.coalesce, "ifnull": F.coalesce, "nvl": F.coalesce, "nullif": lambda a, b: F.when(~F.coalesce(a == b, F.lit(False)), a),
}
_ANY: dict[str, Callable[..., Column]] = {"isnull": F.isnull, "isnotnull": F.isnotnull}
FUNCTIONS = frozenset((*_OF_NUMBERS, *_OF_TEXT, *_ALIKE, *_ANY, "if", "between"))


def condition(text: str, columns: DataFrame) -> Column:
    """The condition that `text` states over the columns of a table; ``Unusable`` if it states none."""
    if not text or len(text) > LONGEST:
        raise Unusable("no text, or too long")
    parser = columns.sparkSession._jsparkSession.sessionState().sqlParser()
    try:
        built = _Builder(columns).build(parser.parseExpression(text), 0)
        kind = _kind(columns, built)
    except (AnalysisException, ParseException) as e:
        raise Unusable(str(e).splitlines()[0]) from e
    if kind not in ("boolean", "void"):
        raise Unusable("not a condition")
    return built.cast("boolean")


def usable(text: str, columns: DataFrame) -> bool:
    try:
        condition(text, columns)
    except Unusable:
        return False
    return True


def _kind(columns: DataFrame, column: Column) -> str:
    kind = columns.select(column.alias("c")).schema["c"].dataType
    if isinstance(kind, T.NumericType):
        return "number"
    return kind.typeName()


class _Builder:
    def __init__(self, columns: DataFrame) -> None:
        self.columns = columns
        self.names = set(columns.columns)

    def build(self, node, depth: int) -> Column:
        if depth > DEEPEST:
            raise Unusable("nested too deeply")
        name = node.getClass().getSimpleName()
        if name == "Literal":
            return F.expr(node.sql())  # a constant, written by Spark
        if name == "UnresolvedAttribute":
            parts = _items(node.nameParts())
            if len(parts) != 1 or parts[0] not in self.names:
                raise Unusable(f"unknown column {'.'.join(parts)}")
            return F.col("`" + parts[0].replace("`", "``") + "`")
        nodes = _items(node.children())
        if name == "UnresolvedFunction":
            if node.isDistinct() or node.filter().isDefined() or node.ignoreNulls():
                raise Unusable("aggregates are not allowed")
            return self.call(_items(node.nameParts()), [self.build(n, depth + 1) for n in nodes])
        if name == "Like":
            return self.like(node, nodes, depth)
        inner = [self.build(n, depth + 1) for n in nodes]
        if name in _ARITHMETIC:
            self.all_are("number", inner)
            return _ARITHMETIC[name](*inner)
        if name in _COMPARISONS:
            self.alike(inner)
            return _COMPARISONS[name](*inner)
        if name in _LOGIC:
            if not name.startswith("Is"):
                self.all_are("boolean", inner)
            return _LOGIC[name](*inner)
        if name == "In":
            self.alike(inner)
            return inner[0].isin(*inner[1:])
        if name == "CaseWhen":
            return self.case(inner)
        raise Unusable(f"{name} is not allowed")

    def call(self, parts: list[str], inner: list[Column]) -> Column:
        name = parts[0].lower()
        if len(parts) != 1 or name not in FUNCTIONS or not inner:
            raise Unusable(f"function {'.'.join(parts)} is not allowed")
        if name == "if":
            if len(inner) != 3:
                raise Unusable("if takes three arguments")
            return self.case(inner)
        if name == "between":
            if len(inner) != 3:
                raise Unusable("between takes three arguments")
            self.alike(inner)
            return inner[0].between(inner[1], inner[2])
        for group, check in ((_OF_NUMBERS, "number"), (_OF_TEXT, "string")):
            if name in group:
                self.all_are(check, inner)
        if name in _ALIKE:
            self.alike(inner)
        try:
            return ({**_OF_NUMBERS, **_OF_TEXT, **_ALIKE, **_ANY})[name](*inner)
        except TypeError as e:
            raise Unusable(f"wrong number of arguments of {name}") from e

    def like(self, node, nodes: list, depth: int) -> Column:
        text = self.build(nodes[0], depth + 1)
        self.all_are("string", [text])
        pattern = nodes[1]
        if pattern.getClass().getSimpleName() != "Literal" or str(node.escapeChar()) != "\\" or "\\" in (value := str(pattern.value())):
            raise Unusable("only like with a constant pattern is allowed")
        return text.like(value)

    def case(self, inner: list[Column]) -> Column:
        pairs = list(zip(inner[0::2], inner[1::2], strict=False))
        other = inner[-1:] if len(inner) % 2 else []
        self.all_are("boolean", [c for c, _ in pairs])
        self.alike([v for _, v in pairs] + other)
        out = F.when(*pairs[0])
        for c, v in pairs[1:]:
            out = out.when(c, v)
        return out.otherwise(other[0]) if other else out

    def kinds(self, inner: list[Column]) -> set[str]:
        return {_kind(self.columns, c) for c in inner} - {"void"}

    def all_are(self, kind: str, inner: list[Column]) -> None:
        if self.kinds(inner) - {kind}:
            raise Unusable(f"needs a {kind}")

    def alike(self, inner: list[Column]) -> None:
        if len(self.kinds(inner)) > 1:
            raise Unusable("compares values of different kinds")


def _items(seq) -> list:
    return [seq.apply(i) for i in range(seq.size())]
