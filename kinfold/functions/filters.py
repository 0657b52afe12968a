"""Metadata and text filters compiled to boolean columns.

Every predicate is two-valued: true or false, never null. A positive test carries its own null check
(``x IS NOT NULL AND x = v``) and a negative one is its complement, so negation, conjunction and
disjunction compose, and both parts of a test on a promoted column are pushed into the scan.
"""

from __future__ import annotations

import datetime as dt
import json
import math
import operator
from collections.abc import Callable, Iterable, Mapping
from functools import reduce
from typing import Any, Union

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinfold.errors import FilterError
from kinfold.functions.text import contains
from kinfold.functions.values import iso_text, primitive
from kinfold.schema import ODD, RESERVED

# The filter operators of the data model.
ORDERING = {
    "$gt": operator.gt,
    "$gte": operator.ge,
    "$lt": operator.lt,
    "$lte": operator.le,
}
FIELD_OPERATORS = ("$eq", "$ne", "$gt", "$gte", "$lt", "$lte", "$in", "$nin")
LOGICAL_OPERATORS = ("$and", "$or")
TEXT_OPERATORS = ("$contains",)


def never() -> Column:
    return F.lit(False)


def always() -> Column:
    return F.lit(True)


class Where:
    """Fluent metadata filter. Chained conditions are ANDed unless :meth:`or_` was called."""

    def __init__(self) -> None:
        self._terms: list[dict[str, Any]] = []
        self._joiner = "$and"

    def _add(self, term: dict[str, Any]) -> Where:
        self._terms.append(term)
        return self

    def equals(self, field: str, value: Any) -> Where:
        return self._add({field: value})

    def is_in(self, field: str, values: Iterable[Any]) -> Where:
        return self._add({field: {"$in": list(values)}})

    def not_in(self, field: str, values: Iterable[Any]) -> Where:
        return self._add({field: {"$nin": list(values)}})

    def greater_than(self, field: str, value: Any) -> Where:
        return self._add({field: {"$gt": value}})

    def greater_than_or_equal(self, field: str, value: Any) -> Where:
        return self._add({field: {"$gte": value}})

    def less_than(self, field: str, value: Any) -> Where:
        return self._add({field: {"$lt": value}})

    def less_than_or_equal(self, field: str, value: Any) -> Where:
        return self._add({field: {"$lte": value}})

    def and_(self, *filters: Where) -> Where:
        """Add the conjunction of `filters` as one condition."""
        return self._add({"$and": [f.to_dict() for f in filters]})

    def or_(self, *filters: Where) -> Where:
        """Add the disjunction of `filters`; without arguments, OR the chained conditions."""
        if not filters:
            self._joiner = "$or"
            return self
        return self._add({"$or": [f.to_dict() for f in filters]})

    def to_dict(self) -> dict[str, Any]:
        """The filter tree: empty, one bare condition, or a list of conditions under one operator."""
        if not self._terms:
            return {}
        return self._terms[0] if len(self._terms) == 1 else {self._joiner: list(self._terms)}


Filter = Union[Where, Mapping[str, Any], str, None]


def filter_tree(where: Filter) -> Mapping[str, Any]:
    """Any accepted form of a filter (builder, dictionary, JSON text) as a dictionary."""
    if where is None:
        return {}
    if isinstance(where, Where):
        return where.to_dict()
    if isinstance(where, str):
        try:
            where = json.loads(where)
        except json.JSONDecodeError as broken:
            raise FilterError(f"filter is not valid JSON: {broken}") from broken
    if not isinstance(where, Mapping):
        raise FilterError(f"a filter is an object, not {type(where).__name__}")
    return where


def _utc(value: dt.datetime) -> dt.datetime:
    """A moment in UTC, the form that stored timestamps have; one without a zone is taken as UTC."""
    return value.replace(tzinfo=dt.timezone.utc) if value.tzinfo is None else value.astimezone(dt.timezone.utc)


def _spellings(value: Any) -> list[str]:
    """The texts that stand for a value: a moment may be stored in UTC, without a zone, or as it was written."""
    text = _literal(value)[1]
    if not isinstance(value, dt.datetime):
        return [text]
    return list(dict.fromkeys([text, text.removesuffix("Z"), iso_text(value)]))


def _literal(value: Any) -> tuple[str, Any]:
    if isinstance(value, dt.datetime):
        return "s", iso_text(_utc(value))
    typed = primitive(value)
    if typed is None:
        raise TypeError(f"cannot filter on a value of type {type(value).__name__}")
    return typed


# ------------------------------------------------------------------- tests on one typed column


def _known(column: Column, test: Column) -> Column:
    return column.isNotNull() & test


def _test_integer(column: Column, op: str, value: float) -> Column:
    """`column` is integral. A fractional bound is moved to the next integer, so the column needs no cast."""
    whole = isinstance(value, int) or (math.isfinite(value) and value == math.floor(value) and abs(value) < 2**63)
    if whole:
        exact = F.lit(int(value))
        return _known(column, column == exact if op == "$eq" else ORDERING[op](column, exact))
    if op == "$eq" or math.isnan(value):
        return never()
    if math.isinf(value) or abs(value) >= 2**63:
        holds = (value < 0) == (op in ("$gt", "$gte"))
        return column.isNotNull() if holds else never()
    if op in ("$gt", "$gte"):
        return _known(column, column > F.lit(math.floor(value)))
    return _known(column, column < F.lit(math.ceil(value)))


def _test_plain(column: Column, op: str, value: Any) -> Column:
    exact = value if isinstance(value, Column) else F.lit(value)
    return _known(column, column == exact if op == "$eq" else ORDERING[op](column, exact))


def _any_of(column: Column, values: list[Any]) -> Column:
    return _known(column, column.isin(values)) if values else never()


class _Field:
    """A metadata field: up to one column per value type; None where the type cannot occur.

    `other` holds the values that do not fit the column of a promoted key, `odd` marks rows that have any.
    """

    def __init__(
        self,
        text: Column | None = None,
        integer: Column | None = None,
        double: Column | None = None,
        boolean: Column | None = None,
        moment: T.DataType | None = None,
        single: bool = False,
        other: _Field | None = None,
        odd: Column | None = None,
    ):
        self.text, self.integer, self.double, self.boolean = text, integer, double, boolean
        self.moment, self.single, self.other, self.odd = moment, single, other, odd

    def compare(self, op: str, value: Any) -> Column:
        here = self._compare(op, value)
        return here if self.other is None else self._or_odd(here, self.other.compare(op, value))

    def one_of(self, values: list[Any]) -> Column:
        here = self._one_of(values)
        return here if self.other is None else self._or_odd(here, self.other.one_of(values))

    def _or_odd(self, here: Column, there: Column) -> Column:
        """Here, or there in an odd row. The first of two conditions reaches the scan, the map never does."""
        if self.odd is None:
            return here | there
        return (here | self.odd) & F.when(self.odd, here | there).otherwise(here)

    def _number(self, value: float) -> Any:
        """A literal for the double column; single precision is compared in single precision."""
        return F.lit(float(value)).cast("float") if self.single else float(value)

    def _compare(self, op: str, value: Any) -> Column:
        tag, plain = _literal(value)
        if tag == "b":
            if op != "$eq":
                raise FilterError(f"{op} does not apply to a boolean")
            return never() if self.boolean is None else _test_plain(self.boolean, op, plain)
        if tag == "s":
            if self.text is None:
                return never()
            if self.moment is not None:
                bound = F.lit(plain).try_cast(self.moment)
                test = self.text == bound if op == "$eq" else ORDERING[op](self.text, bound)
                return self.text.isNotNull() & bound.isNotNull() & test
            if op == "$eq" and len(texts := _spellings(value)) > 1:
                return _any_of(self.text, texts)
            return _test_plain(self.text, op, plain)
        tests = []
        if self.integer is not None:
            tests.append(_test_integer(self.integer, op, plain))
        if self.double is not None:
            tests.append(_test_plain(self.double, op, self._number(plain)))
        return reduce(operator.or_, tests) if tests else never()

    def _one_of(self, values: list[Any]) -> Column:
        if not isinstance(values, (list, tuple, set, frozenset)) or not values:
            raise FilterError("a list operator needs a non-empty list")
        if self.moment is not None:
            return reduce(operator.or_, [self._compare("$eq", v) for v in values])
        typed = [_literal(v) for v in values]
        numbers = [v for t, v in typed if t in "id"]
        tests = []
        if self.text is not None:
            tests.append(_any_of(self.text, [s for v, (t, _) in zip(values, typed) if t == "s" for s in _spellings(v)]))
        if self.boolean is not None:
            tests.append(_any_of(self.boolean, [v for t, v in typed if t == "b"]))
        if self.integer is not None:
            whole = [int(v) for v in numbers if math.isfinite(v) and v == math.floor(v) and abs(v) <= 2**63 - 1]
            tests.append(_any_of(self.integer, whole))
        if self.double is not None:
            tests.append(_any_of(self.double, [self._number(v) for v in numbers]))
        return reduce(operator.or_, tests) if tests else never()


def _promoted(column: Column, dtype: T.DataType, **rest: Any) -> _Field:
    if isinstance(dtype, T.BooleanType):
        return _Field(boolean=column, **rest)
    if isinstance(dtype, T.StringType):
        return _Field(text=column, **rest)
    if isinstance(dtype, T.IntegralType):
        return _Field(integer=column, **rest)
    if isinstance(dtype, (T.FractionalType, T.DecimalType)):
        return _Field(double=column, single=isinstance(dtype, T.FloatType), **rest)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return _Field(text=column, moment=dtype, **rest)
    raise FilterError(f"cannot filter on a column of type {dtype.simpleString()}")


def field_resolver(schema: T.StructType) -> Callable[[str], _Field]:
    """Field name to columns: a promoted column if there is one, and the metadata map.

    The map holds the values of a promoted key that do not fit its column. Where a DataFrame has no
    metadata but promoted columns, the optimiser drops that part, and the column's alone reaches the
    scan. Map keys are looked up whole, so names with dots work.
    """

    def resolve(name: str) -> _Field:
        mapped = None
        if "metadata" in schema.fieldNames():
            value = F.col("metadata")[F.lit(name)]
            mapped = _Field(value["s"], value["i"], value["d"], value["b"])
        if name in schema.fieldNames() and name not in RESERVED:
            odd = F.col(ODD).isNotNull() if ODD in schema.fieldNames() else None
            return _promoted(F.col(f"`{name}`"), schema[name].dataType, other=mapped, odd=odd)
        return mapped or _Field()

    return resolve


# ---------------------------------------------------------------------------- compilation


def _field_test(field: _Field, name: str, condition: Any) -> Column:
    if not isinstance(condition, Mapping):
        return field.compare("$eq", condition)
    if not condition:
        raise FilterError(f"empty condition on {name!r}")
    tests = []
    for op, value in condition.items():
        if op == "$eq":
            tests.append(field.compare(op, value))
        elif op == "$ne":
            tests.append(~field.compare("$eq", value))
        elif op in ORDERING:
            tests.append(field.compare(op, value))
        elif op == "$in":
            tests.append(field.one_of(value))
        elif op == "$nin":
            tests.append(~field.one_of(value))
        else:
            raise FilterError(f"unknown operator {op!r} on {name!r}; known: {FIELD_OPERATORS}")
    return reduce(operator.and_, tests)


def where_column(where: Filter, df: DataFrame | T.StructType) -> Column:
    """A metadata filter as a boolean column over `df`. An empty filter matches every row."""
    resolve = field_resolver(df if isinstance(df, T.StructType) else df.schema)

    def build(tree: Any) -> Column:
        if not isinstance(tree, Mapping):
            raise FilterError(f"a filter is an object, not {type(tree).__name__}")
        tests = []
        for key, content in tree.items():
            if key in LOGICAL_OPERATORS:
                if not isinstance(content, (list, tuple)) or not content:
                    raise FilterError(f"{key} needs a non-empty list of filters")
                join = operator.and_ if key == "$and" else operator.or_
                tests.append(reduce(join, [build(part) for part in content]))
            elif key.startswith("$"):
                raise FilterError(f"unknown logical operator {key!r}; known: {LOGICAL_OPERATORS}")
            else:
                tests.append(_field_test(resolve(key), key, content))
        return reduce(operator.and_, tests) if tests else always()

    return build(filter_tree(where))


def document_column(where_document: Filter) -> Column:
    """A text filter, ``{"$contains": text}``, as a boolean column."""
    tree = filter_tree(where_document)
    tests = []
    for key, needle in tree.items():
        if key not in TEXT_OPERATORS:
            raise FilterError(f"unknown text operator {key!r}; known: {TEXT_OPERATORS}")
        if not isinstance(needle, str):
            raise FilterError(f"{key} needs a string")
        tests.append(contains(F.col("document"), needle))
    return reduce(operator.and_, tests) if tests else always()


def apply_filters(df: DataFrame, where: Filter = None, where_document: Filter = None) -> DataFrame:
    """Keep the rows that match the metadata filter and the text filter."""
    if where is not None:
        df = df.filter(where_column(where, df))
    if where_document is not None:
        df = df.filter(document_column(where_document))
    return df
