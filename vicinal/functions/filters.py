"""Metadata filters: a JSON-like dict becomes one Boolean column over a VARIANT."""

from __future__ import annotations

import json
import math
import re
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# How ``schema_of_variant`` names the JSON kinds.
_NUMBER_KINDS = r"^(BIGINT|DOUBLE|FLOAT|DECIMAL)"
_PLAIN_KEY = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")
_PREFIX = "metadata."
_EXACT_DOUBLE = (1 << 53) - 1
_EXACT_DECIMAL = 10**38 - 1


def compile_filter(filters: dict | str | None, metadata: Column | str = "metadata") -> Column:
    """Compile a filter to a column that is true on a match, and false or null elsewhere.

    Evidenced forms: ``{"key": value}``, ``$gt``, ``$in`` and ``$and``, with dotted
    paths. Extensions of ours: ``$or``, ``$not``, ``$eq``, ``$ne``, ``$gte``, ``$lt``,
    ``$lte``, ``$nin``, ``$exists`` and several keys in one dict, which are and-ed.
    ``None`` and ``{}`` select everything. Numbers only equal numbers, strings only
    strings and Booleans only Booleans. Plain comparisons stay bare, so that Catalyst can
    hand them to the Parquet scan of a stored VARIANT; only negations fold null to false.
    """
    if isinstance(filters, str):
        filters = json.loads(filters)
    column = F.col(metadata) if isinstance(metadata, str) else metadata
    return _document(filters or {}, column)


def _document(filters: dict, metadata: Column) -> Column:
    if not isinstance(filters, dict):
        raise ValueError(f"a filter must be a dict, got {type(filters).__name__}")
    terms = []
    for key, condition in filters.items():
        if key in ("$and", "$or"):
            if not isinstance(condition, (list, tuple)):
                raise ValueError(f"{key} needs a list of filters")
            parts = [_document(part, metadata) for part in condition]
            empty = F.lit(key == "$and")
            terms.append(reduce(and_ if key == "$and" else or_, parts) if parts else empty)
        elif key == "$not":
            terms.append(_negate(_document(condition, metadata)))
        elif key.startswith("$"):
            raise ValueError(f"unknown filter operator {key!r}")
        else:
            terms.append(_field(key, condition, metadata))
    return reduce(and_, terms) if terms else F.lit(True)


def _field(path: str, condition, metadata: Column) -> Column:
    value = _Value(metadata, path)
    if not (isinstance(condition, dict) and any(k.startswith("$") for k in condition)):
        return _equals(value, condition)
    return reduce(and_, [_comparison(value, op, arg) for op, arg in condition.items()])


class _Value:
    """The metadata value under a dotted path, read as one kind or another.

    ``metadata.score`` may name a nested key or carry the column's own name as a
    prefix: the literal path is tried first, then the path without the prefix.
    """

    def __init__(self, metadata: Column, path: str):
        self.metadata = metadata
        self.paths = [_json_path(path)]
        if path.startswith(_PREFIX) and len(path) > len(_PREFIX):
            self.paths.append(_json_path(path[len(_PREFIX):]))

    def read(self, kind: str) -> Column:
        found = [F.try_variant_get(self.metadata, path, kind) for path in self.paths]
        if len(found) == 1:
            return found[0]
        literal = F.try_variant_get(self.metadata, self.paths[0], "variant")
        return F.when(literal.isNotNull(), found[0]).otherwise(found[1])

    def is_kind(self, kind: str) -> Column:
        found = F.schema_of_variant(self.read("variant"))
        return found.rlike(_NUMBER_KINDS) if kind == "number" else found == F.lit(kind.upper())


def _comparison(value: _Value, op: str, arg) -> Column:
    if op == "$eq":
        return _equals(value, arg)
    if op == "$ne":
        return _negate(_equals(value, arg))
    if op in ("$in", "$nin"):
        if not isinstance(arg, (list, tuple)):
            raise ValueError(f"{op} needs a list")
        found = _member(value, list(arg))
        return found if op == "$in" else _negate(found)
    if op == "$exists":
        found = value.read("variant")
        return found.isNotNull() if arg else found.isNull()
    if op == "$not":
        if not isinstance(arg, dict) or not arg:
            raise ValueError("$not needs an operator dict")
        return _negate(reduce(and_, [_comparison(value, o, a) for o, a in arg.items()]))
    if op in ("$gt", "$gte", "$lt", "$lte"):
        return _ordered(value, op, arg)
    raise ValueError(f"unknown filter operator {op!r}")


def _ordered(value: _Value, op: str, arg) -> Column:
    if _is_number(arg):
        left, gate, right = value.read("double"), value.is_kind("number"), F.lit(float(arg))
    elif isinstance(arg, str):
        left, gate, right = value.read("string"), value.is_kind("string"), F.lit(arg)
    else:
        raise ValueError(f"{op} compares with a number or a string, got {arg!r}")
    tests = {"$gt": left > right, "$gte": left >= right, "$lt": left < right, "$lte": left <= right}
    if _is_number(arg) and _EXACT_DOUBLE < abs(arg) < _EXACT_DECIMAL:
        # Rounding keeps the order of different doubles; numbers this large may share one.
        exact, bound = value.read("decimal(38,0)"), F.lit(str(int(arg))).cast("decimal(38,0)")
        ties = {"$gt": exact > bound, "$gte": exact >= bound, "$lt": exact < bound, "$lte": exact <= bound}
        strict = left > right if op in ("$gt", "$gte") else left < right
        return (strict | ((left == right) & ties[op])) & gate
    return tests[op] & gate


def _equals(value: _Value, expected) -> Column:
    if expected is None:
        found = value.read("variant")
        return found.isNull() | F.coalesce(F.is_variant_null(found), F.lit(False))
    if isinstance(expected, bool):
        return (value.read("boolean") == F.lit(expected)) & value.is_kind("boolean")
    if _is_number(expected):
        return _number_equals(value, expected) & value.is_kind("number")
    if isinstance(expected, str):
        return (value.read("string") == F.lit(expected)) & value.is_kind("string")
    if isinstance(expected, (list, tuple, dict)):
        wanted = F.to_json(F.parse_json(F.lit(json.dumps(expected))))
        return F.to_json(value.read("variant")) == wanted
    raise ValueError(f"unsupported filter value {expected!r}")


def _number_equals(value: _Value, expected) -> Column:
    same = value.read("double") == F.lit(float(expected))
    if isinstance(expected, int) and _EXACT_DOUBLE < abs(expected) < 1 << 63:
        # Neighbouring integers this large share one double.
        same = same & (value.read("decimal(38,0)") == F.lit(expected).cast("decimal(38,0)"))
    return same


def _member(value: _Value, options: list) -> Column:
    """One IN list per kind, so that a long list is looked up as a set."""
    strings = [o for o in options if isinstance(o, str)]
    numbers = [o for o in options if _is_number(o) and abs(o) <= _EXACT_DOUBLE]
    tests = []
    if strings:
        tests.append(value.read("string").isin(strings) & value.is_kind("string"))
    if numbers:
        tests.append(value.read("double").isin([float(n) for n in numbers]) & value.is_kind("number"))
    for option in options:
        if not isinstance(option, str) and not (_is_number(option) and abs(option) <= _EXACT_DOUBLE):
            tests.append(_equals(value, option))
    return reduce(or_, tests) if tests else F.lit(False)


def _json_path(path: str) -> str:
    steps = path.split(".")
    if not all(steps):
        raise ValueError(f"malformed metadata path {path!r}")
    return "$" + "".join(f".{s}" if _PLAIN_KEY.fullmatch(s) else f"[{json.dumps(s, ensure_ascii=False)}]" for s in steps)


def _is_number(value) -> bool:
    return isinstance(value, (int, float)) and not isinstance(value, bool) and math.isfinite(value)


def _negate(test: Column) -> Column:
    return ~F.coalesce(test, F.lit(False))
