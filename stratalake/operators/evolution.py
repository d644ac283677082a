"""Rows written under different schemas as one table.

Columns are matched by name as Spark resolves it: without regard to case, unless the session is case
sensitive. A column that one side lacks is NULL there; types that differ become their least common
type:

* whole numbers: the wider one; with decimals: a decimal that holds both, a double beyond 38 digits
* floating point with any other number: double
* date and timestamp: timestamp
* structs, arrays and maps: field by field, element by element
* any other two plain types: text
* plain against nested: an error that names the column
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Digits of the whole-number types, from narrow to wide.
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}
_NESTED = (T.StructType, T.ArrayType, T.MapType)
_MOST_DIGITS = 38


def _as_decimal(kind: T.DataType) -> T.DecimalType | None:
    if isinstance(kind, T.DecimalType):
        return kind
    return T.DecimalType(_DIGITS[type(kind)], 0) if type(kind) in _DIGITS else None


def _wider_number(a: T.DataType, b: T.DataType) -> T.DataType:
    if type(a) in _DIGITS and type(b) in _DIGITS:
        return max(a, b, key=lambda kind: _DIGITS[type(kind)])
    left, right = _as_decimal(a), _as_decimal(b)
    if left is None or right is None:
        return T.DoubleType()
    scale = max(left.scale, right.scale)
    whole = max(left.precision - left.scale, right.precision - right.scale)
    return T.DecimalType(whole + scale, scale) if whole + scale <= _MOST_DIGITS else T.DoubleType()


def least_common_type(a: T.DataType, b: T.DataType, path: str = "", exact_case: bool = False) -> T.DataType:
    """The narrowest type that takes the values of both."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        return _wider_number(a, b)
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return reconciled([a, b], path, exact_case)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        element = least_common_type(a.elementType, b.elementType, f"{path}.element", exact_case)
        return T.ArrayType(element, a.containsNull or b.containsNull)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(
            least_common_type(a.keyType, b.keyType, f"{path}.key", exact_case),
            least_common_type(a.valueType, b.valueType, f"{path}.value", exact_case),
            a.valueContainsNull or b.valueContainsNull,
        )
    if isinstance(a, _NESTED) or isinstance(b, _NESTED):
        raise ValueError(f"column {path}: {a.simpleString()} and {b.simpleString()} have no common type")
    days = (T.DateType, T.TimestampType, T.TimestampNTZType)
    if isinstance(a, days) and isinstance(b, days):
        zoned = isinstance(a, T.TimestampType) or isinstance(b, T.TimestampType)
        return T.TimestampType() if zoned else T.TimestampNTZType()
    return T.StringType()


def reconciled(
    schemas: Iterable[T.StructType], path: str = "", exact_case: bool = False
) -> T.StructType:
    """All columns of all schemas, in the order and spelling in which they are first met."""
    fields: dict[str, T.StructField] = {}
    for schema in schemas:
        for field in schema.fields:
            key = field.name if exact_case else field.name.lower()
            known = fields.get(key)
            if known is None:
                fields[key] = T.StructField(field.name, field.dataType, True)
            else:
                at = f"{path}.{field.name}" if path else field.name
                kind = least_common_type(known.dataType, field.dataType, at, exact_case)
                fields[key] = T.StructField(known.name, kind, True)
    return T.StructType(list(fields.values()))


def _converted(value: Column, have: T.DataType, want: T.DataType, exact_case: bool) -> Column:
    if have == want:
        return value
    if isinstance(want, T.StructType):
        own = {f.name if exact_case else f.name.lower(): f for f in have.fields}
        parts = []
        for field in want.fields:
            mine = own.get(field.name if exact_case else field.name.lower())
            part = F.lit(None).cast(field.dataType)
            if mine is not None:
                part = _converted(value.getField(mine.name), mine.dataType, field.dataType, exact_case)
            parts.append(part.alias(field.name))
        return F.when(value.isNotNull(), F.struct(*parts))
    if isinstance(want, T.ArrayType):
        return F.transform(
            value, lambda x: _converted(x, have.elementType, want.elementType, exact_case)
        )
    if isinstance(want, T.MapType):
        values = F.transform_values(
            value, lambda _, v: _converted(v, have.valueType, want.valueType, exact_case)
        )
        return F.transform_keys(
            values, lambda k, _: _converted(k, have.keyType, want.keyType, exact_case)
        )
    return value.cast(want)


def aligned(df: DataFrame, want: T.StructType, exact_case: bool = False) -> DataFrame:
    """``df`` with the columns and types of ``want``; columns it lacks are NULL."""
    own = {f.name if exact_case else f.name.lower(): f for f in df.schema.fields}
    columns = []
    for field in want.fields:
        mine = own.get(field.name if exact_case else field.name.lower())
        if mine is None:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
        else:
            value = _converted(df[f"`{mine.name}`"], mine.dataType, field.dataType, exact_case)
            columns.append(value.alias(field.name))
    return df.select(*columns)


def united(frames: Iterable[DataFrame], exact_case: bool = False) -> DataFrame:
    """The rows of all frames under their reconciled schema."""
    frames = list(frames)
    want = reconciled([f.schema for f in frames], exact_case=exact_case)
    whole, *more = [aligned(f, want, exact_case) for f in frames]
    for frame in more:
        whole = whole.unionAll(frame)
    return whole


def schema_changes(before: T.StructType, after: T.StructType) -> list[tuple[str, str, str | None, str | None]]:
    """``(column, change, type before, type after)`` by name; change: added, removed, widened (to the
    least common type) or changed."""
    old = {f.name.lower(): f for f in before.fields}
    new = {f.name.lower(): f for f in after.fields}
    found = []
    for key in sorted(old.keys() | new.keys()):
        a, b = old.get(key), new.get(key)
        name = (b or a).name
        if a is None:
            found.append((name, "added", None, b.dataType.simpleString()))
        elif b is None:
            found.append((name, "removed", a.dataType.simpleString(), None))
        elif a.dataType != b.dataType:
            try:
                widened = least_common_type(a.dataType, b.dataType) == b.dataType
            except ValueError:
                widened = False
            kinds = a.dataType.simpleString(), b.dataType.simpleString()
            found.append((name, "widened" if widened else "changed", *kinds))
    return found
