"""The narrowest type that holds the values of two: how a column grows when its source does."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import types as T

# Whole-number types from the narrowest on, with the digits their values have at most.
WHOLE = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}
_MOST_DIGITS = 38
_TIMES = (T.DateType, T.TimestampNTZType, T.TimestampType)
_SMALL = (T.ByteType, T.ShortType)  # all of whose values a float has


def widest(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The type for values of both, whichever comes first; None if there is none.

    Whole numbers and decimals grow until 38 digits are not enough, and then, like a mix of any other
    plain types, become text, which loses nothing. Only whole numbers and decimals that meet
    floating-point ones become doubles, as these stand for rounded values. A date becomes a time.
    """
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        inner = widest(a.elementType, b.elementType)
        return inner and T.ArrayType(inner, a.containsNull or b.containsNull)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        key, value = widest(a.keyType, b.keyType), widest(a.valueType, b.valueType)
        return T.MapType(key, value, a.valueContainsNull or b.valueContainsNull) if key and value else None
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        inner = [widest(x.dataType, y.dataType) for x, y in zip(a.fields, b.fields)]
        if a.fieldNames() != b.fieldNames() or None in inner:
            return None
        return T.StructType([T.StructField(f.name, kind, True) for f, kind in zip(a.fields, inner)])
    if any(isinstance(x, (T.ArrayType, T.MapType, T.StructType, T.BinaryType)) for x in (a, b)):
        return None
    kinds = (type(a), type(b))
    if all(k in WHOLE for k in kinds):
        return max(kinds, key=WHOLE.__getitem__)()
    if all(k in _TIMES for k in kinds):
        return max(kinds, key=_TIMES.index)()
    if all(isinstance(x, T.NumericType) for x in (a, b)):
        if any(isinstance(x, T.FractionalType) and not isinstance(x, T.DecimalType) for x in (a, b)):
            return T.FloatType() if all(k in (T.FloatType, *_SMALL) for k in kinds) else T.DoubleType()
        (p, s), (q, t) = (_digits(x) for x in (a, b))
        scale = max(s, t)
        precision = max(p - s, q - t) + scale
        return T.DecimalType(precision, scale) if precision <= _MOST_DIGITS else T.StringType()
    return T.StringType()


def _digits(kind: T.DataType) -> tuple[int, int]:
    return (kind.precision, kind.scale) if isinstance(kind, T.DecimalType) else (WHOLE[type(kind)], 0)


def widest_fields(schemas: list[T.StructType]) -> T.StructType:
    """All columns of the schemas, in order of first appearance, each with the type for the values of all."""

    def grown(all_: dict[str, T.DataType], schema: T.StructType) -> dict[str, T.DataType]:
        for f in schema.fields:
            kind = widest(all_.get(f.name, f.dataType), f.dataType)
            if kind is None:
                raise TypeError(f"column {f.name!r} is {all_[f.name].simpleString()} and {f.dataType.simpleString()}, which no type holds both")
            all_[f.name] = kind
        return all_

    return T.StructType([T.StructField(name, kind, True) for name, kind in reduce(grown, schemas, {}).items()])
