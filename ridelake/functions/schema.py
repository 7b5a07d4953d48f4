"""Parsing into, conforming to and comparing with a schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    NullType,
    ShortType,
    StructField,
    StructType,
    TimestampNTZType,
)


def parse_json(text: Column | str, schema: StructType) -> Column:
    """JSON text as a struct; unparsable text gives NULL fields, never an error."""
    return F.from_json(text, schema)


def enforce_schema(df: DataFrame, schema: StructType, cast: bool = False) -> DataFrame:
    """Exactly the columns of ``schema``, in its order.

    Missing columns become typed NULLs and others are dropped. Types of present
    columns stay as they are unless ``cast`` is set; a value that does not fit
    the target type is then NULL.
    """
    present = set(df.columns)

    def column(field) -> Column | str:
        if field.name not in present:
            return F.lit(None).cast(field.dataType).alias(field.name)
        found = f"`{field.name}`"
        if not cast or (have := df.schema[field.name].dataType) == field.dataType:
            return found
        return _converted(F.col(found), have, field.dataType).alias(field.name)

    return df.select([column(field) for field in schema.fields])


def _converted(column: Column, have: DataType, want: DataType) -> Column:
    """As ``want``; fields of structs by name, where a cast would go by place."""
    if isinstance(have, StructType) and isinstance(want, StructType):
        own = {field.name: field.dataType for field in have.fields}
        fields = [
            (_converted(column[f.name], own[f.name], f.dataType) if f.name in own else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in want.fields
        ]
        return F.when(column.isNotNull(), F.struct(*fields))
    if isinstance(have, ArrayType) and isinstance(want, ArrayType):
        return F.transform(column, lambda element: _converted(element, have.elementType, want.elementType))
    if isinstance(have, MapType) and isinstance(want, MapType) and have.keyType == want.keyType:
        return F.transform_values(column, lambda _, value: _converted(value, have.valueType, want.valueType))
    return column.try_cast(want)


def validate_schema(df: DataFrame, schema: StructType) -> bool:
    """Same column names and types in the same order; nullability is ignored."""
    return _shape(df.schema) == _shape(schema)


def _shape(schema: StructType) -> list[tuple]:
    return [(field.name, field.dataType) for field in schema.fields]


# Whole numbers, and the digits that hold them; fractions.
_WHOLE = {ByteType: 3, ShortType: 5, IntegerType: 10, LongType: 19}
_FRACTIONS = (FloatType, DoubleType)


def common_type(old: DataType, new: DataType) -> DataType | None:
    """The narrowest type that holds every value of both exactly, or None; structs are merged field by field.

    Whole numbers grow to longer ones, to decimals, and to the fractions that hold all their digits (24 bits in a
    float, 53 in a double); decimals grow on both sides of the point; dates become timestamps without a zone.
    """
    if old == new:
        return old
    if isinstance(old, StructType) and isinstance(new, StructType):
        try:
            return merge_schemas(old, new)
        except ValueError:
            return None
    if isinstance(old, ArrayType) and isinstance(new, ArrayType):
        element = common_type(old.elementType, new.elementType)
        return element and ArrayType(element, old.containsNull or new.containsNull)
    if isinstance(old, MapType) and isinstance(new, MapType):
        value = common_type(old.valueType, new.valueType) if old.keyType == new.keyType else None
        return value and MapType(old.keyType, value, old.valueContainsNull or new.valueContainsNull)
    if isinstance(old, NullType) or isinstance(new, NullType):
        return new if isinstance(old, NullType) else old
    kinds = {type(old), type(new)}
    if kinds == {DateType, TimestampNTZType}:
        return TimestampNTZType()
    if kinds <= set(_WHOLE):
        return max(old, new, key=lambda kind: _WHOLE[type(kind)])
    if kinds == set(_FRACTIONS):
        return DoubleType()
    if kinds & set(_FRACTIONS) and kinds & set(_WHOLE):
        whole = next(kind for kind in kinds if kind in _WHOLE)
        if whole is LongType:
            return None
        return FloatType() if FloatType in kinds and whole in (ByteType, ShortType) else DoubleType()
    if kinds <= {DecimalType, *_WHOLE}:
        one, other = (_decimal(kind) for kind in (old, new))
        scale = max(one.scale, other.scale)
        digits = max(one.precision - one.scale, other.precision - other.scale) + scale
        return DecimalType(digits, scale) if digits <= 38 else None
    return None


def _decimal(kind: DataType) -> DecimalType:
    return kind if isinstance(kind, DecimalType) else DecimalType(_WHOLE[type(kind)], 0)


def merge_schemas(old: StructType, new: StructType) -> StructType:
    """Columns of ``old``, then those only ``new`` has; a changed type becomes one that holds both, or is an error."""
    added = {field.name: field for field in new.fields}
    merged = []
    for field in old.fields:
        other = added.pop(field.name, None)
        kind = common_type(field.dataType, other.dataType) if other else field.dataType
        if kind is None:
            raise ValueError(
                f"column {field.name} is {field.dataType.simpleString()} in the table "
                f"and {other.dataType.simpleString()} in the new data"
            )
        merged.append(StructField(field.name, kind, field.nullable or other is None or other.nullable))
    return StructType(merged + list(added.values()))
