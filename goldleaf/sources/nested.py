"""Schema evolution at any depth: fields that appear inside structs, arrays and maps become nested fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def merge_types(known: T.DataType, found: T.DataType) -> T.DataType:
    """``known`` widened by the fields of ``found`` at every depth.

    Known fields keep their place and their type (a value that does not fit is for the rescue column); new ones follow in the order found.
    A type that says nothing (void) gives way to the other. Everything is nullable.
    """
    if isinstance(known, T.NullType):
        return found
    if isinstance(known, T.StructType) and isinstance(found, T.StructType):
        new = {f.name: f.dataType for f in found.fields}
        fields = [T.StructField(f.name, merge_types(f.dataType, new[f.name]) if f.name in new else f.dataType, True, f.metadata) for f in known.fields]
        return T.StructType(fields + [T.StructField(f.name, f.dataType, True, f.metadata) for f in found.fields if f.name not in known.names])
    if isinstance(known, T.ArrayType) and isinstance(found, T.ArrayType):
        return T.ArrayType(merge_types(known.elementType, found.elementType), True)
    if isinstance(known, T.MapType) and isinstance(found, T.MapType):
        return T.MapType(known.keyType, merge_types(known.valueType, found.valueType), True)
    return known


def aligned(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """``value`` of type ``have`` rewritten to ``want``: absent fields are NULL, a NULL struct, array or map stays NULL.

    Fields are matched by name and surplus ones dropped; leaves are cast with ``try_cast``, as is a value whose shape is another one (to NULL where it cannot be).
    """
    if have == want:
        return value
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        own = {f.name: f.dataType for f in have.fields}
        fields = [(aligned(value[f.name], own[f.name], f.dataType) if f.name in own else F.lit(None).cast(f.dataType)).alias(f.name) for f in want.fields]
        return F.when(value.isNotNull(), F.struct(*fields)) if fields else value
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.transform(value, lambda x: aligned(x, have.elementType, want.elementType))
    if isinstance(have, T.MapType) and isinstance(want, T.MapType) and have.keyType == want.keyType:
        return F.transform_values(value, lambda k, v: aligned(v, have.valueType, want.valueType))
    nested = (T.StructType, T.ArrayType, T.MapType)
    if isinstance(have, nested) or isinstance(want, nested):
        return F.lit(None).cast(want)
    return value.try_cast(want)


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with exactly the columns of ``schema``, rewritten where their types differ."""
    have = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[(aligned(F.col(_quoted(f.name)), have[f.name], f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
                       for f in schema.fields])


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def union_evolved(older: DataFrame, newer: DataFrame) -> DataFrame:
    """UNION ALL by name under the merged schema: a field that only one side has, at any depth, is NULL in the rows of the other."""
    schema = merge_types(older.schema, newer.schema)
    return align(older, schema).union(align(newer, schema))
