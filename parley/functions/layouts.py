"""One layout for records that spell a field as ``primaryTopics`` here and as ``primary_topics`` there."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def snake(name: str) -> str:
    """``primaryTopics`` and ``PrimaryTopics`` as ``primary_topics``; names in that form stay."""
    return re.sub(r"(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])", "_", name).lower()


def _filled(value: Column, dtype: T.DataType) -> Column:
    """NULL for what counts as missing: an empty text or list."""
    if isinstance(dtype, T.StringType):
        return F.when(value != "", value)
    if isinstance(dtype, T.ArrayType):
        return F.when(F.size(value) > 0, value)
    return value


def _merged(found: list[tuple[Column, T.DataType]]) -> tuple[Column, T.DataType]:
    """The values of one field under its several spellings as one value; the first that is filled counts."""
    types = [dtype for _, dtype in found]
    if all(isinstance(t, T.StructType) for t in types):
        fields: dict[str, list[tuple[Column, T.DataType]]] = {}
        for value, dtype in found:
            for f in dtype:
                fields.setdefault(snake(f.name), []).append((value[f.name], f.dataType))
        merged = {name: _merged(values) for name, values in fields.items()}
        present = reduce(lambda a, b: a | b, [value.isNotNull() for value, _ in found])
        whole = F.struct(*[value.alias(name) for name, (value, _) in merged.items()])
        return F.when(present, whole), T.StructType([T.StructField(name, dtype) for name, (_, dtype) in merged.items()])
    lists = [t for t in types if isinstance(t, T.ArrayType)]
    wanted = lists[0] if lists else types[0]
    values = []
    for value, dtype in found:
        value = _filled(value, dtype)
        if lists and not isinstance(dtype, T.ArrayType):
            value = F.when(value.isNotNull(), F.array(value))  # a single value is a list of one
        values.append(value.cast(wanted) if dtype != wanted else value)
    return F.coalesce(*values), wanted


def unified(value: Column, dtype: T.StructType) -> tuple[Column, T.StructType]:
    """A struct with every field, at any depth, under its snake_case name once.

    Of a field that occurs in several spellings the first in the schema's order counts that is filled in the row;
    structs are merged field by field, and a single value beside a list of such values is a list of one.
    """
    return _merged([(value, dtype)])
