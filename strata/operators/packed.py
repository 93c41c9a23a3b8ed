"""Wide rows on the move: many columns as one text.

A row of a shuffle spends eight bytes and more on every column.  Attributes that
are short codes travel as one text instead and are taken apart behind the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BooleanType, IntegralType, StringType, StructType

#: Between values, and in place of a null.
SEPARATOR, NULL = "\x1f", "\x1e"


def pack(df: DataFrame, columns: list[str], name: str = "_packed") -> DataFrame:
    """``df`` with ``columns`` (texts, integers, booleans) in the columns ``name`` and ``name + "_odd"``.

    ``name`` is the joined text; a row whose texts hold one of the two marks has an array of its values in
    the other column instead.  ``unpack`` gives back the same values, nulls and empty texts included."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    for c in columns:
        if not packable(kinds[c]):
            raise ValueError(f"column {c!r} is neither a text, nor an integer, nor a boolean")
    values = F.array(*[F.col(c).cast("string") for c in columns])
    texts = [F.col(c) for c in columns if isinstance(kinds[c], StringType)]
    odd = F.concat_ws("", *texts).rlike(f"[{NULL}{SEPARATOR}]") if texts else F.lit(False)
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.when(~odd, F.array_join(values, SEPARATOR, NULL)).alias(name),
                     F.when(odd, values).alias(f"{name}_odd"))


def unpack(df: DataFrame, columns: list[str], schema: StructType, name: str = "_packed") -> DataFrame:
    """What ``pack`` packed: ``columns`` as ``schema`` has them, after the others."""
    parts = F.transform(F.split(name, SEPARATOR, -1), lambda v: F.when(v != NULL, v))
    kept = [c for c in df.columns if c not in (name, f"{name}_odd")]
    rows = df.select(*kept, F.coalesce(f"{name}_odd", parts).alias(name))
    return rows.select(*kept, *[F.get(name, F.lit(i)).cast(schema[c].dataType).alias(c) for i, c in enumerate(columns)])


def packable(kind) -> bool:
    return isinstance(kind, (IntegralType, BooleanType)) or kind == StringType()


def together(df: DataFrame, keys: list[str], plain: list[str] = ()) -> DataFrame:
    """``df`` with all rows of equal ``keys`` in one partition, by one shuffle that later windows and joins
    on the keys share.  Columns that can be packed travel so, but for ``keys`` and ``plain``."""
    packed = [f.name for f in df.schema.fields if f.name not in (*keys, *plain) and packable(f.dataType)]
    if len(packed) < 2:
        return df.repartition(*keys)
    return unpack(pack(df, packed).repartition(*keys), packed, df.schema).select(*df.columns)
