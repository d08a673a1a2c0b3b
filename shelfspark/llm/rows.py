"""Rows as users have them: helper columns that clash with none of theirs, and rows told apart by all that they hold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, with as many underscores after them as it takes to be no column of ``df``, whatever the case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n += "_"
        taken.add(n.lower())
        out.append(n)
    return out


def _hashable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_hashable(f.dataType) for f in kind)
    return _hashable(kind.elementType) if isinstance(kind, T.ArrayType) else not isinstance(kind, (T.MapType, T.VariantType))


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def row_hash(df: DataFrame) -> Column:
    """A 64-bit hash of all values of a row; maps and variants go by their JSON."""
    return F.xxhash64(*[quoted(f.name) if _hashable(f.dataType) else F.to_json(F.struct(quoted(f.name))) for f in df.schema])


def id_key(column: str = "doc_id") -> dict[str, Column]:
    """An id as columns of a key that tell null from every number."""
    x = F.col(column).cast("long")
    return {"none": x.isNull(), "id": F.coalesce(x, F.lit(0))}


def packed(df: DataFrame, key: dict[str, Column]) -> DataFrame:
    """The columns of ``key``, ``hash`` of all values, and ``row``, which holds all columns of ``df`` under their own names."""
    return df.select(*[c.alias(n) for n, c in key.items()], row_hash(df).alias("hash"), F.struct(*map(quoted, df.columns)).alias("row"))


def one_of_each(df: DataFrame, key: dict[str, Column], wanted: DataFrame) -> DataFrame:
    """The rows of ``df`` whose key is in ``wanted``, one for each key; of rows that differ, that with the least hash
    of all its values. Join and choice share one shuffle."""
    rows = packed(df, key).join(wanted, list(key), "left_semi")
    return rows.groupBy(*key).agg(F.min_by("row", "hash").alias("row")).select("row.*")
