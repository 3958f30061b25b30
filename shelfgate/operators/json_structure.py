"""What JSON text holds: every path with its types and counts, and columns for every path.

Text is parsed once per level into a variant; ``variant_explode`` takes
objects and arrays apart. Each level is one aggregation of ``(column, path,
type)`` counts, combined map-side; the levels end when no value holds
others. The counts stay on the executors: keys may be many.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.schema import col
from ..session import materialize

INVALID = "INVALID"
MAX_COLUMNS = 1000
_PLAIN = r"^[A-Za-z_][A-Za-z0-9_]*$"
# types that extraction casts to; other mixtures come out as text
_NUMBERS = {"BIGINT", "DECIMAL", "DOUBLE", "FLOAT"}
_SCALARS = {"BIGINT": "bigint", "DOUBLE": "double", "FLOAT": "double", "DECIMAL": "double", "BOOLEAN": "boolean",
            "STRING": "string"}


def json_paths(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, path, type, n_values) of the JSON text in ``columns``.

    ``path`` is ``$`` for the whole text, ``$.key`` (``$["a key"]`` where the key is no plain word)
    for a member, ``[*]`` for the elements of an array, of which each counts. ``type`` is OBJECT,
    ARRAY, BIGINT, DECIMAL, DOUBLE, STRING, BOOLEAN or VOID (null); text that is no JSON has the
    type INVALID. Null text does not count.
    """
    texts = F.array(*[F.struct(F.lit(c).alias("column"), col(c).cast("string").alias("text")) for c in columns])
    level = (df.select(F.inline(texts)).where(F.col("text").isNotNull())
             .select("column", F.lit("$").alias("path"), F.try_parse_json("text").alias("v")))
    found = []
    while True:
        kind = F.when(F.col("v").isNull(), INVALID).otherwise(F.regexp_extract(F.schema_of_variant("v"), r"^[A-Z_]+", 0))
        counts = materialize(level.groupBy("column", "path", kind.alias("type")).agg(F.count(F.lit(1)).alias("n_values")),
                             "json-paths")
        found.append(counts)
        if not counts.where(F.col("type").isin("OBJECT", "ARRAY")).take(1):
            return reduce(lambda a, b: a.unionAll(b), found)
        spark = df.sparkSession
        held = level.where(F.col("v").isNotNull())
        taken = held.lateralJoin(spark.tvf.variant_explode(F.col("v").outer()).select(F.col("key"), F.col("value")))
        quoted = F.concat(F.lit("["), F.to_json(F.array("key")).substr(F.lit(2), F.length(F.to_json(F.array("key"))) - 2),
                          F.lit("]"))
        step = (F.when(F.col("key").isNull(), F.lit("[*]"))
                .when(F.col("key").rlike(_PLAIN), F.concat(F.lit("."), "key")).otherwise(quoted))
        level = taken.select("column", F.concat("path", step).alias("path"), F.col("value").alias("v"))


def scalar_columns(paths: DataFrame, max_columns: int = MAX_COLUMNS) -> dict[tuple[str, str], str]:
    """(column, path) -> type of every scalar that is not in an array, by column and path.

    Numbers of several kinds are double, other mixtures text; a path that only ever holds null is
    left out. More than ``max_columns`` paths raise: keys are then data, not columns.
    """
    scalars = (paths.where(~F.col("type").isin(INVALID, "OBJECT", "ARRAY", "VOID") & ~F.col("path").contains("[*]"))
               .where(F.col("path") != "$").groupBy("column", "path").agg(F.collect_set("type").alias("types")))
    rows = scalars.orderBy("column", "path").limit(max_columns + 1).collect()
    if len(rows) > max_columns:
        raise ValueError(f"more than {max_columns} paths; raise max_columns if they are to be columns")
    out = {}
    for r in rows:
        types = set(r["types"])
        one = next(iter(types))
        out[r["column"], r["path"]] = (_SCALARS.get(one, "string") if len(types) == 1
                                       else "double" if types <= _NUMBERS else "string")
    return out


def extract_json(df: DataFrame, columns: list[str], found: dict[tuple[str, str], str] | None = None) -> DataFrame:
    """``df`` plus a column for every scalar path of the JSON text in ``columns``, named ``column.path``
    (``Store_Info.store_id``); null where a row does not have it or holds no JSON.

    ``found`` (see :func:`scalar_columns`) fixes the columns; without it they are looked for first.
    """
    found = scalar_columns(json_paths(df, columns)) if found is None else found
    parsed = {c: F.try_parse_json(col(c)) for c in columns}
    new = []
    for (c, path), kind in found.items():
        name = f"{c}.{path[2:]}" if path.startswith("$.") else f"{c}.{json.loads(path[1:])[0] if path.count('[') == 1 else path}"
        new.append(F.try_variant_get(parsed[c], path, kind).alias(name))
    return df.select(*[col(c) for c in df.columns], *new)
