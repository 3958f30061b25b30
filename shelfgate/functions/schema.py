"""Canonical listing schema, required columns and type families.

The canonical schema is defined once here; every other module asks this
module for names, types and the required set.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    FloatType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# --- fixed values: the canonical listing schema (name, type, nullable) -----
CANONICAL = StructType([
    StructField("Run_Date", TimestampType(), False),
    StructField("Retailer", StringType(), False),
    StructField("Retailer_Website", StringType(), True),
    StructField("Store_Info", StringType(), False),
    StructField("Category_Traversal", StringType(), False),
    StructField("Brand", StringType(), False),
    StructField("Product_Name", StringType(), False),
    StructField("Product_ID", StringType(), False),
    StructField("Universal_Product_ID", StringType(), True),
    StructField("Variant_Info", StringType(), False),
    StructField("Size_Or_Quantity", StringType(), False),
    StructField("Number_Of_Reviews", FloatType(), True),
    StructField("Average_Rating", FloatType(), True),
    StructField("Original_Price", FloatType(), True),
    StructField("Sale_Price", FloatType(), True),
    StructField("Currency", StringType(), True),
    StructField("Url", StringType(), True),
    StructField("In_Stock", BooleanType(), False),
])

# --- fixed values: audit duplicate key ------------------------------------
AUDIT_KEYS = ["Retailer", "Store_Info", "Product_ID", "Run_Date"]

# Lineage column carried next to the canonical columns.
SOURCE_FILE = "Source_File"


def col(name: str) -> Column:
    """Column by exact name (dots and spaces are part of the name, not paths)."""
    return F.col("`" + name.replace("`", "``") + "`")


def free_prefix(columns: list[str]) -> str:
    """A start of names that no given column has."""
    start = "_"
    while any(c.lower().startswith(start) for c in columns):
        start += "_"
    return start


def canonical_names(schema: StructType = CANONICAL) -> list[str]:
    return schema.fieldNames()


def required_names(schema: StructType = CANONICAL) -> list[str]:
    """Required columns are exactly the non-nullable canonical fields."""
    return [f.name for f in schema.fields if not f.nullable]


def eda_schema(schema: StructType = CANONICAL) -> StructType:
    """Exploration copy of the schema: 64-bit floats instead of 32-bit."""
    return StructType([
        StructField(f.name, _widen(f.dataType), f.nullable) for f in schema.fields
    ])


def _widen(t: DataType) -> DataType:
    from pyspark.sql.types import DoubleType

    return DoubleType() if isinstance(t, FloatType) else t


# --- type families --------------------------------------------------------
# A type name (Spark simpleString) maps to a family; two types are
# compatible when their families agree, plus one one-way rule: an actual
# timestamp may stand in for an expected date.
_FAMILY = {
    "tinyint": "integral", "smallint": "integral", "int": "integral",
    "bigint": "integral", "byte": "integral", "short": "integral",
    "integer": "integral", "long": "integral",
    "float": "fractional", "double": "fractional", "real": "fractional",
    "string": "string", "varchar": "string", "char": "string",
    "timestamp": "timestamp", "timestamp_ntz": "timestamp",
    "timestamp_ltz": "timestamp", "timestamp_ns": "timestamp",
    "date": "date",
    "boolean": "boolean",
    "binary": "binary",
}


def type_family(type_name: str) -> str:
    base = type_name.lower().split("(")[0].strip()
    return _FAMILY.get(base, base)


def types_compatible(actual: str, expected: str) -> bool:
    if actual.lower() == expected.lower():
        return True
    fa, fe = type_family(actual), type_family(expected)
    return fa == fe or (fa == "timestamp" and fe == "date")


def family_col(type_name: Column) -> Column:
    """Column version of :func:`type_family` (a map literal lookup, no join)."""
    m = F.create_map(*[x for k, v in _FAMILY.items() for x in (F.lit(k), F.lit(v))])
    base = F.lower(F.trim(F.split(type_name, r"\(").getItem(0)))
    return F.coalesce(F.element_at(m, base), base)


def compatible_col(actual: Column, expected: Column) -> Column:
    fa, fe = family_col(actual), family_col(expected)
    return (F.lower(actual) == F.lower(expected)) | (fa == fe) | (
        (fa == F.lit("timestamp")) & (fe == F.lit("date"))
    )


def schema_rows(schema: StructType) -> list[tuple[int, str, str, bool]]:
    """(ordinal, column, type, nullable) for each field, 1-based ordinal."""
    return [
        (i + 1, f.name, f.dataType.simpleString(), f.nullable)
        for i, f in enumerate(schema.fields)
    ]


# --- merging the types that the parts of one file give a column -------------
_INTEGRAL_ORDER = ["tinyint", "smallint", "int", "bigint"]
_WALL_CLOCK = ["date", "timestamp_ntz", "timestamp_ns"]


def merged_type(types: Column) -> Column:
    """The type that holds the values of all ``types`` (array of type names); null if there is none.

    Equal types stay. Integers widen to the widest; next to fractions they become double (integers
    beyond 2**53 are then rounded, as a reader of the whole file as double would). Decimals widen
    while 38 digits suffice. Dates and timestamps become timestamps. A column without values in a
    part (``void``) takes the type of the others.
    """
    given = F.array_sort(F.array_distinct(F.filter(types, lambda t: t != "void")))

    def among(names: list[str]) -> Column:
        return F.forall(given, lambda t: t.isin(names))

    def has(names: list[str]) -> Column:
        return F.exists(given, lambda t: t.isin(names))

    widest = F.lit("tinyint")
    for name in _INTEGRAL_ORDER:
        widest = F.when(F.array_contains(given, name), name).otherwise(widest)

    def digits(group: int) -> Column:
        return F.transform(given, lambda t: F.regexp_extract(t, r"^decimal\((\d+),(\d+)\)$", group).try_cast("int"))

    scale = F.array_max(digits(2))
    precision = F.array_max(F.zip_with(digits(1), digits(2), lambda a, b: a - b)) + scale
    return (F.when(F.size(given) == 0, "void")
            .when(F.size(given) == 1, F.element_at(given, 1))
            .when(among(_INTEGRAL_ORDER), widest)
            .when(among([*_INTEGRAL_ORDER, "float", "double"]),
                  F.when(has(["double", "int", "bigint"]), "double").otherwise("float"))
            .when(among(_WALL_CLOCK), "timestamp_ntz")
            .when(among([*_WALL_CLOCK, "timestamp"]), "timestamp")
            .when(F.forall(given, lambda t: t.startswith("decimal(")) & (precision <= 38),
                  F.concat(F.lit("decimal("), precision.cast("string"), F.lit(","), scale.cast("string"), F.lit(")"))))
