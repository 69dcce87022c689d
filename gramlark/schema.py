"""Column roles and schema checks (no data is read except by ``require_rows``)."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The raw table's column names, in file order.
LONGITUDE, LATITUDE = "longitude", "latitude"
TARGET = "median_house_value"
CATEGORY = "ocean_proximity"
NUMERIC = [
    "longitude",
    "latitude",
    "housing_median_age",
    "total_rooms",
    "total_bedrooms",
    "population",
    "households",
    "median_income",
]
RAW_COLUMNS = NUMERIC + [TARGET, CATEGORY]

RAW_SCHEMA = T.StructType(
    [T.StructField(c, T.DoubleType()) for c in NUMERIC + [TARGET]]
    + [T.StructField(CATEGORY, T.StringType())]
)


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in exclude
    ]


def string_columns(df: DataFrame, exclude=()) -> list[str]:
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.StringType) and f.name not in exclude
    ]


def column_roles(df: DataFrame, target: str = TARGET) -> dict[str, list[str]]:
    """Numerical, categorical and target columns by schema alone."""
    return {
        "numerical": numeric_columns(df, exclude=(target,)),
        "categorical": string_columns(df, exclude=(target,)),
        "target": [target] if target in df.columns else [],
    }


def split_target(df: DataFrame, target: str = TARGET) -> tuple[DataFrame, DataFrame]:
    return df.drop(target), df.select(target)


def require_columns(df: DataFrame, required=tuple(RAW_COLUMNS)) -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def check_types(df: DataFrame, expected: T.StructType = RAW_SCHEMA) -> list[str]:
    """Warn about columns whose kind differs from the expected schema."""
    actual = {f.name: f.dataType for f in df.schema.fields}
    problems = []
    for field in expected.fields:
        if field.name not in actual:
            continue
        numeric = isinstance(field.dataType, T.NumericType)
        if numeric != isinstance(actual[field.name], T.NumericType):
            problems.append(
                f"{field.name}: expected {field.dataType.simpleString()}, "
                f"got {actual[field.name].simpleString()}"
            )
    for p in problems:
        warnings.warn(p, stacklevel=2)
    return problems


def require_rows(df: DataFrame) -> DataFrame:
    if df.isEmpty():
        raise ValueError("the table has no rows")
    return df


def validate(df: DataFrame, required=tuple(RAW_COLUMNS)) -> DataFrame:
    require_columns(df, required)
    check_types(df)
    return require_rows(df)


def compare_columns(before: DataFrame, after: DataFrame) -> dict[str, list[str]]:
    """Column-name set operations between two tables, in schema order."""
    old, new = set(before.columns), set(after.columns)
    return {
        "common": [c for c in before.columns if c in new],
        "new": [c for c in after.columns if c not in old],
        "removed": [c for c in before.columns if c not in new],
    }


def nan_to_null(df: DataFrame) -> DataFrame:
    """One missing-value marker: NaN in floating columns becomes NULL."""
    floats = {
        f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    }
    return df.select(
        [
            F.when(~F.isnan(c), F.col(c)).alias(c) if c in floats else F.col(c)
            for c in df.columns
        ]
    )
