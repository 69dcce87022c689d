"""Derived features as column expressions.

Division by zero gives NULL (``try_divide``) rather than an infinity.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gramlark.functions.expressions import flag
from gramlark.functions.quantiles import quantile_map
from gramlark.operators.correlate import target_correlations
from gramlark.schema import TARGET, numeric_columns

# Fixed values of the feature definitions.
LONGITUDE_CENTER, LATITUDE_CENTER = -118.0, 34.0
NEW_HOUSE_AGE, OLD_HOUSE_AGE = 10.0, 30.0
HIGH_INCOME_QUANTILE, LOW_POPULATION_QUANTILE = 0.75, 0.25
LOGGED = ["total_rooms", "total_bedrooms", "population", "households"]

RATIO_FEATURES = [
    "rooms_per_household", "bedrooms_per_room", "population_per_household",
    "income_per_person", "income_to_rooms_ratio",
]


def ratio_features(df: DataFrame) -> DataFrame:
    df = df.withColumns(
        {
            "rooms_per_household": F.try_divide("total_rooms", "households"),
            "bedrooms_per_room": F.try_divide("total_bedrooms", "total_rooms"),
            "population_per_household": F.try_divide("population", "households"),
        }
    )
    return df.withColumns(
        {
            "income_per_person": F.try_divide("median_income", "population_per_household"),
            "income_to_rooms_ratio": F.try_divide("median_income", "rooms_per_household"),
        }
    )


def location_features(df: DataFrame) -> DataFrame:
    dx = F.col("longitude") - F.lit(LONGITUDE_CENTER)
    dy = F.col("latitude") - F.lit(LATITUDE_CENTER)
    return df.withColumn("location_score", F.sqrt(dx * dx + dy * dy))


def age_features(df: DataFrame) -> DataFrame:
    age = F.col("housing_median_age")
    return df.withColumns(
        {"is_new_house": flag(age <= NEW_HOUSE_AGE), "is_old_house": flag(age >= OLD_HOUSE_AGE)}
    )


def density_features(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "population_density": F.try_divide("population", "total_rooms"),
            "room_density": F.try_divide("total_rooms", "households"),
        }
    )


def log_features(df: DataFrame, columns: list[str] = LOGGED) -> DataFrame:
    return df.withColumns({f"log_{c}": F.log1p(c) for c in columns})


@dataclass
class Deriver:
    """All derived features; the two quantile thresholds are fitted."""

    income_threshold: float | None = None
    population_threshold: float | None = None

    def fit(self, df: DataFrame) -> "Deriver":
        probs = [LOW_POPULATION_QUANTILE, HIGH_INCOME_QUANTILE]
        q = quantile_map(df, ["median_income", "population"], probs)
        self.income_threshold = q["median_income"][1]
        self.population_threshold = q["population"][0]
        return self

    def threshold_features(self, df: DataFrame) -> DataFrame:
        return df.withColumns(
            {
                "high_income_area": flag(F.col("median_income") > F.lit(self.income_threshold)),
                "low_population_area": flag(F.col("population") < F.lit(self.population_threshold)),
            }
        )

    def transform(self, df: DataFrame) -> DataFrame:
        df = density_features(age_features(location_features(ratio_features(df))))
        df = self.threshold_features(df)
        df = df.withColumns(
            {
                "age_income_interaction": F.col("housing_median_age") * F.col("median_income"),
                "location_income_interaction": F.col("location_score") * F.col("median_income"),
            }
        )
        return log_features(df)


def polynomial_features(
    df: DataFrame, degree: int = 2, features: list[str] | None = None, target: str = TARGET, top: int = 5
) -> DataFrame:
    """Powers 2..degree of each feature, named ``<f>_<f>^k``.

    Without a list: the ``top`` columns by absolute correlation with the
    target, or the first numeric columns if the table has no target.
    """
    if features is None:
        if target in df.columns:
            features = [c for c, _ in target_correlations(df, target)][:top]
        else:
            features = numeric_columns(df)[:top]
    new = {}
    for f in features:
        if f not in df.columns:
            continue
        power = F.col(f)
        for k in range(2, degree + 1):
            power = power * F.col(f)
            new[f"{f}_{f}^{k}"] = power
    return df.withColumns(new) if new else df
