"""The feature flow: impute, limit outliers, derive, cluster, encode, scale, select.

``fit`` runs the aggregates each step needs, in order, and keeps a small state.
``transform`` uses that state only: it is a projection (plus lookups of the
per-category and per-cluster state) and gives the same schema for any rows.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gramlark.functions.quantiles import to_long
from gramlark.operators.cluster import GeoClusters
from gramlark.operators.derive import Deriver
from gramlark.operators.encode import Encoder
from gramlark.operators.impute import Imputer
from gramlark.operators.outliers import Bounds, clip_outliers, outlier_bounds
from gramlark.operators.scale import Scaler
from gramlark.operators.select import select_features
from gramlark.schema import CATEGORY, RAW_COLUMNS, TARGET, numeric_columns
from gramlark.session import stage

STEPS = ("impute", "outliers", "derive", "cluster", "encode", "scale", "select")


@dataclass
class FeatureFlow:
    impute: str = "grouped_median"
    indicators: bool = True
    outlier_method: str = "iqr"
    outlier_threshold: float = 1.5
    clusters: int = 5
    cluster_starts: int = 10
    encoding: str = "onehot"
    scaling: str = "standard"
    selection: str | None = "hybrid"
    k_best: int = 20
    target: str = TARGET
    # True clips the missing-value indicators too, which erases them
    clip_indicators: bool = False
    keys: tuple[str, ...] = ("row_key", "fold")

    imputer: Imputer | None = None
    bounds: dict[str, Bounds] = field(default_factory=dict)
    deriver: Deriver | None = None
    geo: GeoClusters | None = None
    encoder: Encoder | None = None
    # means for what is still NULL when all columns are there (a ratio by zero, a new gap)
    fills: dict[str, float] = field(default_factory=dict)
    scaler: Scaler | None = None
    selected: list[str] = field(default_factory=list)
    fitted: bool = False

    def fit(self, df: DataFrame) -> "FeatureFlow":
        """Fit every step on the rows given: pass the training side only."""
        used = [c for c in df.columns if c in RAW_COLUMNS or c not in self.keys]
        # several passes follow: read the sources once
        data = stage(df.select(used), "flow-input")
        self.imputer = Imputer(self.impute, CATEGORY, self.indicators).fit(
            data, numeric_columns(data, exclude=(self.target,))
        )
        data = self.imputer.transform(data)
        skip = {self.target}
        if not self.clip_indicators:
            skip |= {f"{c}_is_missing" for c in self.imputer.columns}
        self.bounds = outlier_bounds(
            data, numeric_columns(data, exclude=skip), self.outlier_method, self.outlier_threshold
        )
        data = clip_outliers(data, self.bounds)
        self.deriver = Deriver().fit(data)
        data = self.deriver.transform(data)
        self.geo = GeoClusters(
            k=self.clusters, n_init=self.cluster_starts, target=self.target
        ).fit(data)
        data = self.geo.transform(data)
        self.encoder = Encoder(self.encoding, self.target).fit(data)
        # the derived columns are computed once and read by the remaining passes
        data = stage(self.encoder.transform(data), "flow-encoded")
        features = numeric_columns(data, exclude=(self.target,))
        if self._fit_fills(data, features):
            data = self._fill(data)
        self.scaler = Scaler(self.scaling, (self.target,)).fit(data)
        if self.selection and self.target in data.columns:
            self.selected = select_features(
                data, self.target, self.selection, self.k_best, features, self.scaler.params
            )
        else:
            self.selected = features
        self.fitted = True
        return self

    def _fit_fills(self, data: DataFrame, features: list[str]) -> bool:
        """Mean of every feature (0 if it has no value); true if ``data`` has gaps."""
        found = to_long(data, features).groupBy("column").agg(F.avg("v").alias("m"), F.count("v").alias("n"))
        rows = {r["column"]: (r["m"], r["n"]) for r in found.collect()}  # one per feature
        self.fills = {c: float(rows[c][0]) if c in rows and rows[c][1] else 0.0 for c in features}
        n = data.count()
        return any(c not in rows or rows[c][1] < n for c in features)

    def _fill(self, df: DataFrame) -> DataFrame:
        return df.withColumns(
            {c: F.coalesce(F.col(c).cast("double"), F.lit(v)) for c, v in self.fills.items() if c in df.columns}
        )

    def transform(self, df: DataFrame) -> DataFrame:
        """Selected features, plus the target and key columns the input has."""
        if not self.fitted:
            raise ValueError("fit the flow first")
        out = self.imputer.transform(df)
        out = clip_outliers(out, self.bounds)
        out = self.deriver.transform(out)
        out = self.geo.transform(out)
        out = self._fill(self.encoder.transform(out))
        out = self.scaler.transform(out)
        kept = [c for c in (*self.keys, self.target) if c in df.columns]
        return out.select(*kept, *self.selected)

    def fit_transform(self, df: DataFrame) -> DataFrame:
        return self.fit(df).transform(df)

    # -- state as a table -------------------------------------------------

    def state_rows(self) -> list[tuple[str, str, str, float | None, str | None]]:
        """The fitted state as rows ``(step, column, stat, value, text)``."""
        rows: list = []
        add = lambda step, column, stat, value=None, text=None: rows.append(
            (step, column, stat, None if value is None else float(value), text)
        )
        config = {
            k: getattr(self, k)
            for k in ("impute", "indicators", "outlier_method", "outlier_threshold", "clusters",
                      "cluster_starts", "encoding", "scaling", "selection", "k_best", "target",
                      "clip_indicators", "keys")
        }
        add("config", "", "settings", text=json.dumps(config))
        for c in self.imputer.columns:
            add("impute", c, "fill", self.imputer.fills.get(c))
        for c, b in self.bounds.items():
            for stat in ("lo", "hi", "clip_lo", "clip_hi"):
                add("outliers", c, stat, getattr(b, stat))
        add("derive", "median_income", "threshold", self.deriver.income_threshold)
        add("derive", "population", "threshold", self.deriver.population_threshold)
        for i, center in enumerate(self.geo.centers):
            for c, v in zip(self.geo.columns, center):
                add("cluster", c, f"center_{i}", v)
        for i, values in self.geo.stats.items():
            for stat, v in zip(("mean", "std", "count"), values):
                add("cluster", "", f"{stat}_{i}", v)
        for j, c in enumerate(self.encoder.columns):
            add("encode_column", c, "position", j)
            for i, v in enumerate(self.encoder.categories.get(c, [])):
                add("encode", c, f"category_{i:05d}", text=v)
        for c, v in self.fills.items():
            add("fill", c, "mean", v)
        for c, (m, s) in self.scaler.params.items():
            add("scale", c, "center", m)
            add("scale", c, "scale", s)
        for i, c in enumerate(self.selected):
            add("select", c, "position", i)
        return rows

    def save(self, spark: SparkSession, path: str) -> None:
        """Write the state; per-group fills and encoder maps are tables of their own."""
        spark.createDataFrame(
            self.state_rows(), "step string, column string, stat string, value double, text string"
        ).write.mode("overwrite").parquet(f"{path}/state")
        if self.imputer.groups is not None:
            self.imputer.groups.write.mode("overwrite").parquet(f"{path}/groups")
        if self.imputer.donors is not None:
            self.imputer.donors.write.mode("overwrite").parquet(f"{path}/donors")
        for c, table in self.encoder.tables.items():
            table.write.mode("overwrite").parquet(f"{path}/encoder/{c}")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "FeatureFlow":
        rows = spark.read.parquet(f"{path}/state").collect()
        by = lambda step: [r for r in rows if r["step"] == step]
        config = json.loads(by("config")[0]["text"])
        config["keys"] = tuple(config["keys"])
        flow = cls(**config)
        flow.imputer = Imputer(flow.impute, CATEGORY, flow.indicators)
        flow.imputer.columns = [r["column"] for r in by("impute")]
        flow.imputer.fills = {r["column"]: r["value"] for r in by("impute") if r["value"] is not None}
        if flow.impute == "grouped_median" and flow.imputer.columns:
            flow.imputer.groups = spark.read.parquet(f"{path}/groups")
        if flow.impute == "knn" and flow.imputer.columns:
            flow.imputer.donors = spark.read.parquet(f"{path}/donors")
        limits: dict[str, dict[str, float]] = {}
        for r in by("outliers"):
            limits.setdefault(r["column"], {})[r["stat"]] = r["value"]
        flow.bounds = {c: Bounds(**v) for c, v in limits.items()}
        thresholds = {r["column"]: r["value"] for r in by("derive")}
        flow.deriver = Deriver(thresholds["median_income"], thresholds["population"])
        flow.geo = GeoClusters(k=flow.clusters, n_init=flow.cluster_starts, target=flow.target)
        cells = {(r["column"], r["stat"]): r["value"] for r in by("cluster")}
        k = sum(1 for c, s in cells if c == flow.geo.columns[0] and s.startswith("center_"))
        flow.geo.centers = np.array(
            [[cells[(c, f"center_{i}")] for c in flow.geo.columns] for i in range(k)]
        )
        labels = {s.split("_")[1] for c, s in cells if s.startswith("count_")}
        flow.geo.stats = {
            int(i): tuple(cells[("", f"{s}_{i}")] for s in ("mean", "std", "count")) for i in labels
        }
        flow.encoder = Encoder(flow.encoding, flow.target)
        for r in sorted(by("encode"), key=lambda r: (r["column"], r["stat"])):
            flow.encoder.categories.setdefault(r["column"], []).append(r["text"])
        flow.encoder.columns = [
            r["column"] for r in sorted(by("encode_column"), key=lambda r: r["value"])
        ]
        if flow.encoding != "onehot":
            flow.encoder.tables = {
                c: spark.read.parquet(f"{path}/encoder/{c}") for c in flow.encoder.columns
            }
        flow.fills = {r["column"]: r["value"] for r in by("fill")}
        pairs: dict[str, dict[str, float]] = {}
        for r in by("scale"):
            pairs.setdefault(r["column"], {})[r["stat"]] = r["value"]
        flow.scaler = Scaler(flow.scaling, (flow.target,))
        flow.scaler.params = {c: (v["center"], v["scale"]) for c, v in pairs.items()}
        flow.selected = [r["column"] for r in sorted(by("select"), key=lambda r: r["value"])]
        flow.fitted = True
        return flow
