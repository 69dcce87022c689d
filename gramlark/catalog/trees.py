"""Random forest and gradient-boosted regression."""

from __future__ import annotations

from pyspark.sql import functions as F

from gramlark.catalog.base import q, query, rounded, staged_listing
from gramlark.operators import trees
from gramlark.operators.evaluate import basic_metrics
from gramlark.schema import NUMERIC, TARGET
from gramlark.sources.listing import with_listing

ROUNDS, RATE, BINS = 3, 0.5, 8
KEYED = ["row_key", *NUMERIC, TARGET]


def _stumps_sql() -> str:
    """Boosted stumps by exhaustive search over all columns and quantiles, one round after the other."""
    cuts = " UNION ALL ".join(
        f"SELECT DISTINCT '{c}' AS feature, {k} AS place, unnest(quantile_cont({c}, {[i / BINS for i in range(1, BINS)]})) AS edge FROM listing"
        for k, c in enumerate(NUMERIC)
    )
    ctes = [f"cuts AS (SELECT DISTINCT * FROM ({cuts}))"]
    ctes.append("base AS (SELECT *, row_number() OVER () AS id FROM listing)")
    ctes.append(f"r0 AS (SELECT id, {TARGET} - (SELECT avg({TARGET}) FROM base) AS r FROM base)")
    ctes.append(
        'long AS (SELECT id, feature, v FROM (SELECT id, ' + ", ".join(NUMERIC) + f" FROM base) UNPIVOT INCLUDE NULLS (v FOR feature IN ({', '.join(NUMERIC)})))"
    )
    ctes.append("sides AS (SELECT id, c.feature, place, edge, coalesce(v <= edge, true) AS low FROM long JOIN cuts c USING (feature))")
    for k in range(ROUNDS):
        ctes.append(f"""g{k} AS (SELECT feature, place, edge, sum(r) FILTER (low) AS sl, count(*) FILTER (low) AS nl,
  sum(r) FILTER (NOT low) AS sr, count(*) FILTER (NOT low) AS nr FROM sides JOIN r{k} USING (id) GROUP BY ALL)""")
        ctes.append(f"""b{k} AS (SELECT *, sl / nl AS lv, sr / nr AS rv FROM g{k} WHERE nl > 0 AND nr > 0
  ORDER BY sl * sl / nl + sr * sr / nr DESC, place, edge LIMIT 1)""")
        ctes.append(f"""r{k + 1} AS (SELECT id, r - {RATE} * CASE WHEN low THEN lv ELSE rv END AS r
  FROM r{k} JOIN sides USING (id) JOIN b{k} USING (feature, edge))""")
    body = " UNION ALL ".join(
        f"SELECT {k} AS round, feature, {q('edge', 4)} AS threshold, {q('lv', 2)} AS left_value, {q('rv', 2)} AS right_value,"
        f" (SELECT {q('sqrt(avg(r * r))', 2)} FROM r{k + 1}) AS rmse FROM b{k}"
        for k in range(ROUNDS)
    )
    return with_listing(body, ",\n".join(ctes))


@query(_stumps_sql())
def boosted_stumps(spark, sf):
    """The splits of three boosted trees of one level over all columns, and the error after each."""
    df = staged_listing(spark, sf, KEYED)
    model = trees.boosted_trees(df, NUMERIC, TARGET, "row_key", rounds=ROUNDS, depth=1, bins=BINS, rate=RATE)
    parts = [trees.Ensemble(model.columns, model.edges, model.trees[: k + 1], model.base, RATE) for k in range(ROUNDS)]
    errors = df.agg(*[F.sqrt(F.avg((F.col(TARGET) - p.predict()) ** 2)).alias(f"e{k}") for k, p in enumerate(parts)]).first()
    nodes = {(t, n): (f, e, v) for t, n, f, e, v in trees.splits(model)}
    rows = [(k, *nodes[k, 0][:2], nodes[k, 1][2], nodes[k, 2][2], errors[k]) for k in range(ROUNDS)]
    out = spark.createDataFrame(rows, "round int, feature string, threshold double, left_value double, right_value double, rmse double")
    return rounded(out, {"threshold": 4, "left_value": 2, "right_value": 2, "rmse": 2})


def _held_out(spark, sf, fit):
    df = staged_listing(spark, sf, KEYED, fold=True)
    model = fit(df.where("fold <> 0"))
    scored = df.withColumn("p", model.predict()).withColumn("side", F.when(F.col("fold") == 0, "validation").otherwise("train"))
    return rounded(basic_metrics(scored, F.col(TARGET), F.col("p"), ["side"]), 4)


@query()
def random_forest_metrics(spark, sf):
    """A forest on four folds, judged on them and on the fifth."""
    return _held_out(spark, sf, lambda d: trees.random_forest(d, NUMERIC, TARGET, "row_key"))


@query()
def boosted_trees_metrics(spark, sf):
    """Boosted trees on four folds, judged on them and on the fifth."""
    return _held_out(spark, sf, lambda d: trees.boosted_trees(d, NUMERIC, TARGET, "row_key"))
