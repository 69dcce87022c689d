"""Outliers by density."""

from __future__ import annotations

from pyspark.sql import functions as F

from gramlark.catalog.base import query, staged_listing
from gramlark.operators.density import density_clusters
from gramlark.sources.listing import with_listing

EPS, MIN_ROWS = 0.125, 70


@query(with_listing("""
SELECT row_key, coalesce(own.comp, border.comp) AS cluster, own.comp IS NOT NULL AS is_core,
       own.comp IS NULL AND border.comp IS NULL AS is_noise
FROM listing JOIN points p ON p.x = longitude AND p.y = total_rooms / 1000
LEFT JOIN cc own ON own.id = p.id
LEFT JOIN (SELECT n.a, min(c.comp) AS comp FROM near n JOIN cc c ON c.id = n.b GROUP BY 1) border ON border.a = p.id
""", f"""
points AS (SELECT longitude AS x, total_rooms / 1000 AS y, min(row_key) AS id, count(*) AS w FROM listing GROUP BY 1, 2),
near AS (SELECT a.id AS a, b.id AS b, b.w FROM points a JOIN points b
         ON (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= {EPS} * {EPS}
         AND b.x BETWEEN a.x - 1 AND a.x + 1),
core AS (SELECT a AS id FROM near GROUP BY a HAVING sum(w) >= {MIN_ROWS}),
edges AS (SELECT a, b FROM near WHERE a IN (SELECT id FROM core) AND b IN (SELECT id FROM core)),
cc(id, comp) USING KEY (id) AS (
  SELECT id, id FROM core
  UNION
  (SELECT e.b, min(c.comp) FROM cc c JOIN edges e ON e.a = c.id JOIN recurring.cc r ON r.id = e.b
   WHERE c.comp < r.comp GROUP BY e.b))
""", recursive=True))
def outliers_density(spark, sf):
    """Clusters and noise by longitude and rooms."""
    df = staged_listing(spark, sf, ["row_key", "longitude", "total_rooms"])
    scaled = df.withColumn("rooms", F.col("total_rooms") / 1000)
    return density_clusters(scaled, ["longitude", "rooms"], "row_key", EPS, MIN_ROWS)
