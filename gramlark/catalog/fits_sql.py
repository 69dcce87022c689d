"""Reference SQL of fits on any number of features: moments as lists, solved by recursion."""

from __future__ import annotations

import re

from gramlark.catalog.base import q
from gramlark.schema import NUMERIC, TARGET

FILLED = """filled AS (SELECT * REPLACE (coalesce(total_bedrooms,
  (SELECT quantile_cont(total_bedrooms, 0.5) FROM listing)) AS total_bedrooms) FROM listing)"""
ALL_ROWS = "sides AS (SELECT 0 AS grp, * FROM filled)"
TRAIN_SIDES = "sides AS (SELECT k AS grp, filled.* FROM filled JOIN range(5) t(k) ON filled.fold <> k)"


def moments(names: list[str], scaled: bool = True) -> str:
    """``mom``: per group the count, means, (scaled) covariances ``g`` and ``c`` and the target's variance."""
    rows = ", ".join("[" + ", ".join(f"covar_pop({a}, {b})" for b in names) + "]" for a in names)
    target = ", ".join(f"covar_pop({a}, {TARGET})" for a in names)
    spread = ", ".join(f"sqrt(var_pop({a}))" if scaled else "1::DOUBLE" for a in names)
    means = ", ".join(f"avg({a})" for a in names)
    return f"""cov AS (SELECT grp, count(*)::DOUBLE AS n, [{means}] AS mx, avg({TARGET}) AS my, var_pop({TARGET}) AS yy,
  [{spread}] AS sd, [{rows}] AS g0, [{target}] AS c0 FROM sides GROUP BY grp),
mom AS (SELECT *, list_transform(g0, lambda r, i: list_transform(r, lambda x, j: x / (sd[i] * sd[j]))) AS g,
  list_transform(c0, lambda x, i: x / sd[i]) AS c FROM cov)"""


def solved(models: list[tuple[str, float, float, float]], size: int) -> str:
    """``coefs``: raw-scale weights and intercept of every (model, ridge, first, second penalty) per group.

    Models without a first or second penalty are eliminated column by column;
    the others go round the coordinates until the loss moves by less than 1e-6.
    """
    closed = [m for m in models if m[2] == m[3] == 0.0]
    walked = [m for m in models if m not in closed]
    ctes, ends = [], []
    if closed:
        values = ", ".join(f"('{m}', {ridge}::DOUBLE)" for m, ridge, _, _ in closed)
        ctes.append(f"""gj AS (
  SELECT grp, model, 1 AS k, list_transform(g, lambda r, i: list_append(
    list_transform(r, lambda x, j: n * x + CASE WHEN i = j THEN ridge ELSE 0 END), n * c[i])) AS a
  FROM mom, (VALUES {values}) v(model, ridge)
  UNION ALL
  SELECT grp, model, k + 1, list_transform(a, lambda r, i: CASE WHEN i = k THEN list_transform(r, lambda x: x / r[k])
    ELSE list_transform(r, lambda x, j: x - r[k] * a[k][j] / a[k][k]) END) FROM gj WHERE k <= {size})""")
        ends.append(f"SELECT grp, model, list_transform(a, lambda r: r[{size + 1}]) AS beta FROM gj WHERE k = {size + 1}")
    if walked:
        values = ", ".join(f"('{m}', {l1}::DOUBLE, {l2}::DOUBLE)" for m, _, l1, l2 in walked)
        ctes.append(f"""pen AS (SELECT * FROM (VALUES {values}) v(model, l1, l2)),
cd AS (
  SELECT grp, model, 0 AS step, list_transform(c, lambda x: 0::DOUBLE) AS beta, 'infinity'::DOUBLE AS loss, false AS done FROM mom, pen
  UNION ALL
  SELECT grp, model, step, beta, CASE WHEN turn THEN now ELSE loss END, turn AND abs(loss - now) < 1e-6 FROM (
    SELECT grp, model, step, beta, loss, step % {size} = 0 AS turn,
      greatest(yy - 2 * list_dot_product(beta, c) + list_dot_product(beta, list_transform(g, lambda r: list_dot_product(r, beta))), 0)
      + l1 * list_sum(list_transform(beta, lambda b: abs(b))) + 0.5 * l2 * list_dot_product(beta, beta) AS now
    FROM (
      SELECT grp, model, step + 1 AS step, loss, yy, g, c, l1, l2, list_transform(beta, lambda b, i:
        CASE WHEN i = step % {size} + 1 THEN sign(rho) * greatest(abs(rho) - l1, 0) / (g[i][i] + l2) ELSE b END) AS beta
      FROM (SELECT cd.*, yy, g, c, l1, l2, c[step % {size} + 1] - list_dot_product(g[step % {size} + 1], beta)
              + g[step % {size} + 1][step % {size} + 1] * beta[step % {size} + 1] AS rho
            FROM cd JOIN mom USING (grp) JOIN pen USING (model) WHERE NOT done AND step < {size} * 1000))))""")
        ends.append("SELECT grp, model, arg_max(beta, step) AS beta FROM cd GROUP BY grp, model")
    ctes.append("betas AS (" + " UNION ALL ".join(ends) + ")")
    ctes.append("""coefs AS (SELECT grp, model, coef, my - list_dot_product(coef, mx) AS intercept
  FROM (SELECT betas.*, my, mx, list_transform(beta, lambda b, i: b / sd[i]) AS coef FROM betas JOIN mom USING (grp)))""")
    return ",\n".join(ctes)


def prediction(names: list[str] = NUMERIC) -> str:
    return "intercept + " + " + ".join(f"coef[{i}] * {c}" for i, c in enumerate(names, 1))


def side_metrics(digits: dict[str, int]) -> str:
    """Mean and deviation over folds of every metric per model and side, from ``coefs`` of the training sides."""
    rounds = ", ".join(f"{q(f'avg({m})', d)} AS {m}, {q(f'stddev_pop({m})', d)} AS {m}_std" for m, d in digits.items())
    return f"""
SELECT model, side, {rounds}, arg_max(fold, r2) AS best_fold, count(*) AS folds FROM (
  SELECT *, sqrt(mse) AS rmse FROM (
    SELECT model, side, grp::INTEGER AS fold, avg(e * e) AS mse, avg(abs(e)) AS mae, 1 - sum(e * e) / (var_pop(y) * count(*)) AS r2,
      100 * avg(abs(e) / greatest(abs(y), 2.220446049250313e-16)) AS mape, 1 - var_pop(e) / var_pop(y) AS explained_variance
    FROM (SELECT model, grp, CASE WHEN fold = grp THEN 'validation' ELSE 'train' END AS side, {TARGET} AS y,
            {TARGET} - ({prediction()}) AS e FROM filled CROSS JOIN coefs)
    GROUP BY ALL)) GROUP BY model, side"""


def renamed(sql: str, suffix: str) -> str:
    """The same CTEs under other names, so that two kinds of fit can stand in one query."""
    return re.sub(r"\b(cov|mom|gj|cd|pen|betas|coefs)\b(?!\()", rf"\1{suffix}", sql)


def eliminated(names: list[str], until: int) -> str:
    """``left0``, ``left1``, ...: the features left after dropping the smallest raw weight again and again."""
    ctes = [f"left0 AS (SELECT range(1, {len(names) + 1}) AS f)"]
    for t in range(len(names) - until):
        size = len(names) - t
        ctes.append(f"""gj{t} AS (
  SELECT 1 AS k, list_transform(f, lambda i: list_append(list_transform(f, lambda j: g[i][j]), c[i])) AS a FROM left{t}, mom
  UNION ALL
  SELECT k + 1, list_transform(a, lambda r, i: CASE WHEN i = k THEN list_transform(r, lambda x: x / r[k])
    ELSE list_transform(r, lambda x, j: x - r[k] * a[k][j] / a[k][k]) END) FROM gj{t} WHERE k <= {size}),
weight{t} AS (SELECT list_transform(a, lambda r, i: (r[{size + 1}] / sd[f[i]]) ** 2) AS w, f FROM gj{t}, left{t}, mom WHERE k = {size + 1}),
left{t + 1} AS (SELECT list_filter(f, lambda x, i: i <> list_position(w, list_min(w))) AS f FROM weight{t})""")
    return ",\n".join(ctes)
