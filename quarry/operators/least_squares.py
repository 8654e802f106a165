"""Bagged least squares from sums (T3, T4): all folds' fits in two passes over the rows.

Sums of products of the features and the target are additive, so those of a fold's complement are the totals less
the fold's. One aggregate by fold gives counts, sums and products; the missing-value means and the
solution of every complement follow on the driver from matrices of (features + 2) squared numbers a fold.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class LeastSquares:
    """Linear regression on numeric inputs given as SQL expressions; a missing input has the mean of the
    complement's rows. Inputs that add nothing (constant, or sums of others) share the least-norm solution."""

    def fit(self, base: DataFrame, inputs: list[str], label: str, fold: str | None, folds: int) -> list[PipelineModel]:
        xs = [f"nanvl(CAST({x} AS DOUBLE), CAST(NULL AS DOUBLE))" for x in inputs]
        first = base.agg(F.count(F.lit(1)).alias("n"), F.avg(label).alias("my"), *[
            F.expr(e).alias(f"{a}{i}") for i, x in enumerate(xs)
            for a, e in (("n", f"count({x})"), ("m", f"avg({x})"), ("s", f"stddev_pop({x})"))]).first()
        centre = [first[f"m{i}"] if first[f"m{i}"] is not None else 0.0 for i in range(len(xs))]
        scale = [first[f"s{i}"] or 1.0 for i in range(len(xs))]
        middle = first["my"] or 0.0
        partial = [i for i in range(len(xs)) if first[f"n{i}"] != first["n"]]
        z = [f"coalesce(({x} - CAST('{c!r}' AS DOUBLE)) / CAST('{s!r}' AS DOUBLE), 0D)"
             for x, c, s in zip(xs, centre, scale, strict=True)]
        u = [f"CASE WHEN {xs[i]} IS NULL THEN 1D ELSE 0D END" for i in partial]
        names = ["1D", *[f"z{i}" for i in range(len(z))], *[f"u{i}" for i in range(len(u))], "y"]
        at = F.col(fold).cast("int") if fold else F.lit(0)
        wide = base.select(at.alias("f"), *[F.expr(e).alias(f"z{i}") for i, e in enumerate(z)],
                           *[F.expr(e).alias(f"u{i}") for i, e in enumerate(u)],
                           (F.col(label) - F.lit(float(middle))).alias("y"))
        size = len(names)
        pairs = [(a, b) for a in range(size) for b in range(a, size)]
        found = wide.groupBy("f").agg(*[F.expr(f"sum({names[a]} * {names[b]})").alias(f"g{a}_{b}")
                                        for a, b in pairs]).collect()  # a row a fold
        products = {r["f"]: np.zeros((size, size)) for r in found}
        for r in found:
            for a, b in pairs:
                products[r["f"]][a, b] = products[r["f"]][b, a] = r[f"g{a}_{b}"]
        whole = sum(products.values(), np.zeros((size, size)))
        out = []
        for j in range(folds):
            rest = whole - products.get(j, 0.0) if fold and folds > 1 else whole
            slopes, fill, intercept = self.solve(rest, len(z), partial)
            terms = [f"{b!r}D * coalesce(({x} - CAST('{c!r}' AS DOUBLE)) / CAST('{s!r}' AS DOUBLE), {m!r}D)"
                     for b, x, c, s, m in zip(slopes, xs, centre, scale, fill, strict=True)]
            total = " + ".join([f"{intercept + middle!r}D", *terms])
            out.append(PipelineModel([SQLTransformer(statement=f"SELECT *, {total} AS _pred FROM __THIS__")]))
        return out

    @staticmethod
    def solve(g: np.ndarray, p: int, partial: list[int]) -> tuple[list[float], list[float], float]:
        """(slopes, values of missing inputs, intercept) from products of [1, z, u, y]; u marks missing z."""
        n = g[0, 0]
        if n <= 0:
            return [0.0] * p, [0.0] * p, 0.0
        fill = np.zeros(p)
        turn = np.zeros((p + 2, len(g)))
        turn[0, 0] = turn[p + 1, -1] = 1.0
        for i in range(p):
            turn[1 + i, 1 + i] = 1.0
        for k, i in enumerate(partial):
            have = n - g[0, 1 + p + k]
            fill[i] = g[0, 1 + i] / have if have > 0 else 0.0
            turn[1 + i, 1 + p + k] = fill[i]
        a = turn @ g @ turn.T
        means = a[0, 1:] / n
        s = a[1:, 1:] - n * np.outer(means, means)
        width = np.sqrt(np.maximum(np.diag(s)[:p], 0.0))
        live = width > 1e-9 * np.sqrt(n)
        slopes = np.zeros(p)
        if live.any():
            scaled = s[:p, :p][np.ix_(live, live)] / np.outer(width[live], width[live])
            slopes[live] = np.linalg.pinv(scaled, rcond=1e-10, hermitian=True) @ (s[:p, p][live] / width[live]) / width[live]
        return [float(b) for b in slopes], [float(m) for m in fill], float(means[p] - means[:p] @ slopes)
