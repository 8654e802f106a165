"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

Entries c become integers x = floor(64 c) + 1000000, so counts, sums and deviations are exact. The rows,
centred by their mean, are a tall matrix X of which only the d columns fit anywhere. The bidiagonalisation
X V = U B alternates two products: u = X v over all rows, and X'u summed over all rows. A pass over
the rows makes both in turn for a block of rows at a time. The left vectors have a
component a row, so they are never stored: u_j is a combination of X v_1 ... X v_j, kept as the d
coefficients p_j with u_j = X p_j, which costs a block one more small product instead of a table.

Each step reorthogonalises fully, twice: v against all right vectors, and u against all left ones (their inner
products are p_i'(X'u), known from the pass). A direction that ends (an invariant subspace, a constant
dimension) is followed by a fresh one orthogonal to all before, so repeated eigenvalues are
found too. It stops after d steps, or when the residual bounds of the wanted components are at the level of rounding and
``CONFIRM`` more steps from a fresh direction have not changed them. The SVD of the small B
gives the components (its right vectors) and deviations (its singular values).

What is held outside the tasks is d x steps numbers at most. Sums of partitions meet in one aggregate by
dimension, combined map-side. A lost executor costs its tasks; the integer rows are a table in the shared folder.

Defined results: rows whose vector is null, empty, or holds a null or non-finite entry are left out, and so are
rows whose length is not the most frequent one (the greater of equals). Rows may repeat; ids may be null. Components whose
eigenvalue is not above rounding (constant data, fewer rows than dimensions) are not returned. Entries above 2**40
in size raise an error. An empty table gives an empty result; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import stored

COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000
LARGEST = float(1 << 40)
BLOCK = 4096  # rows multiplied at a time
TINY = 1e-10  # of the largest singular value: what is below counts as zero
SETTLED = 1e-13
CONFIRM = 16


def integer_rows(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, x array of long) of the usable rows, all of one length."""
    entry = lambda c: c.cast("double")
    fine = lambda c: c.isNotNull() & (F.abs(entry(c)) < float("inf"))  # noqa: E731  NaN is above infinity
    usable = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v")).filter(
        F.col("v").isNotNull() & (F.size("v") > 0) & F.forall("v", lambda c: F.coalesce(fine(c), F.lit(False))))
    whole = lambda c: F.when(F.abs(entry(c)) <= LARGEST, F.floor(entry(c) * SCALE) + SHIFT).otherwise(
        F.raise_error(F.lit("an entry of a vector is above 2**40 in size")).cast("bigint"))
    rows = stored(usable.select("id", F.transform("v", whole).alias("x")), "vectors")
    lengths = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(2).collect()
    return rows.filter(F.size("x") == lengths[0]["d"]) if len(lengths) > 1 else rows


def matrix(column: pa.Array) -> np.ndarray:
    """The rows of a list column, all of one length."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def summed(rows: DataFrame, width: int, partial: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum over all rows of what ``partial`` makes of blocks of them (``width`` doubles)."""
    def run(batches):
        total = np.zeros(width)
        for batch in batches:
            x = matrix(batch["x"])
            for k in range(0, len(x), BLOCK):
                total += partial(x[k:k + BLOCK])
        yield pa.RecordBatch.from_pydict({"total": pa.array([total.tolist()], pa.list_(pa.float64()))})

    parts = rows.select("x").mapInArrow(run, "total array<double>")
    got = parts.select(F.posexplode("total").alias("at", "part")).groupBy("at").agg(
        F.sum("part").alias("s")).collect()  # width rows
    out = np.zeros(width)
    for r in got:
        out[r["at"]] = r["s"]
    return out


def exact_sums(rows: DataFrame) -> tuple[int, list[int]]:
    """Number of rows and the sum of each dimension, exactly."""
    def run(batches):
        n, total = 0, None
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch["x"])
                part = [int(v) for v in x.sum(axis=0)] if np.abs(x).max() < 1 << 40 else \
                    [sum(map(int, c)) for c in x.T]
                total = part if total is None else [a + b for a, b in zip(total, part, strict=True)]
                n += batch.num_rows
        yield pa.RecordBatch.from_pydict({
            "n": pa.array([n], pa.int64()), "s": pa.array([[str(v) for v in total or []]], pa.list_(pa.string()))})

    parts = rows.select("x").mapInArrow(run, "n bigint, s array<string>")
    found = parts.select("n", F.posexplode_outer("s").alias("at", "s")).groupBy("at").agg(
        F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    by = {r["at"]: r for r in found if r["at"] is not None}
    return (by[0]["n"] if by else 0), [int(by[k]["s"]) for k in range(len(by))]


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - S/n as doubles; the whole part of the mean is taken off before rounding."""
    whole = np.array([s // n for s in sums], dtype=np.int64)
    rest = np.array([(s % n) / n for s in sums])
    return (x - whole).astype(np.float64) - rest


def bidiagonalise(product: Callable[[np.ndarray], tuple[float, np.ndarray]], d: int,
                  wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """Singular values of X (falling) and its right vectors, ``wanted`` at most, from
    ``product(p) = (|X p|^2, X'X p)``: u = X p, then X'u, a pass over the rows each."""
    rng = np.random.default_rng(20_11)
    right = np.zeros((d, 0))
    coefficients, images = np.zeros((d, 0)), np.zeros((d, 0))  # u_j = X p_j and X'u_j
    alphas: list[float] = []
    betas: list[float] = []  # between v_j and v_(j+1)
    scale = 0.0
    confirmed, steps = None, 0  # the values when they had settled first, and steps since then

    def fresh() -> np.ndarray | None:
        """A direction X'X r orthogonal to all before: null directions of X never enter. None: nothing is left."""
        nonlocal scale
        r = rng.standard_normal(d)
        for _ in range(3):
            r -= right @ (right.T @ r)
        r /= np.linalg.norm(r)
        square, v = product(r)
        scale = max(scale, float(square) ** 0.5)
        for _ in range(3):
            v = v - right @ (right.T @ v)
        size = float(np.linalg.norm(v))
        return v / size if size > TINY * scale ** 2 else None

    def small_svd() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        b = np.diag(alphas) + np.diag(betas[:len(alphas) - 1], 1)
        return np.linalg.svd(b)

    v = fresh()
    beta = 0.0
    if v is None:
        return np.zeros(0), right
    while True:
        right = np.column_stack([right, v])
        p = v - beta * coefficients[:, -1] if beta and coefficients.size else v.copy()
        for _ in range(3):
            square, z = product(p)
            size = float(square) ** 0.5
            scale = max(scale, size)
            for _ in range(2):  # u against all left vectors
                c = coefficients.T @ z
                p, z = p - coefficients @ c, z - images @ c
            alpha = max(float(p @ z), 0.0) ** 0.5
            if alpha > 1e-3 * size or size <= TINY * scale:
                break  # otherwise u has nearly cancelled: another pass gives its digits
        if alpha <= TINY * scale:  # X v lies in what is known: no left vector of its own
            alpha = 0.0
            coefficients = np.column_stack([coefficients, np.zeros(d)])
            images = np.column_stack([images, np.zeros(d)])
            following = np.zeros(d)
        else:
            coefficients = np.column_stack([coefficients, p / alpha])
            images = np.column_stack([images, z / alpha])
            following = images[:, -1] - alpha * v
        alphas.append(alpha)
        for _ in range(2):  # v against all right vectors
            following -= right @ (right.T @ following)
        beta = float(np.linalg.norm(following))
        if len(alphas) == d:
            break
        if beta <= TINY * max(scale, 1e-300):
            beta = 0.0
        left, values, _ = small_svd()
        steps += 1
        settled = len(alphas) >= wanted and np.all(beta * np.abs(left[-1, :wanted]) <= SETTLED * values[0])
        if settled and (confirmed is None or steps >= CONFIRM):
            # a fresh direction shows whether a repeated eigenvalue was passed over
            if confirmed is not None and np.abs(values[:wanted] - confirmed).max() <= SETTLED * values[0]:
                break
            confirmed, steps, beta = values[:wanted].copy(), 0, 0.0
        if beta:
            v = following / beta
        else:
            v = fresh()
            if v is None:
                break
        betas.append(beta)
    _, values, turned = small_svd()
    most = min(wanted, len(alphas))
    return values[:most], right @ turned[:most].T


class Whitening:
    """A fitted map: n, exact sums, components (d x k), deviations sqrt(e), explained shares."""

    def __init__(self, n: int, sums: list[int], components: np.ndarray, deviations: np.ndarray,
                 explained: np.ndarray):
        self.n, self.sums = n, sums
        self.components, self.deviations, self.explained = components, deviations, explained

    def project(self, x: np.ndarray) -> np.ndarray:
        return centred(x, self.n, self.sums) @ (self.components / self.deviations)


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Whitening of ``integer_rows``; None for an empty table."""
    n, sums = exact_sums(rows)
    if not n:
        return None
    d = len(sums)

    def product(p: np.ndarray) -> tuple[float, np.ndarray]:
        def partial(x: np.ndarray) -> np.ndarray:
            block = centred(x, n, sums)
            u = block @ p
            return np.concatenate([[u @ u], block.T @ u])
        total = summed(rows, d + 1, partial)
        return total[0], total[1:]

    trace = summed(rows, 1, lambda x: np.array([np.sum(centred(x, n, sums) ** 2)]))[0] / n
    if trace <= 0:
        return Whitening(n, sums, np.zeros((d, 0)), np.zeros(0), np.zeros(0))
    values, vectors = bidiagonalise(product, d, min(components, d))
    eigen = values ** 2 / n
    live = eigen > 1e-14 * eigen[0]
    return Whitening(n, sums, vectors[:, live], np.sqrt(eigen[live]), eigen[live] / trace)


def identity_error(rows: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the covariance (divisor n, centred) of the whitened rows minus the identity."""
    k = len(model.deviations)
    if not k:
        return 0.0
    means = summed(rows, k, lambda x: model.project(x).sum(axis=0)) / model.n

    def partial(x: np.ndarray) -> np.ndarray:
        w = model.project(x) - means
        return (w.T @ w).reshape(-1)

    covariance = summed(rows, k * k, partial).reshape(k, k) / model.n
    return float(np.abs(covariance - np.eye(k)).max())


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """Sum over dimensions of (n x - S)^2 of each row, exactly: with off = x - S div n and r = S mod n it is
    n^2 sum(off^2) - 2 n sum(off r) + sum(r^2)."""
    off = x - np.array([s // n for s in sums], dtype=np.int64)
    rest = [s % n for s in sums]
    most, d = int(np.abs(off).max(initial=0)), len(sums)
    fits = lambda bound: bound * d < 1 << 62
    squares = (off if fits(most * most) else off.astype(object)) ** 2
    crossed = off @ np.array(rest, dtype=np.int64) if fits(most * n) else off.astype(object) @ np.array(rest, object)
    constant = sum(r * r for r in rest)
    return [n * n * int(a) - 2 * n * int(b) + constant
            for a, b in zip(squares.sum(axis=1), crossed, strict=True)]


def transform(rows: DataFrame, model: Whitening, checks: float | None = None) -> DataFrame:
    """One row per row and component: id, component, n, deviation (decimal, exact), whitened, explained, and
    ``identity_error`` where given."""
    k = len(model.deviations)

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(at, BLOCK)
                x = matrix(batch["x"])
                m = len(x)
                each = np.repeat(np.arange(m), k)
                off = pa.array([str(v) for v in deviations(x, model.n, model.sums)], pa.string())
                yield pa.RecordBatch.from_pydict({
                    "id": batch["id"].take(pa.array(each)),
                    "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    "n": pa.array(np.full(m * k, model.n, dtype=np.int64)),
                    "deviation": off.take(pa.array(each)),
                    "whitened": pa.array(model.project(x).reshape(-1)),
                    "explained": pa.array(np.tile(model.explained, m)),
                    "identity_error": pa.array(np.full(m * k, checks, dtype=np.float64))})

    kind = rows.schema["id"].dataType.simpleString()
    made = rows.mapInArrow(run, f"id {kind}, component int, n bigint, deviation string, whitened double, "
                                "explained double, identity_error double")
    return made.withColumn("deviation", F.col("deviation").cast("decimal(38,0)"))


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
           components: int = COMPONENTS) -> DataFrame:
    """The whitened rows of ``vectors``: see ``transform``."""
    rows = integer_rows(vectors, id_col, vector_col)
    model = fit(rows, components)
    if model is None:
        model = Whitening(1, [], np.zeros((0, 0)), np.zeros(0), np.zeros(0))
    return transform(rows, model, identity_error(rows, model))
