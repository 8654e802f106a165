"""Model tournament, weighted ensemble, leaderboard and scoring.

* T1  categoricals as out-of-fold target statistics (``encoding.py``), then ``Imputer`` and
      ``VectorAssembler``.
* T3  a Spark ML pool fitted on the training split and scored on the
      chronological validation split - never on random folds.
* T4  k-fold bagging: fold = 32 bits of ``md5(key)`` modulo k; k fits on the
      complements, member prediction = mean of the k fold predictions. The linear member's
      folds come from one aggregate (``least_squares.py``).
* T6  greedy forward selection with replacement (Caruana et al., 2004).  For
      regression one aggregate collects n, SST and the products of the members'
      errors; R^2 of any weight vector then follows from that small matrix, so
      the greedy search never touches rows again.
* T7  leaderboard rows with fit/predict times; the ensemble's totals are the
      sums over its used members plus its own marginal cost.

Every prediction is a column appended by ``transform``; labels and
predictions stay in the same row.
"""

from __future__ import annotations

import json
import threading
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml import classification as cls
from pyspark.ml import regression as reg
from pyspark.ml.feature import (Imputer, OneHotEncoder, SQLTransformer, StringIndexer,
                                VectorAssembler)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators import encoding
from quarry.operators import metrics as met
from quarry.operators import trees as hist
from quarry.operators.columns import type_partition
from quarry.operators.least_squares import LeastSquares
from quarry.session import batches_by_rows

MAX_CATEGORIES = 256


def eval_metric_for(kind: str) -> str:
    """binary -> f1, multiclass -> f1_weighted, regression -> r2."""
    return {"binary": "f1", "multiclass": "f1_weighted"}.get(kind, "r2")


# ---------------------------------------------------------------- T1 vectorisation

@dataclass
class FeatureSpec:
    numeric: list[str]
    categorical: list[str]
    target: str
    kind: str
    dates: list[str] = field(default_factory=list)   # expanded into year, month, day and weekday
    hashed: list[str] = field(default_factory=list)  # categoricals encoded by hash bucket
    encoded: list[str] = field(default_factory=list)  # columns of target statistics, in place of the categoricals

    @property
    def n_features(self) -> int:
        return len(self.numeric) + len(self.categorical) + len(self.dates)


def feature_spec(train: DataFrame, target: str, kind: str, exclude=(), hash_wide: bool = True) -> FeatureSpec:
    """Numeric and categorical features of ``train``.

    For a pipeline on its own, ``hash_wide`` marks categoricals with more distinct values than a tree's bins hold
    (HyperLogLog estimate, with room for its error) to be encoded by hash bucket. The tournament does not ask for
    it: it encodes all categoricals by target statistics.
    """
    numeric, categorical = type_partition(train, target)
    numeric = [c for c in numeric if c not in exclude]
    categorical = [c for c in categorical if c not in exclude]
    hashed = []
    if categorical and hash_wide:
        row = train.agg(*[F.approx_count_distinct(F.col(f"`{c}`")).alias(f"n{i}")
                          for i, c in enumerate(categorical)]).first()
        hashed = [c for i, c in enumerate(categorical) if row[f"n{i}"] > 0.75 * MAX_CATEGORIES]
    dates = [f.name for f in train.schema.fields if f.name != target and f.name not in exclude
             and f.dataType.typeName() in ("date", "timestamp", "timestamp_ntz")]
    return FeatureSpec(numeric, categorical, target, kind, dates, hashed)


def vectorizer(spec: FeatureSpec, one_hot: bool, out_col: str) -> list:
    stages = []
    num_in = list(spec.numeric)
    if spec.dates:
        stages.append(_calendar(spec.dates))
        num_in += [f"_{part}_{c}" for c in spec.dates for part in DATE_PARTS]
    imputed = [f"_imp_{c}" for c in num_in]
    if num_in:
        casted = [f"_dbl_{c}" for c in num_in]
        stages.append(_caster(num_in, casted))
        stages.append(Imputer(inputCols=casted, outputCols=imputed, strategy="mean"))
    if spec.encoded:  # complete, so not imputed
        stages.append(VectorAssembler(inputCols=imputed + spec.encoded, outputCol=out_col, handleInvalid="keep"))
        return stages
    idx = [f"_idx_{c}" for c in spec.categorical]
    if spec.hashed:
        stages.append(_hasher(spec.hashed))
    if spec.categorical:
        stages.append(StringIndexer(inputCols=[f"_hsh_{c}" if c in spec.hashed else c
                                               for c in spec.categorical], outputCols=idx,
                                    handleInvalid="keep", stringOrderType="alphabetAsc"))
    cat_feats = idx
    if one_hot and idx:
        cat_feats = [f"_ohe_{c}" for c in spec.categorical]
        stages.append(OneHotEncoder(inputCols=idx, outputCols=cat_feats, handleInvalid="keep"))
    stages.append(VectorAssembler(inputCols=imputed + cat_feats, outputCol=out_col,
                                  handleInvalid="keep"))
    return stages


def vector_inputs(spec: FeatureSpec) -> list[str]:
    """The columns that ``vectorizer`` assembles, where all of them hold one number."""
    if spec.categorical and not spec.encoded:
        return []
    num_in = [*spec.numeric, *[f"_{part}_{c}" for c in spec.dates for part in DATE_PARTS]]
    return [*[f"_imp_{c}" for c in num_in], *spec.encoded]


def _caster(inputs, outputs) -> SQLTransformer:
    """Numeric inputs as doubles (the imputer needs floating columns)."""
    sel = ", ".join(f"CAST(`{i}` AS DOUBLE) AS `{o}`" for i, o in zip(inputs, outputs))
    return SQLTransformer(statement=f"SELECT *, {sel} FROM __THIS__")


DATE_PARTS = {"year": "year", "month": "month", "day": "dayofmonth", "weekday": "weekday"}


def _calendar(columns) -> SQLTransformer:
    """Year, month, day and weekday of each date column."""
    sel = ", ".join(f"CAST({fn}(`{c}`) AS DOUBLE) AS `_{part}_{c}`"
                    for c in columns for part, fn in DATE_PARTS.items())
    return SQLTransformer(statement=f"SELECT *, {sel} FROM __THIS__")


def _hasher(columns) -> SQLTransformer:
    """Wide categoricals as one of MAX_CATEGORIES hash buckets (a missing value stays missing)."""
    sel = ", ".join(f"CAST(CASE WHEN `{c}` IS NOT NULL THEN pmod(xxhash64(`{c}`), {MAX_CATEGORIES}) END "
                    f"AS STRING) AS `_hsh_{c}`" for c in columns)
    return SQLTransformer(statement=f"SELECT *, {sel} FROM __THIS__")


# ---------------------------------------------------------------- T3 pool

def model_pool(kind: str, n_classes: int = 2, seed: int = 42) -> dict[str, tuple]:
    """name -> (estimator factory, uses one-hot features).

    Forests keep every row's node in every tree from level to level; the trees are those found from the root.
    """
    if kind == "regression":
        return {
            "linear": (LeastSquares(), True),
            "tree": (lambda f, l: reg.DecisionTreeRegressor(featuresCol=f, labelCol=l, maxDepth=8,
                                                            maxBins=MAX_CATEGORIES + 1,
                                                            seed=seed), False),
            "forest": (lambda f, l: reg.RandomForestRegressor(
                featuresCol=f, labelCol=l, numTrees=30, maxDepth=8, maxBins=MAX_CATEGORIES + 1,
                cacheNodeIds=True, seed=seed), False),
            "gbt": (lambda f, l: reg.GBTRegressor(featuresCol=f, labelCol=l, maxIter=30,
                                                  maxDepth=5, maxBins=MAX_CATEGORIES + 1,
                                                  seed=seed), False),
        }
    pool = {
        "logistic": (lambda f, l: cls.LogisticRegression(featuresCol=f, labelCol=l,
                                                         maxIter=50), True),
        "tree": (lambda f, l: cls.DecisionTreeClassifier(featuresCol=f, labelCol=l, maxDepth=8,
                                                         maxBins=MAX_CATEGORIES + 1,
                                                         seed=seed), False),
        "forest": (lambda f, l: cls.RandomForestClassifier(
            featuresCol=f, labelCol=l, numTrees=30, maxDepth=8, maxBins=MAX_CATEGORIES + 1,
            cacheNodeIds=True, seed=seed), False),
    }
    if n_classes == 2:
        pool["gbt"] = (lambda f, l: cls.GBTClassifier(featuresCol=f, labelCol=l, maxIter=30,
                                                      maxDepth=5, maxBins=MAX_CATEGORIES + 1,
                                                      seed=seed), False)
    return pool


@dataclass
class Member:
    name: str
    fold_models: list[PipelineModel]
    fit_time: float
    pred_time_val: float = 0.0
    score_val: float | None = None
    fit_order: int = 0
    level: int = 1


@dataclass
class Tournament:
    kind: str
    eval_metric: str
    spec: FeatureSpec
    labels: list[str] | None
    members: dict[str, Member] = field(default_factory=dict)
    weights: dict[str, float] = field(default_factory=dict)
    ensemble_score: float | None = None
    ensemble_fit_time: float = 0.0
    ensemble_pred_time: float = 0.0
    l1_names: list[str] = field(default_factory=list)
    statistics: encoding.Statistics | None = None

    @property
    def best(self) -> str:
        """The leaderboard's first: highest score, then the order of fitting (the ensemble last)."""
        board = [(m.score_val, -m.fit_order, n) for n, m in self.members.items()
                 if m.score_val is not None]
        if self.ensemble_score is not None:
            board.append((self.ensemble_score, -len(self.members) - 1, "weighted_ensemble"))
        return max(board)[2]


# ---------------------------------------------------------------- prediction helpers

def _label_frame(df: DataFrame, t: Tournament) -> DataFrame:
    """Add ``_label`` (double): the target, or its class index for classification."""
    if t.kind == "regression":
        return df.withColumn("_label", F.col(t.spec.target).cast("double"))
    from quarry.functions.numeric import label_index
    return df.withColumn("_label", label_index(F.col(t.spec.target).cast("string"), t.labels)
                         .cast("double"))


def l1_columns(t: Tournament, name: str) -> list[str]:
    """Feature columns a level-2 model reads from level-1 member ``name`` (T5)."""
    if t.kind == "regression":
        return [f"_l1_{name}"]
    return [f"_l1_{name}_{i}" for i in range(len(t.labels))]


def _flatten_l1(df: DataFrame, t: Tournament, name: str) -> DataFrame:
    cols = l1_columns(t, name)
    if t.kind == "regression":
        return df.withColumn(cols[0], F.col(f"_p_{name}"))
    return df.withColumns({c: F.col(f"_p_{name}")[i] for i, c in enumerate(cols)})


def _ensure_l1(df: DataFrame, t: Tournament) -> DataFrame:
    """Add the level-1 feature columns, reusing ``_p_`` columns already present."""
    for n in t.l1_names:
        if all(c in df.columns for c in l1_columns(t, n)):
            continue
        added = f"_p_{n}" not in df.columns
        if added:
            df = member_columns(df, t, [n])
        df = _flatten_l1(df, t, n)
        if added:
            df = df.drop(f"_p_{n}")
    return df


def member_columns(df: DataFrame, t: Tournament, names) -> DataFrame:
    """Append ``_p_<name>`` per member (regression value, or probability array).

    Level-2 members first get their level-1 feature columns (T5). Rows are vectorised once for
    all models that share their preparation, as those of one level do.
    """
    out = with_statistics(df, t)
    if any(t.members[n].level > 1 for n in names):
        out = _ensure_l1(out, t)
    held, vectors = None, []
    for name in names:
        m = t.members[name]
        parts = []
        for j, model in enumerate(m.fold_models):
            tmp = f"_f{j}_{name}"
            *prepare, last = model.stages
            uids = [stage.uid for stage in prepare]
            if prepare and uids != held:
                out = out.drop(*vectors)
                before = set(out.columns)
                for stage in prepare:
                    out = stage.transform(out)
                held, vectors = uids, [c for c in out.columns if c not in before]
            out = _transform_to(out, last, t, tmp)
            parts.append(tmp)
        if t.kind == "regression":
            avg = sum((F.col(p) for p in parts[1:]), F.col(parts[0])) / len(parts)
        else:
            avg = F.col(parts[0])
            for p in parts[1:]:
                avg = F.zip_with(avg, F.col(p), lambda a, b: a + b)
            avg = F.transform(avg, lambda x: x / len(parts))
        out = out.withColumn(f"_p_{name}", avg).drop(*parts)
    return out.drop(*vectors, *[c for c in t.spec.encoded if c not in df.columns])


def with_statistics(df: DataFrame, t: Tournament) -> DataFrame:
    """``df`` with the target statistics of its categoricals, unless they are there."""
    if t.statistics is None or all(c in df.columns for c in t.spec.encoded):
        return df
    return encoding.apply(df, t.statistics)


def _transform_to(df: DataFrame, model, t: Tournament, out_col: str) -> DataFrame:
    before = set(df.columns)
    scored = model.transform(df)
    if t.kind == "regression":
        val = F.col("_pred")
    else:
        val = vector_to_array(F.col("_prob"))
    added = [c for c in scored.columns if c not in before]
    return scored.withColumn(out_col, val).drop(*added)


def blend(t: Tournament, weights: dict[str, float]) -> Column:
    """Weighted member blend: a value (regression) or a probability array."""
    items = [(n, w) for n, w in weights.items() if w > 0]
    if t.kind == "regression":
        return sum((F.col(f"_p_{n}") * w for n, w in items[1:]),
                   F.col(f"_p_{items[0][0]}") * items[0][1])
    acc = F.transform(F.col(f"_p_{items[0][0]}"), _scale(items[0][1]))
    for n, w in items[1:]:
        acc = F.zip_with(acc, F.col(f"_p_{n}"), _add_scaled(w))
    return acc


def _scale(w: float):
    return lambda x: x * F.lit(w)


def _add_scaled(w: float):
    return lambda a, b: a + b * F.lit(w)


def argmax_label(prob: Column, labels: list[str]) -> Column:
    """Class label with the highest probability (first on ties)."""
    best = F.array_max(prob)
    pos = F.array_position(prob, best)
    return F.element_at(F.array(*[F.lit(x) for x in labels]), pos.cast("int"))


def _score(df: DataFrame, t: Tournament, pred: Column) -> float:
    """Validation score of a prediction column (T2 metric)."""
    if t.kind == "regression":
        return met.regression_metrics(df.withColumn("_yhat", pred), t.spec.target, "_yhat") \
                  .first()["r2"]
    yhat = argmax_label(pred, t.labels)
    scored = df.withColumn("_yhat", yhat)
    if t.kind == "binary":
        pos = t.labels[-1]
        row = scored.agg(
            F.count_if((F.col(t.spec.target).cast("string") == pos) & (F.col("_yhat") == pos)).alias("tp"),
            F.count_if(F.col("_yhat") == pos).alias("pp"),
            F.count_if(F.col(t.spec.target).cast("string") == pos).alias("ap")).first()
        prec = row["tp"] / row["pp"] if row["pp"] else 0.0
        rec = row["tp"] / row["ap"] if row["ap"] else 0.0
        return 2 * prec * rec / (prec + rec) if prec + rec else 0.0
    return met.classification_metrics(scored, t.spec.target, "_yhat").first()["f1_score"]


# ---------------------------------------------------------------- T3/T4 tournament

def run_tournament(train: DataFrame, val: DataFrame, target: str, kind: str, key_cols,
                   folds: int = 3, pool: dict | None = None, budget_s: float | None = None,
                   exclude=(), ensemble_rounds: int = 25, seed: int = 42,
                   parallelism: int = 8, stack_levels: int = 1) -> Tournament:
    """Fit the pool on ``train`` (bagged), score on ``val``, build the weighted ensemble.

    ``budget_s`` ends the fits that still run when it is over, by the tag of their jobs, and starts no others
    (a member enters the board only with all its folds).  The labelled training frame is cached once, with
    the out-of-fold target statistics of its categoricals,
    and reused by every fit; up to ``parallelism`` members are fitted as concurrent jobs, each one fold at a time.
    ``stack_levels=2`` adds a second bagged pool fed with out-of-fold level-1
    predictions (T5; unset in the reference configuration, so off by default).
    """
    spec = feature_spec(train, target, kind, exclude=tuple(exclude), hash_wide=False)
    labels = None
    if kind != "regression":
        found = (train.select(F.col(target).cast("string")).filter(F.col(target).isNotNull())
                      .distinct().limit(MAX_CATEGORIES + 1).collect())
        if len(found) > MAX_CATEGORIES:
            raise ValueError(f"more than {MAX_CATEGORIES} classes in '{target}'")
        labels = sorted(r[0] for r in found)
    t = Tournament(kind, eval_metric_for(kind), spec, labels)
    pool = pool or model_pool(kind, len(labels or []), seed)
    base = _label_frame(train, t).filter(F.col("_label").isNotNull()).withColumn(
        "_fold", fold_of(key_cols, folds, seed))
    if spec.categorical:
        # statistics need rows outside a fold: three folds of their own where there is no bagging
        base = base.withColumn("_q_part", F.col("_fold") if folds > 1 else fold_of(key_cols, 3, seed))
        classes = [F.col("_label")] if kind != "multiclass" else [
            (F.col("_label") == i).cast("double") for i in range(len(labels))]
        t.statistics, base = encoding.learn(base, spec.categorical, classes, "_q_part")
        base = base.drop("_q_part")
        spec.encoded = [n for c in spec.categorical for n in encoding.names_of(c, len(classes))]
    base = base.repartition(_partitions_for(base)).cache()
    started = time.time()
    t.members.update(_fit_pool(base, spec, pool, kind, folds, parallelism, budget_s, started))
    if stack_levels >= 2 and folds >= 2 and t.members:
        # level 2: the pool again, with out-of-fold level-1 predictions as extra features
        t.l1_names = list(t.members)
        oof = _oof_features(base, t, folds)
        l1_feats = [c for n in t.l1_names for c in l1_columns(t, n)]
        spec2 = FeatureSpec(spec.numeric + l1_feats, spec.categorical, target, kind, spec.dates, spec.hashed,
                            spec.encoded)
        base2 = oof.repartition(_partitions_for(oof)).cache()
        t.members.update(_fit_pool(base2, spec2, pool, kind, folds, parallelism, budget_s,
                                   started, suffix="_l2", level=2, first_order=len(t.members)))
        base2.unpersist()
    base.unpersist()
    with batches_by_rows(val.sparkSession):
        scored = _score_members(t, val)
    _fit_ensemble(t, scored, ensemble_rounds)
    scored.unpersist()
    return t


def fold_of(key_cols, folds: int, seed: int) -> Column:
    """Fold of a row: the first 32 bits of the MD5 of its key and the seed, modulo ``folds``."""
    text = F.concat_ws("|", *[F.coalesce(F.col(f"`{k}`").cast("string"), F.lit("")) for k in key_cols], F.lit(str(seed)))
    return (F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long") % F.lit(folds)).cast("int")


def linear_inputs(spec: FeatureSpec) -> list[str]:
    """The inputs of a linear member as SQL expressions, those that ``vectorizer`` gives the others."""
    dates = [f"{fn}(`{c}`)" for c in spec.dates for fn in DATE_PARTS.values()]
    return [*[f"`{c}`" for c in spec.numeric], *dates, *[f"`{c}`" for c in spec.encoded]]


class Deadline:
    """Ends what runs under its tag once ``seconds`` are over, again and again until ``close``: a fit is
    many jobs, and the next one starts when one is cancelled."""

    def __init__(self, spark, seconds: float | None):
        self.context, self.tag = spark.sparkContext, f"quarry-{uuid.uuid4().hex}"
        self.end = None if seconds is None else time.time() + seconds
        self.done = threading.Event()
        self.thread = threading.Thread(target=self._watch, daemon=True)
        if self.end is not None:
            self.thread.start()

    @property
    def over(self) -> bool:
        return self.end is not None and time.time() >= self.end

    def _watch(self) -> None:
        self.done.wait(max(0.0, self.end - time.time()))
        while not self.done.is_set():
            self.context.cancelJobsWithTag(self.tag)
            self.done.wait(0.1)

    def close(self) -> None:
        self.done.set()
        if self.end is not None:
            self.thread.join()


def _fit_pool(base: DataFrame, spec: FeatureSpec, pool: dict, kind: str, folds: int,
              parallelism: int, budget_s: float | None, started: float, suffix: str = "",
              level: int = 1, first_order: int = 0) -> dict[str, Member]:
    """Fit the members side by side as concurrent Spark jobs; complete members only.

    Regression trees are fitted from blocks of binned rows (``trees.py``), all folds of a member at once. Of other
    members the folds go one after another: every fit holds a copy of its rows, and many at once would not
    stay in memory. These read one vectorised frame; the means of missing features are those of the whole training set.
    """
    jobs = []
    for order, (name, (factory, one_hot)) in enumerate(pool.items(), start=first_order + 1):
        for j in range(folds):
            jobs.append((order, name + suffix, factory, one_hot, j))
    deadline = Deadline(base.sparkSession, None if budget_s is None else budget_s - (time.time() - started))
    label = "_label"
    ready = vectors = None
    blocks: dict[int, hist.Blocks] = {}
    asked = {name: factory("_features", label).setPredictionCol("_pred") for name, (factory, _) in pool.items()
             if not isinstance(factory, LeastSquares)}
    inputs = vector_inputs(spec)
    binned = {name for name, est in asked.items() if kind == "regression" and inputs and hist.fits(est)}
    if asked:
        ready = Pipeline(stages=vectorizer(spec, True, "_features")).fit(base)
        if set(asked) - binned:
            vectors = ready.transform(base).select("_fold", label, "_features").cache()

    def fit_one(job):
        order, name, factory, one_hot, j = job
        if deadline.over:
            return []
        context = base.sparkSession.sparkContext
        context.addJobTag(deadline.tag)
        t0 = time.time()
        try:
            if isinstance(factory, LeastSquares):  # all folds at once
                fitted = factory.fit(base, linear_inputs(spec), label, "_fold" if folds > 1 else None, folds)
                each = (time.time() - t0) / folds
                return [((order, name, factory, one_hot, k), m, each) for k, m in enumerate(fitted)]
            plain = name.removesuffix(suffix)
            if plain in binned:  # all folds at once
                est = asked[plain]
                fitted = hist.fit(est, blocks[est.getMaxBins()], inputs, folds)
                each = (time.time() - t0) / folds
                return [((order, name, factory, one_hot, k), PipelineModel([*ready.stages, m]), each)
                        for k, m in enumerate(fitted)]
            part = vectors.filter(F.col("_fold") != j) if folds > 1 else vectors
            est = factory("_features", label).setPredictionCol("_pred")
            if kind != "regression":
                est = est.setProbabilityCol("_prob").setRawPredictionCol("_raw")
            return [(job, PipelineModel([*ready.stages, est.fit(part)]), time.time() - t0)]
        except Exception:
            if deadline.over:  # its jobs were cancelled
                return []
            raise
        finally:
            context.removeJobTag(deadline.tag)

    def fit_all(chain):
        return [r for job in chain for r in fit_one(job)]

    # fits are independent Spark jobs; running a few at once keeps executors busy
    once = [job for job in jobs if job[4] == 0 or not (
        isinstance(job[2], LeastSquares) or job[1].removesuffix(suffix) in binned)]
    chains: dict[str, list] = {}
    for job in once:
        chains.setdefault(job[1], []).append(job)
    try:
        for most in sorted({asked[name].getMaxBins() for name in binned}):
            blocks[most] = hist.blocks_of(ready.transform(base), inputs, label, "_fold", folds, most,
                                          min(asked[name].getSeed() for name in binned))
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool_exec:
            results = [r for found in pool_exec.map(fit_all, chains.values()) for r in found]
    finally:
        deadline.close()
        for held in blocks.values():
            held.rdd.unpersist()
        if vectors is not None:
            vectors.unpersist()
    members: dict[str, Member] = {}
    for order, name, _f, _o, _j in jobs:
        if name in members:
            continue
        fitted = [(r[0][4], r[1], r[2]) for r in results if r[0][1] == name and r[1] is not None]
        if len(fitted) == folds:
            fitted.sort(key=lambda x: x[0])
            members[name] = Member(name, [m for _, m, _ in fitted], sum(x[2] for x in fitted),
                                   fit_order=order, level=level)
    return members


def _oof_features(base: DataFrame, t: Tournament, folds: int) -> DataFrame:
    """Training rows with out-of-fold level-1 predictions: fold j is scored by the
    models that did not see it, so level 2 learns from honest predictions."""
    parts = []
    for j in range(folds):
        part = base.filter(F.col("_fold") == j)
        for n in t.l1_names:
            part = _transform_to(part, t.members[n].fold_models[j], t, f"_p_{n}")
            part = _flatten_l1(part, t, n).drop(f"_p_{n}")
        parts.append(part)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _partitions_for(df: DataFrame) -> int:
    """The input's own splits, or one partition a core where it has fewer."""
    return max(df.rdd.getNumPartitions(), df.sparkSession.sparkContext.defaultParallelism)


def _score_members(t: Tournament, val: DataFrame) -> DataFrame:
    """Score each member on validation; returns validation with every ``_p_<name>`` column.

    Members are added one at a time to a cached frame, so each model
    transforms the validation rows exactly once; a member's prediction time
    is the time of its own step.
    """
    current = with_statistics(val, t).cache()
    steps = [current]
    for name, m in t.members.items():
        t0 = time.time()
        nxt = member_columns(current, t, [name]).cache()
        m.score_val = _score(nxt, t, F.col(f"_p_{name}"))
        m.pred_time_val = time.time() - t0
        steps.append(nxt)
        current = nxt
    for frame in steps[:-1]:
        frame.unpersist()
    return current


# ---------------------------------------------------------------- T6 ensemble

def gram_stats(df: DataFrame, y: str, preds: list[str]) -> dict:
    """One aggregate over the rows without a missing label or prediction: n, the label's sum of
    squares about its mean, and the sums of products of the members' errors. Errors, not raw values:
    a large offset of the label would cancel out all digits of a difference of raw sums."""
    yc, *ps = met.usable(y, *preds)
    errors = [yc - p for p in ps]
    aggs = [F.count(yc).alias("n"), (F.var_pop(yc) * F.count(yc)).alias("sst")]
    for i, a in enumerate(errors):
        aggs += [F.sum(a * errors[j]).alias(f"see{i}_{j}") for j in range(i, len(errors))]
    return df.agg(*aggs).first().asDict()


def r2_from_gram(g: dict, w: list[float]) -> float:
    """R^2 = 1 - SSE/SST of the blend sum w_i p_i, weights summing to 1: its error is sum w_i e_i, so
    SSE = w'Ew follows from the products of the members' errors."""
    k = len(w)
    if not g["n"]:
        return float("nan")
    sse = sum(w[i] * w[j] * g[f"see{min(i, j)}_{max(i, j)}"] for i in range(k) for j in range(k))
    sst = g["sst"]
    if sst == 0:
        return 1.0 if sse == 0 else 0.0
    return 1.0 - sse / sst


def greedy_weights(score_fn, k: int, rounds: int = 25) -> tuple[dict[int, float], float]:
    """Forward selection with replacement: add the member that most improves the blend."""
    counts = [0] * k
    best_score, best_counts = float("-inf"), None
    for _ in range(rounds):
        trial = []
        for i in range(k):
            c = list(counts)
            c[i] += 1
            total = sum(c)
            trial.append((score_fn([x / total for x in c]), -i, c))
        score, _, counts = max(trial)
        if score > best_score + 1e-12:
            best_score, best_counts = score, list(counts)
    total = sum(best_counts)
    return {i: c / total for i, c in enumerate(best_counts) if c}, best_score


def ensemble_from_predictions(df: DataFrame, y: str, preds: list[str], rounds: int = 25
                              ) -> tuple[dict[str, float], float]:
    """Greedy weights for fixed regression predictors over ``df`` (one data pass)."""
    g = gram_stats(df, y, preds)
    w, score = greedy_weights(lambda ws: r2_from_gram(g, ws), len(preds), rounds)
    return {preds[i]: v for i, v in w.items()}, score


def _fit_ensemble(t: Tournament, scored: DataFrame, rounds: int) -> None:
    """Greedy weights from validation rows that already carry every member's prediction."""
    names = list(t.members)
    if not names:
        return
    t0 = time.time()
    if t.kind == "regression":
        g = gram_stats(scored, t.spec.target, [f"_p_{n}" for n in names])
        w, score = greedy_weights(lambda ws: r2_from_gram(g, ws), len(names), rounds)
    else:
        # each round scores all k candidate blends in one pass over the validation rows
        w, score = _greedy_classification(scored, t, names, rounds)
    t.weights = {names[i]: v for i, v in w.items()}
    t.ensemble_score = score
    t.ensemble_fit_time = time.time() - t0
    t.ensemble_pred_time = 0.0


def _f1_from_confusion(rows, kind: str, labels: list[str]) -> float:
    """Binary F1 of the last label, or support-weighted F1, from (truth, pred, n) rows."""
    truth, pred, tp = {}, {}, {}
    for y, p, n in rows:
        truth[y] = truth.get(y, 0) + n
        pred[p] = pred.get(p, 0) + n
        if y == p:
            tp[y] = tp.get(y, 0) + n

    def f1(c):
        prec = tp.get(c, 0) / pred[c] if pred.get(c) else 0.0
        rec = tp.get(c, 0) / truth[c] if truth.get(c) else 0.0
        return 2 * prec * rec / (prec + rec) if prec + rec else 0.0

    if kind == "binary":
        return f1(labels[-1])
    total = sum(truth.values())
    return sum(f1(c) * s for c, s in truth.items()) / total if total else 0.0


def _greedy_classification(scored: DataFrame, t: Tournament, names, rounds):
    """Greedy blend search; each round scores all k candidates in one grouped pass.

    The argmax of a blend does not change under scaling, so candidate i is
    scored on sum_j count_j * p_j + p_i without normalising.
    """
    k = len(names)
    counts = [0] * k
    best_score, best_counts = float("-inf"), None
    cand_p = F.when(F.col("_cand") == 0, F.col(f"_p_{names[0]}"))
    for i in range(1, k):
        cand_p = cand_p.when(F.col("_cand") == i, F.col(f"_p_{names[i]}"))
    expanded = scored.withColumn("_cand", F.explode(F.array(*[F.lit(i) for i in range(k)])))
    y = F.col(t.spec.target).cast("string")
    for _ in range(rounds):
        used = {names[j]: float(counts[j]) for j in range(k) if counts[j]}
        prob = F.zip_with(blend(t, used), cand_p, lambda a, b: a + b) if used else cand_p
        conf = (expanded.withColumn("_yhat", argmax_label(prob, t.labels))
                        .groupBy("_cand", y.alias("_y"), "_yhat").count().collect())
        trial = []
        for i in range(k):
            rows = [(r["_y"], r["_yhat"], r["count"]) for r in conf if r["_cand"] == i]
            c = list(counts)
            c[i] += 1
            trial.append((_f1_from_confusion(rows, t.kind, t.labels), -i, c))
        score, _, counts = max(trial)
        if score > best_score + 1e-12:
            best_score, best_counts = score, list(counts)
        elif score < best_score - 1e-12:
            break
    total = sum(best_counts)
    return {i: c / total for i, c in enumerate(best_counts) if c}, best_score


# ---------------------------------------------------------------- T7 leaderboard

def leaderboard(t: Tournament) -> list[tuple]:
    """Rows: model, score_val, eval_metric, pred_time_val, fit_time, pred_time_val_marginal,
    fit_time_marginal, stack_level, can_infer, fit_order - best first."""
    rows = []
    for n, m in t.members.items():
        rows.append((f"{n}_bag", m.score_val, t.eval_metric, m.pred_time_val, m.fit_time,
                     m.pred_time_val, m.fit_time, m.level, True, m.fit_order))
    if t.weights:
        used = [t.members[n] for n in t.weights]
        top = max(m.level for m in t.members.values()) + 1
        rows.append(("weighted_ensemble", t.ensemble_score, t.eval_metric,
                     sum(m.pred_time_val for m in used) + t.ensemble_pred_time,
                     sum(m.fit_time for m in used) + t.ensemble_fit_time,
                     t.ensemble_pred_time, t.ensemble_fit_time, top, True, len(t.members) + 1))
    return sorted(rows, key=lambda r: (-(r[1] if r[1] is not None else float("-inf")), r[9]))


LEADERBOARD_SCHEMA = ("model string, score_val double, eval_metric string, pred_time_val double, "
                      "fit_time double, pred_time_val_marginal double, fit_time_marginal double, "
                      "stack_level int, can_infer boolean, fit_order int")


def leaderboard_frame(spark, t: Tournament) -> DataFrame:
    return spark.createDataFrame(leaderboard(t), LEADERBOARD_SCHEMA)


# ---------------------------------------------------------------- T8/T9 scoring

def predict(df: DataFrame, t: Tournament, model: str | None = None, out_col: str = "prediction"
            ) -> DataFrame:
    """Append the prediction of ``model`` (default: best) - the label for classification."""
    name = model or t.best
    weights = t.weights if name == "weighted_ensemble" else {name: 1.0}
    scored = member_columns(df, t, list(weights))
    value = blend(t, weights)
    if t.kind != "regression":
        value = argmax_label(value, t.labels)
    drop = [f"_p_{n}" for n in weights] + [c for c in scored.columns if c.startswith("_l1_")]
    return scored.withColumn(out_col, value).drop(*drop)


def predict_proba(df: DataFrame, t: Tournament, model: str | None = None, prefix: str = "prob_"
                  ) -> DataFrame:
    """Append one probability column per class, in sorted class order."""
    if t.kind == "regression":
        raise ValueError("probabilities need a classification tournament")
    name = model or t.best
    weights = t.weights if name == "weighted_ensemble" else {name: 1.0}
    scored = member_columns(df, t, list(weights)).withColumn("_q_prob", blend(t, weights))
    cols = {f"{prefix}{lbl}": F.col("_q_prob")[i] for i, lbl in enumerate(t.labels)}
    l1 = [c for c in scored.columns if c.startswith("_l1_")]
    return scored.withColumns(cols).drop("_q_prob", *[f"_p_{n}" for n in weights], *l1)


# ---------------------------------------------------------------- S10 persistence

def save(t: Tournament, path: str, spark) -> None:
    """Persist the best model: the ensemble's members with non-zero weight, or the best
    single member with weight 1 (plus the level-1 members a level-2 member reads)."""
    weights = dict(t.weights) if t.best == "weighted_ensemble" else {t.best: 1.0}
    keep = list(weights)
    if any(t.members[n].level > 1 for n in keep):
        keep += [n for n in t.l1_names if n not in keep]   # level 2 reads level-1 outputs
    for n in keep:
        for j, model in enumerate(t.members[n].fold_models):
            model.write().overwrite().save(f"{path}/{n}/fold{j}")
    meta = [(n, float(weights.get(n, 0.0)), len(t.members[n].fold_models), t.members[n].level)
            for n in keep]
    spark.createDataFrame(meta, "member string, weight double, folds int, level int") \
         .coalesce(1).write.mode("overwrite").json(f"{path}/_weights")
    about = json.dumps({"kind": t.kind, "eval_metric": t.eval_metric, "labels": t.labels, "spec": asdict(t.spec),
                        "statistics": None if t.statistics is None else {
                            "columns": t.statistics.columns, "prior": t.statistics.prior,
                            "smoothing": t.statistics.smoothing}})
    if t.statistics is not None:
        t.statistics.table.write.mode("overwrite").parquet(f"{path}/_statistics")
    spark.createDataFrame([(about,)], "value string") \
         .coalesce(1).write.mode("overwrite").text(f"{path}/_about")


def load(path: str, spark) -> Tournament:
    """Reload a saved model from its path alone: kind, metric, labels and feature spec lie beside the
    weights, so another process can score with it.

    The reloaded tournament predicts with the saved weights (its ``best`` is the blend).
    """
    about = json.loads(spark.read.text(f"{path}/_about").first()["value"])
    meta = spark.read.json(f"{path}/_weights").collect()
    t = Tournament(about["kind"], about["eval_metric"], FeatureSpec(**about["spec"]), about["labels"])
    if about.get("statistics"):
        t.statistics = encoding.Statistics(table=spark.read.parquet(f"{path}/_statistics"), **about["statistics"])
    for r in meta:
        models = [PipelineModel.load(f"{path}/{r['member']}/fold{j}") for j in range(r["folds"])]
        t.members[r["member"]] = Member(r["member"], models, 0.0, level=r["level"])
    if any(r["level"] > 1 for r in meta):
        t.l1_names = [r["member"] for r in meta if r["level"] == 1]
    t.weights = {r["member"]: r["weight"] for r in meta if r["weight"] > 0}
    t.ensemble_score = float("inf")
    return t
