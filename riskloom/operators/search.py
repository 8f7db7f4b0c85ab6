"""Hyperparameter search: sampling a space, running trials, stopping early."""

from __future__ import annotations

import json
import logging
import math
from concurrent.futures import ThreadPoolExecutor
from threading import Condition

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.expressions import hash_uniform
from riskloom.operators.metrics import best_trial
from riskloom.operators.quantiles import grouped_quantile
from riskloom.operators.training import TrainingFrame, boost, evaluate, train_boosted, train_forest
from riskloom.operators.trees import TreeEnsembleModel
from riskloom.workspace import small_frame

logger = logging.getLogger(__name__)

MAX_TRIALS = 10_000  # configurations live on the driver; callers may set another limit


def _draw(spec: dict, uniform: Column) -> Column:
    kind = spec.get("type")
    if kind == "choice":
        options = F.array(*[F.lit(v) for v in spec["values"]])
        return F.element_at(options, (F.floor(uniform * len(spec["values"])) + 1).cast("int"))
    if kind not in ("randint", "uniform", "loguniform"):
        raise ValueError(f"unknown search-space type {kind!r}")
    lo, hi = float(spec["lower"]), float(spec["upper"])
    if kind == "randint":
        return (F.lit(lo) + F.floor(uniform * (hi - lo))).cast("int")
    if kind == "uniform":
        return F.lit(lo) + uniform * F.lit(hi - lo)
    return F.exp(F.lit(math.log(lo)) + uniform * F.lit(math.log(hi) - math.log(lo)))


def sample_space(trials: DataFrame, trial_id: str, space: dict[str, dict], seed: int = 42) -> DataFrame:
    """One configuration per trial row: repeatable draws from the trial id, name and seed.

    Parameters of type ``grid_search`` expand every trial into all their values.
    """
    drawn = trials.select(
        trial_id,
        *[
            _draw(spec, hash_uniform([F.lit(seed), F.lit(name), trial_id])).alias(name)
            for name, spec in space.items()
            if spec.get("type") != "grid_search"
        ],
    )
    for name, spec in space.items():
        if spec.get("type") == "grid_search":
            drawn = drawn.select("*", F.explode(F.array(*[F.lit(v) for v in spec["values"]])).alias(name))
    return drawn.select(trial_id, *space)


def _fit(ready: TrainingFrame, config: dict, estimator: str, seed: int):
    if estimator == "forest":
        return train_forest(
            ready,
            num_trees=config["n_estimators"],
            max_depth=config["max_depth"],
            seed=seed,
            subsamplingRate=config.get("subsample", 1.0),
        )
    return train_boosted(
        ready,
        num_trees=config["n_estimators"],
        max_depth=config["max_depth"],
        learning_rate=config.get("learning_rate", 0.1),
        subsample=config.get("subsample", 1.0),
        feature_share=config.get("colsample_bytree", 1.0),
        reg_alpha=config.get("reg_alpha", 0.0),
        reg_lambda=config.get("reg_lambda", 1.0),
        seed=seed,
    )


def run_search(
    train: DataFrame,
    test: DataFrame,
    numeric: list[str],
    categorical: list[str],
    target: str,
    space: dict[str, dict],
    num_samples: int,
    metric: str = "f1_macro",
    estimator: str = "boosted",
    seed: int = 42,
    concurrent: int = 2,
    max_trials: int = MAX_TRIALS,
) -> DataFrame:
    """(trial_id, params, score): every trial is a distributed fit, a few run side by side.

    A trial that fails scores 0.0. The configurations, ``num_samples`` of them, live on the driver.
    """
    if num_samples > max_trials:
        raise ValueError(f"at most {max_trials} trials")
    spark = train.sparkSession
    ids = spark.range(num_samples).withColumnRenamed("id", "trial_id")
    configs = [row.asDict() for row in sample_space(ids, "trial_id", space, seed).orderBy("trial_id").collect()]
    ready = TrainingFrame(train, numeric, categorical, target, balanced=estimator == "forest")
    held_out = test.select(*numeric, *categorical, target).persist()

    def trial(item: tuple[int, dict]) -> tuple:
        number, config = item
        params = {k: v for k, v in config.items() if k != "trial_id"}
        try:
            model = _fit(ready, params, estimator, seed)
            score = float(evaluate(model, held_out, target).head()[metric])
        except Exception:  # a bad configuration must not end the search
            logger.exception("trial failed: %s", params)
            score = 0.0
        return number, json.dumps(params, sort_keys=True), score

    try:
        with ThreadPoolExecutor(concurrent) as pool:
            results = list(pool.map(trial, enumerate(configs)))
    finally:
        held_out.unpersist()
        ready.close()
    return small_frame(spark, results, "trial_id bigint, params string, score double")


def _sign(mode: str) -> float:
    if mode not in ("max", "min"):
        raise ValueError("mode must be 'max' or 'min'")
    return 1.0 if mode == "max" else -1.0


def halving_promote(results: DataFrame, rung: str, metric: str, factor: int = 2, mode: str = "max") -> DataFrame:
    """Which trials of each rung go on: those not worse than the rung's top 1/factor cutoff.

    The cutoff is the exact interpolated quantile at 1 - 1/factor of every rung, however many
    rungs there are and however many trials they hold.
    """
    score = F.col(metric).cast("double") * _sign(mode)
    cutoffs = grouped_quantile(results.select(F.col(rung).alias("_rung"), score.alias("_score")), ["_rung"], "_score", 1 - 1 / factor)
    joined = results.join(cutoffs.withColumnRenamed("quantile", "_cutoff"), F.col(rung).eqNullSafe(F.col("_rung")), "left")
    return joined.select(*results.columns, F.coalesce(score >= F.col("_cutoff"), F.lit(False)).alias("promoted"))


def run_halving(
    train: DataFrame,
    test: DataFrame,
    numeric: list[str],
    categorical: list[str],
    target: str,
    space: dict[str, dict],
    num_samples: int,
    max_trees: int,
    grace: int = 1,
    factor: int = 2,
    metric: str = "f1_macro",
    mode: str = "max",
    estimator: str = "forest",
    seed: int = 42,
    concurrent: int = 4,
    max_trials: int = MAX_TRIALS,
) -> DataFrame:
    """Search with early stopping: rungs of grace, grace*factor, ... trees, survivors go on.

    The trials of a rung run side by side, ``concurrent`` at a time. Returns (trial_id, rung,
    params, score) for every rung a trial reached; a trial that fails scores worst.
    """
    if num_samples > max_trials:
        raise ValueError(f"at most {max_trials} trials")
    spark, worst = train.sparkSession, -_sign(mode) * math.inf
    fixed = {k: v for k, v in space.items() if k != "n_estimators"}
    ids = spark.range(num_samples).withColumnRenamed("id", "trial_id")
    alive = {r["trial_id"]: r.asDict() for r in sample_space(ids, "trial_id", fixed, seed).collect()}
    ready = TrainingFrame(train, numeric, categorical, target, balanced=estimator == "forest")
    held_out = test.select(*numeric, *categorical, target).persist()
    reached, trees = [], grace

    def trial(item: tuple[int, dict]) -> tuple:
        number, config = item
        params = {k: v for k, v in config.items() if k != "trial_id"} | {"n_estimators": trees}
        try:
            score = float(evaluate(_fit(ready, params, estimator, seed), held_out, target).head()[metric])
        except Exception:  # a bad configuration must not end the search
            logger.exception("trial failed: %s", params)
            score = worst
        return number, trees, json.dumps(params, sort_keys=True), score

    try:
        while alive and trees <= max_trees:
            with ThreadPoolExecutor(concurrent) as pool:
                rows = list(pool.map(trial, sorted(alive.items())))
            reached += rows
            ranked = small_frame(spark, rows, "trial_id bigint, rung int, params string, score double")
            kept = halving_promote(ranked, "rung", "score", factor, mode).filter("promoted").collect()
            alive = {r["trial_id"]: alive[r["trial_id"]] for r in kept} if len(rows) > 1 else alive
            trees *= factor
    finally:
        held_out.unpersist()
        ready.close()
    return small_frame(spark, reached, "trial_id bigint, rung int, params string, score double")


class Rungs:
    """Asynchronous halving: which trial goes on is decided by the results that have arrived.

    A trial of rung k goes on to rung k + 1 as soon as it is in the best 1 / factor of the results of its
    rung; of several the one on the highest rung, then with the best score, goes first. A trial that
    wasn't good enough when it arrived may go on later, when worse ones have followed.
    """

    def __init__(self, factor: int = 2, mode: str = "max"):
        self.factor, self.sign = factor, _sign(mode)
        self.results: dict[int, dict[int, float]] = {}
        self.gone: set[tuple[int, int]] = set()

    def record(self, trial: int, rung: int, score: float, last: bool) -> None:
        self.results.setdefault(rung, {})[trial] = score * self.sign
        if last:  # it can't go higher, but counts among the best of its rung
            self.gone.add((trial, rung))

    def take(self) -> tuple[int, int] | None:
        """``(trial, its next rung)`` of a trial that may go on, which is then under way."""
        for rung in sorted(self.results, reverse=True):
            found = self.results[rung]
            best = sorted(found, key=lambda t: (-found[t], t))[: len(found) // self.factor]
            for trial in best:
                if (trial, rung) not in self.gone:
                    self.gone.add((trial, rung))
                    return trial, rung + 1
        return None


def run_async_halving(
    train: DataFrame,
    test: DataFrame,
    numeric: list[str],
    categorical: list[str],
    target: str,
    space: dict[str, dict],
    num_samples: int,
    grace: int = 50,
    factor: int = 2,
    metric: str = "f1_macro",
    mode: str = "max",
    seed: int = 42,
    concurrent: int = 8,
    max_trials: int = MAX_TRIALS,
) -> DataFrame:
    """Search by boosting with early stopping and without repeated work.

    A trial draws all of ``space``, ``n_estimators`` too; its rungs are grace, grace * factor, ... rounds and at
    last its own ``n_estimators``. On each rung it goes on from the ensemble of the rung below. Returns
    (trial_id, rung, params, score, trees_fitted): one row per rung a trial reached, ``rung`` in rounds,
    ``trees_fitted`` the rounds that this step added. A trial that fails scores worst and ends.
    """
    if num_samples > max_trials:
        raise ValueError(f"at most {max_trials} trials")
    spark, worst = train.sparkSession, -_sign(mode) * math.inf
    ids = spark.range(num_samples).withColumnRenamed("id", "trial_id")
    configs = {r["trial_id"]: r.asDict() for r in sample_space(ids, "trial_id", space, seed).collect()}
    if len(configs) != num_samples:
        raise ValueError("a grid has several configurations per trial: search it by run_search")
    ready = TrainingFrame(train, numeric, categorical, target, balanced=False)
    ready.binned  # noqa: B018  (made before the trials share it)
    held_out = ready.preprocessor.transform(test.select(*numeric, *categorical, target)).select("features", target)
    # dealt out, as a table may be one split: each step scores it with all trees of a trial
    held_out = held_out.repartition(2 * spark.sparkContext.defaultParallelism).persist()
    rungs, ready_to_start, running = Rungs(factor, mode), sorted(configs), set()
    ensembles, reached, turn = {}, [], Condition()

    def rounds_at(trial: int, rung: int) -> int:
        return min(configs[trial].get("n_estimators", grace), grace * factor**rung)

    def step(trial: int, rung: int) -> tuple:
        config = configs[trial]
        params = {k: v for k, v in config.items() if k != "trial_id"}
        rounds, before = rounds_at(trial, rung), ensembles.get(trial)
        try:
            ensembles[trial] = boost(
                ready,
                rounds,
                before,
                max_depth=config.get("max_depth", 6),
                learning_rate=config.get("learning_rate", 0.3),
                subsample=config.get("subsample", 1.0),
                feature_share=config.get("colsample_bytree", 1.0),
                l1=config.get("reg_alpha", 0.0),
                l2=config.get("reg_lambda", 1.0),
                seed=seed,
            )
            model = ready.finish_features(TreeEnsembleModel(ensembles[trial]))
            score = float(evaluate(model, held_out, target).head()[metric])
        except Exception:  # a bad configuration must not end the search
            logger.exception("trial failed: %s", params)
            score = worst
        fitted = rounds - (before.rounds if before else 0)
        return trial, rounds, json.dumps(params, sort_keys=True), score, fitted

    def work(_: int) -> None:
        while True:
            with turn:
                while True:
                    job = rungs.take() or ((ready_to_start.pop(0), 0) if ready_to_start else None)
                    if job or not running:
                        break
                    turn.wait()
                if job is None:
                    turn.notify_all()
                    return
                running.add(job[0])
            row = step(*job)
            with turn:
                reached.append(row)
                running.discard(job[0])
                last = row[1] >= configs[job[0]].get("n_estimators", grace) or row[3] == worst
                rungs.record(*job, row[3], last)
                turn.notify_all()

    try:
        with ThreadPoolExecutor(concurrent) as pool:
            list(pool.map(work, range(concurrent)))
    finally:
        held_out.unpersist()
        ready.close()
    return small_frame(spark, reached, "trial_id bigint, rung int, params string, score double, trees_fitted int")


def search_result_row(results: DataFrame, job_id: str, metric: str, created_at: Column, mode: str = "max") -> DataFrame:
    """The log row of a finished search: job, best parameters, best score, metric, time."""
    return best_trial(results, "score", mode, "trial_id").select(
        F.lit(job_id).alias("job_id"),
        F.col("params").alias("best_params"),
        F.col("score").alias("best_score"),
        F.lit(metric).alias("metric_name"),
        created_at.alias("created_at"),
    )
