"""Outcome models on Spark ML: split by season, search, fit, score, explain, persist."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace

import numpy as np
from pyspark import SparkContext
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from formline.functions import scalars
from formline.operators import boosting
from formline.operators.datasets import HOME_WIN_FEATURES, LABEL
from formline.operators.metrics import METRICS
from formline.scratch import kept, new_folder

PREDICTION = "model_prediction"
SEED = 38
HELD_OUT = "_held_out"
ROWS_PER_BUCKET = 10_000
#: Rounds of the first fit of those that may stop early.
FIRST_ROUNDS = 32
#: Fixed value: rounds a fit that stops early may take at most.
MOST_ROUNDS = 4_000
#: Rows that one task of a fit reads: as few while there are cores for the tasks, and the most it reads.
ROWS_PER_TASK, MOST_ROWS_PER_TASK = 10_000, 500_000

# Ranges the search draws from.
BINARY_RANGES = {"step": (0.01, 0.3), "depth": (3, 10), "rows": (0.6, 1.0), "columns": (0.6, 1.0)}
REGRESSION_RANGES = {"step": (0.0, 0.5), "depth": (3, 10), "rows": (0.4, 0.9), "columns": (0.4, 0.9)}


@dataclass(frozen=True)
class TreeParams:
    """Settings of a boosted-tree fit.

    With held-out rows the fit keeps the rounds up to their least loss, where ``patience`` more
    rounds bring no lower one.
    """

    depth: int = 5
    step: float = 0.1
    rows: float = 1.0
    columns: float = 1.0
    rounds: int = 100
    patience: int = 20
    seed: int = SEED


@dataclass
class Search:
    """Trials in the order drawn: settings, with the rounds kept, and the metric on the validation season.

    A trial that was dropped has the rounds and the metric it had then.
    """

    metric: str
    trials: list[tuple[TreeParams, float]] = field(default_factory=list)
    finished: list[int] = field(default_factory=list)

    @property
    def best(self) -> TreeParams:
        """Of the trials that were run to their least loss, or of all where none is named."""
        of = [self.trials[i] for i in self.finished] or self.trials
        return min(of, key=lambda t: t[1])[0]


def kept_rounds(losses: Sequence[float], patience: int) -> int:
    """Rounds up to the least loss before ``patience`` rounds bring none lower."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def _estimator(kind: str, params: TreeParams, label: str):
    settings = dict(
        featuresCol="features", labelCol=label, maxDepth=params.depth, stepSize=params.step, maxIter=params.rounds,
        subsamplingRate=params.rows, featureSubsetStrategy=str(params.columns), seed=params.seed,
    )
    if params.columns >= 1.0:
        settings["featureSubsetStrategy"] = "all"
    if kind == "classifier":
        return GBTClassifier(**settings)
    return GBTRegressor(lossType="absolute", **settings)


def _complete(rows: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Rows that can be fitted: those with a label and all features."""
    return rows.where(F.col(label).isNotNull()).na.drop(subset=list(features))


def fit_tasks(rows: DataFrame, at_once: int = 1) -> int:
    """Tasks that a fit on these rows is dealt to, of ``at_once`` fits that share the cores.

    Every level of every tree is a job in which each task puts out the statistics of all nodes and features, however
    few its rows. So tasks beyond what the rows need cost shuffled bytes, and those beyond the cores a second turn a level.
    """
    count = rows.count()
    cores = max(1, rows.sparkSession.sparkContext.defaultParallelism // at_once)
    return max(1, min(-(-count // ROWS_PER_TASK), cores), -(-count // MOST_ROWS_PER_TASK))


def fit_trees(
    rows: DataFrame, features: Sequence[str], label: str, params: TreeParams, kind: str, held_out: str | None = None,
    tasks: int | None = None, grown: PipelineModel | None = None, compact: bool = False,
) -> PipelineModel:
    """Fit on rows with a label. ``held_out`` is a boolean SQL expression: those rows only decide when to stop.

    ``tasks`` is what ``fit_tasks`` says of the rows, where the caller knows it. ``grown`` is an earlier fit of the
    first rounds on the same rows and settings; a fit that may stop early is not made again for these. Without either,
    rows beyond one task's, or any with ``compact``, are fitted by a task that holds them all in codes, if one can.
    """
    data = _complete(rows, features, label)
    if held_out:
        data = data.withColumn(HELD_OUT, F.expr(held_out))
    assembler = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")
    if tasks is None and grown is None:
        held, every = (F.col(HELD_OUT), data.where(F.col(HELD_OUT).isNotNull())) if held_out else (F.lit(False), data)
        seen = every.agg(F.count_if(~held).alias("fitted"), F.count_if(held).alias("held")).first()
        if seen.fitted > (0 if compact else ROWS_PER_TASK) and boosting.fits(seen.fitted + seen.held, len(features)):
            data = boosting.binned(every, features, label, held, seen.fitted, params.seed)
            return PipelineModel([assembler, boosting.grown(data, kind, params, _estimator(kind, params, label))])
    fitting = data.where(~F.col(HELD_OUT)) if held_out else data
    # Not a shuffle: the rows of a task stay in the order stored, on which samples and subsets depend.
    fitting = fitting.coalesce(tasks or fit_tasks(fitting))
    if not held_out:
        return Pipeline(stages=[assembler, _estimator(kind, params, label)]).fit(fitting)
    held = assembler.transform(data.where(HELD_OUT))
    if not held.take(1):
        return Pipeline(stages=[assembler, _estimator(kind, params, label)]).fit(fitting)
    # A fit of fewer rounds grows the same first trees, so the rounds tried double until patience acts: the
    # trees grown are fewer than four times those that had to be looked at.
    rounds = min(params.rounds, max(FIRST_ROUNDS, params.patience + 1))
    while True:
        if grown is not None and grown.stages[-1].getNumTrees >= rounds:
            fitted = truncated(grown, rounds)
        else:
            fitted = Pipeline(stages=[assembler, _estimator(kind, replace(params, rounds=rounds), label)]).fit(fitting)
        losses = round_losses(fitted, held)
        kept = kept_rounds(losses, params.patience)
        if rounds == params.rounds or kept + params.patience <= len(losses):
            return truncated(fitted, kept)
        rounds = min(params.rounds, 2 * rounds)


def round_losses(model: PipelineModel, held: DataFrame) -> list[float]:
    """The loss after each round on rows with assembled features."""
    trees = model.stages[-1]
    if isinstance(trees, GBTClassificationModel):
        return trees.evaluateEachIteration(held)
    return trees.evaluateEachIteration(held, "absolute")


def truncated(model: PipelineModel, rounds: int) -> PipelineModel:
    """The same model with its first ``rounds`` trees alone; nothing is fitted again."""
    trees = model.stages[-1]
    if rounds >= trees.getNumTrees:
        return model
    context = SparkContext._active_spark_context
    ml, grown, weights = context._jvm.org.apache.spark.ml, trees._java_obj.trees(), trees.treeWeights
    first = context._gateway.new_array(ml.regression.DecisionTreeRegressionModel, rounds)
    rates = context._gateway.new_array(context._jvm.double, rounds)
    for i in range(rounds):
        first[i], rates[i] = grown[i], weights[i]
    if isinstance(trees, GBTClassificationModel):
        cut = GBTClassificationModel(ml.classification.GBTClassificationModel(trees.uid, first, rates, trees.numFeatures, 2))
    else:
        cut = GBTRegressionModel(ml.regression.GBTRegressionModel(trees.uid, first, rates, trees.numFeatures))
    return PipelineModel([*model.stages[:-1], cut])


def train_classifier(rows, features=HOME_WIN_FEATURES, label=LABEL, params=TreeParams(), held_out=None, compact=False):
    """Boosted trees with the logistic loss, the same loss in search and final fit."""
    return fit_trees(rows, features, label, params, "classifier", held_out, compact=compact)


def train_regressor(rows, features, label, params=TreeParams(), held_out=None):
    """Boosted trees with the absolute loss."""
    return fit_trees(rows, features, label, params, "regressor", held_out)


def score(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Rows with ``model_prediction``: probability of a home win, or the predicted number.

    A row that lacks a feature stays, with a NULL prediction.
    """
    complete = F.lit(True)
    for name in model.stages[0].getInputCols():
        complete = complete & F.col(name).isNotNull() & ~F.isnan(F.col(name).cast("double"))
    scored = model.transform(rows)
    if "probability" in scored.columns:
        scored = scored.withColumn(PREDICTION, vector_to_array("probability")[1])
    else:
        scored = scored.withColumn(PREDICTION, F.col("prediction"))
    return scored.select(*rows.columns, F.when(complete, F.col(PREDICTION)).alias(PREDICTION))


def score_splits(model: PipelineModel, split_rows: DataFrame) -> DataFrame:
    """Train, validation and test rows with predictions; copies of a row count once, rows that can't be scored not at all.

    Copies have the same score, so they go before. Only a hash of each row is shuffled to find them; rows whose
    hash comes once have no copy and stay where they are, the others are compared whole.
    """
    rows = split_rows.where(F.col("dataset").isNotNull())
    hashed = rows.withColumn("_hash", F.xxhash64(*rows.columns))
    several = kept(hashed.groupBy("_hash").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_hash"), "copies")
    if not several.isEmpty():
        copies = hashed.join(several, "_hash", "left_semi").select(rows.columns).dropDuplicates()
        rows = hashed.join(several, "_hash", "left_anti").select(rows.columns).unionByName(copies)
    return score(model, rows).where(F.col(PREDICTION).isNotNull())


def score_games(model: PipelineModel, games: DataFrame) -> DataFrame:
    return score(model, games).withColumns({
        "rounded": scalars.round1(PREDICTION), "pred_home_win": scalars.threshold_flag(PREDICTION),
    })


def draw_params(trials: int, ranges: dict = BINARY_RANGES, seed: int = SEED, base: TreeParams = TreeParams()) -> list[TreeParams]:
    """Seeded random draws; a rate range that starts above zero is drawn on a log scale."""
    draw = np.random.default_rng(seed)
    low, high = ranges["step"]
    out = []
    for _ in range(trials):
        step = np.exp(draw.uniform(np.log(low), np.log(high))) if low > 0 else high - draw.uniform(low, high)
        out.append(replace(
            base,
            step=float(step),
            depth=int(draw.integers(ranges["depth"][0], ranges["depth"][1], endpoint=True)),
            rows=float(draw.uniform(*ranges["rows"])),
            columns=float(draw.uniform(*ranges["columns"])),
        ))
    return out


def hyperparam_search(
    split_rows: DataFrame,
    features: Sequence[str],
    label: str,
    kind: str = "classifier",
    metric: str | None = None,
    trials: int = 100,
    seed: int = SEED,
    base: TreeParams = TreeParams(rounds=MOST_ROUNDS),
    parallelism: int = 2,
    first_rounds: int | None = None,
    keep: int = 4,
) -> Search:
    """Draws are fitted on the train season(s) and compared on the validation season, each at its least loss.

    Every draw runs with patience, for at most ``base.rounds`` rounds. Where tasks can hold the rows in codes, each
    core grows a share of the draws; else a draw is a fit of distributed jobs, a few at a time, which share the cores.

    With ``first_rounds`` the search is one of successive halving: all draws get as many rounds; the best in ``keep``
    go on with ``keep`` times the rounds, until one is left or a step would take more than ``FIRST_ROUNDS``, and only
    those left run to their least loss. A draw's first trees are the same in every step, so what a step has seen stays
    true, and those left go on with the rounds of the last step as they were fitted there. The rows are stored once.
    """
    metric = metric or ("log_loss" if kind == "classifier" else "mae")
    ranges = BINARY_RANGES if kind == "classifier" else REGRESSION_RANGES
    path = new_folder(split_rows.sparkSession, "search")
    split_rows.where("dataset in ('train', 'validation')").select(*features, label, "dataset").write.parquet(path)
    rows = split_rows.sparkSession.read.parquet(path)
    validation = rows.where("dataset = 'validation'")
    draws = draw_params(trials, ranges, seed, base)
    if first_rounds is None:
        complete, held = _complete(rows, features, label), F.col("dataset") == "validation"
        seen = complete.agg(F.count_if(~held).alias("fitted"), F.count_if(held).alias("held")).first()
        if seen.fitted and seen.held and boosting.fits(seen.fitted + seen.held, len(features), each=True):
            data = boosting.binned(complete, features, label, held, seen.fitted, seed)
            ended = boosting.finished(data, draws, kind, rows.sparkSession.sparkContext.defaultParallelism)
            losses = ended.groupBy("trial").agg(F.first("rounds").alias("rounds"), METRICS[metric]("label", "prediction").alias("m"))
            found = {r.trial: (replace(draws[r.trial], rounds=r.rounds), r.m) for r in losses.collect()}
            return Search(metric, [found[i] for i in range(trials)], list(range(trials)))
    tasks = fit_tasks(_complete(rows.where("dataset = 'train'"), features, label), parallelism)
    if tasks == 1:
        # Samples go by the order of the rows, and that of stored files is by chance.
        rows = rows.coalesce(1).sortWithinPartitions(*features, label)

    def measured(fitted: PipelineModel, params: TreeParams) -> tuple[TreeParams, float]:
        held = score(fitted, validation).where(F.col(PREDICTION).isNotNull())
        loss = held.agg(METRICS[metric](label, PREDICTION).alias("m")).first().m
        return replace(params, rounds=fitted.stages[-1].getNumTrees), loss

    def step(trial: int, rounds: int) -> tuple[TreeParams, float]:
        params = replace(draws[trial], rounds=rounds)
        grown[trial] = fit_trees(rows.where("dataset = 'train'"), features, label, params, kind, tasks=tasks)
        return measured(grown[trial], params)

    def finish(trial: int) -> tuple[TreeParams, float]:
        params = draws[trial]
        return measured(fit_trees(rows, features, label, params, kind, "dataset = 'validation'", tasks, grown.get(trial)), params)

    def loss_of(trial: int) -> float:
        loss = done[trial][1]
        return float("inf") if loss is None or loss != loss else loss

    done: dict[int, tuple[TreeParams, float]] = {}
    grown: dict[int, PipelineModel] = {}
    alive, rounds = list(range(trials)), first_rounds
    with ThreadPoolExecutor(parallelism) as pool:
        while rounds and len(alive) > 1 and rounds <= min(base.rounds, FIRST_ROUNDS):
            done.update(zip(alive, pool.map(step, alive, [rounds] * len(alive)), strict=True))
            alive = sorted(alive, key=lambda i: (loss_of(i), i))[: -(-len(alive) // keep)]
            grown = {i: grown[i] for i in alive}
            rounds *= keep
        done.update(zip(alive, pool.map(finish, alive), strict=True))
    search = Search(metric, [done[i] for i in range(trials)])
    search.finished = sorted(alive)
    return search


def trials_table(search: Search, like: DataFrame) -> DataFrame:
    rows = [
        (i, p.depth, p.step, p.rows, p.columns, p.rounds, i in search.finished, float(m)) for i, (p, m) in enumerate(search.trials)
    ]
    schema = (
        "trial int, max_depth int, step_size double, row_rate double, column_rate double, rounds int, finished boolean, "
        f"{search.metric} double"
    )
    return like.sparkSession.createDataFrame(rows, schema)


def _with_shifted(rows: DataFrame, features: Sequence[str], seed: int, repeats: int = 1) -> DataFrame:
    """Each row's features as ``_own`` and, as ``_other``, those of another row, anew in every ``_repeat``.

    Rows fall into random buckets of bounded size by a seeded hash; inside a bucket, in hash
    order, every row takes the next row's features and the last takes the first's. That is a
    permutation of the table without a global sort.
    """
    buckets = max(1, -(-rows.count() // ROWS_PER_BUCKET))
    drawn = rows.withColumn("_repeat", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    drawn = drawn.withColumn("_draw", F.xxhash64(F.col("_repeat") + seed, *rows.columns))
    drawn = drawn.withColumn("_bucket", F.pmod(F.xxhash64("_draw"), F.lit(buckets)))
    ring = W.partitionBy("_repeat", "_bucket").orderBy("_draw")
    own = F.array(*[F.col(f).cast("double") for f in features])
    first = F.first("_own").over(ring.rowsBetween(W.unboundedPreceding, 0))
    return drawn.withColumn("_own", own).withColumn("_other", F.coalesce(F.lead("_own").over(ring), first))


def feature_importance(
    model: PipelineModel, rows: DataFrame, features: Sequence[str], label: str, seed: int = SEED, repeats: int = 5
) -> DataFrame:
    """Split importance from the trees, and the rise of the log loss when a feature is shuffled, with its standard error.

    One plan covers all features and repeats: a row is scored as it is and once per feature with that feature taken
    from another row, and one aggregation gives the loss of each variant of each repeat. The rise is the mean over
    the repeats, the error the standard deviation of that mean (NULL for one repeat).
    """
    rows = rows.na.drop(subset=[*features, label])
    names = F.array(*[F.lit(f) for f in features])
    variants = _with_shifted(rows, features, seed, repeats).select(
        label, "_own", "_other", "_repeat", F.explode(F.sequence(F.lit(0), F.lit(len(features)))).alias("_variant")
    )
    # The rows as they are need one repeat.
    variants = variants.where("_variant > 0 or _repeat = 0")
    mixed = F.transform(
        "_own", lambda own, i: F.when(i == F.col("_variant") - 1, F.get("_other", i)).otherwise(own)
    )
    trees = model.stages[-1]
    scored = trees.transform(variants.select(label, "_variant", "_repeat", array_to_vector(mixed).alias("features")))
    loss = METRICS["log_loss"](label, PREDICTION).alias("_loss")
    losses = scored.withColumn(PREDICTION, vector_to_array("probability")[1]).groupBy("_variant", "_repeat").agg(loss)
    # One row per feature and repeat plus the base row.
    base = F.max(F.when(F.col("_variant") == 0, F.col("_loss"))).over(W.partitionBy(F.lit(0)))
    split = F.array(*[F.lit(float(v)) for v in trees.featureImportances.toArray()])
    rises = losses.withColumn("_rise", F.col("_loss") - base).where("_variant > 0").groupBy("_variant").agg(
        F.avg("_rise").alias("_mean"), (F.stddev_samp("_rise") / F.sqrt(F.count(F.lit(1)))).alias("_error")
    )
    return rises.select(
        F.get(names, F.col("_variant") - 1).alias("feature"),
        F.get(split, F.col("_variant") - 1).alias("split_importance"),
        F.col("_mean").alias("log_loss_increase"),
        F.col("_error").alias("log_loss_increase_error"),
    )


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
