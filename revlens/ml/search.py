"""Cross-validation and hyper-parameter search; every score is a distributed fit and a SQL metric."""

from __future__ import annotations

import itertools
import math
import random
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.evaluation import Evaluator
from pyspark.sql import DataFrame, functions as F

from revlens.ml.evaluate import MacroF1Evaluator
from revlens.ml.stacking import in_parallel
from revlens.ml.vectorize import Tfidf, TfidfModel, counted_by_fold, param_map
from revlens.operators.split import folds
from revlens.session import drop_staged, staged


SLICED_TERMS = 1 << 16  # of all folds' vocabularies; beyond it every fold's features are made from the text


@dataclass(frozen=True)
class Uniform:
    low: float
    high: float


@dataclass(frozen=True)
class LogUniform:
    low: float
    high: float


@dataclass(frozen=True)
class Whole:
    """Whole numbers low..high, both included."""

    low: int
    high: int


def grid(space: dict[str, list]) -> list[dict]:
    """All combinations of the listed values."""
    return [dict(zip(space, values)) for values in itertools.product(*space.values())]


def _draw(choice, rng: random.Random):
    if isinstance(choice, Uniform):
        return rng.uniform(choice.low, choice.high)
    if isinstance(choice, LogUniform):
        return math.exp(rng.uniform(math.log(choice.low), math.log(choice.high)))
    if isinstance(choice, Whole):
        return rng.randint(choice.low, choice.high)
    return rng.choice(choice)


def draws(space: dict, n: int, seed: int = 42) -> list[dict]:
    """n seeded random settings from lists and ranges."""
    rng = random.Random(seed)
    return [{name: _draw(choice, rng) for name, choice in space.items()} for _ in range(n)]


def narrowed(space: dict, best: dict, factor: float = 0.5) -> dict:
    """Ranges shrunk to `factor` of their width around the best value, inside the old ranges.

    Lists keep the best value and its neighbours.
    """
    out = {}
    for name, choice in space.items():
        at = best[name]
        if isinstance(choice, LogUniform):
            half = factor * (math.log(choice.high) - math.log(choice.low)) / 2
            out[name] = LogUniform(max(choice.low, at * math.exp(-half)), min(choice.high, at * math.exp(half)))
        elif isinstance(choice, Uniform):
            half = factor * (choice.high - choice.low) / 2
            out[name] = Uniform(max(choice.low, at - half), min(choice.high, at + half))
        elif isinstance(choice, Whole):
            half = max(1, round(factor * (choice.high - choice.low) / 2))
            out[name] = Whole(max(choice.low, at - half), min(choice.high, at + half))
        else:
            i = list(choice).index(at)
            out[name] = list(choice)[max(0, i - 1):i + 2]
    return out


@dataclass
class Trial:
    number: int
    settings: dict
    fold_scores: list[float]

    @property
    def score(self) -> float:
        return sum(self.fold_scores) / len(self.fold_scores)


def with_folds(df: DataFrame, row_id: str, k: int, label: str = "label", seed: int = 42) -> DataFrame:
    """The table with stratified fold numbers, written once, a partition a fold, for all fits that read it.

    Numbering reads the id and label of `df` once more; a fit without fold i opens the files of the others only.
    """
    return staged(folds(df, row_id, k, label, seed), "cv-folds", by="fold")


class FoldFeatures:
    """The features of one setting for all folds, from two passes over the texts whatever the number of folds.

    The first counts each fold's terms; a vocabulary without a fold is a sum over that table. The second writes the rows' counts of
    all folds' terms, from which a fold's features are sliced. The other stages are fitted for each fold.
    """

    def __init__(self, features: Pipeline, rows: DataFrame, k: int, fold: str):
        self.stages, self.source, self.rows, self.fold = features.getStages(), rows, rows, fold
        self.texts = {j: s for j, s in enumerate(self.stages) if isinstance(s, Tfidf)}
        self.models, self.terms = {}, {}
        sizes = {r[0]: r[1] for r in rows.groupBy(fold).count().collect()} if self.texts else {}
        for j, text in self.texts.items():
            counted = staged(counted_by_fold(rows, text.terms(), fold), "fold-terms")
            for i in range(k):
                n = sum(size for f, size in sizes.items() if f not in (None, i))
                self.models[j, i] = text.fit_counted(counted.where(F.col("_fold") != i), n)
            try:
                self.models[j, None] = text.fit_counted(counted, sum(sizes.values()))
            except ValueError:
                pass  # no term is left for all rows, which matters to a refit only
            drop_staged(counted)
        if self.texts and all(isinstance(m, TfidfModel) for m in self.models.values()):
            terms = {j: sorted({t for (at, _), m in self.models.items() if at == j for t in m.vocabulary_}) for j in self.texts}
            if all(len(t) <= SLICED_TERMS for t in terms.values()):
                self.terms, self.rows = terms, self._counted_rows(terms)

    def _counted_rows(self, terms: dict[int, list[str]]) -> DataFrame:
        out = self.source
        for j in self.texts:
            out = self.models[j, 0].term_vectors(out, f"_counts{j}", terms[j])
        others = [s for j, s in enumerate(self.stages) if j not in self.texts]
        read = {c for s in others if s.hasParam("inputCols") and s.isDefined("inputCols") for c in s.getInputCols()}
        read |= {s.getInputCol() for s in others if s.hasParam("inputCol") and s.isDefined("inputCol")}
        known = all(s.hasParam("inputCols") or s.hasParam("inputCol") for s in others)
        unread = {s.getInputCol() for s in self.texts.values()} - read if known else set()
        return staged(out.select(*[c for c in self.source.columns if c not in unread],
                                 *[F.col(f"_counts{j}").alias(f"_counts{j}", metadata={}) for j in self.texts]), "fold-counts", by=self.fold)

    def fit(self, i: int | None) -> tuple[PipelineModel, PipelineModel]:
        """Fitted without fold `i`, or on all rows: (the model for `rows`, the model for rows with texts)."""
        if any((j, i) not in self.models for j in self.texts):
            raise ValueError("no term is left: lower minDF or raise maxDF")
        texts = {j: self.models[j, i] for j in self.texts}
        inside = {j: m.on_counts(f"_counts{j}", self.terms[j]) if self.terms else m for j, m in texts.items()}
        stages = [inside.get(j, s) for j, s in enumerate(self.stages)]
        fitted = Pipeline(stages=stages).fit(self.rows if i is None else self.rows.where(F.col(self.fold) != i))
        return fitted, PipelineModel([texts.get(j, s) for j, s in enumerate(fitted.stages)])

    def drop(self) -> None:
        if self.terms:
            drop_staged(self.rows)


class Search:
    """Scores settings of an estimator by their mean over the folds of `rows`.

    `steps` names the parts that the settings address, as in `param_map`. `features`, a pipeline of
    some of these parts, comes before the estimator: it is fitted on each fold's training rows
    once for every distinct setting of its parts, its result is written, all settings of the
    estimator run on that table, and the table is deleted. The folds share their passes over the texts (`FoldFeatures`);
    the term counts behind the best setting are kept for later candidates of the same features and for `refit`.
    """

    def __init__(self, estimator: Estimator, steps: dict, rows: DataFrame, k: int,
                 evaluator: Evaluator | None = None, fold: str = "fold", parallelism: int = 2,
                 features: Pipeline | None = None):
        self.estimator, self.steps, self.rows, self.k = estimator, steps, rows, k
        self.evaluator = evaluator or MacroF1Evaluator()
        self.fold, self.parallelism, self.features = fold, parallelism, features
        self.trials: list[Trial] = []
        self._kept: tuple[tuple, FoldFeatures, float] | None = None

    def with_settings(self, settings: dict) -> Estimator:
        """The whole model, features included."""
        if self.features is None:
            return self.estimator.copy(param_map(self.steps, settings))
        whole = Pipeline(stages=[*self.features.getStages(), self.estimator])
        return whole.copy(param_map(self.steps, settings))

    def _score(self, settings: dict, rows: DataFrame, i: int) -> float:
        model = self.estimator.copy(param_map(self.steps, settings)).fit(rows.where(F.col(self.fold) != i))
        return self.evaluator.evaluate(model.transform(rows.where(F.col(self.fold) == i)))

    def _of_features(self, settings: dict) -> tuple:
        """The part of the settings that addresses the features, as a key."""
        parts = {n for n, s in self.steps.items() if self.features and any(s is f for f in self.features.getStages())}
        return tuple(sorted((n, str(v)) for n, v in settings.items() if n.partition("__")[0] in parts))

    def _shared(self, settings: dict) -> FoldFeatures:
        if self._kept and self._kept[0] == self._of_features(settings):
            return self._kept[1]
        return FoldFeatures(self.features.copy(param_map(self.steps, settings)), self.rows, self.k, self.fold)

    def _prepared(self, fitted: Model, rows: DataFrame) -> DataFrame:
        """The rows with fitted features, written."""
        added = [c for c in (self.estimator.inner.getFeaturesCol() if getattr(self.estimator, "inner", None) else "features",)]
        kept = [c for c in ("id", "label", self.fold) if c in rows.columns]
        return staged(fitted.transform(rows).select(*kept, *added), "cv-features", by=self.fold if self.fold in kept else None)

    def _keep(self, key: tuple, shared: FoldFeatures, score: float) -> None:
        """Keeps the counts of the best features so far, deletes the others."""
        if self._kept and self._kept[1] is shared:
            self._kept = key, shared, max(score, self._kept[2])
        elif self._kept is None or score > self._kept[2]:
            if self._kept:
                self._kept[1].drop()
            self._kept = key, shared, score
        else:
            shared.drop()

    def run(self, candidates: list[dict]) -> Search:
        found: dict[tuple[int, int], float] = {}
        groups: dict[tuple, list[int]] = {}
        for j, s in enumerate(candidates):
            groups.setdefault(self._of_features(s), []).append(j)
        if self.features is None:
            jobs = [(j, i, self.rows) for j in range(len(candidates)) for i in range(self.k)]
            found |= self._scored(candidates, jobs)
        else:
            for key, members in groups.items():
                shared = self._shared(candidates[members[0]])
                for i in range(self.k):
                    rows = self._prepared(shared.fit(i)[0], shared.rows)
                    found |= self._scored(candidates, [(j, i, rows) for j in members])
                    drop_staged(rows)
                self._keep(key, shared, max(sum(found[j, i] for i in range(self.k)) / self.k for j in members))
        for j, s in enumerate(candidates):
            self.trials.append(Trial(len(self.trials), s, [found[j, i] for i in range(self.k)]))
        return self

    def _scored(self, candidates: list[dict], jobs: list[tuple[int, int, DataFrame]]) -> dict[tuple[int, int], float]:
        calls: list[Callable] = [lambda j=j, i=i, r=r: self._score(candidates[j], r, i) for j, i, r in jobs]
        return {(j, i): s for (j, i, _), s in zip(jobs, in_parallel(calls, self.parallelism))}

    def grid(self, space: dict[str, list]) -> Search:
        return self.run(grid(space))

    def random(self, space: dict, n: int, seed: int = 42) -> Search:
        return self.run(draws(space, n, seed))

    def rounds(self, space: dict, rounds: int, per_round: int = 8, factor: float = 0.5, seed: int = 42) -> Search:
        """Rounds of random candidates; each round draws from ranges narrowed around the best."""
        for r in range(rounds):
            self.run(draws(space, per_round, seed + r))
            space = narrowed(space, self.best.settings, factor)
        return self

    @property
    def best(self) -> Trial:
        """Highest mean score; the earliest of equals."""
        return max(self.trials, key=lambda t: (t.score, -t.number))

    def table(self) -> DataFrame:
        """(trial, settings, fold_scores, score), best first."""
        rows = [(t.number, str(sorted(t.settings.items())), t.fold_scores, t.score) for t in self.trials]
        made = self.rows.sparkSession.createDataFrame(
            rows, "trial int, settings string, fold_scores array<double>, score double"
        )
        return made.orderBy(F.desc("score"), "trial")

    def refit(self, df: DataFrame | None = None) -> Model:
        """The best settings fitted on all rows, or on those of `df`."""
        settings = self.best.settings
        if self.features is None:
            return self.with_settings(settings).fit(self.rows if df is None else df)
        if df is None:
            shared = self._shared(settings)
            fitted, whole = shared.fit(None)
            rows = self._prepared(fitted, shared.rows)
            if not (self._kept and self._kept[1] is shared):
                shared.drop()
        else:
            whole = self.features.copy(param_map(self.steps, settings)).fit(df)
            rows = self._prepared(whole, df)
        model = self.estimator.copy(param_map(self.steps, settings)).fit(rows)
        drop_staged(rows)
        return PipelineModel([*whole.stages, model])


def cross_val_predict(estimator: Estimator, rows: DataFrame, k: int, fold: str = "fold",
                      parallelism: int = 2) -> DataFrame:
    """Every row predicted by the model that was not trained on it."""
    models = in_parallel([lambda i=i: estimator.fit(rows.where(F.col(fold) != i)) for i in range(k)], parallelism)
    out = None
    for i, model in enumerate(models):
        part = model.transform(rows.where(F.col(fold) == i))
        out = part if out is None else out.unionByName(part)
    return out
