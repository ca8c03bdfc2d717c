"""One training run: split, preparation and the learners over one feature table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property
from multiprocessing.pool import ThreadPool

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from tidemark.operators import models
from tidemark.session import cut_lineage

ID = "loyalty_number"


class Trainer:
    """The split and the training part are written once; every fit starts from the table.

    `balancing` is `weights` (class weights) or `synthetic` (rows between neighbours of the smaller class, made from
    the training part alone; the boosted model keeps the members as they are, with class weights, as published).
    `members` has every row of `features` with the id, the label, the training columns and `keep`, written once: models score it,
    so that no score makes the features again.
    """

    def __init__(
        self, features: DataFrame, settings: models.ModelSettings, seed: int = 42,
        test_share: float = 0.2, label: str = "churned", balancing: str = models.WEIGHTS,
        columns: Sequence[str] = models.PROGRAMME_FEATURES, keep: Sequence[str] = (),
    ):
        self.columns = list(columns)
        self.members = cut_lineage(features.select(*dict.fromkeys([ID, label, *self.columns, *keep])))
        table = models.training_table(self.members, label, self.columns)
        self.settings, self.balancing = settings, balancing
        self.fitted: dict[str, PipelineModel] = {}
        self.split = cut_lineage(models.stratified_split(table, "label", ID, test_share, seed))
        parts = models.split_parts(self.split)
        self.train = cut_lineage(models.with_class_weight(parts["train"], "label"))
        self.test = parts["test"]

    @cached_property
    def prepared(self) -> PipelineModel:
        return models.fit_preparation(self.train, self.columns)

    @cached_property
    def weighted(self) -> DataFrame:
        return models.gathered(models.learning_table(self.prepared, self.train, self.columns, self.settings))

    @cached_property
    def balanced(self) -> DataFrame:
        return models.gathered(
            models.learning_table(self.prepared, self.train, self.columns, self.settings, models.SYNTHETIC)
        )

    def balancing_of(self, name: str) -> str:
        return models.WEIGHTS if name == models.BOOSTED else self.balancing

    def table(self, name: str) -> DataFrame:
        """What the named learner is fitted on."""
        return self.balanced if self.balancing_of(name) == models.SYNTHETIC else self.weighted

    def learner(self, name: str):
        if name == models.LOGISTIC:
            return models.logistic(self.table(name).count(), self.settings)
        return models.forest(self.settings) if name == models.FOREST else models.boosted(self.settings)

    def fit(self, name: str) -> PipelineModel:
        return self.fit_all([name])[name]

    def fit_all(self, names: Sequence[str]) -> dict[str, PipelineModel]:
        """Each learner is fitted once. They are independent, so their jobs are submitted together."""
        missing = [name for name in names if name not in self.fitted]
        if missing:
            tasks = [(self.learner(name), self.prepared, self.table(name)) for name in missing]
            with ThreadPool(len(missing)) as pool:
                fits = pool.starmap(models.fit, tasks, chunksize=1)
            self.fitted.update(zip(missing, fits))
        return {name: self.fitted[name] for name in names}

    def scored_test(self, model: PipelineModel) -> DataFrame:
        scored = models.score(model, models.dealt(self.test), self.columns, "probability")
        return scored.select(ID, "label", "probability")

    def scored_members(self, model: PipelineModel) -> DataFrame:
        """`members` with `churn_probability`."""
        return models.score(model, models.dealt(self.members), self.columns)

    def cross_validate(self, name: str, folds: int = 5) -> tuple[float, float]:
        return models.cross_validate(
            self.learner(name), self.prepared, self.train, self.columns, self.settings, folds, self.balancing_of(name)
        )
