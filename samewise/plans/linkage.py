"""The linkage pipeline over DataFrames, with two plug-in points."""

from __future__ import annotations

from abc import ABC, abstractmethod
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from samewise.operators import blocking, features, training
from samewise.operators.submission import write_submission

S1, CAND = "source1_entity_id", "candidate_entity_id"


class CandidateGenerator(ABC):
    @abstractmethod
    def generate_candidates(self, source1: DataFrame, others: DataFrame) -> DataFrame:
        """source1_entity_id, candidate_entity_id."""


class MatchModel(ABC):
    @abstractmethod
    def predict_matches(self, pairs: DataFrame, source1: DataFrame, others: DataFrame) -> DataFrame:
        """The pairs that match."""


@dataclass
class BlockingCandidates(CandidateGenerator):
    max_block_size: int | None = None

    def generate_candidates(self, source1: DataFrame, others: DataFrame) -> DataFrame:
        return blocking.candidate_pairs(source1, others, max_block_size=self.max_block_size)


@dataclass
class ClassifierMatches(MatchModel):
    """Features, a fitted model and an inclusive threshold."""

    model: object
    vocabularies: dict[str, DataFrame]
    threshold: float = 0.5

    def predict_matches(self, pairs: DataFrame, source1: DataFrame, others: DataFrame) -> DataFrame:
        scored = training.score(self.model, features.pair_features(pairs, source1, others, self.vocabularies))
        return scored.filter(F.col("score") >= self.threshold).select(S1, CAND)


def chosen_threshold(flag: float | None, saved: dict | None) -> float:
    """The flag, else the saved threshold, else 0.5."""
    return flag if flag is not None else (saved or {}).get("threshold", 0.5)


def lists(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy(S1).agg(F.array_sort(F.collect_set(CAND)).alias("ids"))


def run_pipeline(source1: DataFrame, others: DataFrame, ordered: DataFrame, generator: CandidateGenerator, model: MatchModel, folder: str) -> None:
    """Generate, predict and write both list files; ``ordered`` holds pos and the source ids."""
    pairs = generator.generate_candidates(source1, others)
    write_submission(ordered, lists(model.predict_matches(pairs, source1, others)), folder, lists(pairs))
