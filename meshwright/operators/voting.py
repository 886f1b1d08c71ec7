"""Ensemble votes over fused mappings."""

from __future__ import annotations

from dataclasses import dataclass, field
from enum import Enum

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meshwright.operators.fusion import weight_of


class Strategy(str, Enum):
    MAJORITY = "majority"
    UNANIMOUS = "unanimous"
    WEIGHTED = "weighted"
    CONFIDENCE_WEIGHTED = "confidence_weighted"
    THRESHOLD = "threshold"


@dataclass(frozen=True)
class VotingConfig:
    strategy: Strategy | str = Strategy.MAJORITY
    min_support_count: int = 2
    min_support_ratio: float = 0.5
    min_confidence: float = 0.0
    weights: dict[str, float] | None = None


@dataclass(frozen=True)
class VotingResult:
    accepted: DataFrame
    rejected: DataFrame
    strategy: Strategy
    options: dict = field(default_factory=dict)


def predicate(config: VotingConfig, total: int) -> Column:
    """The condition under which a mapping is accepted."""
    try:
        strategy = Strategy(config.strategy)
    except ValueError:
        raise ValueError(f"unknown voting strategy: {config.strategy}") from None
    support = F.col("support_count")
    if strategy is Strategy.MAJORITY:
        return support >= total / 2 + 0.5
    if strategy is Strategy.UNANIMOUS:
        return support == total
    if strategy is Strategy.THRESHOLD:
        return support >= max(config.min_support_count, int(config.min_support_ratio * total))
    # without weights every matcher counts alike
    weight = (lambda m: weight_of(m, config.weights)) if config.weights else (lambda m: F.lit(1.0 / max(1, total)))
    vote = weight if strategy is Strategy.WEIGHTED else (lambda m: weight(m) * F.coalesce(F.col("confidences")[m], F.lit(0.0)))
    return F.aggregate("supporting_matchers", F.lit(0.0), lambda acc, m: acc + vote(m)) >= config.min_support_ratio


def decide(fused: DataFrame, config: VotingConfig, total: int) -> DataFrame:
    """``fused`` with a column ``accepted``; rows below ``min_confidence`` are in neither part."""
    rows = fused.where(F.col("consensus_confidence") >= config.min_confidence) if config.min_confidence > 0 else fused
    return rows.withColumn("accepted", F.coalesce(predicate(config, total), F.lit(False)))


def vote(fused: DataFrame, config: VotingConfig | None = None, total: int = 3) -> VotingResult:
    config = config or VotingConfig()
    rows = decide(fused, config, total)
    return VotingResult(rows.where("accepted").drop("accepted"), rows.where("not accepted").drop("accepted"), Strategy(config.strategy))
