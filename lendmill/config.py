"""Policy and sampling settings. Every value is a default that callers may replace."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class RiskPolicy:
    """Thresholds, prices and error costs used by the decision operators."""

    low_risk: float = 0.3
    high_risk: float = 0.7
    base_rate: float = 0.08
    low_adjustment: float = 0.0
    moderate_adjustment: float = 0.05
    high_adjustment: float = 0.10
    false_positive_cost: float = 5000.0
    false_negative_cost: float = 20000.0


@dataclass(frozen=True)
class SplitSpec:
    test: float = 0.2
    validation: float = 0.1
    seed: int = 42


@dataclass(frozen=True)
class PrepSpec:
    """Settings of the preprocessing estimator."""

    outlier_std: float = 3.0
    min_variance: float = 0.01
    max_correlation: float = 0.95
    literal_classes: int = 400


def threshold_grid(start: float = 0.1, stop: float = 0.9, n: int = 50) -> list[float]:
    """Evenly spaced cut-offs; the last one is exactly ``stop``."""
    step = (stop - start) / (n - 1)
    return [start + i * step for i in range(n - 1)] + [stop]


@dataclass(frozen=True)
class LimeSpec:
    samples: int = 5000
    top: int = 10
    seed: int = 42
    kernel_factor: float = 0.75
    ridge: float = 1.0
    selection_ridge: float = 0.01
    selection: str = "weights"  # or "forward"


POLICY = RiskPolicy()
SPLIT = SplitSpec()
PREP = PrepSpec()
LIME = LimeSpec()
