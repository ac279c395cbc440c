"""Labels from numbers: threshold ladders, cut bins, score-box segments."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F


def ladder(steps: Sequence[tuple[Column, str]], otherwise: str | None = None) -> Column:
    """The label of the first condition that holds."""
    chain = None
    for condition, label in steps:
        chain = F.when(condition, label) if chain is None else chain.when(condition, label)
    return chain if otherwise is None else chain.otherwise(otherwise)


def cut(column: Column, edges: Sequence[float], labels: Sequence[str], include_lowest: bool = False) -> Column:
    """Right-closed bins (edges[i], edges[i+1]]; anything outside is NULL.

    The lowest edge itself falls outside unless `include_lowest`.
    """
    if len(edges) != len(labels) + 1:
        raise ValueError("cut needs one more edge than labels")
    steps = []
    for position, (low, high, label) in enumerate(zip(edges, edges[1:], labels)):
        above = column >= low if include_lowest and position == 0 else column > low
        steps.append((above if high == float("inf") else above & (column <= high), label))
    return ladder(steps)


@dataclass(frozen=True)
class ScoreBox:
    """A segment: inclusive score ranges that must all hold; a missing axis is unrestricted."""

    label: str
    ranges: Mapping[str, tuple[int, int]] = field(default_factory=dict)

    def holds(self, axes: Mapping[str, Column]) -> Column:
        inside = F.lit(True)
        for axis, (low, high) in self.ranges.items():
            inside = inside & axes[axis].between(low, high)
        return inside


# Segments by recency (r), frequency (f) and monetary (m) score 1-5, first match wins.
RFM_SEGMENTS = (
    ScoreBox("Champions", {"r": (4, 5), "f": (4, 5), "m": (4, 5)}),
    ScoreBox("Loyal Customers", {"r": (3, 5), "f": (3, 5), "m": (3, 5)}),
    ScoreBox("New Customers", {"r": (4, 5), "f": (1, 2)}),
    ScoreBox("Potential Loyalists", {"r": (3, 5), "f": (1, 5), "m": (2, 5)}),
    ScoreBox("At Risk", {"r": (1, 2), "f": (4, 5), "m": (4, 5)}),
    ScoreBox("Needs Attention", {"r": (1, 2), "f": (2, 5), "m": (2, 5)}),
    ScoreBox("Lost", {"r": (1, 1), "f": (1, 1)}),
)

# The dashboards' own segments; one fewer, so customers land differently.
DASHBOARD_SEGMENTS = (
    ScoreBox("Champions", {"r": (4, 5), "f": (4, 5), "m": (4, 5)}),
    ScoreBox("Loyal", {"r": (3, 5), "f": (3, 5), "m": (3, 5)}),
    ScoreBox("New", {"r": (4, 5), "f": (1, 2)}),
    ScoreBox("At Risk", {"r": (1, 2), "f": (4, 5), "m": (4, 5)}),
    ScoreBox("Needs Attention", {"r": (1, 2), "f": (2, 5), "m": (2, 5)}),
    ScoreBox("Lost", {"r": (1, 1), "f": (1, 1)}),
)
REMAINING_SEGMENT = "Hibernating"


def rfm_segment(r: Column, f: Column, m: Column, segments: Sequence[ScoreBox] = RFM_SEGMENTS) -> Column:
    axes = {"r": r, "f": f, "m": m}
    return ladder([(box.holds(axes), box.label) for box in segments], REMAINING_SEGMENT)
