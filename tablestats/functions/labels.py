"""Text labels for statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Correlation strength cut points and wording.
CORR_HIGH = 0.7
CORR_MEDIUM = 0.3
CORR_LABELS = (
    "High positive correlation: Players and critics tend to agree",
    "Moderate positive correlation: There is some agreement",
    "Low correlation: Players and critics have different opinions",
)


def corr_label(c: Column | str, high: float = CORR_HIGH, medium: float = CORR_MEDIUM,
               labels: Sequence[str] = CORR_LABELS) -> Column:
    """high label if r > high, medium if r > medium, else low; null -> null."""
    r = F.col(c) if isinstance(c, str) else c
    return (F.when(r > high, F.lit(labels[0]))
            .when(r > medium, F.lit(labels[1]))
            .when(r.isNotNull(), F.lit(labels[2])))
