"""Names of the columns that play a part in a labelled panel."""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class ColumnRoles:
    """Column names of a panel: one row per entity and time point.

    ``row_id`` is a unique key of the rows.  It replaces the implicit row index
    of an in-memory frame: predictions are attached by it and it breaks ties.
    """

    entity: str = "entity"
    time: str = "hour"
    label: str = "label"
    row_id: str = "row_id"
    score: str = "p"
    prediction: str = "yhat"
    features: tuple[str, ...] = ()

    def with_features(self, *features: str) -> "ColumnRoles":
        return replace(self, features=tuple(features))
