"""Tables that a keyed aggregate keeps."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame


def _as_they_are(rows: DataFrame) -> DataFrame:
    return rows


@dataclass(frozen=True)
class KeyedTable:
    """Grouped rows and how they are shown.

    ``grouped`` has the keys, then plain aggregates whose value is all that the engine has to
    remember of a group (maxima, minima, counts, sums of whole numbers or doubles). On a stream
    the engine's state store then holds exactly its rows; ``finish`` turns them into the table.
    """

    grouped: DataFrame
    finish: Callable[[DataFrame], DataFrame] = _as_they_are

    def rows(self) -> DataFrame:
        """The table; on a stream in update mode, its rows that changed."""
        return self.finish(self.grouped)

    def then(self, step: Callable[[DataFrame], DataFrame]) -> KeyedTable:
        """The same kept rows, shown through one more step."""
        return KeyedTable(self.grouped, lambda rows: step(self.finish(rows)))
