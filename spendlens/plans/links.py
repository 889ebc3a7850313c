"""Left joins that a report may leave out.

A left join to a side that has at most one row a key changes nothing but the columns it
brings. If no field reads them and no later join needs them, it is not planned. Uniqueness
is known by construction (newest version per id) or declared (``ReportSpec.unique_ids``)
and then checked on the rows that would have been joined.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..operators.history import assert_unique
from .lineage import is_read


@dataclass(frozen=True)
class Link:
    """``... <how> JOIN dim ON left = right`` bringing ``take`` (output name -> column)."""

    dim: DataFrame
    on: Sequence[tuple[str, str]]
    take: Mapping[str, str]
    how: str = "left"
    #: at most one row of ``dim`` a key, by construction
    unique: bool = False
    #: name of a dimension declared unique, which is checked before the join is left out
    declared: str = ""

    def joined(self) -> tuple:
        return self.dim, self.on, self.take, self.how

    def may_go(self) -> bool:
        """Whether the join keeps the rows as they are (a declared dimension is checked now)."""
        if self.how != "left" or not (self.unique or self.declared):
            return False
        if not self.unique:
            assert_unique(self.dim.where(" AND ".join(f"`{r}` IS NOT NULL" for _, r in self.on)), [r for _, r in self.on], self.declared)
        return True


def needed_links(links: Sequence[Link], read: frozenset[str] | None) -> list[Link]:
    """The links that bring a column that is read or joined on, or that may change the rows."""
    kept: list[Link] = []
    for link in reversed(links):
        used = {left for other in kept for left, _ in other.on}
        if any(is_read(c, read) or c in used for c in link.take) or not link.may_go():
            kept.insert(0, link)
    return kept
