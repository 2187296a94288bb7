"""How many parts rows are dealt into where a task holds its part in memory.

Adaptive execution joins shuffle partitions until they hold 64 MB, which it counts as compressed: of narrow rows with
sorted keys that is millions of rows, and a sort or hash table of them takes ten times as much. Counts given here are
left as they are, so a task's memory stays the same however many rows there are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

#: Rows of a part.
ROWS = 500_000


def parts_of(*tables: DataFrame) -> int:
    """Parts for the largest of the tables, each of which is counted (files by their footers alone)."""
    return max(1, *[-(-t.count() // ROWS) for t in tables])
