"""Upsert / insert-if-absent of keyed tables, as one full outer join on the key.

* ``update`` (ON CONFLICT DO UPDATE): incoming rows replace target rows with the same key,
  target rows without an incoming match are kept (never deletes).
* ``ignore`` (ON CONFLICT DO NOTHING): only keys absent from the target are inserted.

Each side is evaluated once and shuffled at most once on the key (record ids / customer ids,
uniform); a staged incoming side is already partitioned by it. Incoming rows must be unique per key
(staging guarantees it), as the reference database would reject the batch otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert(target: DataFrame, incoming: DataFrame, key: str | list[str],
           on_conflict: str = "update", newest_by: str | None = None) -> DataFrame:
    """With ``newest_by``, a column of both sides, an update only replaces rows that are not newer than it (a row
    without a date is never newer)."""
    if on_conflict not in ("update", "ignore"):
        raise ValueError(f"on_conflict must be 'update' or 'ignore', not {on_conflict!r}")
    keys = [key] if isinstance(key, str) else list(key)
    first, second = ("_new", "_old") if on_conflict == "update" else ("_old", "_new")
    whole = F.struct(*(F.col(f"`{c}`") for c in target.columns))
    both = target.select(*keys, whole.alias("_old")).join(incoming.select(*keys, whole.alias("_new")), keys, "full")
    wins = F.col(first).isNotNull()
    if newest_by and on_conflict == "update":
        newer = F.col(f"_old.`{newest_by}`") > F.col(f"_new.`{newest_by}`")
        wins = wins & ~F.coalesce(newer, F.lit(False))
    row = F.when(wins, F.col(first)).otherwise(F.col(second))
    return both.select(row.alias("_row")).select("_row.*")
