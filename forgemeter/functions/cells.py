"""Row keys and string cells of the keyed result tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY_FORMAT = "%016d"  # fixed value: 16 digits, so text order is time order


def window_key(millis: Column) -> Column:
    """Sortable row key of a window start in epoch milliseconds."""
    return F.format_string(KEY_FORMAT, millis)


def window_key_literal(millis: int) -> str:
    return KEY_FORMAT % millis


def window_bounds(window: str = "window") -> list[Column]:
    """Both ends of a window struct as epoch milliseconds."""
    return [
        F.unix_millis(F.col(f"{window}.start")).alias("window_start"),
        F.unix_millis(F.col(f"{window}.end")).alias("window_end"),
    ]


def encode_cells(table: DataFrame, columns: Iterable[str]) -> DataFrame:
    """The named columns as text cells."""
    return table.withColumns({c: F.col(c).cast("string") for c in columns})


def decode_cells(
    table: DataFrame,
    *,
    numbers: Iterable[str] = (),
    texts: Iterable[str] = (),
    required_numbers: Iterable[str] = (),
) -> DataFrame:
    """Text cells back to typed columns: an absent number is 0, an absent text is empty.

    ``required_numbers`` have no default and stay null when absent.
    """
    columns = {
        c: F.coalesce(F.nullif(F.col(c), F.lit("")).cast("long"), F.lit(0).cast("long"))
        for c in numbers
    }
    columns |= {c: F.coalesce(F.col(c), F.lit("")) for c in texts}
    columns |= {c: F.col(c).cast("long") for c in required_numbers}
    return table.withColumns(columns)
