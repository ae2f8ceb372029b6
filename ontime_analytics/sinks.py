"""K1-K3: result writers.

One file per partition by default.  ``single_file=True`` is for results known
to be small (one row per year, airport, model ...; the catalogue marks them):
``coalesce(1)`` then narrows the final result only and never moves flight rows.
CSV and JSON go to separate directories.  JSON is JSON Lines in UTF-8 with
named fields; a NULL is written as ``null``, so every row has every field.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_csv(result: DataFrame, path: str, header: bool = False, mode: str = "overwrite",
              single_file: bool = False) -> None:
    """K1/K2: ``key,value[,value]`` lines, no header by default."""
    out = result.coalesce(1) if single_file else result
    out.write.mode(mode).option("header", header).csv(path)


def write_json(result: DataFrame, path: str, mode: str = "overwrite",
               single_file: bool = False) -> None:
    """K3: one JSON object per result row."""
    out = result.coalesce(1) if single_file else result
    out.write.mode(mode).option("encoding", "UTF-8").option("ignoreNullFields", "false").json(path)
