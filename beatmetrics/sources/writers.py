"""CSV and text sinks: a directory of part files each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.csv(path, header=True, mode=mode, escape='"')


def pair_lines(df: DataFrame, key: str, value: str) -> DataFrame:
    """Lines like ``('NIGHT', 42)``."""
    return df.select(
        F.concat(F.lit("('"), F.col(key), F.lit("', "), F.col(value).cast("string"), F.lit(")"))
        .alias("value")
    )


def write_pairs_text(df: DataFrame, path: str, key: str, value: str) -> None:
    """Writes pairs as text lines; an existing path is an error."""
    pair_lines(df, key, value).write.mode("errorifexists").text(path)


def write_csv_observed(
    df: DataFrame, path: str, rejected: dict[str, Column] | None = None, mode: str = "overwrite"
) -> list[tuple[str, int, int]]:
    """Writes the CSV and returns (column, rows, nulls) of what was written, from the same job.

    ``rejected`` names further counts: of the rows on which a condition holds,
    as dates that could not be read.  They are returned under their names.  An
    empty frame has zeros.
    """
    counts = {f"n{i}": F.count(F.col(f"`{c}`")) for i, c in enumerate(df.columns)}
    rejected = rejected or {}
    more = {f"r{i}": F.count(F.when(c, 1)) for i, c in enumerate(rejected.values())}
    seen = Observation()
    measures = {"rows": F.count(F.lit(1)), **counts, **more}
    observed = df.observe(seen, *[c.alias(k) for k, c in measures.items()])
    write_csv(observed.select(*[f"`{c}`" for c in df.columns]), path, mode)
    found = seen.get
    rows = found["rows"]
    lines = [(c, rows, rows - found[f"n{i}"]) for i, c in enumerate(df.columns)]
    return lines + [(name, rows, found[f"r{i}"]) for i, name in enumerate(rejected)]
