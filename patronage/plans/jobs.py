"""Generate the extract files: the end-to-end job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from patronage.operators.population import population_standard
from patronage.params import Params
from patronage.plans import extracts
from patronage.session import ensure_checkpoint_dir
from patronage.sources.sinks import write_extract, write_file
from patronage.tables import Tables

# file name -> extract; the ones taking ``pop`` share the standard population
FILES = {
    "constituent": (extracts.constituent_extract, False),
    "activity": (extracts.activity_extract, True),
    "affiliation": (extracts.affiliation_extract, False),
    "degree": (extracts.degree_extract, True),
    "gift": (extracts.gift_extract, True),
    "giftsummary": (extracts.gift_summary_extract, True),
    "relative": (extracts.relative_extract, True),
}


def shared_population(spark: SparkSession, t: Tables, p: Params) -> DataFrame:
    """The standard population, computed once and checkpointed.

    A reliable checkpoint writes it to ``spark.checkpoint.dir`` (a shared
    folder on a cluster), so the five extracts reading it neither recompute
    the person x behavior join nor depend on executor-local cached blocks.
    """
    ensure_checkpoint_dir(spark)
    return population_standard(t, p).checkpoint(eager=True)


def write_extracts(spark: SparkSession, t: Tables, p: Params, out_dir: str, fmt: str = "csv",
                   files: list[str] | None = None, one_file: bool = False) -> dict[str, str]:
    """Write each extract to ``{out_dir}/{name}``, a folder of parts, or, if
    ``one_file``, to the single file ``{out_dir}/{name}.csv`` with one header;
    returns name -> path."""
    if one_file and fmt != "csv":
        raise ValueError("one file per extract is a csv file")
    names = list(FILES) if files is None else files
    unknown = set(names) - set(FILES)
    if unknown:
        raise ValueError(f"unknown extract files: {sorted(unknown)}")
    pop = shared_population(spark, t, p) if any(FILES[n][1] for n in names) else None
    written = {}
    for name in names:
        fn, uses_pop = FILES[name]
        df = fn(t, p, pop) if uses_pop else fn(t, p)
        path = f"{out_dir.rstrip('/')}/{name}"
        if one_file:
            path += ".csv"
            write_file(df, path)
        else:
            write_extract(df, path, fmt)
        written[name] = path
    return written
