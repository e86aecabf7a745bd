"""Source files to the unified, classified and repaired data set with its reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import catalogs as C
from ..operators.normalize import normalize_source, rule_impact
from ..operators.repair import repair_audit, repair_closing_dates
from ..sources import sinks
from ..sources.files import Dialect, read_numbered


def unify(
    spark: SparkSession, sources: dict[str, str], as_of=None,
    dialects: dict[str, Dialect] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """All sources (name -> path) as one repaired table with impact flags and changes, and
    (fuente, refused): rows left out of each source. Known dialects need no probe."""
    parts, refused = [], []
    for name, path in sources.items():
        rows, left_out = read_numbered(spark, path, "_position", (dialects or {}).get(name))
        parts.append(normalize_source(rows, name))
        refused.append(left_out.select(F.lit(name).alias("fuente"), "refused"))
    unified = repair_closing_dates(reduce(DataFrame.unionByName, parts), as_of)
    return unified, reduce(DataFrame.unionByName, refused)


def run(
    spark: SparkSession, sources: dict[str, str], out: str, as_of=None,
    dialects: dict[str, Dialect] | None = None,
) -> None:
    """Write tickets, one folder per channel, audit log and run report below ``out``.

    The sources are read and classified once, into a table; every output derives from it.
    """
    work = f"{out}/unified"
    unified, refused = unify(spark, sources, as_of, dialects)
    unified.write.mode("overwrite").parquet(work)
    unified = spark.read.parquet(work)
    tickets = unified.select(*C.TICKET_COLUMNS)
    sinks.write_tickets(tickets, f"{out}/tickets")
    sinks.write_by_channel(tickets, f"{out}/by_channel")
    sinks.write_table(repair_audit(unified), f"{out}/repair_audit")
    report = sinks.run_report(tickets, rule_impact(unified)).unionByName(
        refused.select(
            F.lit("filas_descartadas").alias("metrica"), F.col("fuente").alias("clave"),
            F.col("refused").alias("valor"),
        )
    )
    sinks.write_report(report, f"{out}/report")
