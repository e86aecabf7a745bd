"""A staged load into the warehouse: facts, lineage and rejects change together."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import warehouse
from ..session import written
from ..sources.snapshots import Snapshots

FACTS, LINEAGE, REJECTS = "f_tickets", "map_id_origen", "rechazos"
LINEAGE_SCHEMA = "id_ticket long, origen string, id_origen string"


def current(snapshots: Snapshots, version: int | None = None) -> dict[str, DataFrame]:
    """Facts, lineage and rejects of a version; empty tables before the first load."""
    spark = snapshots.spark
    return {
        FACTS: spark.createDataFrame([], warehouse.FACT_SCHEMA), LINEAGE: spark.createDataFrame([], LINEAGE_SCHEMA),
        **snapshots.read(version),
    }


def load(
    spark: SparkSession, root: str, staging: DataFrame, name: str | None = None, origin: str = "manual"
) -> int:
    """Replace the staged tickets and their lineage in the warehouse below ``root``; the new version.

    Lineage is made from the facts as they were written, so its numbers are theirs. Nothing is seen of
    the load before its manifest stands; a load that fails, or a driver that dies, leaves the version
    before. A ``name`` that was loaded already is not loaded again.
    """
    snapshots = Snapshots(spark, root)
    base = snapshots.version()
    before = current(snapshots, base)
    resolved = written(warehouse.resolve_dimensions(warehouse.clean_staging(staging)))
    promoted = warehouse.promote(resolved)
    tables = {
        FACTS: warehouse.reload_facts(before[FACTS], resolved, promoted),
        LINEAGE: lambda fresh: warehouse.reload_lineage(
            before[LINEAGE], before[FACTS], resolved, fresh[FACTS], origin
        ),
        REJECTS: warehouse.promotion_rejects(resolved).unionByName(warehouse.repeated_codes(promoted)),
    }
    return snapshots.publish(tables, base, name)


def orphans(tables: dict[str, DataFrame]) -> DataFrame:
    """Lineage without its fact: none in any version."""
    return tables[LINEAGE].join(tables[FACTS].select(F.col("id_ticket")), "id_ticket", "left_anti")
