"""Datasets in the zones of a lake: ``<root>/<zone>/<container>/<dataset>``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

# The containers each zone declares.
ZONES = {
    "raw": ("data", "di001", "di002"),
    "encur": ("data", "di001", "di002"),
    "work": ("data", "dp001", "dp002"),
    "ext": ("data",),
}
MODES = ("overwrite", "ignore", "append")


def zone_path(root: str, zone: str, container: str, dataset: str) -> str:
    """The folder of a dataset; the zone must exist and must declare the container."""
    if zone not in ZONES:
        raise ValueError(f"unknown zone {zone!r}, expected one of {', '.join(ZONES)}")
    if container not in ZONES[zone]:
        raise ValueError(f"zone {zone!r} has no container {container!r}, only {', '.join(ZONES[zone])}")
    return f"{root.rstrip('/')}/{zone}/{container}/{dataset}"


def read_zone(
    spark: SparkSession, root: str, zone: str, container: str, dataset: str, fmt: str = "parquet", **options: str
) -> DataFrame:
    """Scan one dataset. Filters and column choices made later reach the file scan."""
    return spark.read.format(fmt).options(**options).load(zone_path(root, zone, container, dataset))


def write_zone(
    df: DataFrame,
    root: str,
    zone: str,
    container: str,
    dataset: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
) -> str:
    """Write one dataset and return its folder.

    ``overwrite`` replaces what is there (with ``partition_by``: only the partitions that occur in
    ``df``), ``ignore`` writes only when nothing is there, ``append`` adds. Before a partitioned
    write the rows are dealt by the partition columns, so that a partition gets files of about the
    size adaptive execution is told to aim for, a large one several of them.
    """
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}, expected one of {', '.join(MODES)}")
    path = zone_path(root, zone, container, dataset)
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.format(fmt).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    writer.save(path)
    return path
