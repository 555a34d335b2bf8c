"""Tables laid out for their readers: clustered for lookups of a key, bucketed for joins without an exchange."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from tapeworks.sources.scratch import folder

#: Bytes of a row group, and rows of a page, which is what a lookup reads at least.
GROUP_BYTES, PAGE_ROWS = 16 << 20, 5000
BUCKETS = 32


def write_clustered(
    df: DataFrame, path: str, by: list[str], bloom: dict[str, int] | None = None, partition_by: tuple[str, ...] = (), group_bytes: int = GROUP_BYTES, files: int | None = None
) -> None:
    """Replace the table at ``path``: rows in ranges of ``by``, sorted in files, so that statistics of row groups and pages tell which hold a key.

    ``bloom``: columns that the order doesn't help with (a contract, an id), and how many values of each a row group has at most; a
    lookup then skips the row groups whose filter lacks the value. Equal leading values may take several files.
    """
    order = [*partition_by, *by]
    spread = df.repartitionByRange(files, *order) if files else df.repartitionByRange(*order)
    w = spread.sortWithinPartitions(*order).write.mode("overwrite").option("compression", "zstd").option("parquet.block.size", group_bytes).option("parquet.page.row.count.limit", PAGE_ROWS)
    for column, values in (bloom or {}).items():
        w = w.option(f"parquet.bloom.filter.enabled#{column}", "true").option(f"parquet.bloom.filter.expected.ndv#{column}", values)
    w.partitionBy(*partition_by).parquet(path)


def bucketed(df: DataFrame, keys: list[str], buckets: int = BUCKETS, name: str | None = None) -> DataFrame:
    """``df`` as a stored table of one file a bucket, sorted by ``keys``; tables of the same keys and buckets join without an exchange or a sort.

    ``buckets`` should be in proportion to the larger table. A ``name`` makes it a lasting table of the catalog, else it gets one of its own in
    the shared folder.
    """
    name = name or f"bucketed_{uuid.uuid4().hex}"
    rows = df.repartition(buckets, *keys)
    rows.write.mode("overwrite").format("parquet").option("path", folder(df.sparkSession, name)).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    return df.sparkSession.table(name)
