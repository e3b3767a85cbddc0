"""What Parquet files hold, from their footers alone.

A footer lists for every row group the number of rows and the smallest and largest value per column. Tasks read
the footers of their share of the files; no data page is opened, so terabytes are surveyed by reading megabytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timezone

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridyield.sources.tables import scan_chosen

RANGES = "path string, row_group int, n_rows bigint, n_nulls bigint, least timestamp, most timestamp"


def footer_ranges(files: DataFrame, t: str = "t", path: str = "path") -> DataFrame:
    """Per row group: path, row_group, n_rows, n_nulls, and the least and most value of the time column ``t``.

    ``files`` has the paths of single files; repeated ones are read once. Values are NULL where a file keeps no statistics. Stores are those
    that pyarrow opens by URI (local, HDFS, S3, GCS, Azure).
    """
    schema = pa.schema([
        ("path", pa.string()), ("row_group", pa.int32()), ("n_rows", pa.int64()), ("n_nulls", pa.int64()),
        ("least", pa.timestamp("us", "UTC")), ("most", pa.timestamp("us", "UTC")),
    ])

    def instant(value):
        return value if value is None or value.tzinfo else value.replace(tzinfo=timezone.utc)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for name in batch.column(0).to_pylist():
                store, inner = pyarrow.fs.FileSystem.from_uri(name if "://" in name or name.startswith("file:") else f"file://{name}")
                with store.open_input_file(inner) as source:
                    meta = pq.ParquetFile(source).metadata
                column = next((k for k in range(meta.num_columns) if meta.schema.column(k).path == t), None)
                if column is None:
                    raise ValueError(f"{name} has no column {t}")
                for g in range(meta.num_row_groups):
                    stats = meta.row_group(g).column(column).statistics
                    known = stats is not None and stats.has_min_max
                    nulls = stats.null_count if stats is not None and stats.has_null_count else None
                    rows.append((name, g, meta.row_group(g).num_rows, nulls, instant(stats.min) if known else None, instant(stats.max) if known else None))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), schema.types)], schema=schema)

    return files.select(F.col(path).alias("path")).distinct().mapInArrow(read, RANGES)


def years_of_files(files: DataFrame, t: str = "t", path: str = "path") -> DataFrame:
    """(path, year) for every year in which a file has a time step.

    Row groups within one year are judged by their footers. Only the time column of files with other row groups (several years, or no
    statistics) is read.
    """
    ranges = footer_ranges(files, t, path)
    first, last = F.year("least"), F.year("most")
    clear = F.coalesce(first == last, F.lit(False)) | (F.col("n_rows") == F.coalesce("n_nulls", F.lit(-1)))
    sure = ranges.where(clear & first.isNotNull()).select("path", first.alias("year")).distinct()
    unsure = ranges.where(~clear).select("path").distinct()
    found = scan_chosen(unsure, ["path"], columns=[t])
    if found is None:
        return sure
    read = found.where(F.col(t).isNotNull()).select("path", F.year(t).alias("year")).distinct()
    return sure.unionByName(read).distinct()
