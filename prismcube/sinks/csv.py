"""CSV export."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..sources.csv import TIMESTAMPS

# Header, minimal quoting with doubled quotes, blanks kept, missing values as empty fields.
CSV_OPTIONS = {
    "header": "true",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "emptyValue": "",
    **TIMESTAMPS,
}


#: Rows of a compressed file, which one task has to read.
COMPRESSED_ROWS = 500_000


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", compression: str = "none") -> None:
    """Write ``df`` as a folder of CSV part files, in the order of its partitions.

    Compressed files (``"gzip"``) can't be cut by readers, so they are kept small.
    """
    limits = {} if compression == "none" else {"maxRecordsPerFile": str(COMPRESSED_ROWS)}
    df.write.mode(mode).options(**CSV_OPTIONS, **limits, compression=compression).csv(path)
