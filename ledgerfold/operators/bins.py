"""Which small files of a replica are merged, and into how many of what size.

A month is due once it holds more small files than it may. Its small files are packed into
bins of at most the wanted size, each bin one new file; large files and months that are not
due stay. A full bin is no small file any more, so a row is rewritten a few times at most,
however many runs follow.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerfold.functions.columns import named
from ledgerfold.spec import ScdSpec

# Bytes a merged file is filled up to, and small files that a month may hold.
FILE_BYTES, MOST_SMALL = 128 << 20, 32
# Folder name of the null partition, a fixed value of the Hive layout.
NO_MONTH = "__HIVE_DEFAULT_PARTITION__"

_PLACE, _BIN = "__place", "__bin"


def month_name(file: str) -> str:
    """The two month folders of a data file's name."""
    return file.rsplit("/", 1)[0]


def packed(
    sizes: dict[str, int], file_bytes: int = FILE_BYTES, most_small: int = MOST_SMALL
) -> dict[str, int]:
    """The number of its bin for each file to be merged.

    ``sizes`` are the bytes of files, named by two month folders and the file. A file is
    small below a quarter of ``file_bytes``.
    """
    months: dict[str, list[tuple[int, str]]] = {}
    for name, size in sizes.items():
        if 4 * size < file_bytes:
            months.setdefault(month_name(name), []).append((size, name))
    bins: list[list[str]] = []
    for month in sorted(months):
        small = sorted(months[month])
        if len(small) <= most_small:
            continue
        own: list[list[str]] = []
        room = 0
        for size, name in small:
            if not own or size > room:
                own.append([])
                room = file_bytes
            own[-1].append(name)
            room -= size
        bins += [b for b in own if len(b) > 1]
    return {name: i for i, names in enumerate(bins) for name in names}


def dealt(rows: DataFrame, bins: dict[str, int], spec: ScdSpec) -> DataFrame:
    """Stored rows of the files in ``bins``, one task for each bin.

    The numbers are broadcast: one for each file, names which the driver has listed to read
    them. A file that goes by another name to the reader keeps its rows, in the first bin.
    """

    def folder(name: str):
        month = F.coalesce(named(name).cast("string"), F.lit(NO_MONTH))
        return F.concat(F.lit(f"{name}="), month)

    columns = [named(c) for c in rows.columns]
    place = F.concat_ws("/", *[folder(c) for c in spec.partitioning], F.col("_metadata.file_name"))
    numbers = rows.sparkSession.createDataFrame(list(bins.items()), f"{_PLACE} string, {_BIN} int")
    numbered = rows.withColumn(_PLACE, place).join(F.broadcast(numbers), _PLACE, "left")
    bin_ = F.coalesce(F.col(_BIN), F.lit(0))
    return numbered.repartitionById(max(bins.values()) + 1, bin_).select(*columns)
