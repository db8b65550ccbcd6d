"""Where a replica lives: a Parquet path or a catalog table.

Both scan it, append rows as new files and retire the files they replace. Retired
files are moved aside, below the replica's own records, so a run can be undone.
"""

from __future__ import annotations

from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ledgerfold.functions.columns import in_open_partition, named
from ledgerfold.operators.bins import NO_MONTH
from ledgerfold.sources.files import Folder
from ledgerfold.sources.ledger import FOLDER
from ledgerfold.sources.replica import read_replica
from ledgerfold.sources.staging import open_folder, write_replica
from ledgerfold.spec import DEFAULT, ScdSpec


def short(uri: str) -> str:
    """A data file's name below its replica: two month folders and the file."""
    return unquote("/".join(uri.split("/")[-3:]))


def read_files(
    spark: SparkSession, location: str, schema: T.StructType, names: list[str]
) -> DataFrame:
    """Rows of some files or folders below a replica, with their months."""
    if not names:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).option("basePath", location)
    return reader.parquet(*[f"{location}/{n}" for n in names])


def files_below(spark: SparkSession, location: str, folders: list[str]) -> list[str]:
    """Names of the data files in folders of an end month."""
    return sorted(sizes_below(spark, location, folders))


def sizes_below(spark: SparkSession, location: str, folders: list[str]) -> dict[str, int]:
    """The same names with the bytes of each file."""
    there = Folder(spark, location)
    return {short(f): n for folder in folders for f, n in there.sizes(f"{folder}/*/*").items()}


def open_name(spec: ScdSpec) -> str:
    return f"{spec.part_to}={spec.open_month}"


class _Files:
    """What paths and tables that keep their files in one folder have in common."""

    attach = False

    def open_rows(self, spark: SparkSession, schema: T.StructType, spec: ScdSpec) -> DataFrame:
        """The open slice; only its folder is listed."""
        location, folder = self.location(spark), open_name(spec)
        held = [folder] if Folder(spark, location).exists(folder) else []
        return read_files(spark, location, schema, held)

    def retire(self, spark: SparkSession, names: list[str], aside: str, spec: ScdSpec) -> None:
        """Move files aside; those that have been moved before stay there."""
        Folder(spark, self.location(spark)).move_all(names, "", f"{aside}/")
        self._tidy(spark, names, spec)

    def restore(self, spark: SparkSession, names: list[str], aside: str, spec: ScdSpec) -> None:
        """Bring retired files back."""
        Folder(spark, self.location(spark)).move_all(names, f"{aside}/", "")
        self._found(spark, names, spec)

    def drop_files(self, spark: SparkSession, names: list[str], spec: ScdSpec) -> None:
        """Delete files for good."""
        folder = Folder(spark, self.location(spark))
        for name in names:
            folder.delete(name)
        self._tidy(spark, names, spec)

    def _emptied(self, spark: SparkSession, names: list[str]) -> list[tuple[str, str]]:
        """Month folders without a file: they go. Their two names, of the table's partitions."""
        folder = Folder(spark, self.location(spark))
        gone = []
        for months in sorted({n.rsplit("/", 1)[0] for n in names}):
            if folder.is_empty(months):
                folder.delete(months)
                gone.append(tuple(m.split("=", 1)[1] for m in months.split("/")))
        for ends in sorted({n.split("/", 1)[0] for n in names}):
            if folder.is_empty(ends):
                folder.delete(ends)
        return gone

    def _tidy(self, spark: SparkSession, names: list[str], spec: ScdSpec) -> None:
        self._emptied(spark, names)

    def _found(self, spark: SparkSession, names: list[str], spec: ScdSpec) -> None:
        """Nothing to tell: a path is listed anew by each reader."""


@dataclass(frozen=True)
class PathReplica(_Files):
    path: str

    @property
    def identity(self) -> str:
        return self.path.rstrip("/")

    def location(self, spark: SparkSession) -> str:
        return self.identity

    def check(self, spark: SparkSession) -> None:
        """Nothing to check: a path has one mode."""

    def scan(
        self, spark: SparkSession, spec: ScdSpec = DEFAULT, schema: T.StructType | None = None
    ) -> DataFrame:
        return read_replica(spark, self.path, spec, schema)

    def append(self, added: DataFrame, spec: ScdSpec = DEFAULT) -> None:
        write_replica(added, self.path, "append", spec)


@dataclass(frozen=True)
class TableReplica(_Files):
    """A catalog table; with ``attach`` its open partitions point at the staged files.

    Attaching changes the catalog alone, so no open row is written a second
    time, and the staged files stay for as long as the table uses them. The table
    keeps its mode as a property: runs of the other mode would overwrite files
    that partitions still point at, or bring back those they have let go of.
    A managed table is not attached to: dropping its partition would delete staged files.
    """

    name: str
    attach: bool = False

    @property
    def identity(self) -> str:
        return self.name

    def check(self, spark: SparkSession) -> None:
        """Refuse a run in another mode than the table's; an unmarked table gets this one."""
        wanted = _ATTACHED if self.attach else _PLAIN
        if self.attach and self._described(spark)["Type"] != "EXTERNAL":
            raise ValueError(f"{self.name} is managed; only an external table can be attached to")
        rows = spark.sql(f"SHOW TBLPROPERTIES {self.name}").collect()
        mode = {r["key"]: r["value"] for r in rows}.get(_MODE)
        if mode is None:
            spark.sql(f"ALTER TABLE {self.name} SET TBLPROPERTIES ('{_MODE}' = '{wanted}')")
        elif mode != wanted:
            raise ValueError(f"{self.name} is kept by {mode} runs, this one is {wanted}")

    def scan(
        self, spark: SparkSession, spec: ScdSpec = DEFAULT, schema: T.StructType | None = None
    ) -> DataFrame:
        return spark.table(self.name)

    def open_rows(self, spark: SparkSession, schema: T.StructType, spec: ScdSpec) -> DataFrame:
        if not self.attach:
            return super().open_rows(spark, schema, spec)
        return spark.table(self.name).filter(in_open_partition(spec))

    def append(self, added: DataFrame, spec: ScdSpec = DEFAULT) -> None:
        table = added.sparkSession.table(self.name)
        added.select(*[named(c) for c in table.columns]).write.insertInto(self.name)

    def location(self, spark: SparkSession) -> str:
        return self._described(spark)["Location"].rstrip("/")

    def _described(self, spark: SparkSession) -> dict[str, str]:
        rows = spark.sql(f"DESCRIBE TABLE EXTENDED {self.name}").collect()
        return {r["col_name"]: r["data_type"] for r in rows}

    def _tidy(self, spark: SparkSession, names: list[str], spec: ScdSpec) -> None:
        gone = self._emptied(spark, names)
        if gone:
            listed = ", ".join(self._partition(ends, starts, spec) for ends, starts in gone)
            spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS {listed}")
        spark.catalog.refreshTable(self.name)

    def _found(self, spark: SparkSession, names: list[str], spec: ScdSpec) -> None:
        months = sorted({tuple(m.split("=", 1)[1] for m in n.split("/")[:2]) for n in names})
        if months:
            listed = " ".join(self._partition(ends, starts, spec) for ends, starts in months)
            spark.sql(f"ALTER TABLE {self.name} ADD IF NOT EXISTS {listed}")
        spark.catalog.refreshTable(self.name)

    def _partition(self, ends: str, starts: str, spec: ScdSpec) -> str:
        values = ["null" if m == NO_MONTH else f"DATE'{m}'" for m in (ends, starts)]
        return f"PARTITION (`{spec.part_to}` = {values[0]}, `{spec.part_from}` = {values[1]})"

    def _open_months(self, spark: SparkSession, spec: ScdSpec) -> list[str]:
        """Start months of the table's open partitions, as text."""
        listed = spark.sql(
            f"SHOW PARTITIONS {self.name} PARTITION (`{spec.part_to}` = DATE'{spec.open_month}')"
        )
        return [r[0].removeprefix(f"{open_name(spec)}/{spec.part_from}=") for r in listed.collect()]

    def point_at(self, spark: SparkSession, root: str, spec: ScdSpec) -> None:
        """Let the open partitions be those below ``root``: a list of months. Repeatable."""
        folder = open_folder(root, spec)
        months = [
            n.removeprefix(f"{spec.part_from}=")
            for n in Folder(spark, folder).names()
            if n.startswith(f"{spec.part_from}=")
        ]
        held = self._open_months(spark, spec)
        if held:
            gone = ", ".join(self._partition(str(spec.open_month), m, spec) for m in held)
            spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS {gone}")
        if months:
            quoted = folder.replace("'", "\\'")
            added = [
                f"{self._partition(str(spec.open_month), m, spec)} LOCATION '{quoted}/{spec.part_from}={m}'"
                for m in months
            ]
            spark.sql(f"ALTER TABLE {self.name} ADD {' '.join(added)}")
        spark.catalog.refreshTable(self.name)


_MODE, _PLAIN, _ATTACHED = "ledgerfold.mode", "overwriting", "attaching"


def create_replica(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    path: str,
    spec: ScdSpec = DEFAULT,
    attach: bool = False,
) -> TableReplica:
    """An empty replica table over ``path``, partitioned by the two months."""
    writer = spark.createDataFrame([], schema).write.format("parquet").option("path", path)
    writer.option("compression", "zstd").partitionBy(*spec.partitioning).saveAsTable(name)
    made = TableReplica(name, attach)
    made.check(spark)
    return made


Target = PathReplica | TableReplica
