"""What a replica remembers: who may write to it, which runs are over, what they changed.

The records are small files in a folder of their own beside the months, which
Spark's readers pass by. Every job that changes the replica holds a claim with a
number, made by creating a file that must not exist. Numbers only grow: whoever takes
over a broken run gets a higher one, and a job whose number is not the highest any
more stops before it writes (a fencing number). So a replica has one writer, whatever
staging roots are used. A claim without content was left by a job that broke off while
it wrote it; nothing was begun under it, and it can be passed over.

On stores whose create is not atomic, start the jobs of one replica one at a time.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerfold.sources.files import Folder

PUBLISHED, ABANDONED, UNDONE = "published", "abandoned", "undone"
FOLDER = "_ledgerfold"
_ENTRY = (
    "number bigint, run_id string, read bigint, rejected bigint, "
    "months array<struct<ends:string,starts:string,added:bigint,removed:bigint>>"
)


@dataclass(frozen=True)
class Run:
    run_id: str
    target: str
    root: str
    strategy: str
    spec: str
    kind: str = "apply"


@dataclass(frozen=True)
class Claim:
    number: int
    run: Run | None


class Ledger:
    def __init__(self, spark: SparkSession, location: str) -> None:
        self.spark = spark
        self.folder = Folder(spark, f"{location.rstrip('/')}/{FOLDER}")

    def last(self) -> int:
        return max((int(n.split(".")[0]) for n in self.folder.names("claims")), default=0)

    def current(self) -> Claim | None:
        """The claim of a job that was begun and is not over."""
        number = self.last()
        if number == 0 or self.folder.exists(f"claims/{number:08d}.over"):
            return None
        held = self.folder.read(f"claims/{number:08d}.json")
        return Claim(number, Run(**held) if held else None)

    def free(self) -> None:
        """Refuse where a run is unfinished."""
        held = self.current()
        if held is not None and held.run is not None:
            raise RuntimeError(
                f"run {held.run.run_id} of staging root {held.run.root} is unfinished; "
                "finish it with resume_run"
            )

    def take(self, run: Run, after: int | None = None) -> int:
        """Claim the replica; ``after`` is the number of the broken attempt that is taken over."""
        if after is None:
            self.free()
        number = self.last() + 1
        try:
            if after is not None and number != after + 1:
                raise RuntimeError(f"claim {after} has been taken over by another job")
            self.folder.create(f"claims/{number:08d}.json", asdict(run))
        except Py4JJavaError as taken:
            if "alreadyexists" not in str(taken.java_exception).lower().replace(" ", ""):
                raise
            raise RuntimeError("another job has just claimed the replica") from taken
        return number

    def check(self, number: int) -> None:
        """Stop a job that has been taken over."""
        last = self.last()
        if last != number:
            raise RuntimeError(f"claim {number} has been taken over by claim {last}")

    def outcome(self, run_id: str) -> str | None:
        """How a run ended, if it has."""
        record = self.folder.read(f"runs/{run_id}.json")
        return record and record.get("state")

    def finish(self, number: int, run: Run, state: str) -> None:
        """Record how the run ended and give the replica free."""
        at = datetime.now(timezone.utc).isoformat()
        self.folder.put(f"runs/{run.run_id}.json", asdict(run) | {"state": state, "at": at})
        self.folder.create(f"claims/{number:08d}.over", {})
        for name in self.folder.names("claims"):
            if int(name.split(".")[0]) < number:
                self.folder.delete(f"claims/{name}")

    def begin_again(self, number: int) -> None:
        """Go on from a number after the folder was overwritten together with the replica."""
        for kind in ("json", "over"):
            self.folder.create(f"claims/{number:08d}.{kind}", {})

    # what the runs changed, by month

    def has_entries(self) -> bool:
        return bool(self.folder.names("entries"))

    def enter(self, number: int, run_id: str, months: list[dict], **counts: int | None) -> None:
        """Rows that a run added to and removed from each month."""
        for name in self.folder.names("entries"):
            if (self.folder.read(f"entries/{name}") or {}).get("run_id") == run_id:
                self.folder.delete(f"entries/{name}")
        entry = {"number": number, "run_id": run_id, "months": months} | counts
        self.folder.create(f"entries/{number:08d}.json", entry)

    def strike(self, run_id: str) -> None:
        """Take back the entry of a run that was undone."""
        for name in self.folder.names("entries"):
            if (self.folder.read(f"entries/{name}") or {}).get("run_id") == run_id:
                self.folder.delete(f"entries/{name}")

    def entries(self) -> DataFrame:
        """One row for each run and month: ``number``, ``run_id``, ``ends``, ``starts``, ``added``,
        ``removed``, and what the run ``read`` and ``rejected``."""
        names = self.folder.names("entries")
        paths = [f"{self.folder.path}/entries/{n}" for n in names]
        schema = T.StructType.fromDDL(_ENTRY)
        rows = (
            self.spark.read.schema(schema).json(paths)
            if paths
            else self.spark.createDataFrame([], schema)
        )
        return rows.select("number", "run_id", "read", "rejected", F.inline_outer("months"))

    # the declared schema

    def schema(self) -> T.StructType | None:
        held = self.folder.read("schema.json")
        return T.StructType.fromJson(held) if held else None

    def declare(self, schema: T.StructType) -> None:
        self.folder.put("schema.json", schema.jsonValue())
