"""Written tables: intermediate ones and the stored ones of the pipeline."""

import hashlib
import uuid
from datetime import datetime
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyboard.operators.maintain import conform
from tallyboard.schemas import BASE_TABLES
from tallyboard.session import staging_folder


def scratch_folder(spark: SparkSession) -> str:
    """Where intermediate tables go: `spark.checkpoint.dir`, or else beside the session's tables.

    Both are places that all executors share.
    """
    folder = staging_folder(spark)
    return folder.rstrip("/") if folder else spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/staged"


def staged(table: DataFrame, label: str, *partitions: str) -> DataFrame:
    """The table, written once and read back.

    For results that several later steps read: they are worked out once, later steps read only
    the columns they need, and a lost executor costs no recomputation of what came before.
    """
    return reread(table, write_staged(table, label, *partitions))


def write_staged(table: DataFrame, label: str, *partitions: str) -> str:
    folder = f"{scratch_folder(table.sparkSession)}/{label}-{uuid.uuid4().hex}"
    gathered(table, *partitions).write.partitionBy(*partitions).parquet(folder)
    return folder


def gathered(table: DataFrame, *partitions: str) -> DataFrame:
    """The rows of a partition together, large partitions split: few files of even size."""
    return table.hint("rebalance", *partitions) if partitions else table


def reread(table: DataFrame, folder: str) -> DataFrame:
    """What was written to the folder, in the layout of the table it came from."""
    return table.sparkSession.read.schema(table.schema).parquet(folder).select(*table.columns)


def layout_mark(schema: T.StructType) -> str:
    """A short mark that two tables share if their columns have the same names and types."""
    return hashlib.sha256(schema.simpleString().encode()).hexdigest()[:8]


# How the folder of one year is named.
YEAR = "year="


def folder_parts(folder: str) -> tuple[str, str, str | None]:
    """Layout mark, name within the table and year (if it has one) of a stored folder."""
    parts = folder.split("/")
    if parts[-1].startswith(YEAR):
        return parts[-3], "/".join(parts[-2:]), parts[-1].removeprefix(YEAR)
    return parts[-2], parts[-1], None


class Store:
    """Stored tables as Parquet folders, and which folders make up each table.

    A run writes new folders and becomes visible with one last row in `runs`, numbered one above
    the run it began from; the run's own date plays no part. A second writer that began from the
    same run finds the number taken and fails. A run that dies earlier leaves folders nobody
    reads, so nothing is overwritten in place and a retry starts from the last complete state.
    Fact tables grow by one folder per import and year of the events, so a report on one year opens the folders of
    that year; small tables are rewritten.
    """

    LOG = "number long, run_id string, run_time timestamp, folders map<string, array<string>>"

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def last(self) -> tuple[int, dict[str, list[str]]]:
        """Number and folders of the last complete run; 0 and none before the first."""
        log = self.spark.read.schema(self.LOG).option("recursiveFileLookup", "true")
        try:
            last = log.json(f"{self.root}/runs").orderBy(F.desc("number")).first()
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return 0, {}
            raise
        return (last["number"], dict(last["folders"])) if last else (0, {})

    def folders(self) -> dict[str, list[str]]:
        """The folders of each table after the last complete run."""
        return self.last()[1]

    def read(self, name: str, folders: list[str] | None = None, located: bool = False, marked: bool = False) -> DataFrame:
        """A table, in its declared layout if it has one; empty if nothing is stored.

        Folders carry a mark of the layout they were written in, so only folders of an older
        layout are opened to see what is in them. `located` adds the name of each row's folder, `marked` only the
        mark of its file, a number that costs little to carry; `places` tells its folder.
        """
        folders = self.folders().get(name, []) if folders is None else folders
        declared = BASE_TABLES.get(name)
        if not folders:
            if declared is None:
                raise LookupError(f"{name} has not been built yet")
            return self.spark.createDataFrame([], declared)
        if declared is None:
            return self.spark.read.parquet(*folders)
        current = [folder for folder in folders if f"/{layout_mark(declared)}/" in folder]
        parts = [self.spark.read.parquet(folder) for folder in folders if folder not in current]
        if current:
            parts.append(self.spark.read.schema(declared).parquet(*current))
        extra = self._folder() if located else self._place() if marked else None
        shaped = [conform(part, declared, extra) for part in parts]
        return reduce(DataFrame.unionByName, shaped)

    def places(self, folders: list[str]) -> DataFrame:
        """(place, folder) of each file in the folders, none of them opened."""
        return self.spark.read.format("binaryFile").load(folders).select(self._place(), self._folder())

    @staticmethod
    def _place() -> Column:
        return F.xxhash64("_metadata.file_path").alias("place")

    @staticmethod
    def _folder() -> Column:
        return F.regexp_extract("_metadata.file_path", f"([^/]+(?:/{YEAR}[^/]+)?)/[^/]+$", 1).alias("folder")

    def write(self, table: DataFrame, name: str, run_id: str, *partitions: str, year: str | None = None) -> str:
        """Write one new folder of a table; it counts once the run is committed.

        The mark is that of the columns inside the files. `year` makes it the folder of that year.
        """
        inside = T.StructType([field for field in table.schema if field.name not in partitions])
        folder = f"{self.root}/{name}/{layout_mark(inside)}/run-{run_id}-{uuid.uuid4().hex[:8]}"
        folder += f"/{YEAR}{year}" if year else ""
        gathered(table, *partitions).write.partitionBy(*partitions).parquet(folder)
        return folder

    def write_by_year(self, table: DataFrame, name: str, run_id: str) -> list[str]:
        """Write a table with a column `year` and give one folder per year that has rows."""
        folder = self.write(table, name, run_id, "year")
        context = self.spark.sparkContext
        place = context._jvm.org.apache.hadoop.fs.Path(folder)
        inside = place.getFileSystem(context._jsc.hadoopConfiguration()).listStatus(place)
        names = sorted(entry.getPath().getName() for entry in inside)
        return [f"{folder}/{one}" for one in names if one.startswith(YEAR)]

    def commit(self, number: int, run_id: str, run_time: datetime, folders: dict[str, list[str]]) -> None:
        """Make a run visible. Fails if another run has the number."""
        row = self.spark.createDataFrame([(number, run_id, run_time, folders)], self.LOG)
        place = f"{self.root}/runs/{number:012d}"
        row.coalesce(1).write.mode("error").json(place)
        if self.spark.read.schema(self.LOG).json(place).count() != 1:
            raise RuntimeError(f"two runs took the number {number}")
