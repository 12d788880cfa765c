"""Published tables: immutable folders, and numbered pointers that name the current ones.

A publication stages tables, each written once in its final layout into folders of its own.
Later tables of a publication may be computed from its staged ones. Committing adds one pointer
file, so all of it appears at the same moment or not at all. Readers take a `Snapshot`: the
pointer with the highest number, and the files it names, which stay until `vacuum` deletes
versions that are both old and superseded.

Commits are compare-and-set. A publication begins at a snapshot and may only become the very
next number; the number is claimed by creating a file that must not exist yet, so of two
publications that began at the same snapshot one gets a `PublicationConflict` and leaves nothing.
A claim whose publication died before its pointer was there is taken over after `CLAIM_SECONDS`.
(The store has to refuse to create an existing file, as HDFS does.)

Tables with a time in `schemas.PARTITION_TIMES` lie in one folder per day; a publication may
replace single days and keep the folders of the others. A keyed merge rewrites the files that
hold a key of the new rows and keeps the others. Rows are counted while they are written.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Callable, Collection, Iterable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline import schemas

_POINTER, _CLAIM = "_current-", "_claim-"
#: After this time without a pointer a claimed number counts as abandoned.
CLAIM_SECONDS = 600
#: How many versions, and how old ones, `vacuum` leaves to readers.
KEEP_VERSIONS, KEEP_SECONDS = 2, 24 * 3600


class RefreshRejected(RuntimeError):
    """The written tables broke a rule; what was published before is still published."""


class PublicationConflict(RuntimeError):
    """Another publication was committed since this one began; nothing of this one is published."""


def _path(spark: SparkSession, path: str):
    """A Hadoop path and its file system, whatever store the path names."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def delete(spark: SparkSession, path: str) -> None:
    found, system = _path(spark, path)
    system.delete(found, True)


def move(spark: SparkSession, path: str, to: str) -> bool:
    """Give a file or folder another name, in folders that are made; False if there is none."""
    found, system = _path(spark, path)
    if not system.exists(found):
        return False
    target = _path(spark, to)[0]
    system.mkdirs(target.getParent())
    if not system.rename(found, target):
        raise RuntimeError(f"{path} could not be moved to {to}")
    return True


def _listed(spark: SparkSession, path: str) -> list:
    folder, system = _path(spark, path)
    return list(system.listStatus(folder)) if system.exists(folder) else []


def _numbers(spark: SparkSession, directory: str, prefix: str) -> list[int]:
    names = (s.getPath().getName() for s in _listed(spark, directory))
    return sorted(int(n[len(prefix) :]) for n in names if n.startswith(prefix))


def _create(spark: SparkSession, path: str) -> None:
    """An empty file, or FileExistsError if there is one."""
    found, system = _path(spark, path)
    if system.getUri().getScheme() == "file":
        # Hadoop's local file system looks first and creates then.
        os.close(os.open(found.toUri().getPath(), os.O_CREAT | os.O_EXCL))
        return
    try:
        system.create(found, False).close()
    except Exception as error:
        if system.exists(found):
            raise FileExistsError(path) from error
        raise


def _write_text(spark: SparkSession, directory: str, name: str, text: str) -> None:
    """Written beside and renamed, so that the file is whole when it has its name."""
    draft, system = _path(spark, f"{directory}/_draft-{uuid.uuid4().hex}")
    stream = system.create(draft, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    if not system.rename(draft, _path(spark, f"{directory}/{name}")[0]):
        raise RuntimeError(f"{directory}/{name} could not be written")


def _read_text(spark: SparkSession, path: str) -> str:
    found, system = _path(spark, path)
    stream = system.open(found)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


# -- reading -----------------------------------------------------------------------------------


@dataclass(frozen=True)
class Snapshot:
    """The tables of one publication. All its files stay readable until they are vacuumed.

    Per table: `days` (paths below the table's folder, by day) or `paths`, and `rows`.
    """

    spark: SparkSession = field(repr=False)
    directory: str
    number: int
    tables: Mapping[str, dict]
    #: What a publication says about itself, such as the batches of a stream that it holds.
    notes: Mapping[str, object] = field(default_factory=dict)

    def paths(self, table: str) -> dict[str, str]:
        """Folder (or file) by day; without days the number of the part takes the day's place."""
        entry = self.tables[table]
        parts = entry.get("days") or {str(at): path for at, path in enumerate(entry.get("paths", []))}
        return {part: f"{self._folder(table)}/{path}" for part, path in parts.items()}

    def _folder(self, table: str) -> str:
        return f"{self.directory}/versions/{table}"

    def _load(self, table: str, paths: Iterable[str]) -> DataFrame | None:
        paths = list(paths)
        if not paths:
            return None
        declared = schemas.PUBLISHED[table]
        if table in schemas.PARTITION_TIMES:
            declared = T.StructType([*declared, T.StructField("date", T.DateType())])
        # With the types given no file is opened to look for them.
        return self.spark.read.schema(declared).option("basePath", self._folder(table)).parquet(*paths)

    def _none(self, table: str) -> DataFrame:
        return self.spark.createDataFrame([], schemas.PUBLISHED[table])

    def rows(self, table: str) -> int:
        """The rows of a table, as counted when they were written."""
        return self.tables[table]["rows"] if table in self.tables else 0

    def days(self, table: str) -> list[str]:
        return sorted(self.tables.get(table, {}).get("days", {}))

    def read(self, table: str, days: Collection[str] | None = None) -> DataFrame:
        """All rows of a table, or those of some days; none if it was cleared."""
        if not self.number:
            raise FileNotFoundError(f"nothing is published in {self.directory}")
        parts = self.paths(table) if table in self.tables else {}
        found = self._load(table, [path for part, path in parts.items() if days is None or part in days])
        return self._none(table) if found is None else found.select(*schemas.PUBLISHED[table].names)

    def read_range(self, table: str, lo: str, hi: str) -> DataFrame:
        """Rows of a dated table with `lo <= time <= hi`; only the days between are opened."""
        if not self.number:
            raise FileNotFoundError(f"nothing is published in {self.directory}")
        parts = self.paths(table) if table in self.tables else {}
        found = self._load(table, [path for day, path in parts.items() if lo[:10] <= day <= hi[:10]])
        if found is None:
            return self._none(table)
        return _in_range(found, schemas.PARTITION_TIMES[table], lo, hi).select(*schemas.PUBLISHED[table].names)


def snapshot(spark: SparkSession, directory: str, number: int | None = None) -> Snapshot:
    """The current publication, or an older one that was not vacuumed; number 0 before the first."""
    if number is None:
        number = max(_numbers(spark, directory, _POINTER), default=0)
    if not number:
        return Snapshot(spark, directory, 0, {})
    held = json.loads(_read_text(spark, f"{directory}/{_POINTER}{number:012d}"))
    return Snapshot(spark, directory, number, held["tables"], held["notes"])


def current(spark: SparkSession, directory: str) -> dict[str, dict]:
    """What the current pointer says by published table; empty before the first publication."""
    return dict(snapshot(spark, directory).tables)


def read_table(spark: SparkSession, directory: str, table: str) -> DataFrame:
    """The current rows of a published table; none if it was cleared.

    Whoever reads several tables that have to fit together takes one `snapshot` for all.
    """
    return snapshot(spark, directory).read(table)


def _in_range(df: DataFrame, ts: str, lo: str, hi: str) -> DataFrame:
    kind = df.schema[ts].dataType
    low, high = F.lit(lo).cast(kind), F.lit(hi).cast(kind)
    in_days = F.col("date").between(low.cast("date"), high.cast("date"))
    return df.filter(in_days & F.col(ts).between(low, high))


def read_range(spark: SparkSession, path: str, ts: str, lo: str, hi: str) -> DataFrame:
    """Rows of a table written by `write_by_date` with `lo <= ts <= hi`.

    The date filter prunes folders, the time filter is pushed to the row groups.
    """
    return _in_range(spark.read.parquet(path), ts, lo, hi).drop("date")


def read_published_range(spark: SparkSession, directory: str, table: str, lo: str, hi: str) -> DataFrame:
    """`Snapshot.read_range` over the current publication."""
    return snapshot(spark, directory).read_range(table, lo, hi)


# -- writing -----------------------------------------------------------------------------------


def write_by_date(df: DataFrame, path: str, ts: str, mode: str = "overwrite", counted: Observation | None = None) -> None:
    """Parquet in one folder per day of `ts`; days are gathered, and large ones split by size."""
    dated = df.withColumn("date", F.to_date(ts)).hint("rebalance", "date").sortWithinPartitions("date", ts)
    _counted(dated, counted).write.mode(mode).partitionBy("date").parquet(path)


def _counted(df: DataFrame, counted: Observation | None) -> DataFrame:
    """Counts at the write itself: a task that is repeated counts once, as it writes once."""
    return df if counted is None else df.observe(counted, F.count(F.lit(1)).alias("rows"))


def counted_write(df: DataFrame, write: Callable[[DataFrame], None]) -> int:
    """How many rows `write` wrote, told by the write."""
    counted = Observation()
    write(_counted(df, counted))
    return counted.get.get("rows") or 0


def reject(violations: DataFrame) -> None:
    """Raise RefreshRejected with the first violations, if there are any."""
    found = violations.limit(5).collect()
    if found:
        raise RefreshRejected("; ".join(f"{v['rule']} {v['table']} {v['key']}" for v in found))


class Publication:
    """Staged tables over a snapshot. Nothing of them is visible before `commit`."""

    def __init__(self, spark: SparkSession, directory: str, clear: Collection[str] = ()):
        self.spark, self.directory = spark, directory
        self.base = snapshot(spark, directory)
        self._version = f"v=p{uuid.uuid4().hex}"
        self._tables = {t: entry for t, entry in self.base.tables.items() if t not in clear}
        self.notes = dict(self.base.notes)
        self._written: list[str] = []
        self._folders: list[str] = []

    @property
    def staged(self) -> Snapshot:
        """The tables as they will be; reading it needs the publication to be alive."""
        return Snapshot(self.spark, self.directory, self.base.number + 1, self._tables, self.notes)

    def read(self, table: str, days: Collection[str] | None = None) -> DataFrame:
        return self.staged.read(table, days)

    def _stage(self, table: str, df: DataFrame) -> tuple[str, int]:
        """(folder below the table's, rows written)."""
        folder = f"{self._version}-{len(self._folders)}"
        path = f"{self.directory}/versions/{table}/{folder}"
        self._folders.append(path)
        self._written.append(table)
        df = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.PUBLISHED[table]])
        counted = Observation()
        if table in schemas.PARTITION_TIMES:
            write_by_date(df, path, schemas.PARTITION_TIMES[table], counted=counted)
        else:
            _counted(df, counted).write.parquet(path)
        return folder, counted.get.get("rows") or 0

    def _days_in(self, table: str, folder: str) -> dict[str, str]:
        names = [s.getPath().getName() for s in _listed(self.spark, f"{self.directory}/versions/{table}/{folder}")]
        return {name[len("date=") :]: f"{folder}/{name}" for name in names if name.startswith("date=")}

    def write(self, table: str, df: DataFrame) -> DataFrame:
        """Stage a table in place of the published one; returns the stored rows."""
        folder, rows = self._stage(table, df)
        place = {"days": self._days_in(table, folder)} if table in schemas.PARTITION_TIMES else {"paths": [folder]}
        self._tables[table] = {**place, "rows": rows}
        return self.read(table)

    def write_days(self, table: str, df: DataFrame, days: Collection[str | date]) -> None:
        """Stage rows of `days` in place of all rows of these days; the other days stay as they are."""
        days = {str(day) for day in days}
        folder, rows = self._stage(table, df)
        new = self._days_in(table, folder)
        if not new.keys() <= days:
            raise ValueError(f"rows of {sorted(new.keys() - days)} are not among the days to replace")
        before = self._tables.get(table, {"days": {}, "rows": 0})
        replaced = [day for day in before["days"] if day in days]
        # Parquet footers tell how many rows go; no column is read.
        gone = self.read(table, replaced).count() if replaced else 0
        kept = {day: path for day, path in before["days"].items() if day not in days}
        self._tables[table] = {"days": {**kept, **new}, "rows": before["rows"] - gone + rows}

    def merge(self, table: str, df: DataFrame, key: Sequence[str]) -> None:
        """Stage an undated table with the rows of `df` inserted or, where the key exists, put in their place.

        Files without any of the keys are kept. A key that `df` holds twice is an error.
        """
        names = schemas.PUBLISHED[table].names
        new = self.spark.read.schema(df.select(*names).schema).parquet(self._scratch(table, df.select(*names)))
        if not new.groupBy(*key).count().filter("count > 1").isEmpty():
            raise ValueError(f"the rows to merge into {table} repeat a key ({', '.join(key)})")
        folder_of = f"{self.directory}/versions/{table}/"
        paths = list(self.staged.paths(table).values()) if table in self._tables else []
        rows, kept, rewritten = self.staged.rows(table), [], new
        if paths:
            stored = self.spark.read.option("basePath", folder_of).parquet(*paths)
            keyed = stored.select(*key, F.col("_metadata.file_path").alias("file"))
            # As many names as the table has files.
            touched = {_local_name(r.file, table) for r in keyed.join(new.select(*key), list(key), "left_semi").select("file").distinct().collect()}
            files = {_local_name(name, table) for name in stored.inputFiles()}
            kept = sorted(files - touched)
            if touched:
                old = self.spark.read.option("basePath", folder_of).parquet(*[folder_of + name for name in sorted(touched)])
                rows -= old.count()
                rewritten = old.select(*names).join(new.select(*key), list(key), "left_anti").select(*names).unionByName(new)
        folder, written = self._stage(table, rewritten)
        self._tables[table] = {"paths": [*kept, folder], "rows": rows + written}

    def _scratch(self, table: str, df: DataFrame) -> str:
        path = f"{self.directory}/versions/{table}/{self._version}-merged-{len(self._folders)}"
        self._folders.append(path)
        df.write.parquet(path)
        return path

    def commit(self, violations: Callable[[Mapping[str, DataFrame]], DataFrame] | None = None) -> Snapshot:
        """Check what was written and make it current, unless another publication came first."""
        if violations is not None:
            reject(violations({table: self.read(table) for table in self._written}))
        number = self.base.number + 1
        claim = f"{self.directory}/{_CLAIM}{number:012d}"
        if snapshot(self.spark, self.directory).number != self.base.number:
            raise PublicationConflict(f"version {number} of {self.directory} was published meanwhile")
        _folder(self.spark, self.directory)
        try:
            _create(self.spark, claim)
        except FileExistsError:
            self._take_over(claim)
        text = json.dumps({"tables": self._tables, "notes": self.notes, "at": int(time.time())})
        _write_text(self.spark, self.directory, f"{_POINTER}{number:012d}", text)
        return self.staged

    def _take_over(self, claim: str) -> None:
        found, system = _path(self.spark, claim)
        age = time.time() - system.getFileStatus(found).getModificationTime() / 1000
        if age < CLAIM_SECONDS:
            raise PublicationConflict(f"{claim} belongs to another publication")
        system.delete(found, False)
        try:
            _create(self.spark, claim)
        except FileExistsError as error:
            raise PublicationConflict(f"{claim} was taken over by another publication") from error

    def discard(self) -> None:
        for path in self._folders:
            delete(self.spark, path)


def _folder(spark: SparkSession, directory: str) -> None:
    found, system = _path(spark, directory)
    system.mkdirs(found)


def _local_name(file: str, table: str) -> str:
    """A file's path below the folder of its table."""
    return file.split(f"/versions/{table}/", 1)[1]


@contextmanager
def publication(
    spark: SparkSession,
    directory: str,
    clear: Collection[str] = (),
    violations: Callable[[Mapping[str, DataFrame]], DataFrame] | None = None,
) -> Iterator[Publication]:
    """Stage tables inside the `with`; they are committed together at its end, or not at all."""
    staged = Publication(spark, directory, clear)
    try:
        yield staged
        staged.commit(violations)
    except BaseException:
        staged.discard()
        raise


def publish(
    spark: SparkSession,
    frames: Mapping[str, DataFrame],
    directory: str,
    violations: Callable[[Mapping[str, DataFrame]], DataFrame] | None = None,
    clear: Collection[str] = (),
) -> None:
    """Write `frames` once each, check them, and make them (without the tables `clear`) the current ones."""
    with publication(spark, directory, clear, violations) as staged:
        for table, df in frames.items():
            staged.write(table, df)


def vacuum(spark: SparkSession, directory: str, keep: int = KEEP_VERSIONS, seconds: float = KEEP_SECONDS) -> int:
    """Delete superseded versions, but never the last `keep` nor anything younger than `seconds`.

    Folders younger than that may belong to a publication that is still being staged, and pointers to
    readers that planned a scan. Returns how many folders and files went.
    """
    limit, gone = (time.time() - seconds) * 1000, 0
    pointers = [s for s in _listed(spark, directory) if s.getPath().getName().startswith(_POINTER)]
    pointers.sort(key=lambda s: s.getPath().getName())
    old = [s for s in pointers[: max(len(pointers) - keep, 0)] if s.getModificationTime() < limit]
    dropped = {int(s.getPath().getName()[len(_POINTER) :]) for s in old}
    named: dict[str, set[str]] = {}
    for number in _numbers(spark, directory, _POINTER):
        if number not in dropped:
            for table, entry in snapshot(spark, directory, number).tables.items():
                named.setdefault(table, set()).update([*entry.get("days", {}).values(), *entry.get("paths", [])])
    # Pointers first: nobody begins to read what goes.
    for status in old:
        number = int(status.getPath().getName()[len(_POINTER) :])
        delete(spark, status.getPath().toString())
        delete(spark, f"{directory}/{_CLAIM}{number:012d}")
    for table in _listed(spark, f"{directory}/versions"):
        held = named.get(table.getPath().getName(), set())
        for version in _listed(spark, table.getPath().toString()):
            if version.getModificationTime() < limit:
                gone += _drop_unnamed(spark, version, version.getPath().getName(), held)
    return gone


def _drop_unnamed(spark: SparkSession, status, name: str, held: set[str]) -> int:
    """Delete a folder, or of a folder that is named in part, the days and files that are not."""
    if name in held:
        return 0
    if not any(path.startswith(f"{name}/") for path in held):
        delete(spark, status.getPath().toString())
        return 1
    inside = [s for s in _listed(spark, status.getPath().toString()) if not s.getPath().getName().startswith(("_", "."))]
    return sum(_drop_unnamed(spark, one, f"{name}/{one.getPath().getName()}", held) for one in inside)
