"""Materialisation points (barriers) and table sinks.

``stage``     writes an intermediate DataFrame as parquet into the shared
              folder the cluster names in ``spark.checkpoint.dir`` and reads
              it back: one computation, lineage cut, survives executor loss,
              and later readers get column pruning and filter pushdown.
``StageScope``  owns the folders staged while it is open and frees them after
              their last reader.
``write_dated``  idempotent daily upsert of a dated table (K3 + K4 = K5).
``DatedStore``  the same, crash-safe: a day is written under a run of its own
              and becomes visible by one commit marker.
``append_history``  plain append with schema merge (K7).
"""

from __future__ import annotations

import uuid
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from renewlens.session import ensure_checkpoint_dir


_SCOPE: ContextVar[StageScope | None] = ContextVar("stage_scope", default=None)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder through the file system its path names, if it is there."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


class StageScope:
    """Owner of the folders staged while it is open.

    ``free`` releases one as soon as its last reader is done; leaving the scope
    releases the rest, on an error too. What a scope returns goes through
    ``keep``, which stages it for the scope around (or for the caller, outside
    of all scopes). A staged table of a closed scope must not be read again.

        with StageScope(spark) as scope:
            links = stage(..., "links")
            return scope.keep(stage(...), "result")
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[str, None] = {}

    def __enter__(self) -> StageScope:
        self._outer = _SCOPE.get()
        self._token = _SCOPE.set(self)
        return self

    def __exit__(self, *_) -> None:
        _SCOPE.reset(self._token)
        for path in list(self.paths):
            self._release(path)

    def _release(self, path: str) -> None:
        self.paths.pop(path, None)
        delete_folder(self.spark, path)

    def free(self, *tables: DataFrame) -> None:
        """Release staged tables of this scope; others are left alone."""
        for df in tables:
            path = getattr(df, "_stage_path", None)
            if path in self.paths:
                self._release(path)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` written as a table of the scope around."""
        out = _write_stage(df, name)
        if self._outer is not None:
            self._outer.paths[out._stage_path] = None
        return out


#: While a table is stored: shuffle files go with the write they were made for,
#: not when the driver happens to collect its garbage, and what waits between
#: Spark and a Python worker is a few MB.
_WHILE_STORED = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}


def _write_stage(df: DataFrame, name: str) -> DataFrame:
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/stage-{name}-{uuid.uuid4().hex[:12]}"
    before = {key: spark.conf.get(key, None) for key in _WHILE_STORED}
    try:
        for key, value in _WHILE_STORED.items():
            spark.conf.set(key, value)
        df.write.mode("overwrite").parquet(path)
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
    out = spark.read.parquet(path)
    out._stage_path = path
    return out


def stage(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back; the innermost open
    scope owns the folder."""
    out = _write_stage(df, name)
    scope = _SCOPE.get()
    if scope is not None:
        scope.paths[out._stage_path] = None
    return out


def write_dated(df: DataFrame, path: str, date_col: str, day=None) -> None:
    """Replace exactly the run dates present in ``df`` (dynamic partition
    overwrite), leaving every other date as it was: a rerun on the same day
    replaces that day only, in one commit (the notebook deletes, then inserts).
    With ``day`` given, that day's old rows go even if ``df`` has none for it.
    """
    if day is not None and df.filter(F.col(date_col) == F.lit(day)).isEmpty():
        clear_date(df.sparkSession, path, date_col, day)
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(date_col).parquet(path)


def clear_date(spark: SparkSession, path: str, date_col: str, day) -> None:
    """Drop one run date's partition (the DELETE of a day with no new rows)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{date_col}={day}")
    fs = p.getFileSystem(conf)
    if fs.exists(p):
        fs.delete(p, True)


class DatedStore:
    """A table of run days whose days are replaced whole and at once (K5).

    ``write`` puts the rows under a run folder that nobody reads yet and then
    creates one empty marker, ``commits/<day>/<number>-<run>``; creating it is
    the swap. Readers take the run of each day's highest marker, so a job that
    dies before its marker leaves the old day as it was, an empty run clears
    the day, and readers that listed the markers earlier still find their files
    until ``vacuum``. Two writers of one day: the marker of the later number
    wins, and a number is taken only once.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._at = jvm.org.apache.hadoop.fs.Path
        self._fs = self._at(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        p = self._at(f"{self.path}/{folder}")
        return sorted(x.getPath().getName() for x in self._fs.listStatus(p)) if self._fs.exists(p) else []

    def _commits(self, day: str) -> list[str]:
        return [x for x in self._names(f"commits/{day}") if not x.startswith((".", "_"))]

    def write(self, df: DataFrame, day) -> None:
        """Replace the rows of ``day`` by ``df``."""
        run = uuid.uuid4().hex[:12]
        df.write.parquet(f"{self.path}/runs/{day}/{run}")
        self._commit(str(day), run)

    def _commit(self, day: str, run: str) -> None:
        number = int(self._commits(day)[-1].split("-")[0]) if self._commits(day) else 0
        while True:
            number += 1
            if any(x.startswith(f"{number:09d}-") for x in self._commits(day)):
                continue
            if self._fs.mkdirs(self._at(f"{self.path}/commits/{day}")) and self._fs.createNewFile(self._at(f"{self.path}/commits/{day}/{number:09d}-{run}")):
                return

    def days(self) -> list[str]:
        """Days that were committed, in order; some may hold no row."""
        return [d for d in self._names("commits") if self._commits(d)]

    def read(self, before=None) -> DataFrame | None:
        """All rows (of days before ``before``); None where no day is stored."""
        found = [f"{self.path}/runs/{d}/{self._commits(d)[-1].split('-')[1]}" for d in self.days() if before is None or d < str(before)]
        return self.spark.read.option("mergeSchema", "true").parquet(*found) if found else None

    def vacuum(self) -> None:
        """Delete the runs that no day's last marker names."""
        for d in self._names("runs"):
            current = self._commits(d)[-1].split("-")[1] if self._commits(d) else None
            for run in self._names(f"runs/{d}"):
                if run != current:
                    self._fs.delete(self._at(f"{self.path}/runs/{d}/{run}"), True)


def append_history(df: DataFrame, path: str) -> None:
    """Plain append (the notebook's prediction history); not idempotent."""
    df.write.mode("append").parquet(path)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", "true").parquet(path)
