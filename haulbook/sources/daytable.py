"""A report table in day folders, listed by a manifest: a window of days is replaced in one step."""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from haulbook.sources.sinks import conform

NO_DAY = "none"            # folder name of the rows without a date


class DayTable:
    """Rows of one schema, in one folder per day of ``day_col``.

    ``path/data/_set=<id>/_day=<ISO day>`` holds files that never change; ``path/manifest/<number>`` lists the live folders,
    one entry a day, and the highest number is the table. A replace writes new folders first and the next manifest last,
    under a name that can be taken once. A run that breaks off leaves the old table as it was, a reader keeps
    the folders it started with, and of two writers at a time one is refused.
    """

    def __init__(self, spark: SparkSession, path: str, day_col: str):
        self.spark, self.root, self.day_col = spark, path.rstrip("/"), day_col

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    def _fs(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, *parts: str) -> list[str]:
        folder, fs = self._path(*parts), self._fs()
        return sorted(s.getPath().getName() for s in fs.listStatus(folder)) if fs.exists(folder) else []

    def version(self) -> int:
        """Number of the current manifest, 0 before the first write."""
        return max((int(n) for n in self._names("manifest") if n.isdigit()), default=0)

    def _manifest(self, version: int) -> dict:
        stream = self._fs().open(self._path("manifest", f"{version:08d}"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _commit(self, version: int, manifest: dict) -> None:
        draft = self._path("manifest", f"draft-{uuid.uuid4().hex}")
        out = self._fs().create(draft, False)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        jvm, gateway = self.spark._jvm, self.spark.sparkContext._gateway
        plain = gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)   # refuses a name that exists
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), self.spark._jsc.hadoopConfiguration())
        files.rename(draft, self._path("manifest", f"{version:08d}"), plain)

    def days(self) -> list[str]:
        """Days with rows, as ISO text; ``none`` stands for rows without a date."""
        version = self.version()
        return sorted(self._manifest(version)["days"]) if version else []

    def read(self, version: int | None = None) -> DataFrame:
        """The table of the current manifest, or of an older one whose folders are still there."""
        manifest = self._manifest(version or self.version())
        schema = T.StructType.fromJson(manifest["schema"])
        live: dict[str, set[str]] = {}
        for day, folder in manifest["days"].items():
            live.setdefault(folder.split("/")[0], set()).add(day)
        if not live:
            return self.spark.createDataFrame([], schema)
        full = T.StructType([*schema.fields, T.StructField("_set", T.StringType()), T.StructField("_day", T.StringType())])
        rows = self.spark.read.schema(full).option("basePath", f"{self.root}/data").parquet(*[f"{self.root}/data/{s}" for s in live])
        # Folders of days that a later set replaced are pruned by their names, before any file is opened.
        for name, days in live.items():
            gone = sorted({n.partition("=")[2] for n in self._names("data", name) if n.startswith("_day=")} - days)
            if gone:
                rows = rows.filter((F.col("_set") != name.partition("=")[2]) | ~F.col("_day").isin(gone))
        return rows.select(*schema.names)

    def _write(self, new: DataFrame) -> dict[str, str]:
        """Write day folders under a new id; which days got rows is read from the folder names."""
        folder = f"_set={uuid.uuid4().hex}"
        day = F.coalesce(F.date_format(F.to_date(self.day_col), "yyyy-MM-dd"), F.lit(NO_DAY))
        # Days are brought together, and a day with very many rows is split by its size.
        new.withColumn("_day", day).hint("rebalance", "_day").write.partitionBy("_day").parquet(f"{self.root}/data/{folder}")
        return {n.partition("=")[2]: f"{folder}/{n}" for n in self._names("data", folder) if n.startswith("_day=")}

    def replace(self, new: DataFrame, first=None, last=None) -> int:
        """Replace the days first … last, both included, by the new rows; all days, and rows without one, where no window is given.

        ``new`` is evaluated once. Days of the window that get no row are gone afterwards; rows without a date stay
        when a window is given. New rows outside the window, other columns than the table's, and values that do not
        fit their column are refused, and nothing changes then. Returns the new version.
        """
        version = self.version()
        old = self._manifest(version) if version else {"days": {}}
        if version:
            schema = T.StructType.fromJson(old["schema"])
            if set(new.columns) - set(schema.names):
                raise ValueError(f"the table has no {', '.join(sorted(set(new.columns) - set(schema.names)))}")
            new = conform(new, schema)
        written = self._write(new)
        keep = {}
        if first is not None and last is not None:
            low, high = (str(d)[:10] for d in (first, last))
            dt.date.fromisoformat(low), dt.date.fromisoformat(high)
            outside = [d for d in written if d == NO_DAY or not low <= d <= high]
            if outside:
                raise ValueError(f"new rows lie outside {low} … {high}: {outside[:5]}")
            keep = {d: f for d, f in old["days"].items() if d == NO_DAY or not low <= d <= high}
        self._commit(version + 1, {"schema": json.loads(new.schema.json()), "days": keep | written})
        return version + 1

    def remove_unlisted(self) -> int:
        """Delete folders and manifests that the current manifest does not need; run it when no reader or writer is at work."""
        version = self.version()
        live = {f.split("/")[0] for f in self._manifest(version)["days"].values()} if version else set()
        gone = [self._path("data", n) for n in self._names("data") if n not in live]
        gone += [self._path("manifest", n) for n in self._names("manifest") if n != f"{version:08d}"]
        for p in gone:
            self._fs().delete(p, True)
        return len(gone)


def replace_days(new: DataFrame, path: str, day_col: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Replace the days start … end (ISO dates) of the day table at ``path``, or all of it, and read the result."""
    table = DayTable(new.sparkSession, path, day_col)
    return table.read(table.replace(new, start, end))
