"""Tables as parquet folders, with a small commit table beside them.

Layout: ``<root>/<table>/v=<version>/batch=<name>[/<part>=<value>]/*.parquet`` and ``<root>/commits``. Three
kinds of write, all safe to repeat after a crash:

- ``append`` writes one named batch. A repeat of the same batch overwrites its folder, so rows are
  never stored twice; once committed the batch is not written again, under this version or a later
  one. Readers see committed batches only.
- ``replace`` writes complete new versions of one or more tables and then commits them together by
  one row file. Until then readers see the old versions of all of them.
- ``change`` replaces single parts (months, days or hash folders) of a table beside appends to others. The files
  of all other parts stay as they are; readers leave out a part's folders below its newest version. Spark's own
  overwrite of single folders deletes the old one before the new one is in place, so a crash between the two
  would lose rows; here both stand side by side until the commit.

All may write tables derived from the ones just written, and commit all of them together. A commit can
also name batches that its rows take in without a folder of their own (``folded``): those count as there.
Watermarks travel in the commit rows, so they can not run ahead of the data. Commits are numbered; one
job at a time may write to a root. The commit rows (one for each load and table) are read into the driver by
one job after each commit.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from operator import and_

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vidstrata import schemas
from vidstrata.functions.datetimes import month_key
from vidstrata.session import list_folder

COMMITS = {
    "table": "string",
    "version": "int",
    "batch": "string",
    "watermark": "string",
    "number": "bigint",
    "folded": "boolean",
    "kind": "string",
    "parts": "array<string>",
    "committed_at": "timestamp",
}

# Marks the views that register() has made.
OWN = "vidstrata.root"

# Per table: columns that rows are sorted by inside a file.
SORT_KEYS = {
    "documents": ("created_at", "_id"),
    "document_keys": ("_id",),
    "channels": ("id",),
    "bronze_videos": ("id",),
    "bronze_channels": ("id",),
    "silver_events": ("channel_id", "video_id"),
    "silver_waiting": ("owner_username", "id"),
    "gold_channel_growth": ("channel_username", "date"),
    "gold_top_channels": ("channel_username", "date"),
    "gold_video_engagement": ("video_id", "date"),
    "gold_content_popularity": ("tag", "date"),
    "gold_geographic_distribution": ("country", "date"),
    "gold_channel_activity_trends": ("channel_username", "created_date"),
}
# Hash folders: an increment reads and rewrites only those that its keys fall into.
BUCKETS = 64


def bucket_of(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("string")


# Per table: the folder below the batch that a row goes to, and the column it comes from.
PARTS = {
    "documents": ("day", "created_at"),
    "document_keys": ("bucket", "_id"),
    "channels": ("bucket", "username"),
    "silver_waiting": ("bucket", "owner_username"),
} | {
    name: ("yyyymm", "created_date" if name == "gold_channel_activity_trends" else "date")
    for name in schemas.TABLES
    if name.startswith("gold_")
}


def part_of(name: str, by_month: bool = False) -> Column:
    kind, column = PARTS[name]
    if kind == "bucket":
        return bucket_of(column)
    return month_key(F.col(column)) if kind == "yyyymm" else F.date_format(column, "yyyy-MM" if by_month else "yyyy-MM-dd")


def write_sorted(df: DataFrame, path: str, name: str, by_month: bool = False):
    """Overwrite ``path``; rows sorted inside each file so row-group statistics can skip.

    Rows of a table with parts go to one folder for each. They are rebalanced by part first, so a part is a few
    well-filled files; AQE cuts one that is too large for one task. Days are dealt by ranges of time instead,
    so that the files of a large day follow each other in time; the ranges are sampled, so ``df`` is computed twice up
    to its last shuffle. ``by_month`` gives folders of months to a batch that has rows of very many days, which would
    be as many small files; months are rebalanced, and sorted by time inside a file.
    """
    kind, sort_key = PARTS.get(name, (None, None))[0], SORT_KEYS.get(name, ())
    if kind:
        df = df.withColumn(kind, part_of(name, by_month))
        df = df.repartitionByRange(*sort_key) if kind == "day" and not by_month else df.hint("rebalance", F.col(kind))
        sort_key = (kind, *sort_key)
    if sort_key:
        df = df.sortWithinPartitions(*sort_key)
    writer = df.write.mode("overwrite")
    if kind:
        writer = writer.partitionBy(kind)
    writer.parquet(path)


class Tables:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._files: list[str] | None = None
        self._log: list = []

    # --- commits -------------------------------------------------------------------------------

    def log(self) -> list:
        """The commit rows; read again when the folder has other files than last time."""
        files = list_folder(self.spark, f"{self.root}/commits")
        if files != self._files:
            rows = self.spark.read.schema(schemas.ddl(COMMITS)).parquet(f"{self.root}/commits").collect() if files else []
            self._files, self._log = files, rows
        return self._log

    def _rows(self, name: str) -> list:
        return [row for row in self.log() if row["table"] == name]

    def _commit(self, rows: list[tuple], folded: dict[str, list[str]] | None = None) -> None:
        """One file with a row (table, version, batch, watermark, kind, parts) for each table, and the folded names."""
        number, now = self.number() + 1, dt.datetime.now(dt.timezone.utc).isoformat()
        full = [(t, v, batch, mark, number, False, kind, parts, now) for t, v, batch, mark, kind, parts in rows]
        version = {row[0]: row[1] for row in rows}
        for name, batches in (folded or {}).items():
            full += [(name, version[name], batch, None, number, True, "append", None, now) for batch in batches]
        text = json.dumps([dict(zip(COMMITS, row, strict=True)) for row in full])
        rows = self.spark.range(1, numPartitions=1).select(F.inline(F.from_json(F.lit(text), f"array<struct<{schemas.ddl(COMMITS)}>>")))
        rows.write.mode("append").parquet(f"{self.root}/commits")

    def number(self) -> int:
        """Of the last commit."""
        return max((row["number"] for row in self.log()), default=0)

    def version(self, name: str) -> int:
        return max((row["version"] for row in self._rows(name)), default=0)

    def _whole(self, name: str) -> int:
        """The version that was last written as a whole; rows without a kind are of before there were parts."""
        return max((r["version"] for r in self._rows(name) if r["kind"] == "replace" or r["kind"] is None), default=0)

    def _newest(self, name: str) -> dict[str, int]:
        """Of each part replaced since then, the version that holds it."""
        found: dict[str, int] = {}
        for row in self._rows(name):
            if row["kind"] == "parts" and row["version"] > self._whole(name):
                found |= {p: max(row["version"], found.get(p, 0)) for p in row["parts"]}
        return found

    def holds(self, name: str, batch: str) -> bool:
        """Whether the batch was ever committed: a later version was made from the ones before it."""
        return any(row["batch"] == batch for row in self._rows(name))

    def batches(self, name: str, current: bool = False) -> list[str]:
        """All names ever committed, or those with a folder that is read now."""
        rows = self._rows(name)
        if current:
            rows = [row for row in rows if row["version"] >= self._whole(name) and not row["folded"]]
        return sorted({row["batch"] for row in rows})

    def watermark(self, name: str) -> str | None:
        rows = [row for row in self._rows(name) if row["watermark"] is not None]
        return max(rows, key=lambda row: row["number"])["watermark"] if rows else None

    def highest(self, name: str, column: str) -> int:
        """The largest value of a column that commits note as the watermark; counted where none does."""
        marks = [r["watermark"] for r in self._rows(name) if r["version"] >= self._whole(name) and r["watermark"] is not None]
        if marks:
            return max(map(int, marks))
        return self.read(name).agg(F.max(column)).first()[0] or 0

    def grown_parts(self, name: str) -> list[str] | None:
        """Parts that more than one write has added to; None if the log does not tell."""
        newest, counts = self._newest(name), {}
        for row in self._rows(name):
            if row["version"] >= self._whole(name) and not row["folded"]:
                if row["parts"] is None:
                    return None
                for part in row["parts"]:
                    if row["version"] >= newest.get(part, 0):
                        counts[part] = counts.get(part, 0) + 1
        return sorted(part for part, n in counts.items() if n > 1)

    # --- reading -------------------------------------------------------------------------------

    def path(self, name: str, version: int | None = None) -> str:
        return f"{self.root}/{name}/v={self.version(name) if version is None else version}"

    def _stored(self, name: str) -> DataFrame:
        """The committed batches of the current versions; folders of cut-off writes are skipped."""
        part = PARTS.get(name, (None, None))[0]
        columns = schemas.TABLES[name] | {"v": "int", "batch": "string"} | ({part: "string"} if part else {})
        live = {(r["version"], r["batch"]) for r in self._rows(name) if r["version"] >= self._whole(name) and not r["folded"]}
        if not live:
            return self.spark.createDataFrame([], schemas.ddl(columns)).limit(0)
        paths = [self.path(name, version) for version in sorted({v for v, _ in live})]
        df = self.spark.read.schema(schemas.ddl(columns)).option("basePath", f"{self.root}/{name}").parquet(*paths)
        for version in sorted({v for v, _ in live}):
            folders = {f.removeprefix("batch=") for f in list_folder(self.spark, self.path(name, version)) if f.startswith("batch=")}
            cut_off = folders - {b for v, b in live if v == version}
            if cut_off:
                df = df.where(~((F.col("v") == version) & F.col("batch").isin(sorted(cut_off))))
        newest = self._newest(name)
        for version in sorted(set(newest.values())):
            parts = [p for p, v in newest.items() if v == version]
            df = df.where(~(F.col(part).isin(parts) & (F.col("v") < version)))
        return df

    def read(self, name: str, without_batch: str | None = None, only: list[str] | None = None) -> DataFrame:
        """The table, without one batch, or only the committed batches named."""
        df = self._stored(name)
        if without_batch is not None:
            df = df.where(F.col("batch") != without_batch)
        if only is not None:
            df = df.where(F.col("batch").isin(only))
        return df.select(*schemas.TABLES[name])

    def read_batch(self, name: str, batch: str) -> DataFrame:
        return self._stored(name).where(F.col("batch") == batch).select(*schemas.TABLES[name])

    def read_parts(self, name: str, parts: list[str]) -> DataFrame:
        """The rows of some parts; other folders are not read."""
        return self._stored(name).where(F.col(PARTS[name][0]).isin(parts)).select(*schemas.TABLES[name])

    def read_range(self, name: str, first: str | None = None, last: str | None = None, batch: str | None = None) -> DataFrame:
        """A table by months (``yyyyMM``) or days (``yyyy-MM-dd``), both ends included, other folders not read.

        A filter on the time alone prunes nothing, so the folder is filtered here.
        """
        df, part = self._stored(name), F.col(PARTS[name][0])
        bounds = []
        if first is not None:
            # a folder of a whole month, among those of days, holds days from the first on if its month does
            month = (F.length(part) == 7) & (part >= first[:7]) if PARTS[name][0] == "day" else F.lit(False)
            bounds.append((part >= first) | month)
        bounds += [part <= last] if last is not None else []
        bounds += [F.col("batch") == batch] if batch is not None else []
        return (df.where(reduce(and_, bounds)) if bounds else df).select(*schemas.TABLES[name])

    def read_months(self, name: str, first: str | None = None, last: str | None = None) -> DataFrame:
        return self.read_range(name, first, last)

    # --- writing -------------------------------------------------------------------------------

    def _write(self, name: str, df: DataFrame, version: int, batch: str, watermark_of: str | None, by_month: bool = False):
        """Write one batch folder; returns its row count, watermark and parts.

        All are read back from the written files: counters kept while a job runs may count a task
        twice when its executor is lost.
        """
        path = f"{self.path(name, version)}/batch={batch}"
        write_sorted(schemas.conform(df, schemas.TABLES[name]), path, name, by_month)
        part = PARTS.get(name, (None, None))[0]
        columns = schemas.TABLES[name] | ({part: "string"} if part else {})
        written = self.spark.read.schema(schemas.ddl(columns)).parquet(path)
        top = F.max(watermark_of).cast("string") if watermark_of in columns else F.lit(None).cast("string")
        parts = F.sort_array(F.collect_set(part)) if part else F.lit(None)
        return tuple(written.agg(F.count(F.lit(1)), top, parts).first())

    def _write_all(self, new: dict[str, DataFrame], versions: dict[str, int], batch, watermark_of, by_month=False):
        """Independent tables are written side by side, so small ones do not leave executors idle."""

        def write(name: str):
            return self._write(name, new[name], versions[name], batch, watermark_of, by_month)

        if len(new) == 1:
            return {name: write(name) for name in new}
        with ThreadPoolExecutor(len(new)) as pool:
            target = inheritable_thread_target(self.spark)(write)
            return dict(zip(new, pool.map(target, new)))

    def _store(self, new, kinds, batch, watermark_of=None, then=None, folded=None, parts=None, least_mark=None, by_month=False) -> dict[str, int]:
        """Write and commit; ``kinds`` has every table to write, derived ones included."""
        versions = {name: self.version(name) + (kind != "append") for name, kind in kinds.items()}
        written = self._write_all(new, versions, batch, watermark_of, by_month) if new else {}
        if then and new:
            more = then({name: self._written(name, versions[name], batch) for name in new})
            more = {name: df for name, df in more.items() if name in versions}
            written |= self._write_all(more, versions, batch, None) if more else {}
        folded = {name: names for name, names in (folded or {}).items() if name in written}
        commits = []
        for name, (rows, mark, own) in written.items():
            if rows or kinds[name] != "append" or name in folded:
                if mark is not None and name in (least_mark or {}):
                    mark = str(max(int(mark), least_mark[name]))
                commits.append((name, versions[name], batch, mark, kinds[name], (parts or {}).get(name, own)))
        if commits:
            self._commit(commits, folded)
        return {name: rows for name, (rows, _, _) in written.items()}

    def _written(self, name: str, version: int, batch: str) -> DataFrame:
        path = f"{self.path(name, version)}/batch={batch}"
        return self.spark.read.schema(schemas.ddl(schemas.TABLES[name])).parquet(path)

    def append_all(
        self,
        new: dict[str, DataFrame],
        batch: str,
        watermark_of: str | None = None,
        then: Callable[[dict[str, DataFrame]], dict[str, DataFrame]] | None = None,
        derived: tuple[str, ...] = (),
        folded: dict[str, list[str]] | None = None,
        by_month: bool = False,
    ) -> dict[str, int]:
        """Store one batch of each table and return the row counts.

        A batch that is there already is skipped; 0 rows leave no commit and no watermark, unless they
        fold names. ``then`` gives the tables ``derived`` from what was written.
        """
        kinds = {name: "append" for name in [*new, *derived] if not self.holds(name, batch)}
        todo = {name: df for name, df in new.items() if name in kinds}
        written = self._store(todo, kinds, batch, watermark_of, then, folded, by_month=by_month)
        return {name: written.get(name, 0) for name in new}

    def append(
        self, name: str, df: DataFrame, batch: str, watermark_of: str | None = None
    ) -> int:
        return self.append_all({name: df}, batch, watermark_of)[name]

    def replace(
        self,
        new: dict[str, DataFrame],
        batch: str = "base",
        watermark_of: str | None = None,
        then: Callable[[dict[str, DataFrame]], dict[str, DataFrame]] | None = None,
        derived: tuple[str, ...] = (),
        folded: dict[str, list[str]] | None = None,
    ) -> dict[str, int]:
        """New complete versions of the given tables and those derived from them, visible together."""
        kinds = {name: "replace" for name in [*new, *derived]}
        return self._store(new, kinds, batch, watermark_of, then, folded)

    def change(
        self,
        appended: dict[str, DataFrame],
        replaced: dict[str, tuple[DataFrame, list[str]]],
        batch: str,
        watermark_of: str | None = None,
        then: Callable[[dict[str, DataFrame]], dict[str, DataFrame]] | None = None,
        derived: tuple[str, ...] = (),
        folded: dict[str, list[str]] | None = None,
    ) -> dict[str, int]:
        """Appends to some tables and new parts of others, given as (rows, parts), visible together.

        A part that is named and has no rows is empty from then on. Where parts carry a watermark, it never falls.
        """
        kinds = {name: "append" for name in [*appended, *derived]} | {name: "parts" for name in replaced}
        parts = {name: sorted(of) for name, (_, of) in replaced.items()}
        least = {name: self.highest(name, watermark_of) for name in replaced if watermark_of in schemas.TABLES[name]}
        new = appended | {name: df for name, (df, _) in replaced.items()}
        return self._store(new, kinds, batch, watermark_of, then, folded, parts, least)

    # --- catalog -------------------------------------------------------------------------------

    def register(self, prefix: str = "") -> list[str]:
        """Views of the tables in the session's catalog; they always show what is committed.

        Layers are databases (``<prefix>bronze``, ...); the other tables go to ``<prefix>lake``, or to the current
        database if there is no prefix. A view or table of the same name that this method has not made is left alone,
        and the call fails. Returns the databases made.
        """
        made = []
        for layer in ("bronze", "silver", "gold", *(["lake"] if prefix else [])):
            if not self.spark.catalog.databaseExists(f"{prefix}{layer}"):
                self.spark.sql(f"CREATE DATABASE `{prefix}{layer}`")
                made.append(f"{prefix}{layer}")
        for name, columns in schemas.TABLES.items():
            layer, _, short = name.partition("_")
            if layer in ("bronze", "silver", "gold"):
                target = f"`{prefix}{layer}`.`{short}`"
            else:
                target = f"`{prefix}lake`.`{name}`" if prefix else f"`{name}`"
            if self.spark.catalog.tableExists(target) and not self._is_own(target):
                raise ValueError(f"{target} exists and is not a view of this library")
            self.spark.sql(f"CREATE OR REPLACE VIEW {target} TBLPROPERTIES ('{OWN}' = '{self.root}') AS {self._view(name, columns)}")
        return made

    def _is_own(self, target: str) -> bool:
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {target}").collect()
        return any(row["key"] == OWN for row in rows)

    def _view(self, name: str, columns: dict[str, str]) -> str:
        if not self._rows(name):
            cells = ", ".join(f"CAST(NULL AS {kind}) AS `{c}`" for c, kind in columns.items())
            return f"SELECT {cells} WHERE false"
        log = f"(SELECT * FROM parquet.`{self.root}/commits` WHERE table = '{name}')"
        whole = f"(SELECT coalesce(max(version), 0) FROM {log} WHERE coalesce(kind, 'replace') = 'replace')"
        # names of batches can look like numbers and lose their zeros as folders, so they are read from the path
        batch = "url_decode(replace(regexp_extract(_metadata.file_path, '.*/batch=([^/]*)/', 1), '+', '%2B'))"
        hidden = ""
        if name in PARTS:
            newer = f"(SELECT version, explode(parts) AS part FROM {log} WHERE kind = 'parts')"
            hidden = f"""AND NOT EXISTS (SELECT 1 FROM {newer} AS n
                WHERE n.part = CAST(t.`{PARTS[name][0]}` AS string) AND n.version > t.v)"""
        return f"""SELECT {", ".join(f"`{c}`" for c in columns)} FROM (
            SELECT *, {batch} AS _batch FROM parquet.`{self.root}/{name}`) AS t
            WHERE v >= {whole} AND EXISTS (SELECT 1 FROM {log} AS l WHERE l.version = t.v AND l.batch = t._batch AND NOT l.folded) {hidden}"""
