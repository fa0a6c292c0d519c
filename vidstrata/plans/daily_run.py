"""One run over the drops: documents, channels, bronze, silver, gold, audit.

``as_of`` names the run. Repeating a run, in whole or after a crash at any point, changes nothing:
every batch is named by the run and every stage skips what is committed.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vidstrata.operators import increments, quality
from vidstrata.operators import normalize as n
from vidstrata.operators.audit import Audit, Counts
from vidstrata.operators.keys import first_by_key, unseen
from vidstrata.operators.upsert import number_rows, upsert_channels
from vidstrata.plans.tables import Tables, bucket_of
from vidstrata.session import remove_folder, size_shuffles
from vidstrata.sources import channel_csv, files, json_lines
from vidstrata.streaming import silver_view


# A batch of documents from more days is stored in folders of months.
MANY_DAYS = 62
# How parsed lines are written that are read three times and deleted: only the path repeats from row to row.
STAGED_LINES = {"parquet.enable.dictionary": "false", "parquet.enable.dictionary#source_path": "true"}


@dataclass(frozen=True)
class Run:
    """What a run takes in: JSON files modified in [since, until), CSV drops dated up to as_of."""

    as_of: dt.datetime
    json_root: str | None = None
    csv_root: str | None = None
    since: dt.datetime | None = None
    until: dt.datetime | None = None
    created_since: dt.datetime | None = None
    dialect: str = "daily"
    json_suffix: str = ".json"

    @property
    def batch(self) -> str:
        return files.utc(self.as_of).strftime("%Y%m%dT%H%M%S")


def append_documents(tables: Tables, lines: DataFrame, batch: str, dialect: str) -> Counts:
    """Normalise, keep refused lines apart, and store documents whose ``_id`` is new.

    The parsed lines are written once and read three times, so no line is parsed twice; what was written
    for that goes when the batch is committed. It holds the text of refused lines only, and no dictionaries: building
    those cost more than a third of the write. A batch that is there is not read again. Which ids are stored
    is told by a table of ids in hash folders, of which only those are read that the new ids fall into.
    """
    if tables.holds("documents", batch):
        return Counts(skipped=True)
    if not tables.batches("document_keys") and tables.batches("documents"):  # a root from before there were ids
        tables.replace({"document_keys": tables.read("documents").select("_id")})
    size_shuffles(tables.spark, lines, tables.read("document_keys"))
    staging = f"{tables.root}/staging/documents/batch={batch}"
    parsed = n.normalize(lines, dialect, unit=False).withColumn("value", F.when(F.col("reason").isNotNull(), F.col("value")))
    parsed.write.options(**STAGED_LINES).mode("overwrite").parquet(staging)
    staged = tables.spark.read.parquet(staging)
    bad = n.rejected(staged)
    good = n.accepted(staged, *json_lines.LINE_ORDER)
    firsts = first_by_key(good, ["_id"], list(json_lines.LINE_ORDER), keep=n.accepted(staged).columns)
    # a row for each bucket and day first, which is a hash aggregate of fixed width
    seen = good.select(bucket_of("_id").cast("int").alias("bucket"), F.to_date("created_at").alias("day")).distinct()
    buckets = F.collect_set(F.col("bucket").cast("string"))  # BUCKETS at most
    keys = seen.agg(buckets.alias("buckets"), F.count_distinct("day").alias("days")).first()
    new = unseen(firsts, tables.read_parts("document_keys", keys["buckets"]), ["_id"])
    noted = f"json-{batch}"
    held = tables.holds("rejects", noted)  # by a run that was cut off between the two commits
    rejected = tables.read_batch("rejects", noted).count() if held else tables.append("rejects", bad, noted)
    stored = tables.append_all(
        {"documents": new},
        batch,
        then=lambda written: {"document_keys": written["documents"].select("_id")},
        derived=("document_keys",),
        by_month=keys["days"] > MANY_DAYS,
    )
    counts = Counts(rows_in=staged.count(), rows_rejected=rejected, rows_out=stored["documents"])
    remove_folder(tables.spark, staging)
    return counts


def append_videos(tables: Tables, batch: str, created_since=None) -> Counts:
    """This batch's documents as bronze videos, optionally only those created since a time."""
    if tables.holds("bronze_videos", batch):
        return Counts(skipped=True)
    documents = tables.read_batch("documents", batch)
    taken = documents
    if created_since is not None:
        first, _ = increments.days_of(created_since)
        taken = increments.between(tables.read_range("documents", first, batch=batch), created_since)
    return Counts(
        rows_in=documents.count(),
        rows_out=tables.append("bronze_videos", n.flatten(taken), batch),
    )


def reload_videos(tables: Tables) -> None:
    """All documents as bronze videos, one per ``_id``, in place of what is there."""
    documents = tables.read("documents")
    order = ["created_at", "update_count"]
    videos = n.flatten(increments.snapshot(documents, order))
    # a later run of any of these batches must not add its documents once more
    tables.replace({"bronze_videos": videos}, folded={"bronze_videos": tables.batches("documents")})


def load_channel_drops(tables: Tables, root: str, as_of, batch: str) -> Counts:
    """Upsert the due CSV drops and mark them; both become visible by one commit.

    Each drop stands for itself: one without a date, without content or without a required column is refused with its
    reason and noted in ``csv_refused``, the others are loaded. A refused drop comes up again when it is changed.

    The folders of the due drops are read once, as lines, and joined with the names that are due. Of the channel table
    only the hash folders are read and written that the drops' usernames fall into.
    """
    spark = tables.spark
    ledger, refused = tables.read("csv_files"), tables.read("csv_refused")
    name = f"{batch}-{tables.number():012d}"
    staging = f"{tables.root}/staging/channels/batch={batch}"

    def stage(purpose: str):
        def write(df: DataFrame) -> DataFrame:
            df.write.mode("overwrite").parquet(f"{staging}/{purpose}")
            return spark.read.schema(df.schema).parquet(f"{staging}/{purpose}")

        return write

    pending = files.pending_drops(spark, root, ledger, as_of, refused=refused).where("state <> 'future'")
    pending = stage("drops")(pending.select("path", "key", "modified", "length", "state"))
    full = pending.where("state = 'due' AND length > 0")
    folders = [row["folder"] for row in full.select(F.regexp_replace("path", "/[^/]*$", "").alias("folder")).distinct().collect()]
    if folders:
        lines = channel_csv.read_lines(spark, folders, full)
        size_shuffles(spark, tables.read("channels"), spark.read.text(folders))
        lines = stage("lines")(lines)
        found = stage("headers")(channel_csv.placed(channel_csv.headers(lines)))
    else:
        found = spark.createDataFrame([], "source_path string, missing string")
    # the state of each drop: done, or refused with a reason
    looked_at = pending.join(found.select(F.col("source_path").alias("path"), "missing"), "path", "left")
    reason = (
        F.when(F.col("state") == "invalid", "no date in key")
        .when(F.col("missing").isNull(), "no lines")
        .when(F.col("missing") != "", F.concat(F.lit("missing columns: "), "missing"))
    )
    drops = stage("states")(looked_at.withColumn("reason", reason).select("path", "key", "modified", "reason"))
    bad = drops.where("reason IS NOT NULL")
    done = drops.where("reason IS NULL").select(F.col("key").alias("file_name"), F.lit(True).alias("inserted"))
    appended = {
        "csv_refused": bad.select(F.col("key").alias("file_name"), "modified", "reason"),
        "rejects": bad.select(F.col("path").alias("source"), F.col("key").alias("raw"), "reason"),
    }
    loaded, replaced = done.count(), {}
    if loaded:
        rows = channel_csv.rows_of(lines, found.where("missing = ''"))
        good, broken = channel_csv.daily_rows(rows, stage("rows"))
        touched = [row["b"] for row in good.select(bucket_of("username").alias("b")).distinct().collect()]  # BUCKETS at most
        known = tables.read_parts("channels", touched)
        after = upsert_channels(known, good, stage=stage("merged"), last_id=tables.highest("channels", "id"))
        appended |= {"csv_files": done, "rejects": appended["rejects"].unionByName(broken)}
        replaced = {"channels": (after, touched)} if touched else {}
    stored = tables.change(appended, replaced, name, watermark_of="id")
    remove_folder(spark, staging)
    return Counts(rows_in=loaded, rows_out=stored.get("channels", 0), rows_rejected=stored["rejects"])


def bulk_load_channels(tables: Tables, path: str, strict: bool = True) -> Counts:
    """The one-off load of the channel table.

    ``strict`` fails on any broken constraint, as the store's bulk copy does; otherwise bad rows go
    to the rejects and the first row of a repeated username stays.
    """
    raw = channel_csv.read_bulk(tables.spark, path)
    rows = channel_csv.bulk_channels(raw)
    rejected = 0
    if strict:
        quality.require(rows)
    else:
        origin = raw.select(*channel_csv.ROW_ORDER, *rows.columns[:-1])
        typed = origin.select(
            *channel_csv.ROW_ORDER,
            *[F.col(c).try_cast(rows.schema[c].dataType).alias(c) for c in rows.columns[:-1]],
        ).withColumn("created_at", F.lit(channel_csv.BULK_CREATED_AT).cast("timestamp"))
        good, broken = quality.split_rows(typed)
        rejects = broken.select(
            F.col("source_path").alias("source"),
            F.to_json(F.struct(*channel_csv.BULK_COLUMNS)).alias("raw"),
            F.col("rule").alias("reason"),
        )
        rejected = tables.append("rejects", rejects, "bulk-channels")
        rows = first_by_key(good, ["username"], list(channel_csv.ROW_ORDER)).select(rows.columns)
    loaded = tables.replace({"channels": number_rows(rows, "username", 0)}, watermark_of="id")
    return Counts(
        rows_in=raw.count(), rows_out=loaded["channels"], rows_rejected=rejected
    )


def copy_channels(tables: Tables, mode: str = "keyset") -> Counts:
    """Channels to bronze: rows above the watermark, or all of them again.

    A channel keeps its id when a drop updates it, so ``keyset`` never carries updates over; use
    ``full`` for those. The batch is named by the watermark it starts from, so a repeat after a
    crash overwrites it, and the watermark moves by the commit that makes the batch final.
    """
    channels = tables.read("channels")
    if mode == "full":
        rows = tables.replace({"bronze_channels": channels}, watermark_of="id")
        return Counts(rows_out=rows["bronze_channels"])
    last = int(tables.watermark("bronze_channels") or 0)
    new = increments.after_key(channels, last)
    return Counts(
        rows_out=tables.append("bronze_channels", new, f"after-{last:012d}", watermark_of="id")
    )


def run(spark: SparkSession, root: str, run: Run, attempts: int = 2) -> DataFrame:
    """All stages in order; returns the audit rows of this run and stores them."""
    tables = Tables(spark, root)
    audit = Audit(spark, run.batch)

    def events() -> Counts:
        return Counts(rows_out=silver_view.refresh(tables, files.utc(run.as_of).date()))

    try:
        if run.json_root:
            lines = json_lines.read_lines(
                spark, run.json_root, run.since, run.until, run.json_suffix
            )
            audit.stage(
                "documents",
                lambda: append_documents(tables, lines, run.batch, run.dialect),
                attempts,
            )
            audit.stage(
                "bronze_videos",
                lambda: append_videos(tables, run.batch, run.created_since),
                attempts,
            )
        if run.csv_root:
            audit.stage(
                "channels",
                lambda: load_channel_drops(tables, run.csv_root, run.as_of, run.batch),
                attempts,
            )
        audit.stage("bronze_channels", lambda: copy_channels(tables), attempts)
        audit.stage("silver_and_gold", events, attempts)
    finally:
        started = dt.datetime.now(dt.timezone.utc)
        rows = audit.rows()
        tables.append("run_audit", rows, f"{run.batch}-{started:%Y%m%dT%H%M%S%f}")
    return rows
