"""Every operator as a named query over the test tables: ``name -> (spark, sf_dir) -> DataFrame``.

Queries that need files or stored tables write them under the session's shared folder first. All
of them run over whole tables.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vidstrata import schemas
from vidstrata.functions import coerce, datetimes
from vidstrata.operators import audit, increments, quality, upsert
from vidstrata.operators import normalize as n
from vidstrata.operators import reports as r
from vidstrata.operators.keys import first_by_key, unseen
from vidstrata.operators.silver import silver_events as joined_events
from vidstrata.operators.states import Distinct
from vidstrata.plans import binding, daily_run, gold, sample_lines
from vidstrata.plans.tables import Tables
from vidstrata.session import size_shuffles, tune, work_dir
from vidstrata.sources import channel_csv, files, json_lines
from vidstrata.streaming import intake, silver_view

AS_OF = "2025-07-01"
# The drops of the file queries are cut at these days of the events table.
DROP_DAYS = ("2024-01-10", "2024-01-20", "2024-02-01")
DROPS_AS_OF = "2024-01-25 00:00:00"
CREATED_CUTS = ("1997-01-01", "1999-07-01")
CHANNEL_CUT = "2025-04-01"

QUERIES = {}


def query(build):
    """Register ``build`` under its own name, run on a tuned session with portable output."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        tune(spark)
        # the two largest tables the queries read
        sizes = [binding.table(spark, sf_dir, name) for name in ("orders", "lineitem")]
        size_shuffles(spark, *sizes)
        return portable(build(spark, sf_dir))

    QUERIES[build.__name__] = run
    return build


def portable(df: DataFrame) -> DataFrame:
    """Dates and times as text and doubles rounded, so that any client compares them alike."""
    forms = {
        T.DateType: "date_format(`{0}`, 'yyyy-MM-dd')",
        T.TimestampType: "date_format(`{0}`, 'yyyy-MM-dd HH:mm:ss.SSS')",
        T.TimestampNTZType: "date_format(`{0}`, 'yyyy-MM-dd HH:mm:ss.SSS')",
        T.DoubleType: "round(`{0}`, 6)",
    }
    return df.selectExpr(
        *[
            f"{forms.get(type(f.dataType), '`{0}`').format(f.name)} AS `{f.name}`"
            for f in df.schema.fields
        ]
    )


def new_tables(spark: SparkSession) -> Tables:
    return Tables(spark, work_dir(spark, "tables"))


# --- bronze and silver -----------------------------------------------------------------------------


@query
def bronze_channels(spark, sf_dir):
    return binding.channels(spark, sf_dir)


@query
def bronze_videos(spark, sf_dir):
    return binding.videos(spark, sf_dir)


@query
def silver_events(spark, sf_dir):
    return binding.silver(spark, sf_dir)


@query
def silver_events_spread(spark, sf_dir):
    """The same join the way it runs when the channels do not fit a broadcast."""
    never = 1 << 62
    return binding.silver(spark, sf_dir, right_bytes=never)


# --- reports ---------------------------------------------------------------------------------------


def _report(spark, sf_dir, report: r.Report, limit=None) -> DataFrame:
    return report.ordered(report.one_pass(binding.silver(spark, sf_dir), AS_OF), limit)


def _in_two_parts(spark, sf_dir, report: r.Report) -> DataFrame:
    """States of silver loaded in two parts, odd and even video ids."""
    events = binding.silver(spark, sf_dir)
    part = (F.col("video_id").cast("bigint") % 2) == 0
    halves = [report.partial(events.where(x), AS_OF) for x in (part, ~part)]
    return halves[0].unionByName(halves[1])


@query
def report_channel_growth(spark, sf_dir):
    return _report(spark, sf_dir, r.CHANNEL_GROWTH)


@query
def report_channel_growth_raw_counts(spark, sf_dir):
    return r.growth_raw_counts(_in_two_parts(spark, sf_dir, r.CHANNEL_GROWTH))


@query
def report_top_channels(spark, sf_dir):
    return _report(spark, sf_dir, r.TOP_CHANNELS)


@query
def report_top_channels_all(spark, sf_dir):
    return r.TOP_CHANNELS.one_pass(binding.silver(spark, sf_dir))


@query
def report_video_engagement(spark, sf_dir):
    return _report(spark, sf_dir, r.VIDEO_ENGAGEMENT)


@query
def report_video_engagement_all(spark, sf_dir):
    return r.VIDEO_ENGAGEMENT.one_pass(binding.silver(spark, sf_dir))


@query
def report_content_popularity(spark, sf_dir):
    return _report(spark, sf_dir, r.CONTENT_POPULARITY)


@query
def report_geographic_distribution(spark, sf_dir):
    return _report(spark, sf_dir, r.GEOGRAPHIC_DISTRIBUTION)


@query
def report_geographic_channel_grain(spark, sf_dir):
    events = r.at_channel_grain(binding.silver(spark, sf_dir))
    return r.GEOGRAPHIC_DISTRIBUTION.ordered(r.GEOGRAPHIC_DISTRIBUTION.one_pass(events))


@query
def report_geographic_approx(spark, sf_dir):
    """Distinct channels from merged sketches, and whether that is within 5 % of the exact count."""
    report = r.GEOGRAPHIC_DISTRIBUTION
    estimated = report.finish(_in_two_parts(spark, sf_dir, report))
    exact = report.one_pass(binding.silver(spark, sf_dir)).select(
        "country", "date", F.col("channel_count").alias("exact")
    )
    error = F.abs(F.col("channel_count") - F.col("exact"))
    near = error <= F.greatest(F.lit(1), F.col("exact") * 0.05)
    return estimated.join(exact, ["country", "date"]).select(
        "country", "date", "total_followers", "total_video_visits", near.alias("near")
    )


@query
def report_channel_activity(spark, sf_dir):
    return _report(spark, sf_dir, r.CHANNEL_ACTIVITY)


@query
def state_merge_channel_growth(spark, sf_dir):
    return r.CHANNEL_GROWTH.finish(_in_two_parts(spark, sf_dir, r.CHANNEL_GROWTH))


@query
def state_merge_top_channels(spark, sf_dir):
    return r.TOP_CHANNELS.finish(_in_two_parts(spark, sf_dir, r.TOP_CHANNELS))


@query
def state_merge_video_engagement(spark, sf_dir):
    return r.VIDEO_ENGAGEMENT.finish(_in_two_parts(spark, sf_dir, r.VIDEO_ENGAGEMENT))


@query
def state_merge_content_popularity(spark, sf_dir):
    return r.CONTENT_POPULARITY.finish(_in_two_parts(spark, sf_dir, r.CONTENT_POPULARITY))


@query
def state_merge_geographic_distribution(spark, sf_dir):
    report = r.GEOGRAPHIC_DISTRIBUTION
    return report.finish(_in_two_parts(spark, sf_dir, report)).drop("channel_count")


@query
def state_merge_channel_activity(spark, sf_dir):
    return r.CHANNEL_ACTIVITY.finish(_in_two_parts(spark, sf_dir, r.CHANNEL_ACTIVITY))


@query
def gold_compacted(spark, sf_dir):
    """Gold tables appended in two loads, compacted, then read as the top-channels report."""
    tables = new_tables(spark)
    events = binding.silver(spark, sf_dir)
    even = (F.col("video_id").cast("bigint") % 2) == 0
    for batch, part in (("even", events.where(even)), ("odd", events.where(~even))):
        tables.append("gold_top_channels", r.TOP_CHANNELS.partial(part), batch)
    # an appended batch that is repeated adds nothing
    tables.append("gold_top_channels", r.TOP_CHANNELS.partial(events), "odd")
    gold.compact(tables, ("top_channels",))
    states = tables.read("gold_top_channels")
    rows = states.groupBy("channel_username", "date").agg(F.count(F.lit(1)).alias("states"))
    return r.TOP_CHANNELS.finish(states).join(rows, ["channel_username", "date"])


@query
def month_partitions(spark, sf_dir):
    """Stored gold states per month, each month read through its own folder."""
    tables = new_tables(spark)
    tables.append("gold_top_channels", r.TOP_CHANNELS.partial(binding.silver(spark, sf_dir)), "all")
    early = tables.read_months("gold_top_channels", last="199712")
    late = tables.read_months("gold_top_channels", first="199801")
    month = datetimes.month_key(F.col("date")).alias("yyyymm")
    return (
        early.select(F.lit("early").alias("part"), month, "total_video_visits")
        .unionByName(late.select(F.lit("late").alias("part"), month, "total_video_visits"))
        .groupBy("part", "yyyymm")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("total_video_visits").alias("visits"))
    )


# --- documents -------------------------------------------------------------------------------------


@query
def normalize_documents(spark, sf_dir):
    good = n.accepted(n.normalize(sample_lines.lines(spark, sf_dir)))
    return good.select("_id", "object.*", "created_at", "expire_at", "update_count")


@query
def normalize_rejects(spark, sf_dir):
    lines = n.normalize(sample_lines.lines(spark, sf_dir))
    return lines.where(F.col("reason").isNotNull()).select("line_no", "reason")


@query
def normalize_extended(spark, sf_dir):
    good = n.accepted(n.normalize(sample_lines.lines(spark, sf_dir, "extended"), "extended"))
    return good.select("_id", "object.*", "created_at", "expire_at", "update_count")


@query
def normalize_extended_rejects(spark, sf_dir):
    lines = n.normalize(sample_lines.lines(spark, sf_dir, "extended"), "extended")
    return lines.where(F.col("reason").isNotNull()).select("line_no", "reason")


@query
def flatten_documents(spark, sf_dir):
    return n.flatten(n.accepted(n.normalize(sample_lines.lines(spark, sf_dir))))


@query
def events_props_parse(spark, sf_dir):
    line = coerce.parse_line(F.col("props"), "struct<k: variant>")
    return binding.table(spark, sf_dir, "events").select(
        "event_id", coerce.number_of(F.to_json(line["k"])).alias("k")
    )


@query
def comment_part_count(spark, sf_dir):
    return binding.table(spark, sf_dir, "documents").select(
        "doc_id",
        coerce.part_count(F.col("text")).alias("parts"),
        coerce.part_count(F.col("text"), ",").alias("comma_parts"),
    )


@query
def lenient_timestamps(spark, sf_dir):
    """The time text of each event in one of eight forms, by event id."""
    day = "date_format(ts, 'yyyy-MM-dd')"
    time = "date_format(ts, 'HH:mm:ss')"
    form = f"""CASE event_id % 8
        WHEN 0 THEN concat({day}, 'T', {time}, 'Z')
        WHEN 1 THEN concat({day}, ' ', {time})
        WHEN 2 THEN concat({day}, 'T', {time}, '.250+02:00')
        WHEN 3 THEN {day}
        WHEN 4 THEN concat('at ', {day}, 'T', {time})
        WHEN 5 THEN concat({day}, 'T', date_format(ts, 'HH:mm'))
        WHEN 6 THEN NULL
        ELSE concat('T', {time}) END"""
    events = binding.table(spark, sf_dir, "events").selectExpr("event_id", f"{form} AS form")
    return events.select("event_id", datetimes.lenient_timestamp(F.col("form")).alias("moment"))


def _documents(spark, sf_dir, tables: Tables) -> None:
    """Raw lines written as two drops of JSON files and appended in three runs, one repeated."""
    root = work_dir(spark, "drops")
    lines = sample_lines.lines(spark, sf_dir)
    early = F.col("line_no") % 2 == 0
    lines.where(early).select("value").write.text(f"{root}/one")
    lines.select("value").write.text(f"{root}/two")
    for batch in ("one", "two", "two"):
        source = json_lines.read_lines(spark, f"{root}/{batch}", suffix=".txt")
        daily_run.append_documents(tables, source, batch, "daily")


@query
def append_documents(spark, sf_dir):
    """Every id once, though half of the lines come twice."""
    tables = new_tables(spark)
    _documents(spark, sf_dir, tables)
    return tables.read("documents").select("_id", "object.visit_count", "created_at")


@query
def run_rejects(spark, sf_dir):
    """Refused lines by reason; those of the first drop come again with the second."""
    tables = new_tables(spark)
    _documents(spark, sf_dir, tables)
    return tables.read("rejects").groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query
def json_lines_roundtrip(spark, sf_dir):
    """Extended export, converted file to file, and read back."""
    root = work_dir(spark, "convert")
    sample_lines.lines(spark, sf_dir, "extended").select("value").write.text(f"{root}/in")
    json_lines.convert(spark, f"{root}/in", f"{root}/out", f"{root}/rejects")
    back = spark.read.schema(
        f"_id string, object {schemas.DOCUMENT_BODY}, created_at string, update_count int"
    ).json(f"{root}/out")
    return back.select(
        "_id", "object.title", "object.tags", "object.like_count", "created_at", "update_count"
    )


@query
def json_lines_rejects(spark, sf_dir):
    """Refused lines of the same conversion, by reason."""
    root = work_dir(spark, "convert")
    sample_lines.lines(spark, sf_dir, "extended").select("value").write.text(f"{root}/in")
    json_lines.convert(spark, f"{root}/in", f"{root}/out", f"{root}/rejects")
    refused = spark.read.schema("source string, raw string, reason string").json(f"{root}/rejects")
    return refused.groupBy("reason").agg(F.count("raw").alias("n"))


@query
def columns_by_position(spark, sf_dir):
    """The second, first and fourth column of the customers."""
    return channel_csv.cut_columns(binding.table(spark, sf_dir, "customer"), 2, 1, 4)


# --- discovery -------------------------------------------------------------------------------------


def _event_keys(spark, sf_dir) -> DataFrame:
    """One made-up object key per event: dated folders, some without a date."""
    form = """CASE event_id % 10
        WHEN 0 THEN concat('misc/', event_id, '.csv')
        WHEN 1 THEN concat(date_format(ts, 'y-M-d'), ' evening/', event_id, '.csv')
        WHEN 2 THEN concat('/', event_id, '.csv')
        WHEN 3 THEN concat(date_format(ts, 'yyyy-MM-dd'), 'x/', event_id, '.csv')
        ELSE concat(date_format(ts, 'yyyy-MM-dd'), '/', event_type, '/', event_id, '.csv') END"""
    events = binding.table(spark, sf_dir, "events")
    return events.selectExpr("event_id", "user_id", f"{form} AS key")


@query
def path_date_filter(spark, sf_dir):
    keys = files.with_drop_date(_event_keys(spark, sf_dir))
    state = files.drop_state("2024-01-15T00:00:00").alias("state")
    return keys.select("event_id", "drop_date", state)


@query
def ledger_anti_join(spark, sf_dir):
    keys = _event_keys(spark, sf_dir)
    ledger = keys.where("user_id % 3 = 0").select(
        F.col("key").alias("file_name"), (F.col("event_id") % 2 == 0).alias("inserted")
    )
    return files.not_in_ledger(keys.select("event_id", "key"), ledger)


@query
def ledger_upsert(spark, sf_dir):
    keys = _event_keys(spark, sf_dir)
    ledger = keys.where("user_id % 3 = 0").select(
        F.col("key").alias("file_name"), (F.col("event_id") % 2 == 0).alias("inserted")
    )
    return upsert.mark_files(ledger, keys.where("user_id % 2 = 0"))


@query
def files_modified_since(spark, sf_dir):
    """Folders of the files listed since the epoch; a start in the future lists none."""
    root = work_dir(spark, "listing")
    documents = binding.table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    documents.write.partitionBy("source").json(f"{root}/docs")
    documents.write.partitionBy("source").csv(f"{root}/other")
    found = files.modified_since(spark, root, "1970-01-01")
    later = files.modified_since(spark, root, dt.datetime(2999, 1, 1))
    both = found.withColumn("since", F.lit("epoch")).unionByName(
        later.withColumn("since", F.lit("future"))
    )
    # a file the listing lost would be missing in the lines of its folder
    lines = json_lines.read_lines(spark, root).groupBy("source_path").agg(F.count("*").alias("lines"))
    both = both.join(lines, F.col("path") == F.col("source_path"))
    return both.groupBy(
        F.split("key", "/")[0].alias("folder"), F.split("key", "/")[1].alias("part"), "since"
    ).agg(F.sum("lines").alias("lines"))


@query
def files_interval(spark, sf_dir):
    """Lines of three drops of known age, by the bounds that the reader is given."""
    root = work_dir(spark, "interval")
    times = {"old": 1_600_000_000, "middle": 1_700_000_000, "new": 1_800_000_000}
    documents = binding.table(spark, sf_dir, "documents").select("doc_id", "lang")
    drop = F.element_at(F.array(*map(F.lit, times)), (F.col("doc_id") % 3 + 1).cast("int"))
    documents.withColumn("drop", drop).write.partitionBy("drop").json(root)
    for row in files.list_files(spark, root).select("path", "key").toLocalIterator():
        age = times[row["key"].split("/")[0].removeprefix("drop=")]
        where = spark._jvm.org.apache.hadoop.fs.Path(row["path"])
        where.getFileSystem(spark._jsc.hadoopConfiguration()).setTimes(where, age * 1000, -1)
    since, until = (dt.datetime.fromtimestamp(times[name], dt.timezone.utc) for name in ("middle", "new"))
    slices = {"neither": (None, None), "since": (since, None), "until": (None, until), "both": (since, until)}
    return audit.stage_counts(**{name: json_lines.read_lines(spark, root, *bounds) for name, bounds in slices.items()})


@query
def files_once_only(spark, sf_dir):
    """Lines of two drops taken in by three runs, each file in exactly one of them."""
    root = work_dir(spark, "once")
    rows = binding.table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    cut = F.col("doc_id") % 2 == 0
    for number, part in enumerate((rows.where(cut), rows.where(~cut))):
        part.write.json(f"{root}/in/drop{number}")
        intake.copy_lines(spark, f"{root}/in", f"{root}/out", f"{root}/checkpoint")
    intake.copy_lines(spark, f"{root}/in", f"{root}/out", f"{root}/checkpoint")
    lines = spark.read.schema("value string").parquet(f"{root}/out")
    return lines.select(
        F.from_json("value", "doc_id bigint, lang string, n_chars bigint").alias("d")
    ).select("d.*")


# --- channels --------------------------------------------------------------------------------------


def _event_channels(spark, sf_dir) -> DataFrame:
    """A channel drop row per event: known and new usernames, in the order of the events."""
    username = """CASE WHEN user_id % 4 = 0 THEN concat('New#', user_id)
        ELSE concat('Customer#', lpad(cast(user_id AS string), 9, '0')) END"""
    return binding.table(spark, sf_dir, "events").selectExpr(
        f"{username} AS username", "cast(ts AS timestamp) AS created_at", "ts", "event_id"
    )


def _without_new_ids(channels: DataFrame, known: DataFrame) -> DataFrame:
    """Ids handed out by the upsert replaced by their offset to be checked as a whole elsewhere."""
    last = known.agg(F.max("id")).scalar()
    return channels.withColumn("id", F.when(F.col("id") <= last, F.col("id")))


@query
def channel_upsert(spark, sf_dir):
    known = binding.channels(spark, sf_dir)
    after = upsert.upsert_channels(known, _event_channels(spark, sf_dir), ("ts", "event_id"))
    return _without_new_ids(after, known)


@query
def channel_upsert_ids(spark, sf_dir):
    """New ids follow the known ones without gap or repeat."""
    known = binding.channels(spark, sf_dir)
    after = upsert.upsert_channels(known, _event_channels(spark, sf_dir), ("ts", "event_id"))
    return after.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("id").alias("distinct_ids"),
        F.min("id").alias("first_id"),
        F.max("id").alias("last_id"),
    )


def _write_csv_drops(spark, sf_dir, root: str) -> None:
    """Events as CSV drops in dated folders, with a surplus column, and one folder without date."""
    rows = _event_channels(spark, sf_dir).select(
        F.lit("say \"hi\", twice").alias("note"),
        F.col("username").alias("_id"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("created_at"),
        F.col("ts"),
    )
    first = "1970-01-01"
    for day in DROP_DAYS:
        part = rows.where((F.col("ts") >= first) & (F.col("ts") < day)).drop("ts")
        part = part.repartitionByRange(4, "created_at").sortWithinPartitions("created_at")
        part.write.option("header", True).option("escape", '"').csv(f"{root}/{day} drop")
        first = day
    rows.drop("ts").write.option("header", True).option("escape", '"').csv(f"{root}/undated")


@query
def csv_daily_load(spark, sf_dir):
    """Due drops upserted into the channels; the last drop is dated after the run."""
    tables, root = new_tables(spark), work_dir(spark, "csv")
    known = binding.channels(spark, sf_dir)
    tables.replace({"channels": known})
    _write_csv_drops(spark, sf_dir, root)
    for batch in ("one", "again"):
        daily_run.load_channel_drops(tables, root, DROPS_AS_OF, batch)
    return _without_new_ids(tables.read("channels"), known)


def _write_refused_drops(spark, sf_dir, root: str) -> None:
    """Beside the good drops of the second day: one without the columns it must have, one blank, one of 0 bytes."""
    rows = _event_channels(spark, sf_dir).select(F.col("username").alias("name"), F.col("created_at").cast("string").alias("when"))
    bad = f"{root}/{DROP_DAYS[1]} drop"
    rows.write.option("header", True).csv(f"{bad}/other columns")
    for name, text in (("blank", " \n"), ("empty", "")):
        _write_file(spark, f"{bad}/{name}/0.csv", text)


def _write_file(spark, path: str, text: str = "") -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    stream = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(where)
    stream.writeBytes(text)
    stream.close()


@query
def drops_with_refused_file(spark, sf_dir):
    """Good and bad drops of one day: the good ones load, each bad one is refused for its own reason."""
    tables, root = new_tables(spark), work_dir(spark, "csv")
    known = binding.channels(spark, sf_dir)
    tables.replace({"channels": known})
    _write_csv_drops(spark, sf_dir, root)
    _write_refused_drops(spark, sf_dir, root)
    for batch in ("one", "again"):
        daily_run.load_channel_drops(tables, root, DROPS_AS_OF, batch)
    folder = F.regexp_extract("file_name", "^(.*)/[^/]*$", 1)
    # the writer itself leaves files of 0 bytes where a part has no rows
    by_writer = F.col("file_name").contains("/part-") & (F.col("reason") == "no lines")
    refused = tables.read("csv_refused").where(~by_writer).select(folder.alias("drop"), "reason").distinct()
    loaded = tables.read("csv_files").select(folder.alias("drop"), F.lit("loaded").alias("reason")).distinct()
    updates = tables.read("channels").agg(F.sum("update_count"), F.count(F.lit(1))).first()
    return refused.unionByName(loaded).select(
        "drop", "reason", F.lit(updates[0]).alias("updates"), F.lit(updates[1]).alias("channels")
    )


@query
def files_with_empty_drop(spark, sf_dir):
    """Files of 0 bytes beside others, by folder and by what the listing is asked for."""
    root = work_dir(spark, "empty")
    documents = binding.table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    documents.write.partitionBy("source").json(root)
    for row in documents.select("source").distinct().toLocalIterator():
        _write_file(spark, f"{root}/source={row['source']}/no lines.json")
    folder = F.split("key", "/")[0].alias("folder")
    slices = {"all": (None, None), "since": ("2000-01-01", None), "until": (None, "2000-01-01")}
    parts = [
        files.modified_since(spark, root, *bounds).groupBy(folder).agg(
            F.count_if(F.col("length") == 0).alias("empty"), F.max(F.col("length") > 0).alias("with_lines")
        ).select(F.lit(name).alias("asked"), "folder", "empty", "with_lines")
        for name, bounds in slices.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def csv_bulk_load(spark, sf_dir):
    """Channels written as bulk CSV with empty, quoted and surplus fields, and loaded back."""
    tables, root = new_tables(spark), work_dir(spark, "bulk")
    channels = binding.channels(spark, sf_dir)
    country = F.when(F.col("id") % 5 == 0, F.lit("")).otherwise(
        F.concat(F.lit('a "b", '), F.col("country"))
    )
    channels.withColumn("country", country).select(
        *channel_csv.BULK_COLUMNS, F.lit("x").alias("surplus")
    ).write.options(header=True, escape='"', nullValue="", emptyValue='""').csv(root)
    daily_run.bulk_load_channels(tables, root)
    loaded = tables.read("channels")
    return loaded.select(*channel_csv.BULK_COLUMNS, "created_at")


@query
def quality_violations(spark, sf_dir):
    """One channel row per order: repeated, missing and negative values."""
    key = F.col("o_orderkey")
    rows = binding.video_source(spark, sf_dir).select(
        F.when(key % 40 == 0, None).otherwise(F.col("c_name")).alias("username"),
        (F.floor("o_totalprice").cast("bigint") - 5000).alias("total_video_visit"),
        F.when(key % 3 == 0, None).otherwise(key % 20 - 1).alias("video_count"),
        (key % 7).alias("start_date_timestamp"),
        (key % 11 - 2).alias("followers_count"),
    )
    return quality.violations(rows)


@query
def quality_split(spark, sf_dir):
    """Good rows and the rule each other row breaks first."""
    key = F.col("o_orderkey")
    rows = binding.video_source(spark, sf_dir).select(
        key,
        F.when(key % 40 == 0, None).otherwise(F.col("c_name")).alias("username"),
        (F.floor("o_totalprice").cast("bigint") - 5000).alias("total_video_visit"),
        F.when(key % 3 == 0, None).otherwise(key % 20 - 1).alias("video_count"),
        (key % 7).alias("start_date_timestamp"),
        (key % 11 - 2).alias("followers_count"),
    )
    good, bad = quality.split_rows(rows)
    good = good.withColumn("rule", F.lit("none"))
    return good.select("o_orderkey", "rule").unionByName(bad.select("o_orderkey", "rule"))


# --- increments ------------------------------------------------------------------------------------


@query
def keyset_increment(spark, sf_dir):
    """Channels copied to bronze in two increments and an empty third one."""
    tables = new_tables(spark)
    channels = binding.channels(spark, sf_dir)
    half = channels.agg(F.floor(F.max("id") / 2)).scalar()
    tables.replace({"channels": channels.where(F.col("id") <= half)})
    daily_run.copy_channels(tables)
    tables.replace({"channels": channels})
    daily_run.copy_channels(tables)
    daily_run.copy_channels(tables)
    return tables.read("bronze_channels")


@query
def time_increment(spark, sf_dir):
    videos = binding.videos(spark, sf_dir)
    first, second = CREATED_CUTS
    slices = (("1900-01-01", first), (first, second), (second, None))
    parts = [
        increments.between(videos, since, until).select(F.lit(i).alias("slice"), "id", "created_at")
        for i, (since, until) in enumerate(slices)
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def documents_by_time(spark, sf_dir):
    """Stored documents read in three slices of time, each from its own folders."""
    tables, root = new_tables(spark), work_dir(spark, "drops")
    sample_lines.lines(spark, sf_dir).select("value").write.text(root)
    daily_run.append_documents(tables, json_lines.read_lines(spark, root, suffix=".txt"), "one", "daily")
    first, second = CREATED_CUTS
    slices = (("1900-01-01", first), (first, second), (second, None))
    parts = []
    for i, (since, until) in enumerate(slices):
        rows = increments.between(tables.read_range("documents", *increments.days_of(since, until)), since, until)
        parts.append(rows.select(F.lit(i).alias("slice"), "_id", "created_at"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def key_page(spark, sf_dir):
    """The page of 100 channels that follows the first 700."""
    return increments.key_page(binding.channels(spark, sf_dir), 700, 100).select("id", "username")


@query
def dedup_first_seen(spark, sf_dir):
    """The first line of every order, ties by part, supplier and price."""
    lines = binding.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"
    )
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    return first_by_key(lines, ["l_orderkey"], order)


@query
def snapshot_reload(spark, sf_dir):
    """A full reload that meets every document twice."""
    lines = sample_lines.lines(spark, sf_dir)
    twice = n.accepted(n.normalize(lines.unionByName(lines)))
    kept = increments.snapshot(twice, ["update_count"])
    return n.flatten(kept).select("id", "visit_count", "created_at")


@query
def unseen_keys(spark, sf_dir):
    """Customers without an urgent order."""
    customers = binding.table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    orders = binding.table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'")
    return unseen(customers, orders.select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"])


@query
def approximate_distinct(spark, sf_dir):
    """Distinct parts by return flag: exact, and whether merged sketches come within 2 %."""
    rows = binding.table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linenumber", "l_partkey")
    parts = rows.groupBy("l_returnflag", "l_linenumber").agg(Distinct.partial(F.col("l_partkey")).alias("state"))
    merged = parts.groupBy("l_returnflag").agg(Distinct.merge(F.col("state")).alias("state"))
    estimated = merged.select("l_returnflag", Distinct.final(F.col("state")).alias("estimate"))
    exact = rows.groupBy("l_returnflag").agg(Distinct.exact(F.col("l_partkey")).alias("n"))
    near = F.abs(F.col("estimate") - F.col("n")) <= F.col("n") * 0.02
    return exact.join(estimated, "l_returnflag").select("l_returnflag", "n", near.alias("near"))


# --- the stored pipeline ---------------------------------------------------------------------------


@query
def silver_stream(spark, sf_dir):
    """Two drops of videos with the channels known at each; late channels do not reach back."""
    tables = new_tables(spark)
    channels, videos = binding.channels(spark, sf_dir), binding.videos(spark, sf_dir)
    early_channel = F.col("created_at") < CHANNEL_CUT
    early_video = F.col("created_at") < CREATED_CUTS[1]
    tables.append("bronze_channels", channels.where(early_channel), "one")
    tables.append("bronze_videos", videos.where(early_video), "one")
    silver_view.refresh(tables, AS_OF, with_gold=False)
    tables.append("bronze_channels", channels.where(~early_channel), "two")
    silver_view.refresh(tables, AS_OF, with_gold=False)
    tables.append("bronze_videos", videos.where(~early_video), "two")
    silver_view.refresh(tables, AS_OF, with_gold=False)
    return tables.read("silver_events").select("video_id", "channel_id", "channel_username")


@query
def silver_rebuilt(spark, sf_dir):
    """After a rebuild late channels have their earlier videos, and gold follows."""
    tables = new_tables(spark)
    channels, videos = binding.channels(spark, sf_dir), binding.videos(spark, sf_dir)
    tables.append("bronze_channels", channels.where(F.col("created_at") < CHANNEL_CUT), "one")
    tables.append("bronze_videos", videos, "one")
    silver_view.refresh(tables, AS_OF)
    tables.append("bronze_channels", channels.where(F.col("created_at") >= CHANNEL_CUT), "two")
    silver_view.rebuild(tables, AS_OF)
    silver_view.refresh(tables, AS_OF)
    return gold.report(tables, "channel_growth")


@query
def silver_late_channels(spark, sf_dir):
    """Videos and channels that come in turn, each joined with what waits on the other side: the plain join."""
    tables = new_tables(spark)
    channels, videos = binding.channels(spark, sf_dir), binding.videos(spark, sf_dir)
    early_channel = F.col("created_at") < CHANNEL_CUT
    early_video = F.col("created_at") < CREATED_CUTS[1]
    tables.append("bronze_videos", videos.where(early_video), "one")
    silver_view.refresh(tables, AS_OF, late_channels=True)
    tables.append("bronze_channels", channels.where(early_channel), "one")
    silver_view.refresh(tables, AS_OF, late_channels=True)
    tables.append("bronze_videos", videos.where(~early_video), "two")
    tables.append("bronze_channels", channels.where(~early_channel), "two")
    for _ in range(2):
        silver_view.refresh(tables, AS_OF, late_channels=True)
    return tables.read("silver_events")


@query
def gold_late_channels(spark, sf_dir):
    """The growth report after late channels were caught up with: as if they had been there before."""
    tables = new_tables(spark)
    channels = binding.channels(spark, sf_dir)
    early = F.col("created_at") < CHANNEL_CUT
    tables.append("bronze_channels", channels.where(early), "one")
    tables.append("bronze_videos", binding.videos(spark, sf_dir), "one")
    silver_view.refresh(tables, AS_OF, late_channels=True)
    tables.append("bronze_channels", channels.where(~early), "two")
    silver_view.refresh(tables, AS_OF, late_channels=True)
    return gold.report(tables, "channel_growth")


@query
def silver_after_cut_append(spark, sf_dir):
    """An append cut off before its commit is not seen, and is taken in once when it is repeated."""
    tables = new_tables(spark)
    videos = binding.videos(spark, sf_dir)
    early = F.col("created_at") < CREATED_CUTS[1]
    tables.append("bronze_channels", binding.channels(spark, sf_dir), "one")
    tables.append("bronze_videos", videos.where(early), "one")
    tables._write("bronze_videos", videos.where(~early), 0, "two", None)  # and no commit
    silver_view.refresh(tables, AS_OF, with_gold=False)
    tables.append("bronze_videos", videos.where(~early), "two")
    silver_view.refresh(tables, AS_OF, with_gold=False)
    return tables.read("silver_events").select("video_id", "channel_id", "channel_username")


@query
def rebuild_after_crash(spark, sf_dir):
    """A rebuild cut off before its commit changes nothing; repeated, gold has the late channels."""
    tables = new_tables(spark)
    channels, videos = binding.channels(spark, sf_dir), binding.videos(spark, sf_dir)
    tables.append("bronze_channels", channels.where(F.col("created_at") < CHANNEL_CUT), "one")
    tables.append("bronze_videos", videos, "one")
    silver_view.refresh(tables, AS_OF)
    tables.append("bronze_channels", channels.where(F.col("created_at") >= CHANNEL_CUT), "two")
    staged = work_dir(spark, "events")  # the join is made once, as a rebuild makes it
    joined_events(tables.read("bronze_videos"), tables.read("bronze_channels")).write.parquet(staged)
    events = spark.read.parquet(staged)
    for name, rows in {"silver_events": events, **gold.states(events, AS_OF)}.items():
        tables._write(name, rows.limit(3), 1, "s0-rebuilt", None)  # part of the rows, and no commit
    silver_view.refresh(tables, AS_OF)
    silver_view.rebuild(tables, AS_OF)
    return gold.report(tables, "channel_growth")


@query
def compact_then_replay(spark, sf_dir):
    """Two batches of states, folded, and the first one once more."""
    tables = new_tables(spark)
    events = binding.silver(spark, sf_dir)
    first = (F.col("video_id").cast("bigint") % 2) == 0
    gold.refresh_append(tables, events.where(first), "one", AS_OF)
    gold.refresh_append(tables, events.where(~first), "two", AS_OF)
    gold.compact(tables)
    gold.refresh_append(tables, events.where(first), "one", AS_OF)
    return r.TOP_CHANNELS.finish(tables.read("gold_top_channels"))


@query
def catalog_tables(spark, sf_dir):
    """Rows of the tables by name, after appends, a replacement and a compaction."""
    tables = new_tables(spark)
    channels, videos = binding.channels(spark, sf_dir), binding.videos(spark, sf_dir)
    early = F.col("created_at") < CHANNEL_CUT
    tables.append("bronze_channels", channels.where(early), "one")
    tables.append("bronze_channels", channels.where(~early), "two")
    tables.replace({"bronze_videos": videos.limit(0)})
    tables.replace({"bronze_videos": videos})
    silver_view.refresh(tables, AS_OF)
    gold.compact(tables)
    prefix = f"run_{uuid.uuid4().hex[:12]}_"
    made = tables.register(prefix)
    names = ("bronze.channels", "bronze.videos", "silver.events", "gold.channel_growth", "lake.documents")
    found = audit.stage_counts(**{name.removeprefix("lake."): spark.table(prefix + name) for name in names})
    # the views are resolved; the session's catalog is left as it was
    for database in made:
        spark.sql(f"DROP DATABASE `{database}` CASCADE")
    return found


def _daily_runs(spark, sf_dir, times: int) -> tuple[Tables, DataFrame, daily_run.Run]:
    """Raw lines and channel CSV (one row per customer) taken in by the same run, repeated."""
    tables, root = new_tables(spark), work_dir(spark, "daily")
    sample_lines.lines(spark, sf_dir).select("value").write.text(f"{root}/json")
    channels = binding.channels(spark, sf_dir)
    channels.select(
        F.col("username").alias("_id"),
        F.date_format("created_at", "yyyy-MM-dd HH:mm:ss").alias("created_at"),
    ).write.option("header", True).csv(f"{root}/csv/2025-06-30")
    # text files, taken in as a drop of .json would be
    run = daily_run.Run(
        as_of=dt.datetime(2025, 7, 1),
        json_root=f"{root}/json",
        csv_root=f"{root}/csv",
        json_suffix=".txt",
    )
    for _ in range(times):
        rows = daily_run.run(spark, tables.root, run)
    return tables, rows, run


@query
def run_audit_counts(spark, sf_dir):
    tables, _, _ = _daily_runs(spark, sf_dir, 1)
    return tables.read("run_audit").select("stage", "status", "rows_out", "rows_rejected")


def _stored_counts(tables: Tables) -> DataFrame:
    stages = {
        name: tables.read(name)
        for name in ("documents", "rejects", "channels", "bronze_videos", "bronze_channels")
    }
    stages["silver_events"] = tables.read("silver_events")
    states = tables.read("gold_content_popularity")
    stages["tag_occurrences"] = states.select(F.explode(F.sequence(F.lit(1), "video_count")))
    return audit.stage_counts(**stages)


@query
def backfill_rerun(spark, sf_dir):
    """The same run three times: tables as after the first."""
    return _stored_counts(_daily_runs(spark, sf_dir, 3)[0])


@query
def reload_then_rerun(spark, sf_dir):
    """A run, a full reload of the videos, and the same run again: nothing counts twice."""
    tables, _, run = _daily_runs(spark, sf_dir, 1)
    daily_run.reload_videos(tables)
    daily_run.run(spark, tables.root, run)
    return _stored_counts(tables)
