"""JSON lines to typed video documents, with refused lines kept apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vidstrata import schemas
from vidstrata.functions import coerce as c
from vidstrata.functions import datetimes as d

DIALECTS = ("daily", "extended")

TEXT_FIELDS = ("owner_username", "owner_id", "title", "uid", "owner_name", "description")
BODY_FIELDS = (
    "id",
    "owner_username",
    "owner_id",
    "title",
    "tags",
    "uid",
    "visit_count",
    "owner_name",
    "duration",
    "posted_date",
    "posted_timestamp",
    "comments",
    "like_count",
    "description",
    "is_deleted",
)
TOP_FIELDS = ("_id", "created_at", "expire_at", "update_count")
NEVER_NULL = ("visit_count", "duration", "posted_timestamp", "comments", "update_count")

# Every field a variant: absent is SQL NULL, JSON null a variant null.
LINE = "struct<{top}, object: struct<{body}>>".format(
    top=", ".join(f"{name}: variant" for name in TOP_FIELDS),
    body=", ".join(f"{name}: variant" for name in BODY_FIELDS),
)


def normalize(lines: DataFrame, dialect: str = "daily", text: str = "value", unit: bool = True) -> DataFrame:
    """Add ``document`` (the typed struct) and ``reason`` (NULL for a good line) to each line.

    ``daily`` reads plain JSON; ``extended`` also unwraps ``$numberInt``, ``$numberLong`` and
    ``$date`` and skips blank lines. All of it is built-in column expressions: one parse of the
    line, one projection per step, no shuffle. A result that is written as it is needs no ``unit``.
    """
    if dialect not in DIALECTS:
        raise ValueError(f"dialect must be one of {DIALECTS}")
    extended = dialect == "extended"
    kept = lines.columns
    if extended:
        lines = lines.where(F.trim(F.col(text)) != "")
    parsed = lines.withColumn("_line", c.parse_line(F.col(text), LINE))
    names = TOP_FIELDS + BODY_FIELDS
    paths = [f"_line.{name}" for name in TOP_FIELDS]
    paths += [f"_line.object.{name}" for name in BODY_FIELDS]
    raw = parsed.select(
        *kept,
        F.col("_line").isNull().alias("_bad"),
        F.col("_line.object").isNull().alias("_no_object"),
        *[F.to_json(path).alias(f"_j_{name}") for name, path in zip(names, paths)],
    )
    fields = {name: c.Loose(F.col(f"_j_{name}"), extended) for name in names}
    values = _extended(fields) if extended else _daily(fields)
    typed = raw.select(
        *kept,
        *["_bad", "_no_object", "_j_id", "_j_created_at", "_j_expire_at"],
        *[column.alias(f"_v_{name}") for name, column in values.items()],
    )
    typed = typed.withColumns(_moments(extended))
    checks = _extended_checks(F.col(text)) if extended else _daily_checks(fields)
    bad = F.when(c.is_json(F.col(text)), F.lit("not an object")).otherwise(F.lit("bad json"))
    # the first thing wrong with the line
    reason = F.coalesce(
        F.when(F.col("_bad"), bad), *[F.when(wrong, F.lit(why)) for why, wrong in checks.items()]
    )
    result = _document().alias("document"), reason.alias("reason")
    if not unit:
        return typed.select(*kept, *result)
    # As the one item of an array the result stays a unit: a filter on the reason would otherwise be
    # moved below the projections and everything above computed twice.
    return typed.select(*kept, F.inline(F.array(F.struct(*result))))


def _shared(fields: dict[str, c.Loose]) -> dict[str, Column]:
    values = {name: fields[name].text_or("") for name in TEXT_FIELDS}
    values["_id"] = F.when(~fields["_id"].null, fields["_id"].text)
    # any non-empty value counts as true, the text "false" included
    values["is_deleted"] = ~fields["is_deleted"].empty
    return values


def _daily(fields: dict[str, c.Loose]) -> dict[str, Column]:
    return _shared(fields) | {
        "id": F.when(~fields["id"].null, fields["id"].text),
        "tags": fields["tags"].text_or(""),
        "visit_count": fields["visit_count"].whole(),
        "duration": fields["duration"].small(),
        "posted_date": fields["posted_date"].text_or("1970-01-01"),
        "posted_timestamp": fields["posted_timestamp"].strict(),
        "comments": fields["comments"].parts(),
        "like_count": fields["like_count"].strict(),
        "created_at": F.when(fields["created_at"].is_text, fields["created_at"].text),
        "expire_at": F.when(fields["expire_at"].is_text, fields["expire_at"].text),
        "update_count": fields["update_count"].small(),
    }


def _extended(fields: dict[str, c.Loose]) -> dict[str, Column]:
    comments, ident = fields["comments"], fields["id"]
    return _shared(fields) | {
        "id": F.when(ident.empty | ident.is_object, ident.whole().cast("string")).otherwise(
            ident.text
        ),
        "tags": fields["tags"].filled_text_or("None"),
        "visit_count": fields["visit_count"].whole(),
        "duration": fields["duration"].small(),
        "posted_date": fields["posted_date"].text_or("1970-01-01 00:00:00"),
        "posted_timestamp": fields["posted_timestamp"].not_text(),
        "comments": F.when(comments.empty, F.lit(0)).otherwise(comments.parts()),
        "like_count": fields["like_count"].number,
        "created_at": fields["created_at"].not_text(),
        "expire_at": fields["expire_at"].not_text(),
        "update_count": fields["update_count"].small(),
    }


def _moments(extended: bool) -> dict[str, Column]:
    """The time fields, read in the step before as seconds, milliseconds or text."""
    read = d.millis_timestamp if extended else d.stored_timestamp
    return {
        "_v_posted_timestamp": d.iso_seconds(F.col("_v_posted_timestamp")),
        "_v_created_at": read(F.col("_v_created_at")),
        "_v_expire_at": read(F.col("_v_expire_at")),
    }


def _document() -> Column:
    body = F.struct(*[F.col(f"_v_{name}").alias(name) for name in BODY_FIELDS])
    return F.struct(
        F.col("_v__id").alias("_id"),
        body.cast(schemas.DOCUMENT_BODY).alias("object"),
        F.col("_v_created_at").alias("created_at"),
        F.col("_v_expire_at").alias("expire_at"),
        F.col("_v_update_count").alias("update_count"),
    )


def _is_null(name: str) -> Column:
    return F.col(f"_v_{name}").isNull()


def _daily_checks(fields: dict[str, c.Loose]) -> dict[str, Column]:
    def unread(name: str) -> Column:
        return _is_null(name) & ~fields[name].absent & ~fields[name].null

    return {
        "_id": _is_null("_id"),
        "object": F.col("_no_object"),
        "object.id": fields["id"].absent,
        **{name: _is_null(name) for name in NEVER_NULL},
        "created_at": unread("created_at"),
        "expire_at": unread("expire_at"),
    }


def _extended_checks(text: Column) -> dict[str, Column]:
    return {
        "_id": _is_null("_id"),
        # an absent object is all defaults; the line is only looked at again when there is none
        "object": F.col("_no_object") & c.has_field(text, "object"),
        "object.id": _is_null("id"),
        **{name: _is_null(name) for name in NEVER_NULL},
        "created_at": _is_null("created_at"),
        "expire_at": _is_null("expire_at"),
    }


def accepted(normalized: DataFrame, *keep: str) -> DataFrame:
    return normalized.where(F.col("reason").isNull()).select(*keep, "document.*")


def rejected(normalized: DataFrame, source: str = "source_path", text: str = "value") -> DataFrame:
    origin = F.col(source) if source in normalized.columns else F.lit(None).cast("string")
    return normalized.where(F.col("reason").isNotNull()).select(
        origin.alias("source"), F.col(text).alias("raw"), "reason"
    )


def export_json(documents: DataFrame) -> DataFrame:
    """Documents in their exchange form: times as ISO text, null fields written out."""
    return documents.select(
        "_id",
        "object",
        d.iso_text(F.col("created_at")).alias("created_at"),
        d.iso_text(F.col("expire_at")).alias("expire_at"),
        "update_count",
    )


def flatten(documents: DataFrame) -> DataFrame:
    """Typed documents to the 15 flat bronze columns, gaps filled with each column's default."""
    body = {
        "owner_username": F.lit(""),
        "owner_id": F.lit(""),
        "title": F.lit(""),
        "tags": None,
        "uid": F.lit(""),
        "visit_count": F.lit(0),
        "owner_name": F.lit(""),
        "duration": F.lit(0),
        "comments": None,
        "like_count": None,
        "is_deleted": F.lit(False),
    }
    columns = {"id": F.coalesce(F.col("_id"), F.lit(""))}
    for name, default in body.items():
        value = F.col(f"object.{name}")
        columns[name] = value if default is None else F.coalesce(value, default)
    columns["created_at"] = F.coalesce(F.col("created_at"), d.epoch())
    columns["expire_at"] = F.coalesce(F.col("expire_at"), d.epoch())
    columns["update_count"] = F.coalesce(F.col("update_count"), F.lit(0))
    flat = documents.select(*[value.alias(name) for name, value in columns.items()])
    return schemas.conform(flat, schemas.BRONZE_VIDEOS)
