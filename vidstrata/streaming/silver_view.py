"""The silver table as an insert-triggered view over bronze.

New video batches are joined with the channels known at that moment and appended. A channel that
arrives later adds nothing to videos that went before it; ``rebuild`` gives the complete join, and so does
``refresh`` with ``late_channels``, at the cost of what is new on either side: videos without a channel wait in a
table of their own, in hash folders of their owner, and new channels are joined with those only.
The first run takes all videos present, which is the view's backfill.

What is new is told by the commit log: batches of bronze whose names silver has not taken in. Rows of
bronze that are not committed are never seen. Silver and gold are committed together, so a crash at any
point leaves both as they were.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vidstrata.operators.silver import silver_events
from vidstrata.plans import gold
from vidstrata.plans.tables import Tables, bucket_of
from vidstrata.session import size_shuffles


def refresh(tables: Tables, as_of=None, with_gold: bool = True, late_channels: bool = False) -> int:
    """Join the new bronze videos into silver and, unless told not to, add them to gold.

    ``late_channels`` also joins channels that are new with the videos that waited for them, and keeps videos without
    a channel waiting. Videos that a call without it has taken in do not wait; ``rebuild`` finds them.
    Without gold, the rows of this call are in silver only: a later call does not add them to gold, a rebuild does.
    Bronze replaced as a whole leads to a rebuild. Returns the number of rows added.
    """
    source = tables.version("bronze_videos")
    if not tables.batches("bronze_videos"):
        return 0
    if _newest_source(tables) not in (None, source) or (late_channels and _channels_replaced(tables)):
        return rebuild(tables, as_of, with_gold, late_channels)
    added = _catch_up(tables, source, as_of, with_gold) if late_channels else 0
    taken = set(tables.batches("silver_events"))
    # the name under which silver takes in a batch of this version of bronze
    pending = [b for b in tables.batches("bronze_videos", current=True) if _name(source, b) not in taken]
    if not pending:
        return added
    videos = tables.read("bronze_videos", only=pending)
    channels = tables.read("bronze_channels")
    size_shuffles(tables.spark, videos)
    new = {"silver_events": silver_events(videos, channels)}
    if late_channels:
        new["silver_waiting"] = _without_channel(videos, channels)
    rows = tables.append_all(
        new,
        f"s{source}-upto-{tables.number():012d}",
        folded={"silver_events": [_name(source, b) for b in pending]},
        **_gold(as_of, with_gold),
    )
    return added + rows["silver_events"]


def rebuild(tables: Tables, as_of=None, with_gold: bool = True, late_channels: bool = False) -> int:
    """Silver and gold anew from all of bronze: late channels get their earlier videos."""
    source = tables.version("bronze_videos")
    present = tables.batches("bronze_videos", current=True)
    videos = tables.read("bronze_videos", only=present)
    channels = tables.read("bronze_channels")
    size_shuffles(tables.spark, videos, channels)
    new = {"silver_events": silver_events(videos, channels)}
    folded = {"silver_events": [_name(source, b) for b in present]}
    if late_channels:
        new["silver_waiting"] = _without_channel(videos, channels)
        folded["silver_waiting"] = _channel_batches(tables)
    rows = tables.replace(new, f"s{source}-rebuilt", folded=folded, **_gold(as_of, with_gold))
    return rows["silver_events"]


def _catch_up(tables: Tables, source: int, as_of, with_gold: bool) -> int:
    """Join channels that are new with the videos that wait for them; those then wait no longer.

    A new row of a channel that silver knows already joins with all videos taken in so far, as the plain join has it
    once for each row of a channel.
    """
    known = set(tables.batches("silver_waiting"))
    pending = [name for name in _channel_batches(tables) if name not in known]
    if not pending:
        return 0
    of = {name: batch for name, batch in zip(_channel_batches(tables), tables.batches("bronze_channels", current=True), strict=True)}
    new = tables.read("bronze_channels", only=[of[name] for name in pending])
    old = tables.read("bronze_channels", only=[batch for name, batch in of.items() if name in known])
    touched = [row["b"] for row in new.select(bucket_of("username").alias("b")).distinct().collect()]  # BUCKETS at most
    waiting = tables.read_parts("silver_waiting", touched)
    events = silver_events(waiting, new)
    again = new.join(old.select("username").distinct(), "username", "left_semi").select(new.columns)
    taken = set(tables.batches("silver_events"))
    earlier = [b for b in tables.batches("bronze_videos", current=True) if _name(source, b) in taken]
    if earlier and not again.isEmpty():
        videos = tables.read("bronze_videos", only=earlier)
        videos = videos.join(again.select("username").distinct(), F.col("owner_username") == F.col("username"), "left_semi")
        events = events.unionByName(silver_events(videos, again))
    rows = tables.change(
        {"silver_events": events},
        {"silver_waiting": (_without_channel(waiting, new), touched)},
        f"s{source}-late-{tables.number():012d}",
        folded={"silver_waiting": pending},
        **_gold(as_of, with_gold),
    )
    return rows["silver_events"]


def _without_channel(videos: DataFrame, channels: DataFrame) -> DataFrame:
    names = channels.select(F.col("username").alias("_known")).where("_known IS NOT NULL").distinct()
    return videos.join(names, F.col("owner_username") == F.col("_known"), "left_anti")


def _channel_batches(tables: Tables) -> list[str]:
    """Names under which the current batches of bronze channels are noted as taken in."""
    return [f"c{tables.version('bronze_channels')}-of-{b}" for b in tables.batches("bronze_channels", current=True)]


def _channels_replaced(tables: Tables) -> bool:
    """Whether channels taken in so far were replaced as a whole."""
    versions = [int(m[1]) for m in map(re.compile(r"c(\d+)-of-").match, tables.batches("silver_waiting")) if m]
    return bool(versions) and max(versions) != tables.version("bronze_channels")


def _name(source: int, batch: str) -> str:
    return f"s{source}-of-{batch}"


def _newest_source(tables: Tables) -> int | None:
    """Version of bronze that silver was made from, None if there is no silver yet."""
    found = [int(m[1]) for m in map(re.compile(r"s(\d+)-").match, tables.batches("silver_events")) if m]
    return max(found, default=None)


def _gold(as_of, with_gold: bool) -> dict:
    if not with_gold:
        return {}

    def then(written: dict[str, DataFrame]) -> dict[str, DataFrame]:
        return gold.states(written["silver_events"], as_of)

    return {"then": then, "derived": gold.NAMES}
