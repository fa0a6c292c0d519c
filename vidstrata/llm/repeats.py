"""Passages that occur more than once, by a sparse suffix array.

A byte goes if some string of ``length`` bytes that covers it also starts anywhere else, in the same
text or another. Texts are UTF-8 bytes; matches never cross texts; all occurrences go, the first too.

1. Anchors. Of every ``length`` bytes the place of the smallest hash of ``k`` bytes (the rightmost on
   ties) is an anchor, so equal strings have an anchor at the same offset. Hashes of ``k`` bytes are
   counted, and anchors whose bytes occur once are dropped; no task gets all rows of a frequent hash.
2. Suffixes of the other anchors are range-partitioned by their leading bytes (Spark samples the
   splitters), each bucket sorts its suffixes by multikey quicksort, eight bytes at a step, and has
   the common prefixes of neighbours. Strings around an anchor repeat if two suffixes agree far
   enough to the right and their texts far enough to the left.
3. A leading string that more than ``hot`` suffixes share is no unit of work: its strings are compared
   by their hashes instead of by sorted suffixes, counted in all tasks and looked up like the anchors.

Texts that occur more than once as a whole are settled by counting them; a task gives the suffixes of
such a text once. Null texts are empty, texts shorter than ``length`` keep all bytes, repeated rows are
copies of each other. Input columns named ``doc_id``/``text`` may have other names; others are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vidstrata.llm.common import _VALUES, apart, as_bytes, inverse_powers, mix, powers, shuffle_partitions, small_batches, stored
from vidstrata.operators.keys import HOT_SHARE

LENGTH = 200
HOT = 50_000
BLOCK = 1 << 20
CHUNK_ROWS = 8192
FEW_BYTES = 48 << 20  # keys of documents that may be broadcast to spare a shuffle of texts


def gram_size(length: int) -> int:
    return max(length * 64 // 200, 4)


def rolling(data: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all strings of ``size`` bytes."""
    n = len(data)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_VALUES[data] * powers(n), out=total[1:])
    return mix((total[size:] - total[:-size]) * inverse_powers(n - size + 1))


def anchors(text: bytes, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and place of every anchor."""
    k = gram_size(length)
    hashes, places = [], []
    for begin in range(0, len(text) - length + 1, BLOCK):
        part = np.frombuffer(text, dtype=np.uint8)[begin : begin + BLOCK + length - 1]
        h = rolling(part, k)
        low = np.uint64((1 << 21) - 1)
        # the place in the low bits, larger ones first, makes the least value name its place
        least = (h & ~low) | (low - np.arange(len(h), dtype=np.uint64))
        width, wanted = 1, length - k + 1
        while width * 2 <= wanted:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        rest = wanted - width
        if rest:
            least = np.minimum(least[:-rest], least[rest:])
        at = np.unique((low - (least & low)).astype(np.int64))
        hashes.append(h[at])
        places.append(at + begin)
    if not places:
        return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
    place, first = np.unique(np.concatenate(places), return_index=True)
    return np.concatenate(hashes)[first], place


def thinned(text: bytes, hashes: np.ndarray, places: np.ndarray, length: int):
    """Anchors with the same surroundings in one text: their spans, and one of each.

    In a periodic text all anchors but a few look alike, and all strings around them repeat.
    """
    left = length - gram_size(length)
    inner = (places >= left) & (places + length <= len(text))
    if inner.sum() < 2:
        return [], hashes, places
    data = np.frombuffer(text, dtype=np.uint8)
    at = np.flatnonzero(inner)
    order = np.argsort(hashes[at], kind="stable")
    at = at[order]
    same = hashes[at][1:] == hashes[at][:-1]
    if not same.any():
        return [], hashes, places
    in_run = np.concatenate([[False], same]) | np.concatenate([same, [False]])
    rows = at[in_run]
    around: dict[bytes, list[int]] = {}
    for i in rows.tolist():
        p = int(places[i])
        around.setdefault(data[p - left : p + length].tobytes(), []).append(i)
    drop, spans = [], []
    for alike in around.values():
        if len(alike) > 1:
            drop += alike[1:]
            spans += [(int(places[i]) - left, int(places[i]) + length) for i in alike]
    keep = np.ones(len(places), dtype=bool)
    keep[drop] = False
    return merged(spans), hashes[keep], places[keep]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def multikey_order(group: np.ndarray, words: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of rows by (group, words, size), and how many words each shares with the one before.

    Sorts by one word at a time and goes on only with the rows that are still equal.
    """
    order = np.lexsort((sizes, group))
    same = np.zeros(len(group), dtype=bool)
    same[1:] = group[order][1:] == group[order][:-1]
    shared = np.zeros(len(group), dtype=np.int64)
    shared[~same] = -1
    for depth in range(words.shape[1]):
        tied = np.flatnonzero(same | np.concatenate([same[1:], [False]]))
        if not len(tied):
            break
        bucket = np.cumsum(~same)[tied]
        rows = order[tied]
        order[tied] = rows[np.lexsort((words[rows, depth], bucket))]
        column = words[order, depth]
        equal = np.zeros(len(group), dtype=bool)
        equal[1:] = column[1:] == column[:-1]
        same &= equal
        shared[same] = depth + 1
    return order, shared


def common_bytes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    differ = a != b
    return np.where(differ.any(axis=1), differ.argmax(axis=1), a.shape[1])


def padded(parts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``width`` bytes, zeros at the end, and their lengths."""
    sizes = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
    data = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in parts), dtype=np.uint8)
    return data.reshape(len(parts), width), sizes


def repeated_offsets(group: np.ndarray, after: list[bytes], before: list[bytes], reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest offset at which a row's string repeats in its group; -1 where none does.

    The string at offset o has o bytes before the anchor and reach - o bytes after the leading ones.
    ``before`` is given backwards.
    """
    n = len(group)
    width = -(-reach // 8) * 8
    right, right_size = padded(after, width)
    left, left_size = padded(before, max(reach, 1))
    order, shared = multikey_order(group, right.view(">u8"), right_size)
    right, right_size, left, left_size = right[order], right_size[order], left[order], left_size[order]
    common = np.full(n, -1, dtype=np.int64)
    inner = np.flatnonzero(shared >= 0)
    common[inner] = common_bytes(right[inner - 1], right[inner])
    common[inner] = np.minimum(common[inner], np.minimum(right_size[inner - 1], right_size[inner]))
    least = np.full(n, -1, dtype=np.int64)
    largest = np.full(n, -1, dtype=np.int64)
    hashed = np.zeros(n, dtype=np.uint64)
    step = powers(reach + 1)
    for o in range(reach + 1):
        if o:
            hashed = hashed + _VALUES[left[:, o - 1]] * step[o]
        rows = np.flatnonzero((left_size >= o) & (right_size >= reach - o))
        run = np.cumsum(common < reach - o)[rows].astype(np.uint64)
        key = mix(hashed[rows] + mix(run))
        by_key = np.argsort(key, kind="stable")
        equal = key[by_key][1:] == key[by_key][:-1]
        twice = np.concatenate([[False], equal]) | np.concatenate([equal, [False]]) if len(rows) else equal
        hit = rows[by_key[twice]] if len(rows) else rows
        least[hit] = np.where(least[hit] < 0, o, least[hit])
        largest[hit] = o
    back = np.empty(n, dtype=np.int64)
    back[order] = np.arange(n)
    return least[back], largest[back]


def base(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    whole = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(doc_id).alias("doc_id"), whole.alias("text")).withColumn("digest", F.xxhash64("text"))


def find_anchors(texts: DataFrame, length: int) -> DataFrame:
    """(h, doc_id, digest, place, end): anchors, or with a null h spans already known to repeat."""
    kind = texts.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator):
        seen = set()
        for batch in batches:
            ids, raw, digests = batch.column(0), as_bytes(batch.column(1)), batch.column(2).to_pylist()
            row, hs, starts, ends = [], [], [], []
            for i, data in enumerate(raw):
                if digests[i] in seen:
                    continue
                seen.add(digests[i])
                spans, h, p = thinned(data, *anchors(data, length), length)
                row.append(np.full(len(h), i))
                hs.append(pa.array(h.view(np.int64)))
                starts.append(p)
                ends.append(p)
                if spans:
                    row.append(np.full(len(spans), i))
                    hs.append(pa.nulls(len(spans), pa.int64()))
                    starts.append(np.array([a for a, _ in spans]))
                    ends.append(np.array([b for _, b in spans]))
            if row:
                at = pa.array(np.concatenate(row).astype(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.concat_arrays(hs),
                        ids.take(at),
                        batch.column(2).take(at),
                        pa.array(np.concatenate(starts).astype(np.int64)),
                        pa.array(np.concatenate(ends).astype(np.int64)),
                    ],
                    names=["h", "doc_id", "digest", "place", "end"],
                )

    return texts.mapInArrow(run, f"h bigint, doc_id {kind}, digest bigint, place bigint, end bigint")


def few(keys: DataFrame) -> bool:
    """Whether the values of ``keys``, with some 16 bytes a row to hold them, are small enough for a broadcast."""
    sizes = [F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) for c in keys.columns]
    return (keys.agg(F.sum(sum(sizes, F.lit(16))).alias("held")).first().held or 0) <= FEW_BYTES


def repeated(rows: DataFrame, keys: list[str], counts: DataFrame, once: bool = False) -> DataFrame:
    """``rows`` whose keys are in the written table ``counts`` (keys, times), with their ``times``; ``once``: all rows, others with null.

    Keys that hold more than 1/HOT_SHARE of the counted rows, so at most HOT_SHARE keys, are broadcast
    and their rows stay where they are; the rest is joined by shuffle. Null keys are in no table.
    """
    total = counts.agg(F.sum("times").alias("total")).first().total or 0
    hot = F.broadcast(counts.where(F.col("times") * HOT_SHARE > total))
    there = rows.join(hot, keys)
    others = rows.join(hot.select(*keys), keys, "left_anti")
    return there.unionByName(others.join(counts.where(F.col("times") * HOT_SHARE <= total), keys, "left" if once else "inner"))


def only_with(texts: DataFrame, keys: DataFrame, doc_id: Column, key: Column) -> DataFrame:
    """Rows of ``texts`` that have a key, cut down before a later join if the keys are few."""
    if not few(keys.select(key.alias("__key"))):
        return texts
    return texts.join(F.broadcast(keys.select(key.alias("__key")).distinct()), doc_id.eqNullSafe(F.col("__key")), "left_semi")


def surroundings(texts: DataFrame, places: DataFrame, length: int) -> DataFrame:
    """(lead, after, before, doc_id, digest, place, n) of each anchor; before is backwards."""
    k = gram_size(length)
    kind = texts.schema["doc_id"].dataType.simpleString()
    own = places.groupBy(F.col("doc_id").alias("of"), F.col("digest").alias("of_digest")).agg(
        F.collect_list(F.struct("place", "n")).alias("places")
    )
    some = only_with(texts, own, F.col("digest"), F.col("of_digest"))
    joined = some.join(own, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("digest") == F.col("of_digest")))
    joined = joined.select("doc_id", "text", "digest", "places.place", "places.n")

    def run(batches: Iterator):
        for batch in batches:
            raw, places, ns = as_bytes(batch.column(1)), batch.column(3).to_pylist(), batch.column(4).to_pylist()
            for i, data in enumerate(raw):
                own = sorted(set(zip(places[i], ns[i], strict=True)))
                for c in range(0, len(own), 5000):
                    some = own[c : c + 5000]
                    at = [p for p, _ in some]
                    ids = pa.array(np.full(len(some), i))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([data[p : p + k] for p in at], type=pa.binary()),
                            pa.array([data[p + k : p + length] for p in at], type=pa.binary()),
                            pa.array([data[max(p - length + k, 0) : p][::-1] for p in at], type=pa.binary()),
                            batch.column(0).take(ids),
                            batch.column(2).take(ids),
                            pa.array(at, type=pa.int64()),
                            pa.array([n for _, n in some], type=pa.int64()),
                        ],
                        names=["lead", "after", "before", "doc_id", "digest", "place", "n"],
                    )

    return joined.mapInArrow(run, f"lead binary, after binary, before binary, doc_id {kind}, digest bigint, place bigint, n bigint")


def compare_sorted(suffixes: DataFrame, length: int) -> DataFrame:
    """(doc_id, digest, place, end) of what repeats around each suffix; leads whole and in order."""
    reach = length - gram_size(length)
    kind = suffixes.schema["doc_id"].dataType.simpleString()

    def found(rows: pa.Table):
        lead = rows.column("lead").combine_chunks().dictionary_encode()
        lead = lead.combine_chunks() if isinstance(lead, pa.ChunkedArray) else lead
        group = lead.indices.to_numpy()
        after, before = rows.column("after").to_pylist(), rows.column("before").to_pylist()
        least, largest = repeated_offsets(group, after, before, reach)
        hit = np.flatnonzero(least >= 0)
        place = rows.column("place").to_numpy()[hit]
        at = pa.array(hit)
        return pa.RecordBatch.from_arrays(
            [
                rows.column("doc_id").combine_chunks().take(at),
                rows.column("digest").combine_chunks().take(at),
                pa.array(place - largest[hit]),
                pa.array(place - least[hit] + length),
            ],
            names=["doc_id", "digest", "place", "end"],
        )

    def run(batches: Iterator):
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows < CHUNK_ROWS:
                continue
            table = pa.Table.from_batches(held)
            lead = table.column("lead")
            last = lead[rows - 1]
            # the last lead may go on in the next batch
            begin = rows - 1
            while begin > 0 and lead[begin - 1] == last:
                begin -= 1
            if begin:
                yield found(table.slice(0, begin))
            held = table.slice(begin).to_batches()
            rows -= begin
        if rows:
            yield found(pa.Table.from_batches(held))

    return suffixes.mapInArrow(run, f"doc_id {kind}, digest bigint, place bigint, end bigint")


def compare_hot(suffixes: DataFrame, length: int) -> DataFrame:
    """The same for leads that too many suffixes share, spread by the hashes of the strings around them."""
    reach = length - gram_size(length)
    kind = suffixes.schema["doc_id"].dataType.simpleString()
    known = suffixes.withColumn("around", F.xxhash64("after", "before"))
    whole = (F.octet_length("after") == reach) & (F.octet_length("before") == reach)

    def run(batches: Iterator):
        for batch in batches:
            lead, after, before = (as_bytes(batch.column(i)) for i in range(3))
            row, offset, hashed = [], [], []
            for i in range(batch.num_rows):
                data = np.frombuffer(before[i][::-1] + lead[i] + after[i], dtype=np.uint8)
                if len(data) < length:
                    continue
                h = rolling(data, length)
                row.append(np.full(len(h), i))
                offset.append(len(before[i]) - np.arange(len(h)))
                hashed.append(h.view(np.int64))
            if row:
                at = pa.array(np.concatenate(row))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(j).take(at) for j in (3, 4, 5)] + [pa.array(np.concatenate(offset)), pa.array(np.concatenate(hashed))],
                    names=["doc_id", "digest", "place", "o", "string"],
                )

    # one of each kind of surroundings stands for all of them, but at the ends of texts each for itself
    kinds = known.where(whole).groupBy("lead", "around").agg(
        F.min(F.struct("after", "before", "doc_id", "digest", "place")).alias("one"), F.count("*").alias("times")
    )
    kinds = stored(kinds, "repeats-kinds")
    settled = repeated(known.where(whole), ["lead", "around"], kinds.where("times > 1").select("lead", "around", "times"))
    settled = settled.select("doc_id", "digest", (F.col("place") - reach).alias("place"), (F.col("place") + length).alias("end"))
    single = kinds.select("lead", "one.*").unionByName(known.where(~whole).drop("around", "n"))
    strings = single.select("lead", "after", "before", "doc_id", "digest", "place").mapInArrow(
        run, f"doc_id {kind}, digest bigint, place bigint, o bigint, string bigint"
    )
    strings = stored(strings, "repeats-strings")
    counted = stored(strings.groupBy("o", "string").agg(F.count("*").alias("times")).where("times > 1"), "repeats-counted")
    hit = repeated(strings, ["o", "string"], counted)
    open_ = hit.groupBy("doc_id", "digest", F.col("place").alias("at")).agg(F.max("o").alias("most"), F.min("o").alias("least"))
    open_ = open_.select("doc_id", "digest", (F.col("at") - F.col("most")).alias("place"), (F.col("at") - F.col("least") + length).alias("end"))
    return settled.unionByName(open_)


def repeated_spans(docs: DataFrame, length: int = LENGTH, doc_id: str = "doc_id", text: str = "text", hot: int = HOT) -> DataFrame:
    """(doc_id, digest, spans): the spans of each text that repeat, if it has any and occurs once as a whole."""
    spark = docs.sparkSession
    texts = base(docs, doc_id, text).where(F.octet_length("text") >= length)
    small_batches(spark, 500)
    anchors_ = stored(find_anchors(texts, length), "repeats-anchors")
    found = anchors_.where("h IS NOT NULL")
    often = stored(found.groupBy("h").agg(F.count("*").alias("times")).where("times > 1"), "repeats-often")
    places = repeated(found, ["h"], often).select("doc_id", "digest", "place", F.col("times").alias("n"))
    suffixes = stored(surroundings(texts, places, length), "repeats-suffixes")
    small_batches(spark, 4000)
    buckets = shuffle_partitions(spark)
    ordered = suffixes.where(F.col("n") <= hot).repartitionByRange(buckets, "lead").sortWithinPartitions("lead")
    spans = compare_sorted(ordered, length)
    if not suffixes.where(F.col("n") > hot).isEmpty():
        spans = spans.unionByName(compare_hot(suffixes.where(F.col("n") > hot), length))
    known = anchors_.where("h IS NULL").select("doc_id", "digest", "place", "end")
    every = spans.unionByName(known).groupBy("doc_id", "digest").agg(F.sort_array(F.collect_list(F.struct("place", "end"))).alias("spans"))
    return stored(every, "repeats-spans")


def copies(docs: DataFrame, length: int, doc_id: str, text: str) -> DataFrame:
    """(doc_id, digest, n_bytes, sha, copied) of every row."""
    rows = base(docs, doc_id, text).select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha"))
    rows = stored(rows, "repeats-rows")
    twice = rows.where(F.col("n_bytes") >= length).groupBy("sha").agg(F.count("*").alias("times")).where("times > 1")
    marked = repeated(rows, ["sha"], stored(twice, "repeats-copies"), once=True)
    return marked.withColumn("copied", F.col("times").isNotNull()).drop("times")


def cut(docs: DataFrame, length: int = LENGTH, doc_id: str = "doc_id", text: str = "text", hot: int = HOT, with_text: bool = False) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256; ``with_text`` adds digest and
    kept, the remaining text of texts that lose some (characters cut in two are dropped)."""
    small_batches(docs.sparkSession, 500)
    spans = repeated_spans(docs, length, doc_id, text, hot)
    small_batches(docs.sparkSession, 500)
    kind = docs.schema[doc_id].dataType.simpleString()
    texts = base(docs, doc_id, text)
    own = spans.select(F.col("doc_id").alias("of"), F.col("digest").alias("of_digest"), "spans")
    some = only_with(texts, own, F.col("digest"), F.col("of_digest")).dropDuplicates(["doc_id", "digest"])
    joined = some.join(own, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("digest") == F.col("of_digest")))
    joined = joined.select("doc_id", "text", "digest", "spans.place", "spans.end")

    def run(batches: Iterator):
        import hashlib

        for batch in batches:
            raw, starts, ends = as_bytes(batch.column(1)), batch.column(3).to_pylist(), batch.column(4).to_pylist()
            out = {"removed": [], "n_spans": [], "kept_sha": [], "kept": []}
            for data, a, b in zip(raw, starts, ends, strict=True):
                gone = merged(list(zip(a, b, strict=True)))
                edges = [0, *(x for span in gone for x in span), len(data)]
                kept = b"".join(data[edges[j] : edges[j + 1]] for j in range(0, len(edges), 2))
                out["removed"].append(len(data) - len(kept))
                out["n_spans"].append(len(gone))
                out["kept_sha"].append(hashlib.sha256(kept).hexdigest())
                out["kept"].append(kept.decode("utf-8", "ignore") if with_text else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array(out["removed"], type=pa.int64()),
                    pa.array(out["n_spans"], type=pa.int64()),
                    pa.array(out["kept_sha"], type=pa.string()),
                    pa.array(out["kept"], type=pa.string()),
                ],
                names=["of", "of_digest", "removed", "n_spans", "kept_sha", "kept"],
            )

    done = joined.mapInArrow(run, f"of {kind}, of_digest bigint, removed bigint, n_spans bigint, kept_sha string, kept string")
    done = stored(done, "repeats-cut")
    rows = copies(docs, length, doc_id, text)
    both = rows.join(done, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("digest") == F.col("of_digest")), "left")
    copied = F.col("copied")
    none = F.sha2(F.lit(""), 256)
    return both.select(
        "doc_id",
        "n_bytes",
        F.when(copied, F.col("n_bytes")).otherwise(F.coalesce("removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copied, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copied, none).otherwise(F.coalesce("kept_sha", F.col("sha"))).alias("kept_sha256"),
        *([F.col("digest"), F.when(copied, F.lit("")).otherwise(F.col("kept")).alias("kept"), F.when(copied, True).otherwise(F.col("removed").isNotNull()).alias("changed")] if with_text else []),
    )


@apart
def without_repeats(docs: DataFrame, length: int = LENGTH, doc_id: str = "doc_id", text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """``docs`` with what repeats cut out of their texts, and ``n_chars`` (if there is one) counted anew."""
    found = cut(docs, length, doc_id, text, with_text=True).where("changed").select(F.col("doc_id").alias("__of"), F.col("digest").alias("__of_digest"), F.col("kept").alias("__kept"))
    found = stored(found.dropDuplicates(["__of", "__of_digest"]), "repeats-changed")
    rows = docs.withColumn("__digest", F.xxhash64(F.coalesce(F.col(text), F.lit(""))))
    same = F.col(doc_id).eqNullSafe(F.col("__of")) & (F.col("__digest") == F.col("__of_digest"))
    keys = found.select("__of", "__of_digest")
    keys = F.broadcast(keys) if few(keys) else keys
    unchanged = rows.join(keys, same, "left_anti")
    changed = rows.drop(text).join(keys, same, "left_semi").join(found, same).withColumn(text, F.col("__kept"))
    if n_chars in docs.columns:
        changed = changed.withColumn(n_chars, F.char_length(F.col(text)).cast(docs.schema[n_chars].dataType))
    return unchanged.select(docs.columns).unionByName(changed.select(docs.columns))
