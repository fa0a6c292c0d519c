"""SimHash fingerprints of texts, and all fingerprints within a Hamming radius of each other.

The terms of a text are its pairs of neighbouring words (A-Z as a-z; a text of one word has that word).
A term weighs 1 + ln of how often the text has it, and votes with the bits of its hash for or against
each bit of the fingerprint. Null texts are empty; a text without words has no votes and all bits 0.
Equal texts have equal fingerprints. The likeness of two is the share of equal bits.

``with_neighbours`` counts for every document the others within a Hamming radius by block tables, without
a row for each pair; ``within_radius`` lists the pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vidstrata.llm.common import Words, free_name, groups, mix, powers, shuffle_partitions, small_batches, stored

BITS = 256
EMPTY = bytes(BITS // 8)
HOT = 1000  # so many fingerprints with one key of blocks are split by further blocks
RADIUS = 7  # 8 tables, each with 32 bits as its key
DIGITS = BITS // 4
LOW = 63  # the bits of a key that hold the number of its block


def fingerprint(terms: np.ndarray) -> bytes:
    """Of the hashes of a text's terms."""
    if not len(terms):
        return EMPTY
    term, times = np.unique(terms, return_counts=True)
    weight = (1 + np.log(times)).astype(np.float32)
    halves = np.stack([mix(term + powers(8)[j + 1]) for j in range(BITS // 64)], axis=1)
    votes = np.zeros(BITS, dtype=np.float32)
    for a in range(0, len(term), 4096):  # a few rows of bits at a time
        bits = np.unpackbits(halves[a : a + 4096].view(np.uint8), axis=1).astype(np.float32)
        votes += weight[a : a + 4096] @ bits
    # half of all weight is the even vote; float sums in a fixed order, so equal texts agree
    return np.packbits(votes > weight.sum() / 2).tobytes()


def fingerprints(texts: list[bytes]) -> list[bytes]:
    out = []
    for a, b in groups(texts):
        words = Words(texts[a:b])
        h, first = words.hash, words.first_word
        pairs = mix(h[:-1] * powers(3)[1] + h[1:] * powers(3)[2]) if len(h) else h
        for i in range(b - a):
            start, end = int(first[i]), int(first[i + 1])
            out.append(fingerprint(pairs[start : end - 1] if end - start > 1 else h[start:end]))
    return out


def likeness(a: bytes, b: bytes) -> float:
    return 1 - (int.from_bytes(a) ^ int.from_bytes(b)).bit_count() / BITS


def edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


STARTS = range(1, BITS // 4, 16)  # of the 64-bit numbers in the hex form
RESULT = "doc_id {kind}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
EDGE = ", part int, edge string, own string"
NAMES = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "part", "edge", "own")


def pairs_of(texts: list[str], prints: list[bytes]) -> dict[str, list]:
    """Results of all texts but the last, each followed by the next."""
    changed = [edited(a, b) for a, b in zip(texts, texts[1:], strict=False)]
    raw = [t.encode() for t in changed]
    new = fingerprints(raw)
    return {
        "n_chars": [len(t) for t in texts[:-1]],
        "edited_sha256": [hashlib.sha256(r).hexdigest() for r in raw],
        "fingerprint": [p.hex() for p in prints[:-1]],
        "edited_fingerprint": [p.hex() for p in new],
        "near_edited": [likeness(p, q) for p, q in zip(prints, new, strict=False)],
        "near_next": [likeness(p, q) for p, q in zip(prints, prints[1:], strict=False)],
    }


def with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of each text, of its edited text, and how near both and the next text's are.

    The next document is the one after it in descending doc_id (null ids last, equal ids by text hash),
    the first one after the last. Documents are dealt out by ranges of ids; the last of each range meets
    the first of the next in a second step, which has a row or two for each range.
    """
    spark = docs.sparkSession
    kind = docs.schema[doc_id].dataType.simpleString()
    small_batches(spark, 500)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    order = [F.col("doc_id").desc_nulls_last(), F.col("tie")]
    rows = rows.repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order)
    rows = rows.select("doc_id", "text", F.spark_partition_id().alias("part"))

    def run(batches: Iterator):
        held_id = held_text = held_print = part = None

        def batch_of(ids, columns, edge, own=None):
            n = len(columns["n_chars"])
            fixed = {"part": [part] * n, "edge": [edge] * n, "own": [own] * n}
            columns = columns | fixed
            return pa.RecordBatch.from_arrays(
                [ids, *(pa.array(columns[c], type=t) for c, t in zip(NAMES[1:], TYPES, strict=True))], names=list(NAMES)
            )

        def lone(edge):
            columns = {"n_chars": [len(held_text)], "fingerprint": [held_print.hex()]}
            return batch_of(held_id, {c: columns.get(c, [None]) for c in NAMES[1:7]}, edge, held_text)

        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch.column(2)[0].as_py()
            texts = batch.column(1).to_pylist()
            prints = fingerprints([t.encode() for t in texts])
            ids = batch.column(0)
            if held_id is None:
                held_id, held_text, held_print = ids.slice(0, 1), texts[0], prints[0]
                yield lone("first")
            else:
                texts, prints = [held_text, *texts], [held_print, *prints]
                ids = pa.concat_arrays([held_id, ids])
            if len(texts) > 1:
                yield batch_of(ids.slice(0, len(texts) - 1), pairs_of(texts, prints), "")
            held_id, held_text, held_print = ids.slice(len(texts) - 1, 1), texts[-1], prints[-1]
        if held_id is not None:
            yield lone("last")

    found = stored(rows.mapInArrow(run, RESULT.format(kind=kind) + EDGE), "simhash")
    inner = found.where("edge = ''").select(*NAMES[:7])
    firsts = found.where("edge = 'first'").select("part", F.struct("part", F.col("own").alias("next"), F.col("fingerprint").alias("next_print")).alias("head"))
    lasts = found.where("edge = 'last'").select("part", "doc_id", "own", "fingerprint")
    # a row for each range of ids
    after = F.coalesce(F.lead("head").over(W.orderBy("part")), F.first("head").over(W.orderBy("part")))
    heads = firsts.withColumn("after", after).select(F.col("part").alias("of"), "after")
    edges = lasts.join(heads, F.col("part") == F.col("of")).select("doc_id", "own", "fingerprint", "after.next", "after.next_print")

    def finish(batches: Iterator):
        for batch in batches:
            out = {c: [] for c in NAMES[1:7]}
            for own, mark, nxt, next_mark in zip(*(batch.column(i).to_pylist() for i in range(1, 5)), strict=True):
                one = pairs_of([own, nxt], [bytes.fromhex(mark), bytes.fromhex(next_mark)])
                for c in out:
                    out[c] += one[c]
            arrays = [pa.array(out[c], type=t) for c, t in zip(NAMES[1:7], TYPES[:6], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=list(NAMES[:7]))

    return inner.unionByName(edges.mapInArrow(finish, RESULT.format(kind=kind)))


TYPES = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int32(), pa.string(), pa.string())


def simhash(docs: DataFrame, text: str = "text", into: str = "fingerprint") -> DataFrame:
    """``docs`` with the fingerprint of each text as hex."""
    import pandas as pd

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([p.hex() for p in fingerprints([(t or "").encode() for t in texts])])

    return docs.withColumn(into, run(F.col(text)))


def block_tables(prints: DataFrame, radius: int, fingerprint_column: str = "fingerprint", spare: int = 2) -> DataFrame:
    """(mark, table, key): two fingerprints at most ``radius`` bits apart have a table and key in common.

    Of radius + spare blocks, two such fingerprints agree on at least ``spare``. A table for each choice of
    ``spare`` blocks has their bits as its key. Where more than ``HOT`` have one key, the other bits are cut
    into radius + 1 blocks, of which they agree on one at least, and each of them is added to the key.
    """
    n = radius + spare
    edges = [BITS * i // n for i in range(n + 1)]
    bits = [F.lpad(F.conv(F.substring("mark", s, 16), 16, 2), 64, "0") for s in STARTS]
    own = prints.select(F.col(fingerprint_column).alias("mark")).where("mark IS NOT NULL").distinct()
    own = own.withColumn("bits", F.concat(*bits))
    keys = []
    for number, chosen in enumerate(combinations(range(n), spare)):
        parts = [F.substring("bits", edges[i] + 1, edges[i + 1] - edges[i]) for i in chosen]
        others = [F.substring("bits", edges[i] + 1, edges[i + 1] - edges[i]) for i in range(n) if i not in chosen]
        keys.append(F.struct(F.lit(number).alias("table"), F.concat(*parts).alias("key"), F.concat(F.lit(""), *others).alias("rest")))
    tables = own.select("mark", F.explode(F.array(*keys)).alias("k")).select("mark", "k.table", "k.key", "k.rest")
    tables = stored(tables, "simhash-blocks")
    hot = tables.groupBy("table", "key").agg(F.count("*").alias("n")).where(F.col("n") > HOT).drop("n")
    cold = tables.join(hot, ["table", "key"], "left_anti").select("mark", "table", "key")
    size = F.length("rest")
    further = []
    for i in range(radius + 1):
        start, end = (F.floor(size * j / (radius + 1)).cast("int") for j in (i, i + 1))
        further.append(F.concat("key", F.lit(f":{i}:"), F.substring("rest", start + 1, end - start)))
    split = tables.join(hot, ["table", "key"]).select("mark", "table", F.explode(F.array(*further)).alias("key"))
    return cold.unionByName(split)


def within_radius(prints: DataFrame, radius: int, fingerprint_column: str = "fingerprint", spare: int = 2) -> DataFrame:
    """(a, b, distance), a < b: all pairs of different hex fingerprints at most ``radius`` bits apart.

    Permuted block tables; only equal keys are compared. Equal fingerprints are one row here, so copies make
    no pairs.
    """
    tables = block_tables(prints, radius, fingerprint_column, spare)
    left, right = tables.withColumnRenamed("mark", "a"), tables.withColumnRenamed("mark", "b")
    near = left.join(right, ["table", "key"]).where("a < b")
    distance = F.lit(0)
    for s in STARTS:
        one, two = (F.conv(F.substring(c, s, 16), 16, -10).cast("long") for c in ("a", "b"))
        distance = distance + F.bit_count(one.bitwiseXOR(two))
    return near.select("a", "b", distance.cast("int").alias("distance")).where(F.col("distance") <= radius).distinct()


def block_edges(size: int, radius: int) -> list[int]:
    """``radius`` + 1 blocks of ``size`` hex digits."""
    return [size * i // (radius + 1) for i in range(radius + 2)]


def block_keys(digits: Column, edges: list[Column | int], *salt: Column) -> Column:
    """Array of the keys of a text's blocks; equal blocks have equal keys, which hold the block's number."""
    keys = []
    for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
        block = F.substring(digits, F.lit(a) + 1, F.lit(b) - F.lit(a))
        keys.append(F.xxhash64(*salt, F.lit(i), block).bitwiseAND(F.lit(~LOW)).bitwiseOR(F.lit(i)))
    return F.array(*keys)


def block_units(marks: DataFrame, radius: int) -> DataFrame:
    """Rows (key, further, cell, cross, tile, mark, n) of ``marks`` (mark binary, n): units of marks to be compared.

    Two marks at most ``radius`` bits apart agree in one of ``radius`` + 1 blocks, so they have a key in
    common. Keys with more than ``HOT`` marks are split by a block of the other bits, of which there are
    ``radius`` + 1 again. What is still more is dealt into tiles of about ``HOT`` marks, and each two tiles
    are a cell: a unit has about 2 * ``HOT`` rows at most, whatever the data.
    """
    digits = F.hex("mark")
    edges = block_edges(DIGITS, radius)
    entries = marks.select("mark", "n", F.explode(block_keys(digits, edges)).alias("key"))
    sizes = entries.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    entries = entries.join(stored(sizes, "simhash-keys"), "key")
    whole = entries.where(F.col("size") <= HOT).withColumn("further", F.lit(0).cast("long")).withColumn("tiles", F.lit(1).cast("long"))

    start, end = (F.element_at(F.array(*map(F.lit, e)), F.col("key").bitwiseAND(F.lit(LOW)).cast("int") + 1) for e in (edges[:-1], edges[1:]))
    rest = F.concat(F.substring(digits, F.lit(1), start), F.substring(digits, end + 1, F.lit(DIGITS)))
    left = F.length(rest)
    inner = [F.floor(left * i / (radius + 1)).cast("int") for i in range(radius + 2)]
    split = entries.where(F.col("size") > HOT).drop("size")
    split = split.withColumn("further", F.explode(block_keys(rest, inner, F.col("key"))))
    sizes = split.groupBy("key", "further").agg(F.count("*").alias("size")).where("size > 1")
    split = split.join(stored(sizes, "simhash-further"), ["key", "further"]).withColumn("tiles", F.ceil(F.col("size") / HOT))

    tile = F.pmod(F.xxhash64("mark"), F.col("tiles"))
    rows = whole.unionByName(split).withColumn("tile", tile)
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
    cell = F.least("tile", "other") * F.col("tiles") + F.greatest("tile", "other")
    # row and column of a cell differ where two tiles meet; a tile by itself is the cell on the diagonal
    return rows.select("key", "further", cell.alias("cell"), (F.col("tile") != F.col("other")).alias("cross"), "tile", "mark", "n")


def first_equal(differs: np.ndarray, edges: list[int]) -> np.ndarray:
    """Of each row the first block without a difference."""
    return np.logical_or.reduceat(differs, edges[:-1], axis=1).argmin(axis=1)


def counted_once(apart: np.ndarray, key: np.ndarray, further: np.ndarray, radius: int) -> np.ndarray:
    """Whether a pair (bytes of its exclusive or) is met here for the first time: other keys hold it too."""
    differs = np.stack([apart >> 4, apart & 15], axis=2).reshape(len(apart), DIGITS) != 0
    edges = block_edges(DIGITS, radius)
    here = first_equal(differs, edges) == key & LOW
    for block in range(radius + 1):
        rows = np.flatnonzero(here & (further != 0) & (key & LOW == block))
        if len(rows):
            rest = np.delete(differs[rows], slice(edges[block], edges[block + 1]), axis=1)
            here[rows] = first_equal(rest, block_edges(rest.shape[1], radius)) == further[rows] & LOW
    return here


def neighbours_within(units: list[np.ndarray], radius: int) -> np.ndarray:
    """Of each row how many documents the marks near it in its unit have; rows of a unit are next to each other."""
    key, further, cell, cross, tile, marks, n = units
    rows = len(key)
    bits = marks.view(np.uint64)
    new = np.ones(rows, dtype=bool)
    new[1:] = (key[1:] != key[:-1]) | (further[1:] != further[:-1]) | (cell[1:] != cell[:-1])
    ends = np.append(np.flatnonzero(new)[1:], rows)
    end = ends[np.cumsum(new) - 1]
    near = np.zeros(rows, dtype=np.int64)
    live, step = np.arange(rows), 0
    while True:  # all rows with the one ``step`` behind them
        step += 1
        live = live[live + step < end[live]]
        if not len(live):
            return near
        one = live[~cross[live] | (tile[live] != tile[live + step])]
        distance = np.bitwise_count(bits[one] ^ bits[one + step]).sum(axis=1, dtype=np.int64)
        one = one[distance <= radius]
        if len(one):
            one = one[counted_once(marks[one] ^ marks[one + step], key[one], further[one], radius)]
            near[one] += n[one + step]
            near[one + step] += n[one]


def near_counts(marks: DataFrame, radius: int) -> DataFrame:
    """(mark, near): for each of ``marks`` (mark binary, distinct; n, its documents) the documents of other marks
    at most ``radius`` bits apart. Marks without any have no row."""
    units = block_units(marks, radius).repartition("key", "further", "cell").sortWithinPartitions("key", "further", "cell")

    def run(batches: Iterator):
        held = None

        def counted(units):
            near = neighbours_within(units, radius)
            at = np.flatnonzero(near)
            found = [pa.array([m.tobytes() for m in units[5][at]], type=pa.binary()), pa.array(near[at])]
            return pa.RecordBatch.from_arrays(found, names=["mark", "near"])

        for batch in batches:
            if not batch.num_rows:
                continue
            units = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
            marks_ = np.frombuffer(b"".join(batch.column(5).to_pylist()), dtype=np.uint8).reshape(-1, BITS // 8)
            units += [marks_, batch.column(6).to_numpy()]
            if held is not None:
                units = [np.concatenate(two) for two in zip(held, units, strict=True)]
            # the last unit may go on in the next batch
            same = np.logical_and.reduce([units[i] == units[i][-1] for i in range(3)])
            cut = len(same) - int(same.sum())
            held = [x[cut:] for x in units]
            if cut:
                yield counted([x[:cut] for x in units])
        if held is not None:
            yield counted(held)

    found = units.mapInArrow(run, "mark binary, near bigint")
    return found.groupBy("mark").agg(F.sum("near").alias("near"))


def with_neighbours(docs: DataFrame, radius: int = RADIUS, fingerprint_column: str = "fingerprint", into: str = "near_documents") -> DataFrame:
    """``docs`` with the number of other rows whose hex fingerprints are at most ``radius`` bits apart, ``into``.

    Equal fingerprints are one mark, weighed by its rows, so copies cost nothing. Marks are compared where
    they have a block in common; a pair counts where it is met first, so no pairs are written or made
    distinct. Rows without a fingerprint have none near (0); an empty table gives an empty one.
    """
    if not 0 <= radius < DIGITS // 2:
        raise ValueError(f"radius must be 0 to {DIGITS // 2 - 1}")
    mark = free_name(docs, "mark")
    of = F.unhex(F.col(fingerprint_column))
    own = docs.where(F.col(fingerprint_column).isNotNull()).groupBy(of.alias("mark")).agg(F.count("*").alias("n"))
    own = stored(own, "simhash-marks")
    near = own.join(near_counts(own, radius), "mark", "left").select("mark", (F.col("n") - 1 + F.coalesce("near", F.lit(0))).alias(into))
    near = stored(near.where(F.col(into) > 0), "simhash-near").withColumnRenamed("mark", mark)
    found = docs.withColumn(mark, of).join(near, mark, "left").drop(mark)
    return found.withColumn(into, F.coalesce(into, F.lit(0).cast("long")))
