"""Packing of token sequences along a space-filling curve.

A document's words are hashed into a count vector, its direction is projected to ``AXES`` numbers by
fixed random signs, and the place of these on a Hilbert curve is the document's key. Documents are
range-sorted by key (equal keys by a hash of the id, so copies spread over ranges) and their token ids
are laid end to end and cut every ``LENGTH`` ids: near documents share sequences. What is left at the
end of a range is cut into sequences of powers of two, the largest first, so nothing is padded.

Splitters of the ranges are quantiles of a sample of at most about ``SAMPLE`` keys, chosen by a hash of
the id. Null and empty texts have the closing id alone. Repeated rows are packed each.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vidstrata.llm.common import CASED_WORDS, Words, as_bytes, groups, mix, shuffle_partitions, small_batches

LENGTH = 4096
CLOSING = 2
TOKENIZER = "word_bpe_49k.json"
SIGNS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"  # no apostrophe: it may belong to the letters behind it
DIMENSIONS = 1024
AXES = 4
DEPTH = 15  # bits of an axis
SAMPLE = 20_000
REMEMBERED = 1_000_000  # words: some 40 MB
TOGETHER = 1 << 21  # bytes of texts encoded at a time

# Letters end a token, whatever sign or digit follows (but "|", which a special token may hold).
_LETTER = np.array([i < 128 and chr(i).isalpha() for i in range(256)])
_CUT = _LETTER, ~_LETTER & (np.arange(256) < 128) & CASED_WORDS[0] & (np.arange(256) != ord("|"))
_NO_KEYS = np.empty(0, dtype=np.int64)
_SIGNS = (mix(np.arange(1, DIMENSIONS * AXES + 1, dtype=np.uint64)) & np.uint64(1)).astype(np.float32).reshape(DIMENSIONS, AXES) * 2 - 1


def hilbert(points: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """Places on the Hilbert curve of rows of whole numbers below 2^depth."""
    x = points.astype(np.int64).T.copy()
    axes = len(x)
    # undo, from the highest bit down, the turns the curve makes in each cube
    for level in range(depth - 1, 0, -1):
        bit, below = np.int64(1 << level), np.int64((1 << level) - 1)
        for i in range(axes):
            high = (x[i] & bit) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & below)
            x[0] = np.where(high, x[0] ^ below, x[0]) ^ swap
            x[i] ^= swap
    for i in range(1, axes):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for level in range(depth - 1, 0, -1):
        turn ^= np.where((x[axes - 1] & (1 << level)) != 0, (1 << level) - 1, 0)
    x ^= turn
    key = np.zeros_like(x[0])
    for level in range(depth - 1, -1, -1):
        for i in range(axes):
            key = (key << 1) | ((x[i] >> level) & 1)
    return key


def read_words(texts: list[bytes]) -> list[Words]:
    """Words as they are written, cut behind their letters, of consecutive groups of rows."""
    return [Words(texts[a:b], CASED_WORDS, _CUT) for a, b in groups(texts)]


def curve_keys(words: Words) -> np.ndarray:
    out = np.empty(words.rows, dtype=np.int64)
    for a in range(0, words.rows, 256):
        b = min(a + 256, words.rows)
        own = np.arange(words.first_word[a], words.first_word[b])
        own = own[words.start[own] != words.end[own - 1]]  # without what was cut off behind letters
        at = (words.doc[own] - a) * DIMENSIONS + (words.hash[own] % np.uint64(DIMENSIONS)).astype(np.int64)
        counts = np.bincount(at, minlength=(b - a) * DIMENSIONS).reshape(b - a, DIMENSIONS)
        size = np.sqrt((counts.astype(np.float64) ** 2).sum(axis=1, keepdims=True))
        spots = (counts @ _SIGNS.astype(np.float64)) / np.maximum(size, 1)
        # about normal with spread 1: a logistic curve spreads them evenly over the cube
        share = 1 / (1 + np.exp(-1.702 * spots))
        cells = np.minimum((share * (1 << DEPTH)).astype(np.int64), (1 << DEPTH) - 1)
        out[a:b] = hilbert(cells)
    return out


def laid_out(flat: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Runs of ``flat``, one after the other."""
    ends = np.cumsum(counts)
    return flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - counts), counts)]


class Encoder:
    """Token ids of whole texts as 16-bit numbers, remembered word by word.

    The tokenizer never joins characters across white space, nor letters with the signs behind them, so a
    text's ids are those of its words one after the other, and a word's those of its letters and of its
    closing signs. A word is known by its 64-bit hash; the ids of all words known lie in one array. Words
    not met for longest are forgotten beyond ``REMEMBERED``.
    """

    def __init__(self, path: str | None):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has a task for each core
        from tokenizers import Tokenizer

        if path is None:
            import public_tokenizers

            path = public_tokenizers.path(TOKENIZER)
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.wide = max(vocabulary.values()) >= 1 << 16
        self.kind = "<u4" if self.wide else "<u2"
        self.width = 4 if self.wide else 2
        self.closes = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.closes[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        # of each word known, by hash: where its ids begin in ``flat``, how many they are, when it was met last
        self.hash = np.empty(0, dtype=np.uint64)
        self.start = self.count = self.met = np.empty(0, dtype=np.int64)
        self.flat = np.empty(0, dtype=self.kind)
        self.calls = 0

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype=self.kind) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def ids_of(self, words: list[str]) -> list[bytes]:
        bare, signs, other = [], set(), []
        for word in words:
            letters = word.rstrip(SIGNS)
            # the tokenizer lowers words itself; only for Latin-1 letters the result is sure to be the same
            if letters.isalpha() and (letters.isascii() or max(letters) < "\u0100"):
                bare.append(letters.lower())
                signs.add(word[len(letters) :])
            else:
                bare.append(None)
                other.append(word)
        found = {}
        # a run of letters is one piece and ends with the only token that closes a piece
        plain = list({letters for letters in bare if letters})
        some = [plain[a : a + 500] for a in range(0, len(plain), 500)]
        for letters, ids in zip(some, self.ids([" ".join(x) for x in some]), strict=True):
            ends = ((np.flatnonzero(self.closes[ids]) + 1) * self.width).tolist()
            data = ids.tobytes()
            found.update(zip(letters, map(data.__getitem__, map(slice, [0, *ends], ends)), strict=True))
        whole = [*signs, *other]
        found.update((word, ids.tobytes()) for word, ids in zip(whole, self.ids(whole), strict=True))
        return [found[word] if letters is None else found[letters] + found[word[len(letters) :]] for word, letters in zip(words, bare, strict=True)]

    def learn(self, hashes: np.ndarray, words: list[bytes]) -> None:
        """Remember the ids of words not known; ``hashes`` rise."""
        ids = self.ids_of([word.decode("utf-8", "replace") for word in words])
        counts = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // self.width
        starts = len(self.flat) + np.cumsum(counts) - counts
        self.flat = np.concatenate([self.flat, np.frombuffer(b"".join(ids), dtype=self.kind)])
        at = np.searchsorted(self.hash, hashes)
        self.hash = np.insert(self.hash, at, hashes)
        self.start = np.insert(self.start, at, starts)
        self.count = np.insert(self.count, at, counts)
        self.met = np.insert(self.met, at, self.calls)

    def forget(self) -> None:
        keep = self.met > np.median(self.met)
        self.flat = laid_out(self.flat, self.start[keep], self.count[keep])
        self.hash, self.count, self.met = self.hash[keep], self.count[keep], self.met[keep]
        self.start = np.cumsum(self.count) - self.count

    def encode(self, read: list[Words]) -> pa.Array:
        """Ids of each text and the closing id, little-endian; 32-bit numbers if the vocabulary needs it."""
        if len(self.hash) > REMEMBERED:
            self.forget()
        self.calls += 1
        distinct, first, place = np.unique(np.concatenate([w.hash for w in read]), return_index=True, return_inverse=True)
        at = np.searchsorted(self.hash, distinct)
        new = np.ones(len(distinct), dtype=bool)
        inside = at < len(self.hash)
        new[inside] = self.hash[at[inside]] != distinct[inside]
        if new.any():
            begins = np.cumsum([0, *(len(w.hash) for w in read)])
            group = np.searchsorted(begins, first[new], side="right") - 1
            words = []
            for i, w in enumerate(read):
                own = first[new][group == i] - begins[i]
                words.append(map(w.text.__getitem__, map(slice, w.start[own].tolist(), w.end[own].tolist())))
            order = np.argsort(np.argsort(group, kind="stable"), kind="stable")
            words = [word for some in words for word in some]
            self.learn(distinct[new], [words[i] for i in order.tolist()])
            at = np.searchsorted(self.hash, distinct)
        self.met[at] = self.calls
        counts = self.count[at][place]
        ids = laid_out(self.flat, self.start[at][place], counts)
        # a text ends behind its last word, and its closing id is set in there
        sizes = np.concatenate([np.diff(w.first_word) for w in read])
        ends = np.concatenate([[0], np.cumsum(counts)])[np.cumsum(sizes)]
        ids = np.insert(ids, ends, CLOSING)
        offsets = np.concatenate([[0], ends + np.arange(1, len(ends) + 1)]) * self.width
        return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(ids)])


_encoders: dict[str | None, Encoder] = {}


def encoder(path: str | None) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def splitters(docs: DataFrame, ranges: int, doc_id: str, text: str) -> list[tuple[int, int]]:
    """(key, tie) at which ranges begin, from a sample of the documents."""
    rows = docs.count()
    share = min(1.0, SAMPLE / max(rows, 1))
    drawn = docs.where(F.pmod(F.hash(doc_id), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)

    def run(batches: Iterator):
        for batch in batches:
            keys = [curve_keys(words) for words in read_words([t or b"" for t in as_bytes(batch.column(0))])]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([_NO_KEYS, *keys])), batch.column(1)], names=["key", "tie"])

    found = drawn.select(F.col(text), F.xxhash64(doc_id)).mapInArrow(run, "key bigint, tie bigint").toArrow()
    keys = sorted(zip(found.column("key").to_pylist(), found.column("tie").to_pylist(), strict=True))
    return [keys[len(keys) * i // ranges] for i in range(1, ranges)] if keys else []


def tokens(docs: DataFrame, cuts: list[tuple[int, int]], doc_id: str, text: str, path: str | None) -> DataFrame:
    """(bucket, key, tie, doc_id, ids) of each document."""
    kind = docs.schema[doc_id].dataType.simpleString()
    cut_keys = np.array([k for k, _ in cuts], dtype=np.int64)

    def run(batches: Iterator):
        own = encoder(path)
        for batch in batches:
            texts = [t or b"" for t in as_bytes(batch.column(1))]
            for a, b in groups(texts, TOGETHER):
                part = batch.slice(a, b - a)
                read = read_words(texts[a:b])
                keys = np.concatenate([curve_keys(words) for words in read])
                ties = part.column(2).to_pylist()
                buckets = np.searchsorted(cut_keys, keys, side="left")
                for i, key in enumerate(keys):  # equal keys go by their tie
                    while buckets[i] < len(cuts) and cuts[buckets[i]] <= (key, ties[i]):
                        buckets[i] += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(buckets.astype(np.int32)), pa.array(keys), part.column(2), part.column(0), own.encode(read)],
                    names=["bucket", "key", "tie", "doc_id", "ids"],
                )

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(doc_id).alias("tie"))
    return rows.mapInArrow(run, f"bucket int, key bigint, tie bigint, doc_id {kind}, ids binary")


def closing_cuts(size: int) -> list[int]:
    """``size`` as powers of two, the largest first."""
    return [1 << b for b in range(size.bit_length() - 1, -1, -1) if size >> b & 1]


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None, with_ids: bool = False) -> DataFrame:
    """A row for each piece of a document in a sequence; ``with_ids`` adds its token ids."""
    spark = docs.sparkSession
    small_batches(spark, 500)
    ranges = shuffle_partitions(spark)
    cuts = splitters(docs, ranges, doc_id, text)
    rows = tokens(docs, cuts, doc_id, text, path).repartitionById(ranges, F.col("bucket").cast("int"))
    rows = rows.sortWithinPartitions("bucket", "key", "tie", "doc_id", F.crc32("ids"))
    rows = rows.select("doc_id", "ids", F.spark_partition_id().cast("long").alias("part"))
    kind = docs.schema[doc_id].dataType.simpleString()
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def run(batches: Iterator):
        width = encoder(path).width
        part, sequence, filled = 0, 0, 0
        open_pieces: list[tuple] = []  # of the sequence being filled: id, start, ids, tokens of the document

        def laid(pieces, number, ids_of):
            offset, out = 0, {n: [] for n in names[1:]} | {"doc_id": [], "ids": []}
            for own, start, data, total in pieces:
                ids = np.frombuffer(data, dtype=f"<u{width}").astype("<u4")
                out["doc_id"].append(own)
                out["start"].append(start)
                out["length"].append(len(ids))
                out["ids_crc32"].append(zlib.crc32(ids.tobytes()))
                out["doc_tokens"].append(total)
                out["sequence_id"].append((part << 40) + number)
                out["offset"].append(offset)
                if ids_of:
                    out["ids"].append(ids.tolist())
                offset += len(ids)
            return out

        def batch_of(columns):
            arrays = [pa.concat_arrays(columns["doc_id"]), *(pa.array(columns[n], type=pa.int64()) for n in names[1:])]
            if with_ids:
                arrays.append(pa.array(columns["ids"], type=pa.list_(pa.int32())))
            return pa.RecordBatch.from_arrays(arrays, names=names + ["ids"] * with_ids)

        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch.column(2)[0].as_py()
            ready = {n: [] for n in names} | {"ids": []}
            for i, data in enumerate(batch.column(1).to_pylist()):
                own, at, total = batch.column(0).slice(i, 1), 0, len(data) // width
                while at < total:
                    take = min(LENGTH - filled, total - at)
                    open_pieces.append((own, at, data[at * width : (at + take) * width], total))
                    at += take
                    filled += take
                    if filled == LENGTH:
                        for n, values in laid(open_pieces, sequence, with_ids).items():
                            ready[n] += values
                        sequence, filled, open_pieces = sequence + 1, 0, []
            if ready["doc_id"]:
                yield batch_of(ready)
        # the rest of the range, in powers of two
        for size in closing_cuts(filled):
            pieces = []
            while size:
                own, start, data, total = open_pieces.pop(0)
                n = len(data) // width
                if n > size:
                    open_pieces.insert(0, (own, start + size, data[size * width :], total))
                    data, n = data[: size * width], size
                pieces.append((own, start, data, total))
                size -= n
            yield batch_of(laid(pieces, sequence, with_ids))
            sequence += 1

    schema = f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
    return rows.mapInArrow(run, schema + ", ids array<int>" * with_ids)
