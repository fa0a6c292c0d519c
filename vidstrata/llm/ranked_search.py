"""Ranked lexical search by a hybrid of term-at-a-time and document-at-a-time evaluation.

Every text is cut into terms once; what is kept of it are its length and the terms that the items ask for.
Tasks take the documents in shards of at most ``SHARD_ROWS`` rows or ``SHARD_POSTINGS`` postings and turn
each into lists by term, with the largest contribution of each list. For an item the short lists (at most
1 / ``SHORT`` of the shard's documents) are summed term by term into accumulators. The accumulators are then
one more list, with their largest sum as its bound, beside the long ones: ranges of documents are taken in
order, from those lists only that can lift a document to the k-th score; the other lists are looked up,
largest bound first, for the documents that can still reach it, and skipped otherwise. The k-th score goes
on from range to range and from shard to shard; the first one comes from a run over about ``SEED_ROWS``
documents, which changes no result, as only a k-th score that others reach already rules documents out.

Scores are whole numbers by the statistics of all documents: with N documents of at least one term, L terms
in all, n terms in the document, df documents with a term and tf occurrences, a term weighs
w = floor(1000 * ln((2N + 2) / (2df + 1))), and adds w * (10^9 * tf div (1000 * tf + 20 * m)) where
m = 50 + (50 * n * N) div L. Terms are runs of ASCII letters and digits and of any other characters beyond
ASCII, A-Z in lower case, known by a 64-bit hash. Null and empty texts have none. Each item lists its k best
documents with a score above 0. Equal scores go by document id, null last; rows that share an id are documents
each. Items that repeat an id are items each; an item without terms lists nothing. Items are asked in blocks
of about ``ITEM_TERMS`` terms, so what a task holds of them is bounded; each block reads the documents once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vidstrata.llm.common import LOWER_ALNUM_WORDS, Words, as_bytes, groups, in_arrow, pa_schema, stored

SHARD_ROWS = 1 << 15
SHARD_POSTINGS = 1 << 22
SHORT = 16
RANGE = 2048
SEED_ROWS = 50_000
ITEM_TERMS = 1 << 18


def item_terms(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """(item_id, terms): the distinct term hashes of each item."""

    def work(batch):
        texts = [t or b"" for t in as_bytes(batch.column("text"))]
        for begin, end in groups(texts):
            words = Words(texts[begin:end], LOWER_ALNUM_WORDS)
            cut = words.first_word
            terms = [np.unique(words.hash[cut[i] : cut[i + 1]]).view(np.int64) for i in range(words.rows)]
            yield {"item_id": batch.column("item_id")[begin:end], "terms": terms}

    kind = items.schema[item_id].dataType.simpleString()
    rows = items.select(F.col(item_id).alias("item_id"), F.col(text).alias("text"))
    return in_arrow(rows, work, f"item_id {kind}, terms array<bigint>")


def postings(docs: DataFrame, vocabulary: np.ndarray, doc_id: str, text: str) -> DataFrame:
    """(doc_id, n, term, tf): a document's number of terms, and those of the vocabulary by position in it."""

    def work(batch):
        texts = [t or b"" for t in as_bytes(batch.column("text"))]
        for begin, end in groups(texts):
            words = Words(texts[begin:end], LOWER_ALNUM_WORDS)
            at = np.searchsorted(vocabulary, words.hash)
            known = vocabulary[np.minimum(at, len(vocabulary) - 1)] == words.hash if len(vocabulary) else np.zeros(len(at), bool)
            keys, tf = np.unique(words.doc[known] * len(vocabulary) + at[known], return_counts=True)
            doc, term = np.divmod(keys, max(len(vocabulary), 1))
            cut = np.searchsorted(doc, np.arange(words.rows + 1)).astype(np.int32)
            yield {
                "doc_id": batch.column("doc_id")[begin:end],
                "n": np.diff(words.first_word),
                "term": pa.ListArray.from_arrays(cut, term.astype(np.int32)),
                "tf": pa.ListArray.from_arrays(cut, tf.astype(np.int32)),
            }

    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return in_arrow(rows, work, f"doc_id {kind}, n bigint, term array<int>, tf array<int>")


def term_weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], dtype=np.int64)


class Shard:
    """Lists by term over documents numbered in the order of their ids."""

    def __init__(self, batches: list[pa.RecordBatch], weights: np.ndarray, n_docs: int, n_terms: int):
        table = pa.Table.from_batches(batches).combine_chunks()
        order = pc.sort_indices(table, sort_keys=[("doc_id", "ascending")], null_placement="at_end")
        table = table.take(order).combine_chunks()
        self.doc_id = table.column("doc_id")
        self.rows = table.num_rows
        n = table.column("n").to_numpy()
        term = table.column("term").combine_chunks()
        sizes = np.diff(term.offsets.to_numpy())
        term = term.flatten().to_numpy()
        tf = table.column("tf").combine_chunks().flatten().to_numpy().astype(np.int64)
        doc = np.repeat(np.arange(self.rows, dtype=np.int32), sizes)
        m = 50 + (50 * n * n_docs) // max(n_terms, 1)
        added = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[doc]))
        by_term = np.argsort(term, kind="stable")
        self.doc, self.added = doc[by_term], added[by_term]
        self.start = np.concatenate([[0], np.cumsum(np.bincount(term, minlength=len(weights)))])

    def lists(self, terms: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, int]]:
        """(documents, scores, bound): the long lists of an item and its accumulators."""
        short, out = [], []
        for term in terms:
            a, b = self.start[term], self.start[term + 1]
            if b - a > self.rows // SHORT:
                out.append((self.doc[a:b], self.added[a:b], int(self.added[a:b].max())))
            elif b > a:
                short.append((a, b))
        if short:
            total = np.zeros(self.rows, dtype=np.int64)
            for a, b in short:
                total[self.doc[a:b]] += self.added[a:b]
            held = np.flatnonzero(total)
            if len(held):
                out.append((held, total[held], int(total.max())))
        return sorted((x for x in out if x[2]), key=lambda x: x[2])

    def search(self, terms: np.ndarray, least: int, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Documents and scores of the k best that score ``least`` at the lowest, and the lowest score to beat from here on."""
        lists = self.lists(terms)
        reach = np.cumsum([bound for _, _, bound in lists])  # of the lists up to each one
        best_doc, best = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        at = [0] * len(lists)
        low = 0
        while lists and low < self.rows:
            needed = int(np.searchsorted(reach, least))  # lists before this one can not lift a document alone
            if needed == len(lists):
                break
            # the next range starts where the needed lists go on
            for i in range(needed, len(lists)):
                at[i] += int(np.searchsorted(lists[i][0][at[i] :], low))
            low = min((int(lists[i][0][at[i]]) for i in range(needed, len(lists)) if at[i] < len(lists[i][0])), default=self.rows)
            if low == self.rows:
                break
            score = np.zeros(min(RANGE, self.rows - low), dtype=np.int64)
            for i in range(needed, len(lists)):
                doc, added, _ = lists[i]
                end = at[i] + int(np.searchsorted(doc[at[i] :], low + len(score)))
                score[doc[at[i] : end] - low] += added[at[i] : end]
                at[i] = end
            found = np.flatnonzero(score)
            for i in range(needed - 1, -1, -1):
                found = found[score[found] + reach[i] >= least]
                if not len(found):
                    break
                doc, added, _ = lists[i]
                place = np.searchsorted(doc, found + low)
                place[place == len(doc)] = 0
                hit = doc[place] == found + low
                score[found[hit]] += added[place[hit]]
            found = found[score[found] >= least]
            if len(found):
                best_doc = np.concatenate([best_doc, found + low])
                best = np.concatenate([best, score[found]])
                first = np.lexsort((best_doc, -best))[:k]
                best_doc, best = best_doc[first], best[first]
                if len(best) == k:
                    least = max(least, int(best[-1]))
            low += len(score)
        return best_doc, best, least


def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    held, rows, size = [], 0, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        more = len(batch.column("term").flatten())
        if held and (rows + batch.num_rows > SHARD_ROWS or size + more > SHARD_POSTINGS):
            yield held
            held, rows, size = [], 0, 0
        held.append(batch)
        rows, size = rows + batch.num_rows, size + more
    if held:
        yield held


def search(lists: DataFrame, items: dict[int, np.ndarray], weights: np.ndarray, n_docs: int, n_terms: int, least: dict[int, int], k: int) -> DataFrame:
    """(item, doc_id, score): of each task the k best documents of each item."""
    schema = f"item bigint, doc_id {lists.schema['doc_id'].dataType.simpleString()}, score bigint"
    fields = pa_schema(lists.sparkSession, schema)

    def run(batches):
        floor = {item: least.get(item, 1) for item in items}
        kept: dict[int, list] = {item: [] for item in items}
        for held in shards(batches):
            shard = Shard(held, weights, n_docs, n_terms)
            for item, terms in items.items():
                doc, score, floor[item] = shard.search(terms, floor[item], k)
                if len(doc):
                    kept[item].append((shard.doc_id.take(pa.array(doc)).combine_chunks(), score))
        for item, parts in kept.items():
            if parts:
                ids, score = pa.concat_arrays([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
                found = pa.table({"doc_id": ids, "score": pa.array(score)})
                first = pc.sort_indices(found, sort_keys=[("score", "descending"), ("doc_id", "ascending")], null_placement="at_end")[:k]
                found = found.take(first).combine_chunks()
                columns = [pa.array(np.full(found.num_rows, item)), *(found.column(c).chunk(0) for c in ("doc_id", "score"))]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, fields, strict=True)], schema=fields)

    return lists.mapInArrow(run, schema)


def best_of(found: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(
    docs: DataFrame,
    items: DataFrame,
    k: int = 50,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """(item_id, rank, doc_id, score) of the k best documents of each item."""
    asked = stored(item_terms(items, item_id, item_text).withColumn("item", F.monotonically_increasing_id()), "items")
    total = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = max(-(-total // ITEM_TERMS), 1)
    asked = asked.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(blocks)))
    parts = [top_k_of(docs, asked.where(F.col("block") == block), k, doc_id, text) for block in range(blocks)]
    ranked = reduce(DataFrame.unionByName, parts)
    names = asked.select("item", "item_id")
    return ranked.join(names, "item").select("item_id", "rank", "doc_id", "score")


def top_k_of(docs: DataFrame, asked: DataFrame, k: int, doc_id: str, text: str) -> DataFrame:
    """(item, rank, doc_id, score) for one block of items."""
    terms = {r["item"]: np.array(r["terms"], dtype=np.int64).view(np.uint64) for r in asked.select("item", "terms").collect()}
    vocabulary = np.unique(np.concatenate([*terms.values(), np.empty(0, dtype=np.uint64)]))
    lists = stored(postings(docs, vocabulary, doc_id, text), "postings")
    size = lists.agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    counts = np.zeros(len(vocabulary), dtype=np.int64)
    for row in lists.select(F.explode("term").alias("term")).groupBy("term").count().collect():  # a row for each term asked for
        counts[row["term"]] = row["count"]
    weights = term_weights(counts, size.docs)
    items = {item: np.searchsorted(vocabulary, own) for item, own in terms.items()}
    lists = lists.where(F.size("term") > 0)
    least = {}
    if size.docs > 2 * SEED_ROWS:
        some = lists.where(F.pmod(F.xxhash64("doc_id"), F.lit(size.docs // SEED_ROWS)) == 0)
        seeds = best_of(search(some, items, weights, size.docs, size.terms, {}, k), k)
        least = {r["item"]: r["score"] for r in seeds.where(F.col("rank") == k).select("item", "score").collect()}
    found = search(lists, items, weights, size.docs, size.terms, least, k)
    return best_of(found, k).select("item", "rank", "doc_id", "score")
