"""Token counts of the sections of a text, from one encoding of the whole text.

A byte-level tokenizer's tokens, laid end to end, are the text's bytes, so their spans follow from their
lengths. Token spans and section spans are both in order and are joined as intervals by one search of
the section ends. A token that crosses a boundary is allotted by one of these rules:

- ``majority`` (default): to the section with most of its characters, the earlier one on ties; a token
  that completes a character begun before counts where its first byte is
- ``first``: to the section of its first byte
- ``share``: to each section by its share of the token's characters (counts are then fractions)

Sections tile the text: by default its lines, each with its line break. A null or empty text has one
empty section. Counts of a text's sections always add up to the tokens of the whole text.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vidstrata.llm.common import as_bytes, small_batches

RANKS = "byte_bpe_50k.tiktoken"
RULES = ("majority", "first", "share")


class Encoder:
    def __init__(self, path: str | None):
        import public_tokenizers
        import tiktoken

        path = public_tokenizers.path(RANKS) if path is None else path
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.sizes = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for token, rank in ranks.items():
            self.sizes[rank] = len(token)

    def ends(self, text: str) -> np.ndarray:
        """Byte at which each token of the whole text ends."""
        return np.cumsum(self.sizes[np.asarray(self.encoding.encode_ordinary(text), dtype=np.int64)])


_encoders: dict[str | None, Encoder] = {}


def encoder(path: str | None) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def line_ends(data: np.ndarray) -> np.ndarray:
    """Ends of the lines of a text, each with its line break."""
    ends = np.flatnonzero(data == 0x0A) + 1
    return ends if len(ends) and ends[-1] == len(data) else np.append(ends, len(data))


def allot(token_ends: np.ndarray, section_ends: np.ndarray, chars: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each section, and how many of them (wholly or in part) cross one of its ends.

    ``chars[i]`` is the number of characters that begin before byte i.
    """
    counts = np.zeros(len(section_ends), dtype=np.float64)
    crossing = np.zeros(len(section_ends), dtype=np.int64)
    if not len(token_ends):
        return counts, crossing
    starts = np.concatenate([[0], token_ends[:-1]])
    first = np.searchsorted(section_ends, starts, side="right")
    last = np.searchsorted(section_ends, token_ends - 1, side="right")
    whole = first == last
    counts += np.bincount(first[whole], minlength=len(counts))
    for t in np.flatnonzero(~whole):
        own = np.arange(first[t], last[t] + 1)
        crossing[own] += 1
        edges = np.concatenate([[starts[t]], section_ends[own[:-1]], [token_ends[t]]])
        parts = np.diff(chars[edges])
        if rule == "first" or not parts.sum():
            counts[own[0]] += 1
        elif rule == "majority":
            counts[own[parts.argmax()]] += 1
        else:
            counts[own] += parts / parts.sum()
    return counts, crossing


def section_tokens(
    docs: DataFrame,
    rule: str = "majority",
    sections: Callable[[np.ndarray], np.ndarray] = line_ends,
    doc_id: str = "doc_id",
    text: str = "text",
    path: str | None = None,
) -> DataFrame:
    """(doc_id, section, start, n_chars, tokens, crossing) of each section; start and n_chars in characters."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    small_batches(docs.sparkSession, 500)
    kind = docs.schema[doc_id].dataType.simpleString()
    count = pa.float64() if rule == "share" else pa.int64()

    def run(batches: Iterator):
        own = encoder(path)
        for batch in batches:
            for i, raw in enumerate(as_bytes(batch.column(1))):
                raw = raw or b""
                data = np.frombuffer(raw, dtype=np.uint8)
                chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                ends = sections(data)
                counts, crossing = allot(own.ends(raw.decode()), ends, chars, rule)
                starts = chars[np.concatenate([[0], ends[:-1]])]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(np.full(len(ends), i))),
                        pa.array(np.arange(len(ends), dtype=np.int64)),
                        pa.array(starts.astype(np.int64)),
                        pa.array((chars[ends] - starts).astype(np.int64)),
                        pa.array(counts if rule == "share" else counts.astype(np.int64), type=count),
                        pa.array(crossing),
                    ],
                    names=["doc_id", "section", "start", "n_chars", "tokens", "crossing"],
                )

    kinds = "double" if rule == "share" else "bigint"
    schema = f"doc_id {kind}, section bigint, start bigint, n_chars bigint, tokens {kinds}, crossing bigint"
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema)
