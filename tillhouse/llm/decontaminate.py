"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Patterns are windows of ten consecutive words of an item (an item of fewer words is one pattern). Words are
numbered, an item is a stretch of one array of numbers, and a pattern is a place in it.
For patterns of one length, a shift table tells from the two words that end at a position how far
the search may jump: blocks that stand in no pattern let it skip all but one word of a pattern's
length. Where a block ends some pattern, the bucket of that suffix names the patterns, and the
words are compared one by one. Nothing is decided by a digest.

Items reach the workers as a broadcast table of at most `SHARD_BYTES` of text, and each worker builds its
tables once. A larger benchmark
is cut into shards by item digest, and the documents are searched once per shard.

Defined results: a null or empty text has no words, so nothing hits it and an item without words
has no pattern. Repeated item_ids count once; an item without id marks words, but is neither
counted nor listed. Repeated documents are rows of their own. A document without hits has the
digest of the empty string. Columns of the input travel inside a struct, so no name can clash.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.llm.common import ROW, keep, packed

WINDOW = 10
SHARD_BYTES = 16 << 20

# Bytes that belong to words; the rest separates. A-Z is lowered, bytes from 0x80 on are words.
_WORDS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)

Words = list[bytes]


def words(text: bytes) -> Words:
    return text.translate(_WORDS).split()


class Patterns:
    """Search tables for the patterns of one length, over the numbered words of all items.

    A pattern is a place in the items' words. Two sorted arrays stand for the tables: the blocks that occur
    in patterns with their shifts, and the patterns by the block they end in, which is their bucket.
    """

    def __init__(self, length: int, text: np.ndarray, places: np.ndarray, within: np.ndarray, left: np.ndarray, size: int):
        """`places` are those of the items of this length, `within` and `left` say how many words of the item
        come before each and from it on; numbers of words are below `size`."""
        self.length, self.text, self.size = length, text, size
        self.block = min(2, length)
        self.furthest = length - self.block + 1
        # A block is as near to the end of a pattern as the first pattern of its item allows.
        ending = within >= self.block - 1
        ends, away = places[ending], np.maximum(0, length - 1 - within[ending]).astype(np.int8)
        blocks = self._blocks(text, ends)
        order = np.lexsort((away, blocks))
        blocks, away = blocks[order], away[order]
        first = np.ones(len(order), bool)
        first[1:] = blocks[1:] != blocks[:-1]
        self.blocks, self.shift = blocks[first], away[first]
        starts = places[left >= length]
        tails = self._blocks(text, starts + length - 1)
        order = np.argsort(tails, kind="stable")
        self.tails, self.starts = tails[order], starts[order]

    def _blocks(self, words: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The block that ends at each place, as a number."""
        last = words[ends].astype(np.int64)
        return last if self.block == 1 else words[ends - 1].astype(np.int64) * self.size + last

    def search(self, words: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(start, the places of the patterns) of every occurrence in numbered words; unknown words are -1."""
        n, length = len(words), self.length
        if n < length or not len(self.blocks):
            return
        ends = np.arange(length - 1, n)
        known = words[ends] >= 0
        if self.block == 2:
            known &= words[ends - 1] >= 0
        jumps = np.full(len(ends), self.furthest, np.int8)
        asked = np.flatnonzero(known)
        keys = self._blocks(words, ends[asked])
        at = np.minimum(np.searchsorted(self.blocks, keys), len(self.blocks) - 1)
        met = self.blocks[at] == keys
        jumps[asked[met]] = self.shift[at[met]]
        if jumps.all():
            return
        jumps = jumps.tolist()
        end = 0
        while end < len(jumps):
            if jumps[end]:
                end += jumps[end]
                continue
            start = end
            tail = words[end:end + length]
            key = self._blocks(words, np.array([end + length - 1]))[0]
            low, high = np.searchsorted(self.tails, [key, key + 1])
            found = self.starts[low:high]
            for j in range(length - self.block):
                if len(found):
                    found = found[self.text[found + j] == tail[j]]
            if len(found):
                yield start, found
            end += 1


class Tables:
    """The words of all items as numbers, once, and the patterns of each length over them."""

    def __init__(self, items: Iterable[tuple[str | None, bytes]], window: int):
        number: dict[bytes, int] = {}
        self.ids: list[str | None] = []
        parts: list[np.ndarray] = []
        for item, text in items:
            found = words(text)
            if found:
                self.ids.append(item)
                parts.append(np.fromiter((number.setdefault(w, len(number)) for w in found), np.int32, len(found)))
        self.number = number
        lengths = np.array([len(p) for p in parts], np.int64)
        self.text = np.concatenate(parts) if parts else np.zeros(0, np.int32)
        self.offsets = np.cumsum(lengths) - lengths
        places = np.arange(len(self.text), dtype=np.int32)
        within = places - np.repeat(self.offsets, lengths).astype(np.int32)
        left = np.repeat(lengths, lengths).astype(np.int32) - within
        sizes = np.minimum(lengths, window)
        self.patterns: list[Patterns] = []
        for size in np.unique(sizes).tolist():
            mine = np.repeat(sizes == size, lengths)
            self.patterns.append(Patterns(size, self.text, places[mine], within[mine], left[mine], len(number)))

    def items_at(self, places: np.ndarray) -> set[str]:
        found = np.unique(np.searchsorted(self.offsets, places, side="right") - 1)
        return {self.ids[i] for i in found.tolist() if self.ids[i] is not None}


def build(items: Iterable[tuple[str | None, bytes]], window: int) -> Tables:
    """Tables for all lengths that occur among the items' windows."""
    return Tables(items, window)


def find(text: Words, tables: Tables) -> tuple[list[tuple[int, int]], set[str]]:
    """Stretches of hit words as (start, end), sorted and apart, and the items found."""
    marks: list[tuple[int, int]] = []
    items: set[str] = set()
    get = tables.number.get
    numbered = np.fromiter((get(w, -1) for w in text), np.int64, len(text))
    for patterns in tables.patterns:
        for start, places in patterns.search(numbered):
            marks.append((start, start + patterns.length))
            items |= tables.items_at(places)
    return merge(marks), items


def merge(stretches: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(stretches):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def shards(benchmark: DataFrame, shard_bytes: int = SHARD_BYTES) -> Iterator[list[tuple[str | None, bytes]]]:
    """The items in lists of about `shard_bytes` of text at most, one after another."""
    items = benchmark.select(
        F.col("item_id").cast("string").alias("id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("t")
    )
    size = items.agg(F.sum(F.octet_length("t") + 64)).first()[0] or 0
    count = -(-2 * size // shard_bytes) if size > shard_bytes else 1
    shard = F.pmod(F.xxhash64("id", "t"), F.lit(count))
    for k in range(count):
        part = items.where(shard == k).select("id", F.col("t").cast("binary")).distinct().collect()
        yield [(i, bytes(t)) for i, t in part]


def search(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Every row of `docs` inside `ROW` with `found`: n_words, spans (hit words as [start, end)) and items (sorted ids)."""
    spark = docs.sparkSession
    state = packed(docs).withColumn(
        "found",
        F.struct(
            F.lit(0).cast("long").alias("n_words"),
            F.array().cast("array<struct<start:int,end:int>>").alias("spans"),
            F.array().cast("array<string>").alias("items"),
        ),
    )
    for k, items in enumerate(shards(benchmark, shard_bytes)):
        if k:  # the shard before is searched and out of memory before the next is sent
            state = keep(state, "decontaminate")
        sent = spark.sparkContext.broadcast((uuid.uuid4().hex, items))
        text = F.col(f"{ROW}.text").cast("string")
        state = state.select(ROW, _searcher(sent, window)(text, "found").alias("found"))
    return state


# The tables of the last shard that this worker searched for, by the shard's name.
_BUILT: dict[tuple[str, int], Tables] = {}


def _tables(name: str, items: list[tuple[str | None, bytes]], window: int) -> Tables:
    """Built once in a worker, however many tasks it runs."""
    if (name, window) not in _BUILT:
        _BUILT.clear()
        _BUILT[name, window] = build(items, window)
    return _BUILT[name, window]


def _searcher(sent, window: int):
    """The search for the broadcast items as a function of a text and what earlier shards found."""
    stretch = pa.struct([("start", pa.int32()), ("end", pa.int32())])
    kind = pa.struct([("n_words", pa.int64()), ("spans", pa.list_(stretch)), ("items", pa.list_(pa.string()))])

    def one(text: bytes | None, before: dict, tables: Tables) -> dict:
        found = words(text or b"")
        marks, ids = find(found, tables)
        if before["spans"]:
            marks = merge([*marks, *((s["start"], s["end"]) for s in before["spans"])])
        return {
            "n_words": len(found),
            "spans": [{"start": a, "end": b} for a, b in marks],
            "items": sorted(ids.union(before["items"])),
        }

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        tables = _tables(*sent.value, window)
        for texts, before in batches:
            pairs = zip(texts.cast(pa.binary()).to_pylist(), before.to_pylist())
            yield pa.array([one(text, old, tables) for text, old in pairs], kind)

    schema = "n_words long, spans array<struct<start:int,end:int>>, items array<string>"
    # Marked so that no plan evaluates it twice.
    return F.arrow_udf(run, schema).asNondeterministic()


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of `docs` that no window of the benchmark occurs in, with their own columns."""
    return search(docs, benchmark, window).where(F.size("found.spans") == 0).select(f"{ROW}.*")


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: its words, its hit words, and the items found as count and digest."""
    found = search(docs.select("doc_id", "text"), benchmark, window)
    n_hit = F.aggregate("found.spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    return found.select(
        F.col(f"{ROW}.doc_id").alias("doc_id"),
        "found.n_words",
        n_hit.alias("n_hit"),
        F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("found.items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("found.spans") > 0).alias("contaminated"),
    )
