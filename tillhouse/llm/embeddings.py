"""Embedding near duplicates by spherical-cap filters from random product codes.

A filter is a direction: one code word for each block of coordinates after a random rotation, side
by side. A vector belongs to all filters whose inner product with it reaches a threshold. With the
products of the blocks at hand, list decoding finds these among billions of directions without
trying them: a partial sum is given up as soon as the best of the remaining blocks can not lift it.
Two vectors meet in the filters they share, and their cosine is verified in double precision.

The number of directions grows with the number of vectors, so a filter's load does not, and the
threshold is set so that a pair at exactly the wanted cosine shares `SHARED` filters on average.
Equal vectors are one class with a count. A filter of more than `BLOCK` classes is cut into blocks,
and each two blocks meet in a task of their own. A pair counts in the smallest filter it shares, so
counts need no list of pairs: each task gives one row per class and filter, with the number of
links first seen there and one edge to the smallest class it is connected to there.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components link
with nothing. Vectors of different lengths do not link. Repeated rows count each; a class whose
vec_ids are all null has a null component_id, and a null vec_id is not kept. An empty table gives an
empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.llm.common import batch_rows, components, keep
from tillhouse.operators.joins import splittable_join

COSINE = 0.9
SHARED = 12
BLOCK = 1024
SEED = 11
# Directions per vector, and the most code words of a block before one more block is used.
DIRECTIONS, WORDS = 4, 1024
_DECODE_ROWS = 128


class Code:
    """The product code for vectors of one length."""

    def __init__(self, dim: int, count: int, cosine: float, seed: int = SEED):
        rng = np.random.default_rng([seed, dim])
        directions = max(64, DIRECTIONS * count)
        blocks = 2
        while directions ** (1 / blocks) > WORDS:
            blocks += 1
        blocks = min(blocks, dim)
        self.size = ceil(directions ** (1 / blocks))
        self.rotation = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
        self.blocks = np.array_split(np.arange(dim), blocks)
        self.words = []
        for block in self.blocks:
            words = rng.standard_normal((len(block), self.size))
            self.words.append(words / np.linalg.norm(words, axis=0))
        self.threshold = self._calibrate(rng, dim, cosine)

    def products(self, vectors: np.ndarray) -> list[np.ndarray]:
        turned = vectors @ self.rotation
        return [turned[:, block] @ words for block, words in zip(self.blocks, self.words)]

    def _calibrate(self, rng: np.random.Generator, dim: int, cosine: float, pairs: int = 128) -> float:
        """The threshold at which random pairs at `cosine` share `SHARED` filters on average."""
        x = rng.standard_normal((pairs, dim))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        y = rng.standard_normal((pairs, dim))
        y -= (x * y).sum(axis=1, keepdims=True) * x
        y /= np.maximum(np.linalg.norm(y, axis=1, keepdims=True), 1e-300)
        y = cosine * x + np.sqrt(1 - cosine**2) * y
        px, py = self.products(x), self.products(y)
        wanted, tops = SHARED * pairs, np.empty(0)
        for a, b in zip(zip(*px), zip(*py)):
            both = np.minimum(self._sums(a), self._sums(b))
            tops = np.concatenate([tops, both])
            if len(tops) > wanted:
                tops = np.partition(tops, len(tops) - wanted)[-wanted:]
        return float(tops.min())

    @staticmethod
    def _sums(parts: tuple[np.ndarray, ...]) -> np.ndarray:
        """Products of one vector with every direction."""
        total = parts[0]
        for part in parts[1:]:
            total = (total[:, None] + part).ravel()
        return total

    def decode(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, filter) for all filters that the unit `vectors` belong to, by row and filter."""
        rows_out, filters_out = [], []
        for at in range(0, len(vectors), _DECODE_ROWS):
            products = self.products(vectors[at:at + _DECODE_ROWS])
            best = [p.max(axis=1) for p in products]
            rest = sum(best[1:], np.zeros(len(best[0])))
            rows, filters = np.nonzero(products[0] >= (self.threshold - rest)[:, None])
            sums = products[0][rows, filters]
            for k in range(1, len(products)):
                rest = rest - best[k]
                total = sums[:, None] + products[k][rows]
                found, word = np.nonzero(total >= (self.threshold - rest)[rows][:, None])
                sums, filters, rows = total[found, word], filters[found] * self.size + word, rows[found]
            rows_out.append(rows + at)
            filters_out.append(filters)
        if not rows_out:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate(rows_out), np.concatenate(filters_out)


@lru_cache(maxsize=4)
def _code(dim: int, count: int, cosine: float) -> Code:
    return Code(dim, count, cosine)


def units(blobs: list[bytes]) -> np.ndarray:
    """Stored vectors of one length as unit vectors; scaled first, so that no square overflows."""
    raw = np.frombuffer(b"".join(blobs), dtype="<f8").reshape(len(blobs), -1)
    raw = raw / np.abs(raw).max(axis=1, keepdims=True)
    return raw / np.linalg.norm(raw, axis=1, keepdims=True)


def keyed(vectors: DataFrame) -> DataFrame:
    """(vec_id, key, vec) of every row: a digest and the doubles of a vector, null where it links with nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys: list[bytes | None] = []
            blobs: list[bytes | None] = []
            for values in batch.column(1).to_pylist():
                key = blob = None
                if values and None not in values:
                    vector = np.array(values, dtype="<f8") + 0.0  # minus zero becomes zero
                    if np.isfinite(vector).all() and vector.any():
                        blob = vector.tobytes()
                        key = hashlib.blake2b(blob, digest_size=16).digest()
                keys.append(key)
                blobs.append(blob)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(keys, pa.binary()), pa.array(blobs, pa.binary())],
                names=["vec_id", "key", "vec"],
            )

    slim = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    return slim.mapInArrow(run, "vec_id long, key binary, vec binary")


def in_filters(classes: DataFrame, count: int, cosine: float) -> DataFrame:
    """(dim, filter, key, n, vec): every class of `classes` (key, n, vec) once for each filter it belongs to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = batch.column("vec").to_pylist()
            dims = np.array([len(b) // 8 for b in blobs], dtype=np.int64)
            for dim in np.unique(dims):
                at = np.nonzero(dims == dim)[0]
                code = _code(int(dim), count, cosine)
                for part in np.array_split(at, -(-len(at) // 256)):
                    rows, filters = code.decode(units([blobs[i] for i in part]))
                    take = pa.array(part[rows])
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(rows), dim, dtype=np.int32)), pa.array(filters.astype(np.int64)),
                            *[batch.column(c).take(take) for c in ("key", "n", "vec")],
                        ],
                        names=["dim", "filter", "key", "n", "vec"],
                    )

    return classes.select("key", "n", "vec").mapInArrow(run, "dim int, filter long, key binary, n long, vec binary")


def _local(keys: list[bytes], linked: np.ndarray) -> list[bytes]:
    """For each row of a symmetric link matrix the smallest key it is connected to."""
    label = np.empty(len(keys), dtype=np.int64)
    order = sorted(range(len(keys)), key=keys.__getitem__)
    label[order] = np.arange(len(keys))
    reach = linked | np.eye(len(keys), dtype=bool)
    while True:
        lower = np.where(reach, label[None, :], len(keys)).min(axis=1)
        if (lower == label).all():
            return [keys[order[i]] for i in label]
        label = lower


def _meet(code: Code, number: int, keys: list[bytes], blobs: list[bytes], counts: np.ndarray, side: np.ndarray, cosine: float):
    """(key, root, links) of the rows of one cell of filter `number` that link with another there.

    Rows of one block meet each other where it is alone, and else the rows of the other block.
    """
    vectors = units(blobs)
    linked = vectors @ vectors.T >= cosine
    np.fill_diagonal(linked, False)
    if (side != side[0]).any():
        linked &= side[:, None] != side[None, :]
    some = np.nonzero(linked.any(axis=1))[0]
    if not len(some):
        return [], [], np.empty(0, np.int64)
    linked = linked[np.ix_(some, some)]
    # A pair counts here unless it shares a smaller filter.
    rows, filters = code.decode(vectors[some])
    smaller = filters < number
    columns, inverse = np.unique(filters[smaller], return_inverse=True)
    member = np.zeros((len(some), len(columns)), dtype=np.float32)
    member[rows[smaller], inverse] = 1
    first = linked & (member @ member.T < 0.5)
    names = [keys[i] for i in some]
    return names, _local(names, linked), first.astype(np.int64) @ counts[some]


def met(members: DataFrame, count: int, cosine: float) -> DataFrame:
    """(key, root, links) from `members` (dim, filter, p, q, side, key, n, vec), sorted by cell."""

    def cells(batches: Iterator[pa.RecordBatch]):
        """The rows of one cell after another; at most one batch and one cell are held."""
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            table = pa.Table.from_batches(held)
            ids = np.stack([table.column(c).to_numpy() for c in ("dim", "filter", "p", "q")], axis=1)
            cuts = np.nonzero((ids[1:] != ids[:-1]).any(axis=1))[0] + 1
            if len(cuts):
                yield table, np.concatenate([[0], cuts])
                held = table.slice(cuts[-1]).combine_chunks().to_batches()
        if held:
            table = pa.Table.from_batches(held)
            yield table, np.array([0, len(table)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, cuts in cells(batches):
            keys, blobs = table.column("key").to_pylist(), table.column("vec").to_pylist()
            counts, side = table.column("n").to_numpy(), table.column("side").to_numpy()
            dims, filters = table.column("dim").to_numpy(), table.column("filter").to_numpy()
            out: tuple[list, list, list] = ([], [], [])
            for a, b in zip(cuts, cuts[1:]):
                if b - a > 1:
                    code = _code(int(dims[a]), count, cosine)
                    found = _meet(code, int(filters[a]), keys[a:b], blobs[a:b], counts[a:b], side[a:b], cosine)
                    for to, values in zip(out, found):
                        to.extend(values)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.binary()), pa.array(out[1], pa.binary()), pa.array(out[2], pa.int64())],
                names=["key", "root", "links"],
            )

    return members.mapInArrow(run, "key binary, root binary, links long")


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of `vectors` (vec_id, embedding)."""
    spark = vectors.sparkSession
    with batch_rows(spark, 1024):
        rows = keep(keyed(vectors), "vectors")
        classes = keep(
            rows.where("key is not null").groupBy("key").agg(
                F.count("*").alias("n"), F.min("vec_id").alias("first"), F.any_value("vec").alias("vec")
            ),
            "vector-classes",
        )
        count = classes.count()
        inside = keep(in_filters(classes, count, cosine), "filters")
        # Filters above one block; the sums are made before they are shuffled.
        hot = inside.groupBy("dim", "filter").count().where(F.col("count") > block).select(
            "dim", "filter", F.ceil(F.col("count") / block).cast("int").alias("blocks")
        )
        cut = splittable_join(inside, keep(hot, "hot-filters"), ["dim", "filter"], "left")
        side = F.pmod(F.xxhash64("key"), F.coalesce("blocks", F.lit(1))).cast("int")
        dealt = cut.withColumn("side", side).withColumn(
            "other", F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1))
        ).select(
            "dim", "filter", F.least("side", "other").alias("p"), F.greatest("side", "other").alias("q"), "side", "key", "n", "vec"
        )
        cell = ["dim", "filter", "p", "q"]
        seen = keep(met(dealt.repartition(*cell).sortWithinPartitions(*cell), count, cosine), "links")
    links = seen.groupBy("key").agg(F.sum("links").alias("links"))
    roots = components(seen.select(F.col("key").alias("a"), F.col("root").alias("b")).distinct())
    classed = (
        classes.select("key", "n", "first").join(links, "key", "left")
        .join(roots.withColumnRenamed("node", "key"), "key", "left")
        .select("key", "first", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("root", "key").alias("root"))
    )
    smallest = classed.groupBy("root").agg(F.min("first").alias("component_id"))
    named = keep(splittable_join(classed, smallest, "root").select("key", "n_links", "component_id"), "vector-components")
    alone = F.col("key").isNull()
    # Rows without a class stand apart, since a null key is equal to none.
    found = splittable_join(rows.select("vec_id", "key"), named, "key", "left")
    component = F.when(alone, F.col("vec_id")).otherwise(F.col("component_id"))
    return found.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
