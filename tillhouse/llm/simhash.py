"""SimHash near duplicates by the generalised pigeonhole principle.

The 64 bits of a fingerprint are dealt into groups of correlated bits, and each group gets an own
threshold, chosen by dynamic programming on estimated candidate counts. If the thresholds of m
groups sum to `max_bits` - m + 1, then two fingerprints within `max_bits` of each other are within
its threshold in one group at least. So each fingerprint is looked up in each group by all values
within the threshold of its own, and what meets there is verified on all 64 bits.

Defined results: a null text has no words, and texts without words share the fingerprint 0, which
links like any other. Rows with equal doc_ids are rows of their own. A component whose doc_ids are
all null has a null component_id; null doc_ids are never the smallest. An empty table gives an
empty result. Other columns of the input are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.llm.common import ROW, batch_rows, components, keep, packed
from tillhouse.operators.joins import splittable_join

BITS = 64
SEED = 42
# Hashes that are unpacked to bits at once, 64 bytes each.
_CHUNK = 1 << 16
# A bucket with more fingerprints than this is dealt out once more, by its remaining bits.
HOT_BUCKET = 256


def fingerprint(text: bytes, size: int = 3) -> int:
    """The unsigned SimHash of the `size`-word shingles of a UTF-8 text."""
    words = text.lower().split()  # of bytes: A-Z and the six white-space bytes alone
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) < size:
        hashes = [xxhash.xxh64_intdigest(line, SEED)]
    else:
        ends = list(accumulate([len(w) + 1 for w in words]))
        digest = xxhash.xxh64_intdigest
        hashes = [digest(line[a:b - 1], SEED) for a, b in zip([0, *ends], ends[size - 1:])]
    values = np.array(hashes, dtype="<u8")
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(values), _CHUNK):
        part = values[at:at + _CHUNK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(values), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle_words: int = 3) -> DataFrame:
    """(doc_id, mark, fp) of every row of `docs` (doc_id, text, mark); fp is the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            found = np.array([fingerprint(t or b"", shingle_words) for t in texts], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(found.view(np.int64))], names=["doc_id", "mark", "fp"]
            )

    slim = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("mark").cast("long"))
    return slim.mapInArrow(run, "doc_id long, mark long, fp long")


def pair_counts(distinct: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints, and for each two bits the number that have both set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros((BITS, BITS), dtype=np.int64), 0
        for batch in batches:
            values = batch.column(0).to_numpy().view(np.uint8).reshape(-1, 8)
            bits = np.unpackbits(values, axis=1, bitorder="little").astype(np.float32)
            total += np.rint(bits.T.astype(np.float64) @ bits).astype(np.int64)
            rows += len(bits)
        if rows:
            flat = np.append(total.ravel(), rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(flat))), pa.array(flat)], names=["cell", "n"]
            )

    cells = distinct.select("fp").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    flat = np.zeros(BITS * BITS + 1, dtype=np.int64)
    for cell, n in cells.collect():  # BITS * BITS + 1 rows at most
        flat[cell] = n
    return int(flat[-1]), flat[:-1].reshape(BITS, BITS)


def bit_groups(n: int, both: np.ndarray, groups: int) -> list[list[int]]:
    """Deal the bits into groups of near equal size with correlated bits together, greedily."""
    p = np.diag(both) / max(n, 1)
    cov = both / max(n, 1) - np.outer(p, p)
    scale = np.sqrt(np.outer(p * (1 - p), p * (1 - p)))
    corr = np.abs(np.divide(cov, scale, out=np.zeros_like(cov), where=scale > 0))
    np.fill_diagonal(corr, 0)
    left, out = list(range(BITS)), []
    for k in range(groups):
        room = len(left) // (groups - k)
        seed = max(left, key=lambda b: (corr[b, left].sum(), -b))
        group = [seed]
        left.remove(seed)
        while len(group) < room:
            best = max(left, key=lambda b: (corr[b, group].sum(), -b))
            group.append(best)
            left.remove(best)
        out.append(group)
    return out


def distance_share(n: int, both: np.ndarray, group: list[int], most: int) -> list[float]:
    """Estimated share of pairs within 0, 1 .. `most` bits of each other in `group`.

    The bits form a chain: whether two fingerprints agree in a bit depends on whether they agree
    in the one before, by the joint counts of the two bits.
    """
    ones = np.diag(both)

    def agree(i: int) -> float:
        p = ones[i] / n
        return p * p + (1 - p) * (1 - p)

    first = agree(group[0])
    state = {(0, True): first, (1, False): 1 - first}  # (bits that differ, agreed in the last)
    for i, j in zip(group, group[1:]):
        joint = np.array([[n - ones[i] - ones[j] + both[i, j], ones[j] - both[i, j]], [ones[i] - both[i, j], both[i, j]]]) / n
        yes_yes = float((joint**2).sum())
        yes_no = float(2 * (joint[0, 0] * joint[0, 1] + joint[1, 0] * joint[1, 1]))
        both_agree, differ = agree(i), 1 - agree(i)
        no_yes = max(0.0, agree(j) - yes_yes)
        step = {True: (yes_yes, yes_no, both_agree), False: (no_yes, max(0.0, differ - no_yes), differ)}
        after: dict[tuple[int, bool], float] = {}
        for (errors, last), share in state.items():
            same, other, base = step[last]
            if base <= 0:
                continue
            for agreed, weight in ((True, same), (False, other)):
                k = errors + (not agreed)
                if k <= most:
                    after[k, agreed] = after.get((k, agreed), 0.0) + share * weight / base
        state = after
    return list(accumulate(sum(v for (k, _), v in state.items() if k == e) for e in range(most + 1)))


def allocate(n: int, both: np.ndarray, max_bits: int) -> list[tuple[list[int], int]]:
    """The groups to look in with their thresholds, of least estimated work for `n` fingerprints.

    For each number of groups m, a dynamic program gives every group a threshold from -1 (not
    looked in) up, summing to max_bits - m + 1. Work counts the values looked up and the pairs met.
    """
    if n == 0:
        return []
    best: tuple[float, list[tuple[list[int], int]]] | None = None
    for m in range(1, max_bits + 2):
        table: dict[int, tuple[float, list[tuple[list[int], int]]]] = {0: (0.0, [])}
        for group in bit_groups(n, both, m):
            shares = distance_share(n, both, group, max_bits)
            after: dict[int, tuple[float, list[tuple[list[int], int]]]] = {}
            for spent, (cost, chosen) in table.items():
                for t in range(-1, max_bits + 1):
                    total = spent + t + 1
                    if total > max_bits + 1:
                        break
                    probes = sum(comb(len(group), e) for e in range(t + 1))
                    work = 0.0 if t < 0 else n * (1 + probes) + shares[t] * n * (n - 1) / 2
                    option = (cost + work, chosen + ([(group, t)] if t >= 0 else []))
                    if total not in after or option[0] < after[total][0]:
                        after[total] = option
            table = after
        # The thresholds plus one sum to max_bits + 1, whatever m is.
        option = table.get(max_bits + 1)
        if option and (best is None or option[0] < best[0]):
            best = option
    return best[1]


def _signed(mask: int) -> Column:
    return F.lit(mask - (1 << BITS) if mask >= 1 << (BITS - 1) else mask).cast("long")


def _mask(bits: list[int]) -> int:
    return sum(1 << b for b in bits)


def _keys(group: list[int], threshold: int, number: int) -> list[Column]:
    """What one fingerprint is looked up by in a group: its value there with up to `threshold` bits flipped."""
    value = F.col("fp").bitwiseAND(_signed(_mask(group)))
    return [
        F.struct(F.lit(number).alias("g"), value.bitwiseXOR(_signed(_mask(flips))).alias("key"))
        for e in range(threshold + 1)
        for flips in combinations(group, e)
    ]


def links(distinct: DataFrame, max_bits: int = 2) -> DataFrame:
    """(a, b) with a < b for all fingerprints at `max_bits` or fewer differing bits.

    `distinct` holds each fp once. The verification is part of the join's condition, so only
    true links leave it, once for each group they are found in. A bucket of more than HOT_BUCKET
    fingerprints is dealt out by the pigeonhole principle once more: in it, all agree in the
    group within its threshold, so at most `max_bits` of the other bits differ, and of
    `max_bits` + 1 parts of those one is equal.
    """
    n, both = pair_counts(distinct)
    plan = allocate(n, both, max_bits)
    if not plan:
        return distinct.select(F.col("fp").alias("a"), F.col("fp").alias("b"))
    stored = [key for g, (group, _) in enumerate(plan) for key in _keys(group, 0, g)]
    looked = [key for g, (group, t) in enumerate(plan) for key in _keys(group, t, g)]

    def entries(keys: list[Column]) -> DataFrame:
        return distinct.select("fp", F.explode(F.array(*keys)).alias("e")).select("fp", "e.g", "e.key")

    hot = entries(stored).groupBy("g", "key").count().where(F.col("count") > HOT_BUCKET).select("g", "key", F.lit(True).alias("hot"))
    hot = keep(hot, "hot-buckets")
    whole = F.array(F.struct(F.lit(-1).alias("part"), F.lit(0).cast("long").alias("sub")))
    parts = F.lit(None)
    for g, (group, _) in enumerate(plan):
        rest = [b for b in range(BITS) if b not in group]
        split = [rest[j::max_bits + 1] for j in range(max_bits + 1)]
        parts = F.when(
            F.col("g") == g,
            F.array(*[
                F.struct(F.lit(j).alias("part"), F.col("fp").bitwiseAND(_signed(_mask(s))).alias("sub"))
                for j, s in enumerate(split)
            ]),
        ).otherwise(parts)

    def dealt(keys: list[Column], name: str) -> DataFrame:
        found = splittable_join(entries(keys), hot, ["g", "key"], "left")
        where = F.explode(F.when(F.col("hot"), parts).otherwise(whole)).alias("w")
        return found.select(F.col("fp").alias(name), "g", "key", where).select(name, "g", "key", "w.part", "w.sub")

    near = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
    # Two fingerprints find each other both ways where values are flipped, so one way is enough.
    left, right = dealt(stored, "a").alias("l"), dealt(looked, "b").alias("r")
    same = [F.col(f"l.{c}") == F.col(f"r.{c}") for c in ("g", "key", "part", "sub")]
    condition = near
    for equal in same:
        condition = condition & equal
    return left.join(right, condition).select("a", "b")


def near_duplicates(docs: DataFrame, shingle_words: int = 3, max_bits: int = 2, mark: Column | None = None) -> DataFrame:
    """(doc_id, mark, fp, root, component_id) of every row: the smallest doc_id reachable by links.

    `root` names the component, and `mark` is a number over `docs` that a caller knows its rows by.
    Rows meet as distinct fingerprints, so a group of copies of any size is one of them.
    """
    marked = docs.select("doc_id", "text", (F.lit(None) if mark is None else mark).cast("long").alias("mark"))
    with batch_rows(docs.sparkSession, 256):
        rows = keep(fingerprints(marked, shingle_words), "fingerprints")
    distinct = keep(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    roots = keep(components(links(distinct, max_bits)), "components")
    classed = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    smallest = classed.groupBy("root").agg(F.min("first").alias("component_id"))
    named = keep(splittable_join(classed, smallest, "root").select("fp", "root", "component_id"), "named-fingerprints")
    return splittable_join(rows, named, "fp").select("doc_id", "mark", "fp", "root", "component_id")


def one_of_each(docs: DataFrame, shingle_words: int = 3, max_bits: int = 2) -> DataFrame:
    """The rows of `docs` that stand for their component, one each: that with the smallest doc_id.

    Of rows that share this doc_id the one with the smallest row digest stays, and of equal rows one.
    """
    digest = F.xxhash64(F.struct(*[docs[f"`{c}`"] for c in docs.columns]))
    classes = near_duplicates(docs, shingle_words, max_bits, digest)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")
    stays = classes.groupBy("root").agg(F.min(order).alias("s")).select(
        F.col("s.mark").alias("digest"), F.coalesce(F.col("s.doc_id").cast("string"), F.lit("")).alias("id")
    )
    rows = packed(docs).withColumns(
        {"digest": F.xxhash64(ROW), "id": F.coalesce(F.col(f"{ROW}.doc_id").cast("string"), F.lit(""))}
    )
    met = rows.join(keep(stays, "component-rows"), ["digest", "id"])
    # Repeated rows meet as one of each task, however many they are.
    return met.dropDuplicates(["digest", "id"]).select(f"{ROW}.*")


def hex_digits(fp: Column) -> Column:
    """A signed long as 16 lower-case hex digits."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
