"""Phrase collocations by Toivonen's sampling method.

A sample of the documents proposes phrases that may be frequent: those above a lowered threshold. One
full pass counts the proposed phrases and their negative border exactly. A phrase is counted if its
first and its last words but one are both proposed, which is the proposal and its border in one rule.
If a phrase of the border turns out frequent, a further pass counts what that adds at every length
(`Expansion`). Then it is closed: every frequent phrase is known, whatever the sample was.

The proposal goes to the tasks as a bit map of fixed size (`FILTER_BITS` at most). Where it takes a
phrase for proposed that is not, that phrase is counted as well: more work, the same result. Phrases
are kept apart by their words, never by a hash.

A task counts in batches of `BATCH_BYTES` of text with numpy, over numbers that it gives to the words
of the batch, and hands on (lang, phrase, count); Spark sums them, in each task first, so a hot phrase
or language is spread. Counts, joins and ranks are DataFrame plans.

Defined results: a null text is empty, a null lang is `und`. Repeated rows count each. Only A-Z are
lower-cased. Phrases do not cross pieces. An empty table gives an empty result; a language without a
candidate has no rows. Only text and lang are read, and the id for the sample.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillhouse.llm.common import batch_rows, keep

LONGEST = 5
SUPPORT = 100
TOP = 2000
# One document in so many is sampled; a phrase is proposed at this share of its expected sample count.
SAMPLE, LOWERED = 8, 0.75
BATCH_BYTES = 12 << 20
# Bits of the map for each proposed phrase, and of the whole map at most (8 MB).
BITS_EACH, FILTER_BITS = 16, 1 << 26

_PIECES = b".,;:!?\x0b\x0c\r"
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ" + _PIECES, b"abcdefghijklmnopqrstuvwxyz" + b"\n" * len(_PIECES))
# Stands for the end of a piece; no UTF-8 text holds this byte.
_END = b"\xff"

# What is shuffled: language, a tab, and the phrase, which has no tab in it (none for the sum of all words).
COUNTS = pa.schema([("key", pa.string()), ("n", pa.int64())])
COUNTS_DDL = "key string, n long"


class _Numbers(dict):
    """Numbers words as they come; the end of a piece is 0."""

    def __init__(self) -> None:
        super().__init__({_END: 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def tokens(texts: list[bytes]) -> list[bytes]:
    """The words of `texts` in order, with `_END` after each piece."""
    return b"\n".join([*texts, b""]).translate(_FOLD).replace(b"\n", b" " + _END + b" ").split()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def _word_hashes(lang: str, words: Sequence[bytes]) -> np.ndarray:
    seed = xxhash.xxh32_intdigest(lang.encode())
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), np.uint64, len(words))


def _extend(phrase: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hashes of phrases that are one word longer."""
    return _mix(phrase * np.uint64(0xD6E8FEB86659FD93) + word)


class Phrases:
    """A bit map of phrases. It may take a phrase for one it holds, never the other way round."""

    def __init__(self, bits: np.ndarray):
        self.bits, self.mask = bits, np.uint64(len(bits) * 64 - 1)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        first, second = _places(hashes, self.mask)
        found = self._set(first)
        at = np.flatnonzero(found)
        found[at] = self._set(second[at])
        return found

    def _set(self, place: np.ndarray) -> np.ndarray:
        return (self.bits[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1


class Proposal:
    """Phrases of up to `level` words that a pass counts, with their border."""

    def __init__(self, bits: np.ndarray, level: int):
        self.phrases, self.level = Phrases(bits), level

    def counted(self, hashes: list[np.ndarray], valid: list[np.ndarray]) -> list[np.ndarray]:
        """For each length from 2 on, the places whose phrase this proposal or its border holds."""
        out: list[np.ndarray] = []
        within = valid[0]
        for k in range(2, LONGEST + 1):
            if k <= self.level + 1:
                within = self.phrases.holds(hashes[k - 2]) & valid[k - 2]
            # Beyond the level a phrase is counted where all its parts of that length are proposed.
            within = within[:-1] & within[1:] & valid[k - 1]
            out.append(within)
        return out


class Expansion:
    """What a pass adds to a proposal that some frequent phrases, the `news`, were no part of.

    A part of a phrase is alive if it is known to be frequent, or if it was not counted and its own parts are
    alive. A phrase that was not counted is, if its parts are alive, at every length in one pass: a frequent
    phrase has no other parts, so none is left for another pass.
    """

    def __init__(self, known: np.ndarray, news: np.ndarray, first: Proposal):
        self.known, self.news, self.first = Phrases(known), Phrases(news), first

    def near_news(self, hashes: list[np.ndarray], valid: list[np.ndarray]) -> np.ndarray:
        """The places that phrases with news in them can reach."""
        edge = np.zeros(len(valid[0]) + 1, np.int32)
        for k in range(1, LONGEST):
            at = np.flatnonzero(self.news.holds(hashes[k - 1]) & valid[k - 1])
            np.add.at(edge, np.maximum(0, at - (LONGEST - k)), 1)
            np.add.at(edge, np.minimum(len(edge) - 1, at + LONGEST), -1)
        return np.cumsum(edge[:-1]) > 0

    def counted(self, hashes: list[np.ndarray], valid: list[np.ndarray]) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        before = self.first.counted(hashes, valid)
        alive = self.known.holds(hashes[0]) & valid[0]
        for k in range(2, LONGEST + 1):
            fresh = alive[:-1] & alive[1:] & valid[k - 1] & ~before[k - 2]
            out.append(fresh)
            if k < LONGEST:
                alive = fresh | self.known.holds(hashes[k - 1]) & valid[k - 1]
        return out


def _places(hashes: np.ndarray, mask: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    return hashes & mask, (hashes >> np.uint64(32)) & mask


def _distinct(columns: list[np.ndarray], sizes: list[int]) -> tuple[list[np.ndarray], np.ndarray]:
    """(the distinct rows of `columns`, their counts); the numbers of a column are below its size.

    As many columns as fit are packed into one number and sorted; where not all fit, those are ranked first.
    """
    bound, j = 1, 0
    while j < len(columns) and bound * sizes[j] < 1 << 63:
        bound, j = bound * sizes[j], j + 1
    key = columns[0].astype(np.int64)
    for column, size in zip(columns[1:j], sizes[1:j]):
        key *= size
        key += column

    def unpacked(packed: np.ndarray) -> list[np.ndarray]:
        out = []
        for size in reversed(sizes[1:j]):
            packed, part = np.divmod(packed, size)
            out.append(part)
        return [packed, *reversed(out)]

    ordered = np.sort(key)
    starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.zeros(0, np.int64)
    heads = ordered[starts]
    if j == len(columns):
        return unpacked(heads), np.diff(np.append(starts, len(ordered)))
    found, n = _distinct([np.searchsorted(heads, key), *columns[j:]], [len(heads), *sizes[j:]])
    return [*unpacked(heads[found[0]]), *found[1:]], n


def _valid(word: np.ndarray) -> list[np.ndarray]:
    """For each length, the places from which so many words of one piece follow."""
    valid = [word > 0]
    for k in range(2, LONGEST + 1):
        valid.append(valid[-1][:-1] & valid[0][k - 1:] if len(valid[-1]) else valid[-1])
    return valid


def _hashes(word: np.ndarray, of_word: np.ndarray) -> list[np.ndarray]:
    hashes = [of_word[word]]
    for k in range(2, LONGEST):
        hashes.append(_extend(hashes[-1][:-1], hashes[0][k - 1:]) if len(hashes[-1]) else hashes[-1])
    return hashes


def count_batch(
    lang: str, texts: list[bytes], what: Proposal | Expansion | None, lengths: range
) -> Iterator[tuple[int, pa.Array, np.ndarray]]:
    """(length, phrases, counts) over `texts`.

    Without a proposal all phrases are counted, otherwise those it counts; single words only where `lengths`
    has them. Length 0 counts all words.
    """
    numbers = _Numbers()
    found = tokens(texts)
    word = np.fromiter(map(numbers.__getitem__, found), np.int32, len(found))
    del found
    names = list(numbers)
    words = pa.array(names, pa.binary())
    valid = _valid(word)
    if 1 in lengths:
        n = np.bincount(word, minlength=len(words))
        n[0] = 0
        at = np.flatnonzero(n)
        yield 0, pa.array([b""], pa.binary()), n.sum(keepdims=True)
        yield 1, words.take(pa.array(at)), n[at]
    wanted = valid[1:]
    if what is not None:
        of_word = _word_hashes(lang, names)
        hashes = _hashes(word, of_word)
        if isinstance(what, Expansion):
            # Mostly little is near news; the rest is cut away before it is looked at closely.
            near = what.near_news(hashes, valid)
            word = np.where(near, word, 0)[near | np.concatenate([[False], near[:-1]])]
            valid, hashes = _valid(word), _hashes(word, of_word)
        wanted = what.counted(hashes, valid)
        del hashes
    for k in lengths:
        if k > 1:
            at = np.flatnonzero(wanted[k - 2])
            columns, n = _distinct([word[at + j] for j in range(k)], [len(words)] * k)
            phrases = pc.binary_join_element_wise(*[words.take(pa.array(c)) for c in columns], pa.scalar(b" ", pa.binary()))
            yield k, phrases, n


def _counter(sent, lengths: range):
    """The function of `mapInArrow` that counts (lang, text) rows; a proposal or an expansion comes as a broadcast."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        what = None if sent is None else sent.value
        waiting: dict[str, list[bytes]] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, texts in waiting.items():
                for _, phrases, n in count_batch(lang, texts, what, lengths):
                    if len(phrases):
                        keys = pc.binary_join_element_wise(pa.scalar(lang.encode(), pa.binary()), phrases, pa.scalar(b"\t", pa.binary()))
                        yield pa.RecordBatch.from_arrays([keys.cast(pa.string()), pa.array(n, pa.int64())], schema=COUNTS)

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                waiting.setdefault(lang, []).append(text)
                size += len(text)
                if size >= BATCH_BYTES:
                    yield from flush()
                    waiting, size = {}, 0
        yield from flush()

    return run


def _count(texts: DataFrame, sent, lengths: range, least: float, purpose: str) -> DataFrame:
    """(lang, k, phrase, n) of the phrases that are counted and occur `least` times; k = 0 sums all words."""
    with batch_rows(texts.sparkSession, 512):
        parts = texts.mapInArrow(_counter(sent, lengths), COUNTS_DDL)
        phrase = F.substring_index("key", "\t", -1)
        sums = parts.groupBy("key").agg(F.sum("n").alias("n")).where((F.col("n") >= least) | (phrase == "")).withColumn("phrase", phrase)
        lang = F.left("key", F.length("key") - F.length("phrase") - 1)
        k = F.when(F.col("phrase") == "", 0).otherwise(F.regexp_count("phrase", F.lit(" ")) + 1)
        return keep(sums.select(lang.alias("lang"), k.alias("k"), "phrase", "n"), purpose)


_SET = "place long"


def _set_bits(mask: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_length: dict[tuple[str, int], list[list[bytes]]] = {}
            for lang, phrase in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = phrase.encode().split(b" ")
                by_length.setdefault((lang, len(words)), []).append(words)
            places = [np.zeros(0, np.uint64)]
            for (lang, _), rows in by_length.items():
                first, *more = zip(*rows)
                found = _word_hashes(lang, first)
                for words in more:
                    found = _extend(found, _word_hashes(lang, words))
                places += _places(found, np.uint64(mask))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(places).astype(np.int64))], names=["place"])

    return run


def propose(spark: SparkSession, phrases: DataFrame, level: int) -> tuple[Proposal, Broadcast]:
    """The proposal of `phrases` (lang, phrase), and a broadcast of it."""
    proposal = Proposal(_bit_map(phrases), level)
    return proposal, spark.sparkContext.broadcast(proposal)


def _bit_map(phrases: DataFrame) -> np.ndarray:
    """At most `FILTER_BITS` bits, which are all that reaches the driver."""
    count = phrases.count()
    size = 1 << 12
    while size < min(count * BITS_EACH, FILTER_BITS):
        size *= 2
    places = phrases.select("lang", "phrase").mapInArrow(_set_bits(size - 1), _SET)
    words = places.groupBy(F.shiftright("place", 6).alias("at")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(place & 63 as int))")).alias("bits")
    )
    bits = np.zeros(size // 64, np.int64)
    found = words.toArrow()
    bits[found.column("at").to_numpy()] = found.column("bits").to_numpy()
    return bits.view(np.uint64)


def _parts(phrases: DataFrame) -> DataFrame:
    return phrases.where((F.col("k") > 0) & (F.col("k") < LONGEST))


def frequent(docs: DataFrame, doc_id: Column, support: int = SUPPORT, sample: int = SAMPLE, lowered: float = LOWERED) -> DataFrame:
    """(lang, k, phrase, n) of every phrase of 1 to `LONGEST` words that occurs `support` times, and for k = 0
    the number of all words of each language.

    `sample` and `lowered` decide how much is counted and in how many passes, not what is returned.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text")
    lang = F.coalesce(F.col("lang"), F.lit("und")).alias("lang")
    texts = docs.select(lang, text)
    some = keep(docs.where(F.pmod(F.xxhash64(doc_id), F.lit(sample)) == 0).select(lang, text), "phrase-sample")
    least = max(2.0, support * lowered / sample)
    # In the sample, pairs first: a longer phrase is looked at where all its pairs are proposed.
    pairs = _count(some, None, range(1, 3), least, "phrase-pairs").where("k > 0")
    longer = _count(some, propose(spark, pairs, 2)[1], range(3, LONGEST + 1), least, "phrase-proposal")
    proposed = pairs.unionByName(longer)
    proposal, sent = propose(spark, _parts(proposed), LONGEST - 1)
    known = _count(texts, sent, range(1, LONGEST + 1), support, "phrases")
    # Only what can be part of a longer phrase asks for a further pass.
    news = keep(_parts(known).join(proposed, ["lang", "k", "phrase"], "left_anti"), "phrase-news")
    if not news.limit(1).count():
        return known
    expansion = Expansion(_bit_map(_parts(known)), _bit_map(news), proposal)
    more = _count(texts, spark.sparkContext.broadcast(expansion), range(2, LONGEST + 1), support, "phrases-more")
    return known.unionByName(more)


def collocations(docs: DataFrame, doc_id: Column | None = None, support: int = SUPPORT, top: int = TOP, **how) -> DataFrame:
    """The `top` phrases of each language of `docs` (text, lang) by score: lang, rank, phrase, a, l, r, n, score.

    `doc_id` is what the sample is drawn by, the column of that name if it is not given.
    """
    found = frequent(docs, F.col("doc_id") if doc_id is None else doc_id, support, **how)
    counts = found.where("k > 0").select("lang", "phrase", F.col("n").alias("f"))
    candidates = found.where("k > 1").select("lang", "phrase", F.split("phrase", " ").alias("words"), F.col("n").alias("a"))
    # A longer phrase contains a shorter one as often only if one of the phrases between does, by one word more.
    ends = "array(array_join(slice(words, 1, size(words) - 1), ' '), array_join(slice(words, 2, size(words) - 1), ' '))"
    inside = candidates.where("size(words) > 2").select("lang", F.explode(F.expr(ends)).alias("phrase"), "a")
    left = candidates.join(inside, ["lang", "phrase", "a"], "left_anti")
    # Every cut meets the counts of both its parts; parts of a frequent phrase are frequent.
    cut = left.select("lang", "phrase", "a", F.posexplode(F.expr("transform(sequence(1, size(words) - 1), i -> struct("
        "array_join(slice(words, 1, i), ' ') AS first, array_join(slice(words, i + 1, size(words)), ' ') AS rest))")))
    cut = cut.select("lang", "phrase", "a", "pos", "col.first", "col.rest")
    met = cut.join(counts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    met = met.join(counts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    totals = found.where("k = 0").select("lang", F.col("n").alias("all_words"))
    met = met.join(totals, "lang")
    # 16 digits each: the products stay below 38, so the division is exact.
    big = {c: F.col(c).cast("decimal(16,0)") for c in ("a", "l", "r", "all_words")}
    product = big["a"] * big["all_words"] * F.lit(1000).cast("decimal(4,0)")
    score = F.call_function("div", product, big["l"] * big["r"])
    scored = met.select("lang", "phrase", "a", F.struct(score.alias("score"), "pos", "l", "r", F.col("all_words").alias("n")).alias("cut"))
    least = scored.groupBy("lang", "phrase", "a").agg(F.min("cut").alias("cut"))
    rows = least.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.n", "cut.score")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # The best of each share of a language, and then the best of those.
    share = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(32))).orderBy(*order)
    best = rows.withColumn("_place", F.row_number().over(share)).where(F.col("_place") <= top).drop("_place")
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
