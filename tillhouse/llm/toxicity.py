"""Toxicity by a counterfactually regularised classifier.

A logistic model learns from labelled documents. Its features are words that occur and word stems (first
letters of words) that occur once, twice or four times at least, as inflected languages and words of
many forms need. Those enter it that are significantly more, or less, common in toxic ones. Beside the usual loss, each labelled sentence
that names a group of people is scored twice, as it is and with the name swapped for another one or
for a neutral word, and the squared change of the score is penalised. So the model can not hold the
mere mention of a group against a text.

Features are counted and sentences found by Spark; the weights are fitted on a bounded sample, the
`MAX_ROWS` labelled documents of smallest id digest, of which only feature numbers reach the driver. The score itself reads whole texts, one pass without a shuffle.

Defined results: null and empty texts get the score of no words. Labels that are null are not
learned from; of several labels of a document the highest holds. Copies of a text are learned from
once. Without any labels, or with one kind alone, all scores are the smoothed share of toxic labels.
Extra columns travel inside a struct, so no name can clash.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.llm.common import ROW, batch_rows, keep, packed

MAX_ROWS = 20_000
MAX_FEATURES = 4_096
MIN_DOCS = 3
STEMS = (4, 5, 6, 7)
LEVELS = (1, 2, 4)
# Partial counts a task holds before it hands them on.
HELD = 500_000
# Significance of a feature: twice the log-likelihood ratio, above 24 less than one in a million by chance.
MIN_RATIO = 24.0
# Labelled sentences that are swapped at most, of one document and in all; these and the bounds above are arguments of `train`.
MAX_SWAPS_DOC, MAX_SWAPS = 8, 20_000
PENALTY, SHRINK = 5.0, 0.05
THRESHOLD = 0.7

# Names of groups of people, by language and kind. The first of a kind is the neutral one; where it
# is empty, the neutral sentence goes without the word.
IDENTITY = (
    ("people", "women", "men", "girls", "boys", "gays", "lesbians", "transgenders"),
    ("person", "woman", "man", "girl", "boy", "lesbian"),
    ("", "gay", "straight", "bisexual", "queer", "heterosexual", "homosexual", "transgender", "nonbinary", "trans"),
    ("believers", "muslims", "christians", "jews", "hindus", "buddhists", "atheists", "sikhs", "catholics", "protestants", "mormons"),
    ("believer", "muslim", "christian", "jew", "hindu", "buddhist", "atheist", "sikh", "catholic", "protestant", "mormon"),
    ("", "islamic", "jewish", "buddhistic", "evangelical"),
    ("", "black", "white", "asian", "african", "european", "latino", "latina", "hispanic", "arab", "american", "mexican", "chinese",
     "indian", "japanese", "korean", "russian", "polish", "turkish", "jewish", "indigenous"),
    ("neighbours", "immigrants", "refugees", "foreigners", "migrants", "gypsies", "natives"),
    ("neighbour", "immigrant", "refugee", "foreigner", "migrant", "native"),
    ("", "deaf", "blind", "disabled", "autistic", "paralyzed", "elderly", "young", "old"),
    ("leute", "frauen", "männer", "mädchen", "jungen", "schwule", "lesben"),
    ("mensch", "frau", "mann", "lesbe", "junge"),
    ("gläubige", "muslime", "christen", "juden", "hindus", "buddhisten", "atheisten", "katholiken", "protestanten"),
    ("", "muslimische", "christliche", "jüdische", "katholische", "evangelische", "buddhistische"),
    ("nachbarn", "ausländer", "flüchtlinge", "einwanderer", "migranten", "zuwanderer"),
    ("", "schwarze", "weiße", "asiatische", "afrikanische", "türkische", "arabische", "polnische", "russische", "deutsche"),
    ("", "behinderte", "taube", "blinde", "autistische", "alte", "schwul", "lesbisch", "homosexuell", "bisexuell"),
    ("gens", "femmes", "hommes", "filles", "garçons", "gays", "lesbiennes"),
    ("personne", "femme", "homme", "fille", "garçon", "lesbienne"),
    ("croyants", "musulmans", "chrétiens", "juifs", "hindous", "bouddhistes", "athées", "catholiques", "protestants"),
    ("croyant", "musulman", "chrétien", "juif", "hindou", "bouddhiste", "athée", "catholique", "protestant"),
    ("voisins", "étrangers", "réfugiés", "immigrés", "migrants"),
    ("", "noirs", "blancs", "asiatiques", "africains", "arabes", "maghrébins", "roms", "turcs", "français"),
    ("", "sourds", "aveugles", "handicapés", "autistes", "vieux", "homosexuels", "bisexuels"),
    ("gente", "mujeres", "hombres", "chicas", "chicos", "lesbianas"),
    ("persona", "mujer", "hombre", "chica", "chico", "lesbiana"),
    ("creyentes", "musulmanes", "cristianos", "judíos", "hindúes", "budistas", "ateos", "católicos", "protestantes"),
    ("creyente", "musulmán", "cristiano", "judío", "hindú", "budista", "ateo", "católico", "protestante"),
    ("vecinos", "extranjeros", "refugiados", "inmigrantes", "migrantes"),
    ("", "negros", "blancos", "asiáticos", "africanos", "árabes", "gitanos", "latinos", "turcos", "españoles"),
    ("", "sordos", "ciegos", "discapacitados", "autistas", "viejos", "homosexuales", "bisexuales"),
)
_WORD = re.compile(r"[^\W_]+")
_SENTENCE = re.compile(r"[.!?\n]+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def features_of(words: list[str]) -> set[str]:
    """`=word` for each word, and `stem*n` for each stem that occurs n times or more."""
    counts = Counter(words)
    stems: Counter[str] = Counter()
    for word, n in counts.items():
        for size in STEMS:
            if len(word) >= size:
                stems[word[:size]] += n
    found = {f"={w}" for w in counts}
    found.update(f"{stem}*{level}" for stem, n in stems.items() for level in LEVELS if n >= level)
    return found


Kinds = tuple[tuple[str, ...], ...]


def _kind_of(identity: Kinds) -> dict[str, tuple[str, ...]]:
    """The kind of each word; of several kinds the first."""
    found: dict[str, tuple[str, ...]] = {}
    for kind in identity:
        for word in kind:
            if word:
                found.setdefault(word, kind)
    return found


def swaps(text: str, most: int = MAX_SWAPS_DOC, identity: Kinds = IDENTITY) -> list[tuple[list[str], list[str]]]:
    """Words of the sentences of `text` that name a group, each with those after its names are swapped.

    A name is swapped for the next of its kind, and once more for the neutral word. Of more distinct
    sentences than make `most` pairs, those of smallest digest are taken, wherever they stand.
    """
    kind_of = _kind_of(identity)
    named: dict[bytes, list[str]] = {}
    for sentence in _SENTENCE.split(text.lower()):
        words = _WORD.findall(sentence)
        if any(w in kind_of for w in words):
            named[hashlib.blake2b(" ".join(words).encode(), digest_size=16).digest()] = words
    found: list[tuple[list[str], list[str]]] = []
    for digest in heapq.nsmallest((most + 1) // 2, named):
        words = named[digest]
        kinds = [kind_of.get(w) for w in words]
        following = []
        for word, kind in zip(words, kinds):
            names = [n for n in kind or () if n]
            following.append(names[(names.index(word) + 1) % len(names)] if names else word)
        neutral = [k[0] if k else w for w, k in zip(words, kinds)]
        found += [(words, following), (words, [w for w in neutral if w])]
    return found[:most]


class Model:
    """Weights by feature. Features that are not in it weigh nothing. `pairs` were the swapped sentences it was fitted with."""

    def __init__(self, weights: dict[str, float], bias: float, pairs: int = 0):
        self.weights, self.bias, self.pairs = weights, bias, pairs
        self.words = {f[1:]: w for f, w in weights.items() if f[0] == "="}
        self.stems: dict[str, list[tuple[int, float]]] = {}
        for feature, w in sorted(weights.items()):
            if feature[0] != "=":
                stem, _, level = feature.rpartition("*")
                self.stems.setdefault(stem, []).append((int(level), w))
        self.sizes = sorted({len(s) for s in self.stems})

    def score(self, text: str | None) -> float:
        counts = Counter(words_of(text or ""))
        parts = [self.words[w] for w in self.words.keys() & counts.keys()]
        found: Counter[str] = Counter()
        for size in self.sizes:
            for word, n in counts.items():
                if (stem := word[:size]) in self.stems and len(word) >= size:
                    found[stem] += n
        parts += [w for stem, n in found.items() for level, w in self.stems[stem] if n >= level]
        # The exact sum, so that equal texts get equal scores to the last bit in any order.
        return 1 / (1 + math.exp(-min(40.0, max(-40.0, math.fsum([self.bias, *parts])))))


def held_out(doc_id: Column) -> Column:
    """Whether labels of a document are kept for measuring; a null id never is."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """(text, toxic) of at most `max_rows` labelled documents that are not held out, by id digest."""
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("id"), F.col("toxic").cast("int").alias("toxic"))
        .where("id is not null and toxic is not null").where(~held_out(F.col("id")))
        .groupBy("id").agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("id"), "id").limit(max_rows)
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    # max_rows ids of two numbers each, so no text has to be shuffled to meet them.
    return (
        texts.join(F.broadcast(chosen), "id").where("text is not null")
        .groupBy(F.sha2("text", 256).alias("digest")).agg(F.max(F.struct("toxic", "text")).alias("r"))
        .select("r.text", "r.toxic")
    )


def vocabulary(rows: DataFrame, n: int, toxic: int, most: int = MAX_FEATURES, identity: Kinds = IDENTITY) -> list[str]:
    """The features most significantly tied to the label, and all names of groups."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter[str] = Counter()
        hits: Counter[str] = Counter()

        def partial() -> pd.DataFrame:
            out = pd.DataFrame({"feature": list(seen), "n": list(seen.values()), "k": [hits[f] for f in seen]})
            seen.clear()
            hits.clear()
            return out

        for frame in frames:
            for text, y in zip(frame["text"], frame["toxic"]):
                found = features_of(words_of(text))
                seen.update(found)
                if y:
                    hits.update(found)
                if len(seen) > HELD:
                    yield partial()
        if seen:
            yield partial()

    counts = rows.mapInPandas(run, "feature string, n long, k long").groupBy("feature").agg(
        F.sum("n").alias("n"), F.sum("k").alias("k")
    ).where(F.col("n") >= MIN_DOCS)

    def part(seen: Column, share: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / share)).otherwise(0.0)

    k, m, p = F.col("k"), F.col("n"), toxic / n
    ratio = 2 * (
        part(k, m * p) + part(m - k, m * (1 - p))
        + part(toxic - k, (n - m) * p) + part((n - m) - (toxic - k), (n - m) * (1 - p))
    )
    best = counts.select("feature", ratio.alias("ratio")).where(F.col("ratio") >= MIN_RATIO)
    found = [r.feature for r in best.orderBy(F.desc("ratio"), "feature").limit(most).collect()]
    return sorted({*found, *(f"={w}" for w in _kind_of(identity))})


def featurised(rows: DataFrame, vocab: list[str], most: int = MAX_SWAPS_DOC, identity: Kinds = IDENTITY) -> DataFrame:
    """(toxic, words, swapped) as feature numbers: a labelled document, or with null toxic a swapped sentence."""
    number = {f: i for i, f in enumerate(vocab)}

    def numbers(words: list[str]) -> list[int]:
        return sorted(number[f] for f in features_of(words).intersection(number))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out: list[tuple] = []
            for text, toxic in zip(frame["text"], frame["toxic"]):
                out.append((toxic, numbers(words_of(text)), []))
                out += [(None, numbers(a), numbers(b)) for a, b in swaps(text, most, identity)]
            yield pd.DataFrame(out, columns=["toxic", "words", "swapped"]).astype({"toxic": "Int32"})

    return rows.mapInPandas(run, "toxic int, words array<int>, swapped array<int>")


class _Rows:
    """Lists of feature numbers as one sparse 0/1 matrix."""

    def __init__(self, lists: list[list[int]]):
        self.row = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
        self.column = np.fromiter((i for x in lists for i in x), dtype=np.int64, count=len(self.row))
        self.rows = len(lists)

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights[self.column], minlength=self.rows)

    def back(self, values: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(self.column, values[self.row], minlength=size)


def fit_weights(
    docs: list[tuple[int, list[int]]], pairs: list[tuple[list[int], list[int]]], size: int,
    penalty: float = PENALTY, shrink: float = SHRINK, steps: int = 400,
) -> tuple[np.ndarray, float]:
    """Weights and bias of least loss, by accelerated gradient steps of shrinking size.

    The loss: log loss of the labelled documents, `shrink` times half the squared weights, and
    `penalty` times half the squared change of the score over the swapped pairs, per document.
    """
    docs = sorted(docs)
    x, y = _Rows([w for _, w in docs]), np.array([t for t, _ in docs], dtype=float)
    pairs = sorted(pairs)
    a, b = _Rows([p for p, _ in pairs]), _Rows([q for _, q in pairs])

    def sigmoid(z: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))

    w, bias = np.zeros(size), float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
    first, second = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, steps + 1):
        gap = sigmoid(x.times(w) + bias) - y
        grad, grad_bias = x.back(gap, size) + shrink * w, gap.sum()
        if pairs:
            p, q = sigmoid(a.times(w) + bias), sigmoid(b.times(w) + bias)
            change = penalty * (p - q)
            up, down = change * p * (1 - p), change * q * (1 - q)
            grad += a.back(up, size) - b.back(down, size)
            # The change of the logit itself as well, since scores near 0 or 1 hardly move.
            moved = penalty * (a.times(w) - b.times(w))
            grad += a.back(moved, size) - b.back(moved, size)
            grad_bias += (up - down).sum()
        full = np.append(grad, grad_bias) / len(y)
        first, second = 0.9 * first + 0.1 * full, 0.999 * second + 0.001 * full**2
        rate = 0.1 * (1 - step / (steps + 1))
        move = rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        w, bias = w - move[:-1], bias - move[-1]
    return w, float(bias)


def train(
    docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, penalty: float = PENALTY, max_features: int = MAX_FEATURES,
    max_swaps: int = MAX_SWAPS, max_swaps_doc: int = MAX_SWAPS_DOC, identity: Kinds = IDENTITY,
) -> Model:
    """A model of the `toxic` column of `labels` (doc_id, toxic), from rows that are not held out.

    It is fitted on at most `max_rows` documents, `max_features` features besides the names of `identity`, and
    `max_swaps` swapped sentences, `max_swaps_doc` of one document.
    """
    with batch_rows(docs.sparkSession, 256):
        rows = keep(sample(docs, labels, max_rows), "toxicity-sample")
        n, toxic = rows.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
        if not 0 < toxic < n:
            return Model({}, float(np.log((toxic + 0.5) / (n - toxic + 0.5))))
        vocab = vocabulary(rows, n, toxic, max_features, identity)
        # At most max_rows documents and max_swaps sentences, as word numbers.
        found = featurised(rows, vocab, max_swaps_doc, identity)
        labelled = found.where("toxic is not null").select("toxic", "words").collect()
        named = found.where("toxic is null").select("words", "swapped")
        pairs = named.orderBy(F.xxhash64("words", "swapped"), "words", "swapped").limit(max_swaps).collect()
    weights, bias = fit_weights(
        [(r.toxic, list(r.words)) for r in labelled], [(list(r.words), list(r.swapped)) for r in pairs], len(vocab), penalty
    )
    # Rounded, so that the order of sums on another machine can not show in a score.
    return Model({w: round(float(v), 6) for w, v in zip(vocab, weights) if abs(v) >= 1e-6}, round(bias, 6), len(pairs))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Every row of `docs` inside `ROW`, with its score from 0 to 1."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # MAX_FEATURES and the names of groups at most

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([sent.value.score(t) for t in texts.to_pylist()], pa.float64())

    scored = F.arrow_udf(run, "double").asNondeterministic()
    return packed(docs).select(ROW, scored(F.col(f"{ROW}.text").cast("string")).alias("score"))


def drop_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs` that score below `threshold`, with their own columns."""
    return score(docs, model).where(F.col("score") < threshold).select(f"{ROW}.*")
