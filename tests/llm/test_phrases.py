"""Phrase mining against plain counting."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tillhouse.llm import phrases


def by_hand(rows, support, top):
    """lang to (rank, phrase, a, l, r, n, score), from (lang, text) rows."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lower):
            words = [w for w in re.split("[ \t]+", piece) if w]
            n[lang] += len(words)
            for k in range(1, 6):
                f.update((lang, tuple(words[i:i + k])) for i in range(len(words) - k + 1))
    frequent = {key: a for key, a in f.items() if a >= support}
    out = {}
    for (lang, words), a in frequent.items():
        if len(words) == 1 or any(
            m == lang and b >= a and len(longer) > len(words) and any(longer[i:i + len(words)] == words for i in range(len(longer)))
            for (m, longer), b in frequent.items()
        ):
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, words[:k]] * f[lang, words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), f[lang, words[:k]], f[lang, words[k:]]))
    return {
        lang: [(i, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1)]
        for lang, found in out.items()
    }


def some_rows(rng, n):
    words = ["the", "Of", "to", "é", "x y", "new", "york", "city", "İ", "\x00", "a'b", "-"]
    def text():
        return "".join(rng.choice(words) + rng.choice((" ", " ", " ", "\t", ". ", ",", "  \n", "\r")) for _ in range(rng.randrange(0, 40)))
    copied = "to be or not to be that is the question " * 3
    rows = [(rng.choice(("en", "de", None, "und")), rng.choice((text(), text(), copied, None, ""))) for _ in range(n)]
    return rows


@pytest.mark.parametrize("sample, lowered, bits", [(1, 1.0, 1 << 26), (3, 0.5, 1 << 26), (2, 5.0, 1 << 26), (10**9, 0.5, 1 << 26), (4, 0.5, 1 << 12)])
def test_any_sample_gives_the_same(spark, monkeypatch, sample, lowered, bits):
    """Good, poor and empty samples: border failures lead to further passes, and the result is the same."""
    monkeypatch.setattr(phrases, "FILTER_BITS", bits)
    rows = some_rows(random.Random(7), 160)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    passes = []
    count = phrases._count
    monkeypatch.setattr(phrases, "_count", lambda *args: passes.append(args[-1]) or count(*args))
    found = {}
    for r in phrases.collocations(docs, F.xxhash64("lang", "text"), support=8, top=25, sample=sample, lowered=lowered).orderBy("lang", "rank").collect():
        found.setdefault(r.lang, []).append(tuple(r)[1:])
    assert found == by_hand(rows, 8, 25)
    if sample == 10**9:
        assert "phrases-more" in passes


def test_words_of_a_batch_are_counted_exactly():
    rng = random.Random(1)
    texts = [" ".join(rng.choices("abcdef", k=rng.randrange(30))) + rng.choice((".", "", "\n")) for _ in range(50)]
    expected = Counter()
    for text in texts:
        for piece in re.split("[.\n]", text):
            words = piece.split()
            for k in range(1, 6):
                expected.update((k, " ".join(words[i:i + k])) for i in range(len(words) - k + 1))
    found = Counter()
    for k, names, n in phrases.count_batch("en", [t.encode() for t in texts], None, range(1, 6)):
        if k:
            found.update({(k, p.decode()): int(c) for p, c in zip(names.to_pylist(), n)})
    assert found == expected


def test_many_words_are_kept_apart():
    """More different words than fit into one number with their followers."""
    import numpy as np

    rng = np.random.default_rng(2)
    columns = [rng.integers(0, 1 << 40, 500) for _ in range(5)]
    columns = [np.concatenate([c, c[:200]]) for c in columns]
    found, n = phrases._distinct(columns, [1 << 40] * 5)
    assert sorted(n) == [1] * 300 + [2] * 200
    assert {tuple(r): int(c) for r, c in zip(zip(*found), n)} == Counter(zip(*columns))
