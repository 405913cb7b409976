import os

import pytest

from tillhouse.llm.common import ship

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

LONG = " ".join(f"word{i % 977}" for i in range(60_000)) + " idiot gnu general public license"
COPY = "the quick brown fox jumps over the lazy dog and then it sleeps in the warm sun all day long " * 3
TABLES = {
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "labels": "doc_id long, quality int, toxic int",
    "pages": "page_id long, url string, html string",
    "benchmark": "item_id long, text string",
    "embeddings": "vec_id long, embedding array<float>, label int",
    "conversations": "conv_id long, turn long, role string, text string",
}
# Names that operators use inside: rows that carry them must come through.
CLASH = (
    "_row, size, class, cell, rank, copy, fp, mark, root, found, score, host, lines, all, stay, key, digest, words, "
    "line, base, detections, n, first, vec, side, n_words, _split, u, v, hi, lo, id, nth, ckey, dated, copies, audit, harm, place, ways"
).split(", ")


def rows_of(name):
    if name == "documents":
        texts = [
            None, "", " \n\t ", "one", "two words", COPY, COPY, COPY + "again", LONG, LONG,
            "KKelvin İ straße GNU General Public License, v3\x00 CC BY-NC 4.0 \U0001f600",
            "Card 4111 1111 1111 1111, mail a.b@example.com!\nsecond line", "same line\nsame line\nother",
        ]
        out = [(i, t, "en", f"src{i % 3}", len(t or "")) for i, t in enumerate(texts)]
        return [*out, out[5], out[5], (None, COPY, None, None, None), (None, None, None, None, None), (7, "another text with id seven", "en", None, 5)]
    if name == "labels":
        return [(i, 1, 0) for i in range(12)] + [(None, 1, 1), (3, None, None), (3, 0, 1), (3, 0, 0)]
    if name == "pages":
        html = "<html><body><nav>menu</nav><p>text {} here</p><script>var a='<p>no</p>';</script><footer>foot</footer>" + "x" * 90
        out = [(i, f"http://Host{i % 2}.example:80/a?b", html.format(i % 4)) for i in range(24)]
        return [*out, out[3], out[3], (None, None, None), (None, "nonsense \r\n url", html.format(1)), (90, "https://u@h.example", ""), (91, None, "short"), (92, "http://h.example/", "short")]
    if name == "benchmark":
        words = COPY.split()
        return [(1, " ".join(words[:14])), (2, "two WORDS"), (3, None), (4, ""), (5, "..."), (None, "other"), (10, " ".join(words[3:13])), (10, " ".join(words[3:13]))]
    if name == "conversations":
        odd = [(1, None, None, None), (1, None, "user", "no turn."), (1, 0, "", "empty role."), (1, 0, "user", "a tie."), (1, 0, "user", "a tie."), (2, 0, "system", "only a system turn.")]
        lone = [(None, 3, "user", "no id?"), (None, 4, "assistant", "still none"), (None, 4, None, "tied!"), (3, 5, "Tool", " "), (3, 9, "assistant", "\n"), (4, 0, None, None)]
        long = [(5, i, ("user", "assistant", "user", "system")[i % 4 if i % 11 else 2], f"turn {i % 350} says{'.' if i % 5 else ''}") for i in range(1400)]
        return [*odd, *lone, *long, (6, 0, "user", LONG), (6, 1, "assistant", LONG + "!"), *[(7, 1, "user", "same.")] * 1200]
    if name == "embeddings":
        base = [1.0, 2.0, 3.0, 4.0]
        return [
            (0, base, 1), (1, base, 1), (1, base, 2), (2, [1.0, 2.0, 3.1, 4.0], 1), (3, [2.0, 4.0, 6.0, 8.0], 1), (4, [-1.0, 2.0, -3.0, 1.0], 0),
            (5, None, 1), (6, [], 1), (7, [0.0, 0.0, 0.0, 0.0], 1), (8, [1.0, None, 1.0, 1.0], 1), (9, [float("nan"), 1.0, 1.0, 1.0], 1),
            (10, [float("inf"), 1.0, 1.0, 1.0], 1), (11, [1.0, 2.0, 3.0], 1), (None, base, 1), (12, [5.0], None),
        ]


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


def write_tables(spark, folder, rows):
    for name, schema in TABLES.items():
        frame = spark.createDataFrame(rows(name), schema)
        for column in CLASH:
            frame = frame.selectExpr("*", f"'x' AS `{column}`")
        frame.repartition(3).write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.fixture(scope="session")
def odd_dir(spark, tmp_path_factory):
    """Tables of nulls, empty and long texts, ties, repeated rows, and columns that clash."""
    return write_tables(spark, str(tmp_path_factory.mktemp("odd")), rows_of)


@pytest.fixture(scope="session")
def empty_dir(spark, tmp_path_factory):
    return write_tables(spark, str(tmp_path_factory.mktemp("empty")), lambda name: [])
