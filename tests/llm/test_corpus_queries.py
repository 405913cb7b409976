"""Every corpus query over whole tables, odd tables and empty tables."""

import glob
import os
from collections import Counter

import duckdb
import pytest

import corpus_pipeline
from tests.compare import connect, differences
from tests.llm.conftest import SF_DIR, TABLES, rows_of, write_tables
from tillhouse.llm import oracle, queries

QUERIES, SQL = queries.queries(), oracle.oracle_sql()
ID = {"op4_warc": "pages", "op10_lines": "pages", "op6_embeddings": "embeddings", "op13_main_text": "pages"}
# Queries whose rows are not those of a table.
OWN_ROWS = {"op11_phrases", "op12_conversations"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, name):
    found = QUERIES[name](spark, SF_DIR).toPandas()
    assert differences(found, connect(SF_DIR).execute(SQL[name]).df()) is None


def folder_connection(folder):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[:-8]
        columns = ", ".join(c.split()[0] for c in TABLES[name].split(", "))
        con.execute(f"CREATE VIEW {name} AS SELECT {columns} FROM read_parquet('{path}/*.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_odd_tables_against_sql(spark, odd_dir, name):
    found = QUERIES[name](spark, odd_dir).toPandas()
    assert differences(found, folder_connection(odd_dir).execute(SQL[name]).df()) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - OWN_ROWS))
def test_odd_tables_keep_every_row(spark, odd_dir, name):
    rows = QUERIES[name](spark, odd_dir).collect()
    expected = Counter(r[0] for r in rows_of(ID.get(name, "documents")))
    assert Counter(r[0] for r in rows) == expected


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, empty_dir, name):
    found = QUERIES[name](spark, empty_dir)
    assert found.count() == 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_reruns_agree(spark, odd_dir, name):
    def run():
        return sorted(map(str, QUERIES[name](spark, odd_dir).collect()))

    assert run() == run()


def test_pipeline_stages_on_odd_tables(spark, odd_dir):
    docs = queries.table(spark, odd_dir, "documents")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.count()
        docs = corpus_pipeline.keep(stage(spark, docs, odd_dir), name)
        assert docs.columns == columns
        assert 0 < docs.count() <= before
    assert set(columns) <= set(corpus_pipeline.mix_sources(spark, docs, odd_dir).columns)


def test_pipeline_on_empty_tables(spark, empty_dir):
    assert corpus_pipeline.run(spark, empty_dir).count() == 0


def test_pipeline_keeps_one_of_a_document_that_is_a_third_of_its_source(spark, tmp_path):
    """Copies do not make their lines boilerplate; a line on every distinct page still is."""
    body = "\n".join(f"line {i} of the copied document holds words {i * 7} and {i * 13}" for i in range(6))
    own = ["\n".join(f"{i} own line {j} {(i * 7919 + j * 104729) ** 2} with word{i * 31 + j} and other{i * 17 + j}" for j in range(4)) for i in range(40)]
    texts = [body] * 20 + own
    rows = [(i, f"{t}\nfooter", "en", "one source", len(t) + 7) for i, t in enumerate(texts)]
    folder = write_tables(spark, str(tmp_path), lambda name: rows if name == "documents" else [])
    changed = corpus_pipeline.drop_lines(spark, queries.table(spark, folder, "documents"), folder).collect()
    assert sorted((r.doc_id, r.text, r.n_chars) for r in changed) == [(i, t, len(t)) for i, t in enumerate(texts)]
    left = [r.text for r in corpus_pipeline.run(spark, folder).collect()]
    assert left.count(body) == 1 and "" not in left


def test_pipeline_keeps_one_whole_of_near_copies_that_are_a_third_of_their_source(spark, tmp_path):
    """Near copies count as one document, so their shared lines are not boilerplate; one of them stays whole."""
    lines = [" ".join(f"w{(i * 131 + j * 17) % 5000}" for j in range(400)) for i in range(6)]
    copies = ["\n".join([*lines, f"closing words number {k}"]) for k in range(20)]
    own = ["\n".join(f"{i} own line {j} {(i * 7919 + j * 104729) ** 2} with word{i * 31 + j} and other{i * 17 + j}" for j in range(4)) for i in range(40)]
    rows = [(i, f"{t}\nfooter", "en", "one source", len(t) + 7) for i, t in enumerate(copies + own)]
    folder = write_tables(spark, str(tmp_path), lambda name: rows if name == "documents" else [])
    docs = queries.table(spark, folder, "documents")
    roots = {r.doc_id: r.component_id for r in corpus_pipeline.simhash.near_duplicates(docs).collect()}
    assert len({roots[i] for i in range(20)}) <= 3
    changed = {r.doc_id: r.text for r in corpus_pipeline.drop_lines(spark, docs, folder).collect()}
    assert changed == dict(enumerate(copies + own))
    left = [r.text for r in corpus_pipeline.run(spark, folder).collect()]
    assert len([t for t in left if t in copies]) >= 1 and "" not in left


def test_pipeline_decisions(spark):
    """Each stage's rows against what its operator says of the rows before it."""
    docs = queries.table(spark, SF_DIR, "documents")
    model = corpus_pipeline.toxicity.train(docs, queries.table(spark, SF_DIR, "labels"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    kept = {r.doc_id for r in corpus_pipeline.drop_toxic(spark, docs, SF_DIR).collect()}
    assert kept == {i for i, t in texts.items() if model.score(t) < 0.7}

    words = [corpus_pipeline.decontaminate.words(t.encode()) for (t,) in queries.table(spark, SF_DIR, "benchmark").select("text").collect()]
    grams = {tuple(w[i:i + min(10, len(w))]) for w in words for i in range(max(1, len(w) - 9)) if w}

    def clean(text):
        w = corpus_pipeline.decontaminate.words(text.encode())
        return not any(tuple(w[i:i + n]) in grams for n in {len(g) for g in grams} for i in range(len(w) - n + 1))

    kept = {r.doc_id for r in corpus_pipeline.drop_contaminated(spark, docs, SF_DIR).collect()}
    assert kept == {i for i, t in texts.items() if clean(t)}

    classes = corpus_pipeline.simhash.near_duplicates(docs).collect()
    kept = sorted(r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, SF_DIR).collect())
    assert kept == sorted({r.component_id for r in classes})

    changed = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.drop_lines(spark, docs, SF_DIR).collect()}
    rows = docs.collect()
    group = {r.doc_id: r.component_id for r in classes}
    pages = Counter(source for source, _ in {(r.source, group[r.doc_id]) for r in rows})
    held = Counter(
        (source, line) for source, _, line in
        {(r.source, group[r.doc_id], x.strip(" \t\r")) for r in rows for x in r.text.split("\n")} if line
    )
    for r in rows:
        stay = [
            x for x in r.text.split("\n")
            if not (held[r.source, x.strip(" \t\r")] >= 5 and held[r.source, x.strip(" \t\r")] > 0.1 * pages[r.source])
        ]
        assert changed[r.doc_id] == ("\n".join(stay), len("\n".join(stay)) if len(stay) < len(r.text.split("\n")) else r.n_chars)

    mixed = Counter(r.doc_id for r in corpus_pipeline.mix_sources(spark, docs, SF_DIR).collect())
    taken = {r.doc_id: (r.taken, r.size) for r in queries.op1_mix(spark, SF_DIR).collect()}
    assert all(mixed[i] * size == t for i, (t, size) in taken.items())
