import random
from itertools import cycle

import duckdb
from tests.llm import brute
from tests.llm.conftest import MEDIUM

from kiln.lineage import Scratch
from kiln.llm import catalogue, decontaminate
from kiln.llm.shingles import shingle_set


def expected(docs, items, percent):
    out = []
    for doc, text in docs:
        held = brute.shingles(text)
        for item, passage in items:
            wanted = brute.shingles(passage)
            if wanted and 100 * len(wanted & held) >= percent * len(wanted):
                out.append((doc, item, len(wanted), len(wanted & held)))
    return sorted(out, key=str)


def got(found):
    return sorted(((r.doc_id, r.item_id, r.n_item, r.n_shared) for r in found.collect()), key=str)


def test_sql_agrees_on_the_whole_table(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{MEDIUM}/{t}.parquet')")
    want = sorted(con.sql(catalogue.oracle_sql()["op9_decontaminate"]).fetchall(), key=str)
    assert want and got(catalogue.op9_decontaminate(spark, MEDIUM)) == want


def test_short_items_in_long_documents(spark, make_docs):
    draw = random.Random(3)
    words = [f"w{k}" for k in range(3000)]
    items = [(k, " ".join(draw.choice(words) for _ in range(n))) for k, n in enumerate([12, 20, 40, 80] * 6)]
    docs = []
    for n in range(60):
        text = [draw.choice(words) for _ in range(draw.choice([30, 300, 5000, 40_000]))]
        if n % 2:
            passage = items[n % len(items)][1].split()
            if n % 4 == 1 and len(passage) > 20:
                passage[draw.randrange(len(passage))] = "changed"
            at = draw.randrange(len(text))
            text[at:at] = passage
        docs.append((n, " ".join(text)))
    table = spark.createDataFrame(items, "item_id long, text string")
    assert got(decontaminate.contained_items(make_docs(docs), table)) == expected(docs, items, 80)


def test_items_of_one_shingle_beside_the_signature(spark, make_docs):
    draw, items, docs = random.Random(5), [], []
    while len(docs) < 2:  # documents of 64 shingles whose signature leaves out the item's
        words = [f"w{draw.randrange(10 ** 6)}" for _ in range(68)]
        text, item = " ".join(words), " ".join(words[30:35])
        minima = decontaminate.bin_minima(shingle_set(text.encode()), decontaminate.size_part(64))
        if shingle_set(item.encode())[0] not in {x for _, found in minima for x in found}:
            docs.append((len(docs), text))
            items.append((len(items), item))
    table = spark.createDataFrame(items, "item_id long, text string")
    assert got(decontaminate.contained_items(make_docs(docs), table)) == [(0, 0, 1, 1), (1, 1, 1, 1)]


def test_edge_rows(spark, make_docs):
    passage = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    docs = [(1, None), (2, ""), (3, f"x {passage.upper()}\ty"), (3, f"x {passage.upper()}\ty"), (None, passage), (4, "alpha beta"),
            (5, "alpha  BETA"), (6, "word " * 100_000)]
    items = spark.createDataFrame([(10, passage), (11, None), (12, " "), (13, "alpha beta"), (None, passage)],
                                  "item_id long, text string")
    found = [(1 * d, i) for d, i, _, _ in got(decontaminate.contained_items(make_docs(docs), items)) if d and i]
    assert found == [(3, 10), (3, 10), (4, 13), (5, 13)]
    kept = decontaminate.clean_documents(make_docs(docs), items)
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 6] and kept.columns == make_docs(docs).columns
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contained_items(make_docs(docs), empty).collect() == []
    assert decontaminate.contained_items(make_docs([]), items).collect() == []


def test_numbers_do_not_follow_the_cores_that_read_a_table(spark, make_docs, monkeypatch):
    """A changed number of cores between two jobs cuts the scans otherwise; the pairs stay the same."""
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet").repartition(7)
    items = spark.read.parquet(f"{MEDIUM}/benchmark.parquet").repartition(3)
    want = got(decontaminate.contained_items(docs, items))
    names, write = ("spark.sql.leafNodeDefaultParallelism", "spark.sql.files.openCostInBytes"), Scratch.write
    settings = cycle([("1", "100"), ("64", "4000000")])  # all files in one task, then a task for each file

    def changed(self, df, name):
        out = write(self, df, name)
        for key, value in zip(names, next(settings), strict=True):
            spark.conf.set(key, value)
        return out

    monkeypatch.setattr(Scratch, "write", changed)
    try:
        found = decontaminate.contained_items(docs, items)
        assert want and got(found) == want
    finally:
        for key in names:
            spark.conf.unset(key)
