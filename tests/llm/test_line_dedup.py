import random

import pytest
from tests.llm.conftest import MEDIUM

from kiln.llm import line_dedup


def brute(rows, least):
    """Texts after deleting every run of lines that repeats an earlier run, over all pairs of minimal runs."""
    docs = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    first, runs = {}, []
    for at, (_, text) in enumerate(docs):
        lines = [(n, x.strip(" \t\r\x0b\x0c")) for n, x in enumerate((text or "").split("\n"))] if text is not None else []
        lines = [x for x in lines if x[1]]
        spans = set()
        for i in range(len(lines)):
            size = 0
            for j in range(i, len(lines)):
                size += len(lines[j][1])
                if size >= least:
                    spans.add((i, j))
                    break
            size = 0
            for j in range(i, -1, -1):
                size += len(lines[j][1])
                if size >= least:
                    spans.add((j, i))
                    break
        for i, j in sorted(spans):
            key = tuple(x[1] for x in lines[i:j + 1])
            place = (at, lines[i][0])
            first[key] = min(first.get(key, place), place)
            runs.append((key, place, lines[j][0]))
    gone = [set() for _ in docs]
    for key, (at, start), end in runs:
        if first[key] < (at, start):
            gone[at].update(range(start, end + 1))
    out = []
    for (doc, text), numbers in zip(docs, gone):
        lines = text.split("\n") if text is not None else []
        kept = [x for n, x in enumerate(lines) if n not in numbers]
        out.append((doc, len(lines), len(numbers), "\n".join(kept) if text is not None else None))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.n_lines, r.n_deleted, r.text) for r in df.collect()), key=str)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()], line_dedup.MIN_CHARS)
    assert sum(r[2] for r in want) > 100 and got(line_dedup.dedup_lines(docs)) == want


@pytest.mark.parametrize("least", [1, 4, 9, 25])
def test_short_lines_in_runs(make_docs, least):
    draw = random.Random(least)
    rows = [(n, "\n".join(draw.choice(["a", "bb", "ccc", "", " a ", "dddd", "x" * 30])
                          for _ in range(draw.randint(0, 30)))) for n in range(40)]
    rows.sort(key=lambda r: draw.random())
    assert got(line_dedup.dedup_lines(make_docs(rows), least)) == brute(rows, least)


def test_edge_rows(make_docs):
    same = "this line is long enough to count\nso is this other line here"
    rows = [(1, None), (2, ""), (3, "\n\n \n"), (4, same), (5, same + "\r\nnew"), (None, same)]
    out = line_dedup.dedup_lines(make_docs(rows))
    assert got(out) == brute(rows, line_dedup.MIN_CHARS)
    assert set(make_docs(rows).columns) <= set(out.columns)
    assert {r.doc_id: r.text for r in out.collect()}[4] == ""
    assert line_dedup.dedup_lines(make_docs([])).collect() == []


def test_repeated_rows_are_one_document(make_docs):
    same = "this line is long enough to count"
    assert got(line_dedup.dedup_lines(make_docs([(1, same), (1, same)]))) == [(1, 1, 0, same)] * 2


def test_a_long_document_keeps_its_first_lines(make_docs):
    lines = [f"line number {k % 4000} of a long document" for k in range(8000)]
    assert got(line_dedup.dedup_lines(make_docs([(1, "\n".join(lines))]))) == [(1, 8000, 4000, "\n".join(lines[:4000]))]
