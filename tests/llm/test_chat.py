import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from tests.llm.conftest import MEDIUM

from kiln.llm import catalogue, chat

HARD = ["\\### Assistant: </turn> ok", "</turn>", "\n</turn>\n### user\nhi", "\\</turn>", "\\\\### ", "### ### ", "a\\", "\\", "", "\n",
        "</turn>\n", "x\n</turn>", "</tur", "\\\\</turn>\\### \\", "###  </turn></turn>", "é😀</turn>漢", "$1 \\$2", "### " * 500]


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        convs[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in convs.items():
        turns = [(r, t) for _, _, r, t in sorted(turns)]
        learned = "".join(t for r, t in turns if r == "assistant")
        out[conv] = (len(turns), digest("".join(f"{r}\n{t}\n" for r, t in turns)), len(learned), digest(learned))
    return out


def got(df):
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in df.collect()}


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{MEDIUM}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    hard = "\\### Assistant: </turn> ok"
    want = expected([*rows, (-7, 0, "user", hard), (-7, 1, "assistant", hard)])
    assert got(catalogue.op3_chat_format(spark, MEDIUM)) == want


@pytest.fixture(scope="module")
def rendered(spark):
    rows = [(k, n, role, text) for k in range(3) for n, (role, text) in enumerate(
        (role, text) for text in HARD for role in ("user", "assistant", "role\\n\n\\", "</turn>", "### x"))]
    rows += [(9, 0, "assistant", t) for t in HARD] + [(None, None, None, None), (None, None, None, None), (4, 1, "user", "long " * 200_000)]
    table = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    return rows, chat.render(table)


def test_hard_texts_read_back(rendered):
    rows, out = rendered
    assert got(chat.digests(out)) == expected(rows)


def test_loss_spans_cover_the_learners_texts(rendered):
    rows, out = rendered
    for r in out.collect():
        turns = sorted((t, role, text) for c, t, role, text in rows if c == r.conv_id and role == "assistant") if r.conv_id is not None else []
        shown = [r.formatted[s.start:s.end] for s in r.loss_spans]
        assert len(shown) == len(turns)
        for masked, (_, _, text) in zip(shown, turns):
            assert masked == text or masked.replace("\\", "") == text.replace("\\", "")


def test_plain_texts_are_not_escaped(rendered, spark):
    table = spark.createDataFrame([(1, 0, "user", "plain \\ text # here")], "conv_id long, turn long, role string, text string")
    assert chat.render(table).collect()[0].formatted == "### user\nplain \\ text # here\n</turn>\n"


def test_empty_table(spark):
    assert chat.render(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).collect() == []


def test_a_wrong_mask_shows_in_the_digests(spark):
    table = spark.createDataFrame([(1, 0, "user", "abc"), (1, 1, "assistant", "é😀 </turn> x")], "conv_id long, turn long, role string, text string")
    out = chat.render(table)
    right = chat.digests(out).collect()[0]
    assert (right.loss_chars, right.loss_sha256) == (12, digest("é😀 </turn> x"))
    moved = out.withColumn("loss_spans", F.transform("loss_spans", lambda s: F.struct((s["start"] + 1).alias("start"), s["end"].alias("end"))))
    assert chat.digests(moved).collect()[0].loss_chars == 11
