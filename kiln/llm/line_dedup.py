"""Line dedup: repeated runs of lines from a suffix array over line ids, built by distributed prefix doubling.

Lines get ids, and ids that occur once in the corpus drop out: no repeated run holds them. The others are ranked
in id order. Round k ranks the blocks of 2^k lines that start at each position by sorting the pairs (rank of the first
half, rank of the second half); pairs that occur once drop out. So after round k, rank order is the order
of the suffix array to a depth of 2^k lines, and the positions of one rank are an interval of it whose longest
common prefix is at least 2^k lines. A run of any length is named by the ranks of the two overlapping blocks that
cover it.

Every repeated run that is long enough is a union of minimal ones: for each line, the shortest run that starts (ends)
there with at least ``min_chars`` characters. A line has a character at least, which bounds the depth that is needed.
The first copy of each minimal run stays and every later copy is deleted.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kiln.lineage import Scratch
from kiln.llm.names import fresh, quoted
from kiln.operators.common import global_index

#: A run is deleted when its lines, trimmed, hold as many characters.
MIN_CHARS = 25
_BLANK = " \t\r\x0b\x0c"
#: A document in the tables below: its id (the least long for null) and the hash of its text.
_DOC = ["d", "t"]
_NO_ID = -(1 << 63)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, not once per element of a later lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _doc_key(docs: DataFrame) -> list[Column]:
    return [F.coalesce(docs["doc_id"].cast("long"), F.lit(_NO_ID)), F.xxhash64(docs["text"])]


def line_ids(text: Column) -> Column:
    """array<struct<n, size, a, b>>: number, trimmed length and 128-bit id of each line that isn't blank."""
    trimmed = F.transform(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(_BLANK)))
    return F.filter(
        F.transform(trimmed, lambda line, n: F.struct(
            n.alias("n"), F.length(line).alias("size"), F.xxhash64(line).alias("a"),
            F.xxhash64(F.lit(7), line).alias("b"))),
        lambda line: line["size"] > 0)


def _shortest(sizes: Column, least: int) -> Column:
    """Length of the shortest prefix of ``sizes`` that sums to ``least``; null if none does."""
    return F.aggregate(
        sizes, F.struct(F.lit(0).alias("sum"), F.lit(0).alias("n")),
        lambda at, x: F.when(at["sum"] >= least, at).otherwise(
            F.struct((at["sum"] + F.least(x, F.lit(least))).alias("sum"), (at["n"] + 1).alias("n"))),
        lambda at: F.when(at["sum"] >= least, at["n"]))


def _minimal_runs(lines: Column, sizes: Column, line: Column, i: Column, least: int) -> Column:
    """array<struct<at, n, first, last>>: the shortest runs of n lines that start and that end at line i."""
    def run(at: Column, n: Column) -> Column:
        return F.struct(at.alias("at"), n.alias("n"), F.get(lines, at)["n"].alias("first"),
                        F.get(lines, at + n - 1)["n"].alias("last"))

    alone = F.array(run(i, F.lit(1)))
    ahead = _let(_shortest(F.slice(sizes, i + 1, least), least), lambda n: run(i, n))
    behind = F.reverse(F.slice(sizes, F.greatest(i + 2 - least, F.lit(1)), F.least(i + 1, F.lit(least))))
    back = _let(_shortest(behind, least), lambda n: run(i + 1 - n, n))
    return F.when(line["size"] >= least, alone).otherwise(
        F.filter(F.array(ahead, back), lambda r: r["n"].isNotNull()))


def line_table(docs: DataFrame, least: int) -> DataFrame:
    """(d, t, i, a, b, runs): one row per line that isn't blank, i counting those of its document."""
    def rows(lines: Column) -> Column:
        return _let(F.transform(lines, lambda line: line["size"]), lambda sizes: F.transform(lines, lambda line, i: F.struct(
            i.alias("i"), line["a"].alias("a"), line["b"].alias("b"),
            _minimal_runs(lines, sizes, line, i, least).alias("runs"))))

    d, t = _doc_key(docs)
    return (docs.select(d.alias("d"), t.alias("t"), F.explode(_let(line_ids(docs["text"]), rows)).alias("r"))
            .select(*_DOC, "r.i", "r.a", "r.b", "r.runs"))


def _ranked(rows: DataFrame, by: list[str], work: Scratch, name: str) -> DataFrame:
    """``rows`` whose ``by`` values occur more than once, with ``rank``, their place in sort order, instead of them."""
    again = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    # written, so that both sides of the join are plain scans: a very common value can be split
    ranks = work.write(global_index(again, by, out="_rank"), f"{name}-ranks")
    return work.write(rows.join(ranks, by).drop(*by).withColumnRenamed("_rank", "rank"), name)


def repeated_runs(docs: DataFrame, work: Scratch, least: int) -> DataFrame:
    """(d, t, first, last, n, x, y): minimal runs that may be repeated; equal (n, x, y) are equal runs of n lines."""
    lines = work.write(line_table(docs, least), "lines")
    blocks = _ranked(lines, ["a", "b"], work, "blocks-0")
    one = F.filter("runs", lambda r: r["n"] == 1)
    found = blocks.select(*_DOC, F.explode(one).alias("r"), F.col("rank").alias("x"), F.col("rank").alias("y")) \
        .select(*_DOC, "r.first", "r.last", "r.n", "x", "y")
    longer = work.write(lines.select(*_DOC, F.explode(F.filter("runs", lambda r: r["n"] > 1)).alias("r"))
                        .select(*_DOC, "r.*").distinct(), "longer-runs")
    blocks, depth = blocks.drop("runs"), 1
    while 2 * depth <= least:
        ahead = Window.partitionBy(*_DOC).orderBy("i").rangeBetween(depth, depth)
        pairs = blocks.withColumn("next", F.first("rank").over(ahead)).where("next IS NOT NULL")
        depth *= 2
        blocks = _ranked(pairs, ["rank", "next"], work, f"blocks-{depth}")
        work.drop(f"blocks-{depth}-ranks")
        here = longer.where((F.col("n") >= depth) & (F.col("n") < 2 * depth))
        start = blocks.select(*_DOC, F.col("i").alias("at"), F.col("rank").alias("x"))
        end = blocks.select(*_DOC, F.col("i").alias("end"), F.col("rank").alias("y"))
        found = found.unionByName(here.withColumn("end", F.col("at") + F.col("n") - depth)
                                  .join(start, [*_DOC, "at"]).join(end, [*_DOC, "end"]).drop("at", "end"))
        if blocks.isEmpty():
            break
    return found


def later_copies(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(d, t, first, last): line ranges that repeat an earlier run, by doc_id, text hash and line number."""
    work, key = Scratch(docs.sparkSession, "line-dedup"), ["n", "x", "y"]
    runs = work.write(repeated_runs(docs, work, min_chars).select(*key, F.struct(*_DOC, "first").alias("at"), "last"), "runs")
    copied = work.write(runs.groupBy(*key).agg(F.min("at").alias("origin"), F.max("at").alias("final"))
                        .where("origin <> final").select(*key, "origin"), "copied")
    for name in ("lines", "longer-runs"):
        work.drop(name)
    return runs.join(copied, key).where("at > origin").select("at.d", "at.t", "at.first", "last")


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` with later copies of repeated line runs taken out of text, and n_lines, n_deleted added.

    Lines end at \\n; their ids ignore blanks at both ends. Blank lines belong to no run, but go with a run that
    encloses them. The first copy in the order of doc_id (null first), text hash and line number stays, so some copy of
    every line stays. Rows equal in doc_id and text count as one document and keep the same lines. A null text
    stays null with n_lines 0, an empty one is one blank line; a document all of whose lines go has text ''.
    Other columns are passed through, an empty table gives no rows. Input columns n_lines and n_deleted are replaced.
    """
    rest = [c for c in docs.columns if c.lower() not in ("n_lines", "n_deleted", "text")]
    d0, t0, ranges, changed = fresh(rest, "_d", "_t", "_ranges", "_changed")
    # written, so that the join with the texts knows its real size: a short list is broadcast and no text moves
    gone = Scratch(docs.sparkSession, "later-copies").write(
        later_copies(docs, min_chars).groupBy(*_DOC).agg(F.collect_list(F.struct("first", "last")).alias(ranges))
        .withColumnsRenamed({"d": d0, "t": t0}), "ranges")
    d, t = _doc_key(docs)
    joined = docs.select(*quoted(rest), docs["text"]).join(gone, (d == F.col(d0)) & (t == F.col(t0)), "left")
    numbers = F.array_distinct(F.flatten(F.transform(ranges, lambda r: F.sequence(r["first"], r["last"]))))
    # one row holds the lines and the numbers of those that stay, each evaluated once
    kept = _let(F.split("text", "\n"), lambda lines: _let(
        F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), numbers),
        lambda stay: F.struct(F.size(lines).alias("n"), F.size(stay).alias("stay"),
                              F.array_join(F.transform(stay, lambda n: F.get(lines, n)), "\n").alias("text"))))
    out = joined.select(*quoted(rest), "text", F.when(F.col(ranges).isNotNull(), kept).alias(changed))
    new = F.col(changed)
    lines = F.when(F.col("text").isNull(), 0).otherwise(F.length("text") - F.length(F.translate("text", "\n", "")) + 1)
    return out.select(*quoted(rest), F.coalesce(new["text"], F.col("text")).alias("text"),
                      F.coalesce(new["n"], lines).cast("long").alias("n_lines"),
                      F.coalesce(new["n"] - new["stay"], F.lit(0)).cast("long").alias("n_deleted"))
