"""Chat formatting with a grammar round trip, in DataFrame functions only.

A conversation is rendered as turns of the form

    ### ROLE
    TEXT
    </turn>

A text may hold a control string itself. Each rendered turn is parsed again and compared with its source;
where they differ, every control string of the text gets one more backslash, and the parser takes one off
each control string that has any. An escaped text has no bare control string, and a newline parts it from the
closing mark, so the second form always reads back. The whole conversation is then parsed and compared once
more; a difference raises an error.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, CLOSE = "### ", "</turn>"
_BARE = r"(?<!\\)(?:### |</turn>)"
_CONTROL = r"(?<!\\)(\\*+)(### |</turn>)"
_ESCAPED = r"(?<!\\)\\(\\*+)(### |</turn>)"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def escape(text: Column) -> Column:
    """One more backslash before every control string."""
    return F.regexp_replace(text, _CONTROL, r"\\$1$2")


def unescape(text: Column) -> Column:
    """One backslash less before every control string that has any."""
    return F.regexp_replace(text, _ESCAPED, r"$1$2")


def render_role(role: Column) -> Column:
    """A role as one line: a backslash is doubled, a newline becomes \\n."""
    return F.regexp_replace(F.regexp_replace(role, r"\\", r"\\\\"), "\n", r"\\n")


def parse_role(line: Column) -> Column:
    """Inverse of ``render_role``."""
    return F.regexp_replace(F.regexp_replace(line, r"(?<!\\)((?:\\\\)*+)\\n", "$1\n"), r"\\\\", r"\\")


def render_turn(role: Column, text: Column) -> Column:
    """One turn of an already escaped text."""
    return F.concat(F.lit(OPEN), render_role(role), F.lit("\n"), text, F.lit(f"\n{CLOSE}\n"))


def parse(formatted: Column) -> Column:
    """array<struct<role, text>> of a rendered conversation; a text is null if a bare control string is in it."""
    blocks = F.filter(F.split(formatted, rf"\n{CLOSE}\n"), lambda block: block != "")

    def turn(block: Column) -> Column:
        return _let(F.instr(block, "\n"), lambda end: _let(F.substring(block, end + 1, F.length(block)), lambda body: F.struct(
            parse_role(F.substring(block, F.lit(len(OPEN) + 1), end - len(OPEN) - 1)).alias("role"),
            F.when(~body.rlike(_BARE), unescape(body)).alias("text"))))

    return F.transform(blocks, turn)


def render(turns: DataFrame, learner: str = "assistant") -> DataFrame:
    """(conv_id, n_turns, formatted, loss_spans, parsed): one row per conversation of (conv_id, turn, role, text).

    Turns follow each other by turn (null first); ties by role and text, and equal rows all stay. A null role or
    text counts as empty. Rows without conv_id form one conversation. ``loss_spans`` are the code point ranges of
    the learner's texts in ``formatted``, and ``parsed`` the turns read back from it. Other columns are
    ignored; an empty table gives no rows. A conversation is one row, so it must fit one; its texts are
    rendered and checked before they are brought together.
    """
    source = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                          F.coalesce("text", F.lit("")).alias("text"))
    plain = parse(render_turn(F.col("role"), F.col("text")))
    reads_back = _let(plain, lambda got: (F.size(got) == 1) & got[0]["role"].eqNullSafe(F.col("role"))
                      & got[0]["text"].eqNullSafe(F.col("text")))
    shown = F.when(reads_back, F.col("text")).otherwise(escape(F.col("text")))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rows = (source.withColumn("shown", shown)
            .withColumn("block", render_turn(F.col("role"), F.col("shown")))
            .withColumn("n", F.row_number().over(order))
            .withColumn("at", F.coalesce(F.sum(F.length("block")).over(before), F.lit(0))
                        + len(OPEN) + F.length(render_role(F.col("role"))) + 1))
    whole = (rows.groupBy("conv_id")
             .agg(F.sort_array(F.collect_list(F.struct("n", "role", "text", "block", "at", F.length("shown").alias("size"))))
                  .alias("turns"))
             .withColumn("formatted", F.array_join(F.transform("turns", lambda t: t["block"]), ""))
             .withColumn("parsed", parse(F.col("formatted"))))
    same = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))) == F.col("parsed")
    return whole.select(
        "conv_id", F.size("parsed").cast("long").alias("n_turns"),
        F.when(same, F.col("formatted")).otherwise(
            F.raise_error(F.lit("a rendered conversation does not read back"))).alias("formatted"),
        F.transform(F.filter("turns", lambda t: t["role"] == learner),
                    lambda t: F.struct(t["at"].alias("start"), (t["at"] + t["size"]).alias("end"))).alias("loss_spans"),
        "parsed")


def masked_texts(formatted: Column, loss_spans: Column) -> Column:
    """array<string>: what the loss spans cover in the output, unescaped. Four bytes a code point let every span be cut out without
    counting from the start of the conversation."""
    return _let(F.encode(formatted, "UTF-32"), lambda wide: F.transform(loss_spans, lambda span: unescape(F.decode(
        F.substring(wide, (4 * span["start"] + 1).cast("int"), (4 * (span["end"] - span["start"])).cast("int")), "UTF-32"))))


def digests(rendered: DataFrame) -> DataFrame:
    """Lengths and SHA-256 digests of what ``render`` gives: the turns read back, and the text under the loss mask."""
    said = F.array_join(F.transform("parsed", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = F.array_join(masked_texts(F.col("formatted"), F.col("loss_spans")), "")
    return (rendered.withColumn("_learned", learned)
            .select("conv_id", "n_turns", F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
                    F.length("_learned").cast("long").alias("loss_chars"),
                    F.sha2(F.col("_learned").cast("binary"), 256).alias("loss_sha256"),
                    F.length("formatted").cast("long").alias("formatted_chars")))
