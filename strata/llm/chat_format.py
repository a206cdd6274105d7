r"""Chat formatting with a grammar round trip.

Template (fixed strings).  A turn is one of

    <s>TEXT</s>                    assistant
    [INST]TEXT[/INST]              user
    [SYS]TEXT[/SYS]                system
    [ROLE]NAME[TEXT]TEXT[/ROLE]    any other role, also an empty one

and a conversation is its turns, ordered by turn, with nothing between.

Method.  Each turn is rendered as it is and read back by the deterministic
parser.  If the parser does not return exactly the source (the text holds a
control string, or something that unescaping would change), the content is
escaped and rendered again.  Escaping puts one more backslash after the first
character of every control string (``[INST]`` becomes ``[\INST]``, ``[\INST]``
becomes ``[\\INST]``), unescaping takes one away, so it is reversible for every
text, and an escaped text holds no control string: the second round is always
identical.  A control string has its bracket only in front, so none can arise
across the seam of text and mark.  The assembled conversation is parsed once
more and compared; ``round_trip`` says that it gave the source.

DataFrame functions only.  Turns are rendered, checked and escaped row by row
before the shuffle; a conversation is one output row, so its own text must fit
into a row (2 GB), and it is assembled where that row is made.

Defined cases: null text or role is empty; a null turn comes first; equal turns
are ordered by role and text; repeated rows are kept as turns; rows with a null
conversation id form one conversation; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: What follows the opening bracket of a control string.
_TAIL = r"(/?s>|/?INST\]|/?SYS\]|/?ROLE\]|TEXT\])"
_CONTROL = r"[<\[]" + _TAIL
_TURN = r"(?s)<s>.*?</s>|\[INST\].*?\[/INST\]|\[SYS\].*?\[/SYS\]|\[ROLE\].*?\[TEXT\].*?\[/ROLE\]"
_MARKS = {"assistant": ("<s>", "</s>"), "user": ("[INST]", "[/INST]"), "system": ("[SYS]", "[/SYS]")}


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])(\\*)" + _TAIL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\(\\*)" + _TAIL, r"$1$2$3")


def _opening(role: Column, name: Column) -> Column:
    out = F.concat(F.lit("[ROLE]"), name, F.lit("[TEXT]"))
    for r, (a, _) in _MARKS.items():
        out = F.when(role == r, F.lit(a)).otherwise(out)
    return out


def _closing(role: Column) -> Column:
    out = F.lit("[/ROLE]")
    for r, (_, b) in _MARKS.items():
        out = F.when(role == r, F.lit(b)).otherwise(out)
    return out


def _between(x: Column, a: Column | int, b: int) -> Column:
    """``x`` without its first ``a`` and last ``b`` characters."""
    a = F.lit(a) if isinstance(a, int) else a
    return F.substr(x, a + 1, F.length(x) - a - b)


def parse(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation; null if it is not made of well-formed turns alone."""
    def turn(m: Column) -> Column:
        named = F.instr(m, "[TEXT]")
        role = F.when(F.startswith(m, F.lit("[ROLE]")), unescape(F.substr(m, F.lit(7), named - 7)))
        text = F.when(F.startswith(m, F.lit("[ROLE]")), _between(m, named + 5, len("[/ROLE]")))
        for r, (a, b) in _MARKS.items():
            here = F.startswith(m, F.lit(a))
            role, text = F.when(here, F.lit(r)).otherwise(role), F.when(here, _between(m, len(a), len(b))).otherwise(text)
        return F.struct(role.alias("role"), unescape(text).alias("text"), text.rlike(_CONTROL).alias("bad"))

    found = F.regexp_extract_all(formatted, F.lit(_TURN), F.lit(0))
    turns = F.transform(found, turn)
    whole = F.aggregate(found, F.lit(0), lambda n, m: n + F.length(m)) == F.length(formatted)
    return F.when(whole & ~F.exists(turns, lambda t: t["bad"]),
                  F.transform(turns, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))))


def format_chat(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text", train_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per conversation: conv_id, formatted, turns (as read back), loss_spans (start, length in code points of
    ``formatted``: the content of the turns to learn), round_trip."""
    t = rows.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
                    F.coalesce(role_col, F.lit("")).alias("role"), F.coalesce(text_col, F.lit("")).alias("text"))
    plain = F.concat(_opening(F.col("role"), F.col("role")), F.col("text"), _closing(F.col("role")))
    source = F.array(F.struct("role", "text"))
    t = t.withColumn("same", F.coalesce(parse(plain) == source, F.lit(False)))
    t = (t.withColumn("body", F.when(F.col("same"), F.col("text")).otherwise(escape(F.col("text"))))
         .withColumn("opening", _opening(F.col("role"), F.when(F.col("same"), F.col("role")).otherwise(escape(F.col("role")))))
         .withColumn("piece", F.concat("opening", "body", _closing(F.col("role")))))
    before = Window.partitionBy("conv_id").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, -1)
    t = t.withColumn("at", F.coalesce(F.sum(F.length("piece").cast("long")).over(before), F.lit(0)))
    mask = F.when(F.col("role").isin(*train_roles), F.struct((F.col("at") + F.length("opening")).alias("start"),
                                                           F.length("body").cast("long").alias("length")))
    c = t.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(
        "at", "piece", mask.alias("mask"), F.struct("role", "text").alias("source")))).alias("t"))
    c = c.select("conv_id", F.array_join("t.piece", "").alias("formatted"),
                 F.filter("t.mask", lambda m: m.isNotNull()).alias("loss_spans"), F.col("t.source").alias("source"))
    c = c.withColumn("turns", parse(F.col("formatted")))
    return c.select("conv_id", "formatted", "turns", "loss_spans",
                    F.coalesce(F.col("turns") == F.col("source"), F.lit(False)).alias("round_trip"))
