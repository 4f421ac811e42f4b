"""Chat formatting with a grammar round trip, in DataFrame functions only.

Template (one string for each conversation)::

    formatted := "<s>" turn*
    turn      := "[INST] " role "\\n" text "[/INST]"     any role but assistant
               | text "</s>"                            assistant

The control strings are ``<s>``, ``</s>``, ``[INST]`` and ``[/INST]``. The parser is
deterministic: it cuts the string behind each end mark, takes the marks off, and
fails when the pieces don't add up to the string, when a control string is left
inside a piece or when a role line is missing; what it recovers is unescaped
(``&lt;`` ``&#91;`` ``&#10;``, then ``&amp;``).

Round trip: a conversation is first rendered as it is and parsed again. If the turns
that come back are not the source's, it is rendered with its conflicting content
escaped (``&`` everywhere, the first character of every control string, line ends in
roles), and parsed again; that this one is identical is asserted, not assumed.

The loss mask is a list of spans (start, length) of the formatted string: the texts
of assistant turns, without their end marks.

Turns are laid out by one window over the conversation (each turn's place is a
running sum of lengths), so a long conversation costs time in proportion to its turns.

Defined cases: null text or role is empty; rows are ordered by turn (nulls first),
then role, then text, so rows that repeat a turn number all count; a null conv_id is
one conversation; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Control strings of the template (fixed values).
BEGIN, END, OPEN, CLOSE = "<s>", "</s>", "[INST]", "[/INST]"
CONTROL = (BEGIN, END, OPEN, CLOSE)
ASSISTANT = "assistant"
_CONTROL_RE = r"</?s>|\[/?INST\]"
_PIECES_RE = r"(?s)\[INST\] .*?\[/INST\]|.*?</s>"
_ESCAPED_RE = r"&(amp|lt|#91|#10);"


def escape(text: Column, lines: bool = False) -> Column:
    out = F.replace(text, F.lit("&"), F.lit("&amp;"))
    for c in CONTROL:
        mark = "&lt;" if c[0] == "<" else "&#91;"
        out = F.replace(out, F.lit(c), F.lit(mark + c[1:]))
    return F.replace(out, F.lit("\n"), F.lit("&#10;")) if lines else out


def unescape(text: Column) -> Column:
    out = text
    for mark, char in (("&lt;", "<"), ("&#91;", "["), ("&#10;", "\n"), ("&amp;", "&")):
        out = F.replace(out, F.lit(mark), F.lit(char))
    return out


def parse(formatted: Column) -> Column:
    """array<struct<role, text>> of a formatted string, or null if it isn't in the grammar."""
    body = F.substring(formatted, len(BEGIN) + 1, 2 ** 31 - 1)
    pieces = F.regexp_extract_all(body, F.lit(_PIECES_RE), F.lit(0))

    def turn(p: Column) -> Column:
        inner = F.substring(p, F.lit(len(OPEN) + 2), F.length(p) - F.lit(len(OPEN) + 1 + len(CLOSE)))
        line = F.locate("\n", inner)
        user = F.startswith(p, F.lit(OPEN))
        raw = F.when(user, F.substring(inner, line + 1, F.length(inner))) \
            .otherwise(F.substring(p, F.lit(1), F.length(p) - F.lit(len(END))))
        role = F.when(user, F.when(line > 0, F.substring(inner, F.lit(1), line - 1))).otherwise(F.lit(ASSISTANT))
        good = role.isNotNull() & ~raw.rlike(_CONTROL_RE) & ~role.rlike(_CONTROL_RE)
        return F.struct(F.when(good, unescape(role)).alias("role"), F.when(good, unescape(raw)).alias("text"))

    turns = F.transform(pieces, turn)
    whole = F.startswith(formatted, F.lit(BEGIN)) & (F.array_join(pieces, "") == body)
    return F.when(whole & ~F.exists(turns, lambda t: t["text"].isNull()), turns)


def _render(role: Column, text: Column, escaped: bool) -> tuple[Column, Column, Column]:
    """A turn's piece, and the start and length of the text inside it."""
    t = escape(text) if escaped else text
    r = escape(role, lines=True) if escaped else role
    user = F.concat(F.lit(OPEN + " "), r, F.lit("\n"), t, F.lit(CLOSE))
    reply = role == ASSISTANT
    return (F.when(reply, F.concat(t, F.lit(END))).otherwise(user),
            F.when(reply, F.lit(0)).otherwise(F.length(r) + len(OPEN) + 2), F.length(t))


def format_chat(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                text: str = "text") -> DataFrame:
    """(conv_id, formatted, escaped, n_turns, loss_spans array<struct<start, length>>);
    start counts code points from 0."""
    rows = conversations.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"),
                                F.coalesce(F.col(role), F.lit("")).alias("role"),
                                F.coalesce(F.col(text), F.lit("")).alias("text"))
    order = Window.partitionBy("conv").orderBy("turn", "role", "text")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("nth", F.row_number().over(order))
    for kind, escaped in (("plain", False), ("safe", True)):
        piece, start, length = _render(F.col("role"), F.col("text"), escaped)
        rows = rows.withColumn(kind, piece) \
            .withColumn(f"{kind}_at", F.lit(len(BEGIN)) + F.coalesce(F.sum(F.length(kind)).over(before), F.lit(0)) + start) \
            .withColumn(f"{kind}_len", length)
    packed = rows.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct(
        "nth", "role", "text", "plain", "plain_at", "plain_len", "safe", "safe_at", "safe_len"))).alias("t"))
    source = F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text")))

    def string(kind: str) -> Column:
        return F.concat(F.lit(BEGIN), F.array_join(F.transform("t", lambda x: x[kind]), ""))

    def spans(kind: str) -> Column:
        replies = F.filter("t", lambda x: x["role"] == ASSISTANT)
        return F.transform(replies, lambda x: F.struct(x[f"{kind}_at"].cast("long").alias("start"),
                                                       x[f"{kind}_len"].cast("long").alias("length")))

    tried = packed.withColumn("source", source).withColumn("plain", string("plain")) \
        .withColumn("escaped", ~F.coalesce(parse(F.col("plain")) == F.col("source"), F.lit(False)))
    chosen = tried.withColumn("formatted", F.when(F.col("escaped"), string("safe")).otherwise(F.col("plain")))
    same = ~F.col("escaped") | F.coalesce(parse(F.col("formatted")) == F.col("source"), F.lit(False))
    return chosen.select(
        F.col("conv").alias(conv),
        F.when(same, F.col("formatted")).otherwise(F.raise_error(F.lit("a conversation does not survive its round trip")))
        .alias("formatted"),
        "escaped", F.size("t").cast("long").alias("n_turns"),
        F.when(F.col("escaped"), spans("safe")).otherwise(spans("plain")).alias("loss_spans"))


def read_back(formatted: DataFrame, conv: str = "conv_id") -> DataFrame:
    """What the formatted strings and loss spans say: (conv_id, turns, loss_text)."""
    masked = F.transform("loss_spans", lambda s: unescape(F.substring(
        F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int"))))
    return formatted.select(conv, "formatted", parse(F.col("formatted")).alias("turns"),
                            F.array_join(masked, "").alias("loss_text"))


def digests(formatted: DataFrame, conv: str = "conv_id") -> DataFrame:
    back = read_back(formatted, conv)
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(conv, F.size("turns").cast("long").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"),
                       F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))
