"""Chat formatting by prefix-target expansion, on DataFrame functions alone.

Every assistant turn becomes an example of its own: all turns before it are
context, only its text is trainable. Turns after the last assistant turn (all
turns, where there is none) make one more example without a target, so that the
output holds every turn.

Template::

    example := <s> turn ... turn
    turn    := [INST] role [/INST] text </s>        (without the blanks)

Roles and texts are escaped so that no control string is left inside them: each
backslash is doubled and a backslash goes behind the first character of each
control string (``</s>`` is written ``<\\/s>``). A single pass takes it back: a
backslash goes, the character behind it stays if it is a backslash. No control
string can form across a border, since markers begin with ``<`` or ``[`` and
end with ``>`` or ``]``.

The loss mask of an example is the span ``[loss_start, loss_end)`` in code
points: the escaped text of the target, without its markers.

Defined cases: a null text or role is empty; rows are ordered by turn (nulls
first), then role, then text; repeated rows are turns each; rows with a null
conversation id are one conversation; an empty table gives no examples; other
columns of the input, whatever their names, take no part and are not returned.

An example holds its whole conversation up to the target, so a conversation is
gathered in one row, no larger than its own last example; the prefixes of a
conversation are made one after the other while they are written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BEGIN, END, HEAD, HEAD_END = "<s>", "</s>", "[INST]", "[/INST]"
#: The first characters of control strings, and what makes one of them.
_FIRST_OF_CONTROL = r"(<(?=/?s>)|\[(?=/?INST\]))"
_ESCAPED = r"\\(\\?)"
TARGET_ROLE = "assistant"


def escape(text: Column) -> Column:
    """``text`` without control strings, reversibly."""
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), _FIRST_OF_CONTROL, r"$1\\")


def unescape(text: Column) -> Column:
    """The text that :func:`escape` was given."""
    return F.regexp_replace(text, _ESCAPED, "$1")


def format_chats(chats: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text", *, target_role: str = TARGET_ROLE) -> DataFrame:
    """One row per example: ``conv_id``, ``example`` (from 1, in order),
    ``n_turns`` (turns it holds), ``trainable``, ``formatted``, ``loss_start``
    and ``loss_end``."""
    empty = F.lit("")
    rows = chats.select(F.col(conv_col).alias("__c"), F.struct(
        F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col).cast("string"), empty).alias("role"),
        F.coalesce(F.col(text_col), empty).alias("text")).alias("__r"))
    whole = rows.groupBy("__c").agg(F.sort_array(F.collect_list("__r")).alias("__r"))
    turns = F.transform("__r", lambda r: F.concat(
        F.lit(HEAD), escape(r["role"]), F.lit(HEAD_END), escape(r["text"]), F.lit(END)))
    place = F.transform("__r", lambda r, i: F.when(r["role"] == target_role, i + 1))
    size = F.size("__r")
    targets = F.filter(place, lambda i: i.isNotNull())
    ends = F.when(F.element_at("__r", -1)["role"] == target_role, targets).otherwise(F.concat(targets, F.array(size)))
    made = whole.select("__c", turns.alias("__turns"), ends.alias("__ends"), F.size(targets).alias("__targets"))
    # the places are exploded, not the texts: one prefix at a time is in memory
    one = made.select("__c", "__turns", "__targets", F.posexplode("__ends").alias("__e", "__n"))
    text = F.concat(F.lit(BEGIN), F.array_join(F.slice("__turns", F.lit(1), F.col("__n")), ""))
    out = one.select("__c", (F.col("__e") + 1).alias("example"), F.col("__n").alias("n_turns"),
                     (F.col("__e") < F.col("__targets")).alias("trainable"), text.alias("formatted"),
                     F.element_at("__turns", F.col("__n")).alias("__last"))
    # escaped roles hold no marker: the first one ends the head
    body = F.length("__last") - F.length(F.substring_index("__last", HEAD_END, 1)) - len(HEAD_END) - len(END)
    end = F.when(F.col("trainable"), F.length("formatted") - len(END)).otherwise(F.lit(0))
    return out.select(F.col("__c").alias(conv_col), "example", "n_turns", "trainable", "formatted",
                      (end - F.when(F.col("trainable"), body).otherwise(F.lit(0))).alias("loss_start"), end.alias("loss_end"))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted example: array of (``role``, ``text``)."""
    inner = F.substring(formatted, F.lit(len(BEGIN) + 1), F.length(formatted))
    pieces = F.split(inner, F.lit(END))
    turns = F.slice(pieces, F.lit(1), F.size(pieces) - 1)  # behind the last end marker is nothing
    return F.transform(turns, lambda t: F.struct(
        unescape(F.substring(F.substring_index(t, HEAD_END, 1), F.lit(len(HEAD) + 1), F.length(t))).alias("role"),
        unescape(F.substring(t, F.length(F.substring_index(t, HEAD_END, 1)) + len(HEAD_END) + 1, F.length(t))).alias("text")))


def read_target(formatted: Column, loss_start: Column, loss_end: Column) -> Column:
    """The text under the loss mask, as it was given."""
    return unescape(F.substring(formatted, loss_start + 1, loss_end - loss_start))
