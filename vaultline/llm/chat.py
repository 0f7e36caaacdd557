"""Chat formatting in budgeted windows.

A conversation becomes one or more windows of whole turns. Prefix sums of the
turns' tokens choose the spans: the line of tokens is cut every ``stride`` tokens, a turn
belongs to the piece it starts in, and one that crosses a cut is a span of its
own; so a span never holds more than ``stride`` tokens unless it is one longer turn. Each
window holds, in order,

* the system turn (the first turn, if its role is ``system``), in every window that has room for it. Only one of at most
  ``system_share`` tokens is a system turn in this sense; a longer one is an ordinary turn, told once;
* limited history: the last ``history_turns`` turns before the span, as far as
  they have at most ``history_tokens`` tokens together; none before a turn longer than ``stride``;
* the span itself.

So a window has at most ``budget`` tokens, unless it is a single turn that alone has more.

A window is ``<s>`` and its turns, each ``<|role|>text</s>``. Inside roles and
texts ``\\``, ``<`` and ``|`` are written ``\\s``, ``\\l`` and ``\\p``, so no control
string can occur there, and reading back is a plain replacement. The loss mask is a
list of character spans: the assistant texts of the span. Repeated turns (system,
history) are never under it, so each assistant text is a target once.

All steps are DataFrame functions; one shuffle by ``conv_id`` serves them all. A
conversation is one unit of work, as a text is: its turns meet in one task.

Edge cases: a null text or role is empty; turns are ordered by ``turn`` (null
first), then role and text, and repeated rows stay separate turns; a null ``conv_id`` is a
conversation of its own; an empty table gives no rows; a text of any length is one turn; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import WORD

BEGIN, END, OPEN, CLOSE = "<s>", "</s>", "<|", "|>"
LONGEST = 2147483647
ESCAPES = (("\\", "\\s"), ("<", "\\l"), ("|", "\\p"))  # the backslash first


@dataclass(frozen=True)
class Settings:
    budget: int = 1024  # tokens of a window
    system_share: int = 128  # of them kept for the system turn
    history_turns: int = 2
    history_tokens: int = 256
    turn_tokens: int = 4  # a turn's marks
    system_role: str = "system"
    target_role: str = "assistant"

    @property
    def stride(self) -> int:
        return max(1, self.budget - self.system_share - self.history_tokens)


def escaped(c: Column) -> Column:
    for plain, code in ESCAPES:
        c = F.replace(c, F.lit(plain), F.lit(code))
    return c


def unescaped(c: Column) -> Column:
    for plain, code in reversed(ESCAPES):
        c = F.replace(c, F.lit(code), F.lit(plain))
    return c


def spans(conversations: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Each turn with its place ``pos``, its tokens ``n`` and its ``span`` (from 0)."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    turns = conversations.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                                 F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    turns = turns.withColumn("n", F.regexp_count("text", F.lit(WORD)) + s.turn_tokens)
    turns = (turns.withColumn("pos", F.row_number().over(order))
             .withColumn("is_system", (F.col("pos") == 1) & (F.col("role") == s.system_role) & (F.col("n") <= s.system_share)))
    before = (F.sum(F.when(F.col("is_system"), 0).otherwise(F.col("n")))
              .over(order.rowsBetween(Window.unboundedPreceding, -1)))
    turns = turns.withColumn("before", F.coalesce(before, F.lit(0)))
    piece = F.floor(F.col("before") / s.stride)
    crosses = (F.col("before") + F.col("n")) > (piece + 1) * s.stride
    turns = turns.withColumn("cut", F.when(F.col("is_system"), F.lit(-1))
                             .otherwise(2 * piece + crosses.cast("int")))
    # a turn that is longer than a stride is a span of its own; alone, if the system turn does not fit beside it
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    system = F.max(F.when(F.col("is_system"), F.col("n")).otherwise(0)).over(whole)
    turns = turns.withColumn("long", ~F.col("is_system") & (F.col("n") > s.stride)).withColumn(
        "alone", F.col("long") & (F.col("n") + system > s.budget))
    changed = (F.col("cut") != F.lag("cut").over(order)) & ((F.lag("cut").over(order) >= 0) | F.col("alone"))
    return turns.withColumn("span", F.sum(changed.cast("int")).over(order)).withColumn(
        "span", F.coalesce(F.col("span"), F.lit(0)))


def windows(conversations: DataFrame, s: Settings = Settings()) -> DataFrame:
    """One row per window: ``conv_id``, ``window``, ``formatted``, ``n_repeated`` (turns at its
    start that an earlier window has held) and ``loss`` (character spans, end exclusive)."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    turns = spans(conversations, s).withColumn("last", F.max("span").over(whole))
    places = [F.array(F.col("span"))]
    behind = F.lit(0)  # tokens from this turn to the one before a later span's first
    for d in range(1, s.history_turns + 1):
        behind = behind + (F.col("n") if d == 1 else F.lead("n", d - 1).over(order))
        here, earlier = F.lead("span", d).over(order), (F.col("span") if d == 1
                                                       else F.lead("span", d - 1).over(order))
        room = (behind <= s.history_tokens) & ~F.lead("long", d).over(order)
        places.append(F.when((here != earlier) & room & ~F.col("is_system"),
                             F.array(here)).otherwise(F.array().cast("array<bigint>")))
    full = F.collect_set(F.when(F.col("alone"), F.col("span"))).over(whole)  # windows without room for a system turn
    turns = turns.withColumn("windows", F.when(F.col("is_system"), F.array_except(F.sequence(F.lit(0).cast("bigint"), "last"), full))
                             .otherwise(F.concat(*places)))
    turns = turns.select(
        "conv_id", "pos", "span", F.explode("windows").alias("window"),
        F.concat(F.lit(OPEN), escaped(F.col("role")), F.lit(CLOSE)).alias("head"),
        escaped(F.col("text")).alias("body"), (F.col("role") == s.target_role).alias("target"))
    turns = turns.withColumn("again", F.col("window") != F.col("span"))
    held = (turns.groupBy("conv_id", "window")
            .agg(F.array_sort(F.collect_list(F.struct("pos", "again", "target", "head", "body"))).alias("t")))
    text = F.concat(F.lit(BEGIN), F.array_join(F.transform(
        "t", lambda x: F.concat(x.head, x.body, F.lit(END))), ""))
    place = F.aggregate(  # prefix sums of the turns' lengths give the spans under the mask
        "t", F.struct(F.lit(len(BEGIN)).alias("at"),
                      F.array().cast("array<struct<start:int,end:int>>").alias("spans")),
        lambda a, x: F.struct(
            (a.at + F.length(x.head) + F.length(x.body) + len(END)).alias("at"),
            F.when(x.target & ~x.again, F.concat(a.spans, F.array(F.struct(
                (a.at + F.length(x.head)).alias("start"),
                (a.at + F.length(x.head) + F.length(x.body)).alias("end"))))).otherwise(a.spans).alias("spans")),
        lambda a: a.spans)
    return held.select("conv_id", "window", text.alias("formatted"),
                       F.size(F.filter("t", lambda x: x.again)).alias("n_repeated"), place.alias("loss"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Each conversation as its windows tell it: ``conv_id``, ``turns`` (role and text of every turn
    once, in order), ``loss_text`` and ``formatted_chars``."""
    parts = F.split(F.substring("formatted", len(BEGIN) + 1, LONGEST), END)  # the last one is empty
    parts = F.slice(parts, F.col("n_repeated") + 1, F.size(parts) - 1 - F.col("n_repeated"))
    turns = F.transform(parts, lambda p: F.struct(
        unescaped(F.substring(F.substring_index(p, CLOSE, 1), len(OPEN) + 1, LONGEST)).alias("role"),
        unescaped(F.substr(p, F.instr(p, CLOSE) + len(CLOSE))).alias("text")))
    loss = F.array_join(F.transform("loss", lambda x: unescaped(
        F.substr(F.col("formatted"), x.start + 1, x.end - x.start))), "")
    each = formatted.select("conv_id", F.struct("window", turns.alias("turns"), loss.alias("loss")).alias("w"),
                            F.char_length("formatted").cast("long").alias("chars"))
    whole = each.groupBy("conv_id").agg(F.array_sort(F.collect_list("w")).alias("w"),
                                        F.sum("chars").alias("formatted_chars"))
    return whole.select("conv_id", F.flatten("w.turns").alias("turns"),
                        F.array_join("w.loss", "").alias("loss_text"), "formatted_chars")


def digests(conversations: DataFrame, s: Settings = Settings()) -> DataFrame:
    """What the windows of each conversation hold, as counts and digests."""
    told = read_back(windows(conversations, s))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    return told.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                       F.sha2(lines, 256).alias("turns_sha256"),
                       F.char_length("loss_text").cast("long").alias("loss_chars"),
                       F.sha2("loss_text", 256).alias("loss_sha256"), "formatted_chars")
