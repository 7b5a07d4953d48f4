"""Chat formatting: a finite-state machine over roles, and segments with loss flags from a declarative template."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """How conversations are written, and which orders of roles are valid.

    A turn is written as open, role, middle, text, close. ``moves`` gives for each state and role the next state;
    a conversation is valid if it goes from "start" to one of ``ends``. ``loss`` are the roles whose texts are learnt.
    ``reserved`` are control strings of other templates, which are escaped too.
    """

    open: str = "<|im_start|>"
    middle: str = "<|im_sep|>"
    close: str = "<|im_end|>"
    reserved: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]", "<|endoftext|>")
    loss: tuple[str, ...] = ("assistant",)
    ends: tuple[str, ...] = ("assistant",)
    moves: dict[tuple[str, str], str] = field(
        default_factory=lambda: {
            ("start", "system"): "system",
            ("start", "user"): "user",
            ("system", "user"): "user",
            ("user", "assistant"): "assistant",
            ("assistant", "user"): "user",
        }
    )

    @property
    def controls(self) -> tuple[str, ...]:
        return (self.open, self.middle, self.close, *self.reserved)

    @property
    def _firsts(self) -> str:
        """A character class of the control strings' first characters, which none has later on but for repeats in front."""
        return "[" + "".join(re.escape(c) for c in sorted({control[0] for control in self.controls})) + "]"

    @property
    def _rests(self) -> str:
        rests = sorted({control[1:] for control in self.controls})
        return "(?=" + "|".join(re.escape(rest) for rest in rests) + ")"

    def escape(self, text: Column) -> Column:
        """One backslash more after the first character of each control string, or of what was one before escaping."""
        return F.regexp_replace(text, rf"({self._firsts})(\\*){self._rests}", r"$1\\$2")

    def unescape(self, text: Column) -> Column:
        return F.regexp_replace(text, rf"({self._firsts})\\(\\*){self._rests}", "$1$2")


CHAT = Template()


def _checked(template: Template) -> Template:
    firsts = {control[0] for control in template.controls}
    if any(set(control[1:]) & (firsts | {"\\"}) for control in template.controls):
        raise ValueError("a control string holds a backslash, or the first character of one after its own first")
    if len({template.open, template.middle, template.close}) < 3:
        raise ValueError("the marks of a turn must differ")
    return template


def formatted(conversations: DataFrame, template: Template = CHAT) -> DataFrame:
    """conv_id, segments (text, loss), text, n_turns, valid and first_error (the place of the first turn out of order).

    Turns are ordered by turn, nulls first, then role and text. Null roles and texts count as empty; a null conv_id
    is a conversation like any other. All conversations are written, valid or not; a conversation that ends in a
    state that isn't an end is invalid with no first_error. Rows that repeat are turns each; other columns are ignored.
    A conversation becomes one row, so its own rows are gathered in one task, as writing it demands.
    """
    template = _checked(template)
    turn = F.struct(
        "turn",
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    turns = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    moves = F.create_map(*[F.lit(x) for (state, role), to in template.moves.items() for x in (f"{state}\n{role}", to)])

    def step(state: Column, turn: Column) -> Column:
        """(state, turns read, place of the first error)."""
        to = F.coalesce(moves[F.concat(state["state"], F.lit("\n"), turn["role"])], F.lit("error"))
        fresh = (to == "error") & state["error"].isNull()
        return F.struct(
            to.alias("state"),
            (state["read"] + 1).alias("read"),
            F.when(fresh, state["read"]).otherwise(state["error"]).alias("error"),
        )

    start = F.struct(F.lit("start").alias("state"), F.lit(0).alias("read"), F.lit(None).cast("int").alias("error"))

    def written(turn: Column) -> Column:
        def segment(text: Column, loss: Column) -> Column:
            return F.struct(text.alias("text"), loss.alias("loss"))

        head = F.concat(F.lit(template.open), template.escape(turn["role"]), F.lit(template.middle))
        return F.array(
            segment(head, F.lit(False)),
            segment(template.escape(turn["text"]), turn["role"].isin(*template.loss)),
            segment(F.lit(template.close), F.lit(False)),
        )

    run = turns.select(
        "conv_id",
        F.flatten(F.transform("turns", written)).alias("segments"),
        F.size("turns").cast("long").alias("n_turns"),
        F.aggregate("turns", start, step).alias("run"),
    )
    return run.select(
        "conv_id",
        "segments",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("text"),
        "n_turns",
        F.col("run.state").isin(*template.ends).alias("valid"),
        F.col("run.error").alias("first_error"),
    )


def read_back(text: Column, template: Template = CHAT) -> Column:
    """The turns (role, text) written in a formatted text."""

    def turn(part: Column) -> Column:
        halves = F.split(part, re.escape(template.middle), 2)
        body = F.substring_index(halves[1], template.close, 1)
        return F.struct(template.unescape(halves[0]).alias("role"), template.unescape(body).alias("text"))

    parts = F.split(text, re.escape(template.open))
    return F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), turn)


def digests(chats: DataFrame, template: Template = CHAT) -> DataFrame:
    """What formatted conversations say, read back from them: digests of their turns and of the text under the loss mask."""
    turns = read_back(F.col("text"), template)
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    masked = F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: template.unescape(s["text"]))
    return chats.withColumns({"turns": turns, "learnt": F.array_join(masked, "")}).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("learnt").cast("long").alias("loss_chars"),
        F.sha2("learnt", 256).alias("loss_sha256"),
        F.length("text").cast("long").alias("formatted_chars"),
        "valid",
        "first_error",
    )
