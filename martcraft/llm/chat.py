"""Chat formatting by a finite-state machine over roles, built-in functions
only.

A template is data: what may follow what (the machine's transitions; its state
is the role of the turn before, ``START`` before the first), and for each role
the marks that open and close a turn and whether its text is learned. A turn
becomes up to three segments, open mark, text, close mark; only texts carry the
loss flag, marks never do. A conversation's formatted text is its segments in
order, behind the template's first mark.

Every mark starts with a character that stands nowhere else in any mark, so
marks cannot overlap or be completed by a neighbouring text. A mark that occurs
in a text is escaped by one backslash behind its first character; where
backslashes stand there already one more is added, so removing one undoes it
and texts without marks stay as they are. ``read_back`` takes a formatted
text apart again.

The machine needs no fold over a conversation: turns are dealt to blocks of
256 turn numbers, each block learns the state before it from the blocks' last
roles, and inside a block a turn looks at the one before. So ``segments``
splits a conversation of any length over tasks; only ``format_chats``, whose
result is one row a conversation, brings its blocks (already put together)
into one row.

Defined cases: a null text or role is empty; a role outside the template gets
the generic marks around its name, is learned never and follows nothing
legally; turns are ordered by turn (null first), then role, then text; repeated
rows are turns of their own; rows with a null id form one conversation; turns
out of order are formatted too and flagged; texts are taken whole; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START = ""


@dataclass(frozen=True)
class Role:
    name: str
    open: str
    close: str
    loss: bool
    after: tuple[str, ...]  # roles (or START) that it may follow


@dataclass(frozen=True)
class Template:
    roles: tuple[Role, ...] = (
        Role("system", "[SYS]", "[/SYS]", False, (START,)),
        Role("user", "[INST]", "[/INST]", False, (START, "system", "assistant")),
        Role("assistant", "[ANS]", "</s>", True, ("user",)),
    )
    begin: str = "<s>"
    # a role of another name: open + name + middle, text, close
    other: tuple[str, str, str] = ("[ROLE]", "[/ROLE]", "[/TURN]")

    def __post_init__(self) -> None:
        marks = self.marks()
        heads = {m[:1] for m in marks}
        if any(len(m) < 2 or "\\" in m or heads & set(m[1:]) for m in marks):
            raise ValueError("a mark has two characters or more, no backslash, and a first character that stands nowhere else in a mark")
        if any(a != b and b.startswith(a) for a in marks for b in marks) or len(set(marks)) < len(marks):
            raise ValueError("no mark begins another one")

    def marks(self) -> list[str]:
        return [m for r in self.roles for m in (r.open, r.close)] + [self.begin, *self.other]

    def _places(self, taken: str) -> str:
        """Regular expression: ``taken`` right behind a mark's first character,
        any backslashes and the rest of the mark ahead."""
        tails: dict[str, list[str]] = {}
        for m in self.marks():
            tails.setdefault(m[0], []).append(re.escape(m[1:]))
        return "|".join(rf"(?<={re.escape(h)}){taken}(?=\\*(?:{'|'.join(t)}))" for h, t in tails.items())

    def escape(self, text: Column) -> Column:
        return F.regexp_replace(text, F.lit(self._places("")), F.lit(r"\\"))

    def unescape(self, text: Column) -> Column:
        return F.regexp_replace(text, F.lit(self._places(r"\\")), F.lit(""))

    def _by_role(self, role: Column, value, other: Column) -> Column:
        out = other
        for r in self.roles:
            out = F.when(role == r.name, value(r)).otherwise(out)
        return out

    def follows(self, role: Column, before: Column) -> Column:
        """The machine's transition: whether ``role`` may come in the state
        ``before``."""
        return self._by_role(role, lambda r: before.isin(list(r.after)), F.lit(False))

    def segments(self, role: Column, text: Column) -> Column:
        """Open mark, text, close mark as structs (text, loss)."""
        piece = lambda t, loss: F.struct(t.alias("text"), loss.alias("loss"))
        opened = self._by_role(role, lambda r: F.lit(r.open), F.concat(F.lit(self.other[0]), self.escape(role), F.lit(self.other[1])))
        return F.array(
            piece(opened, F.lit(False)),
            piece(self.escape(text), self._by_role(role, lambda r: F.lit(r.loss), F.lit(False))),
            piece(self._by_role(role, lambda r: F.lit(r.close), F.lit(self.other[2])), F.lit(False)))

    def read_back(self, formatted: Column) -> Column:
        """The turns of a formatted text, as structs (role, text)."""
        either = lambda marks: "|".join(map(re.escape, marks))
        opens, closes = either([r.open for r in self.roles] + [self.other[0]]), either([r.close for r in self.roles] + [self.other[2]])
        name, begin, end = (len(m) for m in self.other)

        def turn(e: Column) -> Column:
            cut = F.locate(self.other[1], e)
            role, text = F.substring(e, F.lit(name + 1), cut - (name + 1)), F.substring(e, cut + begin, F.length(e) - cut - (begin + end - 1))
            for r in self.roles:
                own = e.startswith(r.open)
                role = F.when(own, F.lit(r.name)).otherwise(self.unescape(role) if r is self.roles[0] else role)
                text = F.when(own, F.substring(e, F.lit(len(r.open) + 1), F.length(e) - len(r.open) - len(r.close))).otherwise(text)
            return F.struct(role.alias("role"), self.unescape(text).alias("text"))

        return F.transform(F.regexp_extract_all(formatted, F.lit(f"(?s)(?:{opens}).*?(?:{closes})"), F.lit(0)), turn)

    def learned(self, segments: Column) -> Column:
        """All text under the loss flags, unescaped, in order."""
        return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: self.unescape(s["text"])), "")


BLOCK = 256  # turn numbers of a block


def _turns(convs: DataFrame) -> DataFrame:
    """conv_id, block, place (order inside the block), role, text, before (the
    machine's state)."""
    rows = convs.select("conv_id", F.expr(f"(turn - pmod(turn, {BLOCK}L)) div {BLOCK}L").alias("block"), F.lit(True).alias("real"), "turn",
                        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    last = rows.groupBy("conv_id", "block").agg(F.max(F.struct("turn", "role")).alias("last"))
    state = F.lag("last.role", 1, START).over(Window.partitionBy("conv_id").orderBy(F.col("block").asc_nulls_first()))
    # a block's first row carries the state before it
    states = last.select("conv_id", "block", F.lit(False).alias("real"), F.lit(None).cast("long").alias("turn"), state.alias("role"),
                         F.lit("").alias("text"))
    order = Window.partitionBy("conv_id", "block").orderBy("real", F.col("turn").asc_nulls_first(), "role", "text")
    return rows.unionByName(states).select(
        "conv_id", "block", "real", "role", "text", F.lag("role").over(order).alias("before"),
        (F.row_number().over(order) - 2).alias("place")).where("real").drop("real")


def segments(convs: DataFrame, template: Template = Template()) -> DataFrame:
    """conv_id, block, place, part, role, text, loss, in_order: the segments as
    rows; (block, place, part) is their order in the conversation. The
    template's first mark is not among them."""
    turns = _turns(convs).withColumn("in_order", template.follows(F.col("role"), F.col("before")))
    return turns.select("conv_id", "block", "place", "role", "in_order", F.posexplode(
        template.segments(F.col("role"), F.col("text"))).alias("part", "s")).select(
        "conv_id", "block", "place", "part", "role", "s.text", "s.loss", "in_order")


def format_chats(convs: DataFrame, template: Template = Template()) -> DataFrame:
    """One row for each conversation: conv_id, segments (structs text, loss),
    formatted, in_order (every turn follows legally)."""
    turns = _turns(convs)
    blocks = turns.groupBy("conv_id", "block").agg(
        F.sort_array(F.collect_list(F.struct("place", template.segments(F.col("role"), F.col("text")).alias("parts")))).alias("turns"),
        F.min(template.follows(F.col("role"), F.col("before"))).alias("in_order"))
    blocks = blocks.select("conv_id", "in_order", F.struct("block", F.flatten("turns.parts").alias("parts")).alias("piece"))
    begin = F.array(F.struct(F.lit(template.begin).alias("text"), F.lit(False).alias("loss")))
    whole = blocks.groupBy("conv_id").agg(F.sort_array(F.collect_list("piece")).alias("pieces"), F.min("in_order").alias("in_order"))
    out = whole.select("conv_id", F.concat(begin, F.flatten("pieces.parts")).alias("segments"), "in_order")
    return out.select("conv_id", "segments", F.array_join("segments.text", "").alias("formatted"), "in_order")
