"""Chat formatting by a finite-state machine over roles, from a declarative template.

A template names, for each role, its header and whether its text is learned, the string that closes
a turn, the allowed transitions between states and the accepting states. Each conversation becomes an
array of segments (text, loss): header, escaped text and closing string of every turn; the text alone
carries the role's loss flag. The machine's last state and whether it accepts come with it; no
conversation is dropped here.

Escapes are reversible: every backslash and every control string (header mark, closing mark) in a text
becomes a backslash and a digit, so neither can occur inside a text. Only DataFrame functions are used.

Defined results: null text is empty; a null role, and one that the template doesn't name, are written
with their own escaped header, read back as they were (null as empty) and reject; equal turn numbers go
by role and text; rows with a null conversation id form one conversation of their own; other columns
are ignored. One conversation is one output row, so its turns meet in one task.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """headers: role to title; learned: roles under the loss; moves: state to the states that may follow."""

    mark: str = "### "
    colon: str = ": "
    close: str = "</turn>\n"
    titles: dict[str, str] = field(default_factory=lambda: {"system": "System", "user": "User", "assistant": "Assistant"})
    learned: tuple[str, ...] = ("assistant",)
    moves: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {"start": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)}
    )
    accept: tuple[str, ...] = ("assistant",)

    @property
    def controls(self) -> tuple[tuple[str, str], ...]:
        """What is escaped and as what, in this order; undone in reverse."""
        return ("\\", "\\0"), (self.mark.strip(), "\\1"), (self.close.strip(), "\\2")


def escape(text: Column, template: Template) -> Column:
    for plain, safe in template.controls:
        text = F.replace(text, F.lit(plain), F.lit(safe))
    return text


def unescape(text: Column, template: Template) -> Column:
    for plain, safe in reversed(template.controls):
        text = F.replace(text, F.lit(safe), F.lit(plain))
    return text


def _title(role: Column, template: Template) -> Column:
    """Known roles by their title; others as backslash 4 and the escaped role, null as backslash 5."""
    known = F.coalesce(*[F.when(role == r, F.lit(t)) for r, t in template.titles.items()])
    other = F.concat(F.lit("\\4"), F.replace(escape(role, template), F.lit(":"), F.lit("\\3")))
    return F.coalesce(known, other, F.lit("\\5"))


def _role(title: Column, template: Template) -> Column:
    known = F.coalesce(*[F.when(title == t, F.lit(r)) for r, t in template.titles.items()])
    other = F.when(F.startswith(title, F.lit("\\4")), unescape(F.replace(F.substr(title, F.lit(3)), F.lit("\\3"), F.lit(":")), template))
    return F.coalesce(known, other, F.lit(""))


def format_conversations(rows: DataFrame, template: Template = Template()) -> DataFrame:
    """(conv_id, segments array<struct<text, loss>>, state, valid) from rows (conv_id, turn, role, text)."""
    turns = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", F.coalesce("text", F.lit("")).alias("text")))).alias("turns"))

    def parts(t: Column) -> Column:
        def segment(text: Column, loss: Column) -> Column:
            return F.struct(text.alias("text"), loss.alias("loss"))

        loss = F.coalesce(t["role"].isin(*template.learned), F.lit(False))
        return F.array(
            segment(F.concat(F.lit(template.mark), _title(t["role"], template), F.lit(template.colon)), F.lit(False)),
            segment(escape(t["text"], template), loss),
            segment(F.lit(template.close), F.lit(False)),
        )

    allowed = [f"{a}>{b}" for a, after in template.moves.items() for b in after]

    def move(state: Column, t: Column) -> Column:
        return F.when(F.concat_ws(">", state, t["role"]).isin(*allowed), t["role"]).otherwise(F.lit("reject"))

    state = F.aggregate("turns", F.lit("start"), move)
    return turns.select("conv_id", F.flatten(F.transform("turns", parts)).alias("segments"), state.alias("state")).withColumn(
        "valid", F.col("state").isin(*template.accept)
    )


def read_back(formatted: DataFrame, template: Template = Template()) -> DataFrame:
    """(conv_id, formatted, turns array<struct<role, text>>, learned, state, valid): turns and learned are parsed from the segments' text and flags alone."""
    text = F.array_join(F.transform("segments", lambda s: s["text"]), "")
    learned = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"], template)), "")
    close = "".join(f"\\x{ord(c):02x}" for c in template.close)

    def turn(piece: Column) -> Column:
        at = F.instr(piece, template.colon)
        title = F.substr(piece, F.lit(len(template.mark) + 1), at - F.lit(len(template.mark) + 1))
        body = F.substr(piece, at + F.lit(len(template.colon)))
        return F.struct(_role(title, template).alias("role"), unescape(body, template).alias("text"))

    out = formatted.select("conv_id", text.alias("formatted"), learned.alias("learned"), "state", "valid")
    pieces = F.filter(F.split("formatted", close), lambda p: p != "")
    return out.select("conv_id", "formatted", F.transform(pieces, turn).alias("turns"), "learned", "state", "valid")
