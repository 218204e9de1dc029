"""Chat formatting: a finite-state machine over roles, a declarative template, and segments with loss flags.

The template is data: marks around a turn, further control strings, and the roles whose texts are learned. The
first character of each mark and control string, and the backslash, become a backslash and a code in texts and
roles, so no such string can begin inside a text, and putting the characters back gives the text. A template
whose turns could not be told apart (an empty mark, one with a backslash, an ``end`` that begins inside another
mark) is an error.

The machine reads the roles in turn order: START -system-> SYSTEM, START/SYSTEM/ANSWERED -user-> ASKED, ASKED
-assistant-> ANSWERED, anything else -> BAD, which stays. A conversation is valid if it ends in ASKED or
ANSWERED. Invalid ones are formatted as well and flagged.

DataFrame functions only. One conversation becomes one row, as it is one training example; a conversation is
never split. Defined cases: NULL texts and roles count as empty; equal turn numbers are ordered by role,
then text; NULL turn numbers come first; rows repeated in full are turns of their own; rows with a NULL
conv_id form one conversation; extra columns are not carried.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SYSTEM, ASKED, ANSWERED, BAD = range(5)


@dataclass(frozen=True)
class Template:
    """Marks of a turn: ``begin`` role ``middle`` text ``end``. ``controls``: other strings that texts must not hold.
    ``learned``: roles whose texts carry loss. ``moves``: (state, role) to the next state."""

    begin: str = "<s>["
    middle: str = "] "
    end: str = "</s>"
    controls: tuple[str, ...] = ("[INST]", "[/INST]")
    learned: tuple[str, ...] = ("assistant",)
    moves: dict[tuple[int, str], int] = field(
        default_factory=lambda: {
            (START, "system"): SYSTEM,
            (START, "user"): ASKED,
            (SYSTEM, "user"): ASKED,
            (ANSWERED, "user"): ASKED,
            (ASKED, "assistant"): ANSWERED,
        }
    )
    final: tuple[int, ...] = (ASKED, ANSWERED)

    def __post_init__(self) -> None:
        strings = (self.begin, self.middle, self.end, *self.controls)
        if any(not s or "\\" in s for s in strings):
            raise ValueError("a mark or control string is empty or holds a backslash")
        for mark in (self.begin, self.middle):
            if self.end in mark or any(self.end.startswith(mark[i:]) for i in range(len(mark))):
                raise ValueError(f"the end mark {self.end!r} can begin inside {mark!r}")

    def codes(self) -> list[tuple[str, str]]:
        """What stands for the backslash, which is first, and for each first character; no code is such a character."""
        firsts = sorted({s[0] for s in (self.begin, self.middle, self.end, *self.controls)})
        free = (c for c in map(chr, range(ord("0"), 0xD800)) if c not in firsts and c != "\\")
        return [(c, "\\" + code) for c, code in zip(["\\", *firsts], free, strict=False)]


CHAT = Template()


def escaped(text: Column, template: Template = CHAT) -> Column:
    for char, code in template.codes():
        text = F.replace(text, F.lit(char), F.lit(code))
    return text


def unescaped(text: Column, template: Template = CHAT) -> Column:
    # Each backslash begins a code, and the code of the backslash itself is put back last.
    for char, code in reversed(template.codes()):
        text = F.replace(text, F.lit(code), F.lit(char))
    return text


def _state(roles: Column, template: Template) -> Column:
    """The state after the roles of a conversation."""

    def move(state: Column, role: Column) -> Column:
        after = F.lit(BAD)
        for (of, name), to in template.moves.items():
            after = F.when((state == of) & (role == name), to).otherwise(after)
        return after

    return F.aggregate(roles, F.lit(START), move)


def format_chats(turns: DataFrame, template: Template = CHAT) -> DataFrame:
    """A row per conversation of ``turns`` (conv_id, turn, role, text): conv_id, valid, state, segments (array of
    text and loss, in order) and formatted, their texts joined."""
    empty = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(""))
    rows = turns.select("conv_id", F.struct(F.col("turn"), empty("role").alias("role"), empty("text").alias("text")).alias("one"))
    chats = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("one")).alias("turns"))

    def segments(one: Column) -> Column:
        piece = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
        return F.array(
            piece(F.concat(F.lit(template.begin), escaped(one["role"], template), F.lit(template.middle)), F.lit(False)),
            piece(escaped(one["text"], template), one["role"].isin(*template.learned)),
            piece(F.lit(template.end), F.lit(False)),
        )

    state = _state(F.col("turns.role"), template)
    out = chats.select("conv_id", state.alias("state"), F.flatten(F.transform("turns", segments)).alias("segments"))
    return out.select("conv_id", F.col("state").isin(*template.final).alias("valid"), "state", "segments", F.array_join(F.col("segments.text"), "").alias("formatted"))


def parsed(formatted: Column, template: Template = CHAT) -> Column:
    """The turns (array of role and text) of a formatted conversation."""
    whole = F.split(formatted, f"\\Q{template.end}\\E")
    bodies = F.slice(whole, 1, F.size(whole) - 1)

    def turn(body: Column) -> Column:
        inner = F.substr(body, F.lit(len(template.begin) + 1))
        at = F.instr(inner, template.middle)
        return F.struct(unescaped(F.substr(inner, F.lit(1), at - 1), template).alias("role"), unescaped(F.substr(inner, at + len(template.middle)), template).alias("text"))

    return F.transform(bodies, turn)


def learned(segments: Column, template: Template = CHAT) -> Column:
    """The text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescaped(s["text"], template)), "")


def read_back(formatted: DataFrame, template: Template = CHAT) -> DataFrame:
    """Counts and digests of what the output of :func:`format_chats` holds: n_turns, turns_sha256 (role, line break,
    text, line break of each turn), loss_chars, loss_sha256, formatted_chars, valid."""
    rows = formatted.select("conv_id", "valid", parsed(F.col("formatted"), template).alias("turns"), learned(F.col("segments"), template).alias("learned"), F.length("formatted").cast("long").alias("formatted_chars"))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return rows.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines, 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        "formatted_chars",
        "valid",
    )
