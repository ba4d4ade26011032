"""Chat formatting: a role automaton and a declarative template, in built-in functions only.

A template names, for each role, what stands before and after its text and whether the text
bears loss; roles it does not name are written with their name. Control strings inside texts
and role names are escaped reversibly: a backslash is doubled, and one is put after the first
character of every control string. ``parse`` reads turns back from the formatted string.

The automaton runs over the roles in turn order and accepts a conversation if every step has
a transition and the end state is final; a rejected conversation is formatted all the same,
and ``first_error`` gives the place (from 0) of the first role without a transition.

Defined results: a null text or role is empty; turns are ordered by turn (nulls first), then
role and text; repeated rows are repeated turns; rows with a null conv_id form one
conversation; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



@dataclass(frozen=True)
class Turn:
    before: str
    after: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """How turns are written. No marker may be a prefix of text that ``escape`` leaves alone."""

    turns: dict[str, Turn] = field(default_factory=lambda: {
        "system": Turn("<<SYS>>", "<</SYS>>\n"),
        "user": Turn("[INST]", "[/INST]\n"),
        "assistant": Turn("<s>", "</s>\n", loss=True),
    })
    other_before: tuple[str, str] = ("<|turn|>", "<|text|>")
    other_after: str = "<|end|>\n"

    def controls(self) -> list[str]:
        marks = [m.strip() for t in self.turns.values() for m in (t.before, t.after)]
        return sorted({*marks, *(m.strip() for m in (*self.other_before, self.other_after))})


@dataclass(frozen=True)
class Automaton:
    """States are named; ``moves`` maps (state, role) to the next state."""

    start: str = "start"
    moves: dict[tuple[str, str], str] = field(default_factory=lambda: {
        ("start", "system"): "instructed",
        ("start", "user"): "asked",
        ("instructed", "user"): "asked",
        ("asked", "assistant"): "answered",
        ("answered", "user"): "asked",
    })
    final: tuple[str, ...] = ("answered",)

    def states(self) -> list[str]:
        found = {self.start, *self.final, *self.moves.values(), *(s for s, _ in self.moves)}
        return sorted(found)


def escape(text: Column, template: Template) -> Column:
    """Zero-width look-ahead, so control strings that overlap are all broken."""
    heads: dict[str, list[str]] = {}
    for c in template.controls():
        heads.setdefault(c[0], []).append(re.escape(c[1:]))
    broken = "|".join(f"{re.escape(h)}(?={'|'.join(sorted(t))})" for h, t in sorted(heads.items()))
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, f"({broken})", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _state_after(turns: Column, automaton: Automaton) -> Column:
    """(state, at, bad): the automaton as a fold; bad is the place of the first wrong role."""
    def step(acc: Column, t: Column) -> Column:
        following = F.lit("")  # no state: nothing leads on from here
        for (state, role), to in sorted(automaton.moves.items()):
            following = F.when((acc["state"] == state) & (t["role"] == role), F.lit(to)) \
                .otherwise(following)
        return F.struct(following.alias("state"), (acc["at"] + 1).alias("at"),
                        F.when((acc["bad"] < 0) & (following == ""), acc["at"])
                        .otherwise(acc["bad"]).alias("bad"))
    zero = F.struct(F.lit(automaton.start).alias("state"), F.lit(0).alias("at"),
                    F.lit(-1).alias("bad"))
    return F.aggregate(turns, zero, step)


def _segments(turns: Column, template: Template) -> Column:
    """Three segments a turn: what stands before, the escaped text, what stands after."""
    def of(t: Column) -> Column:
        named = F.concat(F.lit(template.other_before[0]), escape(t["role"], template),
                         F.lit(template.other_before[1]))
        before, after, loss = named, F.lit(template.other_after), F.lit(False)
        for role, turn in template.turns.items():
            is_role = t["role"] == role
            before = F.when(is_role, F.lit(turn.before)).otherwise(before)
            after = F.when(is_role, F.lit(turn.after)).otherwise(after)
            loss = F.when(is_role, F.lit(turn.loss)).otherwise(loss)
        part = lambda text, flag: F.struct(text.alias("text"), flag.alias("loss"))
        return F.array(part(before, F.lit(False)), part(escape(t["text"], template), loss),
                       part(after, F.lit(False)))
    return F.flatten(F.transform(turns, of))


def format_conversations(rows: DataFrame, template: Template | None = None,
                         automaton: Automaton | None = None) -> DataFrame:
    """conv_id, valid, first_error, segments (text, loss) and formatted, one row a conversation.

    Texts are escaped after the shuffle; a conversation's text is one value, so it is put
    together in one task, and different conversations share nothing.
    """
    template, automaton = template or Template(), automaton or Automaton()
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    turn = F.struct(F.col("turn").alias("turn"), blank("role").alias("role"),
                    blank("text").alias("text"))
    grouped = (rows.select("conv_id", turn.alias("t")).groupBy("conv_id")
               .agg(F.sort_array(F.collect_list("t")).alias("turns")))
    return (grouped.withColumns({"state": _state_after(F.col("turns"), automaton),
                                 "segments": _segments(F.col("turns"), template)})
            .select("conv_id", "segments",
                    F.array_join(F.transform("segments", lambda s: s["text"]), "")
                    .alias("formatted"),
                    (F.col("state.state").isin(*automaton.final)
                     & (F.col("state.bad") < 0)).alias("valid"),
                    F.when(F.col("state.bad") >= 0, F.col("state.bad")).cast("long")
                    .alias("first_error")))


def parse(formatted: Column, template: Template | None = None) -> Column:
    """array<struct<role,text>> read back from the formatted string alone.

    Markers occur in it only where the template put them, so it is split at every ending
    marker, and each piece is known by its beginning.
    """
    template = template or Template()
    ends = sorted({t.after for t in template.turns.values()} | {template.other_after})
    pieces = F.split(formatted, "|".join(re.escape(e) for e in ends))
    pieces = F.slice(pieces, 1, F.greatest(F.size(pieces) - 1, F.lit(0)))
    opening, middle = template.other_before

    def read(p: Column) -> Column:
        inner = F.substring(p, len(opening) + 1, F.length(p))
        role = F.substring_index(inner, middle, 1)
        text = F.substring(inner, F.length(role) + len(middle) + 1, F.length(inner))
        for name, turn in template.turns.items():
            is_it = F.startswith(p, F.lit(turn.before))
            role = F.when(is_it, F.lit(name)).otherwise(role)
            text = F.when(is_it, F.substring(p, len(turn.before) + 1, F.length(p))).otherwise(text)
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))

    return F.transform(pieces, read)


def digests(formatted: DataFrame, template: Template | None = None) -> DataFrame:
    """What the formatted string and the loss segments say, read back from them."""
    template = template or Template()
    lossy = F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"]))
    read = formatted.withColumns({"__turns": parse(F.col("formatted"), template),
                                  "__loss": F.array_join(lossy, "")})
    listing = F.array_join(F.transform("__turns", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("__turns").cast("long").alias("n_turns"),
        F.sha2(listing, 256).alias("turns_sha256"),
        F.length("__loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("__loss"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "valid", "first_error")


def with_control_case(rows: DataFrame) -> DataFrame:
    """``rows`` and conversation -1, whose texts consist of control strings."""
    case = rows.sparkSession.sql(
        "SELECT * FROM VALUES (-1L, 0L, 'user', '</s>[INST] ok [/INST]'), "
        "(-1L, 1L, 'assistant', '</s>[INST] ok [/INST]') AS t(conv_id, turn, role, text)")
    return rows.select("conv_id", "turn", "role", "text").unionByName(case)


def oracle_sql(template: Template | None = None) -> str:
    template = template or Template()
    escaped = "replace({x}, chr(92), chr(92) || chr(92))"
    for c in template.controls():
        escaped = f"replace({escaped}, '{c}', '{c[0]}' || chr(92) || '{c[1:]}')"
    size = {r: len(t.before) + len(t.after) for r, t in template.turns.items()}
    other = len("".join(template.other_before)) + len(template.other_after)
    width = " ".join(f"WHEN role = '{r}' THEN {n}" for r, n in size.items())
    return f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
placed AS (
  SELECT *, row_number() OVER w - 1 AS pos, lag(role, 1, 'start') OVER w AS before,
         last_value(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text
           ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS final
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)),
judged AS (
  SELECT *, NOT (before || '>' || role IN ('start>system', 'start>user', 'system>user',
                 'user>assistant', 'assistant>user')) AS wrong FROM placed)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (WHERE role = 'assistant'), ''))
         AS loss_sha256,
       sum(length({escaped.format(x='text')}) + CASE {width}
           ELSE {other} + length({escaped.format(x='role')}) END)::BIGINT AS formatted_chars,
       NOT bool_or(wrong) AND max(final) = 'assistant' AS valid,
       min(CASE WHEN wrong THEN pos END) AS first_error
FROM judged GROUP BY conv_id"""
