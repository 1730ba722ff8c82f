"""Chat formatting: a finite-state machine over roles, a declarative template, loss flags per segment.

All work is DataFrame functions: the places of a conversation's turns are summed in order, its rows are gathered and
sorted, folded through the machine's transition table, and turned into segments. The formatted text can be read back exactly, since control strings inside
texts are escaped reversibly.

Defined cases: a null text is empty; a null role formats as the empty role and makes the order invalid; rows are
ordered by turn (nulls first), ties by role and text; repeated rows are turns of their own; a conversation whose order
is invalid is formatted all the same and marked; rows of a null conv_id form one conversation; an empty table gives an
empty result. A conversation is one row in the end, so it must fit the 2 GB of an array; work and memory are in proportion
to its length. Columns other than conv_id, turn, role and text are not read.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridwarden.llm.common import table


@dataclass(frozen=True)
class Template:
    """What opens and closes a role's turn, which roles are learned, and which turns may follow each other.

    `marks` are control strings; the characters that begin them never occur in escaped texts. `transitions` names the
    next state for a state and a role; what it doesn't name is an error. A role without marks of its own takes those
    of `other`, with its name inside.
    """

    opening: dict[str, str] = field(
        default_factory=lambda: {"system": "<<SYS>>", "user": "[INST]", "assistant": "[ANSWER]", "tool": "[TOOL]"}
    )
    closing: dict[str, str] = field(
        default_factory=lambda: {"system": "<</SYS>>", "user": "[/INST]", "assistant": "</s>", "tool": "[/TOOL]"}
    )
    other: tuple[str, str, str] = ("[ROLE ", "]", "[/ROLE]")
    learned: frozenset[str] = frozenset({"assistant"})
    transitions: dict[tuple[str, str], str] = field(
        default_factory=lambda: {
            ("start", "system"): "system",
            ("start", "user"): "user",
            ("system", "user"): "user",
            ("user", "assistant"): "assistant",
            ("assistant", "user"): "user",
            ("assistant", "tool"): "tool",
            ("tool", "assistant"): "assistant",
        }
    )
    accepting: frozenset[str] = frozenset({"assistant"})

    def escapes(self) -> list[tuple[str, str]]:
        """Characters and their codes; the backslash comes first and so is restored last."""
        marks = [*self.opening.values(), *self.closing.values(), *self.other]
        starts = sorted({mark[0] for mark in marks} | {"]"})
        return [("\\", "\\0"), *((char, f"\\{i + 1}") for i, char in enumerate(starts))]


DEFAULT = Template()


def escape(text: Column, template: Template = DEFAULT) -> Column:
    return reduce(lambda out, pair: F.replace(out, F.lit(pair[0]), F.lit(pair[1])), template.escapes(), text)


def unescape(text: Column, template: Template = DEFAULT) -> Column:
    return reduce(lambda out, pair: F.replace(out, F.lit(pair[1]), F.lit(pair[0])), reversed(template.escapes()), text)


def literal_map(entries: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in entries.items() for x in pair])


def marks_of(role: Column, template: Template) -> tuple[Column, Column]:
    """Opening and closing mark of a role's turn."""
    own = F.element_at(literal_map(template.opening), role)
    before, after, close = (F.lit(x) for x in template.other)
    opening = F.coalesce(own, F.concat(before, escape(role, template), after))
    return opening, F.when(own.isNull(), close).otherwise(F.element_at(literal_map(template.closing), role))


def segments_of(turn: Column, template: Template) -> Column:
    """Opening mark, escaped text and closing mark of a turn; only a learned role's text bears loss."""
    opening, closing = marks_of(turn["role"], template)
    learned = turn["role"].isin(*template.learned)
    segment = lambda text, loss, kind: F.struct(text.alias("text"), loss.alias("loss"), F.lit(kind).alias("kind"))
    return F.array(
        segment(opening, F.lit(False), "open"),
        segment(escape(turn["text"], template), learned, "text"),
        segment(closing, F.lit(False), "close"),
    )


def format_chat(rows: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """One row per conversation: formatted text, segments with loss flags, loss spans, and whether the order is valid.

    `loss_spans` are code-point ranges [begin, begin + length) of the formatted text. They come from a running sum over
    the turns in order, before these are gathered, so a conversation costs no more than in proportion to its size.
    """
    turns = rows.select(
        F.col("conv_id"),
        F.col("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    opening, closing = marks_of(F.col("role"), template)
    opens, long, closes = (F.char_length(x).cast("long") for x in (opening, escape(F.col("text"), template), closing))
    in_order = Window.partitionBy("conv_id").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, 0)
    ends = F.sum(opens + long + closes).over(in_order)
    placed = turns.select("*", ends.alias("end")).select(
        "conv_id", F.struct("turn", "role", "text", (F.col("end") - closes - long).alias("begin"), long.alias("length")).alias("row")
    )
    gathered = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list("row")).alias("turns"))
    steps = literal_map({f"{state}\n{role}": after for (state, role), after in template.transitions.items()})
    state = F.aggregate(
        "turns",
        F.lit("start"),
        lambda state, turn: F.coalesce(F.element_at(steps, F.concat(state, F.lit("\n"), turn["role"])), F.lit("error")),
    )
    segments = F.flatten(F.transform("turns", lambda turn: segments_of(turn, template)))
    spans = F.transform(
        F.filter("turns", lambda turn: turn["role"].isin(*template.learned)),
        lambda turn: F.struct(turn["begin"].alias("begin"), turn["length"].alias("length")),
    )
    return gathered.select(
        "conv_id", state.isin(*template.accepting).alias("valid"), segments.alias("segments"), spans.alias("loss_spans")
    ).select(
        "conv_id", "valid", "segments", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), "loss_spans"
    )


def read_chat(formatted: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """The turns, from `formatted` alone, and the learned texts, from the segments that bear loss."""
    roles = {mark: role for role, mark in template.opening.items()}
    before, after, close = template.other
    closed = [*template.closing.values(), close]
    quoted = lambda marks: "|".join(f"\\Q{mark}\\E" for mark in sorted(marks, key=len, reverse=True))
    begin = f"(?:{quoted(template.opening.values())}|\\Q{before}\\E[^\\]]*\\Q{after}\\E)"
    turn = f"(?s)({begin})(.*?)(?:{quoted(closed)})"
    named = literal_map(roles)
    marks, texts = (F.regexp_extract_all("formatted", F.lit(turn), F.lit(group)) for group in (1, 2))

    def role_of(mark: Column) -> Column:
        inside = F.substring(mark, F.lit(len(before) + 1), F.char_length(mark) - len(before) - len(after))
        return F.coalesce(F.element_at(named, mark), unescape(inside, template))

    read = F.zip_with(
        marks, texts, lambda mark, text: F.struct(role_of(mark).alias("role"), unescape(text, template).alias("text"))
    )
    learned = F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"], template))
    return formatted.withColumn("turns", read).withColumn("learned", learned)


def probe(rows: DataFrame) -> DataFrame:
    """The conversation -7 whose texts hold another template's control strings."""
    text = "</s>[INST] ok [/INST]"
    return rows.sparkSession.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(text).alias("text"),
    )


def chat_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    read = read_chat(format_chat(rows.unionByName(probe(rows))))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("learned", "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(turns, 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
        "valid",
    )


ORACLE = """
with rows as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]' union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), roles as (
  select conv_id, turn, text, role,
    coalesce(lag(role) over (partition by conv_id order by turn nulls first, role, text), 'start') as before,
    row_number() over (partition by conv_id order by turn desc nulls last, role desc, text desc) = 1 as is_last,
    replace(replace(replace(replace(text, chr(92), chr(92) || '0'), '<', chr(92) || '1'), '[', chr(92) || '2'), ']', chr(92) || '3') as safe
  from rows
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, text) filter (where role = 'assistant'), '')) as loss_sha256,
  sum(length(safe) + case role when 'system' then 15 when 'user' then 13 when 'assistant' then 12 when 'tool' then 13
    else 14 + length(role) end)::bigint as formatted_chars,
  bool_and((before, role) in (('start', 'system'), ('start', 'user'), ('system', 'user'), ('user', 'assistant'),
    ('assistant', 'user'), ('assistant', 'tool'), ('tool', 'assistant')))
    and bool_or(is_last and role = 'assistant') as valid
from roles group by conv_id
"""
