"""Chat formatting (operator 7): a finite-state machine over roles and a declarative template.

A conversation's turns, in the order of ``turn`` (ties: role, then text), become text segments
with a loss flag each: header, body, end of turn. The machine's table says which role may follow
which and in which states a conversation may end; conversations that break it are formatted all
the same and flagged. Inside roles and texts the template's control characters are escaped, so a
text that spells a header or an end mark stays text; ``parse`` is the exact inverse.

Nulls: a null text is empty, a null role is an empty role (which no state accepts), a null turn
comes first; rows with a null conv_id are one conversation. Repeated rows are repeated turns.
One conversation is one output row, so its text must fit a row.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """What a turn looks like, which roles are learned from, and the role machine."""

    head: str = "### "
    after_role: str = ": "
    end: str = " </turn>\n"
    learned: tuple[str, ...] = ("assistant",)
    #: control character -> escape; the backslash comes first, and every escape starts with it.
    escapes: tuple[tuple[str, str], ...] = (("\\", "\\b"), ("#", "\\h"), ("<", "\\l"), (":", "\\c"))
    moves: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        "start": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)})
    final: tuple[str, ...] = ("user", "assistant")


CHAT = Template()


def escape(text: Column, template: Template = CHAT) -> Column:
    for raw, safe in template.escapes:
        text = F.replace(text, F.lit(raw), F.lit(safe))
    return text


def unescape(text: Column, template: Template = CHAT) -> Column:
    for raw, safe in reversed(template.escapes):
        text = F.replace(text, F.lit(safe), F.lit(raw))
    return text


def valid_order(roles: Column, template: Template = CHAT) -> Column:
    """Whether the machine accepts the roles."""
    table = F.create_map(*[x for state, after in template.moves.items() for role in after
                           for x in (F.lit(f"{state}>{role}"), F.lit(role))])
    end = F.aggregate(roles, F.lit("start"), lambda state, role: F.coalesce(
        F.try_element_at(table, F.concat(state, F.lit(">"), role)), F.lit("broken")))
    return end.isin(*template.final)


def format_chats(conversations: DataFrame, template: Template = CHAT) -> DataFrame:
    """conv_id, n_turns, valid, segments: array<struct<text, loss>>, formatted."""
    turns = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(
        "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")))).alias("turns"))
    segments = F.flatten(F.transform("turns", lambda t: F.array(
        F.struct(F.concat(F.lit(template.head), escape(t["role"], template), F.lit(template.after_role)).alias("text"),
                 F.lit(False).alias("loss")),
        F.struct(escape(t["text"], template).alias("text"), t["role"].isin(*template.learned).alias("loss")),
        F.struct(F.lit(template.end).alias("text"), F.lit(False).alias("loss")))))
    out = turns.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                       valid_order(F.transform("turns", lambda t: t["role"]), template).alias("valid"),
                       segments.alias("segments"))
    return out.withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def parse(formatted: Column, template: Template = CHAT) -> Column:
    """array<struct<role, text>> of a formatted conversation."""
    def turn(x: Column) -> Column:
        # Escapes leave no control character inside a role, so the first mark after it is the header's.
        head = F.substring_index(x, template.after_role, 1)
        return F.struct(
            unescape(F.substr(head, F.lit(len(template.head) + 1)), template).alias("role"),
            unescape(F.substr(x, F.char_length(head) + len(template.after_role) + 1), template).alias("text"))
    # The end mark holds no character that is special in a pattern.
    pieces = F.split(formatted, template.end, -1)
    return F.transform(F.slice(pieces, 1, F.size(pieces) - 1), turn)


def learned_text(segments: Column, template: Template = CHAT) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return unescape(F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: s["text"]), ""), template)


def op7(conversations: DataFrame) -> DataFrame:
    """All conversations and the contract's conversation -7, read back from the output."""
    spoken = "\\### Assistant: </turn> ok"
    rows = conversations.select("conv_id", "turn", "role", "text")
    probe = conversations.sparkSession.range(2).select(
        F.lit(-7).alias("conv_id"), F.col("id").alias("turn"), F.element_at(F.array(F.lit("user"), F.lit("assistant")), (F.col("id") + 1).cast("int")).alias("role"),
        F.lit(spoken).alias("text")).select(*[F.col(f.name).cast(f.dataType) for f in rows.schema])
    out = format_chats(rows.unionByName(probe)).select(
        "conv_id", "valid", "formatted", parse(F.col("formatted")).alias("turns"), learned_text(F.col("segments")).alias("learned"))
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(whole, 256).alias("turns_sha256"),
        F.char_length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"), "valid")


SQL = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
m AS (SELECT *, lag(role) OVER w AS before, lead(role) OVER w AS after FROM c
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(4 + 2 + 9 + length(text) + length(regexp_replace(text, '[^\\#<:]', '', 'g'))
      + length(role) + length(regexp_replace(role, '[^\\#<:]', '', 'g')))::BIGINT AS formatted_chars,
  bool_and(CASE WHEN before IS NULL THEN role IN ('system', 'user')
           WHEN before IN ('system', 'assistant') THEN role = 'user'
           WHEN before = 'user' THEN role = 'assistant' ELSE false END
           AND (after IS NOT NULL OR role IN ('user', 'assistant'))) AS valid
FROM m GROUP BY conv_id
"""
