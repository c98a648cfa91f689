"""Chat formatting by perspective rotation: each participant in turn is the assistant of the dialogue."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

NOBODY = "unknown"


def rotate_perspectives(conversations: DataFrame, system: str = "system", part_turns: int = 512) -> DataFrame:
    """conv_id, speaker, part, rendered, mask, n_messages, n_target: the dialogue as ``speaker`` sees it.

    For every participant of a conversation, that speaker's messages are rendered as ``assistant``, the
    messages of others as ``user`` with their name, and system messages as ``system``; ``mask`` lists the
    character ranges "start-end" of the assistant's own texts in ``rendered``, joined by ";". A dialogue is
    rendered in parts of ``part_turns`` turns (one part, numbered 0, for all ordinary ones), so a
    conversation of any length is spread over tasks; the parts joined in order are the whole dialogue.

    System messages are no participant; a conversation of these alone gives no rows. Messages are ordered by
    turn (null first), then role and text. Messages alike in conversation, turn, role and text are one. A
    null role is the speaker "unknown", a null text is empty, and rows without conv_id form a conversation.
    """
    messages = conversations.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(NOBODY)).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).distinct()
    speakers = (
        messages.filter(F.col("role") != system)
        .select(F.col("conv_id").alias("of"), F.col("role").alias("speaker"))
        .distinct()
    )
    target = F.col("role") == F.col("speaker")
    head = (
        F.when(target, F.lit("<|im_start|>assistant\n"))
        .when(F.col("role") == system, F.lit("<|im_start|>system\n"))
        .otherwise(F.concat(F.lit("<|im_start|>user name="), "role", F.lit("\n")))
    )
    seen = messages.join(speakers, F.col("conv_id").eqNullSafe(F.col("of"))).select(
        "conv_id",
        "speaker",
        F.floor(F.coalesce(F.col("turn"), F.lit(0)) / part_turns).alias("part"),
        "turn",
        "role",
        "text",
        target.alias("target"),
        head.alias("head"),
        F.concat(head, "text", F.lit("<|im_end|>\n")).alias("segment"),
    )
    order = Window.partitionBy("conv_id", "speaker", "part").orderBy("turn", "role", "text")
    place = F.sum(F.length("segment")).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    begin = place - F.length("segment") + F.length("head")
    placed = seen.withColumns({"n": F.row_number().over(order), "begin": begin})
    span = F.when(F.col("target"), F.concat_ws("-", "begin", F.col("begin") + F.length("text")))
    in_order = F.array_sort(F.collect_list(F.struct("n", "segment", span.alias("span"))))
    return (
        placed.groupBy("conv_id", "speaker", "part")
        .agg(in_order.alias("all"), F.count("*").alias("n_messages"), F.count_if("target").alias("n_target"))
        .select(
            "conv_id",
            "speaker",
            "part",
            F.array_join("all.segment", "").alias("rendered"),
            F.array_join("all.span", ";").alias("mask"),
            "n_messages",
            "n_target",
        )
    )


COMPARISON = r"""
with messages as (
    select distinct conv_id, cast(turn as bigint) as turn, coalesce(role, 'unknown') as role, coalesce(text, '') as text
    from conversations
), speakers as (
    select distinct conv_id, role as speaker from messages where role <> 'system'
), seen as (
    select m.conv_id, s.speaker, coalesce(m.turn, 0) // 512 as part, m.turn, m.role, m.text, m.role = s.speaker as target,
        case when m.role = s.speaker then '<|im_start|>assistant' || chr(10)
             when m.role = 'system' then '<|im_start|>system' || chr(10)
             else '<|im_start|>user name=' || m.role || chr(10) end as head
    from messages m join speakers s on m.conv_id is not distinct from s.conv_id
), placed as (
    select *, head || text || '<|im_end|>' || chr(10) as segment,
        row_number() over w as n,
        sum(length(head) + length(text) + 11) over (w rows unbounded preceding) - length(text) - 11 as begins
    from seen
    window w as (partition by conv_id, speaker, part order by turn nulls first, role, text)
)
select conv_id, speaker, part, string_agg(segment, '' order by n) as rendered,
    coalesce(string_agg(begins || '-' || (begins + length(text)), ';' order by n) filter (where target), '') as mask,
    count(*) as n_messages, count(*) filter (where target) as n_target
from placed group by conv_id, speaker, part
"""
