"""Preference pairs for chat training, in DataFrame and SQL functions only.

A pair of conversations, the chosen one and the rejected one, shares its first turns. The longest common prefix of
turns is rendered once, as the prompt; what follows in each conversation is rendered as its completion, together
with a mask: the code points of prompt + completion that are trained on, which are the bodies of the assistant's
turns and their end marks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEAD, NECK, TAIL = "<|", "|>\n", "<|end|>\n"
TURNS = "array<struct<role: string, text: string>>"
ASSISTANT = "assistant"


def conversation_turns(conversations: DataFrame) -> DataFrame:
    """One row per conv_id with its ``turns`` in order; a conversation is one unit of training and so one row.

    Repeated rows are one turn; rows of equal turn number stand in the order of role and text; a null turn number
    comes first, a null role is the user's, a null text is empty. Rows without conv_id belong to no conversation.
    """
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long"),
        F.struct(
            F.col("turn").cast("long"),
            F.coalesce(F.col("role").cast("string"), F.lit("user")).alias("role"),
            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        ).alias("one"),
    )
    ordered = rows.groupBy("conv_id").agg(F.sort_array(F.collect_set("one")).alias("ordered"))
    return ordered.select("conv_id", F.expr(f"CAST(transform(ordered, t -> struct(t.role AS role, t.text AS text)) AS {TURNS})").alias("turns"))


def echo_pairs(conversations: DataFrame) -> DataFrame:
    """conv_id, chosen and rejected: the conversation up to the assistant's last turn, and the same conversation
    with that turn repeating what the turn before it said (nothing, if it is the first).

    Without a turn of the assistant both are the whole conversation.
    """
    rows = conversation_turns(conversations)
    rows = rows.withColumn("last", F.expr(f"coalesce(array_max(transform(turns, (t, i) -> CASE WHEN t.role = '{ASSISTANT}' THEN i + 1 END)), 0)"))
    spoken = F.expr("CASE WHEN last = 0 THEN turns ELSE slice(turns, 1, last) END")
    echo = F.expr(
        f"""CASE WHEN last = 0 THEN turns ELSE concat(slice(turns, 1, last - 1), CAST(array(named_struct(
            'role', '{ASSISTANT}', 'text', CASE WHEN last > 1 THEN element_at(turns, greatest(last - 1, 1)).text ELSE '' END)) AS {TURNS})) END"""
    )
    return rows.select("conv_id", spoken.alias("chosen"), echo.alias("rejected"))


def _body(text: str) -> str:
    """SQL: a turn's text, in which nothing can pass for a mark of the format."""
    return f"replace({text}, '{HEAD}', '< |')"


def _rendered(turns: str) -> Column:
    neck, tail = NECK.replace("\n", "\\n"), TAIL.replace("\n", "\\n")
    return F.expr(f"concat_ws('', transform({turns}, t -> concat('{HEAD}', t.role, '{neck}', {_body('t.text')}, '{tail}')))")


def _mask(turns: str, start: str) -> Column:
    """start:end of the assistant's bodies and end marks, comma-joined; ``start`` is where the turns begin."""
    head = f"{len(HEAD) + len(NECK)} + length(t.role)"
    body = f"length({_body('t.text')}) + {len(TAIL)}"
    return F.expr(
        f"""array_join(aggregate({turns}, named_struct('at', CAST({start} AS BIGINT), 'out', CAST(array() AS array<string>)),
            (a, t) -> named_struct('at', CAST(a.at + {head} + {body} AS BIGINT),
                'out', CASE WHEN t.role = '{ASSISTANT}' THEN concat(a.out, array(concat(a.at + {head}, ':', a.at + {head} + {body}))) ELSE a.out END),
            a -> a.out), ',')"""
    )


def preference_pairs(pairs: DataFrame) -> DataFrame:
    """Formats pairs: the columns of ``pairs`` but chosen and rejected, then n_prompt_turns, prompt, chosen, rejected,
    chosen_mask and rejected_mask.

    ``pairs`` has arrays chosen and rejected of (role, text). Where one conversation begins with all of the other,
    the other's completion is empty; equal conversations leave both empty. Null conversations count as empty.
    """
    others = [F.col(f"`{c}`") for c in pairs.columns if c not in ("chosen", "rejected")]
    rows = pairs.select(*others, *[F.coalesce(F.col(c), F.array().cast(TURNS)).alias(f"__{c}") for c in ("chosen", "rejected")])
    shorter = "least(size(__chosen), size(__rejected))"
    differs = f"array_position(zip_with(slice(__chosen, 1, {shorter}), slice(__rejected, 1, {shorter}), (a, b) -> a <=> b), false)"
    rows = rows.withColumn("__common", F.expr(f"CAST(CASE WHEN {differs} = 0 THEN {shorter} ELSE {differs} - 1 END AS INT)"))
    rows = rows.select(
        *others,
        "__common",
        F.expr("slice(__chosen, 1, __common)").alias("__prompt"),
        *[F.expr(f"slice(__{c}, __common + 1, size(__{c}))").alias(f"__{c}") for c in ("chosen", "rejected")],
    ).withColumn("__text", _rendered("__prompt"))
    return rows.select(
        *others,
        F.col("__common").cast("long").alias("n_prompt_turns"),
        F.col("__text").alias("prompt"),
        _rendered("__chosen").alias("chosen"),
        _rendered("__rejected").alias("rejected"),
        _mask("__chosen", "length(__text)").alias("chosen_mask"),
        _mask("__rejected", "length(__text)").alias("rejected_mask"),
    )


ECHO_SQL = """
WITH numbered AS (
  SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos
  FROM (SELECT DISTINCT conv_id, turn, coalesce(role, 'user') AS role, coalesce(text, '') AS text
        FROM conversations WHERE conv_id IS NOT NULL)
), placed AS (
  SELECT *, max(CASE WHEN role = 'assistant' THEN pos END) OVER (PARTITION BY conv_id) AS last,
         lag(text, 1, '') OVER (PARTITION BY conv_id ORDER BY pos) AS before
  FROM numbered
), turns AS (
  SELECT *, '<|' || role || '|>' || chr(10) || replace(text, '<|', '< |') || '<|end|>' || chr(10) AS said,
         '<|' || role || '|>' || chr(10) || replace(before, '<|', '< |') || '<|end|>' || chr(10) AS echoed,
         last IS NULL OR pos < last OR (pos = last AND text = before) AS common
  FROM placed WHERE last IS NULL OR pos <= last
), grouped AS (
  SELECT conv_id, count(*) FILTER (WHERE common) AS n_prompt_turns,
         coalesce(string_agg(said, '' ORDER BY pos) FILTER (WHERE common), '') AS prompt,
         coalesce(max(said) FILTER (WHERE NOT common), '') AS chosen,
         coalesce(max(echoed) FILTER (WHERE NOT common), '') AS rejected
  FROM turns GROUP BY conv_id
)
SELECT conv_id, n_prompt_turns, prompt, chosen, rejected,
       CASE WHEN chosen = '' THEN '' ELSE (length(prompt) + 14) || ':' || (length(prompt) + length(chosen)) END AS chosen_mask,
       CASE WHEN rejected = '' THEN '' ELSE (length(prompt) + 14) || ':' || (length(prompt) + length(rejected)) END AS rejected_mask
FROM grouped
"""
