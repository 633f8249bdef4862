"""Chat formatting by multi-party perspective rotation.

For every participant of a conversation the whole dialogue is rendered once more
with that speaker as the assistant and the others as named users; the mask spans
the text of the assistant's turns, on which a model would be trained.  System
turns stay system turns and are nobody's perspective.

A rendered dialogue is a sequence of segments, one for each turn, at character
offsets that are found without touching the texts again: the perspectives of a
conversation differ only in the heads of one speaker's turns.  A turn's offset is
thus the conversation's running sum plus, for each earlier turn of the
perspective's speaker, the difference between the two heads.  Sums run in two
levels, inside runs of turns and over the runs, so a conversation that holds a
third of all turns is spread over tasks, and each text is shuffled once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table

#: Turns in one run of the two-level running sums.
RUN = 256
#: Characters after which a rendered dialogue goes on in another row, at a turn.
PART = 1 << 20
#: What opens a head; in a text a backslash comes in between, so that no text can pass for one.
OPEN = "<|"
#: The conversation, its null flag (null ids form a conversation of their own) and the run.
KEYS = ["_c", "_n", "run"]


def escaped(text: Column) -> Column:
    """The text without marks of heads: ``<|`` becomes ``<\\|``, and ``<\\`` becomes ``<\\\\`` so that nothing is lost."""
    return F.replace(F.replace(text, F.lit("<\\"), F.lit("<\\\\")), F.lit(OPEN), F.lit("<\\|"))


def unescaped(text: Column) -> Column:
    """The text that ``escaped`` was given."""
    return F.regexp_replace(text, F.lit(r"(?s)<\\(.)"), F.lit("<$1"))


def speakers(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, speaker, body) of ``turns``: a blank speaker is ``unknown``, marks of heads in texts are escaped."""
    speaker = F.coalesce(F.nullif(F.trim(F.col("role")), F.lit("")), F.lit("unknown"))
    return turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        escaped(speaker).alias("speaker"), escaped(F.coalesce("text", F.lit(""))).alias("body"),
    )


def role_of(speaker: Column, perspective: Column) -> Column:
    return F.when(speaker == "system", "system").when(speaker == perspective, "assistant").otherwise(F.concat(F.lit("user:"), speaker))


def rotate_perspectives(turns: DataFrame) -> DataFrame:
    """(conv_id, perspective, turn, seq, role, segment, mask, char_start, char_end, mask_start, mask_end).

    ``turns`` has conv_id, turn, role (the speaker) and text.  Turns of the same
    number are ordered by speaker, then text; repeated rows stay repeated.  A
    null or blank speaker is called ``unknown``, a null text is empty, and null
    conversations and turn numbers form a conversation and a first turn of their
    own.  Texts of any length are one segment.  Conversations of system turns
    alone have no perspective and no rows, nor has an empty table; other columns
    are ignored.  Where the mask is false, ``mask_start`` and ``mask_end`` are
    both ``char_end``: an empty span.
    """
    plain = F.when(F.col("speaker") == "system", 6).otherwise(5 + F.length("speaker"))
    base = speakers(turns).select(
        "*", F.coalesce("conv_id", F.lit(0)).alias("_c"), F.col("conv_id").isNull().alias("_n"), F.floor(F.coalesce("turn", F.lit(-1)) / RUN).alias("run"),
        (plain + F.length("body") + 6).cast("long").alias("size"),
    )
    # Turns that tie in all of the order are equal, so their places do not matter.
    inside = Window.partitionBy(*KEYS).orderBy("turn", "speaker", "body")
    placed = base.withColumn("_seq", (F.row_number().over(inside) - 1).cast("long")).withColumn(
        "_at", F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )
    before = Window.partitionBy("_c", "_n").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = base.groupBy(*KEYS).agg(F.count("*").alias("_k"), F.sum("size").alias("_total"))
    runs = runs.select(*KEYS, F.coalesce(F.sum("_k").over(before), F.lit(0)).alias("_seq0"), F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_at0"))

    # For each perspective and run: its speaker's turns in the runs before, and where they are in this one.
    spoken = placed.where("speaker <> 'system'").groupBy(*KEYS, F.col("speaker").alias("perspective")).agg(F.sort_array(F.collect_list("_seq")).alias("own"))
    people = spoken.select("_c", "_n", "perspective").distinct()
    each = people.join(runs, ["_c", "_n"]).join(spoken, [*KEYS, "perspective"], "left")
    earlier = Window.partitionBy("_c", "_n", "perspective").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    each = each.withColumn("own", F.coalesce("own", F.array().cast("array<bigint>")))
    each = each.withColumn("_own0", F.coalesce(F.sum(F.size("own")).over(earlier), F.lit(0)))

    out = placed.join(each, KEYS)
    role = role_of(F.col("speaker"), F.col("perspective"))
    own = F.col("_own0") + F.size(F.filter("own", lambda x: x < F.col("_seq")))
    out = out.select(
        "conv_id", "perspective", "turn", (F.col("_seq0") + F.col("_seq")).alias("seq"), role.alias("role"),
        F.concat(F.lit(OPEN), role, F.lit("|>\n"), F.col("body"), F.lit("\n")).alias("segment"), (role == "assistant").alias("mask"),
        (F.col("_at0") + F.col("_at") + own * (4 - F.length("perspective"))).alias("char_start"),
    )
    end = F.col("char_start") + F.length("segment")
    return out.select(
        "*", end.alias("char_end"), F.when(F.col("mask"), F.col("char_start") + 14).otherwise(end).alias("mask_start"), F.when(F.col("mask"), end - 1).otherwise(end).alias("mask_end"),
    )


def dialogues(turns: DataFrame, part: int = PART) -> DataFrame:
    """(conv_id, perspective, part, turns, char_start, text, masks): the rendered dialogues.

    A dialogue is one row, or one for every ``part`` characters, cut between
    turns, so that no row grows with a conversation.  ``masks`` lists the spans
    to train on as ``start-end`` in the whole dialogue, joined by commas.
    """
    cut = rotate_perspectives(turns).withColumn("part", F.floor(F.col("char_start") / part))
    span = F.when(F.col("mask"), F.concat("mask_start", F.lit("-"), "mask_end"))
    listed = F.sort_array(F.collect_list(F.struct("seq", "segment", span.alias("span"))))
    out = cut.groupBy("conv_id", "perspective", "part").agg(F.count("*").alias("turns"), F.min("char_start").alias("char_start"), listed.alias("_l"))
    return out.select(
        "conv_id", "perspective", "part", "turns", "char_start", F.array_join(F.transform("_l", lambda x: x["segment"]), "").alias("text"),
        F.array_join(F.transform("_l", lambda x: x["span"]), ",").alias("masks"),
    )


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dialogues(table(spark, sf_dir, "conversations"))


ORACLE = """
with base as (
  select conv_id, turn, replace(replace(coalesce(nullif(trim(role), ''), 'unknown'), '<' || chr(92), '<' || chr(92) || chr(92)), '<|', '<' || chr(92) || '|') as speaker,
    replace(replace(coalesce(text, ''), '<' || chr(92), '<' || chr(92) || chr(92)), '<|', '<' || chr(92) || '|') as body from conversations
), people as (select distinct conv_id, speaker as perspective from base where speaker <> 'system'),
each as (
  select b.conv_id, p.perspective, b.turn, b.speaker, b.body,
    case when b.speaker = 'system' then 'system' when b.speaker = p.perspective then 'assistant' else 'user:' || b.speaker end as role
  from base b join people p on b.conv_id is not distinct from p.conv_id
), seg as (select *, '<|' || role || '|>' || chr(10) || body || chr(10) as segment from each),
at_ as (select *, row_number() over w as seq, coalesce(sum(length(segment)) over (w rows between unbounded preceding and 1 preceding), 0)::bigint as start from seg window w as (partition by conv_id, perspective order by turn nulls first, speaker, body))
select conv_id, perspective, (start // 1048576)::bigint as part, count(*)::bigint as turns, min(start) as char_start, string_agg(segment, '' order by seq) as text,
  coalesce(string_agg((start + 14) || '-' || (start + length(segment) - 1), ',' order by seq) filter (where role = 'assistant'), '') as masks
from at_ group by conv_id, perspective, start // 1048576
"""
