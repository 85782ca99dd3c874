"""Chat formatting into budgeted windows, in DataFrame functions only (operator 2).

Template: ``<s>[`` role ``]\\n`` text ``</s>\\n`` per turn. Inside roles and texts a backslash
follows each of ``<``, ``[``, ``]`` and ``\\``, so no control string (they start with ``<`` or
``[``) can occur there, and dropping that backslash gives the text back.

Prefix sums of turn tokens give each turn the span it starts in; spans are turn-aligned. A
window holds the conversation's system turn, as many of the last turns of the window before it
as the history budget allows (none of earlier windows, even where that one is short), and its
span. Only assistant turns of the span are targets: the loss
mask lists their texts as (start, length) in code points; repeated turns are not in it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

OPEN, CLOSE = "<s>[", "</s>\n"
HEADER_END = "]\n"
#: Turn numbers that share a chunk in the two-level prefix sums of one conversation.
CHUNK_TURNS = 256


@dataclass(frozen=True)
class Budget:
    """Tokens of a window, and of the history repeated in it. A turn counts a token per started
    four code points of its formatted text (an estimate that needs no vocabulary)."""

    window: int = 2048
    history: int = 256


def escape(c: Column) -> Column:
    return F.regexp_replace(c, r"([<\[\]\\])", r"$1\\")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"([<\[\]\\])\\", "$1")


def _turns(conversations: DataFrame) -> DataFrame:
    """One row per turn: conv_id, turn, role, key of the row (k1, k2), its formatted piece with its
    length, the place of its text in it, tokens, and the chunk of turn numbers."""
    plain_role, plain_text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    role, text = escape(plain_role), escape(plain_text)
    head = F.concat(F.lit(OPEN), role, F.lit(HEADER_END))
    key = [F.col("conv_id").isNull(), F.col("conv_id"), F.col("turn").isNull(), F.col("turn"), plain_role, plain_text]
    rows = conversations.select(
        "conv_id",
        "turn",
        plain_role.alias("role"),
        F.xxhash64(*key).alias("k1"),
        F.xxhash64(F.lit(1), *key).alias("k2"),
        F.length(head).alias("head"),
        F.length(text).cast("long").alias("body"),
        F.concat(head, text, F.lit(CLOSE)).alias("piece"),
    )
    return rows.select(
        "*",
        F.length("piece").cast("long").alias("chars"),
        F.expr("(length(piece) + 3) div 4").alias("tokens"),
        F.coalesce(F.expr(f"turn div {CHUNK_TURNS}"), F.lit(-1)).alias("chunk"),
    )


def windows(conversations: DataFrame, budget: Budget = Budget()) -> DataFrame:
    """conv_id, window (from 0), text, turns, repeats (leading turns that repeat), loss (start, length).

    Turns go by turn number (null first), then role, then a hash of the text, so ties have one
    order, and repeated rows are turns of their own; null roles and texts are empty; rows of a
    null conv_id are one conversation. Windows are planned on lengths alone; a text moves when
    its turns' windows are known, and again into its window. A window
    holds at most ``budget.window`` tokens unless its system turn or one turn is longer than half of what
    the budget leaves: such a turn has a window of its own, uncut. The system turn is the
    conversation's first one if its role is ``system``. Other columns are ignored.
    """
    turns = _turns(conversations)
    texts = turns.groupBy("k1", "k2").agg(F.first("piece").alias("piece"))  # repeated rows have one piece
    rows = turns.drop("piece")
    in_chunk = Window.partitionBy("conv_id", "chunk").orderBy("turn", "role", "k1", "k2")
    chunks = Window.partitionBy("conv_id").orderBy("chunk")
    ahead = Window.unboundedPreceding, -1
    first = F.min(F.struct("turn", "role", "k1", "k2", "chars", "tokens")).alias("first")
    is_system = F.col("lead.role") == "system"
    sums = (
        rows.groupBy("conv_id", "chunk")
        .agg(F.sum("tokens").alias("c_tokens"), F.count("*").alias("c_turns"), first)
        .withColumn("tokens_ahead", F.coalesce(F.sum("c_tokens").over(chunks.rowsBetween(*ahead)), F.lit(0)))
        .withColumn("turns_ahead", F.coalesce(F.sum("c_turns").over(chunks.rowsBetween(*ahead)), F.lit(0)))
        .withColumn("lead", F.first("first").over(chunks))
        .select(
            F.col("conv_id").alias("s_conv"), F.col("chunk").alias("s_chunk"), "tokens_ahead", "turns_ahead",
            F.when(is_system, F.col("lead")).alias("system"),
        )
    )
    room = F.lit(budget.window - budget.history) - F.coalesce("system.tokens", F.lit(0))
    placed = (
        rows.withColumn("own_ahead", F.coalesce(F.sum("tokens").over(in_chunk.rowsBetween(*ahead)), F.lit(0)))
        .withColumn("own_place", F.row_number().over(in_chunk) - 1)
        .join(sums, F.col("conv_id").eqNullSafe(F.col("s_conv")) & (F.col("chunk") == F.col("s_chunk")))
        .withColumn("ahead", F.col("own_ahead") + F.col("tokens_ahead"))
        .withColumn("place", F.col("own_place") + F.col("turns_ahead"))
        .withColumn("span_tokens", F.greatest(F.lit(1), F.floor(room / 2)))
        .withColumn("span", F.expr("ahead div span_tokens"))
        .withColumn("long", F.expr("tokens > span_tokens"))
        .drop("own_ahead", "own_place", "s_conv", "s_chunk", "tokens_ahead", "turns_ahead", "turn", "chunk", "span_tokens")
    )
    # the turns of a span share a window, but for a long turn, which starts its own
    by_span = Window.partitionBy("conv_id", "span").orderBy("place")
    spans = placed.withColumn("part", F.sum(F.col("long").cast("int")).over(by_span))
    whole = Window.partitionBy("conv_id", "span", "part")
    spans = spans.withColumn("span_end", F.max(F.col("ahead") + F.col("tokens")).over(whole)).withColumn("span_first", F.min("place").over(whole))
    by_start = Window.partitionBy("conv_id").orderBy("span_first")
    starts = (
        spans.groupBy("conv_id", "span_first")
        .agg(F.first("system").alias("w_system"))
        .withColumn("window", F.row_number().over(by_start) - 1)
        .withColumn("next_first", F.lead("span_first").over(by_start))
        .select(F.col("conv_id").alias("w_conv"), F.col("span_first").alias("w_first"), "window", "next_first", "w_system")
    )
    joined = spans.join(starts, F.col("conv_id").eqNullSafe(F.col("w_conv")) & (F.col("span_first") == F.col("w_first")))
    near_next = F.col("next_first").isNotNull() & (F.col("span_end") - F.col("ahead") <= budget.history)
    leads = (F.col("place") == 0) & (F.col("role") == "system")
    copies = F.when(near_next & ~leads, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    shown = joined.withColumn("copy", F.explode(copies)).select(
        "conv_id", (F.col("window") + F.col("copy")).alias("window"), "place", "copy", "k1", "k2", "chars",
        F.when((F.col("copy") == 0) & (F.col("role") == "assistant"), F.col("head")).alias("loss_at"),
        F.col("body").alias("loss_length"),
    )
    system = starts.where("w_system is not null and window > 0").select(
        F.col("w_conv").alias("conv_id"), "window", F.lit(-1).cast("long").alias("place"), F.lit(1).alias("copy"),
        "w_system.k1", "w_system.k2", "w_system.chars", F.lit(None).cast("int").alias("loss_at"),
        F.lit(0).cast("long").alias("loss_length"),
    )
    offset = F.sum("chars").over(Window.partitionBy("conv_id", "window").orderBy("place").rowsBetween(*ahead))
    shown = shown.unionByName(system).withColumn("loss_start", F.coalesce(offset, F.lit(0)) + F.col("loss_at"))
    shown = shown.join(texts, ["k1", "k2"])
    items = F.array_sort(F.collect_list(F.struct("place", "copy", "piece", "loss_start", "loss_length")))
    packed = shown.groupBy("conv_id", "window").agg(items.alias("items"))
    return packed.select(
        "conv_id",
        "window",
        F.concat_ws("", F.col("items.piece")).alias("text"),
        F.size("items").alias("turns"),
        F.size(F.filter("items", lambda x: x["copy"] == 1)).alias("repeats"),
        F.transform(
            F.filter("items", lambda x: x["loss_start"].isNotNull()),
            lambda x: F.struct(x["loss_start"].alias("start"), x["loss_length"].alias("length")),
        ).alias("loss"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, from the windows alone."""
    pieces = F.expr(f"slice(split(text, '{CLOSE.strip()}\\n'), repeats + 1, turns - repeats)")
    turns = F.transform(
        pieces,
        lambda p: F.concat(
            unescape(F.regexp_extract(p, r"(?s)^<s>\[(.*?)\]\n", 1)),
            F.lit("\n"),
            unescape(F.regexp_replace(p, r"(?s)^<s>\[.*?\]\n", "")),
            F.lit("\n"),
        ),
    )
    masked = F.transform("loss", lambda m: unescape(F.substring(F.col("text"), (m["start"] + 1).cast("int"), m["length"].cast("int"))))
    read = formatted.select(
        "conv_id",
        "window",
        (F.col("turns") - F.col("repeats")).alias("n"),
        F.concat_ws("", turns).alias("own"),
        F.concat_ws("", masked).alias("target"),
        F.length("text").cast("long").alias("chars"),
    )
    whole = read.groupBy("conv_id").agg(
        F.sum("n").cast("long").alias("n_turns"),
        F.array_sort(F.collect_list(F.struct("window", "own", "target"))).alias("parts"),
        F.sum("chars").alias("formatted_chars"),
    )
    loss = F.concat_ws("", F.col("parts.target"))
    return whole.select(
        "conv_id",
        "n_turns",
        F.sha2(F.concat_ws("", F.col("parts.own")), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        "formatted_chars",
    )


CONTROLS = "</s>[INST] ok [/INST]"


def chat_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONTROLS).alias("text"),
    )
    return read_back(windows(conversations.unionByName(extra)))


_MARKS = len(OPEN + HEADER_END + CLOSE)
_B = Budget()

SQL = f"""
with turns as (
    select conv_id, turn, role, coalesce(text, '') as text from conversations
    union all select -1, unnest([0, 1]), unnest(['user', 'assistant']), '{CONTROLS}'
), sized as (
    select *, row_number() over (partition by conv_id order by turn) as place,
           {_MARKS} + len(role) + len(text) + len(regexp_replace(role || text, '[^<\\[\\]\\\\]', '', 'g')) as chars
    from turns
), counted as (
    select *, (chars + 3) // 4 as tokens, coalesce(sum((chars + 3) // 4) over before, 0) as ahead,
           first(if(role = 'system', chars, 0)) over whole as system_chars
    from sized
    window whole as (partition by conv_id order by place rows between unbounded preceding and unbounded following),
           before as (partition by conv_id order by place rows between unbounded preceding and 1 preceding)
), spanned as (
    select *, greatest(1, ({_B.window} - {_B.history} - (system_chars + 3) // 4) // 2) as span_tokens,
           ahead // span_tokens as span, tokens > span_tokens as long
    from counted
), parts as (
    select *, sum(long::int) over (partition by conv_id, span order by place) as part from spanned
), placed as (
    select *, max(ahead + tokens) over (partition by conv_id, span, part) as span_end,
           max(ahead + tokens) over (partition by conv_id) as conv_end
    from parts
)
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by place)) as turns_sha256,
       cast(sum(if(role = 'assistant', len(text), 0)) as bigint) as loss_chars,
       sha256(coalesce(string_agg(text, '' order by place) filter (where role = 'assistant'), '')) as loss_sha256,
       cast(sum(chars) + sum(if(span_end < conv_end and span_end - ahead <= {_B.history} and not (place = 1 and role = 'system'), chars, 0))
            + any_value(system_chars) * (count(distinct [span, part]) - 1) as bigint) as formatted_chars
from placed group by conv_id
"""
