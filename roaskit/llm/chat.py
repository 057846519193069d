"""Chat formatting by event-sourced reconstruction, with DataFrame functions only.

A log holds the events of conversations: (conv_id, turn, seq, kind, role, text).  ``delta`` appends text to
a turn, ``edit`` replaces what the turn holds, ``regenerate`` empties the turn and takes back every event of
later turns that came before it.  Events are folded per turn (so the streamed parts of one long conversation
spread over tasks), a running maximum over the turns applies regenerations, and the final messages render by
a template.  Only the rendered text of a conversation, which is one value, is put together in one place.

Template: ``<|turn|>role<|text|>text<|end|>`` per turn.  Control strings inside roles and texts are escaped
by one backslash after their first character (and one more where backslashes stand there already), so
removing one backslash gives back the source exactly.  ``loss_turns`` marks the turns a model learns from.

Defined cases: a null text or role counts as empty; a null conversation id or turn is a value like any other
(nulls first); rows that repeat a turn number are turns of their own, ordered by role and text; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# --- fixed values: control strings of this template and of common ones, as a pattern in two parts ----------
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
CONTROL = (r"\|turn\|>|\|text\|>|\|end\|>|\|im_start\|>|\|im_end\|>|\|endoftext\|>|\|startoftext\|>"
           r"|/?s>|unk>|/?INST\]|</?SYS>>")
# ------------------------------------------------------------------------------------------------------------
#: Characters of a stored text per streamed event.
DELTA_CHARS = 512
LEARNT_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])(\\*)({CONTROL})", r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])\\(\\*)({CONTROL})", "$1$2$3")


def messages(events: DataFrame) -> DataFrame:
    """Fold events into final messages (conv_id, turn, role, text).

    The role is that of the turn's last event that names one."""
    resets = F.col("kind").isin("edit", "regenerate")
    turns = events.groupBy("conv_id", "turn").agg(
        F.max(F.when(F.col("kind") == "regenerate", F.col("seq"))).alias("regenerated"),
        F.max(F.when(resets, F.col("seq"))).alias("reset"),
        F.max_by("role", F.when(F.col("role").isNotNull(), F.col("seq"))).alias("role"),
        F.sort_array(F.collect_list(F.struct("seq", "kind", F.coalesce("text", F.lit("")).alias("text")))).alias("log"))
    earlier = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    turns = turns.withColumn("taken_back", F.max("regenerated").over(earlier))
    cut = F.greatest(F.coalesce("reset", F.lit(-(1 << 62))), F.coalesce(F.col("taken_back") + 1, F.lit(-(1 << 62))))
    log = F.filter("log", lambda e: e["seq"] >= cut)
    text = F.array_join(F.transform(F.filter(log, lambda e: e["kind"] != "regenerate"), lambda e: e["text"]), "")
    return turns.where(F.size(log) > 0).select("conv_id", "turn", "role", text.alias("text"))


def render(final: DataFrame, learnt_role: str = LEARNT_ROLE) -> DataFrame:
    """One row per conversation: (conv_id, formatted, loss_turns)."""
    role = F.coalesce("role", F.lit(""))
    part = F.concat(F.lit(TURN), escape(role), F.lit(TEXT), escape(F.coalesce("text", F.lit(""))), F.lit(END))
    whole = final.select("conv_id", F.struct("turn", part.alias("part"), (role == learnt_role).alias("learnt")).alias("m"))
    whole = whole.groupBy("conv_id").agg(F.sort_array(F.collect_list("m")).alias("ms"))
    return whole.select("conv_id", F.array_join("ms.part", "").alias("formatted"), F.col("ms.learnt").alias("loss_turns"))


def read_back(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of (role, text), unescaped."""
    parts = F.split(formatted, r"<\|end\|>", -1)
    parts = F.slice(parts, 1, F.size(parts) - 1)
    def turn(part: Column) -> Column:
        halves = F.split(part, r"<\|text\|>", -1)
        return F.struct(unescape(F.substring(halves[0], len(TURN) + 1, 1 << 30)).alias("role"),
                        unescape(halves[1]).alias("text"))
    return F.transform(parts, turn)


def stored_events(rows: DataFrame) -> DataFrame:
    """The log of a table of finished turns (conv_id, turn, role, text): each text streamed in parts.

    Turns are numbered anew by (turn, role, text), so rows that share a number stay apart."""
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    last = F.greatest(F.floor((F.length(text) - 1) / DELTA_CHARS).cast("long"), F.lit(0).cast("long"))
    # numbered before the texts are cut, as a generator in the same select would run first
    told = rows.select("conv_id", "role", text.alias("whole"), place.cast("long").alias("turn"), last.alias("last"))
    told = told.withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), "last")))
    return told.select("conv_id", "turn", "role", (F.col("turn") * (1 << 31) + F.col("k")).alias("seq"), F.lit("delta").alias("kind"),
                       F.substring("whole", (F.col("k") * DELTA_CHARS + 1).cast("int"), F.lit(DELTA_CHARS)).alias("text"))


def format_conversations(rows: DataFrame) -> DataFrame:
    """Rebuild the final messages of a table of turns and render them: (conv_id, formatted, loss_turns)."""
    rows = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                       F.col("role").cast("string").alias("role"), "text")
    return render(messages(stored_events(rows)))


def digests(formatted: DataFrame) -> DataFrame:
    """What a reader of the formatted text finds: turns, their digest, and the text under the loss mask."""
    read = formatted.select("conv_id", "formatted", "loss_turns", read_back(F.col("formatted")).alias("turns"))
    lf = F.lit("\n")
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], lf, t["text"], lf)), "")
    learnt = F.array_join(F.transform(F.filter(F.arrays_zip("turns", "loss_turns"), lambda z: z["loss_turns"]),
                                      lambda z: z["turns"]["text"]), "")
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"),
                       F.length(learnt).cast("long").alias("loss_chars"), F.sha2(learnt, 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))
