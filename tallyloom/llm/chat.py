"""Chat formatting: every assistant turn is an example of its own.

An example is a prefix and a target: all turns before an assistant turn are its
context, and only that reply is trained on.  The prefixes of a conversation
nest, so its rendered turns are stored once, as a stream with offsets; an
example holds its target's text and points at its context, [context_start,
context_end) of the stream, with a digest of it.  ``contexts`` reads every
example's context through these.  That keeps the output linear in the input
where a conversation has millions of turns; ``with_texts`` spells the examples
out.

Only DataFrame functions are used.

A turn is rendered as ``### role: text</turn>`` and a line feed.  Inside roles
and texts ``\\``, ``<`` and ``#`` are written as ``\\b``, ``\\l`` and ``\\h``, so
no marker can stand in them, and the other way round nothing is lost.  Inside
roles ``:`` is written as ``\\c``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Work

HEAD, COLON, END = "### ", ": ", "</turn>\n"
#: What is escaped, and how.
ESCAPES = (("\\", "\\b"), ("<", "\\l"), ("#", "\\h"))
#: Turns of one conversation whose offsets are summed up together.
STRETCH = 512


def escape(text: Column) -> Column:
    for raw, safe in ESCAPES:  # the backslash first
        text = F.replace(text, F.lit(raw), F.lit(safe))
    return text


def unescape(text: Column) -> Column:
    text = F.replace(text, F.lit("\\c"), F.lit(":"))
    for raw, safe in reversed(ESCAPES):  # the backslash last; it begins every escape
        text = F.replace(text, F.lit(safe), F.lit(raw))
    return text


def line_hash(text: Column, stretch: Column, place: Column) -> Column:
    """Of a line, or its begin, at its place in a conversation; a context's digest is all its lines' by exclusive or."""
    return F.xxhash64(text, stretch, place)


def render(turns: DataFrame) -> DataFrame:
    """The streams: conv_id, stretch, place, rendered, trained, start, loss_start, loss_end, context_hash.

    turns: conv_id, turn, role, text in any order.  Turns stand in the order of
    turn, null first; rows that share a turn by role and text, repeated rows
    side by side.  Null roles and texts are empty.  Rows with a null conv_id
    make one conversation.  Offsets are code points from the stream's begin;
    loss_start, loss_end and context_hash, the digest of all text before
    loss_start, are null but for assistant turns.  Other columns are not looked
    at.  An empty table gives none.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    head, body = F.concat(F.lit(HEAD), F.replace(escape(role), F.lit(":"), F.lit("\\c")), F.lit(COLON)), escape(text)
    rows = turns.select(
        "conv_id",
        "turn",
        role.alias("role"),
        text.alias("text"),
        F.floor(F.col("turn") / STRETCH).alias("stretch"),
        F.concat(head, body, F.lit(END)).alias("rendered"),
        head.alias("head"),
        F.char_length(head).cast("long").alias("head_chars"),
        F.char_length(body).cast("long").alias("body_chars"),
    ).withColumn("chars", F.col("head_chars") + F.col("body_chars") + len(END))
    # sums in two levels: of stretches, and inside each
    inside = Window.partitionBy("conv_id", "stretch").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    before = Window.partitionBy("conv_id").orderBy(F.col("stretch").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("place", F.row_number().over(inside)).withColumn("hash", line_hash(F.col("rendered"), F.col("stretch"), F.col("place")))
    sums = rows.groupBy("conv_id", "stretch").agg(F.sum("chars").alias("chars"), F.bit_xor("hash").alias("hash"))
    bases = sums.select("conv_id", "stretch", F.coalesce(F.sum("chars").over(before), F.lit(0)).alias("base"), F.coalesce(F.bit_xor("hash").over(before), F.lit(0)).alias("base_hash"))
    so_far = inside.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({"to": F.sum("chars").over(so_far), "hash_to": F.bit_xor("hash").over(so_far)})
    a, b = rows.alias("a"), bases.alias("b")
    rows = a.join(b, F.col("a.conv_id").eqNullSafe(F.col("b.conv_id")) & F.col("a.stretch").eqNullSafe(F.col("b.stretch"))).select("a.*", "b.base", "b.base_hash")
    start = F.col("base") + F.col("to") - F.col("chars")
    trained = F.col("role") == "assistant"
    loss = start + F.col("head_chars")
    seen = F.col("base_hash").bitwiseXOR(F.col("hash_to")).bitwiseXOR(F.col("hash")).bitwiseXOR(line_hash(F.col("head"), F.col("stretch"), F.col("place")))
    return rows.select("conv_id", "stretch", "place", "rendered", trained.alias("trained"), start.alias("start"), F.when(trained, loss).alias("loss_start"), F.when(trained, loss + F.col("body_chars")).alias("loss_end"), F.when(trained, seen).alias("context_hash"))


def examples(streams: DataFrame) -> DataFrame:
    """One row for each assistant turn: conv_id, stretch, context_start, context_end, context_hash, loss_start, loss_end, target.

    The context is the conversation's stream from context_start up to
    context_end, all preceding turns and the turn's own head; target is the
    reply in the markup, the only text that is trained on.
    """
    target = F.substring(F.col("rendered"), (F.col("loss_start") - F.col("start") + 1).cast("int"), (F.col("loss_end") - F.col("loss_start")).cast("int"))
    return streams.filter("trained").select("conv_id", "stretch", F.lit(0).cast("long").alias("context_start"), F.col("loss_start").alias("context_end"), "context_hash", "loss_start", "loss_end", target.alias("target"))


def contexts(streams: DataFrame, examples: DataFrame) -> DataFrame:
    """The examples with ``read_chars`` and ``read_hash`` of their contexts, as read from the streams' text alone.

    A context is the whole lines before context_end and the begin of the line
    in which it lies.  Contexts nest, so each line is read once, and summed up
    in two levels.
    """
    text = F.col("rendered")
    chars, whole = F.char_length(text).cast("long"), line_hash(text, F.col("stretch"), F.col("place"))
    lines = streams.select("conv_id", "stretch", F.col("start").alias("at"), F.struct(text.alias("text"), F.col("start").alias("start"), F.col("place").alias("place"), chars.alias("chars"), whole.alias("hash")).alias("line"), F.lit(None).cast(examples.schema).alias("example"))
    # an example stands behind the line in which its context ends
    asked = examples.select("conv_id", "stretch", F.col("context_end").alias("at"), F.lit(None).cast(lines.schema["line"].dataType).alias("line"), F.struct("*").alias("example"))
    sums = lines.groupBy("conv_id", "stretch").agg(F.sum("line.chars").alias("chars"), F.bit_xor("line.hash").alias("hash"))
    before = Window.partitionBy("conv_id").orderBy(F.col("stretch").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("conv_id", "stretch", F.coalesce(F.sum("chars").over(before), F.lit(0)).alias("base"), F.coalesce(F.bit_xor("hash").over(before), F.lit(0)).alias("base_hash"))
    so_far = Window.partitionBy("conv_id", "stretch").orderBy("at", F.col("example").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    rows = lines.union(asked).withColumns({"last": F.last("line", ignorenulls=True).over(so_far), "chars": F.sum("line.chars").over(so_far), "hash": F.bit_xor("line.hash").over(so_far)})
    a, b = rows.filter("example IS NOT NULL").alias("a"), bases.alias("b")
    rows = a.join(b, F.col("a.conv_id").eqNullSafe(F.col("b.conv_id")) & F.col("a.stretch").eqNullSafe(F.col("b.stretch"))).select("a.*", "b.base", "b.base_hash")
    begin = F.substring(F.col("last.text"), F.lit(1), (F.col("at") - F.col("last.start")).cast("int"))
    read_hash = F.col("base_hash").bitwiseXOR(F.col("hash")).bitwiseXOR(F.col("last.hash")).bitwiseXOR(line_hash(begin, F.col("stretch"), F.col("last.place")))
    return rows.select("example.*", (F.col("base") + F.col("chars") - F.col("last.chars") + F.char_length(begin)).alias("read_chars"), read_hash.alias("read_hash"))


def with_texts(streams: DataFrame) -> DataFrame:
    """The examples as context and target texts, in the markup.

    A conversation's texts add up to the square of its length; this is for
    conversations that fit a model's window.
    """
    so_far = Window.partitionBy("conv_id").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    cut = F.col("loss_start") - F.col("start")
    context = F.concat(F.array_join(F.collect_list("rendered").over(so_far), ""), F.substring(F.col("rendered"), F.lit(1), cut.cast("int")))
    target = F.substring(F.col("rendered"), (cut + 1).cast("int"), (F.col("loss_end") - F.col("loss_start")).cast("int"))
    return streams.withColumns({"context": context, "target": target}).filter("trained").select("conv_id", "loss_start", "context", "target")


def digests(streams: DataFrame, examples: DataFrame) -> DataFrame:
    """Read back, per conversation: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_examples.

    Roles and texts are taken from the streams' markup alone, the loss from the
    examples' targets.  Every example's context is read, too; one that isn't
    what the example was made with is an error.  A digest is over a whole conversation and so needs it in
    one place; rows meet there as stretches.
    """
    line = F.col("rendered")
    inner = F.substring(line, F.lit(len(HEAD) + 1), F.char_length(line) - len(HEAD) - len(END))
    role = F.substring_index(inner, COLON, 1)
    body = F.substring(inner, F.char_length(role) + len(COLON) + 1, F.char_length(inner))
    read = streams.select("conv_id", "stretch", F.col("start").alias("at"), F.char_length(line).cast("long").alias("chars"), F.concat(unescape(role), F.lit("\n"), unescape(body), F.lit("\n")).alias("said"))
    sound = (F.col("context_start") == 0) & (F.col("context_end") == F.col("loss_start")) & (F.col("read_chars") == F.col("context_end")) & (F.col("read_hash") == F.col("context_hash"))
    target = F.when(sound, F.col("target")).otherwise(F.raise_error(F.concat(F.lit("the context of an example isn't in the stream: conversation "), F.coalesce(F.col("conv_id").cast("string"), F.lit("null")), F.lit(", context up to "), "context_end")))
    targets = contexts(streams, examples).select("conv_id", "stretch", F.col("loss_start").alias("at"), F.lit(0).cast("long").alias("chars"), unescape(target).alias("said"))

    def whole(rows: DataFrame, n: str, chars: str, text: str) -> DataFrame:
        joined = F.array_join(F.transform(F.array_sort("parts"), lambda x: x["said"]), "")
        part = F.collect_list(F.struct("at", "said")).alias("parts")
        rows = rows.groupBy("conv_id", "stretch").agg(part, F.min("at").alias("at"), F.count("*").alias("n"), F.sum("chars").alias("chars")).withColumn("said", joined)
        return rows.groupBy("conv_id").agg(part, F.sum("n").alias(n), F.sum("chars").alias(chars)).select("conv_id", n, chars, joined.alias(text))

    a, b = whole(read, "n_turns", "formatted_chars", "turn_text").alias("a"), whole(targets, "n_examples", "_none", "loss_text").alias("b")
    loss = F.coalesce("loss_text", F.lit(""))
    return a.join(b, F.col("a.conv_id").eqNullSafe(F.col("b.conv_id")), "left").select(
        "a.conv_id", "n_turns", F.sha2("turn_text", 256).alias("turns_sha256"), F.char_length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars", F.coalesce("n_examples", F.lit(0).cast("long")).alias("n_examples")
    )


def format_conversations(spark: SparkSession, turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The streams and the examples, written; see render and examples."""
    work = Work(spark, "chat")
    streams = work.save(render(turns), "streams")
    return streams, work.save(examples(streams), "examples")
