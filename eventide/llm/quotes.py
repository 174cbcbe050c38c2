"""Quotation linking: reply-ordered conversations without quotes.

A line's quote level is the number of ``>`` marks before it. Successive lines
of one level form a passage. Passages, and their paragraphs (parted by blank
quoted lines), lines and sentences, are normalised (lower case, runs of anything
but letters and digits become one space) and hashed; so are every message's own
body, paragraphs, lines and sentences. A passage links to the latest earlier
message of its conversation that holds the same hash, whole passages before
paragraphs before lines and sentences, longer ones before shorter ones. A
message answers the latest message linked by its lowest level of quotes;
following the answers up gives its thread. Words out of the middle of a sentence
link to nothing.

Built-in functions only. "Latest earlier" is an as-of join in two steps, inside
spans of ``SPAN`` turns and over the spans' maxima, so a line that a huge
conversation repeats is never one task's work and no pairs are formed; threads
are resolved by pointer doubling over the answering messages.

The result has one row per message: its body without quotes, the turn it
answers, and its thread's first turn; (thread_turn, turn) is the reply order
inside a conversation.

Defined cases: a null text is an empty message; rows with a null conversation
or turn are kept, without links; equal rows count once; several messages of a
turn all keep their rows and a link names their turn; empty passages link to
nothing; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

SPAN = 4096
_MARKS = r"^[ \t]*(?:>[ \t]*)+"
_BLANK = r"\n[ \t]*\n"
# white space after an end mark and its closing quotes; full-width marks need none
_STOP = "(?<=[.!?\u2026][\"')\\]\u201d\u2019]{0,2})\\s+|(?<=[\u3002\uff01\uff1f])"


def _normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def _lines(text: Column) -> Column:
    """array<struct<at, level, line>> of a text."""
    return F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda line, at: F.struct(
        at.alias("at"),
        F.length(F.regexp_replace(F.regexp_extract(line, _MARKS, 0), "[^>]", "")).alias("level"),
        F.regexp_replace(line, _MARKS, "").alias("line")))


def _sentences(texts: Column) -> Column:
    return F.flatten(F.transform(texts, lambda x: F.split(x, _STOP)))


def messages(chat: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Distinct messages with a key, lines, and the body without quotes."""
    rows = chat.select(
        F.col(conv).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"),
        F.col(role).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("raw")).distinct()
    lines = rows.withColumn("key", F.md5(F.concat_ws("\n", "role", "raw"))).withColumn(
        "lines", _lines(F.col("raw"))).drop("raw")
    own = F.filter("lines", lambda x: x["level"] == 0)
    return lines.withColumn("body", F.trim(F.regexp_replace(
        F.array_join(F.transform(own, lambda x: x["line"]), "\n"), r"\n{3,}", "\n\n")))


def _passages(said: DataFrame) -> DataFrame:
    """(conv_id, turn, key, level, run, priority, size, hash): probes of quoted text."""
    quoted = (said.select("conv_id", "turn", "key", F.explode(
        F.filter("lines", lambda x: x["level"] > 0)).alias("q"))
        .select("conv_id", "turn", "key", "q.*"))
    run = F.col("at") - F.row_number().over(
        Window.partitionBy("conv_id", "turn", "key", "level").orderBy("at"))
    whole = (quoted.withColumn("run", run).groupBy("conv_id", "turn", "key", "level", "run")
             .agg(F.sort_array(F.collect_list(F.struct("at", "line"))).alias("part")))
    lines = F.transform("part", lambda x: x["line"])
    run_text = F.array_join(lines, "\n")
    paragraphs = F.split(run_text, _BLANK)
    small = F.concat(lines, _sentences(paragraphs), _sentences(lines))
    probes = F.concat(*(
        F.transform(F.array_distinct(F.transform(units, _normal)), lambda x, rank=rank: F.struct(
            F.lit(rank).alias("priority"), x.alias("text")))
        for rank, units in enumerate((F.array(run_text), paragraphs, small))))
    return (whole.select("conv_id", "turn", "key", "level", "run", F.explode(probes).alias("p"))
            .where(F.length("p.text") > 0)
            .select("conv_id", "turn", "key", "level", "run", "p.priority",
                    F.length("p.text").alias("size"), F.md5("p.text").alias("hash")))


def _sources(said: DataFrame) -> DataFrame:
    """(conv_id, hash, turn) of what messages say themselves."""
    paragraphs, lines = F.split("body", _BLANK), F.split("body", "\n")
    units = F.concat(F.array("body"), paragraphs, lines, _sentences(paragraphs), _sentences(lines))
    return (said.select("conv_id", "turn", F.explode(F.array_distinct(
        F.transform(units, _normal))).alias("text"))
        .where(F.length("text") > 0)
        .select("conv_id", F.md5("text").alias("hash"), "turn").distinct())


def _links(said: DataFrame) -> DataFrame:
    """(conv_id, turn, key, answers): the turn that a message answers."""
    probes = written(_passages(said), "probes")
    asked = probes.select("conv_id", "hash").distinct()
    sources = _sources(said).join(asked, ["conv_id", "hash"], "left_semi")
    span = F.floor(F.col("turn") / SPAN).alias("span")
    wanted = probes.select("conv_id", "hash", "turn").distinct()
    both = (sources.select("conv_id", "hash", "turn", F.col("turn").alias("said"))
            .unionByName(wanted.select("conv_id", "hash", "turn",
                                       F.lit(None).cast("long").alias("said")))
            .groupBy("conv_id", "hash", "turn", span).agg(F.max("said").alias("said")))
    near = Window.partitionBy("conv_id", "hash", "span").orderBy("turn").rowsBetween(
        Window.unboundedPreceding, -1)
    far = Window.partitionBy("conv_id", "hash").orderBy("span").rowsBetween(
        Window.unboundedPreceding, -1)
    spans = (both.groupBy("conv_id", "hash", "span").agg(F.max("said").alias("said"))
             .withColumn("earlier", F.max("said").over(far)).drop("said"))
    found = (both.withColumn("near", F.max("said").over(near))
             .join(spans, ["conv_id", "hash", "span"])
             .select("conv_id", "hash", "turn", F.coalesce("near", "earlier").alias("source"))
             .where(F.col("source").isNotNull()))
    best = (probes.join(found, ["conv_id", "hash", "turn"])
            .groupBy("conv_id", "turn", "key", "level", "run")
            .agg(F.min(F.struct("priority", (-F.col("size")).alias("size"),
                                (-F.col("source")).alias("source"))).alias("b")))
    return (best.groupBy("conv_id", "turn", "key", "level")
            .agg(F.max(-F.col("b.source")).alias("source"))
            .groupBy("conv_id", "turn", "key")
            .agg(F.min(F.struct("level", "source"))["source"].alias("answers")))


def _roots(links: DataFrame) -> DataFrame:
    """(conv_id, turn, thread_turn) of answering turns, by pointer doubling."""
    at = written(links.groupBy("conv_id", "turn").agg(F.max("answers").alias("up")), "answers")
    while True:
        up = at.select("conv_id", F.col("turn").alias("up"), F.col("up").alias("further"))
        step = written(at.join(up, ["conv_id", "up"], "left").select(
            "conv_id", "turn", F.coalesce("further", "up").alias("up"),
            F.col("further").isNotNull().alias("moved")), "answers")
        at = step.select("conv_id", "turn", "up")
        if step.where("moved").isEmpty():
            return at.withColumnRenamed("up", "thread_turn")


def reply_ordered(chat: DataFrame, conv: str = "conv_id", turn: str = "turn",
                  role: str = "role", text: str = "text") -> DataFrame:
    """One row per message: conv_id, turn, role, body, quoted_lines, quote_levels,
    answers, thread_turn."""
    said = written(messages(chat, conv, turn, role, text), "messages")
    links = written(_links(said), "links")
    roots = _roots(links)
    return (said.join(links, ["conv_id", "turn", "key"], "left")
            .join(roots, ["conv_id", "turn"], "left")
            .select("conv_id", "turn", "role", "body",
                    F.size(F.filter("lines", lambda x: x["level"] > 0)).cast("long")
                    .alias("quoted_lines"),
                    F.array_max(F.transform("lines", lambda x: x["level"])).cast("long")
                    .alias("quote_levels"),
                    "answers", F.coalesce("thread_turn", "turn").alias("thread_turn")))
