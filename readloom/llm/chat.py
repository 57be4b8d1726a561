"""Quotation linking of conversations: who answers whom, from what is quoted; column expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readloom.functions.arrays import indices, let
from readloom.operators.ordering import ranked
from readloom.operators.staging import stage

QUOTED = r"^(?:[ \t]*>)+"


def plain(text: Column) -> Column:
    """Lower case, white space as single blanks, none at the ends."""
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def passages(text: Column) -> Column:
    """``array<struct<level, lines>>``: runs of lines at one quote level, in order; level 0 is the message's own."""
    lines = F.transform(
        F.split(text, r"\r\n|\r|\n", -1),
        lambda x: let(
            F.regexp_extract(x, QUOTED, 0),
            lambda mark: F.struct(
                F.length(F.regexp_replace(mark, "[ \t]", "")).alias("level"),
                F.when(mark == "", x).otherwise(F.ltrim(F.substring(x, F.length(mark) + 1, F.length(x)))).alias("line"),
            ),
        ),
    )

    def runs(xs: Column) -> Column:
        first = lambda i: (i == 0) | (xs[i]["level"] != xs[i - 1]["level"])
        return let(
            F.filter(indices(F.size(xs)), first),
            lambda at: F.transform(
                at,
                lambda start, k: F.struct(
                    xs[start]["level"].alias("level"),
                    F.transform(
                        F.slice(xs, start + 1, F.when(k + 1 < F.size(at), F.get(at, k + 1)).otherwise(F.size(xs)) - start),
                        lambda x: x["line"],
                    ).alias("lines"),
                ),
            ),
        )

    return let(lines, runs)


def keys(run: Column) -> Column:
    """Hashes by which a run is found: of the whole run, of each of its paragraphs, of each of its lines; blank ones give none.

    A paragraph ends at a blank line. White space is normalised, so one that a mail client has wrapped anew keeps its hash.
    """
    part = lambda n, passage: F.struct(F.lit(n).alias("part"), plain(passage).alias("passage"))
    paragraphs = F.split(F.array_join(run["lines"], "\n"), r"\n\s*\n", -1)
    parts = F.concat(
        F.array(part(0, F.array_join(run["lines"], " "))),
        F.transform(paragraphs, lambda x: part(1, x)),
        F.transform(run["lines"], lambda x: part(2, x)),
    )
    return F.transform(
        F.filter(parts, lambda p: p["passage"] != ""),
        lambda p: F.struct(p["part"].alias("part"), F.sha2(p["passage"], 256).alias("hash")),
    )


def link(messages: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text, chat, n_quotes, max_level, parent_turn, thread_turn, depth)``, one row per row.

    ``text`` is the message without its quoted lines. A quoted run, one of its paragraphs, or failing that
    one of its lines, is joined by hash to the earliest message of the conversation
    that says it itself and comes before. Of a message's links the one with the
    lowest level wins, then whole runs before paragraphs before lines, then the latest original: its turn is
    ``parent_turn``. Following parents leads to ``thread_turn``, in ``depth`` steps; a
    message without a link is its own thread. Ordered by conv_id, thread_turn, turn
    every reply comes after what it answers. ``chat`` is the text under its role.

    Null texts are empty; rows without conv_id or turn link with nothing; repeated
    rows stay. Other columns are not looked at. Originals are one row per conversation
    and passage before the join, so a line that a third of all messages share costs a
    row per quote.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = messages.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"),
        passages(text).alias("runs"),
    )
    own = F.filter("runs", lambda r: r["level"] == 0)
    quoted = F.filter("runs", lambda r: r["level"] > 0)
    rows = stage(
        rows.select(
            "conv_id",
            "turn",
            "role",
            F.trim(F.array_join(F.flatten(F.transform(own, lambda r: r["lines"])), "\n")).alias("text"),
            F.array_distinct(F.transform(F.flatten(F.transform(own, keys)), lambda k: k["hash"])).alias("said"),
            F.transform(quoted, lambda r: F.struct(r["level"].alias("level"), keys(r).alias("keys"))).alias("quotes"),
        ),
        "messages",
    )
    # The quotes say which passages matter; nothing else of the corpus is shuffled by passage.
    quotes = rows.select("conv_id", "turn", F.explode("quotes").alias("q")).select(
        "conv_id", "turn", F.col("q.level").alias("level"), F.explode("q.keys").alias("k")
    )
    quotes = quotes.select("conv_id", "turn", "level", F.col("k.part").alias("part"), F.col("k.hash").alias("hash"))
    said = rows.select("conv_id", "turn", F.explode("said").alias("hash"))
    wanted = quotes.select("conv_id", "hash").distinct()
    origin = said.join(wanted, ["conv_id", "hash"], "left_semi").groupBy("conv_id", "hash").agg(F.min("turn").alias("origin"))
    best = F.struct(-F.col("level"), -F.col("part"), "origin")
    parents = (
        quotes.join(origin, ["conv_id", "hash"])
        .where("origin < turn")
        .groupBy("conv_id", "turn")
        .agg(F.max_by("origin", best).alias("parent_turn"))
    )
    threads = thread_of(stage(parents, "parents"))
    known = rows.join(threads, ["conv_id", "turn"], "left")
    levels = F.transform("quotes", lambda q: q["level"])
    return known.select(
        "conv_id",
        "turn",
        "role",
        "text",
        F.concat(F.lit("<|"), F.coalesce("role", F.lit("")), F.lit("|>\n"), F.col("text")).alias("chat"),
        F.size("quotes").cast("long").alias("n_quotes"),
        F.coalesce(F.array_max(levels), F.lit(0)).cast("long").alias("max_level"),
        "parent_turn",
        F.coalesce("thread_turn", "turn").alias("thread_turn"),
        F.coalesce("depth", F.lit(0).cast("long")).alias("depth"),
    )


def conversations(linked: DataFrame, size: int = 1000) -> DataFrame:
    """``(conv_id, thread_turn, part, messages, chat)``: the threads of ``link`` in reply order, every message without quotes.

    ``messages`` are ``(position, turn, role, parent_turn, depth, text)`` by turn, so each comes after what it answers;
    ``chat`` is the same under role marks. A thread of over ``size`` messages has several rows, in order of ``part``: no
    task holds more of one, however long it is. Messages without conv_id or turn make threads of their own.
    """
    numbered = ranked(linked, ["turn", "role", "text"], group=["conv_id", "thread_turn"], name="position")
    message = F.struct("position", "turn", "role", "parent_turn", "depth", "text", "chat")
    parts = numbered.groupBy("conv_id", "thread_turn", F.floor((F.col("position") - 1) / size).cast("int").alias("part")).agg(
        F.array_sort(F.collect_list(message)).alias("messages")
    )
    return parts.select(
        "conv_id", "thread_turn", "part", F.transform("messages", lambda m: m.dropFields("chat")).alias("messages"),
        F.array_join(F.transform("messages", lambda m: m["chat"]), "\n").alias("chat"),
    )


def thread_of(parents: DataFrame) -> DataFrame:
    """``(conv_id, turn, parent_turn, thread_turn, depth)`` by pointer doubling: rounds grow with the log of the depth."""
    heads = parents.select("conv_id", "turn", "parent_turn", F.col("parent_turn").alias("thread_turn"), F.lit(1).cast("long").alias("depth"))
    while True:
        up = heads.select("conv_id", F.col("turn").alias("thread_turn"), F.col("thread_turn").alias("further"), F.col("depth").alias("more"))
        joined = heads.join(up, ["conv_id", "thread_turn"], "left")
        if joined.where("further is not null").isEmpty():
            return heads
        heads = stage(
            joined.select(
                "conv_id",
                "turn",
                "parent_turn",
                F.coalesce("further", "thread_turn").alias("thread_turn"),
                (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
            ),
            "threads",
        )
