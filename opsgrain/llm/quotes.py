"""Quotation linking in conversations: quoted passages lead to the messages they come from.  DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import ordered
from .shared import store

#: Quote marks at the start of a line, and the line that introduces a quote.
MARKS = r"^(?:[\x20\t]*+>)++"
INTRODUCES = r"(?i)^[\x20\t]*(?:on|le|am|el)\x20.{1,200}(?:wrote|écrit|schrieb|escribió)[^:]{0,80}:[\x20\t]*$"
#: Turns that one task orders at a time for a key.
TURNS = 4096
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def normalised(text: Column) -> Column:
    """A-Z in lower case, white space as single blanks, none at the ends."""
    return F.trim(F.regexp_replace(F.translate(text, _UPPER, _UPPER.lower()), r"[\x20\x09-\x0D]+", " "))


def _units(lines: Column) -> Column:
    """What of a passage can be found again: the whole of it (0), its paragraphs (1) and its lines (2), as (level, hash, chars)."""
    whole = F.array_join(lines, "\n")

    def unit(level: int):
        return lambda t: F.struct(F.lit(level).alias("level"), F.md5(normalised(t)).alias("hash"), F.length(normalised(t)).alias("chars"))

    every = F.concat(
        F.transform(F.array(whole), unit(0)),
        F.transform(F.split(whole, r"\n[\x20\t]*\n", -1), unit(1)),
        F.transform(lines, unit(2)),
    )
    return F.array_distinct(F.filter(every, lambda u: u["chars"] > 0))


def passages(messages: DataFrame) -> DataFrame:
    """mid, conv_id, turn, role, text without quotes, and ``runs`` of each row of ``messages``.

    A run is a stretch of lines of one quote level: (no, depth, units).  Depth 0 is the writer's own text; a line that introduces a quote and
    stands right before one belongs to no run (depth -1).
    """
    lines = F.split(F.coalesce("text", F.lit("")), "\r\n|\r|\n", -1)
    given = messages.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), "role", "text", lines.alias("lines"))
    depth = F.transform("lines", lambda x: F.length(F.regexp_replace(F.regexp_extract(x, MARKS, 0), "[^>]", "")))
    body = F.transform("lines", lambda x: F.regexp_replace(x, MARKS + r"\x20?", ""))
    out = given.withColumn("mid", F.monotonically_increasing_id()).withColumn("depths", depth).withColumn("bodies", body)
    introduces = lambda i: (F.get("depths", i) == 0) & (F.coalesce(F.get("depths", i + 1), F.lit(0)) > 0) & F.get("lines", i).rlike(INTRODUCES)
    places = F.sequence(F.lit(0), F.size("lines") - 1)
    out = out.withColumn("depths", F.transform(places, lambda i: F.when(introduces(i), -1).otherwise(F.get("depths", i))))
    out = out.withColumn("starts", F.filter(places, lambda i: (i == 0) | ~F.get("depths", i).eqNullSafe(F.get("depths", i - 1))))

    def run(start: Column, no: Column) -> Column:
        end = F.coalesce(F.get("starts", no + 1), F.size("lines"))
        return F.struct(no.alias("no"), F.get("depths", start).alias("depth"), _units(F.slice("bodies", start + 1, end - start)).alias("units"))

    own = F.array_join(F.filter("bodies", lambda x, i: F.get("depths", i) == 0), "\n")
    own = F.regexp_replace(F.regexp_replace(own, r"^[\x20\x09-\x0D]++", ""), r"(?<![\x20\x09-\x0D])[\x20\x09-\x0D]++$", "")
    quoted = F.exists("depths", lambda d: d != 0)
    return out.select("mid", "conv_id", "turn", "role", F.when(quoted, own).otherwise(F.col("text")).alias("text"), F.transform("starts", run).alias("runs"))


def _sources(runs: DataFrame) -> DataFrame:
    """(mid, no, depth, chars, source) of each quoted passage that is found again; source: (turn, mid).

    A unit of a quote comes from the last earlier message of the conversation that has it in its own text.  Both sides are stacked and
    scanned once along the turns, in chunks, so neither a common line nor a long conversation makes pairs or meets in one task.
    """
    units = runs.select("conv_id", "turn", "mid", "no", "depth", F.explode("units").alias("u")).select("conv_id", "turn", "mid", "no", "depth", "u.*")
    quotes = units.filter("depth > 0").select("*", F.lit(0).alias("rank"), F.lit(None).cast("struct<turn:bigint,mid:bigint>").alias("hit"))
    wanted = store(quotes.select("conv_id").distinct(), "quoting")
    own = units.filter("depth = 0").join(wanted, "conv_id", "left_semi").select("conv_id", "turn", "mid", "hash").distinct()
    own = own.withColumns({"rank": F.lit(1), "hit": F.struct("turn", "mid")})
    stacked = quotes.unionByName(own, allowMissingColumns=True)
    found = ordered(stacked, ["conv_id", "hash"], ["turn", "rank", "mid"], F.floor(F.col("turn") / TURNS), last_seen={"source": F.col("hit")})
    found = found.filter("rank = 0 and source is not null").groupBy("mid", "no", "depth", "level", "source").agg(F.sum("chars").alias("chars"))
    best = F.max(F.struct((-F.col("level")).alias("l"), "chars", "source")).alias("best")
    return found.groupBy("mid", "no", "depth").agg(best).select("mid", "no", "depth", "best.chars", "best.source")


def _roots(replies: DataFrame) -> DataFrame:
    """(mid, root) of messages with a reply_to: the first message of their chain, by doubling the step of each pointer."""
    now = store(replies.select("mid", F.col("reply").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("mid").alias("via"), F.col("root").alias("next"))
        new = now.join(ahead, F.col("root.mid") == F.col("via"), "left")
        new = store(new.select("mid", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        now = new.select("mid", "root")
        if new.filter("moved").isEmpty():
            return now


def link_quotes(messages: DataFrame) -> DataFrame:
    """The rows of ``messages`` (conv_id, turn, role, text) in reply order and without quotes.

    Columns: conv_id, turn, role, text (own text only), n_quotes (quoted passages), max_depth, n_linked (quoted passages that were found in
    an earlier message), reply_to (turn of the message that is answered, or null), thread (turn of the first message of the chain of
    answers), position (from 1, the place in the reply-ordered conversation).

    A quoted passage is a stretch of lines with the same number of > marks.  Its normalised text is hashed as a whole, by paragraphs and by lines,
    and joined to the own texts of earlier turns; the coarsest level that is found counts, then the most characters, then the latest
    turn.  A message answers the source of its outermost linked passage (then most characters, then latest).  Messages are ordered by the
    turn their thread begins with, then by their own turn.

    A text without quotes stays as it is, null included.  Messages without conv_id or turn link to nothing and have no thread and
    position; messages that repeat a turn come in the order they are read, and none answers another of the same turn.  An empty
    table gives an empty result; other columns are not read.
    """
    parsed = store(passages(messages), "messages")
    whole = parsed.filter("conv_id is not null and turn is not null")
    runs = whole.select("conv_id", "turn", "mid", F.explode("runs").alias("run")).select("conv_id", "turn", "mid", "run.*")
    linked = store(_sources(runs), "sources")
    nearest = F.max(F.struct((-F.col("depth")).alias("d"), "chars", "source")).alias("best")
    replies = linked.groupBy("mid").agg(F.count("*").alias("n_linked"), nearest).select("mid", "n_linked", F.col("best.source").alias("reply"))
    replies = store(replies, "replies")
    places = whole.select("mid", "conv_id", "turn").join(_roots(replies), "mid", "left")
    places = places.select("mid", "conv_id", "turn", F.coalesce("root.turn", "turn").alias("thread"), F.coalesce("root.mid", "mid").alias("first"))
    places = store(places, "places")

    thread = ["conv_id", "thread", "first"]
    sizes = places.groupBy(thread).agg(F.count("*").alias("n"))
    sizes = ordered(sizes, ["conv_id"], ["thread", "first"], F.floor(F.col("thread") / TURNS), running={"upto": F.col("n")})
    before = store(sizes.select(*thread, (F.col("upto") - F.col("n")).alias("before")), "before")
    inside = ordered(places, thread, ["turn", "mid"], F.floor(F.col("turn") / TURNS), number="place")
    placed = inside.join(before, thread).select("mid", "thread", (F.col("before") + F.col("place")).cast("bigint").alias("position"))

    quoted = F.filter("runs", lambda r: r["depth"] > 0)
    out = parsed.join(placed, "mid", "left").join(replies, "mid", "left")
    return out.select(
        "conv_id", "turn", "role", "text",
        F.size(quoted).cast("bigint").alias("n_quotes"),
        F.coalesce(F.array_max(F.transform(quoted, lambda r: r["depth"])), F.lit(0)).cast("bigint").alias("max_depth"),
        F.coalesce("n_linked", F.lit(0)).cast("bigint").alias("n_linked"),
        F.col("reply.turn").alias("reply_to"), "thread", "position",
    )
