"""Chat formatting by quotation linking.

A message's lines have a quote level: the number of ``>`` marks at their start. Level 0 is the message's own text;
deeper lines repeat others. Each line is normalised (marks off, lower case, runs of white space as one space) and hashed;
the hash of a line at level n is looked up among the lines at level n - 1 of the messages of the same conversation, then
among their own lines. The original of a quoted line is the earliest message that has it, if that is earlier than the
quoting one. Lines without such an original may be wrapped anew: consecutive lines of one level are a passage, and a line's
windows are the runs of ``WINDOW`` words of its passage that touch it (a shorter passage is one window). They are looked up
like lines; the original is the earliest message first in most of them, if in half of them or more. A message replies to
the original of most of its lines of the lowest level that has any original (of equal ones the latest); n_quoted counts
these lines of that level. If none is found, it replies to nothing and opens a thread.

Threads are the trees of these replies. Their roots and depths come from pointer doubling, as many rounds as the
logarithm of the longest chain. The order of a conversation is thread by thread (by the turn of the root), and in a thread
by depth, then turn: each reply after what it answers. Without quotes it is the order of turns.

The formatted message has the role mark, the own text without quotes and without the line that introduces
a quote ("... wrote:"), and an end mark. Own lines that repeat at large (greetings, a conversation with very many turns)
cost one row each in a partial aggregate; nothing pairs the members of a group, and no conversation is gathered in a task.

Cases: null text counts as empty; null conv_id: messages form one conversation of their own; null turn: first in
order, no original; rows with the same conv_id and turn share links and are ordered by role and text; a quote of itself or
of a later message is no link; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b, sha256
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from furrow.llm.common import ship, written

WINDOW = 3
# Rows of windows handed on at a time.
WINDOWS_STEP = 1 << 16
START, END = "<|", "|>"
QUOTE = r"^[ \t]*(>[ \t]?)+"
INTRODUCES = r"(?i)^.*\b(wrote|writes|said|schrieb|a écrit|escribió)\s*:\s*$"


def level_of(line: Column) -> Column:
    """Quote marks at the start of a line."""
    marks = F.regexp_extract(line, QUOTE, 0)
    return F.length(marks) - F.length(F.replace(marks, F.lit(">"), F.lit("")))


def key_of(line: Column) -> Column:
    """Normalised words of a line without its quote marks."""
    return F.trim(F.regexp_replace(F.lower(F.regexp_replace(line, QUOTE, "")), r"[\x20\x09-\x0D]+", " "))


def lines(messages: DataFrame) -> DataFrame:
    """(conv, turn, level, passage) of the lines with any words."""
    each = messages.select("conv", "turn", F.explode(F.split("text", "\n")).alias("line"))
    each = each.select("conv", "turn", level_of(F.col("line")).alias("level"), key_of(F.col("line")).alias("key"))
    return each.where("key <> ''").select("conv", "turn", "level", F.sha2("key", 256).alias("passage"))


def _looked_up(level: Column) -> Column:
    """The levels at which a line of a level is looked up."""
    return F.explode(F.array_distinct(F.array(level - 1, F.lit(0))))


def _windows_of(lines_: list[dict], quoted: bool) -> Iterator[tuple]:
    """(level, passage, of, window) of a message: the windows of each quoted line with their number, or all windows once."""
    for (level, worded), run in groupby(lines_, key=lambda line: (line["level"], line["key"] != "")):
        if not worded or quoted and not level:
            continue
        keys = [line["key"] for line in run]
        words = [w for key in keys for w in key.split(" ")]
        starts = range(max(1, len(words) - WINDOW + 1))
        hashes = [int.from_bytes(blake2b(" ".join(words[i:i + WINDOW]).encode(), digest_size=8).digest(), "big", signed=True)
                  for i in starts]
        if not quoted:
            yield from ((level, None, 0, h) for h in hashes)
            continue
        at = 0
        for key in keys:
            upto = at + key.count(" ") + 1
            mine = set(hashes[max(0, at - WINDOW + 1):upto]) or {hashes[-1]}
            yield from ((level, sha256(key.encode()).hexdigest(), len(mine), h) for h in mine)
            at = upto


def windows(messages: DataFrame, quoted: bool) -> DataFrame:
    """(conv, turn, level, passage, of, window): see ``_windows_of``."""
    ship(messages.sparkSession)
    schema = pa.schema([("conv", pa.string()), ("turn", pa.int64()), ("level", pa.int32()), ("passage", pa.string()),
                        ("of", pa.int64()), ("window", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in batches:
            for conv, turn, lines_ in zip(*batch.columns):
                for row in _windows_of(lines_.as_py(), quoted):
                    rows.append((conv.as_py(), turn.as_py(), *row))
                    if len(rows) == WINDOWS_STEP:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                        rows.clear()
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    each = F.transform(F.split("text", "\n"), lambda line: F.struct(level_of(line).alias("level"), key_of(line).alias("key")))
    return messages.select("conv", "turn", each.alias("lines")) \
        .mapInArrow(run, "conv string, turn long, level int, passage string, of long, window long")


def _rewrapped(messages: DataFrame, unknown: DataFrame) -> DataFrame:
    """(conv, turn, level, passage, origin) of the lines of ``unknown`` whose windows have an original."""
    line = ["conv", "turn", "level", "passage"]
    there = messages.join(unknown.select("conv").distinct(), "conv", "left_semi")
    first = windows(there, False).groupBy("conv", F.col("level").alias("at"), "window").agg(F.min("turn").alias("origin"))
    quoting = there.where(F.col("text").rlike("(?m)" + QUOTE))
    asked = windows(quoting, True).distinct().join(unknown.select(*line), line, "left_semi")
    found = asked.select("*", _looked_up(F.col("level")).alias("at")).join(first, ["conv", "at", "window"]).where("origin < turn") \
        .groupBy(*line, "of", "at", "origin").agg(F.count("*").alias("n")).where("2 * n >= of")
    best = F.max_by("origin", F.struct("at", "n", -F.col("origin")))
    return found.groupBy(*line).agg(best.alias("origin"))


def replies(messages: DataFrame) -> DataFrame:
    """(conv, turn, parent, n_quoted) of the messages with a known original. ``messages``: conv, turn, text."""
    line = ["conv", "turn", "level", "passage"]
    said = lines(messages)
    first = said.groupBy("conv", F.col("level").alias("at"), "passage").agg(F.min("turn").alias("origin"))
    quoted = said.where("level > 0").distinct().select("*", _looked_up(F.col("level")).alias("at"))
    earlier = F.when(F.col("origin") < F.col("turn"), F.col("origin"))
    known = written(quoted.join(first, ["conv", "at", "passage"], "left").withColumn("origin", earlier)
                    .groupBy(*line).agg(F.max_by("origin", F.when(F.col("origin").isNotNull(), F.col("at"))).alias("origin")), "quoted")
    unknown = known.where("origin IS NULL AND turn IS NOT NULL")
    origins = known.where("origin IS NOT NULL")
    if not unknown.isEmpty():
        origins = origins.unionByName(_rewrapped(messages, unknown))
    votes = origins.groupBy("conv", "turn", "level", "origin").agg(F.count("*").alias("n"))
    best = votes.groupBy("conv", "turn", "level").agg(F.max(F.struct("n", "origin")).alias("b"), F.sum("n").alias("n_quoted"))
    lowest = best.groupBy("conv", "turn").agg(F.min(F.struct("level", F.col("b.origin").alias("parent"), "n_quoted")).alias("l"))
    return lowest.select("conv", "turn", "l.parent", "l.n_quoted")


def threads(links: DataFrame) -> DataFrame:
    """(conv, turn, parent, n_quoted, root, depth): pointer doubling until every message points at its root."""
    at = written(links.withColumn("root", F.col("parent")).withColumn("depth", F.lit(1).cast("long")), "replies")
    while True:
        up = at.select("conv", F.col("turn").alias("root"), F.col("root").alias("up"), F.col("depth").alias("more"))
        met = at.join(up, ["conv", "root"], "left")
        step = written(met.select("conv", "turn", "parent", "n_quoted", F.coalesce("up", "root").alias("root"),
                                  (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
                                  F.col("up").isNotNull().alias("moved")), "threads")
        at = step.drop("moved")
        if step.where("moved").isEmpty():
            return at


def own_text(text: Column) -> Column:
    """The text without quoted lines and the lines that introduce them."""
    def own(ls: Column) -> Column:
        quote_next = lambda i: F.coalesce(F.get(ls, i + 1), F.lit("")).rlike(QUOTE)
        return F.filter(ls, lambda line, i: ~line.rlike(QUOTE) & ~(line.rlike(INTRODUCES) & quote_next(i)))

    return F.regexp_replace(F.array_join(F.transform(F.array(F.split(text, "\n")), own)[0], "\n"), r"^\s+|\s+$", "")


def format_chats(messages: DataFrame) -> DataFrame:
    """Per message: conv_id, turn, role, reply_to, n_quoted, thread (turn of the root), depth, place (the message's place in
    its thread-wise order, as sortable text), formatted."""
    base = messages.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv"))
    linked = threads(replies(base.select("conv", "turn", "text"))).withColumnRenamed("turn", "_turn")
    out = base.join(linked, (base["conv"] == linked["conv"]) & (base["turn"] == linked["_turn"]), "left")
    thread, depth = F.coalesce("root", "turn"), F.coalesce("depth", F.lit(0).cast("long"))
    place = F.concat_ws("/", *[F.lpad(F.coalesce(c, F.lit(-1)).cast("string"), 12, "0") for c in (thread, depth, F.col("turn"))])
    body = own_text(F.col("text"))
    return out.select(
        "conv_id", "turn", "role", F.col("parent").alias("reply_to"),
        F.coalesce("n_quoted", F.lit(0).cast("long")).alias("n_quoted"), thread.alias("thread"), depth.alias("depth"),
        place.alias("place"),
        F.concat(F.lit(START), F.coalesce("role", F.lit("")), F.lit(END + "\n"), body, F.lit("\n" + START + "end" + END)).alias("formatted"))


ORACLE = r"""
WITH RECURSIVE base AS (SELECT conv_id, turn, role, coalesce(text, '') AS text, coalesce(conv_id::VARCHAR, '') AS conv FROM conversations),
cut AS (SELECT conv, turn, unnest(string_split(text, chr(10))) AS line FROM base),
said AS (SELECT conv, turn, length(regexp_extract(line, '^[ \t]*(>[ \t]?)+')) - length(replace(regexp_extract(line, '^[ \t]*(>[ \t]?)+'), '>', ''))
  AS level, trim(regexp_replace(lower(regexp_replace(line, '^[ \t]*(>[ \t]?)+', '')), '[\x20\x09-\x0D]+', ' ', 'g')) AS key FROM cut),
own AS (SELECT conv, key, min(turn) AS origin FROM said WHERE level = 0 AND key <> '' GROUP BY ALL),
votes AS (SELECT q.conv, q.turn, origin, count(*) AS n FROM (SELECT DISTINCT conv, turn, key FROM said WHERE level = 1 AND key <> '') q
  JOIN own USING (conv, key) WHERE origin < q.turn GROUP BY ALL),
best AS (SELECT conv, turn, arg_max(origin, n * 1000000000 + origin) AS parent, sum(n)::BIGINT AS n_quoted FROM votes GROUP BY ALL),
walk AS (SELECT conv, turn, parent AS root, 1::BIGINT AS depth FROM best
  UNION ALL SELECT w.conv, w.turn, b.parent, w.depth + 1 FROM walk w JOIN best b ON b.conv = w.conv AND b.turn = w.root),
top AS (SELECT conv, turn, min(root) AS root, max(depth) AS depth FROM walk GROUP BY ALL),
joined AS (SELECT base.*, parent, n_quoted, root, depth FROM base LEFT JOIN best USING (conv, turn) LEFT JOIN top USING (conv, turn)),
shaped AS (SELECT *, coalesce(root, turn) AS thread, coalesce(depth, 0) AS deep, string_split(text, chr(10)) AS ls FROM joined)
SELECT conv_id, turn, role, parent AS reply_to, coalesce(n_quoted, 0)::BIGINT AS n_quoted, thread, deep::BIGINT AS depth,
  lpad(coalesce(thread, -1)::VARCHAR, 12, '0') || '/' || lpad(deep::VARCHAR, 12, '0') || '/' || lpad(coalesce(turn, -1)::VARCHAR, 12, '0') AS place,
  '<|' || coalesce(role, '') || '|>' || chr(10) || regexp_replace(array_to_string(list_filter(ls, lambda l, i:
    NOT regexp_matches(l, '^[ \t]*>') AND NOT (regexp_matches(l, '(?i)^.*\b(wrote|writes|said|schrieb|a écrit|escribió)\s*:\s*$')
      AND regexp_matches(coalesce(ls[i + 1], ''), '^[ \t]*>'))), chr(10)), '^\s+|\s+$', '', 'g') || chr(10) || '<|end|>' AS formatted
FROM shaped
"""
