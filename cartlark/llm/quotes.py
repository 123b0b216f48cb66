"""Quotation linking: replies find the messages they quote.

Lines of a message carry a quote level, the number of leading ``>`` marks; neighbouring
lines of one level are a passage.  Normalised passages (spaces folded, trimmed,
lower-cased) are hashed.  A message's whole own text, its own passages, and their paragraphs
(between blank lines) and lines are filed under conversation and hash with the turn that said
them first; quoted passages, their paragraphs and their lines are joined to that turn where it
is earlier, so that a trimmed quotation finds its message too.  A message answers what it
quotes at the lowest level where a quotation was found; there a whole passage goes before a
paragraph, a paragraph before a line, and then the latest turn before others.  Answers form
trees: ordering by ``thread`` and turn puts each message after the one that it answers, and the
text comes without its quotations.

DataFrame functions only.  A null text is empty.  A message with a null conversation or
turn is kept, links to nothing and starts a thread of its own.  Repeated messages of one
turn are judged one by one.  Passages without a letter or digit link nothing.  An empty
table gives no rows.  Columns other than the four of a message are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlark.llm import common

#: No repeated group, which would take a stack frame per mark.
_MARKS = "^[ \\t]*>[ \\t>]*"
_BLANKS = " \t\r\n\f\x0b"
_PARAGRAPH = "\n[ \\t\\r\\f\\x0B]*\n"
_PASSAGE_UNIT, _PARAGRAPH_UNIT, _LINE_UNIT = 0, 1, 2
_SPACES = "[ \\t\\r\\n\\f\\x0B]+"
_RUN, _TEXT = "\x1e", "\x1f"  # mark runs of lines and their levels; not kept in texts


def normalised(text: Column) -> Column:
    return F.lower(F.btrim(F.regexp_replace(text, _SPACES, " "), F.lit(" ")))


def _units(body: Column) -> Column:
    """``unit`` and normalised ``words`` of a passage, its paragraphs and its lines."""
    def of(unit: int, parts: Column) -> Column:
        return F.transform(
            parts, lambda part: F.struct(F.lit(unit).alias("unit"), normalised(part).alias("words"))
        )

    return F.concat(
        of(_PASSAGE_UNIT, F.array(body)), of(_PARAGRAPH_UNIT, F.split(body, _PARAGRAPH)),
        of(_LINE_UNIT, F.split(body, "\n")),
    )


def parsed(messages: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``role``, ``message`` (a digest of role and text), ``clean``
    (the text without quoted lines) and ``passages``: ``level`` and ``units`` of each run of
    lines of one level."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lines = F.split(F.translate(text, _RUN + _TEXT, "  "), "\n")
    levels = F.transform(
        lines, lambda line: F.length(F.translate(F.regexp_extract(line, _MARKS, 0), " \t", ""))
    )
    rows = messages.select(
        "conv_id", "turn", "role",
        F.sha2(F.concat_ws(_RUN, F.coalesce("role", F.lit("")), text), 256).alias("message"),
        lines.alias("lines"),
        levels.alias("levels"),
    )

    def marked(line: Column, at: Column) -> Column:
        level = F.get("levels", at)
        begins = (at == 0) | (level != F.get("levels", at - 1))
        head = F.when(begins, F.concat(F.lit(_RUN), level.cast("string"), F.lit(_TEXT)))
        return F.concat(F.coalesce(head, F.lit("\n")), F.regexp_replace(line, _MARKS, ""))

    runs = F.split(F.array_join(F.transform("lines", marked), ""), _RUN)
    runs = F.filter(runs, lambda run: run != "")
    passages = F.transform(
        runs,
        lambda run: F.struct(
            F.substring_index(run, _TEXT, 1).cast("int").alias("level"),
            _units(F.substring_index(run, _TEXT, -1)).alias("units"),
        ),
    )
    own = F.filter("lines", lambda line, at: F.get("levels", at) == 0)
    clean = F.btrim(F.array_join(own, "\n"), F.lit(_BLANKS))
    return rows.select(
        "conv_id", "turn", "role", "message", clean.alias("clean"), passages.alias("passages")
    )


def _filed(rows: DataFrame, words: str) -> DataFrame:
    """Rows whose words can link, with their hash."""
    return rows.filter(F.col(words).rlike("[\\p{L}\\p{N}]")).withColumn(
        "hash", F.sha2(F.col(words), 256)
    )


def link(messages: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``message``, ``parent_turn`` of the ``parsed`` messages that
    quote an earlier turn."""
    rows = messages.filter("conv_id is not null and turn is not null")
    own = F.filter("passages", lambda p: p["level"] == 0)
    units = F.flatten(F.transform(own, lambda p: F.transform(p["units"], lambda u: u["words"])))
    spoken = F.array_distinct(F.concat(units, F.array(normalised(F.col("clean")))))
    said = (
        _filed(rows.select("conv_id", "turn", F.explode(spoken).alias("words")), "words")
        .groupBy("conv_id", "hash")  # combined before the shuffle: one first turn per key
        .agg(F.min("turn").alias("first"))
    )
    quoted = F.filter("passages", lambda p: p["level"] > 0)
    asked = _filed(
        rows.select("conv_id", "turn", "message", F.explode(quoted).alias("p"))
        .select("conv_id", "turn", "message", "p.level", F.explode("p.units").alias("u"))
        .select("conv_id", "turn", "message", "level", "u.unit", "u.words"),
        "words",
    ).drop("words").distinct()
    return (
        asked.join(said, ["conv_id", "hash"])
        .filter("first < turn")
        .groupBy("conv_id", "turn", "message")
        .agg(F.max_by("first", F.struct(-F.col("level"), -F.col("unit"), "first")).alias("parent_turn"))
    )


def threads(links: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``thread`` (the turn at the root) and ``depth`` of every turn
    that answers another; a turn with several parents follows the latest.

    Each step doubles the distance that is looked up, and is stored."""
    up = common.stored(
        links.groupBy("conv_id", "turn")
        .agg(F.max("parent_turn").alias("thread"))
        .withColumn("depth", F.lit(1).cast("bigint")),
        "reply_steps",
    )
    while True:
        above = up.select(
            "conv_id", F.col("turn").alias("thread"), F.col("thread").alias("_thread"),
            F.col("depth").alias("_depth"),
        )
        joined = up.join(above, ["conv_id", "thread"], "left")
        if joined.filter("_thread is not null").isEmpty():
            return up
        up = common.stored(
            joined.select(
                "conv_id", "turn", F.coalesce("_thread", "thread").alias("thread"),
                (F.col("depth") + F.coalesce("_depth", F.lit(0))).alias("depth"),
            ),
            "reply_steps",
        )


def reply_order(messages: DataFrame) -> DataFrame:
    """Every message with ``parent_turn``, ``thread``, ``depth``, ``n_quotes`` and its text
    without quotations.  Ordering a conversation by ``thread``, ``turn`` gives reply order."""
    rows = common.stored(parsed(messages), "parsed_messages")
    links = common.stored(link(rows), "quote_links")
    found = threads(links)
    return (
        rows.join(links, ["conv_id", "turn", "message"], "left")
        .join(found, ["conv_id", "turn"], "left")
        .select(
            "conv_id", "turn", "role", "parent_turn",
            F.coalesce("thread", "turn").alias("thread"),
            F.coalesce("depth", F.lit(0)).cast("bigint").alias("depth"),
            F.size(F.filter("passages", lambda p: p["level"] > 0)).cast("bigint")
            .alias("n_quotes"),
            F.col("clean").alias("text"),
        )
    )


def op4_chat_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All messages in reply order, without quotations."""
    return reply_order(common.table(spark, sf_dir, "conversations"))


OP4_SQL = r"""
with recursive lined as (
    select conv_id, turn, role, coalesce(text, '') t,
           string_split(translate(coalesce(text, ''), chr(30) || chr(31), '  '), chr(10)) lines
    from conversations
), leveled as (
    select *, list_transform(lines, lambda x: cast(length(translate(
        regexp_extract(x, '^[ \t]*>[ \t>]*'), ' ' || chr(9), '')) as integer)) levels
    from lined
), marked as (
    select *, list_filter(string_split(array_to_string(list_transform(range(1, len(lines) + 1),
        lambda i: case when i = 1 or levels[i] <> levels[i - 1]
                       then chr(30) || levels[i] || chr(31) else chr(10) end
                  || regexp_replace(lines[i], '^[ \t]*>[ \t>]*', '')), ''), chr(30)),
        lambda r: r <> '') runs,
        trim(array_to_string(list_transform(list_filter(range(1, len(lines) + 1),
            lambda i: levels[i] = 0), lambda i: lines[i]), chr(10)),
            ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) clean
    from leveled
), bodies as (
    select conv_id, turn, role, t, cast(split_part(run, chr(31), 1) as integer) level,
           split_part(run, chr(31), 2) body
    from (select conv_id, turn, role, t, unnest(runs) run from marked)
    where conv_id is not null and turn is not null
), units as (
    select *, 0 unit, body part from bodies
    union all
    select *, 1, unnest(regexp_split_to_array(body, '\n[ \t\r\f\v]*\n')) from bodies
    union all
    select *, 2, unnest(string_split(body, chr(10))) from bodies
), passages as (
    select * exclude (body, part),
           lower(trim(regexp_replace(part, '[ \t\r\n\f\v]+', ' ', 'g'), ' ')) words
    from units
), said as (
    select conv_id, words, min(turn) first_turn from (
        select conv_id, turn, words from passages where level = 0
        union all
        select conv_id, turn, lower(trim(regexp_replace(clean,
            '[ \t\r\n\f\v]+', ' ', 'g'), ' ')) from marked)
    where regexp_matches(words, '[\p{L}\p{N}]') group by all
), links as (
    select conv_id, turn, role, t, arg_max(first_turn, (-level, -unit, first_turn)) parent_turn
    from passages p join said using (conv_id, words)
    where level > 0 and first_turn < turn group by all
), parents as (
    select conv_id, turn, max(parent_turn) parent from links group by all
), climbed(conv_id, turn, above, depth) as (
    select conv_id, turn, parent, 1 from parents
    union all
    select c.conv_id, c.turn, p.parent, c.depth + 1
    from climbed c join parents p on c.conv_id = p.conv_id and c.above = p.turn
), roots as (
    select conv_id, turn, arg_max(above, depth) thread, max(depth) depth from climbed group by all
)
select m.conv_id, m.turn, m.role, l.parent_turn, coalesce(r.thread, m.turn) thread,
       cast(coalesce(r.depth, 0) as bigint) depth,
       cast(len(list_filter(m.runs, lambda x: not starts_with(x, '0' || chr(31)))) as bigint)
           n_quotes,
       m.clean "text"
from marked m
left join links l on m.conv_id = l.conv_id and m.turn = l.turn
                 and m.role is not distinct from l.role and m.t = l.t
left join roots r on m.conv_id = r.conv_id and m.turn = r.turn
"""
