"""Chat formatting by quotation linking, with DataFrame functions only.

Messages quote each other with ``>`` before lines, several of them for quotes of quotes.  Each
text is cut into passages of one quote level; the message's own ones (level 0) and the quoted
ones are normalised and hashed, whole, by paragraph and by line, and a quoted passage is joined to
its original: the earliest message of the conversation that has it as its own.  A message replies
to the original of what it quotes at the lowest level, by most characters; that gives threads,
depths, and an order in which replies come after what they reply to, by thread and turn, with all
quotes taken out.

Originals are the earliest turn for each passage, found with map-side combine, so a passage that
everyone repeats is one row; the join is one to one, and Spark splits it for a conversation that
holds a third of all rows.  Threads are found by doubling of links, in rounds that grow with the
logarithm of the depth.  No task sees a whole conversation.

Edge cases: a null text is empty and quotes nothing; a message with a null conversation is in the
conversation null; one with a null turn is never an original or a reply, and comes first; a
quote of a later message or of the message itself links nothing; rows with equal conversation and
turn are one message for links and order, and each row is returned with its own text; ties between
originals go to the earlier one.  Only the columns named are looked at.

A passage or paragraph links at any length; a single line of a longer passage needs ``MIN_CHARS``
letters, since short lines ("yes") are said often.  Time grows in proportion to a text's length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from watchpost.llm.ranking import numbered_within, prefixed, same
from watchpost.llm.storage import checkpointed, written

MIN_CHARS = 8  # of a normalised line that can link on its own; whole passages link at any length
KEY = ["conv", "turn"]
# Fixed value: what a line that introduces a quote says before its colon, in four languages.
ATTRIBUTION = r"(?i)wrote|schrieb|écrit|escribió"
BLANKS = " \t\n\x0b\f\r"


def quote_level(line: Column) -> Column:
    """Number of ``>`` before the text of a line."""
    return F.length(F.translate(F.regexp_extract(line, r"^([> \t]*)", 1), " \t", ""))


def line_content(line: Column) -> Column:
    return F.rtrim(F.ltrim(line, F.lit("> \t")), F.lit(BLANKS))


def normalised(text: Column) -> Column:
    """Lower-case words with one space between."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def _starts(boundary: str) -> Column:
    """Numbers of the lines at which a passage begins; ``boundary`` says so for line ``i``."""
    return F.expr(f"filter(sequence(0, size(lines) - 1), i -> i = 0 or {boundary})")


def _runs(starts: str) -> Column:
    """Passages of consecutive lines, from the column of their first lines."""
    return F.expr(
        f"transform({starts}, (s, k) -> struct(lines[s].level as level, s as begin,"
        f" coalesce(get({starts}, k + 1), size(lines)) as end, true as whole))"
    )


def _with_lines(messages: DataFrame) -> DataFrame:
    """Adds ``lines``, an array of levels and contents, and its passages, as line ranges."""
    lines = F.transform(
        F.split(F.coalesce("text", F.lit("")), "\n"),
        lambda x: F.struct(quote_level(x).alias("level"), line_content(x).alias("content"), x.alias("line")),
    )
    level = "lines[i].level <> lines[i - 1].level"
    # First lines are columns of their own, so that they are found once and not for each passage.
    begun = messages.withColumn("lines", lines).withColumns(
        {"run_starts": _starts(level), "paragraph_starts": _starts(f"{level} or lines[i - 1].content = ''")}
    )
    return begun.withColumns({"runs": _runs("run_starts"), "paragraphs": _runs("paragraph_starts")}).drop(
        "run_starts", "paragraph_starts"
    )


def _units(rows: DataFrame, where: str) -> DataFrame:
    """``(conv, turn, level, hash, chars)`` of the passages, paragraphs and lines whose level fits;
    a passage may come more than once."""
    # A passage's text is put together before passages become rows, so that no row carries all lines.
    parts = (
        "concat(runs, paragraphs, transform(sequence(0, size(lines) - 1),"
        " i -> struct(lines[i].level as level, i as begin, i + 1 as end, false as whole)))"
    )
    text = "array_join(transform(slice(lines, u.begin + 1, u.end - u.begin), l -> l.content), ' ')"
    passages = f"transform(filter({parts}, u -> u.level {where}), u -> struct(u.level, u.whole, {text} as text))"
    long_enough = (F.length("passage") >= MIN_CHARS) | (F.col("whole") & (F.length("passage") > 0))
    return (
        rows.select(*KEY, F.explode(F.expr(passages)).alias("u"))
        .select(*KEY, "u.level", "u.whole", normalised(F.col("u.text")).alias("passage"))
        .where(long_enough)
        # 128 bits stand for the passage.
        .select(*KEY, "level", F.md5("passage").alias("hash"), F.length("passage").alias("chars"))
    )


def reply_links(lined: DataFrame) -> DataFrame:
    """``(conv, turn, parent, quoted)``: messages that quote, the turn they reply to, and the turns
    of all originals they quote, as an array in order."""
    originals = _units(lined, "= 0").groupBy("conv", "hash").agg(F.min("turn").alias("origin"))
    originals = prefixed(originals, ["conv", "hash"])
    quotes = _units(lined.where(F.exists("lines", lambda x: x["level"] > 0)), "> 0").distinct()
    found = quotes.join(originals, same(quotes, originals, ["conv", "hash"])).where("origin < turn")
    by_origin = found.groupBy(*KEY, "level", "origin").agg(F.sum("chars").alias("chars"))
    best = F.max_by("origin", F.struct(-F.col("level"), "chars", -F.col("origin")))
    # As many rows as one message quotes others.
    return by_origin.groupBy(*KEY).agg(best.alias("parent"), F.sort_array(F.collect_set("origin")).alias("quoted"))


def threads(links: DataFrame) -> DataFrame:
    """``(conv, turn, thread, depth)`` of the messages with a link: the first message above, and how
    many links up it is."""
    up = checkpointed(links.select(*KEY, F.col("parent").alias("thread"), F.lit(1).cast("long").alias("depth")))
    while True:
        above = up.select(
            F.col("conv").alias("__conv"), F.col("turn").alias("__thread"), F.col("thread").alias("__next"),
            F.col("depth").alias("__more"),
        )
        step = up.join(above, same(up, above, ["conv", "thread"]), "left")
        if step.where("__next is not null").isEmpty():
            return up
        up = checkpointed(
            step.select(
                *KEY,
                F.coalesce("__next", "thread").alias("thread"),
                (F.col("depth") + F.coalesce("__more", F.lit(0))).alias("depth"),
            )
        )


def own_text() -> Column:
    """The lines of level 0, without those that introduce a quote and without blank ends."""
    kept = F.expr(
        "filter(sequence(0, size(lines) - 1), i -> lines[i].level = 0 and not"
        " (coalesce(get(lines, i + 1).level, 0) > 0 and lines[i].introduces))"
    )
    joined = F.array_join(F.transform(kept, lambda i: F.expr("lines")[i]["line"]), "\n")
    return F.trim(joined, F.lit("\n"))


def link_quotations(
    messages: DataFrame,
    *,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """A row for each message, with its place in the reply order of its conversation.

    ``conv_col``, ``turn_col``, ``role_col``; ``parent_turn``: the message that it replies to, null
    if it quotes none; ``thread``: turn of the first message above; ``depth``: links up to it;
    ``position``: number of the message in its conversation, from 0, by thread and turn;
    ``quoted_turns``: originals of its quotes, comma-joined; ``text``: without quotes.
    """
    rows = messages.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"),
        F.col(text_col).alias("text"),
    )
    lined = _with_lines(rows)
    links = written(reply_links(lined), "quote-links")
    above = prefixed(threads(links), KEY)
    linked = links.join(above, same(links, above, KEY)).select(*KEY, "parent", "quoted", "thread", "depth")
    roots = prefixed(linked, KEY)
    # Rows that share conversation and turn are one message.
    distinct = rows.select(*KEY).distinct()
    placed = distinct.join(roots, same(distinct, roots, KEY), "left").select(
        *KEY,
        "parent",
        F.coalesce("thread", "turn").alias("thread"),
        F.coalesce("depth", F.lit(0)).cast("long").alias("depth"),
        F.array_join(F.coalesce("quoted", F.array().cast("array<string>")), ",").alias("quoted_turns"),
    )
    placed = prefixed(numbered_within(placed, ["conv"], ["thread", "turn"], "position"), KEY)
    introduces = lambda x: F.rtrim(x, F.lit(BLANKS)).endswith(":") & x.rlike(ATTRIBUTION)
    marked = F.transform(
        "lines",
        lambda x: F.struct(x["level"].alias("level"), x["line"].alias("line"), introduces(x["line"]).alias("introduces")),
    )
    clean = lined.withColumn("lines", marked)
    return clean.join(placed, same(clean, placed, KEY)).select(
        F.col("conv").alias(conv_col),
        F.col("turn").alias(turn_col),
        F.col("role").alias(role_col),
        F.col("parent").alias("parent_turn"),
        "thread",
        "depth",
        "position",
        "quoted_turns",
        own_text().alias("text"),
    )
