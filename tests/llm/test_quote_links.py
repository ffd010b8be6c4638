from __future__ import annotations

import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from watchpost.llm import quote_links as ql
from watchpost.llm.oracle import ORACLE_SQL

SCHEMA = "conv_id long, turn long, role string, text string"


def norm(text):
    return " ".join(re.findall(r"[^\W_]+", text.lower()))


def split(line):
    prefix = re.match(r"[> \t]*", line)[0]
    return prefix.count(">"), line[len(prefix) :].rstrip()


def units(text):
    """``(level, normalised passage)`` of runs, paragraphs and, from 8 characters on, lines."""
    lines = [split(x) for x in (text or "").split("\n")]
    found = set()
    for paragraphs in (False, True):
        begin = 0
        for i in range(1, len(lines) + 1):
            if i == len(lines) or lines[i][0] != lines[i - 1][0] or paragraphs and lines[i - 1][1] == "":
                found.add((lines[begin][0], norm(" ".join(c for _, c in lines[begin:i]))))
                begin = i
    found |= {(level, norm(content)) for level, content in lines if len(norm(content)) >= 8}
    return {(level, passage) for level, passage in found if passage}


def brute(rows):
    """``(conv, turn): (parent, thread, depth, position, quoted)`` of different messages."""
    origin = {}
    for conv, turn, _, text in rows:
        for level, passage in units(text):
            if level == 0 and turn is not None:
                origin[conv, passage] = min(turn, origin.get((conv, passage), turn))
    votes = {}
    for conv, turn, _, text in rows:
        for level, passage in units(text):
            first = origin.get((conv, passage))
            if level and first is not None and turn is not None and first < turn:
                votes.setdefault((conv, turn), set()).add((level, first, passage))
    parent, quoted = {}, {}
    for key, found in votes.items():
        chars = {}
        for level, first, passage in found:
            chars[level, first] = chars.get((level, first), 0) + len(passage)
        parent[key] = min(chars, key=lambda x: (x[0], -chars[x], x[1]))[1]
        quoted[key] = sorted({first for _, first in chars})
    result = {}
    for conv, turn in {(c, t) for c, t, _, _ in rows}:
        at, depth = turn, 0
        while (conv, at) in parent:
            at, depth = parent[conv, at], depth + 1
        result[conv, turn] = [parent.get((conv, turn)), at, depth, None, quoted.get((conv, turn), [])]
    none_first = lambda x: (x is not None, x or 0)
    for conv in {c for c, _ in result}:
        own = sorted((k for k in result if k[0] == conv), key=lambda k: (none_first(result[k][1]), none_first(k[1])))
        for i, k in enumerate(own):
            result[k][3] = i
    return result


def answer(rows):
    found = {}
    for r in rows:
        quoted = [int(x) for x in r["quoted_turns"].split(",")] if r["quoted_turns"] else []
        found[r["conv_id"], r["turn"]] = [r["parent_turn"], r["thread"], r["depth"], r["position"], quoted]
    return found


def conversations(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    rows = []
    for conv in (1, 2, 3):
        own = []
        for turn in range(25 if conv == 1 else 6):
            lines = [" ".join(rng.choice(words) for _ in range(rng.randrange(2, 9))) for _ in range(3)]
            text = "\n".join([lines[0], "", *lines[1:]])
            if own and rng.random() < 0.8:
                source = own[-1] if rng.random() < 0.5 else rng.choice(own)
                part = source if rng.random() < 0.5 else rng.choice(source.split("\n"))
                quote = "\n".join(f"> {x}".rstrip() for x in part.split("\n"))
                text = f"On Monday, A wrote:\n{quote}\n{text}"
            own.append(text)
            rows.append((conv, turn, "user", text))
    return rows


def test_links_equal_brute_force(spark):
    rows = conversations(3)
    found = ql.link_quotations(spark.createDataFrame(rows, SCHEMA)).collect()
    expected = brute(rows)
    assert max(depth for _, _, depth, _, _ in expected.values()) > 4
    assert answer(found) == expected
    assert not any(re.search(r"^\s*>|wrote:$", r["text"], re.M) for r in found)


NESTED = [
    (1, 0, "user", "How do I sort a table?\nIt is large."),
    (1, 1, "assistant", "Anna wrote:\n> How do I SORT\n>  a table?\nUse order by, it spills."),
    (1, 2, "user", ">> How do I sort a table?\n> Use order by,\n> it spills.\n\nThank you very much"),
    (1, 3, "user", "> Nobody has said this here\nReally not"),
]


def test_nested_quotes_and_clean_text(spark):
    found = {r["turn"]: r for r in ql.link_quotations(spark.createDataFrame(NESTED, SCHEMA)).collect()}
    assert [found[t]["parent_turn"] for t in range(4)] == [None, 0, 1, None]
    assert [found[t]["quoted_turns"] for t in range(4)] == ["", "0", "0,1", ""]
    assert [found[t]["depth"] for t in range(4)] == [0, 1, 2, 0]
    assert [found[t]["text"] for t in range(1, 4)] == ["Use order by, it spills.", "Thank you very much", "Really not"]


SHORT = [x for k, word in enumerate(["x", "no", "Why?", "はい", "そうですか", "thanks", "seven77", "这个问题很好吗"]) for x in (
    (k, 0, "user", word), (k, 1, "assistant", f"> {word}\nBecause."), (k, 2, "user", f"first\n\n{word}\n\nlast one"),
    (k, 3, "user", f"> {word}"))]


def test_short_passages_link_where_they_are_whole(spark):
    found = {(r["conv_id"], r["turn"]): r for r in ql.link_quotations(spark.createDataFrame(SHORT, SCHEMA)).collect()}
    for k in range(8):
        assert [found[k, t]["parent_turn"] for t in range(4)] == [None, 0, None, 0]
        assert found[k, 1]["text"] == "Because."
    assert answer(found.values()) == brute(SHORT)


def test_short_lines_of_longer_passages_link_nothing(spark):
    rows = [(1, 0, "a", "yes\nand more words here"), (1, 1, "b", "> yes\nok"), (1, 2, "b", "> yes\n> other words there\nok")]
    found = {r["turn"]: r["parent_turn"] for r in ql.link_quotations(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert found == {0: None, 1: None, 2: None}


@pytest.mark.parametrize("unit", ["> a\nb\n", "a\n", " ", "\n", "> ", "wrote: x ", "a  \t "])
def test_time_is_about_linear_in_one_message(spark, unit):
    from time import perf_counter

    def took(chars):
        rows = [(1, 0, "a", unit * (chars // len(unit)) + "x"), (1, 1, "b", "> some words")]
        df = spark.createDataFrame(rows, SCHEMA)
        started = perf_counter()
        ql.link_quotations(df).write.format("noop").mode("overwrite").save()
        return perf_counter() - started

    took(1000)
    assert took(800_000) < 8 * max(took(200_000), 1.0)


def test_a_long_chain_needs_few_rounds(spark):
    rows = [(1, i, "user", (f"> message number {i - 1} here\n" if i else "") + f"message number {i} here") for i in range(40)]
    found = ql.link_quotations(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r["turn"], r["depth"], r["thread"], r["position"]) for r in found) == [(i, i, 0, i) for i in range(40)]


def test_edge_cases(spark):
    rows = [
        (1, 0, "a", None), (1, 1, "a", ""), (1, 2, "b", "> \n>>"), (1, 3, None, "> > x"), (None, 0, "a", "words are here"),
        (None, 1, "a", "> words are here\nyes"), (2, None, "a", "words are here"), (2, None, "a", "> words are here"),
        (2, 4, "a", "words are here"), (2, 4, "a", "> words are here"), (2, 5, "a", "> words are here\nok"),
        (3, 1, "a", "> later words come\nno"), (3, 2, "a", "later words come"), (4, 0, "a", "> " + "x " * 50_000),
    ]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("thread", F.lit("own")).withColumn("conv", F.lit(1))
    found = ql.link_quotations(df).collect()
    assert len(found) == len(rows) and answer(found) == brute(rows)
    assert ql.link_quotations(df.limit(0)).count() == 0


@pytest.mark.parametrize("rows", [NESTED, SHORT, conversations(5), [(1, 0, "u", None), (1, 1, "u", "> "), (None, None, None, "")]])
def test_statement_links_like_the_operator(spark, tmp_path, rows):
    """The registered SQL over messages that do quote."""
    frame = spark.createDataFrame(rows, SCHEMA)
    frame.write.parquet(str(tmp_path / "conversations.parquet"))
    connection = duckdb.connect()
    connection.execute(f"create view conversations as select * from '{tmp_path}/conversations.parquet/*.parquet'")
    cursor = connection.execute(ORACLE_SQL["op5_quotation_links"])
    names = [c[0] for c in cursor.description]
    result = ql.link_quotations(frame)
    theirs = sorted((tuple(r[names.index(c)] for c in result.columns) for r in cursor.fetchall()), key=str)
    assert sorted(map(tuple, result.collect()), key=str) == theirs


def test_no_python_runs(spark, sf_dir, capsys):
    ql.link_quotations(spark.read.parquet(f"{sf_dir}/conversations.parquet")).explain()
    assert not re.search("Python|Pandas|Arrow", capsys.readouterr().out)
