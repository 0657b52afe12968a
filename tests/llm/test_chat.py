"""op13: every example in full against plain Python, exact reading back, hot conversations, odd input."""

import hashlib
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from kinfold.llm import chat
from kinfold.llm.chat import CHAT_SQL, PROBE, escape, expand, format_turn, parse, read_back, round_trip, unescape
from kinfold.llm.shared import stored
from tests.llm.conftest import EXTRA

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
NASTY = ["", "\\", "###", "####", "\\###", "</turn>", " </turn>\n", "\\### Assistant: </turn> ok", "a </turn", "\n### user: x </turn>\n", "\\\\", "#\\", ": "]


def conversations(seed=0, count=40):
    draw = random.Random(seed)
    rows = []
    for c in range(count):
        for t in range(draw.randint(1, 9)):
            who = draw.choice(["user", "assistant", "assistant", "system", "tool: x\\", None])
            words = draw.choice([None, draw.choice(NASTY), " ".join(draw.choice(NASTY + ["plain", "été", "☃"]) for _ in range(draw.randint(1, 30)))])
            rows.append((c, t, who, words))
    return rows


def turns_of(rows):
    held = {}
    for c, t, who, words in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "")):
        held.setdefault(c, []).append((who or "", words or ""))
    return held


def naive(rows):
    out = []
    for c, turns in turns_of(rows).items():
        replies = [w for who, w in turns if who == "assistant"]
        sizes = [len(format_turn(*t)[0]) for t in turns]
        upto = [sum(sizes[: k + 1]) for k in range(len(turns))]
        total = sum(n for n, (who, _) in zip(upto, turns) if who == "assistant") + (upto[-1] if turns[-1][0] != "assistant" else 0)
        digest = [hashlib.sha256("".join(x).encode()).hexdigest() for x in ([f"{a}\n{b}\n" for a, b in turns], replies)]
        out.append((c, len(turns), digest[0], len("".join(replies)), digest[1], total))
    return sorted(out, key=str)


def found(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("text", NASTY + [a + b for a in NASTY for b in NASTY])
def test_turns_read_back(text):
    assert unescape(escape(text)) == text
    turns = [(text, text), ("assistant", text), ("a", text + "x")]
    assert parse("".join(format_turn(*t)[0] for t in turns)) == turns
    for who, words in turns:
        formatted, begin, end = format_turn(who, words)
        assert unescape(formatted[begin:end]) == words


def test_broken_text_is_an_error():
    for bad in ("x", "### user: no end", "### user: a </turn>\nrest"):
        with pytest.raises(ValueError):
            parse(bad)


@pytest.mark.parametrize("segment", [1, 200, 16_384])
def test_examples_in_full(spark, segment):
    """Each reply has one example: all turns before it, then the reply, which alone is trainable."""
    rows = conversations(segment)
    examples = expand(spark.createDataFrame(rows, SCHEMA).repartition(3), segment=segment).collect()
    got = {}
    for c in {r["conv_id"] for r in examples}:
        before = ""
        for r in sorted((r for r in examples if r["conv_id"] == c), key=lambda r: r["seq"]):
            if r["loss_begin"] is not None:
                context = before + r["text"][: r["loss_begin"]]
                got.setdefault(c, []).append((context, unescape(r["text"][r["loss_begin"] : r["loss_end"]]), before + r["text"]))
            if r["closes"]:
                before += r["text"]
        assert parse(before) == turns_of(rows)[c]
    for c, turns in turns_of(rows).items():
        wanted = []
        for k, (who, words) in enumerate(turns):
            if who == "assistant":
                before = "".join(format_turn(*t)[0] for t in turns[:k])
                whole, begin, _ = format_turn(who, words)
                wanted.append((before + whole[:begin], words, before + whole))
        assert got.get(c, []) == wanted


@pytest.mark.parametrize("segment", [1, 200, 16_384])
def test_examples_are_written_out_in_full(spark, segment, tmp_path):
    """The files hold each reply's whole context; a long conversation, over several tasks, and a null id too."""
    rows = conversations(segment) + [(None, t, "assistant" if t % 3 else "user", f"null {t}") for t in range(20)]
    rows += [(77, t, "assistant" if t % 2 else "user", f"turn {t} " + "words " * 9) for t in range(601)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        examples = stored(expand(spark.createDataFrame(rows, SCHEMA).repartition(3), segment=segment), "parts")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert examples.filter("conv_id = 77").agg(F.countDistinct(F.shiftright("seq", 32))).first()[0] > 1
    chat.written_out(examples).write.parquet(str(tmp_path / "whole"))
    whole = spark.read.parquet(str(tmp_path / "whole"))
    held = {}
    for r in sorted(whole.collect(), key=lambda r: (r["seq"], r["part"])):
        held.setdefault(r["conv_id"], {}).setdefault(r["seq"], []).append(r)
    for c, turns in turns_of(rows).items():
        wanted = []
        for k, (who, words) in enumerate(turns):
            if who == "assistant" or k == len(turns) - 1:
                wanted.append(("".join(format_turn(*t)[0] for t in turns[: k + 1]), words if who == "assistant" else None))
        got = []
        for parts in held[c].values():
            assert [r["part"] for r in parts] == list(range(len(parts)))
            assert all(r["loss_begin"] is None for r in parts[:-1])
            text, begin, end = parts[-1]["text"], parts[-1]["loss_begin"], parts[-1]["loss_end"]
            got.append(("".join(r["text"] for r in parts), None if begin is None else unescape(text[begin:end])))
        assert got == wanted
    assert found(read_back(whole)) == naive(rows)


def test_query_writes_whole_examples(spark, monkeypatch):
    """What the query reports as formatted is what lies in its files."""
    kept = {}
    monkeypatch.setattr(chat, "stored", lambda df, name: kept.setdefault(name, stored(df, name)))
    rows = [(1, t, "assistant" if t % 2 else "user", "word " * 50) for t in range(200)]
    [row] = found(round_trip(spark.createDataFrame(rows, SCHEMA), segment=1000))
    assert kept["chat-examples"].agg(F.sum(F.length("text"))).first()[0] == row[-1] == naive(rows)[0][-1]


@pytest.mark.parametrize("segment", [1, 300, 16_384])
def test_read_back(spark, segment):
    rows = conversations(9) + PROBE + [(None, None, None, None), (None, 1, "assistant", "x"), (3, None, "user", "first")]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", *[f"1 AS {n}" for n in EXTRA])
    assert found(round_trip(df, segment=segment)) == naive(rows)


def test_hot_conversation_spreads_and_grows_in_proportion(spark):
    rows = [(5, t, "assistant" if t % 2 else "user", f"turn {t} " + "words " * 20) for t in range(4000)]
    rows += [(c, t, "assistant" if t % 2 else "user", "hello") for c in range(100, 400) for t in range(4)]
    # Left alone, adaptive execution would merge the small ranges again.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        examples = stored(expand(spark.createDataFrame(rows, SCHEMA).repartition(8), segment=4096), "hot")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    held = examples.withColumn("task", F.shiftright("seq", 32)).filter("conv_id = 5")
    stats = held.agg(F.countDistinct("task").alias("tasks"), F.sum(F.length("text")).alias("chars")).first()
    assert stats["tasks"] > 1 and stats["chars"] < 2000 * 2 * 4096
    assert found(read_back(examples)) == naive(rows)


def test_repeated_rows_are_repeated_turns(spark):
    rows = [(1, 0, "assistant", "same")] * 500 + [(2, 0, "user", "u")] * 3
    assert found(round_trip(spark.createDataFrame(rows, SCHEMA), segment=100)) == naive(rows)


def test_empty_table(spark):
    assert round_trip(spark.createDataFrame([], SCHEMA)).collect() == []


def test_sql_says_the_same(spark):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{folder}/conversations.parquet')")
    names = "conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars"
    theirs = con.execute(f"SELECT {names} FROM ({CHAT_SQL})").fetchall()
    rows = spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text")
    assert found(round_trip(rows.union(spark.createDataFrame(PROBE, SCHEMA)))) == sorted(theirs, key=str)
