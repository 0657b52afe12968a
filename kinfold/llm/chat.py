r"""Training examples from conversations: every assistant turn with all turns before it as context.

A turn is written ``### role: text </turn>`` and a line feed. Inside texts and roles a backslash goes
before every backslash, ``###`` and ``</turn>`` (in roles before ``:`` too), so reading is exact.

Examples of one conversation are prefixes of one another. The formatted conversation is first cut, before a
turn, into segments of about `segment` characters, and a row of :func:`expand` holds its segment from the
beginning to the end of its own turn. :func:`written_out` then gives every example the segments before its own,
as parts in rows of their own: each example is there in full, and no row or task holds more than a few segments,
however long the conversation. A conversation below one segment, as nearly all are, has each example whole in
one row. What is written grows with the square of a conversation's turns, as whole examples do. Only the reply of
an example's own turn is trainable.

The rows are sorted by ranges of conversation and turn, so a long conversation spreads over tasks; a
task begins with a new segment and holds no more than one. Copies of a segment are dealt by conversation, segment
and blocks of `ASKING` later segments.

Turns come in order of `turn`, nulls first; ties go by role, then by a hash of the text. Null text and null role are
empty; a null id is a conversation of its own. Repeated rows are repeated turns. Turns after the last
reply are kept in a row with nothing to train. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinfold.llm.shared import cut, plain, stored
from kinfold.plans.sizing import fits

REPLY = "assistant"
HEAD, COLON, END = "### ", ": ", " </turn>\n"
ROWS_SCHEMA = "conv_id bigint, seq bigint, text string, loss_begin bigint, loss_end bigint, closes boolean, before bigint"
#: Rows of one task are numbered from its number times this.
TASK_ROWS = 1 << 32
#: Segments whose examples get their copies of an earlier segment from one group of a join.
ASKING = 64
#: Characters of parsed turns that travel together when a conversation is read back.
BLOCK = 1 << 16

_CONTROL = re.compile(r"\\|###|</turn>")
_CONTROL_IN_ROLE = re.compile(r"\\|###|</turn>|:")
_ESCAPED = re.compile(r"\\(\\|###|</turn>|:)")
_ROLE = re.compile(r"### ((?:\\(?:\\|###|</turn>|:)|[^\\:])*): ")


def escape(text: str, role: bool = False) -> str:
    return (_CONTROL_IN_ROLE if role else _CONTROL).sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[1], text) if "\\" in text else text


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The turn as it stands in an example, and where its text lies in it."""
    head = HEAD + escape(role, True) + COLON
    body = escape(text)
    return head + body + END, len(head), len(head) + len(body)


def parse(formatted: str) -> list[tuple[str, str]]:
    """Role and text of every turn; anything but whole turns is an error."""
    turns, at = [], 0
    while at < len(formatted):
        role = _ROLE.match(formatted, at)
        # A text never holds the end as it stands: a backslash would be in it.
        end = formatted.find(END, role.end()) if role else -1
        if end < 0:
            raise ValueError(f"no turn begins at character {at}")
        turns.append((unescape(role[1]), unescape(formatted[role.end() : end])))
        at = end + len(END)
    return turns


def expand(conversations: DataFrame, *, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", segment: int = 16_384) -> DataFrame:
    """A row per example: conv_id, seq, text, loss_begin, loss_end (within the text), closes, before.

    `seq` orders all rows. A row that `closes` its segment holds the whole of it. The context of an
    example is the text of all closing rows of its conversation with a smaller `seq`, up to the one of
    its own segment, and its own text up to `loss_begin`; :func:`written_out` puts it there. `before` counts the segments
    of the conversation that the same task closed earlier. Rows without a reply of their own have null bounds.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() * TASK_ROWS
        current, held, size, before = None, [], 0, 0
        waiting: tuple | None = None  # the last turn of the segment, which may close it
        out: list[tuple] = []

        def leave(closes: bool) -> None:
            nonlocal number, waiting
            if waiting is not None and (closes or waiting[0] is not None):
                out.append((current, number, "".join(held), *waiting, closes, before))
                number += 1
            waiting = None

        def shown() -> pa.RecordBatch:
            types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.int64()]
            columns = [pa.array(c, t) for c, t in zip(zip(*out), types)]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, ["conv_id", "seq", "text", "loss_begin", "loss_end", "closes", "before"])

        written = 0
        for batch in batches:
            for conv, who, words in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                if waiting is not None:
                    # Whether the turn before closes its segment shows only now.
                    closes = conv != current or size >= segment
                    leave(closes)
                    written += size
                    if closes:
                        held.clear()
                        size, before = 0, before + 1 if conv == current else 0
                current = conv
                formatted, begin, end = format_turn(who, words)
                waiting = (size + begin, size + end) if who == REPLY else (None, None)
                held.append(formatted)
                size += len(formatted)
                if written >= 1 << 20:
                    written = 0
                    if out:
                        yield shown()
        leave(True)
        if out:
            yield shown()

    rows = plain(conversations, conv_id=id, turn=turn, role=role, text=text).select(
        F.col("conv_id").cast("bigint"),
        F.col("turn").cast("bigint"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    # Equal rows may go either way, so a row repeated without end does not fill one range.
    rows = rows.withColumns({"tie": F.xxhash64("text"), "salt": F.rand(11)})
    keys = ["conv_id", "turn", "role", "tie", "salt"]
    return rows.repartitionByRange(*keys).sortWithinPartitions(*keys[:4], "text").select("conv_id", "role", "text").mapInArrow(run, ROWS_SCHEMA)


def written_out(examples: DataFrame) -> DataFrame:
    """Every example in full: conv_id, seq, part, text, loss_begin, loss_end, last.

    The parts of an example have its `seq`; in order of `part` their texts are the whole of it. The last part is its own
    row of :func:`expand` and alone has bounds, within its text. `last` marks the parts of a conversation's last example,
    which has nothing to train if turns follow the last reply. `examples` is read more than once and must be stored.
    """
    task = F.shiftright("seq", 32)
    closed = examples.filter("closes").groupBy(F.col("conv_id").alias("c"), task.alias("t")).agg(F.count(F.lit(1)).alias("n"))
    conversation = Window.partitionBy("c")
    earlier = conversation.orderBy("t").rowsBetween(Window.unboundedPreceding, -1)
    closed = closed.withColumns({"segments": F.sum("n").over(conversation), "base": F.coalesce(F.sum("n").over(earlier), F.lit(0))})
    places = cut(closed.filter("segments > 1").drop("n"))
    places = F.broadcast(places) if fits(places) else places
    placed = examples.join(places, F.col("conv_id").eqNullSafe(F.col("c")) & (task == F.col("t")), "left")
    placed = placed.withColumn("part", F.coalesce("base", F.lit(0)) + F.when(F.col("segments").isNull(), 0).otherwise(F.col("before")))
    placed = placed.withColumn("last", F.col("closes") & (F.col("part") + 1 == F.coalesce("segments", F.lit(1))))
    # Segments that close without a reply are no examples of their own, but for the end of a conversation.
    own = placed.filter("loss_begin IS NOT NULL OR last").select("conv_id", "seq", "part", "text", "loss_begin", "loss_end", "last")
    asking = own.filter("part > 0").select(
        F.col("conv_id").alias("c"), "seq", "last", F.floor(F.col("part") / ASKING).alias("block"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("part") - 1)).alias("part")
    )
    blocks = F.sequence(F.floor((F.col("part") + 1) / ASKING), F.floor((F.col("segments") - 1) / ASKING))
    given = placed.filter("closes AND part + 1 < segments").select("conv_id", "text", F.col("part").alias("p"), F.explode(blocks).alias("b"))
    same = F.col("c").eqNullSafe(F.col("conv_id")) & (F.col("part") == F.col("p")) & (F.col("block") == F.col("b"))
    none = F.lit(None).cast("bigint")
    copies = asking.join(given, same).select("conv_id", "seq", "part", "text", none.alias("loss_begin"), none.alias("loss_end"), "last")
    return own.unionByName(copies)


def read_back(examples: DataFrame) -> DataFrame:
    """What stored examples hold, a row per conversation.

    conv_id, n_turns, turns_sha256 (role, line feed, text, line feed of each turn), loss_chars and
    loss_sha256 (all trainable text, unescaped), formatted_chars (of all examples with their whole
    contexts, and of the conversation itself if turns follow its last reply).

    `examples` come from :func:`written_out`: all their parts are read, and the turns of a conversation are those of
    its last example. Rows of :func:`expand` alone are read too; the characters of contexts are then reckoned.

    Tasks parse what lies in their splits and pass on blocks of many turns; a digest then takes the blocks of
    its conversation one by one, in order.
    """
    whole = "part" in examples.columns
    if whole:
        rows = examples.filter("loss_begin IS NOT NULL OR last").select("conv_id", "seq", "text", "loss_begin", "loss_end", F.col("last").alias("closes"), "part")
    else:
        rows = examples.select("conv_id", "seq", "text", "loss_begin", "loss_end", "closes", F.lit(0).cast("bigint").alias("part"))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "seq", "part", "turns", "n", "loss", "size", "replies", "ends", "rest"]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
        state: dict | None = None
        last = None

        def row() -> tuple:
            return (
                state["conv"], state["seq"], state["part"], "".join(state["turns"]), state["n"], "".join(state["loss"]),
                state["size"], state["replies"], state["ends"], state["rest"],
            )

        for batch in batches:
            out = []
            for conv, seq, text, begin, end, closes, part in zip(*(c.to_pylist() for c in batch.columns)):
                # A block ends with a segment, before each part of an example of many that ends a conversation, and
                # wherever the rows of a split do not follow one another.
                if state is not None and (seq != last + 1 or (closes and part > 0) or conv != state["conv"] or (state["fresh"] and state["held"] >= BLOCK)):
                    out.append(row())
                    state = None
                if state is None:
                    state = dict(conv=conv, seq=seq, part=part, turns=[], n=0, loss=[], size=0, replies=0, ends=0, rest=False, held=0, fresh=True)
                if begin is not None:
                    reply = unescape(text[begin:end])
                    state["loss"].append(reply)
                    state["held"] += len(reply)
                    state["replies"] += 1
                    state["ends"] += state["size"] + len(text)
                if closes:
                    turns = parse(text)
                    state["turns"] += [f"{who}\n{words}\n" for who, words in turns]
                    state["n"] += len(turns)
                    state["held"] += len(text)
                    state["size"] += len(text)
                    state["rest"] = begin is None
                state["fresh"], last = closes, seq
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(row()), types)], names)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        current: list | None = None  # conversation, turns, digest, loss characters, digest, formatted, length so far, open end

        def row() -> tuple:
            conv, n, turns, chars, loss, formatted, size, rest = current
            return conv, n, turns.hexdigest(), chars, loss.hexdigest(), formatted + (size if rest else 0)

        for batch in batches:
            out = []
            for conv, _, _, turns, n, loss, size, replies, ends, rest in zip(*(c.to_pylist() for c in batch.columns)):
                if current is None or conv != current[0]:
                    if current is not None:
                        out.append(row())
                    current = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0, False]
                current[1] += n
                current[2].update(turns.encode())
                current[3] += len(loss)
                current[4].update(loss.encode())
                current[5] += replies * current[6] + ends
                current[6] += size
                current[7] = rest if n else current[7]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
        if current is not None:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(row()), types)], names)

    parsed = rows.mapInArrow(
        blocks,
        "conv_id bigint, seq bigint, part bigint, turns string, n bigint, loss string, size bigint, replies bigint, ends bigint, rest boolean",
    )
    ordered = parsed.repartition("conv_id").sortWithinPartitions("conv_id", "seq", "part")
    found = ordered.mapInArrow(
        digest, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    )
    if not whole:
        return found
    sizes = examples.groupBy(F.col("conv_id").alias("c")).agg(F.sum(F.length("text")).alias("chars"))
    counted = found.join(sizes, F.col("conv_id").eqNullSafe(F.col("c")))
    return counted.select(*found.columns[:-1], F.col("chars").alias("formatted_chars"))


def round_trip(conversations: DataFrame, **options) -> DataFrame:
    """Write every example in full to shared storage and return what the files hold."""
    segments = stored(expand(conversations, **options), "chat-segments")
    return read_back(stored(written_out(segments), "chat-examples"))


#: A user and an assistant row that say what the template itself uses.
PROBE = [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]

CHAT_SQL = r"""WITH rows_ AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
sized AS (
  SELECT *, length('### : ' || regexp_replace(role, '(\\|###|</turn>|:)', '\\\1', 'g')
    || regexp_replace(text, '(\\|###|</turn>)', '\\\1', 'g') || ' </turn>' || chr(10)) AS size FROM rows_),
placed AS (
  SELECT *, sum(size) OVER w AS upto, row_number() OVER w AS n, count(*) OVER (PARTITION BY conv_id) AS total
  FROM sized WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(coalesce(sum(upto) FILTER (role = 'assistant' OR n = total), 0) AS BIGINT) AS formatted_chars
FROM placed GROUP BY conv_id"""
