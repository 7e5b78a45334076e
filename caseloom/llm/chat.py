"""Chat formatting by event-sourced reconstruction.

A conversation is a log of events. Two sorted streams rebuild and render it:

1. events dealt by (conversation, message) and sorted by sequence: deltas,
   edits, regenerations and deletions fold into one final text a message, so
   even one huge conversation spreads over many tasks;
2. final messages dealt by conversation and sorted: each becomes one rendered
   segment. A task holds one message at a time, never a conversation.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n`` a turn. A control string
inside a role or text gets a backslash after its first character, a backslash
is doubled, and a newline in a role becomes backslash n; ``unescape`` inverts
this. So control strings in the output are always the template's own.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.llm.common import arrow_type, batches_of, rows_of
from caseloom.session import table

START, END = "<|im_start|>", "<|im_end|>"
#: Control strings of common chat templates; other <|...|> marks are matched by shape.
_CONTROL = re.compile(r"\\|<\|[A-Za-z0-9_]+\|>|</?s>|<pad>|<unk>|\[/?INST\]|<</?SYS>>|</?think>|<(?:start|end)_of_turn>|<[be]os>")
_ESCAPED = re.compile(r"\\(.)", re.S)
_TURN = re.compile(re.escape(START) + r"([^\n]*)\n(.*?)" + re.escape(END) + r"\n", re.S)
#: Event kinds in the order in which events of one sequence number apply.
KINDS = ("message", "regenerate", "edit", "delta", "delete")
LOSS_ROLES = ("assistant",)
SEGMENTS = "conv_id {kind}, turn_no long, role string, segment string, loss_start long, loss_end long"
DIGESTS = "conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: "\\" if m[1] == "\\" else m[1], text)


def escape_role(role: str) -> str:
    return escape(role).replace("\n", "\\n")


def unescape_role(role: str) -> str:
    return _ESCAPED.sub(lambda m: {"\\": "\\", "n": "\n"}.get(m[1], m[1]), role)


def turn_events(conversations: DataFrame, conv="conv_id", turn="turn", role="role", text="text") -> DataFrame:
    """Finished turns as events: each row opens a message of its own."""
    return conversations.select(F.col(conv).alias("conv_id"), F.col(turn).alias("message"), F.col(turn).alias("seq"), F.lit("message").alias("kind"), F.col(role).alias("role"), F.col(text).alias("text"))


def fold(events: Iterable[tuple]) -> Iterator[tuple]:
    """(conv, message, seq, kind, role, text) in order -> final (conv, message, seq, role, text).

    message opens one (again for one message number: another message); delta
    appends; edit replaces; regenerate empties; delete removes. Events before
    any opening open one themselves. A null text adds nothing.
    """
    key, parts, role, seq = None, None, "", None
    for conv, message, at, kind, who, text in events:
        if key is not None and ((conv, message) != key or kind == "message"):
            if parts is not None:
                yield (*key, seq, role, "".join(parts))
            key = None
        if key is None:
            key, parts, role, seq = (conv, message), [], who, at
        if kind == "delete":
            parts = None
            continue
        if kind in ("edit", "regenerate", "message") or parts is None:
            parts = []
        role = who or role
        parts.append(text or "")
    if key is not None and parts is not None:
        yield (*key, seq, role, "".join(parts))


def final_messages(events: DataFrame) -> DataFrame:
    """Fold an event log (conv_id, message, seq, kind, role, text).

    A null kind counts as message, a null role as empty. Ties of seq apply in
    the order of ``KINDS``, then role and text; unknown kinds fail.
    """
    kind = F.coalesce(F.lower("kind"), F.lit("message"))
    order = F.array_position(F.array(*map(F.lit, KINDS)), kind)
    events = events.select("conv_id", F.col("message").cast("long"), F.col("seq").cast("long"), F.when(order > 0, kind).otherwise(F.raise_error(F.lit("unknown event kind"))).alias("kind"), "role", "text", order.alias("nth"))
    dealt = events.repartition("conv_id", "message").sortWithinPartitions("conv_id", "message", "seq", "nth", "role", "text").drop("nth")

    types = [arrow_type(events, "conv_id"), pa.int64(), pa.int64(), pa.string(), pa.string()]

    def run(batches):
        yield from batches_of(fold(rows_of(batches)), ["conv_id", "message", "seq", "role", "text"], types, 4)

    return dealt.mapInArrow(run, f"conv_id {_kind(events)}, message long, seq long, role string, text string")


def _kind(df: DataFrame) -> str:
    return df.schema["conv_id"].dataType.simpleString()


def render(messages: DataFrame, loss_roles: tuple[str, ...] = LOSS_ROLES) -> DataFrame:
    """Segments in order: (conv_id, turn_no, role, segment, loss_start, loss_end).

    A conversation's formatted text is its segments joined by turn_no; the
    loss span counts code points from the conversation's start and holds the
    escaped text of a turn whose role is in ``loss_roles``, else it is empty.
    Output partitions hold whole conversations, sorted.
    """
    dealt = messages.select("conv_id", "message", "seq", "role", "text").repartition("conv_id").sortWithinPartitions("conv_id", "message", "seq", "role", "text")

    def segments(rows):
        first, conv, n, at = True, None, 0, 0
        for c, _, _, role, text in rows:
            if first or c != conv:
                first, conv, n, at = False, c, 0, 0
            role, text = role or "", text or ""
            head, body = f"{START}{escape_role(role)}\n", escape(text)
            segment = f"{head}{body}{END}\n"
            lo = at + len(head)
            yield c, n, role, segment, lo, lo + (len(body) if role in loss_roles else 0)
            n, at = n + 1, at + len(segment)

    types = [arrow_type(messages, "conv_id"), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()]

    def run(batches):
        yield from batches_of(segments(rows_of(batches)), ["conv_id", "turn_no", "role", "segment", "loss_start", "loss_end"], types, 3)

    return dealt.mapInArrow(run, SEGMENTS.format(kind=_kind(messages)))


def format_conversations(events: DataFrame, loss_roles: tuple[str, ...] = LOSS_ROLES) -> DataFrame:
    """Event log -> rendered segments. Empty logs give no rows."""
    return render(final_messages(events), loss_roles)


def read_back(segments: DataFrame) -> DataFrame:
    """Digests of each conversation, parsed from rendered segments.

    ``segments`` must come as ``render`` leaves them: conversations whole in
    a partition and sorted by turn_no.
    """

    def digests(rows):
        first, conv, turns, loss, n, chars, total = True, None, None, None, 0, 0, 0
        for c, _, _, segment, lo, hi in rows:
            if first or c != conv:
                if not first:
                    yield conv, n, turns.hexdigest(), chars, loss.hexdigest(), total
                first, conv, n, chars, total = False, c, 0, 0, 0
                turns, loss = hashlib.sha256(), hashlib.sha256()
            m = _TURN.fullmatch(segment)
            if not m:
                raise ValueError("a segment does not parse")
            turns.update(f"{unescape_role(m[1])}\n{unescape(m[2])}\n".encode("utf-8", "surrogatepass"))
            masked = unescape(segment[lo - total : hi - total])
            loss.update(masked.encode("utf-8", "surrogatepass"))
            n, chars, total = n + 1, chars + len(masked), total + len(segment)
        if not first:
            yield conv, n, turns.hexdigest(), chars, loss.hexdigest(), total

    types = [arrow_type(segments, "conv_id"), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def run(batches):
        yield from batches_of(digests(rows_of(batches)), ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"], types, 2)

    return segments.mapInArrow(run, DIGESTS.format(kind=_kind(segments)))


PROBE = "</s>[INST] ok [/INST]"


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    talk = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-1, 0, "user", PROBE), (-1, 1, "assistant", PROBE)], "conv_id long, turn long, role string, text string")
    return read_back(format_conversations(turn_events(talk.unionByName(probe))))


QUERIES = {"op1_chat_format": op1_chat_format}
_RE = r"'(\\|<\|[A-Za-z0-9_]+\|>|</?s>|<pad>|<unk>|\[/?INST\]|<</?SYS>>|</?think>|<(?:start|end)_of_turn>|<[be]os>)'"
ORACLE_SQL = {
    "op1_chat_format": f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '{PROBE}'), (-1, 1, 'assistant', '{PROBE}')
), sized AS (
  SELECT *, length(role) + len(regexp_extract_all(role, {_RE})) + length(role) - length(replace(role, chr(10), ''))
            + length(text) + len(regexp_extract_all(text, {_RE})) + {len(START) + len(END) + 2} AS chars,
         CASE WHEN role = 'assistant' THEN text ELSE '' END AS loss
  FROM rows
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       sum(length(loss))::BIGINT AS loss_chars,
       sha256(string_agg(loss, '' ORDER BY turn, role, text)) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""
}
