"""Chat formatting: a finite-state machine over roles and a declarative template.

The template names an opening and a closing mark for each role and the roles that may follow each role. The machine walks
a conversation turn by turn, checks the order, and emits text segments, each with a loss flag. Marks inside texts
are broken by a backslash after their first character, backslashes are doubled; so no mark of the output stems
from a text, and reading gives the texts back.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridweave.llm.common import table
from gridweave.session import staging_path

#: A mark's first character is at no other place in any mark. So no mark can begin in a text and end in the mark after it.
#: `role` is the mark before the name of a role that the template does not list; `next` has the roles that may follow.
TEMPLATE = {
    "roles": {
        "system": {"open": "[SYS]", "close": "[/SYS]", "loss": False, "next": ["user"]},
        "user": {"open": "[INST]", "close": "[/INST]", "loss": False, "next": ["assistant"]},
        "assistant": {"open": "<s>", "close": "</s>", "loss": True, "next": ["user"]},
    },
    "other": {"open": "[TURN]", "role_end": "[ROLE]", "close": "[/TURN]", "loss": False, "next": []},
    "first": ["system", "user"],
}
SEGMENT_SCHEMA = "conv_id long, turn_number long, segment int, text string, loss boolean, valid boolean"


def marks_of(template: dict) -> list[str]:
    """All marks, longest first; fails on a template whose marks could be mistaken."""
    found = {t[k] for t in [*template["roles"].values(), template["other"]] for k in ("open", "close", "role_end") if k in t}
    firsts = {m[0] for m in found}
    if any(not m or "\\" in m or firsts & set(m[1:]) for m in found):
        raise ValueError("a mark's first character may be at no other place of a mark, and no mark may have a backslash")
    opens = [t["open"] for t in [*template["roles"].values(), template["other"]]]
    if len(set(opens)) < len(opens):
        raise ValueError("two roles have the same opening mark")
    return sorted(found, key=lambda m: (-len(m), m))


def codec(template: dict):
    """Functions that escape and unescape a text, and the pattern of a mark."""
    mark = re.compile("|".join(map(re.escape, marks_of(template))))
    risky = re.compile(r"\\|" + mark.pattern)
    escape = lambda text: risky.sub(lambda m: "\\\\" if m[0] == "\\" else m[0][0] + "\\" + m[0][1:], text)
    unescape = lambda text: re.sub(r"\\(.)", r"\1", text, flags=re.S)
    return escape, unescape, mark


def format_turn(template: dict, escape, before: str | None, role: str | None, text: str | None) -> tuple[list[tuple[str, bool]], bool]:
    """Segments of a turn, each with its loss flag, and whether `role` may follow `before` (None: at the start).

    A role that the template does not list, or none, is never in order and bears no loss; a null role reads back as "".
    """
    known = template["roles"].get(role)
    allowed = template["first"] if before is None else template["roles"].get(before, template["other"])["next"]
    rule = known or template["other"]
    body = (escape(text or ""), rule["loss"])
    head = [(rule["open"], False)] if known else [(rule["open"] + escape(role or "") + rule["role_end"], False)]
    return [*head, body, (rule["close"], False)], role in allowed


def parse_turns(template: dict, unescape, mark: re.Pattern, pieces: Iterator[tuple[str, bool]]) -> Iterator[tuple[str, str, str]]:
    """Formatted text in pieces with loss flags -> (role, text, text under the loss mask), by the same machine.

    It keeps one turn at a time. Fails on text outside turns, on marks out of order and on a turn that doesn't end.
    """
    by_open = {t["open"]: (role, t) for role, t in template["roles"].items()} | {template["other"]["open"]: (None, template["other"])}
    role, rule, text, lost = "", None, [], []
    for piece, loss in pieces:
        at = 0
        for m in [*mark.finditer(piece), None]:
            part = piece[at: m.start() if m else len(piece)]
            if part and rule is None:
                raise ValueError("text outside a turn")
            if part:
                text.append(part)
                lost += [part] if loss else []
            if m is None:
                break
            at = m.end()
            if loss:
                raise ValueError("a mark under the loss mask")
            if rule is None:
                if m[0] not in by_open:
                    raise ValueError("a turn that was not opened")
                (role, rule), text, lost = by_open[m[0]], [], []
            elif m[0] == rule.get("role_end") and role is None:
                role, text, lost = unescape("".join(text)), [], []
            elif m[0] == rule["close"] and role is not None:
                yield role, unescape("".join(text)), unescape("".join(lost))
                rule = None
            else:
                raise ValueError("a mark out of order")
    if rule is not None:
        raise ValueError("a turn that does not end")


def format_conversations(conversations: DataFrame, template: dict = TEMPLATE) -> DataFrame:
    """Segments of all conversations: `conv_id, turn_number, segment, text, loss, valid`.

    `valid` tells whether the turn follows the template's order; turns out of order are formatted like the others. Turns go
    by `turn` (nulls first), equal ones by role and text; repeated rows are turns of their own. Rows without a
    `conv_id` are one conversation. Turns pass one by one, so a conversation of any length needs little memory.
    """
    import pyarrow as pa

    schema = pa.schema([("conv_id", pa.int64()), ("turn_number", pa.int64()), ("segment", pa.int32()), ("text", pa.string()), ("loss", pa.bool_()), ("valid", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        escape, _, _ = codec(template)
        current, before, number, first = None, None, 0, True
        for batch in batches:
            out, size = [], 0
            for conv, role, text in zip(*(batch.column(i) for i in range(3)), strict=True):
                conv, role, text = conv.as_py(), role.as_py(), text.as_py()
                if first or conv != current:
                    current, before, number, first = conv, None, 0, False
                segments, valid = format_turn(template, escape, before, role, text)
                out += [(conv, number, k, s, loss, valid) for k, (s, loss) in enumerate(segments)]
                before, number = role or "", number + 1
                size += len(text or "")
                if size > 1 << 23:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
                    out, size = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    turns = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"), "role", "text")
    return turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text").mapInArrow(run, SEGMENT_SCHEMA)


def read_digests(segments: DataFrame, template: dict = TEMPLATE) -> DataFrame:
    """Digests of each conversation, from its formatted segments alone; hashes take turns as they come."""
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, unescape, mark = codec(template)
        length = 0

        def pieces() -> Iterator[tuple[int | None, str, bool]]:
            for batch in batches:
                yield from zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)

        stream = pieces()
        ahead = next(stream, None)

        def of(conv: int | None) -> Iterator[tuple[str, bool]]:
            nonlocal ahead, length
            while ahead is not None and ahead[0] == conv:
                text, loss = ahead[1] or "", ahead[2]
                length += len(text)
                yield text, loss
                ahead = next(stream, None)

        while ahead is not None:
            conv, length = ahead[0], 0
            turns, lost, n, chars = hashlib.sha256(), hashlib.sha256(), 0, 0
            for role, text, loss in parse_turns(template, unescape, mark, of(conv)):
                turns.update(f"{role}\n{text}\n".encode())
                lost.update(loss.encode())
                n, chars = n + 1, chars + len(loss)
            yield pa.RecordBatch.from_pydict({
                "conv_id": pa.array([conv], pa.int64()), "n_turns": pa.array([n], pa.int64()), "turns_sha256": [turns.hexdigest()],
                "loss_chars": pa.array([chars], pa.int64()), "loss_sha256": [lost.hexdigest()], "formatted_chars": pa.array([length], pa.int64())})

    ordered = segments.select("conv_id", "turn_number", "segment", "text", "loss").repartition("conv_id").sortWithinPartitions("conv_id", "turn_number", "segment")
    return ordered.select("conv_id", "text", "loss").mapInArrow(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def op8_chat(spark: SparkSession, folder: str) -> DataFrame:
    """All `conversations` and one that says marks, formatted, written, read back; one row per conversation."""
    tricky = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    segments = format_conversations(rows.unionByName(tricky))
    path = staging_path(spark, "chat")
    segments.write.parquet(path)
    return read_digests(spark.read.schema(SEGMENT_SCHEMA).parquet(path))


QUERIES = {"op8_chat": op8_chat}
#: What a conversation says, straight from the table; `formatted_chars` follows from the template's marks and escapes.
_ESCAPED = "text"
for _mark in marks_of(TEMPLATE):
    _ESCAPED = f"replace({_ESCAPED}, '{_mark}', '{_mark}_')"
ORACLES = {"op8_chat": rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), measured AS (
  SELECT *, length({_ESCAPED}) + length(text) - length(replace(text, '\', '')) + CASE role WHEN 'system' THEN 11
    WHEN 'user' THEN 13 WHEN 'assistant' THEN 7 ELSE 19 + length(role) END AS chars FROM turns
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM measured GROUP BY conv_id"""}
