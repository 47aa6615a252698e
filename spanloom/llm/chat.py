"""Chat formatting by event sourcing: log -> final messages -> one marked text.

Events are folded per (conversation, turn) first, so streamed deltas shrink
before anything is gathered by conversation. A conversation is then one value of
the output, and only that much is held at once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Control strings of the template.
OPEN, HEAD, BODY, CLOSE = "<s>", "[INST]", "[/INST]", "</s>"
CONTROL = re.compile("|".join(re.escape(c) for c in (OPEN, HEAD, BODY, CLOSE)))
TURN = re.compile(re.escape(OPEN + HEAD) + "(.*?)" + re.escape(BODY) + "(.*?)" + re.escape(CLOSE), re.DOTALL)
TRAINED = "assistant"


def escape(text: str) -> str:
    """No control string is left in the result, and ``unescape`` gives it back."""
    return CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: m[1], text, flags=re.DOTALL)


def render(messages: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The marked text and the loss mask: code-point spans of trained texts."""
    parts, spans, at = [], [], 0
    for role, text in messages:
        head, body = f"{OPEN}{HEAD}{escape(role)}{BODY}", escape(text)
        parts += (head, body, CLOSE)
        if role == TRAINED:
            spans.append((at + len(head), at + len(head) + len(body)))
        at += len(head) + len(body) + len(CLOSE)
    return "".join(parts), spans


def read_back(formatted: str) -> list[tuple[str, str]]:
    """The messages of a rendered text."""
    return [(unescape(role), unescape(text)) for role, text in TURN.findall(formatted)]


def fold_events(events: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) of the final messages.

    ``events`` has ``conv_id, seq, turn, role, kind, text``. Kinds: ``message``
    and ``edit`` set the text of their turn, ``regenerate`` empties it, ``delta``
    adds to it. An edit or regeneration also withdraws every later turn that was
    written before it. The role is that of the turn's first live event that has
    one, else that of its last event with one. Null texts and roles are empty; a null kind counts as ``message``;
    events of one ``seq`` apply in the order of kind (``delta`` last) and text.
    Null conversations, turns and sequence numbers are values of their own, the
    lowest. Repeated events apply again. Further columns are ignored.
    """
    e = events.select(
        "conv_id",
        "turn",
        F.coalesce(F.col("seq").cast("long"), F.lit(-(2**63))).alias("seq"),
        F.col("role"),
        F.coalesce("kind", F.lit("message")).alias("kind"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    # The last reset of each turn, carried on to all later turns: one row a turn.
    resets = e.groupBy("conv_id", "turn").agg(F.max(F.when(F.col("kind").isin("edit", "regenerate"), F.col("seq"))).alias("own"), F.max(F.when(F.col("kind").isin("message", "edit", "regenerate"), F.struct("seq", F.col("kind") != "message"))).alias("starts"), F.max(F.when(F.col("role").isNotNull(), F.struct("seq", "role"))).alias("named"))
    later = W.partitionBy("conv_id").orderBy("turn").rowsBetween(W.unboundedPreceding, -1)
    limits = resets.select(
        F.col("conv_id").alias("c"), F.col("turn").alias("t"), F.coalesce(F.max("own").over(later), F.lit(-(2**63))).alias("withdrawn"), F.coalesce(F.col("starts.seq"), F.lit(-(2**63))).alias("start"), F.col("named.role").alias("known")
    )
    joined = e.join(limits, e.conv_id.eqNullSafe(F.col("c")) & e.turn.eqNullSafe(F.col("t")))
    live = joined.filter((F.col("seq") >= F.col("withdrawn")) & (F.col("seq") >= F.col("start")))
    step = F.struct("seq", (F.col("kind") == "delta").alias("adds"), (F.col("kind") != "message").alias("after"), F.col("text"), F.col("role"), F.col("kind"))
    gathered = live.groupBy("conv_id", "turn").agg(F.array_sort(F.collect_list(step)).alias("steps"), F.max("known").alias("known"))
    text = F.aggregate(
        "steps",
        F.lit(""),
        lambda done, s: F.when(s["kind"] == "delta", F.concat(done, s["text"])).when(s["kind"] == "regenerate", F.lit("")).otherwise(s["text"]),
    )
    role = F.coalesce(F.get(F.filter(F.transform("steps", lambda s: s["role"]), lambda r: r.isNotNull()), F.lit(0)), F.col("known"), F.lit(""))
    return gathered.select("conv_id", "turn", role.alias("role"), text.alias("text"))


def format_conversations(messages: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss_spans) of ``conv_id, turn, role, text`` rows.

    Turns in order (ties by role, then text; null first); null texts and roles
    are empty; an empty table gives no row.
    """
    one = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    whole = messages.groupBy("conv_id").agg(F.sort_array(F.collect_list(one)).alias("turns"))
    conv = messages.select("conv_id").schema[0].dataType.simpleString()
    spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                formatted, found = render([(t["role"], t["text"]) for t in batch.column(1)[row].as_py()])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, 1), pa.array([formatted]), pa.array([[{"start": a, "end": b} for a, b in found]], spans)], names=["conv_id", "formatted", "loss_spans"])

    return whole.mapInArrow(run, f"conv_id {conv}, formatted string, loss_spans array<struct<start:bigint,end:bigint>>")
