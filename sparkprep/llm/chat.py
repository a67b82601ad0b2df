"""Chat formatting with a black-box template.

The template is any function from a list of ``(role, text)`` to one string. Successive prefixes of a
conversation are rendered, and each output is compared with the one before: what was added is the
turn's span. An output that does not begin with the one before tells that the template rewrites
history. Where a text lies inside its turn is found by rendering the turn with two short probes.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkprep.llm.common import documents

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]

FORMATTED = (
    "conv_id bigint, formatted string, "
    "turns array<struct<role:string,start:bigint,end:bigint,text_start:bigint,text_end:bigint>>, "
    "first_rewrite bigint"
)


def escape(text: str) -> str:
    """Keep control strings out of a text: each of them begins with ``<``."""
    return text.replace("\\", "\\\\").replace("<", "\\<")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def turn_template(turns: list[Turn]) -> str:
    """``<turn>role<says>text</turn>`` for each turn; a single ``<`` is always a control string."""
    return "".join(f"<turn>{escape(r)}<says>{escape(t)}</turn>\n" for r, t in turns)


_TURN = re.compile(r"<turn>((?:[^<\\]|\\.)*)<says>((?:[^<\\]|\\.)*)</turn>\n", re.DOTALL)


def read_turns(formatted: str) -> list[Turn]:
    """The turns of a string that ``turn_template`` made."""
    return [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


def spans(template: Template, turns: list[Turn]) -> tuple[str, list[tuple], int | None]:
    """The rendered conversation, each turn's span and text span, and the first turn that rewrites.

    Spans are half-open, in code points of the last output. From the first turn on whose output
    does not extend the one before, spans are NULL: the parts then can't be told apart.
    """
    whole, found, rewrite = template([]), [], None
    for k, (role, _) in enumerate(turns, 1):
        before, whole = whole, template(turns[:k])
        if rewrite is None and not whole.startswith(before):
            rewrite = k - 1
        if rewrite is None:
            probes = [template([*turns[: k - 1], (role, probe)]) for probe in ("a", "b")]
            head = len(os.path.commonprefix([p[len(before) :] for p in probes]))
            tail = len(probes[0]) - len(before) - head - 1
            inner = (len(before) + head, len(whole) - tail)
            found.append((role, len(before), len(whole), *inner))
        else:
            found.append((role, None, None, None, None))
    return whole, found, rewrite


def _conversations(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int | None, list[Turn]]]:
    """Conversations of rows that are sorted by ``conv_id`` and turn."""
    last, turns = None, []
    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")))
        for conv, role, text in rows:
            if turns and conv != last:
                yield last, turns
                turns = []
            last = conv
            turns.append((role, text))
    if turns:
        yield last, turns


def format_conversations(
    rows: DataFrame, template: Template = turn_template, rows_out: int = 256
) -> DataFrame:
    """One row for each conversation: ``conv_id``, ``formatted``, ``turns``, ``first_rewrite``.

    Turns are in the order of ``turn``, NULL first; equal ones by role and text. A NULL text or role
    is empty, and rows without ``conv_id`` are one conversation. Rows of a conversation meet in one
    task, since its string is one value; rendering n turns renders O(n) prefixes. Other columns are
    not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("role", "start", "end", "text_start", "text_end")
        kinds = [pa.field("role", pa.string()), *(pa.field(n, pa.int64()) for n in names[1:])]
        schema = pa.schema(
            [
                ("conv_id", pa.int64()),
                ("formatted", pa.string()),
                ("turns", pa.list_(pa.struct(kinds))),
                ("first_rewrite", pa.int64()),
            ]
        )
        out: list[dict] = []
        for conv, turns in _conversations(batches):
            text, found, rewrite = spans(template, turns)
            marked = [dict(zip(names, t)) for t in found]
            out.append(
                {"conv_id": conv, "formatted": text, "turns": marked, "first_rewrite": rewrite}
            )
            if len(out) == rows_out:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    turns = rows.select(F.col("conv_id").cast("long"), "turn", text("role"), text("text"))
    by_turn = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return by_turn.select("conv_id", "role", "text").mapInArrow(run, FORMATTED)


def read_back(formatted: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """Digests of what the formatted strings say; the loss mask is the texts of ``loss_role``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                text = row["formatted"]
                turns = read_turns(text)
                said = "".join(f"{role}\n{body}\n" for role, body in turns)
                loss = "".join(
                    unescape(text[t["text_start"] : t["text_end"]])
                    for t in row["turns"]
                    if t["role"] == loss_role and t["text_start"] is not None
                )
                out.append(
                    {
                        "conv_id": row["conv_id"],
                        "n_turns": len(turns),
                        "turns_sha256": hashlib.sha256(said.encode()).hexdigest(),
                        "loss_chars": len(loss),
                        "loss_sha256": hashlib.sha256(loss.encode()).hexdigest(),
                        "formatted_chars": len(text),
                    }
                )
            yield pa.RecordBatch.from_pylist(out, schema)

    schema = pa.schema(
        [
            ("conv_id", pa.int64()),
            ("n_turns", pa.int64()),
            ("turns_sha256", pa.string()),
            ("loss_chars", pa.int64()),
            ("loss_sha256", pa.string()),
            ("formatted_chars", pa.int64()),
        ]
    )
    kinds = (
        "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, "
        "loss_sha256 string, formatted_chars bigint"
    )
    return formatted.mapInArrow(run, kinds)


CONTROL_TEXT = "\\### Assistant: </turn> ok"


def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one (-7) whose texts hold control strings, formatted and read back."""
    columns = ("conv_id", "turn", "role", "text")
    given = documents(spark, sf_dir, "conversations").select(*columns)
    planted = [(-7, 0, "user", CONTROL_TEXT), (-7, 1, "assistant", CONTROL_TEXT)]
    planted = spark.createDataFrame(planted, "conv_id bigint, turn bigint, role string, text string")
    return read_back(format_conversations(given.unionByName(planted)))
