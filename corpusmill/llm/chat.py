"""Chat formatting by incremental black-box rendering.

A template is any function from a list of (role, text) to a string. Successive prefixes of a conversation are
rendered; what a turn adds is the difference of two consecutive outputs, and the place of its text inside that span
comes from rendering the turn once more with a probe in place of the text. A template whose output for k + 1 turns
doesn't begin with its output for k turns rewrites history; it is detected and reported.

Rows of a conversation are read in order from sorted partitions. Of a template that is declared to be turn-local (its attribute
turn_local is true: what a turn adds depends on no turn before the last), prefixes restart at the last turn after WINDOW turns if it is
found to add the same to the shorter prefix, so that no conversation is held as a whole. Of others, all prefixes are rendered whole.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]
WINDOW = 32
PROBE = "\ue000probe\ue001"
#: Strings with a meaning in templates in common use; inside texts they are broken up by the escape.
CONTROL = ("<|im_start|>", "<|im_end|>", "<|system|>", "<|user|>", "<|assistant|>", "<|end|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
_TO_ESCAPE = re.compile(r"\\|" + "|".join(map(re.escape, CONTROL)))
_ESCAPED = re.compile(r"\\(\\?)")


def escape(text: str) -> str:
    """A backslash is doubled; a control string gets a backslash after its first character."""
    return _TO_ESCAPE.sub(lambda m: "\\\\" if m[0] == "\\" else f"{m[0][0]}\\{m[0][1:]}", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def marked(turns: list[Turn]) -> str:
    """The default template; roles are escaped too, with their line breaks as a backslash before n."""
    return "".join(f"<|im_start|>{escape(r).replace(chr(10), chr(92) + 'n')}\n{escape(t)}<|im_end|>\n" for r, t in turns)


marked.turn_local = True
_PIECE = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.DOTALL)


def parse(formatted: str) -> list[Turn]:
    """The turns of what the default template made."""

    def role(x: str) -> str:
        out, i = [], 0
        while i < len(x):
            if x[i] == "\\" and i + 1 < len(x) and x[i + 1] in "\\n":
                out.append("\\" if x[i + 1] == "\\" else "\n")
                i += 2
            else:
                out.append("" if x[i] == "\\" else x[i])
                i += 1
        return "".join(out)

    return [(role(r), unescape(t)) for r, t in _PIECE.findall(formatted)]


class Renderer:
    """Spans of one conversation's turns, one turn at a time."""

    def __init__(self, template: Template, window: int = WINDOW):
        self.template, self.window = template, window
        self.local = getattr(template, "turn_local", False)
        self.turns: list[Turn] = []
        self.out = ""
        self.offset = 0  # where the last output ends
        self.rewrites = False

    def push(self, role: str, text: str) -> tuple[str, int, int]:
        """What the turn adds, and where its text (as rendered) starts and ends in that."""
        before = self.out
        turns = [*self.turns, (role, text)]
        out = self.template(turns)
        if out.startswith(before):
            added = out[len(before) :]
        else:
            self.rewrites = True
            same = next((i for i, (a, b) in enumerate(zip(before, out)) if a != b), min(len(before), len(out)))
            added = out[same:]
            self.turns, self.out = turns, out
            return added, 0, 0
        probe = self.template([*self.turns, (role, PROBE)])
        probe = probe[len(before) :] if probe.startswith(before) else ""
        head, found, tail = probe.partition(PROBE)
        start, end = (len(head), len(added) - len(tail)) if found and added.startswith(head) and added.endswith(tail) else (0, 0)
        self.turns, self.out = turns, out
        self.offset += len(added)
        if self.local and len(turns) > self.window and not self.rewrites:
            short = self.template(turns[-1:])
            two = self.template(turns[-2:])
            if two.endswith(added) and two == self.template(turns[-2:-1]) + added:
                self.turns, self.out = turns[-1:], short
        return added, start, max(start, end)


FORMATTED = "conv_id long, turn_no long, role string, piece string, text_start long, text_end long, in_loss boolean, rewrites boolean"


def format_turns(conversations: DataFrame, template: Template = marked, loss_role: str = "assistant") -> DataFrame:
    """A row for each turn with what it adds to the formatted conversation, ordered inside partitions.

    Null texts and roles are empty; turns with null numbers come first; repeated rows and equal numbers all stay, in the
    order of role and text; a null conv_id is a conversation of its own. An empty table gives no rows.
    """
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    n = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(n, "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: object = run
        for b in batches:
            out: list[list] = [[] for _ in range(8)]
            for conv, role, text in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                if conv != last:
                    last, renderer, no = conv, Renderer(template), 0
                piece, start, end = renderer.push(role, text)
                for column, x in zip(out, (conv, no, role, piece, start, end, role == loss_role, renderer.rewrites), strict=True):
                    column.append(x)
                no += 1
            types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], [f.split(" ")[0] for f in FORMATTED.split(", ")])

    return map_arrow(rows, run, FORMATTED)


DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def digests(formatted: DataFrame) -> DataFrame:
    """Per conversation, what is read back from the rows of format_turns() in their order (made by the default template)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split(" ")[0] for f in DIGEST.split(", ")]
        schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
        state = None
        for b in batches:
            done = []
            for conv, piece, start, end, loss in zip(*(b.column(k).to_pylist() for k in (0, 3, 4, 5, 6)), strict=True):
                if state is None or state[0] != conv:
                    if state:
                        done.append(state)
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text in parse(piece):
                    state[1] += 1
                    state[2].update(f"{role}\n{text}\n".encode())
                if loss:
                    text = unescape(piece[start:end])
                    state[3] += len(text)
                    state[4].update(text.encode())
                state[5] += len(piece)
            if done:
                yield _rows(done, names, schema)
        if state:
            yield _rows([state], names, schema)

    return map_arrow(formatted, run, DIGEST)


def _rows(states: list[list], names: list[str], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([dict(zip(names, [c, n, t.hexdigest(), lc, lh.hexdigest(), f], strict=True)) for c, n, t, lc, lh, f in states], schema)
