"""Chat templates as column expressions, and their inverse."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip

SYSTEM = "You are a helpful assistant for integration engineers."
#: Per template: start of text, opening of a role, closing of a turn, what follows a turn of a dialogue.
TEMPLATES = {
    "llama": ("<|begin_of_text|>", "<|start_header_id|>{role}<|end_header_id|>\n\n", "<|eot_id|>", ""),
    "chatml": ("", "<|im_start|>{role}\n", "<|im_end|>", "\n"),
}


def _head(template: str, role: Column | str) -> Column:
    before, after = TEMPLATES[template][1].split("{role}")
    return F.concat(F.lit(before), F.lit(role) if isinstance(role, str) else role, F.lit(after))


def single_turn(instruction: Column, extra: Column, output: Column, cot: Column | None = None, template: str = "llama", system: str = SYSTEM) -> Column:
    """System, user (the input after a blank line) and assistant turn (a trace in think tags before the answer)."""
    begin, _, end, _ = TEMPLATES[template]
    joint = F.lit("\n" if template == "chatml" else "")
    user = F.when(F.coalesce(extra, F.lit("")) != "", F.concat(instruction, F.lit("\n\n"), extra)).otherwise(instruction)
    answer = output if cot is None else F.when(F.coalesce(cot, F.lit("")) != "", F.concat(F.lit("<think>\n"), cot, F.lit("\n</think>\n\n"), output)).otherwise(output)
    return F.concat(F.lit(begin), _head(template, "system"), F.lit(system + end), joint, _head(template, "user"), user, F.lit(end), joint, _head(template, "assistant"), answer, F.lit(end))


def turn(role: Column, content: Column, template: str = "llama") -> Column:
    _, _, end, after = TEMPLATES[template]
    return F.concat(_head(template, role), content, F.lit(end + after))


def dialogue(turns: Column, template: str = "llama", system: str | None = SYSTEM) -> Column:
    """An array of (role, content); a system turn is put first unless it is None."""
    first = [turn(F.lit("system"), F.lit(system), template)] if system is not None else []
    return F.concat(F.lit(TEMPLATES[template][0]), *first, F.array_join(F.transform(turns, lambda t: turn(t["role"], t["content"], template)), ""))


def inference_prompt(turns: Column, template: str = "llama") -> Column:
    """A dialogue without a system turn of its own, with the assistant's turn left open."""
    return F.concat(dialogue(turns, template, None), _head(template, "assistant"))


def user_prompt(text: Column) -> Column:
    """The first user block of a rendered text, stripped; else its first 500 characters."""
    pattern = r"(?s)<\|start_header_id\|>user<\|end_header_id\|>\n\n(.*?)<\|eot_id\|>"
    return F.when(text.rlike(pattern), strip(F.regexp_extract(text, pattern, 1))).otherwise(F.substring(text, 1, 500))


def split_cot(text: Column) -> Column:
    """struct(trace, answer): what stands before the first closing think tag, without the tag, and the stripped rest."""
    has = text.contains("<think>") & text.contains("</think>")
    at = F.instr(text, "</think>")
    trace = F.when(has, strip(F.replace(F.substring(text, F.lit(1), at - 1), F.lit("<think>"), F.lit(""))))
    return F.struct(trace.alias("trace"), F.when(has, strip(F.substring(text, at + 8, F.length(text)))).otherwise(text).alias("answer"))
