"""Seeded prompts, and synthesis of instructions, answers and conversations through a pluggable teacher.

A teacher is a function from a prompt to a text; it may fail or give nothing. All that can be planned without it is a table. With
`log`, a folder that all executors share, calls run at once and answers are kept for tasks that start again (teacher.ask).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import render, rules
from . import dialogue, sampling
from . import teacher as calls

Teacher = Callable[[str], str]
#: Version names that mark what a row was made by.
VERSIONS = {"code": "synthetic-v1", "general": "general-v1", "conversation": "conversation-v1", "conceptual": "conceptual-v1", "hl7": "raw-hl7-v1"}


def _asked(plan: DataFrame, prompt: str, teacher: Teacher, least: int, retries: int, key: str | None, log: str | None) -> DataFrame:
    """plan with responses: one call after the other in each task, or, with a log, several at once and each answer kept."""
    if log is None:
        return sampling.synthesize(plan, prompt, teacher, least=least, retries=retries)
    if key is None:
        raise ValueError("a log needs the key of the rows")
    return calls.ask(plan, key, prompt, teacher, log, least=least, retries=retries)


def seed_of(domain: Column, pools: Mapping[str, Sequence[str]], default: str, *draw: Column) -> Column:
    """A drawn seed from the pool of a row's domain, or of the default domain where it has none."""
    out = rules.pick(pools[default], *draw)
    for name, pool in pools.items():
        out = F.when(domain == name, rules.pick(pool, *draw)).otherwise(out)
    return out


def instructions(plan: DataFrame, key: str, teacher: Teacher, pools: Mapping[str, Sequence[str]], default: str, context: str | None = None, retries: int = 2, log: str | None = None) -> DataFrame:
    """plan (with `domain`, and with a context column if it is named) and an instruction for each row, inspired by a seed. Where
    the teacher gives nothing, the seed itself is the instruction."""
    about = F.lit("") if context is None else F.concat(F.lit("Reference:\n"), F.substring(F.coalesce(context, F.lit("")), 1, 4000), F.lit("\n\n"))
    seeded = plan.withColumn("seed", seed_of(F.col("domain"), pools, default, F.col(key)))
    asked = seeded.withColumn("_prompt", F.concat(about, F.lit("Domain: "), "domain", F.lit("\nWrite one new request in the manner of: "), "seed"))
    answered = _asked(asked, "_prompt", teacher, -1, retries, key, log)
    return answered.withColumn("instruction", F.when(F.length("response") > 0, F.col("response")).otherwise(F.col("seed"))).drop("_prompt", "response")


def answers(plan: DataFrame, teacher: Teacher, with_trace: bool = True, version: str = VERSIONS["code"], least: int = 0, retries: int = 2, key: str | None = None, log: str | None = None) -> DataFrame:
    """plan (with `instruction`) with output, cot_trace (null without one) and version; rows without an answer go."""
    asked = plan.withColumn("_prompt", F.concat(F.lit("Think step by step first.\n\n" if with_trace else ""), F.lit("Request: "), "instruction"))
    got = _asked(asked, "_prompt", teacher, least, retries, key, log)
    parts = render.split_cot(F.col("response")) if with_trace else F.struct(F.lit(None).cast("string").alias("trace"), F.col("response").alias("answer"))
    return got.withColumn("output", parts["answer"]).withColumn("cot_trace", parts["trace"]).withColumn("version", F.lit(version)).drop("_prompt", "response")


def samples(plan: DataFrame, n: int, base: float = 0.3, step: float = 0.05) -> DataFrame:
    """Each row of plan n times, for as many completions: with its sample (from 0) and a temperature that rises by `step`."""
    rows = plan.withColumn("sample", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    return rows.withColumn("temperature", F.round(F.lit(base) + F.col("sample") * F.lit(step), 6))


def outline(description: Column, turns: Column) -> Column:
    """The prompt of a conversation from turns (role, summary)."""
    lines = F.array_join(F.transform(turns, lambda t: F.concat(F.lit("  "), F.upper(t["role"]), F.lit(": "), t["summary"])), "\n")
    return F.concat(F.lit("Scenario: "), description, F.lit("\nOutline:\n"), lines, F.lit("\nWrite the conversation. Each turn starts a line with USER: or ASSISTANT:"))


def conversations(plan: DataFrame, key: str, teacher: Teacher, retries: int = 2, log: str | None = None) -> DataFrame:
    """Of scenarios (key, domain, scenario_type, description, outline: array of role and summary) those whose conversation parses,
    with its turns."""
    asked = plan.withColumn("_prompt", outline(F.col("description"), F.col("outline")))
    got = _asked(asked, "_prompt", teacher, 0, retries, key, log)
    turns = dialogue.parse(got.select(key, "response"), key, "response")
    return plan.select(key, "domain", "scenario_type").join(turns, key).withColumn("version", F.lit(VERSIONS["conversation"]))


def prompt_plan(spark, kinds: Sequence[tuple[str, str, int, Sequence[Column | str], Mapping]], target: int, existing: int = 0, seed: int = 42) -> DataFrame:
    """category, item, prompt and domain: what remains of `target` prompts.

    Each kind (category, domain, count, templates, rules) has `count` prompts; a prompt's template is drawn, and its names are
    filled: by pools of texts, or by number rules. All are shuffled in a seeded order, and the first that remain are kept.
    """
    out = None
    for category, domain, count, templates, fill in kinds:
        item = F.col("item")
        of = [F.lit(f"{seed}:{category}"), item]
        numeric = bool(fill) and all(isinstance(v, tuple) and v and v[0] in ("int", "choice", "decimal", "sorted") for v in fill.values())
        filled = [rules.fill_numbers(t, fill, *of) if numeric else rules.fill_template(F.lit(t), fill, *of) for t in templates]
        which = F.pmod(rules.drawn(F.lit("template"), *of), F.lit(len(templates)))
        prompt = filled[0]
        for k, f in enumerate(filled[1:], 1):
            prompt = F.when(which == k, f).otherwise(prompt)
        rows = spark.range(count).select(F.lit(category).alias("category"), F.col("id").alias("item")).withColumn("prompt", prompt).withColumn("domain", F.lit(domain))
        out = rows if out is None else out.unionByName(rows)
    left = max(0, target - existing)
    return sampling.first_in_order(out.withColumn("_key", F.concat_ws(":", "category", "item")), "_key", left, seed=seed).drop("_key")


def distinct_prompts(prompts: DataFrame, prompt: str, n: int, seed: int = 42) -> DataFrame:
    """At most n different prompts, the first in a seeded order."""
    return sampling.first_in_order(prompts.select(prompt).distinct(), prompt, n, seed=seed)


def varied_prompts(prompts: DataFrame, prompt: str, n: int, variants: Sequence[tuple[str, str]] = rules.VARIANTS, seed: int = 42) -> DataFrame:
    """n prompts out of all prompts and their variants, each different one in turn, again and again if there are fewer."""
    all_ = prompts.select(F.explode(rules.variations(F.col(prompt), variants)).alias(prompt)).distinct()
    return sampling.cycled(all_, prompt, n, seed)
