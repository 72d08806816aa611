"""Many literals in one scan of a text: ordered replacement, and which groups of literals occur.

The literals of all rules are one Aho-Corasick automaton, made once in each Python worker. A text without any of them costs that
scan, however many rules there are.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructType


def _automaton(literals: Sequence[str]):
    """Of each literal that isn't empty, the numbers it has; None without any."""
    import ahocorasick

    numbers: dict[str, list[int]] = {}
    for k, x in enumerate(literals):
        if x:
            numbers.setdefault(x, []).append(k)
    if not numbers:
        return None
    out = ahocorasick.Automaton()
    for x, ks in numbers.items():
        out.add_word(x, (len(x), ks))
    out.make_automaton()
    return out


def _overlaps(a: str, b: str) -> bool:
    """Whether a beginning of one is an end of the other, or one stands in the other."""
    return a in b or b in a or any(a.endswith(b[:n]) or b.endswith(a[:n]) for n in range(1, min(len(a), len(b))))


class OrderedRules:
    """Replacements (literal, text) as if applied one after the other, each to all that the ones before left.

    `after[k]`: the later rules whose literal may come about where rule k has replaced something. `near[k]`: the rules whose
    literal may share characters with k's. Where nothing comes about by the rules that a text has, and none is near
    another, the places of the scan are replaced in one go. Else these rules, and those that may come about by them, go over the
    text in their order; all others can't match. A rule with an empty literal does nothing.
    """

    def __init__(self, pairs: Sequence[tuple[str, str]]):
        self.pairs, self.automaton = pairs, _automaton([a for a, _ in pairs])
        self.after = [[j for j in range(k + 1, len(pairs)) if pairs[j][0] and self._makes(new, pairs[j][0])] for k, (_, new) in enumerate(pairs)]
        self.near = [{j for j, (b, _) in enumerate(pairs) if j != k and a and b and _overlaps(a, b)} for k, (a, _) in enumerate(pairs)]

    @staticmethod
    def _makes(new: str, literal: str) -> bool:
        return _overlaps(new, literal) if new else len(literal) > 1

    def __call__(self, text: str) -> str:
        found = list(self.automaton.iter(text)) if self.automaton else []
        if not found:
            return text
        has = {k for _, (_, ks) in found for k in ks}
        if not any(self.after[k] or has & self.near[k] for k in has):
            return self._spliced(text, found)
        todo = set(has)
        for k in range(min(has), len(self.pairs)):
            if k in todo:
                before, text = text, text.replace(*self.pairs[k])
                if text != before:
                    todo.update(self.after[k])
        return text

    def _spliced(self, text: str, found: list) -> str:
        out, at = [], 0
        for last, (size, ks) in found:
            if last + 1 - size >= at:  # else it overlaps with itself
                out += text[at : last + 1 - size], self.pairs[ks[0]][1]
                at = last + 1
        return "".join([*out, text[at:]])


@lru_cache(maxsize=16)
def _rules(pairs: tuple[tuple[str, str], ...]) -> OrderedRules:
    return OrderedRules(pairs)


def replaced(text: Column, pairs: Sequence[tuple[str, str]]) -> Column:
    """As rules.replace_all(), for many rules: literal, case-sensitive replacements in order, where later ones see what earlier
    ones made. Null stays null; empty literals do nothing; rules of one literal follow each other."""
    fixed = tuple((a, b) for a, b in pairs)

    @F.pandas_udf(StringType())
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(_rules(fixed), na_action="ignore")

    return run(text)


class Groups:
    """Which groups have a literal in a text; the scan ends when all have."""

    def __init__(self, groups: Sequence[tuple[str, ...]]):
        self.size, flat = len(groups), [(g, x) for g, xs in enumerate(groups) for x in xs]
        self.always = {g for g, x in flat if not x}
        self.of = [g for g, _ in flat]
        self.automaton = _automaton([x for _, x in flat])

    def __call__(self, text: str) -> list[bool]:
        has = set(self.always)
        for _, (_, ks) in self.automaton.iter(text) if self.automaton else ():
            has.update(self.of[k] for k in ks)
            if len(has) == self.size:
                break
        return [g in has for g in range(self.size)]


@lru_cache(maxsize=16)
def _groups(groups: tuple[tuple[str, ...], ...]) -> Groups:
    return Groups(groups)


def occurring(text: Column, groups: Mapping[str, Sequence[str]]) -> Column:
    """A struct with a field for each group: whether any of its literals stands in the text (case counts). Null texts have null
    fields, groups without literals are false, and an empty literal stands in every text."""
    names, fixed = list(groups), tuple(tuple(x) for x in groups.values())
    kind = StructType()
    for n in names:
        kind = kind.add(n, BooleanType())

    @F.pandas_udf(kind)
    def run(texts: pd.Series) -> pd.DataFrame:
        found = [[None] * len(names) if t is None else _groups(fixed)(t) for t in texts]
        return pd.DataFrame(found, columns=names, dtype=object)

    return run(text)
