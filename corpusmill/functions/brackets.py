"""Bracket balance as a reduction whose steps may be grouped in any way, in column expressions alone.

A stretch of brackets comes down to the closing ones that nothing in it opens, with their places, the opening ones that nothing in it
closes, and the first that meets a wrong one. Two neighbours merge by holding the end of the one's openers against the start of
the other's closers. Stretches of SPAN brackets are folded, then neighbours merge in pairs: n log n at any depth of nesting.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Brackets that are folded one by one before stretches merge in pairs.
SPAN = 32

_STRING = r"{q}[^{q}\\]*+(?:\\.[^{q}\\]*+)*+(?:{q}|\\?\z)"
#: What a text is made of: escapes, strings (unclosed ones reach the end), brackets, and all else.
_PIECE = r"(?s)\\(?:.|\z)|" + "|".join(_STRING.format(q=q) for q in "'\"`") + r"|[()\[\]{}]|[^()\[\]{}'\"`\\]++"


def _bound(value: Column, f) -> Column:
    """f of a value that is worked out once."""
    return F.transform(F.array(value), f)[0]


def _state(closers: Column, at: Column, openers: Column, wrong: Column, char: Column) -> Column:
    return F.struct(closers.alias("closers"), at.alias("at"), openers.alias("openers"), wrong.alias("wrong"), char.alias("char"))


def _one(c: Column, place: Column) -> Column:
    closes, none = c.isin(")", "]", "}"), F.array().cast("array<int>")
    return _state(F.when(closes, c).otherwise(""), F.when(closes, F.array(place)).otherwise(none), F.when(closes, "").otherwise(c), F.lit(0), F.lit(""))


def _merged(a: Column, b: Column) -> Column:
    """a followed by b; a where b is null. What follows a wrong bracket doesn't count."""
    met = F.least(F.length(a["openers"]), F.length(b["closers"]))
    want, have, over = F.translate(F.reverse(F.right(a["openers"], met)), "([{", ")]}"), F.left(b["closers"], met), F.length(b["closers"]) - met
    both = _state(F.concat(a["closers"], F.right(b["closers"], over)), F.concat(a["at"], F.slice(b["at"], met + 1, over)), F.concat(F.left(a["openers"], F.length(a["openers"]) - met), b["openers"]), b["wrong"], b["char"])
    differs = F.array_position(F.zip_with(F.split(want, ""), F.split(have, ""), lambda x, y: x == y), False).cast("int")
    broken = _bound(differs, lambda i: _state(a["closers"], a["at"], F.lit(""), F.element_at(b["at"], i), F.substring(b["closers"], i, F.lit(1))))
    return F.when(b.isNull() | (a["wrong"] > 0), a).when(want == have, both).otherwise(broken)


def _reduced(kept: Column) -> Column:
    none = _state(F.lit(""), F.array().cast("array<int>"), F.lit(""), F.lit(0), F.lit(""))

    def fold(span: Column, k: Column) -> Column:
        return F.aggregate(F.transform(F.split(span, ""), lambda c, i: _one(c, k * SPAN + i + 1)), none, _merged)

    def pairs(states: Column, _: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), ((F.size(states) - 1) / 2).cast("int")), lambda i: _merged(F.get(states, 2 * i), F.get(states, 2 * i + 1)))

    def rounds(spans: Column) -> Column:
        return F.aggregate(F.sequence(F.lit(0), F.ceil(F.log2(F.size(spans))).cast("int")), F.transform(spans, fold), pairs)[0]

    return F.when(kept == "", none).otherwise(_bound(F.regexp_extract_all(kept, F.lit(f".{{1,{SPAN}}}"), F.lit(0)), rounds))


def balance(text: Column) -> Column:
    """struct(left, nth): the brackets that stay open, or '!' and the first closing one that doesn't match, and which of all
    brackets outside strings that is (from 1; else 0). Null for a null text."""
    bare = F.regexp_replace(text, r"(?s)\\(?:.|\z)", "")
    bare = F.regexp_replace(bare, r"""'[^']*(?:'|\z)|"[^"]*(?:"|\z)|`[^`]*(?:`|\z)""", "")
    kept = F.regexp_replace(bare, r"[^()\[\]{}]+", "")

    def result(s: Column) -> Column:
        first = F.when(s["closers"] != "", F.struct(F.concat(F.lit("!"), F.left(s["closers"], F.lit(1))).alias("left"), s["at"][0].alias("nth")))
        return first.when(s["wrong"] > 0, F.struct(F.concat(F.lit("!"), s["char"]).alias("left"), s["wrong"].alias("nth"))).otherwise(F.struct(s["openers"].alias("left"), F.lit(0).alias("nth")))

    return F.when(text.isNotNull(), _bound(_reduced(kept), result))


def place(text: Column, nth: Column) -> Column:
    """struct(at, line) of the nth bracket outside strings: the characters before it, and its line from 1."""

    def step(s: Column, piece: Column) -> Column:
        bracket = piece.isin(*"()[]{}").cast("int")
        return F.when(s["seen"] >= nth, s).otherwise(F.struct((s["at"] + F.length(piece)).alias("at"), (s["seen"] + bracket).alias("seen")))

    start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("seen"))
    end = F.aggregate(F.regexp_extract_all(text, F.lit(_PIECE), F.lit(0)), start, step)

    def found(at: Column) -> Column:
        before = F.left(text, at)
        return F.struct(at.alias("at"), (F.length(before) - F.length(F.translate(before, "\n", "")) + 1).alias("line"))

    return F.when(text.isNotNull(), _bound(end["at"] - 1, found))
