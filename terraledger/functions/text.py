"""Blocks of braces in texts as Column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def block_values(text: Column, key: str) -> Column:
    """A map from each ``name = { ... }`` without inner braces to the word after ``key =`` in it; blocks without the key are left out, the last of a name stays."""
    inner = rf"\b{re.escape(key)}\s*=\s*(\w+)"
    blocks = F.regexp_extract_all(text, F.lit(r"(?m)(^[\w.-]+\s*=\s*\{[^{}]*)"), F.lit(1))
    named = F.transform(blocks, lambda b: F.struct(F.regexp_extract(b, r"^([\w.-]+)", 1).alias("k"), F.regexp_extract(F.regexp_extract(b, r"(?s)\{(.*)", 1), inner, 1).alias("v")))
    some = F.filter(named, lambda p: p["v"] != "")
    last = F.filter(some, lambda p, i: ~F.exists(F.slice(some, i + 2, F.size(some)), lambda q: q["k"] == p["k"]))
    return F.map_from_entries(last)


def block_span(text: Column, key: str) -> Column:
    """``{first, last}``: places (from 1) of the first ``key`` that opens a block and of the brace that closes it; missing where no such block closes.

    One pass over the characters from the opening brace with the depth as state, since
    nested braces are no regular language.
    """
    first = F.regexp_instr(text, F.lit(rf"(?m)^[ \t]*{re.escape(key)}\s*=\s*\{{"))
    rest = F.substring(text, first, F.length(text))
    start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("depth"), F.lit(0).alias("close"))

    def step(s: Column, c: Column) -> Column:
        depth = s["depth"] + F.when(c == "{", 1).when(c == "}", -1).otherwise(0)
        closes = (s["close"] == 0) & (c == "}") & (depth == 0)
        return F.struct((s["at"] + 1).alias("at"), depth.alias("depth"), F.when(closes, s["at"] + 1).otherwise(s["close"]).alias("close"))

    close = F.aggregate(F.split(rest, ""), start, step, lambda s: s["close"])
    return F.when((first > 0) & (close > 0), F.struct(first.alias("first"), (first + close - 1).alias("last")))
