"""Tool-call linking for chat rows, in DataFrame functions only.

Calls and results are hash-joined by conversation and identifier, put in
topological order, checked against parameter schemas, and serialised as canonical
JSON, one line a conversation.

Where calls come from.  A turn whose text is a JSON object with a list ``tool_calls``
(of ``{"id", "name", "arguments": {..}}``; arguments may be an object or a string that
holds one) holds calls; a turn of role ``tool`` whose text is ``{"tool_call_id",
"content"}`` holds a result.  Any other text, broken JSON too, is plain chat, which has
neither: with ``as_calls=True`` each assistant turn is read as the result of a
``respond`` call that the turn before it makes, its arguments being the role and
the text, so every conversation goes through the same join, order and check.

Values keep the JSON type that they are written with (a number without a fraction is
an integer); plain chat is text whatever it looks like, and refers to nothing.

Order.  A call depends on the calls whose results it refers to (a string
``$<id>`` anywhere in its arguments, keys apart) and on nothing else; its level is
the longest chain below it, found in rounds, each over the referring calls that are
still open.  Links are ordered by level, turn
and place in the turn.

Defined cases: a call without a result, and a result without a call, stay, with
status ``unanswered`` or ``orphan``; calls and results without an identifier link
with nothing; a repeated identifier pairs the n-th call
with the n-th result; arguments that miss a required field, or have one of
another type (null is a type) or unknown, or are no object, give ``invalid`` with the
reasons in order; an unknown
tool is ``unknown_tool``; a null conversation or text counts as empty text of
conversation null, which is kept as one group; calls in a cycle get status
``cyclic``; extra columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terraledger.sources.lineage import written

#: What each tool takes: field -> (JSON type, required).
SCHEMAS: dict[str, dict[str, tuple[str, bool]]] = {"respond": {"role": ("string", True), "text": ("string", True)}}

#: Turns that are numbered together.
STRETCH = 64


def quoted(text: Column) -> Column:
    """A JSON string literal in its shortest form."""
    out = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    for raw, short in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"), ("\b", "\\b"), ("\f", "\\f")):
        out = F.replace(out, F.lit(raw), F.lit(short))
    for code in (*range(8), 11, *range(14, 32)):
        out = F.replace(out, F.lit(chr(code)), F.lit(f"\\u{code:04x}"))
    return F.concat(F.lit('"'), out, F.lit('"'))


def spelled(json: Column) -> Column:
    """JSON text with the control characters spelled as ``quoted`` spells them, so that a value has one form."""
    out = json
    for code in (11, *range(14, 32)):
        if f"{code:04x}" != f"{code:04X}":
            # an even number of backslashes before it: the escape is one, and no text about one
            out = F.regexp_replace(out, rf"(?<!\\)((?:\\\\)*)\\u{code:04X}", rf"$1\\u{code:04x}")
    return F.when(F.contains(json, F.lit("\\u00")), out).otherwise(json)


def json_type(value: str) -> str:
    """SQL of the JSON type of a variant value."""
    schema = f"schema_of_variant({value})"
    return f"""CASE WHEN {schema} = 'BIGINT' OR {schema} LIKE 'DECIMAL(%,0)' THEN 'integer' WHEN {schema} LIKE 'DECIMAL%' OR {schema} IN ('DOUBLE', 'FLOAT') THEN 'number'
        WHEN {schema} = 'BOOLEAN' THEN 'boolean' WHEN {schema} LIKE 'OBJECT%' THEN 'object' WHEN {schema} LIKE 'ARRAY%' THEN 'array' WHEN {schema} = 'VOID' THEN 'null' ELSE 'string' END"""


#: An argument: its key, its JSON type, its canonical JSON, and the identifiers that it refers to.
_ENTRY = "struct<key:string,type:string,json:string,refs:array<string>>"
#: A string in JSON without spaces, with the colon that tells a key.
_STRING = r'"(?:[^"\\]|\\.)*":?'


def references(json: Column) -> Column:
    """The identifiers that strings ``$<id>`` anywhere in a JSON value name, keys apart."""
    strings = F.filter(F.regexp_extract_all(json, F.lit(_STRING), F.lit(0)), lambda t: F.startswith(t, F.lit('"$')) & ~F.endswith(t, F.lit('":')))
    return F.transform(strings, lambda t: F.substring(F.try_variant_get(F.try_parse_json(t), "$", "string"), 2, 1 << 30))


def entries(arguments: str) -> Column:
    """The arguments of a variant object, in the order of their keys; null where it is no object."""
    held = f"map_entries(try_variant_get({arguments}, '$', 'map<string,variant>'))"
    plain = F.expr(f"transform({held}, e -> struct(e.key AS key, {json_type('e.value')} AS type, to_json(e.value) AS json))")
    typed = F.transform(plain, lambda e: F.struct(e["key"].alias("key"), e["type"].alias("type"), spelled(e["json"]).alias("json")))
    return F.array_sort(F.transform(typed, lambda e: F.struct(e["key"].alias("key"), e["type"].alias("type"), e["json"].alias("json"), references(e["json"]).alias("refs"))))


def turns(df: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text)`` with null texts as empty."""
    return df.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))


def extract(rows: DataFrame, *, as_calls: bool = True) -> tuple[DataFrame, DataFrame]:
    """Calls ``(conv_id, id, turn, place, name, arguments)`` and results ``(conv_id, id, turn, content, content_json)``.

    ``arguments`` are entries as ``entries`` gives them, null where they are no object.
    """
    parsed = rows.withColumn("_v", F.expr("CASE WHEN startswith(ltrim(text), '{') THEN try_parse_json(text) END"))
    parsed = parsed.withColumn("_calls", F.expr("try_variant_get(_v, '$.tool_calls', 'array<variant>')"))
    parsed = parsed.withColumn("_answers", (F.col("role") == "tool") & F.col("_calls").isNull() & F.coalesce(F.expr("schema_of_variant(try_variant_get(_v, '$.tool_call_id')) <> 'VOID'"), F.lit(False)))
    called = parsed.where("_calls is not null").select("conv_id", "turn", F.posexplode("_calls").alias("place", "c"))
    called = called.withColumn("_given", F.expr("try_variant_get(c, '$.arguments')"))
    called = called.withColumn("_given", F.expr("coalesce(CASE WHEN schema_of_variant(_given) = 'STRING' THEN try_parse_json(try_variant_get(_given, '$', 'string')) END, _given)"))
    given = F.when(F.col("_given").isNull(), F.array().cast(f"array<{_ENTRY}>")).otherwise(entries("_given"))
    calls = called.select("conv_id", F.expr("try_variant_get(c, '$.id', 'string')").alias("id"), "turn", "place", F.expr("try_variant_get(c, '$.name', 'string')").alias("name"), given.alias("arguments"))
    said = parsed.where("_answers").withColumn("_said", F.expr("try_variant_get(_v, '$.content')"))
    words, raw = F.expr("try_variant_get(_said, '$', 'string')"), spelled(F.expr("to_json(_said)"))
    plain_text = F.expr("schema_of_variant(_said) = 'STRING'")
    results = said.select("conv_id", F.expr("try_variant_get(_v, '$.tool_call_id', 'string')").alias("id"), "turn", F.when(plain_text, words).otherwise(raw).alias("content"), F.when(plain_text, quoted(words)).otherwise(raw).alias("content_json"))
    if as_calls:
        plain = parsed.where(F.col("_calls").isNull() & ~F.col("_answers"))
        name = F.concat(F.lit("t"), F.coalesce(F.col("turn").cast("string"), F.lit("")))
        field = lambda key: F.struct(F.lit(key).alias("key"), F.lit("string").alias("type"), quoted(F.col(key)).alias("json"), F.array().cast("array<string>").alias("refs"))
        asks = plain.where("role <> 'assistant'").select("conv_id", name.alias("id"), "turn", F.lit(0).alias("place"), F.lit("respond").alias("name"), F.array(field("role"), field("text")).cast(f"array<{_ENTRY}>").alias("arguments"))
        gives = plain.where("role = 'assistant'").select("conv_id", F.concat(F.lit("t"), F.coalesce((F.col("turn") - 1).cast("string"), F.lit(""))).alias("id"), "turn", F.col("text").alias("content"), quoted(F.col("text")).alias("content_json"))
        calls, results = calls.unionByName(asks), results.unionByName(gives)
    return calls, results


def nth(df: DataFrame, *order: str) -> DataFrame:
    """``df`` with ``nth``: the place of a row among those of its conversation and identifier.

    Rows without an identifier link with nothing, so they are spread by their contents
    and not gathered.
    """
    spread = F.when(F.col("id").isNull(), F.xxhash64(*order))
    return df.withColumn("nth", F.row_number().over(Window.partitionBy("conv_id", "id", spread).orderBy(*order)))


def _named(field: str) -> Callable[[Column], Column]:
    return lambda e: e["key"] == field


def problems(name: Column, arguments: Column, schemas: dict[str, dict[str, tuple[str, bool]]]) -> Column:
    """What is wrong with a call's arguments, in the order of the fields."""
    out = F.array(F.lit("unknown_tool"))
    for tool, fields in schemas.items():
        found = []
        for field, (kind, needed) in sorted(fields.items()):
            held = F.get(F.filter(arguments, _named(field)), F.lit(0))["type"]
            fits = held.isin("integer", "number") if kind == "number" else held == kind
            found.append(F.when(held.isNull(), F.lit(f"missing:{field}") if needed else None).when(~fits, F.lit(f"type:{field}")))
        known = F.array(*[F.lit(f) for f in fields]) if fields else F.array().cast("array<string>")
        extra = F.transform(F.array_sort(F.array_except(F.transform(arguments, lambda e: e["key"]), known)), lambda f: F.concat(F.lit("unknown:"), f))
        checked = F.concat(F.array_compact(F.array(*found).cast("array<string>")), extra)
        out = F.when(name == tool, F.when(arguments.isNull(), F.array(F.lit("no_object"))).otherwise(checked)).otherwise(out)
    return out


def levels(calls: DataFrame) -> DataFrame:
    """``calls`` with ``level``: 0 for those that refer to no other, null for those in or above a cycle.

    Keys are texts that hold a null conversation or identifier too, so equi-joins
    meet them.  Rounds end when no further call is ready, however long a chain is.
    """
    conv = F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit(""))
    key = lambda c: F.concat(conv, F.lit("\x01"), F.coalesce(F.concat(F.lit("i"), F.col(c)), F.lit("")))
    keyed = calls.withColumn("_key", key("id"))
    named = calls.select("conv_id", "id", F.explode(F.flatten(F.transform("arguments", lambda e: e["refs"]))).alias("_on")).where("_on is not null")
    refs = named.select(key("id").alias("_key"), key("_on").alias("_on")).distinct()
    refs = refs.join(keyed.select(F.col("_key").alias("_on")).distinct(), "_on", "left_semi")
    if refs.limit(1).count() == 0:
        return calls.withColumn("level", F.lit(0))
    # calls that refer to others, with how many of these are open; a round closes what the last one made ready
    refs = written(refs)
    first = keyed.select("_key").distinct().join(refs.select("_key").distinct(), "_key", "left_anti").select("_key", F.lit(0).alias("level"))
    open_ = written(refs.groupBy("_key").agg(F.count(F.lit(1)).alias("open"), F.lit(0).alias("level")))
    rounds = [first]
    while True:
        closed = refs.join(rounds[-1].withColumnRenamed("_key", "_on"), "_on").groupBy("_key").agg(F.count(F.lit(1)).alias("_n"), (F.max("level") + 1).alias("_level"))
        new = open_.join(closed, "_key", "left").select("_key", (F.col("open") - F.coalesce("_n", F.lit(0))).alias("open"), F.greatest("level", F.coalesce("_level", F.lit(0))).alias("level"))
        new = written(new)
        ready = new.where("open = 0").select("_key", "level")
        if not ready.limit(1).count():
            level = reduce(DataFrame.unionByName, rounds)
            return keyed.join(level, "_key", "left").drop("_key")
        rounds.append(ready)
        open_ = new.where("open > 0")


def link(df: DataFrame, *, schemas: dict[str, dict[str, tuple[str, bool]]] = SCHEMAS, as_calls: bool = True) -> DataFrame:
    """One row per call or unclaimed result: ``(conv_id, id, nth, level, call_turn, result_turn, name, arguments, content, status, problems)``."""
    calls, results = extract(turns(df), as_calls=as_calls)
    calls = nth(levels(calls).withColumn("arguments_json", arguments_json(F.col("arguments"))), "turn", "place", "name", "arguments_json")
    results = nth(results, "turn", "content").select("conv_id", "id", "nth", F.col("turn").alias("result_turn"), "content", "content_json")
    calls = calls.withColumn("problems", problems(F.col("name"), F.col("arguments"), schemas)).withColumn("_call", F.lit(True))
    on = [F.col("c.conv_id").eqNullSafe(F.col("r.conv_id")), F.col("c.id") == F.col("r.id"), F.col("c.nth") == F.col("r.nth")]
    both = calls.alias("c").join(results.hint("shuffle_hash").alias("r"), on[0] & on[1] & on[2], "full_outer")
    status = (
        F.when(F.col("_call").isNull(), "orphan")
        .when(F.col("level").isNull(), "cyclic")
        .when(F.array_contains("problems", "unknown_tool"), "unknown_tool")
        .when(F.size("problems") > 0, "invalid")
        .when(F.col("result_turn").isNull(), "unanswered")
        .otherwise("ok")
    )
    return both.select(
        F.coalesce("c.conv_id", "r.conv_id").alias("conv_id"), F.coalesce("c.id", "r.id").alias("id"), F.coalesce("c.nth", "r.nth").alias("nth"),
        "level", F.col("turn").alias("call_turn"), "place", "result_turn", "name", "arguments", "arguments_json", "content", "content_json", status.alias("status"), F.coalesce("problems", F.array().cast("array<string>")).alias("problems"),
    )


def _field(name: str, value: Column) -> Column:
    return F.concat(F.lit(f'"{name}":'), F.coalesce(value, F.lit("null")))


def arguments_json(arguments: Column) -> Column:
    """Argument entries as canonical JSON: keys in order, no spaces."""
    entry = lambda e: F.concat(quoted(e["key"]), F.lit(":"), e["json"])
    return F.concat(F.lit("{"), F.array_join(F.transform(arguments, entry), ","), F.lit("}"))


def canonical(links: DataFrame) -> DataFrame:
    """``links`` with ``json``: keys in order, no spaces, shortest escapes."""
    fields = [
        _field("arguments", F.col("arguments_json")), _field("call_turn", F.col("call_turn").cast("string")), _field("content", F.col("content_json")), _field("id", quoted(F.col("id"))),
        _field("level", F.col("level").cast("string")), _field("name", quoted(F.col("name"))), _field("problems", F.concat(F.lit("["), F.array_join(F.transform("problems", quoted), ","), F.lit("]"))),
        _field("result_turn", F.col("result_turn").cast("string")), _field("status", quoted(F.col("status"))),
    ]
    return links.withColumn("json", F.concat(F.lit("{"), F.concat_ws(",", *fields), F.lit("}")))


def formatted(df: DataFrame, *, schemas: dict[str, dict[str, tuple[str, bool]]] = SCHEMAS, as_calls: bool = True) -> DataFrame:
    """One row per link in canonical form with its place in the conversation: ``(conv_id, seq, id, status, level, json)``.

    A conversation may be long, so its lines stay rows, and they are numbered in
    stretches of its turns: no window spans a whole conversation's lines.
    """
    at = F.coalesce("call_turn", "result_turn")
    out = canonical(link(df, schemas=schemas, as_calls=as_calls)).withColumn("_at", at).withColumn("_stretch", F.floor(at / STRETCH))
    stretch = ["conv_id", "level", "_stretch"]
    lines = out.select(*stretch).groupBy(*stretch).agg(F.count(F.lit(1)).alias("n"))
    so_far = F.sum("n").over(Window.partitionBy("conv_id").orderBy(F.col("level").asc_nulls_last(), "_stretch"))
    lines = lines.select(*[F.col(c).alias(f"_{c}") for c in stretch], (so_far - F.col("n")).alias("before"))
    same = [out[c].eqNullSafe(lines[f"_{c}"]) for c in stretch]
    within = Window.partitionBy(*stretch).orderBy("_at", F.coalesce("place", F.lit(-1)), "id", "nth", "json")
    placed = out.join(lines, same[0] & same[1] & same[2]).withColumn("seq", F.col("before") + F.row_number().over(within) - 1)
    return placed.select("conv_id", "seq", "id", "call_turn", "result_turn", "level", "status", "json")
