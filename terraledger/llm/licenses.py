"""License scans by an exact set-similarity join of text blocks with templates.

A text's words fall into blocks of ``2 m`` words that start every ``m`` words,
``m`` being the longest template's length, so that every stretch of ``m`` words
lies whole in a block.  A block meets a template when it holds at least the
threshold's share of the template's distinct words.  Words are ordered by the
number of documents of the whole corpus that hold them, rarest first; an index
maps the words of each template's prefix (``|T| - o + 1`` words, ``o`` being the
overlap asked for) to the template and the word's place in it.  A block becomes
a candidate only at a prefix word; of the candidates those stay whose length and
whose remaining words on either side can still give ``o`` common words, and
their overlap is then counted.  No filter loses a block that meets a template.

Words that stand in no template can't add to an overlap, so they are dropped
from blocks before lengths and places are taken.  A row's candidates are found
and counted within the row, in built-in functions: texts are never shuffled,
blocks are never written out, and only a number for each template word (a
parameter's size) reaches the driver.

*Phrases* are templates of threshold 1 whose words must also stand
consecutively: the blocks that the join finds are searched for the exact places,
each place in the one block in whose first ``m`` words it starts.

Defined cases: a null or empty text, or one without words, has counts of 0, null
places, empty labels and score 0; repeated rows and ties give equal results;
texts are never cut; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed value: what a word is.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Phrases and their labels.
PHRASES = [
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
]
#: Opening sentences of well-known licenses; further ones are a parameter.
TEMPLATES = [
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    ("gpl-2", "under the terms of the gnu general public license version 2"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("mpl-2", "subject to the terms of the mozilla public license v 2 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("unlicense", "free and unencumbered software released into the public domain"),
]
THRESHOLD = 0.9


def text_words(text: Column) -> Column:
    """The words of a text, A-Z in lower case."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(f"({WORD})"), F.lit(1))


def needed(distinct: int, threshold: float) -> int:
    """The least common words that reach ``threshold``, without rounding errors."""
    return next(o for o in range(1, distinct + 1) if o >= threshold * distinct - 1e-9)


def document_counts(words: DataFrame, vocabulary: Sequence[str]) -> dict[str, int]:
    """How many documents hold each word of ``vocabulary``; one row a word reaches the driver."""
    own = words.select(F.explode(F.array_distinct(F.filter("words", lambda w: w.isin(*vocabulary)))).alias("w"))
    found = {r.w: r.n for r in own.groupBy("w").agg(F.count(F.lit(1)).alias("n")).collect()}
    return {w: found.get(w, 0) for w in vocabulary}


def _array(values: Sequence[int | str]) -> Column:
    return F.array(*map(F.lit, values))


def scan(df: DataFrame, *, phrases: Sequence[tuple[str, str]] = PHRASES, templates: Sequence[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows ``(id, n_words, n_base, first_word, last_word, base_labels, labels, score, matches)``.

    ``matches`` lists every block that meets a template: ``(block, label, common, of)``;
    ``score`` is the greatest share of a template that any block holds among them.
    """
    if not phrases and not templates:
        raise ValueError("no phrase and no template to look for")
    rules = [(label, text.split(), 1.0) for label, text in phrases] + [(label, text.split(), threshold) for label, text in templates]
    span = max(len(words) for _, words, _ in rules)
    vocabulary = sorted({w for _, words, _ in rules for w in words})

    texts = df.select(F.col(id_col).alias("id"), text_words(F.col(text_col)).alias("words"))
    counts = document_counts(texts, vocabulary)
    number = {w: k for k, w in enumerate(sorted(vocabulary, key=lambda w: (counts[w], w)))}  # rarest first
    ordered = [sorted({number[w] for w in words}) for _, words, _ in rules]
    asked = [needed(len(t), share) for t, (_, _, share) in zip(ordered, rules, strict=True)]
    index: dict[int, list[tuple[int, int]]] = {}
    for k, (tokens, o) in enumerate(zip(ordered, asked, strict=True)):
        for i, token in enumerate(tokens[: len(tokens) - o + 1]):
            index.setdefault(token, []).append((k, i))
    opening = [w for w, n in number.items() if n in index]

    rule = F.array(*[
        F.struct(F.lit(label).alias("label"), F.lit(len(t)).alias("of"), F.lit(o).alias("asked"), _array(t).alias("tokens"), F.lit(k < len(phrases)).alias("phrase"), _array(words).alias("words"))
        for k, ((label, words, _), t, o) in enumerate(zip(rules, ordered, asked, strict=True))
    ])
    numbers = F.create_map(*[F.lit(x) for pair in number.items() for x in pair])
    # entry n lists where word number n stands in a prefix
    entries = F.array(*[F.array(*[F.struct(F.lit(k).alias("rule"), F.lit(i).alias("i")) for k, i in index.get(n, [])]).cast("array<struct<rule:int,i:int>>") for n in range(len(number))])

    words = F.col("words")
    at = F.filter(F.transform(words, lambda w, i: F.when(w.isin(*opening), i)), lambda i: i.isNotNull())
    rows = texts.withColumn("opened", F.when(F.exists(words, lambda w: w.isin(*opening)), at))
    around = F.transform("opened", lambda i: F.filter(F.array(F.floor(i / span).cast("int"), F.floor(i / span).cast("int") - 1), lambda b: b >= 0))
    rows = rows.withColumn("starts", F.array_distinct(F.flatten(around)))
    own = lambda b: F.transform(F.slice(words, b * span + 1, 2 * span), lambda w: numbers[w])
    rows = rows.withColumn("blocks", F.transform("starts", lambda b: F.struct(b.alias("block"), F.array_sort(F.array_distinct(F.filter(own(b), lambda n: n.isNotNull()))).alias("tokens"))))

    def candidates(block: Column) -> Column:
        """The rules that a prefix word of the block, its length and the places on both sides leave open."""
        size = F.size(block.tokens)

        def by_place(e: Column, j: Column) -> Column:
            r = rule[e.rule]
            return (size >= r.asked) & (F.least(r.of - e.i, size - j) >= r.asked)

        return F.array_distinct(F.flatten(F.transform(block.tokens, lambda n, j: F.transform(F.filter(entries[n], lambda e: by_place(e, j)), lambda e: e.rule))))

    def met(block: Column) -> Column:
        found = F.transform(
            candidates(block),
            lambda k: F.struct(block.block.alias("block"), rule[k].label.alias("label"), F.size(F.array_intersect(block.tokens, rule[k].tokens)).alias("common"), rule[k].of.alias("of"), k.alias("rule")),
        )
        return F.filter(found, lambda m: m.common >= rule[m.rule].asked)

    rows = rows.withColumn("met", F.flatten(F.transform("blocks", met)))

    def places(m: Column) -> Column:
        """Where the words of a phrase stand consecutively, starting in the block's first part."""
        phrase = rule[m.rule].words
        first = m.block * span
        return F.filter(F.sequence(first, first + (span - 1)), lambda p: F.slice(words, p + 1, F.size(phrase)) == phrase)

    exact = F.transform(F.filter("met", lambda m: rule[m.rule].phrase), lambda m: F.struct(m.label.alias("label"), places(m).alias("places")))
    none = F.array().cast("array<string>")
    rows = rows.withColumn("exact", F.filter(exact, lambda m: F.size(m.places) > 0))
    rows = rows.withColumn("base", F.coalesce(F.flatten(F.transform("exact", lambda m: m.places)), F.array().cast("array<int>")))
    rows = rows.withColumn("matches", F.coalesce(F.filter("met", lambda m: ~rule[m.rule].phrase), F.array().cast("array<struct<block:int,label:string,common:int,of:int,rule:int>>")))
    base_labels = F.coalesce(F.array_distinct(F.transform("exact", lambda m: m.label)), none)
    share = F.array_max(F.transform("matches", lambda m: m.common / m.of))
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    return rows.select(
        "id",
        F.size(words).cast("long").alias("n_words"),
        F.size("base").cast("long").alias("n_base"),
        F.array_min("base").cast("long").alias("first_word"),
        F.array_max("base").cast("long").alias("last_word"),
        joined(base_labels).alias("base_labels"),
        joined(F.concat(base_labels, F.transform("matches", lambda m: m.label))).alias("labels"),
        F.greatest(F.coalesce(share, F.lit(0.0)), F.when(F.size("base") > 0, 1.0).otherwise(0.0)).alias("score"),
        F.transform("matches", lambda m: F.struct(m.block.alias("block"), m.label.alias("label"), m.common.alias("common"), m.of.alias("of"))).alias("matches"),
    )


def scan_sql(phrases: Sequence[tuple[str, str]] = PHRASES, templates: Sequence[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> str:
    """DuckDB SQL of the same rows (but ``matches``): every place and every block against every rule, without order, index or filter."""
    rules = [(label, text.split(), 1.0) for label, text in phrases] + [(label, text.split(), threshold) for label, text in templates]
    span = max(len(words) for _, words, _ in rules)
    values = ", ".join(f"({k}, '{label}', {words!r}, {share}, {str(k < len(phrases)).lower()})" for k, (label, words, share) in enumerate(rules))
    return f"""
        WITH rules(rule, label, words, share, phrase) AS (VALUES {values}),
        t AS MATERIALIZED (
            SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS words FROM documents),
        w AS MATERIALIZED (SELECT rid, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS pos FROM t),
        base AS (
            SELECT w.rid, w.pos, r.label FROM w JOIN rules r ON r.phrase AND w.word = r.words[1] JOIN t ON t.rid = w.rid
            WHERE t.words[w.pos + 1 : w.pos + len(r.words)] = r.words),
        held AS (SELECT DISTINCT rid, word, b AS block FROM (SELECT rid, word, pos // {span} AS b FROM w UNION ALL SELECT rid, word, pos // {span} - 1 FROM w) WHERE b >= 0),
        asked AS (SELECT rule, label, unnest(list_distinct(words)) AS word, len(list_distinct(words)) AS n, share FROM rules WHERE NOT phrase),
        met AS (
            SELECT rid, label, count(*) / max(n) AS part FROM held JOIN asked USING (word)
            GROUP BY rid, block, rule, label HAVING count(*) >= max(share * n) - 1e-9),
        b AS (SELECT rid, count(*) AS n, min(pos) AS lo, max(pos) AS hi FROM base GROUP BY rid),
        bl AS (SELECT rid, string_agg(label, ',' ORDER BY label) AS labels FROM (SELECT DISTINCT rid, label FROM base) GROUP BY rid),
        al AS (SELECT rid, string_agg(label, ',' ORDER BY label) AS labels FROM (SELECT rid, label FROM base UNION SELECT rid, label FROM met) GROUP BY rid),
        s AS (SELECT rid, max(part) AS score FROM (SELECT rid, part FROM met UNION ALL SELECT rid, 1.0 FROM base) GROUP BY rid)
        SELECT t.doc_id, CAST(len(t.words) AS BIGINT) AS n_words, coalesce(b.n, 0) AS n_base, b.lo AS first_word, b.hi AS last_word,
               coalesce(bl.labels, '') AS base_labels, coalesce(al.labels, '') AS labels, CAST(coalesce(s.score, 0) AS DOUBLE) AS score
        FROM t LEFT JOIN b USING (rid) LEFT JOIN bl USING (rid) LEFT JOIN al USING (rid) LEFT JOIN s USING (rid)"""
