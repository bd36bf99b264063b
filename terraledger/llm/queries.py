"""Registered queries of the training-data operators: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terraledger.llm import alignment, avi, bpe, centroids, chat, licenses, masked_lm, minhash, neighbours, packing, quality, sharding, toxicity
from terraledger.llm.common import held_out
from terraledger.sources.tables import table


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe.encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), keep_ids=False)
    return out.select(F.col("id").alias("doc_id"), "n_tokens", "ids_sha256", "decoded_sha256")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit_on(docs, labels, ~held_out(F.col("_id"), 5, 0))
    out = toxicity.score(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score", "predicted")


def op3_dartminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_avi(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = avi.stored(table(spark, sf_dir, "documents"), keep_media=False)
    return out.select(F.col("id").alias("doc_id"), "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op6_masked_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = masked_lm.pseudo_likelihood(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_tokens", "log_likelihood", F.col("mean_log_probability").alias("score"))


def op7_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.near_duplicates(table(spark, sf_dir, "embeddings"))


def op8_tool_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = chat.formatted(table(spark, sf_dir, "conversations"))
    return out.select("conv_id", F.col("seq").cast("long").alias("seq"), "id", F.col("call_turn").cast("long").alias("call_turn"), F.col("result_turn").cast("long").alias("result_turn"), F.col("level").cast("long").alias("level"), "status", "json")


def chat_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The turns of each conversation rewritten as calls and results of one tool.

    A user's turn calls ``lookup``, referring to the call two turns before from inside
    a list; an assistant's turn is the result of the call before it.  Some calls name
    another tool, bear a field of a wrong type, or refer to themselves; some results
    answer no call.
    """
    turn, size, conv = F.col("turn"), F.col("size"), F.col("conv_id")
    rows = table(spark, sf_dir, "conversations").where("conv_id is not null and turn is not null").groupBy("conv_id", "turn").agg(F.max("role").alias("role"), F.max(F.length("text")).alias("size"))
    name = F.when(conv % 11 == 3, "search").otherwise("lookup")
    back = F.when((conv % 13 == 5) & (turn % 4 == 0), turn).otherwise(turn - 2)
    number = F.when(turn % 5 == 3, F.concat(F.lit('"'), size, F.lit('"'))).otherwise(size.cast("string"))
    call = F.format_string('{"tool_calls": [{"id": "c%d", "name": "%s", "arguments": {"n": %s, "after": [{"on": "$c%d"}]}}]}', turn, name, number, back)
    answer = F.format_string('{"tool_call_id": "c%d", "content": %d}', F.when(conv % 7 == 2, turn + 50).otherwise(turn - 1), size)
    text = F.when(F.col("role") == "user", call).when(F.col("role") == "assistant", answer).otherwise("plain")
    role = F.when(F.col("role") == "assistant", "tool").otherwise(F.col("role"))
    out = chat.canonical(chat.link(rows.select("conv_id", "turn", role.alias("role"), text.alias("text")), schemas={"lookup": {"n": ("integer", True), "after": ("array", False)}}, as_calls=False))
    return out.select("conv_id", "id", F.col("level").cast("long").alias("level"), "status", F.array_join("problems", ",").alias("problems"), "json")


def op9_interleave(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.interleave(table(spark, sf_dir, "documents"), 24)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "source")


def op10_attention_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.fit_on(docs, labels, ~held_out(F.col("_id"), 3, 1))
    out = quality.score(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out(F.col("doc_id"), 3, 1).alias("held_out"), "score", "predicted")


def op11_partial_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"), k=40, rounds=5, seed=2).withColumnRenamed("id", "vec_id")


def op12_license_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).drop("matches").withColumnRenamed("id", "doc_id")


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = alignment.linked(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    return out.withColumnRenamed("id", "doc_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_toxicity": op2_toxicity,
    "op3_dartminhash": op3_dartminhash,
    "op4_avi": op4_avi,
    "op5_packing": op5_packing,
    "op6_masked_lm": op6_masked_lm,
    "op7_nn_descent": op7_nn_descent,
    "op8_tool_links": op8_tool_links,
    "chat_tool_calls": chat_tool_calls,
    "op9_interleave": op9_interleave,
    "op10_attention_mil": op10_attention_mil,
    "op11_partial_distance": op11_partial_distance,
    "op12_license_join": op12_license_join,
    "op13_token_alignment": op13_token_alignment,
}

ORACLE: dict[str, str] = {
    # plain chat: each assistant turn answers the call that the turn before it makes
    "op8_tool_links": """
        WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations),
        c AS (
            SELECT conv_id, 't' || turn AS id, turn, '{"role":' || to_json(role) || ',"text":' || to_json(text) || '}' AS args,
                   row_number() OVER (PARTITION BY conv_id, turn ORDER BY '{"role":' || to_json(role) || ',"text":' || to_json(text) || '}') AS nth
            FROM t WHERE role <> 'assistant'),
        r AS (
            SELECT conv_id, 't' || (turn - 1) AS id, turn, text, row_number() OVER (PARTITION BY conv_id, turn ORDER BY text) AS nth
            FROM t WHERE role = 'assistant'),
        j AS (
            SELECT coalesce(c.conv_id, r.conv_id) AS conv_id, coalesce(c.id, r.id) AS id, coalesce(c.nth, r.nth) AS nth,
                   c.turn AS call_turn, r.turn AS result_turn, CASE WHEN c.id IS NOT NULL THEN 0 END AS level, c.args, r.text,
                   CASE WHEN c.id IS NULL THEN 'orphan' WHEN r.id IS NULL THEN 'unanswered' ELSE 'ok' END AS status
            FROM c FULL OUTER JOIN r ON c.conv_id = r.conv_id AND c.id = r.id AND c.nth = r.nth)
        SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY level NULLS LAST, coalesce(call_turn, result_turn), CASE WHEN level IS NULL THEN -1 ELSE 0 END, id, nth) - 1 AS seq,
               id, call_turn, result_turn, CAST(level AS BIGINT) AS level, status,
               '{"arguments":' || coalesce(args, 'null') || ',"call_turn":' || coalesce(call_turn::VARCHAR, 'null')
               || ',"content":' || coalesce(to_json(text)::VARCHAR, 'null') || ',"id":"' || id || '","level":' || coalesce(level::VARCHAR, 'null')
               || ',"name":' || CASE WHEN level IS NULL THEN 'null' ELSE '"respond"' END || ',"problems":[],"result_turn":' || coalesce(result_turn::VARCHAR, 'null')
               || ',"status":"' || status || '"}' AS json
        FROM j""",
    "chat_tool_calls": """
        WITH RECURSIVE t AS (SELECT conv_id, turn, max(role) AS role, max(length(text)) AS size FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY 1, 2),
        c AS (
            SELECT conv_id, turn, 'c' || turn AS id, CASE WHEN conv_id % 11 = 3 THEN 'search' ELSE 'lookup' END AS name, CASE WHEN turn % 5 = 3 THEN '"' || size || '"' ELSE '' || size END AS number,
                   turn % 5 = 3 AS wrong, CASE WHEN conv_id % 13 = 5 AND turn % 4 = 0 THEN turn ELSE turn - 2 END AS back
            FROM t WHERE role = 'user'),
        l AS (
            SELECT conv_id, turn, 0 AS level FROM c WHERE NOT EXISTS (SELECT 1 FROM c b WHERE b.conv_id = c.conv_id AND b.turn = c.back)
            UNION ALL SELECT c.conv_id, c.turn, l.level + 1 FROM c JOIN l ON l.conv_id = c.conv_id AND l.turn = c.back),
        r AS (SELECT conv_id, 'c' || CASE WHEN conv_id % 7 = 2 THEN turn + 50 ELSE turn - 1 END AS id, turn, size FROM t WHERE role = 'assistant'),
        j AS (
            SELECT coalesce(c.conv_id, r.conv_id) AS conv_id, coalesce(c.id, r.id) AS id, CAST(l.level AS BIGINT) AS level, c.turn AS asked, r.turn AS answered, name, number, back, r.size,
                   CASE WHEN c.id IS NULL THEN '' WHEN name = 'search' THEN 'unknown_tool' WHEN wrong THEN 'type:n' ELSE '' END AS problems, c.id IS NULL AS orphan
            FROM c FULL JOIN r ON r.conv_id = c.conv_id AND r.id = c.id LEFT JOIN l ON l.conv_id = c.conv_id AND l.turn = c.turn),
        s AS (SELECT *, CASE WHEN orphan THEN 'orphan' WHEN level IS NULL THEN 'cyclic' WHEN problems = 'unknown_tool' THEN 'unknown_tool' WHEN problems <> '' THEN 'invalid' WHEN answered IS NULL THEN 'unanswered' ELSE 'ok' END AS status FROM j)
        SELECT conv_id, id, level, status, problems,
               '{"arguments":' || CASE WHEN orphan THEN 'null' ELSE '{"after":[{"on":"$c' || back || '"}],"n":' || number || '}' END || ',"call_turn":' || coalesce(asked::VARCHAR, 'null')
               || ',"content":' || coalesce(size::VARCHAR, 'null') || ',"id":"' || id || '","level":' || coalesce(level::VARCHAR, 'null') || ',"name":' || coalesce('"' || name || '"', 'null')
               || ',"problems":[' || CASE WHEN problems = '' THEN '' ELSE '"' || problems || '"' END || '],"result_turn":' || coalesce(answered::VARCHAR, 'null') || ',"status":"' || status || '"}' AS json
        FROM s""",
    "op11_partial_distance": centroids.cluster_sql(),
    "op12_license_join": licenses.scan_sql(),
}
