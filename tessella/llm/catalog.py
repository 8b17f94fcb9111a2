"""The queries of this subpackage by name, and their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm import decontaminate, fixity, oracle, packing, quality, secrets, simhash, suffixes, tokencounts, tokenfiles, toolcalls
from tessella.llm.shared import cut, new_folder


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = cut(quality.features(_read(spark, sf_dir, "documents").select("doc_id", "text", "lang")).select(F.struct("row.doc_id").alias("row"), "quality"), "quality")
    cutoffs = quality.cutoffs_of(judged, _read(spark, sf_dir, "labels"))
    done = quality.apply_cutoffs(judged, cutoffs)
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    return done.select("row.doc_id", *(F.col(f"quality.{n}") for n in counts), "kept", "quality.reject_level", "quality.stratum", F.col("cutoff").alias("cutoff_level"))


#: Schemas of the tools in the messages that :func:`tool_messages` makes.
SCHEMAS = {
    "answer": {"type": "object", "required": ["prompt", "turn"], "additionalProperties": False, "properties": {"prompt": {"type": "string", "minLength": 1}, "turn": {"type": "integer"}}},
    "follow_up": {"type": "object", "required": ["prompt", "turn"], "additionalProperties": False, "properties": {"prompt": {"type": "string", "minLength": 1, "maxLength": 200}, "turn": {"type": "integer"}}},
}


def tool_messages(conversations: DataFrame) -> DataFrame:
    """Tool-call messages from plain turns: a user turn calls, the assistant's next turn answers.

    Every second call depends on the one before it.  By the conversation's number some have ids
    that are used again, a first call that depends on a later one, a call cut off in its JSON, names
    that are no strings, results that answer an earlier call, or one that is still to come.
    """
    conv, turn = F.col("conv_id"), F.col("turn").cast("long")
    name_of = lambda t: F.concat(F.lit("call_"), F.when(conv % 5 == 1, t % 4).otherwise(t).cast("string"))
    later, tangled = turn % 4 >= 2, conv % 10 == 3
    depends = F.when(later & ~tangled, F.array(name_of(turn - 2))).when((turn < 2) & tangled, F.array(name_of(turn + 2))).when(~later & (turn >= 4) & tangled, F.array(name_of(turn - 4)))
    call = F.struct(name_of(turn).alias("id"), F.when(later, "follow_up").otherwise("answer").alias("name"), F.struct(F.col("text").alias("prompt"), turn.alias("turn")).alias("arguments"), depends.alias("depends_on"))
    made = F.to_json(F.struct(F.array(call).alias("tool_calls")))
    made = F.when(conv % 11 == 4, F.regexp_replace(made, '"name":"[a-z_]+"', '"name":{}')).when((conv % 7 == 2) & turn.isin(2, 3), F.substring(made, 1, 40)).otherwise(made)
    answers = F.when((conv % 13 == 5) & (turn >= 4), turn - 3).when(conv % 17 == 6, turn + 1).otherwise(turn - 1)
    result = F.to_json(F.struct(name_of(answers).alias("tool_call_id"), F.col("text").alias("content")))
    is_call, is_result = F.col("role") == "user", F.col("role") == "assistant"
    text = F.when(is_call, made).when(is_result, result).otherwise(F.col("text"))
    role = F.when(is_call, "assistant").when(is_result, "tool").otherwise(F.col("role"))
    return conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"))


def op2_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toolcalls.link(tool_messages(_read(spark, sf_dir, "conversations")), SCHEMAS)


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.passages(_read(spark, sf_dir, "documents"))


#: Pages in a WARC file of :func:`op4_fixity`, and files for pages without an id.
PAGES_IN_FILE, UNNAMED_FILES = 100, 4096


def replicas(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records of ``pages`` in two stores; the second has rotten bytes and lacks pages.

    One page of 97 has its second character overwritten, one of 89 is longer by a character.
    Every fifth file lacks its last page, and every fifth but one its 38th, which shifts all
    behind it.  Pages without an id are dealt to files by their content.
    """
    n, html = F.col("page_id"), F.col("html")
    unnamed = F.concat(F.lit("unnamed-"), F.pmod(F.xxhash64("url", "html"), F.lit(UNNAMED_FILES)).cast("string"))
    file = F.coalesce(F.concat(F.lit("warc-"), F.floor(n / PAGES_IN_FILE).cast("string")), unnamed)
    rotten, longer = (n % 97 == 13) & (F.length(html) >= 2), n % 89 == 7
    bad = F.when(rotten, F.concat(F.substring(html, 1, 1), F.lit("~"), F.expr("substring(html, 3)"))).when(longer, F.concat(F.lit("~"), F.coalesce(html, F.lit("")))).otherwise(html)
    place, turn = n % PAGES_IN_FILE, F.floor(n / PAGES_IN_FILE) % 5
    lost = F.coalesce(((place == PAGES_IN_FILE - 1) & (turn == 1)) | ((place == 37) & (turn == 2)), F.lit(False))
    ours = pages.select(file.alias("file"), n.alias("id"), fixity.record(F.col("url"), html).alias("record"))
    theirs = pages.where(~lost).select(file.alias("file"), n.alias("id"), fixity.record(F.col("url"), bad).alias("record"))
    return ours, theirs


def op4_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    ours, theirs = (cut(fixity.laid_out(x), "leaves") for x in replicas(_read(spark, sf_dir, "pages")))
    found = fixity.audit(fixity.tree(ours), fixity.tree(theirs))
    wrong = found.where("status <> 'extra'").select(F.col("file").alias("bad_file"), F.col("offset").alias("bad_offset"), "status")
    done = ours.join(wrong, F.col("file").eqNullSafe(F.col("bad_file")) & (F.col("offset") == F.col("bad_offset")), "left")
    return done.select(F.col("id").alias("page_id"), "file", "offset", "length", "digest", F.coalesce("status", F.lit("sound")).alias("status"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = cut(secrets.scan(_read(spark, sf_dir, "documents").select("doc_id", "text")).select("row.doc_id", "base", "tested"), "secrets")
    spans = secrets.all_spans(*secrets.discovery_bin(scanned))
    of = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return scanned.select("doc_id", *(of(k).alias(f"n_{name}") for k, name in enumerate(secrets.KINDS[:3])), F.sha2(secrets.written(F.col("base")), 256).alias("base_sha256"), secrets.written(spans).alias("spans"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))
    n_hit = decontaminate.hit_words(F.col("hits")).cast("long")
    done = found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"))
    return done.withColumn("contaminated", F.col("n_hit") > 0)


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = cut(packing.pieces(_read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")), "pieces")
    return packing.pack(found)


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    where = new_folder(spark, "token-files")
    tokenfiles.write(_read(spark, sf_dir, "documents"), where, public_tokenizers.path("word_bpe_49k.json"))
    return tokenfiles.positions(tokenfiles.read(spark, where))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencounts.token_counts(_read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_tool_calls": op2_tool_calls,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_fixity": op4_fixity,
    "op5_secret_scan": op5_secret_scan,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_decontamination": op7_decontamination,
    "op8_token_files": op8_token_files,
    "op9_token_counts": op9_token_counts,
    "op10_simhash": op10_simhash,
}

ORACLE_SQL: dict[str, str] = {
    "op1_quality_rules": oracle.OP1,
    "op2_tool_calls": oracle.OP2,
    "op3_suffix_dedup": oracle.OP3,
    "op7_decontamination": oracle.OP7,
    "op4_fixity": """
        WITH p AS (
            SELECT page_id, url, html, 'warc-' || CAST(page_id // 100 AS VARCHAR) AS file,
                   coalesce(page_id % 97 = 13 AND length(html) >= 2 AND html[2] <> '~', false) OR (page_id % 89 = 7 AND NOT coalesce(page_id % 97 = 13 AND length(html) >= 2, false)) AS rotten,
                   (page_id % 100 = 99 AND (page_id // 100) % 5 = 1) OR (page_id % 100 = 37 AND (page_id // 100) % 5 = 2) AS lost
            FROM pages
        ), r AS (
            SELECT page_id, file, rotten, lost,
                   'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10)
                   || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10)
                   || 'Content-Type: text/html' || chr(13) || chr(10)
                   || 'Content-Length: ' || CAST(strlen(coalesce(html, '')) AS VARCHAR)
                   || chr(13) || chr(10) || chr(13) || chr(10) || coalesce(html, '')
                   || chr(13) || chr(10) || chr(13) || chr(10) AS record
            FROM p
        )
        SELECT page_id, file,
               CAST(coalesce(sum(strlen(record)) OVER (PARTITION BY file ORDER BY page_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS offset,
               CAST(strlen(record) AS BIGINT) AS length, sha256(record) AS digest,
               CASE WHEN lost THEN 'missing' WHEN rotten THEN 'corrupt' ELSE 'sound' END AS status
        FROM r
    """,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
