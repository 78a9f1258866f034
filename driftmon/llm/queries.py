"""The operators as queries over the given tables, and their SQL where SQL can say it."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftmon.llm import (
    chat,
    decontaminate,
    exact_dedup,
    language,
    packing,
    quality,
    rule_ledger,
    secret_scan,
    simhash,
    structure_repair,
    token_align,
    token_counts,
    toxicity,
)
from driftmon.llm.common import crc_mod, table
from driftmon.llm.labelled import labelled

QUALITY_FOLDS, QUALITY_HELD = 3, 1
TOXIC_FOLDS, TOXIC_HELD = 5, 0
LANG_FOLDS, LANG_HELD = 4, 2

TOOLS = {
    "search": {
        "type": "object",
        "properties": {"query": {"type": "string"}, "limit": {"type": "integer", "minimum": 1, "maximum": 100}},
        "required": ["query", "limit"],
        "additionalProperties": False,
    },
    "translate": {
        "type": "object",
        "properties": {"text": {"type": "string"}, "to": {"type": "string", "enum": ["de", "en", "es", "fr"]}},
        "required": ["text", "to"],
        "additionalProperties": False,
    },
}


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))
    return rows.select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256")
    )


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def quality_model(spark: SparkSession, sf_dir: str, docs: DataFrame) -> quality.Model:
    learn = crc_mod("doc_id", QUALITY_FOLDS) != QUALITY_HELD
    return quality.learn(labelled(docs, table(spark, sf_dir, "labels"), "quality", learn))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = quality.score_quality(docs, quality_model(spark, sf_dir, docs))
    held = (crc_mod("doc_id", QUALITY_FOLDS) == QUALITY_HELD).alias("held_out")
    return scored.select("doc_id", held, "score", "predicted")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    learn = crc_mod("doc_id", TOXIC_FOLDS) != TOXIC_HELD
    model = toxicity.learn(labelled(docs, table(spark, sf_dir, "labels"), "toxic", learn))
    held = (crc_mod("doc_id", TOXIC_FOLDS) == TOXIC_HELD).alias("held_out")
    return toxicity.score_toxicity(docs, model).select("doc_id", held, "score", "predicted")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return rows.select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest_columns(secret_scan.scan_secrets(table(spark, sf_dir, "documents")))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = crc_mod("doc_id", LANG_FOLDS) == LANG_HELD
    found = language.identify(docs, language.learn(docs.where(~held)))
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score")


def tool_messages(conversations: DataFrame) -> DataFrame:
    """The conversations with tools in them: each user message also asks a tool, and each
    assistant message is also the result of the call one turn earlier.

    The given conversations hold no calls, so Spark derives some from all their rows. Every
    second call waits for the one before it; one in seven has a limit that is no number, and
    some ask for a language that the tool lacks.
    """
    conv, turn = F.col("conv_id").cast("string"), F.col("turn").cast("long")
    name = F.when(turn % 4 == 0, "search").otherwise("translate")
    odd = F.crc32(F.coalesce("text", F.lit("")).cast("binary")) % 7
    search = F.when(
        odd == 0, F.to_json(F.struct(F.col("text").alias("query"), F.lit("many").alias("limit")))
    ).otherwise(F.to_json(F.struct(F.col("text").alias("query"), (turn + 1).alias("limit"))))
    to = F.element_at(F.array(*map(F.lit, ["de", "en", "es", "fr", "it"])), (odd % 5 + 1).cast("int"))
    translate = F.to_json(F.struct(to.alias("to"), "text"))
    before = F.when(turn % 4 == 2, F.array(F.concat_ws("-", conv, turn - 2))).otherwise(F.array().cast("array<string>"))
    call = F.struct(
        F.concat_ws("-", conv, turn).alias("id"),
        name.alias("name"),
        F.when(turn % 4 == 0, search).otherwise(translate).alias("arguments"),
        before.alias("after"),
    )
    result = F.struct(F.concat_ws("-", conv, turn - 1).alias("tool_call_id"), F.col("text").alias("content"))
    calls = conversations.where("role = 'user'").select(
        "conv_id", "turn", F.lit("assistant").alias("role"), F.to_json(F.struct(F.array(call).alias("tool_calls"))).alias("text")
    )
    results = conversations.where("role = 'assistant'").select(
        "conv_id", "turn", F.lit("tool").alias("role"), F.to_json(result).alias("text")
    )
    return conversations.select("conv_id", "turn", "role", "text").unionByName(calls).unionByName(results)


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(tool_messages(table(spark, sf_dir, "conversations")), TOOLS)


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with faults: by a hash of its place a message is dropped, emptied, robbed
    of its ends of sentences, repeated, or given to the user. Nulls count as one space."""

    def shown(c: str):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    hurt = rows.where("kind != 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("times"))
    return hurt.withColumn("time", F.explode("times")).drop("times", "time")


def op11_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    repaired = structure_repair.repair_conversations(damaged(conversations))
    return structure_repair.with_all(conversations.select("conv_id").distinct(), repaired)


def op12_token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_align.token_alignment(table(spark, sf_dir, "documents"))


def op13_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rule_ledger.ledger(table(spark, sf_dir, "documents"))
    base = rule_ledger.rejects(rule_ledger.BASE).alias("base_failed")
    judged = rule_ledger.apply_policy(rows, rule_ledger.POLICIES[-1])
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base, "kept", "failed", "policy"
    )


OPERATORS = {
    f.__name__: f
    for f in (
        op1_exact_dedup,
        op2_token_counts,
        op3_decontaminate,
        op4_quality,
        op5_toxicity,
        op6_simhash,
        op7_secrets,
        op8_packing,
        op9_language,
        op10_chat,
        op11_structure_repair,
        op12_token_align,
        op13_rule_ledger,
    )
}

ORACLES = {
    "op1_exact_dedup": """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents
)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
""",
    # The damage, then per conversation the least (cost, audit) of reaching each state of the
    # grammar, one message after another.
    "op11_structure_repair": r"""
WITH RECURSIVE src AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k
  FROM conversations
), hashed AS (
  SELECT *, xor(list_reduce(
      list_transform(string_split(k, ''), lambda x: ascii(x)::BIGINT),
      lambda c, b: list_reduce(range(8),
        lambda d, i: CASE WHEN d & 1 = 1 THEN xor(d >> 1, 3988292384) ELSE d >> 1 END, xor(c, b)),
      4294967295::BIGINT), 4294967295) % 20 AS kind
  FROM src
), hurt AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM hashed, (SELECT unnest([1, 2]) AS t) WHERE kind <> 0 AND (t = 1 OR kind = 3)
), ordered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM hurt
), marked AS (
  SELECT *,
         CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE 'x' END AS c,
         CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
              WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
              WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault
  FROM ordered
), paired AS (
  SELECT *, lag(c) OVER (PARTITION BY conv_id ORDER BY i) || c AS pair FROM marked
), counted AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count_if(fault = 'blank') AS blank, count_if(fault = 'duplicate') AS duplicate,
         count_if(fault = 'truncated') AS truncated,
         count_if(pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM paired GROUP BY conv_id
), walk AS (
  SELECT conv_id, n, 0::BIGINT AS i,
         {'c': 0, 'a': '', 'o': ''} AS s0, {'c': 1000000000, 'a': '', 'o': ''} AS s1,
         {'c': 2, 'a': 'I', 'o': e'user:\n'} AS s2, {'c': 4, 'a': 'II', 'o': e'user:\nassistant:\n'} AS s3
  FROM counted
  UNION ALL
  SELECT conv_id, n, i, t0, t1,
         list_min([t2, {'c': t3.c + 2, 'a': t3.a || 'I', 'o': t3.o || e'user:\n'},
                   {'c': least(t0.c, t1.c) + 2, 'a': list_min([t0, t1]).a || 'I', 'o': list_min([t0, t1]).o || e'user:\n'}]),
         list_min([t3, {'c': t2.c + 2, 'a': t2.a || 'I', 'o': t2.o || e'assistant:\n'},
                   {'c': least(t0.c, t1.c) + 4, 'a': list_min([t0, t1]).a || 'II', 'o': list_min([t0, t1]).o || e'user:\nassistant:\n'}])
  FROM (
    SELECT conv_id, n, i,
           {'c': s0.c + 3, 'a': s0.a || 'D', 'o': s0.o} AS t0,
           list_min([{'c': s1.c + 3, 'a': s1.a || 'D', 'o': s1.o},
                     {'c': s0.c + cut + CASE WHEN c = 's' THEN 0 ELSE far END, 'a': s0.a || 'K', 'o': s0.o || line}]) AS t1,
           list_min([{'c': s2.c + 3, 'a': s2.a || 'D', 'o': s2.o}]
             || list_transform([s0, s1, s3], lambda s: {'c': s.c + cut + CASE WHEN c = 'u' THEN 0 ELSE far END, 'a': s.a || 'K', 'o': s.o || line})
             || list_transform([s0, s1, s3], lambda s: {'c': s.c + cut + 2, 'a': s.a || 'R', 'o': s.o || 'user:' || text || e'\n'})) AS t2,
           list_min([{'c': s3.c + 3, 'a': s3.a || 'D', 'o': s3.o},
                     {'c': s2.c + cut + CASE WHEN c = 'a' THEN 0 ELSE far END, 'a': s2.a || 'K', 'o': s2.o || line},
                     {'c': s2.c + cut + 2, 'a': s2.a || 'R', 'o': s2.o || 'assistant:' || text || e'\n'}]) AS t3
    FROM (
      SELECT w.*  EXCLUDE (i), w.i + 1 AS i, m.c, m.text, m.role || ':' || m.text || e'\n' AS line, 100000000 AS far,
             CASE WHEN m.fault IN ('blank', 'duplicate') THEN 100000000 WHEN m.fault = 'truncated' THEN 1 ELSE 0 END AS cut
      FROM walk w JOIN marked m ON m.conv_id IS NOT DISTINCT FROM w.conv_id AND m.i = w.i + 1
    )
  )
), best AS (
  SELECT conv_id, list_min([s0, s3, {'c': s2.c + 2, 'a': s2.a || 'I', 'o': s2.o || e'assistant:\n'},
                            {'c': s1.c + 4, 'a': s1.a || 'II', 'o': s1.o || e'user:\nassistant:\n'}]) AS s
  FROM walk WHERE i = n
), ids AS (SELECT DISTINCT conv_id FROM conversations)
SELECT ids.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
       coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, coalesce(s.c, 0)::BIGINT AS cost, coalesce(s.a, '') AS audit,
       sha256(coalesce(left(s.o, -1), '')) AS repaired_sha256
FROM ids LEFT JOIN counted ON counted.conv_id IS NOT DISTINCT FROM ids.conv_id
         LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM ids.conv_id
""",
    "op13_rule_ledger": r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT r, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM d
), windows AS (
  SELECT r, i, [words[i], words[i + 1], words[i + 2]] AS g
  FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM w)
), again AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS times FROM windows) WHERE times > 1
), covered AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY r
), m AS (
  SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, len(lines) AS n_lines,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words,
         len(list_filter(lines, lambda x: regexp_matches(x, '^[ \t]*([-*•‣◦]|[0-9]{1,3}[.)])[ \t]'))) AS n_bullets,
         len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)[ \t\r]*$'))) AS n_ellipses,
         len(list_filter(words, lambda x: NOT regexp_matches(x, '\p{L}'))) AS n_unlettered
  FROM w LEFT JOIN covered USING (r)
), f AS (
  SELECT *, (n_words < 50)::BIGINT AS f0, (100 * n_repeat_words > 50 * n_words)::BIGINT AS f1,
         (word_chars < 3 * n_words)::BIGINT AS f2, (word_chars > 10 * n_words)::BIGINT AS f3,
         (10 * n_symbols > n_words)::BIGINT AS f4, (2 * n_dup_lines > n_lines)::BIGINT AS f5,
         (10 * n_bullets > 9 * n_lines)::BIGINT AS f6, (10 * n_ellipses > 3 * n_lines)::BIGINT AS f7,
         (10 * n_unlettered > 2 * n_words)::BIGINT AS f8
  FROM m
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, f0 + f1 > 0 AS base_failed,
       f0 + f1 + f3 + f4 + f5 = 0 AND f2 + f6 + f7 + f8 <= 1 AS kept,
       f0 + 2 * f1 + 4 * f2 + 8 * f3 + 16 * f4 + 32 * f5 + 64 * f6 + 128 * f7 + 256 * f8 AS failed, 'v2' AS policy
FROM f
""",
}
