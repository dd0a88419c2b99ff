"""One query for each operator, over the whole of its table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockpulse.llm import (
    chat_windows,
    decontamination,
    importance_resampling,
    license_scan,
    merkle_manifest,
    quality_rules,
    secret_scan,
    simhash_dedup,
    source_mixing,
    substring_dedup,
    suffix_dedup,
    token_output,
    url_filter,
)
from dockpulse.llm.registry import query, table


@query("op1_substring_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", F.col("n_units").alias("n_words"), "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


@query("op9_suffix_array_dedup")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", F.col("n_units").alias("n_bytes"), "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


@query("op8_simhash_near_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_dedup.classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op3_license_scan")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


@query(
    "op7_quality_rules",
    r"""
    WITH w AS (
      SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
             list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
      FROM documents),
    windows AS (
      SELECT doc_id, i, array_to_string(words[i:i + 4], ' ') AS win
      FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM w WHERE len(words) >= 5)),
    twice AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n FROM windows),
    repeats AS (
      SELECT doc_id, count(DISTINCT place) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS place FROM twice WHERE n > 1)
      GROUP BY doc_id),
    m AS (
      SELECT w.doc_id, len(words) AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
             len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
             coalesce(repeats.n, 0) AS n_repeat_words, len(regexp_extract_all(t, '[A-Z]')) AS n_capitals, len(lines) AS n_lines
      FROM w LEFT JOIN repeats USING (doc_id)),
    b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT (base_failed OR 10 * n_symbols > 5 * n_words OR 10 * n_dup_lines > 5 * n_lines OR word_chars > 20 * n_words
                OR 10 * n_capitals > 5 * word_chars) AS kept
    FROM b
    """,
)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents")).drop("n_rules_run")


@query("op6_benchmark_decontamination")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op10_token_output")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.encoded(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query(
    "op2_url_filter",
    r"""
    WITH p AS (
      SELECT page_id, coalesce(CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) END, '') AS rest FROM pages),
    h AS (
      SELECT page_id, rest,
             translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
      FROM p),
    listed(host, path, verdict) AS (
      VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'),
             ('com', '/de/', 'block')),
    best AS (
      SELECT h.*, (SELECT max(struct_pack(n := length(l.host || l.path), rule := l.host || l.path, verdict := l.verdict)) FROM listed l
                   WHERE (h.host = l.host OR ends_with(h.host, '.' || l.host)) AND starts_with(h.path, l.path)) AS r
      FROM h),
    found AS (
      SELECT *, host || substr(rest, length(regexp_extract(rest, '^([^/?#]*)', 1)) + 1) AS target FROM best),
    patterns AS (
      SELECT *, CASE WHEN regexp_matches(target, '^(?:[^/?#]*[.-])?spam-farm\.') THEN 'spam farm'
                     WHEN regexp_matches(target, '^(?:[^/?#]*[.-])?cheap-pills\.') THEN 'cheap pills'
                     WHEN regexp_matches(target, '^(?:[^/?#]*[.-])?casino[.-]') THEN 'casino'
                     WHEN regexp_matches(target, '^(?:[^/?#]*[.-])?xxx[.-]') THEN 'adult'
                     WHEN regexp_matches(target, '/(?:login|signin)(?:[/?#]|$)') THEN 'login page'
                     WHEN regexp_matches(target, '[?&]phpsessid=') THEN 'session id' END AS pattern
      FROM found)
    SELECT page_id, host, path, r.rule AS rule,
           coalesce(r.verdict, CASE WHEN pattern IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict,
           CASE WHEN r IS NULL THEN pattern END AS pattern
    FROM patterns
    """,
)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"))


@query(
    "op4_source_mixing",
    r"""
    WITH texts AS (
      SELECT doc_id, md5(coalesce(text, '')) AS digest, source, count(*) AS n_rows,
             sum(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0))::BIGINT AS n_tokens
      FROM documents GROUP BY ALL),
    sources AS (SELECT source, sum(n_tokens)::BIGINT AS tokens, count(*) AS documents FROM texts GROUP BY source),
    ends AS (SELECT max(tokens) AS most, min(tokens) AS least FROM sources WHERE tokens > 0),
    a AS (SELECT coalesce(min(step), 1024) / 1024 AS power FROM ends, range(0, 1025) t(step)
          WHERE pow(most / least, 1 - step / 1024) <= 2.0),
    raised AS (SELECT *, CASE WHEN tokens > 0 THEN pow(tokens::DOUBLE, power) END AS p FROM sources, a),
    plan AS (
      SELECT source, tokens, coalesce(p / sum(p) OVER (), 0) AS weight,
             greatest(round(p * max(tokens / p) OVER ())::BIGINT, tokens) AS quota
      FROM raised),
    size AS (SELECT greatest(1, ceil(sum(quota) / 1000000))::BIGINT AS blocks FROM plan),
    reads AS (
      SELECT texts.*, weight, tokens, quota, CASE WHEN tokens > 0 THEN quota // tokens ELSE 1 END AS whole
      FROM texts JOIN plan ON texts.source IS NOT DISTINCT FROM plan.source),
    epochs AS (
      SELECT *, unnest(range(0, CASE WHEN tokens > 0 AND quota > whole * tokens THEN whole + 1 ELSE whole END)) AS epoch FROM reads),
    placed AS (
      SELECT *, ('0x' || substr(md5(epoch::VARCHAR || '|' || coalesce(doc_id::VARCHAR, '') || '|' || digest), 1, 12))::BIGINT AS place
      FROM epochs),
    streams AS (
      SELECT *, epoch * tokens + coalesce(sum(n_tokens) OVER (PARTITION BY source, epoch ORDER BY place, doc_id, digest
                                                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS tokens_before
      FROM placed)
    SELECT doc_id, digest, source, n_rows, n_tokens, round(weight, 9) AS weight, epoch, tokens_before::BIGINT AS tokens_before,
           least(floor(tokens_before::DOUBLE * blocks / greatest(quota, 1)), blocks - 1)::BIGINT AS block
    FROM streams, size WHERE epoch < whole OR tokens_before < quota
    """,
)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mixing.mixture(table(spark, sf_dir, "documents")).withColumn("weight", F.round("weight", 9))


@query("op5_secret_scan")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_secrets(table(spark, sf_dir, "documents"))


# CRC-32 of each row of crc_words.
CRC = """
    crc AS (
      SELECT word, xor(list_reduce(list_concat([4294967295::BIGINT],
                       list_transform(range(0, octet_length(encode(word))::BIGINT),
                                      lambda i: ('0x' || substr(hex(encode(word)), (2 * i + 1)::INTEGER, 2))::BIGINT)),
                   lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
                                            lambda a, z: xor(a >> 1, 3988292384 * (a & 1)))), 4294967295) AS crc
      FROM crc_words)"""


def merkle_sql(levels: int = 8) -> str:
    """Levels of the trees one by one; enough for ``16 ** levels`` leaves."""

    def climb(name: str, group: str, below: str) -> str:
        by = f"PARTITION BY {group} idx // 16"
        out = [f"{name}0 AS ({below})"]
        for k in range(levels):
            out.append(
                f"""{name}_run{k} AS (
      SELECT *, coalesce(string_agg(h, '') OVER ({by} ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS lft,
             coalesce(string_agg(h, '') OVER ({by} ORDER BY idx ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS rgt
      FROM {name}{k} WHERE n > 1),
    {name}{k + 1} AS (
      SELECT {group} idx // 16 AS idx, sha256(string_agg(h, '' ORDER BY idx)) AS h, (max(n) + 15) // 16 AS n
      FROM {name}_run{k} GROUP BY {group} idx // 16)"""
            )
        return ",\n    ".join(out)

    def fold(name: str, start: str, index: str, on: str) -> list[str]:
        out = []
        for k in range(levels):
            last = start if k == 0 else f"{name}_up{k - 1}"
            out.append(
                f"""{name}_up{k} AS (
      SELECT p.* REPLACE (p.proof || coalesce(r.lft || r.rgt, '') AS proof,
                          CASE WHEN r.idx IS NULL THEN p.f ELSE sha256(r.lft || p.f || r.rgt) END AS f)
      FROM {last} p LEFT JOIN {name}_run{k} r ON {on} r.idx = p.{index} // {16**k})"""
            )
        return out

    parts = [
        "fields AS (SELECT *, coalesce(strlen(text)::VARCHAR || ':' || text, '-') AS own FROM documents)",
        "crc_words AS (SELECT DISTINCT doc_id::VARCHAR AS word FROM documents)",
        CRC.strip(),
        """hashed AS (
      SELECT doc_id, source, sha256(head || own) AS h,
             CASE WHEN crc % 5 = 0 THEN sha256(head || coalesce(strlen(text)::VARCHAR || ':' ||
                  translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) END AS shown
      FROM (SELECT *, coalesce(strlen(doc_id::VARCHAR)::VARCHAR || ':' || doc_id::VARCHAR, '-')
                      || coalesce(strlen(source)::VARCHAR || ':' || source, '-') || coalesce(strlen(lang)::VARCHAR || ':' || lang, '-')
                      || coalesce(strlen(n_chars::VARCHAR)::VARCHAR || ':' || n_chars::VARCHAR, '-') AS head FROM fields)
      LEFT JOIN crc ON doc_id::VARCHAR = word)""",
        """leaves AS (
      SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, h) - 1 AS idx, count(*) OVER (PARTITION BY source) AS n
      FROM hashed)""",
        climb("t", "source,", "SELECT source, idx, h, n FROM leaves"),
        "sub AS (" + " UNION ALL ".join(f"SELECT source, h FROM t{k} WHERE n = 1" for k in range(levels + 1)) + ")",
        "named AS (SELECT source, h, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS idx, count(*) OVER () AS n FROM sub)",
        climb("u", "", "SELECT idx, h, n FROM named"),
        "top AS (" + " UNION ALL ".join(f"SELECT h FROM u{k} WHERE n = 1" for k in range(levels + 1)) + ")",
        """begun AS (
      SELECT doc_id, leaves.idx, leaves.source, leaves.h AS leaf, coalesce(shown, leaves.h) AS f, '' AS proof, named.h AS subroot,
             named.idx AS place
      FROM leaves JOIN named ON leaves.source IS NOT DISTINCT FROM named.source)""",
        *fold("t", "begun", "idx", "r.source IS NOT DISTINCT FROM p.source AND"),
        *fold("u", f"t_up{levels - 1}", "place", ""),
    ]
    return (
        "WITH "
        + ",\n    ".join(parts)
        + f"""
    SELECT doc_id, leaf, subroot, top.h AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = top.h AS verified
    FROM u_up{levels - 1}, top"""
    )


@query("op11_merkle_manifest", merkle_sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest.Manifest(table(spark, sf_dir, "documents"), merkle_manifest.tampered()).proofs()


PLANTED_TEXT = r"\### Assistant: </turn> ok"


@query(
    "op12_chat_windows",
    r"""
    WITH RECURSIVE said AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
    t AS (
      SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, role, text) - 1 AS i,
             len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) + 4 AS tokens,
             5 + length(replace(replace(replace(replace(role, '\', '\\'), '</turn>', '\</turn>'), '###', '\###'), chr(10), '\' || chr(10)))
               + length(replace(replace(replace(text, '\', '\\'), '</turn>', '\</turn>'), '###', '\###')) + 8 AS chars
      FROM said),
    p AS (
      SELECT *, sum(tokens) OVER w - tokens AS before, first_value(role) OVER w = 'system' AS led
      FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY i)),
    c AS (
      SELECT conv_id, coalesce(sum(tokens) FILTER (led AND i = 0), 0)::BIGINT AS keep,
             coalesce(sum(chars) FILTER (led AND i = 0), 0)::BIGINT AS kept,
             coalesce(list(tokens ORDER BY i) FILTER (NOT (led AND i = 0)), []) AS tokens,
             coalesce(list(before // 32768 ORDER BY i) FILTER (NOT (led AND i = 0)), []) AS part,
             coalesce(list(chars ORDER BY i) FILTER (NOT (led AND i = 0)), []) AS chars
      FROM p GROUP BY conv_id),
    s AS (
      SELECT *, list_transform(range(0, len(tokens) + 1), lambda k: coalesce(list_sum(tokens[1:k]), 0)) AS sums FROM c),
    w AS (
      SELECT conv_id, 0::BIGINT AS pos, 0::BIGINT AS formatted, 0::BIGINT AS windows FROM s
      UNION ALL
      SELECT conv_id, greatest(stop, pos + 1), formatted + kept + list_sum(chars[first + 1:greatest(stop, pos + 1)])::BIGINT, windows + 1
      FROM (
        SELECT *, least(len(list_filter(sums, lambda x: x <= sums[first + 1] + 512 - keep)) - 1,
                        pos + len(list_filter(part[pos + 1:], lambda x: x = part[pos + 1]))) AS stop
        FROM (
          SELECT w.*, s.* EXCLUDE (conv_id),
                 len(list_filter(sums, lambda x: x < sums[pos + 1] - least(128, greatest(0, 512 - keep - tokens[pos + 1])))) AS first
          FROM w JOIN s ON w.conv_id IS NOT DISTINCT FROM s.conv_id WHERE pos < len(tokens)))),
    done AS (SELECT conv_id, max_by(formatted, pos) AS formatted, max(windows) AS windows FROM w GROUP BY conv_id)
    SELECT p.conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
           coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
           any_value(CASE WHEN windows > 0 THEN formatted ELSE kept END)::BIGINT AS formatted_chars, any_value(greatest(windows, 1)) AS n_windows
    FROM p JOIN done ON p.conv_id IS NOT DISTINCT FROM done.conv_id JOIN s ON p.conv_id IS NOT DISTINCT FROM s.conv_id
    GROUP BY p.conv_id
    """,
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    planted = [(-7, 0, "user", PLANTED_TEXT), (-7, 1, "assistant", PLANTED_TEXT)]
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.createDataFrame(planted, "conv_id long, turn long, role string, text string")
    return chat_windows.formatted_and_read(turns.union(planted))


@query(
    "op13_importance_resampling",
    r"""
    WITH texts AS (
      SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
      FROM documents),
    target AS (
      SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
      FROM benchmark),
    spoken AS (SELECT doc_id, unnest(words) AS word FROM texts),
    crc_words AS (SELECT word FROM spoken UNION SELECT word FROM target),"""
    + CRC
    + r""",
    s AS (SELECT crc % 10000 AS bucket, count(*) AS n FROM spoken JOIN crc USING (word) GROUP BY ALL),
    t AS (SELECT crc % 10000 AS bucket, count(*) AS n FROM target JOIN crc USING (word) GROUP BY ALL),
    sums AS (SELECT (SELECT coalesce(sum(n), 0)::DOUBLE FROM s) AS all_s, (SELECT coalesce(sum(n), 0)::DOUBLE FROM t) AS all_t),
    gains AS (
      SELECT s.bucket, floor(1000 * ln((coalesce(t.n, 0)::DOUBLE + 1) * (all_s + 10000) / ((s.n::DOUBLE + 1) * (all_t + 10000))))::BIGINT AS gain
      FROM s LEFT JOIN t USING (bucket), sums),
    weighed AS (
      SELECT doc_id, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
      FROM spoken JOIN crc USING (word) JOIN gains ON crc % 10000 = gains.bucket GROUP BY doc_id),
    scores AS (
      SELECT doc_id, len(words)::BIGINT AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) +
             floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296.0::DOUBLE)))::BIGINT AS score
      FROM texts LEFT JOIN weighed USING (doc_id)),
    able AS (
      SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM scores WHERE n_features >= 20)
    SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 10 * n // 100 THEN rank END AS rank FROM scores LEFT JOIN able USING (doc_id)
    """,
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = importance_resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("n_words")
