"""The registered queries of the corpus operators, and their SQL for DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe,
    chat,
    decontam,
    exact_dedup,
    merkle,
    pii,
    quality,
    repair,
    simhash,
    substring,
    suffix,
    token_counts,
    toxicity,
)
from .common import table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
WORD_VOCABULARY = "word_bpe_49k.json"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_groups(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        F.lpad(F.lower(F.hex(F.get("fp", F.lit(0)))), 16, "0").alias("fingerprint"),
        "component_id",
    )


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring.substring_dedup(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = pii.find(docs, pii.fit(docs))

    def joined(spans):
        order = F.transform(
            spans,
            lambda s: F.struct(
                s["start"].alias("start"),
                F.array_position(F.array(*[F.lit(k) for k in pii.KINDS]), s["kind"]).alias("rank"),
                F.concat_ws(":", s["kind"], s["start"], s["end"]).alias("name"),
            ),
        )
        return F.array_join(F.transform(F.sort_array(order), lambda s: s["name"]), ",")

    def counted(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [counted(k) for k in pii.KINDS]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.concat("base", "added")).alias("spans"),
    )


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def vocabulary() -> tuple[str, str]:
    """Path and word pattern of the public vocabulary."""
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = vocabulary()
    return bpe.encode(table(spark, sf_dir, "documents"), path, pattern, decoded=True).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id",
        toxicity.held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
        F.size("passages").alias("n_passages"),
    )


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix.suffix_dedup(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    added = spark.sql("SELECT -7L AS conv_id, turn, role FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)")
    turns = (
        table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
        .unionByName(added.withColumn("text", F.lit(said)))
    )
    chats = chat.format_chats(turns)
    read = chats.select(
        "conv_id",
        chat.read_turns(F.col("formatted")).alias("turns"),
        chat.loss_text(F.col("segments")).alias("loss"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
        "valid",
        "first_fault",
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
        "valid",
        "first_fault",
    )


OP9_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, t, r, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(t, r)
), said AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS whole,
    coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
    sum(15 + length(role) + length(role) - length(replace(replace(replace(role, '\', ''), '<', ''), chr(10), ''))
      + length(text) + length(text) - length(replace(replace(text, '\', ''), '<', ''))) AS formatted_chars
  FROM turns GROUP BY conv_id
), placed AS (
  SELECT conv_id, role, row_number() OVER spoken - 1 AS place, lag(role, 1, '') OVER spoken AS before FROM turns
  WINDOW spoken AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), faults AS (
  SELECT conv_id, min(place) FILTER (before || '>' || role NOT IN
    ('>system', '>user', 'system>user', 'user>assistant', 'assistant>user')) AS first_fault
  FROM placed GROUP BY conv_id
)
SELECT said.conv_id, n_turns, sha256(whole) AS turns_sha256, length(loss) AS loss_chars,
  sha256(loss) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars,
  first_fault IS NULL AS valid, CAST(first_fault AS BIGINT) AS first_fault
FROM said JOIN faults ON said.conv_id IS NOT DISTINCT FROM faults.conv_id
"""


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.exact_groups(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_VOCABULARY))


def damaged(turns: DataFrame) -> DataFrame:
    """Each row dropped, emptied, without its stops, repeated, made a user's, or left, as its number tells."""
    blank = F.lit(" ")
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), blank) for c in ("conv_id", "turn")])
    lot = F.crc32(name) % 20
    text = F.coalesce("text", blank)
    return turns.filter(lot != 0).select(
        "conv_id",
        "turn",
        F.when(lot == 4, "user").otherwise(F.coalesce("role", blank)).alias("role"),
        F.when(lot == 1, "").when(lot == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(F.when(lot == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    )


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    found = repair.repair(damaged(turns))
    facts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    nothing = {f: F.lit(None).cast("long") for f in facts} | {"audit": F.lit(None).cast("string")}
    lines = [
        turns.select("conv_id").distinct().withColumns(nothing | {"sha256": F.lit(None).cast("string")}),
        found.conversations.withColumn("sha256", F.lit(None).cast("string")),
        repair.digests(found.pieces).withColumns(nothing),
    ]
    whole = lines[0].unionByName(lines[1]).unionByName(lines[2])
    merged = whole.groupBy("conv_id").agg(*[F.max(c).alias(c) for c in [*facts, "audit", "sha256"]])
    return merged.select(
        "conv_id",
        *[F.coalesce(f, F.lit(0)).cast("long").alias(f) for f in facts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    tried = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    lowered = F.translate("text", CAPITALS, CAPITALS.lower())
    found = merkle.manifest(
        table(spark, sf_dir, "documents"), {"text": F.when(tried, lowered).otherwise(F.col("text"))}
    )
    return found.drop("path")


#: CRC32 of an ASCII string ``s`` in SQL: a fold over its bytes, of a fold over the bits of each.
CRC32 = """xor(4294967295, list_reduce(
      list_concat([4294967295], list_transform(string_split(s, ''), lambda c: CAST(ascii(c) AS BIGINT))),
      lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0],
        lambda x, z: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)))"""


def _op12_sql() -> str:
    """Paths as strings, six digits of cost and the letters; a fold over gaps and rows keeps the least for each state."""

    def put(letter: str, cost: str, states: str, when: str = "") -> str:
        paths = [
            f"lpad(CAST(CAST(a.s{q}[1:6] AS INT) + {cost} AS VARCHAR), 6, '0') || a.s{q}[7:] || '{letter}'" for q in states
        ]
        return ", ".join(f"CASE WHEN {when} THEN {p} END" if when else p for p in paths)

    gap = f"""'s0': a.s0, 's1': a.s1, 's2': least(a.s2, {put("I", "2", "013")}), 's3': least(a.s3, {put("I", "2", "2")})"""
    live, kept = "NOT x.dead", "NOT x.dead AND x.r = "
    stays, rerole = "x.cut", "2 + x.cut"
    row = f"""'s0': {put("D", "3", "0")}, 's1': least({put("D", "3", "1")}, {put("K", stays, "0", kept + "'s'")}),
      's2': least({put("D", "3", "2")}, {put("K", stays, "013", kept + "'u'")}, {put("R", rerole, "013", live)}),
      's3': least({put("D", "3", "3")}, {put("K", stays, "2", kept + "'a'")}, {put("R", rerole, "2", live)})"""
    fixed = "'op': 'gap', 'r': '', 'dead': false, 'cut': 0"
    free = "'s0': CAST(NULL AS VARCHAR), 's1': CAST(NULL AS VARCHAR), 's2': CAST(NULL AS VARCHAR), 's3': CAST(NULL AS VARCHAR)"
    gaps = f"{{{fixed}, {free}}}, {{{fixed}, {free}}}"
    return rf"""
WITH damaged AS (
  SELECT conv_id, turn, CASE lot WHEN 4 THEN 'user' ELSE role END AS role,
    CASE lot WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM (SELECT *, {CRC32} % 20 AS lot FROM (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
      coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS s FROM conversations)),
    unnest(range(CASE lot WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END))
), placed AS (
  SELECT *, row_number() OVER w AS i, NOT regexp_matches(text, '[^ \t\n\x0B\f\r]') AS blank,
    lag(role[1]) OVER w || role[1] AS pair
  FROM damaged WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), judged AS (
  SELECT *, NOT blank AND seen AS dup,
    NOT blank AND NOT seen AND NOT regexp_matches(text, '[.!?][ \t\n\x0B\f\r]*\z') AS cut
  FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS seen FROM placed)
), decided AS (
  SELECT * EXCLUDE p, least(p.s0, p.s3) AS best FROM (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
      count(*) FILTER (blank) AS blank, count(*) FILTER (dup) AS duplicate, count(*) FILTER (cut) AS truncated,
      count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal,
      list_reduce(
        list_concat([{{{fixed}, 's0': '000000', 's1': CAST(NULL AS VARCHAR), 's2': CAST(NULL AS VARCHAR), 's3': CAST(NULL AS VARCHAR)}}],
          flatten(list([{gaps}, {{'op': 'row', 'r': role[1], 'dead': blank OR dup, 'cut': CAST(cut AS INT), {free}}}] ORDER BY i)),
          [{gaps}]),
        lambda a, x: CASE x.op WHEN 'gap' THEN {{{fixed}, {gap}}} ELSE {{{fixed}, {row}}} END) AS p
    FROM judged GROUP BY conv_id)
), letters AS (
  SELECT conv_id, k, best[6 + k] AS letter,
    count(*) FILTER (best[6 + k] <> 'I') OVER (PARTITION BY conv_id ORDER BY k) AS i,
    count(*) FILTER (best[6 + k] <> 'D') OVER (PARTITION BY conv_id ORDER BY k) AS made
  FROM decided, unnest(range(1, length(best) - 5)) AS r(k)
), said AS (
  SELECT l.*, p.role, p.text,
    max(CASE WHEN made = 1 AND letter = 'K' AND p.role[1] = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY l.conv_id) AS sys
  FROM letters l LEFT JOIN placed p ON l.conv_id IS NOT DISTINCT FROM p.conv_id AND l.i = p.i AND letter <> 'I'
), repaired AS (
  SELECT conv_id, sha256(string_agg(CASE WHEN letter = 'K' THEN role WHEN (made - sys) % 2 = 1 THEN 'user' ELSE 'assistant' END
    || ':' || coalesce(text, ''), chr(10) ORDER BY k)) AS h FROM said WHERE letter <> 'D' GROUP BY conv_id
)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(CAST(best[1:6] AS BIGINT), 0) AS cost,
  coalesce(best[7:], '') AS audit, coalesce(h, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN decided d ON c.conv_id IS NOT DISTINCT FROM d.conv_id LEFT JOIN repaired r ON c.conv_id IS NOT DISTINCT FROM r.conv_id
"""


OP12_SQL = _op12_sql()


def _op13_sql(levels: int = 8) -> str:
    """All trees level by level, each of up to 8 ** levels leaves: the leaves' siblings, and the folded digests."""
    fields = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)"]

    def leaf(text: str) -> str:
        parts = [f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in [*fields, text]]
        return f"sha256({' || '.join(parts)})"

    lone = "len(hs) = 1 AND p = 0"
    steps = []

    def climb(tree: str, key: str, nodes: str, leaves: str) -> None:
        for k in range(levels):
            steps.append(f"""{tree}g{k} AS (SELECT {key}, r // 8 AS p, list(h ORDER BY r) AS hs FROM {nodes} GROUP BY ALL),
{tree}{k} AS (SELECT {key}, p AS r, CASE WHEN {lone} THEN hs[1] ELSE sha256(array_to_string(hs, '')) END AS h FROM {tree}g{k}),
{tree}l{k} AS (
  SELECT l.* REPLACE (l.r // 8 AS r,
    CASE WHEN {lone} THEN f ELSE sha256(array_to_string(hs[1:l.r % 8], '') || f || array_to_string(hs[l.r % 8 + 2:], '')) END AS f,
    sib || array_to_string(hs[1:l.r % 8], '') || array_to_string(hs[l.r % 8 + 2:], '') AS sib)
  FROM {leaves} l JOIN {tree}g{k} g ON l.{key} IS NOT DISTINCT FROM g.{key} AND l.r // 8 = g.p)""")
            nodes, leaves = f"{tree}{k}", f"{tree}l{k}"

    climb("a", "lang", "leaves", "own")
    steps.append(f"""subs AS (SELECT lang, h, 0 AS one, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS r FROM a{levels - 1}),
upper AS (SELECT l.* REPLACE (s.r AS r), s.h AS subroot, 0 AS one FROM al{levels - 1} l JOIN subs s ON l.lang IS NOT DISTINCT FROM s.lang)""")
    climb("b", "one", "subs", "upper")
    return f"""
WITH hashed AS (
  SELECT *, {leaf("text")} AS h,
    CASE WHEN {CRC32} % 3 = 0 THEN {leaf(f"translate(text, '{CAPITALS}', '{CAPITALS.lower()}')")} ELSE {leaf("text")} END AS f
  FROM (SELECT *, CAST(doc_id AS VARCHAR) AS s FROM documents)
), leaves AS (
  SELECT doc_id, lang, h, f, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, h, f) - 1 AS r FROM hashed
), own AS (SELECT doc_id, lang, h AS leaf, f, r, '' AS sib FROM leaves),
{", ".join(steps)}
SELECT doc_id, leaf, subroot, b{levels - 1}.h AS root, sha256(sib) AS proof_sha256, f AS folded_root, f = b{levels - 1}.h AS verified
FROM bl{levels - 1}, b{levels - 1}
"""


OP13_SQL = _op13_sql()

OP10_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[ \t\n\x0B\f\r]+', ' ', 'g') AS text FROM documents
), g AS (
  SELECT doc_id, text, min(doc_id) OVER (PARTITION BY text) AS keep_id, count(*) OVER (PARTITION BY text) AS group_size
  FROM d
)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(text) AS text_sha256 FROM g
"""

OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0B\f\r]+') AS w
  FROM documents
), win AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h
  FROM d, unnest(range(1, len(w) - 48)) AS r(i) WHERE len(w) >= 50
), low AS (SELECT h, min(doc_id) AS first FROM win GROUP BY h),
gone AS (
  SELECT DISTINCT doc_id, p FROM win JOIN low USING (h), unnest(range(i, i + 50)) AS r(p) WHERE first < doc_id
), lost AS (SELECT doc_id, list(p) AS ps, count(*) AS n FROM gone GROUP BY doc_id),
kept AS (
  SELECT d.doc_id, string_agg(w[p], ' ' ORDER BY p) AS text
  FROM d, unnest(range(1, len(w) + 1)) AS r(p)
  WHERE NOT EXISTS (SELECT 1 FROM gone WHERE gone.doc_id = d.doc_id AND gone.p = r.p)
  GROUP BY d.doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN lost USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_pii": op3_pii,
    "op4_decontaminate": op4_decontaminate,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_quality": op6_quality,
    "op7_toxicity": op7_toxicity,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_chat_format": op9_chat_format,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_token_counts": op11_token_counts,
    "op12_repair": op12_repair,
    "op13_merkle": op13_merkle,
}

ORACLE_SQL = {
    "op2_substring_dedup": OP2_SQL,
    "op9_chat_format": OP9_SQL,
    "op10_exact_dedup": OP10_SQL,
    "op12_repair": OP12_SQL,
    "op13_merkle": OP13_SQL,
}
