"""Registered queries of the subpackage and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starfold.llm import (
    chat_repair,
    chat_tools,
    decontaminate,
    language_id,
    licenses,
    line_dedup,
    lm_score,
    near_dup,
    packing,
    phrases,
    pieces,
    quality,
    suffix_dedup,
)
from starfold.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def piece_model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), keep_first=False)
    return found.withColumn("has_repeats", F.col("n_removed") > 0)


def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.pseudo_likelihood(table(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(docs, ~language_id.held_out())
    return language_id.identify(docs, model)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out, dropped = line_dedup.dedup_lines(
        docs.withColumn("n_lines", F.size(line_dedup.text_lines(F.col("text"))).cast("long"))
    )
    return out.select(
        "doc_id",
        "n_lines",
        F.col(dropped).alias("n_dropped"),
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )


def op5_chat_tools(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = chat_tools.plain_chats(table(spark, sf_dir, "conversations"))
    return chat_tools.link_tools(messages, {"reply": chat_tools.REPLY_SCHEMA})


def op6_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), size=3, percent=85).drop("th")


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), short=True).drop("th")


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents"))


def op11_chat_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return chat_repair.repair_conversations(chat_repair.damaged(rows), rows)


def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.token_digests(table(spark, sf_dir, "documents"), piece_model_path())


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"), n_max=5, min_count=100, top=2000)


QUERIES: dict[str, Query] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_lm_score": op2_lm_score,
    "op3_language_id": op3_language_id,
    "op4_line_dedup": op4_line_dedup,
    "op5_chat_tools": op5_chat_tools,
    "op6_near_dup": op6_near_dup,
    "op7_decontaminate": op7_decontaminate,
    "op8_licenses": op8_licenses,
    "op9_packing": op9_packing,
    "op10_quality": op10_quality,
    "op11_chat_repair": op11_chat_repair,
    "op12_sentencepiece": op12_sentencepiece,
    "op13_phrases": op13_phrases,
}

SPACE = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
ORACLES: dict[str, str] = {
    "op4_line_dedup": f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM d),
k AS (SELECT *, translate(trim(line, {SPACE}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key, min(doc_id) AS first_doc FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1)
SELECT k.doc_id, count(*) AS n_lines,
       count(*) FILTER (WHERE f.key IS NOT NULL AND k.doc_id <> f.first_doc) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos)
                       FILTER (WHERE f.key IS NULL OR k.doc_id = f.first_doc), '')) AS kept_sha256
FROM k LEFT JOIN f ON k.key = f.key GROUP BY k.doc_id
""",
    "op13_phrases": r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
           FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
s AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w),
g AS (SELECT lang, array_to_string(w[i:i + k - 1], ' ') AS phrase, k, count(*) AS a
      FROM (SELECT *, unnest([1, 2, 3, 4, 5]) AS k FROM s) WHERE i + k - 1 <= len(w) GROUP BY ALL HAVING count(*) >= 100),
c AS (SELECT lang, phrase, a, k, string_split(phrase, ' ') AS w FROM g WHERE k > 1),
inner_starts AS (SELECT *, unnest(range(1, k + 1)) AS i FROM c),
inner_spans AS (SELECT *, unnest(range(i + 1, k + 1)) AS j FROM inner_starts),
inside AS (SELECT lang, array_to_string(w[i:j], ' ') AS phrase, max(a) AS most FROM inner_spans
           WHERE j - i + 1 < k GROUP BY 1, 2),
kept AS (SELECT c.* FROM c LEFT JOIN inside USING (lang, phrase) WHERE most IS NULL OR 100 * most < 100 * a),
cuts AS (SELECT *, unnest(range(1, k)) AS cut FROM kept),
scored AS (SELECT cuts.lang, cuts.phrase, cuts.a, cut, l.a AS l, r.a AS r, n.n,
                  ((1000::HUGEINT * cuts.a * n.n) // (l.a::HUGEINT * r.a))::BIGINT AS score
           FROM cuts JOIN g l ON l.lang = cuts.lang AND l.phrase = array_to_string(w[1:cut], ' ')
           JOIN g r ON r.lang = cuts.lang AND r.phrase = array_to_string(w[cut + 1:], ' ')
           JOIN n ON n.lang = cuts.lang),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM best QUALIFY rank <= 2000
""",
}
