"""The registered queries of this subpackage: ``QUERIES`` and ``ORACLE``.

Each ``opN_*`` callable applies its operator to its whole tables and derives the
contract's columns.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from subledger.llm import bpe, decontaminate, html, infill, licenses, quality, relz, secrets, simhash, topk, toxicity, trie, urls
from subledger.llm.common import read_table

#: The public vocabulary that the registered BPE query and pipeline stage use.
RANK_FILE = public_tokenizers.path("byte_bpe_50k.tiktoken")

#: Rules of the registered URL query (fixed values).
URL_RULES = [
    urls.Rule("allow", "org", "/"),
    urls.Rule("block", "example.org", "/es/"),
    urls.Rule("block", "example.org", "/en/1"),
    urls.Rule("allow", "com", "/fr/"),
    urls.Rule("block", "com", "/de/"),
]


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), window=10)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"), shingle=3, radius=2)
    return found.select("doc_id", simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.filter_urls(read_table(spark, sf_dir, "pages"), URL_RULES)


def op4_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(read_table(spark, sf_dir, "documents")).drop("detections")


def op5_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.scan_secrets(documents, secrets.train(documents))

    def of_kind(k: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")

    base = F.filter("spans", lambda s: s["kind"] < 3)
    return found.select(
        "doc_id",
        *[of_kind(k).alias(f"n_{secrets.KINDS[k]}") for k in range(3)],
        F.sha2(secrets.span_text(base), 256).alias("base_sha256"),
        secrets.span_text(F.col("spans")).alias("spans"),
    )


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    return toxicity.toxicity(documents, labels).drop("n_clauses")


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    return bpe.digests(bpe.encode_documents(documents, RANK_FILE, public_tokenizers.PATTERN))


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(read_table(spark, sf_dir, "pages"))


def op10_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = trie.conversation_trie(read_table(spark, sf_dir, "conversations"), block=100, most=5)
    ends = F.coalesce("ends", F.unhex(F.sha2(F.lit(""), 256)))
    return made.withColumns({"depth": F.col("depth").cast("long"), "ends_sha256": F.lower(F.hex(ends))}).drop("ends")


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.digests(infill.fill_in_middle(read_table(spark, sf_dir, "documents"), rate=50, spm_rate=80, seed=42))


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = relz.without_repeats(read_table(spark, sf_dir, "documents"), window=50)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_benchmark_decontamination": op1_benchmark_decontamination,
    "op2_simhash_near_dedup": op2_simhash_near_dedup,
    "op3_url_filters": op3_url_filters,
    "op4_license_scans": op4_license_scans,
    "op5_secret_scans": op5_secret_scans,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_toxicity": op7_toxicity,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_html_extraction": op9_html_extraction,
    "op10_exact_top_k": op10_exact_top_k,
    "op11_conversation_trie": op11_conversation_trie,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_substring_dedup": op13_substring_dedup,
}

ORACLE: dict[str, str] = {
    "op1_benchmark_decontamination": r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), i AS (
  SELECT item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), ip AS (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS s FROM i WHERE len(w) > 0),
wins AS (SELECT DISTINCT item_id, list_slice(w, s, least(s + 9, len(w))) AS win FROM ip),
lens AS (SELECT DISTINCT len(win) AS n FROM wins),
dp AS (SELECT rid, w, n, unnest(generate_series(1, len(w) - n + 1)) AS s FROM d, lens WHERE len(w) >= n),
hits AS (SELECT dp.rid, dp.s, dp.n, wins.item_id FROM dp JOIN wins ON list_slice(dp.w, dp.s, dp.s + dp.n - 1) = wins.win),
places AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(generate_series(s, s + n - 1)) AS p FROM hits) GROUP BY rid),
ids AS (
  SELECT rid, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS id_text
  FROM (SELECT DISTINCT rid, item_id::VARCHAR AS id FROM hits WHERE item_id IS NOT NULL) GROUP BY rid
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(id_text, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN places USING (rid) LEFT JOIN ids USING (rid)
""",
    "op10_exact_top_k": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.e::DOUBLE[], c.e::DOUBLE[])::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5
""",
    "op11_conversation_trie": r"""
WITH t AS (
  SELECT conv_id, list(struct_pack(r := coalesce(role, ''), x := coalesce(text, '')) ORDER BY turn NULLS FIRST) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), h AS (
  SELECT *, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)),
    lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                                  lambda c, z: xor(c >> 1, (c & 1) * 3988292384))), 4294967295::BIGINT) % 6 AS h
  FROM t
), s AS (
  SELECT h.conv_id, list_concat(coalesce(list_slice(d.turns, 1, h.h), []), list_slice(h.turns, h.h + 1, len(h.turns))) AS seq
  FROM h LEFT JOIN t d ON d.conv_id = h.conv_id - h.conv_id % 100
), p AS (SELECT conv_id, len(seq) AS size, depth, list_slice(seq, 1, depth) AS prefix
         FROM (SELECT *, unnest(generate_series(0, len(seq))) AS depth FROM s)),
n AS (
  SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE size = depth), '')) AS ends_sha256
  FROM p GROUP BY prefix, depth
), up AS (SELECT list_slice(prefix, 1, depth - 1) AS prefix, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
own AS (
  SELECT n.*, coalesce(up.n_children, 0) AS n_children,
    CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * length(prefix[depth].x) END AS saved
  FROM n LEFT JOIN up USING (prefix)
), below AS (
  SELECT list_slice(prefix, 1, above) AS prefix, sum(saved) AS saved_tokens, count(*) FILTER (WHERE n_children = 0) AS n_leaves
  FROM (SELECT *, unnest(generate_series(0, depth)) AS above FROM own) GROUP BY 1
)
SELECT own.conv_id, own.depth, parent.conv_id AS parent_conv_id, own.n_convs, own.n_children, n_leaves,
  saved_tokens::BIGINT AS saved_tokens, own.ends_sha256
FROM own JOIN below USING (prefix) LEFT JOIN n parent ON own.depth > 0 AND parent.prefix = list_slice(own.prefix, 1, own.depth - 1)
""",
    "op12_fill_in_middle": r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS hex,
    regexp_extract_all(coalesce(text, ''), '[ 	-
]*[^ 	-
]+|[ 	-
]+') AS u
  FROM documents
), h AS (
  SELECT *, len(u) AS n, list_transform([1, 9, 17, 25], lambda i: ('0x' || substr(hex, i, 8))::BIGINT) AS h FROM d
), c AS (
  SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
    CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 50 THEN 'plain'
         WHEN h[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM h
), o AS (
  SELECT *, array_to_string(list_slice(u, 1, a), '') AS pre, array_to_string(list_slice(u, a + 1, b), '') AS mid,
    array_to_string(list_slice(u, b + 1, n), '') AS suf
  FROM c
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                   ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM o
""",
    "op13_substring_dedup": r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^ 	-
]+') AS w FROM documents
), p AS (
  SELECT rid, doc_id, s, array_to_string(list_slice(w, s, s + 49), ' ') AS win
  FROM (SELECT *, unnest(generate_series(1, len(w) - 49)) AS s FROM d WHERE len(w) >= 50 AND doc_id IS NOT NULL)
), m AS (SELECT win, min(doc_id) AS least FROM p GROUP BY win HAVING min(doc_id) < max(doc_id)),
gone AS (
  SELECT rid, list(DISTINCT i) AS gone FROM (SELECT rid, unnest(generate_series(s, s + 49)) AS i FROM p JOIN m USING (win) WHERE doc_id > least)
  GROUP BY rid
)
SELECT doc_id, len(w) AS n_words, coalesce(len(gone), 0) AS n_removed,
  sha256(coalesce(array_to_string(CASE WHEN gone IS NULL THEN w
    ELSE list_transform(list_filter(list_zip(w, generate_series(1, len(w))), lambda x: NOT list_contains(gone, x[2])), lambda x: x[1]) END, ' '), '')) AS kept_sha256
FROM d LEFT JOIN gone USING (rid)
""",
}
