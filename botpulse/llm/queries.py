"""The queries ``opN_<name>``: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from botpulse.llm import (
    dart_minhash, decontaminate, lexical_search, license_scan, line_dedup, merkle, mixing, pii, quality, secrets,
    substring_dedup, token_counts, url_filter)
from botpulse.llm.common import read_documents


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_dedup.line_dedup(read_documents(spark, sf_dir))
    return done.select("doc_id", "n_removed", F.length("kept_text").cast("long").alias("kept_chars"),
                       F.sha2("kept_text", 256).alias("kept_sha256"))


# Runs of three lines, or of fewer with 8 words: content of each, its first place, lines covered by later places.
OP1_SQL = r"""
WITH raw AS (
  SELECT doc_id, coalesce(text, '') AS text FROM documents
), parts AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS place FROM raw
), stripped AS (
  SELECT *, trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body FROM parts
), numbered AS (
  SELECT doc_id, place, body, len(regexp_extract_all(body, '[^\x20\x09-\x0D]+')) AS n_words,
         row_number() OVER (PARTITION BY doc_id ORDER BY place) AS number
  FROM stripped WHERE body <> ''
), following AS (
  SELECT *, lead(body, 1) OVER w AS second, lead(body, 2) OVER w AS third, lead(n_words, 1) OVER w AS n_second
  FROM numbered WINDOW w AS (PARTITION BY doc_id ORDER BY number)
), runs AS (
  SELECT doc_id, number, 1 AS lines, body AS content FROM following WHERE n_words >= 8
  UNION ALL
  SELECT doc_id, number, 2, body || chr(10) || second FROM following WHERE n_words + n_second >= 8
  UNION ALL
  SELECT doc_id, number, 3, body || chr(10) || second || chr(10) || third FROM following WHERE third IS NOT NULL
), ranked AS (
  SELECT doc_id, number, lines, row_number() OVER (PARTITION BY lines, content ORDER BY doc_id, number) > 1 AS later FROM runs
), covered AS (
  SELECT DISTINCT doc_id, number + unnest(range(lines)) AS number FROM ranked WHERE later
), lines_out AS (
  SELECT n.doc_id, n.place, (c.number IS NOT NULL)::INT AS gone FROM numbered n
  LEFT JOIN covered c ON c.doc_id = n.doc_id AND c.number = n.number
), marked AS (
  SELECT s.doc_id, s.place, s.line, coalesce(l.gone, 0) AS gone
  FROM stripped s LEFT JOIN lines_out l ON s.doc_id = l.doc_id AND s.place = l.place
), kept AS (
  SELECT doc_id, sum(gone)::BIGINT AS n_removed,
         coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE gone = 0), '') AS kept_text
  FROM marked GROUP BY doc_id
)
SELECT doc_id, n_removed, length(kept_text)::BIGINT AS kept_chars, sha256(kept_text) AS kept_sha256 FROM kept
"""


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(read_documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.secret_spans(read_documents(spark, sf_dir).select("doc_id", "text"))

    def count(kind: int):
        return F.size(F.filter("secrets", lambda s: s.kind == kind)).cast("long")

    base = F.filter("secrets", lambda s: s.kind < 3)
    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                        F.sha2(secrets.as_text(base), 256).alias("base_sha256"),
                        secrets.as_text(F.col("secrets")).alias("spans"))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    return dart_minhash.near_duplicate_classes(docs).select("doc_id", "class_id", "class_keeps")


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    leaks = decontaminate.find_leaks(read_documents(spark, sf_dir), read_documents(spark, sf_dir, "benchmark"))
    return leaks.drop("key")


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.license_scan(read_documents(spark, sf_dir))
    return found.select("doc_id", F.size("licenses").cast("long").alias("n_licenses"),
                        F.array_join(F.transform("licenses", lambda m: F.concat_ws(
                            ":", m.license, m.start.cast("string"), m.end.cast("string"))), ",").alias("licenses"),
                        F.coalesce(F.array_max(F.transform("licenses", lambda m: m.coverage)), F.lit(0.0)).alias("coverage"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.pii_spans(read_documents(spark, sf_dir))

    def count(kind: int):
        return F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long")

    base = F.filter("spans", lambda s: s.kind < pii.N_BASE)
    return found.select("doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(pii.KINDS[:pii.N_BASE])],
                        F.sha2(pii.as_text(base), 256).alias("base_sha256"),
                        pii.as_text(F.col("spans")).alias("spans"))


def op8_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    counted = token_counts.token_counts(read_documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_documents(spark, sf_dir)).select(
        "doc_id", "source", "lang", "topic", "n_tokens", "probability", "weight", "kept")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(read_documents(spark, sf_dir), window=35, keep_text=False)


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    claimed = {"n_chars": F.when(tampered, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}
    return merkle.merkle_manifest(read_documents(spark, sf_dir), claimed=claimed).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


# Nodes of all levels by recursion, paths by the index shifted right, folding by list_reduce; CRC-32 bit by bit.
OP11_SQL = r"""
WITH RECURSIVE given AS (
  SELECT doc_id, coalesce('1' || lang, '0') AS g,
         coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
         || coalesce(strlen(lang) || ':' || lang, '-') AS head,
         coalesce(strlen(text) || ':' || text, '-') AS body, n_chars,
         list_reduce(list_concat([4294967295::UBIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::UBIGINT)),
                     lambda c, b: list_reduce(list_concat([xor(c, b)], list_transform(range(8), lambda k: k::UBIGINT)),
                                           lambda x, k: xor(x >> 1, 3988292384::UBIGINT * (x & 1::UBIGINT)))) AS crc
  FROM documents
), hashed AS (
  SELECT doc_id, g, sha256(head || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || body) AS leaf,
         CASE WHEN xor(crc, 4294967295::UBIGINT) % 7 = 0
              THEN sha256(head || coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') || body) END AS changed
  FROM given
), leaves AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY g) AS n
  FROM hashed
), nodes AS (
  SELECT g, 0 AS level, i, n, leaf AS digest FROM leaves
  UNION ALL
  SELECT g, any_value(level) + 1, i // 2, any_value((n + 1) // 2), sha256(string_agg(digest, '' ORDER BY i))
  FROM nodes WHERE n > 1 GROUP BY g, i // 2
), subroots AS (
  SELECT g, digest AS subroot, row_number() OVER (ORDER BY g) - 1 AS i, count(*) OVER () AS n FROM nodes WHERE n = 1
), tops AS (
  SELECT 0 AS level, i, n, subroot AS digest FROM subroots
  UNION ALL
  SELECT any_value(level) + 1, i // 2, any_value((n + 1) // 2), sha256(string_agg(digest, '' ORDER BY i))
  FROM tops WHERE n > 1 GROUP BY i // 2
), steps AS (
  SELECT l.g, l.i, s.level, (l.i >> s.level) % 2 AS slot, coalesce(o.digest, '') AS sibling
  FROM leaves l JOIN (SELECT DISTINCT g, level FROM nodes WHERE n > 1) s ON l.g = s.g
  LEFT JOIN nodes o ON o.g = l.g AND o.level = s.level AND o.i = xor(l.i >> s.level, 1)
  UNION ALL
  SELECT l.g, l.i, 1000 + s.level, (r.i >> s.level) % 2, coalesce(o.digest, '')
  FROM leaves l JOIN subroots r ON l.g = r.g CROSS JOIN (SELECT DISTINCT level FROM tops WHERE n > 1) s
  LEFT JOIN tops o ON o.level = s.level AND o.i = xor(r.i >> s.level, 1)
), proofs AS (
  SELECT g, i, string_agg(sibling, '' ORDER BY level) AS proof, list(slot || sibling ORDER BY level) AS path FROM steps GROUP BY g, i
), joined AS (
  SELECT l.*, r.subroot, coalesce(p.proof, '') AS proof, coalesce(p.path, []) AS path, (SELECT digest FROM tops WHERE n = 1) AS root
  FROM leaves l JOIN subroots r ON l.g = r.g LEFT JOIN proofs p ON p.g = l.g AND p.i = l.i
), done AS (
  SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256,
         list_reduce(list_concat([coalesce(changed, leaf)], path), lambda acc, s:
           CASE WHEN s[1] = '1' THEN sha256(s[2:] || acc) ELSE sha256(acc || s[2:]) END) AS folded_root
  FROM joined
)
SELECT *, folded_root = root AS verified FROM done
"""

def op12_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.lexical_search(read_documents(spark, sf_dir), read_documents(spark, sf_dir, "benchmark"))


# Every pair of item and document that shares a term, scored.
OP12_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents
), sized AS (
  SELECT doc_id, row_number() OVER () AS row, terms, len(terms) AS n FROM words WHERE len(terms) > 0
), total AS (
  SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM sized
), held AS (
  SELECT row, doc_id, n, term, count(*) AS tf FROM (SELECT row, doc_id, n, unnest(terms) AS term FROM sized) GROUP BY ALL
), weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM held, total
  GROUP BY term, n_docs
), asked AS (
  SELECT DISTINCT item, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT *, row_number() OVER () AS item FROM benchmark)
), scored AS (
  SELECT item, item_id, row, doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN held USING (term), total GROUP BY item, item_id, row, doc_id
), ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM scored WHERE score > 0
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 50
"""

URL_RULES: list[url_filter.Rule] = [
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"), ("block", "com", "/de/"),
]


def op13_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.url_verdicts(read_documents(spark, sf_dir, "pages"), URL_RULES)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_quality": op2_quality,
    "op3_secrets": op3_secrets,
    "op4_near_duplicates": op4_near_duplicates,
    "op5_decontaminate": op5_decontaminate,
    "op6_licenses": op6_licenses,
    "op7_pii": op7_pii,
    "op8_tokens": op8_tokens,
    "op9_mixing": op9_mixing,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_merkle": op11_merkle,
    "op12_search": op12_search,
    "op13_urls": op13_urls,
}

ORACLES: dict[str, str] = {
    "op1_line_dedup": OP1_SQL,
    "op11_merkle": OP11_SQL,
    "op12_search": OP12_SQL,
}
