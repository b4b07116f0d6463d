"""The operators bound to the given tables, with production parameters, and SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm import contamination, language, lexical, mixing, negatives, secrets, simhash, substrings, token_counts, token_store, transducer, vectors, warc
from tidewell.llm.common import load
from tidewell.session import scratch_path


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents", "doc_id", "text")
    manifest, dictionary = token_store.write_token_store(docs, scratch_path(spark, "token-store"), tokenizer_path("byte_bpe_50k.json"))
    return token_store.id_checksums(token_store.read_token_store(manifest, dictionary))


def op2_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substrings.drop_repeats(load(spark, sf_dir, "documents", "doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents", "doc_id", "text", "lang")
    training = language.learn(docs.where(~language.held_out(F.col("doc_id"))))
    found = language.identify(docs, training)
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op4_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = load(spark, sf_dir, "documents", "doc_id", "text"), load(spark, sf_dir, "benchmark", "item_id", "text")
    return contamination.find_leaks(docs, items)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(load(spark, sf_dir, "documents", "doc_id", "text"), tokenizer_path("piece_bpe_32k.model"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(load(spark, sf_dir, "documents", "doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = load(spark, sf_dir, "pages", "page_id", "url", "html")
    read = warc.read_archives(warc.write_archives(warc.decide(pages), scratch_path(spark, "warc")))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(load(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(load(spark, sf_dir, "documents", "doc_id", "text"))

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("spans", lambda s: s["kind"].isin("assign", "access", "hex"))

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"), F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans")
    )


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(load(spark, sf_dir, "documents", "doc_id", "text"))


def op11_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs, ranks = load(spark, sf_dir, "documents", "doc_id", "text"), tokenizer_path("byte_bpe_multi_50k.tiktoken")
    encoded = transducer.encode_texts(docs, ranks, public_tokenizers.PATTERN, decode=True)
    return encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op12_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(load(spark, sf_dir, "documents", "doc_id", "text"), load(spark, sf_dir, "benchmark", "item_id", "text"))


def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(load(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"), F.col("vec_id") % 100 == 0, label)


LEAK_SQL = r"""
WITH i AS (
  SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w FROM benchmark),
d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w FROM documents),
si AS (
  SELECT DISTINCT item_id, least(len(w), 5) AS n, array_to_string(w[p:p + least(len(w), 5) - 1], ' ') AS s
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 5, 0) + 2)) AS p FROM i WHERE len(w) > 0)),
sd AS (
  SELECT DISTINCT doc_id, n, array_to_string(w[p:p + n - 1], ' ') AS s
  FROM (SELECT d.*, l.n, unnest(range(1, len(w) - n + 2)) AS p FROM d, (SELECT DISTINCT n FROM si) l WHERE len(w) >= n)),
c AS (SELECT item_id, CAST(count(*) AS INTEGER) AS n_item FROM si GROUP BY item_id),
m AS (SELECT doc_id, item_id, CAST(count(*) AS INTEGER) AS n_shared FROM sd JOIN si USING (n, s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_shared, n_item, n_shared / n_item AS containment
FROM m JOIN c USING (item_id) WHERE n_shared >= ceil(n_item * 0.8 - 1e-9)
"""

MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || '|' || md5(coalesce(text, ''))), 1, 15) AS BIGINT) AS h
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight,
    3 * source_size AS room FROM s),
r AS (
  SELECT *, CAST(sum(source_size) OVER () AS DOUBLE) AS total,
    CAST(coalesce(sum(room) OVER (ORDER BY room / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) AS used,
    CAST(sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY room / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) AS rest_weight
  FROM w),
c AS (
  SELECT *, min_by((total - used) / rest_weight, room / weight) FILTER (WHERE (total - used) / rest_weight * weight <= room) OVER () AS common FROM r),
t AS (
  SELECT source, source_size,
    CASE WHEN common IS NULL OR room / weight < common THEN CAST(room AS DOUBLE) ELSE common * weight END AS target FROM c),
p AS (SELECT *, coalesce(floor(target / nullif(source_size, 0)), 0) AS whole FROM t),
m AS (
  SELECT d.*, p.source_size, p.target, p.whole, p.target - p.whole * p.source_size AS rest,
    sum(size) OVER (PARTITION BY d.source ORDER BY h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
    sum(size) OVER (PARTITION BY d.source, h) AS tied
  FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target,
  CAST((whole + CASE WHEN whole < 3 AND upto - tied / 2 <= rest THEN 1 ELSE 0 END) * size AS BIGINT) AS taken
FROM m
"""

WARC_SQL = """
WITH p AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
  FROM pages),
g AS (SELECT payload_digest, max(page_id) AS newest FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest HAVING count(*) > 1)
SELECT page_id, payload_bytes, p.payload_digest,
  CASE WHEN newest IS NOT NULL AND page_id IS DISTINCT FROM newest THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN newest IS NOT NULL AND page_id IS DISTINCT FROM newest THEN newest END AS refers_to
FROM p LEFT JOIN g ON p.payload_digest = g.payload_digest
"""

SEARCH_SQL = r"""
WITH t AS (
  SELECT doc_id, CAST(row_number() OVER () AS BIGINT) AS row,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
d AS (SELECT *, CAST(len(w) AS BIGINT) AS n FROM t WHERE len(w) > 0),
g AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS total FROM d),
i AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
p AS (SELECT row, doc_id, n, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT row, doc_id, n, unnest(w) AS term FROM d) GROUP BY ALL),
f AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM p GROUP BY term), g),
s AS (
  SELECT item_id, row, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // total)))) AS BIGINT) AS score
  FROM i JOIN p USING (term) JOIN f USING (term), g GROUP BY ALL),
r AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= 50
"""

NEGATIVES_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS row, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.row AS anchor, a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
    CAST(list_sum(list_transform(range(1, len(a.q) + 1), lambda k: a.q[k] * b.q[k])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.row <> b.row AND len(a.q) = len(b.q) WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor, anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other NULLS LAST) <= 5),
n AS (
  SELECT p.anchor_id, positive_id, other AS negative_id, positive_score, score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor, positive_id, positive_score ORDER BY score DESC, other NULLS LAST) AS rank
  FROM p JOIN s ON p.anchor = s.anchor AND NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""

#: Name: (query, SQL or None).
QUERIES = {
    "op1_token_store": (op1_token_store, None),
    "op2_substrings": (op2_substrings, None),
    "op3_language": (op3_language, None),
    "op4_leaks": (op4_leaks, LEAK_SQL),
    "op5_token_counts": (op5_token_counts, None),
    "op6_mixing": (op6_mixing, MIX_SQL),
    "op7_warc": (op7_warc, WARC_SQL),
    "op8_vectors": (op8_vectors, None),
    "op9_secrets": (op9_secrets, None),
    "op10_simhash": (op10_simhash, None),
    "op11_transducer": (op11_transducer, None),
    "op12_lexical": (op12_lexical, SEARCH_SQL),
    "op13_negatives": (op13_negatives, NEGATIVES_SQL),
}
