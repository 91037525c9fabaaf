"""Driver queries of the corpus operators and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.llm.common import table


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from orrery.llm.language_id import identify

    return identify(table(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from orrery.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), tokenizer_path(), payload={"ids_crc32": F.crc32("ids")})


def op3_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from orrery.llm.ann import nearest

    return nearest(table(spark, sf_dir, "embeddings"))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from orrery.llm.minhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from orrery.llm.warc import round_trip

    records = round_trip(table(spark, sf_dir, "pages"))
    # a record id is urn:page:<page_id>:<row>
    refers = F.expr("try_cast(split(refers_to, ':')[2] AS bigint)")
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", refers.alias("refers_to"))


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from orrery.llm.embedding_dedup import near_vectors

    return near_vectors(table(spark, sf_dir, "embeddings"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from orrery.llm.mixing import mix

    return mix(table(spark, sf_dir, "documents"))


URL_RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from orrery.llm.url_filter import Rule, filter_urls

    return filter_urls(table(spark, sf_dir, "pages"), [Rule(*r) for r in URL_RULES])


def op9_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    from orrery.llm.token_count import count_tokens

    return count_tokens(table(spark, sf_dir, "documents"), tokenizer_path())


def quality_model(spark: SparkSession, docs: DataFrame, sf_dir: str):
    """The model learned from the ``labels`` of the documents that are in ``docs``."""
    from orrery.llm.quality import fit, grade_column

    labels = table(spark, sf_dir, "labels").select("doc_id", grade_column(F.col("quality"), F.col("toxic")).alias("grade"))
    return fit(docs, labels)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from orrery.llm.quality import classify

    docs = table(spark, sf_dir, "documents")
    return classify(docs, quality_model(spark, docs, sf_dir), at_least=2)


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from orrery.llm.merkle import audit

    # the version held against the manifest: the texts of a third of the ids have lost their capitals
    small = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    hit = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    return audit(table(spark, sf_dir, "documents"), {"text": F.when(hit, small).otherwise(F.col("text"))})


def op12_min_bin_slack(spark: SparkSession, sf_dir: str) -> DataFrame:
    from orrery.llm.bin_slack import pack

    return pack(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), payload={"ids_crc32": F.crc32("ids")})


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from orrery.llm.collocations import collocations

    return collocations(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_language_id, op2_packing, op3_nearest, op4_near_duplicates, op5_warc,
                                  op6_embedding_dedup, op7_mixing, op8_url_filter,
                                  op9_token_count, op10_quality, op11_merkle, op12_min_bin_slack,
                                  op13_collocations)}

SQL = {
    "op5_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first_id FROM d WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, d.payload_digest,
       CASE WHEN first_id IS NULL OR first_id = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first_id <> page_id THEN first_id END AS refers_to
FROM d LEFT JOIN f ON f.payload_digest = d.payload_digest""",
    "op7_mixing": r"""
WITH s AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         strlen(coalesce(text, '')) AS bytes,
         length(regexp_replace(coalesce(text, ''), '[^!"#$%&()*+/0-9:;<=>?@\[\\\]^_`{|}~]', '', 'g')) AS marks,
         md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS digest
  FROM documents),
d AS (
  SELECT doc_id, source, size,
         -ln((CAST(CAST('0x' || substr(digest, 1, 13) AS BIGINT) AS DOUBLE) + 0.5) / 4503599627370496.0::DOUBLE)
         / (0.25::DOUBLE + 0.75::DOUBLE * CASE WHEN bytes > 0 THEN 1 - marks::DOUBLE / bytes ELSE 0 END) AS e
  FROM s),
t AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, ((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1)::DOUBLE AS weight,
         3.0::DOUBLE * source_size AS cap FROM t),
c AS (
  SELECT *, cap / weight AS full_at,
         sum(source_size) OVER () ::DOUBLE AS total, sum(weight) OVER () AS weights,
         coalesce(sum(cap) OVER (ORDER BY cap / weight, encode(source) NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cap_before,
         coalesce(sum(weight) OVER (ORDER BY cap / weight, encode(source) NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS weight_before
  FROM w),
k AS (SELECT *, (total - cap_before) / (weights - weight_before) AS factor FROM c),
g AS (
  SELECT source, source_size,
         CASE WHEN (SELECT min(full_at) FROM k WHERE factor < full_at) IS NULL THEN cap
              ELSE least(cap, weight * (SELECT arg_min(factor, full_at) FROM k WHERE factor < full_at)) END AS target
  FROM k),
h AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs FROM g),
r AS (
  SELECT doc_id, size, source_size, target, epochs, target - epochs * source_size AS rest,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY e, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS upto
  FROM d JOIN h ON h.source IS NOT DISTINCT FROM d.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (epochs + CASE WHEN upto + size / 2.0::DOUBLE <= rest THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM r""",
    "op8_url_filter": r"""
WITH u AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
r(h, p, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
                      ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
m AS (
  SELECT u.page_id, u.host, u.path, r.h || r.p AS rule, r.v,
         row_number() OVER (PARTITION BY u.page_id ORDER BY length(r.h || r.p) DESC NULLS LAST) AS k
  FROM u LEFT JOIN r ON (u.host = r.h OR ends_with(u.host, '.' || r.h)) AND starts_with(u.path, r.p))
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM m WHERE k = 1""",
    "op11_merkle": """
WITH RECURSIVE crc AS (
  SELECT doc_id, source, lang, n_chars, text, xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1),
                                                    lambda i: CAST(ascii(substr(CAST(doc_id AS VARCHAR), i, 1)) AS BIGINT))),
    lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                             lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)), 4294967295) AS crc
  FROM documents),
versions AS (
  SELECT *, coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || CAST(doc_id AS VARCHAR), '-')
            || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
            || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || CAST(n_chars AS VARCHAR), '-') AS head,
         CASE WHEN crc % 3 = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS claimed
  FROM crc),
hashed AS (
  SELECT doc_id, coalesce('=' || lang, '-') AS tree, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         sha256(head || coalesce(strlen(claimed) || ':' || claimed, '-')) AS claim
  FROM versions),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY tree) AS n, row_number() OVER () AS id FROM hashed),
lower AS (
  SELECT tree, 0 AS depth, pos AS i, leaf AS h, n FROM leaves
  UNION ALL
  SELECT tree, depth + 1, i // 8, sha256(string_agg(h, '' ORDER BY i)), (n + 7) // 8 FROM lower WHERE n > 1
  GROUP BY tree, depth, i // 8, n),
tops AS (
  SELECT tree, h, row_number() OVER (ORDER BY encode(tree)) - 1 AS pos, count(*) OVER () AS n FROM lower WHERE n = 1),
higher AS (
  SELECT 0 AS depth, pos AS i, h, n FROM tops
  UNION ALL
  SELECT depth + 1, i // 8, sha256(string_agg(h, '' ORDER BY i)), (n + 7) // 8 FROM higher WHERE n > 1 GROUP BY depth, i // 8, n),
up AS (
  SELECT id, tree, 0 AS depth, pos AS i, n, claim AS h, '' AS proof FROM leaves
  UNION ALL
  SELECT u.id, u.tree, u.depth + 1, u.i // 8, (u.n + 7) // 8, sha256(string_agg(CASE WHEN l.i = u.i THEN u.h ELSE l.h END, '' ORDER BY l.i)),
         u.proof || coalesce(string_agg(l.h, '' ORDER BY l.i) FILTER (WHERE l.i <> u.i), '')
  FROM up u JOIN lower l ON l.tree = u.tree AND l.depth = u.depth AND l.i // 8 = u.i // 8
  WHERE u.n > 1 GROUP BY u.id, u.tree, u.depth, u.i, u.n, u.h, u.proof),
upper_path AS (
  SELECT u.id, 0 AS depth, t.pos AS i, t.n, u.h, u.proof FROM up u JOIN tops t USING (tree) WHERE u.n = 1
  UNION ALL
  SELECT u.id, u.depth + 1, u.i // 8, (u.n + 7) // 8, sha256(string_agg(CASE WHEN l.i = u.i THEN u.h ELSE l.h END, '' ORDER BY l.i)),
         u.proof || coalesce(string_agg(l.h, '' ORDER BY l.i) FILTER (WHERE l.i <> u.i), '')
  FROM upper_path u JOIN higher l ON l.depth = u.depth AND l.i // 8 = u.i // 8
  WHERE u.n > 1 GROUP BY u.id, u.depth, u.i, u.n, u.h, u.proof)
SELECT l.doc_id, l.leaf, t.h AS subroot, r.h AS root, sha256(p.proof) AS proof_sha256, p.h AS folded_root, p.h = r.h AS verified
FROM leaves l JOIN tops t USING (tree) JOIN upper_path p ON p.id = l.id AND p.n = 1 JOIN higher r ON r.n = 1""",
    "op13_collocations": r"""
WITH t AS (
  SELECT coalesce(lang, 'und') AS lang,
         string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS pieces
  FROM documents),
p AS (SELECT lang, unnest(pieces) AS piece FROM t),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM p),
totals AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM w GROUP BY lang),
grams AS (
  SELECT lang, size, unnest(list_transform(range(1, len(ws) - size + 2), lambda i: array_to_string(ws[i:i + size - 1], ' '))) AS phrase
  FROM w, (SELECT unnest(range(1, 6)) AS size) s WHERE len(ws) >= size),
f AS (SELECT lang, size, phrase, count(*) AS f FROM grams GROUP BY lang, size, phrase HAVING count(*) >= 100),
cuts AS (
  SELECT lang, phrase, f AS a, size, k, string_split(phrase, ' ') AS ws FROM f, (SELECT unnest(range(1, 5)) AS k) s WHERE k < size),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.size, c.k, x.f AS l, y.f AS r, n,
         CAST((1000::HUGEINT * c.a * n) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.ws[1:c.k], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.ws[c.k + 1:], ' ') JOIN totals t ON t.lang = c.lang),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
kept AS (
  SELECT * FROM best b WHERE NOT EXISTS (
    SELECT 1 FROM f WHERE f.lang = b.lang AND f.size > b.size AND contains(' ' || f.phrase || ' ', ' ' || b.phrase || ' ') AND 100 * f.f >= 100 * b.a))
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept)
WHERE rank <= 2000""",
}
