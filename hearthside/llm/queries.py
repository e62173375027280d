"""The dealt operators as queries over whole tables."""

from pyspark.sql import functions as F

from hearthside.llm import recompression, suffix_dedup, toxicity
from hearthside.llm.decontaminate import find_leaks
from hearthside.llm.exact_dedup import exact_groups
from hearthside.llm.minhash import near_groups
from hearthside.llm.packing import Limits, pack
from hearthside.llm.pseudonyms import pseudonymise
from hearthside.llm.registry import query, table
from hearthside.llm.url_filter import judge
from hearthside.llm.warc import read_archive, write_archive
from hearthside.session import shared_folder


@query(
    "op5_exact_dedup",
    r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t.t) AS text_sha256 FROM t JOIN g ON t.t = g.t
""",
)
def op5_exact_dedup(spark, sf_dir):
    return exact_groups(table(spark, sf_dir, "documents"))


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query("op10_packing")
def op10_packing(spark, sf_dir):
    packed = pack(table(spark, sf_dir, "documents"), tokenizer_path(), limits=Limits(), keep_ids=False)
    crc = F.conv(F.concat(*[F.hex(F.substring("ids", i, 1)) for i in (4, 3, 2, 1)]), 16, 10).cast("long")
    return packed.select(
        "doc_id", "start", "length", crc.alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query("op7_pseudonyms")
def op7_pseudonyms(spark, sf_dir):
    return pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), key="placeholder key, not secret")


@query("op6_toxicity")
def op6_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    machine = toxicity.fit(docs, toxicity.learnable(table(spark, sf_dir, "labels")))
    # the score takes the text alone; the id only passes through
    return toxicity.score(docs, machine).select(
        "doc_id",
        (F.crc32(F.col("doc_id").cast("string")) % 5 == 0).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"),
    )


RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


@query("op8_url_filter")
def op8_url_filter(spark, sf_dir):
    return judge(table(spark, sf_dir, "pages"), RULES)


@query(
    "op9_warc",
    """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS h, min(page_id) OVER (PARTITION BY payload) AS first FROM p)
SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i:
  substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((CAST('0x' || substr(h, CAST(5 * (i // 4) + 1 AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31 AS BIGINT), 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to, true AS verified
FROM d
""",
)
def op9_warc(spark, sf_dir):
    folder = shared_folder(spark, "warc")
    write_archive(table(spark, sf_dir, "pages"), folder, roll_bytes=8 << 20)
    return read_archive(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "verified")


@query(
    "op4_minhash",
    r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(w) = 1 THEN w ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM w),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS c FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id
      AND 10 * a.n >= 8 * b.n AND 10 * b.n >= 8 * a.n GROUP BY ALL),
l AS (SELECT a, b FROM i WHERE 100 * c >= 80 * (na + nb - c)),
r(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT s.doc_id, len(s.s) AS n_shingles, min(r.b) AS component_id, s.doc_id = min(r.b) AS kept FROM s JOIN r ON s.doc_id = r.a GROUP BY s.doc_id, len(s.s)
""",
)
def op4_minhash(spark, sf_dir):
    return near_groups(table(spark, sf_dir, "documents"), size=2, percent=80)


@query(
    "op1_suffix_array",
    """
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS t FROM documents),
w AS (SELECT doc_id, i, t[i + 1:i + 1] AS c, CASE WHEN i + 50 <= octet_length(t) THEN t[i + 1:i + 50] END AS s FROM (SELECT doc_id, t, unnest(range(octet_length(t))) AS i FROM d)),
f AS (SELECT s, min(doc_id) AS first FROM w WHERE s IS NOT NULL GROUP BY s),
g AS (SELECT w.doc_id, i, c, max(CASE WHEN first < w.doc_id THEN 1 ELSE 0 END) OVER (PARTITION BY w.doc_id ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone FROM w LEFT JOIN f ON w.s = f.s),
r AS (SELECT *, lag(gone, 1, 0) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM g),
a AS (SELECT doc_id, sum(gone) AS n_removed, count(*) FILTER (gone = 1 AND before = 0) AS n_spans, string_agg(hex(c), '' ORDER BY i) FILTER (gone = 0) AS kept FROM r GROUP BY doc_id)
SELECT d.doc_id, octet_length(t) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM d LEFT JOIN a ON d.doc_id = a.doc_id
""",
)
def op1_suffix_array(spark, sf_dir):
    return suffix_dedup.digests(suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), length=50))


@query(
    "op3_recompression",
    r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
w AS (SELECT doc_id, i, w[i] AS c, CASE WHEN i + 12 <= len(w) THEN array_to_string(w[i:i + 12], ' ') END AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d)),
f AS (SELECT s, min(doc_id) AS first FROM w WHERE s IS NOT NULL GROUP BY s),
g AS (SELECT w.doc_id, i, c, max(CASE WHEN first < w.doc_id THEN 1 ELSE 0 END) OVER (PARTITION BY w.doc_id ORDER BY i ROWS BETWEEN 12 PRECEDING AND CURRENT ROW) AS gone FROM w LEFT JOIN f ON w.s = f.s),
a AS (SELECT doc_id, sum(gone) AS n_removed, string_agg(c, ' ' ORDER BY i) FILTER (gone = 0) AS kept FROM g GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN a ON d.doc_id = a.doc_id
""",
)
def op3_recompression(spark, sf_dir):
    return recompression.digests(recompression.remove_repeats(table(spark, sf_dir, "documents"), size=13))


@query("op2_decontaminate")
def op2_decontaminate(spark, sf_dir):
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
