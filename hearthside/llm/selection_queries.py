"""Resampling, fuzzy fingerprints and the dataset manifest as queries over whole tables."""

from pyspark.sql import functions as F

from hearthside.llm import merkle
from hearthside.llm.registry import query, table
from hearthside.llm.resampling import resample
from hearthside.llm.simhash import fuzzy_groups

# CRC-32 of the blob {0} in SQL, byte by byte and bit by bit
_CRC = """xor(4294967295, list_reduce(list_transform(range(octet_length({0})), lambda i: CAST('0x' || hex({0}[i + 1:i + 1]) AS BIGINT)),
  lambda a, x: list_reduce(range(8), lambda c, k: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END), xor(a, x)), CAST(4294967295 AS BIGINT)))"""


@query(
    "op11_resampling",
    rf"""
WITH d AS (SELECT false AS wanted, doc_id, text FROM documents UNION ALL SELECT true, row_number() OVER (), text FROM benchmark),
w AS (SELECT wanted, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM d),
f AS (SELECT wanted, doc_id, unnest(flatten(list_transform([0, 1, 2], lambda k: list_transform(range(1, len(w) + 1 - k), lambda i: array_to_string(w[i:i + k], ' '))))) AS f FROM w),
u AS (SELECT f, encode(f) AS b FROM f GROUP BY f),
b AS (SELECT f, {_CRC.format("b")} % 10000 AS bucket FROM u),
x AS (SELECT wanted, doc_id, bucket, count(*) AS n FROM f JOIN b USING (f) GROUP BY ALL),
c AS (SELECT bucket, coalesce(sum(n) FILTER (NOT wanted), 0) AS s, coalesce(sum(n) FILTER (wanted), 0) AS t FROM x GROUP BY bucket),
g AS (SELECT bucket, CAST(floor(1000 * ln((t + 1)::DOUBLE * ((SELECT sum(s) FROM c) + 10000) / ((s + 1)::DOUBLE * ((SELECT sum(t) FROM c) + 10000)))) AS BIGINT) AS gain FROM c),
v AS (SELECT doc_id, CAST(sum(n) AS BIGINT) AS n_features, CAST(sum(n * gain) AS BIGINT) AS weight FROM x JOIN g USING (bucket) WHERE NOT wanted GROUP BY doc_id),
s AS (SELECT w.doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
  coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('42:' || w.doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM w LEFT JOIN v USING (doc_id) WHERE NOT wanted),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM s WHERE n_words >= 20)
SELECT s.doc_id, n_features, weight, score, rank FROM s LEFT JOIN (SELECT * FROM r WHERE rank <= 5 * n // 100) r ON s.doc_id = r.doc_id
""",
)
def op11_resampling(spark, sf_dir):
    found = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


@query("op12_simhash")
def op12_simhash(spark, sf_dir):
    return fuzzy_groups(table(spark, sf_dir, "documents"), size=3)


def _field(name: str, value: str | None = None) -> str:
    value = value or name
    return f"coalesce(octet_length(encode(CAST({value} AS VARCHAR))) || ':' || {value}, '-')"


_LEAF = "sha256(" + " || ".join(map(_field, merkle.FIELDS)) + ")"
_ALTERED = "sha256(" + " || ".join(_field(f, "(n_chars + 1)" if f == "n_chars" else None) for f in merkle.FIELDS) + ")"


@query(
    "op13_merkle",
    f"""
WITH RECURSIVE d AS (SELECT doc_id, lang, {_LEAF} AS leaf, CASE WHEN {_CRC.format("encode(CAST(doc_id AS VARCHAR))")} % 7 = 0 THEN {_ALTERED} ELSE {_LEAF} END AS altered,
  row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS i FROM documents),
t(lang, level, h) AS (SELECT lang, 0, list(leaf ORDER BY doc_id) FROM d GROUP BY lang
  UNION ALL SELECT lang, level + 1, list_transform(range(1, len(h) + 1, 2), lambda k: sha256(h[k] || coalesce(h[k + 1], ''))) FROM t WHERE len(h) > 1),
s AS (SELECT lang, h[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i FROM t WHERE len(h) = 1),
u(level, h) AS (SELECT 0, list(subroot ORDER BY i) FROM s UNION ALL SELECT level + 1, list_transform(range(1, len(h) + 1, 2), lambda k: sha256(h[k] || coalesce(h[k + 1], ''))) FROM u WHERE len(h) > 1),
p AS (SELECT doc_id, level, (i >> level) & 1 AS side, coalesce(h[xor(i >> level, 1) + 1], '') AS sib FROM d JOIN t ON d.lang IS NOT DISTINCT FROM t.lang WHERE len(h) > 1
  UNION ALL SELECT doc_id, 1000 + level, (s.i >> level) & 1, coalesce(h[xor(s.i >> level, 1) + 1], '') FROM d JOIN s ON d.lang IS NOT DISTINCT FROM s.lang, u WHERE len(h) > 1),
q AS (SELECT doc_id, list({{'side': side, 'sib': sib}} ORDER BY level) AS path FROM p GROUP BY doc_id),
z AS (SELECT d.doc_id, leaf, subroot, (SELECT h[1] FROM u WHERE len(h) = 1) AS root, sha256(array_to_string(list_transform(coalesce(path, []), lambda x: x.sib), '')) AS proof_sha256,
  list_reduce(list_transform(coalesce(path, []), lambda x: x.side || x.sib), lambda a, x: sha256(CASE WHEN x[1] = '1' THEN x[2:] || a ELSE a || x[2:] END), altered) AS folded_root
  FROM d JOIN s ON d.lang IS NOT DISTINCT FROM s.lang LEFT JOIN q ON d.doc_id = q.doc_id)
SELECT *, folded_root = root AS verified FROM z
""",
)
def op13_merkle(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    # what the leaf of a row becomes when one is added to n_chars of every seventh checksum
    raised = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, 1).otherwise(0)
    changed = merkle.leaf([F.col(f) + raised if f == "n_chars" else F.col(f) for f in merkle.FIELDS])
    found = merkle.manifest(docs, carry={"altered": changed})
    folded = found.withColumn("folded_root", merkle.folded(F.col("altered"), F.col("path")))
    return folded.select(
        "doc_id", "leaf", "subroot", "root", merkle.path_digest(F.col("path")).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
