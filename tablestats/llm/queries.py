"""Registered queries of the corpus operators, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablestats.llm import chat_format, decontamination, extraction, fingerprints, jaccard_join, merkle, mixing, ppm, quality, ranked_search, sharding, suffix_dedup, toxicity
from tablestats.llm.common import table


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op2_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.main_text(table(spark, sf_dir, "pages"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("row")


def op4_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.score(table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = mixing.mix(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "source_size", "target", "taken", "source", "position", "shard_words")


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.deduplicated(table(spark, sf_dir, "documents"))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.linked(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.documents_manifest(table(spark, sf_dir, "documents"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: Two turns of a further conversation whose text holds what templates use as marks.
CONTROL_TURNS = [(-7, turn, role, "\\### Assistant: </turn> ok") for turn, role in enumerate(("user", "assistant"))]


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame(CONTROL_TURNS, "conv_id long, turn long, role string, text string")
    return chat_format.digests(*chat_format.formatted(conversations.unionByName(more))).drop("n_tokens", "n_loss_tokens")


QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_extraction": op2_extraction,
    "op3_decontamination": op3_decontamination,
    "op4_ppm": op4_ppm,
    "op5_quality": op5_quality,
    "op6_mixing": op6_mixing,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_fingerprints": op8_fingerprints,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_toxicity": op10_toxicity,
    "op11_merkle": op11_merkle,
    "op12_ranked_search": op12_ranked_search,
    "op13_chat_format": op13_chat_format,
}

def _words(pattern: str) -> str:
    return f"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '{pattern}')"""


#: Every window of every text against the windows of the items.
_CONTAMINATED = f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_words(r'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')} AS words FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_words(r'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')} AS words FROM benchmark),
sized AS (SELECT item, words, least(len(words), 13) AS k FROM b WHERE len(words) > 0),
asked AS (SELECT DISTINCT k, words[i:i + k - 1] AS w, item
  FROM (SELECT item, words, k, unnest(range(1, len(words) - k + 2)) AS i FROM sized)),
known AS (SELECT DISTINCT k, w FROM asked),
spans AS (SELECT r, i, k, w FROM (
  SELECT r, i, k, words[i:i + k - 1] AS w
  FROM (SELECT r, words, k, unnest(range(1, len(words) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM asked)))
  SEMI JOIN known USING (k, w)),
hit AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + k)) AS p FROM spans) GROUP BY r),
found AS (SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, item FROM spans JOIN asked USING (k, w)) GROUP BY r)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(found.n, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256,
  coalesce(hit.n, 0) > 0 AND 20 * coalesce(hit.n, 0) >= len(words) AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN found USING (r)"""

#: All pairs that share a shingle, then what links reach.
_LINKED = f"""WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, {_words(r'[^\x20\x09-\x0D]+')} AS words FROM documents),
shingles AS (SELECT DISTINCT r, w FROM (
  SELECT r, words[i:i + 2] AS w FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM d WHERE len(words) > 2)
  UNION ALL SELECT r, words FROM d WHERE len(words) IN (1, 2))),
sizes AS (SELECT r, count(*) AS n FROM shingles GROUP BY r),
pairs AS (SELECT a.r AS x, b.r AS y, count(*) AS shared FROM shingles a JOIN shingles b ON a.w = b.w AND a.r <> b.r GROUP BY ALL),
links AS (SELECT x, y FROM pairs JOIN sizes s ON s.r = x JOIN sizes t ON t.r = y WHERE 100 * shared >= 90 * (s.n + t.n - shared)),
reached AS (SELECT r AS x, r AS y FROM d UNION SELECT reached.x, links.y FROM reached JOIN links ON links.x = reached.y)
SELECT any_value(d.doc_id) AS doc_id, coalesce(any_value(n), 0) AS n_shingles, min(o.doc_id) AS component_id
FROM d JOIN reached ON reached.x = d.r JOIN d o ON o.r = reached.y LEFT JOIN sizes ON sizes.r = d.r GROUP BY d.r"""

_TERMS = _words(r'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')

#: Scores of all documents, for each item; equal texts under one item_id are one item.
_RANKED = f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS words FROM documents),
known AS (SELECT r, doc_id, len(words) AS n FROM d WHERE len(words) > 0),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM known),
tf AS (SELECT r, word, count(*) AS tf FROM (SELECT r, unnest(words) AS word FROM d) GROUP BY ALL),
df AS (SELECT word, count(*) AS df FROM tf GROUP BY word),
items AS (SELECT DISTINCT item_id, coalesce(text, '') AS text FROM benchmark),
asked AS (SELECT item_id, text, word, count(*) AS times
  FROM (SELECT item_id, text, unnest({_TERMS}) AS word FROM items) GROUP BY ALL),
scored AS (SELECT a.item_id, a.text, k.r, k.doc_id, CAST(sum(a.times
    * CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT)
    * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // terms)))) AS BIGINT) AS score
  FROM asked a JOIN tf USING (word) JOIN df USING (word) JOIN known k USING (r), total GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS FIRST, r) AS rank
  FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10"""

#: Digests straight from the turns; lengths by counting what is escaped (19: the marks of a turn).
_FORMATTED = r"""WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (SELECT *, role || ' ' || text AS whole FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(18 + length(whole) + length(regexp_replace(whole, '[^\\]', '', 'g'))
    + 3 * len(regexp_extract_all(whole, '<turn>|<says>|</turn>|<\|endoftext\|>'))) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id"""

def _field(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


def _level(below: str, above: str) -> str:
    """A level of the tree, a row per leaf: its node ``h``, the changed node ``f`` and the siblings so far."""
    return f"""{above}_runs AS MATERIALIZED (SELECT g, i // 16 AS p, array_agg(h ORDER BY i) AS run
  FROM (SELECT DISTINCT g, i, h FROM {below}) GROUP BY ALL),
{above}_sizes AS (SELECT g, max(i) AS last FROM {below} GROUP BY g),
{above}_beside AS (SELECT b.*, last, array_to_string(run, '') AS whole, array_to_string(run[1:i % 16], '') AS l,
  array_to_string(run[i % 16 + 2:], '') AS r FROM {below} b JOIN {above}_runs u ON u.g = b.g AND p = i // 16
  JOIN {above}_sizes s ON s.g = b.g),
{above} AS MATERIALIZED (SELECT g, i // 16 AS i, CASE WHEN last = 0 THEN h ELSE sha256(whole) END AS h,
  CASE WHEN last = 0 THEN f ELSE sha256(l || f || r) END AS f,
  CASE WHEN last = 0 THEN path ELSE path || l || r END AS path, doc_id, source, leaf, subroot FROM {above}_beside)"""


#: Folded level by level, six times by source and six times above (16 ** 6 nodes).
_LEVELS = 6
_LOWER = ",\n".join(_level(f"low{k}", f"low{k + 1}") for k in range(_LEVELS))
_UPPER = ",\n".join(_level(f"top{k}", f"top{k + 1}") for k in range(_LEVELS))
_ID_CRC = """xor(list_reduce([4294967295] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
  lambda c, x: list_reduce([xor(c, x)] || [0, 0, 0, 0, 0, 0, 0, 0], lambda b, z: CASE WHEN b % 2 = 1 THEN xor(b // 2, 3988292384) ELSE b // 2 END)),
  4294967295)"""
_HEAD = " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars"))
_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_MANIFEST = f"""WITH hashed AS (SELECT doc_id, source, sha256({_HEAD} || {_field('text')}) AS leaf,
  CASE WHEN doc_id IS NOT NULL AND {_ID_CRC} % 5 = 0 THEN sha256({_HEAD} || {_field(_LOWERED)}) END AS changed FROM documents),
low0 AS MATERIALIZED (SELECT dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS g,
  row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
  leaf AS h, coalesce(changed, leaf) AS f, '' AS path, doc_id, source, leaf, '' AS subroot FROM hashed),
{_LOWER},
top0 AS MATERIALIZED (SELECT 0 AS g, g AS i, h, f, path, doc_id, source, leaf, h AS subroot FROM low{_LEVELS}),
{_UPPER}
SELECT doc_id, leaf, subroot, h AS root, sha256(path) AS proof_sha256, f AS folded_root, f = h AS verified, source FROM top{_LEVELS}"""

ORACLE_SQL: dict[str, str] = {"op3_decontamination": _CONTAMINATED, "op9_jaccard_join": _LINKED,
                              "op11_merkle": _MANIFEST, "op12_ranked_search": _RANKED, "op13_chat_format": _FORMATTED}
