"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.llm import (
    block_topk,
    byte_bpe,
    license_scan,
    line_crf,
    line_dedup,
    merkle,
    ngram_join,
    packing,
    quality_rules,
    spelling,
    substring_dedup,
    url_reputation,
    word_bpe,
)
from blotter.llm.common import prepare

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(_table(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(
        _table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
        special=packing.special_tokens(public_tokenizers.path("byte_bpe_50k.json")),
    )
    return packing.packing_report(packed)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_report(_table(spark, sf_dir, "documents"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_crf.quality_scores(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    )


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's outcome is the quality label of its number; the given labels name nothing closer."""
    labels = _table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("page_id"), F.col("quality").alias("good")
    )
    judged = url_reputation.judge_pages(_table(spark, sf_dir, "pages"), labels)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_topk.top_k_of_embeddings(_table(spark, sf_dir, "embeddings"))


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.class_report(_table(spark, sf_dir, "documents"))


def op8_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document is the file source/lang/doc_id: the table has no paths of its own."""
    part = lambda name: F.coalesce(F.col(name).cast("string"), F.lit("_"))
    files = _table(spark, sf_dir, "documents").select(
        F.concat_ws("/", part("source"), part("lang"), part("doc_id")).alias("path"), "text"
    )
    found = license_scan.licences(files)
    doc_id = F.element_at(F.split("path", "/"), -1).try_cast("bigint")
    return found.select(doc_id.alias("doc_id"), *found.columns)


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_report(_table(spark, sf_dir, "documents"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    documents = _table(spark, sf_dir, "documents")
    return byte_bpe.encoding_report(byte_bpe.encode(documents, ranks, public_tokenizers.PATTERN))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.document_manifest(_table(spark, sf_dir, "documents"))


def op13_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = word_bpe.read_vocabulary(public_tokenizers.path("word_bpe_49k.json"))
    return word_bpe.encoding_report(word_bpe.encode(_table(spark, sf_dir, "documents"), vocabulary))


OP1_SQL = r"""
WITH lines AS (
  SELECT doc_id, UNNEST(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), keyed AS (
  SELECT doc_id, pos, line,
    translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines
), first_doc AS (
  SELECT k, min(doc_id) AS holder FROM keyed WHERE length(k) >= 10 GROUP BY k
), judged AS (
  SELECT keyed.*, coalesce(holder <> doc_id, false) AS gone FROM keyed LEFT JOIN first_doc USING (k)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

OP6_SQL = """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(
    CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM usable q JOIN usable c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""


_WORDS = r"regexp_extract_all(coalesce({text}, ''), '[^\x20\x09-\x0D]+')"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP7_SQL = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, {_WORDS.format(text=_LOWER)} AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) >= 5
      THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS shingles
  FROM words
), tokens AS (
  SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM sets
), links AS (
  SELECT a.doc_id AS u, b.doc_id AS v FROM tokens a JOIN tokens b USING (shingle) WHERE a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
), reach AS (
  SELECT doc_id AS u, doc_id AS v FROM sets
  UNION
  SELECT reach.u, links.v FROM reach JOIN links ON reach.v = links.u
)
SELECT doc_id, CAST(len(shingles) AS BIGINT) AS n_shingles, component_id
FROM sets JOIN (SELECT u AS doc_id, min(v) AS component_id FROM reach GROUP BY u) USING (doc_id)
"""

OP9_SQL = f"""
WITH words AS (
  SELECT doc_id, {_WORDS.format(text="text")} AS w FROM documents
), placed AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos, len(w) AS n_words,
    unnest(list_transform(range(1, len(w) + 1), lambda i: CASE WHEN i + 34 <= len(w) THEN md5(array_to_string(w[i:i + 34], ' ')) END)) AS win
  FROM words
), counted AS (
  SELECT *, win IS NOT NULL AND count(*) OVER (PARTITION BY win) > 1 AS again FROM placed
), judged AS (
  SELECT *, bool_or(again) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone
  FROM counted
), kept AS (
  SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY pos) FILTER (NOT gone) AS text
  FROM judged GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
"""


def _crc32_sql(text: str) -> str:
    """The unsigned CRC of a text's UTF-8 bytes, bit by bit."""
    octets = f"list_transform(range(octet_length(encode({text}))), lambda i: ('0x' || hex(encode({text}))[2 * i + 1:2 * i + 2])::UBIGINT)"
    shift = "list_reduce(list_prepend(xor(c, b), repeat([0::UBIGINT], 8)), lambda a, _: xor(a >> 1, 3988292384::UBIGINT * (a & 1)))"
    return f"xor(list_reduce(list_prepend(4294967295::UBIGINT, {octets}), lambda c, b: {shift}), 4294967295::UBIGINT)"


def _strength_sql(name: str, children: str, parent: str) -> str:
    return f"""
{name}_sums AS (
  SELECT {parent}, sum(n) AS total, sum(good) / sum(n) AS p, sum(good * good / n) AS gg, sum(n * n) / sum(n) AS nn,
    count(*) - 1 AS free FROM {children} WHERE n > 0 GROUP BY {parent}
), {name} AS (
  SELECT 1 / coalesce(CASE WHEN most > 0 THEN least(greatest(beyond / most, 0.001), 0.999) END, 0.001) - 1 AS strength
  FROM (SELECT sum(gg - total * p * p - p * (1 - p) * free) AS beyond, sum(p * (1 - p) * (total - nn - free)) AS most
        FROM {name}_sums)
)"""


def _labels_sql(name: str, labels: int) -> str:
    return f"array_to_string(string_split({name}, '.')[-{labels}:], '.')"


_SUFFIXES_SQL = ", ".join(f"'{name}'" for name in url_reputation.SUFFIXES)
_NUMBER_SQL = "regexp_full_match({}, '[0-9]+([.][0-9]+){{3}}')"
_RULES_SQL = " ".join(
    f"WHEN (host = '{name}' OR suffix(host, '.{name}')) AND starts_with(path, '{rest}') THEN '{{{k}}}'"
    for k, (_, rule) in enumerate(sorted(url_reputation.RULES, key=lambda r: -len(r[1])))
    for name, rest in [(rule.split("/", 1)[0], "/" + rule.split("/", 1)[1])]
)
_SORTED_RULES = sorted(url_reputation.RULES, key=lambda r: -len(r[1]))

OP5_SQL = f"""
WITH rests AS (
  SELECT page_id, coalesce(CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END, '') AS rest FROM pages
), parsed AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{url_reputation.UPPER}', '{url_reputation.LOWER}') AS host,
    regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM rests
), outcomes AS (
  SELECT host, count(*) AS n, sum(quality) AS good
  FROM parsed JOIN labels ON doc_id = page_id WHERE quality IS NOT NULL GROUP BY host
), names AS (
  SELECT DISTINCT host, regexp_replace(host, ':[0-9]*$', '') AS name FROM parsed
), hosts AS (
  SELECT host, CAST(coalesce(n, 0) AS DOUBLE) AS n, CAST(coalesce(good, 0) AS DOUBLE) AS good,
    CASE WHEN {_NUMBER_SQL.format("name")} THEN name WHEN {_labels_sql("name", 2)} IN ({_SUFFIXES_SQL}) THEN {_labels_sql("name", 3)}
         ELSE {_labels_sql("name", 2)} END AS domain
  FROM names LEFT JOIN outcomes USING (host)
), domains AS (
  SELECT domain, sum(n) AS n, sum(good) AS good,
    CASE WHEN {_NUMBER_SQL.format("domain")} THEN '' WHEN {_labels_sql("domain", 2)} IN ({_SUFFIXES_SQL}) THEN {_labels_sql("domain", 2)}
         ELSE {_labels_sql("domain", 1)} END AS suffix
  FROM hosts GROUP BY domain
), suffixes AS (
  SELECT suffix, sum(n) AS n, sum(good) AS good, 1 AS everything FROM domains GROUP BY suffix
), overall AS (
  SELECT CASE WHEN sum(n) > 0 THEN sum(good) / sum(n) ELSE 0.5 END AS rate FROM suffixes
), {_strength_sql("s1", "suffixes", "everything")}, {_strength_sql("s2", "domains", "suffix")}, {_strength_sql("s3", "hosts", "domain")},
top AS (
  SELECT suffix, (good + s1.strength * rate) / (n + s1.strength) AS prior FROM suffixes, overall, s1
), middle AS (
  SELECT domain, (good + s2.strength * prior) / (n + s2.strength) AS prior FROM domains JOIN top USING (suffix), s2
), bottom AS (
  SELECT host, (good + s3.strength * prior) / (n + s3.strength) AS mean, n + s3.strength AS weight
  FROM hosts JOIN middle USING (domain), s3
), bounds AS (
  SELECT host, least(mean + {url_reputation.BOUND_SD} * sqrt(mean * (1 - mean) / (weight + 1)), 1.0) AS bound FROM bottom
)
SELECT page_id, host, path, CASE {_RULES_SQL.format(*(rule for _, rule in _SORTED_RULES))} END AS rule,
  CASE {_RULES_SQL.format(*(verdict for verdict, _ in _SORTED_RULES))}
       WHEN bound < greatest({url_reputation.LEAST_GOOD}, {url_reputation.LEAST_SHARE} * (SELECT rate FROM overall)) THEN 'block'
       ELSE 'allow' END AS verdict
FROM parsed JOIN bounds USING (host)
"""

OP11_SQL = rf"""
WITH runs AS (
  SELECT doc_id, lower_run, count(*) AS times FROM (
    SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_run FROM documents)
  WHERE length(lower_run) >= 7 GROUP BY ALL
), hashed AS (
  SELECT lower_run, times, {_crc32_sql("(coalesce(doc_id::VARCHAR, '') || ':' || lower_run)")} AS h FROM runs
), results AS (
  SELECT times, CASE WHEN h % 31 = 0
    THEN left(lower_run, (h % length(lower_run))::INT) || substr(lower_run, (h % length(lower_run))::INT + 2)
    ELSE lower_run END AS word FROM hashed
), words AS (
  SELECT word, sum(times)::BIGINT AS n FROM results WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2
), holes AS (
  SELECT word, n, unnest(list_distinct(list_transform(range(1, length(word) + 1),
    lambda i: left(word, i - 1) || substr(word, i + 1)))) AS hole FROM words
), marked AS (
  SELECT word, n, i, left(word, i - 1) || ' ' || substr(word, i + 1) AS mark
  FROM words, unnest(range(1, length(word) + 1)) AS t(i)
), near AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM marked a JOIN marked b ON a.mark = b.mark AND a.word <> b.word
  UNION
  SELECT a.word, a.n, b.word, b.n FROM words a JOIN holes b ON a.word = b.hole
  UNION
  SELECT b.word, b.n, a.word, a.n FROM words a JOIN holes b ON a.word = b.hole
), best AS (
  SELECT word, count(*) AS n_near, max(other_n) AS best_n,
    arg_min(other, encode(other)) FILTER (other_n = most) AS other
  FROM (SELECT *, max(other_n) OVER (PARTITION BY word) AS most FROM near) GROUP BY word
), formed AS (
  SELECT words.word, words.n, coalesce(n_near, 0) AS n_near,
    CASE WHEN best_n >= 10 * words.n THEN other END AS form,
    CASE WHEN best_n >= 10 * words.n THEN best_n END AS form_n
  FROM words LEFT JOIN best USING (word)
), chain AS (
  WITH RECURSIVE c AS (
    SELECT word, word AS root, form AS next FROM formed
    UNION ALL SELECT c.word, f.word, f.form FROM c JOIN formed f ON c.next = f.word
  ) SELECT word, root FROM c WHERE next IS NULL
)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN chain USING (word)
"""


def _leaf_sql(text: str) -> str:
    values = [*(f"{name}::VARCHAR" for name in ("doc_id", "source", "lang", "n_chars")), text]
    tagged = " || ".join(f"coalesce(octet_length(encode({v})) || ':' || ({v}), '-')" for v in values)
    return f"sha256({tagged})"


_TAMPERED = f"CASE WHEN {_crc32_sql('(doc_id::VARCHAR)')} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END"


def _tree_sql(name: str, leaves: str, group: str) -> str:
    """The nodes of the trees over `leaves`, and per node the siblings in its run."""
    return f"""
{name} AS (
  SELECT {group}, 0 AS level, place, size, node FROM {leaves}
  UNION ALL
  SELECT {group}, min(level) + 1, place // 3, any_value((size + 2) // 3), sha256(string_agg(node, '' ORDER BY place))
  FROM {name} WHERE size > 1 GROUP BY {group}, place // 3
), {name}_runs AS (
  SELECT {group}, level, place // 3 AS run, list(node ORDER BY place) AS nodes FROM {name} WHERE size > 1 GROUP BY ALL
)"""


def _fold_sql(name: str, start: str, tree: str, group: str) -> str:
    """Follow the runs of `tree` from the leaves in `start` to the top, gathering siblings."""
    at = "CAST(f.place % 3 AS INT)"
    return f"""
{name} AS (
  SELECT doc_id, source, leaf, {group} AS tree_of, 0 AS level, place, proof, folded FROM {start}
  UNION ALL
  SELECT f.doc_id, f.source, f.leaf, f.tree_of, f.level + 1, f.place // 3,
    f.proof || array_to_string(r.nodes[1:{at}], '') || array_to_string(r.nodes[{at} + 2:], ''),
    sha256(array_to_string(r.nodes[1:{at}], '') || f.folded || array_to_string(r.nodes[{at} + 2:], ''))
  FROM {name} f JOIN {tree}_runs r
    ON r.{group} IS NOT DISTINCT FROM f.tree_of AND r.level = f.level AND r.run = f.place // 3
)"""


OP12_SQL = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, source, {_leaf_sql("text")} AS node, {_leaf_sql(_TAMPERED)} AS presented,
    row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS place, count(*) OVER (PARTITION BY source) AS size
  FROM documents
), {_tree_sql("tree", "leaves", "source")}, subroots AS (
  SELECT 'all' AS everything, source, node, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place,
    count(*) OVER () AS size FROM tree WHERE size = 1
), {_tree_sql("top", "subroots", "everything")}, start AS (
  SELECT doc_id, source, node AS leaf, place, '' AS proof, presented AS folded FROM leaves
), {_fold_sql("inner_fold", "start", "tree", "source")}, middle AS (
  SELECT f.doc_id, f.source, f.leaf, 'all' AS everything, s.place, f.proof, f.folded, s.node AS subroot
  FROM (SELECT * FROM inner_fold QUALIFY level = max(level) OVER (PARTITION BY source, doc_id)) f
  JOIN subroots s ON s.source IS NOT DISTINCT FROM f.source
), {_fold_sql("outer_fold", "middle", "top", "everything")}
SELECT o.doc_id, o.leaf, m.subroot, (SELECT node FROM top WHERE size = 1) AS root, sha256(o.proof) AS proof_sha256,
  o.folded AS folded_root, o.folded = (SELECT node FROM top WHERE size = 1) AS verified
FROM (SELECT * FROM outer_fold QUALIFY level = max(level) OVER ()) o
JOIN middle m ON m.doc_id = o.doc_id
"""

QUERIES: dict[str, Query] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_packing": op2_packing,
    "op3_quality_rules": op3_quality_rules,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_url_filters": op5_url_filters,
    "op6_topk": op6_topk,
    "op7_ngram_join": op7_ngram_join,
    "op8_license_scans": op8_license_scans,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_word_bpe": op13_word_bpe,
}

SQL: dict[str, str] = {
    "op1_line_dedup": OP1_SQL,
    "op5_url_filters": OP5_SQL,
    "op6_topk": OP6_SQL,
    "op7_ngram_join": OP7_SQL,
    "op9_substring_dedup": OP9_SQL,
    "op11_spelling_variants": OP11_SQL,
    "op12_merkle_manifest": OP12_SQL,
}
