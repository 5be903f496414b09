"""The registered queries of this package and the SQL that some of them must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlens.llm import backoff_lm, bpe_automaton, cotraining, html_model, licenses, mixing, repair, spelling, tiling, toxicity, whitening
from wardlens.llm.exact_dedup import exact_dedup
from wardlens.llm.simhash import simhash_groups
from wardlens.llm.staging import table
from wardlens.session import shared_path


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdicts = exact_dedup(table(spark, sf_dir, "documents"))
    return verdicts.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


OP1_SQL = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       text_sha256
FROM (SELECT doc_id,
             sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))
               AS text_sha256
      FROM documents)
WINDOW same AS (PARTITION BY text_sha256)
"""


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cotraining.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiling.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash_groups(table(spark, sf_dir, "documents"), words=4, max_bits=4)
    return groups.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backoff_lm.score_texts(table(spark, sf_dir, "documents"), order=3)


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = html_model.extract_text(table(spark, sf_dir, "pages"))
    return texts.withColumn("n_chars", F.char_length("text").cast("long"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    def joined(labels):
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    found = licenses.scan_licenses(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min("base.start").alias("first_word"),
        F.array_max("base.start").alias("last_word"),
        joined(F.col("base.label")).alias("base_labels"),
        joined(F.concat("base.label", "found.label")).alias("labels"),
        "score",
    )


def op9_token_id_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "token-ids")
    repair.write_ids(table(spark, sf_dir, "documents"), path)
    return repair.read_ids(spark, path).select(
        "doc_id",
        "start",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


def op10_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = bpe_automaton.encode(table(spark, sf_dir, "documents"), decoded=True)
    return tokens.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), weights=(5, 2, 1), limit=3)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


# The level is the first at which the next source, by size per weight, need not stop. The running sum
# of words by hash is cut where it is nearest to what whole passes leave of the target.
OP11_SQL = r"""
WITH d AS (
  SELECT doc_id, source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 15) AS BIGINT) AS h
  FROM documents),
s AS (
  SELECT source, source_size, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source)),
o AS (
  SELECT *, row_number() OVER (ORDER BY source_size * 1.0 / w, source NULLS LAST) AS k FROM s),
p AS (
  SELECT *, (SELECT sum(source_size) FROM s) - 3 * (sum(source_size) OVER upto - source_size) AS num,
         (SELECT sum(w) FROM s) - (sum(w) OVER upto - w) AS den
  FROM o WINDOW upto AS (ORDER BY k ROWS UNBOUNDED PRECEDING)),
level AS (
  SELECT CAST(num AS BIGINT) AS num, CAST(den AS BIGINT) AS den FROM p
  WHERE 3 * source_size * den >= w * num ORDER BY k LIMIT 1),
t AS (
  SELECT source, source_size,
         CASE WHEN 3 * source_size * den < w * num THEN CAST(3 * source_size AS DOUBLE)
              ELSE CAST(w * num AS DOUBLE) / CAST(den AS DOUBLE) END AS target
  FROM s, level),
b AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS passes FROM t),
g AS (
  SELECT source, h, sum(size) AS words, sum(sum(size)) OVER (PARTITION BY source ORDER BY h) AS upto
  FROM d GROUP BY source, h),
c AS (
  SELECT g.source, g.h,
         upto <= budget OR (upto - words <= budget AND upto - budget < budget - (upto - words)) AS again
  FROM g JOIN (SELECT *, greatest(0, target - passes * source_size) AS budget FROM b) AS x
    ON g.source IS NOT DISTINCT FROM x.source)
SELECT d.doc_id, d.size, b.source_size, b.target,
       CAST(d.size * (b.passes + CASE WHEN c.again THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source
       JOIN c ON d.source IS NOT DISTINCT FROM c.source AND d.h = c.h
"""


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"), least_letters=7, least_uses=2, ratio=10)


# CRC-32 byte by byte over a table made by eight shifts of each byte value. Near words are found through
# what is left when one letter is taken away, and then compared position by position.
OP12_SQL = r"""
WITH RECURSIVE crc AS (
  SELECT list(v ORDER BY i) AS t
  FROM (SELECT i, list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]),
                              lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
        FROM (SELECT CAST(unnest(range(256)) AS BIGINT) AS i))),
runs AS (
  SELECT doc_id, run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(
                 translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 '[A-Za-z\x{C0}-\x{FF}]+')) AS run
        FROM documents)
  WHERE length(run) >= 7 GROUP BY doc_id, run),
hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295, bytes),
                       lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS h
  FROM (SELECT run, n, flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''),
                 lambda x: CASE WHEN unicode(x) < 128 THEN [CAST(unicode(x) AS BIGINT)]
                           ELSE [CAST(192 + (unicode(x) >> 6) AS BIGINT), CAST(128 + (unicode(x) & 63) AS BIGINT)] END)) AS bytes, t
        FROM runs, crc)),
words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n
  FROM (SELECT CASE WHEN h % 31 = 0 THEN left(run, CAST(h % length(run) AS INT)) || substr(run, CAST(h % length(run) AS INT) + 2)
                    ELSE run END AS word, n FROM hashed)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
less AS (
  SELECT word, n, i, left(word, i) || substr(word, i + 2) AS rest
  FROM (SELECT word, n, CAST(unnest(range(length(word))) AS INT) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM less AS a JOIN less AS b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM less AS a JOIN words AS b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM less AS a JOIN words AS b ON a.rest = b.word),
best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS other, max(other_n) AS other_n FROM near GROUP BY word),
forms AS (
  SELECT words.word, n, coalesce(n_near, 0) AS n_near,
         CASE WHEN other_n >= 10 * n THEN other END AS form, CASE WHEN other_n >= 10 * n THEN other_n END AS form_n
  FROM words LEFT JOIN best ON words.word = best.word),
ways AS (
  SELECT word, word AS root, form AS further FROM forms
  UNION ALL
  SELECT ways.word, forms.word, forms.form FROM ways JOIN forms ON ways.further = forms.word)
SELECT forms.word, n, n_near, form, form_n, root FROM forms JOIN ways ON forms.word = ways.word AND further IS NULL
"""


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), components=32, scale=64, shift=1_000_000)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_benchmark_decontamination": op3_benchmark_decontamination,
    "op4_simhash_near_dedup": op4_simhash_near_dedup,
    "op5_toxicity": op5_toxicity,
    "op6_lm_scoring": op6_lm_scoring,
    "op7_html_extraction": op7_html_extraction,
    "op8_license_scan": op8_license_scan,
    "op9_token_id_output": op9_token_id_output,
    "op10_bpe_automaton": op10_bpe_automaton,
    "op11_mixing": op11_mixing,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_embedding_whitening": op13_embedding_whitening,
}

ORACLE: dict[str, str] = {"op1_exact_dedup": OP1_SQL, "op11_mixing": OP11_SQL, "op12_spelling_variants": OP12_SQL}
