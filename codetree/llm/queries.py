"""One query per operator, over its whole table with production parameters, and SQL where it can express one."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codetree.llm import compact_windows, dac, fill_middle, host_rank, jaccard_join, kneser_ney, language_id, latent, packing
from codetree.llm import secret_scan, token_alignment, winnowing, wrapper
from codetree.llm.tables import free_shuffles
from codetree.staging import checkpoint_dir

TOKENIZER = "word_bpe_49k.json"
ALIGNED = ("byte_bpe_50k.json", "piece_bpe_32k.model")
RULES = (
    host_rank.Rule("org/", "allow"),
    host_rank.Rule("example.org/es/", "block"),
    host_rank.Rule("example.org/en/1", "block"),
    host_rank.Rule("com/fr/", "allow"),
    host_rank.Rule("com/de/", "block"),
)
_ROOT = str(Path(__file__).resolve().parents[2])


def tokenizer_path(name: str = TOKENIZER) -> str:
    """A tokenizer file, at the same place on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


#: Rows of whole texts that go to a Python worker at once.
BATCH_ROWS = 1_000


def ready(spark: SparkSession) -> SparkSession:
    """Lets Python workers import this package where it is not installed but lies at the same place.

    Batches of texts are kept small, workers give freed memory back to the machine, and what earlier jobs shuffled goes.
    """
    environment = spark.sparkContext.environment
    environment.setdefault("PYTHONPATH", _ROOT)
    environment.setdefault("ARROW_DEFAULT_MEMORY_POOL", "system")
    environment.setdefault("MALLOC_ARENA_MAX", "2")
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= BATCH_ROWS:
        spark.conf.set(rows, BATCH_ROWS)
    free_shuffles(spark)
    return spark


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    kept = language_id.held_out(F.col("doc_id"))
    model = language_id.train(documents.filter(~kept))
    found = language_id.identify(documents.select("doc_id", "text"), model)
    return found.select("doc_id", kept.alias("held_out"), "lang_pred", "score")


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(_table(spark, sf_dir, "documents"), width=4, num=85, den=100)


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.fingerprints(_table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compact_windows.repeats(_table(spark, sf_dir, "documents"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    path = f"{checkpoint_dir(spark)}/codetree/token-files-{uuid.uuid4().hex}"
    dac.write_token_files(documents, path, tokenizer_path(), end=1)
    return dac.read_token_files(spark, path)


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latent.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rank.judge(_table(spark, sf_dir, "pages"), RULES)


def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrapper.main_text(_table(spark, sf_dir, "pages"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    return packing.pack(packing.pieces(documents, tokenizer_path(), 0, packing.SEQUENCE_TOKENS))


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fill_middle.restore(fill_middle.rearrange(_table(spark, sf_dir, "documents")))
    digests = [F.sha2(c, 256).alias(f"{c}_sha256") for c in ("output", "restored")]
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    a_path, b_path = map(tokenizer_path, ALIGNED)
    found = token_alignment.measures(_table(spark, sf_dir, "documents"), a_path, b_path, spell=False)
    return found.withColumnRenamed("groups", "groups_sha256")


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        *(secret_scan.count_of("base", kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")),
        F.sha2(secret_scan.spelled_spans("base"), 256).alias("base_sha256"),
        secret_scan.spelled_spans("spans").alias("spans"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_language_id, op2_jaccard_join, op3_fingerprints, op4_quality, op5_substring_dedup,
        op6_token_files, op7_decontamination, op8_url_filter, op9_main_text, op10_packing,
        op11_fill_middle, op12_token_alignment, op13_secret_scan,
    )
}

#: op2: links by counting common shingles of every pair that has any, components by reachability.
#: op11: cuts and orders by lists of units; what is restored must be the text.
ORACLE_SQL: dict[str, str] = {
    "op2_jaccard_join": r"""
WITH RECURSIVE
words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s
  FROM words),
sizes AS (SELECT doc_id, len(s) AS n FROM sets),
grams AS (SELECT doc_id, hash(unnest(s)) AS g FROM sets),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
  FROM grams x JOIN grams y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * c >= 85 * (p.n + q.n - c)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM sizes UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)
SELECT s.doc_id, CAST(s.n AS BIGINT) AS n_shingles, min(r.b) AS component_id
FROM sizes s JOIN reach r ON r.a = s.doc_id GROUP BY s.doc_id, s.n
""",
    "op11_fill_middle": r"""
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
cut AS (
  SELECT doc_id, t, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS u,
    CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
    CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4
  FROM drawn),
placed AS (
  SELECT *, CAST(len(u) AS BIGINT) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS x, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS y,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
      WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM cut),
parts AS (
  SELECT *, array_to_string(u[1:x], '') AS p, array_to_string(u[x + 1:y], '') AS m, array_to_string(u[y + 1:], '') AS s FROM placed)
SELECT doc_id, n, form,
  CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM parts
""",
}
