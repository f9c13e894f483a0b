"""One registered query for each text operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybuy.llm import (
    decontaminate,
    exact_dedup,
    language_id,
    line_dedup,
    packing,
    periodic_runs,
    secrets,
    simhash,
    suffix_dedup,
    tokens,
    top_k,
    toxicity,
    turns,
)
from tallybuy.operators.joins import lookup
from tallybuy.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECK_SQL: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def wrap(build):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(tune(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            CHECK_SQL[name] = sql
        return build

    return wrap


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query("op1_toxicity")
def _toxicity(spark, sf_dir):
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.fit_toxicity(docs, _table(spark, sf_dir, "labels").where(~held_out))
    scored = toxicity.score_toxicity(docs, model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


@_query("op2_packing")
def _packing(spark, sf_dir):
    path = public_tokenizers.path("byte_bpe_50k.json")
    pieces = packing.pack(_table(spark, sf_dir, "documents"), path, capacity=2048, end_id=1)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@_query(
    "op3_exact_dedup",
    r"""
    WITH t AS (
      SELECT doc_id, length(coalesce(text, '')) AS points,
        sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
      FROM documents)
    SELECT doc_id, first_value(doc_id) OVER w AS keep_id,
      count(*) OVER (PARTITION BY text_sha256) AS group_size,
      doc_id = first_value(doc_id) OVER w AS kept, text_sha256
    FROM t
    WINDOW w AS (PARTITION BY text_sha256 ORDER BY points DESC, doc_id)
    """,
)
def _exact_dedup(spark, sf_dir):
    return exact_dedup.exact_dedup(_table(spark, sf_dir, "documents"))


@_query(
    "op4_exact_top_k",
    """
    WITH v AS (
      SELECT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings
      WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
    s AS (
      SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
    """,
)
def _exact_top_k(spark, sf_dir):
    return top_k.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


@_query("op5_suffix_dedup")
def _suffix_dedup(spark, sf_dir):
    cut = suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"), length=50)
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@_query("op6_secret_scans")
def _secret_scans(spark, sf_dir):
    def number(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")

    found = secrets.find_secrets(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        number(0).alias("n_assign"),
        number(1).alias("n_access"),
        number(2).alias("n_hex"),
        F.sha2(secrets.spans_text(F.col("base")), 256).alias("base_sha256"),
        secrets.spans_text(F.col("spans")).alias("spans"),
    )


@_query("op7_byte_bpe")
def _byte_bpe(spark, sf_dir):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = tokens.encode(_table(spark, sf_dir, "documents"), path)
    return tokens.decode(encoded, path).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@_query(
    "op8_line_dedup",
    r"""
    WITH s AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS x FROM documents),
    l AS (SELECT doc_id, unnest(x) AS line, unnest(range(len(x))) AS pos FROM s),
    k AS (
      SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
      FROM l),
    m AS (
      SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10
      GROUP BY key HAVING count(DISTINCT doc_id) > 1),
    d AS (SELECT k.*, coalesce(first <> doc_id, false) AS gone FROM k LEFT JOIN m USING (key))
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
      sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
    FROM d GROUP BY doc_id
    """,
)
def _line_dedup(spark, sf_dir):
    kept = line_dedup.line_dedup(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@_query("op9_language_id")
def _language_id(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    found = language_id.identify(docs, language_id.fit_language_model(docs))
    return found.select("doc_id", "language", "confidence", "accepted")


@_query("op9_language_id_pages")
def _language_id_pages(spark, sf_dir):
    """All pages: the text model is that of documents, and of pages in the languages that only their markup names."""
    pages = language_id.page_evidence(_table(spark, sf_dir, "pages"))
    docs = _table(spark, sf_dir, "documents").select("text", F.lower("lang").alias("declared"))
    own = lookup(
        pages.where("declared IS NOT NULL").select("text", "declared"), docs.select("declared").distinct(), ["declared"], "left_anti"
    )
    model = language_id.fit_language_model(docs.unionByName(own), label="declared")
    found = language_id.identify(pages, model, declared="declared", host="host")
    return found.select(F.col("doc_id").alias("page_id"), "declared", "host", "language", "confidence", "accepted")


@_query("op10_simhash")
def _simhash(spark, sf_dir):
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"), words=4, most_bits=4)


@_query(
    "op11_decontamination",
    r"""
    WITH d AS (
      SELECT row_number() OVER () AS row, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
      FROM documents),
    b AS (
      SELECT coalesce(item_id::VARCHAR, '') AS item,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
      FROM benchmark),
    k AS (
      SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[p : p + least(len(w), 10) - 1], ' ') AS gram
      FROM (SELECT *, unnest(range(1, greatest(len(w) - 8, 2))) AS p FROM b WHERE len(w) > 0)),
    n AS (SELECT DISTINCT n FROM k),
    g AS (SELECT row, n.n, unnest(range(1, len(w) - n.n + 2)) AS p, w FROM d, n WHERE len(w) >= n.n),
    f AS (SELECT row, g.n, p, item FROM g JOIN k ON g.n = k.n AND array_to_string(w[p : p + g.n - 1], ' ') = gram),
    h AS (SELECT row, count(DISTINCT q) AS n_hit FROM (SELECT row, unnest(range(p, p + n)) AS q FROM f) GROUP BY row),
    i AS (
      SELECT row, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT row, item FROM f) GROUP BY row)
    SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
      sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN h USING (row) LEFT JOIN i USING (row)
    """,
)
def _decontamination(spark, sf_dir):
    found = decontaminate.decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), window=10)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


@_query("op12_turns")
def _turns(spark, sf_dir):
    rows = _table(spark, sf_dir, "conversations")
    return turns.with_all_ids(turns.Repair(turns.damaged(rows)).audits(), rows)


@_query("op13_periodic_runs")
def _periodic_runs(spark, sf_dir):
    seed = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    found = periodic_runs.periodic_runs(_table(spark, sf_dir, "documents"), loop_seed=seed, with_text=False)
    # The longest run; of equals that with the smallest start, then period.
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("col1"), (-r["start"]).alias("col2"), (-r["period"]).alias("col3"))))
    length, start, period = (F.col(f"longest.col{k}") * sign for k, sign in ((1, 1), (2, -1), (3, -1)))
    return found.withColumn("longest", longest).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        start.alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.expr("1000 * longest.col1 div -longest.col3").alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )
