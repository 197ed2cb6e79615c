"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pathlib import Path

from tempora.llm import bpe, decontaminate, html_extract, kneser_ney, language_id, line_quality, minhash_forest, packing, pii, sharding, token_alignment, url_filter, whitening
from tempora.llm.common import stored, table


def op1_html_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op2_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def op5_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    chain = line_quality.train(line_quality.sample(docs, table(spark, sf_dir, "labels")))
    return line_quality.judge(docs, chain)


def held_out() -> F.Column:
    """The fold that language ID doesn't learn from: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def op8_language_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", held_out().alias("held_out"))
    model = language_id.train(language_id.sample(docs.filter(~F.col("held_out"))))
    return language_id.predict(docs, model, keep=["held_out"]).select("doc_id", "held_out", "lang_pred", "score")


def op7_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_forest.join(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links", "n_copies", "stays")


def op3_extendible_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def op4_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_url_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), url_filter.train(url_filter.labelled(spark)))


#: The key of the registered query; a real job passes its own secret.
PII_KEY = b"a key for examples"


def op9_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.anonymise(table(spark, sf_dir, "documents"), PII_KEY, report=True).select("doc_id", "text", "pii_entities", F.array_join("pii_types", ",").alias("pii_types"))


def tokenizer_json(path: str | None = None) -> str:
    """The tokenizer's description; without a path, the public one that the contract names."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    return Path(path).read_text(encoding="utf-8")


def op10_bm25_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_json())


def op11_interval_alignment(spark: SparkSession, sf_dir: str, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """`a_path` and `b_path` are files of the driver; without them, the public tokenizers that the contract names."""
    if a_path is None or b_path is None:
        import public_tokenizers

        a_path, b_path = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    found = token_alignment.align(table(spark, sf_dir, "documents"), tokenizer_json(a_path), Path(b_path).read_bytes(), as_text=False)
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("groups").alias("groups_sha256"))


def op12_speculative_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    description = tokenizer_json()
    both = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), description), description)
    numbers = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(numbers, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_svd_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


#: The pipeline drops documents in which the best language has a smaller share of the words.
LEAST_SHARE = 0.3


def plain_names(docs: DataFrame) -> tuple[DataFrame, str, str]:
    """The documents under names that clash with nothing (c0, c1, ...), and those of doc_id and text."""
    names = [f"c{k}" for k in range(len(docs.columns))]
    return docs.toDF(*names), names[docs.columns.index("doc_id")], names[docs.columns.index("text")]


def in_known_language(docs: DataFrame, least: float = LEAST_SHARE) -> DataFrame:
    model = language_id.train(language_id.sample(docs.filter(~held_out())))
    rows, key, text = plain_names(docs)
    named = language_id.predict(rows, model, id_col=key, text_col=text, keep=rows.columns)
    return named.filter((F.col("lang_pred") != "und") & (F.col("score") >= least)).select(*rows.columns).toDF(*docs.columns)


def one_of_each_group(docs: DataFrame) -> DataFrame:
    """Rows of equal doc_id and text are one document here."""
    found = stored(minhash_forest.join(docs.select("doc_id", "text")), "groups")
    rows, key, text = plain_names(docs)
    keyed = rows.withColumns({"r_id": F.col(key), "r_exact": F.xxhash64(text)})
    same = lambda keys: F.col("r_id").eqNullSafe(keys["k_id"]) & (F.col("r_exact") == keys["k_exact"])
    keys = found.select(F.col("doc_id").alias("k_id"), F.col("exact").alias("k_exact"), "stays")
    gone = stored(keys.filter(~F.col("stays")).select("k_id", "k_exact").distinct(), "gone")
    gone = F.broadcast(gone) if gone.count() <= minhash_forest.SMALL_ROWS else gone
    left = keyed.join(gone, same(gone), "left_anti")
    again = stored(keys.filter("stays").groupBy("k_id", "k_exact").agg(F.count("*").alias("n")).filter("n > 1").select("k_id", "k_exact"), "again")
    if again.limit(1).count():  # rows that repeat: the first of each
        left = left.join(again, same(again), "left_anti").unionByName(left.join(again, same(again), "left_semi").dropDuplicates(["r_id", "r_exact"]))
    return left.select(*rows.columns).toDF(*docs.columns)


def without_benchmark(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return decontaminate.clean(docs, benchmark)


def with_surrogates(docs: DataFrame) -> DataFrame:
    return pii.anonymise(docs, PII_KEY)


def packed(docs: DataFrame) -> DataFrame:
    return packing.pack(docs, tokenizer_json())


QUERIES = {f.__name__: f for f in (op1_html_crf, op2_fm_index, op3_extendible_hashing, op4_kneser_ney, op5_line_crf, op6_url_regression, op7_lsh_forest, op8_language_crf, op9_pii_surrogates, op10_bm25_packing, op11_interval_alignment, op12_speculative_bpe, op13_svd_whitening)}
ORACLES: dict[str, str] = {
    "op2_fm_index": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS s
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - 9))) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT doc_id, item_id, i, win.n FROM dw JOIN win ON dw.n = win.n AND dw.s = win.s),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op3_extendible_hashing": """
WITH r AS (SELECT doc_id, CAST(coalesce(octet_length(encode(text)), 0) AS BIGINT) AS n_bytes, CAST(('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 15)) AS BIGINT) AS h FROM documents),
bits AS (SELECT doc_id, n_bytes, right(CAST(CAST(h AS BIT) AS VARCHAR), 60) AS s FROM r),
levels AS (SELECT doc_id, n_bytes, d AS depth, left(s, d) AS shard FROM bits, (SELECT unnest(generate_series(0, 60)) AS d)),
fits AS (SELECT depth, shard, sum(n_bytes) AS shard_bytes FROM levels GROUP BY depth, shard HAVING sum(n_bytes) <= 1048576)
SELECT doc_id, n_bytes, shard, CAST(depth AS BIGINT) AS depth, CAST(shard_bytes AS BIGINT) AS shard_bytes
FROM levels JOIN fits USING (depth, shard) QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY depth) = 1""",
}
