"""Registered queries of file lookups, reports and model hooks, on paths and rows derived from the tables, and their SQL."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.plans import queries as base
from tempora.plans import reports as plans
from tempora.plans import schedules
from tempora.sources import catalog, reports, views

FOLDERS = ["", "day1/", "day2/", "_old/", "Clips/", "day1/deep/", "Загрузить/"]
ENDS = [".mov", ".mp4", ".mkv", ".webm", ".txt"]
LISTS = [".json", "/edl.json", "/b_edit/edl.json", "/a_edit/src_edit.json", "/tt/x.json", "/edl2/my_src.json", "/other/edl.json"]


def _nth(values: list[str], k) -> F.Column:
    return F.element_at(F.array(*map(F.lit, values)), (k + 1).cast("int"))


def _files(spark: SparkSession, d: str) -> DataFrame:
    """path of a file for each document."""
    i = F.col("doc_id")
    return views.table(spark, d, "documents").select(F.concat(_nth(FOLDERS, i % 7), F.lit("v"), (i % 97).cast("string"), _nth(ENDS, i % 5)).alias("path"))


def source_lookup(spark, d):
    names = spark.range(100).select(F.concat(F.lit("v"), F.col("id").cast("string")).alias("name"))
    return catalog.find_sources(_files(spark, d), names)


def clip_listing(spark, d):
    return catalog.clips(_files(spark, d)).distinct()


def clips_of_source(spark, d):
    """The first ten clips of one source, as the command line asks for them."""
    return catalog.clips(_files(spark, d).distinct(), "day1", 10)


def sources_with_features(spark, d):
    i = F.col("doc_id")
    paths = views.table(spark, d, "documents").select(F.concat("source", _nth(["/features.csv", "/words.json", "/old/features.csv"], i % 3)).alias("path"))
    return catalog.with_features(paths)


def edit_list_lookup(spark, d):
    i, name = F.col("doc_id"), F.col("source")
    own = F.when(i % 2 == 0, name).otherwise("none")
    edits = views.table(spark, d, "documents").select(F.concat("source", _nth(LISTS, i % 7)).alias("path"), F.when(i % 3 > 0, own).alias("src"), F.when(i % 3 == 0, F.concat(F.lit("/videos/"), own, F.lit(".mov"))).alias("source"))
    return catalog.edit_list_of(edits)


def words_override(spark, d):
    """Words of an edit list for each conversation: of its sidecar by file or by name, else its transcript's."""
    src = views.table(spark, d, "conversations").select(F.col("conv_id").alias("src")).distinct()
    edits = src.select(F.col("src").alias("edit"), F.concat(F.lit("e"), "src").alias("stem"), F.concat(F.lit("n"), "src").alias("name"), "src")
    key = F.when(F.col("src") % 4 == 0, F.concat(F.lit("e"), "src")).when(F.col("src") % 4 == 1, F.concat(F.lit("n"), "src"))
    files = src.select(key.alias("stem")).filter("stem is not null")
    second = schedules._second(spark, d).withColumn("stem", key).filter("stem is not null and src % 8 <> 0").drop("src")
    out = catalog.words_for(edits, files, second, views.words(spark, d).select("src", "o", "w", "start_us", "end_us"))
    return out.select("edit", "origin", "o", "w", "start_us")


def peak_report(spark, d):
    """A line for each hour of a source: events as a gain, users as a length."""
    hours = views.samples(spark, d).groupBy("src", "t").agg(F.count("*").alias("n"), F.countDistinct("user_id").alias("u"))
    return hours.select("src", "t", reports.peak_line(F.col("t") % 200 * 3661, F.col("n") / 10, F.col("u") / 5).alias("line"))


def markdown_lines(spark, d):
    c = views.table(spark, d, "conversations")
    text = F.when(F.col("turn") % 5 != 4, F.replace("text", F.lit("e "), F.lit("|\n")))
    return c.select("conv_id", "turn", reports.table_line(F.col("conv_id").cast("string"), "role", text).alias("line"))


def segment_texts(spark, d):
    """Readable text of each segment: both transcripts, and how many words are equal, replaced and left out."""
    both = plans._segment_words(spark, d).withColumnRenamed("w", "giga")
    w = F.when(F.col("o") % 11 != 0, F.when(F.col("o") % 7 == 0, F.reverse("giga")).otherwise(F.col("giga")))
    i = F.col("src") % 1000
    rows = both.select((F.col("src") - i).alias("src"), i.alias("id"), (i * 30).alias("a"), (i * 30 + 20).alias("b"), "o", "giga", w.alias("w"), F.when(w == F.col("giga"), "eq").otherwise("rep").alias("op"))
    return reports.segment_lines(rows)


def log_lines(spark, d):
    e = views.table(spark, d, "events")
    return e.select("event_id", reports.log_line(F.col("ts").cast("timestamp"), F.col("event_type")).alias("line"))


def model_windows(spark, d):
    """A stand-in for a model on each embedding: mean, greatest value and share above zero."""

    def model(x: np.ndarray) -> np.ndarray:
        return np.stack([x.mean(1, dtype=np.float64), x.max(1), (x > 0).mean(1)], 1)

    rows = views.table(spark, d, "embeddings").select("vec_id", "embedding")
    out = reports.with_model(rows, "embedding", model, ["mean", "top", "share"])
    return out.select("vec_id", *((F.round(c, 4) + 0.0).alias(c) for c in ("mean", "top", "share")))


QUERIES = {f.__name__: f for f in (source_lookup, clip_listing, clips_of_source, sources_with_features, edit_list_lookup, words_override, peak_report, markdown_lines, segment_texts, log_lines, model_windows)}

_sql = lambda values: "[" + ", ".join(f"'{v}'" for v in values) + "]"
_FILES = f"fs AS (SELECT DISTINCT {_sql(FOLDERS)}[doc_id % 7 + 1] || 'v' || (doc_id % 97) || {_sql(ENDS)}[doc_id % 5 + 1] AS path FROM documents)"
_CLIPS = "SELECT path, string_split(path, '/')[1] AS src, left(path, length(path) - 4) || '.mp4' AS target FROM fs WHERE path LIKE '%.mov'"
ORACLES = {
    "source_lookup": rf"""WITH {_FILES}, p AS (SELECT path, string_split(path, '/') AS s, regexp_extract(path, '([^/]+)\.[^.]*$', 1) AS name, list_position(['.mov', '.mp4', '.mkv', '.webm'], regexp_extract(path, '\.[^.]*$')) AS k FROM fs),
r AS (SELECT name, arg_min(path, k) AS path FROM p WHERE k IS NOT NULL AND len(s) = 1 GROUP BY 1), b AS (SELECT name, count(*) AS n, min(path) AS path FROM p WHERE k IS NOT NULL AND len(s) = 2 AND s[1] IN ('day1', 'day2') GROUP BY 1)
SELECT 'v' || i AS name, coalesce(r.path, CASE WHEN n = 1 THEN b.path END) AS path, coalesce(n, 0) AS n_below FROM range(100) x(i) LEFT JOIN r ON r.name = 'v' || i LEFT JOIN b ON b.name = 'v' || i""",
    "clip_listing": f"WITH {_FILES} {_CLIPS}",
    "clips_of_source": f"WITH {_FILES} {_CLIPS} AND path LIKE 'day1/%' ORDER BY path LIMIT 10",
    "sources_with_features": "SELECT DISTINCT source AS src FROM documents WHERE doc_id % 3 = 0",
    "edit_list_lookup": rf"""WITH x AS (SELECT doc_id % 7 AS k, source AS name, regexp_replace(source, '[0-9]+$', '') AS base FROM documents WHERE doc_id % 2 = 0 AND doc_id % 7 < 6),
y AS (SELECT name, name || {_sql(LISTS)}[k + 1] AS path, CASE k WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 3 THEN 2 WHEN 2 THEN 3 WHEN 5 THEN 4 END AS ord FROM x WHERE k <> 4 AND base = 'src')
SELECT name, arg_min(path, ord) AS path FROM y GROUP BY name""",
    "words_override": f"""WITH {base._W} SELECT src AS edit, 'sidecar' AS origin, o, CASE WHEN o % 7 = 0 THEN reverse(w) ELSE w END AS w, start_us + 20000 AS start_us FROM words WHERE src % 4 < 2 AND src % 8 <> 0 AND o % 11 <> 0
UNION ALL SELECT src, 'transcript', o, w, start_us FROM words WHERE src % 4 >= 2""",
    "peak_report": "SELECT src, t, printf('[%02d:%02d:%02d] +%.1f dB (длительность %.1f с)', s // 3600, s // 60 % 60, s % 60, n / 10, u / 5) AS line FROM (SELECT src, t, t % 200 * 3661 AS s, n, u FROM (SELECT event_type AS src, epoch_us(ts) // 3600000000 AS t, count(*) AS n, count(DISTINCT user_id) AS u FROM events GROUP BY 1, 2))",
    "markdown_lines": r"""SELECT conv_id, turn, '| ' || conv_id || ' | ' || CASE WHEN trim(role) = '' THEN '—' ELSE trim(role) END || ' | ' || CASE WHEN turn % 5 = 4 OR trim(x) = '' THEN '—' ELSE trim(x) END || ' |' AS line
FROM (SELECT *, regexp_replace(replace(replace(text, 'e ', '|' || chr(10)), '|', '\|'), '[\r\n]+', ' ', 'g') AS x FROM conversations)""",
    "segment_texts": f"""WITH {base._W}, s AS (SELECT seg.src, id, o, w AS giga, CASE WHEN o % 11 = 0 THEN NULL WHEN o % 7 = 0 THEN reverse(w) ELSE w END AS w2 FROM words JOIN seg ON words.src = seg.src AND start_us >= seg.a AND end_us <= seg.b)
SELECT src * 1000 AS src, id, printf('# сегмент %d  [%.3f..%.3f)  ', id, id * 30.0::DOUBLE, id * 30 + 20.0::DOUBLE) || concat_ws(', ', CASE WHEN count(*) FILTER (WHERE w2 = giga) > 0 THEN 'eq ' || count(*) FILTER (WHERE w2 = giga) END, CASE WHEN count(*) FILTER (WHERE w2 <> giga) > 0 THEN 'rep ' || count(*) FILTER (WHERE w2 <> giga) END) AS head,
'GIGA: ' || string_agg(giga, ' ' ORDER BY o) AS giga, 'ИТОГ: ' || coalesce(string_agg(w2, ' ' ORDER BY o), '') AS final FROM s GROUP BY src, id""",
    "log_lines": "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') || '+0000 ' || event_type AS line FROM events",
    "model_windows": "SELECT vec_id, round(list_avg(embedding::DOUBLE[]), 4) + 0.0 AS mean, round(list_max(embedding)::DOUBLE, 4) AS top, round(len(list_filter(embedding, lambda x: x > 0)) / len(embedding), 4) AS share FROM embeddings",
}
