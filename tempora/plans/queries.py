"""Registered queries of the temporal engine and the SQL that each must equal."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tempora.functions import text as T
from tempora.operators import intervals, series, sessions
from tempora.sources import views

BAD, OK = ["tion", "eau"], ["nn"]

_S = """s AS (SELECT event_type AS src, epoch_us(ts) AS us, CAST(floor(epoch_us(ts) / 3600000000.0) AS BIGINT) AS t, value AS x, user_id, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events),
rms AS (SELECT src, t, round(20 * log10(greatest(sqrt(avg(x * x)), 1e-10)), 4) AS raw_db, count(*) AS n FROM s GROUP BY src, t),
grid AS (SELECT src, t FROM (SELECT DISTINCT src FROM rms), (SELECT unnest(generate_series(min(t), max(t))) AS t FROM s)),
ser AS (SELECT src, t, raw_db, n FROM grid LEFT JOIN rms USING (src, t))"""
_Z = _S + """,
c AS (SELECT src, median(raw_db) AS m FROM ser GROUP BY src),
d AS (SELECT src, median(abs(raw_db - m)) AS mad FROM ser JOIN c USING (src) GROUP BY src),
z AS (SELECT src, t, CASE WHEN mad > 0 THEN greatest(-3.0, least(6.0, coalesce((raw_db - m) / (1.4826 * mad), 0.0))) ELSE 0.0 END AS z FROM ser JOIN c USING (src) JOIN d USING (src)),
sm AS (SELECT src, t, z, round(avg(z) OVER (PARTITION BY src ORDER BY t ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING), 6) AS score FROM z),
nb AS (SELECT *, lag(score) OVER w AS p, lead(score) OVER w AS q FROM sm WINDOW w AS (PARTITION BY src ORDER BY t)),
fl AS (SELECT *, (score >= coalesce(p, score) AND score >= coalesce(q, score) AND (coalesce(score > p, false) OR coalesce(score > q, false))) AS pk FROM nb),
peaks AS (SELECT src, t, score FROM (SELECT *, bool_or(pk) OVER (PARTITION BY src) AS has FROM fl) WHERE pk OR NOT has)"""
_W = r"""tk AS (SELECT conv_id AS src, turn, list_filter(string_split_regex(text, '\s+'), lambda w: w <> '') AS ws FROM conversations),
tb AS (SELECT *, coalesce(sum(len(ws)) OVER (PARTITION BY src ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM tk),
te AS (SELECT src, turn, before, unnest(ws) AS w, generate_subscripts(ws, 1) - 1 AS pos FROM tb),
words AS (SELECT src, CAST(before + pos AS BIGINT) AS o, w, CAST((before + pos) * 350000 + turn * 1500000 AS BIGINT) AS start_us, CAST((before + pos) * 350000 + turn * 1500000 + least(length(w), 8) * 40000 AS BIGINT) AS end_us FROM te),
nw AS (SELECT *, regexp_replace(replace(lower(w), 'ё', 'е'), '[^\p{L}\p{N}_]+', '', 'g') AS nrm FROM words),
fb AS (SELECT *, (nrm <> '' AND NOT contains(nrm, 'nn') AND (contains(nrm, 'tion') OR contains(nrm, 'eau'))) AS bad FROM nw),
mw AS (SELECT src, o, w, greatest(CAST(floor(start_us + (end_us - start_us) * (m + 0.5) / n - half) AS BIGINT), start_us) AS a, least(CAST(floor(start_us + (end_us - start_us) * (m + 0.5) / n + half) AS BIGINT), end_us) AS b
  FROM (SELECT *, length(w) AS n, greatest(1, length(w) // 2) AS m, greatest((end_us - start_us) * 0.40::DOUBLE, 150000) / 2 AS half FROM fb WHERE bad)),
un AS (SELECT src, min(a) AS a, max(b) AS b, count(*) AS n FROM (SELECT *, sum(new) OVER (PARTITION BY src ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS g FROM (SELECT *, CASE WHEN a <= max(b) OVER (PARTITION BY src ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 200000 THEN 0 ELSE 1 END AS new FROM mw WHERE b > a)) GROUP BY src, g),
isl AS (SELECT *, sum(new) OVER (PARTITION BY src ORDER BY start_us, o ROWS UNBOUNDED PRECEDING) AS island FROM (SELECT *, CASE WHEN start_us - lag(end_us) OVER (PARTITION BY src ORDER BY start_us, o) <= 300000 THEN 0 ELSE 1 END AS new FROM words)),
seg AS (SELECT src, k AS id, k * 30000000 AS a, k * 30000000 + 20000000 AS b FROM (SELECT src, unnest(generate_series(0, (max(end_us) - 1) // 30000000)) AS k FROM words GROUP BY src))"""


def _sparse(spark: SparkSession, d: str) -> DataFrame:
    return series.rms_per_bucket(views.samples(spark, d))


def _series(spark: SparkSession, d: str) -> DataFrame:
    return series.dense_grid(_sparse(spark, d), views.samples(spark, d))


def _scored(spark: SparkSession, d: str) -> DataFrame:
    return series.rolling_mean(series.robust_z(_series(spark, d), "raw_db"), "z", "score", place="t")


def _flagged(spark: SparkSession, d: str) -> DataFrame:
    return views.words(spark, d).withColumn("bad", T.is_bad(F.col("w"), BAD, OK))


def _mutes(spark: SparkSession, d: str) -> DataFrame:
    a, b = T.mute_bounds(F.col("start_us"), F.col("end_us"), F.col("w"))
    return _flagged(spark, d).filter("bad").select("src", "o", "w", a.alias("a"), b.alias("b"))


def _union(spark: SparkSession, d: str) -> DataFrame:
    return intervals.union(_mutes(spark, d), gap=200_000)


def _segments(spark: SparkSession, d: str) -> DataFrame:
    last = views.words(spark, d).groupBy("src").agg(F.max("end_us").alias("m"))
    k = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("m") - 1) / 30_000_000)))
    return last.select("src", k.alias("id")).select("src", "id", (F.col("id") * 30_000_000).alias("a"), (F.col("id") * 30_000_000 + 20_000_000).alias("b"))


def _clipped(spark: SparkSession, d: str) -> DataFrame:
    """Merged mutes clipped to the segments that they overlap."""
    mutes = _union(spark, d).select("src", F.col("a").alias("la"), F.col("b").alias("lb"))
    segs = _segments(spark, d).select("src", "id", F.col("a").alias("ra"), F.col("b").alias("rb"))
    met = intervals.range_join(mutes, segs, "src", 10_000_000, (F.col("la") < F.col("rb")) & (F.col("lb") > F.col("ra")))
    return met.select("src", "id", F.greatest("la", "ra").alias("a"), F.least("lb", "rb").alias("b"))


def rms_per_bucket(spark, d):
    return _sparse(spark, d)


def dense_grid_counts(spark, d):
    return _series(spark, d).select("src", "t", F.coalesce("n", F.lit(0)).alias("n"))


def peak_threshold_islands(spark, d):
    return series.threshold_islands(_series(spark, d), "raw_db", 6.0, 5).select("src", "t_from", "t_to", "peak_db", "delta_db")


def voice_mask(spark, d):
    voiced = views.samples(spark, d).filter("user_id % 2 = 0").groupBy("src", "t").agg(F.round(series.rms_db(F.col("x")), 4).alias("voice_db"))
    return _sparse(spark, d).join(voiced, ["src", "t"], "left").select("src", "t", "voice_db", F.when(F.col("voice_db") > 35, F.col("raw_db")).alias("masked_db"))


def robust_z(spark, d):
    return series.robust_z(_series(spark, d), "raw_db").select("src", "t", F.round("z", 4).alias("z"))


def smooth_z(spark, d):
    return _scored(spark, d).select("src", "t", "score")


def local_maxima(spark, d):
    return series.local_maxima(_scored(spark, d), "score", place="t").select("src", "t", F.round("score", 4).alias("score"))


def nms_topn(spark, d):
    return series.nms_top_n(series.local_maxima(_scored(spark, d), "score", place="t"), "score").select("src", "rank", "t", F.round("score", 4).alias("score"))


def sliding_3h(spark, d):
    w = Window.partitionBy("src").orderBy("t").rangeBetween(-1, 1)
    s = _sparse(spark, d)
    return s.select("src", "t", F.sum("n").over(w).alias("n3"), F.round(F.max("raw_db").over(w), 4).alias("max_db"))


def norm_words(spark, d):
    w = F.col("w")
    return views.words(spark, d).groupBy(T.norm_word(w).alias("norm"), T.clean_word(w).alias("clean")).agg(F.count("*").alias("n"))


def is_bad_words(spark, d):
    return _flagged(spark, d).filter("bad").select("src", "o", "w", T.censor(F.col("w")).alias("censored"))


def mute_windows(spark, d):
    return _mutes(spark, d)


def mute_union(spark, d):
    return _union(spark, d)


def mute_stats(spark, d):
    size = F.col("b") - F.col("a")
    return _union(spark, d).groupBy("src").agg(F.count("*").alias("n"), F.min(size).alias("least"), F.max(size).alias("most"), F.sum(size).alias("total"))


def mute_topk(spark, d):
    return _union(spark, d).select("src", "a", "b", (F.col("b") - F.col("a")).alias("size")).orderBy(F.desc("size"), "src", "a").limit(5)


def mute_freq(spark, d):
    return _flagged(spark, d).filter("bad").groupBy(T.norm_word(F.col("w")).alias("word")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "word").limit(15)


def caption_groups(spark, d):
    return sessions.caption_groups(views.words(spark, d)).select("src", "a", "b", "n", "text")


def phrase_sessions(spark, d):
    return sessions.phrases(views.words(spark, d))


def segment_words_start(spark, d):
    w = views.words(spark, d).select("src", "o", F.col("start_us").alias("la"), F.col("start_us").alias("lb"))
    s = _segments(spark, d).select("src", "id", F.col("a").alias("ra"), F.col("b").alias("rb"))
    return intervals.range_join(w, s, "src", 10_000_000, F.col("la") < F.col("rb")).groupBy("src", "id").agg(F.count("*").alias("n"))


def segment_words_contained(spark, d):
    w = views.words(spark, d).select("src", "o", F.col("start_us").alias("la"), F.col("end_us").alias("lb"))
    s = _segments(spark, d).select("src", "id", F.col("a").alias("ra"), F.col("b").alias("rb"))
    return intervals.range_join(w, s, "src", 10_000_000, (F.col("la") >= F.col("ra")) & (F.col("lb") <= F.col("rb"))).groupBy("src", "id").agg(F.count("*").alias("n"))


def running_offsets(spark, d):
    w = Window.partitionBy("src").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    return _segments(spark, d).select("src", "id", "a", "b", F.coalesce(F.sum(F.col("b") - F.col("a")).over(w), F.lit(0)).alias("out_us"))


def interval_subtract(spark, d):
    return intervals.subtract(_segments(spark, d), _clipped(spark, d))


def interval_complement(spark, d):
    total = views.words(spark, d).groupBy("src").agg(F.max("end_us").alias("total"))
    return intervals.complement(_union(spark, d), total, least=600_000)


def asof_backward(spark, d):
    e = views.samples(spark, d).select(F.col("user_id"), "us", "src", "x")
    buys = views.table(spark, d, "events").select(F.unix_micros(F.col("ts").cast("timestamp")).alias("us"), "user_id", "event_id")
    prices = e.groupBy("user_id", "us").agg(F.max("x").alias("x"))
    before = prices.select("user_id", (F.col("us") + 1).alias("us"), "x")
    return intervals.as_of(buys, before, "user_id", "us", ["x"]).select("event_id", "x")


def vocab_intersect(spark, d):
    v = lambda role: views.table(spark, d, "conversations").filter(F.col("role") == role).select(F.explode(F.split("text", r"\s+")).alias("w")).select(T.norm_word(F.col("w")).alias("word")).filter("word <> ''").distinct()
    return v("user").intersect(v("assistant"))


def timecode_formats(spark, d):
    s = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000) % 86400
    return views.table(spark, d, "events").select("event_id", T.clock(s).alias("clock"), T.parse_clock(T.clock(s)).alias("seconds"))


def debounce_batch(spark, d):
    """Runs of events under 50 per user that reach three in a row: first time of the third."""
    low = views.samples(spark, d).groupBy("user_id", "us").agg(F.max("x").alias("x")).withColumn("up", (F.col("x") >= 50).cast("long"))
    w = Window.partitionBy("user_id").orderBy("us")
    runs = low.withColumn("run", F.sum("up").over(w.rowsBetween(Window.unboundedPreceding, 0))).filter("up = 0")
    return runs.withColumn("k", F.row_number().over(Window.partitionBy("user_id", "run").orderBy("us"))).filter("k = 3").select("user_id", "us")


QUERIES = {f.__name__: f for f in (rms_per_bucket, dense_grid_counts, peak_threshold_islands, voice_mask, robust_z, smooth_z, local_maxima, nms_topn, sliding_3h, norm_words, is_bad_words, mute_windows, mute_union, mute_stats, mute_topk, mute_freq, caption_groups, phrase_sessions, segment_words_start, segment_words_contained, running_offsets, interval_subtract, interval_complement, asof_backward, vocab_intersect, timecode_formats, debounce_batch)}

_CLIP = _W + ", cl AS (SELECT seg.src, id, greatest(un.a, seg.a) AS a, least(un.b, seg.b) AS b FROM un JOIN seg ON un.src = seg.src AND un.a < seg.b AND un.b > seg.a)"
ORACLES = {
    "rms_per_bucket": f"WITH {_S} SELECT src, t, raw_db, n FROM rms",
    "dense_grid_counts": f"WITH {_S} SELECT src, t, coalesce(n, 0) AS n FROM ser",
    "peak_threshold_islands": f"WITH {_S}, h AS (SELECT ser.*, m FROM ser JOIN (SELECT src, median(raw_db) AS m FROM ser GROUP BY src) USING (src) WHERE raw_db >= m + 6), g AS (SELECT *, sum(new) OVER (PARTITION BY src ORDER BY t ROWS UNBOUNDED PRECEDING) AS island FROM (SELECT *, CASE WHEN t - lag(t) OVER (PARTITION BY src ORDER BY t) < 5 THEN 0 ELSE 1 END AS new FROM h)) SELECT src, min(t) AS t_from, max(t) + 1 AS t_to, round(max(raw_db), 4) AS peak_db, round(max(raw_db - m), 6) AS delta_db FROM g GROUP BY src, island",
    "voice_mask": f"WITH {_S}, v AS (SELECT src, t, round(20 * log10(greatest(sqrt(avg(x * x)), 1e-10)), 4) AS voice_db FROM s WHERE user_id % 2 = 0 GROUP BY src, t) SELECT src, t, voice_db, CASE WHEN voice_db > 35 THEN raw_db END AS masked_db FROM rms LEFT JOIN v USING (src, t)",
    "robust_z": f"WITH {_Z} SELECT src, t, round(z, 4) AS z FROM z",
    "smooth_z": f"WITH {_Z} SELECT src, t, score FROM sm",
    "local_maxima": f"WITH {_Z} SELECT src, t, round(score, 4) AS score FROM peaks",
    "nms_topn": f"WITH RECURSIVE {_Z}, r AS (SELECT *, row_number() OVER (PARTITION BY src ORDER BY score DESC, t) AS i FROM peaks), f AS (SELECT src, CAST(0 AS BIGINT) AS i, CAST([] AS BIGINT[]) AS kept FROM (SELECT DISTINCT src FROM r) UNION ALL SELECT f.src, r.i, CASE WHEN len(kept) < 20 AND len(list_filter(kept, lambda y: abs(y - r.t) < 45)) = 0 THEN list_append(kept, r.t) ELSE kept END FROM f JOIN r ON r.src = f.src AND r.i = f.i + 1), l AS (SELECT src, kept FROM f QUALIFY row_number() OVER (PARTITION BY src ORDER BY i DESC) = 1), u AS (SELECT src, unnest(kept) AS t, generate_subscripts(kept, 1) AS rank FROM l) SELECT u.src, CAST(rank AS BIGINT) AS rank, u.t, round(score, 4) AS score FROM u JOIN peaks ON u.src = peaks.src AND u.t = peaks.t",
    "sliding_3h": f"WITH {_S} SELECT src, t, CAST(sum(n) OVER w AS BIGINT) AS n3, round(max(raw_db) OVER w, 4) AS max_db FROM rms WINDOW w AS (PARTITION BY src ORDER BY t RANGE BETWEEN 1 PRECEDING AND 1 FOLLOWING)",
    "norm_words": f"WITH {_W} SELECT nrm AS norm, regexp_replace(lower(w), '[^0-9a-zа-яё]', '', 'g') AS clean, count(*) AS n FROM nw GROUP BY 1, 2",
    "is_bad_words": f"WITH {_W} SELECT src, o, w, CASE WHEN length(w) > 0 THEN substr(w, 1, greatest(1, length(w) // 2)) || '*' || substr(w, greatest(1, length(w) // 2) + 2) ELSE w END AS censored FROM fb WHERE bad",
    "mute_windows": f"WITH {_W} SELECT src, o, w, a, b FROM mw",
    "mute_union": f"WITH {_W} SELECT src, a, b, n FROM un",
    "mute_stats": f"WITH {_W} SELECT src, count(*) AS n, min(b - a) AS least, max(b - a) AS most, CAST(sum(b - a) AS BIGINT) AS total FROM un GROUP BY src",
    "mute_topk": f"WITH {_W} SELECT src, a, b, b - a AS size FROM un ORDER BY size DESC, src, a LIMIT 5",
    "mute_freq": f"WITH {_W} SELECT nrm AS word, count(*) AS n FROM fb WHERE bad GROUP BY 1 ORDER BY n DESC, word LIMIT 15",
    "caption_groups": f"WITH RECURSIVE {_W}, iw AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY src, island ORDER BY start_us, o) AS i FROM isl), f AS (SELECT src, island, i, 1 AS g, 1 AS n, length(w) AS c, w, start_us, end_us FROM iw WHERE i = 1 UNION ALL SELECT f.src, f.island, x.i, CASE WHEN f.n >= 3 OR f.c + 1 + length(x.w) > 18 THEN g + 1 ELSE g END, CASE WHEN f.n >= 3 OR f.c + 1 + length(x.w) > 18 THEN 1 ELSE f.n + 1 END, CASE WHEN f.n >= 3 OR f.c + 1 + length(x.w) > 18 THEN length(x.w) ELSE f.c + 1 + length(x.w) END, x.w, x.start_us, x.end_us FROM f JOIN iw x ON x.src = f.src AND x.island = f.island AND x.i = f.i + 1) SELECT src, min(start_us) AS a, max(end_us) AS b, count(*) AS n, string_agg(w, ' ' ORDER BY i) AS text FROM f GROUP BY src, island, g",
    "phrase_sessions": f"WITH RECURSIVE {_W}, i8 AS (SELECT *, sum(new) OVER (PARTITION BY src ORDER BY start_us, o ROWS UNBOUNDED PRECEDING) AS island FROM (SELECT * , CASE WHEN start_us - lag(end_us) OVER (PARTITION BY src ORDER BY start_us, o) <= 800000 THEN 0 ELSE 1 END AS new FROM words)), iw AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY src, island ORDER BY start_us, o) AS i FROM i8), f AS (SELECT src, island, i, start_us AS s0, 1 AS g, w, end_us FROM iw WHERE i = 1 UNION ALL SELECT f.src, f.island, x.i, CASE WHEN x.end_us - s0 > 15000000 THEN x.start_us ELSE s0 END, CASE WHEN x.end_us - s0 > 15000000 THEN g + 1 ELSE g END, x.w, x.end_us FROM f JOIN iw x ON x.src = f.src AND x.island = f.island AND x.i = f.i + 1) SELECT src, min(s0) AS a, max(end_us) AS b, count(*) AS n, string_agg(w, ' ' ORDER BY i) AS text FROM f GROUP BY src, island, g",
    "segment_words_start": f"WITH {_W} SELECT words.src, id, count(*) AS n FROM words JOIN seg ON words.src = seg.src AND start_us >= a AND start_us < b GROUP BY 1, 2",
    "segment_words_contained": f"WITH {_W} SELECT words.src, id, count(*) AS n FROM words JOIN seg ON words.src = seg.src AND start_us >= a AND end_us <= b GROUP BY 1, 2",
    "running_offsets": f"WITH {_W} SELECT src, id, a, b, CAST(coalesce(sum(b - a) OVER (PARTITION BY src ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS out_us FROM seg",
    "interval_subtract": f"WITH {_CLIP}, e AS (SELECT src, id, a AS x, b AS y FROM cl UNION ALL SELECT src, id, b, b FROM seg), p AS (SELECT e.src, e.id, coalesce(lag(y) OVER (PARTITION BY e.src, e.id ORDER BY x, y), seg.a) AS a, x AS b FROM e JOIN seg ON e.src = seg.src AND e.id = seg.id) SELECT * FROM p WHERE b > a",
    "interval_complement": f"WITH {_W}, e AS (SELECT src, a, b FROM un UNION ALL SELECT src, max(end_us), max(end_us) FROM words GROUP BY src), p AS (SELECT src, coalesce(lag(b) OVER (PARTITION BY src ORDER BY a, b), 0) AS a, a AS b FROM e) SELECT * FROM p WHERE b - a > 600000",
    "asof_backward": "WITH p AS (SELECT user_id, epoch_us(ts) AS us, max(value) AS x FROM events GROUP BY 1, 2), e AS (SELECT event_id, user_id, epoch_us(ts) AS us FROM events) SELECT event_id, x FROM e ASOF LEFT JOIN p ON e.user_id = p.user_id AND e.us > p.us",
    "vocab_intersect": r"WITH v AS (SELECT DISTINCT role, regexp_replace(replace(lower(w), 'ё', 'е'), '[^\p{L}\p{N}_]+', '', 'g') AS word FROM (SELECT role, unnest(string_split_regex(text, '\s+')) AS w FROM conversations)) SELECT word FROM v WHERE role = 'user' AND word <> '' INTERSECT SELECT word FROM v WHERE role = 'assistant'",
    "timecode_formats": "SELECT event_id, printf('%02d:%02d:%02d', s // 3600, s // 60 % 60, s % 60) AS clock, CAST(s AS BIGINT) AS seconds FROM (SELECT event_id, (epoch_us(ts) // 1000000) % 86400 AS s FROM events)",
    "debounce_batch": "WITH l AS (SELECT user_id, epoch_us(ts) AS us, CASE WHEN max(value) >= 50 THEN 1 ELSE 0 END AS up FROM events GROUP BY 1, 2), r AS (SELECT *, sum(up) OVER (PARTITION BY user_id ORDER BY us ROWS UNBOUNDED PRECEDING) AS run FROM l), k AS (SELECT *, row_number() OVER (PARTITION BY user_id, run ORDER BY us) AS k FROM r WHERE up = 0) SELECT user_id, us FROM k WHERE k = 3",
}
