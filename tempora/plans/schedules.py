"""Registered queries of ranking, reconciled mutes and clip schedules, and the SQL that each must equal."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.functions import text as T
from tempora.operators import align, intervals, ranking, schedule, series, sessions
from tempora.plans import queries as base
from tempora.sources import views
from tempora.streaming import watch

BUCKET = 10_000_000
CONFIG = [("loud", "raw_db", 1.0), ("mixed", "raw_db", 0.5), ("mixed", "arousal", 0.3), ("mixed", "n", 0.2)]


def _features(spark: SparkSession, d: str) -> DataFrame:
    mean = views.samples(spark, d).groupBy("src", "t").agg(F.round(F.avg("x"), 4).alias("arousal"))
    return base._series(spark, d).join(mean, ["src", "t"], "left").select("src", "t", "raw_db", "arousal", F.coalesce("n", F.lit(0)).alias("n"))


def _refs(spark: SparkSession, d: str) -> DataFrame:
    ends = base._series(spark, d).groupBy("src").agg(F.min("t").alias("lo"), F.max("t").alias("hi"))
    return ends.select("src", "lo", F.posexplode(F.sequence("lo", "hi", F.lit(100).cast("long"))).alias("ord", "a")).select("src", "ord", "a", (F.col("a") + 12).alias("b"))


def _second(spark: SparkSession, d: str) -> DataFrame:
    """The second transcript: words left out, words turned round, times 20 ms later."""
    w = views.words(spark, d).filter("o % 11 <> 0")
    return w.select("src", "o", F.when(F.col("o") % 7 == 0, F.reverse("w")).otherwise(F.col("w")).alias("w"), (F.col("start_us") + 20_000).alias("start_us"), (F.col("end_us") + 20_000).alias("end_us"))


def _bad(words: DataFrame) -> DataFrame:
    return words.filter(T.is_bad(F.col("w"), base.BAD, base.OK))


def _bounds(words: DataFrame, a: str, b: str, pad: int = 0) -> DataFrame:
    return words.select("src", "o", "w", "start_us", "end_us", (F.col("start_us") - pad).alias(a), (F.col("end_us") + pad).alias(b))


def _first_only(spark: SparkSession, d: str) -> DataFrame:
    """Bad words of the first transcript with no bad word of the second within 300 ms."""
    second = _bounds(_bad(_second(spark, d)), "ra", "rb").select("src", "ra", "rb")
    return intervals.not_touching(_bounds(_bad(views.words(spark, d)), "la", "lb", 300_000), second, "src", ["o"], BUCKET)


def _second_windows(spark: SparkSession, d: str) -> DataFrame:
    a, b = T.mute_bounds(F.col("start_us"), F.col("end_us"), F.col("w"))
    return _bad(_second(spark, d)).select("src", a.alias("a"), b.alias("b"))


def _islands(spark: SparkSession, d: str) -> DataFrame:
    padded = views.words(spark, d).select("src", F.greatest(F.lit(0).cast("long"), F.col("start_us") - 120_000).alias("a"), (F.col("end_us") + 120_000).alias("b"))
    return intervals.union(padded)


def _pieces(spark: SparkSession, d: str) -> DataFrame:
    return base.interval_subtract(spark, d)


def weighted_score_long(spark, d):
    config = spark.createDataFrame(CONFIG, "cfg string, feature string, weight double")
    z = series.robust_z(ranking.to_long(_features(spark, d), ["raw_db", "arousal", "n"]), "x", by=("src", "feature"))
    return ranking.weighted_scores(z, config).select("cfg", "src", "t", F.round("score", 4).alias("score"), "top")


def candidates_enriched(spark, d):
    found = ranking.with_band_max(base.nms_topn(spark, d), base._series(spark, d), "raw_db", 3)
    return ranking.with_reference(found, _refs(spark, d)).select("src", "rank", "t", "around", F.col("ref").cast("long").alias("ref"))


def recall_at_k(spark, d):
    return ranking.recall_at(base.nms_topn(spark, d), _refs(spark, d), [10, 20])


def marker_counts(spark, d):
    return views.samples(spark, d).groupBy("src", "t").agg(F.count("*").alias("words"), F.count_if(F.col("k") < 10).alias("markers"))


def vocab_except(spark, d):
    v = lambda role: views.table(spark, d, "conversations").filter(F.col("role") == role).select(F.explode(F.split("text", r"\s+")).alias("w")).select(T.norm_word(F.col("w")).alias("word")).filter("word <> ''").distinct()
    return v("user").subtract(v("assistant"))


def two_source_mutes(spark, d):
    """Windows of the second transcript, and of the bad words that only the first holds."""
    a, b = T.mute_bounds(F.col("start_us"), F.col("end_us"), F.col("w"))
    one = _second_windows(spark, d).withColumn("label", F.lit("1"))
    two = _first_only(spark, d).filter(F.col("end_us") - F.col("start_us") <= 1_200_000).select("src", a.alias("a"), b.alias("b"), F.lit("2").alias("label"))
    return intervals.union(one.unionByName(two), gap=200_000, label="label")


def coverage_gap(spark, d):
    """Bad words of the first transcript whose middle no window of the second covers."""
    mid = F.floor((F.col("start_us") + F.col("end_us")) / 2)
    words = _bad(views.words(spark, d)).select("src", "o", "w", mid.alias("la"), mid.alias("lb"))
    windows = _second_windows(spark, d).select("src", F.col("a").alias("ra"), F.col("b").alias("rb"))
    return intervals.not_touching(words, windows, "src", ["o"], BUCKET).select("src", "o", "w")


def lost_bad_anti(spark, d):
    """Bad words of the first transcript that the second doesn't hold at the same time."""
    ms = lambda x: F.floor((x + 500) / 1000)
    second = _second(spark, d).select("src", ms(F.col("start_us") - 20_000).alias("ms"), "w")
    return _bad(views.words(spark, d)).select("src", "o", "w", ms(F.col("start_us")).alias("ms")).join(second, ["src", "ms", "w"], "left_anti").select("src", "o", "w")


def time_tolerant_dedupe(spark, d):
    both = views.words(spark, d).unionByName(_second(spark, d)).withColumn("norm", T.norm_word(F.col("w")))
    return ranking.dedupe_in_time(both, "norm").select("src", "norm", "start_us", "o")


def caption_ends(spark, d):
    return schedule.caption_ends(sessions.caption_groups(views.words(spark, d))).select("src", "a", "b", "shown_to")


def rail_groups(spark, d):
    return schedule.rails(views.words(spark, d), ["la", "the"], ["de", "a"])


def gap_policy(spark, d):
    return schedule.gap_policy(_islands(spark, d))


def short_merge(spark, d):
    """Short pieces here: those of the subtraction below 1.2 s."""
    return schedule.merge_short(_pieces(spark, d), 1_200_000)


def segment_overlap(spark, d):
    w = _bounds(views.words(spark, d), "la", "lb").select("src", "o", "la", "lb")
    s = base._segments(spark, d).select("src", "id", F.col("a").alias("ra"), F.col("b").alias("rb"))
    return intervals.range_join(w, s, "src", BUCKET, (F.col("la") < F.col("rb")) & (F.col("lb") > F.col("ra"))).groupBy("src", "id").agg(F.count("*").alias("n"))


def words_off_mutes(spark, d):
    off = base._union(spark, d).select("src", F.col("a").alias("ra"), F.col("b").alias("rb"))
    left = intervals.not_touching(_bounds(views.words(spark, d), "la", "lb"), off, "src", ["o"], BUCKET, (F.col("la") < F.col("rb")) & (F.col("lb") > F.col("ra")))
    return left.groupBy("src").agg(F.count("*").alias("n"), F.sum("o").alias("sum_o"))


def time_remap(spark, d):
    points = views.words(spark, d).select("src", "o", F.col("start_us").alias("t"))
    return schedule.remap(points, base._segments(spark, d), ["o"]).select("src", "o", "t", "out")


def punch_map(spark, d):
    """Each bad word's start in every segment that holds it, in the segment's output time."""
    p = _bounds(_bad(views.words(spark, d)), "la", "le").select("src", "o", "la", F.col("la").alias("lb"))
    s = schedule.with_offsets(base._segments(spark, d)).select("src", "id", "off", F.col("a").alias("ra"), F.col("b").alias("rb"))
    return intervals.range_join(p, s, "src", BUCKET, F.col("la") < F.col("rb")).select("src", "o", "id", (F.col("off") + F.col("la") - F.col("ra")).alias("out"))


def nearest_interval(spark, d):
    points = views.words(spark, d).select("src", "o", F.col("start_us").alias("t"))
    return schedule.nearest(points, base._segments(spark, d), ["o"]).select("src", "o", "near_id", "dist", "snapped")


def zoom_envelope(spark, d):
    points = views.words(spark, d).select("src", "o", F.col("start_us").alias("t"))
    punches = _bad(views.words(spark, d)).select("src", (F.col("start_us") - 40_000).alias("t0"))
    return schedule.envelope(points, punches, ["o"]).select("src", "o", F.round("zoom", 4).alias("zoom"))


def lost_words_check(spark, d):
    """Words wholly inside a segment: how many are inside no piece that stays."""
    w = _bounds(views.words(spark, d), "la", "lb").select("src", "o", "la", "lb")
    inside = (F.col("la") >= F.col("ra")) & (F.col("lb") <= F.col("rb"))
    held = lambda keeps: intervals.range_join(w, keeps.select("src", F.col("a").alias("ra"), F.col("b").alias("rb")), "src", BUCKET, inside).select("src", "o").distinct()
    one, two = held(base._segments(spark, d)), held(_pieces(spark, d)).withColumn("kept", F.lit(1))
    return one.join(two, ["src", "o"], "left").groupBy("src").agg(F.count("*").alias("words"), F.count_if(F.col("kept").isNull()).alias("lost"))


def tighten_report(spark, d):
    return schedule.tighten_report(base._segments(spark, d), _pieces(spark, d))


def align_words(spark, d):
    """The transcripts of each segment put together; the timed text wins where it alone is bad."""
    with_norm = lambda w: w.withColumn("norm", T.norm_word(F.col("w")))
    keep = lambda norm: F.exists(F.array(*map(F.lit, base.BAD)), lambda x: F.contains(norm, x)) & ~F.exists(F.array(*map(F.lit, base.OK)), lambda x: F.contains(norm, x))
    both = align.align(with_norm(views.words(spark, d)), with_norm(_second(spark, d)), base._segments(spark, d), keep)
    return align.primary_if_bad(both, lambda w: T.is_bad(F.coalesce(w, F.lit("")), base.BAD, base.OK))


def proportional_split(spark, d):
    """The time of each run of ten words shared by letters."""
    run = F.floor(F.col("o") / 10)
    words = views.words(spark, d).withColumn("run", run)
    ends = words.groupBy("src", "run").agg(F.min("start_us").alias("block_a"), F.max("end_us").alias("block_b"))
    return align.proportional_split(words.join(ends, ["src", "run"]), ["src", "run"], F.length(T.norm_word(F.col("w")))).select("src", "o", "from_us", "to_us")


def _stream(spark: SparkSession, d: str) -> DataFrame:
    path = f"{d}/events.parquet"
    rows = spark.readStream.schema(spark.read.parquet(path).schema).parquet(f"{path}*")  # a stream reads files of a pattern
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


def watch_stream(spark, d):
    """Each user's events as checks of a channel: unknown at values of 20 to 40, live from 60."""
    live = F.when(F.col("value").between(20, 40), F.lit(None)).otherwise(F.col("value") >= 60)
    checks = _stream(spark, d).select(F.col("user_id").alias("channel"), "ts", F.col("event_id").alias("order"), live.alias("live"), (F.col("event_id") % 4 != 0).alias("active"))
    return watch.run_to_end(watch.watch(checks)).select("channel", F.unix_micros("ts").alias("us"), "action", "offline")


def loudness_stream(spark, d):
    samples = _stream(spark, d).select(F.col("event_type").alias("src"), "ts", F.col("value").alias("x"))
    return watch.whole_loudness(samples).select("src", F.floor(F.unix_micros("start") / views.HOUR_US).cast("long").alias("t"), "raw_db", "n")


def session_stream(spark, d):
    """Runs of each user's events without a pause of over six hours, as a stream gives them."""
    events = _stream(spark, d).select(F.col("user_id").alias("src"), "ts")
    found = watch.run_to_end(watch.sessions(events, 6 * views.HOUR_US))
    return found.select("src", F.unix_micros("a").alias("a"), F.unix_micros("b").alias("b"), "n")


QUERIES = {f.__name__: f for f in (weighted_score_long, candidates_enriched, recall_at_k, marker_counts, vocab_except, two_source_mutes, coverage_gap, lost_bad_anti, time_tolerant_dedupe, caption_ends, rail_groups, gap_policy, short_merge, segment_overlap, words_off_mutes, time_remap, punch_map, nearest_interval, zoom_envelope, lost_words_check, tighten_report, align_words, proportional_split, watch_stream, loudness_stream, session_stream)}

_W2 = base._W + r""",
w2 AS (SELECT src, o, CASE WHEN o % 7 = 0 THEN reverse(w) ELSE w END AS w, start_us + 20000 AS start_us, end_us + 20000 AS end_us FROM words WHERE o % 11 <> 0),
n2 AS (SELECT *, regexp_replace(replace(lower(w), 'ё', 'е'), '[^\p{L}\p{N}_]+', '', 'g') AS nrm FROM w2),
b2 AS (SELECT * FROM n2 WHERE nrm <> '' AND NOT contains(nrm, 'nn') AND (contains(nrm, 'tion') OR contains(nrm, 'eau'))),
b1 AS (SELECT * FROM fb WHERE bad),
m2 AS (SELECT src, greatest(CAST(floor(start_us + (end_us - start_us) * (m + 0.5) / n - half) AS BIGINT), start_us) AS a, least(CAST(floor(start_us + (end_us - start_us) * (m + 0.5) / n + half) AS BIGINT), end_us) AS b FROM (SELECT *, length(w) AS n, greatest(1, length(w) // 2) AS m, greatest((end_us - start_us) * 0.40::DOUBLE, 150000) / 2 AS half FROM b2))"""
_P = base._CLIP + """,
e AS (SELECT src, id, a AS x, b AS y FROM cl UNION ALL SELECT src, id, b, b FROM seg),
p0 AS (SELECT e.src, e.id, coalesce(lag(y) OVER (PARTITION BY e.src, e.id ORDER BY x, y), seg.a) AS a, x AS b FROM e JOIN seg ON e.src = seg.src AND e.id = seg.id),
pc AS (SELECT * FROM p0 WHERE b > a),
so AS (SELECT *, CAST(coalesce(sum(b - a) OVER (PARTITION BY src ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS off FROM seg)"""
_N = base.ORACLES["nms_topn"]
_NMS = _N[: _N.index(" SELECT u.src")] + """, nms AS (SELECT u.src, CAST(rank AS BIGINT) AS rank, u.t FROM u),
refs AS (SELECT src, generate_subscripts(g, 1) - 1 AS ord, unnest(g) AS a FROM (SELECT src, generate_series(min(t), max(t), 100) AS g FROM ser GROUP BY src)),
hit AS (SELECT refs.src, ord, t, rank FROM refs JOIN nms ON refs.src = nms.src AND t BETWEEN a - 5 AND a + 17)"""
_CAP = base.ORACLES["caption_groups"]
_RAIL = f"""WITH RECURSIVE {base._W}, iw AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY src, island ORDER BY start_us, o) AS i FROM isl),
f AS (SELECT src, island, i, 1 AS g, 1 AS n, start_us AS s0, w, start_us, end_us FROM iw WHERE i = 1
  UNION ALL SELECT f.src, f.island, x.i, CASE WHEN n >= 5 OR x.end_us - s0 > 2200000 THEN g + 1 ELSE g END, CASE WHEN n >= 5 OR x.end_us - s0 > 2200000 THEN 1 ELSE n + 1 END, CASE WHEN n >= 5 OR x.end_us - s0 > 2200000 THEN x.start_us ELSE s0 END, x.w, x.start_us, x.end_us FROM f JOIN iw x ON x.src = f.src AND x.island = f.island AND x.i = f.i + 1),
gr AS (SELECT src, island, g, min(start_us) AS a, max(end_us) AS b, count(*) AS n FROM f GROUP BY src, island, g),
nb AS (SELECT *, lag(b) OVER w AS pb, lead(a) OVER w AS na FROM gr WINDOW w AS (PARTITION BY src ORDER BY island, g)),
ok AS (SELECT * FROM nb WHERE n > 1 OR (coalesce(a - pb > 300000, true) AND coalesce(na - b > 300000, true))),
wd AS (SELECT f.*, ok.n AS size, row_number() OVER (PARTITION BY f.src, f.island, f.g ORDER BY f.i) AS k FROM f JOIN ok ON f.src = ok.src AND f.island = ok.island AND f.g = ok.g),
fl AS (SELECT src, island, g, min(start_us) AS a, max(end_us) AS b, max(start_us) AS last, count(*) AS n, string_agg(w, ' ' ORDER BY i) AS text FROM wd WHERE lower(trim(w)) NOT IN ('la', 'the') AND NOT (k = 1 AND size > 1 AND lower(trim(w)) IN ('de', 'a')) GROUP BY 1, 2, 3)
SELECT src, a, b, n, text, greatest(0, a - 80000) AS shown_from, greatest(least(b + 500000, coalesce(lead(a) OVER (PARTITION BY src ORDER BY island, g) - 80000, b + 500000)), last) AS shown_to FROM fl"""

ORACLES = {
    "weighted_score_long": f"""WITH {base._S}, m AS (SELECT src, t, round(avg(x), 4) AS arousal FROM s GROUP BY src, t),
ft AS (SELECT ser.src, ser.t, raw_db, arousal, CAST(coalesce(n, 0) AS DOUBLE) AS n FROM ser LEFT JOIN m ON ser.src = m.src AND ser.t = m.t),
lg AS (SELECT src, t, 'raw_db' AS feature, raw_db AS x FROM ft UNION ALL SELECT src, t, 'arousal', arousal FROM ft UNION ALL SELECT src, t, 'n', n FROM ft),
c AS (SELECT src, feature, median(x) AS m FROM lg GROUP BY ALL), dv AS (SELECT lg.*, m FROM lg JOIN c USING (src, feature)), md AS (SELECT src, feature, median(abs(x - m)) AS mad FROM dv GROUP BY ALL),
z AS (SELECT src, t, feature, CASE WHEN mad > 0 THEN greatest(-3.0, least(6.0, coalesce((x - m) / (1.4826 * mad), 0.0))) ELSE 0.0 END AS z FROM dv JOIN md USING (src, feature)),
cf AS (SELECT * FROM (VALUES ('loud', 'raw_db', 1.0::DOUBLE), ('mixed', 'raw_db', 0.5), ('mixed', 'arousal', 0.3), ('mixed', 'n', 0.2)) v(cfg, feature, weight)),
pt AS (SELECT cfg, src, t, feature, weight * z AS v FROM z JOIN cf USING (feature)),
rk AS (SELECT *, row_number() OVER (PARTITION BY cfg, src, t ORDER BY v DESC, feature) AS r FROM pt)
SELECT cfg, src, t, round(sum(v), 4) AS score, string_agg(feature, ',' ORDER BY r) FILTER (WHERE r <= 2) AS top FROM rk GROUP BY cfg, src, t""",
    "candidates_enriched": f"{_NMS} SELECT nms.src, rank, nms.t, (SELECT max(raw_db) FROM ser WHERE ser.src = nms.src AND ser.t BETWEEN nms.t - 3 AND nms.t + 3) AS around, CAST((SELECT min(ord) FROM hit WHERE hit.src = nms.src AND hit.t = nms.t) AS BIGINT) AS ref FROM nms",
    "recall_at_k": f"{_NMS}, h AS (SELECT src, ord, min(rank) AS first FROM hit GROUP BY 1, 2), a AS (SELECT refs.src, first, k FROM refs LEFT JOIN h USING (src, ord), (VALUES (10), (20)) v(k)) SELECT src, CAST(k AS BIGINT) AS k, count(*) AS refs, count(*) FILTER (WHERE first <= k) AS found FROM a GROUP BY GROUPING SETS ((src, k), (k))",
    "marker_counts": f"WITH {base._S} SELECT src, t, count(*) AS words, count(*) FILTER (WHERE k < 10) AS markers FROM s GROUP BY src, t",
    "vocab_except": base.ORACLES["vocab_intersect"].replace("INTERSECT", "EXCEPT"),
    "two_source_mutes": f"""WITH {_W2}, al AS (SELECT src, a, b, '1' AS label FROM m2 UNION ALL SELECT src, a, b, '2' FROM mw JOIN (SELECT src, o FROM b1 WHERE end_us - start_us <= 1200000 AND NOT EXISTS (SELECT 1 FROM b2 WHERE b2.src = b1.src AND b2.start_us <= b1.end_us + 300000 AND b2.end_us >= b1.start_us - 300000)) USING (src, o))
SELECT src, min(a) AS a, max(b) AS b, count(*) AS n, string_agg(DISTINCT label, '+' ORDER BY label) AS labels FROM (SELECT *, sum(new) OVER (PARTITION BY src ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS g FROM (SELECT *, CASE WHEN a <= max(b) OVER (PARTITION BY src ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 200000 THEN 0 ELSE 1 END AS new FROM al WHERE b > a)) GROUP BY src, g""",
    "coverage_gap": f"WITH {_W2} SELECT src, o, w FROM b1 WHERE NOT EXISTS (SELECT 1 FROM m2 WHERE m2.src = b1.src AND (b1.start_us + b1.end_us) // 2 BETWEEN m2.a AND m2.b)",
    "lost_bad_anti": f"WITH {_W2} SELECT src, o, w FROM b1 WHERE NOT EXISTS (SELECT 1 FROM w2 WHERE w2.src = b1.src AND w2.w = b1.w AND (w2.start_us - 20000 + 500) // 1000 = (b1.start_us + 500) // 1000)",
    "time_tolerant_dedupe": f"""WITH RECURSIVE {_W2}, al AS (SELECT src, nrm, start_us, end_us, o, w FROM nw UNION ALL SELECT src, nrm, start_us, end_us, o, w FROM n2),
r AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY src, nrm ORDER BY start_us, end_us, o) AS i FROM al),
f AS (SELECT src, nrm, i, start_us, o, start_us AS kept, true AS keep FROM r WHERE i = 1 UNION ALL SELECT r.src, r.nrm, r.i, r.start_us, r.o, CASE WHEN r.start_us - kept > 250000 THEN r.start_us ELSE kept END, r.start_us - kept > 250000 FROM f JOIN r ON r.src = f.src AND r.nrm = f.nrm AND r.i = f.i + 1)
SELECT src, nrm AS norm, start_us, o FROM f WHERE keep""",
    "caption_ends": f"SELECT src, a, b, greatest(b, least(b + 150000, coalesce(lead(a) OVER (PARTITION BY src ORDER BY a, b), b + 150000))) AS shown_to FROM ({_CAP})",
    "rail_groups": _RAIL,
    "gap_policy": f"""WITH {base._W}, pd AS (SELECT src, greatest(0, start_us - 120000) AS a, end_us + 120000 AS b FROM words),
il AS (SELECT src, min(a) AS a, max(b) AS b FROM (SELECT *, sum(new) OVER (PARTITION BY src ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS g FROM (SELECT *, CASE WHEN a <= max(b) OVER (PARTITION BY src ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS new FROM pd)) GROUP BY src, g),
gp AS (SELECT src, g, min(a) AS a, max(b) AS b, count(*) AS n FROM (SELECT *, sum(new) OVER (PARTITION BY src ORDER BY a ROWS UNBOUNDED PRECEDING) AS g FROM (SELECT *, CASE WHEN a - lag(b) OVER (PARTITION BY src ORDER BY a) > 450000 THEN 1 ELSE 0 END AS new FROM il)) GROUP BY src, g)
SELECT src, CASE WHEN g > 0 THEN a - 125000 ELSE a END AS a, CASE WHEN lead(a) OVER (PARTITION BY src ORDER BY g) IS NULL THEN b ELSE b + 125000 END AS b, n FROM gp""",
    "short_merge": f"""WITH RECURSIVE {_P}, r AS MATERIALIZED (SELECT src, a, b, row_number() OVER (PARTITION BY src ORDER BY a, b) AS i FROM pc),
f AS (SELECT src, i, 1 AS k, a AS ca, b AS cb FROM r WHERE i = 1 UNION ALL SELECT r.src, r.i, CASE WHEN (k = 1 AND cb - ca < 1200000) OR r.b - r.a < 1200000 THEN k ELSE k + 1 END, CASE WHEN (k = 1 AND cb - ca < 1200000) OR r.b - r.a < 1200000 THEN ca ELSE r.a END, r.b FROM f JOIN r ON r.src = f.src AND r.i = f.i + 1)
SELECT src, min(ca) AS a, max(cb) AS b FROM f GROUP BY src, k""",
    "segment_overlap": f"WITH {base._W} SELECT words.src, id, count(*) AS n FROM words JOIN seg ON words.src = seg.src AND start_us < b AND end_us > a GROUP BY 1, 2",
    "words_off_mutes": f"WITH {base._W} SELECT src, count(*) AS n, CAST(sum(o) AS BIGINT) AS sum_o FROM words WHERE NOT EXISTS (SELECT 1 FROM un WHERE un.src = words.src AND start_us < b AND end_us > a) GROUP BY src",
    "time_remap": f"WITH {_P} SELECT w.src, w.o, start_us AS t, min_by(off + start_us - a, id) AS out FROM words w LEFT JOIN so ON w.src = so.src AND start_us BETWEEN a AND b GROUP BY 1, 2, 3",
    "punch_map": f"WITH {_P} SELECT fb.src, o, id, off + start_us - a AS out FROM fb JOIN so ON fb.src = so.src AND start_us >= a AND start_us < b WHERE bad",
    "nearest_interval": f"WITH {base._W}, ds AS (SELECT w.src, o, start_us AS t, id, a, b, CASE WHEN start_us < a THEN a - start_us WHEN start_us >= b THEN start_us - b + 1000 ELSE 0 END AS dist FROM words w JOIN seg ON w.src = seg.src) SELECT src, o, id AS near_id, dist, CASE WHEN t < a THEN a WHEN t >= b THEN b - 1000 ELSE t END AS snapped FROM ds QUALIFY row_number() OVER (PARTITION BY src, o ORDER BY dist, id) = 1",
    "zoom_envelope": f"WITH {base._W}, pn AS (SELECT src, start_us - 40000 AS t0 FROM fb WHERE bad) SELECT w.src, w.o, round(coalesce(1 + max(CASE WHEN t0 IS NOT NULL THEN greatest(least((start_us - t0) / 70000, (t0 + 1000000 - start_us) / 250000, 1.0), 0.0) * 0.3::DOUBLE END), 1.0), 4) AS zoom FROM words w LEFT JOIN pn ON w.src = pn.src AND start_us BETWEEN t0 AND t0 + 1000000 GROUP BY 1, 2",
    "lost_words_check": f"WITH {_P}, i AS (SELECT DISTINCT w.src, o, start_us, end_us FROM words w JOIN seg ON w.src = seg.src AND start_us >= a AND end_us <= b) SELECT src, count(*) AS words, count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM pc WHERE pc.src = i.src AND i.start_us >= pc.a AND i.end_us <= pc.b)) AS lost FROM i GROUP BY src",
    "proportional_split": f"WITH {base._W}, e AS (SELECT src, o // 10 AS run, min(start_us) AS a, max(end_us) AS b, sum(length(nrm)) AS s FROM nw GROUP BY 1, 2), x AS (SELECT nw.src, o, run, a, b, CASE WHEN s > 0 THEN length(nrm) ELSE 1 END AS x FROM nw JOIN e ON nw.src = e.src AND o // 10 = run), y AS (SELECT *, sum(x) OVER (PARTITION BY src, run) AS total, sum(x) OVER (PARTITION BY src, run ORDER BY o) AS upto FROM x) SELECT src, o, a + CAST(floor((b - a) * (upto - x) / total) AS BIGINT) AS from_us, a + CAST(floor((b - a) * upto / total) AS BIGINT) AS to_us FROM y",
    # windows and sessions that the watermark, so far behind the last event, has passed
    "loudness_stream": f"WITH {base._S} SELECT src, t, raw_db, n FROM rms",
    "session_stream": "WITH e AS (SELECT user_id AS src, epoch_us(ts) AS us FROM events), g AS (SELECT *, sum(new) OVER (PARTITION BY src ORDER BY us ROWS UNBOUNDED PRECEDING) AS g FROM (SELECT *, CASE WHEN us - lag(us) OVER (PARTITION BY src ORDER BY us) <= 21600000000 THEN 0 ELSE 1 END AS new FROM e)), s AS (SELECT src, min(us) AS a, max(us) AS b, count(*) AS n FROM g GROUP BY src, g.g) SELECT * FROM s WHERE b + 21600000000 <= (SELECT max(us) // 1000 * 1000 - 3600000000 FROM e)",
    "watch_stream": """WITH RECURSIVE c AS MATERIALIZED (SELECT user_id AS channel, epoch_us(ts) AS us, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i, CASE WHEN value BETWEEN 20 AND 40 THEN NULL ELSE value >= 60 END AS live, event_id % 4 <> 0 AS active FROM events),
f AS (SELECT channel, CAST(0 AS BIGINT) AS i, CAST(NULL AS BIGINT) AS us, '' AS action, false AS rec, CAST(NULL AS VARCHAR) AS who, CAST(0 AS BIGINT) AS offline FROM (SELECT DISTINCT channel FROM c)
UNION ALL SELECT channel, i, us, action,
  CASE action WHEN 'start' THEN true WHEN 'gone' THEN false WHEN 'stop' THEN false ELSE rec END,
  CASE action WHEN 'start' THEN 'auto' WHEN 'gone' THEN NULL WHEN 'stop' THEN NULL ELSE who END,
  CASE action WHEN 'unknown' THEN offline WHEN 'wait' THEN offline + 1 ELSE 0 END
FROM (SELECT f.channel, c.i, c.us, rec, who, offline, CASE WHEN live IS NULL THEN 'unknown' WHEN live AND active THEN 'recording' WHEN live THEN 'start' WHEN NOT active AND rec THEN 'gone' WHEN NOT active THEN 'idle' WHEN who IS DISTINCT FROM 'auto' THEN 'manual' WHEN offline + 1 >= 3 THEN 'stop' ELSE 'wait' END AS action
  FROM f JOIN c ON c.channel = f.channel AND c.i = f.i + 1))
SELECT channel, us, action, offline FROM f WHERE i > 0""",
    "tighten_report": f"WITH {_P}, al AS (SELECT src, b - a AS x, 0 AS y, 0 AS p FROM seg UNION ALL SELECT src, 0, b - a, 1 FROM pc) SELECT src, CAST(sum(x) AS BIGINT) AS before_us, CAST(sum(y) AS BIGINT) AS after_us, CAST(sum(p) AS BIGINT) AS pieces, CASE WHEN sum(x) <> 0 THEN round(100 * (1 - sum(y) / sum(x)), 4) ELSE 0.0 END AS cut_pct FROM al GROUP BY ROLLUP (src)",
}
