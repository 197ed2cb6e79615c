"""Registered queries of selection, suppression, the interval index and reports at the engine's own limits, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.functions import text as T
from tempora.operators import intervals, ranking, selection, series
from tempora.plans import queries as base
from tempora.plans import reports, schedules
from tempora.sources import catalog, files, views

#: What a second without a voice knows nothing of.
MASKED = ["arousal", "dominance", "valence", "emo_angry", "emo_sad", "emo_neutral", "emo_positive", "laugh", "scream"]


def value_medians(spark, d):
    """Median and median deviation of all values of each type, on keys that hold most of the rows."""
    rows = views.samples(spark, d).select("src", "x")
    centre = selection.median(rows, ["src"], "x", "m")
    away = rows.join(centre, "src").withColumn("dev", F.abs(F.col("x") - F.col("m")))
    return centre.join(selection.median(away, ["src"], "dev", "mad"), "src").select("src", F.round("m", 6).alias("m"), F.round("mad", 6).alias("mad"))


def suppressed_peaks(spark, d):
    """The whole greedy choice of peaks at least 45 hours apart, not only the first."""
    peaks = series.local_maxima(base._scored(spark, d), "score", place="t")
    return series.suppress(peaks, "score").select("src", "t", F.round("score", 4).alias("score"))


def active_spans(spark, d):
    """For each event, how many users' times from first to last event of the type hold it."""
    events = views.samples(spark, d).select("src", "us", "user_id")
    spans = events.groupBy("src", "user_id").agg(F.min("us").alias("a"), F.max("us").alias("b"))
    return intervals.stabbings(events.select("src", F.col("us").alias("t")), spans).select("src", F.col("t").alias("us"), F.col("n").alias("events"), F.col("on").alias("active"))


def _voiced(spark: SparkSession, d: str) -> DataFrame:
    """The dense grid with all masked features: shares and means of an hour's values."""
    x, k = F.col("x"), F.col("k")
    own = {"arousal": F.avg("x"), "dominance": F.max("x"), "valence": F.min("x"), "emo_angry": F.avg((x < 10).cast("double")), "emo_sad": F.avg((x < 20).cast("double")), "emo_neutral": F.avg((k < 50).cast("double")), "emo_positive": F.avg(x.between(20, 60).cast("double")), "laugh": F.avg((x > 100).cast("double")), "scream": F.avg((x > 150).cast("double"))}
    voice = F.round(series.rms_db(F.when(F.col("user_id") % 2 == 0, x)), 4)
    hours = views.samples(spark, d).groupBy("src", "t").agg(voice.alias("voice_db"), *(F.round(c, 4).alias(n) for n, c in own.items()), F.count_if(k < 10).alias("markers"))
    grid = base._series(spark, d).withColumnRenamed("n", "words")
    return grid.join(hours, ["src", "t"], "left").select("src", "t", "raw_db", "voice_db", *MASKED, F.coalesce("words", F.lit(0)).alias("words"), F.coalesce("markers", F.lit(0)).alias("markers"))


def masked_features(spark, d):
    """All nine features of the voice, null where it is not over its level or unknown; the others as they are."""
    return series.voice_masked(_voiced(spark, d), MASKED, level=35.0)


def doubtful_long(spark, d):
    """Bad words of the first transcript alone, its words five times as long: over 1.2 s they are reported, others muted."""
    stretched = views.words(spark, d).withColumn("end_us", F.col("start_us") + 5 * (F.col("end_us") - F.col("start_us")))
    second = schedules._bounds(schedules._bad(schedules._second(spark, d)), "ra", "rb").select("src", "ra", "rb")
    alone = intervals.not_touching(schedules._bounds(schedules._bad(stretched), "la", "lb", 300_000), second, "src", ["o"], schedules.BUCKET)
    length = F.col("end_us") - F.col("start_us")
    return alone.select("src", "o", "w", length.alias("length_us"), (length > 1_200_000).alias("doubtful"))


def stream_spans(spark, d):
    """First in order, least and last time of each stream; events stand for packets, and come out of order."""
    packets = views.table(spark, d, "events").select(F.col("event_type").alias("stream"), F.col("value").alias("pts"), (F.col("user_id") % 7 / 10).alias("dur"), F.col("event_id").alias("ord"))
    return files.stream_spans(packets).select("stream", F.round("first", 4).alias("first"), F.round("least", 4).alias("least"), F.round("last", 4).alias("last"))


def overlay_gaps(spark, d):
    """Where neither a line of words nor a hero's window is on for more than 0.6 s."""
    lines = schedules.rail_groups(spark, d).select("src", F.col("shown_from").alias("a"), (F.col("shown_to") + 150_000).alias("b"))
    heroes = base._flagged(spark, d).filter("bad").select("src", (F.col("start_us") - 200_000).alias("a"), (F.col("start_us") + 1_000_000).alias("b"))
    total = views.words(spark, d).groupBy("src").agg(F.max("end_us").alias("total"))
    busy = lines.unionByName(heroes).join(total, "src").filter("a < total").drop("total")
    return intervals.complement(intervals.union(busy), total, least=600_000)


def escaped_texts(spark, d):
    """Turns of conversations as HTML, their second word as a sign of its own."""
    words = F.concat(F.lit("<b>"), F.col("text"), F.lit("</b> & \""))
    return views.table(spark, d, "conversations").select("conv_id", "turn", T.html(words).alias("html"))


def norm_keys(spark, d):
    return views.words(spark, d).groupBy(T.norm_key(F.col("w")).alias("key")).agg(F.count("*").alias("n"))


def reference_table(spark, d):
    """Reference intervals from a table of keys, numbers and clock times; a key's first part is the source."""
    clock = lambda us: T.clock(F.floor(us / 1_000_000) % 86400)
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    rows = views.table(spark, d, "events").filter("user_id < 20").select(
        F.when(F.col("event_id") % 2 == 0, F.concat_ws("/", "event_type", F.col("user_id").cast("string"))).otherwise(F.col("event_type")).alias("key"),
        F.col("event_id").cast("int").alias("num"), clock(us).alias("start"), clock(us + 12_000_000).alias("end"), F.col("props").alias("name"),
    )
    return catalog.references(rows)


def recall_of_table(spark, d):
    """How many references of a table the first 10 or 20 peaks hit."""
    refs = schedules._refs(spark, d).select("src", "ord", "a", "b")
    table = catalog.references(refs.select(F.concat(F.col("src").cast("string"), F.lit("/refs")).alias("key"), F.col("ord").cast("int").alias("num"), (F.col("a") - F.lit(473_000)).alias("_a"), (F.col("b") - F.lit(473_000)).alias("_b")).select("key", "num", T.clock(F.col("_a")).alias("start"), T.clock(F.col("_b")).alias("end"), F.lit("").alias("name")))
    found = table.select("src", F.col("num").alias("ord"), (F.col("start") + 473_000).alias("a"), (F.col("end") + 473_000).alias("b"))
    return ranking.recall_at(base.nms_topn(spark, d), found, [10, 20])


QUERIES = {f.__name__: f for f in (value_medians, suppressed_peaks, active_spans, masked_features, doubtful_long, stream_spans, overlay_gaps, escaped_texts, norm_keys, reference_table, recall_of_table)}

_PEAKS = base.ORACLES["nms_topn"]
_FEATURES = """f AS (SELECT src, t, round(20 * log10(greatest(sqrt(avg(x * x) FILTER (WHERE user_id % 2 = 0)), 1e-10)), 4) AS voice_db, round(avg(x), 4) AS arousal, round(max(x), 4) AS dominance, round(min(x), 4) AS valence,
 round(avg(CASE WHEN x < 10 THEN 1.0 ELSE 0.0 END), 4) AS emo_angry, round(avg(CASE WHEN x < 20 THEN 1.0 ELSE 0.0 END), 4) AS emo_sad, round(avg(CASE WHEN k < 50 THEN 1.0 WHEN k >= 50 THEN 0.0 END), 4) AS emo_neutral, round(avg(CASE WHEN x BETWEEN 20 AND 60 THEN 1.0 ELSE 0.0 END), 4) AS emo_positive,
 round(avg(CASE WHEN x > 100 THEN 1.0 ELSE 0.0 END), 4) AS laugh, round(avg(CASE WHEN x > 150 THEN 1.0 ELSE 0.0 END), 4) AS scream, count(*) FILTER (WHERE k < 10) AS markers FROM s GROUP BY src, t)"""
ORACLES = {
    "value_medians": "WITH c AS (SELECT event_type AS src, median(value) AS m FROM events GROUP BY 1), d AS (SELECT src, m, median(abs(value - m)) AS mad FROM events JOIN c ON event_type = src GROUP BY src, m) SELECT src, round(m, 6) AS m, round(mad, 6) AS mad FROM d",
    "suppressed_peaks": _PEAKS.replace("len(kept) < 20 AND ", "").replace("SELECT u.src, CAST(rank AS BIGINT) AS rank, u.t, round(score, 4)", "SELECT u.src, u.t, round(score, 4)"),
    "active_spans": "WITH e AS (SELECT event_type AS src, epoch_us(ts) AS us, count(*) AS events FROM events GROUP BY 1, 2), p AS (SELECT event_type AS src, user_id, min(epoch_us(ts)) AS a, max(epoch_us(ts)) AS b FROM events GROUP BY 1, 2) SELECT e.src, us, any_value(events) AS events, count(*) AS active FROM e JOIN p ON e.src = p.src AND us BETWEEN a AND b GROUP BY 1, 2",
    "masked_features": f"WITH {base._S}, {_FEATURES} SELECT ser.src, ser.t, raw_db, voice_db, " + ", ".join(f"CASE WHEN voice_db > 35 THEN {c} END AS {c}" for c in MASKED) + ", coalesce(n, 0) AS words, coalesce(markers, 0) AS markers FROM ser LEFT JOIN f ON ser.src = f.src AND ser.t = f.t",
    "doubtful_long": f"WITH {schedules._W2}, lg AS (SELECT src, o, w, start_us, start_us + 5 * (end_us - start_us) AS end_us FROM b1) SELECT src, o, w, end_us - start_us AS length_us, end_us - start_us > 1200000 AS doubtful FROM lg WHERE NOT EXISTS (SELECT 1 FROM b2 WHERE b2.src = lg.src AND b2.start_us <= lg.end_us + 300000 AND b2.end_us >= lg.start_us - 300000)",
    "stream_spans": "SELECT event_type AS stream, round(arg_min(value, event_id), 4) AS first, round(min(value), 4) AS least, round(max(value + user_id % 7 / 10.0), 4) AS last FROM events GROUP BY 1",
    "overlay_gaps": f"""{schedules._RAIL.replace("SELECT src, a, b, n, text, greatest(0", ", rl AS (SELECT src, a, b, n, text, greatest(0", 1)}),
bz AS (SELECT src, shown_from AS a, shown_to + 150000 AS b FROM rl UNION ALL SELECT src, start_us - 200000, start_us + 1000000 FROM fb WHERE bad),
tt AS (SELECT src, max(end_us) AS total FROM words GROUP BY src), lv AS (SELECT bz.src, a, b FROM bz JOIN tt ON bz.src = tt.src WHERE a < total AND b > a),
mg AS (SELECT src, min(a) AS a, max(b) AS b FROM (SELECT *, sum(new) OVER (PARTITION BY src ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS g FROM (SELECT *, CASE WHEN a <= max(b) OVER (PARTITION BY src ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS new FROM lv)) GROUP BY src, g),
eg AS (SELECT src, a, b FROM mg UNION ALL SELECT src, total, total FROM tt), gp AS (SELECT src, coalesce(lag(b) OVER (PARTITION BY src ORDER BY a, b), 0) AS a, a AS b FROM eg) SELECT * FROM gp WHERE b - a > 600000""",
    "escaped_texts": "SELECT conv_id, turn, replace(replace(replace('<b>' || text || '</b> & \"', '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS html FROM conversations",
    "norm_keys": f"WITH {base._W} SELECT regexp_replace(replace(lower(w), 'ё', 'е'), '[^0-9a-zа-я]', '', 'g') AS key, count(*) AS n FROM words GROUP BY 1",
    "reference_table": "WITH e AS (SELECT *, (epoch_us(ts) // 1000000) % 86400 AS s, ((epoch_us(ts) + 12000000) // 1000000) % 86400 AS z FROM events WHERE user_id < 20) SELECT event_type AS src, CASE WHEN event_id % 2 = 0 THEN event_type || '/' || user_id ELSE '' END AS folder, CAST(event_id AS INT) AS num, props AS name, CAST(s AS BIGINT) AS start, CAST(z AS BIGINT) AS end FROM e",
    "recall_of_table": schedules.ORACLES["recall_at_k"],
}
