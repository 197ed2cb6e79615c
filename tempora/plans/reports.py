"""Registered queries of mute rules and reports, edit lists, subtitles, presets and scalar rules, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tempora.functions import text as T
from tempora.operators import audio, intervals, mutes, ranking, schedule, series, sessions
from tempora.plans import queries as base
from tempora.plans import schedules
from tempora.sources import views

WHOLE = ["tionin", "tionth"]
MARKERS = ["the", "la", "die"]
CREDIT, NAMED, BARE, FAREWELL = ["of the"], r"(?i:the|der)\s+[A-Z]\w*,", ["que la"], ["and the", "und die"]


def _merged(spark: SparkSession, d: str) -> DataFrame:
    """src, o, w (second transcript), giga (first), start_us, end_us of the words that both have."""
    second = schedules._second(spark, d).select("src", "o", "w")
    return views.words(spark, d).withColumnRenamed("w", "giga").join(second, ["src", "o"])


def _windows(spark: SparkSession, d: str, rule: str = "letter") -> DataFrame:
    return mutes.windows(_merged(spark, d), base.BAD, base.OK, WHOLE, rule)


def _edits(spark: SparkSession, d: str) -> DataFrame:
    """Segments with the speed 1, 1.25 or 2."""
    return base._segments(spark, d).withColumn("speed", F.element_at(F.array(F.lit(1.0), F.lit(1.25), F.lit(2.0)), ((F.col("src") + F.col("id")) % 3 + 1).cast("int")))


def _seconds(spark: SparkSession, d: str) -> DataFrame:
    """src, t, voice_db, laugh, scream of the seconds in which words begin."""
    w = views.words(spark, d).withColumn("bad", T.is_bad(F.col("w"), base.BAD, base.OK))
    return w.groupBy("src", F.floor(F.col("start_us") / 1_000_000).alias("t")).agg((F.count("*") * 8 - 50.0).alias("voice_db"), F.avg((F.length("w") > 9).cast("double")).alias("laugh"), F.avg(F.col("bad").cast("double")).alias("scream"))


def _segment_words(spark: SparkSession, d: str) -> DataFrame:
    """Words wholly inside a segment, with source and segment as one key (src)."""
    w = views.words(spark, d).select("src", "o", "w", F.col("start_us").alias("la"), F.col("end_us").alias("lb"))
    s = base._segments(spark, d).select("src", "id", F.col("a").alias("ra"), F.col("b").alias("rb"))
    met = intervals.range_join(w, s, "src", 10_000_000, (F.col("la") >= F.col("ra")) & (F.col("lb") <= F.col("rb")))
    return met.select((F.col("src") * 1000 + F.col("id")).alias("src"), "o", "w", F.col("la").alias("start_us"), F.col("lb").alias("end_us"))


def _features(spark: SparkSession, d: str) -> DataFrame:
    """The dense grid with all features of the presets; those of the voice only where it is loud enough."""
    share = lambda c: F.round(F.avg(c.cast("double")), 4)
    x = F.col("x")
    own = views.samples(spark, d).groupBy("src", "t").agg(F.round(series.rms_db(F.when(F.col("user_id") % 2 == 0, x)), 4).alias("voice_db"), F.round(F.avg("x"), 4).alias("arousal"), share(x > 100).alias("laugh"), share(x > 150).alias("scream"), share(x.between(20, 60)).alias("emo_positive"), share(x < 10).alias("emo_angry"), F.count_if(F.col("k") < 10).alias("markers"))
    voiced = lambda c: F.when(F.col("voice_db") > 35, F.col(c)).alias(c)
    return base._series(spark, d).join(own, ["src", "t"], "left").select("src", "t", "raw_db", "voice_db", *map(voiced, ("arousal", "laugh", "scream", "emo_positive", "emo_angry")), F.coalesce("markers", F.lit(0)).alias("markers"))


def _presets(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(ranking.preset_rows(), "cfg string, feature string, weight double")


def _contributions(spark: SparkSession, d: str) -> DataFrame:
    z = series.robust_z(ranking.to_long(_features(spark, d), ["raw_db", "voice_db", "arousal", "laugh", "scream", "emo_positive", "emo_angry", "markers"]), "x", by=("src", "feature"))
    return ranking.contributions(z, _presets(spark))


def first_bad_text(spark, d):
    m = _merged(spark, d)
    return m.select("src", "o", mutes.first_bad(m, base.BAD, base.OK).alias("word")).filter("word is not null")


def mute_rules(spark, d):
    both = [_windows(spark, d, rule).withColumn("rule", F.lit(rule)) for rule in ("letter", "clip")]
    return both[0].unionByName(both[1])


def mute_union_kinds(spark, d):
    return mutes.merged(_windows(spark, d))


def _two_sources(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    a, b = T.mute_bounds(F.col("start_us"), F.col("end_us"), F.col("w"))
    one = schedules._second_windows(spark, d).filter("b > a")
    two = schedules._first_only(spark, d).select("src", a.alias("a"), b.alias("b")).filter("b > a")
    return intervals.union(one.unionByName(two), gap=200_000), one, two


def window_sources(spark, d):
    return mutes.with_sources(*_two_sources(spark, d)).select("src", "a", "b", "source")


def source_counts(spark, d):
    found = window_sources(spark, d)
    return found.groupBy("src").agg(*(F.count_if(F.col("source") == s).alias(n) for s, n in (("1", "first"), ("2", "second"), ("1+2", "both"))))


def range_report(spark, d):
    text = spark.range(1).select(F.explode(T.parse_ranges(F.lit("3-9, 20-31.5, 70.25-90"))).alias("r"))
    ranges = text.select((F.col("r.a") * 1_000_000).cast("long").alias("ra"), (F.col("r.b") * 1_000_000).cast("long").alias("rb"))
    return mutes.in_ranges(base._union(spark, d), ranges)


def doubtful_words(spark, d):
    """Bad words of the first transcript alone: over 300 ms they are reported instead of muted."""
    length = F.col("end_us") - F.col("start_us")
    return schedules._first_only(spark, d).select("src", "o", "w", length.alias("length_us"), (length > 300_000).alias("doubtful"))


def free_starts(spark, d):
    w = views.words(spark, d)
    twice = w.select("src", "o", "w", "start_us", "end_us", F.lit(0).alias("copy")).unionByName(w.filter("o % 5 = 0").select("src", "o", "w", "start_us", "end_us", F.lit(1).alias("copy")))
    return mutes.free_starts(twice, ["w"], ["o", "copy"]).select("src", "o", "copy", "free_us")


def report_rows(spark, d):
    w = mutes.merged(_windows(spark, d)).select("src", "a", "b", "kind")
    return mutes.first_and_whole(w)


def seeded_sample(spark, d):
    return mutes.sample(base._union(spark, d).select("src", "a", "b"), ["src", "a"])


def mute_stats_by_kind(spark, d):
    size = F.col("b") - F.col("a")
    return _windows(spark, d).groupBy("kind").agg(F.count("*").alias("n"), F.min(size).alias("least"), F.max(size).alias("most"), F.round(F.avg(size), 3).alias("mean"))


def first_match_lookup(spark, d):
    return mutes.first_match(_windows(spark, d).select("src", "word").distinct(), _merged(spark, d))


def edit_violations(spark, d):
    k = F.col("src") + F.col("id")
    crop = F.struct((F.col("src") * 37 % 1500).alias("x"), (F.col("src") * 11 % 600).alias("y"), (400 + F.col("id") % 3 * 200).alias("w"), F.when(k % 13 == 0, 0).otherwise(500).alias("h"))
    edits = base._segments(spark, d).select("src", "id", "a", F.when(k % 11 == 0, F.col("a")).otherwise(F.col("b")).alias("b"), (0.5 + (F.col("src") * 7 + F.col("id")) % 9 * 0.25).alias("speed"), F.when(k % 4 == 0, 1.0).alias("broll"), F.element_at(F.array(F.lit("cam"), F.lit("game"), F.lit("face")), (k % 3 + 1).cast("int")).alias("focus"), F.when(k % 2 == 0, crop).alias("crop"))
    return schedule.violations(edits)


def speed_offsets(spark, d):
    return schedule.with_offsets(_edits(spark, d), speed="speed").select("src", "id", "speed", "off")


def words_output_time(spark, d):
    points = views.words(spark, d).select("src", "o", F.col("start_us").alias("t"))
    return schedule.to_output(points, _edits(spark, d), ["o"])


def output_duration(spark, d):
    """Length of all segments at their speed, with an intro of 2.5 s."""
    return _edits(spark, d).groupBy("src").agg((F.sum(F.bround((F.col("b") - F.col("a")) / F.col("speed")).cast("long")) + 2_500_000).alias("out_us"))


def caption_ends_segment(spark, d):
    groups = sessions.caption_groups(_segment_words(spark, d)).withColumn("seg_b", F.col("src") % 1000 * 30_000_000 + 20_000_000)
    return schedule.caption_ends(groups, limit="seg_b").select("src", "a", "b", "shown_to")


def rail_segments(spark, d):
    return schedule.rails(_segment_words(spark, d), ["la", "the"], ["de", "a"])


def subtitle_events(spark, d):
    words = views.words(spark, d)
    ends = schedule.caption_ends(sessions.caption_groups(words))
    shown = F.when(T.is_bad(F.col("w"), base.BAD, base.OK), T.censor(F.col("w"))).otherwise(F.col("w"))
    stamp = lambda c: T.clock_hundredths(F.col(c) / 1_000_000)
    return sessions.subtitle_events(sessions.caption_words(words), ends).select("src", "o", stamp("start_us").alias("shown_from"), stamp("event_end").alias("shown_to"), shown.alias("text"))


def every_fifth_word(spark, d):
    k = F.row_number().over(Window.partitionBy("src").orderBy("start_us", "o")) - 1
    return views.words(spark, d).withColumn("k", k).filter("k % 5 = 0").select("src", "o", F.col("k").cast("long").alias("k"))


def alternate_segments(spark, d):
    k = F.row_number().over(Window.partitionBy("src").orderBy("id")) - 1
    return base._segments(spark, d).select("src", "id", F.when(k % 2 == 0, "near").otherwise("wide").alias("view"))


def drop_and_emph(spark, d):
    w = views.words(spark, d)
    drops = w.filter("o % 13 = 0").select("src", (F.col("start_us") + 30_000).alias("t"))
    emph = w.filter("o % 6 = 0").select("src", (F.col("start_us") + F.when(F.col("o") % 4 == 0, 50_000).otherwise(60_000)).alias("t"))
    left = schedule.near_times(w, drops, ["o"], "gone").filter("not gone")
    return schedule.near_times(left, emph, ["o"], "emph").select("src", "o", "emph")


def _heroes(spark: SparkSession, d: str) -> DataFrame:
    """A window from 5 s before to 7 s after the start of each segment, of source time; those of odd ids begin inside."""
    at = F.when(F.col("id") % 2 == 0, -5_000_000).otherwise(5_000_000)
    e = _edits(spark, d)
    return schedule.hero_windows(e.select("src", "id", (F.col("a") + at).alias("from_us"), (F.col("a") + 7_000_000).alias("to_us")), e)


def hero_windows(spark, d):
    return _heroes(spark, d)


def groups_off_heroes(spark, d):
    """Captions that no hero window overlaps, both in source time here; a shared end is no overlap."""
    groups = sessions.caption_groups(views.words(spark, d)).select("src", "n", F.col("a").alias("la"), F.col("b").alias("lb"))
    heroes = _heroes(spark, d).select("src", F.col("a").alias("ra"), F.col("b").alias("rb"))
    left = intervals.not_touching(groups, heroes, "src", ["la", "lb"], 10_000_000, (F.col("la") < F.col("rb")) & (F.col("lb") > F.col("ra")))
    return left.select("src", F.col("la").alias("a"), F.col("lb").alias("b"), "n")


def containment_check(spark, d):
    """Words, those inside no segment (straddlers or outside), and of the others those inside no piece that stays."""
    w = schedules._bounds(views.words(spark, d), "la", "lb").select("src", "o", "la", "lb")
    inside = (F.col("la") >= F.col("ra")) & (F.col("lb") <= F.col("rb"))
    held = lambda keeps, flag: intervals.range_join(w, keeps.select("src", F.col("a").alias("ra"), F.col("b").alias("rb")), "src", 10_000_000, inside).select("src", "o").distinct().withColumn(flag, F.lit(True))
    both = w.join(held(base._segments(spark, d), "s"), ["src", "o"], "left").join(held(schedules._pieces(spark, d), "p"), ["src", "o"], "left")
    return both.groupBy("src").agg(F.count("*").alias("words"), F.count_if(F.col("s").isNull()).alias("straddle"), F.count_if(F.col("s").isNotNull() & F.col("p").isNull()).alias("lost"))


def asof_inclusive(spark, d):
    """Each event with the greatest value of its user at the last time at or before 1 ms after it."""
    e = views.table(spark, d, "events").select("event_id", "user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"), F.col("value").alias("x"))
    prices = e.groupBy("user_id", "us").agg(F.max("x").alias("x"))
    return intervals.as_of(e.select("event_id", "user_id", (F.col("us") + 1000).alias("us")), prices, "user_id", "us", ["x"]).select("event_id", "x")


def loudest_and_quietest(spark, d):
    """The hour of the greatest and the hour of the smallest mean value of each source, the first of equals."""
    mean = views.samples(spark, d).groupBy("src", "t").agg(F.round(F.avg(F.abs("x")), 4).alias("m"))
    return mean.groupBy("src").agg(F.max_by("t", F.struct("m", -F.col("t"))).alias("loudest"), F.min_by("t", F.struct("m", "t")).alias("quietest"))


def half_window_loudness(spark, d):
    w = Window.partitionBy("event_type").orderBy("ts", "event_id")
    samples = views.table(spark, d, "events").select(F.col("event_type").alias("src"), (F.row_number().over(w) - 1).alias("pos"), F.col("value").alias("x"))
    return audio.window_loudness(samples, 20)


def interval_loudness(spark, d):
    return audio.interval_loudness(views.samples(spark, d), schedules._refs(spark, d), 64).select("src", F.col("ord").cast("long").alias("ord"), "db")


def quiet_chunks(spark, d):
    rows = base._series(spark, d).select("src", "t", F.coalesce("raw_db", F.lit(0.0)).alias("x"))
    lo = rows.agg(F.min("t").alias("lo"))
    return audio.quiet_chunks(rows.join(F.broadcast(lo)).select("src", (F.col("t") - F.col("lo")).alias("i"), "x"))  # one row


def label_max(spark, d):
    e = views.table(spark, d, "embeddings")
    return e.select("vec_id", F.round(F.array_max(F.transform(F.array(*map(F.lit, (0, 2, 5))), lambda i: F.get("embedding", i))).cast("double"), 6).alias("laugh"))


def asr_segment_filter(spark, d):
    c = views.table(spark, d, "conversations").select("conv_id", "turn", "text", ((F.col("conv_id") * 7 + F.col("turn") * 13) % 100 / 100).alias("nsp"), (-((F.col("conv_id") * 11 + F.col("turn") * 5) % 120) / 100).alias("lp"))
    return c.filter(~audio.not_said(F.col("text"), F.col("nsp"), F.col("lp"), CREDIT, NAMED, BARE, FAREWELL)).select("conv_id", "turn")


def loud_seconds(spark, d):
    return _seconds(spark, d).filter(audio.loud_second(F.col("voice_db"), F.col("scream"), F.col("laugh"), -32.0)).select("src", "t")


def loud_islands(spark, d):
    return schedule.loud_islands(views.words(spark, d), loud_seconds(spark, d), base._segments(spark, d))


def marker_words_per_second(spark, d):
    w = views.words(spark, d)
    return w.groupBy("src", F.floor(F.col("start_us") / 1_000_000).alias("t")).agg(F.count("*").alias("words"), F.count_if(T.marker_word(F.col("w")).isin(MARKERS)).alias("markers"))


def short_merge_quarter(spark, d):
    return schedule.merge_short(schedules._pieces(spark, d))


def score_contributions(spark, d):
    return _contributions(spark, d).select("cfg", "src", "t", F.posexplode("contrib").alias("p", "c")).select("cfg", "src", "t", (F.col("p") + 1).cast("long").alias("pos"), F.col("c.k").alias("feature"), (F.col("c.v") + 0.0).alias("v"))


def preset_recall(spark, d):
    """References of each source that one of the first 10 or 20 peaks of each preset's score hits; src null: all."""
    keyed = _contributions(spark, d).select(F.concat_ws("|", "cfg", "src").alias("src"), "t", "score")
    peaks = series.local_maxima(series.rolling_mean(keyed, "score", "score"), "score")
    refs = schedules._refs(spark, d).join(F.broadcast(_presets(spark).select("cfg").distinct())).select(F.concat_ws("|", "cfg", "src").alias("src"), "ord", "a", "b")
    found = ranking.recall_at(series.nms_top_n(peaks, "score"), refs, [10, 20]).filter("src is not null")
    part = F.split("src", r"\|")
    return found.select(part[0].alias("cfg"), part[1].alias("own"), "k", "refs", "found").rollup("cfg", "k", "own").agg(F.sum("refs").alias("refs"), F.sum("found").alias("found")).filter("k is not null").withColumnRenamed("own", "src")


def candidate_texts(spark, d):
    points = base._flagged(spark, d).filter("bad").select("src", "o", F.col("start_us").alias("t"))
    return ranking.with_text(points, views.words(spark, d), ["o"], 2_000_000)


def layout_lookup(spark, d):
    """Each segment's layout by its name, else by its source, else none."""
    layouts = spark.createDataFrame([("wide", 1280), ("tall", 720), ("0", 640), ("3", 480)], "name string, cam_w int")
    own, fall = (F.broadcast(layouts.toDF(f"{c}_name", f"{c}_w")) for c in ("own", "fall"))
    seg = base._segments(spark, d).withColumn("layout", F.when(F.col("id") % 3 == 0, "wide").when(F.col("id") % 3 == 1, "tall").otherwise("odd"))
    both = seg.join(own, F.col("layout") == F.col("own_name"), "left").join(fall, (F.col("src") % 5).cast("string") == F.col("fall_name"), "left")
    return both.select("src", "id", F.coalesce("own_w", "fall_w").alias("cam_w"), F.coalesce("own_w", "fall_w").isNull().alias("missing"))


def text_parsers(spark, d):
    e = views.table(spark, d, "events").select("event_id", "event_type", "props", F.format_string("%.2f", "value").alias("v"))
    log = F.concat(F.lit("x mean_volume:  -"), F.col("v"), F.lit(" dB\nmax_volume: "), F.when(F.col("event_id") % 3 == 0, "-inf").otherwise(F.col("v")), F.lit(" dB I: -14.0 LUFS, I:   -"), F.col("v"), F.lit(' LUFS {"input_i": "1"} {"input_i": "'), F.col("v"), F.lit('"} {"other": 2}'))
    name = F.concat(F.lit("@Ch_"), F.col("event_type"), F.when(F.col("event_id") % 2 == 0, "!").otherwise(""))
    live = T.live_flag(F.when(F.col("event_id") % 7 == 0, F.lit("error")).otherwise(F.col("props")), "$.k")
    return e.select("event_id", T.decibels(log, "mean_volume").alias("mean_db"), T.decibels(log, "max_volume").alias("max_db"), T.decibels(log, "no_volume").alias("no_db"), T.last_loudness(log).alias("lufs"), T.last_block(log, "input_i").alias("block"), T.channel_name(name).alias("channel"), T.clip_name(F.concat(F.lit("exp_"), F.col("event_type"))).alias("clip"), T.whole_seconds(F.col("v")).alias("whole"), live.alias("live"))


def easing(spark, d):
    t = F.col("value") / 100
    x = T.progress(t, 0.2, 2.9)
    rows = views.table(spark, d, "events")
    return rows.select("event_id", F.round(x, 6).alias("x"), F.round(T.ease_out(x), 6).alias("out"), F.round(T.ease_in_out(x), 6).alias("in_out"), T.typed(t, 0.5, 24.0).cast("long").alias("typed"), T.menu_step(t, 0.4, 0.35).cast("long").alias("menu"))


def even_geometry(spark, d):
    p = views.table(spark, d, "part")
    return p.select("p_partkey", T.even_height(F.col("p_size") + 100, F.col("p_size") * 3 + 50, 1080).alias("height"))


def title_lines(spark, d):
    c = views.table(spark, d, "conversations")
    title = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"\s+", " "))
    cut = c.select("conv_id", "turn", title.alias("title")).select("conv_id", "turn", T.title_cut(F.col("title"), 40).alias("lines"))
    return cut.select("conv_id", "turn", F.size("lines").cast("long").alias("n"), F.col("lines")[0].alias("one"), F.coalesce(F.get("lines", 1), F.lit("")).alias("two"))


def greedy_wrap(spark, d):
    c = views.table(spark, d, "conversations")
    lines = T.wrapped(F.filter(F.split("text", r"\s+"), lambda w: w != ""), 60)
    return c.select("conv_id", "turn", F.posexplode(lines).alias("p", "line")).select("conv_id", "turn", (F.col("p") + 1).cast("long").alias("line_no"), "line")


def rich_lines(spark, d):
    c = views.table(spark, d, "conversations").filter("length(text) > 20")
    x = lambda a, n: F.regexp_replace(F.substring("text", a, n), r"[|@]", "")
    mark = F.when(F.col("turn") % 3 == 0, "@yellow").when(F.col("turn") % 3 == 1, "@#12ab9F").otherwise("@nothing")
    line = F.concat(x(1, 5), F.lit("|"), x(6, 5), mark, F.lit("||"), x(11, 5), F.lit("@ RED |@white"))
    return c.select("conv_id", "turn", F.posexplode(T.rich_line(line)).alias("p", "r")).select("conv_id", "turn", F.col("p").cast("long").alias("p"), "r.text", "r.colour")


def freshness(spark, d):
    """Whether each user's newest event is less than a day older than the newest of all."""
    e = views.table(spark, d, "events").select("user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"))
    now = e.agg(F.max("us").alias("now"))
    return e.groupBy("user_id").agg(F.max("us").alias("us")).join(F.broadcast(now)).select("user_id", (F.col("now") - F.col("us") < 86_400_000_000).alias("fresh"))  # one row


def word_rows(spark, d):
    """The transcript at the edge: seconds at three places, later by 12.3456 s, blank words left out, windows of 25 ms or more."""
    at = lambda c: F.round((F.col(c) + 12_345_600) / 1_000_000, 3)
    return views.words(spark, d).filter((F.trim("w") != "") & (F.col("end_us") - F.col("start_us") >= 25_000)).select("src", "o", at("start_us").alias("start"), at("end_us").alias("end"))


QUERIES = {f.__name__: f for f in (first_bad_text, mute_rules, mute_union_kinds, window_sources, source_counts, range_report, doubtful_words, free_starts, report_rows, seeded_sample, mute_stats_by_kind, first_match_lookup, edit_violations, speed_offsets, words_output_time, output_duration, caption_ends_segment, rail_segments, subtitle_events, every_fifth_word, alternate_segments, drop_and_emph, hero_windows, groups_off_heroes, containment_check, asof_inclusive, loudest_and_quietest, half_window_loudness, interval_loudness, quiet_chunks, label_max, asr_segment_filter, loud_seconds, loud_islands, marker_words_per_second, short_merge_quarter, score_contributions, preset_recall, candidate_texts, layout_lookup, text_parsers, easing, even_geometry, title_lines, greedy_wrap, rich_lines, freshness, word_rows)}

_BADN = lambda n: f"({n} <> '' AND NOT contains({n}, 'nn') AND (contains({n}, 'tion') OR contains({n}, 'eau')))"
_MID = lambda w: f"greatest(CAST(floor(start_us + (end_us - start_us) * (greatest(1, length({w}) // 2) + 0.5) / length({w}) - greatest((end_us - start_us) * 0.40::DOUBLE, 150000) / 2) AS BIGINT), start_us) AS a, least(CAST(floor(start_us + (end_us - start_us) * (greatest(1, length({w}) // 2) + 0.5) / length({w}) + greatest((end_us - start_us) * 0.40::DOUBLE, 150000) / 2) AS BIGINT), end_us) AS b"
_M = schedules._W2 + f""",
mg AS (SELECT w.src, w.o, n2.w AS w, w.w AS giga, w.start_us, w.end_us, n2.nrm AS n1, w.nrm AS n0 FROM nw w JOIN n2 ON w.src = n2.src AND w.o = n2.o),
fbt AS (SELECT *, CASE WHEN {_BADN("n1")} THEN w WHEN {_BADN("n0")} THEN giga END AS word, CASE WHEN {_BADN("n1")} THEN n1 ELSE n0 END AS nword, ({_BADN("n1")} AND (contains(n1, 'tionin') OR contains(n1, 'tionth'))) OR ({_BADN("n0")} AND (contains(n0, 'tionin') OR contains(n0, 'tionth'))) AS anyw FROM mg),
mid AS (SELECT *, {_MID("word")} FROM fbt WHERE word IS NOT NULL),
lw AS (SELECT src, o, CASE WHEN (contains(nword, 'tionin') OR contains(nword, 'tionth')) THEN start_us - 30000 ELSE a END AS a, CASE WHEN (contains(nword, 'tionin') OR contains(nword, 'tionth')) THEN end_us + 30000 ELSE b END AS b, word, CASE WHEN (contains(nword, 'tionin') OR contains(nword, 'tionth')) THEN 'word' ELSE 'letter' END AS kind FROM mid),
cw AS (SELECT src, o, CASE WHEN anyw THEN start_us - 30000 ELSE a END AS a, CASE WHEN anyw THEN end_us + 30000 ELSE b END AS b, word, CASE WHEN (contains(nword, 'tionin') OR contains(nword, 'tionth')) THEN 'word' ELSE 'letter' END AS kind FROM mid),
lg AS (SELECT *, sum(new) OVER (PARTITION BY src ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS g FROM (SELECT *, CASE WHEN a <= max(b) OVER (PARTITION BY src ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS new FROM lw WHERE b > a)),
lo AS (SELECT *, row_number() OVER (PARTITION BY src, g ORDER BY a, b, word) AS rn FROM lg),
lm AS (SELECT src, g, min(a) AS a, max(b) AS b, count(*) AS n, max(CASE WHEN kind = 'word' THEN 1 ELSE 0 END) AS wh FROM lo GROUP BY src, g),
lt AS (SELECT src, g, string_agg(word, ',' ORDER BY rn) AS word FROM (SELECT src, g, word, min(rn) AS rn FROM lo GROUP BY src, g, word) GROUP BY src, g),
mu AS (SELECT lm.src, a, b, n, word, CASE WHEN wh = 1 THEN 'word' ELSE 'letter' END AS kind FROM lm JOIN lt USING (src, g))"""
_TWO = schedules._W2 + """,
f1 AS (SELECT * FROM b1 WHERE NOT EXISTS (SELECT 1 FROM b2 WHERE b2.src = b1.src AND b2.start_us <= b1.end_us + 300000 AND b2.end_us >= b1.start_us - 300000)),
w1 AS (SELECT src, a, b FROM m2 WHERE b > a), wz AS (SELECT mw.src, a, b FROM mw JOIN f1 USING (src, o) WHERE b > a),
al AS (SELECT * FROM w1 UNION ALL SELECT * FROM wz),
un2 AS (SELECT src, min(a) AS a, max(b) AS b FROM (SELECT *, sum(new) OVER (PARTITION BY src ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS g FROM (SELECT *, CASE WHEN a <= max(b) OVER (PARTITION BY src ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 200000 THEN 0 ELSE 1 END AS new FROM al)) GROUP BY src, g),
ls AS (SELECT *, EXISTS (SELECT 1 FROM w1 WHERE w1.src = un2.src AND w1.a <= un2.b AND w1.b >= un2.a) AS i1, EXISTS (SELECT 1 FROM wz WHERE wz.src = un2.src AND wz.a <= un2.b AND wz.b >= un2.a) AS i2 FROM un2),
lab AS (SELECT src, a, b, CASE WHEN i1 AND i2 THEN '1+2' WHEN i1 THEN '1' ELSE '2' END AS source FROM ls)"""
_E = base._W + """,
ed AS (SELECT *, CASE (src + id) % 3 WHEN 0 THEN 1.0::DOUBLE WHEN 1 THEN 1.25 ELSE 2.0 END AS speed FROM seg),
eo AS (SELECT *, CAST(coalesce(sum(round_even((b - a) / speed, 0)) OVER (PARTITION BY src ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS off, CAST(round_even((b - a) / speed, 0) AS BIGINT) AS dur FROM ed),
hz AS (SELECT src, id, a AS sa, speed, off, dur, CASE WHEN id % 2 = 0 THEN a - 5000000 ELSE a + 5000000 END AS f, a + 7000000 AS e FROM eo),
hw AS (SELECT * FROM (SELECT src, id, least(greatest(off + CAST(round_even((f - sa) / speed, 0) AS BIGINT), off), off + dur) AS a, least(greatest(off + CAST(round_even((e - sa) / speed, 0) AS BIGINT), off), off + dur) AS b FROM hz) WHERE b > a)"""
_WS = base._W.replace("words AS (SELECT src, CAST", "words0 AS (SELECT src, CAST").replace("nw AS (", "sg0 AS (SELECT src, unnest(generate_series(0, (max(end_us) - 1) // 30000000)) AS k FROM words0 GROUP BY src),\nwords AS (SELECT CAST(words0.src * 1000 + k AS BIGINT) AS src, o, w, start_us, end_us FROM words0 JOIN sg0 ON words0.src = sg0.src AND start_us >= k * 30000000 AND end_us <= k * 30000000 + 20000000),\nnw AS (", 1)
_CAP_HEAD = schedules._CAP[: schedules._CAP.index(" SELECT src, min(start_us) AS a")]
_SEC = base._W + """,
sc AS (SELECT src, start_us // 1000000 AS t, count(*) * 8 - 50.0 AS voice_db, avg(CASE WHEN length(w) > 9 THEN 1.0 ELSE 0.0 END) AS laugh, avg(CASE WHEN bad THEN 1.0 ELSE 0.0 END) AS scream FROM fb GROUP BY 1, 2),
ld AS (SELECT src, t FROM sc WHERE voice_db > -32 OR scream > 0.35 OR laugh > 0.20)"""
_VALUES = ", ".join(f"('{c}', '{f}', {w}::DOUBLE)" for c, f, w in ranking.preset_rows())
_F = base._S + f""",
sh AS (SELECT src, t, round(20 * log10(greatest(sqrt(avg(CASE WHEN user_id % 2 = 0 THEN x * x END)), 1e-10)), 4) AS voice_db, round(avg(x), 4) AS arousal, round(avg(CASE WHEN x > 100 THEN 1.0::DOUBLE ELSE 0 END), 4) AS laugh, round(avg(CASE WHEN x > 150 THEN 1.0::DOUBLE ELSE 0 END), 4) AS scream, round(avg(CASE WHEN x BETWEEN 20 AND 60 THEN 1.0::DOUBLE ELSE 0 END), 4) AS emo_positive, round(avg(CASE WHEN x < 10 THEN 1.0::DOUBLE ELSE 0 END), 4) AS emo_angry, count(*) FILTER (WHERE k < 10) AS markers FROM s GROUP BY src, t),
ft AS (SELECT ser.src, ser.t, raw_db, voice_db, coalesce(voice_db > 35, false) AS v, arousal, laugh, scream, emo_positive, emo_angry, CAST(coalesce(markers, 0) AS DOUBLE) AS markers FROM ser LEFT JOIN sh ON ser.src = sh.src AND ser.t = sh.t),
lg AS (SELECT src, t, 'raw_db' AS feature, raw_db AS x FROM ft UNION ALL SELECT src, t, 'voice_db', voice_db FROM ft UNION ALL SELECT src, t, 'markers', markers FROM ft {" ".join(f"UNION ALL SELECT src, t, '{c}', CASE WHEN v THEN {c} END FROM ft" for c in ("arousal", "laugh", "scream", "emo_positive", "emo_angry"))}),
cm AS (SELECT src, feature, median(x) AS m FROM lg GROUP BY ALL), dv AS (SELECT lg.*, m FROM lg JOIN cm USING (src, feature)), md AS (SELECT src, feature, median(abs(x - m)) AS mad FROM dv GROUP BY ALL),
zf AS (SELECT src, t, feature, CASE WHEN mad > 0 THEN greatest(-3.0, least(6.0, coalesce((x - m) / (1.4826 * mad), 0.0))) ELSE 0.0 END AS z FROM dv JOIN md USING (src, feature)),
cf AS (SELECT * FROM (VALUES {_VALUES}) v(cfg, feature, weight)),
pt AS (SELECT cfg, src, t, feature, weight * z AS v FROM zf JOIN cf USING (feature))"""
_NMS_TAIL = base._Z[base._Z.index("nb AS") :] + schedules._N[schedules._N.index(", r AS (SELECT") : schedules._N.index(" SELECT u.src")]

ORACLES = {
    "first_bad_text": f"WITH {_M} SELECT src, o, word FROM fbt WHERE word IS NOT NULL",
    "mute_rules": f"WITH {_M} SELECT *, 'letter' AS rule FROM lw UNION ALL SELECT *, 'clip' FROM cw WHERE b - a > 1",
    "mute_union_kinds": f"WITH {_M} SELECT src, a, b, n, word, kind FROM mu",
    "window_sources": f"WITH {_TWO} SELECT * FROM lab",
    "source_counts": f"WITH {_TWO} SELECT src, count(*) FILTER (WHERE source = '1') AS first, count(*) FILTER (WHERE source = '2') AS second, count(*) FILTER (WHERE source = '1+2') AS both FROM lab GROUP BY src",
    "range_report": f"WITH {base._W}, rg AS (SELECT * FROM (VALUES (3000000::BIGINT, 9000000::BIGINT), (20000000, 31500000), (70250000, 90000000)) v(ra, rb)) SELECT s.src, ra, rb, count(un.a) AS n FROM (SELECT DISTINCT src FROM un) s CROSS JOIN rg LEFT JOIN un ON un.src = s.src AND un.a <= rb AND un.b >= ra GROUP BY 1, 2, 3",
    "doubtful_words": f"WITH {_TWO} SELECT src, o, w, end_us - start_us AS length_us, end_us - start_us > 300000 AS doubtful FROM f1",
    "free_starts": f"WITH {base._W}, tw AS (SELECT *, 0 AS copy FROM words UNION ALL SELECT *, 1 FROM words WHERE o % 5 = 0) SELECT src, o, copy, least(start_us + (row_number() OVER (PARTITION BY src, start_us, w ORDER BY o, copy) - 1) * 1000, greatest(start_us, end_us)) AS free_us FROM tw",
    "report_rows": f"WITH {_M} SELECT 'first' AS tag, src, a, b FROM (SELECT *, row_number() OVER (PARTITION BY src ORDER BY a, b) AS k FROM mu) WHERE k <= 5 UNION ALL SELECT 'word', src, a, b FROM mu WHERE kind = 'word'",
    "seeded_sample": f"WITH {base._W} SELECT src, a, b FROM un ORDER BY md5('1|' || CAST(src AS VARCHAR) || '|' || CAST(a AS VARCHAR)), src, a LIMIT 10",
    "mute_stats_by_kind": f"WITH {_M} SELECT kind, count(*) AS n, min(b - a) AS least, max(b - a) AS most, round(avg(b - a), 3) AS mean FROM lw GROUP BY kind",
    "first_match_lookup": f"WITH {_M} SELECT t.src, t.word, min(mg.o) AS o FROM (SELECT DISTINCT src, word FROM lw) t LEFT JOIN mg ON mg.src = t.src AND (mg.w = t.word OR mg.giga = t.word) GROUP BY 1, 2",
    "edit_violations": f"""WITH {base._W}, ev AS (SELECT src, id, a, CASE WHEN (src + id) % 11 = 0 THEN a ELSE b END AS b, 0.5 + (src * 7 + id) % 9 * 0.25 AS speed, (src + id) % 4 = 0 AS broll, (src + id) % 3 AS f, (src + id) % 2 = 0 AS crop, src * 37 % 1500 AS x, src * 11 % 600 AS y, 400 + id % 3 * 200 AS w, CASE WHEN (src + id) % 13 = 0 THEN 0 ELSE 500 END AS h FROM seg)
SELECT src, id, 'empty segment' AS rule FROM ev WHERE b <= a UNION ALL SELECT src, id, 'speed' FROM ev WHERE speed < 1 OR speed > 2 UNION ALL SELECT src, id, 'b-roll at another speed' FROM ev WHERE broll AND abs(speed - 1) > 1e-9 UNION ALL SELECT src, id, 'focus' FROM ev WHERE f = 2 UNION ALL SELECT src, id, 'empty crop' FROM ev WHERE crop AND h <= 0 UNION ALL SELECT src, id, 'crop outside' FROM ev WHERE crop AND (x + w > 1920 OR y + h > 1080)""",
    "speed_offsets": f"WITH {_E} SELECT src, id, speed, off FROM eo",
    "words_output_time": f"WITH {_E} SELECT w.src, o, id, start_us AS t, CAST(round_even((start_us - a) / speed, 0) AS BIGINT) AS local_us, off + CAST(round_even((start_us - a) / speed, 0) AS BIGINT) AS out_us FROM words w JOIN eo ON w.src = eo.src AND start_us >= a AND start_us < b",
    "output_duration": f"WITH {_E} SELECT src, CAST(sum(dur) + 2500000 AS BIGINT) AS out_us FROM eo GROUP BY src",
    "caption_ends_segment": f"SELECT src, a, b, greatest(b, least(b + 150000, coalesce(lead(a) OVER (PARTITION BY src ORDER BY a, b), b + 150000), src % 1000 * 30000000 + 20000000)) AS shown_to FROM ({schedules._CAP.replace(base._W, _WS)})",
    "rail_segments": schedules._RAIL.replace(base._W, _WS),
    "subtitle_events": f"""{_CAP_HEAD}, gr AS (SELECT src, island, g, min(start_us) AS a, max(end_us) AS b FROM f GROUP BY 1, 2, 3), ge AS (SELECT *, greatest(b, least(b + 150000, coalesce(lead(a) OVER (PARTITION BY src ORDER BY a, b), b + 150000))) AS shown FROM gr),
en AS (SELECT f.src, f.island, f.i, f.start_us, coalesce(lead(f.start_us) OVER (PARTITION BY f.src, f.island, f.g ORDER BY f.i), shown) AS e FROM f JOIN ge ON f.src = ge.src AND f.island = ge.island AND f.g = ge.g),
ev AS (SELECT src, island, i, start_us // 10000 AS p, CASE WHEN e <= start_us THEN start_us + 50000 ELSE e END // 10000 AS q FROM en)
SELECT iw.src, iw.o, printf('%d:%02d:%02d.%02d', p // 360000, p // 6000 % 60, p // 100 % 60, p % 100) AS shown_from, printf('%d:%02d:%02d.%02d', q // 360000, q // 6000 % 60, q // 100 % 60, q % 100) AS shown_to, CASE WHEN bad THEN substr(iw.w, 1, greatest(1, length(iw.w) // 2)) || '*' || substr(iw.w, greatest(1, length(iw.w) // 2) + 2) ELSE iw.w END AS text
FROM ev JOIN iw ON ev.src = iw.src AND ev.island = iw.island AND ev.i = iw.i JOIN fb ON fb.src = iw.src AND fb.o = iw.o""",
    "every_fifth_word": f"WITH {base._W} SELECT src, o, k FROM (SELECT src, o, row_number() OVER (PARTITION BY src ORDER BY start_us, o) - 1 AS k FROM words) WHERE k % 5 = 0",
    "alternate_segments": f"WITH {base._W} SELECT src, id, CASE WHEN (row_number() OVER (PARTITION BY src ORDER BY id) - 1) % 2 = 0 THEN 'near' ELSE 'wide' END AS view FROM seg",
    "drop_and_emph": f"WITH {base._W}, dr AS (SELECT src, start_us + 30000 AS t FROM words WHERE o % 13 = 0), em AS (SELECT src, start_us + CASE WHEN o % 4 = 0 THEN 50000 ELSE 60000 END AS t FROM words WHERE o % 6 = 0) SELECT src, o, EXISTS (SELECT 1 FROM em WHERE em.src = w.src AND abs(em.t - w.start_us) <= 50000) AS emph FROM words w WHERE NOT EXISTS (SELECT 1 FROM dr WHERE dr.src = w.src AND abs(dr.t - w.start_us) <= 50000)",
    "hero_windows": f"WITH {_E} SELECT * FROM hw",
    "groups_off_heroes": f"{_CAP_HEAD.replace(base._W, _E)}, gr AS (SELECT src, min(start_us) AS a, max(end_us) AS b, count(*) AS n FROM f GROUP BY src, island, g) SELECT src, a, b, n FROM gr WHERE NOT EXISTS (SELECT 1 FROM hw WHERE hw.src = gr.src AND gr.a < hw.b AND gr.b > hw.a)",
    "containment_check": f"WITH {schedules._P}, st AS (SELECT w.src, w.o, EXISTS (SELECT 1 FROM seg WHERE seg.src = w.src AND w.start_us >= seg.a AND w.end_us <= seg.b) AS s, EXISTS (SELECT 1 FROM pc WHERE pc.src = w.src AND w.start_us >= pc.a AND w.end_us <= pc.b) AS p FROM words w) SELECT src, count(*) AS words, count(*) FILTER (WHERE NOT s) AS straddle, count(*) FILTER (WHERE s AND NOT p) AS lost FROM st GROUP BY src",
    "asof_inclusive": "WITH p AS (SELECT user_id, epoch_us(ts) AS us, max(value) AS x FROM events GROUP BY 1, 2), e AS (SELECT event_id, user_id, epoch_us(ts) + 1000 AS us FROM events) SELECT event_id, x FROM e ASOF LEFT JOIN p ON e.user_id = p.user_id AND e.us >= p.us",
    "loudest_and_quietest": f"WITH {base._S}, m AS (SELECT src, t, round(avg(abs(x)), 4) AS m FROM s GROUP BY 1, 2), k AS (SELECT *, row_number() OVER (PARTITION BY src ORDER BY m DESC, t) AS hi, row_number() OVER (PARTITION BY src ORDER BY m, t) AS lo FROM m) SELECT src, max(CASE WHEN hi = 1 THEN t END) AS loudest, max(CASE WHEN lo = 1 THEN t END) AS quietest FROM k GROUP BY src",
    "half_window_loudness": "WITH p AS (SELECT event_type AS src, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS pos, value AS x FROM events) SELECT src, pos // 20 AS k, round(greatest(-200.0, 10 * log10(avg(x * x))), 4) AS db FROM p GROUP BY 1, 2 HAVING count(*) = 20",
    "interval_loudness": f"WITH {base._S}, rf AS (SELECT src, generate_subscripts(g, 1) - 1 AS ord, unnest(g) AS a FROM (SELECT src, generate_series(min(t), max(t), 100) AS g FROM ser GROUP BY src)) SELECT rf.src, CAST(ord AS BIGINT) AS ord, round(20 * log10(sqrt(avg(x * x)) + 1e-12), 4) AS db FROM rf JOIN s ON s.src = rf.src AND s.t >= a AND s.t < a + 12 GROUP BY 1, 2",
    "quiet_chunks": f"""WITH RECURSIVE {base._S}, lv AS MATERIALIZED (SELECT src, t - (SELECT min(t) FROM ser) AS i, coalesce(raw_db, 0.0) AS x FROM ser), nn AS (SELECT src, count(*) AS n FROM lv GROUP BY src),
sm AS MATERIALIZED (SELECT p.src, p.i, n, CASE WHEN n - p.i > 18 THEN (SELECT q.i FROM lv q WHERE q.src = p.src AND q.i BETWEEN p.i + 12 AND p.i + 17 ORDER BY q.x, q.i LIMIT 1) ELSE n END AS e FROM lv p JOIN nn ON p.src = nn.src),
f AS (SELECT src, CAST(0 AS BIGINT) AS k, i AS a, e AS b FROM sm WHERE i = 0 UNION ALL SELECT f.src, k + 1, sm.i, sm.e FROM f JOIN sm ON f.src = sm.src AND f.b = sm.i) SELECT src, k, a, b FROM f""",
    "label_max": "SELECT vec_id, round(CAST(greatest(embedding[1], embedding[3], embedding[6]) AS DOUBLE), 6) AS laugh FROM embeddings",
    "asr_segment_filter": r"WITH c AS (SELECT conv_id, turn, text, lower(text) AS l, (conv_id * 7 + turn * 13) % 100 / 100 AS nsp, -((conv_id * 11 + turn * 5) % 120) / 100 AS lp FROM conversations) SELECT conv_id, turn FROM c WHERE NOT coalesce(contains(l, 'of the') OR regexp_matches(text, '(?i:the|der)\s+[A-Z]\w*,') OR (nsp > 0.7 AND lp < -0.6) OR ((contains(l, 'and the') OR contains(l, 'und die') OR contains(l, 'que la')) AND (nsp > 0.5 OR lp < -0.7)), false)",
    "loud_seconds": f"WITH {_SEC} SELECT src, t FROM ld",
    "loud_islands": f"""WITH {_SEC}, pc AS (SELECT seg.src, id, greatest(seg.a, start_us - 120000) AS a, least(seg.b, end_us + 120000) AS b FROM words JOIN seg ON words.src = seg.src AND start_us >= seg.a AND end_us <= seg.b UNION ALL SELECT seg.src, id, greatest(a, t * 1000000), least(b, t * 1000000 + 1000000) FROM ld JOIN seg ON ld.src = seg.src AND t * 1000000 > a - 1000000 AND t * 1000000 < b)
SELECT src, id, min(a) AS a, max(b) AS b, count(*) AS n FROM (SELECT *, sum(new) OVER (PARTITION BY src, id ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS g FROM (SELECT *, CASE WHEN a <= max(b) OVER (PARTITION BY src, id ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 450000 THEN 0 ELSE 1 END AS new FROM pc WHERE b > a)) GROUP BY src, id, g""",
    "marker_words_per_second": f"WITH {base._W} SELECT src, start_us // 1000000 AS t, count(*) AS words, count(*) FILTER (WHERE trim(replace(lower(w), 'ё', 'е')) IN ('the', 'la', 'die')) AS markers FROM words GROUP BY 1, 2",
    "short_merge_quarter": schedules.ORACLES["short_merge"].replace("1200000", "250000"),
    "score_contributions": f"WITH {_F} SELECT cfg, src, t, pos, feature, round(v, 4) + 0.0 AS v FROM (SELECT *, row_number() OVER (PARTITION BY cfg, src, t ORDER BY v DESC, feature) AS pos FROM pt) WHERE pos <= 5",
    "preset_recall": f"""WITH RECURSIVE {_F}, s0 AS (SELECT cfg || '|' || src AS src, t, round(sum(v), 6) AS z FROM pt GROUP BY cfg, pt.src, t),
sm AS (SELECT src, t, round(avg(z) OVER (PARTITION BY src ORDER BY t ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING), 6) AS score FROM s0),
{_NMS_TAIL}, rf AS (SELECT src, generate_subscripts(g, 1) - 1 AS ord, unnest(g) AS a FROM (SELECT src, generate_series(min(t), max(t), 100) AS g FROM s0 GROUP BY src)),
h AS (SELECT rf.src, ord, min(rank) AS first FROM rf JOIN u ON rf.src = u.src AND u.t BETWEEN a - 5 AND a + 17 GROUP BY 1, 2),
al AS (SELECT string_split(rf.src, '|')[1] AS cfg, string_split(rf.src, '|')[2] AS src, first, k FROM rf LEFT JOIN h USING (src, ord), (VALUES (10), (20)) v(k))
SELECT cfg, src, CAST(k AS BIGINT) AS k, count(*) AS refs, count(*) FILTER (WHERE first <= k) AS found FROM al GROUP BY GROUPING SETS ((cfg, k, src), (cfg, k))""",
    "candidate_texts": f"WITH {base._W}, c AS (SELECT src, o, start_us AS t FROM fb WHERE bad) SELECT c.src, c.o, c.t, string_agg(w.w, ' ' ORDER BY w.start_us, w.o) AS text FROM c JOIN words w ON w.src = c.src AND w.start_us BETWEEN c.t - 2000000 AND c.t + 2000000 GROUP BY 1, 2, 3",
    "layout_lookup": f"WITH {base._W}, x AS (SELECT src, id, CASE id % 3 WHEN 0 THEN 1280 WHEN 1 THEN 720 ELSE CASE src % 5 WHEN 0 THEN 640 WHEN 3 THEN 480 END END AS w FROM seg) SELECT src, id, w AS cam_w, w IS NULL AS missing FROM x",
    "text_parsers": """WITH e AS (SELECT *, printf('%.2f', value) AS v FROM events) SELECT event_id, -CAST(v AS DOUBLE) AS mean_db, CASE WHEN event_id % 3 = 0 THEN -999.0 ELSE CAST(v AS DOUBLE) END AS max_db, CAST(NULL AS DOUBLE) AS no_db, -CAST(v AS DOUBLE) AS lufs, '{"input_i": "' || v || '"}' AS block, CASE WHEN event_id % 2 <> 0 THEN 'ch_' || lower(event_type) END AS channel, 'tt_' || event_type AS clip, string_split(v, '.')[1] AS whole, CASE WHEN event_id % 7 <> 0 THEN json_extract_string(props, '$.k') IS NOT NULL END AS live FROM e""",
    "easing": "WITH x AS (SELECT event_id, value / 100 AS t, greatest(0.0, least(1.0, (value / 100 - 0.2) / (2.9 - 0.2))) AS x FROM events) SELECT event_id, round(x, 6) AS x, round(1 - pow(1 - x, 3), 6) AS out, round(0.5 - 0.5 * cos(pi() * x), 6) AS in_out, CAST(floor(greatest(0.0, t - 0.5) * 24.0) AS BIGINT) AS typed, CASE WHEN t < 0.4 THEN 0 ELSE least(3, 1 + CAST(floor((t - 0.4) / 0.35) AS BIGINT)) END AS menu FROM x",
    "even_geometry": "SELECT p_partkey, CAST(2 * round_even((p_size * 3 + 50) * 1080 / (2.0::DOUBLE * (p_size + 100)), 0) AS BIGINT) AS height FROM part",
    "title_lines": r"""WITH x AS (SELECT conv_id, turn, trim(regexp_replace(coalesce(text, ''), '\s+', ' ', 'g')) AS s FROM conversations), b AS (SELECT *, list_filter(generate_series(1, greatest(length(s), 1)), lambda i: substr(s, i, 1) = ' ') AS bl FROM x),
n AS (SELECT *, list_sort(list_transform(bl, lambda i: {'d': abs(i - 1 - length(s) / 2.0), 'i': i}))[1].i AS i FROM b)
SELECT conv_id, turn, CASE WHEN length(s) <= 40 OR i IS NULL THEN 1::BIGINT ELSE 2 END AS n, CASE WHEN length(s) <= 40 OR i IS NULL THEN s ELSE substr(s, 1, i - 1) END AS one, CASE WHEN length(s) <= 40 OR i IS NULL THEN '' ELSE substr(s, i + 1) END AS two FROM n""",
    "greedy_wrap": r"""WITH RECURSIVE x AS (SELECT conv_id, turn, list_filter(string_split_regex(text, '\s+'), lambda w: w <> '') AS ws FROM conversations), y AS MATERIALIZED (SELECT conv_id, turn, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM x),
f AS (SELECT conv_id, turn, i, 1 AS g, length(w) AS c, w FROM y WHERE i = 1 UNION ALL SELECT y.conv_id, y.turn, y.i, CASE WHEN c + 1 + length(y.w) > 60 THEN g + 1 ELSE g END, CASE WHEN c + 1 + length(y.w) > 60 THEN length(y.w) ELSE c + 1 + length(y.w) END, y.w FROM f JOIN y ON f.conv_id = y.conv_id AND f.turn = y.turn AND y.i = f.i + 1)
SELECT conv_id, turn, CAST(g AS BIGINT) AS line_no, string_agg(w, ' ' ORDER BY i) AS line FROM f GROUP BY conv_id, turn, g""",
    "rich_lines": r"""WITH c AS (SELECT conv_id, turn, [regexp_replace(substr(text, 1, 5), '[|@]', '', 'g'), regexp_replace(substr(text, 6, 5), '[|@]', '', 'g'), regexp_replace(substr(text, 11, 5), '[|@]', '', 'g')] AS p, CASE turn % 3 WHEN 0 THEN 'YELLOW' WHEN 1 THEN '#12ab9F' ELSE 'WHITE' END AS m FROM conversations WHERE length(text) > 20),
l AS (SELECT conv_id, turn, list_filter([{'t': p[1], 'c': 'WHITE'}, {'t': p[2], 'c': m}, {'t': p[3], 'c': 'RED'}], lambda x: x.t <> '') AS l FROM c), u AS (SELECT conv_id, turn, unnest(l) AS x, generate_subscripts(l, 1) - 1 AS p FROM l)
SELECT conv_id, turn, CAST(p AS BIGINT) AS p, x.t AS text, x.c AS colour FROM u""",
    "freshness": "SELECT user_id, (SELECT max(epoch_us(ts)) FROM events) - max(epoch_us(ts)) < 86400000000 AS fresh FROM events GROUP BY user_id",
    "word_rows": f'WITH {base._W} SELECT src, o, round((start_us + 12345600) / 1000000, 3) AS start, round((end_us + 12345600) / 1000000, 3) AS "end" FROM words WHERE trim(w) <> \'\' AND end_us - start_us >= 25000',
}
