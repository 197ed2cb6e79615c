"""Ranking, schedules, alignment and the watcher at their boundaries, against plain restatements."""

import random

from pyspark.sql import functions as F

from tempora.operators import align, intervals, ranking, schedule
from tempora.streaming import watch

S = 1_000_000


def pieces(spark, rows):
    return spark.createDataFrame([("s", int(a * S), int(b * S)) for a, b in rows], "src string, a long, b long")


def got(df):
    return sorted((r.a / S, r.b / S) for r in df.collect())


def test_gap_policy_keeps_the_gap_at_the_limit(spark):
    assert got(schedule.gap_policy(pieces(spark, [(0, 1), (1.45, 2), (2.5, 3)]))) == [(0, 2.125), (2.375, 3)]


def fixpoint(rows, least):
    """Merge the first short piece into a neighbour, and start again."""
    rows = [list(r) for r in rows]
    while len(rows) > 1:
        short = next((i for i, (a, b) in enumerate(rows) if b - a < least), None)
        if short is None:
            break
        a, b = rows.pop(short)
        if short:
            rows[short - 1][1] = max(rows[short - 1][1], b)
        else:
            rows[0][0] = min(rows[0][0], a)
    return [tuple(r) for r in rows]


def test_one_pass_reaches_the_fixpoint_of_short_pieces(spark):
    rng = random.Random(3)
    rows, want = [], {}
    for k in range(60):
        cuts = sorted(rng.sample(range(1, 400), 2 * rng.randint(1, 7)))
        own = list(zip(cuts[::2], cuts[1::2], strict=True))
        rows += [(f"s{k}", a, b) for a, b in own]
        want[f"s{k}"] = fixpoint(own, 25)
    df = spark.createDataFrame(rows, "src string, a long, b long")
    found = {}
    for r in schedule.merge_short(df, 25).orderBy("src", "a").collect():
        found.setdefault(r.src, []).append((r.a, r.b))
    assert found == want


def test_remap_takes_the_first_keep_and_cuts_are_null(spark):
    keeps = spark.createDataFrame([("s", 0, 10, 20), ("s", 1, 20, 30), ("s", 2, 40, 50)], "src string, id long, a long, b long")
    points = spark.createDataFrame([("s", k, t) for k, t in enumerate((10, 20, 30, 35, 50))], "src string, o long, t long")
    assert [r.out for r in schedule.remap(points, keeps, ["o"], 7).orderBy("o").collect()] == [0, 10, 20, None, 30]


def test_nearest_prefers_the_earlier_and_snaps_inside(spark):
    keeps = spark.createDataFrame([("s", 0, 0, 10_000), ("s", 1, 31_000, 40_000)], "src string, id long, a long, b long")
    points = spark.createDataFrame([("s", k, t) for k, t in enumerate((5_000, 20_000, 20_001, 40_000))], "src string, o long, t long")
    rows = schedule.nearest(points, keeps, ["o"]).orderBy("o").collect()
    assert [(r.near_id, r.dist, r.snapped) for r in rows] == [(0, 0, 5_000), (0, 11_000, 9_000), (1, 10_999, 31_000), (1, 1_000, 39_000)]


def test_envelope_ramps(spark):
    punches = spark.createDataFrame([("s", 0)], "src string, t0 long")
    points = spark.createDataFrame([("s", k, t) for k, t in enumerate((0, 35_000, 500_000, 875_000, 1_000_001))], "src string, o long, t long")
    assert [round(r.zoom, 4) for r in schedule.envelope(points, punches, ["o"]).orderBy("o").collect()] == [1.0, 1.15, 1.3, 1.15, 1.0]


def test_rails_drop_near_single_words_and_fillers(spark):
    rows = [(0, 0.0, 0.2, "um"), (1, 0.3, 0.5, "so"), (2, 0.6, 0.8, "go"), (3, 5.0, 5.2, "alone")]
    words = spark.createDataFrame([("s", o, int(a * S), int(b * S), w) for o, a, b, w in rows], "src string, o long, start_us long, end_us long, w string")
    lines = schedule.rails(words, ["um"], ["so"]).orderBy("a").collect()
    assert [r.text for r in lines] == ["so go", "alone"]  # `so` is no longer the first word that was said
    assert lines[0].shown_from == int(0.3 * S) - 80_000 and lines[0].shown_to == int(1.3 * S)


def test_dedupe_counts_from_the_last_kept_word(spark):
    rows = [("s", k, t, t + 10, "a") for k, t in enumerate((0, 200_000, 300_000, 700_000))]
    df = spark.createDataFrame(rows, "src string, o long, start_us long, end_us long, w string").withColumn("norm", F.col("w"))
    assert sorted(r.o for r in ranking.dedupe_in_time(df, "norm").collect()) == [0, 2, 3]


def test_recall_counts_each_reference_once(spark):
    points = spark.createDataFrame([("s", 5, 1), ("s", 7, 2), ("s", 205, 11)], "src string, t long, rank long")
    refs = spark.createDataFrame([("s", 0, 10, 20), ("s", 1, 200, 212)], "src string, ord long, a long, b long")
    rows = {(r.src, r.k): (r.refs, r.found) for r in ranking.recall_at(points, refs, [10, 20]).collect()}
    assert rows == {("s", 10): (2, 1), ("s", 20): (2, 2), (None, 10): (2, 1), (None, 20): (2, 2)}


def test_not_touching_is_an_anti_join(spark):
    a = spark.createDataFrame([("s", 1, 0, 5), ("s", 2, 6, 9), ("t", 3, 0, 5)], "src string, o long, la long, lb long")
    b = spark.createDataFrame([("s", 5, 5)], "src string, ra long, rb long")
    assert sorted(r.o for r in intervals.not_touching(a, b, "src", ["o"], 4).collect()) == [2, 3]


def test_reconcile_every_operation(spark):
    word = lambda w, a, b: (w, a, b)
    timed = [word("one", 0, 10), word("too", 20, 30), word("um", 40, 50), word("longer", 60, 70)]
    spoken = [word("one", 1, 11), word("two", 21, 31), word("end", 990, 1010)]
    cases = [
        (timed, spoken, [("one", "one", 0, 10, "eq"), ("two", "too", 20, 45, "rep"), ("end", "um", 45, 70, "rep")]),
        (timed, [], [(w, w, a, b, "only") for w, a, b in timed]),
        (timed[:1], [word("one", 5, 6), word("new", 990, 1010)], [("one", "one", 0, 10, "eq"), ("new", None, 990, 1000, "ins")]),
        (timed, [timed[0]], [("one", "one", 0, 10, "eq"), ("too", "too", 20, 30, "del"), ("um", "um", 40, 50, "del"), ("longer", "longer", 60, 70, "del")]),
        (timed[:1] + [word("farther", 30, 40)], [timed[0]], [("one", "one", 0, 10, "eq")]),
        ([word("x", 0, 90)], [word("a", 1, 2), word("bb", 2, 3)], [("a", "x", 0, 30, "rep"), ("bb", "x", 30, 90, "rep")]),
        ([word("x", 0, 90)], [word("", 1, 2), word("", 2, 3)], [("", "x", 0, 45, "rep"), ("", "x", 45, 90, "rep")]),
        ([], [word("new", 3, 4)], [("new", None, 3, 4, "ins")]),
    ]
    table = lambda side: spark.createDataFrame([(f"s{k}", o, w, w, a, b) for k, c in enumerate(cases) for o, (w, a, b) in enumerate(c[side])], "src string, o long, norm string, w string, start_us long, end_us long")
    segments = spark.createDataFrame([(f"s{k}", 0, 0, 1000) for k in range(len(cases))], "src string, id long, a long, b long")
    out = align.align(table(0), table(1), segments, lambda norm: norm == "longer", 100).collect()
    for k, (_, _, want) in enumerate(cases):
        assert [(r.w, r.other, r.start_us, r.end_us, r.op) for r in sorted((r for r in out if r.src == f"s{k}"), key=lambda r: r.n)] == want, k


def test_align_groups_by_segment(spark):
    words = lambda rows: spark.createDataFrame([("s", o, w, w, a, a + 5) for o, w, a in rows], "src string, o long, norm string, w string, start_us long, end_us long")
    segments = spark.createDataFrame([("s", 0, 0, 100), ("s", 1, 100, 200)], "src string, id long, a long, b long")
    out = align.align(words([(0, "a", 0), (1, "b", 150)]), words([(0, "a", 1), (1, "c", 151)]), segments, lambda norm: F.lit(False), 50)
    assert sorted((r.id, r.w, r.other, r.op) for r in out.collect()) == [(0, "a", "a", "eq"), (1, "c", "b", "rep")]


def test_watcher_state_machine():
    def actions(checks, state=watch.IDLE):
        out = []
        for live, active in checks:
            state, action = watch.step(state, live, active)
            out.append(action)
        return out

    off, on = (False, True), (True, True)
    assert actions([(True, False), off, off, (None, True), off]) == ["start", "wait", "wait", "unknown", "stop"]
    assert actions([(True, False), off, off, on, off]) == ["start", "wait", "wait", "recording", "wait"]
    assert actions([off] * 4, (True, "manual", 0)) == ["manual"] * 4
    assert actions([(False, False), (False, False)], (True, "auto", 1)) == ["gone", "idle"]


def test_watch_stream_keeps_state_over_batches(spark, tmp_path):
    source = tmp_path / "in"
    rows = [("c", k, live, active) for k, (live, active) in enumerate([(True, False), (False, True), (False, True), (None, True), (False, True)])]
    kind = "channel string, k long, live boolean, active boolean"
    for k, row in enumerate(rows):  # one file for each check
        spark.createDataFrame([row], kind).coalesce(1).write.mode("append").parquet(str(source))
    read = spark.readStream.schema(kind).option("maxFilesPerTrigger", 2).parquet(str(source))
    checks = read.select("channel", F.timestamp_seconds("k").alias("ts"), F.col("k").alias("order"), "live", "active")
    out = watch.run_to_end(watch.watch(checks)).collect()
    # what a state machine gives for the checks in their order
    state, want = watch.IDLE, []
    for r in rows:
        state, action = watch.step(state, r[2], r[3])
        want.append(action)
    assert len(out) == 5 and want == ["start", "wait", "wait", "unknown", "stop"]
    assert [r.action for r in sorted(out, key=lambda r: r.ts)] == want
