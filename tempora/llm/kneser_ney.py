"""Quality classifier: an interpolated modified Kneser-Ney model of character 5-grams.

The model is trained on all trusted text. Counts, continuation counts, discounts and back-off
weights are grouped sums and joins on n-gram codes, sharded by code. The distinct 5-grams of the
whole corpus are looked up in the model by the same sharded joins; a document's perplexity is the
sum of its 5-grams' log probabilities. A document is kept if its perplexity is at most its
language's quantile of trusted perplexities.

A character's code is its code point modulo 4096, so five make 60 bits; a text is preceded by four
zeros. The looked-up 5-grams (code and log probability) are dealt by hash into shards of about
`BROADCAST_ROWS` rows. The documents are joined with one shard at a time, which is broadcast, and
keep their running sums, so neither the driver nor a task ever holds more than a shard; with a bound
of 0, their counted 5-grams are joined with the table by shuffle instead. Log probabilities are
whole numbers of 2^-32, so that sums, and verdicts at the threshold, are the same in any order.

Defined results: null and empty texts have no perplexity and aren't kept; a null or unseen
language takes the quantile over all trusted text; without trusted text nothing is rejected
except texts without perplexity; repeated rows each give a row; ties are kept; other columns are
not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tempora.llm.common import map_batches, slices, stored

ORDER = 5
BITS = 12
BROADCAST_ROWS = 6_000_000
#: A log probability of 1 in the fixed-point numbers that are summed.
ONE = 1 << 32
QUANTILE = 0.995
SMALL_LABELS = 1_000_000


def codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """5-gram code that ends at each character, and the number of characters of each text."""
    pad = ORDER - 1
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    zeros = "\0" * pad
    chars = np.frombuffer((zeros + zeros.join(texts)).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64) & ((1 << BITS) - 1)
    n = len(chars)
    code = np.zeros(n, np.int64)
    for k in range(ORDER):
        code[k:] |= chars[: n - k] << (BITS * k)
    ends = np.cumsum(size + pad)
    real = np.ones(n, bool)
    begin = ends - size - pad
    for k in range(pad):
        real[begin[begin + k < n] + k] = False
    return code[real], size


def counts(docs: DataFrame) -> DataFrame:
    """code, trusted (occurrences in trusted text) for all 5-grams of the corpus (columns x, trusted)."""

    def run(cols):
        rows = [(t, bool(f)) for t, f in zip(*cols, strict=True) if t]
        texts = [t for t, _ in rows]
        flags = np.array([f for _, f in rows], bool)
        for a, b in slices(texts, 6 << 20):
            code, size = codes(texts[a:b])
            key = np.sort(code << 1 | np.repeat(flags[a:b], size))  # 60 bits and the flag
            new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            n = np.diff(np.concatenate([new, [len(key)]]))
            key = key[new]
            yield [(key >> 1).tolist(), np.where(key & 1, n, 0).tolist()]

    return map_batches(docs, ["x", "trusted"], run, "code long, trusted long").groupBy("code").agg(F.sum("trusted").alias("trusted"))


def _shorter(code: Column, order: int) -> Column:
    """The n-gram without its first character."""
    return code.bitwiseAND(F.lit((1 << (BITS * (order - 1))) - 1))


def _context(code: Column) -> Column:
    return F.shiftright(code, BITS)


def discounts(table: DataFrame) -> list[float]:
    """Modified discounts for counts of one, two, and three or more, from the counts of counts."""
    n = {r.c: r.n for r in table.filter("c <= 4").groupBy("c").agg(F.count("*").alias("n")).collect()}
    n1, n2, n3, n4 = (n.get(k, 0) for k in (1, 2, 3, 4))
    if not n1 or not n2:
        return [0.5, 0.5, 0.5]
    y = n1 / (n1 + 2 * n2)
    d3 = 3 - 4 * y * n4 / n3 if n3 else 1.0
    return [min(max(1 - 2 * y * n2 / n1, 0.01), 0.99), min(max(2 - 3 * y * n3 / n2, 0.01), 1.99), min(max(d3, 0.01), 2.99)]


def train(counted: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    """For each order from 1: (code, p) of seen n-grams and (context, gamma) of seen contexts."""
    tables = {ORDER: stored(counted.filter("trusted > 0").select("code", F.col("trusted").alias("c")), "ngrams")}
    for order in range(ORDER, 1, -1):  # below the highest order: how many characters come before
        tables[order - 1] = stored(tables[order].groupBy(_shorter(F.col("code"), order).alias("code")).agg(F.count("*").alias("c")), "ngrams")
    model: list[tuple[DataFrame, DataFrame]] = []
    for order in range(1, ORDER + 1):
        table = tables[order]
        d1, d2, d3 = discounts(table)
        cut = F.when(F.col("c") == 1, d1).when(F.col("c") == 2, d2).otherwise(d3)
        if order == 1:
            sums = table.agg(F.sum("c").alias("total"), F.sum(cut).alias("mass")).first()
            total, mass = (sums.total or 1), (sums.mass or 1.0)
            seen = table.select("code", ((F.col("c") - cut) / total + mass / total / (1 << BITS)).alias("p"))
            back = table.sparkSession.range(1).select(F.lit(0).cast("long").alias("context"), F.lit(mass / total).alias("gamma"))
        else:
            context = table.groupBy(_context(F.col("code")).alias("context")).agg(F.sum("c").alias("total"), F.sum(cut).alias("mass"))
            context = stored(context.withColumn("gamma", F.col("mass") / F.col("total")), "contexts")
            low = model[-1][0].select(F.col("code").alias("short"), F.col("p").alias("low"))
            joined = table.withColumn("context", _context(F.col("code"))).join(context, "context").withColumn("short", _shorter(F.col("code"), order)).join(low, "short")
            seen = stored(joined.select("code", ((F.col("c") - cut) / F.col("total") + F.col("gamma") * F.col("low")).alias("p")), "seen")
            back = context.select("context", "gamma")
        model.append((seen, back))
    return model


def look_up(wanted: DataFrame, model: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """code, lp: log probability of each wanted 5-gram's last character, by sharded joins from the longest order."""
    done, rest = None, wanted.select("code", F.col("code").alias("short"), F.lit(0.0).alias("back"))
    for order in range(ORDER, 0, -1):
        seen, back = model[order - 1]
        met = stored(rest.join(seen.select(F.col("code").alias("short"), "p"), "short", "left"), "met")
        good = met.filter("p is not null").select("code", (F.col("back") + F.log("p")).alias("lp"))
        done = good if done is None else done.union(good)
        rest = met.filter("p is null").withColumn("context", _context(F.col("short")))
        rest = rest.join(back, "context", "left").select("code", _shorter(F.col("short"), order).alias("short"), (F.col("back") + F.log(F.coalesce("gamma", F.lit(1.0)))).alias("back"))
    last = rest.select("code", (F.col("back") - float(np.log(1 << BITS))).alias("lp"))
    return stored(done.union(last).select("code", F.round(F.col("lp") * ONE).cast("long").alias("lp")), "looked-up")


def _score_shards(docs: DataFrame, known: DataFrame, columns: list[str], shard_rows: int) -> DataFrame:
    """columns, n and lp of every document; known has as many rows in a shard, more or less."""
    parts = max(1, -(-known.count() // shard_rows))
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in columns)
    scored = docs.withColumns({"n": F.lit(0).cast("long"), "lp": F.lit(0).cast("long")})
    for part in range(parts):
        own = known if parts == 1 else known.filter(F.pmod(F.xxhash64("code"), F.lit(parts)) == part)
        rows = own.toArrow()
        code, lp = np.asarray(rows.column("code")), np.asarray(rows.column("lp"))
        by = np.argsort(code)
        box = docs.sparkSession.sparkContext.broadcast((code[by], lp[by]))
        keep = [*columns, "x"] if part + 1 < parts else columns

        def run(cols, box=box, keep=keep):
            code, lp = box.value
            texts = [t or "" for t in cols[-3]]
            for a, b in slices(texts, 2 << 20):
                own, size = codes(texts[a:b])
                # sorted look-ups walk the table in order; each distinct code is looked up once
                distinct, at = np.unique(own, return_inverse=True)
                place = np.minimum(np.searchsorted(code, distinct), max(0, len(code) - 1))
                value = np.where(code[place] == distinct, lp[place], 0) if len(code) else np.zeros(len(distinct), np.int64)
                total = np.concatenate([[0], np.cumsum(value[at])])
                ends = np.cumsum(size)
                before = np.array(cols[-1][a:b], np.int64)
                yield [*(c[a:b] for c in cols[: len(keep)]), size.tolist(), (before + total[ends] - total[ends - size]).tolist()]

        scored = map_batches(scored, [*columns, "x", "n", "lp"], run, kinds + ", x string" * (len(keep) > len(columns)) + ", n long, lp long")
        if part + 1 < parts:
            scored = stored(scored, "part-scored")
            box.unpersist()
    return scored


def _score_join(docs: DataFrame, known: DataFrame, columns: list[str]) -> DataFrame:
    """The same by shuffle: counted 5-grams of each distinct (text hash) row meet the looked-up table."""

    def run(cols):
        for key, text in zip(*cols, strict=True):
            code, n = np.unique(codes([text or ""])[0], return_counts=True)
            yield [[key] * len(code), code.tolist(), n.tolist()]

    keyed = docs.withColumn("text_key", F.md5(F.coalesce("x", F.lit(""))))
    own = map_batches(keyed.dropDuplicates(["text_key"]), ["text_key", "x"], run, "text_key string, code long, k long")
    sums = own.join(known, "code").groupBy("text_key").agg(F.sum("k").alias("n"), F.sum(F.col("k") * F.col("lp")).alias("lp"))
    return keyed.join(sums, "text_key", "left").select(*columns, F.coalesce("n", F.lit(0)).cast("long").alias("n"), F.coalesce("lp", F.lit(0)).cast("long").alias("lp"))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", quantile: float = QUANTILE, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """id, lang, n_scored, perplexity, threshold, kept for every row."""
    trusted = labels.filter("quality = 1 and coalesce(toxic, 0) = 0 and doc_id is not null").select(F.col("doc_id").alias("_id")).distinct().withColumn("_t", F.lit(True))
    if labels.count() <= SMALL_LABELS:
        trusted = F.broadcast(trusted)
    rows = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("x"))
    rows = rows.join(trusted, F.col("id") == F.col("_id"), "left").select("id", "lang", "x", F.coalesce("_t", F.lit(False)).alias("trusted"))
    counted = stored(counts(rows), "counted")
    known = look_up(counted, train(counted))
    columns = ["id", "lang", "trusted"]
    scored = _score_shards(rows, known, columns, broadcast_rows) if broadcast_rows else _score_join(rows, known, columns)
    scored = stored(scored.select(*columns, F.col("n").alias("n_scored"), F.when(F.col("n") > 0, F.exp(-F.col("lp") / F.lit(float(ONE)) / F.col("n"))).alias("perplexity")), "scored")
    good = scored.filter("trusted and perplexity is not null")
    limit = F.percentile_approx("perplexity", quantile, 10_000)
    by_lang = good.filter("lang is not null").groupBy("lang").agg(limit.alias("own"))
    whole = good.agg(limit.alias("of_all"))
    by_lang = stored(by_lang, "thresholds")  # of few rows, but for a table of unbounded languages
    by_lang = F.broadcast(by_lang) if by_lang.count() <= SMALL_LABELS else by_lang
    out = scored.join(by_lang, "lang", "left").join(F.broadcast(whole), how="left")
    threshold = F.coalesce("own", "of_all")
    return out.select(F.col("id").alias(id_col), "lang", "n_scored", "perplexity", threshold.alias("threshold"), (F.col("perplexity").isNotNull() & (threshold.isNull() | (F.col("perplexity") <= threshold))).alias("kept"))
