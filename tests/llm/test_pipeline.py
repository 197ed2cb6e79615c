"""The whole pipeline on a small table with planted rows, and its stages one by one on the smallest tables."""

import random

import corpus_pipeline
from tempora.llm import packing, queries

SF = "/root/testdata/sf0.001"


def words(rng, n):
    return " ".join(rng.choice("the and with that from this which they water house children morning river bridge over under".split()) for _ in range(n))


def test_stages_have_their_effect(spark, tmp_path):
    rng = random.Random(1)
    item = " ".join(f"item{k}" for k in range(14))
    base = [rng.choice("the and with that from this which they water house".split()) + rng.choice("abcdefgh") for _ in range(150)]
    near = [*base[:70], "changed", *base[71:]]
    rows = [
        (1, " ".join(base), "en"), (2, " ".join(base), "en"), (3, " ".join(near), "en"),
        (4, words(rng, 80) + " " + item + " " + words(rng, 40), "en"),
        (5, words(rng, 60) + " write to ann.b@mail.example.com or Mrs Jane Doe", "en"),
        (6, None, "en"), (7, "12345 !!", "en"), (8, words(rng, 4000), "en"), (9, words(rng, 90), "en"), (9, words(rng, 90), "en"), (None, words(rng, 70), "en"),
        *((k, words(rng, 50), "en") for k in range(20, 40)),
    ]
    docs = spark.createDataFrame([(i, t, x, "s", len(t or ""), "extra") for i, t, x in rows], "doc_id long, text string, lang string, source string, n_chars long, score string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, item), (1, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = queries.stored(stage(spark, kept, str(tmp_path)), name)
        assert kept.schema.simpleString() == docs.schema.simpleString()
        seen[name] = {(r.doc_id, r.text) for r in kept.collect()}
    before = {(i, t) for i, t, _ in rows}
    assert seen["language"] == {x for x in before if x[0] not in (6, 7)}
    assert seen["near_copies"] == {x for x in seen["language"] if x[0] not in (2, 3)}
    assert {x for x in seen["decontaminate"] if x[0] != 4} == {x for x in seen["near_copies"] if x[0] != 4}
    (cut,) = (t for i, t in seen["decontaminate"] if i == 4)
    assert "item" not in cut and len(cut.split()) == 120
    (masked,) = (t for i, t in seen["surrogates"] if i == 5)
    assert "ann.b" not in masked and "Jane" not in masked and "Doe" not in masked and masked.startswith(rows[4][1][:200])
    assert {x for x in seen["surrogates"] if x[0] != 5} == {x for x in seen["decontaminate"] if x[0] != 5}
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    encode = packing.Words(queries.tokenizer_json())
    import pyarrow as pa

    want = {}
    for i, t in seen["surrogates"]:
        want[i] = want.get(i, 0) + len(encode.encode(pa.array([t]))[0])
    got = {}
    for r in out:
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
    assert got == want


def test_pipeline_on_the_smallest_tables(spark):
    out = corpus_pipeline.run(spark, SF)
    ids = {r.doc_id for r in out.select("doc_id").distinct().collect()}
    docs = {r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert ids <= docs and len(ids) > 0.5 * len(docs)
