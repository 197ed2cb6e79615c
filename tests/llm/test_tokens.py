"""Token alignment and guessed BPE against the tokenizers themselves."""

import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tempora.llm import bpe, queries, token_alignment

WORDS = queries.tokenizer_json()
A_JSON = queries.tokenizer_json(public_tokenizers.path("byte_bpe_50k.json"))
B_MODEL = open(public_tokenizers.path("piece_bpe_32k.model"), "rb").read()
LETTERS = "abeinorst'üßçж漢é̂ǅİ0159 \n\t 　-_.!<|>"


def odd_texts(n, letters, most, seed=5):
    draw = random.Random(seed)
    return ["".join(draw.choice(letters) for _ in range(draw.randint(0, most))) for _ in range(n)]


def texts_of(spark):
    return [r.text or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]


def test_guess_and_check_equals_the_library(spark):
    cases = texts_of(spark) + odd_texts(400, LETTERS, 70) + ["x" * 3000, "ab" * 2000, "<|endoftext|>", "a<|startoftext|>b's", "The" * 300 + "!" * 200, "\x00\x01", "I'LL it's 'S", "漢" * 300, " \n "]
    rows = [(k, t, None) for k, t in enumerate(cases)] + [(len(cases), None, None), (0, cases[0], None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(3)
    found = bpe.decode(bpe.encode(docs, WORDS), WORDS).collect()
    library = Tokenizer.from_str(WORDS)
    assert len(found) == len(rows)
    for r in found:
        want = library.encode(cases[r.doc_id] if r.doc_id < len(cases) else "", add_special_tokens=False).ids
        assert r.ids == want
        assert r.decoded == library.decode(want, skip_special_tokens=False)


def test_only_crossed_seams_are_merged_anew(spark):
    encoder = bpe.Encoder(WORDS)
    words = sorted({w + bpe.WORD_END for t in odd_texts(800, "abeinorst", 12, 8) if (w := t)})
    found, failed = encoder.merges.encode(words)
    assert 0 < failed < len(words)
    assert found == [encoder.merges.merge(w) for w in words]
    right = sum(encoder.merges.guess(w) == f for w, f in zip(words, found, strict=True))
    assert right == len(words) - failed  # no right guess is thrown away


def test_decode_keeps_columns_and_nulls(spark):
    rows = spark.createDataFrame([([320, 49407], "a"), (None, "b"), ([], "c")], "ids array<int>, decoded string")
    found = [tuple(r) for r in bpe.decode(rows, WORDS).collect()]
    assert found == [([320, 49407], "a", "a</w> <|endoftext|>"), (None, "b", None), ([], "c", "")]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.encode(empty, WORDS).count() == 0


def brute_alignment(rows):
    pair = token_alignment.Pair(A_JSON, B_MODEL)
    a_of, b_of = Tokenizer.from_str(A_JSON), sentencepiece.SentencePieceProcessor(model_proto=B_MODEL)
    a_of.encode_special_tokens = True
    letters = bpe.byte_letters()
    out, links = {}, {}
    for key, text in rows:
        data = b" " + (text or "").encode()
        a = a_of.encode(data.decode(), add_special_tokens=False)
        a_bytes = [bytes(ord(letters[c]) for c in t) for t in a.tokens]
        b_ids = b_of.encode(text or "")
        b_bytes = [pair.b_bytes[i] for i in b_ids]
        a_ids = a.ids
        if not text or b"".join(a_bytes) != data or b"".join(b_bytes) != data:
            a_ids, b_ids, a_bytes, b_bytes = [], [], [], []
        ends = [{sum(map(len, x[: k + 1])): k + 1 for k in range(len(x))} for x in (a_bytes, b_bytes)]
        cuts = [(0, 0)] + [(ends[0][e], ends[1][e]) for e in sorted(ends[0].keys() & ends[1].keys())]
        groups = [(a_ids[p[0] : q[0]], b_ids[p[1] : q[1]]) for p, q in zip(cuts, cuts[1:])]
        links[key] = Counter((x, y) for g, h in groups for x in g for y in h)
        out[key] = [len(a_ids), len(b_ids), len(groups), sum(links[key].values()), ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)]
    held, most = Counter(p for x in links.values() for p in x), defaultdict(int)
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    return {k: (*out[k], sum(n for p, n in x.items() if held[p] == most[p[0]]), sum(n * held[p] for p, n in x.items())) for k, x in links.items()}


@pytest.mark.parametrize("chunk_tokens", [token_alignment.CHUNK_TOKENS, 500])
def test_alignment_equals_brute_force(spark, chunk_tokens):
    cases = [t[:4000] for t in texts_of(spark)[:60]] + odd_texts(120, "ab  \n\t漢é🙂=-▁\x00'stre", 60) + ["<|endoftext|> x", "<0x41>", "=" * 999, " " * 500 + "a", "ﬁ №", "▁", "a b", "a b"]
    rows = [(k, t) for k, t in enumerate(cases)] + [(len(cases), None)]
    docs = spark.createDataFrame([(k, t, 0) for k, t in rows], "doc_id long, text string, chunk int").repartition(3)
    found = {r.doc_id: r for r in token_alignment.align(docs, A_JSON, B_MODEL, chunk_tokens=chunk_tokens).collect()}
    want = brute_alignment(rows)
    assert len(found) == len(rows)
    for k, w in want.items():
        r = found[k]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.groups, r.n_best, r.count_sum) == w, cases[k] if k < len(cases) else None
    hashed = {r.doc_id: r.groups for r in token_alignment.align(docs, A_JSON, B_MODEL, as_text=False).collect()}
    assert all(hashed[k] == (hashlib.sha256(w[4].encode()).hexdigest() if w[0] else "") for k, w in want.items())


def test_long_groups_are_counted_not_written_out():
    import numpy as np

    draw = np.random.default_rng(2)
    a, b = draw.integers(0, 5, 300), draw.integers(0, 4, 200)
    doc, code, links = token_alignment.linked(np.zeros(300, int), a, np.zeros(200, int), b, np.array([7]))
    want = Counter((int(x) << 16 | int(y)) for x in a for y in b)
    assert dict(zip(code.tolist(), links.tolist(), strict=True)) == want and set(doc.tolist()) == {7}


def test_alignment_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    found = token_alignment.align(empty, A_JSON, B_MODEL)
    assert found.count() == 0 and found.columns[:2] == ["doc_id", "n_a"]
    nothing = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string").withColumn("n", F.lit(1))
    assert {(r.n_a, r.n_links, r.groups, r.count_sum) for r in token_alignment.align(nothing, A_JSON, B_MODEL).collect()} == {(0, 0, "", 0)}


def test_no_stored_row_of_an_alignment_holds_a_chunk(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    docs = spark.range(0, 6000, 1, 1).select(F.col("id").alias("doc_id"), F.concat_ws(" ", *(F.translate(F.substring(F.md5(F.concat("id", F.lit(f"/{k}"))), 1, 6), "0123456789", letters[10:20]) for k in range(20))).alias("text"))
    made = token_alignment.chunks(docs, A_JSON, B_MODEL, "doc_id", "text", False, token_alignment.CHUNK_TOKENS).collect()
    assert sum(r.first is None for r in made) == 6000 and len({r.chunk for r in made}) == 1
    blocks = [r for r in made if r.first is not None]
    assert len(blocks) > 1 and max(len(r.codes) for r in blocks) <= token_alignment.BLOCK
    assert max(len(r.at) for r in made if r.first is None) < 200
