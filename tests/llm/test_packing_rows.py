"""Packed rows of a table against the tokenizer itself: every id once, sums, offsets, padding, all kinds of rows."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tempora.llm import packing, queries

TEXTS = ["The cat's cradle, 12 of 34!", None, "", " \n\t", "\U0001f642 emoji ﬁ ligature İstanbul ΣΑΣ", "a" * 300 + " " + "b1" * 90, "<|endoftext|> inside", "the same text again", "the same text again", "Über größe ñandú 3½ x²", "don't 's 'll !'s"]


def rows_of(spark, kind):
    long = " ".join(f"word{k % 997} and" for k in range(9000))
    texts = [*TEXTS, long, *(f"filler number {k} on rivers and mountains " * (k % 30) for k in range(150))]
    return spark.createDataFrame([(k if k != 5 else None, t, "x", 1) for k, t in enumerate(texts)] + [(7, TEXTS[7], "x", 1)], f"doc_id {kind}, text string, ids string, sequence_id int")


@pytest.mark.parametrize("kind", ["long", "int"])
def test_every_id_is_packed_once(spark, kind):
    docs = rows_of(spark, kind)
    out = packing.pack(docs, queries.tokenizer_json(), shard_tokens=20_000).collect()
    whole = Tokenizer.from_str(queries.tokenizer_json())
    want, got = {}, {}
    for r in docs.collect():
        want.setdefault(r.doc_id, []).append([*whole.encode(r.text or "", add_special_tokens=False).ids, 1])
    by_seq = {}
    for r in out:
        got.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    assert got.keys() == want.keys()
    for k, pieces in got.items():
        ids, pieces = want[k][0], sorted(pieces, key=lambda r: (r.start, r.length))
        assert all(x == ids for x in want[k])
        covered = np.zeros(len(ids), int)
        for r in pieces:
            covered[r.start : r.start + r.length] += 1
            assert r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
        assert (covered == len(want[k])).all()
    short = 0
    for pieces in by_seq.values():
        pieces.sort(key=lambda r: r.offset)
        assert [r.offset for r in pieces] == [sum(p.length for p in pieces[:j]) for j in range(len(pieces))]
        filled = sum(r.length for r in pieces)
        assert filled <= 2048 and all(r.padded_to >= filled and r.padded_to in (2048, 1 << (filled - 1).bit_length()) for r in pieces)
        short += filled < 2048
    total = sum(len(x) for v in want.values() for x in v)
    assert short <= total // 20_000 + 4


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), queries.tokenizer_json()).count() == 0


def test_ids_equal_the_tokenizer_on_odd_texts():
    import random

    rng = random.Random(3)
    parts = [*"abc ABC .,!\n\t\r éüßñ 1234 #$%'  \x00İſǄ²½", "<|endoftext|>", "ﬁ", "中文", "\U0001f642", "'s", "Ⱥ", "é", "Σ", "ΑΣ"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(60))) for _ in range(4000)]
    whole, words = Tokenizer.from_str(queries.tokenizer_json()), packing.Words(queries.tokenizer_json())
    ids, size = words.encode(pa.array(texts))
    at = 0
    for t, n in zip(texts, size.tolist(), strict=True):
        assert ids[at : at + n].tolist() == [*whole.encode(t, add_special_tokens=False).ids, 1]
        at += n


def test_similar_documents_meet_wherever_they_lie(spark):
    """Pairs on a rare subject are stored far apart, over many partitions; shards hold a small part of the table."""
    rng = np.random.default_rng(5)
    common = [f"common{k}" for k in range(300)]
    subjects = ["volcano", "cathedral", "submarine", "orchid", "violin", "glacier", "parliament", "dinosaur", "telescope", "espresso", "pyramid", "lighthouse"]
    texts = [" ".join([*rng.choice(common, 120), *[subjects[k % len(subjects)]] * 9]) for k in range(360)]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string").repartition(16, "doc_id")
    out = packing.pack(docs, queries.tokenizer_json(), shard_tokens=25_000).collect()
    seqs = {}
    for r in out:
        seqs.setdefault(r.sequence_id, set()).add(r.doc_id % len(subjects))
    assert sum(map(len, seqs.values())) / len(seqs) < 2.5


def test_a_known_word_is_looked_up_once():
    """Each distinct word of a slice costs one look-up once it is known; ids are those of the tokenizer."""
    import pyarrow as pa
    from tokenizers import Tokenizer

    from tempora.llm import packing, queries

    words = packing.Words(queries.tokenizer_json())
    asked = []

    class Counting(packing.Known):
        def __getitem__(self, word):
            asked.append(word)
            return super().__getitem__(word) if word in self.keys() else -1

        def __contains__(self, word):
            asked.append(word)
            return super().__contains__(word)

    texts = ["The cat and the Cat, \u0130stanbul x" + "y" * 90, "", "the \u0130stanbul cat 42 it's"]
    whole = Tokenizer.from_str(queries.tokenizer_json())
    want = [e.ids + [packing.END] for e in whole.encode_batch(texts, add_special_tokens=False)]
    words.words = Counting()
    for _ in range(2):
        asked.clear()
        ids, size = words.encode(pa.array(texts))
        assert [len(w) for w in want] == size.tolist() and ids.tolist() == sum(want, [])
    known = [w for w in asked if len(w) <= packing.LONG]
    assert len(known) == len(set(known))
