"""Recall of the forest join against brute force, and groups whose node holds thousands of unlike texts."""

import random

import numpy as np
import pytest
from test_near_links import brute_force

from tempora.llm import minhash_forest


def edited(rng, text, edits):
    places = set(rng.sample(range(len(text)), edits))
    return [f"e{rng.randrange(10**9)}" if k in places else w for k, w in enumerate(text)]


def test_recall_near_the_threshold(spark):
    """Pairs, stars and chains whose links are mostly of similarity 0.8 to 0.85."""
    rng = random.Random(3)
    docs = []
    for _ in range(250):
        base = [f"w{rng.randrange(10**6)}" for _ in range(200)]
        texts = [base, edited(rng, base, 4)]
        if rng.randrange(2):
            texts += [edited(rng, base, 4), edited(rng, texts[-1], 3), edited(rng, texts[-1], 4)]
        docs += [(len(docs) + j, " ".join(t)) for j, t in enumerate(texts)]
    want = brute_force(docs)
    got = {r.doc_id: r for r in minhash_forest.join(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    links = sum(n for _, n, _ in want.values())
    assert links > 1000 and sum(got[k].n_links for k in want) / links > 0.998
    assert all(got[k].n_links <= want[k][1] for k in want)
    assert sum(got[k].class_id == want[k][0] for k in want) / len(want) > 0.998


def test_unlike_texts_in_one_node(spark, monkeypatch):
    """All signatures are equal, so each node holds all texts; stars and chains among 1,500 unlike ones."""
    monkeypatch.setattr(minhash_forest, "signatures", lambda value, many, n: np.zeros((int((many > 0).sum()), n), np.uint32))
    rng = random.Random(5)
    docs = [(k, " ".join(f"u{rng.randrange(10**6)}" for _ in range(30))) for k in range(1500)]
    base = [f"w{k}" for k in range(200)]
    chain = [base]
    for k in range(1, 6):
        chain.append([*(f"c{j}" for j in range(9 * k)), *base[9 * k :]])
    star = [[*base[:k], f"s{k}", *base[k + 1 :]] for k in range(100, 110)]
    docs += [(2000 + j, " ".join(t)) for j, t in enumerate([*chain, *star])]
    got = {r.doc_id: (r.class_id, r.n_links, r.n_copies) for r in minhash_forest.join(spark.createDataFrame(docs, "doc_id long, text string"), trees=2, block=600).collect()}
    assert got == brute_force(docs)


def test_prefixes_shorten_only_where_links_may_be_missing():
    assert minhash_forest.min_depth() == 4 and minhash_forest.chance(0.8, 4, 16) > minhash_forest.RECALL
    assert minhash_forest.chance(0.8, 5, 16) < minhash_forest.RECALL


@pytest.mark.parametrize("id_col", ["key", "a.b"])
def test_clashing_columns_and_null_ids(spark, id_col):
    rows = [(1, "a b c d e f"), (None, "a b c d e f"), (None, "a b c d e f"), (3, None), (4, "x" * 300_000), (5, "x" * 300_000 + " y")]
    docs = spark.createDataFrame(rows, f"`{id_col}` long, exact string")
    out = minhash_forest.join(docs, id_col, "exact").collect()
    assert len(out) == 6 and sorted(r.n_copies for r in out) == [1, 1, 1, 3, 3, 3]
