"""All links of the forest join against brute force: groups with texts that are similar to one member only."""

import itertools
import random

import pytest

from tempora.llm import minhash_forest


def brute_force(docs):
    """(class, links, copies) of each row's id, over distinct word sequences."""
    seqs = {i: tuple(minhash_forest.WORD.findall((t or "").lower())) for i, t in docs}
    sets = {s: {s[k : k + 5] for k in range(max(1, len(s) - 4))} for s in set(seqs.values()) if s}
    near = {s: set() for s in sets}
    for a, b in itertools.combinations(sets, 2):
        if len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8:
            near[a].add(b)
            near[b].add(a)
    ids = {s: [i for i, x in seqs.items() if x == s] for s in sets}
    want = {i: (i, 0, 1) for i, s in seqs.items() if not s}
    for s in sets:
        group, todo = {s}, [s]
        while todo:
            new = near[todo.pop()] - group
            group |= new
            todo += new
        want |= {i: (min(j for x in group for j in ids[x]), len(near[s]), len(ids[s])) for i in ids[s]}
    return want


def core_and_outliers():
    rng = random.Random(5)
    base = [f"w{rng.randrange(5000)}" for _ in range(200)]
    edit = lambda text, places: [f"e{rng.randrange(10**6)}" if k in places else w for k, w in enumerate(text)]
    core = [edit(base, {rng.randrange(200)}) for _ in range(40)]
    outliers = [edit(core[k], set(range(7 + k, 200, 65))) for k in range(12)]
    far = [edit(outliers[k], set(range(20 + k, 200, 60))) for k in range(12)]  # similar to its outlier, hardly to the core
    texts = [*core, *outliers, *far, *([f"z{rng.randrange(5000)}" for _ in range(50)] for _ in range(10)), core[0], far[0]]
    order = list(range(len(texts)))
    rng.shuffle(order)
    return [(i, " ".join(t)) for i, t in zip(order, texts, strict=True)] + [(900, None), (901, "  "), (902, "a b"), (903, "A b!")]


@pytest.mark.parametrize("limits", [{}, {"few": 3, "block": 7}, {"few": 1000}])
def test_every_link_counts_in_groups_of_all_sizes(spark, limits):
    docs = core_and_outliers()
    out = minhash_forest.join(spark.createDataFrame(docs, "doc_id long, text string"), **limits).collect()
    want = brute_force(docs)
    assert {r.doc_id: (r.class_id, r.n_links, r.n_copies) for r in out} == want
    assert max(n for _, n, _ in want.values()) > 30 and sorted(r.doc_id for r in out if r.stays) == sorted({c for c, _, _ in want.values()})


@pytest.mark.parametrize("m", [3, 20])
def test_all_similar_texts_have_links_to_all_others(spark, m):
    base = [f"w{k}" for k in range(200)]
    docs = [(k, " ".join([*base[: 9 * k], f"e{k}", *base[9 * k + 1 :]])) for k in range(m)]
    out = minhash_forest.join(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.class_id, r.n_links) for r in out} == {k: (0, m - 1) for k in range(m)}


def test_join_of_an_empty_table(spark):
    assert minhash_forest.join(spark.createDataFrame([], "doc_id long, text string")).count() == 0
