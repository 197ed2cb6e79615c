"""Decontaminated texts against a plain restatement, with one and with several blocks of the benchmark."""

import pytest

from tempora.llm import decontaminate


def numbered(name, first, last):
    return [f"{name}{k}" for k in range(first, last)]


#: a and b overlap by five words, as do c and d; the cut of "inner" joins the two halves of "outer"; one has no id.
ITEMS = [(1, numbered("a", 0, 10)), (2, numbered("a", 5, 15)), (None, numbered("c", 0, 10)), (None, numbered("c", 5, 15)), (5, numbered("inner", 0, 10)), (6, numbered("outer", 0, 10)), (7, ["short", "one"]), (8, numbered("x", 0, 30))]


def plain(words):
    while True:
        hit = set()
        for _, item in ITEMS:
            n = min(10, len(item))
            windows = [item[k : k + n] for k in range(len(item) - n + 1)]
            hit |= {b + j for b in range(len(words)) if words[b : b + n] in windows for j in range(n)}
        if not hit:
            return " ".join(words)
        words = [w for k, w in enumerate(words) if k not in hit]


DOCS = [
    ["p", *numbered("a", 0, 15), "q"],
    ["p", *numbered("c", 0, 15), "q"],
    ["p", *numbered("outer", 0, 4), *numbered("inner", 0, 10), *numbered("outer", 4, 10), "q"],
    ["p", *numbered("inner", 0, 5), *numbered("outer", 0, 10), *numbered("inner", 5, 10), "q"],
    ["p", *numbered("x", 3, 25), "short", "one", "q"],
    numbered("a", 0, 10),
    ["clean", "text"],
    numbered("a", 0, 9),
]


@pytest.mark.parametrize("block", [1 << 20, 150])
def test_clean_is_the_same_in_blocks(spark, block):
    rows = [(k, " ".join(d), -1, "n") for k, d in enumerate(DOCS)] + [(50, None, -1, None), (51, "", -1, None), (0, " ".join(DOCS[0]), -1, "n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars int, spans string")
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in ITEMS] + [(9, None)], "item_id long, text string")
    out = decontaminate.clean(docs, bench, block_bytes=block)
    want = [(k, t, len(t) if t != " ".join(d) else -1, "n") for k, d in [*enumerate(DOCS), (0, DOCS[0])] if (t := plain(d))]
    assert out.columns == docs.columns and sorted(map(tuple, out.collect())) == sorted(want)


@pytest.mark.parametrize("block", [1 << 20, 150])
def test_items_without_id_are_found(spark, block):
    docs = spark.createDataFrame([(1, " ".join(numbered("c", 0, 15)))], "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in ITEMS], "item_id long, text string")
    (row,) = decontaminate.find(docs, bench, block_bytes=block).collect()
    assert [(s.first, s.last) for s in row.spans] == [(0, 15)] and row["items"] == [None]
