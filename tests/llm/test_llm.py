"""The corpus operators against brute force and exact round trips, with nulls, empty and repeated rows."""

import itertools
import random
import re

import numpy as np

from tempora.llm import crf, decontaminate, html_extract, kneser_ney, language_id, line_quality, minhash_forest, packing, pii, sharding, url_filter

DOC = "doc_id long, text string"


def words(seed, n, vocab=60):
    rng = random.Random(seed)
    return [f"w{rng.randrange(vocab)}" for _ in range(n)]


def test_marginals_and_viterbi_equal_enumeration():
    rng = np.random.default_rng(1)
    chain = crf.Chain(np.zeros((1, 3)), rng.normal(size=(3, 3)), rng.normal(size=3))
    lengths, scores = [5, 0, 1, 4], rng.normal(size=(10, 3))
    at, probs, best = 0, np.zeros((10, 3)), []
    for n in lengths:
        total, top = 0.0, (-1e9, ())
        for path in itertools.product(range(3), repeat=n):
            s = sum(scores[at + k, y] for k, y in enumerate(path)) + (chain.start[path[0]] if n else 0) + sum(chain.trans[a, b] for a, b in itertools.pairwise(path))
            total += np.exp(s)
            top = max(top, (s, path))
            for k, y in enumerate(path):
                probs[at + k, y] += np.exp(s)
        if n:
            probs[at : at + n] /= total
        best += top[1]
        at += n
    assert np.allclose(crf.marginals(scores, np.array(lengths), chain, block=2), probs, atol=1e-6)
    assert crf.viterbi(scores, np.array(lengths), chain).tolist() == best


def test_html(spark):
    html = "<html><head><title>t</title></head><body><nav><a href='/'>Home</a></nav><article><h1>A  &amp; B</h1><p>One two three four five.<p>Six seven eight nine ten.</article><script>var x='</p>'</script><footer>&copy; x</footer></body></html>"
    rows = [(1, "u", html), (2, None, None), (3, "u", ""), (1, "u", html)]
    out = html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert [r.text for r in out] == ["A & B\nOne two three four five.\nSix seven eight nine ten.", "", "", "A & B\nOne two three four five.\nSix seven eight nine ten."]


def test_decontamination_equals_brute_force(spark):
    items = [(k, " ".join(words(k, 12 if k % 3 else 4))) for k in range(6)] + [(9, None), (10, "")]
    docs = [(k, " ".join(words(100 + k, 40) + (items[k % 6][1].split()[:11] if k % 2 else []) + words(200 + k, 20))) for k in range(30)] + [(50, None), (51, ""), (1, items[1][1] * 2)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    for block in (1 << 20, 40):
        got = sorted((r.doc_id, r.n_words, sum(s.last - s.first for s in r["spans"]), tuple(r["items"])) for r in decontaminate.find(spark.createDataFrame(docs, DOC), bench, block_bytes=block).collect())
        want = []
        for d, text in docs:
            w, hit, its = re.findall("[a-z0-9]+", (text or "").lower()), set(), set()
            for i, t in items:
                x = re.findall("[a-z0-9]+", (t or "").lower())
                n = min(10, len(x))
                for a in range(len(x) - n + 1 if n else 0):
                    for b in range(len(w) - n + 1):
                        if w[b : b + n] == x[a : a + n]:
                            hit |= set(range(b, b + n))
                            its.add(str(i))
            want.append((d, len(w), len(hit), tuple(sorted(its))))
        assert got == sorted(want)


def test_sharding_fits_and_one_hash_overflows(spark):
    rows = [(k, "x" * (k % 40)) for k in range(300)] + [(7, "y" * 30)] * 50 + [(None, None), (500, "z" * 500)]
    out = sharding.shard(spark.createDataFrame(rows, DOC), limit=200).collect()
    size = {}
    for r in out:
        size[r["shard"]] = size.get(r["shard"], 0) + r.n_bytes
    assert len(out) == len(rows) and all(v <= 200 or v == 500 for v in size.values())
    assert sharding.shard(spark.createDataFrame([], DOC)).count() == 0


def test_join_finds_all_similar_texts(spark):
    base = words(1, 80, 1000)
    docs = [(k, " ".join(base[:j] + [f"q{k}"] + base[j + 1 :])) for k, j in enumerate([3, 40, 78])] + [(10, " ".join(words(9, 80, 1000))), (11, " ".join(base)), (11, " ".join(base)), (12, None), (13, ""), (14, "a b"), (15, "A  b!")]
    got = {r.doc_id: r.class_id for r in minhash_forest.join(spark.createDataFrame(docs, DOC)).collect()}
    assert got == {0: 0, 1: 0, 2: 0, 11: 0, 10: 10, 12: 12, 13: 13, 14: 14, 15: 14}


def test_kneser_ney_sums_to_one_and_both_ways_agree(spark):
    docs = spark.createDataFrame([(k, " ".join(words(k, 30, 5)), "en") for k in range(20)] + [(30, "#### $$$$ ####", "en"), (31, None, "en"), (32, "", None)], DOC + ", lang string")
    labels = spark.createDataFrame([(k, 1, 0) for k in range(20)], "doc_id long, quality int, toxic int")
    one = {r.doc_id: r for r in kneser_ney.classify(docs, labels).collect()}
    two = {r.doc_id: r for r in kneser_ney.classify(docs, labels, broadcast_rows=0).collect()}
    assert all(abs((one[k].perplexity or 0) - (two[k].perplexity or 0)) < 1e-3 for k in one)
    assert not one[30].kept and not one[31].kept and one[0].kept


def test_language_learns(spark):
    rows = [("the cat and the dog", "en"), ("der hund und die katze", "de")] * 20
    model = language_id.train(rows)
    out = language_id.predict(spark.createDataFrame([(1, "the dog and the cat"), (2, None), (3, "123"), (4, "die katze und der hund")], DOC), model).orderBy("doc_id").collect()
    assert [r.lang_pred for r in out] == ["en", "und", "und", "de"] and out[1].score == 0


def test_line_counts(spark):
    text = "a b c d e f g h\na b c d e f g h\n\n# x"
    m = line_quality.measure([text, ""], line_quality.train([]))
    assert [m[k].tolist() for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")] == [[18, 0], [18, 0], [1, 0], [1, 0], [16, 0]]


def test_urls(spark):
    urls = ["https://x.com/a", "http://Example.com/en/1?q", "http://www.example.com/en/", "http://a.net/es/1", None, "nourl", "http://casino-win.example.org/en/1", "http://a.com"]
    out = url_filter.judge(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), url_filter.train(url_filter.labelled(spark))).orderBy("page_id").collect()
    assert [(r.rule, r.verdict) for r in out][:7] == [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), (None, "allow"), (None, "allow"), (None, "block")]
    assert out[7].rule is None and out[1].host == "example.com"


def test_pii_is_distinct_coreferent_and_leaves_the_rest():
    text = "Mail ann.b@mail.example.com or ann.b@mail.example.com, card 4111111111111111, ip 10.0.0.1, call +1 (212) 555-0100. Mrs Jane Doe and Mr John Roe."
    out, made = pii.replace(text, b"k", b"n", 2)
    by = {}
    for _, value, new in made:
        assert by.setdefault(value, new) == new and value not in out
    assert len(set(by.values())) == len(by) and pii._luhn(by["4111111111111111"][:-1]) == int(by["4111111111111111"][-1])
    assert pii.replace("plain text", b"k", b"n", 2)[0] == "plain text"
    assert sorted(pii.exchange(b"k", "t", x, 100) for x in range(100)) == list(range(100)) and all(pii.exchange(b"k", "t", x, 100) != x for x in range(100))


def test_packing_covers_every_token():
    rng = np.random.default_rng(3)
    docs = [rng.integers(0, 500, n).astype("<u2") for n in (1, 5000, 30, 2048, 700, 1, 1500)]
    seqs = packing.pack_shard(docs, np.ones(1 << 16), 1000.0)
    seen = [np.zeros(len(d), int) for d in docs]
    for s in seqs:
        assert sum(p[2] for p in s) <= 2048
        for k, a, n in s:
            seen[k][a : a + n] += 1
    assert all((x == 1).all() for x in seen) and sum(sum(p[2] for p in s) < 2048 for s in seqs) <= 1
