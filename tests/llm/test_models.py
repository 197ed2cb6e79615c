"""The Kneser-Ney model, line quality and language ID against brute force and held-out texts."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tempora.llm import kneser_ney, language_id, line_quality, queries

DOC = "doc_id long, text string"
ORDER, SIZE = kneser_ney.ORDER, 1 << kneser_ney.BITS


class Plain:
    """Interpolated modified Kneser-Ney by its definition, on tuples of characters."""

    def __init__(self, texts):
        self.c = [None, *(Counter() for _ in range(ORDER))]
        for t in texts:
            padded = "\0" * (ORDER - 1) + t
            self.c[ORDER].update(padded[k : k + ORDER] for k in range(len(t)))
        for order in range(ORDER - 1, 0, -1):
            self.c[order] = Counter(g[1:] for g in self.c[order + 1])
        self.d = [None]
        for order in range(1, ORDER + 1):
            n = Counter(min(x, 5) for x in self.c[order].values())
            if n[1] and n[2]:
                y = n[1] / (n[1] + 2 * n[2])
                own = [1 - 2 * y * n[2] / n[1], 2 - 3 * y * n[3] / n[2], 3 - 4 * y * n[4] / n[3] if n[3] else 1.0]
                self.d.append([min(max(x, 0.01), k + 0.99) for k, x in enumerate(own)])
            else:
                self.d.append([0.5] * 3)
        self.by = [None] + [defaultdict(list) for _ in range(ORDER)]
        for order in range(1, ORDER + 1):
            for g, n in self.c[order].items():
                self.by[order][g[:-1]].append((g[-1], n))

    def p(self, gram):
        order = len(gram)
        if order == 0:
            return 1 / SIZE
        row = self.by[order].get(gram[:-1])
        if not row:
            return self.p(gram[1:])
        total, cut = sum(n for _, n in row), lambda n: self.d[order][min(n, 3) - 1]
        mass = sum(cut(n) for _, n in row)
        n = dict(row).get(gram[-1], 0)
        return (n - cut(n) if n else 0) / total + mass / total * self.p(gram[1:])


def corpus():
    rng = random.Random(2)
    texts = ["".join(rng.choice("aab bcé") for _ in range(rng.randrange(1, 40))) for _ in range(25)]
    return [*texts, "zzzz", "aaaa", None, "", "a" * 3000, texts[0]]


@pytest.mark.parametrize("bound", [6_000_000, 40, 0])
def test_kneser_ney_equals_its_definition(spark, bound):
    texts = corpus()
    docs = spark.createDataFrame([(k, t, "en" if k % 2 else None, 1.0) for k, t in enumerate(texts)], DOC + ", lang string, perplexity double")
    labels = spark.createDataFrame([(k, 1, 0) for k in range(20)] + [(3, 1, 0), (None, 1, 0), (21, 1, 1)], "doc_id long, quality int, toxic int")
    out = {r.doc_id: r for r in kneser_ney.classify(docs, labels, broadcast_rows=bound).collect()}
    model = Plain(texts[:20])
    for k, t in enumerate(texts):
        if t:
            padded = "\0" * (ORDER - 1) + t
            want = math.exp(-sum(math.log(model.p(padded[j : j + ORDER])) for j in range(len(t))) / len(t))
            assert math.isclose(out[k].perplexity, want, rel_tol=1e-6) and out[k].n_scored == len(t)
        else:
            assert out[k].perplexity is None and not out[k].kept
    assert len(out) == len(texts) and not out[25].kept and out[0].kept


def test_kneser_ney_sums_to_one():
    model = Plain(corpus()[:20])
    for context in ("\0\0\0\0", "\0\0\0a", "aab ", "zzzz", "bcéa"):
        seen = {g[-1] for order in range(1, ORDER + 1) for g in model.c[order]}
        total = sum(model.p(context + c) for c in seen) + (SIZE - len(seen)) * model.p(context + "☃")
        assert math.isclose(total, 1, rel_tol=1e-9)


def test_verdicts_are_the_same_for_every_bound_and_no_labels_keep_all(spark):
    docs = spark.createDataFrame([(k, t, "en") for k, t in enumerate(corpus())] * 2, DOC + ", lang string")
    labels = spark.createDataFrame([(k, 1, 0) for k in range(20)], "doc_id long, quality int, toxic int")
    one, two, three = (sorted(map(repr, kneser_ney.classify(docs, labels, broadcast_rows=b).collect())) for b in (6_000_000, 33, 0))
    assert one == two == three
    assert all(r.kept == bool(r.perplexity) for r in kneser_ney.classify(docs, labels.limit(0)).collect())
    assert kneser_ney.classify(docs.limit(0), labels).count() == 0


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = defaultdict(list)
    for k in range(len(words) - 7):
        windows[tuple(words[k : k + 8])].append(k)
    twice = {k + j for at in windows.values() if len(at) > 1 for k in at for j in range(8)}
    lines = (text or "").split("\n")
    dup = sum(bool(re.search(r"[^\x20\x09-\x0D]", x)) and x in lines[:k] for k, x in enumerate(lines))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(twice)


def test_base_counts_equal_brute_force(spark):
    rng = random.Random(4)
    parts = [*"ab c \n\t\r\x0b\x0c", "#", "*|", "é", "\U0001f642", " ", " ", "\x1c", "one two three four five six seven eight ", "x y\n"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(120))) for _ in range(400)] + [None, "", "a b c d e f g h " * 5000, "\n" * 50, texts_line()]
    rows = [(k, t, 1.5, "x") for k, t in enumerate(texts)] + [(None, texts[0], 1.5, "x")] * 2
    docs = spark.createDataFrame(rows, "n_words long, text string, kept double, x string")
    out = line_quality.judge(docs, line_quality.train([]), id_col="n_words").toDF("id", *"abcde", "failed", "kept", "share").collect()
    assert len(out) == len(rows)
    for r in out:
        want = plain_counts(texts[r.id or 0])
        assert (r.a, r.b, r.c, r.d, r.e) == want
        assert r.failed == (want[0] < 20 or 100 * want[4] > 30 * want[0]) and not (r.failed and r.kept)
    assert line_quality.judge(docs.limit(0).withColumnRenamed("n_words", "doc_id"), line_quality.train([])).count() == 0


def texts_line():
    return "same line here\nsame line here \nsame line here\n\n\n end"


def prose(rng, n):
    return " ".join(rng.choice("the river bridge morning water stood over their house near long evening light".split()) for _ in range(n)).capitalize() + "."


def test_line_labels_come_from_the_texts_and_hold_out():
    """Trained on texts with notes that no cue word marks; other texts with the same kind of lines are told apart."""
    rng = random.Random(8)
    note = "Rights reserved 1999-2024 | page 7 | no. 12"

    def text(bad):
        lines = [f"NOW {k} $$ | >> BUY {rng.randrange(99)} !!!" for k in range(6)] if bad else [prose(rng, 14) for _ in range(6)]
        return "\n".join([*lines, note] if rng.randrange(2) else lines)

    rows = [(text(k % 2), 1 - k % 2) for k in range(120)]
    assert note in line_quality.shared_lines([t for t, _ in rows]) and not line_quality.shared_lines([rows[0][0]] * 9)
    chain = line_quality.train(rows)
    held = [(text(k % 2), k % 2) for k in range(60)]
    share = line_quality.measure([t for t, _ in held], chain)["content_share"]
    assert all((s >= 0.5) == (not bad) for s, (_, bad) in zip(share, held))


LANGS = {"en": "the and with that from this which they water house children morning", "de": "der die und nicht mit wasser haus kinder morgen über schön für", "fr": "le les et avec pour maison enfants matin eau très où été"}


def spoken(rng, lang, n):
    return " ".join(rng.choice(LANGS[lang].split()) + rng.choice(["", "", "s"]) for _ in range(n))


def test_language_held_out_and_code_switched(spark):
    rng = random.Random(6)
    model = language_id.train([(spoken(rng, lang, 60), lang) for lang in LANGS for _ in range(30)])
    rows = [(k, spoken(rng, lang, 12), lang) for k, lang in enumerate(list(LANGS) * 40)]
    docs = spark.createDataFrame(rows + [(500, None, "en"), (501, "12 !", "en"), (502, spoken(rng, "de", 200_000), "de"), (None, "the and", "en")], "doc_id long, text string, lang_pred string")
    out = language_id.predict(docs.withColumnRenamed("lang_pred", "lang"), model, keep=["lang"]).collect()
    judged = [r for r in out if r.doc_id not in (500, 501)]
    assert sum(r.lang_pred == r.lang for r in judged) / len(judged) > 0.97 and all(0 <= r.score <= 1 for r in out)
    assert {(r.doc_id, r.lang_pred, r.score) for r in out if r.doc_id in (500, 501)} == {(500, "und", 0.0), (501, "und", 0.0)}
    probs, lengths = language_id.label_words(model, [" ".join([spoken(rng, "en", 8), spoken(rng, "fr", 8), spoken(rng, "de", 8)])])
    got = [model.langs[k] for k in probs.argmax(1)]
    assert lengths.tolist() == [24] and sum(a == b for a, b in zip(got, ["en"] * 8 + ["fr"] * 8 + ["de"] * 8)) >= 21
    assert np.allclose(probs.sum(1), 1)
    assert language_id.predict(docs.limit(0), model).count() == 0


def test_language_sample_keeps_every_language_and_long_texts_share(spark, monkeypatch):
    docs = spark.createDataFrame([(k, f"w{k} word", f"l{k % 230:03d}") for k in range(460)], "doc_id long, text string, lang string")
    assert len({lang for _, lang in language_id.sample(docs)}) == 230
    monkeypatch.setattr(language_id, "MOST_LANGS", 100)
    with pytest.raises(ValueError):
        language_id.sample(docs)


def test_stage_with_clashing_columns(spark):
    rng = random.Random(9)
    rows = [(k, spoken(rng, lang, 30), lang, 1.0, "x", 5) for k, lang in enumerate(list(LANGS) * 20)] + [(90, None, None, 1.0, "x", 5), (91, "123", None, 1.0, "x", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double, lang_pred string, _id int")
    left = queries.in_known_language(docs)
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == list(range(60))
    doubled = docs.union(docs.filter("doc_id < 3"))
    one = queries.one_of_each_group(doubled)
    assert one.columns == docs.columns and sorted(r.doc_id for r in one.collect()) == sorted({r[0] for r in rows})
