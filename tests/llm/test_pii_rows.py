"""Surrogates of whole tables: long secrets, persons within and across documents, clashes, all kinds of rows."""

import random
import re
import time

from tempora.llm import pii

NAMES = "Mrs Jane Doe met Dr Jane Doe. Later Mrs Doe wrote to Mr John Roe; Jane Doe and Doe agreed, Roe did not. Doerr stayed."


def new_of(text, seed=b"k"):
    return pii.replace(text, seed, b"n", 3)


def test_mentions_of_one_person_share_one_surrogate():
    out, made = new_of(NAMES)
    whole = {v: n for _, v, n in made}
    given, last = whole["Jane Doe"].split(" ")
    assert given in pii.GIVEN["f"] and whole["Doe"] == last and whole["John Roe"].split(" ")[0] in pii.GIVEN["m"]
    assert whole["Roe"] == whole["John Roe"].split(" ")[1] != last
    assert out.count(whole["Jane Doe"]) == 3 and not re.search(r"\b(Jane|Doe|Roe|John)\b", out) and "Doerr stayed" in out
    assert new_of("Mrs Jane Doe")[0] == "Mrs " + whole["Jane Doe"]


def test_two_persons_of_one_surname_stay_apart():
    _, made = new_of("Mr John Doe and Mrs Jane Doe; Mr Doe left, Mrs Doe stayed, Dr Doe came.")
    by = [(v, n) for _, v, n in made]
    john, jane = dict(by)["John Doe"], dict(by)["Jane Doe"]
    assert john != jane and john.split()[1] != jane.split()[1]


def test_long_secrets_end_soon_and_stay_distinct():
    rng = random.Random(1)
    key = "".join(rng.choice("abcXYZ0189+/") for _ in range(1_000_000))
    began = time.time()
    one, two = (new_of(f"token = {x} end")[0] for x in (key, key[:-1] + ("a" if key[-1] != "a" else "b")))
    assert time.time() - began < 60 and len(one) == len(two) == len(key) + 12 and one != two and key[:40] not in one
    short = "Ab1" * 1700
    assert new_of(f"k={short}")[0] != f"k={short}" and new_of(f"k={short}") == new_of(f"k={short}")


def test_blocks_are_a_permutation(monkeypatch):
    monkeypatch.setattr(pii, "BLOCK", 2)
    values = [f"{k:04d}" for k in range(10_000)]
    new = [pii.surrogate(b"k", "phone", v) for v in values]
    assert sorted(new) == values and all(a != b for a, b in zip(values, new))


def test_addresses_of_both_versions():
    out, made = new_of("from 2001:db8::ff00:42:8329 and fe80:0:0:0:1:2:3:4 at 12:30:45, C++ std::vector and a::b, 10.0.0.1")
    assert [k for k, _, _ in made] == ["ipv6", "ipv6", "ip"] and "12:30:45" in out and "std::vector and a::b" in out


def test_no_entity_is_without_what_entities_need():
    rng = random.Random(7)
    parts = [*"ab AF09-_.:@+/=()", "sk-", "ghp_", "AKIA", "dead:", "::", "٣", "é@ü.de", "abcdefghijklmnopqrst", "ABCDEFGHIJKLMNOP", "GB12", " 1234", "fe80:"]
    found = 0
    for _ in range(20_000):
        for m in pii.ENTITY.finditer("".join(rng.choice(parts) for _ in range(rng.randrange(2, 14)))):
            assert pii.NEEDED.search(m[0])
            found += 1
    assert found > 500


def test_whole_table(spark):
    texts = [NAMES, None, "", "plain text", "mail a.b@c.example.com now", "mail a.b@c.example.com now", "token = " + "aB3" * 60_000, "call +1 (212) 555-0100"]
    rows = [(k if k != 3 else None, t, -1, "keep", 7, "c") for k, t in enumerate(texts)] + [(0, NAMES, -1, "keep", 7, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, pii_entities string, c0 int, `a.b` string")
    out = pii.anonymise(docs, b"k")
    assert out.schema.simpleString() == docs.schema.simpleString()
    name_key, syllables = pii.name_plan(docs, "text", b"k")
    want = []
    for row in rows:
        text, made = pii.replace(row[1], b"k", name_key, syllables) if row[1] else (row[1], [])
        want.append((row[0], text, len(text) if made else -1, *row[3:]))
    assert sorted(map(repr, map(tuple, out.collect()))) == sorted(map(repr, want))
    told = pii.anonymise(docs, b"k", report=True)
    assert [r.pii_entities for r in told.filter("doc_id = 0").collect()] == [7, 7] and "pii_types" in told.columns
    assert pii.anonymise(docs.limit(0), b"k").count() == 0


def test_surnames_never_clash(spark):
    names = [f"Mrs Ann {a}{b}son" for a in "BCDFGHJKLMNP" for b in ("al", "el", "il", "ol", "ul", "ar", "er")]
    docs = spark.createDataFrame(list(enumerate(names)), "doc_id long, text string")
    out = [r.text for r in pii.anonymise(docs, b"k").collect()]
    assert len({t.rsplit(" ", 1)[1] for t in out}) == len(names)
