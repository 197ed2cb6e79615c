"""Quality rules: base counts of a text, and a linear-chain CRF that labels its lines.

Lines that hold a word form the sequence; Viterbi decoding marks each as content or boilerplate.
A text is kept if it passes the base rules and at least half of its words are in content lines.
The chain is trained on labelled texts. Their quality labels give the lines' labels: lines of good
texts are content, lines that only bad texts have are boilerplate, and so are lines that several
otherwise different texts repeat; a few fixed lines are added. Cues are a feature only.
Base counts follow words `[^\\x20\\x09-\\x0D]+`: word_chars (code points in words), n_symbols
(characters of `[#*$%&|<>]`), n_dup_lines (lines with a word that equal an earlier line) and
n_repeat_words (words in windows of eight words that occur twice or more in the text).

Defined results: null and empty texts have no words and fail the base rules; whole texts are read
whatever their length; repeated rows each give a row; other columns are not read; a share of
exactly one half keeps.
"""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempora.llm import crf
from tempora.llm.common import map_batches, slices

WINDOW = 8
MIN_WORDS = 20
REPEAT_PERCENT = 30
CONTENT_SHARE = 0.5
#: Labelled rows of each class that training reads at most, and the bytes of the largest text among them.
TRAIN_DOCS, TRAIN_BYTES = 300, 1 << 18
#: Otherwise different texts in which a line makes it boilerplate.
SHARED_BY = 3
#: Cues of lines that are no prose.
CUES = re.compile(r"cookie|licen[cs]ed? under|copyright|all rights reserved|terms of (?:use|service)|privacy|subscribe|log ?in|sign up|read more|click here|share (?:on|this)|follow us|newsletter|powered by|permission is hereby", re.I)
#: Labelled lines that every model is trained on, besides the labelled rows.
BOILERPLATE = ["Home | News | Sport | Contact", "Accept all cookies to continue", "Copyright 2020 Example Ltd. All rights reserved.", "Share this on social media", "Subscribe to our newsletter!", "Log in | Sign up", "Click here to read more >>", "### *** ### $$$ ###", "BUY NOW!! LIMITED OFFER!! CALL TODAY!!", "Terms of use | Privacy policy", "<< previous | next >>", "Follow us: #deal #win #free", "This work is licensed under the GNU General Public License, version 3.", "Licensed under the Apache License, Version 2.0."]
CONTENT = ["The river rose in the night and by morning the lower fields were under water.", "Nobody had expected the bridge to hold, but it did.", "She wrote down the figures, one after another, and compared them with the old list.", "Der Regen hörte gegen Mittag auf, und die Kinder liefen wieder hinaus.", "Le marché ouvre tôt, et les marchands arrivent avant le jour.", "La casa estaba vacía desde hacía años, pero el jardín seguía vivo.", "In spring the birds return to the island.", "It was late."]

WORD_BYTE, SYMBOL, UPPER, DIGIT, LETTER, STOP, BAR, START = (1 << k for k in range(8))
KIND = np.zeros(256, np.uint8)
for _b in range(256):
    _c = chr(_b)
    KIND[_b] = (WORD_BYTE if _b not in (32, 9, 10, 11, 12, 13) else 0) | (SYMBOL if _c in "#*$%&|<>" else 0) | (UPPER if 65 <= _b <= 90 else 0) | (DIGIT if 48 <= _b <= 57 else 0) | (LETTER if 65 <= _b <= 90 or 97 <= _b <= 122 or _b >= 0xC0 else 0) | (STOP if _c in ".,;:!?" else 0) | (BAR if _c in "|!" else 0) | (START if not 0x80 <= _b < 0xC0 else 0)
N_FEATS = 128


def _sums(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Number of set flags between successive bounds."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def _bounds(sizes: list[int]) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])


def line_features(data: np.ndarray, bounds: np.ndarray, ids: np.ndarray, repeated: np.ndarray, first: np.ndarray, cues: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(line, feature, words of each line); ids: the words' numbers."""
    kind = KIND[data]
    inside = (kind & WORD_BYTE) > 0
    starts = inside & ~np.concatenate([[False], inside[:-1]])
    words = _sums(starts, bounds)
    size = np.maximum(1, _sums(inside & ((kind & START) > 0), bounds))
    share = lambda flag: _sums((kind & flag) > 0, bounds) / size
    level = lambda x, cuts: np.searchsorted(np.array(cuts), x, side="right")
    same = np.concatenate([[False], ids[1:] == ids[:-1]])
    stutter = np.bincount(np.repeat(np.arange(len(words)), words), same, len(words)) / np.maximum(1, words)
    columns = [
        (level(words, [2, 3, 5, 9, 17]), 6),
        (level(stutter, [0.05, 0.2, 0.4]), 4),
        (level(size / np.maximum(1, words), [2, 3, 4, 5, 6, 7, 9, 12]), 9),
        (level(share(SYMBOL), [0.001, 0.02, 0.05, 0.1, 0.2]), 6),
        (level(share(UPPER), [0.01, 0.05, 0.1, 0.2, 0.4, 0.6]), 7),
        (level(share(DIGIT), [0.01, 0.05, 0.1, 0.3, 0.5]), 6),
        (level(share(LETTER), [0.3, 0.5, 0.7, 0.8, 0.9]), 6),
        (level(share(STOP), [0.001, 0.01, 0.03, 0.06, 0.1, 0.2]), 7),
        (level(share(BAR), [0.001, 0.01, 0.03, 0.06]), 5),
        (repeated.astype(np.int64), 2),
        (first.astype(np.int64), 2),
        (cues.astype(np.int64), 2),
        (np.zeros(len(words), np.int64), 1),
    ]
    at, feats = 0, []
    for values, n in columns:
        feats.append(at + values)
        at += n
    return np.tile(np.arange(len(words)), len(feats)), np.concatenate(feats), words


def lay_out(texts: list[str]) -> dict:
    """The texts' lines as one byte array, with the features of the lines that hold a word."""
    lines, owner = [], []
    for k, text in enumerate(texts):
        own = text.encode("utf-8", "replace").split(b"\n")
        lines += own
        owner += [k] * len(own)
    data = np.frombuffer(b"\n".join(lines) + b"\n", np.uint8)
    bounds = _bounds([len(x) + 1 for x in lines])
    owner = np.array(owner, np.int64)
    seen, last, repeated = set(), -1, np.zeros(len(lines), bool)
    for k, (doc, line) in enumerate(zip(owner.tolist(), lines, strict=True)):
        if doc != last:
            seen, last = set(), doc
        repeated[k] = line in seen
        seen.add(line)
    cues = np.fromiter((CUES.search(x.decode("utf-8", "replace")) is not None for x in lines), bool, len(lines))
    first = np.concatenate([[True], owner[1:] != owner[:-1]])
    vocab: dict = defaultdict()
    vocab.default_factory = vocab.__len__
    ids = np.array([vocab[w] for w in data.tobytes().split()], np.int64)
    items, feats, words = line_features(data, bounds, ids, repeated, first, cues)
    real = words > 0
    ok = real[items]
    number = np.cumsum(real) - 1
    return {"data": data, "ids": ids, "lines": lines, "owner": owner, "repeated": repeated & real, "words": words, "real": real, "items": number[items[ok]], "feats": feats[ok], "n": int(real.sum())}


def shared_lines(texts: list[str], least: int = SHARED_BY) -> set[str]:
    """Lines in at least so many texts; texts of the same longest line are copies and count once."""
    copies: dict[str, set[str]] = defaultdict(set)
    for text in texts:
        lines = {x for x in text.split("\n") if x.strip()}
        if lines:
            copies[max(lines, key=lambda x: (len(x), x))] |= lines
    count: dict[str, int] = defaultdict(int)
    for longest, lines in copies.items():
        for line in lines - {longest}:
            count[line] += 1
    return {x for x, n in count.items() if n >= least}


def train(rows: list[tuple[str, int]]) -> crf.Chain:
    """rows: (text, 1 if good)."""
    good_lines = {x for t, q in rows if q for x in t.split("\n")}
    shared = shared_lines([t for t, _ in rows])
    texts = [t for t, _ in rows] + BOILERPLATE + CONTENT
    flags = [q for _, q in rows] + [0] * len(BOILERPLATE) + [1] * len(CONTENT)
    laid = lay_out(texts)
    labels = np.zeros(laid["n"], np.int64)
    at = 0
    for line, doc, real in zip(laid["lines"], laid["owner"].tolist(), laid["real"].tolist(), strict=True):
        if real:
            text = line.decode("utf-8", "replace")
            labels[at] = (flags[doc] or text in good_lines) and text not in shared
            at += 1
    owner = laid["owner"][laid["real"]]
    counts = np.bincount(owner, minlength=len(texts))
    begin = np.cumsum(counts) - counts
    longest = 40  # a training sequence; longer texts give several
    seqs = [list(range(int(b) + k, int(b) + min(int(c), k + longest))) for b, c in zip(begin, counts, strict=True) for k in range(0, int(c), longest)]
    mask = np.array([[k < len(s) for k in range(longest)] for s in seqs])
    ids = np.array([s + [0] * (longest - len(s)) for s in seqs])
    return crf.fit(ids, mask, labels[ids], laid["items"], laid["feats"], laid["n"], N_FEATS, 2, steps=80, rate=0.2, l2=1e-3)


def repeat_words(ids: np.ndarray, owner: np.ndarray, n_docs: int, window: int = WINDOW) -> np.ndarray:
    """Per text: words in windows that occur at least twice in it."""
    n = len(ids) - window + 1
    if n < 2:
        return np.zeros(n_docs, np.int64)
    key = owner[:n].astype(np.uint64)
    for k in range(window):
        key = (key + ids[k : k + n].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    at = np.flatnonzero(owner[:n] == owner[window - 1 :])
    order = at[np.argsort(key[at], kind="stable")]
    near = np.flatnonzero(key[order[1:]] == key[order[:-1]])
    a, b = order[near], order[near + 1]
    same = owner[a] == owner[b]
    for k in range(window):
        same &= ids[a + k] == ids[b + k]
    edge = np.zeros(len(ids) + 1, np.int64)
    twice = np.unique(np.concatenate([a[same], b[same]]))
    np.add.at(edge, twice, 1)
    np.add.at(edge, twice + window, -1)
    return np.bincount(owner[np.cumsum(edge[:-1]) > 0], minlength=n_docs)


def measure(texts: list[str], chain: crf.Chain) -> dict[str, np.ndarray]:
    n = len(texts)
    laid = lay_out(texts)
    data, owner = laid["data"], laid["owner"]
    kind = KIND[data]
    sizes = np.bincount(owner, [len(x) + 1 for x in laid["lines"]], n).astype(np.int64)
    bounds = _bounds(sizes.tolist())
    inside = (kind & WORD_BYTE) > 0
    out = {"n_words": np.bincount(owner, laid["words"], n).astype(np.int64), "word_chars": _sums(inside & ((kind & START) > 0), bounds), "n_symbols": _sums((kind & SYMBOL) > 0, bounds), "n_dup_lines": np.bincount(owner, laid["repeated"], n).astype(np.int64)}
    out["n_repeat_words"] = repeat_words(laid["ids"], np.repeat(np.arange(n), out["n_words"]), n)
    real = laid["real"]
    labels = crf.viterbi(chain.emissions(laid["items"], laid["feats"], laid["n"]), np.bincount(owner[real], minlength=n), chain) if laid["n"] else np.zeros(0, np.int64)
    content = np.bincount(owner[real], labels * laid["words"][real], n)
    out["content_share"] = content / np.maximum(1, out["n_words"])
    return out


def sample(docs: DataFrame, labels: DataFrame, per_class: int = TRAIN_DOCS) -> list[tuple[str, int]]:
    """At most about `per_class` labelled texts of each class, of at most `TRAIN_BYTES`, chosen by a hash of the id."""
    known = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", "quality").distinct()
    counts = {r.quality: r.n for r in known.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return []
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) / 1_000_000
    share = F.coalesce(*(F.when(F.col("quality") == q, min(1.0, 1.3 * per_class / n)) for q, n in counts.items()))
    picked = known.filter(place < share)
    text = docs.select("doc_id", "text").filter(F.col("text").isNotNull() & (F.octet_length("text") <= TRAIN_BYTES))
    rows = text.join(F.broadcast(picked), "doc_id").orderBy(F.xxhash64("doc_id"), "text").limit(3 * per_class).collect()
    return [(r.text, int(r.quality)) for r in rows]


def judge(docs: DataFrame, chain: crf.Chain, id_col: str = "doc_id", text_col: str = "text", content_share: float = CONTENT_SHARE) -> DataFrame:
    """id, n_words, the four base counts, base_failed, kept and content_share for every row."""
    box = docs.sparkSession.sparkContext.broadcast(chain)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("x"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    schema = f"id {rows.schema['id'].dataType.simpleString()}, " + ", ".join(f"{n} long" for n in names) + ", base_failed boolean, kept boolean, content_share double"

    def run(cols):
        texts = [t or "" for t in cols[1]]
        for a, b in slices(texts):
            m = measure(texts[a:b], box.value)
            failed = (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > REPEAT_PERCENT * m["n_words"])
            kept = ~failed & (m["content_share"] >= content_share)
            yield [cols[0][a:b], *(m[k].tolist() for k in names), failed.tolist(), kept.tolist(), m["content_share"].tolist()]

    return map_batches(rows, ["id", "x"], run, schema).withColumnRenamed("id", id_col)
