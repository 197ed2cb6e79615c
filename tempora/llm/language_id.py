"""Language ID: a linear-chain CRF labels every word, so that code-switched text is handled.

Words are maximal runs of letters. A word's features are its character n-grams of one to four
characters with word boundaries (so affixes are among them) and the word itself (the lexicon).
Transitions between languages are learned together with these. A document's language is the one
with the largest sum of the words' forward-backward probabilities; the score is its share.

Defined results: null, empty and letterless text gives `und` and score 0; ties go to the
alphabetically first language; repeated rows each give a row; an empty table gives no rows;
without any labelled row everything is `und`; more than `MOST_LANGS` languages are an error. Other
columns of the input are not read.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempora.llm import crf
from tempora.llm.common import map_batches, slices

WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
#: Rows of each language that training reads at most (a bounded sample by hash of the id).
TRAIN_DOCS = 100
#: Languages that one model can learn.
MOST_LANGS = 1000
#: Hash buckets of the features.
BUCKETS = 1 << 16
#: Words of each language that training sequences hold, unmixed, dealt evenly over the sampled texts; as
#: many more are mixed.
TRAIN_WORDS = 12_000
#: Words of one training sequence.
SPAN = 32
#: Distinct words that a task remembers.
MEMORY = 100_000


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word number, feature bucket) of every feature of distinct, lower-cased words."""
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    text = np.frombuffer(("\x02" + "\x03\x02".join(words) + "\x03").encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 2
    begin = np.cumsum(size) - size
    word = np.repeat(np.arange(len(words)), size)
    left = np.repeat(begin + size, size) - np.arange(len(text))  # characters from here to the word's end
    items, feats = [], []
    mixed = np.zeros(len(text), np.uint64)
    for n in range(1, 5):
        mixed[: len(text) - n + 1] = (mixed[: len(text) - n + 1] + text[n - 1 :]) * np.uint64(0x9E3779B97F4A7C15)
        ok = left >= n
        items.append(word[ok])
        feats.append((mixed[ok] ^ np.uint64(n * 7919)) >> np.uint64(48))
    place = np.arange(len(text)) - np.repeat(begin, size)
    powers = np.cumprod(np.full(int(size.max()), 0x100000001B3, np.uint64))
    whole = np.add.reduceat(text * powers[place], begin) * np.uint64(0xD6E8FEB86659FD93)
    items.append(np.arange(len(words)))
    feats.append(whole >> np.uint64(48))
    return np.concatenate(items), (np.concatenate(feats) % np.uint64(BUCKETS)).astype(np.int64)


@dataclass
class Model:
    langs: list[str]
    chain: crf.Chain | None


def train(rows: list[tuple[str, str]], seed: int = 7) -> Model:
    """Learn from (text, lang) pairs. Half of the sequences switch between languages."""
    langs = sorted({lang for _, lang in rows})
    if not langs:
        return Model([], None)
    vocab: dict = defaultdict()
    vocab.default_factory = vocab.__len__
    pieces: list[list[tuple[int, int, list[int]]]] = [[] for _ in langs]
    for k, (text, lang) in enumerate(rows):
        words = [vocab[w] for w in WORD.findall((text or "").lower())]
        pieces[langs.index(lang)] += [(at, k, words[at : at + SPAN]) for at in range(0, len(words), SPAN)]
    # the first words of every text, then the next of every text: a long one doesn't fill the sample
    streams = [[w for *_, piece in sorted(p, key=lambda x: x[:2]) for w in piece] for p in pieces]
    if not vocab:
        return Model([], None)
    rng = np.random.default_rng(seed)
    seqs, labels = [], []
    have = [k for k, s in enumerate(streams) if s]
    most = max(len(streams[k]) for k in have)
    for k in have:  # languages with few words are seen as often as the others
        stream = np.resize(np.array(streams[k]), max(SPAN, min(most, TRAIN_WORDS) // SPAN * SPAN))
        seqs += list(stream[: len(stream) // SPAN * SPAN].reshape(-1, SPAN))
        labels += [np.full(SPAN, k)] * (len(stream) // SPAN)
    for _ in range(len(seqs)):
        one, lab = [], []
        while len(one) < SPAN:
            k = have[rng.integers(len(have))]
            run = int(rng.integers(3, 17))
            at = int(rng.integers(0, max(1, len(streams[k]) - run)))
            piece = streams[k][at : at + run]
            one += piece
            lab += [k] * len(piece)
        seqs.append(np.array(one[:SPAN]))
        labels.append(np.array(lab[:SPAN]))
    seqs, labels = np.stack(seqs), np.stack(labels)
    items, feats = features(list(vocab))
    chain = crf.fit(seqs, np.ones(seqs.shape, bool), labels, items, feats, len(vocab), BUCKETS, len(langs), steps=30, rate=0.1, l2=1e-5)
    chain.weights = chain.weights.astype(np.float32)
    return Model(langs, chain)


def label_words(model: Model, texts: list[str], memory: dict | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities of every word of the texts, end to end, and the number of words of each text."""
    memory = {} if memory is None else memory
    vocab = memory.get("vocab")
    if vocab is None or len(vocab) > MEMORY:
        vocab = defaultdict()
        vocab.default_factory = vocab.__len__
        memory |= {"vocab": vocab, "scores": np.zeros((0, len(model.langs)))}
    old, ids, lengths = len(vocab), [], []
    for text in texts:
        words = WORD.findall(text.lower())
        lengths.append(len(words))
        ids.extend(map(vocab.__getitem__, words))
    if len(vocab) > old:
        new = list(vocab)[old:]
        items, feats = features(new)
        memory["scores"] = np.concatenate([memory["scores"], model.chain.emissions(items, feats, len(new))])
    return crf.marginals(memory["scores"][np.array(ids, np.int64)], np.array(lengths), model.chain), np.array(lengths, np.int64)


def sample(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_lang: int = TRAIN_DOCS) -> list[tuple[str, str]]:
    """At most `per_lang` labelled rows of each language, chosen by a hash of the id, whole texts.

    The cut by hash keeps the reading distributed; only the sample reaches the driver.
    """
    known = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).cast("string").alias("i"), F.col(text_col).alias("x"), F.col(lang_col).alias("l"))
    counts = {r.l: r.n for r in known.groupBy("l").agg(F.count("*").alias("n")).limit(MOST_LANGS + 1).collect()}
    if len(counts) > MOST_LANGS:
        raise ValueError(f"more than {MOST_LANGS} languages")
    if not counts:
        return []
    place = F.pmod(F.xxhash64("i", "l"), F.lit(1_000_000)) / 1_000_000
    share = F.coalesce(*(F.when(F.col("l") == lang, min(1.0, 1.3 * per_lang / n)) for lang, n in counts.items()), F.lit(0.0))
    rows = known.filter(place < share).withColumn("p", place).orderBy("p", "i").limit(2 * per_lang * len(counts)).collect()
    out, seen = [], defaultdict(int)
    for r in rows:
        seen[r.l] += 1
        if seen[r.l] <= per_lang:
            out.append((r.x, r.l))
    return out


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """id, `keep` columns, lang_pred, score, n_words and each language's share of words, for every row."""
    spark = docs.sparkSession
    box = spark.sparkContext.broadcast(model)
    kept = list(dict.fromkeys([id_col, *(keep or [])]))
    columns = kept if text_col in kept else [*kept, text_col]
    at = columns.index(text_col)
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept) + ", lang_pred string, score double, n_letter_words long, lang_shares map<string,double>"

    memory: dict = {}

    def run(cols):
        model = box.value
        texts = [t or "" for t in cols[at]]
        for a, b in slices(texts, 1 << 19):
            langs, scores, shares, counts = [], [], [], [0] * (b - a)
            if model.chain is not None:
                probs, lengths = label_words(model, texts[a:b], memory)
                counts = lengths.tolist()
                ends = np.cumsum(lengths)
                total = np.concatenate([np.zeros((1, len(model.langs))), np.cumsum(probs, 0)])
                mean = (total[ends] - total[ends - lengths]) / np.maximum(1, lengths)[:, None]
            for k in range(b - a):
                if counts[k]:
                    best = int(mean[k].argmax())
                    langs.append(model.langs[best])
                    scores.append(min(1.0, max(0.0, float(mean[k, best]))))
                    shares.append([(x, float(y)) for x, y in zip(model.langs, mean[k], strict=True)])
                else:
                    langs.append("und")
                    scores.append(0.0)
                    shares.append([])
            yield [*(c[a:b] for c in cols[: len(kept)]), langs, scores, counts, shares]

    return map_batches(docs, [f"`{c}`" for c in columns], run, schema)
