"""BPE encoding and decoding by guess and check.

Words are looked up once each and remembered. A new word is first cut greedily into the longest
tokens. That guess is right exactly if every token stands for its own characters and no merge of the
training crosses the seam of two neighbours, so each seam is checked by itself, those of all new words
at once by numpy: the tokens that end at the seam, one inside the other, against those that begin
there. A merge of rank m crosses if neither side has been used up before it, in the left token by a
merge of at most rank m (of equal ones the left comes first), in the right one by one under m. Only
words with a crossed seam are merged pair by pair, in order of rank.

Blanks, letters, numbers and signs are told apart by `packing.Words`; chunks that need normalizing go
through the description's own normalizer and word rules, and special tokens in texts are tokens.

Defined results: null and empty texts have no ids; repeated rows are encoded each; a word of any length
is one word; an empty table gives no rows; other columns are not read by `encode` and kept by `decode`,
which gives null for null and joins the tokens as the description's decoder does (by blanks if it has none).
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tempora.llm.common import release, with_batches_of
from tempora.llm.packing import CUT_BYTES, TEXT_ROWS, Words, runs

NEVER = np.int64(1) << 40
#: The end of a word, as a symbol after its bytes.
WORD_END = chr(256)


def byte_letters() -> dict[str, str]:
    """The letter that stands for each byte in the vocabulary, and the byte as a character."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): chr(b) for b in shown} | {chr(256 + k): chr(b) for k, b in enumerate(hidden)}


class Merges:
    """Tables of a BPE model over words of byte symbols that end with `WORD_END`."""

    def __init__(self, model: dict):
        vocab, suffix = model["vocab"], model["end_of_word_suffix"]
        byte = byte_letters()
        self.size = size = max(vocab.values()) + 1
        self.left, self.right, self.rank = np.full(size, -1), np.full(size, -1), np.full(size, -1)
        pairs = [(vocab[a], vocab[b], vocab[a + b]) for a, b in (m if isinstance(m, list) else m.split(" ") for m in model["merges"])]
        self.pairs = {(a, b): (k, c) for k, (a, b, c) in reversed(list(enumerate(pairs)))}
        key = np.array([a * size + b for a, b, _ in pairs])
        self.by = np.argsort(key, kind="stable")
        self.key = key[self.by]
        made = np.zeros(size, np.int64)
        for k, (a, b, c) in enumerate(pairs):
            self.left[c], self.right[c], self.rank[c] = a, b, k
            made[c] += 1
        parts = self.rank >= 0
        # what the check of seams needs: one merge a token, later than those of its parts, and none across its own seam
        sure = made <= 1
        sure[parts] &= (self.rank[self.left[parts]] < self.rank[parts]) & (self.rank[self.right[parts]] < self.rank[parts])
        sure[parts] &= ~self.crossed(self.left[parts], self.right[parts], inside=True)
        for c in np.flatnonzero(parts)[np.argsort(self.rank[parts])]:
            sure[c] &= sure[self.left[c]] and sure[self.right[c]]
        self.sure = sure
        self.base = {}
        #: Of (node << 9 | symbol) the next node; the token of a node, -1 for none.
        self.next, self.token = {}, [-1]
        for word, number in vocab.items():
            ended = word.endswith(suffix) and len(word) > len(suffix)
            symbols = "".join(byte[c] for c in (word.removesuffix(suffix) if ended else word)) + WORD_END * ended
            if number not in self.base and not parts[number]:
                self.base[symbols] = number
            node = 0
            for c in symbols:
                step = node << 9 | ord(c)
                if step not in self.next:
                    self.next[step] = len(self.token)
                    self.token.append(-1)
                node = self.next[step]
            self.token[node] = number

    def rank_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of the merges of tokens a and b, `NEVER` where there is none."""
        want = a * self.size + b
        at = np.minimum(np.searchsorted(self.key, want), len(self.key) - 1)
        return np.where(self.key[at] == want, self.by[at], NEVER)

    def crossed(self, a: np.ndarray, b: np.ndarray, inside: bool = False) -> np.ndarray:
        """Whether a merge crosses the seam between tokens a and b; `inside` one token, its last merge is none."""
        bad = np.zeros(len(a), bool)
        x, x_until, first = a, np.full(len(a), NEVER), inside
        live = np.arange(len(a))
        while len(live):
            y, y_until, here = b[live], np.full(len(live), NEVER), np.arange(len(live))
            while len(here):
                m = self.rank_of(x[here], y[here])
                if not first:
                    bad[live[here]] |= (m < x_until[here]) & (m <= y_until[here])
                first = False
                y_until[here] = self.rank[y[here]]
                y[here] = self.left[y[here]]
                here = here[y[here] >= 0]
            x_until, x = self.rank[x], self.right[x]
            live, x, x_until = live[x >= 0], x[x >= 0], x_until[x >= 0]
        return bad

    def guess(self, word: str) -> list[int]:
        """The longest tokens from the left; none may leave the end of the word alone."""
        out, at, last, following, token = [], 0, len(word) - 1, self.next, self.token
        while at <= last:
            node, best, end, k = 0, -1, at, at
            while k <= last and (node := following.get(node << 9 | ord(word[k]), -1)) >= 0:
                k += 1
                if token[node] >= 0 and k != last:
                    best, end = token[node], k
            if best < 0:
                return []
            out.append(best)
            at = end
        return out

    def merge(self, word: str) -> list[int]:
        """Merges pair by pair: of all pairs that stand side by side the one of the lowest rank, the left of equals."""
        tokens = [self.base[c] for c in word[:-2]] + [self.base[word[-2:]]]
        before, after = list(range(-1, len(tokens) - 1)), [*range(1, len(tokens)), -1]
        queue = [(self.pairs[p][0], k, p) for k, p in enumerate(zip(tokens, tokens[1:], strict=False)) if p in self.pairs]
        heapq.heapify(queue)
        while queue:
            _, k, pair = heapq.heappop(queue)
            n = after[k]
            if n < 0 or tokens[k] != pair[0] or tokens[n] != pair[1]:
                continue  # one of the two has been used up
            tokens[k], tokens[n], after[k] = self.pairs[pair][1], -1, after[n]
            if after[n] >= 0:
                before[after[n]] = k
            for i, j in ((before[k], k), (k, after[k])):
                if i >= 0 and j >= 0 and (tokens[i], tokens[j]) in self.pairs:
                    heapq.heappush(queue, (self.pairs[tokens[i], tokens[j]][0], i, (tokens[i], tokens[j])))
        return [t for t in tokens if t >= 0]

    def encode(self, words: list[str]) -> tuple[list[list[int]], int]:
        """(ids of each word, words whose guess failed); words are bytes as characters with `WORD_END`."""
        found = [self.guess(w) for w in words]
        size = np.array([len(f) for f in found], np.int64)
        flat = np.array([t for f in found for t in f], np.int64)
        owner = np.repeat(np.arange(len(words)), size)
        wrong = np.zeros(len(words), bool)
        wrong[size == 0] = True
        np.logical_or.at(wrong, owner, ~self.sure[flat])
        seam = np.flatnonzero(owner[1:] == owner[:-1])
        pairs, which = np.unique(flat[seam] * self.size + flat[seam + 1], return_inverse=True)
        np.logical_or.at(wrong, owner[seam], self.crossed(pairs // self.size, pairs % self.size)[which])
        for k in np.flatnonzero(wrong):
            found[k] = self.merge(words[k])
        return found, int(wrong.sum())


class Encoder(Words):
    """Texts to ids, each distinct word guessed and checked once."""

    def __init__(self, description: str):
        super().__init__(description)
        parts = json.loads(description)
        self.merges = Merges(parts["model"])
        self.special = {t["content"]: t["id"] for t in parts["added_tokens"]}
        self.is_special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.bytes_of = str.maketrans(byte_letters())
        self.failed = self.learned = 0

    def remember(self, names: list[str], parts: list[list[str | int]]) -> None:
        """`parts` of each name: words of byte symbols, or the number of a special token."""
        words = list(dict.fromkeys(w for ws in parts for w in ws if isinstance(w, str)))
        found, failed = self.merges.encode(words)
        ids = dict(zip(words, found, strict=True))
        self.learned, self.failed = self.learned + len(words), self.failed + failed
        whole = [[i for w in ws for i in (ids[w] if isinstance(w, str) else [w])] for ws in parts]
        self.learn(names, np.array([i for w in whole for i in w], "<u2"), np.array([len(w) for w in whole], np.int64))

    def learn_words(self, words: list[str]) -> None:
        self.remember(words, [[w.encode().decode("latin-1") + WORD_END] for w in words])

    def learn_chunks(self, chunks: list[str]) -> None:
        out = []
        for chunk in chunks:
            cut: list[str | int] = []
            for k, part in enumerate(self.is_special.split(chunk)):
                if k % 2:
                    cut.append(self.special[part])
                elif part:
                    cut += [w.translate(self.bytes_of) + WORD_END for w, _ in self.whole.pre_tokenizer.pre_tokenize_str(self.whole.normalizer.normalize_str(part))]
            out.append(cut)
        self.remember(chunks, out)


_LOADED: dict[int, Encoder] = {}


def encoder(description: str) -> Encoder:
    """One encoder, with what it remembers, for all tasks of a Python worker."""
    key = hash(description)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Encoder(description)
    return _LOADED[key]


def encode(docs: DataFrame, tokenizer_json: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ids (array of int, without special tokens around) of every row."""
    box = docs.sparkSession.sparkContext.broadcast(tokenizer_json)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("x"))
    schema = pa.schema([("id", to_arrow_type(rows.schema["id"].dataType)), ("ids", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(box.value)
        for batch in batches:
            texts = batch.column(1).fill_null("")
            total = np.cumsum(np.asarray(pc.binary_length(texts)).astype(np.int64) + 1)
            for a, b in runs(total, CUT_BYTES):
                ids, size = words.encode(texts.slice(a, b - a))
                ids = np.delete(ids, np.cumsum(size) - 1)  # the end mark of each text
                offsets = np.concatenate([[0], np.cumsum(size - 1)]).astype(np.int32)
                column = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a).cast(schema.field(0).type), column], schema=schema)
        release()

    with_batches_of(docs.sparkSession, TEXT_ROWS)
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, ids array<int>").withColumnRenamed("id", id_col)


def decode(rows: DataFrame, tokenizer_json: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """Adds the text of `ids_col`: the tokens as the vocabulary writes them, special ones too, joined by blanks."""
    parts = json.loads(tokenizer_json)
    if parts["decoder"] is not None:
        raise ValueError("the description has a decoder of its own")
    names = {i: w for w, i in parts["model"]["vocab"].items()} | {t["id"]: t["content"] for t in parts["added_tokens"]}
    box = rows.sparkSession.sparkContext.broadcast([names.get(i) for i in range(max(names) + 1)])
    kept = rows.toDF(*(f"c{k}" for k in range(len(rows.columns))))
    which, named = rows.columns.index(ids_col), [*kept.columns, "decoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = pa.array(box.value)
        for batch in batches:
            ids = batch.column(which)
            words = names.take(ids.flatten())
            offsets = np.concatenate([[0], np.cumsum(np.asarray(pc.list_value_length(ids).fill_null(0)))]).astype(np.int32)
            texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), words), " ")
            yield pa.RecordBatch.from_arrays([*batch.columns, pc.if_else(ids.is_valid(), texts, None)], names=named)
        release()

    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept.schema)
    with_batches_of(rows.sparkSession, TEXT_ROWS)
    return kept.mapInArrow(run, f"{ddl}, decoded string").toDF(*rows.columns, out)
