"""Benchmark decontamination with an FM-index per training shard.

The corpus is cut into shards where it lies (no shuffle). A shard's words become numbers, its
suffix array gives the Burrows-Wheeler transform, a wavelet matrix answers rank queries on it, and
all windows of the benchmark are looked up by backward search at once. Rows of a match are turned
into places by walking the last-to-first mapping to a sampled suffix position, and overlapping
places are merged into removal spans.

Words outside the benchmark's vocabulary can be in no match, so a run of them is one separator,
and runs of vocabulary words shorter than the shortest window hold no match and are not indexed.

Words: A-Z lower-cased, then `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`. A window is ten consecutive
words of an item; an item of fewer words, but not none, is one window.

Defined results: null, empty and wordless texts have no words and no hits; null, empty and
wordless items have no windows; repeated items each count, by their ids; items without id count as one, null;
repeated documents each give a row; an empty benchmark hits nothing. Other columns are not read. A
benchmark larger than `BLOCK_BYTES` is dealt into blocks by hash. One block at a time is built,
broadcast and searched, on a table that is written between blocks; texts are cut by the merged spans
of all blocks.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempora.llm.common import map_batches, slices, stored

WINDOW = 10
#: Text of benchmark items that is broadcast at once.
BLOCK_BYTES = 64 << 20
#: Characters of a shard.
SHARD = 8 << 20
#: Every so many text positions the index keeps the suffix position.
SAMPLE = 8
CUT = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().translate(CUT).split()


@dataclass
class Phrases:
    """Distinct windows: right-aligned word numbers, lengths, and the items of each window (CSR)."""

    vocab: dict[bytes, int]
    words: np.ndarray
    length: np.ndarray
    item_at: np.ndarray
    items: list[str | None]


def in_order(items: set[str | None]) -> list[str | None]:
    return sorted(items, key=lambda x: (x is None, x or ""))


def phrases(rows: list[tuple[object, str | None]], window: int = WINDOW) -> Phrases:
    vocab: dict[bytes, int] = {}
    found: dict[tuple[int, ...], set[str | None]] = {}
    for item, text in rows:
        ids = [vocab.setdefault(w, len(vocab) + 1) for w in words_of(text)]
        for k in range(max(1, len(ids) - window + 1) if ids else 0):
            found.setdefault(tuple(ids[k : k + window]), set()).add(None if item is None else str(item))
    words = np.zeros((len(found), window), np.int64)
    for k, w in enumerate(found):
        words[k, window - len(w) :] = w
    sizes = [len(x) for x in found.values()]
    return Phrases(vocab, words, np.array([len(w) for w in found], np.int64), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64), [i for x in found.values() for i in in_order(x)])


def suffix_array(text: np.ndarray) -> np.ndarray:
    """By prefix doubling; only suffixes that still tie are sorted again. Ties need no end: 0s differ."""
    n = len(text)
    order = np.argsort(text, kind="stable")
    sorted_ = text[order]
    new = np.concatenate([[True], (sorted_[1:] != sorted_[:-1]) | (sorted_[1:] == 0)])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    k = 1
    while True:
        last = np.concatenate([new[1:], [True]])
        tied = np.flatnonzero(~(new & last))
        if not len(tied):
            return order
        own = order[tied]
        then = own + k
        follow = np.where(then < n, rank[np.minimum(then, n - 1)] + 1, 0)
        key = rank[own] * (n + 1) + follow
        by = np.argsort(key, kind="stable")
        order[tied] = own[by]
        key = key[by]
        fresh = np.concatenate([[True], key[1:] != key[:-1]])
        new[tied] |= fresh
        begin = np.maximum.accumulate(np.where(fresh, tied, 0))
        rank[order[tied]] = begin
        k *= 2


class FMIndex:
    """text: word numbers from 1, 0 separates runs and ends the text."""

    def __init__(self, text: np.ndarray, top: int):
        n = len(text)
        order = suffix_array(text)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=top + 2))]).astype(np.int64)
        bwt = text[order - 1]
        starts = np.concatenate([[True], text[:-1] == 0])  # a walk ends at the start of its run at the latest
        kept = starts | (np.arange(n) % SAMPLE == 0)
        self.sampled = kept[order]
        self.sample_rank = np.cumsum(self.sampled) - 1
        self.places = order[self.sampled]
        self.levels: list[tuple[int, np.ndarray, int]] = []
        now = bwt
        for bit in range(max(1, int(top).bit_length()) - 1, -1, -1):
            ones = (now >> bit) & 1
            count = np.concatenate([[0], np.cumsum(ones, dtype=np.int32)])
            zeros = n - int(count[-1])
            self.levels.append((bit, count, zeros))
            now = np.concatenate([now[ones == 0], now[ones == 1]])

    def rank(self, symbol: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Occurrences of symbol before position end of the transform."""
        lo, hi = np.zeros_like(end), end
        for bit, count, zeros in self.levels:
            one = ((symbol >> bit) & 1).astype(bool)
            a, b = count[lo], count[hi]
            lo, hi = np.where(one, zeros + a, lo - a), np.where(one, zeros + b, hi - b)
        return hi - lo

    def step_back(self, row: np.ndarray) -> np.ndarray:
        """The row of the suffix one word earlier."""
        symbol, at = np.zeros_like(row), row
        for bit, count, zeros in self.levels:
            one = count[at + 1] > count[at]
            symbol |= one.astype(np.int64) << bit
            at = np.where(one, zeros + count[at], at - count[at])
        return self.before[symbol] + self.rank(symbol, row)

    def search(self, words: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of right-aligned phrases, by backward search."""
        lo = np.zeros(len(words), np.int64)
        hi = np.full(len(words), len(self.sampled), np.int64)
        width = words.shape[1]
        for k in range(width):
            live = np.flatnonzero((length > k) & (hi > lo))
            if not len(live):
                break
            s = words[live, width - 1 - k]
            lo[live], hi[live] = self.before[s] + self.rank(s, lo[live]), self.before[s] + self.rank(s, hi[live])
        return lo, np.maximum(lo, hi)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        steps, at, out = np.zeros(len(rows), np.int64), rows.copy(), np.zeros(len(rows), np.int64)
        live = np.arange(len(rows))
        while len(live):
            done = self.sampled[at[live]]
            hit = live[done]
            out[hit] = self.places[self.sample_rank[at[hit]]] + steps[hit]
            live = live[~done]
            at[live] = self.step_back(at[live])
            steps[live] += 1
        return out


def search_shard(texts: list[str], p: Phrases) -> tuple[np.ndarray, list[list[tuple[int, int]]], list[list[str | None]]]:
    """(number of words, merged removal spans in words, sorted items) of each text."""
    get = p.vocab.get
    counts, ids = [], [0]
    for text in texts:
        own = [get(w, 0) for w in words_of(text)]
        counts.append(len(own))
        ids += own
        ids.append(0)
    n_words = np.array(counts, np.int64)
    spans: list[list[tuple[int, int]]] = [[] for _ in texts]
    items: list[list[str | None]] = [[] for _ in texts]
    if not len(p.length):
        return n_words, spans, items
    ids = np.array(ids, np.int64)
    known = ids > 0
    edge = np.flatnonzero(np.diff(known.astype(np.int8)))  # run k is from edge[2k] + 1 up to edge[2k + 1]
    first, last = edge[::2] + 1, edge[1::2] + 1
    long = last - first >= int(p.length.min())
    first, last = first[long], last[long]
    if not len(first):
        return n_words, spans, items
    size = last - first + 1  # with the separator that follows
    place = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
    index = FMIndex(ids[place], len(p.vocab))
    lo, hi = index.search(p.words, p.length)
    many = hi - lo
    if not many.sum():
        return n_words, spans, items
    which = np.repeat(np.arange(len(lo)), many)
    rows = np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many) + lo[which]
    at = place[index.locate(rows)]
    begin = np.cumsum(n_words + 1) - n_words  # first word of each text, after the leading 0
    doc = np.searchsorted(begin, at, side="right") - 1
    mark = np.zeros(len(ids) + 1, np.int64)
    np.add.at(mark, at, 1)
    np.add.at(mark, at + p.length[which], -1)
    hit = np.concatenate([[False], np.cumsum(mark[:-1]) > 0, [False]])
    edges = np.flatnonzero(hit[1:] != hit[:-1])
    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        d = int(np.searchsorted(begin, a, side="right")) - 1
        spans[d].append((a - int(begin[d]), b - int(begin[d])))
    pairs = np.unique(doc * len(lo) + which)
    sets: dict[int, set[str | None]] = {}
    for d, w in zip((pairs // len(lo)).tolist(), (pairs % len(lo)).tolist(), strict=True):
        sets.setdefault(d, set()).update(p.items[p.item_at[w] : p.item_at[w + 1]])
    for d, s in sets.items():
        items[d] = in_order(s)
    return n_words, spans, items


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of spans; those that touch become one."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def blocks(benchmark: DataFrame, id_col: str, text_col: str, block_bytes: int) -> list[DataFrame]:
    """The benchmark's rows in blocks of about `block_bytes` of text, dealt by hash of the row."""
    rows = benchmark.select(F.col(id_col).alias("i"), F.col(text_col).alias("x")).filter(F.col("x").isNotNull())
    total = rows.agg(F.sum(F.octet_length("x")).alias("n")).first().n or 0
    n = max(1, -(-total // block_bytes))
    part = F.pmod(F.xxhash64(F.col("i").cast("string"), "x"), F.lit(n))
    return [rows.filter(part == k) for k in range(n)] if n > 1 else [rows]


def broadcast(block: DataFrame):
    return block.sparkSession.sparkContext.broadcast(phrases([(r.i, r.x) for r in block.collect()]))


SPANS = "n_words long, spans array<struct<first:int,last:int>>, items array<string>"
NONE = ["cast(0 as bigint) as n_words", "cast(array() as array<struct<first:int,last:int>>) as spans", "cast(array() as array<string>) as items"]


def search(df: DataFrame, box, keep: list[str], x: str = "x") -> DataFrame:
    """`keep` columns of a table with text and the columns of SPANS, with a block's finds added to these."""
    names = list(dict.fromkeys([x, *keep]))
    schema = ", ".join([f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep] + [SPANS])

    def run(cols):
        texts = [t or "" for t in cols[0]]
        at, old_spans, old_items = [names.index(c) for c in keep], cols[-2], cols[-1]
        for a, b in slices(texts, SHARD):
            n, spans, items = search_shard(texts[a:b], box.value)
            spans = [merge(new + [(s["first"], s["last"]) for s in old]) if old else new for new, old in zip(spans, old_spans[a:b], strict=True)]
            items = [in_order({*new, *old}) if old else new for new, old in zip(items, old_items[a:b], strict=True)]
            yield [*(cols[k][a:b] for k in at), n.tolist(), [[{"first": p, "last": q} for p, q in s] for s in spans], items]

    return map_batches(df, [*(f"`{c}`" for c in names), "n_words", "spans", "items"], run, schema)


def find(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """id, n_words, removal spans (first word, word after the last) and items for every row."""
    todo = blocks(benchmark, item_col, item_text, block_bytes)
    df = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("x"), *map(F.expr, NONE))
    for block in todo[:-1]:
        box = broadcast(block)
        df = stored(search(df, box, ["i", "x"]), "spans")
        box.unpersist()
    return search(df, broadcast(todo[-1]), ["i"]).withColumnRenamed("i", id_col)


def strip(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the given words; what a span covers becomes one space."""
    places = [m.span() for m in WORD.finditer(text)]
    out, at = [], 0
    for a, b in spans:
        out.append(text[at : places[a][0]])
        at = places[b - 1][1]
    out.append(text[at:])
    return " ".join(x for x in (piece.strip(" ") for piece in out) if x)


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", length_col: str | None = "n_chars", item_col: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """All columns of `docs`, with the removal spans cut out of the text; wordless rests go.

    Words that meet where a span was cut can form a new match, so a changed text is searched
    again, for all blocks, until it is clean. Rows without hits are unchanged; null texts go, having
    no words.
    """
    todo = blocks(benchmark, item_col, item_text, block_bytes)
    if len(todo) > 1:
        return clean_by_blocks(docs, todo, text_col, length_col)
    cols = docs.columns
    x = cols.index(text_col)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    box = broadcast(todo[0])

    def run(values):
        texts = [t or "" for t in values[x]]
        for a, b in slices(texts, SHARD):
            own, left, todo = texts[a:b], [1] * (b - a), list(range(b - a))
            changed = set()
            while todo:
                n, spans, _ = search_shard([own[k] for k in todo], box.value)
                for k, c in zip(todo, n.tolist(), strict=True):
                    left[k] = c
                again = [k for k, s in zip(todo, spans, strict=True) if s]
                for k, s in zip(todo, spans, strict=True):
                    if s:
                        own[k] = strip(own[k], s)
                changed.update(again)
                todo = again
            keep = [k for k in range(b - a) if left[k]]
            out = []
            for name, column in zip(cols, values, strict=True):
                if name == text_col:
                    out.append([own[k] for k in keep])
                elif name == length_col:
                    out.append([len(own[k]) if k in changed else column[a + k] for k in keep])
                else:
                    out.append([column[a + k] for k in keep])
            yield out

    return map_batches(docs, [f"`{c}`" for c in cols], run, schema)


def clean_by_blocks(docs: DataFrame, todo: list[DataFrame], text_col: str, length_col: str | None) -> DataFrame:
    """The same for several blocks: each round searches all of them and cuts the changed texts once."""
    names = [f"c{k}" for k in range(len(docs.columns))]  # the documents' names may clash with the spans'
    x = names[docs.columns.index(text_col)]
    length = names[docs.columns.index(length_col)] if length_col in docs.columns else None
    schema = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, docs.schema, strict=True))

    def cut(values):
        spans = values[-1]
        new = dict(zip(names, values[:-1], strict=True))
        new[x] = [strip(t, [(s["first"], s["last"]) for s in own]) for t, own in zip(new[x], spans, strict=True)]
        if length:
            new[length] = list(map(len, new[x]))
        yield [new[c] for c in names]

    left, done = docs.toDF(*names), []
    while True:
        df = left.select(*names, *map(F.expr, NONE))
        for block in todo:
            box = broadcast(block)
            df = stored(search(df, box, names, x), "spans")
            box.unpersist()
        done.append(df.filter("n_words > 0 and size(spans) = 0").select(*names))
        hit = df.filter("size(spans) > 0")
        if hit.limit(1).count() == 0:
            break
        left = stored(map_batches(hit, [*names, "spans"], cut, schema), "cut")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.toDF(*docs.columns)
