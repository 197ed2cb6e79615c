"""Packing by lexical retrieval: a sharded BM25 index returns unused neighbours of each seed document.

Documents become token ids once and are kept in a table (two bytes an id, from a fixed
vocabulary). Token statistics for BM25 (document frequencies, mean length) are counted over all
documents. Documents are then dealt to shards by content: sorted by their two terms of the greatest
BM25 weight and cut into ranges, so that documents on the same rare terms meet in a shard wherever
they were stored. A shard has an inverted index over its documents, and windows are filled greedily:
a seed, with all its terms, takes the best unused neighbours by BM25 until the window is full; a
neighbour that does not fit is cut and its rest stays available. Documents longer than a window give
whole windows first. Only a shard's last sequence can be short; it is padded at a power of two.

Defined results: null and empty texts have the end id alone; equal scores go to the row earlier in
the shard; repeated rows are packed each by itself; an empty table gives no rows; other columns are
not read.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tempora.llm.common import release, stored, with_batches_of

WINDOW = 2048
END = 1
#: Tokens of one shard (a longer document is a shard of its own), and shards of one task.
SHARD_TOKENS, SHARDS_OF_TASK = 1_000_000, 2
K1, B = 1.2, 0.75
#: Distinct words that a task remembers; those of over `LONG` characters it doesn't.
MEMORY, LONG = 400_000, 64
#: Rows of an Arrow batch here, whose texts are not made Python objects, and bytes that are cut into words at once.
TEXT_ROWS, CUT_BYTES = 1000, 1 << 20
#: Characters that are stable under NFC and lower-case one by one; the tokenizer itself reads chunks with others.
PLAIN = regex.compile(r"[!-~\u00a1-\u012f\u0131-\u024f\u0391-\u03a1\u03a4-\u03ff\u0400-\u0481\u048a-\u052f\u2010-\u2027\u2030-\u205e\u20ac]")
LETTER, NUMBER, OTHER, BLANK, RAW = range(1, 6)


class Known(dict):
    """Numbers of words; -1 for those that are not known, so each is looked up once."""

    def __missing__(self, word: str) -> int:
        return -1


class Words:
    """Token ids of texts by a lower-casing word-level BPE tokenizer, remembering words.

    Texts are cut at blanks into chunks. Chunks of plain characters (each lower-cased by itself to as
    many bytes, and no change under NFC) are lower-cased and cut into words by tables over the bytes,
    and each distinct word is encoded once by the tokenizer's model; it reads other chunks whole.
    """

    def __init__(self, description: str):
        from tokenizers import Tokenizer

        parts = json.loads(description)
        vocab = parts["model"]["vocab"]
        if len(vocab) > 1 << 16:
            raise ValueError("ids of more than two bytes")
        self.whole = Tokenizer.from_str(description)
        first = {t["content"][0] for t in parts["added_tokens"]} | {"'"}  # special tokens; contractions are cut by context
        # the model alone, over words that are already in its byte alphabet
        words = parts | {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}, "post_processor": None, "added_tokens": []}
        self.model = Tokenizer.from_str(json.dumps(words))
        self.ends = np.zeros(1 << 16, bool)
        self.ends[[i for w, i in vocab.items() if w.endswith(parts["model"]["end_of_word_suffix"])]] = True
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        self.alphabet = np.zeros(256, "<u4")
        self.alphabet[shown] = shown
        self.alphabet[[b for b in range(256) if b not in shown]] = np.arange(256, 512 - len(shown))
        self.alphabet[32] = 32
        # of characters up to U+FFFF: whether plain, the small letter, and the class (letter, number, other)
        self.plain, self.small, self.kind = np.zeros(1 << 16, bool), np.arange(1 << 16), np.full(1 << 16, OTHER, np.uint8)
        for code in [*range(33, 0x530), *range(0x2010, 0x20AD)]:
            c, low = chr(code), chr(code).lower()
            self.plain[code] = bool(PLAIN.fullmatch(c)) and c not in first and len(low) == 1 and len(low.encode()) == len(c.encode())
            if self.plain[code]:
                self.small[code] = ord(low)
            self.kind[code] = LETTER if regex.match(r"\p{L}", low) else NUMBER if regex.match(r"\p{N}", low) else OTHER
        self.plain[[9, 10, 13, 32]], self.kind[[9, 10, 13, 32]] = True, BLANK
        self.forget()

    def forget(self) -> None:
        self.words = Known()
        #: Ids of all known words, end to end; where each word's begin; how many they are.
        self.pool, self.begin, self.size = np.zeros(0, "<u2"), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def learn(self, words: list[str], ids: np.ndarray, size: np.ndarray) -> None:
        self.words.update(zip(words, range(len(self.size), len(self.size) + len(words)), strict=True))
        self.begin = np.concatenate([self.begin, len(self.pool) + np.cumsum(size) - size])
        self.pool = np.concatenate([self.pool, ids])
        self.size = np.concatenate([self.size, size])

    def learn_words(self, words: list[str]) -> None:
        found = []
        for a in range(0, len(words), 2000):
            line = self.alphabet[np.frombuffer(" ".join(words[a : a + 2000]).encode(), np.uint8)].tobytes().decode("utf-32-le")
            found.append(np.array(self.model.encode_batch_fast([line], add_special_tokens=False)[0].ids, "<u2"))
        ids = np.concatenate([np.zeros(0, "<u2"), *found])
        self.learn(words, ids, np.diff(np.concatenate([[0], np.flatnonzero(self.ends[ids]) + 1])))

    def learn_chunks(self, chunks: list[str]) -> None:
        """Blanks end words and are dropped, so a text's ids are those of its chunks."""
        found = [np.array(e.ids, "<u2") for e in self.whole.encode_batch_fast(chunks, add_special_tokens=False)]
        self.learn(chunks, np.concatenate([np.zeros(0, "<u2"), *found]), np.array([len(x) for x in found], np.int64))

    def cut(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of UTF-8 bytes that end with a blank: bytes without blanks, where each word begins there, which
        words are whole chunks, and the running number of bytes left."""
        data = data.copy()
        kind, plain = self.kind[:128].take(data, mode="clip"), self.plain[:128].take(data, mode="clip")
        lower = self.small[:128].astype(np.uint8)
        low = data < 128
        small = np.where(low, lower.take(data, mode="clip"), data)
        lead = np.flatnonzero(data >= 0xC0)
        if len(lead):
            head = data[lead]
            for size, mark in ((2, 0xC0), (3, 0xE0), (4, 0xF0)):
                at = lead[(head >= mark) & (head < (0xE0, 0xF0, 0x100)[size - 2])]
                if size == 4:
                    plain[at] = False
                    continue
                code = (data[at] & (0xFF >> (size + 1))).astype(np.int64)
                for k in range(1, size):
                    code = code << 6 | (data[at + k] & 0x3F)
                new = self.small[code]
                for k in range(size):
                    byte = new >> (6 * (size - 1 - k)) & (0x3F if k else 0xFF)
                    small[at + k] = byte | (0x80 if k else mark)
                    kind[at + k] = self.kind[code]
                    plain[at + k] = self.plain[code]
        blank = kind == BLANK
        ends = np.flatnonzero(blank)
        odd = np.flatnonzero(~plain)
        raw = np.zeros(len(data), bool)
        if len(odd):  # chunks that hold one of these stay as they are
            chunk = np.unique(np.searchsorted(ends, odd))
            first = np.where(chunk, ends[chunk - 1] + 1, 0)
            edge = np.zeros(len(data) + 1, np.int8)
            np.add.at(edge, first, 1)
            np.add.at(edge, ends[chunk], -1)
            raw = np.cumsum(edge[:-1], dtype=np.int8) > 0
            kind[raw], small[raw] = RAW, data[raw]
        begin = np.concatenate([[True], kind[1:] != kind[:-1]]) | ((kind == NUMBER) & ((data & 0xC0) != 0x80))
        left = ~blank
        at = np.flatnonzero(begin & left)
        count = np.cumsum(left, dtype=np.int32 if len(data) < 1 << 31 else np.int64)
        return small[left], count[at] - 1, raw[at], count

    def encode(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each with the end id; ids of each text). Each distinct word is looked up once."""
        if len(self.words) > MEMORY:
            self.forget()
        ended = pc.binary_join_element_wise(texts.cast(pa.large_string()), *(pa.scalar(c, pa.large_string()) for c in ("", " ")))
        _, places, content = ended.buffers()
        places = np.frombuffer(places, np.int64)[ended.offset : ended.offset + len(ended) + 1]
        data, begin, raw, count = self.cut(np.frombuffer(content, np.uint8)[: places[-1]])
        offsets = np.concatenate([begin, [len(data)]]).astype(np.int64)
        pieces = pa.LargeStringArray.from_buffers(len(begin), pa.py_buffer(offsets), pa.py_buffer(data)).dictionary_encode()
        which = np.asarray(pieces.indices)
        words = pieces.dictionary.to_numpy(zero_copy_only=False).tolist()
        known = np.fromiter(map(self.words.__getitem__, words), np.int64, len(words))
        new = np.flatnonzero(known < 0)
        kept = len(self.size), len(self.pool)
        long = []
        if len(new):
            chunk = np.zeros(len(words), bool)
            chunk[which] = raw
            unknown = [(words[k], c) for k, c in zip(new.tolist(), chunk[new].tolist(), strict=True)]
            self.learn_words([w for w, c in unknown if not c and len(w) <= LONG])
            self.learn_chunks([w for w, c in unknown if c and len(w) <= LONG])
            kept, long = (len(self.size), len(self.pool)), [w for w, _ in unknown if len(w) > LONG]
            self.learn_words([w for w, c in unknown if not c and len(w) > LONG])
            self.learn_chunks([w for w, c in unknown if c and len(w) > LONG])
            known[new] = [self.words[w] for w, _ in unknown]
        number = known[which]
        size = self.size[number]
        ends = np.cumsum(size)
        flat = self.pool[np.repeat(self.begin[number] - (ends - size), size) + np.arange(int(size.sum()))]
        last = np.searchsorted(begin, count[places[1:] - 1], side="left")  # words before each text's end
        text_ends = np.concatenate([[0], ends])[last]
        if long:  # these are not remembered
            for w in long:
                del self.words[w]
            self.size, self.begin, self.pool = self.size[: kept[0]], self.begin[: kept[0]], self.pool[: kept[1]]
        return np.insert(flat, text_ends, END), np.diff(np.concatenate([[0], text_ends])) + 1


_LOADED: dict[int, Words] = {}


def words_of(description: str) -> Words:
    """One tokenizer, with what it remembers, for all tasks of a Python worker."""
    key = hash(description)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Words(description)
        release()
    return _LOADED[key]


def tokens(docs: DataFrame, tokenizer_json: str, id_col: str, text_col: str) -> DataFrame:
    """id, ids (two bytes each, with the end id) for every row."""
    box = docs.sparkSession.sparkContext.broadcast(tokenizer_json)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("x"))
    schema = pa.schema([("id", to_arrow_type(rows.schema["id"].dataType)), ("ids", pa.large_binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = words_of(box.value)
        for batch in batches:
            texts = batch.column(1).fill_null("")
            total = np.cumsum(np.asarray(pc.binary_length(texts)).astype(np.int64) + 1)
            for a, b in runs(total, CUT_BYTES):
                ids, size = words.encode(texts.slice(a, b - a))
                offsets = np.concatenate([[0], np.cumsum(size * 2)]).astype(np.int64)
                column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), b - a, [None, pa.py_buffer(offsets), pa.py_buffer(ids.astype("<u2"))])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a).cast(schema.field(0).type), column], schema=schema)
        release()

    with_batches_of(docs.sparkSession, TEXT_ROWS)
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, ids binary")


def runs(total: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Cut rows with running sizes `total` into (first, end) ranges of about `limit`, one row at least."""
    first = 0
    while first < len(total):
        end = max(first + 1, int(np.searchsorted(total, (total[first - 1] if first else 0) + limit, side="right")))
        yield first, end
        first = end


def terms_of(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct ids in order, how often each occurs) of one document."""
    own = np.sort(ids, kind="stable")
    first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
    return own[first], np.diff(np.concatenate([first, [len(own)]]))


def statistics(table: DataFrame, vocab: int) -> tuple[np.ndarray, int, float]:
    """(documents that hold each token, documents, mean length). At most one row a token leaves a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, docs, total = np.zeros(vocab, np.int64), 0, 0
        for batch in batches:
            for ids in batch.column(0):
                own = np.frombuffer(ids.as_buffer(), "<u2")
                count[terms_of(own)[0]] += 1
                docs, total = docs + 1, total + len(own)
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([[-2, -1], some])), pa.array(np.concatenate([[docs, total], count[some]]))], names=["token", "n"])

    rows = table.select("ids").mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).collect()
    count, docs, total = np.zeros(vocab, np.int64), 0, 0
    for r in rows:
        if r.token >= 0:
            count[r.token] = r.n
        elif r.token == -2:
            docs = r.n
        else:
            total = r.n
    return count, docs, total / max(1, docs)


def weights(tf: np.ndarray, idf: np.ndarray, size: np.ndarray | int, mean: float) -> np.ndarray:
    """BM25 weight of terms of frequency tf in documents of `size` ids."""
    return idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * size / mean))


def routed(table: DataFrame, box, parts: int) -> DataFrame:
    """The token table dealt by content: rows of the same heaviest terms lie together, in sorted order.

    The place in the table ends the key, so a term that heads a third of all rows is cut into many
    ranges too, and each run gives the same ranges.
    """
    kind = table.schema["id"].dataType.simpleString()
    schema = pa.schema([("one", pa.int32()), ("two", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, mean = box.value
        for batch in batches:
            top = np.zeros((batch.num_rows, 2), np.int32)
            for k, ids in enumerate(batch.column(1)):
                own = np.frombuffer(ids.as_buffer(), "<u2")
                term, tf = terms_of(own)
                weight = weights(tf, idf[term], len(own), mean)
                best = int(weight.argmax())
                weight[best] = -1
                top[k] = term[best], term[int(weight.argmax())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(top[:, j]) for j in (0, 1))], schema=pa.schema([*batch.schema, *schema]))

    rows = table.select("id", "ids", F.monotonically_increasing_id().alias("place")).mapInArrow(run, f"id {kind}, ids binary, place long, one int, two int")
    key = ["one", "two", "place"]
    return rows.repartitionByRange(parts, *key).sortWithinPartitions(*key).select("id", "ids")


def pack_shard(docs: list[np.ndarray], idf: np.ndarray, mean: float, window: int = WINDOW) -> list[list[tuple[int, int, int]]]:
    """Sequences of one shard, each a list of (document, start, length)."""
    out: list[list[tuple[int, int, int]]] = []
    size = np.array([len(d) for d in docs], np.int64)
    start = size // window * window
    for k in np.flatnonzero(start):
        out += [[(int(k), at, window)] for at in range(0, int(start[k]), window)]
    rest = size - start
    unit = np.flatnonzero(rest)
    owner = np.repeat(unit, size[unit])
    if not len(unit):
        return out
    code, tf = np.unique(owner * (1 << 16) + np.concatenate([docs[k] for k in unit]).astype(np.int64), return_counts=True)
    doc, token = code >> 16, code & 0xFFFF
    begin = np.searchsorted(doc, np.arange(len(docs) + 1))
    by = np.argsort(token, kind="stable")
    post_token, post_doc, post_weight = token[by], doc[by], weights(tf, idf[token], size[doc], mean)[by]
    post_at = np.searchsorted(post_token, np.arange((1 << 16) + 1))
    free = rest > 0
    indexed = n_free = len(unit)
    after = 0
    for seed in unit:
        if not free[seed]:
            continue
        if n_free * 2 < indexed:  # the index is built anew over what is unused
            left = free[post_doc]
            post_token, post_doc, post_weight = post_token[left], post_doc[left], post_weight[left]
            post_at = np.searchsorted(post_token, np.arange((1 << 16) + 1))
            indexed = n_free
        room, seq = window, []
        take = [int(seed)]
        while room:
            for k in take:
                n = int(min(room, rest[k]))
                seq.append((k, int(start[k]), n))
                start[k] += n
                rest[k] -= n
                if not rest[k]:
                    free[k] = False
                    n_free -= 1
                room -= n
                if not room:
                    break
            if not room:
                break
            if len(take) == 1 and take[0] == seed and len(seq) == 1:
                terms = token[begin[seed] : begin[seed + 1]]
                many = post_at[terms + 1] - post_at[terms]
                found = np.repeat(post_at[terms] - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
                score = np.bincount(post_doc[found], post_weight[found], len(docs)) * free
                near = np.flatnonzero(score)
                take = near[np.argsort(-score[near], kind="stable")].tolist()
                if take:
                    continue
            while after < len(unit) and not free[unit[after]]:
                after += 1
            if after == len(unit):
                break
            take = [int(unit[after])]
        out.append(seq)
    return out


def pack(docs: DataFrame, tokenizer_json: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """One row for each piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset, padded_to."""
    table = stored(tokens(docs, tokenizer_json, id_col, text_col), "tokens")
    with_batches_of(docs.sparkSession, TEXT_ROWS)
    count, n, mean = statistics(table, 1 << 16)
    idf = np.log1p((n - count + 0.5) / (count + 0.5))
    box = docs.sparkSession.sparkContext.broadcast((idf, mean))
    kind = table.schema["id"].dataType.simpleString()
    schema = pa.schema([("id", to_arrow_type(table.schema["id"].dataType)), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("padded_to", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, mean = box.value
        sequence = TaskContext.get().partitionId() << 33
        held: list[tuple] = []
        total = 0

        def flush() -> pa.RecordBatch:
            nonlocal sequence
            ids = [np.frombuffer(x, "<u2") for _, x in held]
            cols: list[list] = [[] for _ in schema]
            for seq in pack_shard(ids, idf, mean, window):
                offset, filled = 0, sum(p[2] for p in seq)
                for k, start, length in seq:
                    crc = zlib.crc32(ids[k][start : start + length].astype("<u4").tobytes())
                    for c, v in zip(cols, (held[k][0], start, length, crc, len(ids[k]), sequence, offset, min(window, 1 << (filled - 1).bit_length())), strict=True):
                        c.append(v)
                    offset += length
                sequence += 1
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], names=schema.names)

        for batch in batches:
            for row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if held and total + len(row[1]) // 2 > shard_tokens:
                    yield flush()
                    total = 0
                held.append(row)
                total += len(row[1]) // 2
        if held:
            yield flush()
        release()

    parts = max(1, round(n * mean / (SHARDS_OF_TASK * shard_tokens)))
    return routed(table, box, parts).mapInArrow(run, f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, padded_to long").withColumnRenamed("id", id_col)
