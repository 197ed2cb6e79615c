"""Tokens of two tokenizers for the same text, aligned by bytes, and their links counted over the corpus.

The tokens of B are intervals of bytes; their sorted starts and ends are a static index. Two bisections
for each token of A give the run of B tokens that it overlaps. A gap between neighbours of A that no
token of B spans ends a group, so groups end where tokens of both end. All texts of a slice lie end to
end in one index, as nothing spans the gap between texts. In a group every A token is linked with every
B token; long groups are counted over their distinct ids, never written out.

Counts need all documents, links of one id pair many of them. So documents are dealt to chunks of a
bounded number of tokens, and a chunk asks once for each distinct id pair that it holds: pairs are
summed (the chunk has summed its own before), joined back to the chunks that asked, and the answers of
a chunk meet its documents. The greatest count of each A id has at most as many rows as A has ids.
A row of the JVM's is a document or a block of a chunk's pairs, as a whole chunk in a row would be
megabytes that readers, sorts and writers hold by the hundred; a chunk is whole in Python only.

Defined results: texts that are null or empty, or whose joined A or B bytes differ from the text behind
a blank, have no tokens, zeros and an empty groups string; special tokens' strings are plain text; rows
that repeat are documents each; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tempora.llm.bpe import byte_letters
from tempora.llm.common import release, stored, with_batches_of
from tempora.llm.packing import TEXT_ROWS, runs

#: A tokens of a chunk of documents (a longer document is a chunk of its own); bytes of text that are aligned at once.
CHUNK_TOKENS, SLICE = 500_000, 1 << 20
#: Links of a group from which its ids are counted before they are paired.
LONG_GROUP = 4096
#: Texts of characters whose kind is old and the same to everyone are cut before blanks, where tokens of both end.
PIECE = regex.compile(r"\s++\S*+")
PLAIN = regex.compile(r"[\t\n -~\u00a1-\u012f\u0131-\u024f\u0391-\u03a1\u03a4-\u03ff\u0400-\u0481\u048a-\u052f\u2010-\u2027\u2030-\u205e\u20ac]*+")
#: Pieces whose alignment a task remembers, and the longest of them.
MEMORY, LONGEST = 300_000, 64
#: Id pairs of one row.
BLOCK = 4096
#: Of the stored rows: bytes of a row group, and rows after which its size is looked at.
GROUPS = {"parquet.block.size": str(16 << 20), "parquet.page.size.row.check.min": "10", "parquet.page.size.row.check.max": "200"}
#: Columns of a document that are given as they are, and their types.
PER_DOC = {"n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "n_links": pa.int64(), "groups": pa.string()}


class Pair:
    """Both tokenizers, and the bytes of each of their tokens."""

    def __init__(self, a_json: str, b_model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_json)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        parts = json.loads(a_json)
        names = {i: w for w, i in parts["model"]["vocab"].items()}
        letters = str.maketrans(byte_letters())
        self.a_bytes = [names[i].translate(letters).encode("latin-1") if i in names else b"" for i in range(max(names) + 1 + len(parts["added_tokens"]))]
        piece = lambda i: bytes([int(self.b.id_to_piece(i)[3:-1], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace("▁", " ").encode()
        self.b_bytes = [piece(i) for i in range(self.b.get_piece_size())]
        if max(len(self.a_bytes), len(self.b_bytes)) > 1 << 16:
            raise ValueError("ids of more than two bytes")
        self.a_size, self.b_size = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        #: An id with what follows it: another of its side, the other side, another group.
        self.named = [[f"{i}{c}" for i in range(1 << 16)] for c in ",|;"]
        before = parts["pre_tokenizer"] or {}
        no_blank_inside = all(not regex.search(r"[^▁]▁|[\t\n ]", self.b.id_to_piece(i)) for i in range(self.b.get_piece_size()))
        self.by_pieces = before.get("type") == "ByteLevel" and before.get("use_regex") and not parts["normalizer"] and no_blank_inside
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.written: list[str] = []
        #: Of each known piece: tokens of A and B, groups, links, and where its id pairs begin and how many they are.
        self.facts = np.zeros((6, 0), np.int64)
        self.codes = self.links = np.zeros(0, np.int64)

    def tokens(self, whole: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """A ids of all texts, which begin with a blank, how many each has, and the same of B; a text whose bytes
        are not those of both has none."""
        a = [e.ids for e in self.a.encode_batch_fast(whole, add_special_tokens=False)]
        # B puts a space in front: in place of one that is there, else to be taken off again
        b = [x if w[:1] == " " else x[1:] for w, x in zip(whole, self.b.encode([w.removeprefix(" ") for w in whole], num_threads=1), strict=True)]
        data = [w.encode() for w in whole]
        size = np.array([len(d) for d in data], np.int64)
        for _ in range(2):
            sides = []
            right = np.ones(len(whole), bool)
            for ids, sizes, names in ((a, self.a_size, self.a_bytes), (b, self.b_size, self.b_bytes)):
                flat = list(chain.from_iterable(ids))
                many = np.fromiter(map(len, ids), np.int64, len(ids))
                array = np.array(flat, np.int64)
                found = np.zeros(len(ids), np.int64)
                np.add.at(found, np.repeat(np.arange(len(ids)), many), sizes[array])
                sides += [array, many]
                if (found == size).all() and b"".join(map(names.__getitem__, flat)) == b"".join(data):
                    continue  # all at once
                right &= [b"".join(map(names.__getitem__, x)) == d for x, d in zip(ids, data, strict=True)]
            if right.all():
                break
            a, b, data = ([x if r else x[:0] for x, r in zip(side, right.tolist(), strict=True)] for side in (a, b, data))
            size = np.where(right, size, 0)
        return tuple(sides)

    def learn(self, pieces: list[str]) -> None:
        found = align_whole(self, pieces)
        size = np.bincount(found.doc, minlength=len(pieces))
        begin = len(self.codes) + np.cumsum(size) - size
        self.known.update(zip(pieces, range(len(self.written), len(self.written) + len(pieces)), strict=True))
        self.written += found.groups
        self.facts = np.concatenate([self.facts, [found.n_a, found.n_b, found.n_groups, found.n_links, begin, size]], axis=1)
        self.codes, self.links = np.concatenate([self.codes, found.code]), np.concatenate([self.links, found.links])


def overlaps(a_end: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last B token that each A token overlaps; tokens lie end to end, in bytes."""
    a_start, b_start = (np.concatenate([[0], e[:-1]]) for e in (a_end, b_end))
    return np.searchsorted(b_end, a_start, side="right"), np.searchsorted(b_start, a_end, side="left") - 1


def groups_of(a_end: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group numbers of A tokens and of B tokens, from 0."""
    first, last = overlaps(a_end, b_end)
    a_group = np.cumsum(np.concatenate([[0], last[:-1] < first[1:]]))[: len(a_end)]
    return a_group, a_group[np.searchsorted(last, np.arange(len(b_end)), side="left")] if len(b_end) else a_group


@dataclass
class Slice:
    """Aligned documents: numbers of each, and the distinct id pairs (a << 16 | b) of each with their links."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    groups: list[str]
    doc: np.ndarray
    code: np.ndarray
    links: np.ndarray


def linked(group_a: np.ndarray, a: np.ndarray, group_b: np.ndarray, b: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, code, links) of the distinct id pairs of each document; `doc` has the document of each group."""
    many = int(group_a[-1]) + 1 if len(group_a) else 0
    size_a, size_b = np.bincount(group_a, minlength=many), np.bincount(group_b, minlength=many)
    at_a, at_b = np.cumsum(size_a) - size_a, np.cumsum(size_b) - size_b
    long = size_a * size_b > LONG_GROUP
    keep = ~long[group_a]
    times = np.where(keep, size_b[group_a], 0)
    left = np.repeat(np.arange(len(a)), times)
    place = np.arange(len(left)) - np.repeat(np.cumsum(times) - times, times)
    code = a[left] << 16 | b[at_b[group_a[left]] + place]
    owner, weight = doc[group_a[left]], np.ones(len(left), np.int64)
    for g in np.flatnonzero(long):
        (x, n), (y, m) = (np.unique(t[s[g] : s[g] + z[g]], return_counts=True) for t, s, z in ((a, at_a, size_a), (b, at_b, size_b)))
        code = np.concatenate([code, (x[:, None] << 16 | y[None]).ravel()])
        weight = np.concatenate([weight, (n[:, None] * m[None]).ravel()])
        owner = np.concatenate([owner, np.full(len(x) * len(y), doc[g])])
    key, which = np.unique(owner << 32 | code, return_inverse=True)
    return key >> 32, key & 0xFFFFFFFF, np.bincount(which, weight, len(key)).astype(np.int64)


def align_whole(pair: Pair, whole: list[str]) -> Slice:
    """Alignment of each text, which begins with a blank."""
    a, n_a, b, n_b = pair.tokens(whole)
    group_a, group_b = groups_of(np.cumsum(pair.a_size[a]), np.cumsum(pair.b_size[b]))
    begins = np.concatenate([[True], group_a[1:] != group_a[:-1]])[: len(group_a)]
    doc = np.repeat(np.arange(len(whole)), n_a)[begins]
    size_a, size_b = np.bincount(group_a, minlength=len(doc)), np.bincount(group_b, minlength=len(doc))
    n_links = np.zeros(len(whole), np.int64)
    np.add.at(n_links, doc, size_a * size_b)
    # ids in the order in which they are written: by group, A before B
    group, side = np.concatenate([group_a, group_b]), np.repeat([0, 1], [len(a), len(b)])
    order = np.argsort(group * 2 + side, kind="stable")
    ids, group, side = np.concatenate([a, b])[order], group[order], side[order]
    then = np.full(len(ids), 2)
    then[:-1] = np.where(group[1:] != group[:-1], 2, side[1:] != side[:-1])
    names = [pair.named[t][i] for i, t in zip(ids.tolist(), then.tolist(), strict=True)]
    ends = np.cumsum(n_a + n_b)
    groups = ["".join(names[x:y])[:-1] for x, y in zip((ends - n_a - n_b).tolist(), ends.tolist(), strict=True)]
    return Slice(n_a, n_b, np.bincount(doc, minlength=len(whole)), n_links, groups, *linked(group_a, a, group_b, b, doc))


def align_slice(pair: Pair, texts: list[str], as_text: bool = False) -> Slice:
    """Alignment of each text; `groups` as written out, or as SHA-256 of that. Pieces that are known are put together."""
    if len(pair.known) > MEMORY:
        pair.forget()
    whole = [" " + t for t in texts]
    cut = [PIECE.findall(t) if t != " " and pair.by_pieces and PLAIN.fullmatch(t) else [] for t in whole]
    cut = [c if max(map(len, c), default=0) <= LONGEST else [] for c in cut]
    pieces = list(chain.from_iterable(cut))
    pair.learn([w for w in set(pieces) if w not in pair.known])
    size = np.array([len(c) for c in cut], np.int64)
    piece = np.fromiter(map(pair.known.__getitem__, pieces), np.int64, len(pieces))
    owner = np.repeat(np.arange(len(texts)), size)
    numbers = np.zeros((4, len(texts)), np.int64)
    facts = pair.facts[:, piece]
    odd = np.ones(len(texts), bool)
    odd[owner] = False
    odd[owner[facts[0] == 0]] = True  # a piece whose bytes differ
    odd &= np.array([t != " " for t in whole], bool)
    held = ~odd[owner]
    for row in range(4):
        np.add.at(numbers[row], owner[held], facts[row][held])
    ends = np.cumsum(size)
    groups = [";".join(map(pair.written.__getitem__, piece[x:y].tolist())) for x, y in zip(ends - size, ends, strict=True)]
    begin, many = facts[4][held], facts[5][held]
    at = np.repeat(begin - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
    doc, code, links = np.repeat(owner[held], many), pair.codes[at], pair.links[at]
    if odd.any():
        places = np.flatnonzero(odd)
        rest = align_whole(pair, [whole[k] for k in places])
        numbers[:, places] = [rest.n_a, rest.n_b, rest.n_groups, rest.n_links]
        for k, text in zip(places.tolist(), rest.groups, strict=True):
            groups[k] = text
        doc, code, links = np.concatenate([doc, places[rest.doc]]), np.concatenate([code, rest.code]), np.concatenate([links, rest.links])
    key, which = np.unique(doc << 32 | code, return_inverse=True)
    if not as_text:
        groups = [hashlib.sha256(g.encode()).hexdigest() if g else g for g in groups]
    return Slice(*numbers, groups, key >> 32, key & 0xFFFFFFFF, np.bincount(which, links, len(key)).astype(np.int64))


_LOADED: dict[int, Pair] = {}


def loaded(a_json: str, b_model: bytes) -> Pair:
    key = hash((a_json, b_model))
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Pair(a_json, b_model)
    return _LOADED[key]


def chunks(docs: DataFrame, a_json: str, b_model: bytes, id_col: str, text_col: str, as_text: bool, chunk_tokens: int) -> DataFrame:
    """Rows of chunks, of two kinds. A document: `chunk`, `id`, the columns of `PER_DOC`, `at` and `links`, the places of
    its id pairs among the chunk's and their links. A block of the chunk's distinct id pairs: `chunk`, `first`, the
    place of the first, `codes` and `holders`, how many documents of the chunk hold each."""
    box = docs.sparkSession.sparkContext.broadcast((a_json, b_model))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("x"))
    kind = rows.schema["id"].dataType
    schema = pa.schema([("chunk", pa.int64()), ("id", to_arrow_type(kind)), *PER_DOC.items(), ("at", pa.list_(pa.int32())), ("links", pa.list_(pa.int64())), ("first", pa.int32()), ("codes", pa.list_(pa.int64())), ("holders", pa.list_(pa.int64()))])

    def lists(ends: np.ndarray, flat: np.ndarray, of: pa.DataType) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(flat, of))

    def rows_of(chunk: int, many: int, cells: dict[str, pa.Array]) -> pa.RecordBatch:
        given = {"chunk": pa.array(np.full(many, chunk))} | cells
        return pa.RecordBatch.from_arrays([given[f.name].cast(f.type) if f.name in given else pa.nulls(many, f.type) for f in schema], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = loaded(*box.value)
        number = TaskContext.get().partitionId() << 33
        held: list[tuple[pa.Array, Slice]] = []

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal number
            parts = [s for _, s in held]
            codes, at = np.unique(np.concatenate([s.code for s in parts]), return_inverse=True)
            holders = np.bincount(at, minlength=len(codes))
            first = np.arange(0, len(codes), BLOCK)
            ends = np.minimum(first + BLOCK, len(codes))
            if len(codes):
                yield rows_of(number, len(first), {"first": pa.array(first), "codes": lists(ends, codes, pa.int64()), "holders": lists(ends, holders, pa.int64())})
            done = 0
            for ids, part in held:
                pairs = np.bincount(part.doc, minlength=len(part.n_a))
                own = at[done : done + len(part.code)]
                done += len(part.code)
                cells = {c: pa.array(getattr(part, c), t) for c, t in PER_DOC.items()}
                yield rows_of(number, len(ids), {"id": ids, **cells, "at": lists(np.cumsum(pairs), own, pa.int32()), "links": lists(np.cumsum(pairs), part.links, pa.int64())})
            number += 1
            held.clear()

        total = 0
        for batch in batches:
            texts = batch.column(1).fill_null("")
            size = np.cumsum(np.asarray(pc.binary_length(texts)).astype(np.int64) + 1)
            for a, b in runs(size, SLICE):
                part = align_slice(pair, texts.slice(a, b - a).to_pylist(), as_text)
                if held and total + int(part.n_a.sum()) > chunk_tokens:
                    yield from flush()
                    total = 0
                held.append((batch.column(0).slice(a, b - a), part))
                total += int(part.n_a.sum())
        if held:
            yield from flush()
        release()

    with_batches_of(docs.sparkSession, TEXT_ROWS)
    return rows.mapInArrow(run, f"chunk long, id {kind.simpleString()}, n_a long, n_b long, n_groups long, n_links long, groups string, at array<int>, links array<long>, first int, codes array<long>, holders array<long>")


def pair_counts(made: DataFrame) -> DataFrame:
    """code, count: how many documents hold each id pair linked."""
    blocks = made.filter("first is not null").select(F.explode(F.arrays_zip("codes", "holders")).alias("p"))
    return blocks.groupBy(F.col("p.codes").alias("code")).agg(F.sum("p.holders").alias("count"))


def align(docs: DataFrame, a_json: str, b_model: bytes, id_col: str = "doc_id", text_col: str = "text", as_text: bool = True, chunk_tokens: int = CHUNK_TOKENS) -> DataFrame:
    """id, n_a, n_b, n_groups, n_links, groups, n_best, count_sum for every row.

    `groups` is written `a1,a2|b1;a3|b2,b3`, without `as_text` its SHA-256; a link's count is how many
    documents hold its id pair linked, and it is best if no pair of its A id has a greater one.
    """
    made = stored(chunks(docs, a_json, b_model, id_col, text_col, as_text, chunk_tokens), "chunks", GROUPS)
    counts = stored(pair_counts(made), "pair-counts")
    # one row for each id of A at most
    best = counts.groupBy(F.shiftright("code", 16).alias("a")).agg(F.max("count").alias("most"))
    known = counts.join(F.broadcast(best), F.shiftright("code", 16) == F.col("a")).select("code", "count", (F.col("count") == F.col("most")).alias("best"))
    asked = made.filter("first is not null").select("chunk", "first", F.posexplode("codes").alias("k", "code"))
    told = asked.join(known, "code").select(F.col("chunk").alias("asking"), (F.col("first") + F.col("k")).alias("k"), "count", "best")
    own = made.filter("first is null").select("chunk", "id", *PER_DOC, "at", "links")
    kind = own.schema["id"].dataType
    schema = pa.schema([("id", to_arrow_type(kind)), *PER_DOC.items(), ("n_best", pa.int64()), ("count_sum", pa.int64())])

    def run(docs: pa.Table, told: pa.Table) -> pa.Table:
        k, count, best = (told.column(c).to_numpy() for c in ("k", "count", "best"))
        count_of, best_of = np.zeros(len(k), np.int64), np.zeros(len(k), np.int64)
        count_of[k], best_of[k] = count, best
        doc = np.repeat(np.arange(docs.num_rows), pc.list_value_length(docs.column("at")).to_numpy())
        at, links = (pc.list_flatten(docs.column(c)).to_numpy() for c in ("at", "links"))
        sums = [np.zeros(docs.num_rows, np.int64) for _ in range(2)]
        for total, of in zip(sums, (best_of, count_of), strict=True):
            np.add.at(total, doc, links * of[at])
        return pa.table([*(docs.column(f.name) for f in list(schema)[:-2]), *map(pa.array, sums)], names=schema.names).cast(schema)

    with_batches_of(docs.sparkSession, TEXT_ROWS)
    both = own.groupBy("chunk").cogroup(told.groupBy("asking"))
    return both.applyInArrow(run, f"id {kind.simpleString()}, n_a long, n_b long, n_groups long, n_links long, groups string, n_best long, count_sum long").withColumnRenamed("id", id_col)
