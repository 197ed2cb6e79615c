"""N-gram Jaccard join: a MinHash LSH forest proposes pairs, exact verification decides.

Texts are lower-cased; words are runs of letters and digits; shingles are five consecutive words
(a text of fewer words is one shingle). Texts with the same word sequence form a class, found by
hash, and only one text of each class is compared further.

Each of `TREES` trees is a prefix trie of the signatures: a row holds a text's nodes from the longest
prefix (`DEPTH` values) to the shortest that a pair at the threshold can need (see `min_depth`). Texts
that are alone at the shortest prefix have no partner. The others are matched at the longest prefix
first, and every pair that meets is verified by the exact Jaccard of whole shingle sets. A found link
of similarity s was met with a known probability p(s), so 1 / p(s) - 1 links like it are expected to be
missing; a text whose found links are less than `RECALL` of found and expected ones, counting one more
at the threshold, has its prefixes shortened by one value and meets all texts of the larger nodes. So
texts of dense groups end at long prefixes, and texts without links go on to the shortest.

A shorter prefix is compared only where its node branches, a pair that met at a longer prefix or in
another node of the level is not compared again. All pairs of a node are compared: those of at most
`FEW` texts as rows, larger ones in blocks of about `BLOCK` texts, each with each, where blocks of
texts whose sizes rule out the threshold are left out. A node of m similar texts costs m squared
comparisons, spread over tasks of bounded size, but a block pair gives only counts and links that
span it, not its pairs. Connected texts get the smallest doc_id as their class, and n_links counts
all verified links of a text.

Defined results: null and wordless texts are alone (their own class, no links); repeated rows
each give a row; ties go to the smaller id; null ids are kept as rows of their own; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempora.llm.common import map_batches, slices, stored

SHINGLE = 5
THRESHOLD = 0.8
TREES, DEPTH = 16, 6
#: Share of a text's links that is expected to be found before its prefixes stay as they are.
RECALL = 0.9997
#: A table of at most so many rows of 16 bytes is broadcast; larger ones are joined by shuffle.
SMALL_ROWS = 1_000_000
#: Texts of a node that are paired by a join; texts and shingles of a block of a larger node.
FEW, BLOCK, BLOCK_SHINGLES = 16, 512, 1 << 19
WORD = re.compile(r"[^\W_]+")


def chance(similarity, depth: int, trees: int):
    """The probability that a pair shares a prefix of `depth` values in some tree."""
    return 1 - (1 - similarity**depth) ** trees


def min_depth(threshold: float = THRESHOLD, recall: float = RECALL, trees: int = TREES, depth: int = DEPTH) -> int:
    """The longest prefix at which a pair at the threshold is met in some tree with this probability."""
    return next(d for d in range(depth, 0, -1) if d == 1 or chance(threshold, d, trees) >= recall)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return x ^ (x >> np.uint64(27))


def shingles(texts: list[str], memory: dict) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """(64-bit shingle hashes end to end, shingles of each text, 16-byte hash of each word sequence)."""
    vocab = memory.get("vocab")
    if vocab is None or len(vocab) > 100_000:
        vocab = defaultdict()
        vocab.default_factory = vocab.__len__
        memory |= {"vocab": vocab, "hash": np.zeros(0, np.uint64)}
    ids, counts, old = [], [], len(vocab)
    for text in texts:
        words = WORD.findall(text.lower())
        counts.append(len(words))
        ids.extend(map(vocab.__getitem__, words))
    if len(vocab) > old:
        new = list(vocab)[old:]
        memory["hash"] = np.concatenate([memory["hash"], np.fromiter((xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")) for w in new), np.uint64, len(new))])
    word = memory["hash"][np.array(ids, np.int64)]
    counts = np.array(counts, np.int64)
    ends = np.cumsum(counts)
    keys = [xxhash.xxh3_128_digest(word[e - n : e].tobytes()) if n else None for e, n in zip(ends.tolist(), counts.tolist(), strict=True)]
    # each text's words are followed by zeros if it has fewer than five
    size = np.maximum(counts, np.where(counts > 0, SHINGLE, 0))
    padded = np.zeros(int(size.sum()), np.uint64)
    shift = np.cumsum(size) - size - (ends - counts)
    padded[np.arange(len(word)) + np.repeat(shift, counts)] = word
    n = len(padded)
    value = np.zeros(n, np.uint64)
    for k in range(SHINGLE):
        value[: n - k] = value[: n - k] * np.uint64(0x9E3779B97F4A7C15) + padded[k:] if n else value
    many = np.maximum(0, size - SHINGLE + 1)
    at = np.arange(int(many.sum())) + np.repeat((np.cumsum(size) - size) - (np.cumsum(many) - many), many)
    return _mix(value[at]), many, keys


def _seeds(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240607)
    return rng.integers(1, 1 << 32, n, dtype=np.uint64).astype(np.uint32) | np.uint32(1), rng.integers(0, 1 << 32, n, dtype=np.uint64).astype(np.uint32)


def signatures(value: np.ndarray, many: np.ndarray, n_hashes: int) -> np.ndarray:
    """MinHash values, one row for each text that has shingles."""
    rows = many > 0
    begin = (np.cumsum(many) - many)[rows]
    low = (value ^ (value >> np.uint64(32))).astype(np.uint32)
    high = (value >> np.uint64(40)).astype(np.uint32)
    a, b = _seeds(n_hashes)
    out = np.empty((int(rows.sum()), n_hashes), np.uint32)
    work = np.empty_like(low)
    for k in range(n_hashes):
        np.multiply(low, a[k], out=work)
        work ^= (work >> np.uint32(15)) ^ (high * b[k] | np.uint32(1))
        work *= np.uint32(0x85EBCA6B)
        out[:, k] = np.minimum.reduceat(work, begin) if len(begin) else 0
    return out


def texts_of(docs: DataFrame, id_col: str, text_col: str, trees: int, depths: list[int]) -> DataFrame:
    """id, exact (hash of the raw text), key (hash of the word sequence, null without words), and the
    text's nodes, tree by tree from the longest prefix, as 64-bit hashes (null where a slice has them already)."""
    memory: dict = {}
    top = max(depths)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(f"`{text_col}`").alias("exact"), F.col(f"`{text_col}`").alias("x"))

    def run(cols):
        texts = [t or "" for t in cols[2]]
        for a, b in slices(texts, 1 << 20):
            value, many, keys = shingles(texts[a:b], memory)
            first: dict[bytes, int] = {}
            for k, key in enumerate(keys):
                if key:
                    first.setdefault(key, k)
            pick = np.array(sorted(first.values()), np.int64)
            nodes: list = [None] * (b - a)
            if len(pick):
                sig = signatures(value, many, trees * top)[(np.cumsum(many > 0) - 1)[pick]].astype(np.uint64)
                levels = []
                for t in range(trees):
                    now, by_depth = np.full(len(pick), t + 1, np.uint64), {}
                    for d in range(top):
                        now = by_depth[d + 1] = _mix((now + sig[:, t * top + d]) * np.uint64(0x9E3779B97F4A7C15))
                    levels += [by_depth[d].view(np.int64) for d in depths]
                for k, own in zip(pick.tolist(), np.stack(levels, 1), strict=True):
                    nodes[k] = own
            yield [cols[0][a:b], cols[1][a:b], keys, nodes]

    return map_batches(rows, ["id", "exact", "x"], run, f"id {rows.schema['id'].dataType.simpleString()}, exact long, key binary, nodes array<long>")


def sets_of(docs: DataFrame, text_col: str) -> DataFrame:
    """key and sorted distinct shingle hashes of every row."""
    memory: dict = {}

    def run(cols):
        texts = [t or "" for t in cols[1]]
        for a, b in slices(texts, 1 << 20):
            value, many, _ = shingles(texts[a:b], memory)
            ends = np.cumsum(many)
            yield [cols[0][a:b], [np.unique(value[e - n : e]).view(np.int64) for e, n in zip(ends.tolist(), many.tolist(), strict=True)]]

    return map_batches(docs, ["key", text_col], run, "key binary, shingles array<long>")


def _maybe_broadcast(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= SMALL_ROWS else df


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each connected component, by large and small stars.

    Each round points a node's larger neighbours (large star), then its smaller ones (small star),
    to the smallest; a written table ends each round's lineage.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    edges = stored(edges, "edges")
    while True:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        small_low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(small_low, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v").filter("u <> v").distinct()
        new = stored(small, "edges")
        change = new.exceptAll(edges).limit(1).count() or edges.exceptAll(new).limit(1).count()
        edges = new
        if not change:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, trees: int = TREES, depth: int = DEPTH, recall: float = RECALL, few: int = FEW, block: int = BLOCK) -> DataFrame:
    """id, exact (xxhash64 of the text), class_id, n_links, n_copies, stays for every row.

    class_id: smallest id of the connected texts. n_links: different texts that this row's text is
    linked to by a verified pair. n_copies: rows of the same word sequence. stays: true for the
    rows of the text and id that represent the class.
    """
    depths = list(range(depth, min_depth(threshold, recall, trees, depth) - 1, -1))
    rows = stored(texts_of(docs, id_col, text_col, trees, depths), "texts")
    worded = rows.filter("key is not null")
    classes = stored(worded.groupBy("key").agg(F.min("id").alias("rep"), F.count("*").alias("n_copies")), "classes")
    members = stored(branches(rows, trees, len(depths)), "members")
    sets = wanted_sets(docs, rows, members.select("key"), id_col, text_col)
    tags = stored(members.select("key", F.lit(True).alias("open")).distinct(), "tags")
    edges = sets.select(F.col("key").alias("a"), F.col("key").alias("b")).limit(0)
    ends = sets.select("key", F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("missed")).limit(0)
    for k, d in enumerate(depths):
        level = stored(level_of(members, tags, k), "level")
        if level.limit(1).count() == 0:
            continue
        crowd = level.filter(F.col("n") > few).groupBy("key").agg(F.collect_set("node").alias("own"))
        seen = F.array_distinct(F.flatten(F.collect_list(F.array(*(f"p{j}" for j in range(k)))))) if k else F.lit(None).cast("array<long>")
        known = level.select("key").distinct().join(tags, "key").join(crowd, "key", "left").join(members.groupBy("key").agg(seen.alias("seen")) if k else members.select("key", seen.alias("seen")).distinct(), "key")
        known = stored(known.select("key", "open", *(F.coalesce(c, F.array().cast("array<long>")).alias(c) for c in ("own", "seen"))), "known")
        small = level.filter(F.col("n") <= few).select("node", "key").join(_maybe_broadcast(known, known.count() * 8), "key")
        one, two = (small.select("node", *(F.col(c).alias(f"{c}_{side}") for c in ("key", "open", "own", "seen"))) for side in "ab")
        # a pair that also shares a large node of the level is compared there
        pairs = one.join(two, "node").filter("key_a < key_b and (open_a or open_b) and not arrays_overlap(own_a, own_b) and not arrays_overlap(seen_a, seen_b)").select(F.col("key_a").alias("a"), F.col("key_b").alias("b")).distinct()
        links = stored(verify(pairs, sets).filter(F.col("jaccard") >= threshold), "links")
        missed = 1 / chance(F.col("jaccard"), d, trees) - 1
        found = stored(compare_blocks(level.filter(F.col("n") > few).select("key", "node"), known, sets, threshold, block, d, trees), "found")
        edges = edges.unionByName(links.select("a", "b")).unionByName(found.filter("b is not null").select("a", "b"))
        new = links.select(F.explode(F.array("a", "b")).alias("key"), F.lit(1).cast("long").alias("n"), missed.alias("missed"))
        new = new.unionByName(found.filter("b is null").select(F.col("a").alias("key"), "n", "missed"))
        ends = stored(ends.unionByName(new).groupBy("key").agg(F.sum("n").alias("n"), F.sum("missed").alias("missed")), "ends")
        unmet = F.col("missed") + float(1 / chance(threshold, d, trees) - 1)
        tags = stored(tags.join(ends, "key", "left").select("key", (F.col("open") & F.coalesce(F.col("n") / (F.col("n") + unmet) < recall, F.lit(True))).alias("open")), "tags")
    ends = ends.select("key", F.col("n").alias("n_links"))
    groups = components(edges)
    text = classes.join(groups.withColumnRenamed("node", "key"), "key", "left").join(ends, "key", "left").select("key", "rep", "n_copies", F.coalesce("root", "key").alias("root"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    text = stored(text, "texts")
    # the class's smallest id, and the text that has it
    root = text.groupBy("root").agg(F.min(F.struct("rep", "key")).alias("m")).select("root", F.col("m.rep").alias("class_id"), F.col("m.key").alias("chosen"))
    text = text.join(root, "root").select("key", "class_id", "n_copies", "n_links", (F.col("key") == F.col("chosen")).alias("of_rep"))
    out = worded.join(text, "key").select("id", "exact", "class_id", "n_links", "n_copies", (F.col("of_rep") & F.col("id").eqNullSafe(F.col("class_id"))).alias("stays"))
    alone = rows.filter("key is null").select("id", "exact", F.col("id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.lit(1).cast("long").alias("n_copies"), F.lit(True).alias("stays"))
    return out.unionByName(alone).withColumnRenamed("id", id_col)


def branches(rows: DataFrame, trees: int, levels: int) -> DataFrame:
    """key and its nodes p0 (longest prefix), p1, ... in each tree where the shortest prefix has another text too."""
    own = F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.struct(*(F.get("nodes", t * levels + j).alias(f"p{j}") for j in range(levels))))
    own = rows.filter("nodes is not null").select("key", F.explode(own).alias("b")).select("key", "b.*")
    root = f"p{levels - 1}"
    # map-side minima and maxima make large groups of copies cheap
    shared = own.groupBy(root).agg(F.min("key").alias("lead"), F.max("key").alias("last")).filter("lead <> last").select(root)
    return own.join(shared, root, "left_semi").distinct()


def level_of(members: DataFrame, tags: DataFrame, k: int) -> DataFrame:
    """key, node and texts of the node (n) for the nodes of a level that have pairs to compare."""
    at = members.select("key", F.col(f"p{k}").alias("node"), (F.col(f"p{k - 1}") if k else F.lit(0)).alias("below")).join(_maybe_broadcast(tags, tags.count()), "key")
    heads = at.groupBy("node").agg(F.count("*").alias("n"), F.min("below").alias("low"), F.max("below").alias("high"), F.max("open").alias("any"))
    heads = heads.filter("n > 1 and any" + " and low <> high" * (k > 0))
    return at.select("key", "node").join(heads.select("node", "n"), "node")


def wanted_sets(docs: DataFrame, rows: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """key and shingles of the wanted keys; one row of each wanted text is read again for it."""
    wanted = stored(wanted.distinct(), "wanted")
    picked = rows.filter("key is not null").join(_maybe_broadcast(wanted, wanted.count()), "key").groupBy("key").agg(F.min(F.struct("id", "exact")).alias("m")).select("key", F.col("m.id").alias("id"), F.col("m.exact").alias("exact"))
    picked = stored(picked, "picked")
    texts = docs.select(F.col(f"`{id_col}`").alias("i"), F.col(f"`{text_col}`").alias("x"), F.xxhash64(f"`{text_col}`").alias("e"))
    texts = texts.join(_maybe_broadcast(picked, picked.count()), F.expr("i <=> id and e = exact")).select("key", "x")
    return stored(sets_of(texts, "x").dropDuplicates(["key"]), "sets")


def verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b, jaccard: exact, on whole shingle sets."""
    one, two = sets.select(F.col("key").alias("a"), F.col("shingles").alias("s")), sets.select(F.col("key").alias("b"), F.col("shingles").alias("t"))
    both = F.size(F.array_intersect("s", "t"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", (both / (F.size("s") + F.size("t") - both)).alias("jaccard"))


def spanning_links(near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of a spanning forest of a symmetric relation: one less than the members of each group."""
    new, one, two = np.ones(len(near), bool), [], []
    for root in range(len(near)):
        if not new[root]:
            continue
        new[root] = False
        front = np.array([root])
        while len(front):
            found = np.flatnonzero(near[front].any(0) & new)
            one.append(front[near[np.ix_(front, found)].argmax(0)] if len(found) else found)
            two.append(found)
            new[found] = False
            front = found
    return np.concatenate([*one, np.zeros(0, np.int64)]).astype(np.int64), np.concatenate([*two, np.zeros(0, np.int64)]).astype(np.int64)


def in_common(one: tuple[np.ndarray, np.ndarray], two: tuple[np.ndarray, np.ndarray], n: int, m: int) -> np.ndarray:
    """Values that each of n sets shares with each of m; sets are (owner, value) of their elements."""
    values = np.intersect1d(one[1], two[1])
    sides = []
    for owner, value in (one, two):
        code = np.searchsorted(values, value)
        here = np.flatnonzero(values[np.minimum(code, len(values) - 1)] == value) if len(values) else code[:0]
        here = here[np.argsort(code[here], kind="stable")]
        sides.append((owner[here], code[here]))
    both = np.zeros((n, m), np.float32)
    for at in range(0, len(values), 4096):
        parts = []
        for (owner, code), rows in zip(sides, (n, m), strict=True):
            a, b = np.searchsorted(code, [at, at + 4096])
            part = np.zeros((rows, min(4096, len(values) - at)), np.float32)
            part[owner[a:b], code[a:b] - at] = 1
            parts.append(part)
        both += parts[0] @ parts[1].T
    return both


def compare_blocks(large: DataFrame, known: DataFrame, sets: DataFrame, threshold: float, block: int, depth: int, trees: int) -> DataFrame:
    """Of the similar pairs inside nodes: (a, null, links of a, links expected to be missing) and (a, b, 0, 0)
    for links that span each group.

    A node's texts are dealt into cells by the logarithm of their size and a hash. Texts of a
    similarity of at least the threshold are in the same or in neighbouring sizes, so only cells of
    these are compared. A pair of several nodes belongs to the smallest of them.
    """
    sets = sets.join(known, "key").select("key", "shingles", "own", "seen", "open")
    width = max(-math.log(threshold), 1e-6) * (1 + 1e-9)
    sizes = sets.select("key", F.size("shingles").alias("n"), F.floor(F.log(F.size("shingles")) / width).alias("c"))
    placed = stored(large.join(sizes, "key"), "placed")
    parts = placed.groupBy("node", "c").agg(F.ceil(F.greatest(F.count("*") / block, F.sum("n") / BLOCK_SHINGLES)).alias("parts"))
    parts = stored(parts, "parts")
    placed = placed.join(parts, ["node", "c"]).select("node", "c", F.pmod(F.xxhash64("node", "key"), "parts").alias("p"), "key")
    cells = parts.select("node", "c", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("p"))
    other = cells.toDF("node", "d", "q")
    tasks = cells.join(other, "node").filter("(d = c and q >= p) or d = c + 1")
    tasks = stored(tasks, "tasks")
    task = ["node", "c", "p", "d", "q"]
    left = tasks.join(placed, ["node", "c", "p"]).select(*task, F.lit(0).alias("side"), "key")
    right = tasks.filter("c <> d or p <> q").join(placed.toDF("node", "d", "q", "key"), ["node", "d", "q"]).select(*task, F.lit(1).alias("side"), "key")
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary()), ("n", pa.int64()), ("missed", pa.float64())])

    def lists(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
        """(owner, value) of the elements of an array column."""
        column = column.combine_chunks()
        return np.repeat(np.arange(len(column)), np.asarray(column.value_lengths(), np.int64)), np.asarray(column.flatten())

    def run(group: pa.Table) -> pa.Table:
        node, twice = group.column("node")[0].as_py(), any(group.column(x)[0] != group.column(y)[0] for x, y in ("cd", "pq"))
        side = np.asarray(group.column("side"))
        keys, flat, own, seen, size, waits = [], [], [], [], [], []
        for k in (0, 1) if twice else (0,):
            part = group.filter(pa.array(side == k))
            keys.append(part.column("key").to_pylist())
            flat.append(lists(part.column("shingles")))
            size.append(np.bincount(flat[-1][0], minlength=len(part)))
            owner, nodes = lists(part.column("own"))
            own.append((owner[nodes < node], nodes[nodes < node]))
            seen.append(lists(part.column("seen")))
            waits.append(np.asarray(part.column("open")))
        n, m = len(keys[0]), len(keys[-1])
        both = in_common(flat[0], flat[-1], n, m).astype(np.float64)
        similar = both / (size[0][:, None] + size[-1][None, :] - both)
        near = (similar >= threshold) & (waits[0][:, None] | waits[-1][None, :])
        for met in (own, seen):
            near &= in_common(met[0], met[-1], n, m) == 0
        if not twice:
            np.fill_diagonal(near, False)
        missed = np.where(near, 1 / chance(np.where(near, similar, 1.0), depth, trees) - 1, 0.0)
        if twice:
            counts, unmet = np.concatenate([near.sum(1), near.sum(0)]), np.concatenate([missed.sum(1), missed.sum(0)])
            whole = np.zeros((n + m, n + m), bool)
            whole[:n, n:], whole[n:, :n] = near, near.T
        else:
            counts, unmet, whole = near.sum(1), missed.sum(1), near
        names = [x for part in keys for x in part]
        some = np.flatnonzero(counts)
        i, j = spanning_links(whole)
        one = [names[k] for k in some] + [min(names[a], names[b]) for a, b in zip(i, j, strict=True)]
        two = [None] * len(some) + [max(names[a], names[b]) for a, b in zip(i, j, strict=True)]
        zeros = np.zeros(len(i))
        return pa.table([pa.array(one, pa.binary()), pa.array(two, pa.binary()), pa.array(np.concatenate([counts[some], zeros.astype(np.int64)]), pa.int64()), pa.array(np.concatenate([unmet[some], zeros]))], schema=schema)

    return left.unionByName(right).join(sets, "key").groupBy(*task).applyInArrow(run, "a binary, b binary, n long, missed double")
