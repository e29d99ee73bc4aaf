"""MinHash near-duplicates by a multi-index Hamming join.

A document's set holds its distinct 5-word shingles (ASCII letters lower-cased;
fewer words: the whole sequence).  Documents are linked where
100 * intersection >= ``LINK`` * union, and components are those of the links.

1. Equal sets are one class; only its representative (the least id) goes on.
2. A set's signature is ``CHUNKS`` x ``WORDS`` words of ``SYMBOLS`` MinHash
   symbols of ``BITS`` bits.  The signature is split into CHUNKS chunks; a chunk
   may have one word in error, and the three ways to leave one out are
   enumerated as keys.  By the pigeonhole principle every pair whose signatures
   differ in at most 2 * CHUNKS - 1 = 35 of 216 symbols shares a key; that is the
   guarantee, and it is one on signatures.  A pair at a similarity of exactly 0.85
   differs in 32 symbols on average and in more than 35 in about a quarter of all
   cases; beyond the guarantee it is found by chance, which fails for all 54 keys
   with a probability of 1e-6 at 0.85 and of 3e-4 at 0.80.
3. Most keys are of one document and go no further.  In a bucket that is not,
   all members are grouped with the one that has most company over all its keys
   (in a family of copies, that is their source).  So a pair of a bucket meets
   in that group, once for all keys that the pair shares.
4. A group is compared on full sets, first every member with the centre: members
   are dealt by ``SHARE`` of a group together with a copy of its centre, so that a
   large family is spread over all tasks.  Members linked to the centre need no
   links among each other.
5. What is left, members not linked to their centre, meets all members of the
   group: blocks of bounded size of the one against blocks of the other, by
   counting common shingles.  A task emits a spanning forest of the links that it
   confirms and never all pairs.
6. Components come from alternating large-star and small-star steps over tables
   in the shared folder.

Nothing is capped: a large group has more shares and blocks.  Nothing that grows with the
documents reaches the driver; candidate ids and groups' block counts are
broadcast only up to ``BROADCAST_IDS`` of them, else joined by shuffle.

Edge cases: a document without words is a component of its own, as is one
without id; rows of one id are linked with each other as far as their sets
allow and share their representative; an empty table gives an empty result;
extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec as tv
from .common import partitions, removed, slices, written

SHINGLE = 5
LINK = 85
CHUNKS, WORDS, SYMBOLS, BITS = 18, 3, 4, 16
LENGTH = CHUNKS * WORDS * SYMBOLS
BLOCK_SHINGLES, BLOCK_DOCUMENTS = 500_000, 128
SHARE = 32
BROADCAST_IDS = 2_000_000
_RNG = np.random.default_rng(9173)
_TIMES = _RNG.integers(0, 1 << 32, LENGTH, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_FLIP = _RNG.integers(0, 1 << 32, LENGTH, dtype=np.uint64).astype(np.uint32)


def shingle_sets(offsets: np.ndarray, body: np.ndarray) -> list[np.ndarray]:
    """The sorted set of shingle hashes of each text."""
    n = len(offsets) - 1
    hashes, rows, _ = tv.words(body, offsets)
    runs, of = tv.shingles(hashes, rows, n, SHINGLE)
    cut = np.searchsorted(of, np.arange(n + 1))
    return [np.unique(runs[a:b]) for a, b in zip(cut[:-1], cut[1:], strict=True)]


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash symbols of each non-empty set, sets x LENGTH."""
    out = np.zeros((len(sets), LENGTH), np.uint32)
    for i, found in enumerate(sets):
        half = (found >> np.uint64(32)).astype(np.uint32)
        for a in range(0, len(half), 2048):
            least = ((half[a : a + 2048, None] ^ _FLIP) * _TIMES).min(0)
            out[i] = least if not a else np.minimum(out[i], least)
    return (out & np.uint32((1 << BITS) - 1)).astype(np.uint16)


def keys(symbols: np.ndarray) -> np.ndarray:
    """Index keys of each signature: per chunk, one for each word left out."""
    with np.errstate(over="ignore"):
        words = np.zeros((len(symbols), CHUNKS * WORDS), np.uint64)
        for i in range(SYMBOLS):
            words = tv.mix(words + symbols[:, i::SYMBOLS].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(i + 1))
        words = words.reshape(len(symbols), CHUNKS, WORDS)
        out = np.empty((len(symbols), CHUNKS, WORDS), np.uint64)
        place = np.arange(CHUNKS, dtype=np.uint64) * np.uint64(WORDS)
        for left in range(WORDS):
            key = place + np.uint64(left + 1)
            for w in range(WORDS):
                if w != left:
                    key = tv.mix(key * np.uint64(0xD6E8FEB86659FD93) + words[:, :, w])
            out[:, :, left] = key
    return out.reshape(len(symbols), CHUNKS * WORDS)


def described(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n, digest, keys) of every row; digest and keys are null for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, offsets, body in slices(batches, "text"):
            sets = shingle_sets(offsets, body)
            size = np.array([len(s) for s in sets], np.int64)
            found = keys(signatures(sets)).view(np.int64)
            empty = pa.array(size == 0)
            digest = pa.array([hashlib.blake2b(s, digest_size=16).digest() if len(s) else None for s in sets], pa.binary())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1, dtype=np.int32) * found.shape[1]), pa.array(found.ravel()))
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(size), digest, pa.compute.if_else(empty, None, lists)], ["doc_id", "n", "digest", "keys"])

    import pyarrow.compute  # noqa: F401  bound as pa.compute

    kept = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return kept.mapInArrow(run, "doc_id long, n long, digest binary, keys array<long>")


def confirmed(sets: list[np.ndarray], side: np.ndarray | None = None, link_at: int = LINK) -> list[tuple[int, int]]:
    """A spanning forest of the links among sets; with ``side``, of those between its two values."""
    n = len(sets)
    if n < 2:
        return []
    size = np.array([len(s) for s in sets])
    every = np.concatenate(sets)
    owner = np.repeat(np.arange(n), size)
    order = np.argsort(every, kind="stable")
    every, owner = every[order], owner[order]
    same = every[1:] == every[:-1]
    shared = np.append(same, False) | np.append(False, same)
    owner, column = owner[shared], np.cumsum(np.append(True, ~same))[shared]
    common = np.zeros((n, n), np.float32)
    if len(column):
        column = np.cumsum(np.append(0, column[1:] != column[:-1]))
        width = max(1, 4_000_000 // n)
        for a in range(0, int(column[-1]) + 1, width):
            lo, hi = np.searchsorted(column, [a, a + width])
            has = np.zeros((n, min(width, int(column[-1]) + 1 - a)), np.float32)
            has[owner[lo:hi], column[lo:hi] - a] = 1
            common += has @ has.T
    link = 100 * common.astype(np.int64) >= link_at * (size[:, None] + size[None, :] - common.astype(np.int64))
    link &= (size > 0)[:, None] & (size > 0)[None, :]
    if side is not None:
        link &= side[:, None] != side[None, :]
    np.fill_diagonal(link, True)
    label = np.arange(n)
    while True:
        new = np.where(link, label[None, :], n).min(1)
        if (new == label).all():
            return [(int(i), int(j)) for i, j in enumerate(label) if i != j]
        label = new


def _set(value: pa.Scalar) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), np.uint64)


def _linked(a: np.ndarray, b: np.ndarray, link: int) -> bool:
    """Whether 100 * intersection >= link * union, for sorted sets."""
    if not len(a) or not len(b) or 100 * min(len(a), len(b)) < link * max(len(a), len(b)):
        return False
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    common = int((b[at] == a).sum())
    return 100 * common >= link * (len(a) + len(b) - common)


def _stars(link: int):
    """(centre, member, linked) from shares that begin with the centre's own set: (centre, share, own, member, set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        share, middle = None, None
        for batch in batches:
            out: list[tuple[int, int, bool]] = []
            columns = [batch.column(i).to_pylist() for i in range(4)]
            for centre, number, own, member, found in zip(*columns, batch.column(4), strict=True):
                if own:
                    share, middle = (centre, number), _set(found).copy()
                elif share == (centre, number):
                    out.append((centre, member, _linked(_set(found), middle, link)))
                else:
                    raise ValueError(f"the set of {centre} is missing")
            if out:
                a, b, c = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c)], ["centre", "member", "linked"])

    return run


def _blocks(link: int):
    """Links between the two sides of blocks that come one after the other, as (centre, i, j, member, rest, set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: tuple | None = None
        ids: list[int] = []
        rest: list[bool] = []
        sets: list[np.ndarray] = []

        def links() -> list[tuple[int, int]]:
            return [(ids[a], ids[b]) for a, b in confirmed(sets, np.array(rest), link)]

        def sent(out: list[tuple[int, int]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([a for a, _ in out], pa.int64()), pa.array([b for _, b in out], pa.int64())], ["a", "b"])

        for batch in batches:
            out: list[tuple[int, int]] = []
            columns = [batch.column(i).to_pylist() for i in range(5)]
            for centre, i, j, member, side, found in zip(*columns, batch.column(5), strict=True):
                if (centre, i, j) != group:
                    out += links()
                    group, ids, rest, sets = (centre, i, j), [], [], []
                ids.append(member)
                rest.append(side)
                sets.append(_set(found).copy())
            if out:
                yield sent(out)
        if out := links():
            yield sent(out)

    return run


def components(links: DataFrame) -> tuple[DataFrame, list[str]]:
    """(node, component) for the nodes of links (a, b): component is the least node reachable; and the table's path to delete.

    Each round moves every node's larger neighbours, then its smaller ones, to
    the least of them; the edges are a star per component when nothing changes.
    """
    edges, path = written(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    while True:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large, first = written(large, "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v"))).distinct()
        small, second = written(small, "small")
        sums = [x.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first() for x in (edges, small)]
        removed(links.sparkSession, path, first)
        edges, path = small, second
        if sums[0] == sums[1]:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")), [path]


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", link: int = LINK) -> DataFrame:
    """(id, n_shingles, component_id, kept): one row for each row of df; links at a similarity of ``link`` per cent."""
    spark = df.sparkSession
    n = partitions(spark)

    def few(table: DataFrame) -> DataFrame:
        """Sent to all tasks if that is proven small, so that a large group's members stay spread over them."""
        return F.broadcast(table) if table.count() <= BROADCAST_IDS else table

    whole, _ = written(described(df, id_col, text_col), "described")
    classes = whole.where("n > 0 and doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("rep"))
    classes, class_path = written(classes, "classes")
    lists = whole.where("n > 0").join(classes.select(F.col("rep").alias("doc_id"), "digest"), ["doc_id", "digest"], "left_semi").select(F.col("doc_id").alias("member"), "n", "keys")
    dealt = lists.select("member", F.explode("keys").alias("key")).repartition(n, "key")
    company = dealt.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    buckets, bucket_path = written(dealt.join(company.hint("shuffle_hash"), "key"), "buckets")
    degree = buckets.groupBy("member").agg(F.sum(F.col("size") - 1).alias("degree"))
    ranked = buckets.join(degree, "member")
    centre = ranked.groupBy("key").agg(F.max(F.struct("degree", (-F.col("member")).alias("m"))).alias("top")).select("key", (-F.col("top.m")).alias("centre"))
    pairs = buckets.select("key", "member").join(centre, "key").select("centre", "member").distinct()
    sizes = lists.select("member", "n").distinct()
    group, group_path = written(pairs.join(sizes, "member"), "groups")
    chosen, chosen_path = written(group.select(F.col("member").alias("doc_id")).distinct(), "chosen")
    chosen = few(chosen)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, offsets, body in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array([s.tobytes() for s in shingle_sets(offsets, body)], pa.binary())], ["member", "found"])

    texts = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).join(chosen, "doc_id", "left_semi")
    found, sets_path = written(texts.select("doc_id", "text").mapInArrow(sets, "member long, found binary"), "sets")

    size = group.groupBy("centre").agg(F.count("*").alias("members"), F.sum("n").alias("shingles"))
    size, size_path = written(size.withColumn("shares", F.ceil(F.col("members") / SHARE).cast("int")), "sizes")
    sized = few(size)
    others = group.where("member <> centre").join(sized, "centre").select("centre", F.pmod(F.xxhash64("member"), F.col("shares")).cast("int").alias("share"), F.lit(False).alias("own"), "member")
    middles = size.select("centre", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"), F.lit(True).alias("own"), F.col("centre").alias("member"))
    ready = others.unionByName(middles).join(found, "member").select("centre", "share", "own", "member", "found")
    stars = ready.repartition(n, "centre", "share").sortWithinPartitions("centre", "share", F.desc("own")).mapInArrow(_stars(link), "centre long, member long, linked boolean")
    stars, stars_path = written(stars, "stars")

    rest = stars.where("not linked").select("centre", "member")
    left = rest.groupBy("centre").agg(F.count("*").alias("rest"))
    many = lambda count, shingles: F.greatest(F.ceil(shingles / BLOCK_SHINGLES), F.ceil(count / BLOCK_DOCUMENTS)).cast("int")
    parts, parts_path = written(left.join(size, "centre").select("centre", many(F.col("rest"), F.col("shingles") * F.col("rest") / F.col("members")).alias("rows"), many(F.col("members"), F.col("shingles")).alias("columns")), "parts")
    parts = few(parts)
    dealt = lambda df, by, across, side: df.join(parts, "centre").select("centre", F.pmod(F.xxhash64("member"), F.col(by)).cast("int").alias(by), F.explode(F.sequence(F.lit(0), F.col(across) - 1)).alias(across), "member", F.lit(side).alias("side"))
    blocks = dealt(rest, "rows", "columns", True).unionByName(dealt(group.select("centre", "member"), "columns", "rows", False))
    ready = blocks.join(found, "member").select("centre", F.col("rows").alias("i"), F.col("columns").alias("j"), "member", "side", "found")
    confirmed_ = ready.repartitionByRange(n, "centre", "i", "j").sortWithinPartitions("centre", "i", "j").mapInArrow(_blocks(link), "a long, b long")
    every = stars.where("linked").select(F.col("centre").alias("a"), F.col("member").alias("b")).unionByName(confirmed_)
    found, found_path = written(every, "links")
    component, component_paths = components(found)
    removed(spark, bucket_path, group_path, size_path, chosen_path, sets_path, stars_path, parts_path, found_path)
    named = classes.join(component, classes.rep == component.node, "left").select("digest", F.coalesce("component", "rep").alias("component"))
    named, _ = written(named, "named")
    removed(spark, class_path, *component_paths)
    rows = whole.select("doc_id", "n", "digest").join(named, "digest", "left")
    component_id = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return rows.select(F.col("doc_id").alias(id_col), F.col("n").alias("n_shingles"), component_id.alias("component_id"), F.coalesce(component_id == F.col("doc_id"), F.lit(True)).alias("kept"))


def kept_rows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", link: int = LINK) -> DataFrame:
    """df's rows that their component keeps, with all their columns; rows of a null id stay."""
    gone = near_duplicates(df, id_col, text_col, link).where("not kept").select(id_col).distinct()
    return df.join(gone, id_col, "left_anti").select(df.columns)
