"""SimHash near-duplicates by anchor-point covering.

Fingerprints have 64 bits. Two of them that differ in at most ``2 * h + 1`` bits agree in all but at
most h bits of one half. Per half of 32 bits the anchors are the words of a covering code: the perfect
binary Golay code on 23 bits (covering radius 3) times all words on the other 9. A fingerprint's home is
its nearest anchor. A partner within h bits lies within radius + h of that anchor, so every fingerprint
is replicated to those anchors within radius + h that are home to some word at most h bits from it;
anchors beyond that cannot hold a partner. Each anchor compares its homes with all its fingerprints.
With h = 1 the halves of a pair are equal or of different parity, so it is enough that the odd one is
replicated and the even one stays at home.

Equal fingerprints are one class from the start, so thousands of copies are one row in the comparison.

``keep_one`` asks for similar texts, not for near fingerprints: five-word shingle sets with a Jaccard
similarity of at least 0.8. Its candidates are the components of SimHash fingerprints, found by the same
covering, and, since pairs at 0.8 differ in about 10 of 64 bits, too many to cover, those that share one of
several min-wise fingerprints. The shingle sets of all candidates are compared exactly.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propense.llm.common import (
    BLOCK_ROWS,
    components,
    group_bounds,
    in_blocks,
    spanning,
    stored,
    whole_groups,
)

SEED = 42
PIECE = 1 << 20
SPACE = re.compile(rb"[\x20\x09-\x0d]")
GOLAY_BITS, GOLAY_RADIUS = 23, 3
#: Generator polynomial of the binary Golay code, x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GOLAY_POLYNOMIAL = 0b101011100011
#: Shingles of near copies, and the least part of their union that two of them share.
COPY_WORDS, COPY_SHARE = 5, 0.8
#: Bits in which the SimHashes of linked candidates may differ, and those that anchors cover. At 12 bits different
#: texts of a small vocabulary are chained into large components, all of whose sets are compared.
COPY_BITS, COVERED_BITS = 6, 3
#: Min-wise fingerprints per document, and values in each. A pair with a Jaccard similarity of 0.8 has one in
#: common with probability 1 - (1 - 0.8**5)**25 = 0.99995, a more similar one with a higher one.
BANDS, BAND_ROWS = 25, 5
_DRAWN = np.random.default_rng(SEED)
_FACTORS = _DRAWN.integers(0, 2**32, (BANDS * BAND_ROWS, 1), dtype=np.uint32) | np.uint32(1)
_SHIFTS = _DRAWN.integers(0, 2**32, (BANDS * BAND_ROWS, 1), dtype=np.uint32)
_MIX = _DRAWN.integers(0, 2**64, (BANDS, BAND_ROWS), dtype=np.uint64) | np.uint64(1)
_BAND = _DRAWN.integers(0, 2**64, BANDS, dtype=np.uint64)
#: A block of near-copy candidates holds at most so many shingles per row on average, or fewer rows.
BLOCK_SHINGLES = 512


def _words(data: bytes) -> Iterator[list[bytes]]:
    """The words of a text, piece by piece, so that a long one is never held as a list."""
    at = 0
    while at < len(data):
        end = SPACE.search(data, at + PIECE) if at + PIECE < len(data) else None
        stop = end.start() if end else len(data)
        yield data[at:stop].split()
        at = stop


def _ones(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit set."""
    ones = np.zeros(64, dtype=np.int64)
    for k in range(0, len(hashes), 4096):
        bits = np.unpackbits(hashes[k : k + 4096].view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.uint16)
    return ones


def _majority(ones: np.ndarray, total: int) -> int:
    """The SimHash, as an unsigned number: bits that are set in over half of ``total`` hashes."""
    # bytes are little-endian, the bits within a byte begin with the highest
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "little")


def fingerprint(text: str | None, words: int = 3) -> int:
    """64-bit SimHash of the text's shingles, as an unsigned number; 0 without words."""
    ones, total, before = np.zeros(64, dtype=np.int64), 0, []
    for piece in _words((text or "").encode("utf-8", "surrogatepass").lower()):
        run = before + piece
        n = len(run) - words + 1
        if n > 0:
            shingles = map(b" ".join, zip(*(run[k:] for k in range(words))))
            ones += _ones(np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, n))
            total += n
        before = run[-(words - 1) :] if words > 1 else []
    if total == 0:
        return xxhash.xxh64_intdigest(b" ".join(before), SEED) if before else 0
    return _majority(ones, total)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """One row (id, fp) per row of ``docs``; ``fp`` is the fingerprint as a signed long."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            prints = np.array([fingerprint(t, words) for t in batch["text"]], dtype=np.uint64)
            yield pd.DataFrame({"id": batch["id"], "fp": prints.view(np.int64)})

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInPandas(run, f"id {dict(rows.dtypes)['id']}, fp long")


#: Tables of the code that a task has made already, by reach.
_TABLES: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}


def _golay(reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of single bits; by syndrome the error to the nearest anchor, and errors to all replicas.

    The errors to replicas of a word lead to the nearest anchors of all words at most ``reach`` bits away.
    """
    if reach in _TABLES:
        return _TABLES[reach]
    single = np.zeros(GOLAY_BITS, dtype=np.int64)
    for bit in range(GOLAY_BITS):
        value = 1 << bit
        while value.bit_length() > 11:
            value ^= GOLAY_POLYNOMIAL << (value.bit_length() - 12)
        single[bit] = value
    near = np.zeros(2048, dtype=np.int64)
    for weight in range(1, GOLAY_RADIUS + 1):
        for bits in combinations(range(GOLAY_BITS), weight):
            near[np.bitwise_xor.reduce(single[list(bits)])] = sum(1 << b for b in bits)
    flips = [(0, 0)] + [
        (sum(1 << b for b in bits), int(np.bitwise_xor.reduce(single[list(bits)])))
        for weight in range(1, reach + 1)
        for bits in combinations(range(GOLAY_BITS), weight)
    ]
    # error of a word to the anchor nearest to (word xor flip), with the number of flips spent
    errors = [
        sorted({}.fromkeys(flip ^ int(near[s ^ shift]) for flip, shift in flips)) for s in range(2048)
    ]
    width = max(map(len, errors))
    padded = np.array([e + [-1] * (width - len(e)) for e in errors], dtype=np.int64)
    _TABLES[reach] = single, near, padded
    return single, near, padded


def anchors(prints: np.ndarray, threshold: int = 2) -> tuple[np.ndarray, ...]:
    """(row, anchor, home, visited) of all replicas of the fingerprints (unsigned) for ``threshold`` bits.

    ``visited`` marks homes that replicas of other fingerprints may be compared with.
    """
    reach = threshold // 2
    single, near, errors = _golay(reach)
    rows, names, homes, visited = [], [], [], []
    tail_flips = [
        sum(1 << b for b in bits) for w in range(reach + 1) for bits in combinations(range(9), w)
    ]
    for half in (0, 1):
        word = ((prints >> np.uint64(32 * half)) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        head, tail = word & ((1 << GOLAY_BITS) - 1), word >> GOLAY_BITS
        syndrome = np.zeros(len(word), dtype=np.int64)
        for bit in range(GOLAY_BITS):
            syndrome ^= ((head >> bit) & 1) * single[bit]
        nearest = head ^ near[syndrome]
        # a replica away from home has a partner of the other parity (h = 1), see above
        away = (np.bitwise_count(word) & 1).astype(bool) | (reach > 1)
        for column in range(errors.shape[1]):
            error = errors[syndrome, column]
            for flip in tail_flips:
                anchor = head ^ error
                # a flip in the other bits leaves fewer for the head; with one flip in all the head's
                # anchor is then the nearest one
                home = (anchor == nearest) & (flip == 0)
                ok = (error >= 0) & ((flip == 0) | (anchor == nearest) | (reach > 1)) & (home | away)
                at = np.flatnonzero(ok)
                rows.append(at)
                names.append((half << 32) | ((tail[at] ^ flip) << GOLAY_BITS) | anchor[at])
                homes.append(home[at])
                visited.append(home[at] & ~away[at] | (reach > 1))
    return tuple(map(np.concatenate, (rows, names, homes, visited)))


def _compare(frame: pd.DataFrame, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """Star edges between fingerprints of each bucket that differ in at most ``threshold`` bits."""
    bounds = group_bounds(frame, ["bucket", "block_i", "block_j"])
    prints, home = frame["fp"].to_numpy(), frame["home"].to_numpy()
    own, across = frame["side"].to_numpy(), (frame["block_i"] != frame["block_j"]).to_numpy()
    found_a, found_b = [], []
    for begin, end in zip(bounds[:-1], bounds[1:]):
        x, h, side = prints[begin:end], home[begin:end], own[begin:end]
        at = np.flatnonzero(h)
        pairs_a, pairs_b = [], []
        for k in range(0, len(at), 256):
            some = at[k : k + 256]
            near = np.bitwise_count((x[some, None] ^ x[None, :]).view(np.uint64)) <= threshold
            if across[begin]:  # rows of one block meet in the task of that block alone
                near &= side[some, None] != side[None, :]
            i, j = np.nonzero(near)
            keep = some[i] != j
            if keep.any():
                a, b = spanning(x[some[i[keep]]], x[j[keep]])
                pairs_a.append(a)
                pairs_b.append(b)
        if pairs_a:
            a, b = spanning(np.concatenate(pairs_a), np.concatenate(pairs_b))
            found_a.append(a)
            found_b.append(b)
    none = np.zeros(0, dtype=np.int64)
    return np.concatenate([none, *found_a]), np.concatenate([none, *found_b])


def links(
    prints: DataFrame, threshold: int = 2, block_rows: int = BLOCK_ROWS, covered: int | None = None
) -> DataFrame:
    """Edges (a, b) that connect all distinct fingerprints ``fp`` within ``threshold`` bits of each other.

    The edges span the same components as all links do; a group of g near fingerprints gives fewer than g
    of them per anchor. With ``covered`` bits below the threshold, all links of so many bits are found (also
    those with ``covered // 2`` in a half), and further ones where the two share an anchor.
    """
    covered = threshold if covered is None else covered

    def replicate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values = batch["fp"].to_numpy()
            for k in range(0, len(values), 10_000):
                part = values[k : k + 10_000]
                rows, names, homes, visited = anchors(part.view(np.uint64), covered)
                yield pd.DataFrame({"bucket": names, "fp": part[rows], "home": homes, "visited": visited})

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in whole_groups(batches, ["bucket", "block_i", "block_j"]):
            a, b = _compare(frame, threshold)
            yield pd.DataFrame({"a": a, "b": b})

    replicas = prints.select("fp").mapInPandas(replicate, "bucket long, fp long, home boolean, visited boolean")
    sizes = (
        replicas.groupBy("bucket")
        .agg(F.count("*").alias("size"), F.count_if("home").alias("homes"), F.max("visited").alias("visited"))
        .where("homes > 1 or size > 1 and visited")
        .select("bucket", "size")
    )
    dealt = in_blocks(replicas.drop("visited").join(sizes, "bucket"), "bucket", "size", F.col("fp"), block_rows)
    return dealt.mapInPandas(compare, "a long, b long")


def _named(classes: DataFrame, roots: DataFrame, node: str) -> DataFrame:
    """(node, component_id) of all ``classes`` (node, first_id): the smallest id of the node's component."""
    linked = classes.join(roots.withColumnRenamed("node", node), node)
    lowest = linked.groupBy("root").agg(F.min("first_id").alias("lowest"))
    named = linked.join(lowest, "root").select(node, "lowest")
    return classes.join(named, node, "left").select(node, F.coalesce("lowest", "first_id").alias("component_id"))


def simhash_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, threshold: int = 2
) -> DataFrame:
    """(id, fp, component_id) per distinct (id, fp) of ``docs``.

    ``component_id`` is the smallest id reachable over links of at most ``threshold`` differing bits. Null
    and empty texts and texts of white space alone have fingerprint 0 and are linked like any other. A row
    with a null id has its fingerprint and its component's smallest id (null if there is none). Repeated
    rows are one row; rows that repeat an id with other texts stay apart. Only the two named columns are
    read, so others cannot clash. An empty table gives none.
    """
    prints = stored(fingerprints(docs, id_col, text_col, words), "simhash-prints")
    classes = stored(prints.groupBy("fp").agg(F.min("id").alias("first_id")), "simhash-classes")
    roots = components(links(classes, threshold), "simhash-components")
    classes = _named(classes, roots, "fp")
    return prints.distinct().join(classes, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def shingle_set(text: str | None, words: int = COPY_WORDS) -> np.ndarray:
    """Sorted hashes of the text's distinct shingles; one of all its words if they are fewer; none without."""
    found, before = [], []
    for piece in _words((text or "").encode("utf-8", "surrogatepass").lower()):
        run = before + piece
        n = len(run) - words + 1
        if n > 0:
            shingles = map(b" ".join, zip(*(run[k:] for k in range(words))))
            found.append(np.unique(np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, n)))
        before = run[-(words - 1) :] if words > 1 else []
    if not found:
        return np.array([xxhash.xxh64_intdigest(b" ".join(before), SEED)] if before else [], dtype=np.uint64)
    return found[0] if len(found) == 1 else np.unique(np.concatenate(found))


def bands(hashes: np.ndarray) -> np.ndarray:
    """The min-wise fingerprints of a set of hashes, as signed longs that tell the bands apart; none if empty."""
    if not len(hashes):
        return np.zeros(0, dtype=np.int64)
    values = (hashes >> np.uint64(32)).astype(np.uint32)
    low = np.full(BANDS * BAND_ROWS, 2**32 - 1, dtype=np.uint32)
    for k in range(0, len(values), 1024):
        np.minimum(low, (values[k : k + 1024] * _FACTORS + _SHIFTS).min(axis=1), out=low)
    return ((low.reshape(BANDS, BAND_ROWS) * _MIX).sum(axis=1, dtype=np.uint64) + _BAND).view(np.int64)


def _resembling(frame: pd.DataFrame, share: float) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect the keys of each bucket whose sets have at least ``share`` of their union in common.

    Every edge is such a pair. Sets that are connected already are not compared again, so a group of near
    copies costs about one pass over its shingles.
    """
    bounds = group_bounds(frame, ["bucket", "block_i", "block_j"])
    keys, sets, sides = frame["key"].to_numpy(), frame["hashes"].to_numpy(), frame["side"].to_numpy()
    across = (frame["block_i"] != frame["block_j"]).to_numpy()
    found_a, found_b = [], []
    for begin, end in zip(bounds[:-1], bounds[1:]):
        lengths = np.array([len(s) for s in sets[begin:end]])
        ends = np.cumsum(lengths)
        tokens = np.unique(np.concatenate(sets[begin:end]), return_inverse=True)[1]
        there = np.zeros(len(tokens), dtype=bool)
        key, side, label = keys[begin:end], sides[begin:end], np.arange(end - begin)
        for i in range(end - begin - 1):
            other = label[i + 1 :] != label[i]
            if across[begin]:  # rows of one block meet in the task of that block alone
                other &= side[i + 1 :] != side[i]
            least, most = np.minimum(lengths[i], lengths[i + 1 :]), np.maximum(lengths[i], lengths[i + 1 :])
            other &= least / most >= share
            if not other.any():
                continue
            own = tokens[ends[i] - lengths[i] : ends[i]]
            there[own] = True
            common = np.add.reduceat(there[tokens[ends[i] :]], ends[i:-1] - ends[i], dtype=np.int64)
            there[own] = False
            near = np.flatnonzero(other & (common / (least + most - common) >= share)) + i + 1
            if len(near):
                one_each = near[np.unique(label[near], return_index=True)[1]]
                found_a.append(np.full(len(one_each), key[i]))
                found_b.append(key[one_each])
                label[np.isin(label, label[one_each])] = label[i]
    none = np.zeros(0, dtype=np.int64)
    return np.concatenate([none, *found_a]), np.concatenate([none, *found_b])


def copy_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """(id, component_id) per distinct id and shingle set of ``docs``, with links between near copies.

    Near copies have five-word shingle sets with a Jaccard similarity of at least 0.8; a text of fewer words
    is one shingle. Candidates are in one component of SimHash fingerprints (of the sets) or share a
    min-wise fingerprint (``BANDS``); every link is compared exactly, on 64-bit hashes of the shingles. Equal
    sets are one class, texts without words among them.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(text).alias("hash"))

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text in batch["text"]:
                hashes = shingle_set(text)
                key = np.uint64(xxhash.xxh64_intdigest(hashes.tobytes(), SEED)).view(np.int64)
                fp = np.uint64(_majority(_ones(hashes), len(hashes))).view(np.int64)
                out.append((key, fp, len(hashes), bands(hashes)))
            columns = ["key", "fp", "shingles", "bands"]
            yield pd.concat([batch[["id", "hash"]], pd.DataFrame(out, columns=columns, index=batch.index)], axis=1)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            hashes = [shingle_set(text).view(np.int64) for text in batch["text"]]
            yield pd.DataFrame({"key": batch["key"], "hashes": hashes})

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in whole_groups(batches, ["bucket", "block_i", "block_j"]):
            a, b = _resembling(frame, COPY_SHARE)
            yield pd.DataFrame({"a": a, "b": b})

    prints = stored(
        rows.mapInPandas(
            sign, f"id {dict(rows.dtypes)['id']}, hash long, key long, fp long, shingles long, bands array<long>"
        ),
        "copies-prints",
    )
    classes = stored(
        prints.groupBy("key").agg(
            F.min("id").alias("first_id"), F.min("hash").alias("hash"), F.first("fp").alias("fp"),
            F.first("shingles").alias("shingles"), F.first("bands").alias("bands"),
        ),
        "copies-classes",
    )
    # a component of near fingerprints is a bucket like the min-wise ones; the set without shingles is in none
    prints_of_sets = classes.where("shingles > 0").select("fp").distinct()
    near = components(links(prints_of_sets, COPY_BITS, block_rows, COVERED_BITS), "copies-simhash")
    named = classes.where("shingles > 0").join(near.withColumnRenamed("node", "fp"), "fp", "left")
    places = F.concat("bands", F.array(F.coalesce("root", "fp")))
    buckets = named.select("key", "hash", "shingles", F.explode(places).alias("bucket"))
    # a bucket of long texts has more blocks, but no more than rows
    by_length = F.least(F.ceil(F.sum("shingles") / BLOCK_SHINGLES), F.count("*") * block_rows)
    sizes = buckets.groupBy("bucket").agg(F.count("*").alias("n"), F.greatest(F.count("*"), by_length).alias("size"))
    shared = buckets.join(sizes.where("n > 1").drop("n"), "bucket").select("bucket", "key", "hash", "size")
    shared = stored(shared, "copies-buckets")
    # shingles are made again for those that share a bucket; few do
    wanted = shared.select("key", "hash").distinct()
    texts = rows.drop("id").join(wanted, "hash").dropDuplicates(["key"])
    sets = stored(texts.mapInPandas(read, "key long, hashes array<long>"), "copies-sets")
    dealt = in_blocks(shared.drop("hash").join(sets, "key"), "bucket", "size", F.col("key"), block_rows)
    roots = components(dealt.mapInPandas(compare, "a long, b long"), "copies-components")
    named = _named(classes.select("key", "first_id"), roots, "key")
    return prints.select("id", "key").distinct().join(named, "key").select(F.col("id").alias(id_col), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its component of near copies; all of its columns.

    Rows with a null id stay: nothing says which documents they are. Of rows repeating a kept id, all
    rows that carry it stay, as they are one document.
    """
    found = copy_components(docs, id_col, text_col)
    gone = (
        found.groupBy(id_col)
        .agg(F.min("component_id").alias("_lowest"))
        .where(F.col("_lowest") < F.col(id_col))
        .select(id_col)
    )
    return docs.join(gone, id_col, "left_anti")
