"""Removal of repeated substrings by bucket-pointer refinement over sampled suffixes.

A byte goes if it lies in a ``LENGTH``-byte string that also starts in a document with a smaller id. All
suffixes of a corpus are too many to sort, and most need no sorting: of the q-grams in a string's first
``LENGTH`` bytes one is smallest by hash, and equal strings have the same one. Those q-grams are the
initial buckets.

1. Buckets: each document names the smallest q-grams of its strings; a bucket met in a single document is
   done, its strings are unique.
2. Refinement: the strings in shared buckets are sorted on the identifiers of q-grams at later offsets,
   which gives identifiers of twice the length, and those again give the next ones (16, 32, 50 bytes). A
   string that is alone with its document drops out early. What is left in a bucket is equal, and the
   smallest id in it is the string's first document.
3. Removal: strings in shared buckets that are not first ones mark their bytes.

Before anything moves, each task compares what it has itself and sends a string of its own only if no
smaller id in the task holds it, so a passage in a third of all documents reaches a bucket once per task.
Copies of whole texts are set apart at the start; the removal of a copy is known.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propense.llm.common import stored

LENGTH, GRAM = 50, 16
#: Offsets of the identifiers that are joined: 16 + 16 bytes, then 32 + 32 bytes that overlap, 50 in all.
OFFSETS = (16, 18)
#: Windows per step of a long text; seeds and candidate bytes a task gathers before it sends them.
PIECE, SEEDS, CANDIDATES = 1 << 18, 1_000_000, 1 << 21
#: Bytes of text per bucket of the exchange, which fixes their number, and bits of a q-gram's name beside it.
BUCKET_BYTES, MAX_BUCKETS, NAME_BITS = 1 << 20, 1 << 24, 40
BASE, MIX = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)
NO_ONE = np.iinfo(np.int64).min


def _join(names: np.ndarray, offset: int) -> np.ndarray:
    """Identifiers of longer strings from those at a place and ``offset`` bytes on."""
    both = (names[:-offset] ^ (names[:-offset] >> np.uint64(31))) * MIX + names[offset:]
    return (both ^ (both >> np.uint64(29))) * MIX


def _grams(data: np.ndarray) -> np.ndarray:
    """Identifier of the q-gram at each place."""
    names, length, power = data.astype(np.uint64) + np.uint64(1), 1, BASE
    while length < GRAM:
        names = names[:-length] * power + names[length:]
        with np.errstate(over="ignore"):
            power = power * power
        length *= 2
    names = (names ^ (names >> np.uint64(32))) * MIX
    return names ^ (names >> np.uint64(29))


def _window_min(values: np.ndarray, width: int) -> np.ndarray:
    size, n = 1, len(values) - width + 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    return np.minimum(values[:n], values[width - size : width - size + n])


def _smallest(data: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(first place, smallest q-gram of the string at each place), piece by piece."""
    for begin in range(0, len(data) - LENGTH + 1, PIECE):
        part = data[begin : begin + PIECE + LENGTH - 1]
        yield begin, _window_min(_grams(part), LENGTH - GRAM + 1)


def _runs(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first place, number of places, q-gram) of the runs of strings with one smallest q-gram."""
    starts, values, total = [], [], 0
    for begin, low in _smallest(data):
        change = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))
        starts.append(begin + change)
        values.append(low[change])
        total = begin + len(low)
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    first = np.concatenate(starts)
    return first, np.diff(np.append(first, total)), np.concatenate(values)


def _names(grams: np.ndarray, bits: int) -> np.ndarray:
    """Name of a bucket: ``bits`` that deal it to an exchange bucket, above ``NAME_BITS`` more."""
    mixed = grams * np.uint64(0xD6E8FEB86659FD93)
    low = mixed & np.uint64((1 << NAME_BITS) - 1)
    return low | ((mixed >> np.uint64(64 - bits)) << np.uint64(NAME_BITS) if bits else np.uint64(0))


def _bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)


def _firsts(data: np.ndarray, at: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Which of the strings at ``at`` no smaller owner holds; ``owner`` ascends."""
    first = np.ones(len(at), dtype=bool)
    names, alive = _grams(data), np.arange(len(at))
    for step, offset in enumerate(OFFSETS):
        names = _join(names, offset)
        key = names[at[alive]]
        order = np.argsort(key, kind="stable")
        ranked, who = key[order], owner[alive[order]]
        begin = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]])) if len(order) else order
        size = np.diff(np.append(begin, len(order)))
        lowest = np.repeat(who[begin], size)
        if step == len(OFFSETS) - 1:
            first[alive[order]] = who == lowest
        else:
            shared = np.repeat(who[begin + size - 1], size) != lowest
            alive = np.sort(alive[order[shared]])
    return first


def _places(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """All places of runs, one after another."""
    before = np.cumsum(count) - count
    return np.arange(count.sum()) - np.repeat(before - start, count)


def _consecutive(keep: np.ndarray, run: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first index, number) of the stretches of ``keep`` that follow each other within one run."""
    if not len(keep):
        return keep, keep
    new = np.concatenate([[True], (np.diff(keep) > 1) | (np.diff(run[keep]) > 0)])
    return keep[new], np.diff(np.append(np.flatnonzero(new), len(keep)))


def shared_buckets(docs: DataFrame, bits: int) -> DataFrame:
    """(doc_id, names): the buckets of each document that other documents have as well."""
    n_buckets = 1 << bits
    code = zstandard.ZstdCompressor  # made in the tasks

    def send(ids: list, names: list) -> Iterator[pd.DataFrame]:
        """One entry per bucket and task; the other holders of a bucket met twice know enough already."""
        doc, name = np.concatenate(ids), np.concatenate(names)
        order = np.lexsort((doc, name))
        doc, name = doc[order], name[order]
        begin = np.concatenate([[True], name[1:] != name[:-1]])
        size = np.diff(np.append(np.flatnonzero(begin), len(name)))
        multiple = np.repeat(size > 1, size)
        lone = np.where(multiple, NO_ONE, doc)[begin]
        rows = [(np.int64(0), lone, name[begin]), (np.int64(n_buckets), doc[multiple], name[multiple])]
        for extra, who, what in rows:
            where = (what >> np.uint64(NAME_BITS)).astype(np.int64) if extra == 0 else who % n_buckets
            order = np.lexsort((who, where))
            where, who, what = where[order], who[order], what[order]
            cuts = np.append(np.flatnonzero(np.concatenate([[True], where[1:] != where[:-1]])), len(where))
            if not len(where):
                continue
            width = NAME_BITS // 8 if extra == 0 else 8
            raw = np.ascontiguousarray(what.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width])
            pack = code(level=1).compress
            out = [
                (int(where[a] + extra), raw[a:b].tobytes(), pack(np.diff(who[a:b], prepend=0).tobytes()))
                for a, b in zip(cuts[:-1], cuts[1:])
            ]
            yield pd.DataFrame(out, columns=["bucket", "names", "docs"])

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, names, held = [], [], 0
        for batch in batches:
            for doc, text in zip(batch["doc_id"], batch["text"]):
                found = np.unique(_names(np.unique(_runs(_bytes(text))[2]), bits))
                if len(found):
                    ids.append(np.full(len(found), doc, dtype=np.int64))
                    names.append(found)
                    held += len(found)
                if held >= SEEDS:
                    yield from send(ids, names)
                    ids, names, held = [], [], 0
        if held:
            yield from send(ids, names)

    def meet(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        known = key[0] >= n_buckets
        width = 8 if known else NAME_BITS // 8
        unpack = zstandard.ZstdDecompressor().decompress
        doc = np.concatenate([np.cumsum(np.frombuffer(unpack(d), np.int64)) for d in frame["docs"]])
        raw = np.frombuffer(b"".join(frame["names"]), np.uint8).reshape(-1, width)
        name = np.zeros((len(raw), 8), np.uint8)
        name[:, :width] = raw
        name = name.view("<u8").ravel()
        if not known:
            name = name | np.uint64(int(key[0]) << NAME_BITS)
            _, place, number = np.unique(name, return_inverse=True, return_counts=True)
            keep = (number[place] > 1) & (doc != NO_ONE)
            doc, name = doc[keep], name[keep]
        return pd.DataFrame({"doc_id": doc, "name": name.view(np.int64)})

    sent = docs.select("doc_id", "text").mapInPandas(gather, "bucket long, names binary, docs binary")
    met = sent.groupBy("bucket").applyInPandas(meet, "doc_id long, name long")
    return met.groupBy("doc_id").agg(F.collect_set("name").alias("names"))


def _candidates(data: np.ndarray, names: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first place, number, bucket name) of the runs of strings in shared buckets."""
    start, count, grams = _runs(data)
    name = _names(grams, bits)
    shared = np.isin(name, np.asarray(names, dtype=np.int64).view(np.uint64))
    return start[shared], count[shared], name[shared]


def first_strings(packed: DataFrame, bits: int) -> DataFrame:
    """(doc_id, text_hash, start, count): runs of strings in shared buckets that no smaller id holds."""

    def send(held: list) -> Iterator[pd.DataFrame]:
        """The strings of the task's documents that are first in the task, by exchange bucket."""
        held.sort(key=lambda h: h[0])
        pieces, at, owner, begin = [], [], [], 0
        for doc, _, data, start, count, _ in held:
            # a document's candidates are near each other: its text is taken once
            pieces.append(data)
            at.append(begin + _places(start, count))
            owner.append(np.full(count.sum(), doc, dtype=np.int64))
            begin += len(data)
        data, at, owner = np.concatenate(pieces), np.concatenate(at), np.concatenate(owner)
        keep = np.flatnonzero(_firsts(data, at, owner))
        if not len(keep):
            return
        counts = np.concatenate([h[4] for h in held])
        run = np.repeat(np.arange(len(counts)), counts)
        head, count = _consecutive(keep, run)
        which = np.repeat(np.arange(len(held)), [len(h[3]) for h in held])[run[head]]
        offset = np.cumsum([0] + [len(h[2]) for h in held[:-1]])
        bucket = (np.concatenate([h[5] for h in held])[run[head]] >> np.uint64(NAME_BITS)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        head, count, which, bucket = head[order], count[order], which[order], bucket[order]
        ids = np.array([(h[0], h[1]) for h in held], dtype=np.int64)
        runs = np.column_stack([ids[which], at[head] - offset[which], count])
        text = data[_places(at[head], count + LENGTH - 1)]
        cuts = np.append(np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])), len(bucket))
        ends = np.concatenate([[0], np.cumsum(count + LENGTH - 1)])[cuts]
        yield pd.DataFrame(
            {
                "bucket": bucket[cuts[:-1]],
                "runs": [runs[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])],
                "text": [text[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])],
            }
        )

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unpack = zstandard.ZstdDecompressor().decompress
        held, size = [], 0
        for batch in batches:
            for doc, text_hash, text, names in zip(batch["doc_id"], batch["text_hash"], batch["packed"], batch["names"]):
                data = np.frombuffer(unpack(text), np.uint8)
                start, count, name = _candidates(data, names, bits)
                if len(start):
                    held.append((doc, text_hash, data, start, count, name))
                    size += len(data)
                if size >= CANDIDATES:
                    yield from send(held)
                    held, size = [], 0
        if held:
            yield from send(held)

    def refine(frame: pd.DataFrame) -> pd.DataFrame:
        runs = np.frombuffer(b"".join(frame["runs"]), np.int64).reshape(-1, 4)
        data = np.frombuffer(b"".join(frame["text"]), np.uint8)
        length = runs[:, 3] + LENGTH - 1
        begin = np.cumsum(length) - length
        order = np.argsort(runs[:, 0], kind="stable")
        runs, begin = runs[order], begin[order]
        at = _places(begin, runs[:, 3])
        run = np.repeat(np.arange(len(runs)), runs[:, 3])
        keep = np.flatnonzero(_firsts(data, at, runs[run, 0]))
        head, count = _consecutive(keep, run)
        mine = runs[run[head]]
        start = mine[:, 2] + at[head] - begin[run[head]]
        return pd.DataFrame({"doc_id": mine[:, 0], "text_hash": mine[:, 1], "start": start, "count": count})

    # runs: doc_id, text_hash, first place and number of strings; text: their bytes, one run after another
    kinds = "bucket long, runs binary, text binary"
    return (
        packed.mapInPandas(gather, kinds)
        .groupBy("bucket")
        .applyInPandas(refine, "doc_id long, text_hash long, start long, count long")
    )


def removed_runs(data: np.ndarray, names: np.ndarray | None, firsts: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the maximal runs of bytes covered by shared strings that are not first ones."""
    if names is None or len(names) == 0 or len(data) < LENGTH:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    start, count, _ = _candidates(data, names, bits)
    n = len(data) - LENGTH + 1
    edge = np.zeros(n + 1, dtype=np.int32)
    np.add.at(edge, start, 1)
    np.add.at(edge, start + count, -1)
    kept = np.zeros(n + 1, dtype=np.int32)
    if len(firsts):
        np.add.at(kept, firsts[:, 0], 1)
        np.add.at(kept, firsts[:, 0] + firsts[:, 1], -1)
    gone = (np.cumsum(edge[:-1]) > 0) & (np.cumsum(kept[:-1]) == 0)
    at = np.flatnonzero(gone)
    if not len(at):
        return at, at
    new = np.concatenate([[True], np.diff(at) > LENGTH])
    return at[new], at[np.append(np.flatnonzero(new)[1:] - 1, len(at) - 1)] + LENGTH


def _pack(docs: DataFrame) -> DataFrame:
    """Texts as compressed bytes, for the exchanges."""

    @F.pandas_udf("binary")
    def compress(texts: pd.Series) -> pd.Series:
        pack = zstandard.ZstdCompressor(level=3).compress
        return texts.map(lambda t: pack(t.encode("utf-8", "surrogatepass")))

    return docs.withColumn("packed", compress("text")).drop("text")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per row of ``docs``: id, n_bytes, n_removed, n_spans, kept_sha256, and the removed ``spans``.

    ``spans`` is an array of (start, end) in UTF-8 bytes, end exclusive. Ids are whole numbers. Rows with a
    null id stay whole and count for no one; rows that repeat an id do not remove each other's bytes.
    Null and empty texts have no bytes. Only the named columns are read. An empty table gives none.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    ).withColumn("text_hash", F.xxhash64("text"))
    brief = rows.select("doc_id", "text_hash", F.md5("text").alias("digest"), F.octet_length("text").alias("n"))
    brief = stored(brief.where(F.col("doc_id").isNotNull() & (F.col("n") >= LENGTH)), "substring-texts")
    size = brief.agg(F.sum(F.col("n").cast("long"))).first()[0] or 0
    bits = max(size // BUCKET_BYTES, 1).bit_length()
    bits = min(max(bits, 8), MAX_BUCKETS.bit_length() - 1)
    lowest = brief.groupBy("digest").agg(F.min("doc_id").alias("lowest"), F.max("doc_id").alias("highest"))
    lowest = lowest.where("lowest < highest").select("digest", "lowest")
    copies = brief.join(lowest, "digest").where("doc_id > lowest").select("doc_id", "text_hash").distinct()
    copies = stored(copies.withColumn("copy", F.lit(True)), "substring-copies")

    with_id = rows.where(F.col("doc_id").isNotNull() & (F.octet_length("text") >= LENGTH))
    shared = stored(shared_buckets(with_id, bits), "substring-buckets")
    packed = _pack(with_id)
    originals = packed.join(shared, "doc_id").join(copies, ["doc_id", "text_hash"], "left_anti")
    firsts = stored(first_strings(originals, bits), "substring-firsts")
    by_doc = firsts.groupBy("doc_id", "text_hash").agg(
        F.flatten(F.collect_list(F.array("start", "count"))).alias("firsts")
    )

    def remove(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            out = []
            for doc, text, names, first, copy in zip(
                batch["doc_id"], batch["packed"], batch["names"], batch["firsts"], batch["copy"]
            ):
                raw = unpack(text)
                data = np.frombuffer(raw, np.uint8)
                doc = None if pd.isna(doc) else int(doc)
                if copy is True:
                    start, end = np.array([0]), np.array([len(data)])
                else:
                    known = np.zeros((0, 2), np.int64) if first is None else np.asarray(first, np.int64).reshape(-1, 2)
                    start, end = removed_runs(data, None if doc is None else names, known, bits)
                edges = [0, *np.stack([start, end], axis=1).ravel().tolist(), len(data)]
                digest = hashlib.sha256()
                for a, b in zip(edges[::2], edges[1::2]):
                    digest.update(raw[a:b])
                spans = np.stack([start, end], axis=1).astype(np.int64)
                out.append((doc, len(data), int((end - start).sum()), len(start), digest.hexdigest(), spans.tolist()))
            frame = pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])
            yield frame.astype({"doc_id": "Int64"})

    joined = (
        _pack(rows)
        .join(shared, "doc_id", "left")
        .join(by_doc, ["doc_id", "text_hash"], "left")
        .join(copies, ["doc_id", "text_hash"], "left")
    )
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<array<long>>"
    return joined.mapInPandas(remove, schema).withColumnRenamed("doc_id", id_col)
