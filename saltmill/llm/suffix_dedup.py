"""Repeated strings of ``length`` bytes, found by a column-wise Burrows-Wheeler construction.

A byte is removed if a ``length``-byte string that covers it also starts anywhere else, in the
same document or another one. Strings are judged on the input and never cross documents.

Where to compare. Every window of ``length`` bytes has an anchor, the ``gram``-byte string in it
with the least hash (the leftmost of equals). The anchor depends on the window alone, so equal
windows have equal anchors at equal offsets, in whatever document they stand. Consecutive
windows with one anchor form a piece: the bytes from the first window's start to the last one's
end. Only pieces whose anchor occurs twice can hold a repeated string; equal pieces are kept
once, with their number.

Construction. A task takes whole groups of pieces (equal anchors) in collections of bounded
size, aligns them at their anchors, and runs over the columns from right to left. Each round
inserts one symbol per piece: the pieces are sorted by that symbol, ties in the order of the last
round, which is the transform of the collection at this column; the common prefix of neighbours
becomes one more than the least common prefix between them in the last round, or 0 if the new
symbols differ. Equal windows meet in the same column, so a window is repeated exactly if its
common prefix with a neighbour is ``length``, or if its piece has copies. A round reads the
order and the common prefixes of the last one from front to back and writes those of the next;
they hold one entry per piece, so they are arrays. Anchors, pieces and what is found are files
between the rounds of Spark, written one after the other in the shared scratch folder.

Bounds. A group of more than ``max_group`` different pieces (a short text in very many
surroundings) is not put into one task: its windows are hashed to 128 bits and counted by Spark,
which is exact but for collisions. Hot anchors, pieces and rows are joined with salts. Texts
move twice, by their key, whatever the size of the table.

NULL text is empty. Repeated rows repeat their strings, and all get the same result. Texts
shorter than ``length`` lose nothing. Without documents there are no rows. Other columns are
not read. A text of any size is cut into segments whose windows overlap.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from ..operators.joins import hot_join, small_join
from ..session import materialize
from .common import counted_join, map_rows, pick
from .registry import query

LENGTH = 200
GRAM = 32
MAX_GROUP = 20_000
# Pieces in a collection: groups are added until there are this many.
COLLECTION = 20_000
# Bytes whose grams are hashed at once, and windows of a long text in one segment.
BUFFER = 1 << 18
POSITION = np.uint64((1 << 24) - 1)


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of every gram of ``gram`` bytes, a power of two."""
    h, width, factor = data.astype(np.uint64), 1, 0x9E3779B97F4A7C15
    while width < gram:
        h = h[:-width] * np.uint64(factor) + h[width:]
        factor = (factor * 0xD1342543DE82EF95 + 1442695040888963407) % (1 << 64) | 1
        width *= 2
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    return h ^ (h >> np.uint64(29))


def find_pieces(texts: list[bytes], length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Pieces of texts of fewer than 2^24 bytes together: text, start, windows, bytes before the anchor, anchor hash."""
    sizes = np.array([len(t) for t in texts])
    windows = np.maximum(0, sizes - length + 1)
    if not windows.sum():
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    hashes = gram_hashes(np.frombuffer(b"".join(texts), np.uint8), gram)
    # Order by hash, then by place: the place itself stands in the low bits.
    least = (hashes & ~POSITION) | np.arange(len(hashes), dtype=np.uint64)
    wide, width = length - gram + 1, 1
    while 2 * width <= wide:
        least, width = np.minimum(least[:-width], least[width:]), 2 * width
    if wide > width:
        least = np.minimum(least[: width - wide], least[wide - width :])
    begin = np.cumsum(sizes) - sizes
    text = np.repeat(np.arange(len(texts)), windows)
    start = np.arange(len(text)) - np.repeat(np.cumsum(windows) - windows, windows) + begin[text]
    anchor = (least[start] & POSITION).astype(np.int64)
    cut = np.flatnonzero(np.diff(anchor, prepend=-1))
    first, at, text = start[cut], anchor[cut], text[cut]
    return text, first - begin[text], np.diff(np.append(cut, len(start))), at - first, hashes[at].astype(np.int64)


def _segments(texts: list[bytes], length: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """(row, offset, bytes) in buffers of about BUFFER bytes; windows of long texts are shared out."""
    held, size = [], 0
    for row, text in enumerate(texts):
        for offset in range(0, max(1, len(text) - length + 1), BUFFER):
            part = text[offset : offset + BUFFER + length - 1]
            held.append((row, offset, part))
            size += len(part)
            if size > BUFFER:
                yield held
                held, size = [], 0
    if held:
        yield held


def keyed(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """doc_id, text as bytes, and a 128-bit key k1, k2 that rows equal in both share."""
    rows = pick(docs, doc_id=id_column, text=text_column)
    rows = rows.withColumn("text", F.coalesce(F.col("text").cast("binary"), F.lit(b"")))
    parts = [F.col("doc_id"), F.col("doc_id").isNull(), F.col("text")]
    return rows.select("doc_id", "text", F.xxhash64(*parts).alias("k1"), F.xxhash64(F.lit("k2"), *parts[::-1]).alias("k2"))


def anchors(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """One row per piece: k1, k2, start, windows, before, anchor (hash) and piece (digest)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for part in _segments(texts, length):
                text, start, windows, before, anchor = find_pieces([s[2] for s in part], length, gram)
                row = np.array([s[0] for s in part])[text] if len(text) else text
                start = start + np.array([s[1] for s in part])[text] if len(text) else start
                digests = [
                    xxhash.xxh3_128_digest(texts[r][s : s + w + length - 1], seed=w << 32 | b)
                    for r, s, w, b in zip(row.tolist(), start.tolist(), windows.tolist(), before.tolist(), strict=True)
                ]
                keys = [batch.column(i).take(pa.array(row, pa.int64())) for i in (0, 1)]
                numbers = [pa.array(c, pa.int64()) for c in (start, windows, before, anchor)]
                yield pa.RecordBatch.from_arrays(
                    [*keys, *numbers, pa.array(digests, pa.binary())],
                    names=["k1", "k2", "start", "windows", "before", "anchor", "piece"],
                )

    schema = "k1 bigint, k2 bigint, start bigint, windows bigint, before bigint, anchor bigint, piece binary"
    return rows.select("k1", "k2", "text").mapInArrow(run, schema)


def repeated(pieces: list[bytes], windows: np.ndarray, before: np.ndarray, length: int) -> np.ndarray:
    """Which windows of which piece (rows) also start in another piece or twice; see the module."""
    m, sizes = len(pieces), np.array([len(p) for p in pieces])
    left = int(before.max())
    columns = left + int((sizes - before).max())
    # The pieces side by side, a column of symbols per row of this table.
    symbols = np.zeros((columns, m), np.uint8)
    piece = np.repeat(np.arange(m), sizes)
    place = np.arange(len(piece)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    symbols[place + (left - before)[piece], piece] = np.frombuffer(b"".join(pieces), np.uint8)
    first = left - before
    last = first + sizes - 1
    enter = np.argsort(-last, kind="stable")
    leaves = np.unique(first)
    found = np.zeros((m, int(windows.max())), bool)
    kind = np.uint8 if length < 255 else np.uint32
    order, common, entered = np.zeros(0, np.int64), np.zeros(0, kind), 0
    for column in range(columns - 1, -1, -1):
        if column + 1 in leaves and len(order):
            # Pieces that have ended: their neighbours share the least of what lay between.
            stay = np.flatnonzero(first[order] <= column)
            if len(stay):
                common = np.minimum.reduceat(common[: stay[-1] + 1], np.append(0, stay[:-1] + 1))
                common[0] = 0
            order, common = order[stay], common[: len(stay)]
        begin = entered
        while entered < m and last[enter[entered]] == column:
            entered += 1
        if entered > begin:
            order = np.concatenate([enter[begin:entered], order])
            common = np.concatenate([np.zeros(entered - begin, kind), common])
        if not len(order):
            continue
        symbol = symbols[column, order]
        rank = np.argsort(symbol, kind="stable")
        # Least common prefix after each place up to the next place of the same symbol.
        least = np.minimum.reduceat(np.append(common, kind(0)), rank + 1)
        symbol, order = symbol[rank], order[rank]
        common = np.zeros(len(order), kind)
        same = symbol[1:] == symbol[:-1]
        common[1:][same] = np.minimum(least[:-1][same] + kind(1), kind(length))
        full = common >= length
        if full.any():
            both = full.copy()
            both[:-1] |= full[1:]
            hit = order[both]
            found[hit, column - first[hit]] = True
    return found


def _runs(found: np.ndarray, windows: np.ndarray) -> list[str]:
    """Per piece its repeated windows as ``first+number`` of each run, joined by commas."""
    edges = np.diff(np.pad(found & (np.arange(found.shape[1]) < windows[:, None]), ((0, 0), (1, 1))).astype(np.int8))
    rows, starts = np.nonzero(edges == 1)
    ends = np.nonzero(edges == -1)[1]
    out = [[] for _ in range(len(found))]
    for row, start, end in zip(rows.tolist(), starts.tolist(), ends.tolist(), strict=True):
        out[row].append(f"{start}+{end - start}")
    return [",".join(runs) for runs in out]


def collections(pieces: DataFrame, length: int) -> DataFrame:
    """piece, copies and runs of its repeated windows, from (anchor, piece, copies, windows, before, bytes)."""

    def solve(rows: list[tuple]) -> pa.RecordBatch:
        _, digests, copies, windows, before, texts = zip(*rows, strict=True)
        windows, before = np.array(windows), np.array(before)
        found = repeated(list(texts), windows, before, length)
        found[np.array(copies) > 1] = True
        kept = [(d, n, r) for d, n, r in zip(digests, copies, _runs(found, windows), strict=True) if r]
        columns = zip(*kept, strict=True) if kept else ([], [], [])
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.int64(), pa.string()), strict=True)],
            names=["piece", "copies", "runs"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if held and held[-1][:2] == row[:2]:
                    continue
                if len(held) >= COLLECTION and held[-1][0] != row[0]:
                    yield solve(held)
                    held = []
                held.append(row)
        if held:
            yield solve(held)

    sorted_pieces = pieces.repartition("anchor").sortWithinPartitions("anchor", "piece")
    return sorted_pieces.mapInArrow(run, "piece binary, copies bigint, runs string")


def counted_windows(pieces: DataFrame, length: int) -> DataFrame:
    """The same for pieces of large groups, with every window hashed and counted by Spark."""
    pieces = pieces.dropDuplicates(["piece"])

    def split(piece, copies, windows, text):
        return (piece, copies, windows, [xxhash.xxh3_128_digest(text[i : i + length]) for i in range(windows)])

    rows = map_rows(
        pieces.select("piece", "copies", "windows", "bytes"),
        split,
        "piece binary, copies bigint, windows bigint, digests array<binary>",
    )
    each = materialize(rows.select("piece", "copies", F.posexplode("digests").alias("at", "window")), "windows")
    counts = each.groupBy("window").agg(F.sum("copies").alias("total"), F.count(F.lit(1)).alias("n"))
    counts = materialize(counts.where("total > 1").select("window", "n"), "repeated-windows")
    hits = counted_join(each, counts, "window", "n", F.struct("piece", "at"))
    runs = F.array_join(F.transform(F.array_sort(F.collect_set("at")), lambda i: F.concat(i, F.lit("+1"))), ",")
    # At most length - gram + 1 windows per piece.
    return hits.groupBy("piece", "copies").agg(runs.alias("runs"))


def repeats(docs: DataFrame, length: int, gram: int, max_group: int, id_column: str, text_column: str) -> DataFrame:
    """k1, k2 and places: strings ``start:runs``, the repeated windows of each piece of a document."""
    rows = keyed(docs, id_column, text_column)
    every = materialize(anchors(rows, length, gram), "anchors")
    twice = every.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    twice = materialize(twice, "repeated-anchors")
    shared = counted_join(every, twice, "anchor", "n", F.struct("k1", "start"))
    shared = materialize(shared, "shared-pieces")
    one = shared.groupBy("anchor", "piece").agg(
        F.count(F.lit(1)).alias("copies"),
        *[F.first(c).alias(c) for c in ("k1", "k2", "start", "windows", "before")],
    )
    one = materialize(one, "pieces")
    large = one.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > max_group)
    large = materialize(large.select("anchor", F.lit(True).alias("large")), "large-groups")
    any_large = not large.isEmpty()
    fetched = _bytes_of(rows, one, length)
    if any_large:
        fetched = small_join(materialize(fetched, "piece-bytes"), large, "anchor", "left")
        runs = collections(fetched.where("large is null").drop("large"), length)
        runs = runs.unionByName(counted_windows(fetched.where("large"), length))
    else:
        runs = collections(fetched, length)
    runs = materialize(runs, "runs").withColumnRenamed("copies", "n")
    hits = counted_join(shared.select("k1", "k2", "start", "piece"), runs, "piece", "n", F.struct("k1", "start"))
    # Rows repeated with their id share a key and give the same places, kept once.
    places = hits.groupBy("k1", "k2").agg(F.collect_set(F.concat_ws(":", "start", "runs")).alias("places"))
    return materialize(places, "repeats")


def _bytes_of(rows: DataFrame, one: DataFrame, length: int) -> DataFrame:
    """The pieces with their bytes, cut out of one document each."""
    wanted = F.collect_list(F.struct("start", "anchor", "piece", "copies", "windows", "before")).alias("wanted")
    wanted = materialize(one.groupBy("k1", "k2").agg(wanted), "wanted-pieces")
    found = hot_join(rows.select("k1", "k2", "text"), wanted, ["k1", "k2"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows repeated with their id: a task gives a piece once, the collections skip the rest.
        given = set()
        for batch in batches:
            out = []
            for text, wants in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for w in wants:
                    if w["piece"] not in given:
                        given.add(w["piece"])
                        cut = text[w["start"] : w["start"] + w["windows"] + length - 1]
                        out.append((w["anchor"], w["piece"], w["copies"], w["windows"], w["before"], cut))
            if out:
                types = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)],
                    names=["anchor", "piece", "copies", "windows", "before", "bytes"],
                )

    return found.select("text", "wanted").mapInArrow(
        run, "anchor bigint, piece binary, copies bigint, windows bigint, before bigint, bytes binary"
    )


def spans_of(size: int, places: list[str], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of covered bytes."""
    depth = np.zeros(size + 1, np.int32)
    for place in places:
        start, _, runs = place.partition(":")
        for run in runs.split(","):
            first, _, number = run.partition("+")
            begin = int(start) + int(first)
            depth[begin] += 1
            depth[begin + int(number) + length - 1] -= 1
    edges = np.diff(np.cumsum(depth) > 0, prepend=False).astype(bool)
    at = np.flatnonzero(edges)
    return at[::2], at[1::2]


def cut_repeats(
    docs: DataFrame,
    length: int = LENGTH,
    gram: int = GRAM,
    max_group: int = MAX_GROUP,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Every document: doc_id, n_bytes, the removed spans (starts, ends) and the bytes that are kept."""
    if gram & (gram - 1) or not 0 < gram <= length:
        raise ValueError("gram must be a power of two and at most length")
    places = repeats(docs, length, gram, max_group, id_column, text_column)
    rows = hot_join(keyed(docs, id_column, text_column), places, ["k1", "k2"], "left")
    cuts = T.StructType.fromDDL("n_bytes bigint, starts array<bigint>, ends array<bigint>, kept binary")
    schema = T.StructType([*rows.select("doc_id").schema, *cuts])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, starts, ends, kept = [], [], [], []
            for text, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                begin, end = spans_of(len(text), found, length) if found else ((), ())
                edges = [0, *[x for span in zip(begin, end, strict=True) for x in span], len(text)]
                sizes.append(len(text))
                starts.append(list(begin))
                ends.append(list(end))
                kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)) if found else text)
            lists = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(starts, lists), pa.array(ends, lists), pa.array(kept, pa.binary())],
                names=["doc_id", "n_bytes", "starts", "ends", "kept"],
            )

    return rows.select("doc_id", "text", "places").mapInArrow(run, schema)


@query("op11_suffix_dedup")
def op11_suffix_dedup(load) -> DataFrame:
    """Every document without the bytes that 200-byte repeats cover."""
    cut = cut_repeats(load("documents"))
    return cut.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("starts").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
