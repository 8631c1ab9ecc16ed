"""Operator 9, suffix-array dedup: long repeated byte strings by a run-length index.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts anywhere else in the corpus. Winnowing brings the
places that may match together: each such string holds, at a place that only its content decides, one anchor (the least
hash of ``GRAM`` bytes). The rest is decided among the texts around equal anchors:

1. Anchors are counted (combined map-side) and a filter of bounded size keeps those that may repeat; the others, and all
   texts, stay where they are. Anchors with like surroundings are one context; if it occurs twice, all of it repeats.
2. Where one anchor has several contexts, they are indexed together: a suffix array gives the Burrows-Wheeler transform,
   of which only the runs are kept, with the text position and the match length sampled at both ends of each run. Within a
   run, a position's longest match with its neighbour is one less than that of the position before it; so matching
   statistics stream through the text from the samples, and those of LENGTH or more are marked.
3. Where one anchor has more than ``SPLIT`` contexts, their strings are dealt again by what strings that start nearly alike
   must share: bands of ``BAND`` starts have a core of ``LENGTH - BAND + 1`` bytes. Parts of contexts that are equal repeat
   whole; the few kinds of parts around one core are indexed as in 2.
4. Contexts that overlap in one text show one place twice, so their groups are compared by hashes of all strings at equal
   distance from the anchor instead; so are more than ``GROUP`` kinds around one core, with each string a row of its own: as
   exact, and spread over all tasks.

Beside the removed bytes, n_passages reports word anchors that another row holds too, so that passages of over 50 words that
are shorter than LENGTH bytes are seen as well.

Only documents with marks meet them by a shuffle. Equality of strings of 200 bytes and more is equality of 64-bit hashes.

Defined results: null and empty texts have n_bytes 0; texts below LENGTH bytes lose nothing; repeated rows repeat each
other and lose all that is long enough, null ids included; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm import hashing as H
from wardline.llm.common import map_arrow, partitions, staged, table
from wardline.llm.exact_dedup import BITS_PER_ROW, maybe_repeated, repeated_filter
from wardline.llm.tokens import in_parts

LENGTH, GRAM = 400, 200
REACH = LENGTH - GRAM  # bytes before an anchor that a string which holds it may start
#: Contexts of one anchor that are indexed as they are, starts of strings in a band, kinds of one core that are indexed in
#: one task, and bytes that are indexed at once.
SPLIT, BAND, GROUP, CHUNK = 64, 26, 1024, 3 << 18
FILTER_BITS = 1 << 26
#: Words of a passage that is reported beside the removed bytes, and of the grams that find it.
PASSAGE, WORD_GRAM = 51, 38
#: Bytes of a text that are hashed at once.
SEGMENT = 1 << 22
_BLANK = re.compile(rb"[\x20\x09-\x0D]")


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values, from prefix and suffix minima of blocks."""
    size = -(-len(values) // width) * width
    padded = np.full(size, np.iinfo(values.dtype).max, values.dtype)
    padded[: len(values)] = values
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    count = len(values) - width + 1
    return np.minimum(back[:count], ahead[width - 1 : width - 1 + count])


def anchors(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """Text index, position, anchor hash, context hash, bytes of the context before the anchor and in all, in order.

    The context of an anchor is what the strings cover whose anchor it is: strings that start one after the other share one."""
    data, starts = H.join_texts(texts)
    none = tuple(np.zeros(0, k) for k in (np.int64, np.int64, np.uint64, np.uint64, np.int64, np.int64))
    if len(data) < LENGTH:
        return none
    sums = H.prefix(H.windows(data))
    at = np.arange(len(data) - GRAM + 1)
    grams = H.strings(sums, at, at + GRAM)
    # The low bits hold the place, so that of equal hashes the leftmost wins.
    low = np.uint64((1 << len(data).bit_length()) - 1)
    place = (sliding_min(grams & ~low | at.astype(np.uint64), REACH + 1) & low).astype(np.int64)
    # Only strings that end within their text count.
    room = np.repeat(starts[1:] - 1 - LENGTH, np.diff(starts))[: len(place)]
    first = np.flatnonzero(np.arange(len(place)) <= room)
    if not len(first):
        return none
    place = place[first]
    new = np.concatenate([[True], place[1:] != place[:-1]])
    left, stop = first[new], first[np.append(np.flatnonzero(new)[1:] - 1, len(first) - 1)] + LENGTH
    place = place[new]
    doc = np.searchsorted(starts, place, "right") - 1
    around = H.mix(H.strings(sums, left, stop) + (place - left).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return doc, place - starts[doc], grams[place], around, place - left, stop - left


def segments(texts: list[bytes]) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Numbers of texts, where their segments start and the segments, a bounded number of bytes at a time; those of one text share LENGTH - 1 bytes."""
    own, at, held, size = [], [], [], 0
    for k, text in enumerate(texts):
        for a in range(0, max(1, len(text) - LENGTH + 1), SEGMENT):
            own.append(k)
            at.append(a)
            held.append(text[a : a + SEGMENT + LENGTH - 1])
            size += len(held[-1])
            if size >= SEGMENT:
                yield own, at, held
                own, at, held, size = [], [], [], 0
    if held:
        yield own, at, held


def _word_hashes(text: bytes) -> np.ndarray:
    """Hashes of the words of a text, read in segments that end between words."""
    found, a = [], 0
    while a < len(text):
        end = _BLANK.search(text, a + SEGMENT)
        part = np.frombuffer(text[a : end.start() if end else len(text)], np.uint8)
        found.append(H.spans(H.prefix(H.BYTE_VALUES[part]), *H.words(part)))
        a = end.start() if end else len(text)
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def word_anchors(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Text number and hash of the distinct word anchors of each text: of the WORD_GRAM-grams of every PASSAGE words, the one of least hash."""
    if sum(map(len, texts)) <= SEGMENT:
        data, starts = H.join_texts(texts)
        first, stop = H.words(data)
        hashes = H.spans(H.prefix(H.BYTE_VALUES[data]), first, stop)
        edges = np.searchsorted(first, starts)
    else:
        each = [_word_hashes(t) for t in texts]
        hashes, edges = np.concatenate(each), np.cumsum([0] + [len(x) for x in each])
    width = PASSAGE - WORD_GRAM + 1
    count = np.maximum(np.diff(edges) - PASSAGE + 1, 0)  # windows of each text
    if not count.any():
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.arange(len(hashes) - WORD_GRAM + 1)
    least = sliding_min(H.spans(H.prefix(hashes), at, at + WORD_GRAM), width)
    own = np.repeat(np.arange(len(texts)), count)
    found = least[np.repeat(edges[:-1] - (np.cumsum(count) - count), count) + np.arange(len(own))]
    new = np.append(True, (found[1:] != found[:-1]) | (own[1:] != own[:-1]))
    order = np.lexsort((found[new], own[new]))
    own, found = own[new][order], H.mix(found[new][order] + np.uint64(PASSAGE))
    new = np.append(True, (found[1:] != found[:-1]) | (own[1:] != own[:-1]))
    return own[new], found[new]


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Texts with a key that survives a second scan: the id and a hash of the text."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.select("doc_id", F.xxhash64("text").alias("th"), F.col("text").cast("binary").alias("text"))


def _counts(texts: DataFrame) -> DataFrame:
    """Hashes of byte and word anchors with their count in one part of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, values in in_parts(batch.column(0)):
                every = [word_anchors(values)[1], *(anchors(held)[2] for _, _, held in segments(values))]
                found, count = np.unique(np.concatenate(every), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(count)], names=["_h", "n"])

    return map_arrow(texts.select("text"), run, "_h long, n long")


def anchor_filter(hashes: DataFrame) -> np.ndarray:
    """Bloom filter of the column ``_h`` as 64-bit words; its size is a power of two of at most FILTER_BITS bits."""
    bits = min(FILTER_BITS, max(1024, 1 << (BITS_PER_ROW * hashes.count()).bit_length()))
    probes = F.array(F.col("_h").bitwiseAND(F.lit(bits - 1)), F.shiftrightunsigned("_h", 32).bitwiseAND(F.lit(bits - 1)))
    words = hashes.select(F.explode(probes).alias("p")).groupBy(F.shiftright("p", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(p & 63 AS int)))").alias("mask")).toArrow()
    out = np.zeros(bits >> 6, np.uint64)
    out[words.column("word").to_numpy()] = words.column("mask").to_numpy().view(np.uint64)
    return out


def _in_filter(words: np.ndarray, h: np.ndarray) -> np.ndarray:
    low = np.uint64(64 * len(words) - 1)
    hit = lambda p: (words[(p >> np.uint64(6)).astype(np.int64)] >> (p & np.uint64(63))) & np.uint64(1)
    return (hit(h & low) & hit(h >> np.uint64(32) & low)).astype(bool)


def _occurrences(texts: DataFrame, repeated: np.ndarray) -> DataFrame:
    """Anchors that may repeat, as rows; those that follow each other with one hash and context (periodic text) are one row with a count.

    Word anchors have no place: ``pos`` is null."""
    shared = texts.sparkSession.sparkContext.broadcast(repeated)
    types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32())
    names = ["_h", "ch", "doc_id", "th", "pos", "last", "n", "left", "size"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value
        for batch in batches:
            ids, keys = batch.column(0), batch.column(1)
            for a, _, values in in_parts(batch.column(2)):
                own, found = word_anchors(values)
                may = _in_filter(words, found)
                row, found = pa.array(own[may] + a), found[may]
                if len(found):
                    empty = [pa.nulls(len(found), t) for t in types]
                    yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), empty[1], ids.take(row), keys.take(row), *empty[4:]], names=names)
                for texts_of, at_byte, held in segments(values):
                    doc, place, gram, around, left, size = anchors(held)
                    may = _in_filter(words, gram)
                    if not may.any():
                        continue
                    doc, place, gram, around, left, size = (x[may] for x in (doc, place, gram, around, left, size))
                    place, doc = place + np.array(at_byte)[doc], np.array(texts_of)[doc]
                    new = np.ones(len(doc), bool)
                    new[1:] = (doc[1:] != doc[:-1]) | (gram[1:] != gram[:-1]) | (around[1:] != around[:-1]) | (place[1:] > place[:-1] + LENGTH)
                    at = np.flatnonzero(new)
                    stop = np.append(at[1:], len(doc))
                    row = pa.array(doc[at] + a)
                    cols = [gram[at].view(np.int64), around[at].view(np.int64), ids.take(row), keys.take(row), place[at], place[stop - 1], stop - at, left[at].astype(np.int32), size[at].astype(np.int32)]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) if isinstance(c, np.ndarray) else c for c, t in zip(cols, types, strict=True)], names=names)

    return map_arrow(texts, run, "_h long, ch long, doc_id long, th long, pos long, last long, n long, left int, size int")


def _contexts(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """Staged contexts (_h, ch, left, bytes, doc_id, th, pos) of one occurrence each."""
    by_doc = staged(wanted.groupBy("doc_id", "th").agg(F.collect_list(F.struct("_h", "ch", "pos", "left", "size")).alias("at")), "wanted")
    near = _meeting(texts, by_doc)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                text, at = batch.column(2)[k].as_py(), batch.column(3)[k].as_py()
                start = [x["pos"] - x["left"] for x in at]
                cols = [[x["_h"] for x in at], [x["ch"] for x in at], [x["left"] for x in at], [text[y : y + x["size"]] for x, y in zip(at, start, strict=True)], [batch.column(0)[k].as_py()] * len(at), [batch.column(1)[k].as_py()] * len(at), [x["pos"] for x in at]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int64()), strict=True)], names=["_h", "ch", "left", "bytes", "doc_id", "th", "pos"])

    found = map_arrow(near.select("doc_id", "th", "text", "at"), run, "_h long, ch long, left int, bytes binary, doc_id long, th long, pos long")
    return staged(found.dropDuplicates(["_h", "ch"]), "contexts")  # repeated rows give a context twice


def _meeting(texts: DataFrame, by_doc: DataFrame, how: str = "inner") -> DataFrame:
    """Join texts with staged rows by their key; a filter of bounded size keeps texts without a partner from moving."""
    hashes = by_doc.select(F.xxhash64("doc_id", "th").alias("_h"))
    bits = min(FILTER_BITS, max(1024, BITS_PER_ROW * by_doc.count()))
    words = staged(repeated_filter(hashes.unionAll(hashes), bits), "bloom")
    tested = maybe_repeated(texts.withColumn("_h", F.xxhash64("doc_id", "th")), words, bits).drop("_h")
    side = by_doc.toDF("_id", "_th", *by_doc.columns[2:])
    met = tested.where("_maybe").join(side, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th")), "inner" if how == "inner" else "left").drop("_id", "_th", "_maybe")
    if how == "inner":
        return met
    alone = tested.where(~F.col("_maybe")).drop("_maybe").withColumns({c: F.lit(None).cast(by_doc.schema[c].dataType) for c in by_doc.columns[2:]})
    return alone.unionByName(met)


def suffix_order(data: np.ndarray, rest: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Suffix array by group, then bytes up to the end of each context (``rest`` bytes left), then place; prefix doubling."""
    n, span = len(data), 5
    at = np.arange(n)
    key = np.minimum(rest, span).astype(np.uint64)
    for k in range(span):
        inside = rest > k
        key |= np.where(inside, data[np.minimum(at + k, n - 1)], 0).astype(np.uint64) << np.uint64(8 * (span - k))
    # Groups are few in a chunk; their number leaves 48 bits for five bytes and their count.
    key |= group.astype(np.uint64) << np.uint64(48)

    def ranked(key):
        order = np.argsort(key)
        step = np.empty(n, np.int64)
        step[order] = np.concatenate([[0], np.cumsum(key[order[1:]] != key[order[:-1]])])
        return step

    rank = ranked(key)
    longest = int(rest.max())
    while span < longest and int(rank.max()) < n - 1:
        ahead = np.where(rest > span, rank[np.minimum(at + span, n - 1)] + 1, 0)
        rank = ranked(rank * (n + 1) + ahead)
        span *= 2
    return np.argsort(rank * n + at)


def matching_statistics(contexts: list[bytes], groups: np.ndarray) -> np.ndarray:
    """For every byte of the joined contexts, the longest string from it that also starts elsewhere in its group."""
    size = np.array([len(c) for c in contexts], np.int64)
    ends = np.cumsum(size)
    data = np.frombuffer(b"".join(contexts), np.uint8)
    own = np.repeat(np.arange(len(size)), size)
    at = np.arange(len(data))
    rest = ends[own] - at
    group = np.cumsum(np.concatenate([[0], groups[1:] != groups[:-1]]))[own]
    order = suffix_order(data, rest, group)
    # The transform: the byte before each suffix; a context's first is like no other.
    opening = at == (ends - size)[own]
    before = np.where(opening, 256 + own, data[at - 1])[order]
    edge = np.flatnonzero(before[1:] != before[:-1]) + 1  # first row of each run but the first
    sums = H.prefix(H.windows(data))

    near = np.ndarray((len(data),), np.uint64, np.concatenate([data, np.zeros(8, np.uint8)]), 0, (1,))

    def common(i, j):
        """Longest common prefix of suffixes: by bisection over hashes, and where it is shorter than a window by its bytes."""
        most = np.where(group[i] == group[j], np.minimum(rest[i], rest[j]), 0)
        few = sum(((near[i] ^ near[j]) & np.uint64((1 << 8 * k) - 1) == 0).astype(np.int64) for k in range(1, H.WINDOW))
        low, high = np.minimum(H.WINDOW - 1, most), most
        while (low < high).any():
            mid = (low + high + 1) >> 1
            same = H.strings(sums, i, i + mid) == H.strings(sums, j, j + mid)
            low, high = np.where(same & (mid <= high), mid, low), np.where(same, high, mid - 1)
        return np.where(low >= H.WINDOW, low, np.minimum(few, most))

    met = common(order[edge], order[edge - 1])
    best = np.zeros(len(data), np.int64)
    for rows, sampled in ((edge, met), (edge - 1, met)):  # samples at run starts, then at run ends
        last, value = np.full(len(data), -1, np.int64), np.zeros(len(data), np.int64)
        last[order[rows]] = order[rows]
        value[order[rows]] = sampled
        edge_row = order[0] if rows is edge else order[-1]
        last[edge_row] = edge_row
        last = np.maximum.accumulate(last)
        best = np.maximum(best, value[last] - (at - last))
    return best


def _spans_of(hit: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of bytes that strings starting at the marked places cover."""
    if not len(hit):
        return []
    new = np.flatnonzero(np.diff(hit) > LENGTH)
    return list(zip(hit[np.append(0, new + 1)].tolist(), (hit[np.append(new, len(hit) - 1)] + LENGTH).tolist(), strict=True))


def _string_hashes(text: bytes) -> np.ndarray:
    """Hashes of all strings of LENGTH bytes."""
    data = np.frombuffer(text, np.uint8)
    start = np.arange(len(data) - LENGTH + 1)
    return H.strings(H.prefix(H.windows(data)), start, start + LENGTH)


def _overlapping(rows: list[tuple]) -> bool:
    """Whether two contexts of a group lie over each other in one text."""
    places: dict[tuple, list[int]] = {}
    for *_, doc_id, th, pos in rows:
        places.setdefault((doc_id, th), []).append(pos)
    return any(b - a < REACH + LENGTH for p in places.values() if len(p) > 1 for a, b in zip(sorted(p)[:-1], sorted(p)[1:], strict=True))


def _aligned(rows: list[tuple]) -> list[tuple]:
    """Marks of one group by strings at equal distance from the anchor."""
    keys = [_string_hashes(r[3]) for r in rows]
    size = np.array([len(k) for k in keys])
    own = np.repeat(np.arange(len(rows)), size)
    start = np.arange(len(own)) - np.repeat(np.cumsum(size) - size, size)
    place = start - np.array([r[2] for r in rows])[own]
    key = H.mix(np.concatenate(keys) + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key)
    same = key[order[1:]] == key[order[:-1]]
    hit = np.zeros(len(key), bool)
    hit[order[1:][same]] = hit[order[:-1][same]] = True
    each = np.split(hit, np.cumsum(size)[:-1])
    return [(h, ch, a - left, b - left) for (h, ch, left, *_), found in zip(rows, each, strict=True) for a, b in _spans_of(np.flatnonzero(found))]


def _indexed(contexts: DataFrame) -> DataFrame:
    """Marks (_h, ch, a, b), relative to the anchor, by the run-length index."""

    def marks(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        out, apart = [], []
        edges = [k for k in range(len(rows)) if not k or rows[k][0] != rows[k - 1][0]] + [len(rows)]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            if _overlapping(rows[a:b]):
                out += _aligned(rows[a:b])
            else:
                apart += rows[a:b]
        if apart:
            found, start = matching_statistics([r[3] for r in apart], np.array([r[0] for r in apart])), 0
            for h, ch, left, text, *_ in apart:
                out += [(h, ch, a - left, b - left) for a, b in _spans_of(np.flatnonzero(found[start : start + len(text)] >= LENGTH))]
                start += len(text)
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.int32(), pa.int32()))], names=["_h", "ch", "a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in range(7)), strict=True):
                if size > CHUNK and row[0] != held[-1][0]:
                    yield from marks(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[3])
        yield from marks(held)

    # Dealt by a number of its own, so that adaptive execution does not put these slow rows into few tasks by their bytes.
    rows = contexts.select("_h", "ch", "left", "bytes", "doc_id", "th", "pos")
    dealt = rows.repartition(4 * partitions(contexts.sparkSession), F.xxhash64("_h")).sortWithinPartitions("_h", "ch")
    return map_arrow(dealt, run, "_h long, ch long, a int, b int")


def _hashed(contexts: DataFrame) -> DataFrame:
    """The same marks by hashes of all strings of LENGTH at equal distance from the anchor, counted by shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for h, ch, left, text in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                key = _string_hashes(text).view(np.int64)
                start = np.arange(len(key))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(start), h)), pa.array(np.full(len(start), ch)), pa.array((start - left).astype(np.int32)), pa.array(key)], names=["_h", "ch", "a", "key"])

    rows = staged(map_arrow(contexts.select("_h", "ch", "left", "bytes"), run, "_h long, ch long, a int, key long"), "strings")
    again = staged(rows.groupBy("_h", "a", "key").count().where("count > 1").select("_h", "a", "key"), "again")
    met = rows.join(again, ["_h", "a", "key"], "left_semi")
    return met.select("_h", "ch", "a", (F.col("a") + LENGTH).alias("b"))


def _cores(contexts: DataFrame) -> DataFrame:
    """Contexts cut by bands of their strings' starts. Strings of one band share a core of LENGTH - BAND + 1 bytes, so equal
    ones meet under the hash ``_g`` of anchor, band and core; ``sh`` is the hash of the whole part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = lambda *parts: int.from_bytes(hashlib.blake2b(b"|".join(parts), digest_size=8).digest(), "little", signed=True)
        for batch in batches:
            out = []
            for h, ch, left, text, doc_id, th, pos in zip(*(batch.column(k).to_pylist() for k in range(7)), strict=True):
                least = left + LENGTH - len(text)  # strings start this far before the anchor, up to ``left``
                for band in range(max(0, least) // BAND, left // BAND + 1):
                    low, high = max(least, band * BAND), min(left, band * BAND + BAND - 1)
                    part = text[left - high : left - low + LENGTH]
                    core = text[left - band * BAND : left - band * BAND + LENGTH - BAND + 1]
                    key = b"%d %d" % (h, band)
                    out.append((digest(key, core), digest(b"%d" % high, part), h, ch, high, part, doc_id, th, pos))
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], t) for k, t in enumerate(types)], names=["_g", "sh", "_h", "ch", "left", "bytes", "doc_id", "th", "pos"])

    return map_arrow(contexts.select("_h", "ch", "left", "bytes", "doc_id", "th", "pos"), run, "_g long, sh long, _h long, ch long, left int, bytes binary, doc_id long, th long, pos long")


def _split(contexts: DataFrame) -> DataFrame:
    """Marks of the contexts of large groups: parts that two contexts share repeat whole, and of each core only the kinds of
    parts, which differ in less than BAND bytes at either end, are indexed against each other."""
    rows = staged(_cores(contexts), "cores")
    kinds = staged(rows.groupBy("_g", "sh").agg(F.count(F.lit(1)).alias("n"), F.first("left").alias("left"), F.first(F.length("bytes")).alias("size")), "parts")
    several = staged(kinds.groupBy("_g").agg(F.count(F.lit(1)).alias("g")).where("g > 1"), "several_parts")
    whole = kinds.where("n > 1").select("_g", "sh", (-F.col("left")).alias("a"), (F.col("size") - F.col("left")).alias("b"))
    apart = staged(rows.join(several.select("_g"), "_g", "left_semi").dropDuplicates(["_g", "sh"]).select(F.col("_g").alias("_h"), F.col("sh").alias("ch"), "left", "bytes", "doc_id", "th", "pos"), "kinds_apart")
    large = several.where(F.col("g") > GROUP).select(F.col("_g").alias("_h"))
    found = _indexed(apart.join(large, "_h", "left_anti")).unionAll(_hashed(apart.join(large, "_h", "left_semi"))).toDF("_g", "sh", "a", "b")
    marks = staged(whole.unionAll(found.join(kinds.where("n > 1"), ["_g", "sh"], "left_anti")), "part_marks")
    return rows.select("_g", "sh", "_h", "ch").join(marks, ["_g", "sh"]).select("_h", "ch", "a", "b")


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Keyed texts, and staged rows (doc_id, th, spans, passages): unmerged arrays of (a, b) byte ranges that repeat, and the number of word anchors that another row holds too."""
    texts = _keyed(docs, id_col, text_col)
    counted = staged(_counts(texts).groupBy("_h").agg(F.sum("n").alias("n")).where("n > 1").select("_h"), "repeated")
    every = staged(_occurrences(texts, anchor_filter(counted)), "occurrences")
    occurring, words = every.where("pos IS NOT NULL"), every.where("pos IS NULL").select("_h", "doc_id", "th")
    kinds = staged(occurring.groupBy("_h", "ch").agg(F.sum("n").alias("n"), F.min(F.struct("doc_id", "th", "pos", "left", "size")).alias("rep")), "kinds")
    several = staged(kinds.groupBy("_h").agg(F.count(F.lit(1)).alias("g")).where("g > 1"), "several")
    contexts = _contexts(texts, kinds.join(several, "_h", "left_semi").select("_h", "ch", "rep.*"))
    large = several.where(F.col("g") > SPLIT).select("_h")
    full = kinds.where("n > 1").select("_h", "ch", (-F.col("rep.left")).alias("a"), (F.col("rep.size") - F.col("rep.left")).alias("b"))
    partial = _indexed(contexts.join(large, "_h", "left_anti"))
    if not large.isEmpty():
        partial = partial.unionAll(_split(contexts.join(large, "_h", "left_semi")))
    partial = partial.join(kinds.where("n > 1").select("_h", "ch"), ["_h", "ch"], "left_anti")
    marks = staged(full.unionAll(partial).groupBy("_h", "ch").agg(F.collect_list(F.struct("a", "b")).alias("marks")), "marks")
    met = occurring.join(marks, ["_h", "ch"]).select("doc_id", "th", "pos", "last", F.explode("marks").alias("m"))
    found = met.select("doc_id", "th", F.struct((F.col("pos") + F.col("m.a")).alias("a"), (F.col("last") + F.col("m.b")).alias("b")).alias("span"), F.lit(None).cast("long").alias("_h"))
    # A row holds an anchor once, so two rows of it are two documents.
    shared = staged(words.groupBy("_h").count().where("count > 1").select("_h"), "passages")
    found = found.unionByName(words.join(shared, "_h", "left_semi").distinct().withColumn("span", F.lit(None).cast("struct<a:bigint,b:bigint>")))
    return texts, staged(found.groupBy("doc_id", "th").agg(F.collect_set("span").alias("spans"), F.count("_h").alias("passages")), "spans")


def remove_repeats(docs: DataFrame, with_bytes: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_passages, and the kept bytes themselves if with_bytes.

    n_passages counts word anchors of the row that another row holds too: a passage of PASSAGE words that both hold gives one
    at least, even where it is shorter than LENGTH bytes and stays; rows that share fewer than WORD_GRAM words in a row have none."""
    texts, spans = repeated_spans(docs, id_col, text_col)
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, n_passages long" + ", kept binary" * with_bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                kept, done, runs = [], 0, 0
                stop = -1
                for a, b in sorted((x["a"], min(x["b"], len(text))) for x in found or []):
                    if a > stop:
                        kept.append(text[done:a])
                        runs += 1
                    stop = max(stop, b)
                    done = stop
                kept.append(text[done:])
                left = b"".join(kept)
                out.append((len(text), len(text) - len(left), runs, hashlib.sha256(left).hexdigest(), left))
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            cols = [pa.array([x[k] for x in out], t) for k, t in enumerate(types)]
            cols = [batch.column(0), *cols[:4], batch.column(3), *cols[4:]][: 6 + with_bytes]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_passages", "kept"][: 6 + with_bytes])

    return map_arrow(_meeting(texts, spans, "left").select("doc_id", "text", "spans", F.coalesce("passages", F.lit(0).cast("long")).alias("passages")), run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))
