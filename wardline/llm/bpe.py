"""Operator 8, BPE encoding and decoding by content-defined chunks.

Texts are cut where a rolling hash of 8 bytes meets a mask, so equal passages are cut alike wherever they stand. A chunk is
encoded once per worker and reused; within a new chunk, so is each word between certain boundaries. A cut may fall within a
token, so every join is repaired: the stretch from the last certain boundary before the cut to the first one after it is
encoded anew across the cut. Then the library encodes the stretch together with a word on both sides: where its ids agree
with those at hand, the join is done; else the window takes twice as many words, until its ids agree at both ends with the
ids of the words there, and its ids are taken. Windows are remembered too, so each is encoded once per worker.

A boundary is certain before a space that follows an ASCII character or Latin letter, no white space, and between such a
letter and an ASCII mark other than the apostrophe: the byte-level pre-tokenizer starts a new word there whatever stands
around it, special tokens hold no space, and merges never cross words. So windows agree at once; the loop is what makes the
joins exact should a tokenizer differ.

Each text is handled in the task that reads it: nothing shuffles, whatever repeats, and memory holds one batch and caches
of fixed size. Defined results: null and empty texts have no ids and decode to the empty text; repeated rows and null ids
give a row each; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm.common import map_arrow, table
from wardline.llm.tokens import WordEncoder, byte_table, in_parts

TOKENIZER = "byte_bpe_50k.json"
#: Mean distance of cuts: 2 to this power bytes.
CHUNK_BITS = 10
#: Bytes of chunks that a worker remembers.
CACHE_BYTES = 32 << 20

_codecs: dict[str, Codec] = {}


def cut_points(data: np.ndarray, bits: int = CHUNK_BITS) -> np.ndarray:
    """Ends of the 8-byte windows whose hash has its highest ``bits`` bits clear."""
    if len(data) < 8:
        return np.zeros(0, np.int64)
    windows = np.ndarray((len(data) - 7,), np.uint64, data, 0, (1,))
    return np.flatnonzero(windows * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - bits) == 0) + 8


def boundaries(data: np.ndarray, starts: np.ndarray, special: bool) -> np.ndarray:
    """Text starts and certain boundaries; those at marks only where no special token may be (``special`` false)."""
    plain = (data > 32) & (data < 127)
    latin = np.zeros(len(data), bool)
    latin[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80)
    edge = np.zeros(len(data) + 1, bool)
    edge[starts] = True
    edge[1:-1] |= (data[1:] == 32) & (plain | latin)[:-1]
    if not special:
        ends = _LETTER[data] | latin & (data != 0x97) & (data != 0xB7)
        begins = ends.copy()
        begins[:-1] |= ends[1:] & latin[1:]
        mark = _MARK[data]
        edge[1:-1] |= mark[1:] & ends[:-1] | mark[:-1] & begins[1:]
    return np.flatnonzero(edge)


def joins(data: np.ndarray, certain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each cut, the numbers of the last certain boundary before it and the first after it."""
    cuts = cut_points(data)
    last, first = np.searchsorted(certain, cuts, "right") - 1, np.searchsorted(certain, cuts, "left")
    inside = first < len(certain)
    return last[inside], first[inside]


_LETTER, _MARK = (np.isin(np.arange(256), [*x]) for x in ([*range(65, 91), *range(97, 123)], b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"))
#: What the pre-tokenizer makes one word: letters or marks, with a space before.
_WORD = re.compile("(?: ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+| ?[!-&(-/:-@\\[-`{-~]+)").fullmatch


class BoundedWords(WordEncoder):
    """Ids of stretches between certain boundaries; plain words go to the model directly."""

    def __init__(self, name: str):
        super().__init__(name)
        shown = {b: c for c, b in byte_table().items()}
        self.shown = {c: "".join(shown[b] for b in chr(c).encode()) for c in [32, *range(0xC0, 0x100)]}
        self.dtype, self.pool = np.uint32, np.zeros(0, np.uint32)
        tried = [w for c in [*range(65, 91), *range(97, 123), *range(0xC0, 0x100)] for w in (f" a{chr(c)}he", f"{chr(c)}the", " %%,") if _WORD(w)]
        self.direct = all(self.simple(w) == self.tokenizer.encode(w, add_special_tokens=False).ids for w in tried)

    def simple(self, word: str) -> list[int]:
        return [t.id for t in self.tokenizer.model.tokenize(word.translate(self.shown))]

    def library(self, texts: list[bytes]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)
        return [np.array(x.ids, np.uint32) for x in found]

    def learn(self, words: list[bytes]) -> None:
        texts = [w.decode() for w in words]
        odd = [k for k, w in enumerate(texts) if not (self.direct and _WORD(w))]
        rest = dict(zip(odd, self.tokenizer.encode_batch_fast([texts[k] for k in odd], add_special_tokens=False), strict=True))
        self.keep(words, [rest[k].ids if k in rest else self.simple(w) for k, w in enumerate(texts)])


class Codec:
    """Encoder with a chunk cache, and decoder by a table of bytes."""

    def __init__(self, name: str):
        self.words = BoundedWords(name)
        self.tokenizer = self.words.tokenizer
        self.known: dict[bytes, np.ndarray] = {}
        self.agreed: set[tuple[bytes, int, int]] = set()
        self.size = 0
        stands_for, vocabulary = byte_table(), self.tokenizer.get_vocab(with_added_tokens=True)
        special = {i: t.content for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        tokens = [b""] * (max(vocabulary.values()) + 1)
        for text, i in vocabulary.items():
            tokens[i] = special[i].encode() if i in special else bytes(stands_for[c] for c in text)
        self.count = np.array([len(t) for t in tokens], np.int64)
        self.start = np.cumsum(self.count) - self.count
        self.pool = np.frombuffer(b"".join(tokens), np.uint8)
        self.decimal = [str(i) for i in range(len(tokens))]

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of each text."""
        joined = b"".join(texts)
        if not joined:
            return [np.zeros(0, np.uint32) for _ in texts]
        data, ends = np.frombuffer(joined, np.uint8), np.cumsum([len(t) for t in texts])
        starts = np.concatenate([[0], ends])
        special = b"<|" in joined
        certain = boundaries(data, starts, special)
        last, first = joins(data, certain)
        edge = np.zeros(len(data) + 1, bool)
        edge[starts] = edge[certain[last]] = edge[certain[first]] = True
        edges = np.flatnonzero(edge)
        pieces = [joined[a:b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
        if self.size > CACHE_BYTES:
            self.known, self.agreed, self.size = {}, set(), 0
        new = list({p for p in pieces if p not in self.known})
        if new:
            fresh, size = b"".join(new), np.cumsum([0] + [len(p) for p in new])
            cuts = boundaries(np.frombuffer(fresh, np.uint8), size, special)
            flat, before = self.words.look_up([fresh[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)])
            at = before[np.searchsorted(cuts, size)].tolist()
            self.known.update(zip(new, (flat[a:b] for a, b in zip(at[:-1], at[1:], strict=True)), strict=True))
            self.size += len(fresh)
        of = np.searchsorted(edges, starts).tolist()
        none = [np.zeros(0, np.uint32)]
        out = [np.concatenate(none + [self.known[p] for p in pieces[a:b]]) for a, b in zip(of[:-1], of[1:], strict=True)]
        # A window holds one more word on each side of the stretch, but none of another text.
        whole = np.isin(certain, starts)
        left, right = np.where(whole[last], last, last - 1), np.where(whole[first], first, first + 1)
        for k in self.disagreeing(joined, certain, left, last, first, right):
            text = int(np.searchsorted(ends, certain[left[k]], "right"))
            out[text] = self.repaired(texts[text], special)
        return out

    def disagreeing(self, joined: bytes, certain: np.ndarray, *places: np.ndarray) -> list[int]:
        """Numbers of the joins, one a text, whose window the library encodes otherwise than its parts."""
        at = np.stack([certain[p] for p in places], 1).tolist()
        windows = [(joined[p[0] : p[3]], p[1] - p[0], p[2] - p[0]) for p in at]
        new = {w: k for k, w in enumerate(windows) if w not in self.agreed}
        if not new:
            return []
        parts = [part for text, i, j in new for part in (text[:i], text[i:j], text[j:])]
        flat, before = self.words.look_up(parts)
        bad = []
        for n, (w, found) in enumerate(zip(new, self.words.library([w[0] for w in new]), strict=True)):
            if np.array_equal(found, flat[before[3 * n] : before[3 * n + 3]]):
                self.agreed.add(w)
                self.size += len(w[0])
            else:
                bad.append(w)
        return [k for k, w in enumerate(windows) if w in set(bad)] if bad else []

    def repaired(self, text: bytes, special: bool) -> np.ndarray:
        """Ids of a text one of whose joins disagreed: windows grow until they agree at both ends."""
        data = np.frombuffer(text, np.uint8)
        certain = boundaries(data, np.array([0, len(text)]), special)
        words = [text[a:b] for a, b in zip(certain[:-1].tolist(), certain[1:].tolist(), strict=True)]
        flat, before = self.words.look_up(words)
        own = lambda k: flat[before[k] : before[k + 1]]
        taken: list[tuple[int, int, np.ndarray]] = []
        for i, j in zip(*(x.tolist() for x in joins(data, certain)), strict=True):
            step = 1
            while True:
                a, b = max(0, i - step), min(len(words), j + step)
                while taken and a < taken[-1][1]:  # windows that meet become one
                    a = min(a, taken.pop()[0])
                found = self.words.library([b"".join(words[a:b])])[0]
                if (a == 0 or np.array_equal(found[: len(own(a))], own(a))) and (b == len(words) or np.array_equal(found[len(found) - len(own(b - 1)) :], own(b - 1))):
                    taken.append((a, b, found))
                    break
                step *= 2
        out, done = [np.zeros(0, np.uint32)], 0
        for a, b, found in taken:
            out += [flat[before[done] : before[a]], found]
            done = b
        return np.concatenate([*out, flat[before[done] :]])

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 text of ids, special tokens included; broken sequences become U+FFFD as in the library."""
        count = self.count[ids]
        ends = np.cumsum(count)
        data = self.pool[np.repeat(self.start[ids] - (ends - count), count) + np.arange(int(ends[-1]) if len(ends) else 0)].tobytes()
        return data.decode("utf-8", "replace").encode()


def codec(name: str) -> Codec:
    if name not in _codecs:
        _codecs[name] = Codec(name)
    return _codecs[name]


def _over(docs: DataFrame, schema: str, columns: list, make) -> DataFrame:
    """Map texts in parts of bounded size; ``make`` gives the columns after the first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, values in in_parts(batch.column(1), 1 << 20):
                cols = make(values)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *cols.values()], names=["doc_id", *cols])

    return map_arrow(docs.select(*columns), run, schema)


def encode(docs: DataFrame, tokenizer: str = TOKENIZER, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids: unsigned 32-bit ids, little-endian."""

    def make(texts: list[bytes]) -> dict:
        found = codec(tokenizer).encode(texts)
        return {"n_tokens": pa.array([len(x) for x in found], pa.int64()), "ids": pa.array([x.tobytes() for x in found], pa.binary())}

    return _over(docs, "doc_id long, n_tokens long, ids binary", [F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary")], make)


def decode(encoded: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """doc_id, text of ids as encode() writes them."""

    def make(ids: list[bytes]) -> dict:
        own = codec(tokenizer)
        return {"text": pa.array([own.decode(np.frombuffer(x, np.uint32)).decode() for x in ids], pa.string())}

    return _over(encoded, "doc_id long, text string", [F.col("doc_id"), F.col("ids")], make)


def digest(docs: DataFrame, tokenizer: str = TOKENIZER, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode in one pass: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    sha = lambda b: hashlib.sha256(b).hexdigest()

    def make(texts: list[bytes]) -> dict:
        own = codec(tokenizer)
        found = own.encode(texts)
        decimal = [sha(",".join(map(own.decimal.__getitem__, x.tolist())).encode()) for x in found]
        return {"n_tokens": pa.array([len(x) for x in found], pa.int64()), "ids_sha256": pa.array(decimal, pa.string()), "decoded_sha256": pa.array([sha(own.decode(x)) for x in found], pa.string())}

    return _over(docs, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", [F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary")], make)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(table(spark, sf_dir, "documents"))
