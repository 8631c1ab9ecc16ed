"""Token ids of whole texts for tokenizers that drop white space: each distinct word is encoded once per worker.

Such a tokenizer never lets a token span white space, so a text's ids are the ids of its space-separated words in order.
Words are cut at ASCII white space only; any other white space stays within a word and is left to the library. For a
tokenizer that also lower-cases, A-Z are folded first, and words are also cut between a Latin letter and an ASCII mark
other than the apostrophe, where the pre-tokenizer cuts whatever stands around; both let more words be shared.
"""

from __future__ import annotations

import json
import re

import numpy as np

#: Words that one worker remembers; beyond it keeps those met more than once, which changes speed, not results.
CACHED_WORDS = 200_000
#: Latin letters (\p{L}) that NFC leaves as they are and that lower-casing only moves by 32, where no mark follows.
_PLAIN = re.compile("[a-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+").fullmatch
_SPACE = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
_SMALL, _MARK = (np.isin(np.arange(256), [*x]) for x in (range(97, 123), b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"))

_encoders: dict[tuple[str, bool], WordEncoder] = {}


def byte_table() -> dict[str, int]:
    """The byte that each printable character of a byte-level vocabulary stands for: printable Latin-1 as itself, the rest from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


def load_tokenizer(name: str):
    """A public tokenizer by file name or path, without truncation and padding."""
    import os

    import public_tokenizers
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokenizer = Tokenizer.from_file(name if os.path.isabs(name) else public_tokenizers.path(name))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


class WordEncoder:
    """Maps lists of byte strings to flat arrays of ids."""

    def __init__(self, name: str, plain: bool = False):
        self.tokenizer = load_tokenizer(name)
        self.tokenizer.encode_special_tokens = plain  # their strings in a text are then ordinary text
        self.dtype = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        whole = json.loads(self.tokenizer.to_str())
        steps = (whole["normalizer"] or {}).get("normalizers", [whole["normalizer"] or {}])
        self.folds = any(x.get("type") == "Lowercase" for x in steps)
        # Byte-level models take each byte of UTF-8 as a character; those of plain words stand for themselves.
        shown = {b: c for c, b in byte_table().items()}
        self.byte_level = {c: "".join(shown[b] for b in chr(c).lower().encode()) for c in range(0xC0, 0x100)}
        self.slot: dict[bytes, int] = {}
        self.start, self.count, self.used = (np.zeros(0, np.int64) for _ in range(3))
        self.pool = np.zeros(0, self.dtype)
        self.direct = self.folds and self._agrees()

    def _plain_ids(self, word: str) -> list[int]:
        return [t.id for t in self.tokenizer.model.tokenize(word.translate(self.byte_level))]

    def _agrees(self) -> bool:
        """Whether plain words may go to the model directly: tried on a word of every such letter."""
        words = [w for c in [*range(97, 123), *range(0xC0, 0x100)] if _PLAIN(w := f"a{chr(c)}e{chr(c)}the")]
        return all(self._plain_ids(w) == self.tokenizer.encode(w, add_special_tokens=False).ids for w in words)

    def forget(self) -> None:
        """Keep the words that were met more than once since they were learnt."""
        keep = np.flatnonzero(self.used > 1)
        names = list(self.slot)
        count, start = self.count[keep], self.start[keep]
        ends = np.cumsum(count)
        self.pool = self.pool[np.repeat(start - (ends - count), count) + np.arange(int(ends[-1]) if len(ends) else 0)]
        self.slot = {names[k]: i for i, k in enumerate(keep.tolist())} if len(keep) < CACHED_WORDS // 2 else {}
        self.start, self.count, self.used = ends - count, count, np.zeros(len(keep), np.int64)
        if not self.slot:
            self.start, self.count, self.used, self.pool = self.start[:0], self.count[:0], self.used[:0], self.pool[:0]

    def learn(self, words: list[bytes]) -> None:
        texts = [w.decode() for w in words]
        odd = [k for k, w in enumerate(texts) if not (self.direct and _PLAIN(w))]
        rest = dict(zip(odd, self.tokenizer.encode_batch_fast([texts[k] for k in odd], add_special_tokens=False), strict=True))
        model, table = self.tokenizer.model, self.byte_level
        found = [rest[k].ids if k in rest else [t.id for t in model.tokenize(w if w.isascii() else w.translate(table))] for k, w in enumerate(texts)]
        self.keep(words, found)

    def keep(self, words: list[bytes], found: list[list[int]]) -> None:
        """Remember the ids of words."""
        count = np.fromiter(map(len, found), np.int64, len(found))
        first = len(self.slot)
        self.slot.update(zip(words, range(first, first + len(words)), strict=True))
        self.start = np.concatenate([self.start, len(self.pool) + np.cumsum(count) - count])
        self.count = np.concatenate([self.count, count])
        self.used = np.concatenate([self.used, np.zeros(len(words), np.int64)])
        self.pool = np.concatenate([self.pool, np.fromiter((i for ids in found for i in ids), self.dtype, int(count.sum()))])

    def cut(self, texts: list[bytes]) -> tuple[list[bytes], np.ndarray]:
        """All words, and how many lie before the end of each text (0 first)."""
        joined = b" ".join(texts) + b" "
        size = np.array([len(t) + 1 for t in texts], np.int64)
        if self.folds and b"<|" not in joined:  # special tokens are found before letters are folded
            joined = joined.lower()
            data = np.frombuffer(joined, np.uint8)
            letter = _SMALL[data]
            letter[1:] |= (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] != 0x97) & (data[1:] != 0xB7)
            starts = letter | (data == 0xC3) & np.append(letter[1:], False)
            mark = _MARK[data]
            at = np.flatnonzero(mark[1:] & letter[:-1] | mark[:-1] & starts[1:]) + 1
            ends = np.cumsum(size)
            size = np.diff(ends + np.searchsorted(at, ends), prepend=0)
            joined = np.insert(data, at, 32).tobytes()
        space = _SPACE[np.frombuffer(joined, np.uint8)]
        stops = np.flatnonzero(space[1:] & ~space[:-1])
        return joined.split(), np.concatenate([[0], np.searchsorted(stops, np.cumsum(size) - 1)])

    def look_up(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of words, and how many lie before the end of each word (0 first)."""
        if len(self.slot) > CACHED_WORDS:
            self.forget()
        unknown = list(set(words).difference(self.slot))
        if unknown:
            self.learn(unknown)
        slots = np.fromiter(map(self.slot.__getitem__, words), np.int64, len(words))
        self.used += np.bincount(slots, minlength=len(self.used))
        count = self.count[slots]
        ends = np.concatenate([[0], np.cumsum(count)])
        return self.pool[np.repeat(self.start[slots] - ends[:-1], count) + np.arange(ends[-1])], ends

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all texts, and how many each text has."""
        words, before = self.cut(texts)
        ids, ends = self.look_up(words)
        return ids, np.diff(ends[before])


def word_encoder(name: str, plain: bool = False) -> WordEncoder:
    if (name, plain) not in _encoders:
        _encoders[name, plain] = WordEncoder(name, plain)
    return _encoders[name, plain]


def in_parts(column, limit: int = 1 << 19):
    """Ranges of a column of byte strings, of about ``limit`` bytes and one string at least, with their values; nulls are empty."""
    import pyarrow.compute as pc

    size = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends, first = np.cumsum(size), 0
    while first < len(size):
        done = ends[first - 1] if first else 0
        stop = max(first + 1, int(np.searchsorted(ends, done + limit, "right")))
        yield first, stop, [v or b"" for v in column.slice(first, stop - first).to_pylist()]
        first = stop
