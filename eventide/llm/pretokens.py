"""Byte-level BPE: vectorised word splitting, word encoding, id pieces.

``WordSplitter`` cuts texts where the tokenizer's own pattern does (optional
leading space plus a run of letters, of numbers or of other characters; white
space runs). Character classes come from the tokenizer itself, one question
per new character. Texts with an apostrophe (contractions) or an added token
are cut by the tokenizer. Its distinct words are exact, whatever their hashes.
``WordEncoder`` turns one word into ids.
"""

from __future__ import annotations

import json

import numpy as np
import tiktoken
from tokenizers import Tokenizer

from .wordbytes import give_back, mix

BLOCK_CHARS = 1 << 19
_BASE = np.uint64(0xD1342543DE82EF95)
_INVERSE = np.uint64(pow(0xD1342543DE82EF95, -1, 1 << 64))


def byte_alphabet() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the
    others, in order, for the characters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class WordEncoder:
    """Ids of single words (no splitting), and the bytes of each id."""

    def __init__(self, path: str):
        spec = json.load(open(path, encoding="utf-8"))
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        alphabet = byte_alphabet()
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        raw = {w: bytes(alphabet[c] for c in w) for w in vocab if w not in self.added}
        self.pieces = {vocab[w]: b for w, b in raw.items()} | {
            i: w.encode() for w, i in self.added.items()}
        made = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in merges]
        # ids in merge order are ranks; any other vocabulary is encoded by the library
        self._tokenizer = None
        if all(a < b for a, b in zip(made, made[1:])):
            self._ranks = tiktoken.Encoding(
                "words", pat_str=r"[\s\S]+", special_tokens={},
                mergeable_ranks={b: vocab[w] for w, b in raw.items()})
        else:
            self._tokenizer = Tokenizer.from_file(path)

    def __call__(self, word: str) -> list[int]:
        if word in self.added:
            return [self.added[word]]
        if self._tokenizer is not None:
            return self._tokenizer.encode(word, add_special_tokens=False).ids
        return self._ranks.encode_ordinary(word)


class WordSplitter:
    """Code points and word starts of blocks of texts."""

    def __init__(self, path: str):
        self._tokenizer = Tokenizer.from_file(path)
        self._pre = self._tokenizer.pre_tokenizer
        self._added = sorted((t.content for t in
                              self._tokenizer.get_added_tokens_decoder().values()), key=len)
        self._kind = np.full(0x110000, 255, np.uint8)
        self._value = mix(np.arange(0x110000, dtype=np.uint64) + np.uint64(0x9E3779B9))
        self._power = self._inverse = np.ones(1, np.uint64)

    def _one(self, text: str) -> bool:
        return len(self._pre.pre_tokenize_str(text)) == 1

    def _kinds(self, points: np.ndarray) -> np.ndarray:
        """1 letter, 2 number, 3 white space, 0 other; asked of the tokenizer."""
        kind = self._kind[points]
        if (kind == 255).any():
            for p in np.unique(points[kind == 255]).tolist():
                c = chr(p)
                self._kind[p] = (1 if self._one("a" + c) else 2 if self._one("1" + c)
                                 else 0 if self._one("!" + c) else 3)
            kind = self._kind[points]
        return kind

    def _by_library(self, text: str) -> list[int]:
        """Word starts of a text, cut at added tokens and then by the tokenizer."""
        for token in self._added:
            if token in text:
                starts, at = [], 0
                for part in text.split(token):
                    starts += [at + s for s in (self._by_library(part) if part else [])]
                    at += len(part)
                    if at < len(text):
                        starts.append(at)
                    at += len(token)
                return starts
        return [a for _, (a, _) in self._pre.pre_tokenize_str(text)]

    def split(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(code points, word starts plus the end, index of each text's first word)."""
        points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        n = len(points)
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        if not n:
            return points, np.zeros(1, np.int64), np.zeros(len(texts) + 1, np.int64)
        kind, space = self._kinds(points), points == 32
        first = np.zeros(n + 1, bool)
        first[offsets] = True
        start = first.copy()
        start[1:n] |= kind[1:] != kind[:-1]
        runs = np.flatnonzero(start[:n])
        ends = np.append(runs[1:], n)
        white = kind[runs] == 3
        # a word takes one space before it
        lead = runs[~white & ~first[runs]]
        lead = lead[space[lead - 1]]
        # of white space before a word, the last character stands apart
        last = ends[white] - 1
        last = last[~first[last + 1]]
        start[lead] = False
        start[last] = True
        for k, text in enumerate(texts):
            if "'" in text or any(t in text for t in self._added):
                start[offsets[k]:offsets[k + 1]] = False
                start[offsets[k] + np.array(self._by_library(text), np.int64)] = True
        start[n] = True
        starts = np.flatnonzero(start)
        return points, starts, np.searchsorted(starts, offsets)

    def hashes(self, points: np.ndarray, starts: np.ndarray) -> np.ndarray:
        n = len(points)
        if len(self._power) < n:
            for name, base in (("_power", _BASE), ("_inverse", _INVERSE)):
                steps = np.full(max(n, BLOCK_CHARS), base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self._value[points] * self._power[:n], out=sums[1:])
        a, b = starts[:-1], starts[1:]
        return mix((sums[b] - sums[a]) * self._inverse[a] + (b - a).astype(np.uint64))

    def distinct(self, texts: list[str], points: np.ndarray,
                 starts: np.ndarray) -> tuple[np.ndarray, list[str]]:
        """(each word's number among the distinct words, the distinct words) of texts
        that ``split`` cut.

        Hashes propose, characters decide: every word is compared with the first
        of its hash, and where two differ the block's words are numbered one by one."""
        size = np.diff(starts)
        if not len(size):
            return np.zeros(0, np.int64), []
        joined = "".join(texts)
        _, first, index = np.unique(self.hashes(points, starts), return_index=True,
                                    return_inverse=True)
        like = first[index]
        if (size[like] == size).all():
            spot = np.repeat((starts[like] - starts[:-1]).astype(np.int32), size)
            spot += np.arange(len(points), dtype=np.int32)
            if (points[spot] == points).all():
                return index, [joined[a:b] for a, b in zip(starts[first].tolist(),
                                                           starts[first + 1].tolist())]
        numbers: dict[str, int] = {}
        index = np.array([numbers.setdefault(joined[a:b], len(numbers))
                          for a, b in zip(starts[:-1].tolist(), starts[1:].tolist())], np.int64)
        return index, list(numbers)

    @staticmethod
    def word(points: np.ndarray, a: int, b: int) -> str:
        return points[a:b].tobytes().decode("utf-32-le")


def text_blocks(texts: list[str], limit: int = BLOCK_CHARS):
    """(first, texts) of runs of texts of about ``limit`` characters."""
    row = 0
    while row < len(texts):
        stop, size = row, 0
        while stop < len(texts) and (size == 0 or size + len(texts[stop]) <= limit):
            size += len(texts[stop])
            stop += 1
        yield row, texts[row:stop]
        row = stop
    give_back()


def spread(flat: np.ndarray, at: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Concatenate ``flat[at[i]:at[i + 1]]`` for i in ``index``; and the running ends."""
    size = (at[1:] - at[:-1])[index]
    ends = np.concatenate([[0], np.cumsum(size)])
    where = np.repeat(at[index] - ends[:-1], size) + np.arange(ends[-1])
    return flat[where], ends
