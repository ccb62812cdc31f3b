"""Subword ids of a public tokenizer, encoded piece by piece through a cache.

The tokenizer lower-cases, cuts a text by a fixed pattern (letters, single
digits, runs of other signs, a few English endings) and never merges across a
cut, so a text's ids are the ids of its pieces in order. Texts whose characters
leave no doubt about case, class or normal form are cut here by that pattern
many at once in numpy, and only pieces that are new to the worker go to the
tokenizer; any other text goes to it whole. Pieces are told apart by 64-bit
hashes.
"""

from __future__ import annotations

import os
import re

import numpy as np

from ledgerline.llm.common import mix, powers, span_hash

#: Folder of the tokenizer file; the package's own place if not set.
FOLDER = os.environ.get("PUBLIC_TOKENIZERS", "")
FILE = "word_bpe_49k.json"
VOCABULARY = 49_408
#: The id 1 that closes a document, as little-endian unsigned 32-bit.
END_ID = (1).to_bytes(4, "little")
#: Pieces kept per worker, some 50 bytes each; the cache starts anew beyond it.
CACHED = 1_000_000
#: Texts are encoded in groups of about this many characters.
GROUP = 1 << 20
#: The pattern, and its form for a lower-cased ASCII text; ``cuts`` makes the same cuts.
_PIECE = re.compile(r"'(?:s|t|re|ve|m|ll|d)|[^\W\d_]+|[0-9]|(?:[^\w\s]|_)+")
_ASCII_PIECE = re.compile(r"'(?:s|t|re|ve|m|ll|d)|[a-z]+|[0-9]|[^a-z0-9\s]+")
_CLASSES = (r"[^\W\d_]", "[0-9]", r"[^\w\s]|_")
_BETWEEN, _DIGIT = 0, 2
#: Characters whose case, class or normal form is left to the tokenizer, and the start of its special tokens.
_UNSURE = re.compile("[\x1c-\x1f\x85\xa0ªµº²³¹¼-¾İȺ-‏ -\U0010ffff]|<\\|")
#: Class of every character below the last ones that are sure: letter, digit, other sign, or between pieces.
_CLASS = np.array([next((i for i, c in enumerate(_CLASSES, 1) if re.match(c, chr(x))), _BETWEEN) for x in range(0x2100)], np.uint8)
_CODES = mix(np.arange(1, len(_CLASS) + 1, dtype=np.uint64))


def tokenizer():
    from tokenizers import Tokenizer

    if FOLDER:
        return Tokenizer.from_file(os.path.join(FOLDER, FILE))
    import public_tokenizers

    return Tokenizer.from_file(public_tokenizers.path(FILE))


def cuts(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the pieces of lower-cased code points that end with white space:
    's 't 're 've 'm 'll 'd, else runs of letters, single digits, runs of other signs."""
    of = _CLASS[codes]
    start = np.ones(len(codes), bool)
    start[1:] = (of[1:] != of[:-1]) | (of[1:] == _DIGIT)
    at = np.flatnonzero(start[:-1] & (codes[:-1] == ord("'")) & start[1:])
    a, b = codes[at + 1], codes[np.minimum(at + 2, len(codes) - 1)]
    one = np.isin(a, [ord(x) for x in "stmd"])
    two = np.isin(a, [ord("r"), ord("v")]) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))
    start[at[one | two] + 1] = False
    start[at[one] + 2] = True
    start[at[two] + 3] = True
    at = np.flatnonzero(start)
    end = np.append(at[1:], len(codes))
    solid = of[at] != _BETWEEN
    return at[solid], end[solid]


class Encoder:
    """Texts to their ids as little-endian unsigned 32-bit."""

    def __init__(self):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = tokenizer()
        self.clear()

    def clear(self) -> None:
        self.piece, self.row = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.ids, self.size = np.zeros(0, "<u4"), np.zeros(0, np.int64)

    def _encoded(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def _learn(self, new: list[str]) -> None:
        ids, size = [self.ids], [self.size]
        for at in range(0, len(new), 1000):
            part = new[at:at + 1000]
            e = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            word = np.array(e.word_ids)
            cut = np.concatenate([[0], np.flatnonzero(np.diff(word)) + 1, [len(word)]])
            if len(cut) == len(part) + 1:
                ids.append(np.array(e.ids, "<u4"))
                size.append(np.diff(cut))
            else:  # a piece that the tokenizer cuts again
                own = [self._encoded(p) for p in part]
                ids += own
                size.append(np.array([len(x) for x in own]))
        self.ids, self.size = np.concatenate(ids), np.concatenate(size)

    def _rows(self, h: np.ndarray, text: str, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Row in ids and size of every piece text[start:end] with hash h."""
        kind, first, of = np.unique(h, return_index=True, return_inverse=True)
        if len(self.piece) > CACHED:
            self.clear()
        at = np.searchsorted(self.piece, kind)
        new = np.ones(len(kind), bool)
        inside = at < len(self.piece)
        new[inside] = self.piece[at[inside]] != kind[inside]
        if new.any():
            row = len(self.size) + np.arange(new.sum())
            self._learn([text[a:b] for a, b in zip(start[first[new]].tolist(), end[first[new]].tolist())])
            self.piece = np.insert(self.piece, at[new], kind[new])
            self.row = np.insert(self.row, at[new], row)
            at = np.searchsorted(self.piece, kind)
        return self.row[at][of]

    def _sure(self, texts: list[str]) -> list[bytes]:
        text = "\n".join([*texts, ""]).lower()
        codes = np.frombuffer(text.encode("utf-32-le"), "<u4")
        start, end = cuts(codes)
        hashes = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(_CODES[codes] * powers(len(hashes))[0][:len(codes)], out=hashes[1:])
        row = self._rows(span_hash(hashes, start, end), text, start, end)
        size = self.size[row]
        before = np.concatenate([[0], np.cumsum(size)])
        begin = np.cumsum(self.size) - self.size
        raw = self.ids[np.repeat(begin[row] - before[:-1], size) + np.arange(before[-1])].tobytes()
        first = np.cumsum([0, *(len(t) + 1 for t in texts)])  # no sure character changes its length
        cut = (4 * before[np.searchsorted(start, first)]).tolist()
        return [raw[a:b] for a, b in zip(cut, cut[1:])]

    def _group(self, texts: list[str]) -> list[bytes]:
        sure = [not _UNSURE.search(t) for t in texts]
        ids = iter(self._sure([t for t, s in zip(texts, sure) if s]) if any(sure) else [])
        return [next(ids) if s else self._encoded(t).tobytes() for t, s in zip(texts, sure)]

    def __call__(self, texts: list[str]) -> list[bytes]:
        out, group, size = [], [], 0
        for t in texts:
            group.append(t)
            size += len(t)
            if size >= GROUP:
                out += self._group(group)
                group, size = [], 0
        return out + self._group(group)


_ENCODER: list[Encoder] = []


def encoder() -> Encoder:
    """The worker's encoder; its cache lives as long as the worker."""
    if not _ENCODER:
        _ENCODER.append(Encoder())
    return _ENCODER[0]
