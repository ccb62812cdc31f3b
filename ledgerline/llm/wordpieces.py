"""Subword ids of words under a public byte-level BPE, many words in one call.

All words are joined by single spaces and encoded together; a token's place
among the bytes says which word it belongs to, as no token reaches from a word
into the next one's space. Words with other white space inside could break
that, and very long ones are slow to merge: these are encoded alone, in pieces
of ``LONGEST`` characters. So a word's ids never depend on its neighbours.
"""

from __future__ import annotations

import base64
import os
import re
from functools import cache

import numpy as np

#: Folder of the tokenizer file; the package's own place if not set.
FOLDER = os.environ.get("PUBLIC_TOKENIZERS", "")
FILE = "byte_bpe_50k.tiktoken"
VOCABULARY = 50_257
#: The id that the file leaves free closes a text.
END_TOKEN = 50_256
LONGEST = 128
#: Bytes of other than ASCII characters, and ASCII white space that words may hold.
_ODD = np.arange(256) >= 128
_ODD[0x1C:0x20] = True
_OTHER_SPACE = re.compile(r"[^\S ]|\ufffd")


@cache
def _bpe() -> tuple:
    """The encoding and the byte length of every id; kept per worker."""
    import public_tokenizers
    import tiktoken

    path = os.path.join(FOLDER, FILE) if FOLDER else public_tokenizers.path(FILE)
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    length = np.zeros(VOCABULARY, np.int64)
    length[list(ranks.values())] = [len(x) for x in ranks]
    return tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}), length


def _alone(word: bytes) -> list[int]:
    text = " " + word.decode("utf-8", "replace")
    return [x for i in range(0, len(text), LONGEST) for x in _bpe()[0].encode_ordinary(text[i:i + LONGEST])]


def word_ids(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the words, one word after the other, and the number of ids of each; words hold no space."""
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    bpe, length = _bpe()
    size = np.fromiter(map(len, words), np.int64, len(words)) + 1
    odd = size > LONGEST
    text = b" ".join(words).decode("utf-8", "replace")
    if _OTHER_SPACE.search(text):
        odd |= np.fromiter((_OTHER_SPACE.search(w.decode("utf-8", "replace")) is not None for w in words), bool, len(words))
    if not odd.any():
        ids = np.array(bpe.encode_ordinary(" " + text), np.int64)
        place = np.cumsum(length[ids]) - length[ids]
        return ids, np.bincount(np.searchsorted(np.cumsum(size), place, side="right"), minlength=len(words))
    plain = np.flatnonzero(~odd)
    ids, many = word_ids([words[i] for i in plain.tolist()])
    count = np.zeros(len(words), np.int64)
    count[plain] = many
    own = {i: np.array(_alone(words[i]), np.int64) for i in np.flatnonzero(odd).tolist()}
    cut = np.cumsum(many) - many
    nth = np.searchsorted(plain, list(own))  # plain words before each odd one
    count[list(own)] = [len(x) for x in own.values()]
    at = np.append(cut, len(ids))[nth]
    return np.insert(ids, np.repeat(at, [len(x) for x in own.values()]), np.concatenate(list(own.values()))), count


def spans_ids(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``word_ids`` of the words data[starts:ends]. Short ASCII words are joined in numpy, all others go there one by one."""
    size = ends - starts
    odd = np.flatnonzero(_ODD[data])
    plain = (size < LONGEST) & (np.searchsorted(odd, starts) == np.searchsorted(odd, ends))
    at, other = np.flatnonzero(plain), np.flatnonzero(~plain)
    raw = data.tobytes()
    own, many = word_ids([raw[a:b] for a, b in zip(starts[other].tolist(), ends[other].tolist())])
    if not len(at):
        return own, many
    # Each word after a space.
    size = size[at] + 1
    begin = np.cumsum(size) - size
    text = data[np.repeat(starts[at] - 1 - begin, size) + np.arange(size.sum())]
    text[begin] = 0x20
    bpe, length = _bpe()
    ids = np.array(bpe.encode_ordinary(text.tobytes().decode("ascii")), np.int64)
    of = np.repeat(np.arange(len(at)), size)[np.cumsum(length[ids]) - 1]
    count = np.zeros(len(starts), np.int64)
    count[at], count[other] = np.bincount(of, minlength=len(at)), many
    if len(other):
        word = np.concatenate([at[of], np.repeat(other, many)])
        ids = np.concatenate([ids, own])[np.argsort(word, kind="stable")]
    return ids, count
