"""Token ids of whole texts by a lower-casing word BPE, one word at a time.

The tokenizer drops white space and never joins text across it (its patterns, its
normalisation and its special tokens stay inside a word), so the ids of a text are those of
its words one after the other. Ids of words seen before come from a bounded table that a
Python worker keeps. New words of Latin letters go through the rank form of the same merges
(a word end is a final zero byte, merged before anything else); the library encodes every
other new word.
"""

from __future__ import annotations

import json

import numpy as np
import regex
import tiktoken
from tokenizers import Tokenizer

#: Words that a worker remembers at most; the table starts anew beyond it (results do not change).
MOST_WORDS = 500_000

#: How the tokenizer cuts lower-cased text.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")


class WordEncoder:
    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.known: dict[bytes, bytes] = {}
        with open(path, encoding="utf-8") as f:
            vocab = json.load(f)["model"]["vocab"]
        special = {t.content for t in self.library.get_added_tokens_decoder().values()}
        letters = _byte_letters()
        ranks = {}
        for token, k in vocab.items():
            if token not in special:
                end = token.endswith("</w>") and len(token) > 4
                body = bytes(letters[c] for c in (token[:-4] if end else token))
                ranks.setdefault(body + b"\0" * end, k)
        self.ranks = tiktoken.Encoding("word", pat_str=r"[^\x00]*\x00", mergeable_ranks=ranks, special_tokens={})
        self.mark = ranks[b"\x01\0"]

    def learn(self, words: list[bytes]) -> None:
        """Put the ids of new words into the table."""
        if not words:
            return
        data = np.frombuffer(b"".join(words), np.uint8)
        starts = np.cumsum([0, *map(len, words[:-1])])
        # code points under U+0250 without control bytes and special tokens
        odd = (data >= 0xCA) | (data < 0x20) | (data == ord("|"))
        plain = np.add.reduceat(odd, starts) == 0
        fast = [w for w, p in zip(words, plain, strict=True) if p]
        slow = [w for w, p in zip(words, plain, strict=True) if not p]
        for i in range(0, len(fast), 20_000):
            part = fast[i:i + 20_000]
            text = b" \x01 ".join(part).decode().lower() + " \x01"
            ids = np.array(self.ranks.encode_ordinary("\0".join(PIECES.findall(text)) + "\0"), "<u4")
            ends = np.flatnonzero(ids == self.mark)
            raw, begin = ids.tobytes(), 0
            for w, e in zip(part, ends.tolist(), strict=True):
                self.known[w] = raw[4 * begin:4 * e]
                begin = e + 1
        for i in range(0, len(slow), 4096):
            part = slow[i:i + 4096]
            got = self.library.encode_batch_fast([w.decode() for w in part], add_special_tokens=False)
            for w, e in zip(part, got, strict=True):
                self.known[w] = np.array(e.ids, "<u4").tobytes()

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text (UTF-8) as little-endian unsigned 32-bit integers."""
        if len(self.known) > MOST_WORDS:
            self.known.clear()
        split = [t.split() for t in texts]  # ASCII white space
        known = self.known
        self.learn(list({w for words in split for w in words if w not in known}))
        return [b"".join(map(known.__getitem__, words)) for words in split]


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]
