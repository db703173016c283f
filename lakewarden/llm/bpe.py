"""Exact byte-pair encoding of words, many at a time, for a vocabulary with word ends.

The vocabulary file is one of the ``tokenizers`` library. White space is dropped by it, so a text's ids are those of
its words one after the other. Words of common letters and signs are cut, lower-cased and merged here, whole arrays of
words per step; words with other characters, very long words and words that hold a special token go through the library.
"""

from __future__ import annotations

import os
from unicodedata import normalize

import numpy as np
import regex

from lakewarden.llm.base import kept_tool

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Fixed by the vocabulary file: how it cuts lower-cased text.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
PLAIN = regex.compile(r"[!-~¡-ԯ]{1,64}")
NONE = np.int32(2**31 - 1)


def byte_letters() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(other)) for b in range(256)]


class WordBpe:
    """Ids of words; ``remember`` bounds the words kept between calls."""

    def __init__(self, path: str, remember: int = 400_000):
        import json

        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab = model["vocab"]
        self.specials = [t.content for t in self.library.get_added_tokens_decoder().values()]
        letters, end = byte_letters(), model["end_of_word_suffix"]
        self.inner = np.array([vocab[c] for c in letters], np.int32)
        self.last = np.array([vocab[c + end] for c in letters], np.int32)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int32)
        self.remember = remember
        self.pieces: dict[bytes, bytes] = {}
        self.words: dict[bytes, bytes] = {}

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where((self.keys[at] == keys) & (left >= 0) & (right >= 0), self.ranks[at], NONE)

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """Ids (little-endian, 32 bits each) of pieces of 1 to 64 bytes or so, merged lowest rank first."""
        out: list[bytes] = [b""] * len(pieces)
        lengths = np.array([len(p) for p in pieces])
        order = np.argsort(lengths, kind="stable")
        for start in range(0, len(order), 20_000):
            rows = order[start : start + 20_000]
            widths = lengths[rows]
            width = int(widths[-1])
            raw = np.frombuffer(b"".join(pieces[i].ljust(width, b"\0") for i in rows), np.uint8).reshape(-1, width)
            place = np.arange(width)
            symbols = np.where(place < widths[:, None] - 1, self.inner[raw], self.last[raw])
            symbols[place >= widths[:, None]] = -1
            ranks = np.full(symbols.shape, NONE, np.int32)
            ranks[:, :-1] = self.rank(symbols[:, :-1], symbols[:, 1:])
            while len(rows):
                at = ranks.argmin(1)
                here = np.arange(len(rows))
                best = ranks[here, at]
                over = best == NONE
                if over.any():
                    flat, sizes = symbols[over], (symbols[over] >= 0).sum(1)
                    flat = flat.astype("<u4")
                    for i, ids, size in zip(rows[over].tolist(), flat, sizes.tolist(), strict=True):
                        out[i] = ids[:size].tobytes()
                    go = ~over
                    rows, symbols, ranks, at, best = rows[go], symbols[go], ranks[go], at[go], best[go]
                    here = here[: len(rows)]
                    if not len(rows):
                        break
                symbols[here, at] = self.made[best]
                width = symbols.shape[1]
                # The symbol right of the merged one goes; those after it move up.
                moved = np.minimum(np.arange(width) + (np.arange(width) > at[:, None]), width - 1)
                symbols = np.take_along_axis(symbols, moved, 1)
                symbols[:, -1] = -1
                ranks = np.take_along_axis(ranks, moved, 1)
                ranks[:, -1] = NONE
                after = np.minimum(at + 1, width - 1)
                ranks[here, at] = np.where(after > at, self.rank(symbols[here, at], symbols[here, after]), NONE)
                before = np.maximum(at - 1, 0)
                ranks[here, before] = np.where(at > 0, self.rank(symbols[here, before], symbols[here, at]), ranks[here, before])
                used = int((symbols >= 0).sum(1).max())
                symbols, ranks = symbols[:, :used], ranks[:, :used]
        return out

    def cut(self, word: bytes) -> tuple[bytes, ...] | None:
        """The lower-cased pieces of a word that is more than plain letters; None if the library must take it."""
        if len(word) > 200:
            return None
        text = word.decode()
        if not PLAIN.fullmatch(text) or any(s in text for s in self.specials):
            return None
        text = normalize("NFC", text).replace("Σ", "σ").lower()
        if text.isalpha():
            return (text.encode(),)
        return tuple(p.encode() for p in PIECES.findall(text))

    def encode_new(self, words: list[bytes]) -> list[bytes]:
        """Ids of distinct words."""
        known, cuts = self.pieces, []
        for word in words:
            low = word.lower()
            if low.isalpha() and len(low) <= 64:  # of bytes: ASCII letters only
                cuts.append((low,))
            elif len(low) <= 64 and low[-1:] in b".," and low[:-1].isalpha():
                cuts.append((low[:-1], low[-1:]))
            else:
                cuts.append(self.cut(word))
        new = list({p for c in cuts if c for p in c}.difference(known))
        known.update(zip(new, self.merge(new), strict=True))
        out = []
        for word, c in zip(words, cuts, strict=True):
            if c is None:
                ids = self.library.encode(word.decode(), add_special_tokens=False).ids
                out.append(np.array(ids, "<u4").tobytes())
            elif len(c) == 1:
                out.append(known[c[0]])
            elif len(c) == 2:
                out.append(known[c[0]] + known[c[1]])
            else:
                out.append(b"".join([known[p] for p in c]))
        if len(known) > self.remember:
            for p in new:
                del known[p]
        return out

    def table(self, words: set[bytes], encode=None) -> dict[bytes, bytes]:
        """A table with the ids of these words at least; frequent words stay in it."""
        new = list(words - self.words.keys())
        if len(self.words) + len(new) > self.remember:
            # Words met first are the frequent ones; later ones live for this call only.
            return self.words | dict(zip(new, (encode or self.encode_new)(new), strict=True)) if new else self.words
        self.words.update(zip(new, (encode or self.encode_new)(new), strict=True))
        return self.words


def word_bpe(path: str) -> WordBpe:
    return kept_tool(WordBpe, path)
