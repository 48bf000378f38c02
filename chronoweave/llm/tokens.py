"""Whole-text encoding with a public byte-level tokenizer.

A text is encoded piece by piece where that is exact. Texts of common alphabets are cut by the
tokenizer's own split pattern, whose pieces its model encodes one by one, and the ids of a piece
are remembered. In others that pattern always starts a new piece at a single space between two
non-space characters, so the ids of ``" word"`` do not depend on what stands before it, and are
remembered. Texts with other white space around a space there, or holding a special token's
string, are encoded as one string. Either way the ids are those of
``encode(text, add_special_tokens=False)``.
"""
from __future__ import annotations

import codecs
import json
import re
import sys
import unicodedata
from array import array
from itertools import islice

import numpy as np

_WIDE = re.compile(r" \s|\s ")
#: ASCII white space: a text without other characters beside a space is cut at spaces.
_ASCII_SPACES = "\t\n\r\x0b\x0c\x1c\x1d\x1e\x1f"
#: Characters whose class every Unicode version gives alike: Latin, Greek, Cyrillic, punctuation.
_KNOWN = [chr(c) for c in (*range(0x530), *range(0x2010, 0x2028), 0x20ac) if unicodedata.category(chr(c)) != "Cn"]
_WHITE = "\t\n\x0b\x0c\r \x85\xa0"


def _class(kind: str) -> str:
    return "".join(re.escape(c) for c in _KNOWN if unicodedata.category(c)[0] == kind)


_LETTERS, _NUMBERS = _class("L"), _class("N")
_PLAIN = re.compile(f"[{''.join(map(re.escape, _KNOWN))}]*").fullmatch
#: The byte-level split pattern as it reads on such texts; what can't begin alike may change places.
_SPLIT = re.compile(f" ?[{_LETTERS}]+|'(?:s|t|re|ve|m|ll|d)| ?[^{_WHITE}{_LETTERS}{_NUMBERS}]+| ?[{_NUMBERS}]+"
                    f"|[{_WHITE}]+(?![^{_WHITE}])|[{_WHITE}]+").findall
#: The byte alphabet: printable bytes stand for themselves, the others for what follows U+00FF.
_SELF = [*range(0x21, 0x7f), *range(0xa1, 0xad), *range(0xae, 0x100)]
_ALPHABET = "".join(chr(b if b in _SELF else 0x100 + sum(x not in _SELF for x in range(b))) for b in range(0x100))
_LONG = 64  # characters of the longest piece that is remembered
_CACHE: dict[tuple[str, int, bool], "TextEncoder"] = {}


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def encoder(path: str | None = None, cache_words: int = 300_000, count: bool = False) -> "TextEncoder":
    """One encoder per worker process and tokenizer file. Tasks call :meth:`TextEncoder.forget` at
    their end, so that an idle worker holds the vocabulary only."""
    key = (path or default_path(), cache_words, count)
    if key not in _CACHE:
        _CACHE[key] = TextEncoder(*key)
    return _CACHE[key]


class _Pieces(dict):
    """Ids (or their number) of what the split pattern leaves whole, by the tokenizer's model."""

    def __init__(self, model, count: bool):
        super().__init__()
        self.tokenize, self.count = model.tokenize, count

    def __missing__(self, piece: str) -> bytes | int:
        found = self.tokenize(codecs.charmap_decode(piece.encode(), "strict", _ALPHABET)[0])
        x = len(found) if self.count else array("I", [t.id for t in found]).tobytes()
        if len(piece) <= _LONG:
            self[piece] = x
        return x

    def shorten(self, n: int) -> None:
        first = list(islice(self.items(), n))
        self.clear()
        self.update(first)


class TextEncoder:
    """Ids of texts, or only their number (``count``), with the words met so far remembered: at most
    ``cache_words`` and what one chunk of texts adds."""

    def __init__(self, path: str, cache_words: int, count: bool = False):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        #: UTF-8 bytes of each id (one character of the byte alphabet is one byte)
        self.widths = np.zeros(max(vocab.values()) + 1, np.int64)
        for token, i in vocab.items():
            self.widths[i] = len(token)
        added = self.tokenizer.get_added_tokens_decoder()
        self.special = [t.content for t in added.values()]
        for i, t in added.items():
            self.widths[i] = len(t.content.encode())
        self.cache: dict[str, bytes | int] = {}
        self.limit, self.count = cache_words, count
        self._sum = sum if count else b"".join
        # words are cut further where the tokenizer splits by the byte-level pattern and nothing else
        split = json.loads(self.tokenizer.to_str())
        known = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        plain = split["normalizer"] is None and split["model"]["type"] == "BPE" and not split["model"].get("dropout")
        cuts = plain and known.items() <= (split["pre_tokenizer"] or {}).items() and array("I").itemsize == 4 and sys.byteorder == "little"
        self.pieces = _Pieces(self.tokenizer.model, count) if cuts else None

    def forget(self) -> None:
        self.cache.clear()
        if self.pieces is not None:
            self.pieces.clear()

    def _plain(self, text: str) -> bytes | int:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return len(ids) if self.count else np.array(ids, "<u4").tobytes()

    def _joined(self, words: list[str], sep: str) -> list[bytes] | list[int]:
        """Ids of ``sep + word`` (sep a space) or of ``word`` (sep a line feed), in one call."""
        text = " " + " ".join(words) if sep == " " else "\n".join(words)
        ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
        if text.isascii():
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        else:
            ends = np.cumsum([len(w.encode()) + 1 for w in words])
        if sep != " ":
            ends[-1] -= 1
        at = np.searchsorted(np.cumsum(self.widths[ids]), ends) + 1
        starts = np.concatenate(([0], at[:-1]))
        # a line feed after a word is an id of its own
        stops = at if sep == " " else at - (np.arange(len(at)) < len(at) - 1)
        if self.count:
            return (stops - starts).tolist()
        raw = ids.tobytes()
        return [raw[a:b] for a, b in zip((4 * starts).tolist(), (4 * stops).tolist())]

    def encode_many(self, texts: list[str], chunk_chars: int = 2_000_000) -> list[bytes] | list[int]:
        """Ids of each text as little-endian unsigned 32-bit integers, or their number."""
        out: list = []
        at, n = 0, len(texts)
        while at < n:
            end, chars = at, 0
            while end < n and (end == at or chars + len(texts[end]) <= chunk_chars):
                chars += len(texts[end])
                end += 1
            out += self._chunk(texts[at:end])
            at = end
        return out

    def _whole(self, text: str) -> bool:
        """Whether a text has to be encoded as one string."""
        if text.isascii():
            wide = "  " in text or any(c in text and (f" {c}" in text or f"{c} " in text) for c in _ASCII_SPACES)
        else:
            wide = _WIDE.search(text) is not None
        return wide or text[-1:].isspace() or any(s in text for s in self.special)

    def _chunk(self, texts: list[str]) -> list[bytes] | list[int]:
        if self.pieces is None:
            return self._by_words(texts)
        if len(self.pieces) > self.limit:
            self.pieces.shorten(self.limit // 2)
        look, total = self.pieces.__getitem__, self._sum
        out: list = []
        for t in texts:
            x = None
            if _PLAIN(t) and not any(s in t for s in self.special):
                found = _SPLIT(t)
                # words of many pieces take fewer look-ups as words
                if len(found) <= 2 * (t.count(" ") + 1):
                    x = total(map(look, found))
            out.append(x)
        rest = [i for i, x in enumerate(out) if x is None]
        for i, x in zip(rest, self._by_words([texts[i] for i in rest])):
            out[i] = x
        return out

    def _by_words(self, texts: list[str]) -> list[bytes] | list[int]:
        pieces: list[list[str] | None] = []
        met: set[str] = set()
        for t in texts:
            p = None if self._whole(t) else t.split(" ")
            pieces.append(p)
            if p:
                met.update(p)
        if len(self.cache) > self.limit:
            # the words that this chunk has too are those that come again
            self.cache = {w: self.cache[w] for w in met if w in self.cache}
        cache = self.cache
        # the first piece has no space before it: those are encoded apart, below
        words = [w for w in met.difference(cache) if w and not w[0].isspace() and not w[-1].isspace()]
        if self.pieces is not None:
            look, total = self.pieces.__getitem__, self._sum
            rest = []
            for w in words:
                if _PLAIN(w):
                    cache[w] = total(map(look, _SPLIT(" " + w)))
                else:
                    rest.append(w)
            words = rest
        for i in range(0, len(words), 20_000):
            part = words[i:i + 20_000]
            cache.update(zip(part, self._joined(part, " ")))
        heads = list({p[0] for p in pieces if p and p[0] and p[0].strip() == p[0]})
        first = dict(zip(heads, self._joined(heads, "\n"))) if heads else {}
        look, total = cache.__getitem__, self._sum
        out = []
        for t, p in zip(texts, pieces):
            if p is None:
                out.append(self._plain(t))
            else:
                h = p[0]
                p[0] = first[h] if h in first else self._plain(h)
                p[1:] = map(look, p[1:])
                out.append(total(p))
        return out

    def spans(self, text: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Character spans (start, end) of a text's ids; an id that holds part of a character
        spans that whole character."""
        raw = np.frombuffer(text.encode(), np.uint8)
        end = np.cumsum(self.widths[ids])
        start = end - self.widths[ids]
        if len(raw) == len(text):
            return start, end
        char = np.cumsum((raw & 0xC0) != 0x80) - 1
        return char[start], char[end - 1] + 1
