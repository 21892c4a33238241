"""Byte-level BPE ids of whole texts, chunk by chunk."""

from __future__ import annotations

import re
import string
import struct

import numpy as np

# Unicode White_Space: the tokenizer's pattern never lets a match cross from
# a non-space to a space, so texts may be cut there without changing an id.
_WS = "".join(map(chr, (*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
# Runs of Latin letters, all of them in the tokenizer's letter class: a run ends
# one of its matches when white space or one of .,;:!? follows.
_LETTERS = "".join(f"{chr(a)}-{chr(b)}" for a, b in ((65, 90), (97, 122), (0xC0, 0xD6), (0xD8, 0xF6), (0xF8, 0xFF)))
_CHUNK = re.compile(f"[ \\n]*[{_LETTERS}]+(?=[ \\n.,;:!?]|\\Z)|[{_WS}]*[^{_WS}]+|[{_WS}]+")
_CUT = re.compile(f"(?<=[^{_WS}])(?=[{_WS}])")
# White space but blanks and line ends: in Latin-1, and beyond it.
_OTHER = [c for c in _WS if c not in " \n" and c <= "\xff"]
_WIDE = re.compile(f"[{''.join(c for c in _WS if c > chr(0xFF))}]")
# A part of a plain text: a mark of where it starts (none: after a blank), a word and closing
# signs, which are one match of the tokenizer: they hold no letter for an apostrophe to take.
_SIGNS = string.punctuation
_WORD = re.compile(f"([\\n\\r]?)([{_LETTERS}]+)([{re.escape(_SIGNS)}]*)")
# The characters that byte-level vocabularies show bytes as; every byte has an
# entry, since translate() is slow on those it does not find.
_SHOWN = dict(enumerate(map(chr, range(256)))) | {b: chr(0x100 + k) for k, b in enumerate((*range(0x21), *range(0x7F, 0xA1), 0xAD))}
_SLICE, _GROUP = 1 << 20, 1 << 20
_LONG = 64

_LOADED: dict[str, "ChunkTokenizer"] = {}


def default_tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def _has_other_space(text: str) -> bool:
    """White space but blanks and line ends, sought character by character in
    Latin-1 texts, which is faster than a pattern."""
    if text.isascii():
        return "\t" in text or "\r" in text or "\x0b" in text or "\x0c" in text
    if any(c in text for c in _OTHER):
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return _WIDE.search(text) is not None
    return False


def is_plain(text: str) -> bool:
    """Whether each blank or line end of ``text`` starts a chunk of its own:
    no other white space, and no runs but two line ends before a word (the
    tokenizer takes those one by one)."""
    return not ("  " in text or "\n" in text and (" \n" in text or "\n " in text or "\n\n\n" in text or text.endswith("\n\n"))
                or _has_other_space(text))


# Odd multipliers of two hashes modulo 2**64, a value per byte for each, and the
# powers that bring every place of a buffer to one scale.
_BASE = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_BYTE = tuple(np.random.default_rng(k).integers(1, 1 << 63, 256, dtype=np.uint64) for k in range(2))
_POWERS: list[tuple[np.ndarray, np.ndarray]] = []


def _powers(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    if not _POWERS or len(_POWERS[0][0]) < n:
        def row(base):
            x = np.full(n, base, dtype=np.uint64)
            x[0] = 1
            return np.cumprod(x)
        _POWERS[:] = [(row(b), row(pow(b, -1, 1 << 64))) for b in _BASE]
    return _POWERS


def distinct_parts(buffer: bytes) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Cut ``buffer`` before every blank, line end and byte 0xFF: (the distinct
    parts, the number of each part's text among them, the parts' starts).
    Parts are told apart by two 64-bit hashes."""
    x = np.frombuffer(buffer, dtype=np.uint8)
    starts = np.flatnonzero((x == 0x20) | (x == 0x0A) | (x == 0xFF))
    ends = np.append(starts[1:], len(x))
    code = np.zeros(len(starts), dtype=np.uint64)
    for byte, (up, down) in zip(_BYTE, _powers(len(x) + 1)):
        total = np.empty(len(x) + 1, dtype=np.uint64)
        total[0] = 0
        np.multiply(byte[x], up[:len(x)], out=total[1:])
        np.cumsum(total[1:], out=total[1:])
        part = (total[ends] - total[starts]) * down[starts]
        # mixed before they are added: equal sums need both hashes to agree
        part ^= part >> np.uint64(29)
        code = code * np.uint64(0xBF58476D1CE4E5B9) + part
    _, first, number = np.unique(code, return_index=True, return_inverse=True)
    return [buffer[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist())], number, starts


class Known(dict):
    """Values that ``make`` gives for short keys, up to ``size`` of them; those
    met later are held in ``late``, which starts anew when it is full."""

    LATE = 20_000

    def __init__(self, make, size: int):
        super().__init__()
        self.make, self.size, self.late, self.missed = make, size, {}, 0

    def __missing__(self, key: str) -> bytes:
        value = self.late.get(key)
        if value is None:
            value = self.make(key)
            self.missed += 1
            if len(key) <= _LONG:
                if len(self) < self.size:
                    self[key] = value
                else:
                    if len(self.late) >= self.LATE:
                        self.late.clear()
                    self.late[key] = value
        return value


class ChunkTokenizer:
    """Ids as little-endian uint32 bytes.  Ids always come from the
    ``tokenizers`` library; short chunks met before come from caches of at
    most ``cache`` entries.  A full cache keeps what it has, since frequent
    chunks are met early, and starts anew when the text has drifted so far
    that over DRIFT of the chunks miss it.  Special-token strings in a text
    are ordinary text.

    Plain texts are split at their blanks and line ends, any other text by a
    pattern of the white space runs and words.  Of a part of a plain text that
    was not met before, the library's model takes the word as it is."""

    DRIFT, WATCH = 0.3, 2_000_000

    def __init__(self, path: str, cache: int = 500_000):
        from tokenizers import Tokenizer
        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True
        vocab = self.model.get_vocab()
        self.width = np.zeros(max(vocab.values()) + 1, dtype=np.int64)  # bytes per id: one character each in the vocabulary
        self.width[list(vocab.values())] = [len(t) for t in vocab]
        # whether a word is one match, and its bytes what the model takes
        self.words = (self.model.normalizer is None and all(t.special for t in self.model.get_added_tokens_decoder().values())
                      and self.model.pre_tokenizer is not None
                      and [t for t, _ in self.model.pre_tokenizer.pre_tokenize_str(f"Ab cÀÿ\nd{_SIGNS} é'")] == ["Ab", "ĠcÃĢÃ¿", "Ċ", "d", _SIGNS, "ĠÃ©", "'"])
        self.word = self.model.model.tokenize
        self.size = cache
        self.parts = Known(self._new_part, cache)  # of plain texts
        self.chunks: dict[str, bytes] = {}         # of others
        self.signs: dict[str, bytes] = {}
        self.met = self.missed = 0

    def _slices(self, text: str):
        at = 0
        while len(text) - at > _SLICE:
            m = _CUT.search(text, at + _SLICE)
            end = m.start() if m else len(text)
            yield text[at:end]
            at = end
        yield text[at:] if at else text

    def _encode_new(self, new: list[str]) -> dict[str, bytes]:
        """Ids of chunks not met before.  Chunks that start with white space
        and end without go through the library joined, since no match of its
        own crosses such a seam, and are told apart by bytes per id."""
        joined = [c for c in new if c and c[0] in _WS and c[-1] not in _WS]
        fresh = {}
        if joined:
            ids = np.asarray(self.model.encode_batch_fast(["".join(joined)], add_special_tokens=False)[0].ids, dtype="<u4")
            data, done = ids.tobytes(), np.cumsum(self.width[ids])
            ends = np.cumsum([len(c.encode("utf-8", "surrogatepass")) for c in joined])
            at = 0
            for c, end in zip(joined, (4 * np.searchsorted(done, ends) + 4).tolist()):
                fresh[c] = data[at:end]
                at = end
        for c in new:
            if c not in fresh:
                fresh[c] = np.asarray(self.model.encode(c, add_special_tokens=False).ids, dtype="<u4").tobytes()
        return fresh

    def _new_part(self, part: str) -> bytes:
        """No match holds a letter and a sign after it: the word before closing
        signs is looked up alone."""
        if self.words and part.isascii():  # most parts: no pattern is needed
            if part.isalpha():
                return self._of_word(f"Ġ{part}")
            word = part.rstrip(_SIGNS)
            if word.isalpha():
                return self.parts[word] + self._of_sign(part[len(word):])
        m = _WORD.fullmatch(part) if self.words else None
        if m is None:
            return self._ids(part[1:] if part[:1] == "\r" else part if part[:1] == "\n" else f" {part}")
        head, word, sign = m.groups()
        if sign:
            return self.parts[head + word] + self._of_sign(sign)
        text = word if word.isascii() else word.encode().decode("latin-1").translate(_SHOWN)
        ids = self._of_word(text if head else f"Ġ{text}")
        return self._of_sign("\n") + ids if head == "\n" else ids

    def _of_word(self, shown: str) -> bytes:
        found = [t.id for t in self.word(shown)]
        return struct.pack(f"<{len(found)}I", *found)

    def _of_sign(self, sign: str) -> bytes:
        if sign not in self.signs:
            if len(self.signs) > 10_000:
                self.signs.clear()
            self.signs[sign] = self._ids(sign)
        return self.signs[sign]

    def _ids(self, text: str) -> bytes:
        return np.asarray(self.model.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _plain(self, text: str) -> bytes:
        """Ids of a plain text: parts start at each blank, which is left out, and
        at each line end; the first starts with a carriage return."""
        parts = f"\r{text}".replace("\n", " \n").split(" ")
        ids = b"".join(map(self.parts.__getitem__, parts))
        self.met += len(parts)
        if self.met > self.WATCH:
            self.missed += self.parts.missed
            if len(self.parts) >= self.size and self.missed > self.DRIFT * self.met:
                self.parts.clear()
            self.met = self.missed = self.parts.missed = 0
        return ids

    def _other(self, text: str) -> bytes:
        chunks = _CHUNK.findall(text)
        ids = {c: self.chunks.get(c) for c in set(chunks)}
        new = [c for c, v in ids.items() if v is None]
        if new:
            fresh = self._encode_new(new)
            ids.update(fresh)
            if len(self.chunks) < self.size:
                self.chunks.update((c, v) for c, v in fresh.items() if len(c) <= _LONG)
        self.met += len(chunks)
        self.missed += len(new)
        if self.met > self.WATCH:
            if len(self.chunks) >= self.size and self.missed > self.DRIFT * self.met:
                self.chunks.clear()
            self.met = self.missed = self.parts.missed = 0
        return b"".join(map(ids.__getitem__, chunks))

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """Ids of each text."""
        return list(map(self.encode, texts))

    def encode(self, text: str) -> bytes:
        if len(text) <= _SLICE:
            return self._plain(text) if is_plain(text) else self._other(text)
        return b"".join(self._plain(piece) if is_plain(piece) else self._other(piece) for piece in self._slices(text))


def chunk_tokenizer(path: str, cache: int = 500_000) -> ChunkTokenizer:
    """One tokenizer per Python worker and file, whose caches take the most
    entries (about 140 bytes each) that any of its users gave as ``cache``."""
    if path not in _LOADED:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _LOADED[path] = ChunkTokenizer(path, cache)
    tok = _LOADED[path]
    tok.size = tok.parts.size = max(tok.size, cache)
    return tok
