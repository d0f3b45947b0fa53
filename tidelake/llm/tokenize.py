"""Whole-text encoding with a public vocabulary through the ``tokenizers`` library.

Both vocabularies cut a text before the merges at white space and where letters meet punctuation, so a
text's ids are the ids of its units in a row. A unit is a word with the white space before it. Distinct
units are encoded by the library once per worker process and kept, in two generations of bounded size;
all other work is a dictionary lookup. Texts with white space outside ASCII, where engines differ on what a
space is, go through the library whole.
"""

from __future__ import annotations

import re
import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: UTF-8 forms of characters that some engine counts as white space, ASCII space aside; and byte 1, a mark of ours.
_ODD = re.compile(
    rb"[\x01\x1c-\x1f]|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe1\xa0\x8e|\xe2\x80[\x80-\x8f\xa8-\xaf]|\xe2\x81[\x9f-\xaf]|\xe3\x80\x80|\xef\xbb\xbf"
)
#: A run of Latin letters, ASCII punctuation without the apostrophe (which may open a contraction), white space.
_L = rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+"
_P = rb"[!-&(-/:-@\[-`{-~]"
_W = rb"[ \t-\r]"
#: Pre-tokens end where letters meet such punctuation; else a unit runs to the next white space.
_PARTS = re.compile(b"%b*%b(?=%b|%b|\\Z)|%b*%b+(?=%b|%b|\\Z)|%b*[^ \\t-\\r]+|%b+" % (_W, _L, _P, _W, _W, _P, _L, _W, _W, _W))
#: A Latin word, perhaps after a line feed, perhaps with marks after it.
_DRESSED = re.compile(b"(\n?)(%b)(%b*)" % (_L, _P))
#: White space that is not one space or one line feed between words.
_LOOSE = (b"  ", b" \n", b"\n ", b"\n\n", b"\t", b"\r", b"\x0b", b"\x0c")
#: A comma or full stop at a word's end after something that is no Latin letter or digit: both may be one pre-token.
_GLUED = re.compile(rb"[,.][ \n](?<=[^A-Za-z0-9][,.][ \n])(?<!\xc3[\x80-\x96\x98-\xb6\xb8-\xbf][,.][ \n])")
#: Bytes without which a text has nothing odd.
_LEADS = (b"\x01", b"\x1c", b"\x1d", b"\x1e", b"\x1f", b"\xc2", b"\xe1", b"\xe2", b"\xe3", b"\xef")


def _plain_ends(text: bytes) -> bool:
    """Whether every comma and full stop before a space or line feed follows a Latin letter or digit."""
    return text[:1] not in (b",", b".") and _GLUED.search(text) is None


def _odd(text: bytes) -> bool:
    leads = _LEADS[:5] if text.isascii() else _LEADS
    return any(x in text for x in leads) and _ODD.search(text) is not None


def whole(tokenizer, text: bytes) -> bytes:
    ids = tokenizer.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids
    return struct.pack(f"<{len(ids)}I", *ids)


#: struct.pack for few ids, by their number.
_PACK = [struct.Struct(f"<{n}I").pack for n in range(12)]
#: Bytes of the longest unit that is kept.
_LONGEST = 64


class _Units(dict):
    """Units that have been encoded, in two generations of at most `keep` units of at most `_LONGEST` bytes.

    `lead` is put before each but those that bring their own line feed, or byte 1 for none at all.
    """

    def __init__(self, tokenizer, lead: bytes, keep: int, spaces: bool, lowers: bool):
        from tokenizers.pre_tokenizers import ByteLevel

        super().__init__()
        self.tokenizer, self.lead, self.keep, self.old, self.lowers = tokenizer, lead, keep, {}, lowers
        self.tokenize = tokenizer.model.tokenize
        show = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.space = show(" ")[0][0] if spaces else ""
        # how the vocabulary writes the bytes of Latin words
        self.written = {c: show(chr(c))[0][0] for c in range(33, 127)}
        for c in range(0x80, 0xC0):
            self.written[0xC3], self.written[c] = show(bytes([0xC3, c]).decode())[0][0]

    def __missing__(self, unit: bytes) -> bytes:
        ids = self.old.get(unit)
        if ids is None:
            ids = self.fresh(unit)
        if len(unit) <= _LONGEST:
            if len(self) >= self.keep:
                self.old = dict(self)
                self.clear()
            self[unit] = ids
        return ids

    def word(self, word: bytes, space: str) -> bytes:
        """The ids of a Latin word: one pre-token, which the library's model takes as it is."""
        if word.isalpha():
            shown = word.decode().lower() if self.lowers else word.decode()
        else:
            shown = (word.decode().lower().encode() if self.lowers else word).decode("latin-1").translate(self.written)
        ids = [x.id for x in self.tokenize(space + shown)]
        return _PACK[len(ids)](*ids) if len(ids) < len(_PACK) else struct.pack(f"<{len(ids)}I", *ids)

    def fresh(self, unit: bytes) -> bytes:
        """The ids of a unit that is not held; one that begins with byte 1 has no white space before it."""
        if not self.lead:
            return whole(self.tokenizer, unit[1:] if unit[:1] == b"\x01" else unit)
        if unit.isalpha():
            return self.word(unit, self.space)
        bare = unit[:1] == b"\x01"
        found = _DRESSED.fullmatch(unit, 1 if bare else 0)
        if found is None or (bare and found[1]):
            return whole(self.tokenizer, unit[1:] if bare else unit if unit[:1] == b"\n" else self.lead + unit)
        line, word, marks = found.groups()
        if marks or line:  # three pre-tokens, the word's ids and the marks' most likely known
            head = self[b"\x01\n"] if line and self.space else b""
            return head + self[b"\x01" + word if line or bare else word] + (self[b"\x01" + marks] if marks else b"")
        return self.word(word, "" if bare else self.space)

    def encode(self, units: list[bytes]) -> bytes:
        return b"".join(map(self.__getitem__, units))


class Encoder:
    """bytes of a text -> its ids as little-endian unsigned 32-bit integers.

    `spaces`: True where white space belongs to the unit after it (byte-level vocabularies), False
    where it is dropped. `keep` bounds the units kept in a generation.
    """

    def __init__(self, path: str, spaces: bool, keep: int = 500_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.spaces = spaces
        normalizer = self.tokenizer.normalizer
        self.lowers = normalizer is not None and normalizer.normalize_str("ABYZ") == "abyz"
        self.spaced = _Units(self.tokenizer, b" ", keep, spaces, self.lowers)
        self.exact = _Units(self.tokenizer, b"", keep // 8, spaces, self.lowers)

    def whole(self, text: bytes) -> bytes:
        return whole(self.tokenizer, text)

    def encode(self, text: bytes) -> bytes:
        if _odd(text):
            return self.whole(text)
        if not self.spaces:
            # such a vocabulary is one of lower case: the library would lower the letters in any case
            text = text.lower() if self.lowers else text
            if _plain_ends(text):
                text = text.replace(b", ", b" \x01, ").replace(b". ", b" \x01. ").replace(b".\n", b" \x01.\n")
            return self.spaced.encode(text.split())
        if text[:1].isspace() or text[-1:].isspace() or any(x in text for x in _LOOSE):
            return self.exact.encode(_PARTS.findall(text))
        return self._encode_even([text])[0] if text else b""

    def encode_all(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text; texts without loose white space go through Arrow together."""
        out, even = [b""] * len(texts), []
        for i, text in enumerate(texts):
            if not self.spaces or not text or _odd(text) or text[:1].isspace() or text[-1:].isspace() or any(x in text for x in _LOOSE):
                out[i] = self.encode(text)
            else:
                even.append(i)
        for i, ids in zip(even, self._encode_even([texts[i] for i in even])):
            out[i] = ids
        return out

    def _encode_even(self, texts: list[bytes]) -> list[bytes]:
        """Texts whose units one space or line feed parts: a unit that occurs often is looked up once."""
        if not texts:
            return []
        shown = []
        for text in texts:
            if _plain_ends(text):
                text = text.replace(b", ", b" \x01, ").replace(b". ", b" \x01. ").replace(b".\n", b" \x01.\n")
            shown.append(b"\x01" + text.replace(b"\n", b" \n"))
        units = pc.split_pattern(pa.array([b" ".join(shown)], pa.large_binary()), b" ").flatten().dictionary_encode()
        ids = [self.spaced[x] for x in units.dictionary.to_numpy(zero_copy_only=False)]
        lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        of = units.indices.to_numpy()
        n = lengths[of]
        ends = np.cumsum(n)
        places = np.arange(ends[-1]) + np.repeat((np.cumsum(lengths) - lengths)[of] - ends + n, n)
        flat = memoryview(np.frombuffer(b"".join(ids), "<u4")[places].tobytes())
        cuts = [0, *(4 * ends[np.cumsum([x.count(b" ") + 1 for x in shown]) - 1]).tolist()]
        return [bytes(flat[a:b]) for a, b in zip(cuts, cuts[1:])]


_KEPT: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, spaces: bool, keep: int = 500_000) -> Encoder:
    """This worker process's encoder; what it has kept serves later tasks too."""
    if (path, spaces) not in _KEPT:
        _KEPT.clear()
        _KEPT[path, spaces] = Encoder(path, spaces, keep)
    return _KEPT[path, spaces]
