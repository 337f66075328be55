"""Token ids of whole texts by a public byte-level BPE file and the tokenizers library.

The vocabulary's pre-tokeniser never joins a character to a white-space run before it, but for one space that leads
a word. A text therefore falls apart into units (a run of other characters with one leading space, or white space)
whose ids do not depend on their neighbours; a run of letters is also cut off from the ASCII mark after it. Each distinct unit is encoded once and kept in a bounded cache.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Fixed value: the characters of Unicode's White_Space property, which end a unit.
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Characters that are letters for certain, and ASCII characters that are none: a run of the former ends at the latter.
LETTER = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u02af"
OTHER = "!-@\\[-`{-~"
UNIT = re.compile(f" ?[{LETTER}]+(?![^{WHITE}{OTHER}])| ?[^{WHITE}]+|[{WHITE}]+(?=[{WHITE}][^{WHITE}])|[{WHITE}]+")
#: A word that is letters for certain, and one mark behind them at most: its units are the letters, with the space before them, and the mark.
PLAIN = re.compile(f"([{LETTER}]+)([{OTHER}]?)")
#: White space that is neither a space nor a line feed, and white space next to a space: such texts go unit by unit.
ODD = re.compile(f"[\t\x0b-\r\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
#: Bounds of the caches: words between spaces, and units. Each holds two generations of so many entries and what one call adds; an
#: entry of either takes about 200 bytes.
CACHE_WORDS, CACHE_UNITS = 600_000, 300_000


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_chars() -> dict[int, str]:
    """The vocabulary's printable stand-in for each byte: itself, or the next code point from 256 on."""
    keep = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(256, 512))
    return {b: chr(b) if b in keep else chr(next(rest)) for b in range(256)}


class Cache(dict):
    """Makes what is missing, in two generations: what is met again moves to the young one."""

    def __init__(self, make: Callable[[str], bytes], most: int) -> None:
        super().__init__()
        self.make, self.most, self.old = make, most, {}

    def __missing__(self, key: str) -> bytes:
        value = self.old.get(key)
        self[key] = value = self.make(key) if value is None else value
        return value

    def turn(self) -> None:
        if len(self) > self.most:
            self.old = dict(self)
            self.clear()


class Encoder:
    """Encodes texts to little-endian unsigned 32-bit ids, without special tokens."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model, self.chars = self.tokenizer.model, _byte_chars()
        self.space = self.chars[0x20]
        self.words = Cache(self._word, CACHE_WORDS)
        self.units = Cache(self._unit, CACHE_UNITS)

    def _unit(self, unit: str) -> bytes:
        """A run of letters is one piece for the pattern, so that the file's BPE model takes it as it is."""
        if unit.lstrip(" ").isalpha():
            shown = unit.replace(" ", self.space) if unit.isascii() else unit.encode().decode("latin-1").translate(self.chars)
            return array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()
        return array("I", self.tokenizer.encode(unit, add_special_tokens=False).ids).tobytes()

    def _word(self, word: str) -> bytes:
        """Ids of a word with the space before it. Most are letters with one mark at most, which needs no search for units."""
        plain = PLAIN.fullmatch(word)
        if plain is None:
            return self.by_unit(" " + word)
        letters, mark = plain.groups()
        ids = self.units[" " + letters]
        return ids + self.units[mark] if mark else ids

    def by_unit(self, text: str) -> bytes:
        return b"".join(map(self.units.__getitem__, UNIT.findall(text)))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text. Plain ones are split at their spaces all at once; only distinct words are looked up, one not met yet goes unit by unit."""
        self.words.turn()
        self.units.turn()
        out, plain = [b""] * len(texts), []
        for i, t in enumerate(texts):
            if "  " in t or "\n " in t or " \n" in t or t[:1] == " " or t[-1:] == " " or ODD.search(t):
                out[i] = self.by_unit(t)
            else:
                plain.append(i)
        if plain:
            for i, ids in zip(plain, self._plain([texts[i] for i in plain]), strict=True):
                out[i] = ids
        return out

    def _plain(self, texts: list[str]) -> list[bytes]:
        split = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        first = split.offsets.to_numpy()
        coded = split.values.dictionary_encode()
        words, which = coded.dictionary.to_numpy(zero_copy_only=False), coded.indices.to_numpy().astype(np.int64)
        which[first[:-1]] = len(words) + np.arange(len(texts))  # a text's first word has no space before it
        heads = split.values.take(pa.array(first[:-1])).to_pylist()
        pieces = [*map(self.words.__getitem__, words), *map(self.by_unit, heads)]
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces)) // 4
        begins, ids = np.cumsum(sizes) - sizes, np.frombuffer(b"".join(pieces), "<u4")
        counts = sizes[which]
        ends = np.cumsum(counts)
        flat = ids[np.arange(ends[-1]) + np.repeat(begins[which] - ends + counts, counts)]
        bounds = np.concatenate([[0], ends])[first].tolist()
        return [flat[a:b].tobytes() for a, b in zip(bounds, bounds[1:], strict=False)]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One per worker process and file: the caches outlive a task."""
    return Encoder(path)
