"""Byte-pair encoding with word ends: vocabulary, pre-tokenisation, merging.

Reads a ``tokenizers`` JSON file (path is a parameter). The file's own
normaliser and pre-tokeniser rules are followed exactly: plain words go
through Python string methods, every other word through the library's
normaliser and pre-tokeniser. Merging is done here (``merge``), so the
operators can use vocabulary facts that the library keeps to itself.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from functools import lru_cache

#: Symbols from which merging uses a heap.
LONG = 200


#: What the file's split pattern comes to on lower-case printable ASCII.
ASCII_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+"


def byte_alphabet() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies:
    printable Latin-1 stands for itself, the rest follows from U+0100 on."""
    printable = [b for b in range(256)
                 if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    spare = iter(range(256, 512))
    return [chr(b) if b in set(printable) else chr(next(spare)) for b in range(256)]


class Vocabulary:
    """Vocabulary, merge ranks and word rules of one tokeniser file.

    Null text counts as empty. Special strings inside a text become their own
    id, as the library does by default.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or model["end_of_word_suffix"] is None:
            raise ValueError("a BPE vocabulary with word ends is needed")
        self.end = model["end_of_word_suffix"]
        self.ids: dict[str, int] = model["vocab"]
        self.ranks = {tuple(m.split(" ") if isinstance(m, str) else m): r
                      for r, m in enumerate(model["merges"])}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: t for t, i in self.ids.items()} | {i: t for t, i in self.special.items()}
        self._split_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") \
            if self.special else None
        lib = Tokenizer.from_file(path)
        self.normalize = lib.normalizer.normalize_str
        self.pre_tokenize = lib.pre_tokenizer.pre_tokenize_str
        alphabet = byte_alphabet()
        self.byte_char = alphabet
        self._spelling = dict(enumerate(alphabet))
        self._letters: set[str] = set()
        # The file's own split pattern, for lower-case printable ASCII only.
        self._ascii = re.compile(ASCII_SPLIT).findall

    # -- words ---------------------------------------------------------------

    def char_class(self, c: str) -> str:
        """'s' white space, 'l' letter, 'n' number, 'o' other, as the file's
        own pre-tokeniser takes the (normalised) character."""
        if len(self.pre_tokenize(f"a{c}a")) == 1:
            return "l"
        pieces = [p for p, _ in self.pre_tokenize(f"{c}{c}")]
        return "s" if not pieces else ("n" if len(pieces) == 2 else "o")

    def _plain_letter(self, c: str) -> bool:
        """A letter that lower-cases alone, the way Python does it."""
        low = c.lower()
        return (c != "Σ" and len(low) == 1 and self.normalize(c) == low
                and not unicodedata.combining(c) and self.char_class(low) == "l")

    def _plain(self, word: str) -> bool:
        """Whether a word is one run of plain letters."""
        if not word.isalpha():
            return False
        if word.isascii():
            return True
        if not self._letters.issuperset(word):
            self._letters.update(c for c in set(word) if self._plain_letter(c))
            if not self._letters.issuperset(word):
                return False
        return unicodedata.is_normalized("NFC", word)

    def spell(self, text: str) -> str:
        """UTF-8 bytes as vocabulary characters."""
        return text.encode("utf-8", "surrogatepass").decode("latin-1").translate(self._spelling)

    def pieces(self, word: str) -> list[str]:
        """Unsplittable pieces of a word without ASCII white space, spelled in
        vocabulary characters."""
        if word.isascii() and word.isprintable():
            low = word.lower()
            return [low] if low.isalpha() else self._ascii(low)
        if self._plain(word):
            return [self.spell(word.lower())]
        if word[-1:] in (".", ",", "!", "?", ";", ":") and self._plain(word[:-1]):
            return [self.spell(word[:-1].lower()), word[-1]]
        return [p for p, _ in self.pre_tokenize(self.normalize(word))]

    # -- merging -------------------------------------------------------------

    def symbols(self, piece: str, final: bool = True) -> list[str]:
        """First symbols of a piece; the last carries the word end if final."""
        if not final:
            return list(piece)
        return [*piece[:-1], piece[-1] + self.end]

    def merge(self, parts: list[str]) -> list[str]:
        """Merge by lowest rank, leftmost first, until nothing merges."""
        ranks = self.ranks
        none = len(ranks)
        if len(parts) > LONG:
            return self._merge_long(parts)
        parts = list(parts)
        near = [ranks.get(p, none) for p in zip(parts, parts[1:])]
        while near:
            best = min(near)
            if best == none:
                break
            i = near.index(best)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del near[i]
            if i < len(near):
                near[i] = ranks.get((parts[i], parts[i + 1]), none)
            if i:
                near[i - 1] = ranks.get((parts[i - 1], parts[i]), none)
        return parts


    def _merge_long(self, parts: list[str]) -> list[str]:
        """The same with a heap over linked parts: n log n for long lists."""
        ranks = self.ranks
        parts: list[str | None] = list(parts)
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1)
                if (r := ranks.get((parts[i], parts[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i] if parts[i] is not None else n
            if j >= n or parts[i] != a or parts[j] != b:
                continue                        # merged meanwhile
            parts[i], parts[j] = a + b, None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for left in (before[i], i):
                right = after[left] if left >= 0 else n
                if right < n and (r := ranks.get((parts[left], parts[right]))) is not None:
                    heapq.heappush(heap, (r, left, parts[left], parts[right]))
        return [p for p in parts if p is not None]


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    """One vocabulary per worker process and file."""
    return Vocabulary(path)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
