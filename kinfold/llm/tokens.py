"""Token ids of whole texts with a byte-level vocabulary file, cached by word."""

from __future__ import annotations

import json
import re
from functools import lru_cache

#: Words a worker remembers; beyond that it starts anew.
CACHE_WORDS = 300_000

# Fixed value: how the vocabulary's pre-tokenizer cuts a text.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _byte_of_letter() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the others as letters from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(hidden)}


@lru_cache(maxsize=2)
def _file(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


@lru_cache(maxsize=2)
def encoder(path: str):
    """The vocabulary of a tokenizers file as ranks: ids of text without added tokens are those of the file's own tokenizer."""
    import tiktoken

    model = _file(path)
    special = {t["content"] for t in model.get("added_tokens", []) if t.get("special")}
    letter = _byte_of_letter()
    ranks = {bytes(letter[c] for c in t): i for t, i in model["model"]["vocab"].items() if t not in special}
    return tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


class Ids(dict):
    """Bytes of the little-endian unsigned 32-bit ids of a word that follows a space."""

    def __init__(self, path: str):
        import numpy as np

        super().__init__()
        self.encode = encoder(path).encode_ordinary
        # A space beside another white character is not always the head of the next word.
        self.wide = re.compile(r" \s|\s ").search
        # Added tokens stand for themselves wherever their text occurs, and cut it; the longest one counts.
        added = _file(path).get("added_tokens", [])
        self.added = {t["content"]: np.array([t["id"]], "<u4").tobytes() for t in added}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if added else None
        self.library = None
        if any(t.get(k) for t in added for k in ("single_word", "lstrip", "rstrip", "normalized")):
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(path)

    def of(self, text: str) -> bytes:
        import numpy as np

        return np.array(self.encode(text), "<u4").tobytes()

    def __missing__(self, word: str) -> bytes:
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = ids = self.of(" " + word)
        return ids

    def whole(self, text: str) -> bytes:
        """Ids of a text, with the file's added tokens wherever they are written out."""
        if self.cut is None or not self.cut.search(text):
            return self.plain(text)
        if self.library is not None:
            import numpy as np

            return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        parts = self.cut.split(text)
        return b"".join(self.added[x] if i % 2 else self.plain(x) for i, x in enumerate(parts))

    def plain(self, text: str) -> bytes:
        """Ids of a text without added tokens: single spaces between words are cuts of the pre-tokenizer, so words can be taken one by one."""
        if self.wide(text) or text[-1:].isspace():
            return self.of(text)
        head, *words = text.split(" ")
        return self.of(head) + b"".join(map(self.__getitem__, words))


@lru_cache(maxsize=2)
def ids_for(path: str) -> Ids:
    return Ids(path)
