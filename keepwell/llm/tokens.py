"""Tokenizers in tasks, one per worker process. Vocabulary files are named by path and
must lie at that path on every executor; none is given: the installed public files."""

from __future__ import annotations

import functools
import json
from itertools import pairwise

import numpy as np
import regex

#: Characters of the words whose ids a worker keeps: some 500,000 words, 100 MB.
KEPT_CHARS = 1 << 22

#: What the word vocabulary's tokenizer does before merging.
WORD_PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: Characters up to U+024F without C0 separators: composed, and split as white space alike
#: by Python and by the tokenizer. Other texts take the reference route.
_PLAIN = regex.compile("[\x00-\x1b\x20-ɏ]*")


def public(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_of() -> dict[str, int]:
    """The usual byte-level alphabet: printable Latin-1 stands for itself, the other
    bytes, in order, for the characters from U+0100."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class WordBpe:
    """Ids of a lower-case BPE vocabulary with word ends, as the ``tokenizers`` library
    gives them for ``encode(text, add_special_tokens=False)``.

    The library merges about 1 MB a second here. The same merges run ten times as fast
    as byte-pair ranks: a word end is written as a blank after each word, so a final
    byte with its blank (ids 256-511) merges before all else, and id order is merge
    order. A word's ids do not depend on its neighbours, so those of words met before are
    kept, up to ``KEPT_CHARS`` and one text's words; the others of a text are merged in one
    call. Texts with other than plain Latin characters, or with the name of a special
    token, go through the library itself; tests hold both against each other.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        special = {t["id"]: t["content"] for t in data["added_tokens"]}
        byte_of = _byte_of()

        def raw(token: str) -> bytes:
            ends = token.endswith("</w>") and len(token) > 4
            return bytes(byte_of[c] for c in (token[:-4] if ends else token)) + b" " * ends

        plain = {t: i for t, i in data["model"]["vocab"].items() if i not in special}
        ranks = {raw(t): i for t, i in plain.items()}
        if len(ranks) != len(plain):
            raise ValueError(f"{path}: two tokens have the same bytes")
        self._special = tuple(special.values())
        self._fast = tiktoken.Encoding("words", pat_str="[^ ]+ ", mergeable_ranks=ranks, special_tokens={})
        self._slow = Tokenizer.from_file(path)
        self._ends = np.zeros(max(ranks.values()) + 1, bool)  # ids that end a piece
        self._ends[[i for token, i in ranks.items() if token.endswith(b" ")]] = True
        self._kept, self._chars = {}, 0

    def _merge(self, words: list[str]) -> list[bytes]:
        """The ids of each word."""
        split = WORD_PIECES.findall
        pieces = [w if w.isalpha() else " ".join(split(w)) for w in words]
        ids = self._fast.encode_to_numpy(" ".join(pieces) + " ").astype("<u4", copy=False)
        ends = np.flatnonzero(self._ends[ids]) + 1
        stops = 4 * ends[np.cumsum([p.count(" ") + 1 for p in pieces]) - 1]
        data = ids.tobytes()
        return [data[a:b] for a, b in pairwise([0, *stops.tolist()])]

    def encode(self, text: str) -> np.ndarray:
        if _PLAIN.fullmatch(text) and not any(s in text for s in self._special):
            words = text.lower().split()
            if new := list(set(words).difference(self._kept)):
                self._kept.update(zip(new, self._merge(new), strict=True))
                self._chars += sum(map(len, new))
            ids = np.frombuffer(b"".join(map(self._kept.__getitem__, words)), "<u4")
            if self._chars > KEPT_CHARS:
                self._kept, self._chars = {}, 0
            return ids
        return np.array(self._slow.encode(text, add_special_tokens=False).ids, dtype="<u4")


@functools.lru_cache(maxsize=4)
def word_bpe(path: str | None = None) -> WordBpe:
    return WordBpe(path or public("word_bpe_49k.json"))
