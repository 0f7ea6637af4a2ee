"""Encoding of single words with a tokenizer file, exact and cached.

A text's ids are the concatenation of the ids of its words (runs without ASCII
white space): the tokenizer's rules never look across white space.  Words over
a small alphabet (printable ASCII and Latin-1 letters, which normalisation
leaves alone) are cut into the pieces that the tokenizer's own pattern would
make, and each distinct piece goes to the tokenizer's model once; every other
word goes through the whole tokenizer.
"""

from __future__ import annotations

import os
import re
from array import array
from functools import lru_cache
from itertools import islice

import numpy as np

#: Words that need no Unicode normalisation; the character class of the pattern below.
_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+\Z")
_PIECE = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^0-9a-zß-öø-ÿ]+")
#: Settings under which the pieces above are those of the tokenizer.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _byte_letters() -> dict[int, str]:
    """Byte-level alphabet: printable bytes stand for themselves, the others
    for letters from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in plain}
    for n, b in enumerate(b for b in range(256) if b not in letters):
        letters[b] = chr(256 + n)
    return letters


class WordEncoder:
    """Ids of words as bytes of little-endian unsigned 32-bit numbers.  About
    ``limit`` words and as many pieces are remembered between calls; beyond it
    the memory starts anew."""

    def __init__(self, path: str, limit: int = 500_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import json

        from tokenizers import Tokenizer, pre_tokenizers

        self.full = Tokenizer.from_file(path)
        self.full.no_truncation()
        self.full.no_padding()
        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        steps = (made.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        self.simple = steps[0].get("pattern") == {"Regex": _SPLIT} and (made.get("normalizer") or {}).get("type") == "Sequence"
        self.model = Tokenizer(self.full.model)
        self.model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        letters = _byte_letters()
        self.letters = {c: "".join(letters[b] for b in chr(c).encode()) for c in range(0xC0, 0x100)}
        self.limit, self.known, self.words = limit, {}, {}
        self.added = tuple(t.content for t in self.full.get_added_tokens_decoder().values())
        signs = {a[0] for a in self.added}
        self.sign = signs.pop() if len(signs) == 1 else ""      # what every added token starts with

    def pieces(self) -> list[bytes]:
        """Piece by id."""
        vocab = self.full.get_vocab(with_added_tokens=True)
        out = [b""] * (max(vocab.values()) + 1)
        for piece, i in vocab.items():
            out[i] = piece.encode()
        return out

    def table(self, words: set[bytes]) -> dict[bytes, bytes]:
        """A table that holds the ids of all ``words``, remembered between calls."""
        if len(self.words) > self.limit:
            self.words = {}
        new = list(words.difference(self.words))
        self.words.update(zip(new, self.encode(new), strict=True))
        return self.words

    def forget(self) -> None:
        """Give the remembered words and pieces back."""
        self.words, self.known = {}, {}

    def encode(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word.  Words hold no ASCII white space."""
        if len(self.known) > self.limit:
            self.known = {}
        if not words:
            return []
        known, flat, counts, other = self.known, [], [], []         # of each word its pieces, in one list
        plain, pieces, sign = _PLAIN.match, _PIECE.findall, self.sign
        joined = b" ".join(words).decode("utf-8", "replace")
        for n, (text, low) in enumerate(zip(joined.split(" "), joined.lower().split(" "), strict=True)):
            if self.simple and (text.isascii() and text.isprintable() or plain(text)) and not (sign in text and any(a in text for a in self.added)):
                before = len(flat)
                if low.isalpha():
                    flat.append(low)
                else:
                    flat.extend(pieces(low))
                counts.append(len(flat) - before)
            else:
                counts.append(0)
                other.append((n, text))
        self._learn([p for p in dict.fromkeys(flat) if p not in known])
        ids = map(known.__getitem__, flat)
        out = [next(ids) if n == 1 else b"".join(islice(ids, n)) for n in counts]
        for at in range(0, len(other), 1000):
            some = other[at: at + 1000]
            for (n, _), e in zip(some, self.full.encode_batch([t for _, t in some], add_special_tokens=False), strict=True):
                out[n] = array("I", e.ids).tobytes()
        return out

    def _learn(self, fresh: list[str]) -> None:
        for at in range(0, len(fresh), 5000):
            some = fresh[at: at + 5000]
            text = " ".join([p if p.isascii() else p.translate(self.letters) for p in some])
            e = self.model.encode(text, add_special_tokens=False)
            ids, ends = array("I", e.ids).tobytes(), (4 * np.cumsum(np.bincount(e.word_ids, minlength=len(some)))).tolist()
            self.known.update(zip(some, [ids[a:b] for a, b in zip([0, *ends], ends)], strict=True))


@lru_cache(maxsize=2)
def encoder(path: str | None = None) -> WordEncoder:
    """One encoder for each Python worker, reused by its tasks."""
    return WordEncoder(path or default_path())
