"""Token ids of whole texts by a public tokenizer file, with a cache of the words that a Python worker has met.

A text is cut where white space follows other characters. Neither kind of tokenizer used here makes a token across such a
place, so the ids of the parts, one after another, are the ids of the text; tests compare with the library's own `encode`.
"""

from __future__ import annotations

import re
import sys
from array import array
from collections.abc import Callable
from types import ModuleType

#: A cache that reaches this many words (some 250 MB) starts anew.
CACHED = 1_500_000


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encoder(path: str) -> Callable[[str], bytes]:
    """A function from a text to its ids as little-endian unsigned 16-bit numbers (32-bit for a larger vocabulary).

    A worker that runs several tasks keeps it, and the words it knows, from one to the next.
    """
    kept = sys.modules.setdefault("_gridweave_encoders", ModuleType("_gridweave_encoders")).__dict__
    if path not in kept:
        kept[path] = _encoder(path)
    return kept[path]


def _encoder(path: str) -> Callable[[str], bytes]:
    import tokenizers

    whole = tokenizers.Tokenizer.from_file(path)
    model, normal, split = whole.model, whole.normalizer, whole.pre_tokenizer
    code = "H" if whole.get_vocab_size() <= 1 << 16 else "I"
    marks = tuple(t.content for t in whole.get_added_tokens_decoder().values())
    drops_blanks = normal is not None and whole.encode(" ", add_special_tokens=False).ids == []

    def pieces(part: str) -> list[str]:
        return [piece for piece, _ in split.pre_tokenize_str(normal.normalize_str(part) if normal is not None else part)]

    # A word of A-Z and a-z, with a blank before and a mark after it or not, is cut alike whatever its letters are.
    plain = re.compile(r"( ?)([A-Za-z]+)([.,;:!?]?)").fullmatch
    fold = str.lower if pieces("Ab") == ["ab"] else str
    before = {"": "", " ": pieces(" a")[0][:-1]}
    simple = all(pieces(f"{blank}Ab{mark}") == [before[blank] + fold("Ab"), *mark] for blank in before for mark in ("", *".,;:!?"))

    def ids(part: str) -> list[int]:
        if any(m in part for m in marks):
            return whole.encode(part, add_special_tokens=False).ids
        return [t.id for piece in pieces(part) for t in tokenize(piece)]

    tokenize, head = model.tokenize, before[" "]

    class Known(dict):
        def __missing__(self, part: str | bytes) -> bytes:
            if len(self) >= CACHED:
                self.clear()
            text = part if isinstance(part, str) else part.decode()
            if simple and (found := plain(text)):
                blank, letters, mark = found.groups()
                out = array(code, [t.id for t in tokenize(head + fold(letters) if blank else fold(letters))]).tobytes()
                if mark:
                    out += self[mark if isinstance(part, str) else mark.encode()]
            else:
                out = array(code, ids(text)).tobytes()
            self[part] = out
            return out

    known = Known()
    if drops_blanks:  # bytes.split knows the six ASCII blanks only; others stay inside a part for the library to see
        return lambda text: b"".join(map(known.__getitem__, text.encode().split()))
    parts = re.compile(r"\s*\S+|\s+").findall
    return lambda text: b"".join(map(known.__getitem__, parts(text)))


def id_bytes(path: str) -> int:
    """Bytes of an id in what `encoder` returns."""
    import tokenizers

    return 2 if tokenizers.Tokenizer.from_file(path).get_vocab_size() <= 1 << 16 else 4
