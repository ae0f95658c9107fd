"""Exact byte-level BPE ids at word-cache speed, from public vocabulary files."""

from __future__ import annotations

import base64
import threading
from array import array

_STATE = threading.local()
_CACHE_WORDS = 300_000


class _Words(dict):
    """Ids of ' ' + word as little-endian bytes; computed once for each word while the cache lasts."""

    def __init__(self, encode, code):
        super().__init__()
        self.encode, self.code = encode, code

    def __missing__(self, word: str) -> bytes:
        if len(self) >= _CACHE_WORDS:
            self.clear()
        self[word] = ids = array(self.code, self.encode(" " + word)).tobytes()
        return ids


class Encoder:
    """encode(text) -> little-endian ids, equal to those of the tokenizers library with
    add_special_tokens=False.

    The vocabulary splits text into pieces before merging, and a piece boundary always stands before a
    space that follows a non-space and precedes one. So a text without doubled spaces is the
    concatenation of its space-led words, each of which is encoded alone and cached. Texts for which that
    does not hold, and texts with the marker of a special token, take the library's own way.
    """

    def __init__(self, json_path: str, ranks_path: str | None):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(json_path)
        self.wide = self.whole.get_vocab_size() > 65536
        self.code = "I" if self.wide else "H"
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.fast = None
        if ranks_path:
            import public_tokenizers
            import tiktoken

            with open(ranks_path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
            self.words = _Words(self.fast, self.code)

    def encode(self, text: str) -> bytes:
        if self.fast is None or any(s in text for s in self.special):
            return array(self.code, self.whole.encode(text, add_special_tokens=False).ids).tobytes()
        if "  " in text or text.endswith(" "):
            return array(self.code, self.fast(text)).tobytes()
        head, *rest = text.split(" ")
        return array(self.code, self.fast(head)).tobytes() + b"".join(map(self.words.__getitem__, rest))


def encoder(json_path: str, ranks_path: str | None) -> Encoder:
    """One encoder for each Python worker."""
    key = (json_path, ranks_path)
    if getattr(_STATE, "key", None) != key:
        _STATE.key, _STATE.encoder = key, Encoder(json_path, ranks_path)
    return _STATE.encoder


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
