"""Public tokenizers inside Spark tasks.

The driver reads the vocabulary file once; tasks get its bytes by broadcast (a
few megabytes, fixed), so executors need no path of their own.

``Tokenizer`` gives ids exactly as the library of the file gives them. For a
byte-level BPE .json whose vocabulary is also at hand as ranks, texts that stay
inside ``PLAIN`` are encoded by tiktoken, which is five times as fast and
applies the same splitting pattern and merges; any other text (rare scripts,
where two libraries may hold different Unicode tables, or a special token's
string) goes to the tokenizers library itself.
"""

from __future__ import annotations

import base64
import hashlib
import re
from dataclasses import dataclass
from functools import lru_cache
from importlib import metadata

import numpy as np

# Characters whose class (letter, number, space) is the same in every Unicode
# version that the libraries may carry: Latin, Greek, Cyrillic, and the
# general punctuation, currency and letter-like blocks.
PLAIN = re.compile(r"[^\u0000-\u03FF\u0400-\u0481\u048A-\u0523\u1E00-\u1EFF\u2000-\u2027\u2030-\u205E\u20A0-\u20B5]")


@dataclass(frozen=True)
class Vocabulary:
    """What a task needs to encode: the file, its kind, and its version digest."""

    kind: str            # json (tokenizers) or model (sentencepiece)
    content: bytes
    ranks: bytes | None  # the same byte-level vocabulary as ranks
    pattern: str | None

    @property
    def version(self) -> str:
        library = {"json": "tokenizers", "model": "sentencepiece"}[self.kind]
        return hashlib.sha256(self.content + f"\0{library} {metadata.version(library)}".encode()).hexdigest()


def load(path: str, ranks_path: str | None = None, pattern: str | None = None) -> Vocabulary:
    """Read a vocabulary on the driver. ``ranks_path``: the same vocabulary's ranks, with their pattern."""
    kind = path.rsplit(".", 1)[-1]
    if kind not in ("json", "model"):
        raise ValueError(f"no library here for {path}")
    with open(path, "rb") as f:
        content = f.read()
    ranks = None
    if ranks_path:
        with open(ranks_path, "rb") as f:
            ranks = f.read()
    return Vocabulary(kind, content, ranks, pattern)


def public(name: str = "byte_bpe_50k.json") -> Vocabulary:
    """One of the installed public vocabularies by name."""
    import public_tokenizers as p

    if name == "byte_bpe_50k.json":
        return load(p.path(name), p.path("byte_bpe_50k.tiktoken"), p.PATTERN)
    return load(p.path(name))


class Tokenizer:
    def __init__(self, v: Vocabulary):
        self.v, self._library, self._fast, self.special = v, None, None, None
        if v.ranks is not None:
            import json

            import tiktoken

            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, v.ranks.splitlines())}
            self._fast = tiktoken.Encoding("ranks", pat_str=v.pattern, mergeable_ranks=ranks, special_tokens={})
            added = [t["content"] for t in json.loads(v.content).get("added_tokens", [])]
            self.special = re.compile("|".join(map(re.escape, added))) if added else None

    @property
    def library(self):
        """The library's own encoder, loaded when first asked for."""
        if self._library is None:
            if self.v.kind == "json":
                from tokenizers import Tokenizer as Library

                self._library = Library.from_str(self.v.content.decode())
                self._library.no_truncation()
                self._library.no_padding()
            else:
                from sentencepiece import SentencePieceProcessor

                self._library = SentencePieceProcessor(model_proto=self.v.content)
        return self._library

    def plain(self, text: str) -> bool:
        return self._fast is not None and not PLAIN.search(text) and not (self.special and self.special.search(text))

    def encode(self, text: str) -> np.ndarray:
        """Token ids, without begin, end or added special tokens."""
        if self.plain(text):
            return self._fast.encode_to_numpy(text, disallowed_special=())
        ids = self.library.encode(text, add_special_tokens=False).ids if self.v.kind == "json" else self.library.encode(text)
        return np.array(ids, dtype=np.uint32)


@lru_cache(maxsize=2)
def tokenizer(v: Vocabulary) -> Tokenizer:
    """The worker process's encoder for a vocabulary."""
    return Tokenizer(v)
