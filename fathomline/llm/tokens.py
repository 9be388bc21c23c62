"""Token ids of the public byte-level BPE.

The ids are those of ``tokenizers`` on the vocabulary's JSON file, special strings read as ordinary text. Text of
Latin script goes through the same vocabulary in ``tiktoken``, which is several times as fast and gives
the same ids; anything else goes through ``tokenizers`` itself, as the two libraries' Unicode tables may differ.
"""

from __future__ import annotations

import base64
import functools
import os
import re

import numpy as np

_PLAIN = re.compile(r"[^\x00-ɏ -⁯€]")


class Encoder:
    def __init__(self, path: str | None = None) -> None:
        import public_tokenizers
        import tiktoken

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.path = path or public_tokenizers.path("byte_bpe_50k.json")
        with open(self.path.removesuffix(".json") + ".tiktoken", "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    @functools.cached_property
    def exact(self):
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(self.path)
        t.encode_special_tokens = True
        return t

    def ids(self, text: str) -> list[int]:
        if _PLAIN.search(text):
            return self.exact.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)

    def count(self, text: str) -> int:
        return len(self.ids(text))

    def array(self, text: str) -> np.ndarray:
        return np.array(self.ids(text), dtype=np.uint32)


@functools.cache
def encoder(path: str | None = None) -> Encoder:
    """One for each Python worker."""
    return Encoder(path)
