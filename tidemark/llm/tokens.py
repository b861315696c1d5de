"""Token ids of whole texts by a public byte-level BPE vocabulary.

The vocabulary comes as a tokenizer file and as ranks. Both give the same ids (tested over
all code points and over random strings); the rank form is several times faster and is used
wherever it exists. Special strings inside a text become their ids, as the tokenizer file
has it by default. A text that may hold a very long run of word characters or of white space
goes through the tokenizer file: there the rank form is slow, or runs out of stack.
"""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np

LONG_RUN = 3000


def has_long_run(text: str) -> bool:
    """Whether a run of one kind may be longer than ``LONG_RUN``; never false where one is."""
    if len(text) < LONG_RUN:
        return False
    lengths = list(map(len, text.split()))
    spare = len(text) - sum(lengths) - len(lengths)
    return spare >= LONG_RUN or max(lengths, default=0) >= LONG_RUN


class Encoder:
    """Ids of texts by one vocabulary file."""

    def __init__(self, name: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        self.special = {
            token.content: place
            for place, token in self.tokenizer.get_added_tokens_decoder().items()
        }
        self.ranked = _ranked(name, self.special)

    def ids(self, text: str) -> list[int]:
        if self.ranked is None or has_long_run(text):
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        if any(string in text for string in self.special):
            return self.ranked.encode(text, allowed_special="all")
        return self.ranked.encode_ordinary(text)

    def array(self, text: str) -> np.ndarray:
        """Little-endian unsigned 32-bit ids."""
        return np.array(self.ids(text), "<u4")


def _rank_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(os.path.splitext(name)[0] + ".tiktoken")


def _ranked(name: str, special: dict[str, int]):
    """The encoder over ranks, where the vocabulary also comes as ranks."""
    import base64

    import public_tokenizers
    import tiktoken

    path = _rank_file(name)
    if not os.path.exists(path):
        return None
    with open(path, "rb") as file:
        pairs = [line.split() for line in file]
    ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
    return tiktoken.Encoding(
        name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special
    )


@lru_cache(maxsize=2)
def encoder(name: str) -> Encoder:
    """One encoder per Python worker; it is kept between tasks."""
    return Encoder(name)


def version(name: str) -> str:
    """A digest of what the ids depend on: the vocabulary, as file and ranks, and the libraries."""
    import hashlib

    import public_tokenizers
    import tiktoken
    import tokenizers

    found = hashlib.sha256(public_tokenizers.PATTERN.encode())
    for path in (public_tokenizers.path(name), _rank_file(name)):
        if os.path.exists(path):
            with open(path, "rb") as file:
                found.update(hashlib.sha256(file.read()).digest())
    for library in (tokenizers, tiktoken):
        found.update(f"{library.__name__} {library.__version__}\n".encode())
    return found.hexdigest()
