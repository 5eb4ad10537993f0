"""Token ids of whole texts, shared by packing and token counting."""

from __future__ import annotations

import base64
import json
import os
import re

import numpy as np

TOKENIZER = "byte_bpe_50k.json"
#: Pieces that a worker keeps; the ones met first include nearly all frequent ones.
CACHE_PIECES = 200_000

_SPACE_RUN = re.compile(r" \s|\s ")


class _Pieces(dict):
    """Ids of a space and a piece after it; encoded at first sight, kept while there is room."""

    def __init__(self, encode):
        super().__init__()
        self._encode = encode

    def __missing__(self, piece: str) -> bytes:
        ids = self._encode(" " + piece)
        if len(self) < CACHE_PIECES:
            self[piece] = ids
        return ids


class WordEncoder:
    """Byte-level BPE with a cache of pieces.

    The vocabulary's pre-tokenizer always cuts before a lone space that
    follows a non-space, so a text without other white space beside a space can
    be encoded piece by piece (each with its leading space), and pieces repeat.
    Any other text is encoded whole.  Ids come back as little-endian unsigned
    32-bit bytes.

    The ids are those of ``Tokenizer.from_file(path).encode(text,
    add_special_tokens=False)``.  Where the same vocabulary lies beside it as
    ranks (``.tiktoken``), its merges are run from there, which takes a third
    of the time; a text that may hold a special token's string never is.
    """

    def __init__(self, path: str):
        self._path, self._tokenizer = path, None
        self._known = _Pieces(lambda piece: self._plain(piece))
        self._ranked = None
        ranks_path = re.sub(r"\.json$", ".tiktoken", path)
        if ranks_path != path and os.path.exists(ranks_path):
            import public_tokenizers
            import tiktoken

            with open(ranks_path, "rb") as f:
                ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
            self._ranked = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                             special_tokens={})
        with open(path, encoding="utf-8") as f:
            self._special = [t["content"] for t in json.load(f)["added_tokens"]]

    def _plain(self, text: str) -> bytes:
        if self._ranked is None:
            return self._exact(text)
        return np.array(self._ranked.encode_ordinary(text), "<u4").tobytes()

    def _exact(self, text: str) -> bytes:
        if self._tokenizer is None:  # large, and seldom needed beside the ranks
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            self._tokenizer = Tokenizer.from_file(self._path)
        return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """Ids of a whole text."""
        if any(s in text for s in self._special):
            return self._exact(text)
        if _SPACE_RUN.search(text):
            return self._plain(text)
        head, *rest = text.split(" ")
        ids = b"".join(map(self._known.__getitem__, rest))
        return self._plain(head) + ids if head else ids


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(name: str = TOKENIZER) -> WordEncoder:
    """The worker's encoder of a public vocabulary file (a bare name) or of a given path."""
    if name not in _ENCODERS:
        path = name
        if os.sep not in name:
            import public_tokenizers

            path = public_tokenizers.path(name)
        _ENCODERS[name] = WordEncoder(path)
    return _ENCODERS[name]
