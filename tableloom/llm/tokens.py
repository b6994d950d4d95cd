"""Token ids of texts, by a public tokenizer file whose path is a parameter."""

from __future__ import annotations

import base64
import os
from dataclasses import dataclass
from functools import lru_cache

import numpy as np


@dataclass(frozen=True)
class Vocabulary:
    """json: a file of the tokenizers library.  ranks: the same byte-level vocabulary as merge ranks, or None.

    The tokenizers library, as the file sets it up, defines the ids: a text that holds the string of an added token,
    such as an end-of-text mark, has that token's id there.  Where ranks are given, texts without such a string are
    encoded from them, which is about five times as fast and gives the same ids; every worker checks that on probes
    and on one text in so many it meets, whatever its length, and a text that the faster encoder refuses goes to the
    library.  plain: the strings of added tokens are ordinary text instead.
    """

    json: str
    ranks: str | None = None
    pattern: str | None = None
    plain: bool = False

    @staticmethod
    def byte_bpe(plain: bool = False) -> Vocabulary:
        import public_tokenizers as public

        return Vocabulary(public.path("byte_bpe_50k.json"), public.path("byte_bpe_50k.tiktoken"), public.PATTERN, plain)


PROBES = ("", "a", "Hello  world's 123\n\n  x\t", "Ünïcode ßtraße — ñandú 你好 \U0001f600", "!!!***$$$ | a | b", " " * 40 + "end ")


class Encoder:
    CHECKED = 512  # of so many texts a worker encodes one both ways, the first one too

    def __init__(self, vocabulary: Vocabulary):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(vocabulary.json)
        self.library.encode_special_tokens = vocabulary.plain
        self.size = self.library.get_vocab_size()
        self.added = [] if vocabulary.plain else [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.fast, self.met = None, 0
        if vocabulary.ranks and os.path.exists(vocabulary.ranks):
            import tiktoken

            with open(vocabulary.ranks, "rb") as lines:
                ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("ranks", pat_str=vocabulary.pattern, mergeable_ranks=ranks, special_tokens={})
            for text in PROBES:
                self._compare(text, self._fast(text))

    def _slow(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)

    def _fast(self, text: str) -> np.ndarray:
        return np.array(self.fast.encode_to_numpy(text, disallowed_special=()), np.uint32)

    def _compare(self, text: str, ids: np.ndarray) -> None:
        if not np.array_equal(ids, self._slow(text)):
            raise ValueError(f"the two vocabulary files give different ids for {text[:80]!r}")

    def ids(self, text: str | None) -> np.ndarray:
        text = text or ""
        if not self.fast or any(x in text for x in self.added):
            return self._slow(text)
        try:
            got = self._fast(text)
        except BaseException as e:  # noqa: BLE001  a panic of the native code isn't an Exception
            if isinstance(e, (KeyboardInterrupt, SystemExit)):
                raise
            return self._slow(text)
        if self.met % self.CHECKED == 0:
            self._compare(text, got)
        self.met += 1
        return got


@lru_cache(maxsize=2)
def encoder(vocabulary: Vocabulary) -> Encoder:
    """One per worker process."""
    return Encoder(vocabulary)
