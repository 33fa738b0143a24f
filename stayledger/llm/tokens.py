"""Token ids of whole texts, with a bounded memory of text parts seen before.

The tokenizer's pattern starts a new piece at every blank that follows a non-blank, and merges never
cross pieces. So a text may be cut before such blanks and the parts encoded on their own, with the same
ids. Texts with a blank after other white space are encoded whole.

A part that is one blank and letters or digits, perhaps with marks at its end, is one piece, or two; a
single line's end between non-blanks is a piece. Where the vocabulary is also there as a table of ranks, such pieces are merged by that table directly, which gives
the tokenizer's ids without running its pattern on single words. All else goes through the tokenizer.
"""

from __future__ import annotations

import os
from array import array
from base64 import b64decode
from collections.abc import Iterator
from functools import lru_cache

import numpy as np

#: Parts remembered in each of two generations by a Python worker, and the longest that is.
REMEMBERED, LONGEST = 250_000, 32
#: Characters of a text that are cut into parts at once.
STRETCH = 1 << 20
#: A run of these marks is one piece; an apostrophe could begin a piece of its own.
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


class Encoder:
    def __init__(self, path: str, ranks: str | None = None) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        #: Little-endian ids of two bytes where the vocabulary allows it.
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.merge = None
        if ranks:
            import tiktoken

            with open(ranks, "rb") as lines:
                table = {b64decode(piece): int(number) for piece, number in map(bytes.split, lines)}
            self.merge = tiktoken.Encoding("ranks", pat_str=".", mergeable_ranks=table, special_tokens={})._core_bpe.encode_single_piece
        self.newline = self.plain("\n")
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.heads: dict[str, bytes] = {}

    def plain(self, text: str) -> bytes:
        return array(self.code, self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids).tobytes()

    def part(self, word: str, lead: str) -> bytes:
        """The ids of ``lead`` (a blank, or nothing at a line's beginning) and a part without blanks."""
        if self.merge is not None:
            core = word.rstrip(MARKS)
            # letters of later blocks could be newer than the tokenizer's tables
            if not core or core.isalpha() and max(core) < "\u0250" or core.isdigit() and core.isascii():
                if core and core != word:
                    return array(self.code, self.merge((lead + core).encode()) + self.merge(word[len(core) :].encode())).tobytes()
                return array(self.code, self.merge((lead + word).encode())).tobytes() if lead or word else b""
            line, newline, rest = word.partition("\n")
            if newline and line and rest and not (line[-1].isspace() or rest[0].isspace()):
                # a line's end between non-blanks is a piece of its own
                left = (self.known.get(line) or self.remembered(line)) if lead else self.head(line)
                return left + self.newline + self.head(rest)
        return self.plain(lead + word)

    def head(self, word: str) -> bytes:
        """The ids of a part at the beginning of a text or line."""
        ids = self.heads.get(word)
        if ids is None:
            ids = self.part(word, "")
            if len(word) <= LONGEST:
                if len(self.heads) >= REMEMBERED:
                    self.heads = {}
                self.heads[word] = ids
        return ids

    def remembered(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = self.part(word, " ")
        if len(word) <= LONGEST:
            if len(self.known) >= REMEMBERED:
                self.older, self.known = self.known, {}
            self.known[word] = ids
        return ids

    def stretch(self, text: str, lead: str) -> bytes:
        parts = text.split(" ")
        found: list[bytes | None] = list(map(self.known.get, parts))
        if not lead:  # the first part has no blank before it
            if len(parts) > 1 and (not parts[0] or parts[0][-1].isspace()):
                return self.plain(text)
            found[0] = self.head(parts[0])
        if None in found:
            last = len(parts) - 1
            for i, ids in enumerate(found):
                if ids is None:
                    word = parts[i]
                    if word and not word[-1].isspace():
                        found[i] = self.remembered(word)
                    elif i == last:
                        found[i] = self.part(word, " ")
                    else:
                        return self.plain(lead + text)
        return b"".join(found)

    def encode(self, text: str) -> bytes:
        """The ids of a whole text, as bytes."""
        if len(text) <= STRETCH:
            return self.stretch(text, "")
        return b"".join(self.stretch(part, lead) for part, lead in stretches(text))


def stretches(text: str) -> Iterator[tuple[str, str]]:
    """(part, blank before it): cut at blanks that follow a non-blank."""
    start, lead = 0, ""
    while True:
        end = text.find(" ", start + STRETCH)
        while end > 0 and text[end - 1].isspace():
            end = text.find(" ", end + 1)
        if end < 0:
            yield text[start:], lead
            return
        yield text[start:end], lead
        start, lead = end + 1, " "


@lru_cache(maxsize=2)
def encoder(path: str, ranks: str | None = None) -> Encoder:
    """One encoder for each worker process; a reused worker keeps what it has learnt."""
    return Encoder(path, ranks)
