"""URL filter: all rules as one bit-parallel wildcard automaton.

Every rule is a glob over host + path. Its symbols take one bit each in a row of 64-bit words, with one
more bit for its beginning. Reading a character moves all rules at once: the state is shifted by one
bit (across words) and masked with the symbols that accept the character, and states under a wildcard
stay where they are. URLs of a batch are read side by side, one character of each at a time.

Rules are defined on the host and path as written; globs read the canonical URL (see :func:`canonical`).
Where both are the same, as in most URLs, one pass of the automaton serves both.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import append, quoted

ALLOW, BLOCK = "allow", "block"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """Fits ``host`` and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Glob:
    """``*`` stands for any run without a slash, ``**`` for any run, ``?`` for one character."""

    verdict: str
    pattern: str


#: The method's own globs, for URLs that no rule fits: hosts that sell or farm, and file downloads.
GLOBS = (
    Glob(BLOCK, "*spam*"), Glob(BLOCK, "*spam*/**"),
    Glob(BLOCK, "*cheap-pills*"), Glob(BLOCK, "*cheap-pills*/**"),
    Glob(BLOCK, "*casino*"), Glob(BLOCK, "*casino*/**"),
    Glob(BLOCK, "*/**.exe"), Glob(BLOCK, "*/**.zip"),
)

#: Escapes of characters that need none.
ESCAPE = re.compile("%(2[DEde]|3[0-9]|[46][1-9A-Fa-f]|[57][0-9Aa]|5[Ff]|7[Ee])")
TO_LOWER = str.maketrans(UPPER, LOWER)

Symbol = tuple[str, str]  # kind (one, any, in-host) and character


def symbols(pattern: str) -> list[Symbol]:
    out: list[Symbol] = []
    i = 0
    while i < len(pattern):
        if pattern.startswith("**", i):
            out.append(("all", ""))
            i += 1
        else:
            out.append({"*": ("some", ""), "?": ("any", "")}.get(pattern[i], ("one", pattern[i])))
        i += 1
    return out


def literal(text: str) -> list[Symbol]:
    return [("one", c) for c in text]


class Automaton:
    """Masks of all patterns, by class of characters."""

    def __init__(self, patterns: Sequence[Sequence[Symbol]]) -> None:
        letters = sorted({c for p in patterns for kind, c in p if kind == "one"} | {"/"})
        self.classes = np.zeros(0x110000, np.uint16)  # 0: a character that no pattern names
        for i, c in enumerate(letters):
            self.classes[ord(c)] = i + 1
        bits = sum(1 + sum(kind in ("one", "any") for kind, _ in p) for p in patterns)
        self.words = max(1, -(-bits // 64))
        self.move = np.zeros((len(letters) + 1, self.words), np.uint64)
        self.stay = np.zeros((len(letters) + 1, self.words), np.uint64)
        self.start = np.zeros(self.words, np.uint64)
        self.ends: list[tuple[int, np.uint64]] = []
        at = 0
        for p in patterns:
            self._set(self.start, at)
            for kind, c in p:
                if kind in ("one", "any"):
                    at += 1
                    for k in [letters.index(c) + 1] if kind == "one" else range(len(letters) + 1):
                        self._set(self.move[k], at)
                else:
                    for k in range(len(letters) + 1):
                        if kind == "all" or k == 0 or letters[k - 1] != "/":
                            self._set(self.stay[k], at)
            self.ends.append((at // 64, np.uint64(1 << at % 64)))
            at += 1
        # a state that every character keeps, and that no state can leave in another way, is final
        self.settled = np.bitwise_and.reduce(self.stay, axis=0) & ~self._before_moves()

    @staticmethod
    def _set(mask: np.ndarray, bit: int) -> None:
        mask[bit // 64] |= np.uint64(1 << bit % 64)

    def _before_moves(self) -> np.ndarray:
        """States with a symbol after them."""
        moves = np.bitwise_or.reduce(self.move, axis=0)
        out = moves >> np.uint64(1)
        out[:-1] |= moves[1:] << np.uint64(63)
        return out

    def accepts(self, texts: Sequence[str]) -> np.ndarray:
        """(text, pattern): whether the pattern matches the whole text."""
        lengths = np.array([len(t) for t in texts], np.int64)
        order = np.argsort(-lengths, kind="stable")
        sizes = lengths[order]
        flat = self.classes[np.frombuffer("".join(texts[i] for i in order).encode("utf-32-le", "surrogatepass"), np.uint32)]
        begin = np.cumsum(sizes) - sizes
        state = np.repeat(self.start[None, :], len(texts), axis=0)
        active = np.arange(len(texts))  # longest first
        at = 0
        while True:
            active = active[: np.searchsorted(-sizes[active], -at, side="left")]
            if not len(active):
                break
            if at % 32 == 31:  # URLs whose states can't change any more are done
                active = active[(state[active] & ~self.settled).any(axis=1)]
                if not len(active):
                    break
            kind, old = flat[begin[active] + at], state[active]
            moved = old << np.uint64(1)
            moved[:, 1:] |= old[:, :-1] >> np.uint64(63)
            state[active] = (moved & self.move[kind]) | (old & self.stay[kind])
            at += 1
        out = np.zeros((len(texts), len(self.ends)), bool)
        for p, (word, bit) in enumerate(self.ends):
            out[order, p] = (state[:, word] & bit) != 0
        return out


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host, A-Z lower-cased, and the path; both empty for a null URL or one without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, "^[^/?#]*(/[^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def canonical(host: str, path: str) -> str:
    """Host and path without needless escapes (letters, digits, ``-._~``; decoded once), A-Z lower-cased;
    the host without user info, port and trailing dots."""
    host, path = (ESCAPE.sub(lambda m: chr(int(m[1], 16)), part).translate(TO_LOWER) for part in (host, path))
    host = re.sub(r":[0-9]*\Z", "", host.rpartition("@")[2])
    return host.rstrip(".") + path


def judge(pages: DataFrame, rules: Sequence[Rule], globs: Sequence[Glob] = GLOBS, url: str = "url", default: str = ALLOW) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (the longest that fits; of equally long ones the
    first by name; null if none does), ``verdict`` and ``evidence`` (the rule or glob that decided).

    Where no rule fits, the globs decide over the canonical URL: blocked if a blocking glob matches and no
    allowing one does, else ``default``. Null URLs and those without ``://`` have an empty host and path, which only globs
    can match. Repeated rows are judged alike. Columns named like the added ones are replaced.
    """
    ranked = sorted(rules, key=lambda r: (-len(r.name), r.name))
    patterns: list[list[Symbol]] = []
    for r in ranked:
        tail = literal(r.host + r.path) + [("all", "")]
        patterns += [tail, [("some", ""), ("one", "."), *tail]]
    patterns += [symbols(g.pattern) for g in globs]
    names = [r.name for r in ranked] + [g.pattern for g in globs]
    verdicts = [r.verdict for r in ranked]
    n, first_glob = len(ranked), len(ranked) * 2
    allowing = np.array([g.verdict == ALLOW for g in globs], bool)

    def make():
        automaton = Automaton(patterns)

        def step(hosts, paths):
            parts = list(zip(hosts.to_pylist(), paths.to_pylist()))
            texts, plain = [h + p for h, p in parts], [canonical(h, p) for h, p in parts]
            fits = automaton.accepts(texts)
            by_rule = fits[:, :first_glob].reshape(len(texts), n, 2).any(axis=2)
            by_glob = fits[:, first_glob:]
            if other := [i for i, (a, b) in enumerate(zip(texts, plain)) if a != b]:
                by_glob[other] = automaton.accepts([plain[i] for i in other])[:, first_glob:]
            rule, verdict, evidence = [], [], []
            for i in range(len(texts)):
                if by_rule[i].any():
                    k = int(by_rule[i].argmax())
                    found = (names[k], verdicts[k], names[k])
                elif (hit := by_glob[i] & allowing).any():
                    found = (None, ALLOW, names[n + int(hit.argmax())])
                elif by_glob[i].any():
                    found = (None, BLOCK, names[n + int(by_glob[i].argmax())])
                else:
                    found = (None, default, None)
                for out, value in zip((rule, verdict, evidence), found):
                    out.append(value)
            return [pa.array(x, pa.string()) for x in (rule, verdict, evidence)]

        return step

    host, path = host_and_path(quoted(url))
    ready = pages.withColumns({"host": host, "path": path})
    added = T.StructType([T.StructField(c, T.StringType()) for c in ("rule", "verdict", "evidence")])
    return append(ready, [F.col("host"), F.col("path")], added, make)
