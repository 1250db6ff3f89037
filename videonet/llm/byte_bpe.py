"""Exact token counts of every prefix of a text under byte-level BPE.

Merging is local: a list of tokens is the encoding of its bytes if every token encodes to itself and every two
neighbours encode to just these two. So the last token of each prefix follows from those of shorter ones: it is
the one token that ends there and stands next to the last token of the prefix before it.
"""

from __future__ import annotations

import json
from functools import lru_cache

import ahocorasick
import numpy as np
import regex

CACHE_ENTRIES = 400_000
#: Longer stretches without a safe cut are not kept in the cache.
CACHED_LENGTH = 48

# White space as the tokenizer's pattern knows it, and that pattern (byte-level BPE, GPT-2 style).
SPACE = r"\t-\r \x85\xa0  -     　"
PATTERN = (
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)
TWO_LETTER_ENDINGS = frozenset(("'re", "'ve", "'ll"))

_WORDS = regex.compile(PATTERN)
_BLANKS = regex.compile(rf"[{SPACE}]+")
# A blank that does not stand between two other characters. Python's \s holds a few more characters than SPACE.
_UNSAFE = regex.compile(r"\A\s|\s\s|[\s--[ ]]\Z|\s\Z", regex.V1)


def byte_letters() -> list[str]:
    """The letter by which vocabulary files of byte-level BPE write each byte."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(byte if byte in plain else next(others)) for byte in range(256)]


class PrefixCounter:
    """Counts for one vocabulary file of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self._vocabulary: dict[str, int] = model["vocab"]
        self._ranks = {tuple(pair): rank for rank, pair in enumerate(model["merges"])}
        self.specials = [token["content"] for token in spec["added_tokens"]]
        self._specials = regex.compile("|".join(map(regex.escape, self.specials))) if self.specials else None
        self._letters = byte_letters()
        self._pairs: dict[tuple[str, str], bool] = {}
        self._automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY)
        for token in self._vocabulary:
            if token not in self.specials and self.merged(token) == [token]:
                self._automaton.add_word(token, token)
        self._automaton.make_automaton()
        self._known: dict[str, bytes] = {}
        self._stretches: dict[str, bytes] = {}

    def merged(self, letters: str) -> list[str]:
        """Plain byte-pair merging: the best ranked pair first, the leftmost of equal ones."""
        parts = list(letters)
        rank_of = self._ranks.get
        unranked = [len(self._ranks)] * len(parts)
        while len(parts) > 1:
            ranks = list(map(rank_of, zip(parts, parts[1:]), unranked))
            best = min(ranks)
            if best == unranked[0]:
                break
            at = ranks.index(best)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _neighbours(self, left: str, right: str) -> bool:
        if (left, right) in self._ranks:  # they would merge
            return False
        known = self._pairs.get((left, right))
        if known is None:
            if len(self._pairs) > CACHE_ENTRIES:
                self._pairs.clear()
            known = self._pairs[left, right] = self.merged(left + right) == [left, right]
        return known

    def _byte_counts(self, letters: str) -> list[int]:
        """Tokens of each prefix of one word, by bytes: counts[i] for the first i bytes."""
        size = len(letters)
        counts, last = [0] * (size + 1), [""] * (size + 1)
        neighbours = self._neighbours
        done = 0
        for end, token in self._automaton.iter(letters):  # longer tokens first among those with the same end
            end += 1
            if end == done:
                continue
            start = end - len(token)
            if start == 0 or neighbours(last[start], token):
                counts[end], last[end] = counts[start] + 1, token
                done = end
        return counts

    def word_counts(self, word: str) -> list[int]:
        """Tokens of each prefix of one word of the pattern, by code points, from one code point on."""
        data = word.encode()
        counts = self._byte_counts("".join(map(self._letters.__getitem__, data)))
        if len(data) == len(word):
            found = counts[1:]
        else:  # a code point ends where no continuation byte follows
            found = [counts[i] for i in range(1, len(data) + 1) if i == len(data) or data[i] & 0xC0 != 0x80]
        if word in TWO_LETTER_ENDINGS:
            found[1] = 2  # "'r" is no ending yet: an apostrophe and a letter
        return found

    def _known_counts(self, word: str) -> bytes | list[int]:
        found = self._known.get(word)
        if found is None:
            found = self.word_counts(word)
            if len(word) <= CACHED_LENGTH:
                if len(self._known) > CACHE_ENTRIES:
                    self._known.clear()
                found = self._known[word] = bytes(found)
        return found

    def _stretch(self, text: str) -> list[int]:
        """Counts of a stretch of text that begins and ends where words of the pattern do, whatever surrounds it."""
        counts: list[int] = []
        base, run_ends = 0, []
        for word in _WORDS.findall(text):
            own = self._known_counts(word)
            at = len(counts)
            counts += [base + n for n in own] if base else own
            # White space before a word: its last character belongs to what follows, but as long as nothing
            # does, the whole run is one word.
            if word.isspace() and _BLANKS.fullmatch(word):
                run = _BLANKS.match(text, at)[0]
                if len(run) > len(word):
                    run_ends.append((at + len(run) - 1, base + self._known_counts(run)[-1]))
            base += own[-1]
        for at, count in run_ends:
            counts[at] = count
        return counts

    def _plain(self, text: str) -> np.ndarray:
        """Counts of all prefixes of a text without special tokens, by code points, from one code point on."""
        if not text:
            return np.empty(0, np.int32)
        stretches = text.split(" ")
        stretches[1:] = [" " + stretch for stretch in stretches[1:]]
        if _UNSAFE.search(text):
            stretches = _safe(stretches)
        found = list(map(self._stretches.get, stretches))
        long = False
        if None in found:
            new: dict[str, bytes | list[int]] = {}
            for i, counts in enumerate(found):
                if counts is None:
                    stretch = stretches[i]
                    counts = new.get(stretch)
                    if counts is None:
                        counts = self._stretch(stretch)
                        if len(counts) <= CACHED_LENGTH:
                            counts = bytes(counts)
                        else:
                            long = True
                        new[stretch] = counts
                    found[i] = counts
            if len(self._stretches) > CACHE_ENTRIES:
                self._stretches.clear()
            self._stretches.update((k, v) for k, v in new.items() if len(v) <= CACHED_LENGTH)
        if long:
            local = np.concatenate([np.array(memoryview(x) if isinstance(x, bytes) else x, np.int32) for x in found])
        else:
            local = np.frombuffer(b"".join(found), np.uint8)
        ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))
        # Each stretch's counts are raised by the totals of those before it.
        totals = local[ends - 1].astype(np.int32)
        return local + np.repeat(np.cumsum(totals, dtype=np.int32) - totals, np.diff(ends, prepend=0))

    def prefix_counts(self, text: str) -> np.ndarray:
        """counts[i] is the number of tokens of text[:i], as the library encodes it."""
        pieces, base, at = [np.zeros(1, np.int32)], 0, 0
        for special in self._specials.finditer(text) if self._specials else ():
            # Within the special token's own letters the prefix is ordinary text.
            plain = self._plain(text[at:special.end() - 1])
            size = special.start() - at
            # The text before a special token is encoded on its own, as it is at its end.
            base_here = int(plain[size - 1]) if size else 0
            pieces.append(plain + base)
            base += base_here + 1
            pieces.append(np.array([base], np.int32))
            at = special.end()
        pieces.append(self._plain(text[at:]) + base)
        return np.concatenate(pieces).astype(np.int32)


def _safe(stretches: list[str]) -> list[str]:
    """Join stretches until each cut lies between a character that is no white space and a blank before another."""
    out = [stretches[0]]
    for stretch in stretches[1:]:
        if out[-1] and not out[-1][-1].isspace() and len(stretch) > 1 and not stretch[1].isspace():
            out.append(stretch)
        else:
            out[-1] += stretch
    return out


@lru_cache(maxsize=2)
def prefix_counter(path: str) -> PrefixCounter:
    """One counter per worker process and file."""
    return PrefixCounter(path)
