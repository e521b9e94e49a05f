"""Texts as pieces that tokenizers treat apart, so that frequent pieces are encoded once per task."""

from __future__ import annotations

import ctypes
import gc
import re
import weakref
from collections.abc import Callable, Collection, Iterable

import pyarrow as pa

# a cache of this many bytes is put aside, and what is asked for again comes back from there: so twice this
MOST_BYTES = 64 << 20
# what an entry takes, about: so many bytes, and so many for each character of its piece
ENTRY_BYTES, CHARACTER_BYTES = 300, 12
# longer pieces hardly come again (texts without spaces are one piece) and are not kept
LONGEST = 64

SPACE = "▁"
# marks the cuts of texts that don't have it
BORDER = "\0"

_caches: weakref.WeakSet = weakref.WeakSet()


class Cache:
    """Results by piece; ``fill`` computes those of a list of new pieces. Frequent pieces stay, others make room."""

    def __init__(self, fill: Callable[[list], Iterable], most: int = MOST_BYTES):
        self.fill, self.most = fill, most
        self.forget()
        _caches.add(self)

    def forget(self) -> None:
        self.now: dict = {}
        self.before: dict = {}
        self.bytes = 0

    def of(self, texts: list[list]) -> list[list]:
        """The result of each piece of each text."""
        if self.bytes >= self.most:
            self.before, self.now, self.bytes = self.now, {}, 0
        now, passing = self.now, {}
        unseen = set().union(*texts).difference(now)
        new = unseen.difference(self.before)
        now.update((piece, self.before[piece]) for piece in unseen.difference(new))
        self.bytes += _bytes(unseen.difference(new))
        if new and max(map(len, new)) > LONGEST:
            once = [piece for piece in new if len(piece) > LONGEST]
            passing = dict(zip(once, self.fill(once)))
            new.difference_update(once)
        if new:
            listed = list(new)
            now.update(zip(listed, self.fill(listed)))
            self.bytes += _bytes(listed)
        if passing:
            return [[now[p] if p in now else passing[p] for p in pieces] for pieces in texts]
        return [list(map(now.__getitem__, pieces)) for pieces in texts]


def _bytes(pieces: Collection) -> int:
    return ENTRY_BYTES * len(pieces) + CHARACTER_BYTES * sum(map(len, pieces))


def release() -> None:
    """For the end of a task's input: idle Python workers hold no results, and give back what they held, cyclic garbage too."""
    for cache in list(_caches):
        cache.forget()
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # only glibc has it


def escaped(text: str) -> str:
    """The text as the piece tokenizer sees it: a space in front, spaces as U+2581."""
    return SPACE + text.replace(" ", SPACE) if text else ""


def space_words(text: str) -> list[str]:
    """The escaped text, cut before every U+2581 that follows another character.

    No piece of such a vocabulary has U+2581 after another character, so nothing is merged across a cut.
    """
    if not text:
        return []
    if "  " not in text and SPACE not in text and BORDER not in text:
        return (SPACE + text.replace(" ", BORDER + SPACE)).split(BORDER) if text[0] != " " else _space_words(text)
    return _space_words(text)


def _space_words(text: str) -> list[str]:
    words = text.replace(" ", SPACE).split(SPACE)
    if "" not in words:
        return [SPACE + w for w in words]
    out, run = [], SPACE
    for word in words[:-1]:
        if word:
            out.append(run + word)
            run = SPACE
        else:
            run += SPACE
    out.append(run + words[-1])
    return out


# a cut before a space is safe behind any other character; behind white space it may split a run that the pattern groups
_RUN = re.compile(r"\s \s|\s \Z")
_CUT = re.compile(r"(?<!\s)(?= )")


def byte_words(text: str) -> list[str]:
    """The text cut before spaces where the byte-level tokenizer starts a new word in any case.

    Its pattern starts a word at any white space after another character, and hands the last single space
    of a run to the word behind it.
    """
    if _RUN.search(text):
        return _CUT.split(text)
    if BORDER in text:
        words = text.split(" ")
        return words[:1] + [" " + w for w in words[1:]]
    return text.replace(" ", BORDER + " ").split(BORDER)
