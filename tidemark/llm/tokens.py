"""Token ids of many texts by a public tokenizer, with a bounded cache of words in each worker."""

from __future__ import annotations

import os
import re
from collections import defaultdict
from itertools import count, islice
from string import punctuation

import numpy as np
import pyarrow as pa

#: Distinct words that a worker keeps for a tokenizer, and as many parts of words; beyond that it starts over, so memory stays
#: bounded (about 200 bytes each).
CACHE_WORDS = 700_000
CHUNK_ROWS = 512
CHUNK_CHARS = 500_000
#: New parts of words that go to the library as one text, with a mark between them that is a token of its own there.
JOINED_PARTS = 1_000
_MARK = {"bytes": "\n", "words": " \x01 "}
#: White space other than the space and the line feed, as Python and the tokenizers see it.
_OTHER_SPACE = re.compile(r"[^\S \n]")
_made: dict[tuple[str, str], WordTokenizer] = {}


def tokenizer(path: str, kind: str) -> WordTokenizer:
    """The worker's tokenizer for that file. kind: `words` drops white space, `bytes` keeps it."""
    if (path, kind) not in _made:
        _made[path, kind] = WordTokenizer(path, kind)
    return _made[path, kind]


def release() -> None:
    """Frees the worker's tokenizers and their words: for tasks that come after all texts are encoded."""
    _made.clear()


class _Column:
    """An array that grows at its end; doubling keeps the copies few."""

    def __init__(self, kind):
        self._all, self.size = np.zeros(1 << 16, kind), 0

    def extend(self, more: np.ndarray) -> int:
        """Adds the values; returns the place of the first."""
        at, self.size = self.size, self.size + len(more)
        if self.size > len(self._all):
            self._all = np.concatenate([self._all, np.zeros(max(self.size, len(self._all)), self._all.dtype)])
        self._all[at : self.size] = more
        return at

    @property
    def values(self) -> np.ndarray:
        return self._all[: self.size]


class WordTokenizer:
    """Ids as the tokenizers library gives for whole texts, with each distinct word encoded once.

    Neither tokenizer joins characters over a single space between two non-spaces, so a text's ids are those of its
    words in turn (`bytes`: a word with the space or line feed before it). New words go to the library many at a time, as
    one text in which a mark of one token stands between them. A whole text goes to the library where words aren't
    enough: if it holds the string of an added token or, for `bytes`, if other white space meets a space or a line feed.
    """

    def __init__(self, path: str, kind: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library, self.kind = Tokenizer.from_file(path), kind
        self.added = [x.content for x in self.library.get_added_tokens_decoder().values()]
        (self.mark,) = self._library_ids([_MARK[kind]])[0]
        self._clear()
        self._clear_parts()

    def _library_ids(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _clear(self) -> None:
        # numbers of words as they come, and where the ids of each lie in `ids`; length -1: it can't be encoded alone
        self.numbers: dict = defaultdict(count().__next__)
        self.first, self.length, self.ids = _Column(np.int64), _Column(np.int64), _Column(np.uint32)

    def _clear_parts(self) -> None:
        # parts of words, which outlive them as there are fewer; the first two are no text and the mark, a line feed
        self.parts: dict = defaultdict(count().__next__)
        self.part_ids, self.part_ends = _Column(np.uint32), _Column(np.int64)
        self.parts[""], self.parts["\n"]
        self.part_ids.extend(np.array([self.mark], np.uint32))
        self.part_ends.extend(np.array([0, 0, 1]))

    def _units(self, new: list) -> tuple[list[str], np.ndarray, np.ndarray]:
        """What is encoded for each new word, whether a line feed comes before it, and whether it can't be encoded alone."""
        if self.kind == "words":
            units, after = [x.decode() for x in new], np.zeros(len(new), bool)
            whole = [_MARK["words"].strip(" ") in x for x in units] if _MARK["words"].strip(" ") in "".join(units) else None
        else:
            units = [" " + x if x[:1] != "\n" else x.lstrip("\n") for x in new]
            after = np.array([x[:1] == "\n" and x[1:2] != "\n" for x in new])
            # white space at an end of the word: its ids depend on its neighbours
            odd = _OTHER_SPACE.search("".join(new)) or "" in new or "\n" in new
            whole = [not x.strip(" ") or x.strip(" ")[0].isspace() or x[-1].isspace() for x in units] if odd else None
        return units, after, np.array(whole if whole else np.zeros(len(new), bool))

    @staticmethod
    def _gather(ids: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
        ends = np.cumsum(length)
        return ids[np.repeat(first - (ends - length), length) + np.arange(int(ends[-1]) if len(ends) else 0)]

    def _learn(self) -> None:
        """Encodes the words that came since the last call: each is a part that ends in an ASCII letter or digit and one of ASCII punctuation."""
        n = len(self.numbers) - self.first.size
        if not n:
            return
        units, after, whole = self._units(list(islice(reversed(self.numbers), n))[::-1])
        if whole.any():
            units = ["" if w else x for x, w in zip(units, whole.tolist(), strict=True)]
        cores = [x.rstrip(punctuation) for x in units]
        # after other letters, which the normalizer may turn into letter and mark, a cut could change the ids
        cores = [c if c[-1:].isascii() and c[-1:].isalnum() else x for c, x in zip(cores, units, strict=True)]
        tails = [x[len(c) :] for c, x in zip(cores, units, strict=True)]
        part = self.parts.__getitem__
        parts = np.stack([after * 1, np.fromiter(map(part, cores), np.int64, n), np.fromiter(map(part, tails), np.int64, n)], 1).ravel()
        self._learn_parts()
        ends = self.part_ends.values
        first, length = ends[parts], ends[parts + 1] - ends[parts]
        at = self.ids.extend(self._gather(self.part_ids.values, first, length))
        length = length.reshape(n, 3).sum(1)
        self.first.extend(at + np.cumsum(length) - length)
        self.length.extend(np.where(whole, -1, length))

    def _learn_parts(self) -> None:
        n = len(self.parts) - self.part_ends.size + 1
        if not n:
            return
        new, mark = list(islice(reversed(self.parts), n))[::-1], _MARK[self.kind]
        found = self._library_ids([mark.join([*new[i : i + JOINED_PARTS], ""]) for i in range(0, n, JOINED_PARTS)])
        ids = np.concatenate([np.array(x, np.uint32) for x in found])
        is_mark = ids == self.mark
        ends = np.flatnonzero(is_mark) - np.arange(int(is_mark.sum()))
        if len(ends) != n:
            raise AssertionError("the mark is no token of its own")
        self.part_ends.extend(self.part_ids.extend(ids[~is_mark]) + ends)

    def _words(self, text: str) -> list:
        if not text:
            return []
        if self.kind == "words":
            return text.encode().lower().split()
        words = text.replace("\n", " \n").split(" ")
        # a space came before, but for words with a line feed, and the first one: two line feeds mark that
        words[0] = "\n\n" + words[0]
        return words if len(words[0]) > 2 else words[1:]

    def encode(self, column: pa.Array, end_id: int | None = None):
        """An array of ids for each text in turn; null is empty; end_id follows the ids of each."""
        at, n = 0, len(column)
        while at < n:
            texts, chars = [], 0
            while at < n and len(texts) < CHUNK_ROWS and chars < CHUNK_CHARS:
                texts.append(column[at].as_py() or "")
                chars += len(texts[-1])
                at += 1
            yield from self._chunk(texts, end_id)

    def _chunk(self, texts: list[str], end_id: int | None) -> list[np.ndarray]:
        if len(self.numbers) > CACHE_WORDS:
            self._clear()
        if len(self.parts) > CACHE_WORDS:
            self._clear_parts()
        number, parts = self.numbers.__getitem__, []
        for text in texts:
            if any(x in text for x in self.added):
                parts.append(None)
            else:
                words = self._words(text)
                parts.append(np.fromiter(map(number, words), np.int64, len(words)))
        self._learn()
        out, first, length = [], self.first.values, self.length.values
        for text, own in zip(texts, parts, strict=True):
            if own is None or (len(lengths := length[own]) and lengths.min() < 0):
                ids = np.array(self._library_ids([text])[0], np.uint32)
            else:
                ids = self._gather(self.ids.values, first[own], lengths)
            out.append(ids if end_id is None else np.append(ids, np.uint32(end_id)))
        return out
