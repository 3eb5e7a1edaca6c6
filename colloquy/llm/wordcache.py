"""Words to encoded ids, remembered in two bounded generations."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import filterfalse


class WordCache(dict):
    """Word to bytes. When ``limit`` words are held, they become the old generation;
    words asked for again come back from it, the others go at the next turn."""

    def __init__(self, encode: Callable[[list[str]], Iterable[bytes]], limit: int = 300_000, longest: int = 256):
        super().__init__()
        self.encode, self.limit, self.longest, self.old = encode, limit, longest, {}

    def learn(self, words: Iterable[str]) -> None:
        """Make every word of ``words`` present."""
        words = words if isinstance(words, set) else set(words)
        new = list(filterfalse(self.__contains__, words))  # one look-up a word, whatever the cache holds
        if len(self) + len(new) > self.limit and self:
            self.old = dict(self)
            self.clear()
            new = words
        ask = []
        for w in new:
            got = self.old.get(w)
            if got is None:
                ask.append(w)
            else:
                self[w] = got
        if ask:
            self.update(zip(ask, self.encode(ask)))

    def join(self, words: list[str]) -> bytes:
        return b"".join(map(self.__getitem__, words))


def in_steps(texts: Iterable[str | None], most: int = 1 << 20) -> Iterator[list[str]]:
    """The texts (null: empty) in lists of about ``most`` characters."""
    held: list[str] = []
    n = 0
    for t in texts:
        held.append(t or "")
        n += len(held[-1])
        if n >= most:
            yield held
            held, n = [], 0
    if held:
        yield held
