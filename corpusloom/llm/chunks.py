"""Cut points at which byte-level BPE text can be split without changing its tokens.

The pre-tokenizer attaches one space to the word after it, and a lone newline
between visible characters is a piece of its own. Cutting at single spaces and
single newlines with a plainly visible character on either side is therefore
exact, and most pieces repeat, so their results can be cached.
"""

from __future__ import annotations

import re

_VISIBLE = "!-~À-ɏ"
_LINE = re.compile(f"\n(?<=[{_VISIBLE}]\n)(?=[{_VISIBLE}])")
_SPACE = re.compile(f" (?<=[{_VISIBLE}] )(?=[{_VISIBLE}])")


def lines(text: str) -> list[str]:
    return _LINE.split(text)


def pieces(line: str) -> list[str]:
    """The first piece as it stands; each later one had a space before it."""
    return _SPACE.split(line)


class Memo(dict):
    """A dict that computes missing values, and forgets all of them at a size bound."""

    def __init__(self, compute, bound: int = 200_000, longest: int = 48):
        super().__init__()
        self.compute, self.bound, self.longest = compute, bound, longest

    def __missing__(self, key):
        value = self.compute(key)
        if len(key) <= self.longest:
            if len(self) >= self.bound:
                self.clear()
            self[key] = value
        return value
