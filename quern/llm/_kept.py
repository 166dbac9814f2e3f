"""Results for short texts, kept in a bounded number of bytes."""

from __future__ import annotations

from collections.abc import Callable

MOST_BYTES = 4 << 20
LONGEST = 64
ENTRY_BYTES = 200  # of an entry, beside its letters and its bytes, at most


class Kept(dict):
    """make(key) for texts, made when first asked for. What was made last is kept, in
    two generations of most_bytes each; texts longer than LONGEST are never kept."""

    def __init__(self, make: Callable[[str], bytes], most_bytes: int = MOST_BYTES):
        super().__init__()
        self.make, self.most_bytes, self.older, self.bytes = make, most_bytes, {}, 0

    def __missing__(self, text: str) -> bytes:
        made = self.older.get(text)
        if made is None:
            made = self.make(text)
        if len(text) <= LONGEST:
            self.bytes += 4 * len(text) + len(made) + ENTRY_BYTES
            if self.bytes > self.most_bytes:
                self.older, self.bytes = dict(self), 0
                self.clear()
            self[text] = made
        return made
