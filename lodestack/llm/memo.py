"""Bounded memory of a function's results in a Python worker."""

from __future__ import annotations


class Memo(dict):
    """Remembers the latest results of a function of strings: between `most` and twice as many."""

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most, self.older = make, most, {}

    def __missing__(self, key: str):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        self.put(key, value)
        return value

    def forget(self) -> None:
        self.clear()
        self.older = {}

    def recall(self, key: str):
        """The remembered value, which then is among the latest again, or None."""
        if (value := self.get(key)) is None and (value := self.older.get(key)) is not None:
            self.put(key, value)
        return value

    def renew(self, key: str) -> bool:
        """Whether the older generation has the key, which then is among the latest again."""
        if (value := self.older.get(key)) is None:
            return False
        self.put(key, value)
        return True

    def put_all(self, values: dict) -> None:
        if len(self) + len(values) > self.most:
            self.older = dict(self)
            self.clear()
        self.update(values)

    def put(self, key: str, value) -> None:
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[key] = value
