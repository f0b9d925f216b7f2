"""BK-trees over reference entries: every entry within an edit distance, by the triangle inequality."""

from __future__ import annotations

from collections.abc import Iterable

from annuary.llm.orgnames import distance_from


def letters_of(text: str) -> int:
    """The set of a text's characters as bits, by their codes modulo 64."""
    out = 0
    for c in text:
        out |= 1 << (ord(c) & 63)
    return out


class BKTree:
    """Keys may repeat; each carries the list of its values. The distance is Levenshtein's, a metric.

    Keys of one length have a tree of their own, since lengths that differ by more than the limit cannot match.
    """

    def __init__(self, items: Iterable[tuple[str, object]] = ()) -> None:
        self.keys: list[str] = []
        self.values: list[list[object]] = []
        self.children: list[dict[int, int]] = []
        self.roots: dict[int, int] = {}
        self.letters: list[int] = []  # which letters a key has, as bits
        for key, value in items:
            self.add(key, value)

    def add(self, key: str, value: object) -> None:
        new = len(self.keys)
        node = self.roots.setdefault(len(key), new)
        if node != new:
            to = distance_from(key)
            while True:
                d = to(self.keys[node])
                if d == 0:
                    self.values[node].append(value)
                    return
                child = self.children[node].setdefault(d, new)
                if child == new:
                    break
                node = child
        self.keys.append(key)
        self.values.append([value])
        self.children.append({})
        self.letters.append(letters_of(key))

    def within(self, key: str, limit: int) -> list[tuple[int, str, list[object]]]:
        """(distance, key, values) of every key within limit, nearest first."""
        out: list[tuple[int, str, list[object]]] = []
        stack = [self.roots[n] for n in range(len(key) - limit, len(key) + limit + 1) if n in self.roots]
        to, keys, children, letters, own = distance_from(key), self.keys, self.children, self.letters, letters_of(key)
        while stack:
            node = stack.pop()
            # One edit brings in or takes away one letter at most. Where nothing hangs on a node, that is enough.
            if not children[node] and ((own & ~letters[node]).bit_count() > limit or (letters[node] & ~own).bit_count() > limit):
                continue
            d = to(keys[node])
            if d <= limit:
                out.append((d, keys[node], self.values[node]))
            stack += [child for edge, child in children[node].items() if d - limit <= edge <= d + limit]
        return sorted(out, key=lambda x: (x[0], x[1]))
