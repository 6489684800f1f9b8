"""Which merges of a round are certain: the part of greedy merging that needs no further counting.

From the leading pairs and their contexts the counts after a merge follow exactly, as long as merges
do not interfere. Where they do, a count is only known to lie in an interval. Merging goes on while the
pair that comes first even by the upper ends has an exact count, so every merge taken is the one that
counting again after each single merge would have taken.
"""

from __future__ import annotations

import heapq
from collections import defaultdict

Pair = tuple[str, str]


def merge_order(pair: Pair, count: int) -> tuple:
    """Higher count, shorter piece, bytewise smaller piece, bytewise smaller left symbol."""
    piece = pair[0] + pair[1]
    return (-count, len(piece), piece.encode(), pair[0].encode())


class RoundPlan:
    """``leading`` holds the first pairs ``(left, right, count)`` in merge order, ``contexts`` all
    ``(left, mid, right, count)`` that contain one of them; the empty string marks a word's end."""

    def __init__(self, leading: list[tuple], contexts: list, known: set[str], max_piece_length: int):
        self.low = {(left, right): count for left, right, count in leading}
        self.high = dict(self.low)
        left, right, count = leading[-1]
        self.last_seen = merge_order((left, right), count)
        self.known = known
        self.max_piece_length = max_piece_length
        self.before: dict[Pair, list] = defaultdict(list)
        self.after: dict[Pair, list] = defaultdict(list)
        for first, mid, third, number in contexts:
            if first and mid and third:
                self.before[(mid, third)].append((first, number))
                self.after[(first, mid)].append((third, number))
        self.queue = [(merge_order(pair, count), pair) for pair, count in self.high.items()]
        heapq.heapify(self.queue)
        self.taken: set[Pair] = set()
        self.lefts: set[str] = set()
        self.rights: set[str] = set()
        self.made: set[str] = set()

    def take(self, room: int) -> list[tuple[str, str, int]]:
        """The certain merges in order, at most ``room`` new pieces; at least one if there is any pair."""
        accepted: list[tuple[str, str, int]] = []
        while room > 0 and (pair := self._first()) is not None:
            left, right = pair
            count = self.high[pair]
            exact = self.low[pair] == count
            unseen_may_precede = merge_order(pair, count) > self.last_seen
            if not exact or unseen_may_precede or left in self.made or right in self.made:
                break
            accepted.append((left, right, count))
            piece = left + right
            if piece in self.known or piece in self.made:
                # pairs of an existing symbol gain occurrences that were not counted here
                break
            room -= 1
            self._merge(pair, piece)
        return accepted

    def _first(self) -> Pair | None:
        while self.queue:
            order, pair = self.queue[0]
            if pair in self.high and order == merge_order(pair, self.high[pair]):
                return pair
            heapq.heappop(self.queue)
        return None

    def _merge(self, pair: Pair, piece: str) -> None:
        left, right = pair
        del self.high[pair], self.low[pair]
        self.made.add(piece)
        for outer, number in self.before.get(pair, ()):
            if (outer, left) not in self.taken:
                overlaps = outer == right or left == right
                certain = not (overlaps or outer in self.rights or right in self.lefts)
                self._lose((outer, left), number, certain)
                self._gain((outer, piece), number, certain)
                if overlaps:
                    self._gain((piece, piece), number, False)
        for outer, number in self.after.get(pair, ()):
            if (right, outer) not in self.taken:
                overlaps = outer == left or left == right
                certain = not (overlaps or outer in self.lefts or left in self.rights)
                self._lose((right, outer), number, certain)
                self._gain((piece, outer), number, certain)
                if overlaps:
                    self._gain((piece, piece), number, False)
        self.taken.add(pair)
        self.lefts.add(left)
        self.rights.add(right)

    def _lose(self, pair: Pair, number: int, certain: bool) -> None:
        if pair in self.high:
            self.low[pair] -= number
            if certain:
                self.high[pair] -= number
                heapq.heappush(self.queue, (merge_order(pair, self.high[pair]), pair))

    def _gain(self, pair: Pair, number: int, certain: bool) -> None:
        if len(pair[0]) + len(pair[1]) <= self.max_piece_length:
            self.high[pair] = self.high.get(pair, 0) + number
            self.low[pair] = self.low.get(pair, 0) + (number if certain else 0)
            heapq.heappush(self.queue, (merge_order(pair, self.high[pair]), pair))
