"""External induced suffix sorting with common prefixes, for one shard of a task.

The suffixes of a shard are sorted by induction. Suffixes that are smaller than
their successor (S) with a larger one before them are the stars. The stars are sorted
by naming the pieces between them and sorting the text of names the same way, one
recursion deeper, until all names differ. From the sorted stars a queue induces all
suffixes larger than their successor (L), and from those a second queue induces the S.

What grows with the shard is on disk: once a sort holds ``MEMORY`` bytes, further arrays
are files mapped into memory block by block, and the queues keep at most ``limit``
tuples before they write their buckets out. A queue is a priority queue for keys that never fall below the one
taken last: its buckets are ranges of first characters, each in order of arrival. On
the text itself a tuple is a suffix and the length it has in common with the tuple
before it in its bucket (up to ``cap``); in the text of names the suffix and its name.

Scratch files belong to one task and vanish with it; a task that is lost starts again.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np

BLOCK = 1 << 18
LIMIT = 1 << 21
MEMORY = 128 << 20
SLOTS = 512


class Scratch:
    """The arrays of one sort: in memory up to ``memory`` bytes, then files below ``folder``."""

    def __init__(self, folder: str, memory: int | None = None) -> None:
        self.folder, self.made, self.left = folder, 0, MEMORY if memory is None else memory

    def path(self) -> str:
        self.made += 1
        return os.path.join(self.folder, f"{self.made}.bin")

    def array(self, n: int, dtype: type) -> np.ndarray:
        size = n * np.dtype(dtype).itemsize
        if size <= self.left:
            self.left -= size
            return np.zeros(n, dtype=dtype)
        return np.memmap(self.path(), dtype=dtype, mode="w+", shape=max(n, 1))[:n]


class BucketQueue:
    """Rows of numbers in buckets, first in first out; buckets in memory are written out beyond ``limit`` rows."""

    def __init__(self, scratch: Scratch, buckets: int, width: int, limit: int = LIMIT) -> None:
        self.scratch, self.width, self.limit, self.held = scratch, width, limit, 0
        self.parts: list[list[np.ndarray]] = [[] for _ in range(buckets)]
        self.files: list[list | None] = [None] * buckets  # path, rows read

    def push(self, bucket: np.ndarray, rows: np.ndarray) -> None:
        """Appends rows to their buckets; equal buckets stand together, in the order of arrival."""
        if not len(bucket):
            return
        edges = np.flatnonzero(bucket[1:] != bucket[:-1]) + 1
        for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(bucket)]):
            self.parts[bucket[a]].append(rows[a:b])
        self.held += len(rows)
        if self.held > self.limit:
            self._write_out()

    def _write_out(self) -> None:
        for b, parts in enumerate(self.parts):
            if parts:
                if self.files[b] is None:
                    self.files[b] = [self.scratch.path(), 0]
                with open(self.files[b][0], "ab") as out:
                    out.write(np.concatenate(parts).astype(np.int64).tobytes())
                self.parts[b] = []
        self.held = 0

    def pop(self, b: int) -> np.ndarray | None:
        """The next rows of a bucket, in the order of arrival; None if there are none now."""
        if self.files[b] is not None:
            path, done = self.files[b]
            with open(path, "rb") as raw:
                raw.seek(done * 8 * self.width)
                rows = np.frombuffer(raw.read(BLOCK * 8 * self.width), dtype=np.int64).reshape(-1, self.width)
            if len(rows):
                self.files[b][1] += len(rows)
                return rows
            os.remove(path)
            self.files[b] = None
        if self.parts[b]:
            rows = np.concatenate(self.parts[b])
            self.parts[b] = []
            self.held -= len(rows)
            return rows
        return None


def blocks(n: int, size: int = 0) -> Iterator[tuple[int, int]]:
    size = size or BLOCK
    for a in range(0, n, size):
        yield a, min(n, a + size)


def find_stars(text: np.ndarray, scratch: Scratch) -> np.ndarray:
    """The positions of the stars in the order of the text. The last character is the smallest and stands once."""
    n = len(text)
    found, chunks = 0, []
    after_char, after_small = None, True  # of the character behind the block
    for a, b in reversed(list(blocks(n - 1))):
        chars = np.asarray(text[a : b + 1]).astype(np.int64)
        # equal neighbours have the type of the end of their run
        differ = np.append(chars[1:] != chars[:-1], True)
        small = np.append(chars[:-1] < chars[1:], after_small)
        at = np.flatnonzero(differ)
        small = np.repeat(small[at], np.diff(np.append(-1, at)))
        before_larger = small[1:] & (chars[:-1] > chars[1:])
        part = a + 1 + np.flatnonzero(before_larger)
        chunks.append(part)
        found += len(part)
        after_small = bool(small[0])
    stars = scratch.array(found, np.int64)
    end = 0
    for part in reversed(chunks):
        stars[end : end + len(part)] = part
        end += len(part)
    return stars


def packed(text: np.ndarray, begin: np.ndarray, end: np.ndarray, depth: int, bits: int, count: int) -> np.ndarray:
    """``count`` characters of each piece from ``depth`` on in one number; the last one of a piece is marked."""
    key = np.zeros(len(begin), dtype=np.int64)
    for k in range(depth, depth + count):
        at = begin + k
        char = (np.asarray(text[np.minimum(at, len(text) - 1)]).astype(np.int64) << 1 | (at == end)) + 1
        key = (key << bits) | np.where(at <= end, char, 0)
    return key


def sort_pieces(text: np.ndarray, begin: np.ndarray, end: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of the pieces ``begin`` to ``end`` (both inside), and whether each differs from the one before.

    A piece that ends where an equal one goes on is the larger: its end is an S, the other's character an L.
    """
    count = max(1, 62 // bits)
    n = len(begin)
    order, group = np.arange(n), np.zeros(n, dtype=np.int64)  # group: place of the first of those still equal
    active, depth = order, 0
    while len(active):
        key = packed(text, begin[active], end[active], depth, bits, count)
        mine = np.lexsort((key, group[active])) if depth else np.argsort(key, kind="stable")
        active, key = active[mine], key[mine]
        old = group[active]
        new = np.append(True, (old[1:] != old[:-1]) | (key[1:] != key[:-1]))
        head = np.append(True, old[1:] != old[:-1])
        # the places of an old group are taken over in the new order
        first = np.flatnonzero(head)
        place = old + np.arange(len(active)) - np.repeat(first, np.diff(np.append(first, len(active))))
        order[place] = active
        starts = np.flatnonzero(new)
        sizes = np.diff(np.append(starts, len(active)))
        group[active] = np.repeat(place[starts], sizes)
        depth += count
        active = active[(np.repeat(sizes, sizes) > 1) & (begin[active] + depth <= end[active])]
    sorted_groups = group[order]
    return order, np.append(True, sorted_groups[1:] != sorted_groups[:-1])[:n]


def name_stars(text: np.ndarray, stars: np.ndarray, sigma: int, scratch: Scratch, limit: int) -> tuple[np.ndarray, int]:
    """The names of the pieces between stars in the order of the text, and how many differ.

    Pieces are dealt on disk by ranges of their first characters, so one range is sorted in memory at a time.
    """
    bits = int(2 * sigma + 2).bit_length()
    m = len(stars)
    names = scratch.array(m, np.int64)
    count = max(1, 62 // bits)

    def piece(a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        begin = np.asarray(stars[a:b])
        end = np.append(np.asarray(stars[a + 1 : b + 1]), begin[-1:] if b == m else begin[:0])
        return begin, end

    slots = int(min(SLOTS, m // 4096 + 1))
    edges = np.zeros(0, dtype=np.int64)
    if slots > 1:
        some = np.unique(np.linspace(0, m - 1, 64 * slots).astype(np.int64))
        begin = np.asarray(stars[some])
        end = np.asarray(stars[np.minimum(some + 1, m - 1)])
        keys = np.sort(packed(text, begin, end, 0, bits, count))
        edges = np.unique(keys[np.linspace(0, len(keys) - 1, slots + 1).astype(np.int64)[1:-1]])
    queue = BucketQueue(scratch, len(edges) + 1, 3, limit)
    for a, b in blocks(m):
        begin, end = piece(a, b)
        slot = np.searchsorted(edges, packed(text, begin, end, 0, bits, count), side="right")
        order = np.argsort(slot, kind="stable")
        queue.push(slot[order], np.stack((np.arange(a, b), begin, end), axis=1)[order])
    given = 0
    for slot in range(len(edges) + 1):
        parts = []
        while (rows := queue.pop(slot)) is not None:
            parts.append(rows)
        if parts:
            rows = np.concatenate(parts)
            order, new = sort_pieces(text, rows[:, 1], rows[:, 2], bits)
            names[rows[order, 0]] = given + np.cumsum(new) - 1
            given += int(new.sum())
    return names, given


def mirrored(text: np.ndarray, sigma: int, scratch: Scratch) -> np.ndarray:
    made = scratch.array(len(text), text.dtype)
    for a, b in blocks(len(text)):
        made[a:b] = sigma - 1 - text[a:b]
    return made


def induce_names(text: np.ndarray, seeds: np.ndarray, counts: np.ndarray, scratch: Scratch, limit: int) -> np.ndarray:
    """The suffixes not below their successor, sorted, from the sorted seeds; ``counts`` of each character."""
    sigma, n = len(counts), len(text)
    # ranges of characters of about a block of suffixes each
    width = np.cumsum(counts) // max(1, min(BLOCK, n // 4 + 1))
    slot_of = np.unique(width, return_inverse=True)[1]
    first_char = np.append(np.flatnonzero(np.append(True, slot_of[1:] != slot_of[:-1])), sigma)
    queue = BucketQueue(scratch, len(first_char) - 1, 2, limit)
    made, end = scratch.array(n, np.int64), 0
    item, seed, m = text.item, 0, len(seeds)
    held: list[int] = []
    for slot in range(len(first_char) - 1):
        low, high = int(first_char[slot]), int(first_char[slot + 1])
        buckets: list[list[int]] = [[] for _ in range(high - low)]
        while (rows := queue.pop(slot)) is not None:
            for char, pos in rows.tolist():
                buckets[char - low].append(pos)
        later_char: list[int] = []
        later: list[int] = []
        out: list[int] = []
        for c in range(low, high):
            bucket = buckets[c - low]
            for pos in bucket:  # grows while it is read
                if pos:
                    char = item(pos - 1)
                    if char >= c:
                        if char < high:
                            buckets[char - low].append(pos - 1)
                        else:
                            later_char.append(char), later.append(pos - 1)
            out += bucket
            buckets[c - low] = []
            while seed < m or held:
                if not held:
                    held = np.asarray(seeds[seed : seed + BLOCK])[::-1].tolist()
                    seed += len(held)
                if item(held[-1]) != c:
                    break
                pos = held.pop()
                if pos:
                    char = item(pos - 1)
                    if char > c:
                        if char < high:
                            buckets[char - low].append(pos - 1)
                        else:
                            later_char.append(char), later.append(pos - 1)
        made[end : end + len(out)] = out
        end += len(out)
        chars, rows = np.array(later_char, dtype=np.int64), np.array(later, dtype=np.int64)
        target = slot_of[chars] if len(chars) else chars
        order = np.argsort(target, kind="stable")
        queue.push(target[order], np.stack((chars, rows), axis=1)[order])
    return made[:end]


def range_minimum(values: np.ndarray) -> list[np.ndarray]:
    table = [values]
    while 2 << (len(table) - 1) <= len(values):
        half = 1 << (len(table) - 1)
        table.append(np.minimum(table[-1][:-half], table[-1][half:]))
    return table


def least(table: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The minimum of ``[a, b]`` of each pair; a <= b."""
    level = np.frexp((b - a + 1).astype(np.float64))[1] - 1
    made = np.empty(len(a), dtype=table[0].dtype)
    for k in np.unique(level):
        mine = np.flatnonzero(level == k)
        made[mine] = np.minimum(table[k][a[mine]], table[k][b[mine] + 1 - (1 << int(k))])
    return made


def run_lengths(text: np.ndarray, at: np.ndarray, cap: int) -> np.ndarray:
    """How often the character at each place stands from there on, up to ``cap``."""
    made = np.ones(len(at), dtype=np.int64)
    active = np.arange(len(at))
    for k in range(1, cap):
        beyond = np.minimum(at[active] + k, len(text) - 1)
        active = active[(at[active] + k < len(text)) & (text[beyond] == text[at[active]])]
        if not len(active):
            break
        made[active] += 1
    return made


def induce_text(
    text: np.ndarray, seeds: np.ndarray, common: np.ndarray, sigma: int, cap: int, scratch: Scratch, limit: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``induce_names``, block by block, with what each suffix has in common with the one before it.

    Also gives the last suffix of each character, -1 if it has none.

    A suffix shares one character more with its neighbour in the bucket than the
    suffixes that induced them share: the least common prefix since the last push.
    """
    n = len(text)
    queue = BucketQueue(scratch, sigma, 2, limit)
    made, shared, end = scratch.array(n, np.int64), scratch.array(n, np.int16), 0
    none = -1
    since = np.full(sigma, none, dtype=np.int64)  # least common prefix since the last push of a bucket
    newest = np.full(sigma, -1, dtype=np.int64)

    def push(pos: np.ndarray, lcp: np.ndarray, least_char: int) -> None:
        table = range_minimum(lcp)
        at = np.flatnonzero(pos > 0)
        char = np.asarray(text[pos[at] - 1]).astype(np.int64)
        good = char >= least_char
        at, char = at[good], char[good]
        order = np.argsort(char, kind="stable")
        at, char = at[order], char[order]
        if len(at):
            head = np.append(True, char[1:] != char[:-1])
            begin = np.where(head, 0, np.append(0, at[:-1] + 1))
            value = least(table, begin, at)
            value[head] = np.minimum(value[head], since[char[head]])
            value = np.where(head & (since[char] == none), 0, np.minimum(value + 1, cap))
        np.minimum(since, int(table[0].min()), out=since)
        if len(at):
            last = np.append(head[1:], True)
            tail = at[last] + 1
            rest = np.full(len(tail), cap, dtype=np.int64)
            inner = tail < len(pos)
            rest[inner] = least(table, tail[inner], np.full(int(inner.sum()), len(pos) - 1))
            since[char[last]] = rest
            queue.push(char, np.stack((pos[at] - 1, value), axis=1))

    # seeds stand in the order of their first character
    bound = np.zeros(sigma + 1, dtype=np.int64)
    for a, b in blocks(len(seeds)):
        bound[1:] += np.bincount(np.asarray(text[np.asarray(seeds[a:b])]), minlength=sigma)
    bound = np.cumsum(bound)
    for c in range(sigma):
        while (rows := queue.pop(c)) is not None:
            for a, b in blocks(len(rows)):
                pos, lcp = rows[a:b, 0], rows[a:b, 1]
                made[end : end + len(pos)], shared[end : end + len(pos)] = pos, lcp
                end += len(pos)
                push(pos, lcp, c)
                newest[c] = pos[-1]
        for a in range(int(bound[c]), int(bound[c + 1]), BLOCK):
            b = min(a + BLOCK, int(bound[c + 1]))
            pos, lcp = np.asarray(seeds[a:b]), np.asarray(common[a:b]).astype(np.int64)
            if a == bound[c]:
                lcp = lcp.copy()
                lcp[0] = 0 if newest[c] < 0 else run_lengths(text, np.array([newest[c], pos[0]]), cap).min()
            push(pos, lcp, c + 1)
    return made[:end], shared[:end], newest


def common_prefixes(text: np.ndarray, order: np.ndarray, cap: int, scratch: Scratch) -> np.ndarray:
    """The common prefix of each suffix with the one before it in the order, up to ``cap``."""
    made = scratch.array(len(order), np.int16)
    step = np.arange(8)
    for a, b in blocks(len(order), BLOCK // 8):
        mine = np.asarray(order[a:b])
        other = np.append(order[a - 1] if a else len(text) - 1, mine[:-1])
        value, active = np.zeros(len(mine), dtype=np.int64), np.arange(len(mine))
        while len(active):
            x = np.minimum(mine[active, None] + value[active, None] + step, len(text) - 1)
            y = np.minimum(other[active, None] + value[active, None] + step, len(text) - 1)
            same = (text[x] == text[y]) & (x != y)
            equal = np.where(same.all(axis=1), 8, same.argmin(axis=1))
            value[active] += equal
            active = active[(equal == 8) & (value[active] < cap)]
        made[a:b] = np.minimum(value, cap)
    return made


def star_order(text: np.ndarray, stars: np.ndarray, sigma: int, scratch: Scratch, limit: int) -> np.ndarray:
    """The stars in the order of their suffixes, by recursion over their names."""
    names, different = name_stars(text, stars, sigma, scratch, limit)
    m = len(stars)
    ordered = scratch.array(m, np.int64)
    if different == m:
        for a, b in blocks(m):
            ordered[np.asarray(names[a:b])] = stars[a:b]
        return ordered
    inner = sort_names(names, different, scratch, limit)
    for a, b in blocks(m):
        ordered[a:b] = stars[np.asarray(inner[a:b])]
    return ordered


def sort_names(text: np.ndarray, sigma: int, scratch: Scratch, limit: int = LIMIT) -> np.ndarray:
    """The suffix array of a text of names; its last name is the smallest and stands once."""
    n = len(text)
    counts = np.zeros(sigma, dtype=np.int64)
    for a, b in blocks(n):
        counts += np.bincount(text[a:b], minlength=sigma)
    stars = find_stars(text, scratch)
    ordered = star_order(text, stars, sigma, scratch, limit)
    large = induce_names(text, ordered, counts, scratch, limit)
    turned = mirrored(text, sigma, scratch)
    back = scratch.array(len(large), np.int64)
    back[:] = large[::-1]
    small = induce_names(turned, back, counts[::-1], scratch, limit)
    # of one character the L stand before the S; the last character is an S that nothing induces
    large_count, small_count = np.zeros(sigma, dtype=np.int64), np.zeros(sigma, dtype=np.int64)
    for part, count in ((large, large_count), (small, small_count)):
        for a, b in blocks(len(part)):
            count += np.bincount(np.asarray(text[np.asarray(part[a:b])]), minlength=sigma)
    starts = 1 + np.cumsum(large_count + small_count) - (large_count + small_count)
    result = scratch.array(n, np.int64)
    result[0] = n - 1
    for part, offset in ((large, starts), (small[::-1], starts + large_count)):
        seen = np.zeros(sigma, dtype=np.int64)
        seen = np.cumsum(large_count if part is large else small_count) - (large_count if part is large else small_count)
        for a, b in blocks(len(part)):
            mine = np.asarray(part[a:b])
            char = np.asarray(text[mine])
            result[offset[char] + np.arange(a, b) - seen[char]] = mine
    return result


def neighbours(
    text: np.ndarray, sigma: int, cap: int, scratch: Scratch, limit: int = LIMIT
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of (suffix, the suffix next to it in sorted order, their common prefix up to ``cap``).

    ``text`` holds numbers below ``sigma``; its last one is 0 and stands once, and
    stands in no pair. First come the L, then the S, then where they meet.
    """
    stars = find_stars(text, scratch)
    ordered = star_order(text, stars, sigma, scratch, limit)
    common = common_prefixes(text, ordered, cap, scratch)
    large, shared, last_large = induce_text(text, ordered, common, sigma, cap, scratch, limit)
    turned = mirrored(text, sigma, scratch)
    back, back_shared = scratch.array(len(large), np.int64), scratch.array(len(large), np.int16)
    back[:] = large[::-1]
    back_shared[1:] = shared[:0:-1]
    small, small_shared, last_small = induce_text(turned, back, back_shared, sigma, cap, scratch, limit)
    for found, prefix in ((large, shared), (small, small_shared)):
        for a, b in blocks(len(found)):
            first = max(a, 1)
            yield np.asarray(found[first:b]), np.asarray(found[first - 1 : b - 1]), np.asarray(prefix[first:b])
    both = np.flatnonzero((last_large >= 0) & (last_small[::-1] >= 0))
    one, other = last_large[both], last_small[::-1][both]
    yield one, other, np.minimum(run_lengths(text, one, cap), run_lengths(text, other, cap))
