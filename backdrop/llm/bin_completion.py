"""Bin completion by branch and bound, on counts of lengths.

Packing depends on the lengths alone, and there are at most ``capacity`` of
them, so the search works on how many pieces have each length: its input has
one size whatever the corpus. Its result is a list of patterns: so many bins,
each with these lengths.

Best-fit decreasing gives the first incumbent. The search then fills one bin
after another around the largest piece that is left. It branches over the
undominated fillings of the rest of that bin: a filling is dominated when some
of its pieces can be exchanged for one larger piece that still fits (what then
stays outside fits wherever the larger piece would have). A filling is taken for
as many bins as the counts allow, or else for one. A branch is cut off when
its waste so far, or the lower bound of what is left, reaches the incumbent.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

# So many bins, each with the pieces (length, how many).
Pattern = tuple[int, tuple[tuple[int, int], ...]]

# Bins that the search opens, and fillings that it looks at for one bin. The
# incumbent stands when they are used up.
SEARCH_NODES = 5_000
FILLINGS = 50
# Partial fillings that are looked at for each filling.
STEPS = 10


def lower_bound(counts: np.ndarray) -> int:
    """Bins that pieces of these counts need at least (Martello and Toth's L2); counts[length], capacity is the last length.

    For every a: pieces over capacity - a stand alone, those over half a bin
    each take one, and those of a to half a bin fill what these leave.
    """
    capacity = len(counts) - 1
    n = np.concatenate([[0], np.cumsum(counts)])  # pieces shorter than i
    size = np.concatenate([[0], np.cumsum(counts * np.arange(capacity + 1))])
    half = capacity // 2
    a = np.arange(half + 1)
    alone = n[-1] - n[capacity - a + 1]
    paired = n[capacity - a + 1] - n[half + 1]
    room = paired * capacity - (size[capacity - a + 1] - size[half + 1])
    rest = size[half + 1] - size[a]
    return int((alone + paired + np.maximum(0, -((room - rest) // capacity))).max())


def best_fit(counts: np.ndarray) -> list[Pattern]:
    """Best-fit decreasing, for all equal bins at once."""
    capacity = len(counts) - 1
    # Bins of equal residue, with the pieces that each group of them holds.
    open_bins: dict[int, list[tuple[int, tuple]]] = {capacity: []}
    for length in np.flatnonzero(counts)[::-1].tolist():
        left = int(counts[length])
        # Best fit goes on filling the bin it chose while the length fits.
        for residue in sorted(r for r in open_bins if r >= length):
            while left and open_bins[residue]:
                bins, held = open_bins[residue].pop()
                left -= _fill(open_bins, residue, bins, held, length, left)
            if not left:
                break
        if left:
            _fill(open_bins, capacity, left, (), length, left)
    return [(bins, held) for groups in open_bins.values() for bins, held in groups if held]


def _fill(open_bins: dict, residue: int, bins: int, held: tuple, length: int, left: int) -> int:
    """Put up to ``left`` pieces into ``bins`` equal bins one bin after another; the number placed."""
    each = residue // length
    full = min(bins, left // each)
    some = left - full * each if full < bins else 0
    for n, k in ((full, each), (1 if some else 0, some), (bins - full - (1 if some else 0), 0)):
        if n:
            to = residue - k * length
            open_bins.setdefault(to, []).append((n, (*held, (length, k)) if k else held))
    return full * each + some


def fillings(counts: np.ndarray, room: int, most: int = FILLINGS) -> list[tuple[int, ...]]:
    """Undominated fillings of ``room`` from the counts, least waste first; of the first ``most`` that are found."""
    left = counts[: room + 1].tolist()
    found: list[tuple[int, ...]] = []
    looked = 0

    def extend(taken: tuple[int, ...], room: int, top: int) -> Iterator[tuple[int, ...]]:
        nonlocal looked
        looked += 1
        if room and room <= top and left[room]:
            yield (*taken, room)  # one piece that fills the rest dominates every other way
            return
        fits = False
        for x in range(min(room, top), 0, -1):
            if left[x]:
                fits = True
                left[x] -= 1
                yield from extend((*taken, x), room - x, x)
                left[x] += 1
                if looked > STEPS * most:
                    break
        if not fits:
            yield taken

    for f in extend((), room, room):
        found.append(f)
        if len(found) >= most or looked > STEPS * most:
            break
    have = sum(1 << y for y in range(1, room + 1) if left[y])
    kept = [f for f in dict.fromkeys(found) if not _dominated(f, left, have, room)]
    return sorted(kept or found[:1], key=lambda f: (room - sum(f), [-x for x in f]))


def _smear(bits: int, reach: int) -> int:
    """``bits`` moved up by 0 to ``reach`` places, all together."""
    done = 0
    while done < reach:
        step = min(done + 1, reach - done)
        bits |= bits << step
        done += step
    return bits


def _dominated(filling: tuple[int, ...], left: list[int], have: int, room: int) -> bool:
    """Whether one larger piece could stand for some pieces of the filling, within its waste; bit y of ``have``: a piece y is left."""
    waste = room - sum(filling)
    several, one = 0, 0  # bit s: some two or more pieces, or one piece, sum to s
    for x in filling:
        several |= (several | one) << x
        one |= 1 << x
        if left[x] == filling.count(x):
            have &= ~(1 << x)
    # A piece as long as one of the filling's is no gain; one as long as several is.
    return bool(have & (_smear(several, waste) | (_smear(one, waste - 1) << 1 if waste else 0)))


def solve(counts: np.ndarray, nodes: int = SEARCH_NODES) -> list[Pattern]:
    """Patterns that hold all pieces in as few bins as the search finds; counts[length] up to the capacity.

    Gives the best-fit packing at once where it meets the lower bound.
    """
    counts = np.asarray(counts, np.int64)
    capacity = len(counts) - 1
    best = best_fit(counts)
    fewest = sum(n for n, _ in best)
    if fewest == lower_bound(counts):
        return best
    total = int((counts * np.arange(capacity + 1)).sum())

    def choices(counts: np.ndarray, waste: int) -> Iterator[tuple[int, tuple[int, ...], int]]:
        """(bins, pieces of a bin, waste of a bin) around the largest piece."""
        top = int(np.flatnonzero(counts)[-1])
        counts[top] -= 1
        found = fillings(counts, capacity - top)
        counts[top] += 1
        for f in found:
            pieces = (top, *f)
            lost = capacity - sum(pieces)
            most = min(int(counts[x]) // pieces.count(x) for x in set(pieces))
            for n in dict.fromkeys((most, 1)):
                # Within the waste that a packing with one bin fewer than the incumbent may have.
                if waste + n * lost <= (fewest - 1) * capacity - total:
                    yield n, pieces, lost

    state = counts.copy()
    path: list[tuple[int, tuple[int, ...], int]] = []
    stack = [choices(state, 0)]
    used, waste = 0, 0
    while stack and nodes > 0:
        step = next(stack[-1], None)
        if step is None:
            stack.pop()
            if path:
                n, pieces, lost = path.pop()
                used, waste = used - n, waste - n * lost
                for x in pieces:
                    state[x] += n
            continue
        nodes -= 1
        n, pieces, lost = step
        if waste + n * lost > (fewest - 1) * capacity - total:
            continue
        for x in pieces:
            state[x] -= n
        if used + n + lower_bound(state) < fewest:
            used, waste = used + n, waste + n * lost
            path.append(step)
            if state.any():
                stack.append(choices(state, waste))
                continue
            best = [(m, tuple((x, p.count(x)) for x in dict.fromkeys(p))) for m, p, _ in path]
            fewest = used
            if fewest == lower_bound(counts):
                return best
            path.pop()
            used, waste = used - n, waste - n * lost
        for x in pieces:
            state[x] += n
    return best
