"""Bin completion: a branch and bound that packs counted sizes into as few bins as it can.

Bins are filled one after the other around the largest size left. Its undominated fillings are enumerated, the
least waste first: a filling is dominated if one size that is left could take the place of some of its members, or
be added. Where the exact complement of the largest size is left, it dominates every other filling and there
is no choice. A branch is cut when the bins it has used and a lower bound for the sizes left reach the
incumbent; lower bounds are the whole waste (sum of sizes over capacity) and the bound that sets large sizes, which
share no bin, apart. Incumbents are best-fit decreasing solutions, of the whole and of what branches leave.

Sizes come as counts, so that work depends on the number of different sizes and not on the number of
items. While more than `exact_items` items are left a filling is used as often as its sizes allow; below
that each bin is a choice of its own, and the search is complete if it ends within its nodes.
"""

import math
from itertools import combinations


def lower_bound(counts, capacity):
    """At least so many bins, for counts by size."""
    import numpy as np

    n = np.zeros(capacity + 1, np.int64)
    for size, count in counts.items():
        n[size] = count
    size = np.arange(capacity + 1)
    best = -(-int((n * size).sum()) // capacity)
    many, whole = np.append(0, np.cumsum(n)), np.append(0, np.cumsum(n * size))  # of sizes below
    half = capacity // 2
    at = np.arange(half + 1)
    alone = many[-1] - many[np.maximum(capacity - at + 1, half + 1)]  # too large for any of at and more
    shared = many[-1] - many[half + 1] - alone
    room = shared * capacity - (whole[np.maximum(capacity - at + 1, half + 1)] - whole[half + 1])
    small = whole[half + 1] - whole[at]
    return max(best, int((alone + shared + np.maximum(0, -(-(small - room) // capacity))).max()))


def best_fit(counts, capacity):
    """Best-fit decreasing over counts: a list of (filling, bins), a filling being ((size, uses), ...)."""
    open_bins = {}  # room -> list of [filling, bins]
    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left:
            room = min((r for r in open_bins if r >= size), default=None)
            if room is None:
                uses = min(capacity // size, left)
                bins = left // uses
                open_bins.setdefault(capacity - uses * size, []).append([((size, uses),), bins])
                left -= bins * uses
                continue
            groups = open_bins[room]
            filling, bins = groups.pop()
            uses = min(room // size, left)
            taken = min(bins, left // uses)
            if taken < bins:
                groups.append([filling, bins - taken])
            if not groups:
                del open_bins[room]
            open_bins.setdefault(room - uses * size, []).append([(*filling, (size, uses)), taken])
            left -= taken * uses
    return [(filling, bins) for groups in open_bins.values() for filling, bins in groups]


def _dominated(filling, slack, sizes):
    """Whether a single size that is left, but not in the filling, could replace one or more members."""
    for width in range(1, min(len(filling), 3) + 1):
        for members in combinations(filling, width):
            total = sum(members)
            if any((y > total or width > 1) and y in sizes for y in range(total, total + slack + 1)):
                return True
    return False


def _few_sizes(counts, room, steps):
    """All maximal fillings of the room, as falling sizes, while the steps last."""
    sizes, found = sorted(counts, reverse=True), []

    def go(at, room, chosen):
        nonlocal steps
        steps -= 1
        fits = False
        for n in range(at, len(sizes)):
            size = sizes[n]
            if size <= room and chosen.count(size) < counts[size]:
                fits = True
                go(n, room - size, [*chosen, size])
                if steps <= 0:
                    return
        if not fits and not any(s <= room and chosen.count(s) < counts[s] for s in sizes[:at]):
            found.append(tuple(chosen))

    go(0, room, [])
    return found


def _many_sizes(counts, room, width):
    """Fillings of up to three sizes and what still fits, the least waste and the largest sizes first."""
    import numpy as np

    left = np.zeros(room + 1, np.int64)
    for size, count in counts.items():
        if size <= room:
            left[size] = count
    sizes = np.flatnonzero(left)[::-1]
    if not len(sizes):
        return [()]
    floor = np.maximum.accumulate(np.where(left > 0, np.arange(room + 1), 0))
    second = floor[np.minimum(sizes, room - sizes)]
    second = np.where((second == sizes) & (left[sizes] < 2), floor[np.maximum(second - 1, 0)], second)
    waste = room - sizes - second
    chosen = [(int(sizes[n]), int(second[n])) for n in np.argsort(waste, kind="stable")[:width]]
    if waste.min() > 0:
        a, b = np.meshgrid(sizes, sizes, indexing="ij")
        fits = (b <= a) & (a + b <= room) & ((a != b) | (left[a] > 1))
        a, b = a[fits], b[fits]
        third = floor[np.minimum(b, room - a - b)]
        used = (third > 0) & (1 + (third == b) + ((third == a) & (third == b)) > left[third])
        third = np.where(used, floor[np.maximum(third - 1, 0)], third)
        waste = room - a - b - third
        chosen = [(int(a[n]), int(b[n]), int(third[n])) for n in np.argsort(waste, kind="stable")[:width]] + chosen
    out = []
    for members in chosen:
        members, rest = [m for m in members if m], room - sum(members)
        while rest and (size := int(floor[rest])):
            while size and members.count(size) >= left[size]:
                size = int(floor[size - 1])
            if not size:
                break
            members.append(size)
            rest -= size
        out.append(tuple(sorted(members, reverse=True)))
    return out


def fillings(counts, room, width=6, steps=3000, few=40):
    """Undominated fillings of the room beside the largest size, least waste first, at most `width` of them."""
    if room in counts:
        return [(room,)]
    sizes = {s for s in counts if s <= room}
    if len(sizes) <= few:
        found = _few_sizes({s: counts[s] for s in sizes}, room, steps)
    else:
        found = _many_sizes(counts, room, 4 * width)
    ranked = sorted(set(found), key=lambda f: (room - sum(f), [-s for s in f]))
    kept = []
    for filling in ranked:
        spare = {s for s in sizes if counts[s] > filling.count(s)}
        if not _dominated(filling, room - sum(filling), spare):
            kept.append(filling)
            if len(kept) == width:
                break
    return kept or ranked[:1]


def complete(counts, capacity, nodes=5000, exact_items=60, width=6, tries=40):
    """(plan, lower bound): a list of (filling, bins) for counts by size, and how few bins there can be at least.

    `nodes` bounds the search (choices without alternative count too), `width` the fillings tried per node (complete below `exact_items` with a large one),
    `tries` the best-fit incumbents taken on the way.
    """
    counts = {s: n for s, n in counts.items() if n}
    if any(s < 1 or s > capacity for s in counts):
        raise ValueError("a size is outside the capacity")
    bound = lower_bound(counts, capacity)
    plan = best_fit(counts, capacity)
    most = sum(bins for _, bins in plan)
    # A depth-first search without recursion: each entry is (counts left, bins used, choices so far).
    stack = [(counts, 0, None)]
    while stack and nodes > 0 and most > bound:
        left, used, chosen = stack.pop()
        while left and nodes > 0:
            nodes -= 1
            largest = max(left)
            rest = dict(left)
            rest[largest] -= 1
            if not rest[largest]:
                del rest[largest]
            items = sum(left.values())
            options = fillings(rest, capacity - largest, width if items > exact_items else 10 * width)
            if len(options) > 1:
                break
            left, used, chosen = _used(left, largest, options[0], used, chosen, items > exact_items)
        if not left:
            if used < most:
                most, plan = used, _listed(chosen)
            continue
        if len(options) < 2:  # out of nodes
            break
        if used + lower_bound(left, capacity) >= most:
            continue
        if tries:
            tries -= 1
            quick = best_fit(left, capacity)
            if used + sum(bins for _, bins in quick) < most:
                most, plan = used + sum(bins for _, bins in quick), _listed(chosen) + quick
        for filling in reversed(options):
            stack.append(_used(left, largest, filling, used, chosen, items > exact_items))
    return plan, bound


def _used(left, largest, filling, used, chosen, often):
    """The state after one bin, or as many bins as the sizes allow, with this filling."""
    members = {}
    for size in (largest, *filling):
        members[size] = members.get(size, 0) + 1
    bins = min(left[s] // n for s, n in members.items()) if often else 1
    rest = dict(left)
    for size, n in members.items():
        rest[size] -= bins * n
        if not rest[size]:
            del rest[size]
    return rest, used + bins, (chosen, (tuple(sorted(members.items(), reverse=True)), bins))


def _listed(chosen):
    out = []
    while chosen:
        chosen, step = chosen
        out.append(step)
    return out[::-1]


def gap(plan, capacity):
    """Share of the packed room that is empty."""
    bins = sum(n for _, n in plan)
    filled = sum(n * sum(s * u for s, u in filling) for filling, n in plan)
    return 1 - filled / (bins * capacity) if bins else math.nan
