"""Passages two texts share: sampled seeds of their words, chains of seeds through a Fenwick tree, alignment of the chains.

Everything here works on texts as arrays of 32-bit word hashes and knows nothing of Spark.
"""
from __future__ import annotations

import numpy as np
import xxhash

#: Words of a seed; of all seeds about one in ``SAMPLED`` counts, told by its own hash, so that both texts choose alike, and where
#: ``FILL`` neighbours in a row don't count the least of them does.
KMER, SAMPLED, FILL = 5, 4, 16
#: So many neighbouring seeds are a key of their own: other texts that hold lines of a passage seldom hold its line borders.
RUN = 3
MIN_WORDS, SIMILARITY = 50, 0.8
#: Matched words that a passage of MIN_WORDS words at SIMILARITY has; changed words at its ends can't be told from its surroundings.
MIN_MATCHED = 40
GAP_COST, MAX_GAP, MAX_SHIFT = 0.1, 40, 20
#: A chain is followed if its seeds and runs span so many words.
SPAN = 11
#: Words carried on both sides of a chain for its extension; the extension ends once it has lost so much.
MARGIN, DROP = 64, 8.0
#: Stretches are first taken so that no part of them falls below this similarity, since changed words may lie close together.
LENIENT = 0.7
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_MIX = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F)]
_SALT = np.uint64(0x5555555555555555)


def word_hashes(text: str) -> np.ndarray:
    """A number of 32 bits for each word, lower-cased in A-Z, divided by ASCII white space."""
    h = xxhash.xxh32_intdigest
    return np.array([h(w) for w in text.encode("utf-8", "surrogatepass").translate(_LOWER).split()], np.uint32)


def _finished(h: np.ndarray) -> np.ndarray:
    h ^= h >> np.uint64(31)
    h *= _MIX[1]
    h ^= h >> np.uint64(29)
    h *= _MIX[2]
    return h ^ h >> np.uint64(32)


def seeds(words: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, text index, word index) of the seeds of texts that lie one after another in ``words``, in their order."""
    n = len(words) - KMER + 1
    none = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    if n <= 0:
        return none
    owner = np.repeat(np.arange(len(sizes)), sizes)
    x = words.astype(np.uint64)
    h = np.zeros(n, np.uint64)
    for i in range(KMER):
        h += (x[i:i + n] + np.uint64(1)) * _MIX[i]
        h ^= h >> np.uint64(27 + i)
    h = _finished(h)
    whole = owner[:n] == owner[KMER - 1:]
    chosen = np.flatnonzero(whole & (h % np.uint64(SAMPLED) == 0))
    # Where too many in a row don't count: runs of neighbours inside one text.
    at = np.flatnonzero(whole)
    marks = np.zeros(n, bool)
    marks[chosen] = True
    free = at[~marks[at]]
    cuts = np.flatnonzero((np.diff(free) != 1) | (owner[free[1:]] != owner[free[:-1]])) + 1
    starts, ends = np.append(0, cuts), np.append(cuts, len(free))
    extra = []
    for a, b in zip(starts[ends - starts >= FILL], ends[ends - starts >= FILL], strict=True):
        stretch = h[free[a:b]]
        least = np.lib.stride_tricks.sliding_window_view(stretch, FILL).argmin(axis=1) + np.arange(b - a - FILL + 1)
        extra.append(free[a] + np.unique(least))
    if extra:
        chosen = np.sort(np.concatenate([chosen, *extra]))
    first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    return h[chosen], owner[chosen], chosen - first[owner[chosen]]


def keys(words: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, text index, word index, words) of seeds and of runs of RUN neighbouring seeds, which have a hash of their own, told
    by its last bit, begin where their first seed does and reach to the end of their last one."""
    h, who, pos = seeds(words, sizes)
    one, size = np.uint64(1), np.full(len(h), KMER)
    if len(h) < RUN:
        return h & ~one, who, pos, size
    ends = len(h) - RUN + 1
    run = np.full(ends, _SALT)
    for i in range(RUN):
        run = _finished((run ^ h[i:i + ends]) * _MIX[3])
    same = who[:ends] == who[RUN - 1:]
    return (np.concatenate([h & ~one, run[same] | one]), np.concatenate([who, who[:ends][same]]), np.concatenate([pos, pos[:ends][same]]),
            np.concatenate([size, (pos[RUN - 1:] - pos[:ends] + KMER)[same]]))


def chains(matches: list[tuple[int, int]]) -> list[list[tuple[int, int]]]:
    """Disjoint chains of matches rising on both sides, best first.

    A match is worth KMER words; a step costs GAP_COST per word it passes on either side, halved. The best predecessor is a
    prefix maximum over source positions, kept in a Fenwick tree. Chains are cut at wide or lopsided steps.
    """
    matches = sorted(set(matches))
    rank = {s: i + 1 for i, s in enumerate(sorted({s for _, s in matches}))}
    tree: list[tuple[float, int]] = [(0.0, -1)] * (len(rank) + 1)
    score, before, waiting = [], [], []
    for j, (p, s) in enumerate(matches):
        if waiting and matches[waiting[0]][0] < p:
            for i in waiting:
                entry, at = (score[i] + GAP_COST * sum(matches[i]) / 2, i), rank[matches[i][1]]
                while at < len(tree):
                    if entry > tree[at]:
                        tree[at] = entry
                    at += at & -at
            waiting = []
        best, at = (0.0, -1), rank[s] - 1
        while at:
            if tree[at] > best:
                best = tree[at]
            at -= at & -at
        gain = best[0] - GAP_COST * (p + s) / 2
        score.append(KMER + max(0.0, gain))
        before.append(best[1] if best[1] >= 0 and gain > 0 else -1)
        waiting.append(j)
    used, out = [False] * len(matches), []
    for j in sorted(range(len(matches)), key=lambda i: -score[i]):
        run = []
        while j >= 0 and not used[j]:
            used[j] = True
            run.append(matches[j])
            j = before[j]
        piece: list[tuple[int, int]] = []
        for m in reversed(run):
            if piece and (max(m[0] - piece[-1][0], m[1] - piece[-1][1]) > MAX_GAP or abs(m[0] - piece[-1][0] - m[1] + piece[-1][1]) > MAX_SHIFT):
                out.append(piece)
                piece = []
            piece.append(m)
        if piece:
            out.append(piece)
    return out


def _agree(a: np.ndarray, b: np.ndarray, i: int, j: int) -> int:
    """Equal words from a[i] and b[j] on."""
    n, most = 0, min(len(a) - i, len(b) - j)
    while n < most:
        step = min(32, most - n)
        differ = (a[i + n:i + n + step] != b[j + n:j + n + step]).nonzero()[0]
        if len(differ):
            return n + int(differ[0])
        n += step
    return n


def _furthest(a: np.ndarray, b: np.ndarray, whole: bool, least: float = SIMILARITY) -> tuple[int, int, int]:
    """Align from the start of both sides, edit by edit, furthest word first on each diagonal.

    A match is worth 2 (1 - least), an unmatched word of either side costs ``least``. ``whole``: to the end of both, else to
    the best end, given up once DROP is lost. Returns (i, j, matched).
    """
    worth = 2 * (1 - least)
    front = {0: (0, 0)}  # diagonal j - i: (i, matched)
    best, seen = (0.0, 0, 0, 0), 0.0
    for _ in range(len(a) + len(b) + 1):
        reached: dict[int, tuple[int, int]] = {}
        top = -1e9
        for d, (i, m) in front.items():
            n = _agree(a, b, i, i + d)
            i, m = i + n, m + n
            reached[d] = (i, m)
            score = worth * m - least * (2 * i + d - 2 * m)
            top = max(top, score)
            if score > best[0]:
                best = (score, i, i + d, m)
            if whole and i == len(a) and i + d == len(b):
                return i, i + d, m
        seen = max(seen, top)
        if not whole and top < seen - DROP:
            break
        front = {}
        for d, (i, m) in reached.items():
            if not whole and worth * m - least * (2 * i + d - 2 * m) < seen - DROP:
                continue
            for d2, i2 in ((d, i + 1), (d + 1, i), (d - 1, i + 1)):
                if i2 <= len(a) and 0 <= i2 + d2 <= len(b) and (d2 not in front or front[d2] < (i2, m)):
                    front[d2] = (i2, m)
        if not front:
            break
    return best[1:]


def _stretches(gains: list[float]) -> list[tuple[int, int]]:
    """All maximal stretches (first step, step behind the last) of steps: each sums to more than any part or neighbour of it
    leaves out. One pass; stretches are merged while that raises them."""
    kept: list[tuple[int, int, float, float]] = []  # with the sums before and behind them
    total = 0.0
    for k, gain in enumerate(gains):
        low, total = total, total + gain
        if gain <= 0:
            continue
        piece = (k, k + 1, low, total)
        while True:
            j = len(kept) - 1
            while j >= 0 and kept[j][2] >= piece[2]:
                j -= 1
            if j < 0 or kept[j][3] >= piece[3]:
                kept.append(piece)
                break
            piece = (kept[j][0], piece[1], kept[j][2], piece[3])
            del kept[j:]
    return [(lo, hi) for lo, hi, _, _ in kept]


def align(a: np.ndarray, b: np.ndarray, anchors: list[tuple[int, int]], least: float = LENIENT) -> list[tuple[int, int, int, int, int]]:
    """Passages (start, end, source start, source end, matched words) of a chain, long and similar enough.

    Words from one anchor to the next are aligned; stretches of the chain are kept whose matched words outweigh the others, and
    both ends are extended as long as that pays. What then has MIN_MATCHED matched words and SIMILARITY (twice the matched
    words by the words of both sides) is a passage. A long stretch that is not similar enough is divided by the stricter measure.
    """
    worth = 2 * (1 - least)
    steps = []  # matched and unmatched words of each anchor's first word up to the next anchor
    for (p, s), (q, t) in zip(anchors, anchors[1:], strict=False):
        x, y = a[p:q], b[s:t]
        m = len(x) if len(x) == len(y) and (x == y).all() else _furthest(x, y, True)[2]
        steps.append((m, len(x) + len(y) - 2 * m))
    kept = _stretches([worth * m - least * u for m, u in steps])
    covered = [False] * len(anchors)
    for lo, hi in kept:
        covered[lo:hi + 1] = [True] * (hi + 1 - lo)
    out: list[tuple[int, int, int, int, int]] = []
    for lo, hi in sorted(kept + [(k, k) for k, c in enumerate(covered) if not c]):
        (p, s), (q, t) = anchors[lo], anchors[hi]
        if out and p < out[-1][1]:
            continue  # the passage before has grown over it
        i, j, left = _furthest(a[:p][::-1], b[:s][::-1], False, least)
        e, f, right = _furthest(a[q:], b[t:], False, least)
        start, end, s_start, s_end = p - i, q + e, s - j, t + f
        matched = left + right + sum(m for m, _ in steps[lo:hi])
        if matched < MIN_MATCHED:
            continue
        if 2 * matched >= SIMILARITY * (end - start + s_end - s_start):
            out.append((start, end, s_start, s_end, matched))
        elif least < SIMILARITY:
            out += align(a, b, anchors[lo:hi + 1], SIMILARITY)
    return out


def worth_following(chain: list[tuple[int, int]], reach: dict[tuple[int, int], int]) -> bool:
    """Whether the seeds and runs of a chain span so many words that it can be part of a passage."""
    return max(m[0] + reach[m] for m in chain) - chain[0][0] >= SPAN
