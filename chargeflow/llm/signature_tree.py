"""Trees of token bitmaps over a collection of sets, traversed in pairs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Children of a node.
FAN = 8
LEAST_BITS = 2048
#: Node pairs, and pairs of sets, that are looked at together.
NODE_PAIRS, SET_PAIRS = 1 << 12, 1 << 13
#: Sets of a side, and tokens, of one product of membership matrices.
ROWS, COLUMNS = 256, 1 << 14


def bitmap(tokens: np.ndarray) -> np.ndarray:
    """A bit for each token's lowest digits: two bits a token at least, and so many
    that nodes of small sets can be told apart too."""
    bits = max(LEAST_BITS, 1 << (2 * len(tokens) - 1).bit_length())
    has = np.zeros(bits, bool)
    has[(tokens & np.uint64(bits - 1)).astype(np.int64)] = True
    return np.packbits(has, bitorder="little").view(np.uint64)


def folded(maps: np.ndarray, words: int) -> np.ndarray:
    """Bitmaps (rows) at a narrower width: tokens' digits modulo that width."""
    return np.bitwise_or.reduce(maps.reshape(len(maps), -1, words), axis=1)


class Forest:
    """Which sets are already linked."""

    def __init__(self, n: int):
        self.parent, self.merges = np.arange(n), 0

    def find(self, i: int) -> int:
        p = self.parent
        while p[i] != i:
            p[i] = p[p[i]]
            i = int(p[i])
        return i

    def merge(self, i: int, j: int) -> bool:
        a, b = self.find(i), self.find(j)
        if a != b:
            self.parent[max(a, b)] = min(a, b)
            self.merges += 1
        return a != b

    def roots(self) -> np.ndarray:
        p = self.parent
        while (q := p[p]).tobytes() != p.tobytes():
            p = q
        self.parent = p
        return p


class SignatureTree:
    """``FAN`` neighbours share a parent. A node holds the OR of its sets' token
    bitmaps, the range of their sizes, and the most tokens of one set that share
    a bit with another token of that set ("excess")."""

    def __init__(self, maps: np.ndarray, size: np.ndarray, at: np.ndarray):
        self.at = at  # of each leaf its set
        self.levels = [(maps, size, size, size - np.bitwise_count(maps).sum(1, dtype=np.int64))]

    def grow(self, levels: int) -> SignatureTree:
        while len(self.levels) < levels:
            m, lo, hi, ex = self.levels[-1]
            k = np.arange(0, len(lo), FAN)
            self.levels.append((np.bitwise_or.reduceat(m, k), np.minimum.reduceat(lo, k), np.maximum.reduceat(hi, k), np.maximum.reduceat(ex, k)))
        return self

    def folded(self, words: int) -> SignatureTree:
        """The same sets with narrower bitmaps."""
        maps, size = self.levels[0][:2]
        if maps.shape[1] == words:
            return self
        return SignatureTree(folded(maps, words), size, self.at)


def _height(n: int) -> int:
    levels = 1
    while n > 1:
        n, levels = -(-n // FAN), levels + 1
    return levels


def _possible(one: SignatureTree, two: SignatureTree, level: int, i: np.ndarray, j: np.ndarray, num: int, den: int) -> np.ndarray:
    """Whether nodes i and j can hold a pair at num/den: sizes within the ratio,
    and the largest overlap that the bitmaps allow, which is a token for each
    common bit and the excess, not below what the smallest sizes need."""
    (m, lo, hi, ex), (m2, lo2, hi2, ex2) = one.levels[level], two.levels[level]
    ok = (den * hi[i] >= num * lo2[j]) & (den * hi2[j] >= num * lo[i])
    i, j = i[ok], j[ok]
    most = np.empty(len(i), np.int64)
    step = max(1, (4 << 20) // (8 * m.shape[1]))
    for k in range(0, len(i), step):
        most[k : k + step] = np.bitwise_count(m[i[k : k + step]] & m2[j[k : k + step]]).sum(1, dtype=np.int64)
    most += np.minimum(ex[i], ex2[j])
    ok[ok] = (den + num) * most >= num * (lo[i] + lo2[j])
    return ok


def _traversed(one: SignatureTree, two: SignatureTree, num: int, den: int, forest: Forest | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of sets that the dual traversal of two trees (or of a tree with
    itself) cannot rule out, each once, in parts. The work list is walked in
    depth, so that it stays short. With ``forest``, node pairs whose sets are all
    linked already need no look."""
    top = max(_height(len(one.at)), _height(len(two.at)))
    one.grow(top), two.grow(top)
    same, seen, labels = one is two, -1, {}
    work = [(top - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while work:
        level, i, j = work.pop()
        if len(i) > NODE_PAIRS:
            work.append((level, i[NODE_PAIRS:], j[NODE_PAIRS:]))
            i, j = i[:NODE_PAIRS], j[:NODE_PAIRS]
        if forest is not None:
            if seen != forest.merges:
                seen, root = forest.merges, forest.roots()
                labels = {t: [(root[t.at], root[t.at])] for t in {one, two}}
            for t, ranges in labels.items():
                while len(ranges) <= level:
                    low, high = ranges[-1]
                    k = np.arange(0, len(low), FAN)
                    ranges.append((np.minimum.reduceat(low, k), np.maximum.reduceat(high, k)))
            (low, high), (low2, high2) = labels[one][level], labels[two][level]
            open_ = (low[i] != high[i]) | (low2[j] != high2[j]) | (low[i] != low2[j])
            i, j = i[open_], j[open_]
        ok = _possible(one, two, level, i, j, num, den)
        i, j = i[ok], j[ok]
        if not len(i):
            continue
        if not level:
            yield one.at[i], two.at[j]
            continue
        # To the children: each pair of theirs once, no set with itself.
        n, n2 = len(one.levels[level - 1][1]), len(two.levels[level - 1][1])
        a = (i[:, None] * FAN + np.repeat(np.arange(FAN), FAN)).ravel()
        b = (j[:, None] * FAN + np.tile(np.arange(FAN), FAN)).ravel()
        ok = (a < n) & (b < n2)
        if same:
            ok &= a <= b if level > 1 else a < b
        work.append((level - 1, a[ok], b[ok]))


def possible_pairs(maps: list[np.ndarray], size: np.ndarray, num: int, den: int, forest: Forest | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of sets, given by bitmaps and sizes, that can be at num/den, in parts.
    Sets with bitmaps of one width are a tree; a pair of trees is traversed on the
    narrower width. Memory is that of the bitmaps, whatever the largest set."""
    words = np.array([len(m) for m in maps])
    trees = []
    for w in np.unique(words):
        at = np.flatnonzero(words == w)
        m = np.stack([maps[k] for k in at])
        # Neighbours are of like size and share their lowest bits.
        class_ = np.floor(2 * np.log(size[at]) / np.log(max(1.01, den / num)))
        order = np.lexsort((size[at], m[:, 0].byteswap(), class_))
        trees.append(SignatureTree(m[order], size[at][order], at[order]))
    for k, one in enumerate(trees):
        if len(one.at) > 1:
            yield from _traversed(one, one, num, den, forest)
        for two in trees[k + 1 :]:
            if den * one.levels[0][1].max() >= num * two.levels[0][1].min():
                yield from _traversed(one, two.folded(one.levels[0][0].shape[1]), num, den, forest)


def _overlap(sets: list[np.ndarray], i: int, others: np.ndarray) -> np.ndarray:
    """Exact sizes of the intersections of set i with other sets."""
    own = sets[i]
    sizes = np.array([len(sets[j]) for j in others])
    flat = np.concatenate([sets[j] for j in others])
    at = np.searchsorted(own, flat)
    at[at == len(own)] = 0
    return np.add.reduceat((own[at] == flat).astype(np.int64), np.concatenate([[0], np.cumsum(sizes)[:-1]]))


def _products(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Exact sizes of the intersections of sets i with sets j, all of them, by
    products of membership matrices over the tokens that both sides have."""
    a, b = np.concatenate([sets[k] for k in i]), np.concatenate([sets[k] for k in j])
    both = np.intersect1d(a, b)
    out = np.zeros((len(i), len(j)), np.float32)

    def membership(flat: np.ndarray, at: np.ndarray, tokens: np.ndarray) -> np.ndarray:
        row = np.repeat(np.arange(len(at)), [len(sets[k]) for k in at])
        column = np.searchsorted(tokens, flat)
        column[column == len(tokens)] = 0
        ok = tokens[column] == flat
        m = np.zeros((len(at), len(tokens)), np.float32)
        m[row[ok], column[ok]] = 1
        return m

    for k in range(0, len(both), COLUMNS):
        tokens = both[k : k + COLUMNS]
        out += membership(a, i, tokens) @ membership(b, j, tokens).T
    return out.astype(np.int64)  # sizes below 2**24 are exact in each product


def overlaps(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Exact sizes of the intersections of the pairs. Where a part of the pairs is
    dense in two groups of sets, their product is taken, else pairs by themselves."""
    out = np.empty(len(i), np.int64)
    for at in range(0, len(i), SET_PAIRS * 8):
        part = slice(at, at + SET_PAIRS * 8)
        left, right = np.unique(i[part]), np.unique(j[part])
        x, y = np.searchsorted(left, i[part]), np.searchsorted(right, j[part])
        block = x // ROWS * (len(right) // ROWS + 1) + y // ROWS
        order = np.argsort(block, kind="stable")
        result = np.empty(len(x), np.int64)
        for chunk in np.split(order, np.flatnonzero(np.diff(block[order])) + 1):
            rows, columns = np.unique(x[chunk]), np.unique(y[chunk])
            if len(chunk) >= 64 and 8 * len(chunk) >= len(rows) * len(columns):
                table = _products(sets, left[rows], right[columns])
                result[chunk] = table[np.searchsorted(rows, x[chunk]), np.searchsorted(columns, y[chunk])]
            else:
                by = chunk[np.argsort(x[chunk], kind="stable")]
                for one in np.split(by, np.flatnonzero(np.diff(x[by])) + 1):
                    result[one] = _overlap(sets, int(left[x[one[0]]]), right[y[one]])
        out[part] = result
    return out


def _spanned(forest: Forest, i: np.ndarray, j: np.ndarray) -> list[tuple[int, int]]:
    """Merges pairs into the forest; those that linked something new."""
    root = forest.roots()
    a, b = np.minimum(root[i], root[j]), np.maximum(root[i], root[j])
    first = np.unique(a * len(root) + b, return_index=True)[1]
    first = first[a[first] != b[first]]
    return [(x, y) for x, y in zip(i[first].tolist(), j[first].tolist()) if forest.merge(x, y)]


def possible_links(maps: list[np.ndarray], size: np.ndarray, num: int, den: int, side: np.ndarray | None = None) -> list[tuple[int, int]]:
    """As many pairs that bitmaps and sizes cannot rule out as span the groups that
    all such pairs link. ``side``: only pairs of two sides count."""
    forest, links = Forest(len(maps)), []
    for i, j in possible_pairs(maps, size, num, den, forest):
        if side is not None:
            ok = side[i] != side[j]
            i, j = i[ok], j[ok]
        links += _spanned(forest, i, j)
    return links


def linked_pairs(
    sets: list[np.ndarray], num: int, den: int, side: np.ndarray | None = None, counts: np.ndarray | None = None, weights: np.ndarray | None = None
) -> list[tuple[int, int]]:
    """Pairs of sets with den * intersection >= num * union, as many as span the
    groups that all such pairs link: a pair in one group already isn't looked at.
    The sets are sorted, distinct, not empty. ``side``: only pairs of two sides
    count; others are looked for elsewhere. With ``counts``, every pair that the
    trees leave is looked at, once, and each set's ``counts`` grow by the
    ``weights`` of the sets it links with; the result still spans the groups only.
    """
    if len(sets) < 2:
        return []
    size = np.array([len(s) for s in sets])
    forest, links = Forest(len(sets)), []

    def look(i: np.ndarray, j: np.ndarray) -> None:
        if side is not None:
            ok = side[i] != side[j]
            i, j = i[ok], j[ok]
        step = max(1, len(i)) if counts is not None else SET_PAIRS
        for k in range(0, len(i), step):
            a, b = i[k : k + step], j[k : k + step]
            if counts is None:
                root = forest.roots()
                ok = root[a] != root[b]
                a, b = a[ok], b[ok]
                if not len(a):
                    continue
            ok = (den + num) * overlaps(sets, a, b) >= num * (size[a] + size[b])
            a, b = a[ok], b[ok]
            if counts is not None:
                np.add.at(counts, a, weights[b])
                np.add.at(counts, b, weights[a])
            links.extend(_spanned(forest, a, b))

    for i, j in possible_pairs([bitmap(s) for s in sets], size, num, den, forest if counts is None else None):
        look(i, j)
    return links
