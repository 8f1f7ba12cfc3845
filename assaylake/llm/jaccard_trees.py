"""Jaccard join of shingle sets with signature trees, and its connected components.

1. Every text becomes a set of 64-bit shingle hashes; equal sets, by 128 bits of digests, are one class from here on, so
   exact copies cost one row each.
2. Two sets with Jaccard t or more differ in few shingles for their size. Each set is cut by a hash into one
   segment more than that, so linked sets agree in one segment at least. A segment that is empty stands for two halves
   of the next one.
3. Sets that share a segment are compared by their signatures alone (size, and a bitmap of the shingles): all pairs of a
   few sets, signature trees (nodes with OR-combined bitmaps and size ranges, one traversed against another or itself)
   of more. What could overlap enough is a candidate, and joins components at once, so that a task keeps no pairs and looks
   at none whose sets are in one component; whole sets are fetched for candidates only, so a passage that many
   texts share brings none of them together.
4. Candidates that hang together are a cluster, in blocks of bounded size. Inside a block, and between two, trees are
   traversed again, node pairs in one component already are left out, and what remains is verified on the whole sets.
5. Blocks of a cluster are first compared with its first block; pairs of blocks that are then one component are
   done, the others are compared. So a large group of near copies costs a pass over its blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .components import components
from .filters import key_filter, passes
from .store import discard, partitions, saved
from .text import U64, mix, runs, signed, slices, words

#: A pair is linked if 100 * |both| >= percent * |either|; these are the op3 query's percent and words of a shingle.
PERCENT = 90
SHINGLE = 3
#: Shingles that one block of a cluster holds, and at most one part more; a part is dealt this share of a block on average.
BLOCK_SHINGLES = 1_000_000
PARTS = 16
#: Words of the smallest and of the largest bitmaps; nodes below a node.
BITMAP_WORDS, MOST_WORDS = 16, 1024
FANOUT = 4
#: Words of bitmaps that are held against each other at a time.
PAIR_WORDS = 1 << 18
#: Sets with one segment that are held against each other without a tree; sets of a block of those with one segment; rows
#: of a task's group.
FEW, BLOCK_SETS, TASK_ROWS = 64, 4096, 50_000
#: Groups that are dealt on and broadcast at most; more of them are joined.
BROADCAST_ROWS = 100_000
ODD = [U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F), U64(0x165667B19E3779F9)]


def shingles(texts: pa.Array, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(text's index, hash) of the distinct shingles of lower-cased texts, sorted; too short a text is one shingle."""
    vocabulary, codes, starts = words(texts, lower=True)
    hashed = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in vocabulary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()), U64, len(vocabulary))[codes]
    sizes = np.diff(starts)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    n = max(0, len(hashed) - width + 1)
    value, at = np.zeros(n, U64), owner[:n]
    for k in range(width):
        value = mix(value * ODD[k % 3] + hashed[k : k + n] + U64(k))
    whole = at == owner[width - 1 : width - 1 + n]
    value, at = value[whole], at[whole]
    short = np.flatnonzero((sizes > 0) & (sizes < width))
    if len(short):
        head = np.zeros(len(short), U64)
        for k in range(width - 1):
            has = sizes[short] > k
            head[has] = mix(head[has] * ODD[k % 3] + hashed[starts[short[has]] + k] + U64(k))
        value, at = np.concatenate([value, mix(head + sizes[short].astype(U64))]), np.concatenate([at, short])
    order = np.lexsort((value, at))
    value, at = value[order], at[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (at[1:] != at[:-1])
    return at[new], value[new]


def bands(most: int, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """(first size of each band, segments of each band's signatures). A pair that links is in one band or in
    neighbouring ones; differences among sizes up to a band's end are fewer than its segments."""
    first, segments, low = [], [], 1
    while low <= most:
        high = 100 * low // percent
        first.append(low)
        # |either| - |both| <= (100 - percent) / 100 * |either|, |either| <= 100 / (100 + percent) * 2 * high
        segments.append((100 - percent) * 2 * high // (100 + percent) + 1)
        low = high + 1
    return np.array(first), np.array(segments)


def segment_hashes(at: np.ndarray, value: np.ndarray, n: int, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text's index, signature, words of the band's bitmaps) of every segment of the sets of n texts, for the text's own band
    and the next one."""
    sizes = np.bincount(at, minlength=n)
    first, segments = bands(int(sizes.max(initial=1)) * 100 // percent + 2, percent)
    band = np.searchsorted(first, sizes, side="right") - 1
    owners, out, widths = [], [], []
    for step in (0, 1):
        group = band + step
        count = np.where(sizes > 0, segments[group], 0)
        base = np.cumsum(count) - count
        salted = mix(value + ODD[0] * (group[at] + 1).astype(U64))
        segment = ((salted >> U64(32)) * count[at].astype(U64) >> U64(32)).astype(np.int64)
        half = (salted & U64(1)).astype(np.int64)
        total = int(count.sum())
        # sums of hashes by half segment; two halves make a segment
        halves = np.zeros(2 * total, U64)
        np.add.at(halves, 2 * (base[at] + segment) + half, mix(salted))
        full = np.zeros(total, bool)
        full[base[at] + segment] = True
        owner = np.repeat(np.arange(n), count)
        number = np.arange(total) - base[owner]
        tag = mix((group[owner] * 4 + 1).astype(U64) * ODD[1] + number.astype(U64))
        owners.append(owner[full])
        out.append(mix((halves[::2] + halves[1::2])[full] ^ tag[full]))
        empty = np.flatnonzero(~full)
        # were all other segments to differ, each would by one shingle, so one half of the next is the same
        after = base[owner[empty]] + (number[empty] + 1) % count[owner[empty]]
        for k in (0, 1):
            owners.append(owner[empty])
            out.append(mix(halves[2 * after + k] ^ tag[empty] ^ ODD[2] * U64(k + 1)))
        several = empty[np.bincount(owner[empty], minlength=n)[owner[empty]] > 1]
        owners.append(owner[several])
        out.append(mix(tag[several] + ODD[2]))
        widths += [band_words(first)[group][x] for x in owners[-4:]]
    return np.concatenate(owners), np.concatenate(out), np.concatenate(widths)


def band_words(first: np.ndarray) -> np.ndarray:
    """Words of the bitmaps of each band: a power of two, a bit or more for each shingle of its smallest sets."""
    return np.clip(1 << np.ceil(np.log2(np.maximum(first, 1) / 64)).clip(0).astype(np.int64), BITMAP_WORDS, MOST_WORDS)


def _digests(at: np.ndarray, value: np.ndarray, n: int, clashes: frozenset = frozenset()) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sizes, node, second) of the sets of n texts: two digests of 64 bits each. The first names the set; where it is one of
    ``clashes``, which different sets share, both do."""
    sizes = np.bincount(at, minlength=n)
    both = []
    for odd in ODD[:2]:
        digest = np.zeros(n, U64)
        np.add.at(digest, at, mix(value ^ odd))
        both.append(mix(digest + sizes.astype(U64)))
    node, second = both
    if clashes:
        shared = np.isin(signed(node), list(clashes))
        node = np.where(shared, mix(node * ODD[2] + second), node)
    return sizes, signed(node), signed(second)


def _describe(batches: Iterator[pa.RecordBatch], width: int, clashes: frozenset = frozenset()) -> Iterator[pa.RecordBatch]:
    for piece in slices(batches):
        sizes, node, second = _digests(*shingles(piece.column("text"), width), len(piece), clashes)
        yield pa.RecordBatch.from_arrays([piece.column("doc_id"), piece.column("t"), pa.array(sizes.astype(np.int64)), pa.array(node), pa.array(second)], ["doc_id", "t", "n", "node", "second"])


def bitmaps(at: np.ndarray, value: np.ndarray, n: int, words_: int = BITMAP_WORDS) -> np.ndarray:
    """A bitmap of so many words of each of n sets."""
    bits, place = np.zeros((n, words_), U64), (value >> U64(7)) % U64(64 * words_)
    np.bitwise_or.at(bits, (at, (place // U64(64)).astype(np.int64)), U64(1) << place % U64(64))
    return bits


def minimum_hashes(at: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    least = np.full(n, ~U64(0))
    np.minimum.at(least, at, mix(value ^ ODD[1]))
    return signed(least)


def _once(piece: pa.RecordBatch, width: int, clashes: frozenset) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(node, size; set's index, shingles) of a piece's sets, equal ones once, without empty ones."""
    n = len(piece)
    at, value = shingles(piece.column("text"), width)
    sizes, node, _ = _digests(at, value, n, clashes)
    _, first = np.unique(node, return_index=True)
    once = np.zeros(n, bool)
    once[first] = True
    once &= sizes > 0
    kept = once[at]
    return node[once], sizes[once], (np.cumsum(once) - 1)[at[kept]], value[kept]


def _segments(batches: Iterator[pa.RecordBatch], width: int, percent: int, clashes: frozenset) -> Iterator[pa.RecordBatch]:
    """(sig, node, words) of each segment of each set."""
    for piece in slices(batches):
        node, _, at, value = _once(piece, width, clashes)
        owner, signature, words_ = segment_hashes(at, value, len(node), percent)
        for k in range(0, len(owner), 1 << 20):
            part = slice(k, k + (1 << 20))
            yield pa.RecordBatch.from_arrays([pa.array(signed(signature[part])), pa.array(node[owner[part]]), pa.array(words_[part].astype(np.int16))], ["sig", "node", "words"])


def _sketches(batches: Iterator[pa.RecordBatch], width: int, percent: int, clashes: frozenset) -> Iterator[pa.RecordBatch]:
    """node, words, n, least (minimum hash) and bits (bitmap of so many words) of each set, for the widths of its two bands."""
    for piece in slices(batches):
        node, sizes, at, value = _once(piece, width, clashes)
        if not len(node):
            continue
        first, _ = bands(int(sizes.max()) * 100 // percent + 2, percent)
        band, least = np.searchsorted(first, sizes, side="right") - 1, minimum_hashes(at, value, len(node))
        own, after = band_words(first)[band], band_words(first)[band + 1]
        for words_ in np.unique(np.concatenate([own, after])).tolist():
            has = (own == words_) | (after == words_)
            kept = has[at]
            bits = bitmaps((np.cumsum(has) - 1)[at[kept]], value[kept], int(has.sum()), words_)
            yield pa.RecordBatch.from_arrays([pa.array(node[has]), pa.array(np.full(int(has.sum()), words_, np.int16)), pa.array(sizes[has]), pa.array(least[has]), pa.array([x.tobytes() for x in bits], pa.binary())], ["node", "words", "n", "least", "bits"])


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows (sig, node) of signatures that several nodes have, once each, with the block of the row among its
    signature's, their number, and the signature's least node; all rows of a signature are in this partition."""
    kept = list(batches)
    if not kept:
        return
    sig, node, words_ = (np.concatenate([x.column(k).to_numpy(zero_copy_only=False) for x in kept]) for k in range(3))
    order = np.lexsort((node, sig))
    sig, node, words_ = sig[order], node[order], words_[order]
    new = np.ones(len(sig), bool)
    new[1:] = (sig[1:] != sig[:-1]) | (node[1:] != node[:-1])
    sig, node, words_ = sig[new], node[new], words_[new]
    head = np.flatnonzero(np.diff(sig, prepend=~sig[:1]))
    size = np.diff(np.append(head, len(sig)))
    rank = np.arange(len(sig)) - np.repeat(head, size)
    several = np.repeat(size > 1, size)
    blocks = np.repeat(-(-size // BLOCK_SETS), size)
    columns = [x[several] for x in (sig, node, words_, rank // BLOCK_SETS, blocks, np.repeat(node[head], size))]
    for k in range(0, len(columns[0]), 1 << 20):
        yield pa.RecordBatch.from_arrays([pa.array(c[k : k + (1 << 20)]) for c in columns], ["sig", "node", "words", "block", "blocks", "low"])


def _chosen(batches: Iterator[pa.RecordBatch], wanted: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The rows (key, t, text) whose hash h passes the filter."""
    for batch in batches:
        kept = batch.filter(pa.array(passes(wanted, batch.column("h").to_numpy().view(U64))))
        yield pa.RecordBatch.from_arrays([kept.column(c) for c in ("key", "t", "text")], ["key", "t", "text"])


def _sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """The whole sets of candidates, and a minimum hash that gathers similar ones."""
    for piece in slices(batches):
        n = len(piece)
        at, value = shingles(piece.column("text"), width)
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(np.bincount(at, minlength=n))]).astype(np.int32)), pa.array(signed(value)))
        yield pa.RecordBatch.from_arrays([piece.column("cluster"), piece.column("node"), pa.array(minimum_hashes(at, value, n)), lists], ["cluster", "node", "least", "set"])


class SignatureTree:
    """Bitmaps and sizes of sets in the order of their minimum hash, in nodes of ``FANOUT`` below each other; level 0 has
    the sets."""

    def __init__(self, bits: np.ndarray, sizes: np.ndarray):
        more = sizes - np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
        self.levels = [(bits, sizes, sizes, more)]
        while len(self.levels[-1][1]) > 1:
            bits, low, high, more = self.levels[-1]
            cut = np.arange(0, len(low), FANOUT)
            self.levels.append((np.bitwise_or.reduceat(bits, cut), np.minimum.reduceat(low, cut), np.maximum.reduceat(high, cut), np.maximum.reduceat(more, cut)))

    @classmethod
    def of(cls, sets: list[np.ndarray], words_: int) -> SignatureTree:
        sizes = np.array([len(s) for s in sets], np.int64)
        return cls(bitmaps(np.repeat(np.arange(len(sets)), sizes), np.concatenate(sets).view(U64), len(sets), words_), sizes)

    def one_root(self, roots: np.ndarray, level: int) -> np.ndarray:
        """The component of each node of a level, -1 where its sets are in several."""
        for _ in range(level):
            cut = np.arange(0, len(roots), FANOUT)
            low, high = np.minimum.reduceat(roots, cut), np.maximum.reduceat(roots, cut)
            roots = np.where((low == high) & (low >= 0), low, -1)
        return roots


def could_link(a: tuple[np.ndarray, ...], b: tuple[np.ndarray, ...], pairs: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs of nodes (bits, least size, greatest size, most shingles beyond the bits) can have sets that link."""
    (bits, low, high, more), (bits2, low2, high2, more2) = ([x[p] for x in side] for side, p in ((a, pairs[0]), (b, pairs[1])))
    overlap = np.bitwise_count(bits & bits2).sum(axis=1, dtype=np.int64) + np.minimum(more, more2)
    overlap = np.minimum(overlap, np.minimum(high, high2))
    least = np.maximum(low + low2, -(-np.maximum(low, low2) * (100 + percent) // 100))
    return (100 + percent) * overlap >= percent * least


def traverse(left: SignatureTree, right: SignatureTree, percent: int, is_open: Callable | None = None) -> Iterator[np.ndarray]:
    """Pairs (i, j) of sets of two trees, or of one with itself, that could link, some at a time. ``is_open``, of two levels and
    pairs of their nodes, tells those that are still to be looked at."""
    top = (len(left.levels) - 1, len(right.levels) - 1)
    step = max(1, PAIR_WORDS // left.levels[0][0].shape[1])
    stack = [(top[0], top[1], np.zeros((2, 1), np.int64))]
    while stack:
        u, v, pairs = stack.pop()
        if is_open:
            pairs = pairs[:, is_open(u, v, pairs)]
        pairs = pairs[:, could_link(left.levels[u], right.levels[v], pairs, percent)]
        if u == v == 0:
            yield pairs[:, pairs[0] < pairs[1]] if left is right else pairs
            continue
        for k, tree in ((0, left), (1, right)):  # open the nodes of the sides that have levels below
            if (u, v)[k] and (u, v)[k] >= (u, v)[1 - k]:
                below = pairs[:, :, None].repeat(FANOUT, axis=2)
                below[k] = pairs[k][:, None] * FANOUT + np.arange(FANOUT)
                size = len(tree.levels[(u, v)[k] - 1][1])
                pairs = below.reshape(2, -1)
                pairs = pairs[:, pairs[k] < size]
                u, v = (u - 1, v) if k == 0 else (u, v - 1)
        if left is right and u == v:
            pairs = pairs[:, pairs[0] <= pairs[1]]
        stack += [(u, v, pairs[:, k : k + step]) for k in range(0, pairs.shape[1], step)][::-1]


def joined(root: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """The least number of each number's component, as ``root`` has it and pairs of numbers join components."""
    a, b = root[pairs]
    while True:
        low = np.minimum(root[a], root[b])
        now = root.copy()
        np.minimum.at(now, root[a], low)
        np.minimum.at(now, root[b], low)
        np.minimum.at(now, a, low)
        np.minimum.at(now, b, low)
        now = now[now]
        if (now == root).all():
            return root
        root = now


def stars(pairs: np.ndarray) -> np.ndarray:
    """Pairs (node, least node) of the components of pairs."""
    names, ends = np.unique(pairs, return_inverse=True)
    root = joined(np.arange(len(names)), ends.reshape(2, -1))
    own = root != np.arange(len(names))
    return np.stack([names[own], names[root[own]]])


class Linked:
    """Components of sets, in ``root``, by the pairs among those looked at that could link. Pairs are taken in some at a time and
    none is kept, nor looked at once its sets are in one component, so a group of near copies costs no pairs of all."""

    def __init__(self, sets: tuple[np.ndarray, ...], percent: int):
        self.sets, self.percent, self.root = sets, percent, np.arange(len(sets[1]))

    def look(self, a: np.ndarray, b: np.ndarray) -> None:
        """The pairs (a, b) of sets."""
        step = max(1, PAIR_WORDS // self.sets[0].shape[1])
        for k in range(0, len(a), step):
            pairs = np.stack([a[k : k + step], b[k : k + step]])
            pairs = pairs[:, self.root[pairs[0]] != self.root[pairs[1]]]
            pairs = pairs[:, could_link(self.sets, self.sets, pairs, self.percent)]
            if pairs.size:
                self.root = joined(self.root, pairs)

    def look_all(self, left: np.ndarray, right: np.ndarray) -> None:
        """All pairs of the sets of two groups, or of one with itself, by their trees. The first set is held against all before, and
        neighbours in one group, which joins most near copies."""
        self.look(np.repeat(left[:1], len(right)), right)
        if left is right:
            self.look(left[:-1], left[1:])
        here = self.root[np.concatenate([left, right])]
        if (here == here[0]).all():
            return
        bits, sizes = self.sets[:2]
        tree = SignatureTree(bits[left], sizes[left])
        other = tree if left is right else SignatureTree(bits[right], sizes[right])

        def is_open(u: int, v: int, pairs: np.ndarray) -> np.ndarray:
            mine, theirs = tree.one_root(self.root[left], u)[pairs[0]], other.one_root(self.root[right], v)[pairs[1]]
            return (mine < 0) | (mine != theirs)

        for pairs in traverse(tree, other, self.percent, is_open):
            if pairs.size:
                self.root = joined(self.root, np.stack([left[pairs[0]], right[pairs[1]]]))


def _words_of(column: pa.ChunkedArray, words_: int) -> np.ndarray:
    """Bitmaps of so many words as one array, without a copy of each."""
    whole = pa.concat_arrays(column.chunks)
    start = int(np.frombuffer(whole.buffers()[1], np.int32)[whole.offset])
    return np.frombuffer(whole.buffers()[2], np.uint8)[start : start + 8 * words_ * len(whole)].view(U64).reshape(-1, words_)


def _candidates(rows: pa.Table, sketches: pa.Table, percent: int) -> pa.Table:
    """Edges that join the nodes which share a segment and could link: from all rows (sig, i, j, block, node, words) of some
    (sig, i, j), and one sketch of each (node, words) among them."""
    out = [np.zeros((2, 0), np.int64)]
    for words_ in np.unique(sketches.column("words").to_numpy()).tolist():
        own = sketches.filter(pc.equal(sketches.column("words"), words_)).sort_by([("least", "ascending"), ("node", "ascending")])
        name, sizes = own.column("node").to_numpy(), own.column("n").to_numpy()
        bits = _words_of(own.column("bits"), words_)
        one = (bits, sizes, sizes, sizes - np.bitwise_count(bits).sum(axis=1, dtype=np.int64))
        part = rows.filter(pc.equal(rows.column("words"), words_))
        sig, i, j, block, node = (part.column(k).to_numpy() for k in ("sig", "i", "j", "block", "node"))
        by_name = np.argsort(name)
        place = by_name[np.searchsorted(name, node, sorter=by_name)]  # of the node's sketch, in the order of minimum hashes
        order = np.lexsort((place, j, i, sig))
        sig, i, j, block, place = (x[order] for x in (sig, i, j, block, place))
        change = np.zeros(len(sig), bool)
        for x in (sig, i, j):
            change[1:] |= x[1:] != x[:-1]
        head = np.concatenate([[0], np.flatnonzero(change)])
        count = np.diff(np.append(head, len(sig)))
        few = np.repeat((count <= FEW) & (i == j)[head], count)
        left = np.repeat(head + count, count) - np.arange(len(sig))  # rows to the group's end
        linked = Linked(one, percent)
        for step in range(1, int(min(FEW, count.max()))):
            at = np.flatnonzero(few & (left > step))
            linked.look(place[at], place[at + step])
        for start, n in zip(head[~few[head]].tolist(), count[~few[head]].tolist()):
            own_rows = np.arange(start, start + n)
            sides = [place[own_rows]] if i[start] == j[start] else [place[own_rows[block[own_rows] == k[start]]] for k in (i, j)]
            if all(map(len, sides)):
                linked.look_all(sides[0], sides[-1])
        out.append(np.stack([name, name[linked.root]]))
    found = stars(np.concatenate(out, axis=1))
    return pa.table({"a": found[0], "b": found[1]})


def join_trees(nodes: np.ndarray, sets: list[np.ndarray], side: np.ndarray, roots: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Edges (a, b) that join the components ``roots`` of sets which link. side: 0 and 1 are compared with each
    other and not among themselves; all 0: all are compared. Sets come in the order of their minimum hash."""
    number = {r: k for k, r in enumerate(dict.fromkeys(roots.tolist()))}
    parent = list(range(len(number)))
    part = np.array([number[r] for r in roots.tolist()])
    edges: list[tuple[int, int]] = []

    def find(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    members: dict[int, frozenset] = {}

    def member(i: int) -> frozenset:
        if i not in members:
            if len(members) > 128:
                members.clear()
            members[i] = frozenset(sets[i].tolist())
        return members[i]

    def verify(i: int, j: int) -> None:
        p, q = find(int(part[i])), find(int(part[j]))
        if p != q:
            a, b = len(sets[i]), len(sets[j])
            if (100 + percent) * min(a, b) >= percent * (a + b) and (100 + percent) * len(member(i) & member(j)) >= percent * (a + b):
                parent[max(p, q)] = min(p, q)
                edges.append((int(nodes[i]), int(nodes[j])))

    two = bool(side.any())
    sides = [np.flatnonzero(side == 0), np.flatnonzero(side == 1)] if two else [np.arange(len(sets))] * 2
    if two:  # neighbours first: most links of near copies are found here, and prune the traversal
        for i in sides[1].tolist():
            verify(int(sides[0][0]), i)
    else:
        for i in range(1, len(sets)):
            verify(i - 1, i)
            verify(0, i)
    # two bits for each shingle of the largest set, so that bitmaps of long texts tell them apart too
    words_ = min(MOST_WORDS, 1 << max(BITMAP_WORDS.bit_length() - 1, (max(map(len, sets)) // 32).bit_length()))
    left = SignatureTree.of([sets[i] for i in sides[0]], words_)
    right = left if not two else SignatureTree.of([sets[i] for i in sides[1]], words_)

    def is_open(u: int, v: int, pairs: np.ndarray) -> np.ndarray:
        now = np.array([find(k) for k in range(len(parent))])
        mine, theirs = left.one_root(now[part[sides[0]]], u)[pairs[0]], right.one_root(now[part[sides[1]]], v)[pairs[1]]
        return (mine < 0) | (mine != theirs)

    for pairs in traverse(left, right, percent, is_open):
        for i, j in pairs.T.tolist():
            verify(int(sides[0][i]), int(sides[1][j]))
    return np.array(edges, np.int64).reshape(-1, 2)


def _join_group(table: pa.Table, percent: int) -> pa.Table:
    table = table.sort_by([("least", "ascending"), ("node", "ascending")])
    flat, offsets = table.column("set").combine_chunks(), None
    values, offsets = flat.values.to_numpy(zero_copy_only=False), flat.offsets.to_numpy(zero_copy_only=False)
    sets = [values[offsets[k] : offsets[k + 1]] for k in range(len(flat))]
    column = lambda name: table.column(name).to_numpy()
    edges = join_trees(column("node"), sets, (column("block") != column("i")).astype(np.int64), column("root"), percent)
    return pa.table({"a": edges[:, 0], "b": edges[:, 1]})


EDGE = "a long, b long"


def _compare(members: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """Edges between linked sets of the pairs (cluster, i, j) of blocks; i = j compares a block with itself."""
    ends = pairs.select("cluster", "i", "j", F.explode(F.array_distinct(F.array("i", "j"))).alias("block"))
    return members.join(ends, ["cluster", "block"]).groupBy("cluster", "i", "j").applyInArrow(lambda table: _join_group(table, percent), EDGE)


def _with_blocks(members: DataFrame) -> DataFrame:
    """``members`` with the block of each set, numbered from 0 in each cluster.

    The sets of a minimum hash stay together unless they are more than a part; then each is dealt by itself, as nearly
    all sets of a group of near copies have one minimum hash. Parts are filled into blocks in order."""
    keys = members.select("cluster", "node", "least", F.size("set").cast("long").alias("size"))
    whole = keys.groupBy("cluster").agg(F.sum("size").alias("whole")).where(F.col("whole") > BLOCK_SHINGLES)
    keys = saved(keys.join(whole, "cluster"))
    if keys.isEmpty():
        return members.withColumn("block", F.lit(0).cast("long"))
    common = keys.groupBy("cluster", "least").agg(F.sum("size").alias("held")).where(F.col("held") * PARTS > BLOCK_SHINGLES)
    common = common.select("cluster", "least", F.lit(True).alias("alone"))
    part = F.pmod(F.xxhash64("least", F.when(F.col("alone"), F.col("node"))), F.ceil(F.col("whole") * PARTS / BLOCK_SHINGLES))
    keys = saved(keys.join(common, ["cluster", "least"], "left").select("cluster", "node", "size", part.alias("part")))
    upto = F.sum("held").over(Window.partitionBy("cluster").orderBy("part"))
    parts = keys.groupBy("cluster", "part").agg(F.sum("size").alias("held"))
    parts = parts.select("cluster", "part", F.floor((upto - F.col("held")) / BLOCK_SHINGLES).cast("long").alias("block"))
    blocks = keys.join(parts, ["cluster", "part"]).select("node", "block")
    return members.join(blocks, "node", "left").withColumn("block", F.coalesce("block", F.lit(0)).cast("long"))


def set_classes(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", width: int = SHINGLE, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(doc_id, t, n, node of each row; node, root of the nodes in links): the classes and their links.

    node is a digest of the text's shingle set, t a hash of the text itself."""
    spark = docs.sparkSession
    whole = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).withColumn("t", F.xxhash64("text"))
    rows = saved(whole.mapInArrow(lambda it: _describe(it, width), "doc_id long, t long, n long, node long, second long"))
    # two sets of one digest differ in the second; expected are none in a thousand million sets
    clashes = rows.groupBy("node").agg(F.min("second").alias("low"), F.max("second").alias("high")).where("low <> high").select("node")
    clashes = frozenset(r[0] for r in clashes.collect())
    if clashes:
        rows = saved(whole.mapInArrow(lambda it: _describe(it, width, clashes), "doc_id long, t long, n long, node long, second long"), rows)
    texts = whole.select("text")
    # signatures of a set are at most in number two in ten of its shingles and two, for each of two bands
    total = rows.groupBy("node").agg(F.first("n").alias("n")).agg(F.sum(2 * (F.col("n") * (100 - percent) * 2.5 / (100 + percent) + 2))).first()[0] or 0
    dealt = texts.mapInArrow(lambda it: _segments(it, width, percent, clashes), "sig long, node long, words short").repartition(partitions(int(total), 1_000_000, spark), "sig")
    shared = saved(dealt.mapInArrow(_shared, "sig long, node long, words short, block long, blocks long, low long"))
    sketches = texts.mapInArrow(lambda it: _sketches(it, width, percent, clashes), "node long, words short, n long, least long, bits binary").dropDuplicates(["node", "words"])
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    ends = shared.select("*", other).select("sig", "node", "words", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "low")
    # signatures of one group of near copies mostly have the group's least node, so they go to one task, and a set to few tasks;
    # a group of more rows than a task's is dealt on by signature
    heavy = saved(shared.groupBy("low").agg(F.sum("blocks").alias("held")).where(F.col("held") > TASK_ROWS).select(F.col("low").alias("_low"), F.ceil(F.col("held") / TASK_ROWS).alias("deal")))
    heavy_side = F.broadcast(heavy) if heavy.count() <= BROADCAST_ROWS else heavy
    deal = F.coalesce(F.pmod(F.xxhash64("sig", "i", "j"), F.col("deal")), F.lit(0).cast("long"))
    ends = ends.join(heavy_side, F.col("low") == F.col("_low"), "left").withColumn("task", F.pmod(F.xxhash64("low", deal), F.lit(partitions(shared.count(), TASK_ROWS, spark)))).drop("low", "_low", "deal")
    sent = ends.select("task", "node", "words").distinct().join(sketches, ["node", "words"])
    sent = sent.select(*(F.col(c).alias(c) for c in sent.columns))  # columns of their own, as both sides come from one table
    pruned = ends.groupBy("task").cogroup(sent.groupBy("task")).applyInArrow(lambda left, right: _candidates(left, right, percent), EDGE)
    clusters = components(pruned)
    discard(shared)
    discard(heavy)
    # one text for each node that may link: by its id and hash, so that ids of many texts meet no others
    first = rows.where("n > 0").groupBy("node").agg(F.min(F.struct(F.coalesce("doc_id", F.lit(-(2**63))).alias("key"), "t")).alias("one"))
    picked = saved(clusters.select(F.col("root").alias("cluster"), "node").join(first, "node").select("cluster", "node", "one.key", "one.t"), clusters)
    keyed = whole.withColumn("key", F.coalesce("doc_id", F.lit(-(2**63)))).drop("doc_id")
    # texts that are not wanted are left out where they are read, by a filter of bounded size, and only the others are shuffled
    wanted = spark.sparkContext.broadcast(key_filter(picked.select(F.xxhash64("key", "t").alias("key")), picked.count()))
    keyed = keyed.withColumn("h", F.xxhash64("key", "t")).select("key", "t", "h", "text").mapInArrow(lambda it: _chosen(it, wanted.value), "key long, t long, text string")
    found = picked.hint("merge").join(keyed, ["key", "t"]).select("cluster", "node", "text").mapInArrow(lambda it: _sets(it, width), "cluster long, node long, least long, set array<long>")
    plain = saved(found.dropDuplicates(["node"]), picked)
    members = saved(_with_blocks(plain).withColumn("root", F.col("node")), plain)
    own = members.select("cluster", F.col("block").alias("i"), F.col("block").alias("j")).distinct()
    edges = saved(_compare(members, own, percent))
    large = members.join(members.where("block > 0").select("cluster").distinct(), "cluster", "left_semi")
    if not large.isEmpty():
        first_block = large.groupBy("cluster").agg(F.min("block").alias("i"))
        star = large.select("cluster", "block").distinct().join(first_block, "cluster").where("block <> i").select("cluster", "i", F.col("block").alias("j"))
        edges = saved(edges.union(_compare(_with_roots(large, edges), star, percent)), edges)
        now = saved(_with_roots(large, edges))
        state = now.groupBy("cluster", "block").agg(F.min("root").alias("low"), F.max("root").alias("high"))
        left, right = (state.select("cluster", F.col("block").alias(k), F.col("low").alias(f"low_{k}"), F.col("high").alias(f"high_{k}")) for k in "ij")
        open_pairs = left.join(right, "cluster").where("i < j and not (low_i = high_i and low_j = high_j and low_i = low_j)").join(first_block.select("cluster", F.col("i").alias("done")), "cluster").where("i <> done").select("cluster", "i", "j")
        edges = saved(edges.union(_compare(now, open_pairs, percent)), edges, now)
    roots = components(edges)
    for done in (members, edges):
        discard(done)
    return rows, roots


def _with_roots(members: DataFrame, edges: DataFrame) -> DataFrame:
    return members.drop("root").join(components(edges), "node", "left").withColumn("root", F.coalesce("root", "node"))


def jaccard_components(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, root, t of each row: component_id is the least doc_id that links reach.

    Nulls and empty texts have no shingles and are linked with nothing: their component is their own id. Rows with
    one id are documents of their own. A null id is the component only where all of its ids are null. An empty
    table gives no rows. root names the component's set class and t the text; other columns are not looked at.
    """
    rows, roots = set_classes(docs, text, doc_id, width, percent)
    classes = rows.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies"))
    joined = classes.join(roots, "node", "left").withColumn("linked", F.col("root").isNotNull()).withColumn("root", F.coalesce("root", "node"))
    components_ = joined.where("linked").groupBy("root").agg(F.min("least").alias("of"))
    known = joined.join(components_, "root", "left").where("linked or copies > 1").select("node", "root", F.when(F.col("linked"), F.col("of")).otherwise(F.col("least")).alias("component"))
    found = F.col("component").isNotNull() | F.col("root").isNotNull()
    return rows.join(known, "node", "left").select("doc_id", F.col("n").alias("n_shingles"), F.when((F.col("n") > 0) & found, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"), F.coalesce("root", "node").alias("root"), "t")


def one_of_each(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs``, all columns, of which one of each component stays: the one with the least id, and of
    several such rows one. Rows without shingles stay."""
    found = jaccard_components(docs, text, doc_id, width, percent)
    alone = found.where("n_shingles > 0 and doc_id <=> component_id").groupBy("root", F.col("doc_id").alias("_id")).agg(F.min("t").alias("_t")).select("_id", "_t")
    worded = F.coalesce(F.col(text).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    row = F.struct(*[docs[c] for c in docs.columns]).alias("row")
    marked = docs.where(worded).select(row, docs[doc_id].cast("long").alias("id"), F.xxhash64(text).alias("t"))
    met = marked.join(alone, F.col("id").eqNullSafe(F.col("_id")) & (F.col("t") == F.col("_t")))
    return met.dropDuplicates(["id", "t"]).select("row.*").unionByName(docs.where(~worded))
