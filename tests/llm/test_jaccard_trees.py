"""Candidates of the Jaccard join, against all pairs held against each other."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from assaylake.llm import jaccard_trees as j


def sketches(groups: list[int], random: np.random.Generator, words: int = 16) -> pa.Table:
    """Sets of 200 shingles, those of a group alike but for 8."""
    values = []
    for n in groups:
        base = random.integers(1 << 63, size=200)
        for _ in range(n):
            own = base.copy()
            own[random.choice(200, 8, replace=False)] = random.integers(1 << 63, size=8)
            values.append(np.sort(own))
    at, value, n = np.repeat(np.arange(len(values)), 200), np.concatenate(values).view(np.uint64), len(values)
    bits = j.bitmaps(at, value, n, words)
    node = random.permutation(n) * 7 + 3
    return pa.table({"node": node, "words": np.full(n, words, np.int16), "n": np.full(n, 200), "least": j.minimum_hashes(at, value, n), "bits": pa.array([x.tobytes() for x in bits], pa.binary())})


def rows_of(sig: int, node: np.ndarray, i: int = 0, k: int = 0, block: np.ndarray | None = None) -> pa.Table:
    same = lambda x: np.full(len(node), x, np.int64)
    return pa.table({"sig": same(sig), "i": same(i), "j": same(k), "block": same(0) if block is None else block, "node": node, "words": np.full(len(node), 16, np.int16)})


def all_pairs(rows: pa.Table, sets: pa.Table, percent: int) -> list[tuple[int, int]]:
    place = {x: k for k, x in enumerate(sets["node"].to_pylist())}
    bits = np.array([np.frombuffer(x, np.uint64) for x in sets["bits"].to_pylist()])
    sizes = sets["n"].to_numpy()
    one = (bits, sizes, sizes, sizes - np.bitwise_count(bits).sum(axis=1, dtype=np.int64))
    found = []
    table = rows.to_pandas()
    for (_, i, k), group in table.groupby(["sig", "i", "j"]):
        left, right = (group.node[group.block == x].map(place).to_numpy() for x in (i, k)) if i != k else [group.node.map(place).to_numpy()] * 2
        pairs = np.stack([x.ravel() for x in np.meshgrid(left, right)])
        pairs = pairs[:, pairs[0] != pairs[1]]
        found.append(pairs[:, j.could_link(one, one, pairs, percent)])
    node = sets["node"].to_numpy()
    return sorted(zip(*j.stars(node[np.concatenate(found, axis=1)]).tolist()))


@pytest.mark.parametrize("percent", [80, 90])
def test_candidates_are_the_components_of_all_pairs(percent):
    random = np.random.default_rng(3)
    sets = sketches([150, 90, 40, 3, *[1] * 30], random)
    node = sets["node"].to_numpy()
    rows = [rows_of(1, node), rows_of(2, node[::3]), rows_of(3, node[::9]), rows_of(6, node[270:300])]
    rows.append(rows_of(4, node, 0, 1, random.integers(2, size=len(node))))
    rows.append(rows_of(5, node[-20:], 0, 1, np.zeros(20, np.int64)))  # one side is empty
    for some in (rows, rows[1:3], rows[3:]):
        table = pa.concat_tables(some)
        kept = sets.filter(pa.array(np.isin(node, table["node"].to_numpy())))
        got = j._candidates(table, kept, percent)
        assert sorted(zip(got["a"].to_pylist(), got["b"].to_pylist())) == all_pairs(table, kept, percent)


def test_segments_of_one_large_group_of_near_copies_keep_no_pairs():
    random = np.random.default_rng(4)
    sets = sketches([2500, 100, 1], random)
    node = sets["node"].to_numpy()
    rows = pa.concat_tables([rows_of(k, node) for k in range(8)])
    tracemalloc.start()
    got = j._candidates(rows, sets, 80)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got.num_rows == 2500 - 1 + 100 - 1
    assert peak < 64 << 20
