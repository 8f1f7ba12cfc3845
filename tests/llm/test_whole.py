"""Operators do their whole job: cases that were cut short."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from assaylake.llm import jaccard_trees, secrets, stages, unit_dedup

from .test_llm import UP, WORD, documents, none, odd  # noqa: F401


def least_of_each(rows, width, percent):
    """Indices of the rows that stay, by all pairs."""
    sets = []
    for t in rows:
        w = WORD.findall((t or "").translate(UP))
        sets.append({tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set())
    parent = list(range(len(sets)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                p, q = find(i), find(j)
                parent[max(p, q)] = min(p, q)
    return [k for k in range(len(sets)) if find(k) == k]


def changed_copies():
    random.seed(8)
    rows, vocabulary = [], [f"w{k}" for k in range(400)]
    for size in (4, 6, 12, 30, 60, 120, 200):
        body = random.choices(vocabulary, k=size)
        for n in (0, 0, 1, 1, 1, 2, 2, 3, 4, 5, 8):
            copy = list(body)
            for _ in range(n):
                copy[random.randrange(len(copy))] = random.choice(vocabulary)
            rows.append(" ".join(copy))
    return rows + [" ".join(random.choices(vocabulary[:2], k=k)) for k in (1, 1, 2, 3, 4, 4, 5, 5, 6, 7)]


@pytest.mark.parametrize("block", [jaccard_trees.BLOCK_SHINGLES, 300])
def test_near_copies_of_the_stage_match_all_pairs(spark, block, monkeypatch):
    monkeypatch.setattr(jaccard_trees, "BLOCK_SHINGLES", block)
    rows = changed_copies()
    got = stages.keep_one_of_each(documents(spark, [(k, t, "en", "a") for k, t in enumerate(rows)])).collect()
    want = least_of_each(rows, 5, 80)
    assert want != least_of_each(rows, 3, 90)
    assert sorted(r["doc_id"] for r in got) == want


def test_blocks_of_near_copies_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(jaccard_trees, "BLOCK_SHINGLES", 2000)
    held = []
    compare = jaccard_trees._compare

    def spy(members, *more):
        held.extend(r[0] for r in members.groupBy("cluster", "block").agg(F.sum(F.size("set"))).select("sum(size(set))").collect())
        return compare(members, *more)

    monkeypatch.setattr(jaccard_trees, "_compare", spy)
    body = [f"w{k}" for k in range(100)]
    rows = [" ".join([*body, f"end{k}"]) for k in range(200)]
    got = jaccard_trees.jaccard_components(documents(spark, [(k, t, "en", "a") for k, t in enumerate(rows)])).collect()
    assert {r["component_id"] for r in got} == {0}
    assert len(held) > 5 and max(held) <= 2 * 2000


def test_short_copies_and_lines_are_repeats(spark):
    line = "Please read the terms of use with care first.\n"
    passage = "One two three four five six seven. No. " + "And " * 15 + "so on.\n"
    rows = [(1, "Hello small world.", "en", "a"), (2, "Hello  small WORLD.", "en", "a"), (3, line + "Own text of three.\n\n" + passage, "en", "a"), (4, line + "Other text of four.\n\n" + passage, "en", "a"), (5, line + "\n" + line, "en", "a"), (None, "Hello small world. No.", "en", "a"), (6, None, "en", "a")]
    frame = documents(spark, rows)
    found = unit_dedup.repeated_units(frame)
    seen, want = {}, set()
    for k, t in sorted((r[:2] for r in rows if r[1]), key=lambda x: (x[0] is None, x[0])):
        for number, start, end, plain in unit_dedup.units(t):
            if plain and seen.setdefault(plain, (k, number)) != (k, number):
                want.add((k, number, start, end, seen[plain][0]))
    got = found.collect()
    assert {(r["doc_id"], r["unit_no"], r["start"], r["end"], r["kept_doc_id"]) for r in got} == want and len(got) == len(want)
    assert {r["doc_id"] for r in got if r["whole"]} == {2, 5, None}
    text = {r["doc_id"]: r["text"] for r in unit_dedup.strip_units(frame, unit_dedup.repeated_units(frame, least_run=20)).collect()}
    assert text == dict(r[:2] for r in rows) | {2: "", 4: line + "Other text of four.\n\n", 5: "", None: ""}


def test_short_and_plain_values_are_scored_as_their_windows():
    random.seed(9)
    draw = lambda n, of: "".join(random.choices(of, k=n))
    letters = "abcdefghijklmnopqrstuvwxyz"
    lines = [f"some words before, password = '{draw(random.randrange(6, 16), 'QXZWKJ')}' and words after" for _ in range(200)]
    net = secrets.train(*secrets.labelled_examples(lines))
    texts = ["", "é pin QXZWKJQX here", draw(300, "QXZWKJ") + " " + draw(200, letters), *(" ".join(draw(random.choice([5, 6, 9, 59, 60, 61, 63, 64, 65, 96, 97]), letters + "QXZWKJ") for _ in range(9)) for _ in range(40))]
    got = set(secrets.network_spans(texts, net))
    near = set()
    for i, t in enumerate(texts):
        for m in re.finditer(r"[A-Za-z0-9+/_=-]{6,}", t):
            p = net.probability(np.array(secrets.window(t, *m.span()))).max()
            if abs(p / net.threshold - 1) > 1e-3:
                assert ((i, *m.span()) in got) == (p >= net.threshold)
                near.add((i, *m.span()))
    assert len(near) > 250 and (1, 6, 14) in got


def test_threshold_keeps_the_recall_of_each_label(monkeypatch):
    random.seed(10)
    draw = lambda n: "".join(random.choices("abcdefghijklmnop", k=n))
    rows = [np.array(secrets.window(draw(8), 0, 8)[0]) for _ in range(400)]
    x, y = np.array(rows), np.array([1.0] * 100 + [0.0] * 300)  # nothing to tell them apart by
    monkeypatch.setattr(secrets, "EPOCHS", 1)
    net = secrets.train(x, y)
    assert (net.probability(x[:100]) >= net.threshold).mean() > 0.9
    assert secrets.train(x[99:], y[99:]).threshold <= 1  # one positive example


def test_the_scan_learns_from_every_character_of_every_row(spark):
    """values that only the ends of long texts have were not seen by a sample of cut texts; no order or cut of rows matters."""
    random.seed(11)
    draw = lambda n, of: "".join(random.choices(of, k=n))
    plain = lambda n: " ".join(draw(random.randrange(2, 12), "abcdefghij") for _ in range(n))
    texts = [plain(3000) + f' token = "{draw(40, "0123456789ABCDEF")}" {plain(5)}' for _ in range(24)]
    assert min(len(t) for t in texts) > 20_050
    frame = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None, ""])], "doc_id long, text string")
    net = secrets.learn(frame)
    assert net is not None
    again = secrets.learn(frame.repartition(5, "doc_id"))
    assert all((getattr(net, k) == getattr(again, k)).all() for k in secrets.NAMES) and net.threshold == again.threshold
    value = draw(40, "0123456789ABCDEF")
    found = {t[a:b] for t in [plain(400) + f" {value} " + plain(400)] for _, a, b in secrets.network_spans([t], net)}
    assert value in found and len(found) < 10


def test_examples_are_all_words_and_values(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("text IS NOT NULL").select("text")
    got = {tuple(r) for r in rows.mapInArrow(secrets._examples, "kind int, value string, after string").collect()}
    words, values, around = set(), set(), 0
    for (t,) in rows.collect():
        spans = secrets.base_spans(t)
        values |= {re.search(r"[A-Za-z0-9+/_.=-]+$", t[a:b]).group() for a, b, _ in spans}
        words |= {m.group() for m in re.finditer(r"[A-Za-z0-9+/_=-]{6,}", t) if not any(a < m.end() and m.start() < b for a, b, _ in spans)}
        around += -(-len(t) // secrets.CONTEXT_EACH)
    assert {v for k, v, _ in got if k == secrets.WORD_KIND} == words and {v for k, v, _ in got if k == secrets.VALUE_KIND} == values
    assert 0 < sum(k == secrets.AROUND_KIND for k, *_ in got) <= around


def test_few_values_are_learned_in_all_of_many_parts(spark, monkeypatch):
    random.seed(12)
    draw = lambda n, of: "".join(random.choices(of, k=n))
    monkeypatch.setattr(secrets, "PART_ROWS", 600)
    monkeypatch.setattr(secrets, "EPOCHS", 64)
    texts = [" ".join(draw(8, "abcdefghijkl") for _ in range(60)) + (f' token = "{draw(40, "0123456789")}"' if i % 5 == 0 else "") for i in range(40)]
    net = secrets.learn(spark.createDataFrame([(t,) for t in texts], "text string"))
    fresh = [draw(40, "0123456789") for _ in range(30)]
    found = list(secrets.network_spans([f"one two {v} three and more words then {draw(8, 'abcdefghijkl')}" for v in fresh], net))
    assert sum(b - a == 40 for _, a, b in found) >= 27 and sum(b - a == 8 for _, a, b in found) <= 3


def test_a_step_follows_the_slope(monkeypatch):
    """The step's slopes are those of the loss, by differences."""
    random = np.random.default_rng(13)
    x, y = random.integers(1, 100, (6, secrets.BODY + 2 * secrets.SIDE)), np.array([1.0, 0, 1, 0, 0, 1])
    net, state = secrets.untrained(random), secrets.Moments()
    weight = np.where(y > 0, 3.0, 1.0) / np.where(y > 0, 3.0, 1.0).sum()

    def loss(n):
        z = n.forward(x)[0]
        return float((weight * (np.logaddexp(0, z) - y * z)).sum())

    parts = {k: getattr(net, k).copy() for k in secrets.NAMES}
    secrets.step(secrets.Network(**{k: v.copy() for k, v in parts.items()}), x, y, np.arange(6), state, positive=3.0)
    for name in secrets.NAMES:
        slope = state.first[name] / 0.1
        for at in [np.unravel_index(k, slope.shape) for k in np.argsort(-np.abs(slope), axis=None)[:6]]:
            moved = []
            for d in (1e-6, -1e-6):
                own = {k: v.copy() for k, v in parts.items()}
                own[name][at] += d
                moved.append(loss(secrets.Network(**own)))
            assert abs((moved[0] - moved[1]) / 2e-6 - slope[at]) < 1e-4 * max(1, abs(slope[at]))


def test_sets_that_share_a_digest_are_told_apart():
    texts = pa.array(["one two three four", "five six seven eight", "ONE two  three four", ""])
    at, value = jaccard_trees.shingles(texts)
    sizes, node, second = jaccard_trees._digests(at, value, 4)
    assert node[0] == node[2] and second[0] == second[2] and len({*node.tolist()}) == 3
    _, apart, again = jaccard_trees._digests(at, value, 4, frozenset([int(node[0])]))
    assert apart[0] == apart[2] != node[0] and apart[1] == node[1] and again.tolist() == second.tolist()


def test_texts_of_one_id_meet_their_own_sets_only(spark):
    """Many different texts of one id and of none: a join by the id alone would make their number squared rows."""
    body = [f"w{k}" for k in range(60)]
    rows = [(None if k % 2 else 7, " ".join([*body, f"end{k}"]), "en", "a") for k in range(60)] + [(3, " ".join(body), "en", "a")]
    got = jaccard_trees.jaccard_components(documents(spark, rows)).collect()
    assert len(got) == 61 and {r["component_id"] for r in got} == {3}


def test_texts_that_share_a_passage_are_no_candidates(spark, monkeypatch):
    """A passage in all texts gives them common segments; their bitmaps keep them apart before any set is fetched."""
    random.seed(14)
    passage = " ".join(f"common{k}" for k in range(80))
    own = lambda k, n: " ".join(f"own{k}x{random.randrange(10**6)}" for _ in range(n))
    rows = [(k, f"{own(k, 200)} {passage} {own(k, 150)}", "en", "a") for k in range(300)]
    rows += [(1000 + k, rows[k][1] + f" end{k}", "en", "a") for k in range(5)]
    held, blocks = [], jaccard_trees._with_blocks
    monkeypatch.setattr(jaccard_trees, "_with_blocks", lambda members: (held.append(members.count()), blocks(members))[1])
    got = jaccard_trees.one_of_each(documents(spark, rows), width=5, percent=80)
    assert {r["doc_id"] for r in got.collect()} == set(range(300)) and held == [10]


def test_trees_prune_texts_that_are_only_alike():
    """Sets of one template with four shingles in five in common: few of all pairs come out of the traversal."""
    random.seed(15)
    base = [random.getrandbits(63) for _ in range(400)]
    sets = [np.unique(np.array([x if random.random() < 0.9 else random.getrandbits(63) for x in base], np.uint64).view(np.int64)) for _ in range(1500)]
    sets.sort(key=lambda x: int(jaccard_trees.minimum_hashes(np.zeros(len(x), np.int64), x.view(np.uint64), 1)[0]))
    tree = jaccard_trees.SignatureTree.of(sets, 16)
    left = sum(p.shape[1] for p in jaccard_trees.traverse(tree, tree, 90))
    assert left < 0.01 * 1500 * 1499 / 2


def test_candidates_in_blocks_are_those_of_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(jaccard_trees, "BLOCK_SETS", 3)
    monkeypatch.setattr(jaccard_trees, "FEW", 2)
    rows = changed_copies()
    batch = pa.RecordBatch.from_arrays([pa.array([5] * 8 + [6, 7, 7]), pa.array([*range(8), 1, 2, 2]), pa.array([16] * 11, pa.int16())], ["sig", "node", "words"])
    (out,) = jaccard_trees._shared(iter([batch]))
    assert out.to_pydict() == {"sig": [5] * 8, "node": [*range(8)], "words": [16] * 8, "block": [0, 0, 0, 1, 1, 1, 2, 2], "blocks": [3] * 8, "low": [0] * 8}
    at, value = jaccard_trees.shingles(pa.array(rows), 5)
    n, bits = np.bincount(at, minlength=len(rows)), jaccard_trees.bitmaps(at, value, len(rows))
    least = jaccard_trees.minimum_hashes(at, value, len(rows))
    found = []
    for i in range(0, len(rows), 20):
        for j in range(i, len(rows), 20):
            part = [k for k in range(len(rows)) if k // 20 * 20 in (i, j)]
            column = lambda x, part=part: pa.array([x[k] for k in part])
            width = pa.array([16] * len(part), pa.int16())
            table = pa.table({"sig": pa.array([1] * len(part)), "i": pa.array([i] * len(part)), "j": pa.array([j] * len(part)), "block": column([k // 20 * 20 for k in range(len(rows))]), "node": pa.array(part), "words": width})
            sketches = pa.table({"node": pa.array(part), "words": width, "n": column(n.tolist()), "least": column(least.tolist()), "bits": column([x.tobytes() for x in bits])})
            found.append(jaccard_trees._candidates(table, sketches, 80))
    edges = {(r["a"], r["b"]) for t in found for r in t.to_pylist()}
    root = list(range(len(rows)))
    for a, b in sorted(edges) * 9:
        root[a] = root[b] = min(root[a], root[b])
    one = (bits, n, n, n - np.bitwise_count(bits).sum(axis=1, dtype=np.int64))
    for a in range(len(rows)):
        for b in range(a):
            if n[a] and n[b] and jaccard_trees.could_link(one, one, np.array([[a], [b]]), 80)[0]:
                assert root[a] == root[b]


def test_rows_without_words_and_repeated_rows_of_a_stage(spark):
    """Rows without words all stay, of equal rows one does, and neither depends on how the rows are dealt."""
    rows = [(k % 3, t) for k, t in enumerate([None, "", " \n", "a b c d e f g", "a b c d e f g", "a b c d e f g h", "\x85", None])]
    frame = spark.createDataFrame([(i, t, "en", "s", k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long")
    want = None
    for parts in (1, 3, 8):
        got = sorted(((r["doc_id"], r["text"]) for r in jaccard_trees.one_of_each(frame.repartition(parts), width=5, percent=80).collect()), key=str)
        assert want is None or got == want
        want = got
    assert sum(t is None or not t.strip(" \n") for _, t in want) == 4 and [i for i, t in want if t == "\x85"] == [0]
    assert sum(bool(t) and t.startswith("a b") for _, t in want) == 2
