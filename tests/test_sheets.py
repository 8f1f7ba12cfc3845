"""Plate sheets, correctors of plates, and rings as wide as the nuclei tell."""

import numpy as np
from pyspark.sql import functions as F

from assaylake.operators import metadata, pixels
from assaylake.sources import readers


def cells(spark, rows):
    return spark.createDataFrame([(f, s, k, c) for k, (f, s, c) in enumerate(rows)], "file string, sheet string, row_no int, cells array<string>")


def wells(df):
    return {(r["plate"], r["well"]): r["cohort_id"] for r in df.collect()}


def row(letter, start=0, **at):
    """A sheet's row with ids at the given columns, counted from 1."""
    return [None] * start + [letter] + [at.get(f"c{k}", "x") for k in range(1, 13)] + ["C99"]


def test_sheet_of_one_plate(spark):
    """The wells that the assay's own test names, in a file of one plate."""
    rows = cells(spark, [("20200406_210102_953_final", "s", row("C", 2, c5="C50+55f")), ("20200406_210102_953_final", "s", row("H", 1, c12=" B85")), ("20200420_164920_764_final", "s", row("A", c2="B86"))])
    got = wells(metadata.single_plate_layout(rows))
    assert got["20200406_210102_953", "C05"] == "C50+55f" and got["20200420_164920_764", "A02"] == "B86"
    assert got["20200406_210102_953", "H12"] == "unknown"  # a cell that begins with a space fits no pattern
    assert len(got) == 36 and ("20200406_210102_953", "H13") not in got


def test_sheet_of_several_plates(spark):
    plates = {"Plate 9_5": ["plate9_5_IgM_20200605_084742_832", "plate9_5rep1_20200604_225512_896"], "Plate T3": ["plateT3rep1_20200509_152617_891"]}
    rows = [
        ("f", "1", row("A", c1="C1")),  # before any marker: nobody's
        ("f", "1", ["no", " Plate 9_5 ", "Plate T3"]), ("f", "1", row("A", 3, c8="C209 ")), ("f", "1", row("H", c6="EBV 59")),
        ("f", "1", ["x", None]), ("f", "1", row("a", c1="C7")), ("f", "1", []),
        ("f", "1", ["Plate T3"]), ("f", "1", row("C", c4="3-0099 E")), ("f", "1", row("C", c4="3-0100 E")),
        ("f", "2", ["Plate X"]), ("f", "2", row("B", c1="P126")), ("f", "2", ["Plate T3"]), ("f", "2", row("F", c10="3-0124 K")),
        ("f", "3", ["Plate X"]),
    ]
    got = wells(metadata.sheet_layout(cells(spark, rows), plates))
    for plate in plates["Plate 9_5"]:
        assert got[plate, "A08"] == "C209" and got[plate, "H06"] == "EBV 59" and got[plate, "A01"] == "unknown"
    t3 = {w: c for (p, w), c in got.items() if p == plates["Plate T3"][0]}
    assert t3["F10"] == "3-0124 K" and set(w[0] for w in t3) == {"F"}  # the last block takes the place of the one before
    assert not any(p == "Plate X" for p, _ in got)  # and so does one without wells
    assert set(p for p, _ in got) == {*plates["Plate 9_5"], *plates["Plate T3"]} and len(got) == 2 * 24 + 12
    assert wells(metadata.sheet_layout(cells(spark, rows)))["Plate 9_5", "A08"] == "C209"
    assert metadata.sheet_layout(cells(spark, rows).limit(0), plates).count() == 0


def test_the_last_row_of_a_well_counts(spark):
    rows = cells(spark, [("f", "1", ["Plate A"]), ("f", "1", row("C", c4="C1")), ("f", "1", row("C", c4="C2", c5="C3"))])
    got = wells(metadata.sheet_layout(rows))
    assert got["Plate A", "C04"] == "C2" and got["Plate A", "C05"] == "C3"


def test_sheets_are_read_from_files(spark, tmp_path):
    (tmp_path / "book").mkdir()
    (tmp_path / "book" / "one.csv").write_text('head,er\n,Plate 1,\n,,A,C1,"C2, late"\n\nB,C3\n')
    got = readers.sheets(spark, str(tmp_path), skip=1)
    assert [(r["file"], r["sheet"], r["row_no"], [c for c in r["cells"] if c]) for r in got.orderBy("row_no").collect()] == [("one", "book", 1, ["Plate 1"]), ("one", "book", 2, ["A", "C1", "C2, late"]), ("one", "book", 4, ["B", "C3"])]
    assert wells(metadata.sheet_layout(got))["Plate 1", "A02"] == "C2, late"


def test_moments_of_parts_are_those_of_all(spark):
    rng = np.random.default_rng(2)
    n, side = {"p": 7, "q": 3}, 6
    v = {(p, k): 1e6 + 600 + 50 * rng.random((side, side)) for p in n for k in range(n[p])}
    rows = [(p, f"{p}{k}", "s", y, x, float(a[y, x])) for (p, k), a in v.items() for y in range(side) for x in range(side)]
    table = spark.createDataFrame(rows, "plate string, image string, channel string, y int, x int, v double")
    bad = spark.createDataFrame([("p0", 1), ("q1", 0)], "image string, is_outlier int")
    parts = [pixels.corrector_moments(table.where(F.pmod(F.xxhash64("image"), F.lit(3)) == k), bad) for k in range(3)]
    merged = pixels.merged_moments(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    got = {(r["plate"], r["y"], r["x"]): (r["n"], r["mean"], r["m2"]) for r in merged.collect()}
    for p in n:
        stack = np.stack([a for (q, k), a in v.items() if q == p and (p, k) != ("p", 0)])
        for y in range(side):
            for x in range(side):
                c, mean, m2 = got[p, y, x]
                assert c == len(stack) and np.isclose(mean, stack[:, y, x].mean(), rtol=1e-12) and np.isclose(m2, stack[:, y, x].var() * c, rtol=1e-6)
    shares = {p: np.stack([a for (q, k), a in v.items() if q == p and (p, k) != ("p", 0)]).mean(0) - 550 for p in n}
    want = sum(w * shares[p] / shares[p].mean() for p, w in (("p", 6), ("q", 3))) / 9
    flat = {(r["y"], r["x"]): r["divisor"] for r in pixels.corrector(merged, 550, 0).collect()}
    assert all(np.isclose(flat[y, x], want[y, x]) for y, x in flat) and len(flat) == side * side
    smooth = pixels.corrector(merged, 550, 1.0).collect()
    assert np.std([r["divisor"] for r in smooth]) < np.std(want) and {r["offset"] for r in smooth} == {550.0}
    corrected = pixels.illumination_correct(table, pixels.corrector(merged, 550, 1.0))
    assert corrected.count() == len(rows)


def test_rings_are_as_wide_as_the_nuclei_tell(spark):
    small, large = np.zeros((20, 20), int), np.zeros((20, 20), int)
    small[3:5, 3:5], small[12:15, 12:15], small[3:5, 14:16] = 1, 2, 3
    large[4:10, 4:10] = 7
    images = {"s": small, "l": large, "none": np.zeros((5, 5), int)}
    table = spark.createDataFrame([(k, y, x, int(a[y, x])) for k, a in images.items() for y in range(len(a)) for x in range(len(a))], "image string, y int, x int, seed int")
    radius = pixels.ring_radius(table, 0.8)
    assert {r["image"]: r["radius"] for r in radius.collect()} == {"s": int(0.8 * np.sqrt(4)), "l": int(0.8 * np.sqrt(36)), "none": 0}
    for drop in (False, True):
        got = {(r["image"], r["y"], r["x"]): r["label"] for r in pixels.nearest_seed(table, pixels.ring_radius(table, 1.4), drop).collect()}
        assert len(got) == table.count()
        for k, a in images.items():
            ids, n = np.unique(a[a > 0], return_counts=True)
            reach = int(1.4 * np.sqrt(np.median(n))) if len(n) else 0
            for y in range(len(a)):
                for x in range(len(a)):
                    d = [((y - i) ** 2 + (x - j) ** 2, a[i, j]) for i, j in np.argwhere(a)]
                    near = min(d, default=(1e9, 0))
                    want = (0 if drop else a[y, x]) if a[y, x] else near[1] if near[0] < reach**2 else 0
                    assert got[k, y, x] == want
            assert {v for (q, *_), v in got.items() if q == k} == set(ids) | {0}
