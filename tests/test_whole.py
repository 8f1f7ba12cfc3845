"""Queries return all rows that their counts speak of."""

from assaylake import queries as own


def test_every_id_over_the_threshold_is_a_row(spark):
    sf = "/root/testdata/sf0.01"
    counts = {r["cohort"]: (r["n_over"], r["ids"]) for r in own.QUERIES["A40_fp_table"](spark, sf).collect()}
    rows = own.QUERIES["A40_fp_ids"](spark, sf).collect()
    assert {c: sum(r["cohort"] == c for r in rows) for c in counts} == {c: n for c, (n, _) in counts.items()}
    assert any(n > len(ids.split(",")) for n, ids in counts.values())
