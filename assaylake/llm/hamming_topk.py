"""Exact nearest binary codes by Hamming distance with incremental multi-index hashing.

Codes are cut into segments, each an index from its value to the codes that have it. A query probes the values at
radius 0, 1, 2, ... of its own segments; after radius r of all m segments every code within distance
m * (r + 1) - 1 has been seen, so a query is done once its kth verified distance is no more than that. The index is
one table of all codes by (segment, value), a round of probes is one join with it, and the k best so far of a query
are shared by all tasks: only unfinished queries go on. A pair that several segments find counts where its least
radius is first probed, so none is counted twice and no list of seen pairs is kept.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import discard, saved

K = 10
#: Bits of a segment at least and at most; in between, as many as number the codes.
NARROW, WIDE = 4, 24
#: Every so many ids are queries.
QUERY_EVERY = 50
#: Probes of a query in the first round.
FIRST = 512
#: Codes of a block where a query is held against all codes.
BLOCK = 1 << 20


def sign_code(vector: str, word: int = 0) -> Column:
    """The signs of 64 of the vector's numbers as a long: bit k is set if number 64 * word + k is above 0. Missing, null and
    NaN numbers count as 0."""
    number = lambda k: F.try_element_at(F.col(vector), F.lit(64 * word + k + 1))
    code = F.lit(0).cast("long")
    for k in range(64):
        code = code.bitwiseOR(F.when((number(k) > 0) & ~F.isnan(number(k)), F.shiftleft(F.lit(1).cast("long"), k)).otherwise(F.lit(0).cast("long")))
    return code


def segments(bits: int, width: int) -> list[tuple[int, int, int]]:
    """(word, first bit, bits) of each segment: the used bits of each word in parts of about ``width``."""
    out = []
    for word in range(-(-bits // 64)):
        used = min(64, bits - 64 * word)
        n = max(1, round(used / width))
        cuts = [used * k // n for k in range(n + 1)]
        out += [(word, a, b - a) for a, b in zip(cuts, cuts[1:])]
    return out


def _value(column: str, first: int, bits: int) -> Column:
    moved = F.shiftrightunsigned(F.col(column), first)
    return moved if bits == 64 else moved.bitwiseAND(F.lit((1 << bits) - 1))


def _distance(words: int) -> Column:
    return sum((F.bit_count(F.col(f"q{k}").bitwiseXOR(F.col(f"c{k}"))) for k in range(1, words)), F.bit_count(F.col("q0").bitwiseXOR(F.col("c0")))).cast("int")


def _best(found: DataFrame, words: int, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy("distance", *(f"c{i}" for i in range(words)))
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k).drop("place")


def search(entries: DataFrame, asked: DataFrame, bits: int, k: int, width: int | None = None) -> DataFrame:
    """query, c0, ..., distance: the k nearest codes of each query, ties by code.

    entries: distinct codes c0, ... of 64 bits each, with ``alone``, the id of a code that only one id has. asked: query
    (its key), q0, ..., own; a code whose ``alone`` is the query's own id is passed over.
    """
    spark, words = entries.sparkSession, -(-bits // 64)
    n = entries.count()
    cuts = segments(bits, width or max(NARROW, min(WIDE, n.bit_length())))
    code, probe = [f"c{i}" for i in range(words)], [f"q{i}" for i in range(words)]
    cells = F.array(*(F.struct(F.lit(j).alias("segment"), _value(f"c{w}", a, b).alias("value")) for j, (w, a, b) in enumerate(cuts)))
    index = saved(entries.select(*code, "alone", F.inline(cells)))
    # how far the pair's segments differ: it counts at the least radius, and there in the first such segment
    apart = [F.bit_count(_value(f"q{w}", a, b).bitwiseXOR(_value(f"c{w}", a, b))) for w, a, b in cuts]
    first = F.least(*(d * len(cuts) + j for j, d in enumerate(apart))) if len(cuts) > 1 else apart[0]
    foreign = F.col("alone").isNull() | F.col("own").isNull() | (F.col("alone") != F.col("own"))
    best, unfinished, widest = None, asked, max(b for _, _, b in cuts)
    radii = [0]  # radii of few probes are one round
    while radii[-1] < widest and sum(comb(b, r) for r in range(radii[-1] + 2) for _, _, b in cuts) <= FIRST:
        radii.append(radii[-1] + 1)
    while True:
        shapes = [(j, r, sum(1 << x for x in at)) for r in radii for j, (_, _, b) in enumerate(cuts) if comb(b, r) <= n for at in combinations(range(b), r)]
        last = sum(comb(b, r) for r in radii for _, _, b in cuts) > n or radii[-1] >= widest
        if last:  # no more codes than probes: the last unfinished queries meet all codes, in blocks
            blocks = max(1, -(-n // BLOCK))
            left = entries.withColumn("block", F.pmod(F.xxhash64(*code), F.lit(blocks)))
            right = unfinished.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
            pairs = left.join(right, "block").where(F.floor(first / len(cuts)) >= radii[0])
        else:
            masks = spark.createDataFrame(shapes, "segment int, radius int, mask long")
            cells = F.array(*(F.struct(F.lit(j).alias("segment"), _value(f"q{w}", a, b).alias("at")) for j, (w, a, b) in enumerate(cuts)))
            spots = unfinished.select("*", F.inline(cells)).join(F.broadcast(masks), "segment").withColumn("value", F.col("at").bitwiseXOR(F.col("mask")))
            pairs = index.join(spots, ["segment", "value"]).where(first == F.col("radius") * len(cuts) + F.col("segment"))
        found = pairs.where(foreign).select("query", *code, _distance(words).alias("distance"))
        old = [x for x in (best, unfinished) if x is not None and x is not asked]
        best = saved(_best(found if best is None else found.unionByName(best), words, k))
        if last:
            break
        covered = len(cuts) * (radii[-1] + 1) - 1
        done = best.where(F.col("distance") <= covered).groupBy("query").count().where(F.col("count") >= k)
        unfinished = saved(unfinished.join(done, "query", "left_anti"), *old)
        if unfinished.isEmpty():
            break
        radii = [radii[-1] + 1]
    discard(index)
    return best


def nearest(codes: DataFrame, queries: DataFrame, k: int = K, bits: int = 64) -> DataFrame:
    """query_id, rank, neighbour_id, distance: the k nearest rows (id, c0, c1, ...) for each such row of ``queries``.

    Rows of the query's own id are not its neighbours, however many codes the id has. Equal distances rank by code, then
    id. Rows without id or code are left out; rows that repeat an id and code count once. Fewer than k other rows give
    fewer rows; empty tables give none. Other columns are not looked at.
    """
    words = -(-bits // 64)
    code = [f"c{i}" for i in range(words)]
    full = " and ".join(f"{c} is not null" for c in ("id", *code))
    codes = saved(codes.where(full).select("id", *code).distinct())
    asked = queries.where(full).select("id", *code).distinct()
    by_code = codes.groupBy(*code).agg(F.count("*").alias("n"), F.min("id").alias("least"))
    entries = saved(by_code.select(*code, F.when(F.col("n") == 1, F.col("least")).alias("alone")))
    # an id with a code that no other id has must not meet it; all other queries of one code are one search
    owners = entries.where("alone is not null").select(F.col("alone").alias("id")).distinct().withColumn("own", F.col("id"))
    rows = asked.join(owners, "id", "left").select(F.col("id").alias("query_id"), "own", *(F.col(c).alias(c.replace("c", "q")) for c in code))
    key = ["own", *(c.replace("c", "q") for c in code)]
    rows = saved(rows.withColumn("query", F.concat_ws(",", F.coalesce(F.col("own").cast("string"), F.lit("")), *key[1:])))
    searches = saved(rows.select("query", *key).distinct())
    found = search(entries, searches, bits, k)
    # the least ids of each code: as many as a query can use
    ids = codes.withColumn("place", F.row_number().over(Window.partitionBy(*code).orderBy("id"))).where(F.col("place") <= k + 1).drop("place")
    pairs = found.join(ids, code).join(rows.select("query", "query_id", *key[1:]), "query").where("id <> query_id")
    rank = Window.partitionBy("query_id", *key[1:]).orderBy("distance", *code, "id")
    return pairs.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias("neighbour_id"), "distance")


def nearest_vectors(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", k: int = K) -> DataFrame:
    """``nearest`` by the vectors' sign codes, a bit for each number of the longest vector, with every row whose id is
    divisible by ``QUERY_EVERY`` as a query. Null vectors are left out."""
    whole = vectors.where(F.col(vector).isNotNull()).select(F.col(vec_id).cast("long").alias("id"), F.col(vector).alias("vector"))
    bits = max(1, whole.agg(F.max(F.size("vector"))).first()[0] or 0)
    codes = saved(whole.select("id", *(sign_code("vector", k).alias(f"c{k}") for k in range(-(-bits // 64)))))
    return nearest(codes, codes.where(F.col("id") % QUERY_EVERY == 0), k, bits)
