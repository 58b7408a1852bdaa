"""Best-fit packing of documents into sequences of ``capacity`` words.

A document longer than the capacity is cut into full pieces and a remainder. Lengths are numbers
of white-space separated words, so a length is one of ``capacity`` values whatever the data's size.

1. Pieces are range-sorted by length, longest first, then by doc_id and piece; a piece's rank among
   those of its length follows from its place in its range and the sizes of the ranges before it. No
   length, however common, is sorted by one task alone.
2. The gaps of open sequences are range-sorted too, held as runs: sequences of successive numbers
   with the same gap. Pieces of one length are a run as well.
3. Rounds: the longest pieces left take their successor, the run of least gap that holds them; each
   sequence of that run takes as many as fit. Where no gap holds them they open new sequences.
4. Conflicts are resolved by rank: of the pieces of a length the k-th takes the k-th free slot of
   the run, and the pieces beyond go on to the next round.
5. The gaps of the run are updated, and it goes back among the runs by its new gap.

The result is that of sequential best-fit decreasing. A round changes runs, not rows: a round
empties a length or a run, and a length leaves at most three new runs, so rounds and runs
depend on the capacity alone. They are swept on the driver, and each piece then finds its
sequence by its rank from the list of matches, in one join.

Nulls, ties, extremes: documents that are null, empty or blank have no pieces and are not in the
result; rows with a null doc_id are packed too. Pieces of equal length are ranked by doc_id, then
piece; repeated rows are packed each for themselves. An empty table gives an empty result. Other
columns are not read.
"""

from __future__ import annotations

import bisect

import numpy as np
from pyspark.sql import DataFrame, functions as F

from .store import Scratch

CAPACITY = 2048
RESULT = "doc_id long, piece int, sequence long, place long, n_words int"
_LOCAL = 33  # bits of a row's number within its partition in monotonically_increasing_id


def sweep(counts: np.ndarray, capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Matches for counts of pieces by length: (length, rank from, n pieces, pieces in each sequence, first sequence, words before).
    The pieces of that length and rank from..from+n-1 go in order of rank into sequences first, first+1 and so on."""
    out: list[tuple[int, int, int, int, int, int]] = []
    runs: dict[int, list[tuple[int, int]]] = {}  # gap: (first sequence, number of sequences), last come first served
    gaps: list[int] = []  # those that have runs, ascending
    opened = 0

    def put(gap: int, first: int, n: int) -> None:
        if gap and n:
            if gap not in runs:
                runs[gap] = []
                bisect.insort(gaps, gap)
            runs[gap].append((first, n))

    for size in range(len(counts) - 1, 0, -1):
        rank, left = 0, int(counts[size])
        while left:
            at = bisect.bisect_left(gaps, size)
            if at < len(gaps):
                gap = gaps[at]
                first, n = runs[gap].pop()
                if not runs[gap]:
                    del runs[gap], gaps[at]
            else:
                gap, first, n = capacity, opened, -(-left // (capacity // size))
                opened += n
            each = gap // size
            take = min(left, n * each)
            out.append((size, rank, take, each, first, capacity - gap))
            full, some = divmod(take, each)
            put(gap - each * size, first, full)
            if some:
                put(gap - some * size, first + full, 1)
            put(gap, first + full + bool(some), n - full - bool(some))
            rank, left = rank + take, left - take
    return out


def pieces_of(docs: DataFrame, capacity: int) -> DataFrame:
    words = F.size(F.split(F.trim(F.regexp_replace("text", r"\s+", " ")), " ")).cast("long")
    n = docs.where(F.col("text").rlike(r"\S")).select(F.col("doc_id").cast("long").alias("doc_id"), words.alias("w"))
    last = F.expr(f"cast((w + {capacity} - 1) div {capacity} as int)")
    cut = n.select("doc_id", "w", F.posexplode(F.sequence(F.lit(1), last)).alias("piece", "x"))
    return cut.select("doc_id", "piece", F.least(F.lit(capacity), F.col("w") - F.col("piece") * capacity).cast("int").alias("len"))


def pack(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, piece (from 0), sequence, place (words before it in its sequence), n_words."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    # written first: the range sort reads its input twice, and should not count words twice
    pieces = scratch.keep(pieces_of(docs, capacity), "pieces")
    rows = scratch.keep(pieces.orderBy(F.desc("len"), "doc_id", "piece").withColumn("m", F.monotonically_increasing_id()), "ranged")
    scratch.drop("pieces")
    # a few rows for each range: its rows, by length
    part = F.shiftright("m", _LOCAL).cast("int")
    parts = rows.groupBy(part.alias("part"), "len").agg(F.count("*").alias("n")).collect()
    if not parts:
        scratch.drop()
        return spark.createDataFrame([], RESULT)
    counts = np.zeros(capacity + 1, np.int64)
    of_part: dict[int, int] = {}
    for r in parts:
        counts[r["len"]] += r["n"]
        of_part[r["part"]] = of_part.get(r["part"], 0) + r["n"]
    before = np.cumsum(counts[::-1])[::-1] - counts  # pieces longer than each length
    offsets, total = [], 0
    for p in sorted(of_part):
        offsets.append((p, total))
        total += of_part[p]
    # both are bounded: by the number of ranges, and by the capacity
    starts = F.broadcast(spark.createDataFrame(offsets, "part int, start long"))
    made = [(size, int(before[size]) + rank, int(before[size]) + rank + n, each, first, used) for size, rank, n, each, first, used in sweep(counts, capacity)]
    plan = F.broadcast(spark.createDataFrame(made, "size int, lo long, hi long, each int, first long, used long"))
    mask = (1 << _LOCAL) - 1
    ranked = rows.join(starts, part == F.col("part")).select("doc_id", "piece", "len", (F.col("start") + F.col("m").bitwiseAND(F.lit(mask))).alias("g"))
    both = ranked.join(plan, (F.col("len") == F.col("size")) & (F.col("g") >= F.col("lo")) & (F.col("g") < F.col("hi")))
    k = F.col("g") - F.col("lo")
    return both.select(
        "doc_id",
        "piece",
        (F.col("first") + F.expr("(g - lo) div each")).alias("sequence"),
        (F.col("used") + F.col("len") * (k % F.col("each"))).cast("long").alias("place"),
        F.col("len").alias("n_words"),
    )
