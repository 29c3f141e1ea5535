"""Best-fit packing of token pieces into fixed-length sequences by bin
completion.

A sequence is opened for the largest piece left. A branch-and-bound search
enumerates the fillings of the room beside it: longest pieces first, a branch
is cut when even the largest pieces that still fit cannot beat the incumbent's
waste, and the incumbent starts as the best-fit filling. A filling dominated
by another (one of its pieces could be swapped for a longer one that still
fits) always leaves more room, so it loses to the incumbent.

Repeating the least-waste filling can leave lengths that go badly together. So
the whole plan is searched too: its incumbent is the smaller of that plan and
best-fit decreasing; branches are other fillings and fewer repeats of one,
those nearest to the first choices before others, each completed by best fit
and cut where a lower bound on the rest cannot beat the incumbent.

Only lengths matter, and a length is at most ``capacity``. So the plan is made
from the histogram of lengths (at most ``capacity`` rows whatever the corpus)
and one filling is applied to as many sequences as its scarcest length allows.
The pieces then look up their place: the r-th piece of a length falls into the
r-th place planned for that length. Ranks come from a salted two-level count,
so one very common length is not one task's work.

Cases: a null or empty text is one piece holding only the end id; a longer
document is cut into pieces of ``capacity``; equal and repeated rows are packed
each for itself; an empty table gives an empty result; other columns of the
input are not read.
"""

from __future__ import annotations

import struct
import zlib
from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ingot.llm.common import shuffle_partitions, written
from ingot.llm.tokens import worker_encoder

CAPACITY = 4096
SEARCH_NODES = 3000          # fillings looked at for one sequence before the incumbent is taken
PLAN_NODES = 100_000         # steps of the search over whole plans before its incumbent is taken
PLAN_DEPTH, FILLING_NODES, FANOUT = 40, 400, 8      # fillings chosen in turn; looked at and tried for each
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def best_filling(lengths: np.ndarray, counts: np.ndarray, room: int, nodes: int = SEARCH_NODES) -> list[int]:
    """Lengths (with repeats, longest first) whose sum is as near to ``room``
    as found, from an ascending length table with counts. Exact unless the
    node budget ends first; never worse than the best-fit filling."""
    best: list[int] = []
    best_sum = -1
    chosen: list[int] = []
    budget = nodes
    # the most that all pieces of lengths[:i + 1] can fill
    reach = np.cumsum(lengths * counts)

    def search(top: int, room_left: int, total: int) -> bool:
        """True when a filling without waste is found or the budget is gone.
        Goes one level deeper for each different length."""
        nonlocal best, best_sum, budget
        if total > best_sum:
            best, best_sum = chosen.copy(), total
        if total == room or budget <= 0:
            return True
        for i in range(min(top, int(np.searchsorted(lengths, room_left, "right")) - 1), -1, -1):
            if total + min(room_left, int(reach[i])) <= best_sum:
                return False
            x = int(lengths[i])
            for times in range(min(int(counts[i]), room_left // x), 0, -1):
                budget -= 1
                chosen.extend([x] * times)
                done = search(i - 1, room_left - times * x, total + times * x)
                del chosen[-times:]
                if done:
                    return True
        return False

    search(len(lengths) - 1, room, 0)
    return best


def best_fit_decreasing(hist: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """The plan of best-fit decreasing, without a step per piece: sequences of
    one filling are a group. A sequence that got a piece is the fullest one
    that still has room, so it gets pieces of that length until none fits."""
    rooms: list[int] = []                        # the different rooms left, ascending
    groups: dict[int, list] = {}                 # room -> [(filling as (length, times) pairs, sequences)]

    def put(room: int, filling: tuple, n: int) -> None:
        if n and room not in groups:
            insort(rooms, room)
            groups[room] = []
        if n:
            groups[room].append((filling, n))

    for x in sorted(hist, reverse=True):
        left = hist[x]
        while left:
            k = bisect_left(rooms, x)
            if k < len(rooms):
                room = rooms[k]
                filling, n = groups[room].pop()
                if not groups[room]:
                    del groups[room], rooms[k]
            else:
                room, filling, n = capacity, (), -(-left // (capacity // x))
            each = room // x
            full = min(n, left // each)
            part = left - full * each if full < n else 0     # what one more sequence gets
            put(room - each * x, (*filling, (x, each)), full)
            if part:
                put(room - part * x, (*filling, (x, part)), 1)
            put(room, filling, n - full - (part > 0))
            left -= full * each + part
    return [([x for x, k in filling for _ in range(k)], n) for g in groups.values() for filling, n in g]


def fewest_sequences(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> int:
    """A lower bound (Martello and Toth's L2): pieces above half the capacity
    have a sequence each, pieces of at least x share none with those above
    ``capacity - x``. And of pieces above a k-th of it, k - 1 share one."""
    n, total = (np.concatenate(([0], np.cumsum(x))) for x in (counts, lengths * counts))
    half = int(np.searchsorted(lengths, capacity // 2, "right"))
    top = np.searchsorted(lengths, capacity - lengths[:half], "right")
    spare = (n[top] - n[half]) * capacity - (total[top] - total[half])
    more = -(-(total[half] - total[:half] - spare) // capacity)
    k = np.arange(2, 65)
    above = n[-1] - n[np.searchsorted(lengths, capacity // k, "right")]
    return int(max(-(-total[-1] // capacity), n[-1] - n[half] + max(0, more.max(initial=0)), (-(-above // (k - 1))).max()))


def _fillings(lengths: np.ndarray, counts: np.ndarray, room: int, nodes: int) -> tuple[list[list[int]], int]:
    """Maximal fillings of a room, the least waste first, and the nodes used."""
    found: list[tuple[int, list[int]]] = []
    have, left = list(zip(lengths.tolist(), counts.tolist(), strict=True)), nodes

    def search(i: int, room_left: int, chosen: list[int], spared: int) -> None:
        """``spared`` is the shortest length of which a piece was left out."""
        nonlocal left
        while i >= 0 and have[i][0] > room_left:
            i -= 1
        left -= 1
        if i < 0 or left <= 0:
            if room_left < spared:
                found.append((room_left, chosen))
            return
        x, n = have[i]
        most = min(n, room_left // x)
        for times in range(most, -1, -1):
            search(i - 1, room_left - times * x, chosen + [x] * times, min(spared, x) if times < n else spared)
            if left <= 0:
                return

    search(len(have) - 1, room, [], room + 1)
    return [f for _, f in sorted(found, key=lambda f: f[0])[:FANOUT]], nodes - left


def _greedy(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> list[tuple[list[int], int]]:
    """The least-waste filling of the largest piece, as often as it can be had."""
    plan = []
    while len(lengths):
        top = int(lengths[-1])
        counts[-1] -= 1
        filling = [top, *best_filling(lengths, counts, capacity - top)]
        counts[-1] += 1
        times, lengths, counts = _take(lengths, counts, filling, None)
        plan.append((filling, times))
    return plan


def _take(lengths: np.ndarray, counts: np.ndarray, filling: list[int], times: int | None):
    """What is left after ``times`` sequences of a filling, or as many as there can be."""
    use, need = np.unique(filling, return_counts=True)
    at = np.searchsorted(lengths, use)
    times = int((counts[at] // need).min()) if times is None else times
    counts = counts.copy()
    counts[at] -= times * need
    keep = counts > 0
    return times, lengths[keep], counts[keep]


def _size(plan) -> int:
    return sum(times for _, times in plan)


def plan_sequences(hist: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """``[(lengths of a sequence, how many such sequences)]`` from a histogram
    of lengths: the smallest plan found, never above best-fit decreasing."""
    lengths = np.array(sorted(hist), np.int64)
    counts = np.array([hist[x] for x in lengths.tolist()], np.int64)
    if not len(lengths):
        return []
    best = min(_greedy(lengths, counts, capacity), best_fit_decreasing(hist, capacity), key=_size)
    bound, budget = fewest_sequences(lengths, counts, capacity), PLAN_NODES

    def search(lengths, counts, plan, used: int, depth: int, odd: int) -> None:
        """Completes a partial plan by best fit, then tries its next fillings;
        ``odd`` is how far choices may still lie from the first ones."""
        nonlocal best, budget
        if used + (fewest_sequences(lengths, counts, capacity) if len(lengths) else 0) >= _size(best):
            return
        rest = best_fit_decreasing(dict(zip(lengths.tolist(), counts.tolist(), strict=True)), capacity)
        budget -= 20 + 4 * len(lengths)
        if used + _size(rest) < _size(best):
            best = plan + rest
        if not len(lengths) or depth == PLAN_DEPTH:
            return
        top = int(lengths[-1])
        one = counts.copy()
        one[-1] -= 1
        fillings, nodes = _fillings(lengths, one, capacity - top, FILLING_NODES)
        budget -= nodes
        tries = []
        for k, f in enumerate(fillings):
            most = _take(lengths, counts, [top, *f], None)[0]
            tries += [(k + j, [top, *f], t) for j, t in enumerate(dict.fromkeys((most, -(-most // 2), 1)))]
        for far, filling, times in sorted(tries, key=lambda x: x[0]):
            if far > odd or budget <= 0 or _size(best) <= bound:
                return
            _, some, left = _take(lengths, counts, filling, times)
            search(some, left, [*plan, (filling, times)], used + times, depth + 1, odd - far)

    for odd in range(PLAN_DEPTH):
        if budget <= 0 or _size(best) <= bound:
            break
        search(lengths, counts, [], 0, 0, odd)
    return best


def token_pieces(docs: DataFrame, tokenizer: str, kind: str, end_id: int = 1, capacity: int = CAPACITY) -> DataFrame:
    """Pieces ``(doc_id, piece, start, length, ids_crc32)`` of every document."""
    end = struct.pack("<I", end_id)

    def cut(batches):
        enc = worker_encoder(tokenizer, kind)
        for pdf in batches:
            rows = []
            for d, ids in zip(pdf["doc_id"], enc.encode_batch(pdf["text"]), strict=True):
                ids += end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    rows.append((d, k, at // 4, len(part) // 4, zlib.crc32(part)))
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    return docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(cut, PIECES)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces with a ``length``. The
    pieces are first written down, so ranks hold if a task runs again."""
    salts = shuffle_partitions(pieces.sparkSession)
    salted = written(pieces.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)).cast("int")),
                     "pieces")
    # at most capacity x salts rows, whatever the corpus
    cells = salted.groupBy("length", "_salt").agg(F.count("*").alias("n"))
    hist = {r[0]: r[1] for r in cells.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    by_length: dict[int, list] = {x: [] for x in hist}
    used = {x: 0 for x in hist}
    first = 0
    for filling, times in plan_sequences(hist, capacity):
        at = 0
        for x in filling:
            by_length[x].append((used[x], first, at))
            used[x] += times
            at += x
        first += times
    table = {x: np.array(v, np.int64).T for x, v in by_length.items()}

    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("_before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    within = Window.partitionBy("length", "_salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = salted.withColumn("_r", F.row_number().over(within) - 1) \
        .join(cells, ["length", "_salt"]).withColumn("_rank", F.col("_before") + F.col("_r")) \
        .drop("_salt", "_r", "_before")

    def place(batches):
        for pdf in batches:
            seq = np.zeros(len(pdf), np.int64)
            off = np.zeros(len(pdf), np.int64)
            rank = pdf["_rank"].to_numpy()
            for x, rows in pdf.groupby("length").indices.items():
                starts, firsts, offsets = table[int(x)]
                k = np.searchsorted(starts, rank[rows], "right") - 1
                seq[rows] = firsts[k] + rank[rows] - starts[k]
                off[rows] = offsets[k]
            yield pdf.drop(columns="_rank").assign(sequence_id=seq, offset=off)

    cols = [c for c in ranked.columns if c != "_rank"]
    types = dict(ranked.dtypes)
    schema = ", ".join(f"`{c}` {types[c]}" for c in cols) + ", sequence_id long, offset long"
    return ranked.select(*cols, "_rank").mapInPandas(place, schema) \
        .select(*[c for c in pieces.columns], "sequence_id", "offset")
