"""Best-fit packing of token sequences, improved by a swap-based local search.

Documents become token ids and one end id; longer ones are cut into full pieces, the first piece taking the rest.
Pieces are dealt into groups of bounded size by a hash. Each group is packed by best fit, longest first, and then
improved: pieces move between underfull bins, or swap one for one or two for one, whenever that raises the sum of
squared fills, until bins empty and no such change is left. What lies in bins that stay underfull is dealt into groups again and packed once more.

Defined results: a null text is empty and gives the end id alone. Repeated rows are packed each for itself; ties are
broken by id and piece. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, map_batches, per_worker, table

CAPACITY, END, GROUP, DISSOLVE = 2048, 0, 8192, 0.97
VOCABULARY = "byte_bpe_50k"
#: Characters for which both libraries surely use the same classes; any other text, or one with a special token, goes to ``tokenizers``.
PLAIN = re.compile(r"[^\x00-ɏΑ-ωА-я‐-‧‰-⁞€ぁ-ゖァ-ヺ一-龥]|<\|")
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = f"{PIECES}, sequence_id long, offset long"


def slow_encoder(vocabulary: str):
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(f"{vocabulary}.json"))


def fast_encoder(vocabulary: str):
    """The same vocabulary and pattern in a faster library; tests hold the two against each other."""
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def encode(text: str, vocabulary: str = VOCABULARY) -> list[int]:
    if PLAIN.search(text):
        return per_worker(f"slow {vocabulary}", lambda: slow_encoder(vocabulary)).encode(text, add_special_tokens=False).ids
    return per_worker(f"fast {vocabulary}", lambda: fast_encoder(vocabulary)).encode_ordinary(text)


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, vocabulary: str = VOCABULARY) -> DataFrame:
    def rows(b: pa.RecordBatch) -> pa.RecordBatch:
        out: list[tuple] = []
        for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            ids = np.array([*encode(text or "", vocabulary), END], "<u4")
            edge = (len(ids) - 1) % capacity + 1
            bounds = [0, *range(edge, len(ids) + 1, capacity)]
            out += [(i, k, s, e - s, zlib.crc32(ids[s:e].tobytes())) for k, (s, e) in enumerate(zip(bounds, bounds[1:]))]
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], [x.split()[0] for x in PIECES.split(", ")])

    return map_batches(docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")), rows, PIECES)


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of places in lengths: longest first, each into the fullest bin that has room."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r: a bin has room r
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        n = lengths[i]
        fits = rooms >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, b = capacity, len(bins)
            bins.append([])
        bins[b].append(i)
        by_room[room - n].append(b)
        rooms |= 1 << (room - n)
    return bins


class Bins:
    """Bins by what they hold, and tables of which lengths could be taken out of which."""

    def __init__(self, bins: list[list[int]], lengths: list[int], capacity: int):
        self.capacity, self.held = capacity, []
        for b in bins:
            kinds: dict[int, list[int]] = {}
            for i in b:
                kinds.setdefault(lengths[i], []).append(i)
            self.held.append(kinds)
        self.fill = np.array([*(sum(lengths[i] for i in b) for b in bins), 2 * capacity])  # the last stands for none

    def look_up(self) -> None:
        """one, two: by length, or sum of two lengths, the two emptiest bins that hold such a piece, or pair."""
        self.one, self.two = np.full((2, 2, self.capacity + 1), len(self.held))
        for b in np.argsort(-self.fill[:-1], kind="stable").tolist():
            if not 0 < self.fill[b] < self.capacity:
                continue
            kinds = np.array(list(self.held[b]))
            several = kinds[[len(x) > 1 for x in self.held[b].values()]]
            pairs = np.unique(np.concatenate([(kinds[:, None] + kinds)[np.triu_indices(len(kinds), 1)], 2 * several]))
            for table, found in ((self.one, kinds), (self.two, pairs)):
                table[1, found] = table[0, found]
                table[0, found] = b

    def pair(self, b: int, size: int) -> tuple[int, ...]:
        held = self.held[b]
        return next(((x, size - x) for x in held if size - x in held and (2 * x != size or len(held[x]) > 1)), ())

    def exchange(self, high: int) -> bool:
        """The largest gain of a bin by a move, or by one or two pieces for one, from a bin that is no fuller; False: none."""
        room, gain, best = self.capacity - int(self.fill[high]), 0, None
        for give in (0, *self.held[high]):
            top = min(give + room, self.capacity)
            for table, two in ((self.one, False), (self.two, True)):
                low = give + gain + 1
                if low > top or two and not give:
                    continue
                some = table[:, low : top + 1]
                fine = (some != high) & (self.fill[some] <= self.fill[high])
                for k in np.flatnonzero(fine.any(0))[::-1].tolist():
                    b = int(some[0, k] if fine[0, k] else some[1, k])
                    bring = self.pair(b, low + k) if two else ((low + k,) if low + k in self.held[b] else ())
                    if bring:  # the tables may be older than the bin
                        gain, best = low + k - give, (give, b, bring)
                        break
            if gain == room:
                break
        if best:
            give, b, bring = best
            for x in bring:
                self.move(b, high, x)
            if give:
                self.move(high, b, give)
        return best is not None

    def move(self, source: int, to: int, length: int) -> None:
        kinds = self.held[source]
        self.held[to].setdefault(length, []).append(kinds[length].pop())
        if not kinds[length]:
            del kinds[length]
        self.fill[source] -= length
        self.fill[to] += length


def improve(bins: list[list[int]], lengths: list[int], capacity: int) -> list[list[int]]:
    """Local search. Each exchange moves weight into a bin from one no fuller, so the sum of squared fills rises, until none is left."""
    x = Bins(bins, lengths, capacity)
    least, changed = -(-int(x.fill[:-1].sum()) // capacity), True
    while changed and np.count_nonzero(x.fill[:-1]) > least:
        changed = False
        x.look_up()
        for high in np.argsort(-x.fill[:-1], kind="stable").tolist():
            while 0 < x.fill[high] < capacity and x.exchange(high):
                changed = True
    return [[i for same in kinds.values() for i in same] for kinds in x.held if kinds]


def pack_group(group: pa.Table, capacity: int, first: int) -> pa.Table:
    group = group.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending")])
    lengths = group.column("length").to_pylist()
    number = group.column("grp")[0].as_py()
    whole = sum(n == capacity for n in lengths)
    rest = [i + whole for i in range(len(lengths) - whole)]
    short = lengths[whole:]
    bins = [[i] for i in range(whole)]
    bins += [[rest[i] for i in b] for b in improve(best_fit(short, capacity), short, capacity)]
    seq, off, fill = (np.zeros(len(lengths), np.int64) for _ in range(3))
    for k, b in enumerate(bins):
        at = 0
        for i in b:
            seq[i], off[i] = k, at
            at += lengths[i]
        fill[b] = at
    names = [x.split()[0] for x in PIECES.split(", ")]
    out = group.select(names).append_column("sequence_id", pa.array(first + (number << 32) + seq)).append_column("offset", pa.array(off))
    return out.append_column("fill", pa.array(fill))


def dealt(rows: DataFrame, n: int, size: int = GROUP) -> DataFrame:
    """rows with a group each. Rows may be equal, so a running number takes part in the hash; rows must be a written table."""
    groups = max(1, -(-n // size))
    return rows.withColumn("grp", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.monotonically_increasing_id()), F.lit(groups)))


def packed(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per piece: its place in the documents' ids and its place in a sequence."""
    parts = cut(pieces(docs, capacity=capacity, vocabulary=vocabulary))
    schema = f"{PLACED}, fill long"
    first = cut(dealt(parts, parts.count()).groupBy("grp").applyInArrow(lambda t: pack_group(t, capacity, 0), schema))
    loose = F.col("fill") < int(DISSOLVE * capacity)
    again = first.where(loose)
    second = dealt(again.drop("sequence_id", "offset", "fill"), again.count()).groupBy("grp").applyInArrow(lambda t: pack_group(t, capacity, 1 << 62), schema)
    return first.where(~loose).unionByName(second).drop("fill")


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))
