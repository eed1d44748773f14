"""Language-model scoring by a hierarchical Pitman-Yor model.

Every token seen as a context has a restaurant of its own; all of them share one parent, the restaurant without a
context, whose base is uniform over the V known tokens and one for all unknown ones. The c customers of a dish in a
context restaurant sit at t tables, and each table sends a customer to the parent. Given all other seatings, t has the
probability S(c, t) * prod(j < t) (THETA + D * (T + j)) * P(n + j), where S counts the ways to seat c customers at t tables
(generalized Stirling numbers), T are the tables of the other dishes of the restaurant, and P is the parent's probability
of the dish with n customers from other restaurants. A Gibbs step lifts a dish out of its restaurant and draws t from
that: exactly for c up to EXACT; beyond, by Metropolis steps with saddle-point values of S. The parent's own tables are
summed out. Probabilities are averaged over SAMPLES seatings.

How it is laid out: texts are read in chunks of some megabytes. A chunk sends one packed row to each bucket of dishes:
its distinct (dish, context) pairs and in which of its documents they occur. A bucket holds all that is known of its
dishes; what contexts lack, their customers and tables over all dishes, is summed by exchanges in which contexts, too,
are dealt out: one before the first sweep, one after each round of ROUNDS, one after the samples. In between, a bucket goes by its
own seatings as they are and those of the others as they were at the exchange (in the first round, by the
share of customers that have got tables so far). A bucket draws its pairs in BLOCKS parts, each given the others. Dishes
with a share above 1 / HOT of all tokens (HOT of them at most) are spread over all buckets by context, and summed in the
same exchanges. Rows are as many as chunks times buckets or buckets squared at most, and never more than pairs.

Contexts are told apart by 48 bits of a hash, dishes by 64.

Defined results: a null or empty text is the end token alone. Repeated rows are each learnt from and scored. A null id
is not held out. Without any training row every token is unknown. An empty table gives an empty result.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import as_bytes, cut, per_worker, table

D, THETA = 0.75, 0.5  # discount and strength of context restaurants
ROOT_D, ROOT_THETA = 0.5, 1.0
ROUNDS, SAMPLES, THIN = (5, 3), 3, 2  # sweeps before each exchange, samples after the last, sweeps before each sample
EXACT, BLOCKS, STEPS, FAR = 256, 3, 6, 30.0  # FAR: weights below the largest by more than its power of e are left out
TABLED = 4096  # customers up to which the parent's expected tables are computed, not extended
CHUNK_BYTES, CHUNK_DOCS, BUCKET_TOKENS, HOT = 4_000_000, 60_000, 3_500_000, 2000
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
END = 0x5851F42D4C957F2D  # stands for the end of a text, and for the context of its first word
SPLIT = 0xD6E8FEB86659FD93
SCHEMA = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double"


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(SPLIT)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(SPLIT)
    return h ^ (h >> np.uint64(32))


def pack(*arrays: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(arrays, protocol=5))


def unpack(blob: bytes) -> tuple:
    return pickle.loads(zstandard.ZstdDecompressor().decompress(blob))


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, each text's words and its end, and the bounds of the texts among them."""
    buf = np.frombuffer(b" ".join(t.lower() for t in texts) + b" ", np.uint8)
    ink = ~((buf == 32) | ((buf >= 9) & (buf <= 13)))
    edge = np.diff(ink.astype(np.int8), prepend=0)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    power = np.full(len(buf), BASE, np.uint64)  # arrays of a chunk's length are few and used again
    power[0] = 1
    total = buf.astype(np.uint64)
    total += np.uint64(1)
    total *= np.cumprod(power, out=power)
    np.cumsum(total, out=total)
    before = np.where(start > 0, total[start - 1], np.uint64(0))
    h = total[end - 1] - before
    del total
    power[:] = INVERSE
    power[0] = 1
    h = mix(h * np.cumprod(power, out=power)[start])
    cuts = np.searchsorted(start, np.cumsum([0, *(len(t) + 1 for t in texts)]))
    return np.insert(h, cuts[1:], np.uint64(END)), cuts + np.arange(len(cuts))


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[bytes]]]:
    """Ids and texts of up to CHUNK_BYTES together; one text more if a text alone is longer."""
    ids, texts, size = [], [], 0
    for b in batches:
        for i, t in zip(b.column(0).to_pylist(), as_bytes(b.column(1))):
            t = t or b""
            if texts and (size + len(t) > CHUNK_BYTES or len(texts) >= CHUNK_DOCS):
                yield ids, texts
                ids, texts, size = [], [], 0
            ids.append(i)
            texts.append(t)
            size += len(t)
    if texts:
        yield ids, texts


def learnt(ids: list) -> np.ndarray:
    return np.array([i is None or zlib.crc32(str(i).encode()) % 7 != 2 for i in ids])


def heavy(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Dishes with a share above 1 / HOT of all tokens, and the number of tokens.

    Chunks report dishes above half that share, at most 2 * HOT each, so a dish may be missed up to 1.5 / HOT.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in chunks(batches):
            words, n = np.unique(tokens(texts)[0], return_counts=True)
            most = n * 2 * HOT >= n.sum()
            w = np.concatenate([words[most].view(np.int64), [0]])
            yield pa.RecordBatch.from_arrays([pa.array(w), pa.array(np.concatenate([n[most], [n.sum()]]))], ["w", "n"])

    found = cut(docs.mapInArrow(count, "w long, n long").groupBy("w").agg(F.sum("n").alias("n")))
    total = found.where("w = 0").agg(F.sum("n")).first()[0] or 0
    rows = found.where("w <> 0").where(F.col("n") * HOT > total).collect()
    return np.sort(np.array([r["w"] for r in rows], np.int64).view(np.uint64)), total


def pairs(docs: DataFrame, hot: np.ndarray, buckets: int) -> DataFrame:
    """bucket, chunk, blob: a chunk's pairs by bucket of their dish, and (by one bucket) what is known of its documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = (c.partitionId() if (c := TaskContext.get()) else 0) << 32
        for k, (ids, texts) in enumerate(chunks(batches)):
            w, bounds = tokens(texts)
            doc = np.repeat(np.arange(len(texts), dtype=np.uint16), np.diff(bounds))
            words, wi = np.unique(w, return_inverse=True)
            ui = np.concatenate([[np.searchsorted(words, np.uint64(END))], wi[:-1]])  # an end stands before each first word
            cut48 = words >> np.uint64(16)
            spread = np.where(np.isin(words, hot)[wi], mix(cut48 * np.uint64(BASE))[ui], np.uint64(0)) if len(hot) else np.uint64(0)
            bucket = ((mix(words)[wi] + spread) % np.uint64(buckets)).astype(np.int64)
            key = (bucket * len(words) + wi) * len(words) + ui
            order = np.argsort(key, kind="stable")
            key, doc = key[order], doc[order]
            at = np.append(np.flatnonzero(np.diff(key, prepend=-1)), len(key))  # where pairs begin
            key, size = key[at[:-1]], np.diff(at)
            dish, six = key // len(words), cut48.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
            edges = np.searchsorted(dish, np.arange(buckets + 1) * len(words))
            train = learnt(ids)
            lost = np.array([i is None for i in ids])
            rows = [(int((part + k) % buckets), part + k, pack(np.array([0 if i is None else i for i in ids], np.int64), lost, np.diff(bounds), train), True)]
            for b in range(buckets):
                lo, hi = edges[b], edges[b + 1]
                if lo < hi:
                    own = np.append(np.flatnonzero(np.diff(dish[lo:hi], prepend=-1)), hi - lo)  # where dishes begin
                    shared = (words[dish[lo + own[:-1]] % len(words)], np.diff(own).astype(np.uint32), six[key[lo:hi] % len(words)])
                    rows.append((b, part + k, pack(*shared, size[lo:hi].astype(np.uint32), doc[at[lo] : at[hi]], np.packbits(train), len(texts)), False))
            cols = list(zip(*rows))
            kinds = (pa.int32(), pa.int64(), pa.binary(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], ["bucket", "chunk", "blob", "info"])

    return docs.mapInArrow(run, "bucket int, chunk long, blob binary, info boolean")


def log_gamma(x: np.ndarray) -> np.ndarray:
    """For x > 0, by Stirling's series from x + 8 on."""
    y = x + 8.0
    return (y - 0.5) * np.log(y) - y + 0.9189385332046727 + (1 / 12 - (1 / 360 - 1 / 1260 / y**2) / y**2) / y - np.log(x * (x + 1) * (x + 2) * (x + 3) * (x + 4) * (x + 5) * (x + 6) * (x + 7))


def ways(most: int = EXACT, d: float = D) -> np.ndarray:
    """log S(c, t) - log S(c, t - 1), at [c, t]."""
    s = np.full((most + 1, most + 1), -np.inf)
    s[1, 1] = 0
    for c in range(1, most):
        t = np.arange(1, c + 2)
        s[c + 1, t] = np.logaddexp(np.log(np.maximum(c - d * t, 1e-300)) + s[c, t], s[c, t - 1])
    out = np.zeros_like(s)
    for c in range(2, most + 1):
        out[c, 2 : c + 1] = np.diff(s[c, 1 : c + 1])
    return out


def log_ways(c: np.ndarray, t: np.ndarray, d: float = D) -> np.ndarray:
    """log S(c, t) for many customers: c! / t! times the coefficient of z**c in ((1 - (1 - z)**d) / d)**t, by its saddle point."""
    lo, hi = np.full(len(c), -700.0), np.full(len(c), -1e-12)  # of log(1 - z)
    for _ in range(60):
        x = (lo + hi) / 2
        y = np.exp(d * x)
        slope = -np.expm1(x) * np.exp((d - 1) * x) * d / -np.expm1(d * x)
        lo, hi = np.where(slope > c / t, x, lo), np.where(slope > c / t, hi, x)
    z, f = -np.expm1(x), -np.expm1(d * x) / d
    first = z * np.exp((d - 1) * x) / f
    second = first * (1 + (1 - d) * z / np.exp(x) - first)
    return log_gamma(c + 1.0) - log_gamma(t + 1.0) + t * np.log(f) - c * np.log(z) - np.log(2 * np.pi * t * np.maximum(second, 1e-300)) / 2


class Root:
    """The parent, its tables summed out: n customers of a dish have tables(n) of them on average; the next one comes with weight(n)."""

    def __init__(self, b: float):
        """b: the weight of a new table of a dish, (ROOT_THETA + ROOT_D * all tables) / (V + 1)."""
        self.b = b
        e, p = np.zeros(TABLED + 1), np.ones(1)  # p: the distribution of the number of tables, from 1 on
        if b > 0:
            e[1] = 1.0
            for n in range(1, TABLED):
                t = np.arange(1, len(p) + 1)
                p = np.append(p * (n - ROOT_D * t), 0) + np.append(0, p * b)
                p /= p.sum()
                p = p[: np.flatnonzero(p > 1e-18)[-1] + 1]
                e[n + 1] = p @ np.arange(1, len(p) + 1)
        self.e = e
        self.sums = np.concatenate([[0.0], np.cumsum(np.log(np.arange(TABLED) + b - ROOT_D * e[:-1]))])

    def tables(self, n: np.ndarray) -> np.ndarray:
        n = np.asarray(n, np.float64)
        return np.where(n <= TABLED, self.e[np.minimum(n, TABLED).astype(np.int64)], self.e[-1] * (n / TABLED) ** ROOT_D)

    def weight(self, n: np.ndarray) -> np.ndarray:
        return n + self.b - ROOT_D * self.tables(n)

    def log_weights(self, n: np.ndarray, t: np.ndarray) -> np.ndarray:
        """Of the next t customers together."""
        edge = lambda x: self.sums[np.minimum(x, TABLED).astype(np.int64)]
        low, high = np.maximum(n, TABLED), np.maximum(n + t, TABLED)
        middle = (low + high - 1) / 2
        less = middle - self.weight(middle)
        return edge(n + t) - edge(n) + np.where(high > low, log_gamma(high - less) - log_gamma(low - less), 0.0)


def root(b: float) -> Root:
    kept = per_worker("pitman_yor roots", dict)
    if b not in kept:
        kept.clear()
        kept[b] = Root(b)
    return kept[b]


def drawn(c: np.ndarray, T: np.ndarray, n: np.ndarray, parent: Root, scale: float, rng: np.random.Generator) -> np.ndarray:
    """Tables of 2 to EXACT customers each. T, n: tables of the restaurant and customers of the dish but for these."""
    ratio = per_worker("pitman_yor ways", ways)
    out, best = np.ones(len(c), np.int64), rng.gumbel(size=len(c))
    live, log_w, top, t = np.arange(len(c)), np.zeros(len(c)), np.zeros(len(c)), 1
    while len(live := live[c[live] > t]):  # before ratio is asked: it has no column beyond EXACT tables, not even for no pairs
        t += 1
        log_w[live] += np.log((THETA + D * (T[live] + t - 1)) * parent.weight(n[live] + t - 1) / scale) + ratio[c[live], t]
        v = log_w[live] + rng.gumbel(size=len(live))
        better = v > best[live]
        best[live[better]], out[live[better]] = v[better], t
        top[live] = np.maximum(top[live], log_w[live])
        live = live[log_w[live] > top[live] - FAR]
    return out


def wandered(c: np.ndarray, t: np.ndarray, T: np.ndarray, n: np.ndarray, parent: Root, scale: float, rng: np.random.Generator) -> np.ndarray:
    """Tables of many customers, after Metropolis steps of mixed lengths."""

    def log_p(t: np.ndarray) -> np.ndarray:
        new = t * np.log(D / scale) + log_gamma(THETA / D + T + t) - log_gamma(THETA / D + T)
        return log_ways(c, t) + new + parent.log_weights(n, t)

    now = log_p(t)
    for _ in range(STEPS):
        step = np.exp(rng.random(len(c)) * np.log(c) / 2 + 0.5) * rng.standard_normal(len(c))
        to = t + np.rint(step).astype(np.int64)
        fine = (to >= 1) & (to < c)
        p = log_p(np.where(fine, to, t))
        take = fine & (np.log(rng.random(len(c))) < p - now)
        t, now = np.where(take, to, t), np.where(take, p, now)
    return t


def summed(index: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(index, values, n)


class Bucket:
    """What one bucket knows: distinct pairs and their training counts. many: those of two customers and more."""

    def __init__(self, blobs: list[bytes], hot: np.ndarray):
        parts = [unpack(b) for b in blobs]
        w = np.concatenate([np.repeat(p[0], p[1]) for p in parts])
        six = np.concatenate([p[2] for p in parts])
        u = np.zeros((len(six), 8), np.uint8)
        u[:, :6] = six
        u = u.view("<u8").ravel().astype(np.uint64)
        _, first, self.inverse = np.unique(mix(w) ^ u * np.uint64(BASE), return_index=True, return_inverse=True)
        self.parts = [(p[3], p[4], np.unpackbits(p[5], count=p[6]).astype(np.float64)) for p in parts]
        counts = [np.add.reduceat(t[doc], np.concatenate([[0], np.cumsum(size[:-1], dtype=np.int64)])) for size, doc, t in self.parts]
        self.c = summed(self.inverse, np.concatenate(counts), len(first)).astype(np.int64)
        self.dishes, self.dish = np.unique(w[first], return_inverse=True)
        self.contexts, self.context = np.unique(u[first], return_inverse=True)
        self.hot = np.isin(self.dishes, hot)
        many = np.flatnonzero(self.c > 1)
        self.many = many[np.lexsort((self.context[many], self.dish[many]))]
        wanted = np.zeros(len(self.contexts), bool)
        wanted[self.context[self.many]] = True
        self.wanted = wanted

    def by_place(self, places: int) -> Iterator[tuple[int, np.ndarray, int]]:
        """place, contexts there (wanted ones first), and how many of them are wanted."""
        place = placed(self.contexts, places)
        order = np.lexsort((~self.wanted, place))
        edges = np.searchsorted(place[order], np.arange(places + 1))
        for k in range(places):
            some = order[edges[k] : edges[k + 1]]
            yield k, some, int(self.wanted[some].sum())


class State:
    """The seatings of a bucket's many pairs, and what the others sat at the last exchange."""

    fields = ("hot", "counts", "singles", "runs", "context", "c", "t", "ids", "tables", "excess", "others", "hot_others", "numbers")

    def __init__(self, *values: np.ndarray):
        for name, x in zip(self.fields, values):
            setattr(self, name, x)
        # by known dish: hot (its key, or 0), singles (pairs of one customer), runs (of many pairs); counts: customers of hot dishes
        # numbers: the root's b, own training tokens, customers of the parent elsewhere, and the round
        self.dish = np.repeat(np.arange(len(self.runs)), self.runs)

    def pack(self) -> bytes:
        return pack(*(getattr(self, x) for x in self.fields))

    @classmethod
    def of(cls, b: Bucket) -> State:
        some = b.many
        count = summed(b.dish, b.c, len(b.dishes))
        known = np.flatnonzero(count > 0)
        number = np.full(len(b.dishes), -1)
        number[known] = np.arange(len(known))
        wanted = np.flatnonzero(b.wanted)
        place = np.cumsum(b.wanted) - 1
        return cls(
            np.where(b.hot[known], b.dishes[known], np.uint64(0)), count[b.hot & (count > 0)], np.bincount(number[b.dish[b.c == 1]], minlength=len(known)).astype(np.uint32),
            np.bincount(number[b.dish[some]], minlength=len(known)).astype(np.uint32), place[b.context[some]].astype(np.uint32), b.c[some].astype(np.uint32),
            np.ones(len(some), np.uint32), b.contexts[wanted], np.zeros(len(wanted), np.int64), np.zeros(len(wanted), np.int64), np.zeros(len(wanted)), np.zeros(len(known)), np.array([ROOT_D, count.sum(), 0.0, 0.0]),
        )

    def delta(self, t: np.ndarray) -> np.ndarray:
        """Tables of each context beyond one for each pair."""
        return summed(self.context, t.astype(np.float64) - 1, len(self.ids))

    def customers(self, t: np.ndarray) -> np.ndarray:
        return self.singles + summed(self.dish, t.astype(np.float64), len(self.singles))

    def special(self, ts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Keys and values to sum: for hot dishes their tokens and customers in the parent; under key 0 tokens, other known dishes, and customers and tables in the parent."""
        parent, hot = root(float(self.numbers[0])), self.hot > 0
        n = [self.customers(t) for t in ts]
        rest = [self.numbers[1], (~hot).sum(), *(x.sum() for x in n), *(parent.tables(x[~hot]).sum() for x in n)]
        values = np.zeros((hot.sum() + 1, len(rest)))
        values[:-1, 0] = self.counts
        values[:-1, 2 : 2 + len(ts)] = np.stack([x[hot] for x in n], 1)
        values[-1] = rest
        return np.append(self.hot[hot], np.uint64(0)), values

    def informed(self, got: list[tuple]) -> None:
        """Takes what the answers say of the parent."""
        keys, totals, b, n = ends_of(got, float(self.numbers[0]))
        own = self.customers(self.t)
        hot = self.hot > 0
        self.hot_others = np.zeros(len(self.hot))
        self.hot_others[hot] = totals[np.searchsorted(keys, self.hot[hot]), 2] - own[hot]
        self.numbers = np.array([b, self.numbers[1], n - own.sum(), self.numbers[3] + 1])

    def sweep(self, rng: np.random.Generator) -> None:
        parent, t, c = root(float(self.numbers[0])), self.t.astype(np.int64), self.c.astype(np.int64)
        block = rng.integers(0, BLOCKS, len(t))
        mine, n = self.delta(t), self.customers(t)
        own_excess = summed(self.context, c - 1.0, len(self.ids))
        for k in range(BLOCKS):
            others = self.others
            if self.numbers[3] == 1:  # nothing is known of the others' seatings yet
                others = (self.excess - own_excess) * (mine.sum() / max(1.0, own_excess.sum()))
            for large in (False, True):
                some = np.flatnonzero((block == k) & ((c > EXACT) == large))
                u, w, old = self.context[some], self.dish[some], t[some]
                T, m = self.tables[u] + others[u] + mine[u] - old, n[w] + self.hot_others[w] - old
                scale = ROOT_THETA + n.sum() + self.numbers[2]
                m = np.maximum(m, 0)
                new = wandered(c[some], old, T, m, parent, scale, rng) if large else drawn(c[some], T, m, parent, scale, rng)
                t[some] = new
                mine += summed(u, (new - old).astype(np.float64), len(mine))
                n += summed(w, (new - old).astype(np.float64), len(n))
        self.t = t.astype(np.uint32)


def ends_of(got: list[tuple], b: float) -> tuple[np.ndarray, np.ndarray, float, float]:
    """Keys and totals of hot dishes in order; the b that follows, and the customers of the parent."""
    keys, totals = np.concatenate([x[-2] for x in got]), np.concatenate([x[-1] for x in got])
    sort = np.argsort(keys)
    keys, totals = keys[sort], totals[sort]
    ends, keys, totals = totals[0], keys[1:], totals[1:]  # key 0 comes first
    size = ends[1] + len(keys)
    every = ends[3] + root(b).tables(totals[:, 2]).sum()
    return keys, totals, (ROOT_THETA + ROOT_D * every) / (size + 1), ends[2]


Row = tuple[int, int, int, bytes]  # where to, from where, kind, contents
MESSAGE, STATE, ANSWER = 0, 1, 2


def placed(keys: np.ndarray, places: int) -> np.ndarray:
    return (keys % np.uint64(places)).astype(np.int64)


def start(blobs: list[bytes], number: int, buckets: int, hot: np.ndarray) -> Iterator[Row]:
    """A bucket's state, and of each of its contexts the customers and pairs, to the place of the context."""
    b = Bucket(blobs, hot)
    state = State.of(b)
    yield number, number, STATE, state.pack()
    sums = np.stack([summed(b.context, x, len(b.contexts)) for x in (b.c, b.c > 0)], 1).astype(np.int64)
    keys, values = state.special([state.t])
    place = placed(keys, buckets)
    for k, some, wanted in b.by_place(buckets):
        extra = place == k
        if len(some) or extra.any():
            yield k, number, MESSAGE, pack(b.contexts[some], wanted, sums[some], keys[extra], values[extra])


def totals_of(parts: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    keys, back = np.unique(np.concatenate([p[-2] for p in parts]), return_inverse=True)
    values = np.concatenate([p[-1] for p in parts])
    return keys, np.stack([summed(back, values[:, j], len(keys)) for j in range(values.shape[1])], 1)


def sums_of(parts: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Contexts, their summed values, and for each value sent the place of its context."""
    keys, inverse = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    values = np.concatenate([p[2] for p in parts])
    return keys, np.stack([summed(inverse, values[:, j], len(keys)) for j in range(values.shape[1])], 1).astype(np.int64), inverse


def answers(rows: list[Row], buckets: int) -> Iterator[Row]:
    """Sums of what the buckets sent, to each bucket for the contexts that it wants, in its order; hot dishes and totals to all."""
    rows = sorted(x for x in rows if x[2] == MESSAGE)
    if not rows:
        return
    parts = [unpack(x[3]) for x in rows]
    (_, sums, inverse), (keys, totals) = sums_of(parts), totals_of(parts)
    at, by = 0, {}
    for x, p in zip(rows, parts):
        by[x[1]] = sums[inverse[at : at + int(p[1])]]
        at += len(p[0])
    for b in range(buckets) if len(keys) else by:
        yield b, rows[0][0], ANSWER, pack(by.get(b, sums[:0]), keys, totals)


def last_answers(first: list[Row], rows: list[Row], buckets: int) -> Iterator[Row]:
    """Customers, pairs and the samples' further tables of all contexts that the buckets named first, in their order."""
    first, rows = sorted(x for x in first if x[2] == MESSAGE), sorted(x for x in rows if x[2] == MESSAGE)
    if not first:
        return
    asked, parts = [unpack(x[3]) for x in first], [unpack(x[3]) for x in rows]
    ids, sums, inverse = sums_of(asked)
    more = np.zeros((len(ids), SAMPLES), np.int64)
    if parts:
        some, found, _ = sums_of(parts)
        more[np.searchsorted(ids, some)] = found
    sums = np.concatenate([sums, more], 1)
    keys, totals = totals_of(parts) if parts else (ids[:0], np.zeros((0, 2 + 2 * SAMPLES)))
    at, by = 0, {}
    for x, p in zip(first, asked):
        by[x[1]] = sums[inverse[at : at + len(p[0])]]
        at += len(p[0])
    for b in range(buckets) if len(keys) else by:
        yield b, first[0][0], ANSWER, pack(by.get(b, sums[:0]), keys, totals)


def advanced(rows: list[Row], number: int, buckets: int) -> Iterator[Row]:
    """One round of sweeps: the new state, and what the contexts' tables are now, to the places of the contexts."""
    kept = [unpack(x[3]) for x in rows if x[2] == STATE]
    if not kept:
        return
    s = State(*kept[0])
    got = {x[1]: unpack(x[3]) for x in rows if x[2] == ANSWER}
    s.informed(list(got.values()))
    turn, place = int(s.numbers[3]), placed(s.ids, buckets)
    order = np.argsort(place, kind="stable")
    edges = np.searchsorted(place[order], np.arange(buckets + 1))
    mine = s.delta(s.t)
    for k in range(buckets):
        some = order[edges[k] : edges[k + 1]]
        if len(some) and turn == 1:
            s.excess[some], s.tables[some] = got[k][0][:, 0] - got[k][0][:, 1], got[k][0][:, 1]
        elif len(some):
            s.others[some] = got[k][0][:, 0] - mine[some]
    rng, ts = np.random.default_rng([number, turn]), []
    if turn <= len(ROUNDS):
        for _ in range(ROUNDS[turn - 1]):
            s.sweep(rng)
        ts = [s.t]
        yield number, number, STATE, s.pack()
    else:
        for _ in range(SAMPLES):
            for _ in range(THIN):
                s.sweep(rng)
            ts.append(s.t)
        yield number, number, STATE, pack(s.numbers[0], *ts)
    keys, values = s.special(ts)
    sums, special = np.stack([s.delta(t) for t in ts], 1).astype(np.int64), placed(keys, buckets)
    for k in range(buckets):
        some, extra = order[edges[k] : edges[k + 1]], special == k
        if len(some) or extra.any():
            yield k, number, MESSAGE, pack(s.ids[some], len(some), sums[some], keys[extra], values[extra])


def probabilities(b: Bucket, rows: list[Row], buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Of each pair: whether the dish is known, the log10 of its base and of its mean probability; and N."""
    got = {x[1]: unpack(x[3]) for x in rows if x[2] == ANSWER}
    mine = next(unpack(x[3]) for x in rows if x[2] == STATE)
    parent, ts = root(float(mine[0])), mine[1:]
    special, totals = np.concatenate([x[1] for x in got.values()]), np.concatenate([x[2] for x in got.values()])
    sort = np.argsort(special)
    dishes, heads, ends = special[sort][1:], totals[sort][1:], totals[sort][0]  # key 0 comes first
    size = ends[1] + len(dishes)
    sums = np.empty((len(b.contexts), 2 + SAMPLES))
    for k, some, _ in b.by_place(buckets):
        if len(some):
            sums[some] = got[k][0]
    count = summed(b.dish, b.c, len(b.dishes))
    hot = np.flatnonzero(b.hot & np.isin(b.dishes, dishes))
    found = np.searchsorted(dishes, b.dishes[hot])
    count[hot] = heads[found, 0]
    p = np.zeros(len(b.c))
    for s, drawn_t in enumerate(ts):
        t = np.minimum(b.c, 1).astype(np.float64)
        t[b.many] = drawn_t
        n = summed(b.dish, t, len(b.dishes))
        n[hot] = heads[found, 2 + s]
        every = ends[2 + SAMPLES + s] + parent.tables(heads[:, 2 + s]).sum()
        of_parent = (n - ROOT_D * parent.tables(n) + (ROOT_THETA + ROOT_D * every) / (size + 1)) / (ROOT_THETA + ends[2 + s])
        c, tables = sums[b.context, 0], sums[b.context, 1] + sums[b.context, 2 + s]
        p += (b.c - D * t + (THETA + D * tables) * of_parent[b.dish]) / (THETA + c)
    return (count > 0)[b.dish].astype(np.float64), np.log10((count + 1) / (ends[0] + size + 1))[b.dish], np.log10(p / SAMPLES), ends[0]


def scores(blobs: list[tuple[int, bytes]], info: list[tuple[int, bytes]], rows: list[Row], buckets: int, hot: np.ndarray) -> Iterator[tuple[int, bytes, bool]]:
    """By chunk: sums over this bucket's tokens for each of its documents; and the chunk's documents passed on."""
    n = next(float(x[2][x[1] == 0][0, 0]) for x in (unpack(r[3]) for r in rows if r[2] == ANSWER) if (x[1] == 0).any())
    for chunk, x in info:
        yield chunk, pack(*unpack(x), n), True
    if not blobs:
        return
    b = Bucket([x for _, x in blobs], hot)
    known, base, score, _ = probabilities(b, rows, buckets)
    at = 0
    for (chunk, _), (sizes, doc, train) in zip(blobs, b.parts):
        pair = np.repeat(b.inverse[at : at + len(sizes)], sizes)
        at += len(sizes)
        some = np.flatnonzero(np.bincount(doc, minlength=len(train)))
        yield chunk, pack(some.astype(np.uint16), *(np.bincount(doc, x[pair], len(train))[some] for x in (known, base, score))), False


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: counts, the base and the model's log10 probability of the text, and its perplexity."""
    docs = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    hot, total = heavy(docs)
    buckets = max(6, -(-total // BUCKET_TOKENS))

    def order(t: pa.Table) -> list[tuple[int, bytes]]:
        return sorted(zip(t.column("chunk").to_pylist(), t.column("blob").to_pylist()))

    def read(t: pa.Table) -> list[Row]:
        return list(zip(*(t.column(c).to_pylist() for c in ("dest", "src", "kind", "blob"))))

    def written(rows: Iterator[Row]) -> pa.Table:
        cols = list(zip(*rows)) or [()] * 4
        return pa.table({n: pa.array(c, x) for n, c, x in zip(("dest", "src", "kind", "blob"), cols, (pa.int32(), pa.int32(), pa.int32(), pa.binary()))})

    def begin(key: tuple, t: pa.Table) -> pa.Table:
        blobs = [x for _, x in order(t.filter(pc.invert(t.column("info"))))]
        return written(start(blobs, key[0].as_py(), buckets, hot) if blobs else iter(()))

    def reply(t: pa.Table) -> pa.Table:
        return written(answers(read(t), buckets))

    def go_on(key: tuple, mine: pa.Table, replies: pa.Table) -> pa.Table:
        return written(advanced(read(mine) + read(replies), key[0].as_py(), buckets))

    def end(first: pa.Table, last: pa.Table) -> pa.Table:
        rows = read(last)
        return written(iter([*last_answers(read(first), rows, buckets), *(x for x in rows if x[2] == STATE)]))

    def score(key: tuple, mine: pa.Table, replies: pa.Table) -> pa.Table:
        parts, info = (order(mine.filter(x)) for x in (pc.invert(mine.column("info")), mine.column("info")))
        rows = list(scores(parts, info, read(replies), buckets, hot)) if mine.num_rows else []
        cols = list(zip(*rows)) or [(), (), ()]
        return pa.table({n: pa.array(c, x) for n, c, x in zip(("chunk", "blob", "info"), cols, (pa.int64(), pa.binary(), pa.bool_()))})

    def gather(t: pa.Table) -> pa.Table:
        kinds = t.column("info").to_pylist()
        blobs = [unpack(x) for x in t.column("blob").to_pylist()]
        ids, lost, n_tokens, train, n = next(x for x, k in zip(blobs, kinds) if k)
        known, base, score = (np.zeros(len(ids)) for _ in range(3))
        for x, k in zip(blobs, kinds):
            if not k:
                for to, values in zip((known, base, score), x[1:]):
                    to[x[0]] += values
        cols = [pa.array(ids, mask=lost), pa.array(~train), pa.array(n_tokens.astype(np.int64)), pa.array(np.rint(known).astype(np.int64))]
        cols += [pa.array(np.full(len(ids), n, np.int64)), pa.array(base), pa.array(score), pa.array(10 ** np.minimum(300, -score / n_tokens))]
        return pa.Table.from_arrays(cols, [x.split()[0] for x in SCHEMA.split(", ")])

    schema = "dest int, src int, kind int, blob binary"
    dealt = pairs(docs, hot, buckets)
    first = sent = dealt.groupBy("bucket").applyInArrow(begin, schema)
    for _ in range(len(ROUNDS) + 1):  # each exchange is read twice: by the places, for their answers, and by the buckets, for their states
        replies = sent.groupBy("dest").applyInArrow(reply, schema)
        sent = sent.groupBy("dest").cogroup(replies.groupBy("dest")).applyInArrow(go_on, schema)
    replies = first.groupBy("dest").cogroup(sent.groupBy("dest")).applyInArrow(end, schema)
    parts = dealt.groupBy("bucket").cogroup(replies.groupBy("dest")).applyInArrow(score, "chunk long, blob binary, info boolean")
    return parts.groupBy("chunk").applyInArrow(gather, SCHEMA)


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"))
