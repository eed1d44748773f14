"""Scoring, toxicity, packing, near-duplicates, mixing and the pipeline against brute force."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
import zstandard
from pyspark.sql import functions as F

import corpus_pipeline
from locusmill.llm import mixing, packing, pitman_yor, quality, secrets, shingles, simhash, toxicity
from locusmill.llm.components import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows):
    """rows: (doc_id, text) or with a source."""
    return spark.createDataFrame([(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None) for r in rows], SCHEMA)


def prose(rng, n, words=400):
    vocab = [f"{a}{b}" for a in ("ta", "ro", "mi", "se", "lun", "dor", "ka", "pe") for b in ("nal", "rec", "sto", "vin", "ger", "mun", "x", "")]
    return [" ".join(rng.choice(vocab) + rng.choice(["", "", "s", "ing"]) for _ in range(rng.randint(words // 4, words))) for _ in range(n)]


ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "one"), (5, "one"), (None, "two words"), (6, "w " * 30_000), (7, "Ünïcode   text"), (8, "A B c")]


# --- op8 --------------------------------------------------------------------------------------------------------


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(x, 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_classes(rows, radius=3):
    fps = [brute_fingerprint(t) for _, t, *_ in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                parent[root(i)] = root(j)
    least = {}
    for i, (d, *_) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return Counter((d, f"{fps[i]:016x}", least.get(root(i))) for i, (d, *_) in enumerate(rows))


def test_near_duplicates(spark):
    rng = random.Random(4)
    rows = [(10 + i, t) for i, t in enumerate(prose(rng, 60))]
    for i in range(90):
        words = rng.choice(rows)[1].split()
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = "changed"
        rows.append((200 + i, " ".join(words).upper() if i % 9 == 0 else " ".join(words)))
    rows += ODD
    got = Counter(tuple(r) for r in simhash.near_duplicates(docs(spark, rows).withColumn("fp", F.lit("x"))).collect())
    assert got == brute_classes(rows)
    kept = [r.doc_id for r in simhash.representatives(docs(spark, rows)).collect()]
    assert len(kept) == len(set(kept)) and set(kept) == {c for _, _, c in brute_classes(rows)}
    assert simhash.near_duplicates(docs(spark, rows).limit(0)).count() == 0


def test_representatives_under_null_and_repeated_ids(spark):
    texts = prose(random.Random(21), 9)
    rows = [(None, t) for t in texts[:3]] + [(7, t) for t in texts[3:6]] + [(8, texts[6]), (9, texts[6]), (9, texts[7]), (None, texts[7]), (None, texts[8]), (None, texts[8])]
    got = Counter((r.doc_id, r.text) for r in simhash.representatives(docs(spark, rows)).collect())
    assert got == Counter([*rows[:6], (8, texts[6]), (9, texts[7]), (None, texts[8])])


@pytest.mark.parametrize("radius, parts", [(3, 5), (3, 4), (2, 6)])
def test_links_lose_none(spark, radius, parts):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**64, 150, np.uint64)
    near = [int(b) ^ sum(1 << int(k) for k in rng.choice(64, rng.integers(0, 6), replace=False)) for b in base for _ in range(4)]
    hub = [int(base[0]) ^ (1 << i) ^ (1 << j) for i in range(20) for j in range(i)]  # a block that spans chunks
    fps = sorted({*map(int, base), *near, *hub})
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    got = {r.node: r.label for r in components(simhash.links(df, radius, parts, chunk=32, spread=8)).collect()}
    label = {x: x for x in signed}
    arr = np.array(fps, np.uint64)
    pairs = [(signed[i], signed[j]) for i in range(len(fps)) for j in np.flatnonzero(np.bitwise_count(arr ^ arr[i]) <= radius) if j != i]
    for _ in range(40):
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
    assert {x: got.get(x, x) for x in signed} == label


# --- op9 --------------------------------------------------------------------------------------------------------


def brute_targets(sizes, weights=(3, 1, 2)):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    target, open_, left = {}, set(order), 1.5 * sum(sizes.values())
    while open_:
        total = sum(w[s] for s in open_)
        over = {s for s in open_ if left * w[s] / total > 2 * sizes[s]}
        if not over:
            return target | {s: left * w[s] / total for s in open_}
        for s in over:
            target[s] = 2 * sizes[s]
        left -= sum(target[s] for s in over)
        open_ -= over
    return target


def uniform(doc_id, text, source, seed=9):
    h = 42
    if doc_id is not None:
        h = xxhash.xxh64_intdigest(int(doc_id).to_bytes(8, "little", signed=True), h)
    for x in (text, source):
        if x is not None:
            h = xxhash.xxh64_intdigest(x.encode(), h)
    h = xxhash.xxh64_intdigest(seed.to_bytes(4, "little"), h)
    return ((h >> 11) + 0.5) / (1 << 53)


def n_words(text):
    return len((text or "").encode().split())


def brute_due(sizes, goal):
    """Copies due by size, found by bisection of the common rate: 1 + digits / 8 times it, two at most."""
    rate = lambda x, n: min(2.0, x * (1 + (max(n, 1).bit_length() - 1) / 8))
    lo, hi = 0.0, 2.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if sum(n * rate(mid, n) for n in sizes) < goal else (lo, mid)
    return {n: rate(hi, n) if sum(sizes) else 0.0 for n in sizes}


def brute_mixture(rows):
    """doc_id, text, source, copies, by sorting each source by Pareto rank. Rows must differ."""
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += n_words(t)
    goal, out = brute_targets(sizes), []
    for s in sizes:
        mine = [(i, t) for i, t, x in rows if x == s]
        due = brute_due([n_words(t) for _, t in mine], goal[s])
        due = {n: round(x) if abs(x - round(x)) < 1e-9 else x for n, x in due.items()}
        lack = goal[s] - sum(math.floor(due[n_words(t)]) * n_words(t) for _, t in mine)
        ranks, before, taken = [], 0, set()
        for i, t in mine:
            u, p = uniform(i, t, s), due[n_words(t)] % 1
            if p > 0:
                ranks.append((u / (1 - u) * (1 - p) / p, i, t))
        for _, i, t in sorted(ranks, key=lambda x: x[0]):
            if before + n_words(t) / 2 <= lack:
                taken.add((i, t))
            before += n_words(t)
        out += [(i, t, s, math.floor(due[n_words(t)]) + ((i, t) in taken)) for i, t in mine]
    return out, goal, sizes


def test_mixture(spark):
    rng = random.Random(7)
    rows = [(i, t, rng.choice(["a", "a", "a", "b", "c", "dé", "e", None])) for i, t in enumerate([*prose(rng, 200, 60), *prose(rng, 100, 400)])]
    rows += [(901, "", "empty"), (902, "x y", "tiny"), (903, "x y", "tiny"), (904, "x y z", "tiny"), (None, "n n n", None)]
    got = mixing.mixture(docs(spark, rows).withColumns({"size": F.lit("x"), "target": F.lit("y"), "key": F.lit("z"), "at": F.lit("z")})).collect()
    want, goal, sizes = brute_mixture(rows)
    assert Counter((r.doc_id, r.size, r.source, r.copies) for r in got) == Counter((i, n_words(t), s, c) for i, t, s, c in want)
    taken, longest = Counter(), defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, goal[r.source], rel_tol=1e-9) and r.taken <= 2 * r.size
        taken[r.source] += r.taken
        longest[r.source] = max(longest[r.source], r.size)
    assert all(abs(taken[s] - goal[s]) <= longest[s] / 2 for s in goal)
    assert len({round(r.due, 9) for r in got if r.source == "b"}) > 2  # probabilities differ within a source
    again = mixing.mixture(docs(spark, rows).repartition(7)).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))
    mixed = Counter((r.doc_id, r.text, r.source) for r in mixing.mixed(docs(spark, rows)).collect())
    expect = Counter()
    for i, t, s, c in want:
        expect[i, t, s] += c
    assert mixed == +expect
    assert mixing.mixture(docs(spark, rows).limit(0)).count() == 0


def test_equal_rows_come_near_the_target(spark, tmp_path):
    """Equal rows and rows without an id are drawn one by one."""
    rows = [(5, "a b c d e f", "x")] * 100 + [(None, None, "y")] * 40 + [(None, "g h i", "y")] * 100 + [(i, f"{i} k l", "z") for i in range(200)]
    docs(spark, rows).repartition(3).write.parquet(f"{tmp_path}/d")
    df = spark.read.parquet(f"{tmp_path}/d")
    runs = [Counter(map(tuple, mixing.mixture(df).collect())) for _ in range(2)]
    assert runs[0] == runs[1] and sum(runs[0].values()) == len(rows)
    taken, goal = Counter(), {}
    for r in mixing.mixture(df).collect():
        taken[r.source] += r.taken
        goal[r.source] = r.target
    assert all(abs(taken[s] - goal[s]) <= 3 for s in goal), (taken, goal)
    assert sum(n_words(r.text) for r in mixing.mixed(df).collect()) == sum(taken.values())


def test_inclusion_follows_the_probabilities(spark):
    """Over many seeds a document is taken about as often as it is due."""
    rng = random.Random(17)
    rows = [(i, "w " * rng.choice([1, 3, 20, 90]), "ab"[i % 2]) for i in range(600)]
    runs = [mixing.mixture(docs(spark, rows).coalesce(1), seed=k).collect() for k in range(3)]
    by = defaultdict(lambda: [0, 0.0])
    for run in runs:
        for r in run:
            by[r.source, r.size][0] += r.copies
            by[r.source, r.size][1] += r.due
    assert all(abs(n - due) < 4 * math.sqrt(max(due, 1)) for n, due in by.values())


# --- op7 --------------------------------------------------------------------------------------------------------


def check_packing(rows, got, capacity):
    slow = packing.slow_encoder(packing.VOCABULARY)
    ids = {(i, t): np.array([*slow.encode(t or "", add_special_tokens=False).ids, 0], "<u4") for i, t, *_ in rows}
    expect = Counter()
    for i, t, *_ in rows:
        x = ids[i, t]
        first = (len(x) - 1) % capacity + 1
        edges = [0, *range(first, len(x) + 1, capacity)]
        for k, (a, b) in enumerate(zip(edges, edges[1:])):
            expect[i, k, a, b - a, zlib.crc32(x[a:b].tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == expect
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for o, n in sorted(b):
            assert o == at
            at += n
        assert at <= capacity
    total = sum(len(ids[i, t]) for i, t, *_ in rows)
    assert len(bins) <= 1.01 * total / capacity + 2


def test_packing(spark):
    rng = random.Random(5)
    rows = [(100 + i, t) for i, t in enumerate(prose(rng, 200, 900))] + ODD + [(9, "x <|endoftext|> y"), (11, "日本語 ไทย \U0001f600 ʼn"), (12, "a" * 5000)]
    got = packing.packed(docs(spark, rows).withColumn("length", F.lit("x")), capacity=512).collect()
    check_packing(rows, got, 512)
    assert packing.packed(docs(spark, rows).limit(0)).count() == 0


def test_both_encoders_agree():
    rng = random.Random(6)
    slow, fast = packing.slow_encoder(packing.VOCABULARY), packing.fast_encoder(packing.VOCABULARY)
    alphabet = [chr(c) for c in range(0x250)] + list("αБя一龥ぁア€—…'") + ["  ", "\n\n", "'s", "'LL", " 12"]
    for _ in range(400):
        t = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 80)))
        assert slow.encode(t, add_special_tokens=False).ids == fast.encode_ordinary(t) == packing.encode(t)


def test_local_search_empties_bins():
    lengths = [6, 4, 3, 3, 2, 2]
    poor = [[0, 2], [1, 3], [4, 5]]  # 9, 7, 4 of 10: total 20 fits two
    better = packing.improve([list(b) for b in poor], lengths, 10)
    assert len(better) == 2 and sorted(i for b in better for i in b) == list(range(6))
    rng = random.Random(8)
    for _ in range(50):
        lengths = [rng.randint(1, 100) for _ in range(rng.randint(0, 60))]
        bins = packing.improve(packing.best_fit(lengths, 100), lengths, 100)
        assert sorted(i for b in bins for i in b) == list(range(len(lengths))) and all(sum(lengths[i] for i in b) <= 100 for b in bins)


def gains(bins, lengths, capacity):
    """Whether any move, or swap of one or two pieces for one, fills a bin further from one that is no fuller."""
    fill = [sum(lengths[i] for i in b) for b in bins]
    for h, high in enumerate(bins):
        for k, low in enumerate(bins):
            if h == k or fill[k] > fill[h]:
                continue
            two = [lengths[a] + lengths[b] for n, a in enumerate(low) for b in low[n + 1 :]]
            for give in (0, *(lengths[i] for i in high)):
                if any(0 < more - give <= capacity - fill[h] for more in [*(lengths[i] for i in low), *(two if give else [])]):
                    return True
    return False


def test_local_search_ends_at_an_optimum():
    rng, fewer = random.Random(9), 0
    for n, low, high in ((40, 1, 100), (60, 25, 60), (90, 30, 45), (30, 48, 56), (50, 5, 9), (60, 20, 90)) * 5:
        lengths = [rng.randint(low, high) for _ in range(n)]
        best = packing.best_fit(lengths, 100)
        bins = packing.improve(best, lengths, 100)
        assert sorted(i for b in bins for i in b) == list(range(n)) and len(bins) <= len(best)
        assert len(bins) == -(-sum(lengths) // 100) or not gains(bins, lengths, 100)
        fewer += len(best) - len(bins)
    assert fewer > 0


# --- op1 --------------------------------------------------------------------------------------------------------


def test_lm_base_and_counts(spark):
    rng = random.Random(9)
    rows = [(i, t) for i, t in enumerate(prose(rng, 120, 100))] + [(500 + i, t) for i, (_, t) in enumerate(ODD)] + [(None, "two words")]
    got = pitman_yor.lm_scores(docs(spark, rows).withColumn("score", F.lit("x"))).collect()
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    tok = lambda t: [*(t or "").encode().lower().split(), None]
    c = Counter(w for i, t in rows if not held(i) for w in tok(t))
    n, v = sum(c.values()), len(c)
    want = Counter()
    for i, t in rows:
        w = tok(t)
        want[i, held(i), len(w), sum(c[x] > 0 for x in w), n, round(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w), 6)] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(r.score < 0 for r in got)
    mean = lambda name: sum(getattr(r, name) for r in got if r.held_out) / sum(r.n_tokens for r in got if r.held_out)
    assert mean("score") > mean("base_score")
    assert pitman_yor.lm_scores(docs(spark, rows).limit(0)).count() == 0


def in_buckets(texts, train, buckets, hot=()):
    """log10 probability of every pair of tokens, by the functions that buckets and places run; and the tables of each context, by sample."""
    hot = np.sort(np.array(list(hot), np.uint64))
    w, bounds = pitman_yor.tokens(texts)
    u = np.concatenate([[np.uint64(pitman_yor.END)], w[:-1]])
    doc = np.repeat(np.arange(len(texts)), np.diff(bounds)).astype(np.uint16)
    by = defaultdict(list)
    for k in range(len(w)):
        spread = int(pitman_yor.mix((u[k : k + 1] >> np.uint64(16)) * np.uint64(pitman_yor.BASE))[0]) if w[k] in hot else 0
        by[(int(pitman_yor.mix(w[k : k + 1])[0]) + spread) % 2**64 % buckets].append(k)
    blobs = {}
    for b, ks in by.items():
        ks.sort(key=lambda k: (w[k], u[k] >> np.uint64(16)))
        keys = [(w[k], u[k] >> np.uint64(16)) for k in ks]
        pairs = sorted(set(keys))
        dishes = sorted({p[0] for p in pairs})
        six = np.array([p[1] for p in pairs], "<u8").view(np.uint8).reshape(-1, 8)[:, :6]
        n = Counter(keys)
        blobs[b] = [pitman_yor.pack(np.array(dishes, np.uint64), np.array([sum(p[0] == d for p in pairs) for d in dishes]), six, np.array([n[p] for p in pairs], np.uint32), doc[ks], np.packbits(train), len(texts))]

    def to_places(rows):
        out = defaultdict(list)
        for r in rows:
            out[r[0]].append(r)
        return out

    first = sent = to_places(r for b in blobs for r in pitman_yor.start(blobs[b], b, buckets, hot))
    for _ in range(len(pitman_yor.ROUNDS) + 1):
        back = to_places(r for x in sent.values() for r in pitman_yor.answers(x, buckets))
        sent = to_places(r for b in blobs for r in pitman_yor.advanced(sent[b] + back[b], b, buckets))
    back = to_places(r for k, x in first.items() for r in pitman_yor.last_answers(x, sent[k], buckets))
    out, tables = {}, {}
    for b in blobs:
        bucket = pitman_yor.Bucket(blobs[b], hot)
        rows = back[b] + [x for x in sent[b] if x[2] == pitman_yor.STATE]
        score = pitman_yor.probabilities(bucket, rows, buckets)[2]
        got = {x[1]: pitman_yor.unpack(x[3])[0] for x in back[b]}
        for k, some, _ in bucket.by_place(buckets):
            tables |= {int(bucket.contexts[i]): got[k][j, 1] + got[k][j, 2:] for j, i in enumerate(some)}
        for i, s in enumerate(score):
            out[int(bucket.contexts[bucket.context[i]]), int(bucket.dishes[bucket.dish[i]])] = s
    return out, tables


@pytest.mark.parametrize("buckets, hot_words", [(1, 0), (3, 0), (4, 3)])
def test_lm_probabilities_sum_to_one(buckets, hot_words):
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(25)]
    texts = [" ".join(rng.choices(vocab, range(1, 26), k=30)).encode() for _ in range(40)]
    probe = [f"{a} {b}".encode() for a in ("w3", "w24", "new") for b in [*vocab, "unknown"]] + [a.encode() for a in ("w3", "w24", "new")]
    train = np.array([True] * len(texts) + [False] * len(probe))
    hot = pitman_yor.tokens([" ".join(vocab[-hot_words:]).encode()])[0][:-1] if hot_words else ()
    got = in_buckets(texts + probe, train, buckets, hot)[0]
    code = lambda x: int(pitman_yor.tokens([x.encode()])[0][0])
    for a in ("w3", "w24", "new"):
        dishes = [code(b) for b in [*vocab, "unknown"]] + [pitman_yor.END]
        assert math.isclose(sum(10 ** got[code(a) >> 16, d] for d in dishes), 1, rel_tol=1e-9)


def customer_gibbs(counts, sweeps, burn, seed):
    """Tables by context and mean log10 probability of a training token, by a sampler that moves one customer at a time.

    counts: context: {dish: customers}. Every customer has a table; a table is a customer of the parent, which has tables of its own.
    """
    rng = random.Random(seed)
    d, theta, d0, theta0 = pitman_yor.D, pitman_yor.THETA, pitman_yor.ROOT_D, pitman_yor.ROOT_THETA
    v = len({w for x in counts.values() for w in x})
    rooms = {u: {w: [] for w in x} for u, x in counts.items()}  # customers at each table
    above, seen, score, n_tokens = defaultdict(list), [], [], sum(sum(x.values()) for x in counts.values())

    def chosen(weights):
        x = rng.random() * sum(weights)
        for i, y in enumerate(weights):
            x -= y
            if x < 0:
                return i
        return len(weights) - 1

    def parent(w):
        n0, t0 = sum(map(sum, above.values())), sum(map(len, above.values()))
        return (sum(above[w]) - d0 * len(above[w]) + (theta0 + d0 * t0) / (v + 1)) / (theta0 + n0)

    def up(w):
        t0 = sum(map(len, above.values()))
        k = chosen([n - d0 for n in above[w]] + [(theta0 + d0 * t0) / (v + 1)])
        if k == len(above[w]):
            above[w].append(0)
        above[w][k] += 1

    def down(w):
        k = chosen(above[w])
        above[w][k] -= 1
        if not above[w][k]:
            del above[w][k]

    def sit(u, w):
        room = rooms[u][w]
        k = chosen([n - d for n in room] + [(theta + d * sum(map(len, rooms[u].values()))) * parent(w)])
        if k == len(room):
            room.append(0)
            up(w)
        room[k] += 1

    for u, x in counts.items():
        for w, c in x.items():
            for _ in range(c):
                sit(u, w)
    for i in range(sweeps):
        for u, x in counts.items():
            for w, c in x.items():
                for _ in range(c):
                    room = rooms[u][w]
                    k = chosen(room)
                    room[k] -= 1
                    if not room[k]:
                        del room[k]
                        down(w)
                    sit(u, w)
        if i >= burn:
            seen.append({u: sum(map(len, x.values())) for u, x in rooms.items()})
            total = 0.0
            for u, x in counts.items():
                size, t = sum(x.values()), seen[-1][u]
                total += sum(c * math.log10((c - d * len(rooms[u][w]) + (theta + d * t) * parent(w)) / (theta + size)) for w, c in x.items())
            score.append(total / n_tokens)
    return {u: sum(x[u] for x in seen) / len(seen) for u in counts}, sum(score) / len(score)


def test_seatings_agree_with_a_sampler_of_single_customers():
    """Tables and scores, for 1, 3 and 20 buckets alike, and with dishes spread over the buckets."""
    rng = random.Random(31)
    vocab = [f"w{i}" for i in range(30)]
    texts = [" ".join(rng.choices(vocab, [1 / (i + 1) for i in range(30)], k=25)).encode() for _ in range(50)]
    w, _ = pitman_yor.tokens(texts)
    u = np.concatenate([[np.uint64(pitman_yor.END)], w[:-1]]) >> np.uint64(16)
    counts = defaultdict(Counter)
    for a, b in zip(u.tolist(), w.tolist()):
        counts[a][b] += 1
    tables, score = customer_gibbs(counts, 30, 10, 1)
    mean = sum(tables.values())
    hot = pitman_yor.tokens([" ".join(vocab[:4]).encode()])[0][:-1]
    for buckets, some in ((1, ()), (3, ()), (20, ()), (20, hot)):
        got, sat = in_buckets(texts, np.ones(len(texts), bool), buckets, some)
        ours = sum(got[a, b] * c for a, x in counts.items() for b, c in x.items()) / len(w)
        total = sum(x.mean() for x in sat.values())
        assert abs(total - mean) < 0.03 * mean and abs(ours - score) < 0.006


def exact_tables(c, T, n, parent, scale):
    """The distribution of the tables of c customers, from the recursion of the ways to seat them."""
    s = {1: 1.0}
    for i in range(1, c):
        s = {t: s.get(t, 0.0) * (i - pitman_yor.D * t) + s.get(t - 1, 0.0) for t in range(1, i + 2)}
    p, a = {}, 1.0
    for t in range(1, c + 1):
        a *= (pitman_yor.THETA + pitman_yor.D * (T + t - 1)) * float(parent.weight(np.array([n + t - 1.0]))[0]) / scale
        p[t] = s[t] * a
    return {t: x / sum(p.values()) for t, x in p.items()}


def test_draws_follow_the_exact_distribution():
    rng, n = np.random.default_rng(0), 20_000
    for c, T, m, b, scale in ((2, 3, 5, 0.5, 50.0), (7, 30, 2, 0.7, 60.0), (40, 400, 60, 0.5, 900.0)):
        parent = pitman_yor.Root(b)
        want = exact_tables(c, T, m, parent, scale)
        args = np.full(n, T), np.full(n, float(m)), parent, scale, rng
        one = pitman_yor.drawn(np.full(n, c), *args)
        many = np.ones(n, np.int64)
        for _ in range(12 if c > 7 else 0):
            many = pitman_yor.wandered(np.full(n, c), many, *args)
        for t, x in want.items():
            assert abs((one == t).mean() - x) < 0.012
            assert c <= 7 or abs((many == t).mean() - x) < 0.02


def test_draws_reach_as_many_tables_as_customers():
    rng, parent, most = np.random.default_rng(0), pitman_yor.Root(0.5), pitman_yor.EXACT
    for c in ([most] * 3, [2, most - 1, most], [2, 3]):  # a restaurant so full of tables that each customer opens one
        got = pitman_yor.drawn(np.array(c), np.full(len(c), 1e6), np.full(len(c), 1e6), parent, 1.0, rng)
        assert got.tolist() == c
    assert pitman_yor.drawn(np.zeros(0, np.int64), np.zeros(0), np.zeros(0), parent, 1.0, rng).tolist() == []


def test_parent_sums_its_tables_out():
    """Against all seatings of up to seven customers."""
    b, d = 0.6, pitman_yor.ROOT_D
    parent, s = pitman_yor.Root(b), {0: 1.0}
    for n in range(7):
        mean = sum(t * x for t, x in s.items()) / sum(s.values())
        assert math.isclose(float(parent.tables(np.array([n]))[0]), mean, rel_tol=1e-9, abs_tol=1e-12)
        s = {t: s.get(t, 0.0) * (n - d * t) + s.get(t - 1, 0.0) * b for t in range(0, n + 2)}
    far = parent.log_weights(np.array([3000.0]), np.array([3000]))[0]
    assert math.isclose(far, float(np.log(parent.weight(np.arange(3000.0, 6000.0))).sum()), rel_tol=1e-4)


# --- op2 --------------------------------------------------------------------------------------------------------


def test_toxicity(spark):
    rng = random.Random(11)
    bad, rows, labels = ["vilegast", "vilemon", "scorned"], [], []
    for i, t in enumerate(prose(rng, 700, 80)):
        words, toxic = t.split(), rng.random() < 0.3
        for _ in range(2 * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(bad))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    rows += [(10_000 + i, t) for i, (_, t) in enumerate(ODD)]
    lab = spark.createDataFrame([*labels, (10_001, 1, None)], "doc_id long, quality int, toxic int")
    df = docs(spark, rows).withColumn("score", F.lit("x"))
    model = toxicity.train(df, lab, lambda i: ~toxicity.held_out(i))
    got = {r.doc_id: r for r in toxicity.scored(df, model).collect()}
    y = {i: t for i, _, t in labels}
    test = [i for i in y if got[i].held_out]
    assert {i for i in y if zlib.crc32(str(i).encode()) % 4 == 2} == set(test)
    assert sum((got[i].score >= 0.3) == y[i] for i in test) > 0.93 * len(test)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())
    other = {r.doc_id: r.score for r in toxicity.scored(df.withColumns({"lang": F.lit("zz"), "source": F.lit("q")}), model).collect()}
    assert all(other[i] == got[i].score for i in got)
    assert toxicity.scored(df, toxicity.train(df, lab.limit(0), lambda i: F.lit(True))).where("score <> 0").count() == 0
    assert toxicity.scored(df.limit(0), model).count() == 0


def naive_forward(m, ids, bounds):
    """Outputs by one loop for each text, filter, window and word."""
    out = []
    for a, b in zip(bounds, bounds[1:]):
        words = [sum(m.table[h].astype(np.float64) for h in row) for row in ids[a:b]]
        z, c = float(m.shift[0]), 0
        for w in m.filters:
            for f in range(w.shape[2]):
                r = [sum(words[i + j] @ w[j, :, f].astype(np.float64) for j in range(len(w))) + m.bias[c] for i in range(len(words) - len(w) + 1)]
                z += m.read[c] * max([0.0, *r])
                c += 1
        out.append(z)
    return np.array(out)


def test_convolution_and_gradients_against_loops():
    rng = np.random.default_rng(5)
    m = toxicity.Model(
        rng.normal(0, 0.5, (50, 3)), [rng.normal(0, 0.7, (w, 3, 2)) for w in (1, 2, 3)], rng.normal(0, 0.3, 6), rng.normal(0, 1, 6), np.array([0.2]),
    )
    sizes = [0, 1, 2, 3, 7, 5, 0, 2]
    ids, bounds, y = rng.integers(0, 50, (sum(sizes), 3)), np.cumsum([0, *sizes]), np.array([0, 1, 1, 0, 1, 0, 1, 0])
    m.training = True
    pooled = m.pooled(ids, bounds)[0]
    assert np.allclose(pooled @ m.read + m.shift[0], naive_forward(m, ids, bounds), atol=1e-4)
    params = [m.table, *m.filters, m.bias, m.read, m.shift]

    def loss():
        z = naive_forward(m, ids, bounds)
        return np.mean(np.logaddexp(0, z) - y * z) + toxicity.DECAY / 2 * sum((p * p).sum() for p in (*m.filters, m.read))

    for p, g in zip(params, toxicity.gradients(m, ids, bounds, y)):
        for at in rng.permutation(p.size)[:25]:
            i = np.unravel_index(at, p.shape)
            was, ends = p[i], []
            for step in (1e-5, -1e-5):
                p[i] = was + step
                ends.append(loss())
            p[i] = was
            assert abs((ends[0] - ends[1]) / 2e-5 - g[i]) < 1e-4 * max(1, abs(g[i]))


def test_training_rows_are_bounded_and_in_order(spark):
    rng = random.Random(2)
    rows = [(i % 150, t) for i, t in enumerate(prose(rng, 300, 60))]
    lab = spark.createDataFrame([(i % 150, 1, i % 2) for i in range(600)] + [(3, 1, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    seen = []
    real = toxicity.fit
    toxicity.fit = lambda texts, y, **more: seen.append((list(texts), y.tolist())) or real(texts[:40], y[:40], epochs=1)
    try:
        for parts in (1, 7):
            toxicity.train(docs(spark, rows).repartition(parts), lab.repartition(parts), lambda i: F.lit(True))
        toxicity.train(docs(spark, rows), lab, lambda i: F.lit(True), most_bytes=4000)
        toxicity.train(docs(spark, rows), lab, lambda i: F.lit(True), sample=50)
    finally:
        toxicity.fit = real
    assert seen[0] == seen[1] and len(seen[0][0]) > 200 and sum(map(len, seen[2][0])) <= 4000 < sum(map(len, seen[0][0])) and len(seen[3][0]) <= 50


def test_hashed_words_do_not_depend_on_neighbours():
    alone = [toxicity.hashed([t])[0] for t in (b"Ab,cd", b"", b"xyz " * 50)]
    together, bounds = toxicity.hashed([b"Ab,cd", b"", b"xyz " * 50])
    assert all((together[bounds[i] : bounds[i + 1]] == alone[i]).all() for i in range(3)) and bounds.tolist() == [0, 2, 2, 52]


# --- similarity of shingles -----------------------------------------------------------------------------------


def shingle_set(text):
    words = (text or "").encode().lower().split()
    return frozenset(b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def test_planted_near_copies(spark):
    rng = random.Random(8)
    rows = [(10 + i, t) for i, t in enumerate(prose(rng, 40, 300))]
    for i in range(160):
        words = rng.choice(rows[:40])[1].split()
        for _ in range(rng.randint(0, len(words) // 25)):
            words[rng.randrange(len(words))] = f"changed{i}"
        rows.append((200 + i, " ".join(words)))
    base = rows[0][1].split()
    rows += [(1000 + i, " ".join([*base[:i], "x", *base[i + 1 :]])) for i in range(60)] + ODD  # a class that spans chunks
    sets, label = [shingle_set(t) for _, t in rows], list(range(len(rows)))
    close = [(i, j) for i in range(len(rows)) for j in range(i) if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])]
    for i, j in close:
        a, b = label[i], label[j]
        label = [b if x == a else x for x in label]
    keyed = docs(spark, rows).select(F.monotonically_increasing_id().cast("string").alias("key"), "doc_id", "text")
    keyed = spark.createDataFrame([(str(i), *r) for i, r in enumerate(rows)], keyed.schema)
    got = {int(r.key): r.label for r in shingles.similar(keyed, 32).collect()}
    assert len(got) == len(rows) and len({*zip(label, (got[i] for i in range(len(rows))))}) == len({*label}) == len({*got.values()})
    assert sum(j < 1 for j in (len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a, b in close)) > 100
    kept = [r.doc_id for r in corpus_pipeline.near_dedup(spark, docs(spark, rows), "").collect()]
    assert len(kept) == len({*label})


def test_pivots_find_near_copies_themselves(spark, monkeypatch):
    rng = random.Random(11)
    rows = [(i, t) for i, t in enumerate(prose(rng, 30, 900))]
    rows += [(100 + i, t + " and more") for i, t in rows] + [(200 + i, t.replace(" ", "  ", 1)) for i, t in rows[:30]] + [(300, ""), (301, None)]
    fps = [simhash.majority(shingles.shingles((t or "").encode())) for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= simhash.RADIUS:
                assert 5 * len(shingle_set(rows[i][1]) & shingle_set(rows[j][1])) >= 4 * len(shingle_set(rows[i][1]) | shingle_set(rows[j][1]))
                label = [label[j] if x == label[i] else x for x in label]
    assert 31 <= len({*label}) < 60
    none = lambda heads, chunk: heads.select(F.col("set").alias("a"), F.col("set").alias("b")).limit(0)
    monkeypatch.setattr(shingles, "candidates", none)  # without the bands
    kept = [r.doc_id for r in corpus_pipeline.near_dedup(spark, docs(spark, rows), "").collect()]
    assert sorted(kept) == sorted(min(rows[i][0] for i in range(len(rows)) if label[i] == x) for x in {*label})


def test_dealt_chunks_lose_no_link():
    rng = random.Random(3)
    pairs = {(rng.randrange(30), rng.randrange(30)) for _ in range(25)}
    near = lambda i, others: np.array([j for j in others.tolist() if (i, j) in pairs or (j, i) in pairs], np.int64)
    label = list(range(30))
    for a, b in [*pairs, *shingles.spanning(30, 30, True, near)]:
        label = [min(label[a], label[b]) if x in (label[a], label[b]) else x for x in label]
    other = list(range(30))
    for a, b in shingles.spanning(30, 30, True, near):
        other = [min(other[a], other[b]) if x in (other[a], other[b]) else x for x in other]
    assert label == other


# --- pipeline ---------------------------------------------------------------------------------------------------


def test_pipeline(spark, tmp_path):
    rng = random.Random(13)
    rows = [(i, t, rng.choice("abc")) for i, t in enumerate(prose(rng, 150, 500))]
    rows += [(1000 + i, rows[i][1], "b") for i in range(20)]
    rows += [(2000, "spam " * 300, "a"), (2001, "too short", "a"), (2002, None, "a")]
    rows += [(3000 + i, t + ' token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"', "c") for i, t in enumerate(prose(rng, 5, 500))]
    folder = str(tmp_path)
    docs(spark, rows).write.parquet(f"{folder}/documents.parquet")
    squeeze = zstandard.ZstdCompressor(level=3)
    left = [r for r in rows if quality.measure((r[1] or "").encode(), squeeze)[6]]
    heads = {c for _, _, c in brute_classes(left)}
    left = [r for r in left if r[0] in heads]
    left = [(i, secrets.redacted(t, secrets.find(t)[1]), s) for i, t, s in left]
    mixed = [(i, t, s) for i, t, s, c in brute_mixture(left)[0] for _ in range(c)]
    df, frames = spark.read.parquet(f"{folder}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        df = stage(spark, df, folder)
        frames.append(df)
    assert all(f.columns == SCHEMA.replace(" long", "").replace(" string", "").split(", ") for f in frames[:-1])
    assert Counter((r.doc_id, r.text, r.source) for r in frames[3].collect()) == Counter(mixed)
    got = corpus_pipeline.run(spark, folder).collect()
    check_packing(mixed, got, packing.CAPACITY)
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


CLASHES = ("row", "id", "head", "fp", "label", "size", "target", "copies", "rank", "u", "p", "last", "s", "__s", "slice", "kept", "spans", "component_id", "piece", "length", "offset", "grp", "a.b")


def test_stages_on_odd_tables(spark):
    rows = [*ODD, (20, "same words over and over " * 3, None), (21, "plain " + " ".join(f"w{i}" for i in range(60)), None), (21, "plain " + " ".join(f"w{i}" for i in range(60)), None)]
    df = docs(spark, rows).withColumn("lang", F.lit(None).cast("string"))
    for c in CLASHES:
        df = df.withColumn(c, F.lit("mine"))
    for table in (df, df.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, table, "")
            assert out.columns == df.columns, name
            assert all(r.row == "mine" and r["a.b"] == "mine" for r in out.collect())
        assert corpus_pipeline.STAGES[-1][1](spark, table, "").count() == (0 if table is not df else sum(-(-(len(packing.encode(t or "")) + 1) // 2048) for _, t, *_ in rows))
