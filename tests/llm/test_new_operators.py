"""Operators 11 to 13 against brute force; nulls, empty and long texts, ties, repeated rows, empty tables, clashing names."""

import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from usage_rollup.llm import centroids, importance, minhash
from usage_rollup.llm import textarrays as ta

LONG = "lorem ipsum dolor sit amet " * 4000


# --- operator 11 ------------------------------------------------------------------


def _brute_components(rows, size=2, percent=80):
    sets = {}
    for d, t in rows:
        w = (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        w = re.findall(r"[^\x20\x09-\x0D]+", w)
        sets[d] = {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())
    root = {d: d for d in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                if sets[a] and sets[b] and root[a] != root[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                    root[a] = root[b] = min(root[a], root[b])
                    changed = True
    return {d: (len(sets[d]), root[d]) for d in sets}


def _near_texts(seed=5):
    """Chains and groups of near copies around the threshold, with unrelated texts."""
    rng = np.random.default_rng(seed)
    word = lambda: "".join(rng.choice(list("abcdefghij"), 7))
    texts = []
    for _ in range(6):
        base = [word() for _ in range(120)]
        for edits in (0, 0, 2, 4, 6, 8, 10, 12, 16):
            t = list(base)
            for i in rng.choice(120, edits, replace=False):
                t[i] = word()
            texts.append(" ".join(t))
        t = list(base)
        for step in range(6):  # each step is near the last one, the ends are not near each other
            t = t[:10 * step] + [word() for _ in range(6)] + t[10 * step + 6:]
            texts.append(" ".join(t))
    texts += [" ".join(word() for _ in range(60)) for _ in range(20)]
    return texts


def test_near_duplicates_against_brute_force(docs):
    rows = [*enumerate(_near_texts()), (500, None), (501, ""), (502, " \n\t"), (503, "one"), (504, "ONE"), (505, "one two"), (506, LONG),
            (507, LONG + "end")]
    out = minhash.near_duplicates(docs(rows)).collect()
    want = _brute_components(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in out) and len(out) == len(rows)
    assert len({c for _, c in want.values()}) < len(rows) - 40  # the fixture has groups


def test_near_duplicates_edges(docs):
    rows = [(3, "a b c d"), (3, "a b c d"), (None, "a b c d"), (None, "only here once"), (None, None)]
    out = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(docs(rows)).collect()), key=repr)
    assert out == sorted([(3, 3, 3, True), (3, 3, 3, True), (None, 3, 3, None), (None, 2, None, None), (None, 0, None, None)], key=repr)
    assert minhash.near_duplicates(docs([])).count() == 0
    with pytest.raises(ValueError):
        minhash.near_duplicates(docs(rows), bands=5, rows=5)


def test_members_that_link_past_their_pivot_are_found(docs, monkeypatch):
    """Two texts link with each other but not with the pivot of their bands."""
    rng = np.random.default_rng(8)
    w = [f"w{i}" for i in range(200)]
    variants = []
    for _ in range(12):
        t = list(w)
        for i in rng.choice(200, 14, replace=False):
            t[i] = f"x{rng.integers(1 << 40)}"
        variants.append(t)
        near = list(t)
        near[int(rng.integers(200))] = "other"
        variants.append(near)
    rows = [(i, " ".join(t)) for i, t in enumerate(variants)]
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs(rows)).collect()}
    assert got == {d: c for d, (_, c) in _brute_components(rows).items()}


def test_signature_agreement_follows_similarity():
    rng, signer = np.random.default_rng(2), minhash.Signer(48, 6, 11)
    for share in (0.5, 0.8, 0.95):
        n = 600
        both = int(2 * n * share / (1 + share))
        x = rng.integers(1, 1 << 62, 2 * n - both).astype(np.uint64)
        a, b = (np.frombuffer(signer(s)[0], np.uint8) for s in (x[:n], x[n - both:]))
        true = both / (2 * n - both)
        assert abs((a == b).mean() - (true + (1 - true) / 256)) < 0.11


def test_sequential_test_keeps_linked_pairs_and_drops_others_early():
    steps = minhash.least_agreements(288, 80, 1e-9)
    assert [n for n, _ in steps] == [*range(32, 288, 32), 288] and all(b >= a for (_, a), (_, b) in zip(steps, steps[1:]))
    rng = np.random.default_rng(100)
    left = rng.integers(0, 256, (20_000, 288)).astype(np.uint8)

    def with_rate(p):
        return np.where(rng.random(left.shape) < p, left, rng.integers(0, 256, left.shape)).astype(np.uint8)

    on, _ = minhash.survivors(left, with_rate(0.8), steps)
    assert len(on) == len(left)  # a miss of some 1e-9 a batch
    on, seen = minhash.survivors(left, with_rate(0.3), steps)
    assert len(on) == 0 and seen < 1.5 * 32 * len(left)  # nearly all fall after the first batch
    # the bound is the posterior's tail
    n, m = steps[1]
    grid = np.linspace(0, 1, 200_001)[1:-1]
    for k in (m - 1, m):
        density = k * np.log(grid) + (n - k) * np.log1p(-grid)
        weight = np.exp(density - density.max())
        tail = weight[grid >= minhash.agreement(80)].sum() / weight.sum()
        assert (tail >= 1e-9) == (k >= m)


# --- operator 12 ------------------------------------------------------------------


def _brute_nearest(x, c):
    d = ((x[:, None, :].astype(object) - c[None].astype(object)) ** 2).sum(axis=2)
    return d.argmin(axis=1), d.min(axis=1)


@pytest.mark.parametrize("scale", [1, 30, centroids.LIMIT])
def test_centroid_search_is_exact(scale):
    rng = np.random.default_rng(scale)
    x = rng.integers(-scale, scale + 1, (400, 8))
    x[:50] = x[50:100][:, ::-1]  # equal means
    c = np.concatenate([x[:10], x[:3], rng.integers(-scale, scale + 1, (3, 8))])  # ties by repeated centroids
    number, distance, computed = centroids.Centroids(c).nearest(x)
    want, far = _brute_nearest(x, c)
    assert number.tolist() == want.tolist() and distance.tolist() == far.tolist()
    assert computed <= 400 * 16


def test_centroid_search_skips_most_distances():
    rng = np.random.default_rng(1)
    x = rng.integers(-3, 4, (2000, 64)) + np.repeat(np.arange(16) * 20, 125)[:, None]
    c = x[::125]
    _, _, computed = centroids.Centroids(c).nearest(x)
    assert computed < 2000 * 16 / 8


def _brute_clusters(rows, k=16, rounds=3):
    kept = {i: [math.floor(64 * float(v)) for v in x] for i, x in rows if x is not None and len(x) == 64
            and all(v is not None and math.isfinite(v) for v in x)}
    first = sorted(kept, key=lambda i: hashlib.sha256(f"1:{i}".encode()).hexdigest())[:k]
    cents = [list(kept[i]) for i in first]

    def assign():
        return {i: min((sum((a - b) ** 2 for a, b in zip(x, c)), n) for n, c in enumerate(cents)) for i, x in kept.items()}

    for _ in range(rounds):
        of = assign()
        for n in range(len(cents)):
            mine = [kept[i] for i in kept if of[i][1] == n]
            if mine:
                cents[n] = [sum(col) // len(mine) for col in zip(*mine)]
    of = assign()
    per = {n: sum(d for d, m in of.values() if m == n) for n in range(len(cents))}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return {i: (n, d, per[n], sum(per.values()), sha[n]) for i, (d, n) in of.items()}


def test_clusters_against_brute_force(spark):
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(i % 5, 0.4, 64).tolist()) for i in range(150)]
    rows += [(200, None), (201, []), (202, [1.0] * 63), (203, [float("nan")] + [0.0] * 63), (204, [float("inf")] + [0.0] * 63),
             (205, [None] + [0.0] * 63), (206, [0.0] * 64), (207, [-1.5] * 64), (208, rows[3][1])]
    frame = spark.createDataFrame([(i, x, 1) for i, x in rows], "vec_id long, embedding array<double>, cluster int")
    out = centroids.cluster(frame).collect()
    got = {r.vec_id: (r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in out}
    assert got == _brute_clusters(rows)
    few = frame.where("vec_id in (1, 2, 206)")
    assert {r.vec_id: r.cluster for r in centroids.cluster(few).collect()} == {i: v[0] for i, v in _brute_clusters([r for r in rows if r[0] in (1, 2, 206)]).items()}
    assert centroids.cluster(frame.limit(0)).count() == 0
    assert centroids.cluster(frame.where("vec_id = 200")).count() == 0


def test_clusters_of_repeated_rows_null_ids_and_other_types(spark):
    ones = [(1, [1] * 64), (1, [1] * 64), (None, [2] * 64)]
    out = centroids.cluster(spark.createDataFrame(ones, "vec_id long, embedding array<int>"), k=2).collect()
    assert len(out) == 3 and sorted((r.vec_id is None, r.cluster) for r in out) == [(False, 1), (False, 1), (True, 0)]  # the two start as centroids 0 and 1
    huge = centroids.cluster(spark.createDataFrame([(1, [1e300] * 64), (2, [-1e300] * 64)], "vec_id long, embedding array<double>"), k=1).collect()
    assert len(huge) == 2 and all(r.distance >= 0 for r in huge)


# --- operator 13 ------------------------------------------------------------------


def _words(text):
    t = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)


def _features(text):
    w = _words(text)
    return [*w, *(f"{a} {b}" for a, b in zip(w, w[1:]))]


def _bucket(f, buckets):
    return zlib.crc32(f.encode()) % buckets


TEXTS = [None, "", "one", "One TWO two", "été naïve ÀB x" + "y" * 500 + " z", "a-b_c\x00d9 　e", LONG, "w" * 70 + " " + "v" * 64 + " " + "u" * 65]


def test_feature_buckets_match_crc32():
    batch = pa.RecordBatch.from_arrays([pa.array(TEXTS, pa.string())], names=["text"])
    data, off = ta.text_buffers(batch.column("text"))
    for lo, hi in ta.chunks(off, 1000):
        row, bucket, words = importance.chunk_buckets(data, off, lo, hi, 10007)
        for i in range(hi - lo):
            want = sorted(_bucket(f, 10007) for f in _features(TEXTS[lo + i]))
            assert sorted(bucket[row == i].tolist()) == want and words[i] == len(_words(TEXTS[lo + i]))


def test_bit_sliced_sums_are_exact():
    rng = np.random.default_rng(3)
    for _ in range(20):
        buckets, rows = int(rng.integers(1, 300)), int(rng.integers(1, 600))
        gain = rng.integers(-9000, 9000, buckets)
        gain[0] = rng.choice([0, -8192, 8191, -1, 1])
        n = int(rng.integers(0, 4000))
        row, bucket = np.sort(rng.integers(0, rows, n)), rng.integers(0, max(1, buckets // 7), n)
        want = np.bincount(row, gain[bucket], rows).astype(np.int64) if n else np.zeros(rows, np.int64)
        assert (importance.GainPlanes(gain).sums(row, bucket, rows, buckets) == want).all()


def _brute_resample(rows, target, percent=25, min_words=20, buckets=10000):
    s, t = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    for _, text in rows:
        for f in _features(text):
            s[_bucket(f, buckets)] += 1
    for text in target:
        for f in _features(text):
            t[_bucket(f, buckets)] += 1
    gain = [math.floor(1000 * math.log((float(b) + 1) * (float(s.sum()) + buckets) / ((float(a) + 1) * (float(t.sum()) + buckets)))) for a, b in zip(s, t)]
    out, fit = [], []
    for d, text in rows:
        f = _features(text)
        weight = sum(gain[_bucket(x, buckets)] for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{d}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))) if d is not None else None
        out.append([d, len(f), weight, score, None])
        if score is not None and len(_words(text)) >= min_words:
            fit.append((-score, d, len(out) - 1))
    for rank, (_, _, i) in enumerate(sorted(fit)[:percent * len(fit) // 100], 1):
        out[i][4] = rank
    return sorted(map(tuple, out), key=repr)


def test_resampling_against_brute_force(spark, docs):
    rng = np.random.default_rng(10)
    vocabulary = [f"v{i}" for i in range(300)]
    rows = [(i, " ".join(rng.choice(vocabulary[:100 if i % 3 else 300], int(rng.integers(5, 60))))) for i in range(200)]
    rows += [(1000 + i, t) for i, t in enumerate(TEXTS)] + [(None, " ".join(vocabulary[:30])), (7, rows[7][1])]
    target = [" ".join(vocabulary[:40]), None, "V1 v2 v3"]
    aim = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    got = importance.resample(docs(rows), aim).collect()
    assert sorted(map(tuple, got), key=repr) == _brute_resample(rows, target)
    assert importance.resample(docs([]), aim).count() == 0
    none = importance.resample(docs(rows[:50]), aim.limit(0)).collect()
    assert sorted(map(tuple, none), key=repr) == _brute_resample(rows[:50], [])


def test_ranks_over_many_partitions(spark):
    scored = spark.range(5000, numPartitions=13).selectExpr(
        "id as doc_id", "1L as n_features", "0L as weight", "(id * 7919) % 37 as score", "id % 10 <> 0 as fit", "id as salt")
    out = importance.ranked(scored, 25).collect()
    order = sorted((r for r in out if r.fit), key=lambda r: (-r.score, r.doc_id))
    assert [r["rank"] for r in order[:1125]] == [*range(1, 1126)] and all(r["rank"] is None for r in order[1125:])
    assert all(r["rank"] is None for r in out if not r.fit) and len(out) == 5000
