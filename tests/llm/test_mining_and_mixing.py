"""Hard negatives, mixing and collocations against brute-force versions, and
their defined results for nulls, empties, ties, repeats and odd columns."""

import heapq
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from shopflow.llm import collocations as CO
from shopflow.llm import hard_negatives as HN
from shopflow.llm import mixing as MX

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
CLASH = [("_row", "1"), ("f", "2"), ("m", "3"), ("words", "4"), ("bin", "5"), ("q", "6"), ("norm", "7"), ("window", "8"),
         ("size", "9"), ("known", "10"), ("phrase", "11"), ("score", "12")]


def clashing(df):
    for name, value in CLASH:
        df = df.withColumn(name, F.lit(value))
    return df


# ---- hard negatives ---------------------------------------------------------

VECTORS = "vec_id long, label int, embedding array<float>"


def brute_negatives(rows, anchors, positives=5, negatives=10):
    kept = {}
    for v, label, e in rows:
        if v is None or label is None or e is None or any(x is None or not np.isfinite(x) for x in e):
            continue
        q = [int(np.floor(256 * float(np.float32(x)))) for x in e]
        kept[v] = min(kept.get(v, (label, q)), (label, q))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    out = []
    for a in sorted(kept):
        if not anchors(a):
            continue
        label, q = kept[a]
        s = {v: dot(q, kept[v][1]) for v in kept}
        best = sorted((v for v in kept if v != a and kept[v][0] == label), key=lambda v: (-s[v], v))[:positives]
        other = sorted((v for v in kept if kept[v][0] != label), key=lambda v: (-s[v], v))
        for p in best:
            ok = [v for v in other if 30 * s[p] <= 100 * s[v] <= 90 * s[p]][:negatives]
            out += [(a, p, k + 1, v, s[p], s[v]) for k, v in enumerate(ok)]
    return sorted(out)


def vectors(n, dim, seed, clusters=6):
    rnd = np.random.default_rng(seed)
    centre = rnd.normal(size=(clusters, dim))
    out = []
    for i in range(n):
        c = int(rnd.integers(clusters))
        e = centre[c] + rnd.normal(size=dim) * rnd.choice([0.05, 0.4, 1.5])
        out.append((i, int(rnd.integers(4)) if rnd.random() < 0.3 else c % 4, [float(np.float32(x)) for x in e * rnd.choice([0.1, 1, 20])]))
    for i in range(n, n + 60):                       # one vector many times, over two labels
        out.append((i, i % 2, out[3][2]))
    return out


ODD = [(None, 1, [1.0, 2.0]), (9001, None, [1.0, 2.0]), (9002, 1, None), (9003, 1, [None, 1.0]), (9004, 1, [float("nan"), 1.0]),
       (9005, 1, [float("inf"), 1.0]), (9010, 1, []), (9020, 2, [0.0] * 12), (9030, 0, [0.5]), (9040, 3, [-0.5] * 20),
       (30, 0, [0.1] * 12), (30, 0, [0.1] * 12), (30, 9, [0.2] * 12)]


@pytest.mark.parametrize("references,chunk", [(16, 4096), (3, 5)])
def test_negatives_equal_brute_force(spark, references, chunk):
    rows = vectors(400, 12, 5) + ODD
    want = brute_negatives(rows, lambda v: v % 10 == 0)
    df = clashing(spark.createDataFrame(rows, VECTORS).repartition(5))
    got = HN.hard_negatives(spark, df, F.col("vec_id") % 10 == 0, references=references, chunk=chunk)
    assert sorted(map(tuple, got.collect())) == want and want


def test_bounds_hold_and_windows_are_skipped():
    """No true score outside its bounds; most pairs of tight clusters are
    never scored."""
    rnd = np.random.default_rng(1)
    q = np.concatenate([rnd.normal(size=(1, 8)) * 100 + rnd.normal(size=(50, 8)) for _ in range(8)]).astype(np.int64)
    ref = q[::50].astype(np.float64)
    norm = np.linalg.norm(q, axis=1)
    v = object.__new__(HN.Vectors)
    v.id, v.label, v.norm, v.q = np.arange(len(q)), np.zeros(len(q), np.int64), norm, q
    v.angles = np.arccos(np.clip(q @ ref.T / np.outer(norm, np.linalg.norm(ref, axis=1)), -1, 1)).astype(np.float32)
    down, up = HN.bounds(v, v)
    s = HN.scores(q, q)
    assert (down <= s).all() and (s <= up).all()
    own = np.equal.outer(np.arange(len(q)) // 50, np.arange(len(q)) // 50)
    assert (up[~own] < np.median(s[own])).mean() > 0.5
    for at in range(0, len(q), 50):
        x = v.part(slice(at, at + 50))
        lo, hi = HN.block_bounds(v, x)
        assert (lo[:, None] <= s[:, at:at + 50]).all() and (s[:, at:at + 50] <= hi[:, None]).all()


def test_scores_are_exact_or_an_error():
    big = np.array([[1 << 30, 1]], np.int64)
    assert HN.scores(big, big)[0, 0] == (1 << 60) + 1
    with pytest.raises(ValueError):
        HN.scores(big << 10, big << 10)


def test_negatives_of_nothing(spark):
    df = spark.createDataFrame([], VECTORS)
    assert HN.hard_negatives(spark, df, F.col("vec_id") % 10 == 0).count() == 0
    one = spark.createDataFrame([(0, 1, [1.0]), (1, 1, [1.0])], VECTORS)        # no other label
    assert HN.hard_negatives(spark, one, F.col("vec_id") == 0).count() == 0
    assert HN.hard_negatives(spark, one, F.col("vec_id") > 5).count() == 0      # no anchor


# ---- mixing -----------------------------------------------------------------

DOCS = "doc_id long, text string, source string"


def words(text):
    return len(re.findall("[^\x20\x09-\x0d]+", text or ""))


def brute_targets(sizes, weights=(1, 2, 3), cap=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    capped = set()
    while True:
        left = sum(sizes.values()) - cap * sum(sizes[s] for s in capped)
        free = sum(w[s] for s in names if s not in capped)
        share = {s: Fraction(left * w[s], free) if free else Fraction(0) for s in names if s not in capped}
        new = {s for s, t in share.items() if t > cap * sizes[s]}
        if not new:
            return {s: Fraction(cap * sizes[s]) if s in capped else share[s] for s in names}, capped
        capped |= new


def brute_seats(votes, seats):
    """One seat after the other to the highest quotient."""
    won = dict.fromkeys(votes, 0)
    heap = [(-float(v), i, s) for i, (s, v) in enumerate(votes.items()) if v > 0]
    heapq.heapify(heap)
    for _ in range(seats if heap else 0):
        _, i, s = heapq.heappop(heap)
        won[s] += 1
        heapq.heappush(heap, (-(float(votes[s]) / (2 * won[s] + 1)), i, s))
    return won


def mix_docs(seed=4, n=400):
    rnd = random.Random(seed)
    sources = [None, "", "a", "b", "c", "Ä", "z", "tiny", "empty"]
    out = []
    for i in range(n):
        s = rnd.choice(sources[:7]) if rnd.random() > 0.4 else "b"
        out.append((i, " ".join("w" for _ in range(rnd.randint(0, 60))), s))
    out += [(900, "one two", "tiny"), (901, "", "empty"), (902, None, "empty"), (903, " \n\x0b", "b"),
            (904, "x " * 30000, "c"), (905, "y" * 50000, "a"), (None, "q w e", "a"), (None, "q w e", "a"), (7, "a b", "z"), (7, "a b c", "z")]
    return out


def test_targets_and_taken_words(spark):
    rows = mix_docs()
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += words(t)
    want, capped = brute_targets(sizes)
    assert "tiny" in capped and "c" not in capped
    df = clashing(spark.createDataFrame(rows, DOCS).repartition(7))
    got = MX.mix(spark, df).collect()
    assert sorted(((r.doc_id, r.size) for r in got), key=str) == sorted(((d, words(t)) for d, t, _ in rows), key=str)
    taken = defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - float(want[r.source])) < 1e-6 * max(1, r.target)
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    assert taken["tiny"] == 6 and taken["empty"] == 0
    for s, t in want.items():
        assert abs(taken[s] - t) <= max(2, 0.002 * t)
    again = MX.mix(spark, spark.createDataFrame(rows[::-1], DOCS).repartition(3)).collect()
    key = lambda r: (str(r.doc_id), r.size, r.taken, str(r.source))
    assert sorted(map(key, again)) == sorted(map(key, got))


@pytest.mark.parametrize("resolution,shards", [(3, 1), (50, 8)])
def test_blocks_follow_highest_quotients(spark, resolution, shards):
    """Quotas against seats dealt one by one, and the words taken of every
    document against blocks chosen one by one."""
    rows = mix_docs(9, 150)
    df = spark.createDataFrame(rows, DOCS)
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += words(t)
    targets, capped = brute_targets(sizes)
    open_ = {s: t for s, t in targets.items() if s not in capped}
    left = round(sum(open_.values()))
    block = max(1, left // (len(open_) * resolution))
    seats = left // block
    key = lambda r: r["name"] if r["known"] else None
    thin = MX.sized(df)
    quotas = defaultdict(dict)
    for r in MX.quotas(MX.source_targets(thin), shards, resolution).collect():
        quotas[key(r)][r["shard"]] = r["quota"]
        assert r["block"] == block
    for k in range(1, shards + 1):
        upto = {s: sum(q for g, q in d.items() if g <= k) for s, d in quotas.items()}
        assert upto == brute_seats(open_, seats * k // shards)
    shift = {key(r): r["h"] for r in thin.select("known", "name", F.xxhash64(F.lit(MX.SEED), "known", "name").alias("h")).distinct().collect()}
    streams = defaultdict(list)
    for r in thin.collect():
        streams[key(r)].append((r["place"], str(r["doc_id"]), r["size"]))
    want = Counter()
    for s, docs in streams.items():
        b, total = (block, sizes[s]) if s not in capped else (max(1, sizes[s]), sizes[s])
        n = max(1, -(-total // b))
        quota = 3 * n if s in capped else min(3 * n, sum(quotas[s].values()))
        times = [quota // n + ((MX.PRIME % n * i + shift[s] % n) % n < quota % n) for i in range(n)]
        at = 0
        for _, d, size in sorted(docs):
            want[(s, d, size, sum(times[w // b] for w in range(at, at + size)))] += 1
            at += size
    got = MX.mix(spark, df, resolution=resolution, shards=shards).collect()
    assert Counter((r.source, str(r.doc_id), r.size, r.taken) for r in got) == want


def test_pieces_are_what_mix_counts(spark):
    rows = [r for r in mix_docs(2, 120) if r[0] is not None and r[0] != 7]
    df = spark.createDataFrame(rows, DOCS)
    out = MX.pieces(spark, df, resolution=400).collect()
    total, seen = Counter(), defaultdict(set)
    for p in out:
        total[p.doc_id] += p.words
        span = (p["pass"], p.first_word)
        assert p.words > 0 and span not in seen[p.doc_id]
        seen[p.doc_id].add(span)
    assert {r.doc_id: r.taken for r in MX.mix(spark, df, resolution=400).collect() if r.taken} == dict(total)
    assert {p.shard for p in out} <= {None, *range(1, MX.SHARDS + 1)}
    shard = Counter()
    for p in out:
        shard[p.shard] += p.words
    full = [shard[k] for k in range(1, MX.SHARDS + 1)]
    assert max(full) - min(full) <= 0.1 * max(full)


def test_mix_of_nothing_and_no_python(spark):
    empty = spark.createDataFrame([], DOCS)
    assert MX.mix(spark, empty).count() == 0 and MX.pieces(spark, empty).count() == 0
    blank = MX.mix(spark, spark.createDataFrame([(1, "", "a"), (2, None, None)], DOCS)).collect()
    assert [(r.size, r.source_size, r.target, r.taken) for r in blank] == [(0, 0, 0.0, 0)] * 2
    plan = MX.mix(spark, spark.createDataFrame(mix_docs(), DOCS))._jdf.queryExecution().toString()
    assert not re.search("InArrow|InPandas|EvalPython", plan)


# ---- collocations -----------------------------------------------------------

TEXTS = "doc_id long, text string, lang string"


def brute_phrases(rows, least, first=2000):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, 6):
                for i in range(len(w) - m + 1):
                    f[lang][tuple(w[i:i + m])] += 1
    out = []
    for lang in n:
        known = f[lang]
        cand = {p: a for p, a in known.items() if len(p) > 1 and a >= least}
        inside = Counter()
        for p, a in cand.items():
            for s in {p[i:j] for i in range(len(p)) for j in range(i + 2, len(p) + 1) if j - i < len(p)}:
                inside[s] = max(inside[s], a)
        found = []
        for p, a in cand.items():
            if inside[p] < a:
                score, _, left, right = min((1000 * a * n[lang] // (known[p[:k]] * known[p[k:]]), k, known[p[:k]], known[p[k:]])
                                            for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), left, right))
        for i, (score, a, p, left, right) in enumerate(sorted(found)[:first]):
            out.append((lang, i + 1, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def phrase_docs():
    rnd = random.Random(11)
    voc = ["the", "Of", "x", "é", "中文", "ÄÖ", "in\xa0a", "\x1cq", "new", "york", "city", "state"]
    out = []
    for i in range(300):
        w = []
        for _ in range(rnd.randint(0, 40)):
            w.append(rnd.choice(voc) if rnd.random() < 0.7 else "new york city")
        out.append((i, rnd.choice([" ", "  ", "\t"]).join(x + rnd.choice(["", "", "", ",", ".", "\n"]) for x in w), rnd.choice(["en", "de", None, "und"])))
    out += [(1000, None, "en"), (1001, "", "xx"), (1002, " \t ", "yy"), (1003, "a" * 300_000, "en"), (None, "new york " * 30000, "en"),
            (1004, "new york", None), (1004, "new york", None), (1005, ".,;", "zz"), (1006, "x", "en"), (1007, "x", "en")]
    return out


@pytest.mark.parametrize("least,first", [(100, 2000), (3, 7)])
def test_collocations_equal_brute_force(spark, least, first):
    rows = phrase_docs()
    df = clashing(spark.createDataFrame(rows, TEXTS).repartition(6))
    got = CO.collocations(spark, df, least, first)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == brute_phrases(rows, least, first)


def test_nothing_is_lost_when_summaries_overflow(spark, monkeypatch):
    """Tiny flushes and summaries without spare room: many merges and
    decrements, the same result."""
    rows = phrase_docs()
    monkeypatch.setattr(CO, "ROOM", 1)
    monkeypatch.setattr(CO, "MERGE", 8)
    monkeypatch.setattr(CO, "FLUSH", 500)
    monkeypatch.setattr(CO, "SLICE_BYTES", 2000)
    run = CO._tally, CO._summarise, CO._recount
    assert all(callable(f) for f in run)
    s = CO.Summary(50)
    rnd = np.random.default_rng(0)
    true = Counter()
    for _ in range(200):
        key = np.unique(rnd.integers(0, 4000, 60)).astype(np.uint64)
        count = rnd.integers(1, 4, len(key))
        if rnd.random() < 0.5 and 7 not in key:
            key, count = np.append(key, np.uint64(7)), np.append(count, 9)
        true.update(dict(zip(key.tolist(), count.tolist(), strict=True)))
        s.add(key, count)
    left = s.survivors(10)
    mass = sum(true.values())
    assert len(s.key) <= 50 and s.removed <= mass / 51
    bound = mass // 51 + 1
    assert all(k in set(left.tolist()) for k, c in true.items() if c >= bound and c >= 10)
    est = dict(zip(s.key.tolist(), s.count.tolist(), strict=True))
    assert all(true[k] - s.removed <= est.get(k, 0) <= true[k] for k in true)
    assert sorted(map(tuple, CO.collocations(spark, spark.createDataFrame(rows, TEXTS), 100).collect())) == brute_phrases(rows, 100)


def test_squeezed_counts_round_trip():
    rnd = np.random.default_rng(2)
    key = np.unique(np.concatenate([rnd.integers(0, 1 << 48, 500, dtype=np.uint64), np.array([0, 1, (1 << 48) - 1], np.uint64)]))
    count = np.where(rnd.random(len(key)) < 0.1, 1 << 40, rnd.integers(1, 300, len(key)))
    k, c = CO.unsqueezed(CO.squeezed(key, count))
    assert (k == key).all() and (c == count).all()


def test_scores_past_64_bits(spark):
    """1000 * a * n of the largest counts, in the expression itself."""
    a, n, left, right = 7_000_000_000_000, 90_000_000_000_000_000, 8_000_000_000_000, 9_000_000_000_000
    wide = lambda c: f"cast({c} as decimal(19,0))"
    got = spark.createDataFrame([(a, n, left, right)], "a long, n long, l long, r long").selectExpr(
        f"cast({CO.SCALE} as decimal(4,0)) * {wide('a')} * {wide('n')} div ({wide('l')} * {wide('r')}) as s").first().s
    assert got == 1000 * a * n // (left * right) and 1000 * a * n > 1 << 64


def test_collocations_of_nothing(spark):
    assert CO.collocations(spark, spark.createDataFrame([], TEXTS)).count() == 0
    assert CO.collocations(spark, spark.createDataFrame([(1, None, None)], TEXTS)).count() == 0
