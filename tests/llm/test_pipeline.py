"""The pipeline's stages, chained, against what each should keep."""

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline as C  # noqa: E402

from shopflow.llm import exact_dedup, jaccard_join, packing, quality_rules, suffix_dedup  # noqa: E402
from shopflow.llm.common import saved, table  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, SF, "documents")
    names = docs.columns
    verdicts = {
        0: lambda d: quality_rules.quality_rules(spark, d, table(spark, SF, "labels")).where("kept"),
        1: lambda d: exact_dedup.exact_dedup(spark, d).where("kept"),
        2: lambda d: jaccard_join.jaccard_join(spark, d).where("doc_id = component_id"),
    }
    for k, (_, stage) in enumerate(C.STAGES[:-1]):
        out = saved(stage(spark, docs, SF), "stage")
        assert out.columns == names
        before, after = ({r["doc_id"]: r for r in d.collect()} for d in (docs, out))
        if k in verdicts:
            assert set(after) == {r["doc_id"] for r in verdicts[k](docs).collect()}
            assert all(after[i] == before[i] for i in after) and len(after) < len(before)
        else:
            cut = {r["doc_id"]: r["n_removed"] for r in suffix_dedup.suffix_dedup(spark, docs).collect()}
            assert set(after) == set(before) and sum(cut.values()) > 0
            assert all((after[i]["text"] == before[i]["text"]) == (cut[i] == 0) for i in after)
            assert all(after[i]["n_chars"] == len(after[i]["text"]) for i in after if cut[i])
        docs = out
    last = C.run(spark, SF)
    assert last.columns == [c.split()[0] for c in packing.PIECES.split(", ")]
    assert {r["doc_id"] for r in last.collect()} == {r["doc_id"] for r in docs.collect()}


def test_near_keeps_unlinked_rows_of_null_and_repeated_ids(spark):
    base = " ".join(f"w{k}" for k in range(100))
    other = lambda c: " ".join(f"{c}{k}" for k in range(40))
    rows = [(3, base), (7, base + " end"), (7, other("a")), (7, other("a")), (8, other("b")), (8, other("c")),
            (None, other("d")), (None, other("e")), (None, other("e") + " end"), (None, base + " more"),
            (9, ""), (None, None), (None, " \n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = [r for k, r in enumerate(rows) if k not in (1, 3, 9)]
    for _ in range(2):
        got = [tuple(r) for r in C.near(spark, docs, SF).collect()]
        pair = [r for r in got if r in rows[7:9]]  # linked null ids: either, by the hash of the text
        assert len(pair) == 1
        assert sorted((r for r in got if r not in pair), key=str) == sorted((r for r in want if r not in rows[7:9]), key=str)
        docs = docs.repartition(7)


def chain_rows():
    """Good, bad, copied, nearly copied texts, and passages that repeat."""
    import random
    rnd = random.Random(8)
    voc = [a + b + c for a in ("ba", "ke", "lü", "no") for b in ("ri", "sto", "ge") for c in ("n", "d", "", "中")]
    text = lambda n: [rnd.choice(voc) for _ in range(n)]
    passage = " ".join(text(40))
    out = []
    for i in range(60):
        w = text(rnd.randint(55, 140))
        if i % 9 == 0:
            w = text(20)                                    # too short
        if i % 11 == 0:
            w = text(3) * 40                                # repeats itself
        if i % 13 == 0:
            w = [f"{x}zq" for x in w]                       # unlike the trusted texts
        t = " ".join(w)
        out.append((i, t + ("\n" + passage if i % 4 == 1 else "")))
        if i % 5 == 0:
            out.append((100 + i, t.replace(" ", "  ") if i % 10 else t))
        if i % 7 == 0:
            out.append((200 + i, " ".join([*w[:-1], "end"])))
    return [*out, (300, None), (301, ""), (302, " \n"), (303, " ".join(text(5000)))]


def brute_chain(rows, good):
    """The five stages on one machine: what each keeps, and the pieces."""
    import math
    import re
    import struct
    import zlib
    from collections import Counter, defaultdict

    import xxhash
    from tokenizers import Tokenizer

    from tests.llm.test_operators import BYTES, QR, SPACES, shingles, words
    raw, hit, grams, kept = Counter(), Counter(), {}, []
    bucket = lambda h: (h - (1 << 64) if h >> 63 else h) % QR.BUCKETS
    for i, t in rows:
        e = [bucket(xxhash.xxh64_intdigest(w[-3:].encode(), seed=42)) for w in words(t)]
        grams[i] = e + [bucket(xxhash.xxh64_intdigest(struct.pack("<i", b), seed=xxhash.xxh64_intdigest(struct.pack("<i", a), seed=42)))
                        for a, b in zip(e, e[1:])]
        raw.update(grams[i])
        if i in good:
            hit.update(grams[i])
    n, m = sum(raw.values()) + QR.BUCKETS, sum(hit.values()) + QR.BUCKETS
    for i, t in rows:
        w = words(t)
        count = Counter(zip(w, w[1:], w[2:]))
        again = {k + j for k in range(len(w) - 2) if count[tuple(w[k:k + 3])] > 1 for j in range(3)}
        total = sum(round(1e6 * (math.log((hit[g] + 1) / m) - math.log((raw[g] + 1) / n))) for g in grams[i])
        if len(w) >= 50 and 100 * len(again) <= 50 * len(w) and total >= QR.THRESHOLD * 1e6 * len(grams[i]):
            kept.append((i, t))
    steps = [kept]
    groups = defaultdict(list)
    for i, t in kept:
        groups[re.sub(SPACES, "", t)].append((-len(t), i, t))
    steps.append([(i, t) for _, i, t in map(min, groups.values())])
    sets = {i: shingles(t) for i, t in steps[-1]}
    low = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                if low[a] < low[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]) > 0:
                    low[b], changed = low[a], True
    steps.append([(i, t) for i, t in steps[-1] if low[i] == i])
    seen, cut = set(), []
    for i, t in sorted(steps[-1]):
        b = t.encode()
        gone = bytearray(len(b))
        for p in range(len(b) - 99):
            if b[p:p + 100] in seen:
                gone[p:p + 100] = b"\x01" * 100
            seen.add(b[p:p + 100])
        cut.append((i, bytes(x for x, g in zip(b, gone) if not g).decode(errors="ignore")))
    steps.append(cut)
    lib = Tokenizer.from_file(BYTES)
    lib.encode_special_tokens = True
    at, pieces = 0, []
    for i, t in cut:
        ids = [*lib.encode(t, add_special_tokens=False).ids, 1]
        k = 0
        while k < len(ids):
            take = min(len(ids) - k, 2048 - at % 2048)
            part = ids[k:k + take]
            pieces.append((i, k, take, zlib.crc32(struct.pack(f"<{take}I", *part)), len(ids), at // 2048, at % 2048))
            k, at = k + take, at + take
    assert len(pieces) > len(cut)
    return steps, sorted(pieces)


def test_run_equals_a_chain_on_one_machine(spark, tmp):
    rows = chain_rows()
    good = {i for i, _ in rows if i >= 60 or i % 13}
    steps, pieces = brute_chain(rows, good)
    sizes = [len(rows), *map(len, steps[:3])]
    assert sizes == sorted(set(sizes), reverse=True) and steps[3] != sorted(steps[2])     # every stage does something
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(5).write.parquet(f"{tmp}/documents.parquet")
    spark.createDataFrame([(i, int(i in good), 0) for i, _ in rows], "doc_id long, quality int, toxic int").write.parquet(f"{tmp}/labels.parquet")
    left = table(spark, tmp, "documents")
    for (name, stage), want in zip(C.STAGES[:-1], steps, strict=True):
        left = saved(stage(spark, left, tmp), "chain")
        assert sorted((r["doc_id"], r["text"]) for r in left.collect()) == sorted(want), name
    assert sorted(map(tuple, C.run(spark, tmp).collect())) == pieces


ODD = [(1, "a b"), (1, "a b"), (None, "a b"), (None, None), (2, ""), (2, "x " * 80), (2, "y " * 80), (None, "q" * 300_000),
       (5, " ".join(f"w{k}" for k in range(90))), (6, " ".join(f"w{k}" for k in range(90))), (7, " ".join(f"v{k}" for k in range(70)))]


def test_stages_on_odd_rows_and_names(spark, tmp):
    """Null and repeated ids, empty and very long texts, and columns named
    like an operator's own pass through every stage; empty tables too."""
    spark.createDataFrame([(5, 1, 0), (None, 1, 0), (7, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp}/labels.parquet")
    extra = "_row string, tie string, spans string, key string, words string, kept boolean, _id long, root long, part int"
    docs = spark.createDataFrame([(i, t, len(t or ""), "r", "t", "s", "k", "w", False, 4, 5, 6) for i, t in ODD],
                                 f"doc_id long, text string, n_chars long, {extra}").repartition(3)
    count = {"quality rules": None, "exact dedup": 7, "n-gram Jaccard join": None, "suffix-array dedup": len(ODD)}
    for name, stage in C.STAGES[:-1]:
        out = stage(spark, docs, tmp)
        assert out.columns == docs.columns, name
        rows = out.collect()
        assert all(r["_row"] == "r" and r["kept"] is False and r["part"] == 6 for r in rows), name
        if count[name] is not None:
            assert len(rows) == count[name], name
        assert stage(spark, docs.limit(0), tmp).collect() == []
    texts_left = sorted((r["text"] or "")[:9] for r in C.near(spark, docs, tmp).collect())
    assert texts_left.count("w0 w1 w2 ") == 1 and texts_left.count("v0 v1 v2 ") == 1
    packed = C.pack(spark, docs, tmp).collect()
    assert sum(r["length"] for r in packed) == sum(r["doc_tokens"] for r in packed if r["start"] == 0)
    assert C.pack(spark, docs.limit(0), tmp).collect() == []
