"""Every operator against a brute-force version on small documents."""

import hashlib
import math
import random
import re
import struct
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

P = pytest.importorskip("public_tokenizers")
from shopflow.llm import exact_dedup as ED  # noqa: E402
from shopflow.llm import jaccard_join as JJ  # noqa: E402
from shopflow.llm import kneser_ney as KN  # noqa: E402
from shopflow.llm import language_id as LI  # noqa: E402
from shopflow.llm import packing as PK  # noqa: E402
from shopflow.llm import quality_rules as QR  # noqa: E402
from shopflow.llm import sentence_pieces as SP  # noqa: E402
from shopflow.llm import suffix_dedup as SD  # noqa: E402
from shopflow.llm import token_store as TS  # noqa: E402
from shopflow.llm import toxicity as TX  # noqa: E402
from shopflow.llm.byte_tokens import ByteTokens  # noqa: E402

PIECES, BYTES = P.path("piece_bpe_32k.model"), P.path("byte_bpe_50k.json")
SPACES = "[\x20\x09-\x0d]+"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, words string, tie string, spans string, _row string, n_chars long"


def words(text):
    return [w for w in re.split(SPACES, text or "") if w]


def corpus():
    """Copies, near copies, shared passages, odd characters, empties."""
    rnd = random.Random(7)
    voc = [rnd.choice(["the", "Ünd", "éo", "x1", "中文", "ing"]) + rnd.choice("abcdeféß,.!") * rnd.randint(1, 2) for _ in range(60)]
    base = [[rnd.choice(voc) for _ in range(rnd.randint(1, 90))] for _ in range(30)]
    out = []
    for i in range(260):
        w = list(rnd.choice(base))
        for _ in range(rnd.randint(0, 3)):
            w[rnd.randrange(len(w))] = rnd.choice(voc)
        if rnd.random() < 0.3:
            w += rnd.choice(base)
        out.append((3 * i, rnd.choice([" ", " ", "  ", "\n"]).join(w)))
    odd = [None, "", " \n", "One", "one", "ab" * 400, "x" * 1000, "</s> <0x41> <|endoftext|> ▁a\x00\x1c\xa0 😀 x ", "I'm  we'll\n \n  "]
    out += [(2000 + k, t) for k, t in enumerate(odd)]
    out.append((2100, "".join(rnd.choice("thehain") for _ in range(9000))))
    out.append((2101, " ".join(rnd.choice(voc) for _ in range(6000))))
    return out


DOCS = corpus()


def frame(spark, rows):
    return spark.createDataFrame([(i, t, ("en", "de")[i % 2 if i else 0], "w", "t", "s", "r", len(t or "")) for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, DOCS).repartition(5).cache()


def test_sentence_pieces(spark, docs):
    import sentencepiece
    lib = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = {r["doc_id"]: r for r in SP.round_trip(spark, docs, PIECES).collect()}
    for i, t in DOCS:
        ids = lib.encode(t or "", add_eos=True)
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), t
        assert got[i]["decoded_sha256"] == hashlib.sha256(lib.decode(ids).encode()).hexdigest(), t
    back = SP.decode(spark, SP.encode(spark, docs, PIECES), PIECES)
    assert {r["doc_id"]: r["text"] for r in back.collect()} == {i: lib.decode(lib.encode(t or "")) for i, t in DOCS}


def byte_ids():
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(BYTES)
    lib.encode_special_tokens = True
    return {i: lib.encode(t or "", add_special_tokens=False).ids for i, t in DOCS}


def crc(ids):
    return zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))


def test_token_store(spark, docs):
    ids, at = byte_ids(), 0
    path = TS.write_tokens(spark, docs, BYTES, 0)
    got = {r["doc_id"]: r for r in TS.digests(spark, path).collect()}
    for i, _ in sorted(DOCS):
        want = ids[i] + [0]
        assert (got[i]["start"], got[i]["n_tokens"], got[i]["ids_crc32"]) == (at, len(want), crc(want))
        at += len(want)
    part = TS.read_tokens(spark, path, "doc_id", "ids", first=300, last=303)
    assert {r["doc_id"]: r["ids"] for r in part.collect()} == {i: ids[i] + [0] for i in (300, 303)}
    meta = TS.read_tokens(spark, path, "doc_id", "n_tokens")
    assert "ids" not in meta._jdf.queryExecution().executedPlan().toString()


def test_byte_ids_at_borders():
    """Marks, contractions, runs of white space and rare spaces in any order,
    alone and behind other texts, as the library encodes the whole text."""
    rnd, enc = random.Random(11), ByteTokens(BYTES)
    parts = list(" " * 12 + "\n\n\t\r\x0b\x0c''.,-_\"()aAsStTdm09|<>\x00\x1c\x1f\x7f" + "\xb2\xaa\xe9\xdf\xd7\xf7\u01bb\u023f\u0240\u02b0\u03a9\u044f\u4e2d\u3002\u201c\u2014\U0001f600\ufeff"
                 "\x85\xa0\u1680\u180e\u2003\u2028\u205f\u3000") + ["'s", "'ll", "<|endoftext|>", "the", "  ", "\n    ", "\xdcnd", ".\nHa"]
    rows = ["".join(rnd.choice(parts) for _ in range(rnd.choice([0, 1, 2, 3, 5, 8, 40]))) for _ in range(4000)]
    flat, n = enc.encode(pa.array(["before", *rows])[1:], 0)
    got = np.split(flat, np.cumsum(n)[:-1])
    for t, ids in zip(rows, got, strict=True):
        assert ids.tolist() == enc.library.encode(t, add_special_tokens=False).ids + [0], repr(t)


def test_byte_pieces_leave_marks_and_lines_out():
    """A word is encoded once, whatever mark or line break stands beside it."""
    enc = ByteTokens(BYTES)
    names = [a + b + c for a in "bdfgkl" for b in "aeiou" for c in "mnrst"]
    rows = [" ".join(w + m for w in names) for m in ",.;:!?)"] + ["\n".join(names)]
    rows += [" ".join(f"{w}.\n{v}" for w in names) for v in names[:5]]
    enc.encode(pa.array(rows), 0)
    assert len(enc.cache.index) < 2.2 * len(names)


def test_byte_ids_when_the_cache_empties():
    enc, ids = ByteTokens(BYTES), byte_ids()
    enc.cache.entries = 0
    for k in [*range(0, len(DOCS), 5)] * 2:
        rows = DOCS[k:k + 5]
        flat, n = enc.encode(pa.array([t or "" for _, t in rows]), 0)
        assert flat.tolist() == [x for i, _ in rows for x in [*ids[i], 0]]
        assert n.tolist() == [len(ids[i]) + 1 for i, _ in rows]


def test_packing(spark, docs):
    ids = byte_ids()
    packed = PK.pack(spark, docs, BYTES, 1, window=256, with_ids=True).cache()
    seen, seqs = defaultdict(list), defaultdict(list)
    for r in packed.collect():
        want = ids[r["doc_id"]] + [1]
        assert r["ids"] == want[r["start"]:r["start"] + r["length"]] and r["ids_crc32"] == crc(r["ids"])
        assert r["doc_tokens"] == len(want)
        seen[r["doc_id"]].append((r["start"], r["length"]))
        seqs[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, _ in DOCS:
        assert sum(n for _, n in seen[i]) == len(ids[i]) + 1 and len({s for s, _ in seen[i]}) == len(seen[i])
    for k, parts in seqs.items():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at == 256 or k == max(seqs)
    whole = PK.sequences(packed).orderBy("sequence_id").collect()
    assert [i for r in whole for i in r["ids"]] == [i for d, _ in sorted(DOCS) for i in ids[d] + [1]]


@pytest.mark.parametrize("budget", [64 << 20, 3000])
def test_exact_dedup(spark, docs, budget):
    got = {r["doc_id"]: r for r in ED.exact_dedup(spark, docs, table_bytes=budget, buckets=3).collect()}
    groups = defaultdict(list)
    for i, t in DOCS:
        groups[re.sub(SPACES, "", t or "")].append((-len(t or ""), i))
    for text, rows in groups.items():
        keep = min(rows)[1]
        for _, i in rows:
            r = got[i]
            assert (r["keep_id"], r["group_size"], r["kept"]) == (keep, len(rows), i == keep)
            assert r["text_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def shingles(text):
    w = words((text or "").translate(LOWER))
    return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


@pytest.mark.parametrize("long_list,block", [(48, 1000), (2, 7)])
def test_jaccard_join(spark, docs, monkeypatch, long_list, block):
    monkeypatch.setattr(JJ, "LONG_LIST", long_list)
    monkeypatch.setattr(JJ, "BLOCK", block)
    sets = {i: shingles(t) for i, t in DOCS}
    root = {i: i for i in sets}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]) > 0:
                u, v = sorted((top(a), top(b)))
                root[v] = u
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in JJ.jaccard_join(spark, docs).collect()}
    assert got == {i: (len(sets[i]), top(i)) for i in sets}
    assert len({top(i) for i in sets}) < len(sets) - 50


def test_prefix_depth_follows_cost():
    import numpy as np
    cheap, dear = JJ.prefix(100, np.full(90, 2)), JJ.prefix(100, np.concatenate([np.full(16, 2), np.full(74, 5000)]))
    assert cheap[1] - cheap[0] == dear[1] - dear[0] == 100 - 75 - 10
    assert dear[0] < cheap[0]


@pytest.mark.parametrize("buckets,block", [(4, 400_000), (3, 60)])
def test_suffix_dedup(spark, docs, buckets, block):
    got = {r["doc_id"]: r for r in SD.suffix_dedup(spark, docs, buckets, block).collect()}
    seen, total = set(), 0
    for i, t in sorted(DOCS):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - 99):
            if b[p:p + 100] in seen:
                gone[p:p + 100] = b"\x01" * 100
            seen.add(b[p:p + 100])
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        r = got[i]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"]) == (len(b), sum(gone), spans), i
        assert r["kept_sha256"] == hashlib.sha256(kept).hexdigest()
        total += sum(gone)
    assert total > 1000


def test_suffix_dedup_keeps_its_block_with_a_frequent_line(spark, monkeypatch):
    """A line shorter than LENGTH in many contexts is no block of its own."""
    block, real = 3000, SD._block

    def bounded(h, off, doc, tie, lo, n, raw, at):
        assert int((n - 99).sum()) <= block
        return real(h, off, doc, tie, lo, n, raw, at)
    monkeypatch.setattr(SD, "_block", bounded)
    rnd = random.Random(5)
    text = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n))
    line, passage = "terms of use: a line that comes in every document, ok", text(150)
    rows = [(i, f"{text(90)} {line} {text(90)}") for i in range(400)]
    rows += [(400 + i, f"{text(20)}{line}{passage}") for i in range(5)] + [(1, rows[7][1]), (1, rows[7][1]), (None, rows[9][1])]
    got = {(r["doc_id"], r["n_bytes"], r["kept_sha256"]): r["n_removed"]
           for r in SD.suffix_dedup(spark, frame(spark, rows).repartition(6), 3, block).collect()}
    size = lambda i, t: next(n for (d, b, _), n in got.items() if d == i and b == len(t))
    assert [got[i, len(t), hashlib.sha256(t.encode()).hexdigest()] for i, t in rows[:400] if i not in (1, 7, 9)] == [0] * 397
    assert [size(400 + i, rows[400 + i][1]) for i in range(5)] == [0] + [len(line) + 150] * 4
    assert size(7, rows[7][1]) == len(rows[7][1]) and size(9, rows[9][1]) == 0 and size(None, rows[9][1]) == len(rows[9][1])
    assert [n for (d, _, _), n in got.items() if d == 1] == [0, 0]  # its own text and the copies of one id and text


def test_suffix_dedup_sorts_a_frequent_line_by_distances(spark, monkeypatch):
    """More suffixes than a block before one anchor, but not at any one
    distance: they are sorted some distances at a time, never hashed."""
    block, real, calls = 6000, SD._block, []

    def bounded(h, off, doc, tie, lo, n, raw, at):
        assert int((n - 99).sum()) <= block
        return real(h, off, doc, tie, lo, n, raw, at)
    monkeypatch.setattr(SD, "_block", bounded)
    monkeypatch.setattr(SD, "_windows", lambda blobs: calls.append(blobs))
    rnd = random.Random(6)
    text = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n))
    line = "terms of use: a line that comes in every document, ok"
    rows = [(i, f"{text(90)} {line} {text(90)}") for i in range(400)]
    for i in range(0, 60, 3):        # some repeat a neighbour's line with more or less around it
        a, b = rows[i][1].index(line), rnd.randint(0, 60)
        rows.append((1000 + i, text(30) + rows[i][1][a - b:a + len(line) + 70 - b // 2] + text(40)))
    got = {r["doc_id"]: (r["n_removed"], r["n_spans"], r["kept_sha256"])
           for r in SD.suffix_dedup(spark, frame(spark, rows).repartition(6), 2, block).collect()}
    seen = set()
    for i, t in rows:
        b = t.encode()
        gone = bytearray(len(b))
        for p in range(len(b) - 99):
            if b[p:p + 100] in seen:
                gone[p:p + 100] = b"\x01" * 100
            seen.add(b[p:p + 100])
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        assert got[i] == (sum(gone), spans, hashlib.sha256(kept).hexdigest()), i
    assert sum(n for n, _, _ in got.values()) > 1000 and not calls


def test_native_rules_run_without_python(spark):
    labels = spark.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int")
    plan = QR.quality_rules(spark, frame(spark, DOCS[:20]), labels)._jdf.queryExecution().toString()
    assert not re.search("InArrow|InPandas|EvalPython", plan)


def test_anchors_spread_over_the_buckets():
    import numpy as np
    b = np.random.default_rng(0).integers(97, 123, 200_000).astype(np.uint8)
    share = np.bincount(SD._hash_bucket(SD.anchors(b, np.array([len(b)]))[1], 12), minlength=12) / 200_000 * 35
    assert share.max() < 2 * share.min()


def test_suffix_dedup_of_long_pieces(spark, monkeypatch):
    monkeypatch.setattr(SD, "_PIECE", 500)
    rnd = random.Random(1)
    text = "".join(rnd.choice("abc ") for _ in range(3000))
    rows = [(1, text), (2, "zz" + text[400:1700] + "yy" + text[10:90])]
    got = {r["doc_id"]: r["n_removed"] for r in SD.suffix_dedup(spark, frame(spark, rows), 3).collect()}
    assert got == {1: 0, 2: 1300}


def test_language_id(spark):
    rnd = random.Random(2)
    syllables = {"en": "th he in er an re".split(), "de": "sch ü ei ch ung ö".split()}
    rows = [(i, " ".join("".join(rnd.choices(syllables[lang], k=3)) for _ in range(30)), lang)
            for i in range(100) for lang in [("en", "de")[i % 2]]]
    rows += [(500, None, "en"), (501, "123 !", "en"), (502, "the thin", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in LI.language_id(spark, df).collect()}
    assert all(got[i]["lang_pred"] == lang and 0 <= got[i]["score"] <= 1 for i, _, lang in rows[:100])
    assert got[500]["lang_pred"] == got[501]["lang_pred"] == "und" and got[502]["lang_pred"] == "en"
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i in got)
    counts = Counter()
    for i, t, lang in rows:
        if lang == "en" and zlib.crc32(str(i).encode()) % 5:
            s = re.sub(r"[^a-z]+", " ", f" {(t or '').lower()} ")
            counts.update(s[k:k + n] for n in (1, 2, 3) for k in range(len(s) - n + 1) if s[k:k + n] != " ")
    learned = LI.profiles(df.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0), 20)["en"]
    number = lambda g: sum((1 if c == " " else ord(c)) << 21 * (len(g) - 1 - k) for k, c in enumerate(g))
    assert learned == [number(g) for g, _ in sorted(counts.items(), key=lambda x: (-x[1], number(x[0])))[:20]]


def test_toxicity(spark):
    rnd = random.Random(3)
    voc = ["w%s" % "".join(rnd.choices("abcdefgh", k=4)) for _ in range(300)]
    bad = ["scumbag", "morontic", "trashy", "idioten", "vileness", "loserly"]
    rows, labels = [], []
    for i in range(900):
        w, toxic = [rnd.choice(voc) for _ in range(40)], int(i % 8 == 0)
        for _ in range(rnd.randint(2, 5) if toxic else 0):
            w.insert(rnd.randrange(len(w)), rnd.choice(bad))
        rows.append((i, " ".join(w)))
        if i % 3:
            labels.append((i, 1, toxic))
    rows += [(2000, None), (2001, "")]
    out = TX.toxicity(spark, spark.createDataFrame(rows, "doc_id long, text string"),
                      spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    got = {r["doc_id"]: r for r in out.collect()}
    assert sum(got[i]["predicted"] == (i % 8 == 0) for i in range(900)) >= 890
    assert got[2000]["predicted"] == got[2001]["predicted"] == 0
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_toxicity_mines_all_labelled_rows(spark, monkeypatch):
    """A term in few of many labelled texts, and the last of many terms, count."""
    import itertools
    n = 30_000
    train = spark.range(n).where(F.crc32(F.col("id").cast("string").cast("binary")) % 5 != 0)
    last = [r["id"] for r in train.orderBy(F.desc(F.xxhash64("id"))).limit(6).collect()]  # outside any sample by hash
    rare = ["".join(c) for c in itertools.islice(itertools.product("qxzvkwjp", repeat=4), 4090)]
    text = {i: "plain words of no harm" + " and so" * (i % 3) for i in range(n)}
    for i in last[:3]:
        text[i] += " zorb"
    for i in last[3:]:
        text[i] += " " + " ".join(rare)
    rows = list(text.items()) + [(n, "one zorb"), (n + 1, f"one {rare[-1]}"), (n + 2, "one word")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    labels = spark.createDataFrame([(i, int(i in last)) for i in range(n)], "doc_id long, toxic int")
    runs = []
    for bound in (TX.BROADCAST_BYTES if hasattr(TX, "BROADCAST_BYTES") else 0, 0):
        monkeypatch.setattr(TX, "BROADCAST_BYTES", bound, raising=False)
        got = {r["doc_id"]: r["score"] for r in TX.toxicity(spark, docs, labels).collect()}
        assert got[n] > got[n + 2] and got[n + 1] > got[n + 2]
        runs.append(got)
    assert len(runs[0]) == n + 3 and all(math.isclose(runs[0][i], runs[1][i], rel_tol=1e-9) for i in runs[0])


def test_label_model_learns_accuracies_without_labels():
    import numpy as np
    rnd = np.random.default_rng(0)
    y = rnd.random(20000) < 0.3
    right = np.array([0.95, 0.9, 0.8, 0.7])
    votes = np.where(rnd.random((len(y), 4)) < right, np.where(y, 1, -1)[:, None], np.where(y, -1, 1)[:, None])
    m = TX.fit_label_model(votes, np.ones(len(y)), 0.3)
    assert list(np.argsort(-m.table[:, 1, 2])) == [0, 1, 2, 3]
    assert ((m.posterior(votes) > 0.5) == y).mean() > 0.9


def test_language_distance_and_ties(spark):
    """Profiles, distances, scores and ties against plain counting."""
    rnd = random.Random(4)
    rows = [(i, " ".join("".join(rnd.choices("abcdeé", k=rnd.randint(1, 5))) for _ in range(rnd.randint(0, 30))), lang)
            for i, lang in enumerate(["x", "y", "z", None] * 15)]
    rows += [(900, "same words", "twin a"), (901, "same words", "twin b"), (902, None, "x"), (903, "123 456", "y"),
             (904, "".join(rnd.choices("abcdeé ", k=200_000)), "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for size in (20, 300):
        count = defaultdict(Counter)
        for _, t, lang in rows:
            if lang is not None:
                count[lang].update(LI.grams(t or "").tolist())
        order = lambda c: sorted(c, key=lambda g: (-c[g], g))[:size]
        want = {lang: order(c) for lang, c in count.items() if c}
        known = LI.profiles(df, size)
        assert known == want
        got = {r["doc_id"]: r for r in LI.predict(df, known, size).collect()}
        for i, t, _ in rows:
            mine = order(Counter(LI.grams(t or "").tolist()))
            if not mine or not any(map(str.isalpha, t)):
                assert (got[i]["lang_pred"], got[i]["score"]) == ("und", 0.0)
                continue
            far = {lang: sum(abs(p.index(g) - k) if g in p else size for k, g in enumerate(mine)) for lang, p in want.items()}
            best = min(sorted(far), key=lambda lang: far[lang])
            assert got[i]["lang_pred"] == best and math.isclose(got[i]["score"], 1 - far[best] / (size * len(mine)))
        assert got[900]["lang_pred"] == got[901]["lang_pred"] == "twin a"


def test_kneser_ney(spark, docs):
    got = {r["doc_id"]: r for r in KN.score(docs, KN.train(spark, docs.where(~KN.held_out()))).collect()}
    tok = lambda t: words((t or "").translate(LOWER)) + ["\n"]
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    c, bi = Counter(), Counter()
    for i, t in DOCS:
        if not held(i):
            x = tok(t)
            c.update(x)
            bi.update(zip(["<s>", *x[:-1]], x))
    total, v = sum(c.values()), len(c)
    ctx, kinds, cont = Counter(), defaultdict(lambda: [0, 0, 0]), Counter()
    for (a, b), n in bi.items():
        ctx[a] += n
        kinds[a][min(n, 3) - 1] += 1
        cont[b] += 1
    tally = lambda xs: [sum(x == k for x in xs) for k in (1, 2, 3, 4)]
    up, low = KN.discounts(tally(bi.values())), KN.discounts(tally(cont.values()))
    less = lambda n, d: max(n - ([0.0, *d])[min(n, 3)], 0.0)
    back0 = sum(low[min(n, 3) - 1] for n in cont.values()) / len(bi)
    p0 = lambda b: less(cont[b], low) / len(bi) + back0 / (v + 1)
    p = lambda a, b: less(bi[a, b], up) / ctx[a] + sum(d * k for d, k in zip(up, kinds[a])) / ctx[a] * p0(b) if ctx[a] else p0(b)
    assert abs(sum(p("<s>", b) for b in c) + p("<s>", "never seen") - 1) < 1e-9
    for i, t in DOCS:
        x, r = tok(t), got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held(i), len(x), sum(w in c for w in x), total)
        assert math.isclose(r["base_score"], sum(math.log10((c[w] + 1) / (total + v + 1)) for w in x), rel_tol=1e-9)
        assert math.isclose(r["score"], sum(math.log10(p(a, b)) for a, b in zip(["<s>", *x[:-1]], x)), rel_tol=1e-9)


def test_quality_rules(spark, docs):
    import xxhash
    labels = spark.createDataFrame([(i, int(i % 2 == 0), 0) for i, _ in DOCS], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in QR.quality_rules(spark, docs, labels).collect()}
    bucket = lambda h: (h - (1 << 64) if h >> 63 else h) % QR.BUCKETS
    raw, hit, grams = Counter(), Counter(), {}
    for i, t in DOCS:
        e = [bucket(xxhash.xxh64_intdigest(w[-3:].encode(), seed=42)) for w in words(t)]
        pair = [bucket(xxhash.xxh64_intdigest(struct.pack("<i", b), seed=xxhash.xxh64_intdigest(struct.pack("<i", a), seed=42)))
                for a, b in zip(e, e[1:])]
        grams[i] = e + pair
        raw.update(grams[i])
        if i % 2 == 0:
            hit.update(grams[i])
    n, m = sum(raw.values()) + QR.BUCKETS, sum(hit.values()) + QR.BUCKETS
    ratio = lambda g: round(1e6 * (math.log((hit[g] + 1) / m) - math.log((raw[g] + 1) / n)))
    for i, t in DOCS:
        w, t, r = words(t), t or "", got[i]
        count = Counter(zip(w, w[1:], w[2:]))
        again = {k + j for k in range(len(w) - 2) if count[tuple(w[k:k + 3])] > 1 for j in range(3)}
        lines = [x for x in t.split("\n") if words(x)]
        want = (len(w), sum(map(len, w)), sum(ch in "#*$%&|<>" for ch in t), len(lines) - len(set(lines)), len(again))
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want, i
        failed = len(w) < 50 or 100 * len(again) > 50 * len(w)
        total = sum(map(ratio, grams[i]))
        assert r["base_failed"] == failed
        assert r["kept"] == (not failed and total >= QR.THRESHOLD * 1e6 * len(grams[i])), i
        assert math.isclose(r["score"], total / 1e6 / len(grams[i]) if grams[i] else 0.0, abs_tol=1e-9)


OPERATORS = {
    "jaccard_join": lambda s, d, lab: JJ.jaccard_join(s, d), "exact_dedup": lambda s, d, lab: ED.exact_dedup(s, d),
    "sentence_pieces": lambda s, d, lab: SP.round_trip(s, d, PIECES),
    "token_store": lambda s, d, lab: TS.digests(s, TS.write_tokens(s, d, BYTES, 0)),
    "suffix_dedup": lambda s, d, lab: SD.suffix_dedup(s, d), "toxicity": TX.toxicity,
    "kneser_ney": lambda s, d, lab: KN.score(d, KN.train(s, d)), "language_id": lambda s, d, lab: LI.language_id(s, d),
    "packing": lambda s, d, lab: PK.pack(s, d, BYTES, 1), "quality_rules": QR.quality_rules,
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_empty_null_and_repeated_rows(spark, name):
    labels = spark.createDataFrame([(1, 1, 0), (None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    same = "a text that comes again and again " * 8
    rows = [(1, same), (1, same), (None, same), (None, None), (2, ""), (3, "other words " * 60), (2, "a second text of one id")]
    got = OPERATORS[name](spark, frame(spark, rows), labels).collect()
    ids = sorted(r["doc_id"] or -1 for r in got)
    assert set(ids) == {-1, 1, 2, 3} and (name == "packing" or len(got) == len(rows))
    if name == "exact_dedup":
        assert sum(r["kept"] for r in got) == 4
    assert OPERATORS[name](spark, frame(spark, []), labels).collect() == []
    assert OPERATORS[name](spark, frame(spark, [(5, None)]), labels.limit(0)).count() == 1
