"""Every operator against a brute-force version, and its defined results for
nulls, empty tables, repeated rows, ties, long texts and clashing columns."""

import collections
import hashlib
import math
import re
import zlib

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import __spark_entry__ as E
from stategrid.llm import (ann, chat, decontaminate, line_dedup, packing, quality, sharding,
                           simhash, suffix_dedup, toxicity)
from stategrid.llm.graph import components
from stategrid.llm.suffix_array import common_prefixes, suffix_array

SF = "/root/testdata/sf0.001"
DOC = ("doc_id long, text string, lang string, source string, n_chars long, n long, h string, "
       "_fp_ string, t1 string, size string")
TOKENIZER = __import__("public_tokenizers").path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.fixture(scope="module")
def texts(duck):
    return dict(duck.execute("SELECT doc_id, text FROM documents").fetchall())


def docs(spark, rows):
    """rows (doc_id, text), with extra columns whose names operators use inside."""
    return spark.createDataFrame([(i, t, None, None, None, 1, "x", "y", "z", "s")
                                  for i, t in rows], DOC)


ODD = [(1, None), (2, ""), (None, "some words here"), (None, None), (5, "word " * 30_000),
       (6, "a" * 5000), (7, "same text of two rows\nsame text of two rows"),
       (7, "same text of two rows\nsame text of two rows"), (8, "\n\n\n"), (9, "é<|x|> \x01 \\b")]


@pytest.mark.parametrize("name", [n for n in E.queries() if re.match(r"op\d+_|pipeline", n)])
def test_registered_query_runs(spark, name):
    df = E.queries()[name](spark, SF)
    assert df.count() > 0


@pytest.mark.parametrize("name", [n for n in E.oracle_sql() if re.match(r"op\d+_", n)])
def test_sql(spark, duck, name):
    df = E.queries()[name](spark, SF)
    cols = sorted(df.columns)
    cur = duck.execute(E.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    assert sorted(tuple(r[c] for c in cols) for r in df.collect()) == sorted(
        tuple(r[names.index(c)] for c in cols) for r in cur.fetchall())


# --- 1: nearest neighbours

def test_ann_recall_and_rules(spark):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((1500, 16)).astype(np.float32)
    x[700:] = x[700]                                     # a vector that half of the rows repeat
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(2000, None), (2020, [0.0] * 16), (2040, [math.nan] + [1.0] * 15), (None, [1.0] * 16),
             (2060, [None] + [1.0] * 15), (2080, [1.0, 2.0]), (2100, [math.inf] * 16),
             (20, rows[20][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = collections.defaultdict(list)
    for r in ann.search(df, F.col("vec_id") % 20 == 0, k=20, block=400, chunk=30).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    v = x.astype(np.float64)
    hits = 0
    for q in range(0, 1500, 20):
        s = v @ v[q]
        s[q] = -np.inf
        best = sorted(range(1500), key=lambda i: (-s[i], i))[:20]
        mine = sorted(got[q])
        assert [m[0] for m in mine] == list(range(1, 21))
        assert all(a[2] > b[2] or (a[2] == b[2] and a[1] < b[1]) for a, b in zip(mine, mine[1:]))
        assert all(abs(m[2] - s[m[1]]) < 1e-9 and m[1] != q for m in mine)
        hits += len({m[1] for m in mine} & set(best))
    assert hits / (75 * 20) >= 0.9
    assert set(got) == set(range(0, 1500, 20))           # 2080 has no partner of its length
    assert ann.search(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert "double" in dict(ann.search(df, F.lit(False)).dtypes)["score"]


# --- 2: suffix arrays

def test_suffix_array_and_prefixes():
    rng = np.random.default_rng(1)
    for trial in range(150):
        t = rng.integers(0, rng.integers(1, 5), rng.integers(1, 60)).astype(np.uint8)
        t = np.tile(t, 3) if trial % 3 == 0 else t
        s = np.append(t.astype(np.uint16) + 1, 0).astype(np.uint16)
        sa = suffix_array(s, 6)
        assert sa.tolist() == sorted(range(len(s)), key=lambda i: s[i:].tolist())
        text = np.append(t, 255).astype(np.uint8)
        shared = common_prefixes(text, sa)
        for a, b in zip(sa[:-1], sa[1:]):
            n = 0
            while max(a, b) + n < len(text) and text[a + n] == text[b + n]:
                n += 1
            assert shared[b] == n


def brute_repeats(rows, length):
    data = [(t or "").encode() for _, t in rows]
    seen = collections.Counter(t[i:i + length] for t in data for i in range(len(t) - length + 1))
    out = []
    for t in data:
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = True
        edges = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(int)))))
        out.append((edges.reshape(-1, 2).tolist(),
                    bytes(b for b, g in zip(t, gone) if not g)))
    return out


@pytest.mark.parametrize("hot", [20_000, 2])
def test_suffix_dedup_brute_force(spark, texts, hot):
    rng = np.random.default_rng(5)
    word = lambda: "".join(rng.choice(list("abcdeé"), rng.integers(2, 7)))
    passage = " ".join(word() for _ in range(60))
    rows = list(texts.items())[:60] + ODD[:4] + ODD[5:]
    for i in range(40):
        around = [" ".join(word() for _ in range(rng.integers(0, 40))) for _ in range(2)]
        cut = passage[:rng.integers(100, len(passage))] if i % 2 else passage
        rows.append((10_000 + i, around[0] + cut + around[1]))
    rows.append((20_000, passage + passage + "x" + passage))
    got = collections.Counter((r.doc_id, tuple((s.start, s.end) for s in r["_spans"]),
                               bytes(r["_kept"])) for r in suffix_dedup.remove_repeats(
        docs(spark, rows), 200, hot=hot).collect())
    want = collections.Counter((i, tuple(map(tuple, spans)), kept) for (i, _), (spans, kept)
                               in zip(rows, brute_repeats(rows, 200)))
    assert got == want


def test_op2_columns(spark, texts):
    got = {r.doc_id: r for r in E.queries()["op2_suffix_dedup"](spark, SF).collect()}
    rows = list(texts.items())
    for (i, t), (spans, kept) in zip(rows, brute_repeats(rows, 200)):
        r = got[i]
        assert (r.n_bytes, r.n_removed, r.n_spans) == (
            len(t.encode()), sum(b - a for a, b in spans), len(spans))
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest()


# --- 3: lines

def test_line_dedup_odd(spark):
    line = "  A line of more than forty characters, é, to be found again\t"
    rows = ODD + [(i, f"x\n{line.upper() if i % 2 else line}\nown {i}\n") for i in range(20, 30)]
    out = line_dedup.dedup_lines(docs(spark, rows), batches=3, fanout=2).collect()
    assert len(out) == len(rows)
    by = collections.defaultdict(list)
    for r in out:
        by[r.doc_id].append(r)
    key = lambda s: re.sub("[A-Z]", lambda m: m[0].lower(), s.strip(" \t"))
    assert key(line) != key(line.upper())                # É is not lower-cased
    for i in range(20, 30):
        last = i in (28, 29)
        assert by[i][0]["_n_dropped"] == (0 if last else 1)
        assert by[i][0]["_kept"] == ([t for d, t in rows if d == i][0] if last
                                     else f"x\nown {i}\n")
    assert by[1][0]["_n_lines"] == 1 and by[1][0]["_kept"] == "" and by[8][0]["_n_lines"] == 4
    assert line_dedup.dedup_lines(docs(spark, []).limit(0)).count() == 0


def test_line_runs_compact(spark):
    runs = line_dedup.LineRuns(spark, fanout=2)
    for b in range(5):
        runs.add(spark.createDataFrame([(h, h, 1, 10 - b) for h in range(b, b + 3)],
                                       "h1 long, h2 long, docs long, keeper long"))
    assert sum(map(len, runs.levels)) <= 3
    got = {r.h1: (r.docs, r.keeper) for r in runs.merged(runs.all()).collect()}
    assert got == {h: (sum(b <= h < b + 3 for b in range(5)),
                       10 - min(b for b in range(5) if b <= h < b + 3)) for h in range(7)}


# --- 4: decontamination

def test_decontaminate_templates(spark):
    item = ("Yesterday the clever farmer Alice carried 12 kg of apples and 12 pears to market "
            "where Alice sold them for 30 dollars.")
    other = item.replace("Alice", "Boris").replace("12", "77").replace("30", "99")
    broken = item.replace("12 kg", "15 kg")              # one value of the item, two in the text
    bench = spark.createDataFrame(
        [(1, item), (2, None), (3, ""), (4, "Only five plain words here"), (None, "x y z w v u t s r"),
         (1, item)], "item_id long, text string")
    rows = ODD + [(20, "Some text before. " + item + " And after."), (21, "Text. " + other),
                  (22, "Text. " + broken), (23, item.upper()), (24, "the farmer sold apples"),
                  (25, "there are Only five plain words here indeed"), (26, " ".join(item.split()[:9]))]
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs(spark, rows), bench).collect()}
    assert {(20, 1), (21, 1)} <= got and (22, 1) not in got and (24, 1) not in got
    assert (25, 4) in got and (26, 1) not in got
    assert decontaminate.leaks(docs(spark, rows).limit(0), bench).count() == 0
    assert decontaminate.leaks(docs(spark, rows), bench.limit(0)).count() == 0


def leaked(spark, items, rows):
    bench = spark.createDataFrame(items, "item_id long, text string")
    return {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs(spark, rows), bench).collect()}


def test_decontaminate_other_case(spark):
    item = ("Yesterday the clever farmer Alice carried 12 kg of apples and 12 pears to market "
            "where Alice sold them for 30 dollars.")
    river = "Which river flows through Paris and Rouen before Le Havre"
    street = "In der Straße wohnt Frau Weiß mit ihrem Hund neben Herrn Groß"
    rows = [(23, item.upper()), (24, "So " + river.lower() + "?"), (25, river.title()),
            (26, street.upper()), (27, "which river flows through them and before the sea")]
    assert leaked(spark, [(1, item), (2, river), (3, street)], rows) == {
        (23, 1), (24, 2), (25, 2), (26, 3)}


def test_decontaminate_few_literals(spark):
    short, sums, one = "What is 17 times 23?", "Compute 3 + 5 * 7 - 2 + 9", "Compute 3 + 5"
    rows = [(1, "He asked: " + short + " Nobody knew."), (2, "WHAT IS 17 TIMES 23"),
            (3, "What is 17 times 24?"), (4, "then " + sums + " quickly"),
            (5, "Compute 3 + 5 * 7 - 2 + 8"), (6, "Name the capital"), (7, "?!"),
            (8, "numbers 1 2 3 4 5 6 7 8 9 10 11 12 13 and more")]
    items = [(1, short), (2, sums), (3, one), (4, "the capital"), (5, "?!"),
             (6, "1 2 3 4 5 6 7 8 9 10 11 12")]
    assert leaked(spark, items, rows) == {(1, 1), (2, 1), (4, 2), (4, 3), (5, 3), (6, 4), (8, 6)}


def test_decontaminate_conflicting_slots(spark):
    boxes = ("Tom has 2 boxes with 2 apples in each and wonders how many apples he has in total "
             "before his sister takes some away")
    long = ("On Monday the baker sold 12 loaves and 12 rolls to the first customer of the day who "
            "carried them home in a large basket and shared them with the neighbours from the "
            "house across the street because they had baked a cake for the children")
    rows = [(1, boxes.replace("2 boxes", "3 boxes").replace("2 apples", "5 apples")),
            (2, long.replace("12 loaves", "15 loaves")), (3, boxes), (4, long),
            (5, "Tom has 3 boxes with 2 apples in each")]
    assert leaked(spark, [(1, boxes), (2, long)], rows) == {(1, 1), (2, 2), (3, 1), (4, 2)}


def test_decontaminate_names_and_numbers(spark):
    item = ("Last week the old teacher Alice Smith told Ian McDonald that 1,200 pupils had walked "
            "3.5 km to the school where Alice Smith had taught them all")
    changed = (item.replace("Alice Smith", "Boris Brown").replace("McDonald", "Green")
               .replace("1,200", "950").replace("3.5", "12"))
    quoted = item.replace("Alice Smith", '"Alice" (Smith').replace("Ian", "'Ian")
    torn = item.replace("Alice Smith told", "Boris Brown told")       # one name, two people
    rows = [(1, "So: " + item), (2, changed), (3, quoted), (4, changed.replace("950", "23,456.75")),
            (50, "She said Hello to everyone in the room and left"), (51, "The price rose by 3.5 km")]
    got = leaked(spark, [(1, item), (2, "Hello"), (3, "42")], rows + [(60, torn)])
    assert got - {(60, 1)} == {(1, 1), (2, 1), (3, 1), (4, 1)}
    tk = lambda t, v: spark.range(1).select(decontaminate.tokens(
        F.lit(t), v).alias("t")).first().t
    for t in ("a 1,200.5 b 12,34 c 1.2.3 d 5,000kg e 7. f .8", "x Alice 3,000 km, (Bob 4.5%) 1,2345"):
        assert [w[:2] if w[0] == "\x01" else w for w in tk(t, True)] == tk(t, False)
    assert tk("a 1,200.5 x 12,34", True) == ["a", "\x01n1200\x015", "x", "\x01n12", "\x01n34"]


def test_decontaminate_shortest(spark):
    rows, items = [(1, "say Hello there")], [(1, "Hello")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert leaked(spark, items, rows) == set()
    assert decontaminate.leaks(docs(spark, rows), bench, shortest=1).count() == 1


CLASH = ["_id", "_t1", "_t2", "_k1", "_kept", "_toxic", "_lines", "_drop", "_n_lines", "_rows", "_spans",
         "_c1", "rest", "a.b", "h1", "item_id"]


def clashing(spark, rows):
    """rows (doc_id, text) with columns of the names that operators use inside."""
    return spark.createDataFrame(
        [(i, t, *[f"{c} {n}" for c in CLASH]) for n, (i, t) in enumerate(rows)],
        "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in CLASH))


def test_clashing_columns(spark):
    line = "A line of more than forty characters to be found again and again"
    rows = [(i, f"own {i}\n{line}") for i in range(6)] + [(7, None)]
    df = clashing(spark, rows)
    value = lambda r, n, cols: all(r[c] == f"{c} {n}" for c in cols)
    out = line_dedup.dedup_lines(df).collect()
    for r in out:
        n = 6 if r.doc_id == 7 else r.doc_id
        assert value(r, n, [c for c in CLASH if c not in line_dedup.RESULTS])
        assert r["_n_dropped"] == (1 if n < 5 else 0)
    cut = suffix_dedup.remove_repeats(df).collect()
    assert len(cut) == 7 and all(
        value(r, 6 if r.doc_id == 7 else r.doc_id, [c for c in CLASH if c not in ("_kept", "_spans")])
        for r in cut)


def test_pipeline_clashing_columns(spark):
    import corpus_pipeline as P
    rows = [(i, f"some words of document number {i} {'abcdefgh'[i] * 9} and so on") for i in range(4)]
    df = clashing(spark, rows + [(5, rows[0][1])])
    for _, stage in P.STAGES[:-1]:
        df2 = stage(spark, df, SF)
        assert df2.columns == df.columns
        got = {r.doc_id: r for r in df2.collect()}
        assert all(r[c] == f"{c} {min(i, 4)}" for i, r in got.items() for c in CLASH)


def test_decontaminate_brute_force(spark, duck, texts):
    items = duck.execute("SELECT item_id, text FROM benchmark").fetchall()
    want = {(i, k) for i, t in texts.items() for k, x in items if x in t}
    got = {(r.doc_id, r.item_id) for r in E.queries()["op4_decontaminate"](spark, SF).collect()}
    assert got == want and want


# --- 5: SimHash

def brute_fp(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(
        rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    if not words:
        return 0
    grams = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_simhash_brute_force(spark, texts):
    rows = list(texts.items()) + ODD + [(30, "one"), (31, "One two"), (32, "one TWO three")]
    out = simhash.near_duplicates(docs(spark, rows)).collect()
    assert len(out) == len(rows)
    fps = [brute_fp(t) for _, t in rows]
    assert collections.Counter((r.doc_id, r.fingerprint) for r in out) == collections.Counter(
        (i, f"{f:016x}") for (i, _), f in zip(rows, fps))
    parent = list(range(len(rows)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a
    for a in range(len(rows)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= 2:
                parent[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    want = {(f"{fps[k]:016x}", least.get(find(k))) for k in range(len(rows))}
    assert {(r.fingerprint, r.component_id) for r in out} == want


@pytest.mark.parametrize("bits", [0, 1, 2])
def test_simhash_links_chain(spark, bits):
    rng = np.random.default_rng(2)
    base = rng.integers(-2**63, 2**63, 40).tolist()
    fps = set(base)
    for f in base[:20]:                                   # dense clouds around some
        for _ in range(30):
            for b in rng.choice(64, rng.integers(1, 4), replace=False).tolist():
                f ^= (1 << b) - (1 << 64) if b == 63 else 1 << b
                fps.add(f)
    fps = sorted(fps)
    df = spark.createDataFrame([(f,) for f in fps], "_fp long")
    parts = {r.node: r.component for r in components(simhash.links(df, bits)).collect()}
    u = np.array(fps, np.int64).view(np.uint64)
    parent = {f: f for f in fps}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a
    for k, f in enumerate(fps):
        for j in np.flatnonzero(np.bitwise_count(u ^ u[k]) <= bits).tolist():
            a, b = sorted((find(f), find(fps[j])))
            parent[b] = a
    assert all(parts.get(f, f) == find(f) for f in fps)


def test_empty_tables(spark):
    none = docs(spark, [(1, "x")]).where("doc_id > 1")
    for df in (simhash.near_duplicates(none), suffix_dedup.remove_repeats(none),
               sharding.shard(none), packing.pack(none, TOKENIZER)):
        assert df.count() == 0


# --- 6: packing

def test_packing_round_trip(spark):
    from tokenizers import Tokenizer
    tk = Tokenizer.from_file(TOKENIZER)
    rows = ODD + [(40, "It's ¼ I'M foo_bar ΣΑΣ İx <|endoftext|> “q” x²")]
    out = packing.pack(docs(spark, rows), TOKENIZER, capacity=512, group_docs=4)
    ids = collections.Counter((i, np.array(tk.encode(t or "", add_special_tokens=False).ids + [2],
                                           "<u4").tobytes()) for i, t in rows)
    cut = out.collect()
    assert sum(r.length for r in cut) == sum(len(x) // 4 * n for (_, x), n in ids.items())
    assert {(r.doc_id, r.start, bytes(r["ids"])) for r in cut} == {
        (i, s, x[4 * s:4 * s + 2048]) for i, x in ids for s in range(0, len(x) // 4, 512)}
    whole = collections.defaultdict(list)
    for r in cut:
        whole[r.sequence_id].append((r.offset, r.length, bytes(r["ids"])))
    for ps in whole.values():
        at = 0
        for offset, length, _ in sorted(ps):
            assert offset == at
            at += length
        assert at <= 512
    seqs = {r.sequence_id: r for r in packing.sequences(out, 512).collect()}
    for s, ps in whole.items():
        data = b"".join(p[2] for p in sorted(ps))
        n = len(data) // 4
        full = data if n & (n - 1) == 0 else data + b"\0" * (2048 - len(data))
        assert bytes(seqs[s]["ids"]) == full and seqs[s].tokens == n


def test_first_fit_decreasing():
    rng = np.random.default_rng(4)
    lengths = rng.integers(1, 101, 300)
    bins, offsets = packing.first_fit_decreasing(lengths, 100)
    room, want = [], np.zeros(300, int)
    for i in np.argsort(-lengths, kind="stable"):
        k = next((k for k, r in enumerate(room) if r >= lengths[i]), len(room))
        room += [100] * (k == len(room))
        assert offsets[i] == 100 - room[k]
        room[k] -= lengths[i]
        want[i] = k
    assert (bins == want).all()
    assert len(packing.first_fit_decreasing(np.zeros(0, int), 100)[0]) == 0


# --- 7 and 10: classifiers

@pytest.mark.parametrize("name,label", [("op7_toxicity", "toxic"), ("op10_quality", "quality")])
def test_held_out_accuracy(spark, duck, name, label):
    mod, rest = (5, 0) if label == "toxic" else (3, 1)
    known = dict(duck.execute(f"SELECT doc_id, {label} FROM labels").fetchall())
    rows = E.queries()[name](spark, SF).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % mod == rest) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in known]
    assert sum(r.predicted == known[r.doc_id] for r in held) >= 0.85 * len(held) > 0


def test_toxicity_locates(spark):
    rows = [(i, f"nice words {i % 7}. more of them here." + (" you utter gronkface." if i % 3 == 0
                                                             else "")) for i in range(300)] + ODD
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(300)],
                                   "doc_id long, toxic int")
    df = docs(spark, rows)
    model = toxicity.train(df, labels, max_train=200)
    out = {r.text: r for r in df.select(
        "text", toxicity.score(F.col("text"), model).alias("s"),
        toxicity.offending(F.col("text"), model).alias("o")).collect()}
    for t, r in out.items():
        assert (r.s >= 0.5) == ("gronkface" in (t or ""))
        assert all("gronkface" in t[x.start:x.end] for x in r.o) and bool(r.o) == (r.s >= 0.5)
    assert out[""].s == 0 and out[None].s == 0
    none = toxicity.train(df, labels.limit(0))
    assert none == {} and df.select(toxicity.score(F.col("text"), none).alias("s")).where(
        "s > 0").count() == 0


def test_field_marginals_brute_force():
    rng = np.random.default_rng(6)
    trans = rng.standard_normal((2, 2))
    parts = [rng.standard_normal(n) for n in (5, 1, 3)]
    order, length, e = quality._padded(parts)
    good, pairs, z = quality._forward_backward(e, length, trans)
    for r, i in enumerate(order):
        n = length[r]
        total, marg, pair = 0.0, np.zeros(n), np.zeros((2, 2))
        for m in range(1 << n):
            y = [m >> k & 1 for k in range(n)]
            s = math.exp(sum(parts[i][k] * y[k] for k in range(n))
                         + sum(trans[a, b] for a, b in zip(y, y[1:])))
            total += s
            marg += s * np.array(y)
            for a, b in zip(y, y[1:]):
                pair[a, b] += s
        assert np.allclose(good[r, :n], marg / total) and np.allclose(pairs[r], pair / total)
        assert np.isclose(z[r], math.log(total))


def test_quality_odd(spark):
    df = docs(spark, ODD)
    for model in ({}, {"w": [0.1] * 37, "trans": [[1, 0], [0, 1]]}):
        rows = df.select(quality.score(F.col("text"), model).alias("s"),
                         quality.line_labels(F.col("text"), model).alias("m"), "text").collect()
        assert len(rows) == len(ODD) and all(0 <= r.s <= 1 for r in rows)
        assert all(len(r.m) == len((r.text or "").split("\n")) for r in rows)
    assert quality.train(df, spark.createDataFrame([], "doc_id long, quality int")) == {}


# --- 8: sharding

def test_sharding_law_and_groups(spark):
    rows = [(i, f"text {i if i % 5 else 'shared'} {i // 100 if i % 5 == 0 and i < 400 else ''}")
            for i in range(900)] + [(1000 + i, "hot") for i in range(500)] + ODD[:4]
    out = sharding.shard(docs(spark, rows), shards=8).collect()
    assert len(out) == len(rows)
    counts = collections.Counter(r.shard for r in out)
    assert set(counts) == set(range(8)) and max(counts.values()) - min(counts.values()) <= 1
    for s in counts:
        assert sorted(r.slot for r in out if r.shard == s) == list(range(counts[s]))
    assert collections.Counter((r.doc_id, r.size, r.text_crc32) for r in out) == \
        collections.Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode()))
                            for i, t in rows)
    text = dict((i, t) for i, t in rows if i is not None)
    homes = collections.defaultdict(set)
    for r in out:
        if r.doc_id is not None:
            homes[text[r.doc_id]].add(r.shard)
    assert len(homes["hot"]) <= 5                        # 500 documents, 175 to a shard
    small = [s for t, s in homes.items() if t and t.startswith("text shared")]
    assert sum(len(s) > 1 for s in small) <= 2


def test_sharding_without_room(spark):
    pairs = [(i, f"pair {i // 2}") for i in range(800)]        # 10 whole pairs to a shard
    tight = [(i, f"triple {i // 3}") for i in range(1176)] + [(2000 + i, f"one {i}") for i in range(24)]
    for rows, most in ((pairs, 0), (tight, 39)):
        out = sharding.shard(docs(spark, rows), shards=40).collect()
        counts = collections.Counter(r.shard for r in out)
        assert len(out) == len(rows) and len(counts) == 40
        assert max(counts.values()) - min(counts.values()) <= 1
        homes, text = collections.defaultdict(set), dict(rows)
        for r in out:
            homes[text[r.doc_id]].add(r.shard)
        assert sum(len(s) > 1 for s in homes.values()) <= most


def test_sharding_quotas():
    assert sharding.quotas({(0, 1): 3, (1, 0): 2, (2, 1): 1}, {0: 0, 1: 0, 2: 0}) == {
        (0, 1): 2, (1, 0): 2, (2, 1): 0}
    assert sharding.quotas({(0, 1): 5, (2, 1): 4}, {0: 0, 1: 6, 2: 0}) == {(0, 1): 5, (2, 1): 1}


# --- 9: chat

def test_chat_events(spark):
    log = [("c", 0, 0, "message", "user", "hi"), ("c", 1, 1, "message", "assistant", ""),
           ("c", 2, 1, "delta", None, "he"), ("c", 3, 1, "delta", None, "llo"),
           ("c", 3, 1, "delta", None, "llo"), ("c", 4, 2, "message", "user", "next"),
           ("c", 5, 0, "edit", None, "hi there"), ("c", 6, 1, "regenerate", None, None),
           ("c", 7, 1, "delta", None, "good "), ("c", 8, 1, "delta", None, "day"),
           ("c", 9, 3, "message", "user", "again </turn> \\l"), (None, 0, 0, None, None, None)]
    events = spark.createDataFrame(
        log, "conv_id string, seq long, msg long, kind string, role string, text string")
    told = chat.reconstruct(events)
    turns = {r.conv_id: [(t.role, t.text) for t in r.turns] for r in told.collect()}
    want = [("user", "hi there"), ("assistant", "good day"), ("user", "again </turn> \\l")]
    assert turns == {"c": want, None: [("", "")]}
    back = {r.conv_id: r for r in chat.parse(chat.render(told)).collect()}
    assert [(t.role, t.text) for t in back["c"].turns] == want and back["c"].learnt == "good day"
    assert chat.parse(chat.render(chat.reconstruct(events.limit(0)))).count() == 0


def test_chat_repeated_turns(spark):
    rows = spark.createDataFrame([(1, 0, "user", None), (1, 0, "user", None), (1, 0, None, "<text>"),
                                  (1, None, "assistant", "\\b\\l<\n")],
                                 "conv_id long, turn long, role string, text string")
    r = chat.parse(chat.render(chat.reconstruct(chat.events_from_turns(rows), once=False))).first()
    assert [(t.role, t.text) for t in r.turns] == [
        ("assistant", "\\b\\l<\n"), ("", "<text>"), ("user", ""), ("user", "")]
    assert r.learnt == "\\b\\l<\n"


def test_chat_turns_go_through_the_fold(spark):
    rows = spark.createDataFrame([(1, 0, "user", "a"), (1, 0, "user", "a"), (1, 5000, "user", "c"),
                                  (None, 0, "user", "x"), (None, 3000, None, None)],
                                 "conv_id long, turn long, role string, text string")
    log = chat.events_from_turns(rows)
    edit = spark.createDataFrame([(1, 9, 2, "edit", "", "b"), (1, 10, 3, "delta", "", "!")], log.schema)
    told = {r.conv_id: [(t.role, t.text) for t in r.turns]
            for r in chat.reconstruct(log.unionByName(edit)).collect()}
    assert told == {1: [("user", "a"), ("user", "b"), ("user", "c!")],
                    None: [("user", "x"), ("", "")]}


# --- the pipeline

def test_pipeline_stages(spark, duck, texts):
    import corpus_pipeline as P
    toxic = {i for i, t in texts.items() if re.search(
        "loser|idiot|pathetic|scum|worthless|moron", t.lower())}
    now = spark.read.parquet(f"{SF}/documents.parquet")
    cols, kept = now.columns, []
    for name, stage in P.STAGES[:-1]:
        now = stage(spark, now, SF)
        assert now.columns == cols
        now = P.materialize(now, "test-stage")
        kept.append({r.doc_id: r.text for r in now.collect()})
    assert len(toxic & set(kept[0])) <= 0.3 * len(toxic)
    assert set(kept[1]) == set(kept[0])
    near = simhash.near_duplicates(docs(spark, list(kept[1].items())))
    assert set(kept[2]) == {r.component_id for r in near.collect()}
    items = [x for (x,) in duck.execute("SELECT text FROM benchmark").fetchall()]
    assert not any(x in t for t in kept[3].values() for x in items)
    assert all(kept[3][i] == kept[1][i] for i in kept[3])
    packed = P.STAGES[-1][1](spark, now, SF)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == set(kept[3])


def test_pipeline_odd_rows(spark):
    import corpus_pipeline as P
    now = docs(spark, ODD).select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in P.STAGES:
        now = P.materialize(stage(spark, now, SF), "odd-stage")
    assert now.count() > 0


def test_pipeline_null_and_repeated_ids(spark, duck):
    import corpus_pipeline as P
    rng = np.random.default_rng(5)
    words = ["".join(rng.choice(list("abcdefghij"), 7)) for _ in range(400)]
    clean = [" ".join(rng.choice(words, 60)) for _ in range(6)]
    item = duck.execute("SELECT text FROM benchmark ORDER BY item_id LIMIT 1").fetchone()[0]
    rows = [(None, clean[0]), (None, clean[1]), (None, clean[1]),      # null ids, the last repeated
            (7, clean[2]), (7, clean[3]),                              # different texts of one id
            (3, clean[4]), (9, clean[4]), (9, clean[5]),   # 9 is a copy of 3, and a row of its own
            (None, clean[3]),                                          # a copy without an id
            (None, item), (7, item + " end")]
    cols = ["doc_id", "text", "lang", "source", "n_chars"]
    now = docs(spark, rows).select(*cols)
    near = P.materialize(P.drop_near_duplicates(spark, now, SF), "test-near")
    want = [(None, clean[0]), (None, clean[1]), (7, clean[2]), (7, clean[3]), (3, clean[4]),
            (9, clean[5])]
    told = collections.Counter((r.doc_id, r.text) for r in near.collect() if item not in r.text)
    assert near.columns == cols and told == collections.Counter(want)
    kept = P.drop_leaks(spark, now, SF)
    assert kept.columns == cols
    assert collections.Counter((r.doc_id, r.text) for r in kept.collect()) == collections.Counter(
        (i, t) for i, t in rows if item not in t)
