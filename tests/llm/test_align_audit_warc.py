"""Token alignment, filter audit and archive conversion against brute force,
and their defined results for odd rows and clashing columns."""

import base64
import collections
import gzip
import hashlib
import itertools
import random
import re
from functools import reduce

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as E
from stategrid.llm import align, audit, queries, warc
from stategrid.llm.common import scratch

SF = "/root/testdata/sf0.001"
BPE, PIECES = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
DOC = ("doc_id long, text string, source string, n_a long, _row string, t1 string, k1 string, "
       "pairs string, part string, code int, good int, _id string, words string, n string")


def docs(spark, rows):
    """rows (doc_id, text[, source]) with extra columns named like inner ones."""
    return spark.createDataFrame([(r[0], r[1], r[2] if len(r) > 2 else None, 1, "r", "t", "k", "p",
                                   "q", 3, 1, "i", "w", "n") for r in rows], DOC)


ODD = [(1, None), (2, ""), (None, "some words here"), (None, None), (None, "some words here"),
       (5, "word " * 3000), (6, "a" * 9000), (7, "same text\nof two rows"), (7, "same text\nof two rows"),
       (8, "\n\n\n"), (9, "é<|endoftext|> </s> <0x41> \x01 \\b"), (10, "  lead and  trail "),
       (11, "x ▁ y"), (12, "日本語の文章 と 中文" * 40), (13, " "), (14, "a b c d\x1f e"),
       (15, "don't we'll ٣٤ x²y 12345 ... --- !?"), (16, "퟿ ́x ​ y")]


# --- 11: alignment

def brute_alignment(rows):
    a, b = align.Aligner(BPE, PIECES), align.Aligner(BPE, PIECES)
    per, total = [], collections.Counter()
    for i, t in rows:
        ia, ea, ib, eb, ok = next(a.tokens([t])) if t else ([], [], [], [], False)
        if not ok:
            per.append((i, 0, 0, "", []))
            continue
        text, linked, x, y = [], [], 0, 0
        for end in sorted(set(ea) & set(eb)):
            nx, ny = x, y
            while nx < len(ea) and ea[nx] <= end:
                nx += 1
            while ny < len(eb) and eb[ny] <= end:
                ny += 1
            text.append(",".join(map(str, ia[x:nx])) + "|" + ",".join(map(str, ib[y:ny])))
            x, y = nx, ny
        linked = [(p, q) for p, e in zip(ia, ea) for q, f in zip(ib, eb) if e == f] if len(ia) < 400 \
            else [(ia[ea.index(e)], ib[eb.index(e)]) for e in sorted(set(ea) & set(eb))]
        total.update(linked)
        per.append((i, len(ia), len(ib), ";".join(text), linked))
    best = collections.defaultdict(int)
    for (_, q), n in total.items():
        best[q] = max(best[q], n)
    return collections.Counter((i, na, nb, g, len(ls), sum(total[p] == best[p[1]] for p in ls),
                                sum(total[p] for p in ls)) for i, na, nb, g, ls in per)


@pytest.mark.parametrize("chunk,fan,limit", [(align.CHUNK, align.FAN, 1000_000), (64, 2, 0)])
def test_alignment_brute_force(spark, chunk, fan, limit):
    texts = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(25).collect()
    rows = ODD + [(1000 + r[0], r[1][:6000]) for r in texts]
    rows += [(5000 + i, "one long text of copies, cut anywhere; " * 6) for i in range(30)]
    got = align.score(align.align(docs(spark, rows), BPE, PIECES, chunk, fan), limit)
    assert collections.Counter(
        (r.doc_id, r.n_a, r.n_b, r.groups, r.n_links, r.n_best, r.count_sum)
        for r in got.collect()) == brute_alignment(rows)


def test_alignment_empty(spark):
    got = align.score(align.align(docs(spark, ODD).limit(0), BPE, PIECES))
    assert got.count() == 0 and dict(got.dtypes)["count_sum"] == "bigint"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 4), st.integers(1, 4)), min_size=1, max_size=12), st.data())
def test_fragments_are_a_monoid(sizes, data):
    """Any cuts, composed in any nesting, give the fragment of the whole."""
    a_ends = np.cumsum([s for s, _ in sizes]).tolist()
    b_ends = [e for e in np.cumsum([s for _, s in sizes]).tolist() if e < a_ends[-1]] + a_ends[-1:]
    a, b = list(range(len(a_ends))), list(range(100, 100 + len(b_ends)))
    cuts = sorted(data.draw(st.lists(st.integers(0, a_ends[-1]), max_size=5)))
    parts = [align.of_tokens(*align._within(a, a_ends, lo, hi), *align._within(b, b_ends, lo, hi))
             for lo, hi in zip([0, *cuts], [*cuts, a_ends[-1]])]
    while len(parts) > 1:
        i = data.draw(st.integers(0, len(parts) - 2))
        parts[i:i + 2] = [align.compose(parts[i], parts[i + 1])]
    assert parts[0] == align.of_tokens(a, a_ends, b, b_ends)
    assert align.compose(align.Fragment(), parts[0]) == align.compose(parts[0], align.Fragment()) \
        == parts[0]


def test_chunks_cut_inside_tokens_and_spare_long_units():
    own = align.Aligner(BPE, PIECES)
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdeghiklmnorstuvé") for _ in range(30))
    text = " ".join(word() for _ in range(40)) + " " + "x" * 9000 + " and the rest of it all"
    want, open_ends = align.groups(align.of_tokens(*next(own.tokens([text])))), 0
    for size in (3, 7, 20, 100):
        cuts = list(own.chunks(text, size))
        assert any(lo for _, lo, _, _ in cuts) and [c[0] for c in cuts] == list(range(len(cuts)))
        assert sum("x" * 9000 in piece for *_, piece in cuts) == 1
        frags, *_ = own.read([(p, lo, hi) for _, lo, hi, p in cuts])
        assert align.groups(reduce(align.compose, frags)) == want
        open_ends += sum(bool(f.tail_a or f.tail_b) for f in frags)
    assert open_ends > 10


def test_units_together_and_one_by_one():
    own = align.Aligner(BPE, PIECES)
    units = "some units, don't they; ١٢ ﬁ <s> 日本 a\tb it's".split(" ")
    one, other = own._joined(units), own._each(units)
    assert one.whole == other.whole and one.links.tolist() == other.links.tolist()
    assert one.sums.tolist() == other.sums.tolist()
    assert own._joined(["x", "a▁b"]) is None            # its bytes do not come back
    assert own._each(["x", "a▁b"]).sums[:, 0].tolist() == [0, 1]


# --- 12: filter audit

def brute_audit(rows, labels, min_words):
    def fails(i, t):
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        return "".join(f for f, x in zip("ABCDE", (
            len(words) < min_words, 100 * len(set(words)) < 50 * len(words),
            100 * len(re.findall("[A-Z]", t)) > 2 * len(t), bool(re.search(r"[#$%&*|]", t)),
            i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in rows)))
            if x)
    good = {i for i, q, _ in labels if q == 1} - {None}
    toxic = {i for i, _, x in labels if x == 1} - {None}
    out, shapley = {}, collections.Counter()
    marked = [(s or "", i, fails(i, t or "")) for i, t, s in rows]
    parts = sorted({s for s, *_ in marked})
    for order in map("".join, itertools.permutations("ABCDE")):
        for part in parts:
            left = [(i, f) for s, i, f in marked if s == part]
            everything = left
            for step, own in enumerate(order, 1):
                lost = [(i, f) for i, f in left if own in f]
                left = [(i, f) for i, f in left if own not in f]
                shapley[part, own] += len(lost)
                out[part, order, step] = (
                    len(left), len(lost), sum(own in f for _, f in everything) - len(lost),
                    sum(f == own for _, f in everything), sum(i in good for i, _ in lost),
                    sum(i in toxic for i, _ in lost))
    return {(p, o, s): (*v, shapley[p, o[s - 1]]) for (p, o, s), v in out.items()}


def test_audit_brute_force(spark):
    rng = random.Random(4)
    pool = ["", "a b c d", "a a a a", "AB c d e", "x # y z", "A A A | A", "word " * 12, "é É $"]
    rows = [(rng.choice([None, *range(40)]), rng.choice([None, *pool]),
             rng.choice([None, "", "web", "code"])) for _ in range(300)]
    labels = [(rng.choice([None, *range(40)]), rng.choice([None, 0, 1]), rng.choice([None, 0, 1]))
              for _ in range(60)]
    marks = spark.createDataFrame([(*r, 1, "x") for r in labels],
                                  "doc_id long, quality int, toxic int, good int, _salt string")
    got = audit.audit(docs(spark, rows), marks, min_words=4).collect()
    assert {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in got} == \
        brute_audit(rows, labels, 4)
    assert len(got) == 3 * 600                          # null and '' are one part
    assert audit.audit(docs(spark, rows), marks.limit(0)).count() == 3 * 600
    assert audit.audit(docs(spark, rows).limit(0), marks).count() == 0


def test_audit_odd_rows(spark):
    rows = [(i, t, "s") for i, t in ODD]
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = audit.audit(docs(spark, rows), marks).collect()
    assert {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in got} == brute_audit(rows, [], 200)


def test_contraction_counts_every_outcome():
    rng = np.random.default_rng(2)
    t = rng.integers(0, 50, (3, 2, 2, 2, 2, 2))
    m = audit.contract(t, ["CABDE"])
    assert m["kept"][-1] == t[0, 0, 0, 0, 0, 0]
    assert m["removed"][0] == t[0, :, :, 1].sum() and m["good_lost"][1] == t[1, 1, :, 0].sum()
    assert m["kept"][0] == t[0].sum() - m["removed"].sum() + m["removed"][1:].sum()


# --- 13: archives

def legacy(head: bytes, block: bytes, cut: int = 0) -> bytes:
    return head + b" %d\n" % len(block) + block[:len(block) - cut]


V1 = (legacy(b"filedesc://old.arc 1.2.3.4 19970101 text/plain",
             b"1 0 Crawler\nURL IP-address Archive-date Content-type Archive-length\n\n")
      + b"\n" + legacy(b"http://a.example/x y 1.2.3.4 19970102030405 text/html",
                       b"HTTP/1.0 200 OK\r\nA: b\r\n\r\nab\xff\xfe\r\n\r\n")
      + b"\nthis is no header\n"
      + b"\n" + legacy(b"dns:a.example 1.2.3.4 199701020304 text/dns", b"abc")
      + b"\n" + legacy(b"http://a.example/z 1.2.3.4 19979902030405 text/html",
                       b"HTTP/1.0 200 OK\r\n\r\ncut short", 6))
V2 = (legacy(b"filedesc://new.arc 0.0.0.0 19990909 text/plain 200 - - 0 new.arc",
             b"2 0 Crawler\nURL IP-address Archive-date Content-type Result-code Checksum Location "
             b"Offset Filename Archive-length\n")
      + b"\n" + legacy(b"http://b.example/ 5.6.7.8 19990909101112 text/html 200 sum - 200 new.arc",
                       b"HTTP/1.0 200 OK\r\n\r\nsame")
      + b"\n" + legacy(b"http://b.example/2 5.6.7.8 19990909101113 text/html 200 sum - 300 new.arc",
                       b"HTTP/1.0 200 OK\r\n\r\nsame") + b"\n")


def test_legacy_versions(spark, tmp_path):
    (tmp_path / "a.arc").write_bytes(V1)
    (tmp_path / "b.arc.gz").write_bytes(gzip.compress(V2[:150]) + gzip.compress(V2[150:]))
    (tmp_path / "c.arc").write_bytes(b"not an archive at all\n")
    got = warc.read_arc(spark, [str(tmp_path)]).collect()
    by = {r.uri: r for r in got if r.type != "problem"}
    page = by["http://a.example/x y"]
    assert (page.type, page.date, page.payload_bytes, page.truncated) == (
        "response", "1997-01-02T03:04:05Z", 8, False)
    assert bytes(page.block).endswith(b"ab\xff\xfe\r\n\r\n")
    assert page.payload_digest == base64.b32encode(hashlib.sha1(b"ab\xff\xfe\r\n\r\n").digest()).decode()
    assert by["filedesc://old.arc"].type == "warcinfo"
    assert (by["dns:a.example"].type, by["dns:a.example"].date) == ("resource", "1997-01-02T03:04:00Z")
    assert by["http://a.example/z"].truncated
    assert by["http://a.example/z"].date == "1970-01-01T00:00:00Z"
    assert by["http://b.example/2"].payload_digest == by["http://b.example/"].payload_digest
    assert by["http://b.example/2"].date == "1999-09-09T10:11:13Z"
    assert sorted(r.payload_bytes for r in got if r.type == "problem") == [
        len(b"this is no header\n\n"), len(b"not an archive at all\n")]
    assert len({r.record_id for r in got if r.record_id}) == len(by) == 7
    # a rerun synthesises the same identifiers, and WARC files give the records back
    out = scratch(spark, "test-warc")
    warc.convert(spark, [str(tmp_path)], out)
    back = {r.record_id: r for r in warc.read_warc(spark, out).collect()}
    assert set(back) == {r.record_id for r in by.values()}
    assert all(r.intact for r in back.values())
    assert collections.Counter(r.type for r in back.values()) == {
        "warcinfo": 2, "resource": 1, "response": 3, "revisit": 1}


def test_pages_round_trip(spark):
    rows = [(1, "http://x/ a\nb", "<p>one</p>"), (2, None, "<p>one</p>"), (3, "", None), (4, "u", ""),
            (None, "v", "<p>one</p>"), (5, "w", "é\r\n\r\n\nWARC/1.0\r\n" * 5), (2, "again", "<p>one</p>"),
            (6, "big", "y" * 3_000_000), (7, "http://odd", "é" * 10), (0, "z", "no\x00t \x1f")]
    pages = spark.createDataFrame([(*r, 1, "x", "y") for r in rows],
                                  "page_id long, url string, html string, payload_bytes long, "
                                  "record_id string, value string")

    def through(pages, min_bytes):
        arcs, out = [], scratch(spark, "test-warc")
        for v in ("1", "2"):
            arcs.append(scratch(spark, "test-arc"))
            warc.write_archives(warc.arc_rows(pages, v), arcs[-1], warc.ARC_END) \
                if v == "1" else warc.write_archives(warc.arc_rows(pages.limit(0), v), arcs[-1], "\n")
        warc.convert(spark, arcs, out, min_bytes)
        records = warc.read_warc(spark, out)
        assert records.where("NOT intact").count() == 0
        return collections.Counter(map(tuple, warc.resolve(records).collect()))

    for least in (0, 11):
        want = collections.Counter()
        for i, _, h in rows:
            body = (h or "").encode()
            want[i, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(),
                 "response", None] += 1
        for first, i, n in [(3, 4, 1), (1, 2, 2), (1, None, 1)] if least == 0 else []:
            key = next(k[:3] for k in want if k[0] == i)
            want[*key, "response", None] -= n
            want[*key, "revisit", first] += n
        assert through(pages, least) == +want
    assert through(pages.limit(0), 0) == {}


def test_op13_reads_both_versions(spark):
    got = E.queries()["op13_warc"](spark, SF)
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    assert got.count() == pages.count()
    assert set(got.columns) == {"page_id", "payload_bytes", "payload_digest", "record_type",
                                "refers_to"}


def test_op11_covers_every_document(spark):
    got = E.queries()["op11_alignment"](spark, SF)
    rows = got.collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all((r.n_a == 0) == (r.groups_sha256 == "") for r in rows)
    assert sum(r.n_links for r in rows) >= sum(r.n_groups for r in rows) > 0
    assert queries.op11_alignment.__name__ in queries.QUERIES
