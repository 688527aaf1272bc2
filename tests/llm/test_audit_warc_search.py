"""Filter audit, archives and lexical search against brute force, and their defined results for odd input."""

from __future__ import annotations

import base64
import collections
import gzip
import hashlib
import itertools
import math
import pathlib
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import filter_audit, lexical_search, warc
from tidemark.llm.oracles import ORACLES
from tidemark.llm.queries import queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOCS = "doc_id LONG, text STRING, source STRING, lang STRING, mask STRING, part STRING, n STRING, digest STRING, score STRING, leaf STRING, salt STRING, terms STRING"


def words(rng, n):
    return ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 3))) for _ in range(n)]


@pytest.fixture(scope="module")
def odd(spark):
    rng = random.Random(8)
    long = " ".join(words(rng, 60_000))
    text = " ".join(words(rng, 250))
    rows = [
        (1, text, "a"), (2, text, "b"), (2, text, "b"), (3, text.upper(), "a"), (4, None, None), (5, "", ""), (6, " \t\n", "a"), (None, text, "a"), (None, None, None),
        (7, long, "b"), (8, "same same same", "c"), (9, "Cost 5$ & more", "c"), (10, "Ünïcode ñandú \U0001f600 ABC", "a"), (11, "a" * 40_000, "c"), (2, "other words", "a"), (7, long, "c"),
    ]
    rows += [(20 + i, " ".join(words(rng, rng.randint(1, 60))), rng.choice("abc")) for i in range(120)]
    return spark.createDataFrame([(i, t, s, *["x"] * 9) for i, t, s in rows], DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def tuples(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("name", ["op11_filter_audit", "op12_warc", "op13_lexical_search"])
def test_query_equals_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "labels", "pages", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    df, rel = queries()[name](spark, sf_dir), con.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(rel.columns)
    columns = sorted(df.columns)
    want = [tuple(r[rel.columns.index(c)] for c in columns) for r in rel.fetchall()]
    assert tuples(df.select(*columns)) == sorted(want, key=repr)


# --- filter audit -------------------------------------------------------------------------------------


def fails(rows):
    least = {}
    for r in rows:
        t = r["text"] or ""
        if r["doc_id"] is not None:
            least[t] = min(least.get(t, r["doc_id"]), r["doc_id"])
    for r in rows:
        t = r["text"] or ""
        w = WORD.findall(t)
        yield {
            "A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), "D": bool(re.search(r"[#$%&*|]", t)),
            "E": r["doc_id"] is not None and r["doc_id"] > least[t],
        }


def audited(rows, labels):
    """Every order run over every document."""
    out = collections.defaultdict(lambda: [0] * 7)
    good = {r["doc_id"] for r in labels if r["quality"] == 1 and r["doc_id"] is not None}
    toxic = {r["doc_id"] for r in labels if r["toxic"] == 1 and r["doc_id"] is not None}
    for r, f in zip(rows, fails(rows), strict=True):
        part = r["source"] or ""
        for order in map("".join, itertools.permutations("ABCDE")):
            alive = True
            for step, x in enumerate(order, 1):
                cell = out[part, order, step]
                removed = alive and f[x]
                cell[0] += alive and not f[x]
                cell[1] += removed
                cell[2] += f[x] and not alive
                cell[3] += f[x] and sum(f.values()) == 1
                cell[4] += removed and r["doc_id"] in good
                cell[5] += removed and r["doc_id"] in toxic
                alive = alive and not f[x]
    for (part, order, step), cell in out.items():
        cell[6] = sum(c[1] for (p, o, s), c in out.items() if p == part and o[s - 1] == order[step - 1])
    return sorted((*k, *map(int, v)) for k, v in out.items())


def test_audit_equals_every_order_run_over_every_document(spark, odd):
    labels = spark.createDataFrame([(i, i % 2, int(i % 3 == 0)) for i in range(1, 60)] + [(None, 1, 1), (3, None, None), (4, 1, None), (4, 0, 1)], "doc_id LONG, quality INT, toxic INT")
    rows = odd.collect()
    want = [w for w in audited(rows, labels.collect()) if w[0] in ("", "c")]
    got = filter_audit.audit_filters(odd, labels)
    assert got.columns == ["part", "filter_order", "step", *filter_audit.COUNTS]
    assert tuples(got.where("part in ('', 'c')")) == want
    parts = {r["source"] or "" for r in rows}
    assert got.count() == 600 * len(parts)
    assert all(r["kept"] + r["removed"] + r["redundant"] == n for r in got.collect() for n in [sum((x["source"] or "") == r["part"] for x in rows)] if r["step"] == 1)


def test_audit_matrices():
    m = filter_audit.outcome_matrices()
    assert all(x.shape == (32, 600) for x in m.values())
    # every document is removed once at most in an order, and at each step kept, removed, or failed or gone before
    assert set(m["removed"].reshape(32, 120, 5).sum(axis=2)[1:].ravel()) == {1} and not m["removed"][0].any()
    assert (m["unique_fails"].sum(axis=0) == 1).all()


def test_audit_of_nothing(spark, odd, none):
    labels = spark.createDataFrame([], "doc_id LONG, quality INT, toxic INT")
    assert filter_audit.audit_filters(none, labels).count() == 0
    assert filter_audit.audit_filters(odd, labels).agg(F.sum("good_lost"), F.sum("toxic_lost")).first()[:] == (0, 0)


# --- archives -----------------------------------------------------------------------------------------

PAGES = "page_id LONG, url STRING, html STRING, payload STRING, n STRING, member STRING, record_id STRING, payload_digest STRING"


@pytest.fixture(scope="module")
def pages(spark):
    big = "<p>" + "wörd " * 30_000
    rows = [
        (1, "http://a/1", "<p>x"), (2, "http://a/2", "<p>x"), (9, "http://a/9", "<p>x"), (9, "http://a/9", "<p>x"), (3, None, None), (4, "http://a/4", ""), (None, "http://a/n", "<p>x"),
        (5, "http://a/5 b\r\nWARC/1.1", "\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n"), (6, "http://ñ/6", big), (7, "http://a/7", big + "!"), (8, "http://a/8", "\0\0binary\0"), (9, "http://b/9", "<p>x"), (None, None, "alone"),
    ]
    return spark.createDataFrame([(*r, *["x"] * 5) for r in rows], PAGES).repartition(3)


def b32(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


@pytest.mark.parametrize("least", [0, 1, 5, 10**6])
def test_archive_pages_equals_brute_force(pages, least):
    rows = [(r["page_id"], (r["html"] or "").encode()) for r in pages.collect()]
    largest = {}
    for i, p in rows:
        if len(p) >= least:
            largest[p] = max(largest.get(p, -1), -1 if i is None else i)
    want, seen = [], set()
    for i, p in rows:
        first = len(p) < least or (largest[p] == (-1 if i is None else i) and p not in seen)
        if len(p) >= least and first:
            seen.add(p)
        original = None if first else largest[p]
        want.append((i, len(p), b32(p), "response" if first else "revisit", None if original == -1 else original))
    got = warc.archive_pages(pages, least)
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert tuples(got) == sorted(want, key=repr)


def test_archives_are_gzip_members_that_others_can_read(pages, tmp_path):
    path = str(tmp_path / "archives")
    warc.write_archives(pages, path, date="2026-01-02T03:04:05Z")
    records = []
    for file in sorted(pathlib.Path(path).glob("part-*")):
        data = file.read_bytes()
        whole = gzip.decompress(data)
        assert whole.count(b"\r\n\r\n") >= data.count(b"\x1f\x8b\x08")
        members = list(warc.inflate(data))
        assert b"".join(members) == whole
        for member in members:
            own = list(warc.parse_records(member))
            assert len(own) == 1
            records += own
    assert len(records) == pages.count()
    ids = {f["warc-record-id"] for f, _ in records}
    assert len(ids) == len(records)
    for fields, block in records:
        assert fields["warc-block-digest"] == "sha1:" + b32(block) and fields["warc-date"] == "2026-01-02T03:04:05Z"
        if fields["warc-type"] == "revisit":
            assert fields["warc-refers-to"] in ids and fields["warc-profile"] == warc.PROFILE and block.endswith(b"\r\n\r\n")
        else:
            assert fields["warc-payload-digest"] == "sha1:" + b32(block.partition(b"\r\n\r\n")[2])
    back = warc.read_archives(pages.sparkSession, path, payload=True).where("record_type = 'response'")
    assert {bytes(r["payload"]) for r in back.collect()} == {(r["html"] or "").encode() for r in pages.collect()}
    assert back.where("page_id = 5").first()["url"] == "http://a/5%20b%0D%0AWARC/1.1"


def test_a_repeated_write_gives_the_same_records(pages, tmp_path):
    contents = []
    for k in "ab":
        warc.write_archives(pages, str(tmp_path / k), date="2026-01-02T03:04:05Z")
        contents.append(sorted(m for f in (tmp_path / k).glob("part-*") for m in warc.inflate(f.read_bytes())))
    assert contents[0] == contents[1]


@pytest.mark.parametrize("size", [0, 1, 1000, warc.MEMBER - 1, warc.MEMBER, warc.MEMBER + 300])
def test_members_end_with_a_zero_and_unpack(size):
    data = bytes(size)
    member = warc.gzip_member(data)
    assert member[-1] == 0 and gzip.decompress(member) == data
    assert b"".join(warc.inflate(member + warc.gzip_member(b"next"))) == data + b"next"


def test_damaged_archives_are_refused():
    record = warc.record_bytes({"record_type": "response", "record_id": "r", "payload": b"abc", "payload_bytes": 3, "payload_digest": b32(b"abc"), "url": None, "page_id": None}, "d")
    with pytest.raises(ValueError, match="cut short"):
        list(warc.inflate(warc.gzip_member(record)[:-9]))
    with pytest.raises(ValueError, match="does not end"):
        list(warc.parse_records(record.replace(b"abc", b"abcd")))
    with pytest.raises(ValueError, match="no record"):
        list(warc.parse_records(b"junk"))


def test_archives_of_nothing(spark):
    empty = spark.createDataFrame([], PAGES)
    assert warc.archive_pages(empty).collect() == []


# --- lexical search -----------------------------------------------------------------------------------


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def ranked(docs, items, top=10):
    own = [(r["doc_id"], collections.Counter(terms(r["text"]))) for r in docs]
    own = [(i, c, sum(c.values())) for i, c in own if c]
    n_docs, length = len(own), sum(n for *_, n in own)
    df = collections.Counter(t for _, c, _ in own for t in c)
    out = []
    for item in items:
        scores = []
        for i, c, n in own:
            m = 100 - 75 + (75 * n * n_docs) // length
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 8 * m)) for t in terms(item["text"]) if t in c)
            if s > 0:
                scores.append((-s, i is None, i))
        out += [(item["item_id"], k, i, -s) for k, (s, _, i) in enumerate(sorted(scores)[:top], 1)]
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def items(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(words(rng, rng.randint(1, 30)))) for i in range(25)] + [(30, None), (31, ""), (32, "--- !!"), (33, "a A a b"), (33, "other words"), (None, "abc ñandú"), (34, "zzz unknown"), (35, "ÜNÏCODE \U0001f600")]
    return spark.createDataFrame([(*r, "x", "y") for r in rows], "item_id INT, text STRING, rank STRING, qid STRING")


@pytest.mark.parametrize("shape", [lexical_search.Shape(), lexical_search.Shape(block=20, cluster=3, sample=60, first=1), lexical_search.Shape(block=16, cluster=4, cluster_postings=50, block_postings=400, levels=2)])
def test_search_equals_brute_force(odd, items, shape):
    got = lexical_search.search(odd, items, shape=shape)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert tuples(got) == ranked(odd.collect(), items.collect())


def test_many_ties_go_by_id(spark):
    docs = spark.createDataFrame([(i, "alpha beta") for i in range(200, 0, -1)] + [(300 + i, "gamma") for i in range(50)], "doc_id LONG, text STRING").repartition(5)
    asked = spark.createDataFrame([(1, "alpha"), (2, "Gamma delta")], "item_id LONG, text STRING")
    got = lexical_search.search(docs, asked, shape=lexical_search.Shape(block=32, cluster=4))
    by_item = {i: [r["doc_id"] for r in sorted(got.collect(), key=lambda r: r["rank"]) if r["item_id"] == i] for i in (1, 2)}
    assert by_item == {1: list(range(1, 11)), 2: list(range(300, 310))}


def test_items_in_several_blocks(odd, items, monkeypatch):
    blocks = list(lexical_search.item_blocks(items, terms=40, items=5))
    assert len(blocks) > 4 and all(len(b.ids) <= 5 for b in blocks)
    whole = lexical_search.item_blocks
    monkeypatch.setattr(lexical_search, "item_blocks", lambda b: whole(b, terms=400, items=20))
    assert tuples(lexical_search.search(odd, items)) == ranked(odd.collect(), items.collect())


def test_search_of_nothing(spark, odd, items, none):
    assert lexical_search.search(none, items).collect() == []
    assert lexical_search.search(odd, items.limit(0)).collect() == []
    blank = odd.withColumn("text", F.lit(" -- "))
    assert lexical_search.search(blank, items).columns == ["item_id", "rank", "doc_id", "score"]
    assert lexical_search.search(blank, items).count() == 0


def test_bisection_brings_like_documents_together():
    rng = np.random.default_rng(1)
    topic = rng.permutation(np.repeat(np.arange(4), 32))
    sketches = [np.unique(rng.integers(0, 40, 20) + 40 * t) for t in topic]
    owner, feature = lexical_search._edges(sketches)
    leaf = lexical_search.bisect_graph(owner, feature, len(topic), 2)
    assert np.bincount(leaf).tolist() == [32] * 4
    assert np.mean([np.bincount(topic[leaf == k]).max() / 32 for k in range(4)]) > 0.9
    # documents that were not fitted go the way of their like
    routes = lexical_search.fit_routes(sketches[::2], 2)
    found = lexical_search.route(sketches, routes)
    assert np.mean([np.bincount(topic[found == k]).max() / max(1, (found == k).sum()) for k in range(4) if (found == k).any()]) > 0.85


def test_bounds_hold(spark, odd):
    """The bound of a cluster is no less than any score in it, and every document with a term is in one cluster."""
    items = list(lexical_search.item_blocks(spark.createDataFrame([(1, "abc def gh"), (2, "a b c")], "item_id LONG, text STRING")))[0]
    index = lexical_search.build_index(odd, items.vocabulary, lexical_search.Scratch(spark, "test"), shape=lexical_search.Shape(block=40, cluster=4))
    asked = lexical_search._Asked(items, index.weights)
    rows = list(index.clusters.toPandas().itertuples(index=False))
    for row in rows:
        bounds = asked.bounds(row.terms, row.highest)
        asked.enter(row)
        for q in range(2):
            assert asked.scores(row, q).max() <= bounds[q]
        asked.leave(row)
    assert sum(len(r.doc_ids) for r in rows) == sum(bool({t for t in terms(r["text"])} & {"abc", "def", "gh", "a", "b", "c"}) for r in odd.collect())
