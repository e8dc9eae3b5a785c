"""Archives, vector and text deduplication against brute force."""

import hashlib
import random
import struct

import duckdb
import numpy as np
import pytest

from sparktab.llm import order_minhash, warc
from sparktab.llm.common import shared_folder
from sparktab.llm.components import connected_components
from sparktab.llm.lattice_dedup import e8_roots, link_vectors, nearest_e8
from sparktab.llm.queries import ORACLES, op1_warc, op2_lattice_dedup


def classes(n, links):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return [find(x) for x in range(n)]


# -- archives ----------------------------------------------------------------------------------
def test_archives_round_trip(spark):
    big = "é\x00<p>\r\n\r\n" * 300
    rows = [(1, "u", big), (2, "a b\n", big), (3, None, big), (3, "again", big), (4, "s", "small"), (5, "s", "small"), (6, "n", None),
            (7, "e", ""), (None, "z", big), (8, "l", "x" * 3_000_000), (9, "b", "y" * 999), (10, "b", "y" * 999), (11, "b", "y" * 1000), (12, "b", "y" * 1000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    path = shared_folder(spark, "t")
    warc.write_archives(warc.with_revisits(pages), path, warc.train_dictionary(pages))
    got = {(r.page_id, r.url): r for r in warc.read_archives(spark, path).collect()}
    assert len(got) == len(rows)
    for (p, _), r in got.items():
        html = next(h for q, _, h in rows if q == p) or ""
        assert r.payload_bytes == len(html.encode()) and r.payload_digest == hashlib.sha1(html.encode()).hexdigest()
        assert r.record_type == "revisit" or bytes(r.payload) == html.encode()
    kinds = {p: (r.record_type, r.refers_to) for (p, _), r in got.items()}
    assert kinds[1] == kinds[2] == kinds[None] == ("revisit", 3) and kinds[3] == ("response", None)
    assert all(kinds[p] == ("response", None) for p in (4, 5, 6, 7, 8, 9, 10, 12)) and kinds[11] == ("revisit", 12)


def test_no_pages_give_no_records(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    path = shared_folder(spark, "t")
    warc.write_archives(warc.with_revisits(pages), path, warc.train_dictionary(pages))
    assert warc.read_archives(spark, path).count() == 0


def archive(record, dictionary=b"", compressed=False):
    import zstandard
    d = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    raw = zstandard.ZstdCompressor().compress(dictionary) if compressed else dictionary
    frame = zstandard.ZstdCompressor(dict_data=d, write_checksum=True).compress(record)
    return struct.pack("<II", warc.DICTIONARY_MAGIC, len(raw)) + raw + frame


def test_compressed_dictionary_and_frames():
    import zstandard
    samples = [f"<html>{i} {'abc ' * (i % 50)} the page number {i * 7}</html>".encode() * 3 for i in range(400)]
    d = zstandard.train_dictionary(4096, samples).as_bytes()
    rec = warc.build_record(7, "http://a/b c", b"<html>" * 5000, None, "2020-01-01T00:00:00Z")
    for compressed in (False, True):
        (at, data), = warc.read_archive(archive(rec, d, compressed))
        assert data == rec and warc.parse_record(data)["payload"] == b"<html>" * 5000


@pytest.mark.parametrize("edit", [
    lambda r: r.replace(b"WARC/1.1", b"WARC/9.9"), lambda r: r.replace(b"WARC-Date", b"WARC-Data"), lambda r: r[:-1], lambda r: r + b"x",
    lambda r: r.replace(b"hello", b"hallo"), lambda r: r + r, lambda r: r.replace(b"Content-Length: 5", b"Content-Length: 6"),
    lambda r: r.replace(b"WARC-Type: response", b"no field here"), lambda r: b""])
def test_broken_records_are_refused(edit):
    with pytest.raises(warc.WarcError):
        warc.parse_record(edit(warc.build_record(1, "u", b"hello", None, "2020-01-01T00:00:00Z")))


def test_broken_archives_are_refused():
    good = archive(warc.build_record(1, "u", b"hello" * 100, None, "2020-01-01T00:00:00Z"))
    flipped = bytearray(good)
    flipped[-10] ^= 255
    for bad in (good[:-3], good + b"xx", good + b"12345678", bytes(flipped), b"abc"):
        with pytest.raises(warc.WarcError):
            for _, data in warc.read_archive(bad):
                warc.parse_record(data)


@pytest.mark.parametrize("name,fn,table", [("op1_warc", op1_warc, "pages"), ("op2_lattice_dedup", op2_lattice_dedup, "embeddings")])
def test_queries_match_sql(spark, smoke_dir, name, fn, table):
    con = duckdb.connect()
    con.execute(f"create view {table} as select * from '{smoke_dir}/{table}.parquet'")
    cur = con.execute(ORACLES[name])
    names = [c[0] for c in cur.description]
    assert sorted(map(str, cur.fetchall())) == sorted(str(tuple(r[n] for n in names)) for r in fn(spark, smoke_dir).collect())


# -- components --------------------------------------------------------------------------------
def test_components_of_chains_stars_and_cliques(spark):
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(40)] + [(50, i) for i in range(51, 80)] + [(rng.randint(100, 140), rng.randint(100, 140)) for _ in range(35)]
    want = classes(150, links)
    got = {r.id: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got[x] == want[x] for l in links for x in l if l[0] != l[1])


def test_components_of_a_shuffled_chain(spark, monkeypatch):
    from sparktab.llm import components
    rounds = []
    write = components.written
    monkeypatch.setattr(components, "written", lambda df, name: rounds.append(name) or write(df, name))
    names = [hashlib.md5(str(i).encode()).hexdigest() for i in range(3000)]
    got = connected_components(spark.createDataFrame(list(zip(names, names[1:])), "a string, b string")).collect()
    assert {r.id for r in got} == set(names) and {r.component for r in got} == {min(names)} and len(rounds) < 40


# -- vectors -----------------------------------------------------------------------------------
def test_nearest_e8_is_the_nearest():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 8))
    c = nearest_e8(x)
    best = ((x[:, None, :] - (c[:, None, :] + np.concatenate([e8_roots(), np.zeros((1, 8))])[None])) ** 2).sum(-1).min(1)
    assert np.allclose(best, ((x - c) ** 2).sum(1))
    assert len(e8_roots()) == 240 and np.allclose((e8_roots() ** 2).sum(1), 2)


def near(rng, u, cos):
    v = rng.normal(size=len(u))
    v -= (v @ u) * u
    return cos * u + np.sqrt(1 - cos * cos) * v / np.linalg.norm(v)


@pytest.mark.parametrize("block", [1024, 16])
def test_vector_links(spark, block):
    rng = np.random.default_rng(1)
    rows = []
    for _ in range(40):
        u = rng.normal(size=32)
        u /= np.linalg.norm(u)
        rows += [u * rng.uniform(0.1, 50)] + [near(rng, u, c) for c in rng.uniform(0.93, 0.999, rng.integers(0, 5))]
    hub = rng.normal(size=32)
    hub /= np.linalg.norm(hub)
    rows += [near(rng, hub, 0.98) for _ in range(60)] + [hub] * 30
    x = np.array([r / np.linalg.norm(r) for r in rows])
    linked = (x @ x.T >= 0.9) & ~np.eye(len(x), dtype=bool)
    want = classes(len(x), np.argwhere(linked).tolist())
    df = spark.createDataFrame([(i, [float(y) for y in r], "c") for i, r in enumerate(rows)], "vec_id long, embedding array<double>, n_links string")
    got = {r.vec_id: r for r in link_vectors(df, block=block).collect()}
    assert sum(r.n_links for r in got.values()) >= 0.99 * linked.sum()
    assert all(r.n_links <= linked[i].sum() for i, r in got.items())
    assert sum(r.component_id == want[i] for i, r in got.items()) >= 0.99 * len(rows)
    assert all(r.kept == (i == r.component_id) for i, r in got.items())


def test_vectors_that_link_with_nothing(spark):
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0]),
            (8, [None, 1.0]), (9, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]), (2, [2.0, 0.0]), (10, [1e300, 1e-300]), (11, [0.0, 1e-310])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(map(tuple, link_vectors(df).collect()), key=str)
    linked = {1: 3, 2: 3, 10: 3}
    want = [(i, linked.get(i, 0), 1 if i in linked else i, i not in linked or i == 1) for i, _ in rows]
    assert got == sorted(want, key=str)
    assert link_vectors(df.limit(0)).count() == 0


# -- texts -------------------------------------------------------------------------------------
def plain_similarity(a, b):
    """Longest common subsequence of the labelled shingles, by the full table."""
    a, b = (order_minhash.labelled_shingles(x.split()).tolist() for x in (a, b))
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1] / (len(a) + len(b) - row[-1])


def edited(rng, words, n):
    w = list(words)
    for _ in range(n):
        i = rng.randrange(len(w))
        w[i:i + 1] = rng.choice([[], ["new"], [w[i], "more"]])
    return w


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    texts = []
    for _ in range(40):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(3, 160))]
        if rng.random() < 0.3:
            base += passage
        texts.append(base)
        for _ in range(rng.randint(0, 3)):
            texts.append(edited(rng, base, rng.randint(0, 5)))
    family = [rng.choice(vocabulary) for _ in range(150)]
    texts += [edited(rng, family, rng.randint(0, 6)) for _ in range(40)]
    return [" ".join(t) for t in texts]


@pytest.mark.parametrize("small,block", [(12, 256), (3, 4)])
def test_near_duplicate_classes(spark, small, block):
    texts = corpus(5)
    links = [(i, j) for i in range(len(texts)) for j in range(i) if texts[i].split() and texts[j].split()
             and plain_similarity(texts[i], texts[j]) >= 0.8]
    want = classes(len(texts), links)
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, class_id string").repartition(5)
    got = {r.doc_id: r for r in order_minhash.near_duplicates(df, small=small, block=block).collect()}
    assert sum(got[i].class_id == want[i] for i in range(len(texts))) >= 0.98 * len(texts)
    assert all(want[got[i].class_id] == want[i] for i in range(len(texts)))      # no link that brute force lacks
    assert all(r.kept == (i == r.class_id) for i, r in got.items())


def test_alignment_is_the_longest_common_subsequence():
    rng = random.Random(8)
    for _ in range(150):
        base = [f"w{rng.randint(0, 40)}" for _ in range(rng.randint(1, 80))]
        a, b = " ".join(base), " ".join(edited(rng, base, rng.randint(0, 4)) or ["z"])
        s = plain_similarity(a, b)
        x, y = (order_minhash.labelled_shingles(t.split()) for t in (a, b))
        got = order_minhash.aligned(x, y, 0.8)
        assert got == pytest.approx(s) if s >= 0.8 else got == 0


def test_order_matters_to_the_alignment():
    a = " ".join(f"a{i}" for i in range(100)), " ".join(f"b{i}" for i in range(100))
    x, y = (order_minhash.labelled_shingles(t.split()) for t in (f"{a[0]} {a[1]}", f"{a[1]} {a[0]}"))
    assert order_minhash.aligned(x, x, 0.8) == 1 and order_minhash.aligned(x, y, 0.8) == 0


def test_text_edge_cases(spark):
    rows = [(5, "same words here"), (3, " same  words\nhere "), (7, ""), (8, None), (9, " \n"), (None, "same words here"), (5, "same words here"), (11, "z " * 30000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted({tuple(r)[:3] for r in order_minhash.near_duplicates(df).collect()}, key=str)
    want = [(3, 3, True), (5, 3, False), (7, 7, True), (8, 8, True), (9, 9, True), (11, 11, True), (None, None, True)]
    assert got == sorted(want, key=str)
    assert order_minhash.near_duplicates(df.limit(0)).count() == 0
    kept = order_minhash.keep_one(spark.createDataFrame(rows + [(3, " same  words\nhere ")], "doc_id long, text string"))
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(map(str, [3, 7, 8, 9, None, 11]))
