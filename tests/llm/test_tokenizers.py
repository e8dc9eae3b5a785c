"""Token operators against the public libraries they must agree with."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import Row

from sparktab.llm import packing, token_counts
from sparktab.llm.byte_bpe import byte_bpe, encode_decode
from sparktab.llm.packing import capacities, pack_documents, pack_shard
from sparktab.llm.token_counts import Transducer, count_tokens
from sparktab.llm.wordbpe import load_tokenizer, word_ids

WORD_FILE = public_tokenizers.path("word_bpe_49k.json")
RANK_FILE = public_tokenizers.path("byte_bpe_50k.tiktoken")

PIECES = list("abrvlestmd'''  \n\t!.5७9éÉ²ªßİΣσςÀ́  \x1c\x85’“—日本あ한각ᄀ가‍😀Ǆŉ½Ⅷ") + [
    "<|endoftext|>", "<|startoftext|>", "'re", "'ll", "'ve", "a" * 300, "!" * 40, "<|", "|>", "the ", "   ", "\r\n", "  "]


def random_texts(n, seed, longest=60):
    rng = random.Random(seed)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, longest))) for _ in range(n)]


@pytest.fixture(scope="module")
def texts(spark):
    docs = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    return docs + random_texts(400, 1) + ["", "x" * 5000, "word " * 3000, "'" * 9, "it's they'll 're 'r 'v 'l '"]


@pytest.fixture(scope="module")
def library():
    return load_tokenizer(WORD_FILE)


def docs_frame(spark, texts):
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(None, "null id", "x"), (10 ** 9, None, None), (0, texts[0], "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string").repartition(3)


def test_transducer_agrees_with_the_library(texts, library):
    t = Transducer(WORD_FILE)
    assert t.counts_of(texts) == [len(library.encode(x, add_special_tokens=False).ids) for x in texts]


@pytest.mark.parametrize("chunk", [1, 2, 7, 64, 100000])
def test_chunk_maps_compose_for_any_cut(texts, chunk):
    t = Transducer(WORD_FILE)
    s = np.concatenate([t.symbols(x) for x in texts[-30:-5]])
    assert (t.emissions(s, chunk) == t.emissions(s, len(s))).all()


def test_transducer_is_compiled_anew_at_its_bound(monkeypatch, texts, library):
    monkeypatch.setattr(token_counts, "MAX_STATES", 50)
    t = Transducer(WORD_FILE)
    for x in texts[:40]:
        assert t.counts_of([x]) == [len(library.encode(x, add_special_tokens=False).ids)]


def test_count_query(spark, texts, library):
    df = docs_frame(spark, texts)
    got = sorted(map(tuple, count_tokens(df, WORD_FILE, limit=20).collect()), key=str)
    want = []
    for r in df.collect():
        n = len(library.encode(r.text or "", add_special_tokens=False).ids)
        want.append((r.doc_id, len((r.text or "").encode()), n, n > 20))
    assert got == sorted(want, key=str)
    assert count_tokens(df.limit(0), WORD_FILE).count() == 0


def test_word_ids_agree_with_the_library(texts, library):
    enc = word_ids(WORD_FILE)
    for x in texts:
        assert np.frombuffer(enc.encode(x), "<u4").tolist() == library.encode(x, add_special_tokens=False).ids


def reference_encoding():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANK_FILE, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_bpe_round_trip(spark, texts):
    e = reference_encoding()
    more = texts + ["a \n b", "a  \nb", "a\n  b", "x  ", "x ", " ", "  ", "a \n \n b", " lead", "a   b", "\n \nq"]
    bpe = byte_bpe(RANK_FILE, public_tokenizers.PATTERN)
    for x, ids in zip(more, bpe.encode(more)):
        assert np.frombuffer(ids, "<u4").tolist() == e.encode_ordinary(x), repr(x[:80])
    df = docs_frame(spark, more)
    for r in encode_decode(df, RANK_FILE, public_tokenizers.PATTERN).join(df.select("doc_id", "text").distinct(), "doc_id").collect():
        want = e.encode_ordinary(r.text or "")
        assert r.n_tokens == len(want)
        assert bytes(r.ids) == np.array(want, "<u4").tobytes()
        assert r.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
    assert encode_decode(df.limit(0), RANK_FILE, public_tokenizers.PATTERN).count() == 0


def test_byte_bpe_of_long_words():
    from sparktab.llm import byte_bpe as module
    rng = random.Random(12)
    letters = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n)) for n in [1000] * 400 + [20000]]
    words = letters + ["x" * 20000, "!" * 9000, "日本語" * 2500]
    b, e = module.ByteBpe(RANK_FILE, public_tokenizers.PATTERN), reference_encoding()
    for x, ids in zip(words, b.encode(words)):
        assert np.frombuffer(ids, "<u4").tolist() == e.encode_ordinary(x)


def test_byte_bpe_starts_anew(monkeypatch, texts):
    from sparktab.llm import byte_bpe as module
    monkeypatch.setattr(module, "ROUND_ROWS", 1)
    b, e = module.ByteBpe(RANK_FILE, public_tokenizers.PATTERN), reference_encoding()
    for x, ids in zip(texts[:40], b.encode(texts[:40])):
        assert np.frombuffer(ids, "<u4").tolist() == e.encode_ordinary(x)


def test_byte_bpe_cache_bound(monkeypatch, texts):
    from sparktab.llm import byte_bpe as module
    monkeypatch.setattr(module, "CACHE_WORDS", 20)
    b, e = module.ByteBpe(RANK_FILE, public_tokenizers.PATTERN), reference_encoding()
    for lo in range(0, 60, 10):
        for x, ids in zip(texts[lo:lo + 10], b.encode(texts[lo:lo + 10])):
            assert np.frombuffer(ids, "<u4").tolist() == e.encode_ordinary(x)


def test_capacities_hold_every_token_without_padding():
    for total in (0, 1, 4095, 4096, 4097, 12345):
        c = capacities(total, 4096)
        assert sum(c) == total and all(x == 4096 or x & (x - 1) == 0 for x in c)


@pytest.mark.parametrize("lengths", [[], [1], [5000], [4096, 4096], [3, 3, 3, 10000, 1, 700] * 9, list(range(1, 400))])
def test_pack_shard_places_each_token_once(lengths):
    seen, fill = {}, {}
    for d, start, n, s, off in pack_shard(lengths, 4096, 1.0, 1 / 4096):
        assert off == fill.get(s, 0) and n > 0
        fill[s] = off + n
        seen.setdefault(d, []).append((start, n))
    assert sorted(fill.values(), reverse=True) == sorted(capacities(sum(lengths), 4096), reverse=True)
    for d, n in enumerate(lengths):
        at = 0
        for start, m in sorted(seen.get(d, [])):
            assert start == at
            at += m
        assert at == n


def test_pack_is_descending_into_the_cheapest_sequence_with_room():
    # 3000 and 2500 open two sequences; 1500 fits only the second, 1096 fills the first
    pieces = pack_shard([1500, 3000, 1096, 2500, 96], 4096, 1.0, 1 / 4096)
    assert [(p[0], p[3]) for p in pieces[:3]] == [(1, 0), (3, 1), (0, 1)]


def test_pack_query(spark, texts, library):
    df = docs_frame(spark, texts).filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    rows = pack_documents(df, WORD_FILE, shard_tokens=3000).collect()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    for d in df.collect():
        want = library.encode(d.text or "", add_special_tokens=False).ids + [2]
        got = b"".join(bytes(r.ids) for r in sorted(by[d.doc_id], key=lambda r: r.start))
        assert got == np.array(want, "<u4").tobytes()
        assert {r.doc_tokens for r in by[d.doc_id]} == {len(want)}
    seqs = {}
    for r in rows:
        seqs.setdefault(r.sequence_id, []).append(r)
    for s in seqs.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == s[0].sequence_tokens <= 4096
        assert at & (at - 1) == 0      # full, or a power of two: no padding
    assert pack_documents(df.limit(0), WORD_FILE).count() == 0
    # rows that repeat are documents of their own
    again = pack_documents(spark.createDataFrame([Row(doc_id=1, text="same text")] * 3), WORD_FILE).collect()
    assert sum(r.length for r in again) == 3 * again[0].doc_tokens


def test_query_digests(spark, smoke_dir, library):
    from sparktab.llm.queries import op4_packing
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{smoke_dir}/documents.parquet").collect()}
    for r in op4_packing(spark, smoke_dir).collect():
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids + [2]
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start:r.start + r.length], "<u4").tobytes())
        assert r.doc_tokens == len(ids)


def test_packing_rejects_a_capacity_that_is_no_power_of_two(spark):
    with pytest.raises(ValueError):
        packing.pack_documents(spark.createDataFrame([Row(doc_id=1, text="a")]), WORD_FILE, capacity=1000)
