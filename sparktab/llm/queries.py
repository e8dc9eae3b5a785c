"""The registered queries of this subpackage: each operator over its whole table, with production
parameters, reduced to the columns of its contract; and DuckDB twins where SQL can express one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparktab.llm import (best_fit, byte_bpe, collocations, lattice_dedup, order_minhash, packing, pii, quality_fm, rules,
                          secrets, spelling, token_counts, warc)
from sparktab.llm.common import shared_folder

PSEUDONYM_KEY = b"example key; a deployment passes its own"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    """Place of a public tokenizer file; the package is installed on driver and executors alike."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    path = shared_folder(spark, "warc")
    warc.write_archives(warc.with_revisits(pages), path, warc.train_dictionary(pages))
    return warc.read_archives(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_lattice_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_dedup.link_vectors(_table(spark, sf_dir, "embeddings"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    out = byte_bpe.encode_decode(_table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), "decoded_sha256")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = packing.pack_documents(_table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op5_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_fm.score(docs, quality_fm.train(docs, _table(spark, sf_dir, "labels")))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.scan(docs, secrets.labelled_samples(docs))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")

    def count(kind):
        return F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", count("assign"), count("access"), count("hex"),
                        F.sha2(joined(F.filter("found", lambda x: x["kind"] != "random")), 256).alias("base_sha256"),
                        joined("found").alias("spans"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op8_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op9_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.pseudonymize(_table(spark, sf_dir, "documents"), PSEUDONYM_KEY)
    spans = F.array_join(F.transform("found", lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    return out.withColumn("spans", spans).drop("found")


def op10_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    order = [name for name, _, _ in rules.estimate(docs)]
    return rules.judge(docs, order).drop("rejected_by")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op12_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit.best_fit(_table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), with_ids=False).drop("ids")


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_warc, op2_lattice_dedup, op3_byte_bpe, op4_packing, op5_quality_fm, op6_secrets, op7_token_counts,
    op8_order_minhash, op9_pseudonyms, op10_rules, op11_collocations, op12_best_fit, op13_spelling)}

ORACLES: dict[str, str] = {
    "op1_warc": """
        WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
        d AS (SELECT page_id, octet_length(b) AS payload_bytes, sha1(b) AS payload_digest FROM p),
        r AS (SELECT *, CASE WHEN payload_bytes >= 1000
                             THEN max(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS response FROM d)
        SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
               CASE WHEN response = page_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN response = page_id THEN NULL ELSE response END AS refers_to
        FROM r""",
    "op2_lattice_dedup": """
        WITH RECURSIVE v AS (
            SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
            WHERE embedding IS NOT NULL AND len(embedding) > 0
              AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
              AND len([x for x in embedding if x <> 0]) > 0),
        l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
              WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
        reach AS (SELECT vec_id AS id, vec_id AS c FROM embeddings
                  UNION SELECT l.a, reach.c FROM reach JOIN l ON l.b = reach.id),
        comp AS (SELECT id, min(c) AS component_id FROM reach GROUP BY id),
        deg AS (SELECT a, count(*) AS n FROM l GROUP BY a)
        SELECT e.vec_id, coalesce(deg.n, 0)::BIGINT AS n_links, comp.component_id, e.vec_id = comp.component_id AS kept
        FROM embeddings e JOIN comp ON comp.id = e.vec_id LEFT JOIN deg ON deg.a = e.vec_id""",
    "op10_rules": r"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        g AS (SELECT doc_id, i, array_to_string(w[i:i+4], ' ') AS x
              FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 3))) AS i FROM d)),
        again AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, x) AS n FROM g) WHERE n > 1),
        covered AS (SELECT doc_id, count(*) AS n FROM
                    (SELECT DISTINCT doc_id, unnest(range(i, i + 5)) AS p FROM again) GROUP BY doc_id),
        f AS (SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum([length(x) for x in w]), 0)::BIGINT AS word_chars,
                     length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
                     length(regexp_replace(t, '[^!]', '', 'g')) AS bangs,
                     [x for x in string_split(t, chr(10)) if regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines FROM d),
        s AS (SELECT f.doc_id, n_words, word_chars, n_symbols, bangs, len(lines) AS n_lines,
                     (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words
              FROM f LEFT JOIN covered ON covered.doc_id = f.doc_id),
        b AS (SELECT *, (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed FROM s)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               NOT (base_failed OR 10 * n_symbols > n_words OR 2 * n_dup_lines > n_lines OR 10 * bangs > n_words
                    OR word_chars > 15 * n_words OR word_chars < 2 * n_words) AS kept
        FROM b""",
    "op11_collocations": r"""
        WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                          'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
        w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
        g AS (SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase, w[i:i + m - 1] AS ws
              FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w), (SELECT unnest([1, 2, 3]) AS m) WHERE i + m - 1 <= len(w)),
        f AS (SELECT lang, m, phrase, any_value(ws) AS ws, count(*)::BIGINT AS f FROM g GROUP BY lang, m, phrase),
        n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE m = 1 GROUP BY lang),
        c AS (SELECT * FROM f WHERE m > 1 AND f >= 10),
        cuts AS (SELECT c.lang, c.phrase, c.m, c.ws, c.f AS a, k, l.f AS l, r.f AS r,
                        (1000000::HUGEINT * c.f * c.f) // (l.f::HUGEINT * r.f) AS score
                 FROM (SELECT *, unnest(range(1, m)) AS k FROM c) c
                 JOIN f l ON l.lang = c.lang AND l.m = k AND l.phrase = array_to_string(c.ws[1:k], ' ')
                 JOIN f r ON r.lang = c.lang AND r.m = c.m - k AND r.phrase = array_to_string(c.ws[k + 1:], ' ')),
        s AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, m, phrase ORDER BY score, k) = 1),
        inside AS (SELECT lang, part, max(f) AS longer FROM
                   (SELECT lang, f, unnest([array_to_string(ws[1:2], ' '), array_to_string(ws[2:3], ' ')]) AS part FROM c WHERE m = 3)
                   GROUP BY lang, part),
        kept AS (SELECT s.* FROM s LEFT JOIN inside i ON s.m = 2 AND i.lang = s.lang AND i.part = s.phrase
                 WHERE i.longer IS NULL OR 100 * i.longer < 50 * s.a),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
        SELECT lang, rank::BIGINT AS rank, phrase, a, l, r, n, score::BIGINT AS score
        FROM ranked JOIN n USING (lang) WHERE rank <= 2000""",
    "op13_spelling": r"""
        WITH RECURSIVE steps AS (SELECT i, 0 AS s, i::BIGINT AS c FROM range(256) r(i)
            UNION ALL SELECT i, s + 1, xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END) FROM steps WHERE s < 8),
        t AS (SELECT list(c ORDER BY i) AS crc FROM steps WHERE s = 8),
        runs AS (SELECT doc_id, run, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(
                     translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS run FROM documents) GROUP BY ALL),
        x AS (SELECT run, n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS x FROM runs WHERE length(run) >= 6),
        h AS (SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, [('0x' || x[2 * i - 1:2 * i])::BIGINT for i in range(1, 1 + length(x) // 2)]),
                     lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1]))) AS h FROM x, t),
        words AS (SELECT word, sum(n)::BIGINT AS n FROM (
                      SELECT n, CASE WHEN h % 199 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word FROM h)
                  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
        cut AS (SELECT word, n, i, word[:i] || '?' || word[i + 2:] AS hole, word[:i] || word[i + 2:] AS short
                FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
        pairs AS (SELECT a.word, b.word AS near, b.n AS near_n FROM cut a JOIN cut b ON a.hole = b.hole AND a.word <> b.word
                  UNION SELECT c.word, w.word, w.n FROM cut c JOIN words w ON w.word = c.short
                  UNION SELECT w.word, c.word, c.n FROM cut c JOIN words w ON w.word = c.short),
        best AS (SELECT word, count(*)::BIGINT AS n_near, max(near_n) AS most FROM pairs GROUP BY word),
        form AS (SELECT w.word, min(p.near) AS form, max(p.near_n) AS form_n FROM words w JOIN best b USING (word)
                 JOIN pairs p ON p.word = w.word AND p.near_n = b.most WHERE b.most >= 5 * w.n GROUP BY w.word),
        root AS (SELECT word, word AS root, 0 AS depth FROM words
                 UNION ALL SELECT r.word, f.form, depth + 1 FROM root r JOIN form f ON f.word = r.root)
        SELECT w.word, f.form, (SELECT arg_max(root, depth) FROM root r WHERE r.word = w.word) AS root, w.n, coalesce(b.n_near, 0)::BIGINT AS n_near, f.form_n
        FROM words w LEFT JOIN best b USING (word) LEFT JOIN form f USING (word)""",
}
