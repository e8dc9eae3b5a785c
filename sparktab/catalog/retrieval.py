"""Retrieval queries (T5-T8): label-centroid queries over the embeddings; documents as the KB text."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparktab.catalog.registry import query
from sparktab.operators import retrieval as R
from sparktab.sources.listing import LISTING_COLUMNS as _LISTING_COLS
from sparktab.sources.listing import listing_pair, with_listing
from sparktab.sources.tables import table

# Role -> number of queries per role (fixed values of the reference's role query lists).
ROLES = [("DataAgent", 3), ("FeatureAgent", 5), ("ModelAgent", 4), ("EvaluatorAgent", 3), ("OrchestratorAgent", 2)]
N_LABELS = 10
N_EXTRA_BASE = sum(n for _, n in ROLES)  # extra queries continue the label rotation


def role_queries():
    out, i = [], 0
    for role, n in ROLES:
        for p in range(n):
            out.append((role, p, i % N_LABELS))
            i += 1
    return out


def _emb(spark, d):
    return table(spark, d, "embeddings")


def _kb(spark, d):
    e = _emb(spark, d)
    docs = table(spark, d, "documents").select(F.col("doc_id"), "text", F.col("source").alias("topic"))
    return e.join(docs, e.vec_id == docs.doc_id).select("doc_id", "embedding", "text", "topic")


_VEC_SQL = """
with e as (select vec_id, label, cast(embedding as double[]) as v from embeddings),
el as (select label, unnest(v) as x, generate_subscripts(v, 1) as pos from e),
cent as (select label, list(ax order by pos) as q from (select label, pos, avg(x) as ax from el group by label, pos) group by label),
qn as (select label, list_transform(q, lambda x: x / sqrt(list_sum(list_transform(q, lambda y: y * y)))) as q from cent),
dn as (select vec_id, list_transform(v, lambda x: x / sqrt(list_sum(list_transform(v, lambda y: y * y)))) as v from e)
"""


@query("cosine_topk", _VEC_SQL + """
, s as (select label as query_id, vec_id as doc_id, list_dot_product(q, v) as score from qn, dn)
select query_id, doc_id, round(score, 6) as score, cast(rank as int) as rank from (
  select *, row_number() over (partition by query_id order by score desc, doc_id) as rank from s) where rank <= 5""")
def cosine_topk(spark, d):
    """Exact cosine top-5 of every embedding for each label-centroid query."""
    e = _emb(spark, d)
    q = R.centroids(e, "embedding", "label")
    return R.topk_inner_product(e, "vec_id", "embedding", q, "label", "embedding", k=5).select(
        "query_id", "doc_id", F.round("score", 6).alias("score"), "rank")


_KB_SQL = _VEC_SQL.replace("from embeddings)", "from embeddings join documents on vec_id = doc_id)") + """
, kb as (select doc_id, text, source as topic from documents where doc_id in (select vec_id from e))
"""


@query("context_blocks", _KB_SQL + """
, s as (select label as query_id, vec_id as doc_id, list_dot_product(q, v) as score from qn, dn)
, h as (select * from (select *, row_number() over (partition by query_id order by score desc, doc_id) as rank from s) where rank <= 5)
select query_id as label, '=== Relevant Domain Knowledge ===' || chr(10)
  || string_agg('[' || cast(rank as varchar) || '] (' || coalesce(topic, 'general') || ') ' || text, chr(10) order by rank)
  || chr(10) || '=== End of Domain Knowledge ===' as context
from h join kb using (doc_id) group by query_id""")
def context_blocks(spark, d):
    """One formatted top-5 knowledge block per label query over the document knowledge base."""
    kb = _kb(spark, d)
    e = _emb(spark, d).join(kb.select("doc_id"), F.col("vec_id") == F.col("doc_id"), "left_semi")
    q = R.centroids(e, "embedding", "label")
    hits = R.topk_inner_product(kb, "doc_id", "embedding", q, "label", "embedding", k=5)
    hits = hits.join(kb.select("doc_id", "text", "topic"), "doc_id").withColumnRenamed("query_id", "label")
    return R.context_block(hits, "label", "=== Relevant Domain Knowledge ===", "=== End of Domain Knowledge ===")


def _roles_sql():
    base = "select * from (values " + ", ".join(f"('{r}', {p}, {lab})" for r, p, lab in role_queries()) + ") as t(role, query_pos, label)"
    cells = " + ".join(f"(count(*) - count({c}))" for c in _LISTING_COLS)
    signals = (f"(select ({cells}) / (count(*) * {len(_LISTING_COLS)}.0) as missing_pct, skewness(target) as target_skew, "
               "count(*) as n_rows from train)")
    extras = []
    for i, (col, thr) in enumerate(R.PROFILE_RULES):
        for r, c in ROLES:
            extras.append(f"select '{r}', {c + i}, {(N_EXTRA_BASE + i) % N_LABELS} from {signals} s where s.{col} > {thr}")
    return base + " union all " + " union all ".join(extras)


@query("role_context", with_listing(", " + _KB_SQL.strip()[len("with "):]) + f"""
, roles as ({_roles_sql()})
, s as (select label, vec_id as doc_id, list_dot_product(q, v) as score from qn, dn)
, h as (select * from (select *, row_number() over (partition by label order by score desc, doc_id) as rank from s) where rank <= 3)
, rh as (select role, query_pos, rank, h.doc_id, score, topic, text from roles join h using (label) join kb using (doc_id))
, f as (select role, text, arg_min(query_pos, (query_pos, rank)) as query_pos, arg_min(rank, (query_pos, rank)) as rank,
    arg_min(score, (query_pos, rank)) as score, arg_min(topic, (query_pos, rank)) as topic from rh group by role, text)
, t as (select * from (select *, row_number() over (partition by role order by score desc, query_pos, rank) as pos from f) where pos <= 12)
select role, '=== Domain Knowledge for ' || role || ' ===' || chr(10)
  || string_agg('[' || cast(pos as varchar) || '] (' || coalesce(topic, 'general') || ') ' || text, chr(10) order by pos)
  || chr(10) || '=== End of Knowledge for ' || role || ' ===' as context
from t group by role""")
def role_context(spark, d):
    """Per role, top-3 hits of each of its queries, deduped by text, best 12, formatted."""
    kb = _kb(spark, d)
    e = _emb(spark, d).join(kb.select("doc_id"), F.col("vec_id") == F.col("doc_id"), "left_semi")
    roles = spark.createDataFrame(role_queries(), "role string, query_pos int, label int")  # configuration rows
    train, _ = listing_pair(spark, d)
    fired = [r["extra"] for r in R.extra_queries(R.profile_signals(train)).collect() if r["fired"]]  # <= 3 rows
    if fired:
        ex = [(r, c + i, (N_EXTRA_BASE + i) % N_LABELS) for i in fired for r, c in ROLES]
        roles = roles.unionByName(spark.createDataFrame(ex, "role string, query_pos int, label int"))
    cent = R.centroids(e, "embedding", "label")
    q = cent.join(F.broadcast(roles.select("label").distinct()), "label", "left_semi")  # config rows
    hits = R.topk_inner_product(kb, "doc_id", "embedding", q, "label", "embedding", k=3)
    hits = (hits.withColumnRenamed("query_id", "label").join(F.broadcast(roles), "label")
                .join(kb.select("doc_id", "text", "topic"), "doc_id"))
    top = R.role_context(hits, cap=12)
    return R.context_block(top, "role", "=== Domain Knowledge for {key} ===", "=== End of Knowledge for {key} ===",
                           order_col="pos")
