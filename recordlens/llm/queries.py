"""The registered queries of this package, and the DuckDB SQL of those that SQL can express.

Each query takes whole tables. Columns that hold digests are made from the operators' real outputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordlens.llm import (
    adaptive_scan,
    bpe_matrix,
    chat_tree,
    fill_middle,
    filter_audit,
    impact_topk,
    importance,
    packing,
    pigeonhole,
    superminhash,
    token_blocks,
    toxicity,
    url_rules,
)
from recordlens.llm.vocabularies import public_path

# Fixed values of the contract: the rules of op3 and the conversation that op4 adds.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
PROBE_TEXT = r"\### Assistant: </turn> ok"
END_OF_WORDS, END_OF_BYTES = 1, 0


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Expected severity of every document, and whether it is rejected."""
    docs = _table(spark, folder, "documents")
    model = toxicity.model_of_flags(docs, _table(spark, folder, "labels"))
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", "severity", (F.col("severity") >= toxicity.REJECT_FROM).alias("toxic"))


def op2_token_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """Start, length and checksum of every document's ids, read back from the token files."""
    docs = _table(spark, folder, "documents")
    read = token_blocks.token_files(spark, docs, public_path("word_bpe_49k.json"), END_OF_WORDS)
    return read.select("doc_id", "start", "n_tokens", "ids_crc32")


def op3_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Host, path, deciding rule and verdict of every page's url."""
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    pages = _table(spark, folder, "pages").select("page_id", "url")
    return url_rules.judge(pages, rules).select("page_id", "host", "path", "rule", "verdict")


def op4_chat_tree(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of every conversation, read back from the prefix trees."""
    talks = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-7, 0, "user", PROBE_TEXT), (-7, 1, "assistant", PROBE_TEXT)], "conv_id long, turn long, role string, text string")
    nodes, turns = chat_tree.build_trees(talks.unionByName(probe))
    return chat_tree.read_conversations(*chat_tree.stored(nodes, turns))


def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Sequence and offset of every piece of every document."""
    return packing.pack_documents(_table(spark, folder, "documents"), public_path("byte_bpe_50k.json"), END_OF_BYTES)


def op6_superminhash(spark: SparkSession, folder: str) -> DataFrame:
    """Component of every document by three-word shingles, similarity 0.85."""
    docs = _table(spark, folder, "documents")
    found = superminhash.near_duplicates(docs, words=3, percent=85, bands=superminhash.BANDS, slots=superminhash.SLOTS)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op7_importance(spark: SparkSession, folder: str) -> DataFrame:
    """Weight and key of every document, and whether it is drawn."""
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return importance.resample(docs, _table(spark, folder, "labels"), keep_text=False).select("doc_id", "log_weight", "gumbel_key", "kept")


def op8_pigeonhole(spark: SparkSession, folder: str) -> DataFrame:
    """Links and component of every vector at cosine 0.95."""
    return pigeonhole.near_vectors(_table(spark, folder, "embeddings"))


def op9_bpe_matrix(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of every document's ids and of what they decode to."""
    import public_tokenizers

    docs = _table(spark, folder, "documents")
    found = bpe_matrix.encode_documents(docs, public_path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, keep_ids=False)
    return found.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op10_impact_topk(spark: SparkSession, folder: str) -> DataFrame:
    """The five best of all other vectors for every vector whose id is divisible by 50."""
    return impact_topk.top_k(_table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


def op11_adaptive_scan(spark: SparkSession, folder: str) -> DataFrame:
    """The five nearest vectors found for every vector whose id is divisible by 50."""
    return adaptive_scan.nearest_neighbours(_table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


def op12_fenwick_fim(spark: SparkSession, folder: str) -> DataFrame:
    """Form, lengths and digests of every document's fill-in-the-middle text, and of the text that is made from it again."""
    made = fill_middle.fill_in_middle(_table(spark, folder, "documents").select("doc_id", "text"))
    back = fill_middle.restored(F.col("output"), F.col("form"))
    digests = F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256")
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


def op13_packed_audit(spark: SparkSession, folder: str) -> DataFrame:
    """What each of five filters removes in every order, by source."""
    return filter_audit.audit(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    """All stages of the corpus pipeline over the documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_token_blocks": op2_token_blocks,
    "op3_url_rules": op3_url_rules,
    "op4_chat_tree": op4_chat_tree,
    "op5_packing": op5_packing,
    "op6_superminhash": op6_superminhash,
    "op7_importance": op7_importance,
    "op8_pigeonhole": op8_pigeonhole,
    "op9_bpe_matrix": op9_bpe_matrix,
    "op10_impact_topk": op10_impact_topk,
    "op11_adaptive_scan": op11_adaptive_scan,
    "op12_fenwick_fim": op12_fenwick_fim,
    "op13_packed_audit": op13_packed_audit,
    "pipeline": pipeline,
}

_RULE_ROWS = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)

ORACLES = {
    "op3_url_rules": f"""
        with rules(rule_host, rule_path, verdict) as (values {_RULE_ROWS}),
        cut as (select page_id, case when position('://' in url) > 0 then substr(url, position('://' in url) + 3) end as rest from pages),
        parts as (
            select page_id,
                translate(coalesce(regexp_extract(rest, '^[^/?#]*'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
                coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') as path
            from cut
        ),
        best as (
            select page_id, max_by(rule_host || rule_path, length(rule_host || rule_path)) as rule,
                max_by(verdict, length(rule_host || rule_path)) as verdict
            from parts join rules on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
            group by page_id
        )
        select p.page_id, p.host, p.path, b.rule, coalesce(b.verdict, 'allow') as verdict from parts p left join best b using (page_id)
    """,
    "op4_chat_tree": r"""
        with talks as (
            select conv_id, turn, role, coalesce(text, '') as text from conversations
            union all select -7, 0, 'user', '\### Assistant: </turn> ok'
            union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'
        ),
        written as (select *, '### ' || role || chr(10)
            || replace(replace(replace(text, '\', '\\'), '###', '\###'), '</turn>', '\</turn>') || '</turn>' || chr(10) as whole from talks)
        select conv_id, count(*) as n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn)) as turns_sha256,
            cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
            sha256(coalesce(string_agg(text, '' order by turn) filter (role = 'assistant'), '')) as loss_sha256,
            cast(sum(length(whole)) as bigint) as formatted_chars
        from written group by conv_id
    """,
    "op8_pigeonhole": """
        with recursive v as (select vec_id, cast(embedding as double[]) as x from embeddings),
        u as (select vec_id, list_transform(x, lambda y: y / sqrt(list_dot_product(x, x))) as x from v
            where x is not null and len(x) > 0 and list_dot_product(x, x) > 0 and isfinite(list_dot_product(x, x))),
        links as (select a.vec_id as a, b.vec_id as b from u a join u b on a.vec_id <> b.vec_id and list_dot_product(a.x, b.x) >= 0.95),
        reach(id, to_id) as (select a, b from links union select r.id, l.b from reach r join links l on r.to_id = l.a),
        least as (select id, min(to_id) as to_id from reach group by id),
        counts as (select a, count(*) as n from links group by a)
        select e.vec_id, coalesce(c.n, 0) as n_links, least(e.vec_id, coalesce(l.to_id, e.vec_id)) as component_id,
            e.vec_id = least(e.vec_id, coalesce(l.to_id, e.vec_id)) as kept
        from embeddings e left join least l on l.id = e.vec_id left join counts c on c.a = e.vec_id
    """,
    "op10_impact_topk": """
        with v as (select vec_id, list_transform(embedding, lambda y: floor(256 * cast(y as double))) as x from embeddings
            where embedding is not null and isfinite(list_sum(list_transform(embedding, lambda y: cast(y as double))))),
        scored as (select q.vec_id as query_id, c.vec_id, cast(list_dot_product(q.x, c.x) as bigint) as score
            from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 50 = 0)
        select query_id, cast(rank as integer) as rank, vec_id, score from (
            select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored) where rank <= 5
    """,
    "op12_fenwick_fim": """
        with d as (select doc_id, coalesce(text, '') as t, sha256('1:' || coalesce(cast(doc_id as varchar), '')) as h from documents),
        drawn as (select doc_id, t, cast(length(t) as bigint) as n, cast('0x' || substr(h, 1, 8) as bigint) as h1, cast('0x' || substr(h, 9, 8) as bigint) as h2,
            cast('0x' || substr(h, 17, 8) as bigint) as h3, cast('0x' || substr(h, 25, 8) as bigint) as h4 from d),
        cuts as (select doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) as x, greatest(h1 % (n + 1), h2 % (n + 1)) as y,
            case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 90 then 'plain'
                when h4 % 100 < 20 then 'spm' else 'psm' end as form from drawn),
        parts as (select *, substr(t, 1, x) as p, substr(t, x + 1, y - x) as m, substr(t, y + 1) as s from cuts)
        select doc_id, n, form, case when form <> 'plain' then x end as prefix_chars, case when form <> 'plain' then y - x end as middle_chars,
            sha256(case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
            sha256(t) as restored_sha256
        from parts
    """,
    "op13_packed_audit": r"""
        with d as (select doc_id, coalesce(source, '') as part, coalesce(text, '') as t from documents),
        least as (select t, min(doc_id) as first_id from d group by t),
        flags as (select doc_id, bool_or(quality = 1) as good, bool_or(toxic = 1) as toxic from labels where doc_id is not null group by doc_id),
        words as (select d.doc_id, d.part, d.t, regexp_extract_all(d.t, '[^\x20\x09-\x0D]+') as w, coalesce(d.doc_id > l.first_id, false) as later,
            coalesce(f.good, false) as good, coalesce(f.toxic, false) as toxic from d join least l using (t) left join flags f on f.doc_id = d.doc_id),
        fails as (select part, good, toxic, (case when len(w) < 200 then 'A' else '' end) || (case when 100 * len(list_distinct(w)) < 50 * len(w) then 'B' else '' end)
            || (case when 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 2 * length(t) then 'C' else '' end)
            || (case when regexp_matches(t, '[#$%&*|]') then 'D' else '' end) || (case when later then 'E' else '' end) as failed from words),
        counted as (select part, failed, count(*) as n, count(*) filter (good) as good, count(*) filter (toxic) as toxic from fails group by part, failed),
        letters(x) as (values ('A'), ('B'), ('C'), ('D'), ('E')),
        orders as (select a.x || b.x || c.x || d.x || e.x as filter_order from letters a join letters b on b.x <> a.x join letters c on c.x not in (a.x, b.x)
            join letters d on d.x not in (a.x, b.x, c.x) join letters e on e.x not in (a.x, b.x, c.x, d.x)),
        steps as (select filter_order, cast(i as integer) as step, substr(filter_order, i, 1) as letter, substr(filter_order, 1, i - 1) as earlier from orders, range(1, 6) r(i)),
        seen as (select s.filter_order, s.step, s.letter, c.*, contains(c.failed, s.letter) as fails, failed <> '' and regexp_matches(c.failed, '[' || s.earlier || '0]') as gone
            from steps s join counted c on true),
        found as (select part, filter_order, step, any_value(letter) as letter, sum(n) filter (not fails and not gone) as kept, sum(n) filter (fails and not gone) as removed,
            sum(n) filter (fails and gone) as redundant, sum(n) filter (failed = letter) as unique_fails, sum(good) filter (fails and not gone) as good_lost,
            sum(toxic) filter (fails and not gone) as toxic_lost from seen group by part, filter_order, step)
        select part, filter_order, step, cast(coalesce(kept, 0) as bigint) as kept, cast(coalesce(removed, 0) as bigint) as removed, cast(coalesce(redundant, 0) as bigint) as redundant,
            cast(coalesce(unique_fails, 0) as bigint) as unique_fails, cast(coalesce(good_lost, 0) as bigint) as good_lost, cast(coalesce(toxic_lost, 0) as bigint) as toxic_lost,
            cast(coalesce(sum(removed) over (partition by part, letter), 0) as bigint) as shapley from found
    """,
}
