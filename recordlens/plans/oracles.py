"""DuckDB SQL with the same results as the registered queries, by query name."""

from __future__ import annotations

from recordlens.functions import STOP_WORDS
from recordlens.operators.split import SPLIT_SEED

_EPOCH = "cast(epoch(o_orderdate) as bigint)"

_CAMPAIGNS = f"""
campaigns as (
  select o_orderkey as id,
    concat('Order ', cast(o_orderkey as varchar(20))) as name,
    concat('Status ', o_orderstatus, ' of "class", ', o_orderpriority) as "desc",
    case when o_orderkey % 13 = 0 then null else replace(o_orderpriority, ' ', '-') end as keywords,
    case when o_orderkey % 17 = 0 then null when o_orderkey % 19 = 0 then 'abc'
      when o_orderkey % 41 = 0 then concat(cast(cast(floor(o_totalprice) as bigint) as varchar(20)), '.75')
      else cast(cast(floor(o_totalprice) as bigint) as varchar(20)) end as goal,
    case when o_orderkey % 29 = 0 then null else {_EPOCH} end as launched_at,
    {_EPOCH} - (o_orderkey * 7919 % 2592000) as created_at,
    {_EPOCH} + (o_custkey * 104729 % 5184000) as deadline,
    {_EPOCH} + (o_custkey * 104729 % 5184000) as state_changed_at,
    o_custkey % 500 as backers_count,
    case when o_orderkey % 97 = 0 then 'True' else 'False' end as disable_communication,
    case when o_orderkey % 11 = 0 then 'False' when o_orderkey % 23 = 0 then 'USA'
      when o_orderkey % 31 = 0 then null when o_orderkey % 37 = 0 then 'US'
      when o_custkey % 3 = 0 then 'US' when o_custkey % 3 = 1 then 'GB' else 'FR' end as country,
    case when o_orderkey % 11 = 0 then 'US' when o_orderkey % 23 = 0 then 'USD'
      when o_orderkey % 31 = 0 then 'dollars' when o_orderkey % 37 = 0 then 'dollars'
      when o_custkey % 3 = 0 then 'USD' when o_custkey % 3 = 1 then 'GBP' else 'EUR' end as currency,
    case when o_orderstatus = 'F' then 1 else 0 end as final_status
  from orders)
"""

_TYPED = (
    _CAMPAIGNS
    + """
, typed as (
  select * replace (
    try_cast(regexp_replace(goal, '[.][0-9]*$', '') as integer) as goal,
    cast(backers_count as integer) as backers_count,
    cast(final_status as integer) as final_status)
  from campaigns)
"""
)

_SPANS = (
    _TYPED
    + """
, spans as (
  select *,
    round(cast(deadline - launched_at as double) / 86400 * 1000) / 1000 as days_campaign,
    round(cast(launched_at - created_at as double) / 3600 * 1000) / 1000 as hours_prepa
  from typed)
"""
)

_COUNTRY2 = """case when country = 'False' then currency when length(country) <> 2 then null else country end"""
_CURRENCY2 = """case when length(currency) <> 3 then null else currency end"""
_COUNTRY2_SHORT = """case when country = 'False' then currency else country end"""
_CURRENCY2_SHORT = """case when country is not null and length(currency) <> 3 then null else currency end"""

_PREPARED = (
    _SPANS
    + f"""
, prepared as (
  select id, lower(name) as name, lower("desc") as "desc", lower(keywords) as keywords,
    coalesce(goal, -1) as goal, final_status,
    coalesce({_COUNTRY2}, 'Unknown') as country2,
    coalesce({_CURRENCY2}, 'Unknown') as currency2,
    coalesce(days_campaign, -1.0) as days_campaign,
    coalesce(hours_prepa, -1.0) as hours_prepa,
    concat_ws(' ', lower(name), lower("desc"), lower(keywords)) as text
  from spans)
"""
)

_STOP_LIST = ", ".join("'" + word.replace("'", "''") + "'" for word in STOP_WORDS)


def _tokens(rows: str = "documents") -> str:
    """One row per token, with its place, of the documents in ``rows``."""
    return f"""
token_lists as (
  select doc_id, regexp_split_to_array(lower(coalesce(text, '')), '[^a-zA-Z0-9_]+') as parts from {rows}),
tokens as (
  select * from (
    select doc_id, unnest(parts) as token, generate_subscripts(parts, 1) as place from token_lists)
  where token <> ''),
kept as (select * from tokens where token not in ({_STOP_LIST}))
"""


_TERMS = (
    _tokens()
    + """
, tf as (select doc_id, token as term, cast(count(*) as integer) as tf from kept group by all),
vocab as (select term, cast(sum(tf) as bigint) as "count", count(*) as df from tf group by term),
n as (select count(*) as n_documents from documents)
"""
)

_ML_TERMS = (
    _TERMS
    + """
, ml_vocab as (select *, cast(row_number() over (order by "count" desc, term) - 1 as integer) as position from vocab)
"""
)

_WEIGHTS = """round(tf * ln((n_documents + 1.0) / (df + 1.0)), 6) as tfidf"""

_LINES = """lines as (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as value from documents)"""
_SPACED = (
    _LINES
    + """, spaced as (select case when doc_id % 7 = 0 then concat(value, '  ')
      when doc_id % 7 = 1 then replace(value, ' ', '  ') when doc_id % 7 = 2 then ''
      when doc_id % 7 = 3 then '   ' else value end as value from lines)"""
)
_WORDS = _LINES + """, words as (select unnest(string_split({text}, ' ')) as word from lines)"""


def _word_count(text: str = "value", tail: str = "") -> str:
    return f"""with {_WORDS.format(text=text)}
select word, count(*) as "count" from words group by word {tail}"""


_INDEX = """row_number() over (order by count(*) desc, {label}) - 1"""


def _hash_share(key: str, share: float) -> str:
    bound = f"{int(share * 2**32):08x}"
    return f"substr(md5(concat('{SPLIT_SEED}:', cast({key} as varchar))), 1, 8) < '{bound}'"


def _summary(table: str, column: str, position: int, kind: str, number: str) -> str:
    return f"""select '{column}' as "column", {position} as position, '{kind}' as type, count({column}) as n,
  count(*) - count({column}) as n_null, round(avg({number}), 4) as mean, round(stddev_samp({number}), 4) as stddev,
  cast(min({column}) as varchar) as "min", cast(max({column}) as varchar) as "max" from {table}"""


# Positions are those of the columns in the table that the query summarises.
_NUMBER_COLUMNS = (
    ("goal", 4, "int"),
    ("backers_count", 9, "int"),
    ("final_status", 13, "int"),
    ("deadline", 7, "bigint"),
    ("launched_at", 5, "bigint"),
    ("days_campaign", 14, "double"),
    ("hours_prepa", 15, "double"),
)
_TEXT_COLUMNS = (("goal", 0), ("country2", 2), ("currency2", 3), ("keywords", 1))

_TOP_COLUMNS = ("disable_communication", "country", "currency", "state_changed_at", "backers_count")

_TYPE_TESTS = (
    ("int", "regexp_matches(t, '^[+-]?[0-9]{1,19}$') and try_cast(t as integer) is not null"),
    ("bigint", "regexp_matches(t, '^[+-]?[0-9]{1,19}$') and try_cast(t as bigint) is not null"),
    ("double", "regexp_matches(t, '^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$')"),
    ("date", "regexp_matches(t, '^[0-9]{4}-[0-9]{2}-[0-9]{2}$') and try_cast(t as date) is not null"),
    ("timestamp", "regexp_matches(t, '^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2})?)?$') and try_cast(t as timestamp) is not null"),
    ("boolean", "lower(t) in ('true', 'false')"),
)
_TYPED_COLUMNS = ("id", "name", "goal", "launched_at", "backers_count", "disable_communication", "country", "launched_ms", "day", "price", "moment")


def _inferred_types() -> str:
    """Counts of fitting values by column and type, and the first type that enough of them fit."""
    values = " union all ".join(f"""select '{name}' as "column", cast({name} as varchar) as t from wide""" for name in _TYPED_COLUMNS)
    counts = ", ".join(f"count(*) filter ({test}) as n_{kind}" for kind, test in _TYPE_TESTS)
    choice = " ".join(f"when n > 0 and n_{kind} >= least_share * n then '{kind}'" for kind, _ in _TYPE_TESTS)
    n_fit = " ".join(f"when '{kind}' then n_{kind}" for kind, _ in _TYPE_TESTS)
    return f"""with {_CAMPAIGNS}, wide as (select *, case when id % 5 = 0 then day else day || ' 10:20:30' end as moment from (
          select c.*, launched_at * 1000 as launched_ms, strftime(o_orderdate, '%Y-%m-%d') as day, o_totalprice + 0.5 as price
          from campaigns c join orders on o_orderkey = id)),
        long as ({values}), counts as (select "column", count(t) as n, count(*) - count(t) as n_null, {counts} from long group by "column"),
        typed as (select *, case {choice} else 'string' end as type from counts, (values (1.0::double), (0.9::double)) as s(least_share)),
        fitted as (select *, case type {n_fit} else n end as n_fit from typed)
        select "column", type, n, n_null, n_fit, round(n_fit / n, 6) as share, least_share from fitted"""


ORACLES: dict[str, str] = {
    # Text lines and word counts
    "text_lines": f"with {_LINES} select value from lines",
    "first_lines": "select doc_id, text from documents order by doc_id limit 10",
    "word_count": _word_count(),
    "word_count_of_lines": f"""with {_LINES}, words as (select unnest(string_split(value, ' ')) as word from lines)
        select word, count(*) as "count" from words group by word""",
    "top_words": _word_count(tail='order by "count" desc, word limit 10'),
    "word_count_folded": _word_count("lower(value)"),
    "top_words_folded": _word_count("lower(value)", tail='order by "count" desc, word limit 10'),
    "word_count_refolded": f"""with {_WORDS.format(text="value")},
        counts as (select word, count(*) as n from words group by word)
        select lower(word) as word, cast(sum(n) as bigint) as "count" from counts group by 1""",
    "word_count_java_split": f"""with {_SPACED}, kept as (
          select unnest(string_split(rtrim(value, ' '), ' ')) as word from spaced
          where value = '' or rtrim(value, ' ') <> '')
        select word, count(*) as "count" from kept group by word""",
    "word_count_without_empty": f"""with {_SPACED},
        words as (select unnest(string_split(lower(value), ' ')) as word from spaced)
        select word, count(*) as "count" from words where word <> '' group by word""",
    # Sources and sinks
    "csv_round_trip": f"with {_TYPED} select * exclude (id) from typed",
    "parquet_glob": "select * from orders",
    "parquet_merged_schemas": """
        select o_orderkey, o_custkey, cast(null as varchar) as o_orderpriority, 1 as part from orders
        union all
        select o_orderkey, null, o_orderpriority, 2 from orders""",
    "parquet_overwrite": f"with {_PREPARED} select * from prepared",
    "parquet_staged_overwrite": f"with {_CAMPAIGNS} select id, goal, true as failed_before from campaigns where id % 2 = 0",
    "csv_quarantine": f"""with {_CAMPAIGNS}, parts as (select id, coalesce(goal, '') as goal, "desc",
          '"' || replace("desc", '"', '""') || '"' as quoted, try_cast(regexp_replace(goal, '[.][0-9]*$', '') as integer) as number from campaigns)
        select case when id % 13 = 0 then 'too many fields' when id % 17 = 0 then 'too few fields' when goal <> '' and number is null then 'goal is no int' else 'good' end as reason,
          case when id % 13 = 0 then 5 when id % 17 = 0 then 2 else 3 end as n_fields,
          case when id % 13 = 0 then concat_ws(',', id, goal, quoted, 'EXTRA', '"a, b"') when id % 17 = 0 then concat_ws(',', id, goal)
            when goal <> '' and number is null then concat_ws(',', id, goal, quoted) else concat_ws('|', id, coalesce(cast(number as varchar), ''), "desc") end as line
        from parts""",
    "inferred_types": _inferred_types(),
    "parquet_refuse_existing": "select o_orderkey, o_totalprice, true as refused from orders",
    # Cleaning
    "cast_records": f"""with {_TYPED} select id, goal, deadline, state_changed_at, created_at, launched_at,
        backers_count, final_status from typed""",
    "pruned_columns": f"""with {_CAMPAIGNS} select * exclude (disable_communication, backers_count, state_changed_at)
        from campaigns""",
    "sentinel_rows": f"with {_CAMPAIGNS} select id, country, currency from campaigns where country = 'False'",
    "present_rows": f"with {_CAMPAIGNS} select id, country from campaigns where country is not null",
    "repaired_codes": f"""with {_CAMPAIGNS}
        select id, {_COUNTRY2} as country2, {_CURRENCY2} as currency2 from campaigns""",
    "repaired_codes_short": f"""with {_CAMPAIGNS}
        select id, {_COUNTRY2_SHORT} as country2, {_CURRENCY2_SHORT} as currency2 from campaigns""",
    "code_lengths": f"""with {_CAMPAIGNS} select cast(length(country) as integer) as country_length,
        cast(length(currency) as integer) as currency_length, count(*) as "count" from campaigns group by all""",
    "time_spans": f"with {_SPANS} select id, days_campaign, hours_prepa from spans",
    "folded_columns": f"""with {_CAMPAIGNS} select id, lower(name) as name, lower("desc") as "desc",
        lower(keywords) as keywords from campaigns""",
    "joined_text": f"""with {_CAMPAIGNS} select id, concat_ws(' ', name, "desc", keywords) as text from campaigns""",
    "filled_numbers": f"""with {_SPANS} select id, coalesce(days_campaign, -1.0) as days_campaign,
        coalesce(hours_prepa, -1.0) as hours_prepa, coalesce(goal, -1) as goal from spans""",
    "filled_texts": f"""with {_CAMPAIGNS} select id, coalesce({_COUNTRY2}, 'Unknown') as country2,
        coalesce({_CURRENCY2}, 'Unknown') as currency2 from campaigns""",
    "labelled_missing": f"""with {_CAMPAIGNS} select id, coalesce({_COUNTRY2}, 'unknown') as country2,
        coalesce({_CURRENCY2}, 'unknown') as currency2 from campaigns""",
    "complete_rows": f"""with {_TYPED} select id, keywords, goal, launched_at, country from typed
        where keywords is not null and goal is not null and launched_at is not null and country is not null""",
    "prepared_records": f"with {_PREPARED} select * from prepared",
    "prepared_records_short_rule": f"""with {_SPANS} select id,
        coalesce({_COUNTRY2_SHORT}, 'Unknown') as country2, coalesce({_CURRENCY2_SHORT}, 'Unknown') as currency2,
        coalesce(days_campaign, -1.0) as days_campaign, coalesce(hours_prepa, -1.0) as hours_prepa,
        coalesce(goal, -1) as goal from spans""",
    # Profiling
    "row_count": f"with {_CAMPAIGNS} select count(*) as n_rows from campaigns",
    "summary_of_numbers": f"with {_SPANS} "
    + " union all ".join(_summary("spans", name, place, kind, name) for name, place, kind in _NUMBER_COLUMNS),
    "summary_of_parts": f"with {_SPANS} "
    + " union all ".join(_summary("spans", name, place, kind, name) for place, (name, _, kind) in enumerate(_NUMBER_COLUMNS)),
    "summary_of_texts": f"""with {_CAMPAIGNS}, codes as (select goal, {_COUNTRY2} as country2,
        {_CURRENCY2} as currency2, keywords from campaigns) """
    + " union all ".join(
        _summary("codes", name, place, "string", f"try_cast({name} as double)") for name, place in _TEXT_COLUMNS
    ),
    "value_frequencies": f"""with {_CAMPAIGNS} select country, count(*) as "count" from campaigns group by country""",
    "pair_frequencies": f"""with {_CAMPAIGNS} select country, currency, count(*) as "count" from campaigns
        group by all order by "count" desc, country nulls first, currency nulls first limit 50""",
    "sentinel_currencies": f"""with {_CAMPAIGNS} select currency, count(*) as "count" from campaigns
        where country = 'False' group by currency order by "count" desc, currency nulls first limit 50""",
    "top_values": f"""with {_CAMPAIGNS}, counts as ("""
    + " union all ".join(
        f"""select '{name}' as "column", cast({name} as varchar) as value, count(*) as n from campaigns group by {name}"""
        for name in _TOP_COLUMNS
    )
    + """), ranked as (select *, row_number() over
          (partition by "column" order by n desc, value nulls first) as place from counts)
        select "column", value, n as "count", cast(place as integer) as "rank" from ranked where place <= 100""",
    "distinct_deadlines": f"with {_CAMPAIGNS} select distinct deadline from campaigns",
    "first_goals": f"with {_TYPED} select id, goal, final_status from typed order by id limit 30",
    # Text and category features
    "document_tokens": f"""with {_tokens()} select doc_id, coalesce(joined, '') as tokens from documents
        left join (select doc_id, string_agg(token, ' ' order by place) as joined from tokens group by doc_id)
        using (doc_id)""",
    "token_lengths": f"""with {_tokens()}, a as (select doc_id, count(*) as n from tokens group by doc_id),
        b as (select doc_id, count(*) as m from kept group by doc_id)
        select doc_id, cast(coalesce(n, 0) as integer) as n_tokens, cast(coalesce(m, 0) as integer) as n_filtered
        from documents left join a using (doc_id) left join b using (doc_id)""",
    "filtered_tokens": f"""with {_tokens()} select doc_id, coalesce(joined, '') as filtered from documents
        left join (select doc_id, string_agg(token, ' ' order by place) as joined from kept group by doc_id)
        using (doc_id)""",
    "term_frequencies": f"with {_TERMS} select doc_id, term, tf from tf",
    "vocabulary": f"""with {_TERMS} select term, "count", df from vocab""",
    "vocabulary_min_df": f"""with {_TERMS} select term, "count", df from vocab where df >= 5""",
    "prepared_schema": f"""select cast(row_number() over () - 1 as integer) as position, column_name as "column",
        case column_type when 'VARCHAR' then 'string' when 'INTEGER' then 'int' else lower(column_type) end as type
        from (describe with {_PREPARED} select * from prepared)""",
    "vocabulary_by_share": f"""with {_TERMS} select term, "count", df from vocab, n where df >= n_documents * 0.01
        order by "count" desc, term limit 500""",
    "term_weights": f"""with {_TERMS} select doc_id, term, tf, df, {_WEIGHTS}
        from tf join vocab using (term), n""",
    "label_index": f"""with {_CAMPAIGNS} select deadline as label, count(*) as "count",
        {_INDEX.format(label="deadline")} as "index" from campaigns group by deadline""",
    "distinct_label_index": f"""with {_PREPARED} select country2,
        {_INDEX.format(label="country2")} as country_indexed from prepared group by country2""",
    "one_hot_entries": f"""with indexed as (select source as label, {_INDEX.format(label="source")} as "index"
        from documents where source is not null group by source)
        select label, "index", "index" as position, cast(1 as double) as value from indexed
        where "index" < (select max("index") from indexed)""",
    # Spark ML features
    "count_vectors": f"with {_ML_TERMS} select doc_id, term, position, tf from tf join ml_vocab using (term)",
    "idf_vectors": f"with {_ML_TERMS} select doc_id, term, {_WEIGHTS} from tf join ml_vocab using (term), n",
    "term_table_vectors": f"with {_ML_TERMS} select doc_id, term, position, tf, {_WEIGHTS} from tf join ml_vocab using (term), n",
    "term_table_agreement": f"""with {_TERMS} select (select count(*) from documents) as n_documents, count(*) as n_entries, 0::bigint as n_different from tf""",
    "hashed_term_vectors": f"""with {_tokens()} select doc_id, 20000 as n_buckets, coalesce(m, 0) as n_terms
        from documents left join (select doc_id, count(*) as m from kept group by doc_id) using (doc_id)""",
    "string_indexer": f"""with l as (select lang, cast({_INDEX.format(label="lang")} as double) as lang_indexed
          from documents group by lang),
        s as (select source, cast({_INDEX.format(label="source")} as double) as source_indexed
          from documents group by source)
        select distinct lang, lang_indexed, source, source_indexed
        from documents join l using (lang) join s using (source)""",
    "one_hot_vectors": f"""with l as (select lang, {_INDEX.format(label="lang")} as i from documents group by lang),
        s as (select source, {_INDEX.format(label="source")} as j from documents group by source)
        select doc_id,
          case when i < (select max(i) from l) then i + 1 else 0 end as lang_position,
          case when j < (select max(j) from s) then j + 1 else 0 end as source_position,
          cast((select max(j) from s) as integer) as source_size
        from documents join l using (lang) join s using (source)""",
    "assembled_vectors": f"""with {_ML_TERMS},
        sizes as (select (select count(*) from ml_vocab) + 1
          + (select count(distinct lang) from documents) + (select count(distinct source) from documents) as size),
        entries as (select doc_id, count(*) as m from tf join ml_vocab using (term), n
          where df < n_documents group by doc_id)
        select doc_id, cast(size as integer) as vector_size,
          cast(coalesce(m, 0) + case when n_chars <> 0 then 1 else 0 end + 2 as integer) as n_entries
        from documents left join entries using (doc_id), sizes""",
    # Splits and scores
    "split_sizes": f"""select doc_id, case when {_hash_share("doc_id", 0.9)} then 'train' else 'test' end as part
        from documents""",
    "random_split_union": "select o_orderkey, o_orderstatus from orders",
    "confusion_counts": """select quality, toxic, count(*) as "count" from labels group by all""",
    "weighted_f1": """with pairs as (select quality as l, toxic as p, count(*) as n from labels group by all),
        actual as (select l as c, sum(n) as a, sum(case when l = p then n else 0 end) as hits from pairs group by l),
        predicted as (select p as c, sum(n) as b from pairs group by p)
        select cast(sum(a) as bigint) as n_rows,
          round(sum(2.0 * hits / (a + coalesce(b, 0)) * a) / sum(a), 9) as f1
        from actual left join predicted using (c)""",
    "threshold_decisions": f"""with {_CAMPAIGNS}
        select id, backers_count / 500.0::double as p1,
          case when backers_count / 500.0::double > 0.3 then 1.0::double else 0.0::double end as predictions
        from campaigns""",
    "random_split_shares": "select count(*) as n_rows, count(*) as n_ids, true as near_share from orders",
    "hashed_term_buckets": f"""with {_tokens()}
        select count(*) as n_terms, 0::bigint as n_different, 0::bigint as n_outside from kept""",
    # Trained models: what holds for any fitted model
    "heldout_scores": f"""select doc_id, quality, true as p1_in_range, true as by_threshold
        from documents join labels using (doc_id) where not {_hash_share("doc_id", 0.9)}""",
    "heldout_f1": f"""select count(*) as n_rows, true as f1_agrees, features
        from documents join labels using (doc_id), (values ('join_features'), ('features')) as f(features)
        where not {_hash_share("doc_id", 0.9)} group by features""",
    "grid_report": f"""with fit_rows as (select doc_id, text from documents join labels using (doc_id)
          where {_hash_share("doc_id", 0.7)}),
        check_rows as (select doc_id from documents join labels using (doc_id)
          where {_hash_share("doc_id", 0.9)} and not {_hash_share("doc_id", 0.7)}),
        {_tokens("fit_rows")},
        dfs as (select token, count(distinct doc_id) as df from kept group by token)
        select min_df, reg_param, (select count(*) from fit_rows) as n_fit, (select count(*) from check_rows) as n_check,
          (select count(*) from dfs where df >= min_df) as n_terms,
          true as f1_in_range, true as one_chosen, true as best_chosen
        from (values (10::double), (20::double), (40::double)) as m(min_df),
          (values (1e-7::double), (1e-5::double), (1e-3::double), (1e-1::double)) as r(reg_param)""",
    "resumed_search": f"""with fit_rows as (select doc_id, text from documents join labels using (doc_id)
          where {_hash_share("doc_id", 0.7)}),
        check_rows as (select doc_id from documents join labels using (doc_id)
          where {_hash_share("doc_id", 0.9)} and not {_hash_share("doc_id", 0.7)}),
        {_tokens("fit_rows")},
        dfs as (select token, count(distinct doc_id) as df from kept group by token)
        select min_df, reg_param, (select count(*) from fit_rows) as n_fit, (select count(*) from check_rows) as n_check,
          (select count(*) from dfs where df >= min_df) as n_terms, min_df = 20 as reused, true as same_f1
        from (values (20::double), (40::double)) as m(min_df), (values (1e-5::double), (1e-3::double)) as r(reg_param)""",
    "posting_scores": f"""select count(*) as n_rows, 0::bigint as n_different, 0::bigint as n_other_class
        from documents join labels using (doc_id) where not {_hash_share("doc_id", 0.9)}""",
    "plain_stages_agreement": f"""select count(*) as n_rows, 0::bigint as n_different
        from documents join labels using (doc_id) where not {_hash_share("doc_id", 0.9)}""",
    "country_rates": f"""with {_PREPARED}
        select country2, round(avg(final_status), 4) as p1 from prepared group by country2""",
    "campaign_calibration": f"""with {_PREPARED}, parts as (select *, {_hash_share("id", 0.9)} as first from prepared)
        select count(*) filter (first) as n_train, round(avg(final_status) filter (first), 4) as mean_p1,
          count(*) filter (not first) as n_test from parts""",
    "campaign_models": f"""with {_PREPARED}
        select model, final_status, count(*) as n_rows, count(*) as n_right, true as f1_agrees
        from prepared, (values ('simple'), ('text'), ('tuned'), ('reloaded')) as m(model)
        where not {_hash_share("id", 0.9)} group by model, final_status""",
    "heldout_threshold_agreement": f"""select count(*) as n_rows, 0::bigint as n_different
        from documents join labels using (doc_id) where not {_hash_share("doc_id", 0.9)}""",
    "saved_model_agreement": f"""select count(*) as n_rows, 0::bigint as n_different
        from documents join labels using (doc_id) where not {_hash_share("doc_id", 0.9)}""",
}
ORACLES["assembled_slots"] = f"""select cast(sum(n_entries) as bigint) as n_entries, 0::bigint as n_different
    from ({ORACLES["assembled_vectors"]})"""
