"""Registered queries: each takes (spark, folder) and runs one operator over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.errors import AnalysisException
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recordlens import sources
from recordlens.operators import clean, evaluate, features, infer, linear, profile, split, states, terms, training, vectorize, words
from recordlens.plans import prepare
from recordlens.plans.tables import campaigns, documents, labelled, lines, spaced_lines, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

DOCUMENT_RECIPE = training.Recipe(
    text="text",
    categories=("lang", "source"),
    numbers=("n_chars",),
    label="quality",
    keep=("doc_id",),
)
# The usual values suit about 100,000 rows; these suit the test tables.
DOCUMENT_MIN_DFS = (10.0, 20.0, 40.0)


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def typed_campaigns(spark: SparkSession, folder: str) -> DataFrame:
    return clean.cast_columns(campaigns(spark, folder), prepare.TYPES)


# Text lines and word counts


@query
def text_lines(spark, folder):
    """Documents written as a text file and read back as lines."""
    path = sources.scratch_path(spark, "lines")
    sources.write_text(documents(spark, folder), "text", path)
    return sources.read_text(spark, path, line_sep="\n")


@query
def first_lines(spark, folder):
    docs = documents(spark, folder).select("doc_id", "text")
    return profile.first_rows(docs, 10, "doc_id")


@query
def word_count(spark, folder):
    return words.count_words(lines(spark, folder))


@query
def word_count_of_lines(spark, folder):
    """Words of the lines of a text file, counted and ranked."""
    path = sources.scratch_path(spark, "lines")
    sources.write_text(documents(spark, folder), "text", path)
    return words.ranked(words.count_words(sources.read_text(spark, path, line_sep="\n")))


@query
def top_words(spark, folder):
    return words.top(words.count_words(lines(spark, folder)), 10)


@query
def word_count_folded(spark, folder):
    return words.count_words(lines(spark, folder), fold=True)


@query
def top_words_folded(spark, folder):
    return words.top(words.count_words(lines(spark, folder), fold=True), 10)


@query
def word_count_refolded(spark, folder):
    """Counted first, folded and summed after."""
    return words.fold_counts(words.count_words(lines(spark, folder)))


@query
def word_count_java_split(spark, folder):
    return words.count_words(spaced_lines(spark, folder), java_split=True)


@query
def word_count_without_empty(spark, folder):
    return words.count_words(spaced_lines(spark, folder), fold=True, drop_empty=True)


# Sources and sinks


@query
def csv_round_trip(spark, folder):
    """Records with commas and quotes in their text, through CSV and back, then typed."""
    path = sources.scratch_path(spark, "campaigns-csv")
    records = campaigns(spark, folder)
    # The id stands first and the others in another order than they are read in: columns go by their names.
    sources.write_csv(records.select("id", *sorted(records.drop("id").columns)), path)
    return sources.read_csv(spark, path, records.drop("id").columns, prepare.TYPES)


@query
def parquet_glob(spark, folder):
    """Several part files, matched by a glob."""
    path = sources.scratch_path(spark, "parts")
    sources.write_parquet(table(spark, folder, "orders").repartition(4), path)
    return sources.read_parquet(spark, f"{path}/part-*.parquet")


@query
def prepared_schema(spark, folder):
    """Position, name and type of the columns of the prepared records."""
    return profile.schema_table(prepare.prepare_records(campaigns(spark, folder))).drop("nullable")


@query
def parquet_merged_schemas(spark, folder):
    """Two part sets with different columns, read as one table."""
    path = sources.scratch_path(spark, "merged")
    orders = table(spark, folder, "orders")
    sources.write_parquet(orders.select("o_orderkey", "o_custkey"), f"{path}/part=1")
    sources.write_parquet(orders.select("o_orderkey", "o_orderpriority"), f"{path}/part=2")
    return sources.read_parquet(spark, path, merge_schema=True).select(
        "o_orderkey", "o_custkey", "o_orderpriority", "part"
    )


@query
def parquet_overwrite(spark, folder):
    """The raw records, replaced by the prepared ones at the same path."""
    path = sources.scratch_path(spark, "prepared")
    raw = campaigns(spark, folder)
    sources.write_parquet(raw, path, overwrite=True)
    sources.write_parquet(prepare.prepare_records(raw), path, overwrite=True)
    return sources.read_parquet(spark, path)


@query
def parquet_staged_overwrite(spark, folder):
    """A table that a failed overwrite has left as it was, then replaced by half of its own rows."""
    path = sources.scratch_path(spark, "staged")
    raw = campaigns(spark, folder).select("id", "goal")
    sources.write_parquet(raw, path)
    broken = F.when(F.col("id") % 7 == 0, F.raise_error(F.lit("broken"))).otherwise(F.col("goal"))
    failed = False
    try:
        sources.write_parquet(raw.withColumn("goal", broken.cast("string")), path, overwrite=True)
    except Exception as error:  # whatever class the session raises it as
        failed = "broken" in str(error)
    sources.write_parquet(sources.read_parquet(spark, path).where("id % 2 = 0"), path, overwrite=True)
    return sources.read_parquet(spark, path).withColumn("failed_before", F.lit(failed))


def _written_lines(spark: SparkSession, lines_of: DataFrame, header: str, name: str) -> str:
    """Write one text column as the lines of CSV files with a header, as they are."""
    path = sources.scratch_path(spark, name)
    as_they_are = {"header": True, "sep": "\x01", "quote": "", "escapeQuotes": False, "escape": "\x02", "nullValue": "", "emptyValue": ""}
    lines_of.toDF(header).write.options(**as_they_are).csv(path)
    return path


@query
def csv_quarantine(spark, folder):
    """Records of which some have a field too many or too few: good rows and rejected lines of the same files."""
    quoted = """concat('"', replace(desc, '"', '""'), '"')"""
    line = f"""case when id % 13 = 0 then concat_ws(',', id, coalesce(goal, ''), {quoted}, 'EXTRA', '"a, b"')
        when id % 17 = 0 then concat_ws(',', id, coalesce(goal, '')) else concat_ws(',', id, coalesce(goal, ''), {quoted}) end"""
    path = _written_lines(spark, campaigns(spark, folder).selectExpr(line), "id,goal,desc", "lines-csv")
    good, rejected = sources.read_csv_checked(spark, path, types={"id": "bigint", "goal": "int"}, strict=True)
    accepted = good.select(F.lit("good").alias("reason"), F.lit(3).alias("n_fields"), F.concat_ws("|", "id", F.coalesce(F.col("goal").cast("string"), F.lit("")), "desc").alias("line"))
    return accepted.unionByName(rejected.select("reason", "n_fields", "line"))


@query
def inferred_types(spark, folder):
    """Narrowest types of the columns of CSV files, for all values and for nine tenths of them."""
    path = sources.scratch_path(spark, "typed-csv")
    columns = campaigns(spark, folder).select("id", "name", "goal", "launched_at", "backers_count", "disable_communication", "country").withColumn("launched_ms", F.expr("launched_at * 1000"))
    days = table(spark, folder, "orders").select(F.col("o_orderkey").alias("id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), (F.col("o_totalprice") + 0.5).alias("price"))
    times = F.when(F.col("id") % 5 == 0, F.col("day")).otherwise(F.concat_ws(" ", "day", F.lit("10:20:30")))
    sources.write_csv(columns.join(days, "id").withColumn("moment", times), path)
    raw = sources.read_csv(spark, path)
    tables = [infer.infer_types(raw, least_share=share).withColumn("least_share", F.lit(share)) for share in (1.0, 0.9)]
    return tables[0].union(tables[1]).drop("position").withColumn("share", F.round("share", 6))


@query
def parquet_refuse_existing(spark, folder):
    """A second write to the same path is refused and leaves the first in place."""
    path = sources.scratch_path(spark, "once")
    sources.write_parquet(table(spark, folder, "orders").select("o_orderkey", "o_totalprice"), path)
    try:
        sources.write_parquet(table(spark, folder, "customer"), path)
        refused = False
    except AnalysisException:
        refused = True
    return sources.read_parquet(spark, path).withColumn("refused", F.lit(refused))


# Cleaning


@query
def cast_records(spark, folder):
    return typed_campaigns(spark, folder).select("id", *prepare.TYPES)


@query
def pruned_columns(spark, folder):
    return clean.drop_columns(
        campaigns(spark, folder), prepare.NEAR_CONSTANT + prepare.KNOWN_AFTERWARDS
    )


@query
def sentinel_rows(spark, folder):
    return clean.rows_equal(campaigns(spark, folder), "country", "False").select("id", "country", "currency")


@query
def present_rows(spark, folder):
    return clean.rows_present(campaigns(spark, folder), "country").select("id", "country")


@query
def repaired_codes(spark, folder):
    codes = campaigns(spark, folder).select("id", "country", "currency")
    return clean.repair_codes(codes)


@query
def repaired_codes_short(spark, folder):
    codes = campaigns(spark, folder).select("id", "country", "currency")
    return clean.repair_codes(codes, rule="short")


@query
def code_lengths(spark, folder):
    """Rows by the lengths of their codes."""
    lengths = campaigns(spark, folder).select(
        F.length("country").alias("country_length"), F.length("currency").alias("currency_length")
    )
    return profile.value_counts(lengths, "country_length", "currency_length")


@query
def time_spans(spark, folder):
    return clean.add_spans(typed_campaigns(spark, folder), prepare.SPANS).select("id", *prepare.SPANS)


@query
def folded_columns(spark, folder):
    return clean.fold_columns(campaigns(spark, folder), prepare.TEXTS).select("id", *prepare.TEXTS)


@query
def joined_text(spark, folder):
    return clean.add_text(campaigns(spark, folder), prepare.TEXTS).select("id", "text")


@query
def filled_numbers(spark, folder):
    spans = clean.add_spans(typed_campaigns(spark, folder), prepare.SPANS)
    return clean.fill_missing(spans.select("id", *prepare.FILLED_NUMBERS), numbers=prepare.FILLED_NUMBERS)


@query
def filled_texts(spark, folder):
    codes = clean.repair_codes(campaigns(spark, folder).select("id", "country", "currency"))
    return clean.fill_missing(codes, texts=prepare.FILLED_TEXTS)


@query
def labelled_missing(spark, folder):
    codes = clean.repair_codes(campaigns(spark, folder).select("id", "country", "currency"))
    return clean.label_missing(codes, prepare.FILLED_TEXTS)


@query
def complete_rows(spark, folder):
    columns = ["keywords", "goal", "launched_at", "country"]
    return clean.drop_missing(typed_campaigns(spark, folder).select("id", *columns), columns)


@query
def prepared_records(spark, folder):
    return prepare.prepare_records(campaigns(spark, folder))


@query
def prepared_records_short_rule(spark, folder):
    return prepare.prepare_records(campaigns(spark, folder), code_rule="short").select(
        "id", "country2", "currency2", "days_campaign", "hours_prepa", "goal"
    )


# Profiling


@query
def row_count(spark, folder):
    return profile.row_count(campaigns(spark, folder))


@query
def summary_of_numbers(spark, folder):
    spans = clean.add_spans(typed_campaigns(spark, folder), prepare.SPANS)
    columns = ["goal", "backers_count", "final_status", "deadline", "launched_at", "days_campaign", "hours_prepa"]
    report = profile.summary(spans, columns)
    return report.withColumns({"mean": F.round("mean", 4), "stddev": F.round("stddev", 4)})


@query
def summary_of_texts(spark, folder):
    raw = campaigns(spark, folder)
    codes = clean.repair_codes(raw.select("goal", "country", "currency", "keywords"))
    report = profile.summary(codes, ["goal", "country2", "currency2", "keywords"])
    return report.withColumns({"mean": F.round("mean", 4), "stddev": F.round("stddev", 4)})


@query
def summary_of_parts(spark, folder):
    """The summary of a table that came in three parts, from the states that were stored with each."""
    path = sources.scratch_path(spark, "states")
    spans = clean.add_spans(typed_campaigns(spark, folder), prepare.SPANS)
    columns = ["goal", "backers_count", "final_status", "deadline", "launched_at", "days_campaign", "hours_prepa"]
    for part in range(3):
        states.add_state(states.summary_state(spans.where(F.col("id") % 3 == part), columns), path)
    report = states.merged_summary(states.read_states(spark, path))
    return report.withColumns({"mean": F.round("mean", 4), "stddev": F.round("stddev", 4)})


@query
def value_frequencies(spark, folder):
    return words.ranked(profile.value_counts(campaigns(spark, folder), "country"), "country")


@query
def pair_frequencies(spark, folder):
    return profile.top_counts(campaigns(spark, folder), ["country", "currency"], 50)


@query
def sentinel_currencies(spark, folder):
    """Currencies of the rows whose country is the sentinel."""
    rows = clean.rows_equal(campaigns(spark, folder), "country", "False")
    return profile.top_counts(rows, ["currency"], 50)


@query
def top_values(spark, folder):
    columns = ["disable_communication", "country", "currency", "state_changed_at", "backers_count"]
    return profile.top_values(typed_campaigns(spark, folder), columns, 100)


@query
def distinct_deadlines(spark, folder):
    return profile.distinct_values(campaigns(spark, folder), "deadline")


@query
def first_goals(spark, folder):
    return profile.first_rows(typed_campaigns(spark, folder).select("id", "goal", "final_status"), 30, "id")


# Text and category features in long form


def filtered_documents(docs: DataFrame) -> DataFrame:
    return terms.remove_stop_words(terms.add_tokens(docs), case_sensitive=True)


@query
def document_tokens(spark, folder):
    docs = terms.add_tokens(documents(spark, folder))
    return docs.select("doc_id", F.array_join("tokens", " ").alias("tokens"))


@query
def token_lengths(spark, folder):
    docs = filtered_documents(documents(spark, folder))
    counted = terms.count_tokens(terms.count_tokens(docs), "filtered", "n_filtered")
    return counted.select("doc_id", "n_tokens", "n_filtered")


@query
def filtered_tokens(spark, folder):
    docs = filtered_documents(documents(spark, folder))
    return docs.select("doc_id", F.array_join("filtered", " ").alias("filtered"))


@query
def term_frequencies(spark, folder):
    return terms.term_frequencies(filtered_documents(documents(spark, folder)), "doc_id")


@query
def vocabulary(spark, folder):
    return terms.vocabulary(filtered_documents(documents(spark, folder)))


@query
def vocabulary_min_df(spark, folder):
    """Terms of at least five documents."""
    return terms.vocabulary(filtered_documents(documents(spark, folder)), min_df=5)


@query
def vocabulary_by_share(spark, folder):
    """Terms of at least one percent of the documents, the 500 most frequent of them."""
    return terms.vocabulary(filtered_documents(documents(spark, folder)), min_df=0.01, max_terms=500)


@query
def term_weights(spark, folder):
    weights = terms.term_weights(filtered_documents(documents(spark, folder)), "doc_id")
    return weights.withColumn("tfidf", F.round("tfidf", 6))


@query
def label_index(spark, folder):
    return terms.label_index(campaigns(spark, folder), "deadline")


@query
def distinct_label_index(spark, folder):
    """Distinct pairs of label and index, from the rows that carry them."""
    codes = clean.fill_missing(clean.repair_codes(campaigns(spark, folder)), texts=prepare.FILLED_TEXTS)
    indexed = terms.index_rows(codes, "country2", terms.label_index(codes, "country2"), "country_indexed")
    return profile.distinct_rows(indexed, "country2", "country_indexed")


@query
def one_hot_entries(spark, folder):
    return terms.one_hot(terms.label_index(documents(spark, folder), "source"))


# Spark ML features


def ml_filtered(docs: DataFrame) -> DataFrame:
    for stage in training.token_stages(DOCUMENT_RECIPE):
        docs = stage.transform(docs)
    return docs.drop("text", "tokens")


def ml_token_table(docs: DataFrame) -> DataFrame:
    """Tokens of the Spark ML stages, written once because fitting and transforming both read them."""
    return sources.materialize(ml_filtered(docs), "tokens")


def _fitted_counter(docs: DataFrame, weighted: str | None = "features") -> tuple[DataFrame, DataFrame]:
    """The written term table, and the counts over its terms, written once.

    The Spark ML stage counts as many terms as the driver may hold, the most frequent ones; what further terms there are is joined from the table.
    Then ``firstFeatures`` holds the stage's vectors alone and ``weighted`` the counts weighted by the table.
    """
    known = vectorize.fit_term_table(docs)
    if known.count() > features.DRIVER_TERMS:
        first = None if weighted is None else "firstFeatures"
        kept = [c for c in docs.columns if c != "filtered"]
        return known, vectorize.add_term_vectors(docs, known, weighted=weighted, head=features.DRIVER_TERMS, first=first, keep=kept)
    counter = features.counter_of([row["term"] for row in features.ranked_terms(known).select("term").collect()])
    return known, sources.materialize(counter.transform(docs).drop("filtered"), "counted")


def _named(entries: DataFrame, known: DataFrame) -> DataFrame:
    """Entries with their terms. The most frequent terms, which most entries are of, are looked up without a shuffle."""
    often = F.col("position") < vectorize.HEAD_TERMS
    of = known.select("term", "position")
    if known.count() <= vectorize.HEAD_TERMS:
        return entries.join(F.broadcast(of), "position")
    return entries.where(often).join(F.broadcast(of.where(often)), "position").union(entries.where(~often).join(of.where(~often), "position"))


@query
def count_vectors(spark, folder):
    """Counts per document and term with the term's position, read out of the vectors of the Spark ML stage."""
    known, counted = _fitted_counter(ml_token_table(documents(spark, folder).select("doc_id", "text")))
    entries = features.vector_entries(counted, "doc_id", "rawFeatures", "tf")
    return _named(entries, known).select("doc_id", "term", F.col("position").cast("int").alias("position"), F.col("tf").cast("int").alias("tf"))


@query
def idf_vectors(spark, folder):
    known, counted = _fitted_counter(ml_token_table(documents(spark, folder).select("doc_id", "text")))
    if "firstFeatures" not in counted.columns:
        weighted = features.idf().fit(counted).transform(counted)
        entries = features.vector_entries(weighted, "doc_id", "features", "tfidf")
    else:
        stage = features.idf("firstFeatures", "weighted")
        entries = features.vector_entries(stage.fit(counted).transform(counted), "doc_id", "weighted", "tfidf")
        rest = features.vector_entries(counted, "doc_id", "features", "tfidf").where(F.col("position") >= features.DRIVER_TERMS)
        entries = entries.union(rest)
    return _named(entries, known).select("doc_id", "term", F.round("tfidf", 6).alias("tfidf"))


@query
def term_table_vectors(spark, folder):
    """Counts and weights per document and term, read out of the vectors that are made from tables."""
    docs = ml_token_table(documents(spark, folder).select("doc_id", "text"))
    known = vectorize.fit_term_table(docs)
    made = vectorize.add_term_vectors(docs, known)
    counts, weights = (made.select("doc_id", F.unwrap_udt(F.col(c)).alias(name)) for c, name in (("rawFeatures", "tf"), ("features", "tfidf")))
    # Both vectors of a document are joined whole. Those of one row have the same places; a repeated doc_id also pairs the vectors of different rows.
    both = counts.join(weights, "doc_id")
    zipped = F.arrays_zip(F.col("tf.indices").alias("position"), F.col("tf.values").alias("tf"), F.col("tfidf.values").alias("tfidf"))
    place = F.array_position(F.col("tfidf.indices"), F.col("position"))
    same = both.where(F.col("tf.indices") == F.col("tfidf.indices")).select("doc_id", F.inline(zipped))
    other = both.where(F.col("tf.indices") != F.col("tfidf.indices")).select("doc_id", "tfidf", F.inline(F.arrays_zip(F.col("tf.indices").alias("position"), F.col("tf.values").alias("n"))))
    crossed = other.where(place > 0).select("doc_id", "position", F.col("n").alias("tf"), F.element_at(F.col("tfidf.values"), place.cast("int")).alias("tfidf"))
    return _named(same.union(crossed), known).select(
        "doc_id", "term", F.col("position").cast("int").alias("position"), F.col("tf").cast("int").alias("tf"), F.round("tfidf", 6).alias("tfidf")
    )


@query
def term_table_agreement(spark, folder):
    """Documents whose vectors from tables are not those of the count vectorizer."""
    docs = ml_token_table(documents(spark, folder).select("doc_id", "text"))
    known, counted = _fitted_counter(docs, None)
    made = vectorize.add_term_vectors(docs, known, weighted=None, head=0, keep=["doc_id"]).select("doc_id", F.unwrap_udt(F.col("rawFeatures")).alias("a"))
    return made.join(counted.select("doc_id", F.unwrap_udt(F.col("rawFeatures")).alias("b")), "doc_id").agg(
        F.count(F.lit(1)).alias("n_documents"), F.sum(F.size("a.indices")).alias("n_entries"), F.count_if(~F.col("a").eqNullSafe(F.col("b"))).alias("n_different")
    )


@query
def hashed_term_vectors(spark, folder):
    """Number of buckets, and counted terms of each document, whatever buckets they fell into."""
    docs = ml_filtered(documents(spark, folder).select("doc_id", "text"))
    hashed = features.hashing_tf().transform(docs)
    values = F.unwrap_udt(F.col("rawFeatures"))
    return hashed.select(
        "doc_id",
        values["size"].alias("n_buckets"),
        F.aggregate(values["values"], F.lit(0.0), lambda total, v: total + v).cast("bigint").alias("n_terms"),
    )


@query
def hashed_term_buckets(spark, folder):
    """Counted terms of all documents, and buckets whose count is not that of the terms which hash there one by one."""
    docs = ml_token_table(documents(spark, folder).select("doc_id", "text"))
    hashing = features.hashing_tf()
    entries = features.vector_entries(hashing.transform(docs), "doc_id", "rawFeatures", "found")
    counted = terms.term_frequencies(docs, "doc_id")
    # Each counted term is hashed alone where it stands, which needs no join by term.
    alone = counted.select(F.struct("doc_id", "tf").alias("posting"), F.array("term").alias("filtered"))
    buckets = features.vector_entries(hashing.transform(alone), "posting", "rawFeatures")
    wanted = buckets.groupBy("posting.doc_id", "position").agg(F.sum("posting.tf").alias("tf"))
    return entries.join(wanted, ["doc_id", "position"], "full").agg(
        F.sum("found").cast("bigint").alias("n_terms"),
        F.count_if(~F.col("found").eqNullSafe(F.col("tf").cast("double"))).alias("n_different"),
        F.count_if(~F.col("position").between(0, features.HASH_BUCKETS - 1)).alias("n_outside"),
    )


@query
def string_indexer(spark, folder):
    docs = documents(spark, folder).select("lang", "source")
    features.check_labels(docs, ["lang", "source"])
    model = features.string_indexer(["lang", "source"], ["lang_indexed", "source_indexed"]).fit(docs)
    return profile.distinct_rows(model.transform(docs), "lang", "lang_indexed", "source", "source_indexed")


@query
def one_hot_vectors(spark, folder):
    docs = documents(spark, folder).select("doc_id", "lang", "source")
    features.check_labels(docs, ["lang", "source"])
    chain = [
        features.string_indexer(["lang", "source"], ["lang_indexed", "source_indexed"]),
        features.one_hot_encoder(["lang_indexed", "source_indexed"], ["lang_onehot", "source_onehot"]),
    ]
    encoded = Pipeline(stages=chain).fit(docs).transform(docs)
    return encoded.select(
        "doc_id",
        F.array_position(vector_to_array("lang_onehot"), 1.0).alias("lang_position"),
        F.array_position(vector_to_array("source_onehot"), 1.0).alias("source_position"),
        F.unwrap_udt(F.col("source_onehot"))["size"].alias("source_size"),
    )


@query
def assembled_vectors(spark, folder):
    """Size of each assembled vector and number of its entries."""
    docs = documents(spark, folder).withColumn("quality", F.lit(0))
    rows = ml_token_table(training.training_input(docs, DOCUMENT_RECIPE))
    featurize = training.fit_features(rows, DOCUMENT_RECIPE)
    vector = F.unwrap_udt(F.col("join_features"))
    return featurize.transform(rows).select(
        "doc_id",
        F.coalesce(vector["size"], F.size(vector["values"])).alias("vector_size"),
        F.size(F.filter(vector["values"], lambda v: v != 0)).alias("n_entries"),
    )


@query
def assembled_slots(spark, folder):
    """Entries of the assembled vectors, and those that are not the parts' entries at the parts' places."""
    docs = documents(spark, folder).withColumn("quality", F.lit(0))
    rows = ml_token_table(training.training_input(docs, DOCUMENT_RECIPE))
    made = training.fit_features(rows, DOCUMENT_RECIPE).transform(rows)
    parts = ["features", *DOCUMENT_RECIPE.encoded]
    sizes = made.select(*[vectorize.entries_of(F.unwrap_udt(F.col(name)))[0].alias(name) for name in parts]).first() or dict.fromkeys(parts, 0)
    # A row whose id is its own is compared where it stands; repeated ids, each of whose rows meets all others, and null ones entry by entry.
    repeated = sources.materialize(rows.groupBy("doc_id").count().where("count > 1 and doc_id is not null").select("doc_id"), "repeated")
    alone = made.where("doc_id is not null").join(repeated, "doc_id", "left_anti")
    again = made.where("doc_id is null").unionByName(made.join(repeated, "doc_id", "left_semi"))
    return _compared_rows(alone, sizes).union(_compared_entries(again, sizes)).agg(
        F.coalesce(F.sum("n_entries"), F.lit(0)).alias("n_entries"), F.coalesce(F.sum("n_different"), F.lit(0)).alias("n_different")
    )


def _entries(vector: Column, start: int = 0) -> Column:
    """``position, value`` of a vector's stored form but for zeros, from place ``start`` on."""
    _, places, values = vectorize.entries_of(vector)
    zipped = F.arrays_zip(places.alias("position"), values.alias("value"))
    return F.transform(F.filter(zipped, lambda e: e["value"] != 0), lambda e: F.struct((e["position"] + F.lit(start)).alias("position"), e["value"].alias("value")))


def _compared_rows(made: DataFrame, sizes) -> DataFrame:
    number = F.array(F.struct(F.lit(sizes["features"]).alias("position"), F.col("n_chars").alias("value")))
    parts, start = [_entries(F.unwrap_udt(F.col("features"))), F.filter(number, lambda e: e["value"] != 0)], sizes["features"] + 1
    for name in DOCUMENT_RECIPE.encoded:
        parts.append(_entries(F.unwrap_udt(F.col(name)), start))
        start += sizes[name]
    both = made.select(_entries(F.unwrap_udt(F.col("join_features"))).alias("found"), F.concat(*parts).alias("wanted"))
    places = F.size(F.array_union("found.position", "wanted.position"))
    different = F.when(F.col("found") == F.col("wanted"), 0).otherwise(places - F.size(F.array_intersect("found", "wanted")))
    return both.agg(F.sum(F.size("found")).alias("n_entries"), F.sum(different).alias("n_different"))


def _compared_entries(made: DataFrame, sizes) -> DataFrame:
    number = made.select("doc_id", F.lit(sizes["features"]).alias("position"), F.col("n_chars").alias("value"))
    wanted, start = features.vector_entries(made, "doc_id", "features").union(number), sizes["features"] + 1
    for name in DOCUMENT_RECIPE.encoded:
        part = features.vector_entries(made, "doc_id", name)
        wanted = wanted.union(part.withColumn("position", F.col("position") + start))
        start += sizes[name]
    found = features.vector_entries(made, "doc_id", "join_features", "found").where("found <> 0")
    both = found.join(wanted.where("value <> 0"), ["doc_id", "position"], "full")
    return both.agg(
        F.count("found").alias("n_entries"),
        F.count_if(~F.col("found").eqNullSafe(F.col("value"))).alias("n_different"),
    )


# Splits, scores, training


@query
def split_sizes(spark, folder):
    docs = documents(spark, folder).select("doc_id")
    first, second = split.split_by_hash(docs, "doc_id", 0.9)
    return first.withColumn("part", F.lit("train")).union(second.withColumn("part", F.lit("test")))


@query
def random_split_union(spark, folder):
    """Both parts of the random split together, which are the table again."""
    train, test = split.split_at_random(table(spark, folder, "orders").select("o_orderkey", "o_orderstatus"))
    return train.union(test)


@query
def random_split_shares(spark, folder):
    """Rows and distinct ids of both parts of the random split, and whether the first has its share."""
    train, test = split.split_at_random(table(spark, folder, "orders").select("o_orderkey"))
    parts = train.withColumn("first", F.lit(1)).union(test.withColumn("first", F.lit(0)))
    return parts.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("o_orderkey").alias("n_ids"),
        F.avg("first").between(0.88, 0.92).alias("near_share"),
    )


@query
def confusion_counts(spark, folder):
    return evaluate.confusion(table(spark, folder, "labels"), "quality", "toxic")


@query
def weighted_f1(spark, folder):
    scores = evaluate.weighted_f1(table(spark, folder, "labels"), "quality", "toxic")
    return scores.withColumn("f1", F.round("f1", 9))


@query
def threshold_decisions(spark, folder):
    rows = campaigns(spark, folder).select("id", (F.col("backers_count") / 500).alias("p1"))
    return rows.withColumn("predictions", evaluate.threshold_decision(F.col("p1")))


def document_parts(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    rows = training.training_input(labelled(spark, folder), DOCUMENT_RECIPE)
    return split.split_by_hash(rows, "doc_id", 0.9)


@query
def heldout_scores(spark, folder):
    """Train on nine tenths of the labelled documents, score the rest, and check each row's probability and class."""
    train, test = document_parts(spark, folder)
    scored = training.score(training.fit(train, DOCUMENT_RECIPE), test)
    p1 = vector_to_array("probability")[1]
    return scored.select(
        "doc_id", "quality", p1.between(0, 1).alias("p1_in_range"), (F.col("predictions") == F.when(p1 > 0.3, 1).otherwise(0)).alias("by_threshold")
    )


@query
def heldout_f1(spark, folder):
    """Held-out rows of the models over all features and over text alone, and whether both forms of their F1 agree."""
    train, test = document_parts(spark, folder)
    columns = ("join_features", "features")
    reports = []
    for column, model in zip(columns, training.fit_each(train, DOCUMENT_RECIPE, columns), strict=True):
        scored = training.score(model, test)
        reports.append(_f1_report(scored, "quality").withColumn("features", F.lit(column)))
    return reports[0].union(reports[1])


def _f1_report(scored: DataFrame, label: str) -> DataFrame:
    """``n_rows``, and whether the F1 of the confusion table is in range and that of Spark's evaluator."""
    pairs = scored.groupBy(F.col(label).cast("double").alias(label), "predictions").agg(F.count(F.lit(1)).alias("rows"))
    return _f1_of_pairs(sources.materialize(pairs, "confusion"), label)


def _f1_of_pairs(pairs: DataFrame, label: str) -> DataFrame:
    f1 = evaluate.f1_evaluator(label).setWeightCol("rows").evaluate(pairs)
    report = evaluate.weighted_f1(pairs, label, count="rows")
    return report.select("n_rows", (F.col("f1").between(0, 1) & (F.abs(F.col("f1") - f1) < 1e-9)).alias("f1_agrees"))


@query
def heldout_threshold_agreement(spark, folder):
    """Held-out rows whose prediction differs from the threshold rule on the model's probability."""
    train, test = document_parts(spark, folder)
    scored = training.score(training.fit(train, DOCUMENT_RECIPE), test)
    rule = evaluate.threshold_decision(vector_to_array("probability")[1], DOCUMENT_RECIPE.thresholds)
    return scored.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("predictions") != rule).alias("n_different"),
    )


@query
def saved_model_agreement(spark, folder):
    """Held-out rows that a saved and reloaded model scores differently."""
    train, test = document_parts(spark, folder)
    model = training.fit(train, DOCUMENT_RECIPE)
    path = sources.scratch_path(spark, "model")
    training.save_model(model, path)
    again = training.load_model(path)
    scored = training.score(model, test).select("doc_id", "predictions")
    rescored = training.score(again, test).select("doc_id", F.col("predictions").alias("again"))
    both = scored.join(rescored, "doc_id")
    return both.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("predictions") != F.col("again")).alias("n_different"),
    )


@query
def grid_report(spark, folder):
    """Rows and terms behind every grid point, and whether one point, the best, was chosen."""
    train, _ = document_parts(spark, folder)
    tuned = training.tune(train, DOCUMENT_RECIPE, "doc_id", min_dfs=DOCUMENT_MIN_DFS)
    grid = Window.partitionBy(F.lit(1))  # one row for each grid point
    return tuned.report(spark).select(
        "min_df",
        "reg_param",
        "n_fit",
        "n_check",
        "n_terms",
        F.col("f1").between(0, 1).alias("f1_in_range"),
        (F.count_if("chosen").over(grid) == 1).alias("one_chosen"),
        (F.max(F.when(F.col("chosen"), F.col("f1"))).over(grid) == F.max("f1").over(grid)).alias("best_chosen"),
    )


@query
def resumed_search(spark, folder):
    """A search that finds half of its points in the journal of an earlier one: which it took from there, and its terms."""
    train, _ = document_parts(spark, folder)
    path, smaller = sources.scratch_path(spark, "journal"), DOCUMENT_MIN_DFS[1:2]
    tokens = training.token_rows(train, DOCUMENT_RECIPE)
    search = {"reg_params": training.GRID_REG_PARAMS[1:3], "journal": path, "tokens": tokens}
    first = training.tune(train, DOCUMENT_RECIPE, "doc_id", min_dfs=smaller, **search)
    again = training.tune(train, DOCUMENT_RECIPE, "doc_id", min_dfs=DOCUMENT_MIN_DFS[1:], **search)
    rows = [(m, r, (m, r) in again.reused, (m, r, f1) in first.scores or (m, r) not in again.reused) for m, r, f1 in again.scores]
    points = spark.createDataFrame(rows, "min_df double, reg_param double, reused boolean, same_f1 boolean")
    return again.report(spark).select("min_df", "reg_param", "n_fit", "n_check", "n_terms").join(points, ["min_df", "reg_param"])


@query
def posting_scores(spark, folder):
    """Held-out rows whose probability from a table of weights is not that of the model's vectors."""
    train, test = document_parts(spark, folder)
    model = training.fit(train, DOCUMENT_RECIPE)
    weights, intercept = linear.weight_table(spark, model, DOCUMENT_RECIPE)
    found = linear.score_by_weights(test, weights, intercept, DOCUMENT_RECIPE).select("doc_id", "p1", F.col("predictions").alias("found"))
    wanted = training.score(model, test).select("doc_id", vector_to_array("probability")[1].alias("p"), "predictions")
    return found.join(wanted, "doc_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.abs(F.col("p1") - F.col("p")) > 1e-9).alias("n_different"),
        F.count_if(F.col("found") != F.col("predictions")).alias("n_other_class"),
    )


@query
def plain_stages_agreement(spark, folder):
    """Held-out rows that the plain Spark stages, fitted in one pipeline, score differently."""
    train, test = document_parts(spark, folder)
    recipe = replace(DOCUMENT_RECIPE, reg_param=0.01)
    p1 = vector_to_array("probability")[1]
    plain = Pipeline(stages=training.classification_stages(recipe)).fit(train).transform(test)
    scored = training.score(training.fit(train, recipe), test).select("doc_id", p1.alias("p"))
    return scored.join(plain.select("doc_id", p1.alias("q")), "doc_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.abs(F.col("p") - F.col("q")) > 1e-4).alias("n_different")
    )


# The whole chain: prepared records, trained, tuned, saved, scored

CAMPAIGN_RECIPE = training.Recipe(keep=("id",))


def campaign_parts(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    records = prepare.prepare_records(campaigns(spark, folder))
    return split.split_by_hash(training.training_input(records, CAMPAIGN_RECIPE), "id", 0.9)


@query
def country_rates(spark, folder):
    """Fitted probability of each country from the country alone, which without a penalty is its share of label 1."""
    recipe = training.Recipe(categories=("country2",), numbers=(), features="country_onehot", tol=1e-9)
    rows = prepare.prepare_records(campaigns(spark, folder)).select("country2", "final_status")
    chain = Pipeline(stages=[*training.category_stages(recipe), training.classifier(recipe)])
    p1 = vector_to_array("probability")[1]
    return chain.fit(rows).transform(rows).groupBy("country2").agg(F.round(F.max(p1), 4).alias("p1"))


@query
def campaign_calibration(spark, folder):
    """Rows of both parts, and the mean probability over the training rows, which with an intercept is their label's mean."""
    train, test = campaign_parts(spark, folder)
    scored = training.score(training.fit(train, CAMPAIGN_RECIPE), train)
    mean = scored.agg(F.count(F.lit(1)).alias("n_train"), F.round(F.avg(vector_to_array("probability")[1]), 4).alias("mean_p1"))
    return mean.join(test.agg(F.count(F.lit(1)).alias("n_test")))


@query
def campaign_models(spark, folder):
    """Held-out records by model and label, and how many of them are as they should be.

    The simple model over all features and over text alone: class by the thresholds. The tuned model: the same.
    The tuned model saved and loaded: the class that the tuned model gave.
    """
    train, test = campaign_parts(spark, folder)
    tokens = training.token_rows(train, CAMPAIGN_RECIPE)
    simple, text = training.fit_each(train, CAMPAIGN_RECIPE, ("join_features", "features"), tokens=tokens)
    tuned = training.tune(train, CAMPAIGN_RECIPE, "id", tokens=tokens).model
    path = sources.scratch_path(spark, "tuned")
    training.save_model(tuned, path)
    rule = evaluate.threshold_decision(vector_to_array("probability")[1], CAMPAIGN_RECIPE.thresholds)
    scored = {
        name: training.score(model, test).select("id", "final_status", "predictions", (F.col("predictions") == rule).alias("right"))
        for name, model in (("simple", simple), ("text", text), ("tuned", tuned))
    }
    scored["tuned"] = sources.materialize(scored["tuned"], "scored")
    before = scored["tuned"].select("id", F.col("predictions").alias("before"))
    again = training.score(training.load_tuned(path), test).select("id", "final_status", "predictions").join(before, "id")
    scored["reloaded"] = again.withColumn("right", F.col("predictions") == F.col("before"))
    reports = [_by_label(rows, name) for name, rows in scored.items()]
    return reports[0].union(reports[1]).union(reports[2]).union(reports[3])


def _by_label(scored: DataFrame, name: str) -> DataFrame:
    """Rows by label, and how many are right; the F1 of the table must be that of Spark's evaluator. All from one confusion table."""
    keys = F.col("final_status"), F.col("predictions"), F.col("right")
    pairs = sources.materialize(scored.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")), "confusion")
    agrees = _f1_of_pairs(pairs.withColumn("final_status", F.col("final_status").cast("double")), "final_status").select("f1_agrees")
    right = F.coalesce(F.sum(F.when(F.col("right"), F.col("rows"))), F.lit(0))
    by_label = pairs.groupBy("final_status").agg(F.sum("rows").alias("n_rows"), right.alias("n_right"))
    return by_label.join(F.broadcast(agrees)).select(F.lit(name).alias("model"), "*")  # one row
