"""Each operator against brute force on the small tables, and on awkward rows."""

import base64
import collections
import functools
import hashlib
import math
import os
import re
import struct
import tracemalloc
import zlib
from fractions import Fraction

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from recordlens.llm import bpe_matrix, chat_tree, hashing, impact_topk, importance, packing, pigeonhole, queries, superminhash, token_blocks, toxicity, url_rules, vocabularies
from recordlens.llm.common import components
from recordlens.llm.vocabularies import Encoder, public_path

LONG = "longword" * 2000 + " " + "the cat sat on it. " * 3000
ODD_TEXTS = [None, "", " \n", "one", "One  two", "a b c d e f", "A b\tc d\ne f", LONG, LONG, "it's 12,5 ***x*** ΑΣ é 漢字\u3000 y", "</turn> ### \\"]
SCHEMA = "doc_id long, TEXT_ string, text string, Severity string, set string, key string, place string"


def odd_docs(spark, texts=ODD_TEXTS):
    rows = [(i if i != 3 else None, "x", t, "s", "s", "k", "p") for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, rows[-1]], SCHEMA)


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def table(folder, name):
    return duckdb.sql(f"select * from '{folder}/{name}.parquet'").df()


def words_of(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lowered)


def shingle_set(text, k):
    w = words_of(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)])


def brute_components(texts, k, percent):
    """texts: by id. The least id reachable over links of similar sets."""
    sets = {i: shingle_set(t, k) for i, t in texts.items()}
    parent = {i: i for i in sets}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holders = collections.defaultdict(list)
    for i, s in sets.items():
        for g in s:
            holders[g].append(i)
    common = collections.Counter(p for v in holders.values() for p in [(a, b) for x, b in enumerate(v) for a in v[:x]])
    for (a, b), n in common.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            x, y = top(a), top(b)
            parent[max(x, y)] = min(x, y)
    return sets, {i: top(i) for i in sets}


@pytest.mark.parametrize("name", [*queries.ORACLES])
def test_query_equals_its_sql(spark, small, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "conversations", "labels"):
        con.sql(f"create view {t} as select * from '{small}/{t}.parquet'")
    found, wanted = queries.QUERIES[name](spark, small).toPandas(), con.sql(queries.ORACLES[name]).df()
    columns = sorted(wanted.columns)
    assert sorted(found.columns) == columns
    as_text = lambda f: f[columns].convert_dtypes().astype(str).replace({"None": "nan"}).sort_values(columns).reset_index(drop=True)
    assert as_text(found).equals(as_text(wanted))


def test_components_of_chains_and_stars(spark):
    edges = [(i + 1, i) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(7, 7), (200, 201), (201, 200)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 130)} | {200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# toxicity


def test_toxicity_tells_held_out_documents_apart(spark, medium):
    labels = table(medium, "labels")
    found = queries.op1_toxicity(spark, medium).toPandas()
    assert len(found) == len(table(medium, "documents"))
    both = found.merge(labels, on="doc_id", suffixes=("_found", ""))
    assert ((both["toxic_found"] == (both["toxic"] == 1)).mean()) > 0.97
    large = medium.replace("sf0.01", "sf0.1")
    docs, flags = spark.read.parquet(f"{large}/documents.parquet"), spark.read.parquet(f"{large}/labels.parquet")
    held = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(3)) == 0
    model = toxicity.model_of_flags(docs, flags.where(~held))
    rest = toxicity.score(docs.join(flags.where(held), "doc_id"), model).toPandas()
    assert ((rest["severity"] >= 0.5) == (rest["toxic"] == 1)).mean() > 0.97


def test_ordinal_fit_orders_grades():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 2, (3000, 3)).astype(float)
    score = 3 * x[:, 0] - 2 * x[:, 1] + rng.logistic(size=3000)
    grades = np.digitize(score, [0.0, 1.5])
    rows, columns = np.nonzero(x)
    w, cuts = toxicity.fit_ordinal(rows, columns, x[rows, columns], grades, 3, 3)
    assert abs(w[0] - 3) < 0.4 and abs(w[1] + 2) < 0.4 and abs(w[2]) < 0.3
    assert cuts[0] < cuts[1] and abs(cuts[0]) < 0.3 and abs(cuts[1] - 1.5) < 0.3


def test_severity_is_that_of_the_weights(spark, medium):
    docs, flags = spark.read.parquet(f"{medium}/documents.parquet"), spark.read.parquet(f"{medium}/labels.parquet")
    model = toxicity.model_of_flags(docs, flags)
    assert model.weights and model.thresholds == sorted(model.thresholds) and len(model.thresholds) == 2
    for r in toxicity.score(docs.select("doc_id", "text"), model).collect():
        words = re.findall(r"[^\W\d_]+", (r["text"] or "").lower())
        counts = collections.Counter(words) + collections.Counter(f"^{w[:k]}" for w in words for k in range(4, 9) if len(w) > k)
        score = sum(model.weights.get(f, 0.0) * (1 + math.log(n)) for f, n in counts.items())
        assert abs(r["severity"] - sum(1 / (1 + math.exp(t - score)) for t in model.thresholds)) < 1e-9


def test_ordinal_fit_is_near_the_greatest_likelihood():
    rng = np.random.default_rng(19)
    x = rng.integers(0, 2, (500, 4)).astype(float)
    grades = np.digitize(x @ [2.0, -1.0, 0.5, 0.0] + rng.logistic(size=500), [0.0, 1.0])
    rows, columns = np.nonzero(x)
    w, cuts = toxicity.fit_ordinal(rows, columns, x[rows, columns], grades, 4, 3, steps=3000)

    def likelihood(w, cuts):
        above = 1 / (1 + np.exp(-((x @ w)[:, None] - cuts)))
        full = np.column_stack([np.ones(500), above, np.zeros(500)])
        return np.log(full[np.arange(500), grades] - full[np.arange(500), grades + 1]).mean() - toxicity.PENALTY * (w**2).sum() / 2

    best = likelihood(w, cuts)
    for step in rng.normal(size=(200, 6)) * 0.05:
        assert likelihood(w + step[:4], cuts + step[4:]) <= best + 1e-6


def test_the_least_text_of_a_labelled_id_counts(spark):
    docs = spark.createDataFrame([(1, "b"), (1, "a"), (1, "c"), (2, None), (2, "x"), (3, "y")], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, 0)], "doc_id long, grade int")
    assert sorted(map(tuple, toxicity.graded_sample(docs, labels).collect())) == [(1, "a", 1), (2, "", 0)]


def test_toxicity_of_odd_rows(spark):
    docs = odd_docs(spark)
    labels = spark.createDataFrame([(0, 0), (5, 1), (6, 0), (None, 1), (99, 1)], "doc_id long, toxic int")
    scored = toxicity.score(docs, toxicity.model_of_flags(docs, labels)).toPandas()
    assert len(scored) == 12 and scored["severity"].notna().all() and list(scored.columns) == [c for c in docs.columns if c != "Severity"] + ["severity"]
    none = toxicity.model_of_flags(docs, labels.where("doc_id < 0"))
    assert toxicity.score(docs, none).where("severity <> 0").count() == 0
    assert toxicity.score(empty_docs(spark), none).count() == 0


# token files


@pytest.mark.parametrize("n", [0, 1, 511, 512, 513, 3000])
@pytest.mark.parametrize("top", [1, 2, 300, 49_000, 1 << 31])
def test_blocks_round_trip(n, top):
    rng = np.random.default_rng(n + top)
    ids = rng.integers(0, top, n).astype("<u4")
    ids[rng.random(n) < 0.03] = top * 3 // 2
    file = token_blocks.TokenFile(token_blocks.encode_file([5, None], [ids[: n // 2].tobytes(), ids[n // 2 :].tobytes()]))
    assert file.doc_ids == [5, None] and (file.ids(0, n) == ids).all()
    assert (file.ids(n // 3, n // 2) == ids[n // 3 : n // 2]).all()


def brute_tokens(rows, path, end):
    tokenizer = Tokenizer.from_file(path)
    return [(i, np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, end], "<u4")) for i, t in rows]


def test_packing_a_full_file_of_token_blocks_takes_little_memory_beside_its_ids():
    ids = (np.random.default_rng(3).zipf(1.3, 1_500_100) % 49_000).astype("<u4")
    tracemalloc.start()
    blocks, starts = token_blocks.encode_ids(ids)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 3 * ids.nbytes  # 10 times, when all blocks were taken apart at once
    sizes = [token_blocks.BLOCK] * (len(blocks) - 1) + [len(ids) % token_blocks.BLOCK]
    assert (np.concatenate([token_blocks.decode_block(b, n) for b, n in zip(blocks, sizes, strict=True)]) == ids).all()
    assert starts.tolist() == [0, *np.cumsum([len(b) for b in blocks])[:-1].tolist()]


def test_token_files_equal_brute_force(spark, small):
    docs = table(small, "documents").sort_values("doc_id")
    wanted, start = [], 0
    for i, ids in brute_tokens(zip(docs["doc_id"], docs["text"], strict=True), public_path("word_bpe_49k.json"), 1):
        wanted.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    found = [tuple(r) for r in queries.op2_token_blocks(spark, small).orderBy("doc_id").collect()]
    assert found == wanted


def test_token_files_of_odd_rows(spark):
    path = public_path("word_bpe_49k.json")
    docs = odd_docs(spark)
    found = token_blocks.token_files(spark, docs, path, 1).toPandas().sort_values("start")
    assert found["doc_id"].isna().tolist() == [True] + [False] * 11  # null first
    assert found["doc_id"].dropna().is_monotonic_increasing
    assert found["start"].tolist() == [0, *np.cumsum(found["n_tokens"])[:-1]]
    wanted = collections.Counter(ids.tobytes() for _, ids in brute_tokens([(0, r["text"]) for r in docs.collect()], path, 1))
    assert collections.Counter(found["ids"]) == wanted
    assert token_blocks.token_files(spark, empty_docs(spark), path, 1).count() == 0


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
@pytest.mark.parametrize("slice_bytes", [vocabularies.SLICE, 100])
def test_chunks_give_the_library_ids(name, slice_bytes, monkeypatch):
    encoder, rng = Encoder(public_path(name)), np.random.default_rng(1)
    texts = ["".join(rng.choice(list("aeitnrs HÉß漢 !1\n\t',.\u3000\x1cΣ́"), rng.integers(0, 60))) for _ in range(800)]
    texts += [t or "" for t in ODD_TEXTS] + ["<|endoftext|> <|startoftext|>x", "don't.\n\nab,,  .. $$"]
    texts += ["".join(rng.choice(list("atsréßÀÿ×÷ı€’'._-!<(3 \u0301\u0338"), rng.integers(0, 40))) for _ in range(2000)]
    monkeypatch.setattr(vocabularies, "SLICE", slice_bytes)
    for _ in range(2):  # again from memory
        ids, offsets = encoder(pa.array([None, *texts, None]))
        assert offsets[0] == offsets[1] == 0 and offsets[-1] == offsets[-2] == len(ids)
        for text, a, b in zip(texts, offsets[1:], offsets[2:], strict=False):
            assert ids[a:b].tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids
    assert len(encoder(pa.array([], pa.string()))[0]) == 0


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
@pytest.mark.parametrize("slice_bytes", [vocabularies.SLICE, 100])
def test_added_tokens_have_the_library_ids(name, slice_bytes, monkeypatch):
    encoder, library, rng = Encoder(public_path(name)), Tokenizer.from_file(public_path(name)), np.random.default_rng(2)
    # Parts of a token meet across texts, too.
    parts = ["<|endoftext|>", "<|startoftext|>", "<|endoftext", "|>", "<|ENDOFTEXT|>", "a", "É", "'s", " ", "\n", "\u3000", "\u0338", "<", "1"]
    texts = ["a<|endoftext|>b", "<|endo", "ftext|>", "".join(parts)] + ["".join(rng.choice(parts, rng.integers(0, 12))) for _ in range(3000)]
    monkeypatch.setattr(vocabularies, "SLICE", slice_bytes)
    ids, offsets = encoder(pa.array(texts))
    for text, a, b in zip(texts, offsets, offsets[1:], strict=False):
        assert ids[a:b].tolist() == library.encode(text, add_special_tokens=False).ids
    assert ids[:3].tolist() == {"byte_bpe_50k.json": [64, 50256, 65], "word_bpe_49k.json": [320, 49407, 321]}[name]


# url rules


def brute_rule(url, rules):
    rest = (url or "").partition("://")[2] if "://" in (url or "") else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(h + p, v) for h, p, v in rules if h and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, key=lambda f: len(f[0]), default=(None, "allow"))
    return host, path, *best


def test_url_rules_of_many_nested_rules(spark):
    rng = np.random.default_rng(2)
    labels = ["a", "b", "ab", "a-b", "com", "é"]
    hosts = [".".join(rng.choice(labels, rng.integers(1, 5))) for _ in range(300)]
    paths = ["", "/", "/a", "/a/", "/a/b/", "/b"]
    rules = list({(h, p): (h, p, v) for h, p, v in zip(hosts[:80], rng.choice(paths, 80), rng.choice(["allow", "block"], 80), strict=True)}.values())
    # Lengths differ where two rules can both fit only if their texts do, so leave equal lengths out.
    urls = [None, "", "no scheme", "x://", "http://", "HTTP://A.Com/a/b?x", "http://com#f", "http://a.com\n/x"] + [f"http://{h}{p}{q}" for h, p, q in zip(hosts, rng.choice(paths, 300), rng.choice(["", "?a", "#b", "x/y"], 300), strict=True)]
    urls += ["http://a.b.com/a/"] * 2000
    df = spark.createDataFrame([(i, u, "x", 1, 2) for i, u in enumerate(urls)], "page_id long, url string, host string, key int, range int")
    found = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_rules.judge(df, spark.createDataFrame([*rules, (None, "/", "block"), ("", "", "block")], "host string, path string, verdict string")).collect()}
    for i, u in enumerate(urls):
        wanted = brute_rule(u, rules)
        if found[i] != wanted:  # several rules of the greatest length
            assert found[i][:2] == wanted[:2] and len(found[i][2]) == len(wanted[2])
    same = spark.createDataFrame([(i, "http://a.b.com/a/") for i in range(3000)], "page_id long, url string")
    judged = url_rules.judge(same, spark.createDataFrame(rules, "host string, path string, verdict string"))
    sizes = [r["count"] for r in judged.groupBy(F.spark_partition_id()).count().collect()]
    assert judged.select("verdict", "rule").distinct().count() == 1 and sum(sizes) == 3000 and max(sizes) < 1500
    none = spark.createDataFrame([], "host string, path string, verdict string")
    assert url_rules.judge(df, none).where("verdict <> 'allow' or rule is not null").count() == 0
    assert url_rules.judge(df.limit(0), none).count() == 0


# chat trees


def brute_digest(turns):
    text = lambda x: x or ""
    all_ = "".join(f"{text(r)}\n{text(t)}\n" for r, t in turns)
    loss = "".join(text(t) for r, t in turns if r == "assistant")
    return (len(turns), hashlib.sha256(all_.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_trees_share_nodes_and_read_back(spark):
    talks = {1: ["a", "b", "c"], 2: ["a", "b", "d"], 3: ["a", "b"], 4: ["x"], 5: ["a", "b", "c"], 6: ["a", "e", "\\### Assistant: </turn> ok"]}
    roles = ["user", "assistant", "assistant"]
    rows = [(c, i, roles[i], t) for c, ts in talks.items() for i, t in enumerate(ts)]
    rows += [(None, 0, None, None), (None, None, "as\nsis</turn>tant", "t"), (7, 0, "user", LONG), (7, 0, "user", LONG), (8, 1, "assistant", "")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, node string")
    nodes, turns = chat_tree.stored(*chat_tree.build_trees(df))
    frame = nodes.toPandas()
    by_tree = frame.sort_values("start").groupby("tree")
    for _, tree in by_tree:  # gapless, and each node's ancestors cover its position
        assert tree["start"].tolist() == [0, *np.cumsum(tree["length"])[:-1]]
        for r in tree.itertuples():
            assert sum(b - a for a, b in r.attends) == r.position
            assert all(b <= r.start for _, b in r.attends)
    first = frame[frame["written"].str.startswith("### user\na</turn>")]
    assert len(first) == 1  # five conversations share it
    assert len(frame) == 1 + 2 + 2 + 1 + 1 + 2 + 2 + 1
    found = {r["conv_id"]: tuple(r)[1:5] for r in chat_tree.read_conversations(nodes, turns).collect()}
    for c in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == c), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        assert found[c] == brute_digest([r[2:] for r in own])
    assert chat_tree.read_conversations(*chat_tree.build_trees(df.limit(0))).count() == 0


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_trees_are_walked_depth_first(spark, seed):
    rng = np.random.default_rng(seed)
    talks = {c: [str(t) for t in rng.integers(0, 2, rng.integers(1, 8))] for c in range(150)}
    talks |= {1000 + c: list("hot") + [str(c), "end"] for c in range(60)}  # one first turn, many ways on
    rows = [(c if c else None, i, "user", t) for c, ts in talks.items() for i, t in enumerate(ts)]
    nodes, turns = chat_tree.stored(*chat_tree.build_trees(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))
    spans = {r["node"]: (r["tree"], r["start"], r["start"] + r["length"], [tuple(a) for a in r["attends"]]) for r in nodes.collect()}
    assert len(spans) == len({tuple(ts[: i + 1]) for ts in talks.values() for i in range(len(ts))})
    ways = collections.defaultdict(dict)
    for r in turns.collect():
        ways[r["conv_id"]][r["place"]] = r["node"]
    parent = {}
    for way in ways.values():
        above = []
        for place in range(len(way)):
            node = way[place]
            merged = []
            for a, b in sorted(spans[x][1:3] for x in above):
                merged = [*merged[:-1], (merged[-1][0], b)] if merged and merged[-1][1] == a else [*merged, (a, b)]
            assert spans[node][3] == merged
            parent[node] = above[-1] if above else None
            above.append(node)
    stack = []
    for node in sorted(spans, key=lambda x: spans[x][:2]):  # a preorder: each node's parent is open when it comes
        while stack and stack[-1] != parent[node]:
            stack.pop()
        assert bool(stack) == (parent[node] is not None) and (stack or spans[node][1] == 0)
        stack.append(node)


def test_a_conversation_of_100000_turns(spark, monkeypatch):
    written, n = {}, 100_000

    def noted(df, name, write=chat_tree.materialize):
        out = write(df, name)
        written[name] = sum(os.path.getsize(f.removeprefix("file://")) for f in out.inputFiles())
        return out

    monkeypatch.setattr(chat_tree, "materialize", noted)
    long = spark.range(n).selectExpr("cast(null as long) conv_id", "id turn", "if(id % 2 = 0, 'user', 'assistant') role", "concat('t', id) text")
    other = long.where("turn < 50001").selectExpr("9L conv_id", "turn", "role", "if(turn = 50000, 'else', text) text")
    nodes, turns = chat_tree.stored(*chat_tree.build_trees(long.unionByName(other)))
    assert nodes.count() == n + 1 and nodes.select(F.max(F.size("attends"))).first()[0] <= 2
    assert max(written.values()) < 150 * n and written["paths"] < 10_000  # no turn pays for those before it
    found = {r["conv_id"]: tuple(r)[1:5] for r in chat_tree.read_conversations(nodes, turns).collect()}
    texts = [(("user", "assistant")[i % 2], f"t{i}") for i in range(n)]
    assert found == {None: brute_digest(texts), 9: brute_digest([*texts[:50000], ("user", "else")])}


def test_turns_are_parsed_exactly():
    rng = np.random.default_rng(4)
    for _ in range(500):
        role, text = ("".join(rng.choice(["\\", "#", "###", "</turn>", "\n", "n", "a", "<"], rng.integers(0, 9))) for _ in range(2))
        written, start, end = chat_tree.format_turn(role, text)
        assert chat_tree.parse_turn(written) == (role, text) and chat_tree.unescape(written[start:end]) == text


# packing


def check_packing(found, wanted, length):
    rows = collections.defaultdict(list)
    for r in found:
        rows[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in rows.values():
        parts.sort()
        assert [o for o, _ in parts] == [0, *np.cumsum([n for _, n in parts])[:-1]] and sum(n for _, n in parts) <= length
    pieces = collections.Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found)
    cut = collections.Counter()
    for i, ids in wanted:
        n = len(ids)
        first = n if n <= length else n % length or length
        edges = [0, *range(first, n + 1, length)]
        for p, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
            cut[(i, p, a, b - a, zlib.crc32(ids[a:b].tobytes()))] += 1
    assert pieces == cut
    return len(rows)


def test_packing_of_documents(spark, small):
    docs = table(small, "documents")
    wanted = brute_tokens(zip(docs["doc_id"], docs["text"], strict=True), public_path("byte_bpe_50k.json"), 0)
    n = check_packing(queries.op5_packing(spark, small).collect(), wanted, 2048)
    assert n <= -(-sum(len(x) for _, x in wanted) // 2048) * 1.02 + 1


def test_packing_of_odd_rows(spark):
    docs, path = odd_docs(spark), public_path("byte_bpe_50k.json")
    wanted = brute_tokens([(r["doc_id"], r["text"]) for r in docs.collect()], path, 0)
    check_packing(packing.pack_documents(docs, path, 0, 64).collect(), wanted, 64)
    assert packing.pack_documents(empty_docs(spark), path, 0).count() == 0


def test_packing_in_several_groups(spark):
    rng = np.random.default_rng(5)
    rows = spark.createDataFrame([(i, 0, 0, int(n), 0) for i, n in enumerate(rng.integers(1, 101, 3000))], "doc_id long, piece int, start long, length long, ids_crc32 long")
    out = packing.pack(rows, 100, group=500).toPandas()
    fills = out.groupby("sequence_id")["length"].sum()
    assert len(out) == 3000 and fills.max() <= 100 and len(fills) <= fills.sum() / 100 * 1.03


def test_local_search_empties_bins():
    rng = np.random.default_rng(6)
    lengths = rng.integers(5, 60, 400).tolist()
    loose = [[i] for i in range(400)]
    packed = packing.local_search(loose, lengths, 100, rounds=8)
    assert sorted(i for b in packed for i in b) == list(range(400))
    assert max(sum(lengths[i] for i in b) for b in packed) <= 100
    assert len(packed) <= sum(lengths) / 100 * 1.1


def test_local_search_tries_all_receivers_until_nothing_changes():
    lengths = np.random.default_rng(1).integers(100, 180, 300).tolist()
    bins = packing.best_fit(lengths, 410)
    packed = packing.local_search([list(b) for b in bins], lengths, 410)
    assert sorted(i for b in packed for i in b) == list(range(300)) and len(packed) < len(bins)
    held = [[lengths[i] for i in b] for b in packed]
    assert max(map(sum, held)) <= 410
    for d, donor in enumerate(held):
        for r, receiver in enumerate(held):
            room = 410 - sum(receiver)
            if r == d or sum(receiver) < sum(donor):
                continue
            back = [0, *receiver] + [x + y for i, x in enumerate(receiver) for y in receiver[:i]]
            assert not any(0 < n - x <= room for n in donor for x in back)
            pairs = [x + y for i, x in enumerate(donor) for y in donor[:i]]
            assert not any(0 < n - x <= room for n in pairs for x in receiver)


def test_local_search_gives_two_pieces_for_one():
    lengths = [60, 35, 36, 30]  # 36 and 30 for 60 fill the first bin; no piece alone can go over
    packed = packing.local_search([[0, 1], [2, 3]], lengths, 101)
    assert sorted(sum(lengths[i] for i in b) for b in packed) == [60, 101]


# near-duplicates


@pytest.mark.parametrize(("k", "percent", "bands", "slots"), [(3, 85, 28, 6), (5, 80, 32, 5)])
def test_near_duplicates_equal_brute_force(spark, small, k, percent, bands, slots):
    docs = table(small, "documents")
    texts = dict(zip(docs["doc_id"].tolist(), docs["text"], strict=True))
    rng = np.random.default_rng(7)
    base = docs["text"][0].split()
    for i in range(150):  # a family of mutated copies, linked in chains or not at all
        w = [x if rng.random() > rng.choice([0.0, 0.01, 0.03, 0.06]) else f"w{rng.integers(1 << 30)}" for x in base]
        texts[10_000 + i] = " ".join(w)
    frame = spark.createDataFrame([(i, t) for i, t in texts.items()], "doc_id long, text string")
    sets, least = brute_components(texts, k, percent)
    found = superminhash.near_duplicates(frame, words=k, percent=percent, bands=bands, slots=slots).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in found} == {i: (len(sets[i]), least[i], least[i] == i) for i in texts}


def test_tiles_of_a_large_bucket(spark, monkeypatch):
    monkeypatch.setattr(superminhash, "TILE", 16)
    rng = np.random.default_rng(8)
    base = [f"v{i}" for i in range(120)]
    texts = {i: " ".join(x if rng.random() > 0.02 else f"w{rng.integers(1 << 30)}" for x in base) for i in range(200)}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    _, least = brute_components(texts, 3, 85)
    found = superminhash.near_duplicates(frame, words=3, percent=85, bands=28, slots=6).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == least


def test_near_duplicates_of_odd_rows(spark):
    found = superminhash.near_duplicates(odd_docs(spark), words=3, percent=85, bands=28, slots=6).collect()
    by_id = {r["doc_id"]: r for r in found if r["doc_id"] != 10}
    assert len(found) == 12 and sum(r["doc_id"] == 10 for r in found) == 2
    assert [by_id[i]["n_shingles"] for i in (0, 1, 2, None, 4, 5)] == [0, 0, 0, 1, 1, 4]
    assert by_id[6]["component_id"] == 5 and by_id[8]["component_id"] == 7 and by_id[0]["kept"] and by_id[1]["kept"]
    assert by_id[None]["kept"] and by_id[None]["component_id"] is None
    assert superminhash.near_duplicates(empty_docs(spark)).count() == 0


def test_signatures_estimate_similarity_and_pieces_equal_the_whole(monkeypatch):
    rng = np.random.default_rng(9)
    a = np.sort(rng.integers(0, 1 << 62, 1000).astype(np.uint64))
    b = np.sort(np.concatenate([a[150:], rng.integers(0, 1 << 62, 150).astype(np.uint64)]))
    s = superminhash.signatures(np.concatenate([a, b]), np.repeat([0, 1], 1000), 2, 512)
    assert abs((s[0] == s[1]).mean() - 850 / 1150) < 0.08
    data = np.frombuffer((" ".join(f"w{i % 977}x{i % 31}" for i in range(6000)) + "  ").encode(), np.uint8)
    whole, _ = superminhash.shingles(data, np.array([0, len(data)]), 3)
    monkeypatch.setattr(superminhash, "CHUNK", 1000)
    assert (superminhash.shingles(data, np.array([0, len(data)]), 3)[0] == whole).all()


# importance resampling


def test_resampling_drops_bad_documents(spark, medium):
    found = queries.op7_importance(spark, medium).toPandas()
    labels = table(medium, "labels")
    both = found.merge(labels, on="doc_id")
    assert len(found) == len(table(medium, "documents"))
    assert both[both["quality"] == 1]["kept"].mean() > 0.97 and both[both["quality"] == 0]["kept"].mean() < 0.1
    drawn = found[found["kept"]]
    assert drawn["gumbel_key"].min() >= found[~found["kept"]]["gumbel_key"].max()


def spark_hash(*values):
    h = 42
    for v in values:
        h = xxhash.xxh64_intdigest(struct.pack("<q" if isinstance(v, np.int64) else "<i", v), seed=h)
    return h


def test_resampling_equals_brute_force(spark, small):
    docs, labels = table(small, "documents"), table(small, "labels")
    found = queries.op7_importance(spark, small).toPandas().set_index("doc_id")
    good = {i for i, q in zip(labels["doc_id"], labels["quality"], strict=True) if q == 1}
    half = lambda i: spark_hash(np.int64(i), 1) % 2  # noqa: E731  even and odd are the same for signed and unsigned
    grams, raw, target = {}, collections.Counter(), collections.Counter()
    word_hash = functools.cache(lambda w: hashing.span_hashes(np.frombuffer(w, np.uint8), np.array([0]), np.array([len(w)]))[0])
    for i, text in zip(docs["doc_id"], docs["text"], strict=True):
        words = re.findall(rb"[0-9A-Za-z_\x80-\xff]+|[!-/:-@\[-^`{-~]+", (text or "").encode())
        hashes = [importance._REPEAT if k and words[k - 1].lower() == w.lower() else word_hash(w.lower()) for k, w in enumerate(words)]
        own = [int(hashing.mix(np.array([h], np.uint64))[0]) for h in hashes]
        own += [int(hashing.gram_hashes(np.array(p, np.uint64), np.zeros(2, int), 2)[0][0]) for p in zip(hashes, hashes[1:])]
        grams[i] = collections.Counter(g % importance.BUCKETS for g in own)
        raw.update(grams[i])
        if i in good and half(i) == 0:
            target.update(grams[i])
    n_raw, n_target = sum(raw.values()), sum(target.values())
    ratio = {g: math.log((target[g] + importance.SHRINK) / (n * n_target / n_raw + importance.SHRINK)) for g, n in raw.items()}
    weight = {i: importance.EFFECTIVE_LENGTH * sum(ratio[g] * n for g, n in c.items()) / max(1, sum(c.values())) for i, c in grams.items()}
    assert all(abs(found["log_weight"][i] - w) < 1e-9 for i, w in weight.items())
    key = {i: w - math.log(-math.log(((spark_hash(np.int64(i), importance.SEED) >> 11) + 0.5) / 2**53)) for i, w in weight.items()}
    assert all(abs(found["gumbel_key"][i] - k) < 1e-9 for i, k in key.items())
    reached = np.quantile([weight[i] for i in good if i in weight and half(i) == 1], 1 - importance.RECALL)
    drawn = sum(w >= reached - 1e-12 for w in weight.values())
    assert {i for i in weight if found["kept"][i]} == set(sorted(key, key=lambda i: (-key[i], i))[:drawn])


def test_resampling_learns_from_all_labelled_documents(spark):
    n = 20_600
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.format_string("a%d b%d", F.col("id") % 7, F.col("id") % 50).alias("text"))
    labels = docs.select("doc_id", F.when(F.col("doc_id") % 50 < 10, 0).otherwise(1).alias("quality"))
    assert importance.labelled_ids(labels, "quality").count() == n
    found = importance.resample(docs, labels).withColumn("half", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2))).toPandas()
    data = "".join(found["text"]).encode()
    ends = np.concatenate([[0], np.cumsum([len(t) for t in found["text"]])])
    grams, owner = importance.gram_buckets(np.frombuffer(data, np.uint8), ends)
    good = (found["doc_id"] % 50 >= 10).to_numpy()
    raw, target = (np.bincount(g, minlength=importance.BUCKETS) for g in (grams, grams[(good & (found["half"] == 0))[owner]]))
    ratio = np.log((target + importance.SHRINK) / (raw * target.sum() / raw.sum() + importance.SHRINK))
    weight = np.bincount(owner, ratio[grams]) / np.bincount(owner) * importance.EFFECTIVE_LENGTH
    assert np.abs(found["log_weight"] - weight).max() < 1e-9
    reached = np.quantile(weight[good & (found["half"] == 1)], 1 - importance.RECALL)
    assert found["kept"].sum() == (weight >= reached - 1e-12).sum()


@pytest.mark.parametrize("share", [0.0, 0.002, 0.5, 0.77, 1.0])
def test_percentile_is_that_of_spark(spark, share):
    rows = spark.createDataFrame([((i * 37 % 11) / 7,) for i in range(53)], "x double")
    assert importance._percentile(rows, "x", share) == pytest.approx(rows.agg(F.percentile("x", share)).first()[0], abs=1e-15)
    assert importance._percentile(rows.where("x < 0"), "x", share) is None


def test_resampling_of_odd_rows(spark):
    labels = spark.createDataFrame([(i, 1) for i in range(9)] + [(None, 1), (4, 0)], "doc_id long, quality int")
    found = importance.resample(odd_docs(spark), labels)
    assert set(SCHEMA.replace(",", "").split()[::2]) | {"log_weight", "gumbel_key", "kept"} == set(found.columns)
    rows = found.toPandas()
    assert len(rows) == 12 and (rows["log_weight"][rows["text"].isna()] == 0).all()
    assert importance.resample(odd_docs(spark), labels.where("quality < 0")).where("not kept").count() == 0
    assert importance.resample(empty_docs(spark), labels).count() == 0


@pytest.mark.parametrize("size", [1, 2, 3, 10, 100, 1000])
def test_pieces_of_long_texts_equal_the_whole(monkeypatch, size):
    rng = np.random.default_rng(size)
    for longest in (3, 40, 3000):
        parts = ["".join(rng.choice(list("aBé,!-9"), rng.integers(1, longest))) + " \n"[: rng.integers(0, 3)] for _ in range(40)]
        parts += parts[-1:] * 3 + ["one two two, three!! "] * 5
        data = np.frombuffer("".join(parts).encode(), np.uint8)
        ends = np.array([0, len(data)])
        whole = importance.gram_buckets(data, ends, 1 << 40)[0], *(superminhash.shingles(data, ends, k)[0] for k in (1, 3, 5))
        with monkeypatch.context() as patch:
            patch.setattr(importance, "CHUNK", size)
            patch.setattr(superminhash, "CHUNK", size)
            cut = importance.gram_buckets(data, ends, 1 << 40)[0], *(superminhash.shingles(data, ends, k)[0] for k in (1, 3, 5))
        assert all(np.array_equal(np.sort(x), np.sort(y)) for x, y in zip(whole, cut, strict=True))


def test_long_words_in_long_texts(spark):
    words = [c * 700_000 for c in "abcd"] + list("efgh")
    other = [words[i] for i in (2, 0, 3, 1, 4, 5, 6, 7)]
    few = ["x" * 2_500_000, "y"]
    texts = {1: " ".join(words), 2: " ".join(other), 3: " ".join(words) + " ", 4: " ".join(few), 5: " ".join(few[::-1])}
    found = superminhash.near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), words=3, percent=85, bands=28, slots=6)
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found.collect()) == [(1, 6, 1), (2, 6, 2), (3, 6, 1), (4, 1, 4), (5, 1, 5)]


# vectors


def odd_vectors(spark):
    rng = np.random.default_rng(10)
    rows = [(i, rng.normal(size=16).tolist(), 0) for i in range(60)]
    rows += [(100 + i, (np.array(rows[i][1]) * 3 + rng.normal(size=16) * 0.1).tolist(), 1) for i in range(30)]
    rows += [(200 + i, rows[0][1], 2) for i in range(20)]
    rows += [(300, None, 0), (301, [0.0] * 16, 0), (302, [None] * 16, 0), (303, [float("nan")] * 16, 0), (304, [float("inf")] * 16, 0), (305, [], 0), (306, [1.0, 2.0], 0), (307, [2.0, 4.0], 0), (7, rows[7][1], 0), (None, rows[8][1], 0)]
    return rows, spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")


@pytest.mark.parametrize("tile", [8192, 7])
def test_near_vectors_equal_brute_force(spark, tile, monkeypatch):
    monkeypatch.setattr(pigeonhole, "TILE", tile)
    rows, df = odd_vectors(spark)
    found = pigeonhole.near_vectors(df).collect()

    def unit(v):
        v = np.array([np.nan if x is None else x for x in (v or [])], float)
        return v / np.linalg.norm(v) if len(v) and np.isfinite(v).all() and v.any() else None

    units = [unit(r[1]) for r in rows]
    links = [[j for j, b in enumerate(units) if j != i and a is not None and b is not None and len(a) == len(b) and a @ b >= 0.95] for i, a in enumerate(units)]
    parent = list(range(len(rows)))
    for i, near in enumerate(links):
        for j in near:
            a, b = i, j
            while parent[a] != a:
                a = parent[a]
            while parent[b] != b:
                b = parent[b]
            parent[max(a, b)] = min(a, b)

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = collections.defaultdict(list)
    for i, r in enumerate(rows):
        ids[top(i)].append(r[0])
    wanted = collections.Counter((r[0], len(links[i]), min((x for x in ids[top(i)] if x is not None), default=None)) for i, r in enumerate(rows))
    assert collections.Counter((r["vec_id"], r["n_links"], r["component_id"]) for r in found) == wanted
    assert pigeonhole.near_vectors(df.limit(0)).count() == 0


def links_of(found):
    return {r["vec_id"]: r["n_links"] for r in found.collect()}


def test_pairs_at_the_borders_of_slabs_are_found_once(spark):
    rng = np.random.default_rng(15)
    blocks = pigeonhole.Blocks(64, pigeonhole.BLOCKS, 0.95)
    rows, turn = [], pigeonhole.rotation(64)
    steps = [0, *(sign * 10.0**-p for p in range(5, 16) for sign in (1, -1))]
    for n, step in enumerate(steps * 8):
        # Two vectors that differ in one coordinate of block 0 by about its radius, and less in block 1.
        x = rng.normal(size=64)
        x /= np.linalg.norm(x)
        y = x.copy()
        y[n % 8] += np.sqrt(blocks.budgets[0]) * (1 + step)
        if n % 3:
            y[8 + n % 8] += 0.02 * (n % 3)
        y[63] *= 1 + rng.normal() * 1e-9
        rows += [(2 * n, (turn @ x).tolist()), (2 * n + 1, (turn @ y).tolist())]
    found = links_of(pigeonhole.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")))
    unit = np.array([v for _, v in rows])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    close = unit @ unit.T
    assert abs(close - 0.95).min() > 1e-12
    assert found == {i: int((close[i] >= 0.95).sum()) - 1 for i in range(len(rows))}
    assert min(found.values()) >= 1


@pytest.mark.parametrize("cosine", [0.95, 0.9999])
def test_links_on_a_circle_equal_brute_force(spark, cosine):
    rng = np.random.default_rng(16)
    angles = np.concatenate([rng.uniform(0, 2 * np.pi, 150), np.arange(40) * np.arccos(cosine) * (1 + 1e-9), np.arange(40) * np.arccos(cosine) * (1 - 1e-9)])
    points = np.stack([np.cos(angles), np.sin(angles)], 1) * rng.uniform(0.1, 9, (230, 1))
    unit = points / np.linalg.norm(points, axis=1, keepdims=True)
    found = links_of(pigeonhole.near_vectors(spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "vec_id long, embedding array<double>"), cosine=cosine))
    assert found == {i: int((unit[i] @ unit.T >= cosine).sum()) - 1 for i in range(230)}


def test_vectors_with_nulls_link_with_nothing(spark):
    rows = [(1, [None, 1.0, 2.0]), (2, [1.0, 2.0, None]), (3, [1.0, 2.0]), (4, [2.0, 4.0]), (5, [1.0, None, 2.0]), (6, [1.0, 2.0]), (7, [1.0, 2.0, 0.0]), (8, [1.0, 2.0, -0.0]), (9, None)]
    found = pigeonhole.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    by_id = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in found.collect()}
    assert by_id == {1: (0, 1, True), 2: (0, 2, True), 3: (2, 3, True), 4: (2, 3, False), 5: (0, 5, True), 6: (2, 3, False), 7: (1, 7, True), 8: (1, 7, False), 9: (0, 9, True)}


def test_top_k_of_odd_vectors(spark):
    rows, df = odd_vectors(spark)
    found = collections.defaultdict(list)
    for r in impact_topk.top_k(df, F.col("vec_id") % 5 == 0, k=6).orderBy("query_id", "rank").collect():
        found[r["query_id"]].append((r["vec_id"], r["score"]))
    clean = [(i, np.floor(256 * np.array(v, float)).astype(int)) for i, v, _ in rows if i is not None and v and None not in v and np.isfinite(v).all()]
    for i, q in clean:
        if i % 5 == 0:
            scored = sorted(((j, int(q @ v)) for j, v in clean if j != i and len(v) == len(q)), key=lambda s: (-s[1], s[0]))[:6]
            assert found.pop(i) == scored
    assert not found
    assert impact_topk.top_k(df.limit(0), F.col("vec_id") % 5 == 0).count() == 0


def exact_top(whole, query, k):
    scored = sorted((-sum(a * b for a, b in zip(whole[query], v, strict=True)), i) for i, v in whole.items() if i != query)[:k]
    return [(query, rank, i, -s) for rank, (s, i) in enumerate(scored, 1)]


def test_top_k_counts_large_components_whole(spark):
    vectors = {0: [100000.0, 1.0], 1: [1.0, 1e13], 2: [-4e4, 2.0], 3: [1.0, 1.0], 5: [1.0, 2.0], 6: [3e5, -1.0], 7: [2e5, 0.0]}
    df = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<double>")
    found = impact_topk.top_k(df, F.col("vec_id") % 5 == 0, k=4).orderBy("query_id", "rank").collect()
    whole = {i: [int(256 * x) for x in v] for i, v in vectors.items()}
    assert [tuple(r) for r in found] == exact_top(whole, 0, 4) + exact_top(whole, 5, 4)


def test_top_k_counts_components_that_overflow_whole(spark):
    vectors = {0: [0.0, 3.0], 1: [1.7e308, 1.0], 2: [-1e308, 1.01], 3: [1e60, 1.0], 4: [1.0, 1.0], 6: [2.0, -7.3], 7: [0.0, 1.0], 8: [1.7e308, 1.0]}
    df = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<double>")
    found = impact_topk.top_k(df, F.col("vec_id") == 0, k=9).orderBy("rank").collect()
    whole = {i: [int((256 * Fraction(x)) // 1) for x in v] for i, v in vectors.items()}
    assert [tuple(r) for r in found] == exact_top(whole, 0, 9)
    with pytest.raises(Exception, match="64 bits"):
        impact_topk.top_k(df, F.col("vec_id") == 1).collect()


def test_top_k_of_repeated_queries_takes_the_least_vector(spark):
    rows = [(0, [2.0, 1.0]), (0, [1.0, 2.0]), (0, [1.0, 3.0]), (1, [5.0, 0.0]), (1, [5.0, 0.0]), (2, [0.0, 4.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    found = [tuple(r) for r in impact_topk.top_k(df, F.col("vec_id") == 0, scale=1.0).orderBy("rank").collect()]
    assert found == [(0, 1, 2, 8), (0, 2, 1, 5), (0, 3, 1, 5)]


def test_top_k_is_proved_by_the_index(monkeypatch):
    rng = np.random.default_rng(9)
    rows = np.floor(256 * rng.normal(size=(2000, 64)))
    rows[7], rows[8, :60] = 0, 0
    rows[1500:1600] = rows[0] + rng.integers(0, 2, (100, 64))
    ids, none = np.arange(2000)[::-1].copy(), np.zeros(2000, np.int64)
    shard, query, read = impact_topk.Shard(ids, rows, none), impact_topk.Vectors(rows, none), []
    scores = impact_topk.Shard.scores
    monkeypatch.setattr(impact_topk.Shard, "scores", lambda self, places, *x: read.append(len(places)) or scores(self, places, *x))
    for i in [0, 1, 2, 3, 7, 8, 1600]:
        exact = (rows @ rows[i]).astype(np.int64).tolist()
        wanted = sorted((-s, j) for s, j in zip(exact, ids.tolist(), strict=True))[:6]
        for floor in (None, -wanted[-1][0], -wanted[0][0]):
            places, found, share = shard.search(query, i, 6, floor)
            kept = [w for w in wanted if floor is None or -w[0] >= floor]
            assert [(-s, j) for s, j in zip(found, ids[places].tolist(), strict=True)][: len(kept)] == kept
            assert share < 0.95 or i == 7
        assert shard.search(query, i, 6, -wanted[0][0] * 100 + 10**7)[0].size == 0
        assert max(read) <= impact_topk.FEW_SHARE * 2000 or i == 7  # a zero query has no postings, all scores are 0
        read.clear()


def test_a_shard_that_cannot_reach_the_floor_is_left_at_once():
    rng = np.random.default_rng(14)
    near, far = (np.floor(rng.normal(size=(500, 16)) + sign * 50) for sign in (1, -1))
    none = np.zeros(500, np.int64)
    query = impact_topk.Vectors(near[:1], none[:1])
    places, scores, share = impact_topk.Shard(none, near, none).search(query, 0, 6, None)
    assert len(places) == 6 and min(scores) > 0 and 0 < share <= 1
    assert impact_topk.Shard(none, far, none).search(query, 0, 6, min(scores))[2] == 0


def test_top_k_in_several_shards_and_blocks(spark, small, monkeypatch):
    monkeypatch.setattr(impact_topk, "SHARD", 100)
    monkeypatch.setattr(impact_topk, "QUERIES", 20)
    wanted = duckdb.connect()
    wanted.sql(f"create view embeddings as select * from '{small}/embeddings.parquet'")
    rows = wanted.sql(queries.ORACLES["op10_impact_topk"]).fetchall()
    assert sorted(tuple(r) for r in queries.op10_impact_topk(spark, small).select("query_id", "rank", "vec_id", "score").collect()) == sorted(rows)


# byte-level BPE


@pytest.fixture(scope="module")
def reference_bpe():
    path = public_path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_tiktoken(reference_bpe):
    bpe, rng = bpe_matrix.Encoder(public_path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN), np.random.default_rng(11)
    texts = ["".join(rng.choice(list("aeioutnrsl hé漢ß!1\n \t'\u3000"), rng.integers(0, 40))) for _ in range(1500)]
    texts += [t or "" for t in ODD_TEXTS] + ["ab" * 500, "a" * 1001, "é" * 300, "".join(rng.choice(list("abcde"), 3000)), "<|endoftext|> it's"]
    for text, ids in zip(texts, bpe.encode(texts), strict=True):
        assert ids.tolist() == reference_bpe.encode_ordinary(text) and bpe.decode(ids.tolist()) == text.encode()


@pytest.mark.parametrize("window", [2, 7, 128])
def test_long_matches_equal_tiktoken(reference_bpe, monkeypatch, window):
    monkeypatch.setattr(bpe_matrix, "WINDOW", window)
    ranks, rng = bpe_matrix.Encoder(public_path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN).ranks, np.random.default_rng(17)
    words = ["a" * n for n in (255, 257, 1000, 1001)] + ["abc" * 333 + "a", "=" * 999, " " * 777, "the" * 200, "漢字" * 150, "é" * 301, "ab" * 300 + "b" * 301]
    words += ["".join(rng.choice(list(letters), n)) for letters in ("ab", "aeiounrst", "漢字本日語ß") for n in (130, 600, 1500)]
    for word, ids in zip(words, ranks.encode([w.encode() for w in words]), strict=True):
        assert np.frombuffer(ids, "<i4").tolist() == reference_bpe.encode_ordinary(word)


def test_a_match_of_a_megabyte(reference_bpe):
    ranks, rng = bpe_matrix.Encoder(public_path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN).ranks, np.random.default_rng(18)
    word = "".join(rng.choice(list("etaoinshrdlucmfwyp"), 1_000_000))
    ids = np.frombuffer(ranks.encode([word.encode()])[0], "<i4").tolist()
    assert b"".join(map(ranks.bytes.__getitem__, ids)) == word.encode()
    # tiktoken takes long for the whole; its first part has the same ids up to near its end.
    first = reference_bpe.encode_ordinary(word[:30_000])
    assert ids[: len(first) - 20] == first[:-20]


def test_bpe_query_equals_tiktoken(spark, small, reference_bpe):
    docs = table(small, "documents")
    found = {r["doc_id"]: tuple(r)[1:] for r in queries.op9_bpe_matrix(spark, small).collect()}
    for i, text in zip(docs["doc_id"], docs["text"], strict=True):
        ids = reference_bpe.encode_ordinary(text or "")
        wanted = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())
        assert found[i] == wanted
    out = bpe_matrix.encode_documents(odd_docs(spark), public_path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    assert out.count() == 12 and out.where("size(ids) <> n_tokens").count() == 0


def peak_mb(run):
    tracemalloc.start()
    run()
    peak = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    return peak


def test_memory_of_signatures_and_tiles_is_small():
    """Beside the JVM's heap a worker has little room: ranking 130,800 elements and comparing 1,000 sets took 80 and 46 MB."""
    elements, owner = hashing.mix(np.arange(327 * 400, dtype=np.uint64)), np.repeat(np.arange(327), 400)
    assert peak_mb(lambda: superminhash.signatures(elements, owner, 327, 160)) < 40
    sets = pd.DataFrame({"set_id": np.arange(1000), "elements": [np.arange(i, i + 20) for i in range(1000)]})
    links = superminhash._tile_links(80)(sets)
    assert len(links) == 999 and (links["a"] == 0).all()  # neighbours share 19 of 21
    assert peak_mb(lambda: superminhash._tile_links(80)(sets)) < 32


def test_packing_remembers_fewer_chunks_than_its_worker_could_hold():
    encode = vocabularies.encoder(public_path("byte_bpe_50k.json"), packing.REMEMBERED)
    assert encode.memory.most <= vocabularies.REMEMBERED // 2
    docs = pa.array([" ".join(f"w{i}x{j}" for j in range(50)) for i in range(20)])
    small = Encoder(public_path("byte_bpe_50k.json"), 100)
    for _ in range(2):
        ids, offsets = small(docs)
        wanted, ends = encode(docs)
        assert (ids == wanted).all() and (offsets == ends).all()


def test_texts_of_a_batch_are_python_objects_a_few_at_a_time():
    texts = pa.array(["word " * 2000 + "Δ"] * 2000)
    batch = pa.RecordBatch.from_arrays([texts, pa.array([1, 0] * 1000, pa.int32())], names=["text", "grade"])
    counted = []
    assert peak_mb(lambda: counted.extend(toxicity._counted(iter([batch])))) < 20  # 40 MB for all at once
    assert [tuple(r.values()) for r in counted[0].to_pylist()] == [("word", 1000, 1000), ("δ", 1000, 1000)]
