"""The registered opN_ queries against their contract, and every stage of the pipeline against brute force."""

import collections
import random
import zlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quillon.llm.queries import QUERIES
from test_llm import brute_components, leading, overlap_rule, prose, split

TABLES = "/root/testdata/sf0.001"
CONTRACT = {
    "op1_lm_scoring": "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    "op2_quality": "doc_id bigint, held_out boolean, score double, predicted int",
    "op3_near_dedup": "doc_id bigint, n_shingles bigint, component_id bigint, kept boolean",
    "op6_language_id": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op7_nearest": "query_id bigint, rank int, vec_id bigint, score double",
    "op8_sharding": "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
    "op10_mixing": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
}


def crc(x, folds):
    return zlib.crc32(str(x).encode()) % folds


@pytest.mark.parametrize("name", sorted(CONTRACT))
def test_query_keeps_its_contract(spark, name):
    out = QUERIES[name](spark, TABLES)
    types = dict(out.dtypes)
    for field in CONTRACT[name].split(", "):
        column, kind = field.split()
        assert types[column] == kind
    rows = out.collect()
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{TABLES}/documents.parquet").collect()}
    if name == "op7_nearest":
        assert len(rows) == len({(r["query_id"], r["rank"]) for r in rows}) and all(r["query_id"] % 100 == 0 and r["query_id"] != r["vec_id"] for r in rows)
        return
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    text = {i: r["text"] or "" for i, r in docs.items()}
    if name == "op1_lm_scoring":
        count = collections.Counter(x for i, t in text.items() if crc(i, 10) for x in [*split(t), None])
        for r in rows:
            tokens = [*split(text[r["doc_id"]]), None]
            assert (r["held_out"], r["n_tokens"], r["n_known"]) == (crc(r["doc_id"], 10) == 0, len(tokens), sum(count[x] > 0 for x in tokens))
            assert r["train_tokens"] == sum(count.values()) and r["score"] < 0
    if name == "op2_quality":
        assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) and r["held_out"] == (crc(r["doc_id"], 5) == 0) for r in rows)
    if name == "op6_language_id":
        learned = {r["lang"] for r in docs.values()}
        assert all(0 <= r["score"] <= 1 and r["held_out"] == (crc(r["doc_id"], 4) == 2) and (r["lang_pred"] in learned) == any(c.isalpha() for c in text[r["doc_id"]]) for r in rows)
    if name == "op8_sharding":
        assert all(r["size"] == len(text[r["doc_id"]].encode()) + 1 and r["text_crc32"] == zlib.crc32(text[r["doc_id"]].encode()) and r["law"] == "rows" for r in rows)
        sizes = collections.Counter(r["shard"] for r in rows)
        assert set(sizes) == set(range(8)) and max(sizes.values()) - min(sizes.values()) <= 1
        assert all(sorted(r["slot"] for r in rows if r["shard"] == j) == list(range(n)) for j, n in sizes.items())
    if name == "op10_mixing":
        taken = collections.Counter()
        target = {}
        for r in rows:
            source = docs[r["doc_id"]]["source"]
            assert r["size"] == len(split(text[r["doc_id"]])) and 0 <= r["taken"] <= 2 * r["size"]
            taken[source] += r["taken"]
            target[source] = r["target"]
        assert all(abs(taken[s] - t) <= max(len(split(x)) for x in text.values()) for s, t in target.items())


KINDS = "doc_id long, text string, lang string, source string, n_chars long, extra string"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """A folder with documents and a benchmark; copies, leaks, texts without letters, a repeated row."""
    rng = random.Random(31)
    vocabulary = [f"w{i}" for i in range(400)]
    items = [prose(rng, vocabulary, 40) + ". " + prose(rng, vocabulary, 25) + "." for _ in range(6)]
    texts = [prose(rng, vocabulary, rng.randrange(20, 90)) for _ in range(40)]
    texts += [t + " " + prose(rng, vocabulary, 3) for t in texts[:8]] + texts[8:12]
    texts += [prose(rng, vocabulary, 60) + " " + leading(items[i % 6], 1.0 if i < 6 else 0.9) for i in range(9)]
    texts += [None, "", "123 $$$", "9 9 9", "short"]
    rows = [(i, t, ["en", "de", None][i % 3], ["a", "b", None][i % 3], 1, "x") for i, t in enumerate(texts)]
    folder = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame([*rows, rows[20]], KINDS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([*enumerate(items)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, texts, items


def test_stages_against_brute_force(spark, corpus):
    folder, texts, items = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language ID", "MinHash near-dedup", "benchmark decontamination", "mixing sources to target weights", "sharding"]
    ids = lambda df: sorted(r["doc_id"] for r in df.collect())
    named = stages["language ID"](spark, docs, folder)
    assert named.columns == docs.columns
    letters = [i for i, t in enumerate(texts) if any(c.isalpha() for c in t or "")]
    assert ids(named) == sorted([*letters, 20])
    deduped = stages["MinHash near-dedup"](spark, docs, folder)
    roots, sizes = brute_components(texts)
    assert ids(deduped) == [i for i in range(len(texts)) if roots[i] == i] and deduped.columns == docs.columns
    clean = stages["benchmark decontamination"](spark, docs, folder)
    leaked = {i for i, t in enumerate(texts) for item in items if overlap_rule(t, item)}
    assert ids(clean) == sorted([i for i in [*range(len(texts)), 20] if i not in leaked]) and len(leaked) >= 8
    mixed = stages["mixing sources to target weights"](spark, docs, folder)
    words = lambda rows: collections.Counter(r["source"] for r in rows for _ in split(r["text"]))
    have, want = words(docs.collect()), words(mixed.collect())
    assert max(collections.Counter(ids(mixed)).values()) <= 4  # the repeated row twice
    assert abs(sum(want.values()) - 1.5 * sum(have.values())) <= 3 * 90 and all(want[s] <= 2 * have[s] for s in have)
    sharded = stages["sharding"](spark, docs, folder).collect()
    assert collections.Counter(r["shard"] for r in sharded).most_common()[0][1] - len(sharded) // 8 <= 1 and sorted(r["doc_id"] for r in sharded) == ids(docs)


def test_pipeline_runs_its_stages_in_order(spark, corpus):
    folder, texts, items = corpus
    out = corpus_pipeline.run(spark, folder)
    got = {r["doc_id"] for r in out.collect()}
    letters = {i for i, t in enumerate(texts) if any(c.isalpha() for c in t or "")}
    roots, _ = brute_components([t if i in letters else None for i, t in enumerate(texts)])
    left = {i for i in letters if roots[i] == i and not any(overlap_rule(texts[i], item) for item in items)}
    assert got <= left and len(got) > 0.6 * len(left)
    assert set(out.columns) == {*[f.split()[0] for f in KINDS.split(", ")], "shard", "slot"}
    empty = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, folder).count() == 0


def test_stages_keep_columns_of_any_name(spark, corpus):
    folder, _, _ = corpus
    extra = ["copy", "mix", "_n", "leaked", "score", "lang_pred", "row", "dup", "extra_0", "id", "hash", "r"]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    docs = docs.select(*docs.columns, *[F.concat(F.lit(c), "doc_id").alias(c) for c in extra])
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        rows = out.collect()
        assert out.columns[: len(docs.columns)] == docs.columns and rows
        assert all(r[c] == f"{c}{r['doc_id']}" for r in rows for c in extra)
    sharded = corpus_pipeline.STAGES[-1][1](spark, docs.withColumn("slot", F.lit("x")).withColumn("shard", F.lit("y")), folder)
    assert sharded.columns == [*docs.columns, "shard", "slot"] and dict(sharded.dtypes)["slot"] == "bigint"
