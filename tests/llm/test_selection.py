"""Quality rules, the ordinal classifier, mixing and the pipeline."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cases import WORD, documents, pairs, sentence, write
from gridweave.llm import mixing, ordinal_quality, quality_rules
from gridweave.llm.shingles import WordHasher

FOLDER = "/root/testdata/sf0.001"


def measures(text):
    words = WORD.findall(text)
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_measures(spark):
    docs = documents(spark)
    extra = spark.createDataFrame([(900, "one two three four five six seven eight " * 3 + "nine"), (901, "a b c d e f g h x a b c d e f g h"), (902, "#$ |<>\n#$ |<>\n\n")], "doc_id long, text string")
    both = docs.select("doc_id", "text").unionByName(extra)
    got = quality_rules.measure(both, "doc_id").select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect()
    assert sorted(map(tuple, got), key=str) == sorted(((d, *measures(t)) for d, t in pairs(both)), key=str)


def test_estimate_finds_accuracies():
    draw = random.Random(8)
    on_good, on_bad, counts = (0.98, 0.95, 0.99, 0.97), (0.6, 0.5, 0.7, 0.4), Counter()
    for _ in range(20_000):
        good = draw.random() < 0.85
        votes = tuple(0 if draw.random() < 0.2 else (1 if (draw.random() < (g if good else 1 - b)) else -1) for g, b in zip(on_good, on_bad))
        counts[votes] += 1
    found = quality_rules.estimate(sorted(counts.items()))
    assert abs(found.good - 0.85) < 0.04
    assert all(abs(a - b) < 0.04 for a, b in zip(found.right_on_good, on_good)) and all(abs(a - b) < 0.12 for a, b in zip(found.right_on_bad, on_bad))
    assert quality_rules.estimate([((0, 0), 0)]).good > 0.5


def test_rules_against_labels(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    found = quality_rules.op4_quality_rules(spark, "/root/testdata/sf0.01").join(labels, "doc_id").collect()
    assert all(r["kept"] is False for r in found if r["base_failed"])
    assert np.mean([r["kept"] for r in found if r["label"] == 1 and not r["base_failed"]]) > 0.97
    assert np.mean([r["kept"] for r in found if r["label"] == 0]) < 0.1


def test_posterior_equals_the_formula(spark):
    measured = quality_rules.measure(documents(spark), "doc_id").cache()
    weights = quality_rules.fit(measured)
    votes = [r.vote().alias(r.name) for r in quality_rules.RULES]
    for r in measured.select(quality_rules.posterior(weights).alias("p"), *votes).collect():
        odds = weights.log_odds([r[x.name] for x in quality_rules.RULES])
        assert math.isclose(r["p"], 1 / (1 + math.exp(-odds)), rel_tol=1e-9)
    assert quality_rules.judge(measured.limit(0)).count() == 0


def test_ordinal_fit_on_unseen_rows():
    draw = random.Random(4)
    hasher, made, grades = WordHasher(), [], []
    for k in range(900):
        grade = draw.randrange(3)
        words = sentence(draw, 80).split()
        for _ in range((0, 4, 9)[grade]):
            words[draw.randrange(80)] = "excellent"
        made.append(ordinal_quality.features(hasher, np.frombuffer(" ".join(words).encode(), np.uint8)))
        grades.append(grade)
    starts = np.concatenate(([0], np.cumsum([len(i) for i, _ in made[:600]])))
    model = ordinal_quality.fit(starts, np.concatenate([i for i, _ in made[:600]]), np.concatenate([v for _, v in made[:600]]), np.array(grades[:600]), 3)
    assert (np.diff(model.thresholds) > 0).all()
    scores = np.array([model.weights[i] @ v for i, v in made[600:]])
    tails = model.tails(scores)
    assert (np.diff(tails, axis=1) <= 0).all()
    assert np.mean((tails > 0.5).sum(axis=1) == np.array(grades[600:])) > 0.8


def test_ordinal_gradient():
    """The fit lowers the loss, and thresholds come out in order for any grades."""
    model = ordinal_quality.fit(np.array([0, 1, 2, 3]), np.array([5, 6, 7]), np.ones(3), np.array([0, 2, 1]), 3, least_texts=1)
    tails = model.tails(model.weights[[5, 6, 7]].astype(float))
    assert tails[1, 1] > 0.9 and tails[0, 0] < 0.1 and tails[2, 0] > 0.5 > tails[2, 1]
    none = ordinal_quality.fit(np.array([0]), np.zeros(0, int), np.zeros(0), np.zeros(0, int), 3)
    assert (none.weights == 0).all()


def test_ordinal_quality_query(spark, tmp_path):
    docs = documents(spark)
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(20)] + [(21, None, 1), (22, 1, None), (None, 1, 0)], "doc_id long, quality int, toxic int")
    folder = write(spark, docs, tmp_path, "documents")
    write(spark, labels, tmp_path, "labels")
    found = ordinal_quality.op7_ordinal_quality(spark, folder)
    rows = found.collect()
    assert len(rows) == docs.count() and all(0 <= r["tail_probability"] <= 1 and 0 <= r["expected_grade"] <= 2 for r in rows)
    again = ordinal_quality.op7_ordinal_quality(spark, folder).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    kept = ordinal_quality.judged(docs, labels.limit(0))
    assert kept.count() == docs.count() and kept.select("row.*").columns == docs.columns


def test_ordinal_features_stay_off_the_driver(spark, monkeypatch):
    """All beginnings of words are features, the fit is that of the driver, in parts too, and one id cannot fill the sample."""
    assert ordinal_quality.HEADS == (5, 6, 7)
    draw, data = random.Random(9), []
    for k in range(120):
        data.append((k, sentence(draw, 40) + " excellent" * (4 * (k % 3)), k % 3))
    rated = spark.createDataFrame(data + [(500, f"again {k}", 0) for k in range(300)], "doc_id long, text string, grade int").repartition(3)
    collected = []
    plain = type(rated).collect
    monkeypatch.setattr(type(rated), "collect", lambda self: collected.append(self.columns) or plain(self))
    model = ordinal_quality.train(rated, 3)
    assert not [c for c in collected if "index" in c or "text" in c]
    monkeypatch.undo()
    taken = []
    fit = lambda rows: ordinal_quality.fit(
        np.concatenate(([0], np.cumsum([len(i) for i, _, _ in rows]))), np.concatenate([i for i, _, _ in rows]),
        np.concatenate([v for _, v, _ in rows]), np.array([g for _, _, g in rows]), 3)
    again = rated.where("doc_id = 500").orderBy(F.xxhash64("text", F.lit(12))).limit(ordinal_quality.PER_ID).collect()
    order = {r["doc_id"]: r["o"] for r in rated.select("doc_id", ordinal_quality.drawn("doc_id").alias("o")).distinct().collect()}
    hasher = WordHasher()
    for r in [*data, *map(tuple, again)]:
        i, v = ordinal_quality.features(hasher, np.frombuffer(r[1].encode(), np.uint8))
        taken.append(((order[r[0]], i.astype("<i4").tobytes(), v.astype("<f4").tobytes()), i, v, r[2]))
    taken = [x[1:] for x in sorted(taken, key=lambda x: x[0])]
    expected = fit(taken)
    assert np.allclose(model.weights, expected.weights, atol=1e-4) and np.allclose(model.thresholds, expected.thresholds, atol=1e-4)
    monkeypatch.setattr(ordinal_quality, "PART", 1000)
    cut = fit(taken)
    assert np.allclose(cut.weights, expected.weights, atol=1e-4) and np.allclose(cut.thresholds, expected.thresholds, atol=1e-4)


def brute_targets(sizes, most=3):
    names = sorted([s for s in sizes if s is not None], key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: (1, 2, 3)[k % 3] for k, s in enumerate(names)}
    total, cut = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in cut]
        left = total - sum(cut.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > most * sizes[s]]
        if not over:
            return share | cut
        cut |= {s: most * sizes[s] for s in over}


def test_targets(spark):
    draw = random.Random(3)
    for n in (1, 2, 5, 12):
        sizes = {f"s{k}é"[:draw.randrange(2, 4)] + str(k): int(10 ** (draw.random() * 5)) for k in range(n)} | {None: 50}
        df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r["source"]: r["target"] for r in mixing.source_targets(df).collect()}
        expected = brute_targets(sizes)
        assert all(math.isclose(got[s], expected[s], rel_tol=1e-9, abs_tol=1e-9) for s in sizes)


def test_splitting_tree_is_exact_and_fair():
    quotas = [1000, 1, 0, 333, 77]
    tree = mixing.splitting_tree(quotas, 7, 5)
    assert [sum(col) for col in zip(*tree)] == quotas and max(map(sum, tree)) - min(map(sum, tree)) <= 3
    assert tree == mixing.splitting_tree(quotas, 7, 5) != mixing.splitting_tree(quotas, 7, 6)
    draws = [mixing.hypergeometric(random.Random(k), 30, 50, 20) for k in range(4000)]
    variance = 20 * (30 / 80) * (50 / 80) * (60 / 79)
    assert abs(np.mean(draws) - 7.5) < 0.15 and abs(np.var(draws) - variance) < 0.3 and min(draws) >= 0 and max(draws) <= 20


@pytest.mark.parametrize("block_words", [65_536, 200])
def test_mix(spark, block_words):
    docs = mixing.sized(documents(spark, n=120), "doc_id", "source")
    rows, sources = mixing.mix(docs, shards=5, block_words=block_words, slices=4)
    rows, size = rows.cache(), {r["row"]: r for r in docs.collect()}
    assert {r["doc_id"] for r in size.values()} >= set(range(120))
    taken, by_shard = Counter(), Counter()
    for r in rows.collect():
        taken[r["row"]] += r["words"]
        by_shard[r["shard"]] += 1
    assert all(n <= 3 * size[k]["size"] for k, n in taken.items()) and set(by_shard) <= set(range(5))
    quota = {r["source"]: r["quota"] for r in sources.collect()}
    for source, wanted in quota.items():
        assert sum(n for k, n in taken.items() if size[k]["source"] == source) == wanted
    assert rows.select("row", "round").distinct().count() == rows.count()
    again, _ = mixing.mix(docs, shards=5, block_words=block_words, slices=4)
    assert sorted(map(str, again.collect())) == sorted(map(str, rows.collect()))


def test_mix_edges(spark):
    docs = documents(spark)
    assert mixing.mixed_documents(docs.limit(0)).count() == 0
    assert mixing.mixed_documents(docs.where("doc_id IN (13, 14, 15)")).count() == 0
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    texts = {t for _, t in pairs(docs)}
    cut = [r for r in mixed.collect() if r["text"] not in texts]
    assert len(cut) <= 6 and all(any(t.startswith(r["text"]) for t in texts) and r["n_chars"] == len(r["text"]) for r in cut)


def test_mixed_documents_are_in_the_order_of_the_tree(spark, tmp_path, monkeypatch):
    """Files hold shards with the tree's quotas, in the shuffled order; sources that lie apart in the input are mingled."""
    monkeypatch.setattr(mixing, "TASK_WORDS", 1_500)
    docs = spark.range(600).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") < 300, "a").otherwise("b").alias("source"),
        F.concat_ws(" ", F.lit("d"), F.col("id"), F.lit("c d e f g h i j")).alias("text"))
    docs.coalesce(1).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.schema(docs.schema).parquet(str(tmp_path / "docs"))
    sizes = mixing.sized(docs, "doc_id", "source")
    options = {"shards": 3, "block_words": 60, "slices": 4, "cycle": (1, 2)}
    rows, sources = mixing.mix(sizes, **options)
    block = F.pmod(mixing.keyed("0", F.col("doc_id")), F.col("blocks"))
    made = rows.join(sizes, "row").join(sources.select("source", "place", "blocks"), "source").withColumn("block", block).collect()
    draws = {(r["shard"], r["place"], r["round"], r["block"]) for r in made}
    count = Counter((shard, place) for shard, place, _, _ in draws)
    tree = mixing.splitting_tree([sum(n for (_, p), n in count.items() if p == place) for place in (1, 2)], 3, 0)
    assert [[count[shard, place] for place in (1, 2)] for shard in range(3)] == tree
    expected = [r["doc_id"] for r in sorted(made, key=lambda r: (r["shard"], r["shuffle_key"]))]
    mixing.mixed_documents(docs, **options).write.parquet(str(tmp_path / "mix"))
    files = sorted((tmp_path / "mix").glob("*.parquet"))
    found = [r["doc_id"] for f in files for r in spark.read.parquet(str(f)).collect()]
    assert len(files) > 3 and found == expected
    sources_in_order = [k < 300 for k in found]
    runs = sum(a != b for a, b in zip(sources_in_order, sources_in_order[1:]))
    assert runs > len(found) / 4


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").withColumn("kept", F.lit(1)).withColumn("__extra", F.lit("x"))
    sizes = []
    for name, step in corpus_pipeline.STAGES[:-1]:
        from gridweave.session import stage

        after = stage(step(spark, docs, FOLDER), name)
        assert after.columns == docs.columns
        sizes.append((docs.count(), after.count()))
        docs = after
    assert sizes[0][1] < sizes[0][0] and sizes[1][1] <= sizes[1][0] and sizes[2][0] == sizes[2][1]
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert pieces.selectExpr("sum(length)").first()[0] > 0
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_copies", "repeated_passages", "source_mix", "packed"]


def test_pipeline_keeps_columns_of_any_name(spark):
    """No stage loses or mixes up values of columns that are named as its own might be."""
    from gridweave.session import stage

    names = ["__tie", "__key", "__kept", "__every", "__text", "__d", "__t", "__h", "__row", "__doc", "__words", "row", "kept", "every", "tie", "id", "h",
             "kept_id", "kept_tie", "expected_grade", "tail_probability", "starts", "ends", "copies", "shard", "a.b", "key"]
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(60).withColumns({n: F.concat(F.lit(n), F.col("doc_id").cast("string")) for n in names})
    docs = stage(docs, "named")
    for name, step in corpus_pipeline.STAGES[:-1]:
        docs = stage(step(spark, docs, FOLDER), name)
        wrong = docs.where(" OR ".join(f"`{n}` <> concat('{n}', doc_id) OR `{n}` IS NULL" for n in names))
        assert docs.count() > 0 and wrong.count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).count() > 0


def test_pipeline_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for _, step in corpus_pipeline.STAGES:
        assert step(spark, docs, FOLDER).count() == 0
