"""Near-duplicates, repeated passages and fingerprints against brute force."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cases import WORD, documents, pairs, sentence, write
from gridweave.llm import fingerprints, graph, near_duplicates, repeats


def sets_of(text: str, size: int) -> set:
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + size]) for i in range(len(words) - size + 1)}


def brute_components(rows, size):
    sets = [sets_of(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= 80 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None]
        out.append((doc_id, len(sets[i]), min(ids, default=None)))
    return sorted(out, key=str)


def test_near_duplicates(spark):
    docs = documents(spark)
    found = near_duplicates.near_duplicates(docs, words=4)
    assert sorted(map(tuple, found.select("doc_id", "n_shingles", "component_id").collect()), key=str) == brute_components(pairs(docs), 4)
    assert near_duplicates.near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize("askers", [1, 7, 256])
def test_groups_that_no_single_text_holds_together(spark, askers, monkeypatch):
    """A chain of edits: neighbours are alike, ends are not, and no pivot is like all."""
    monkeypatch.setattr(near_duplicates, "ASKERS", askers)
    monkeypatch.setattr(near_duplicates.joining_links, "__defaults__", (askers,))
    draw = random.Random(9)
    words, rows = sentence(draw, 200).split(), []
    for k in range(60):
        for _ in range(2):
            words[draw.randrange(200)] = f"w{draw.randrange(10_000)}"
        rows.append((k * 3, " ".join(words)))
    for k in range(30):  # and a star around a text that is not there
        changed = sentence(random.Random(4), 150).split()
        for _ in range(5):
            changed[draw.randrange(150)] = f"v{draw.randrange(10_000)}"
        rows.append((1000 + k, " ".join(changed)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = near_duplicates.near_duplicates(docs, words=4).select("doc_id", "n_shingles", "component_id")
    assert sorted(map(tuple, found.collect()), key=str) == brute_components(rows, 4)


def test_one_of_each(spark):
    docs = documents(spark)
    kept = near_duplicates.one_of_each(docs, words=5)
    assert kept.columns == docs.columns
    ids = sorted(r["doc_id"] for r in kept.where("doc_id IS NOT NULL").collect())
    expected = brute_components(pairs(docs), 5)
    assert set(ids) == {d for d, n, c in expected if d is not None and (d == c or n == 0)}
    assert ids.count(9) == 1 and 8 not in ids and 13 in ids


def test_estimate_is_close(spark):
    draw = random.Random(2)
    rows = []
    for k in range(40):
        words = sentence(draw, 400).split()
        other = [w if draw.random() < 0.95 else "zz" + w for w in words]
        rows.append((k, " ".join(words), " ".join(other)))
    df = spark.createDataFrame(rows, "doc_id long, text string, other string")
    a = near_duplicates.signatures(df, 4).select("doc_id", F.col("bits").alias("a"))
    b = near_duplicates.signatures(df.select("doc_id", F.col("other").alias("text")), 4).select("doc_id", F.col("bits").alias("b"))
    got = {r["doc_id"]: r["e"] for r in a.join(b, "doc_id").select("doc_id", near_duplicates.estimate(F.col("a"), F.col("b")).alias("e")).collect()}
    errors = [got[k] - len(sets_of(x, 4) & sets_of(y, 4)) / len(sets_of(x, 4) | sets_of(y, 4)) for k, x, y in rows]
    assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.08


def test_components(spark):
    edges = [(k, k + 1) for k in range(1, 40)] + [(100, k) for k in range(200, 260)] + [(7, 7), (300, 301), (301, 300)]
    found = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{k: 1 for k in range(1, 41)}, 100: 100, **{k: 100 for k in range(200, 260)}, 300: 300, 301: 300}


def brute_repeats(rows, length):
    seen = {}
    data = [t.encode() for _, t in rows]
    for i, b in enumerate(data):
        for p in range(len(b) - length + 1):
            seen.setdefault(b[p:p + length], []).append((i, p))
    covered = [[] for _ in rows]
    for places in seen.values():
        if len(places) > 1:
            for i, p in places:
                covered[i].append(p)
    out = []
    for (doc_id, _), b, starts in zip(rows, data, covered, strict=True):
        runs = []
        for p in sorted(starts):
            if runs and p <= runs[-1][1]:
                runs[-1][1] = p + length
            else:
                runs.append([p, p + length])
        kept, at = b"", 0
        for s, e in [*runs, (len(b), len(b))]:
            kept, at = kept + b[at:s], e
        out.append((doc_id, len(b), sum(e - s for s, e in runs), len(runs), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize(("gathered", "groups"), [(1500, False), (1500, True), (1, False)])
def test_repeats(spark, gathered, groups, monkeypatch):
    monkeypatch.setattr(repeats, "CHUNK", 5000)
    docs = documents(spark)
    found = repeats.find_repeats(docs, length=120, gram=32, gathered=gathered, groups=groups)
    kept = repeats.cleaned(found, 120)
    got = docs.select("doc_id", repeats.text_key().alias("h")).join(kept, "h").select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert sorted(map(tuple, got.collect()), key=str) == brute_repeats(pairs(docs), 120)
    if groups:
        check_groups(docs, found, 120)
    spark.sql(f"DROP TABLE {found.name}")


def check_groups(docs, found, length):
    """Every group is of equal strings with all their occurrences, and all strings that are there twice lie in groups."""
    texts = {r["h"]: r["text"].encode() for r in found.texts.collect()}
    groups, starts = {}, {}
    for r in found.occurrences().collect():
        assert r["end"] - r["start"] >= length and r["end"] <= len(texts[r["h"]])
        groups.setdefault((r["repeat"], texts[r["h"]][r["start"]:r["end"]]), set()).add((r["h"], r["start"]))
    assert len({repeat for repeat, _ in groups}) == len(groups)  # one string a group
    for h, data in texts.items():
        for p in range(len(data) - length + 1):
            starts.setdefault(data[p:p + length], set()).add((bytes(h), p))
    covered = set()
    for (_, string), places in groups.items():
        assert len(places) > 1
        everywhere = {(bytes(h), p) for h, p in starts[string[:length]] if texts[h][p:p + len(string)] == string}
        assert {(bytes(h), p) for h, p in places} == everywhere
        covered |= {(h, p + k) for h, p in everywhere for k in range(len(string) - length + 1)}
    assert covered == {place for places in starts.values() if len(places) > 1 for place in places}


def test_repeats_query_and_stage(spark, tmp_path):
    docs = documents(spark)
    got = repeats.op6_repeats(spark, write(spark, docs, tmp_path, "documents"))
    assert sorted(map(tuple, got.drop("text").collect()), key=str) == brute_repeats(pairs(docs), 400)
    assert all(hashlib.sha256(r["text"].encode()).hexdigest() == r["kept_sha256"] for r in got.collect() if r["text"].isascii())
    cut = repeats.without_repeats(docs, 120, 32)
    assert cut.columns == docs.columns and cut.count() == docs.count()
    texts = {r["doc_id"]: r for r in cut.collect()}
    assert texts[7]["text"] == "" and texts[7]["n_chars"] == 0 and texts[13]["text"] is None
    assert repeats.without_repeats(docs.limit(0)).count() == 0


def test_planted_passages_by_n_removed(spark, tmp_path):
    """Passages of 51 words and more in two documents each: removed from 400 bytes on, no byte else; `n_bytes` is the size before."""
    draw = random.Random(12)
    rows, planted = [], {}
    for k in range(60):
        size = [399, 400, 401, 700][k % 4]
        passage = ""
        while len(passage) < size or len(passage[:size].split()) < 51:
            passage = " ".join("".join(draw.choice("abcdefgh") for _ in range(draw.randrange(3, 8))) for _ in range(size // 5))
        for border in "XY":  # the byte before and after differs, so the passage is all that is shared
            planted[len(rows)] = size if size >= 400 else 0
            rows.append((len(rows), sentence(draw, 80) + border + passage[:size] + border + sentence(draw, draw.choice([5, 200]))))
    rows += [(len(rows) + k, sentence(draw, draw.choice([10, 300]))) for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r for r in repeats.op6_repeats(spark, write(spark, docs, tmp_path, "documents")).collect()}
    assert {k: r["n_removed"] for k, r in got.items()} == {k: planted.get(k, 0) for k, _ in rows}
    assert all(got[k]["n_bytes"] == len(text.encode()) for k, text in rows)


def test_maximal_repeats_have_all_occurrences():
    draw = random.Random(6)
    text = lambda n: bytes(draw.randrange(97, 101) for _ in range(n))
    core = text(30)
    parts = [text(10) + core + text(9), text(4) + core + text(15), core + text(20), text(40) + core[:25]]
    starts = [len(p) - 19 for p in parts]
    found = list(repeats.maximal_repeats(parts, starts, 20, [1] * 4))
    for size, places in found:
        strings = {parts[k][p:p + size] for k, p in places}
        assert len(strings) == 1
        string = strings.pop()
        everywhere = {(k, p) for k, part in enumerate(parts) for p in range(starts[k]) if part[p:p + size] == string}
        assert everywhere == set(places) and len(places) > 1
        assert len({parts[k][p - 1] if p else -1 - k for k, p in places}) > 1
    assert any(size >= 30 and len(places) >= 3 for size, places in found)
    assert list(repeats.maximal_repeats(parts, starts, 20, [1, 2, 3, 4])) == []


def test_fingerprints(spark, tmp_path):
    docs = documents(spark).where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    rows = pairs(docs)
    got = {r["doc_id"]: r for r in fingerprints.op2_fingerprints(spark, write(spark, docs, tmp_path, "documents")).collect()}
    assert len(got) == len(rows)
    def exact(t: str) -> set:
        words = WORD.findall(t)
        return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()

    like = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    errors, prints = [], {}
    for k, (doc_id, text) in enumerate(rows):
        nxt = rows[(k + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + nxt[:half]
        r = got[doc_id]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        errors.append(r["near_edited"] - like(exact(text), exact(edited)))
        assert abs(r["near_next"] - like(exact(text), exact(nxt))) < 0.2
        assert prints.setdefault(text, r["fingerprint"]) == r["fingerprint"]
    assert abs(np.mean(errors)) < 0.05 and np.abs(errors).max() < 0.25
    assert got[14]["fingerprint"] == got[13]["fingerprint"] == got[15]["fingerprint"] == ""


@pytest.mark.parametrize("rows_per_part", [1000, 3])
def test_fingerprints_of_odd_tables(spark, tmp_path, rows_per_part, monkeypatch):
    monkeypatch.setattr(fingerprints.in_parts, "__defaults__", ("tie", rows_per_part, 20))
    hot = spark.createDataFrame([(50 if k % 3 else None, f"text {k} of a hot id", k) for k in range(90)], "doc_id long, text string, part int")
    docs = documents(spark).unionByName(hot, allowMissingColumns=True)
    found = fingerprints.op2_fingerprints(spark, write(spark, docs, tmp_path, "documents")).collect()
    ties = {r["text"] or "": r["tie"] for r in docs.select("text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("tie")).collect()}
    rows = sorted(((r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect()), key=lambda r: (r[0] is None, r[0] or 0, ties[r[1]]))
    expected = []
    for k, (doc_id, text) in enumerate(rows):
        half = len(text) // 2
        edited = text[:len(text) - half] + rows[(k + 1) % len(rows)][1][:half]
        expected.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest()))
    assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in found), key=str) == sorted(expected, key=str)
    (tmp_path / "one").mkdir()
    one = fingerprints.op2_fingerprints(spark, write(spark, docs.where("doc_id = 5"), tmp_path / "one", "documents")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0
    (tmp_path / "none").mkdir()
    assert fingerprints.op2_fingerprints(spark, write(spark, docs.limit(0), tmp_path / "none", "documents")).count() == 0


def test_parts_are_in_order(spark):
    draw = random.Random(1)
    rows = [(draw.randrange(1000) ** 2, draw.getrandbits(64) - (1 << 63)) for _ in range(3000)] + [(None, 1)]
    found = fingerprints.in_parts(spark.createDataFrame(rows, "v long, k long"), "v", "k", rows_per_part=50, ranges=10).collect()
    known = sorted((r["v"], r["part"]) for r in found if r["v"] is not None)
    assert all(a[1] <= b[1] for a, b in zip(known, known[1:]))
    assert max(r["part"] for r in found) == next(r["part"] for r in found if r["v"] is None)
    assert len({r["part"] for r in found}) > 20
