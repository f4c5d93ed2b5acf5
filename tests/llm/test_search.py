"""Nearest vectors, spelling variants and tokenizer alignment against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from cases import documents, sentence
from pyspark.sql import functions as F

from gridweave.llm import alignment, neighbours, spelling
from gridweave.llm.vocabulary import tokenizer_path

VECTORS = "vec_id long, embedding array<float>, label int, row string, part int, asks string, score double, block int"


def vectors(spark, n=900, size=16, seed=1):
    draw = np.random.default_rng(seed)
    made = [(k, [float(x) for x in draw.standard_normal(size) * draw.choice([0.5, 1, 3])]) for k in range(n)]
    made[20] = (20, [10 * x for x in made[20][1]])
    made += [(1000 + k, made[20][1]) for k in range(60)]  # copies of a query, the longest vectors
    made += [(40, made[40][1]), (40, made[41][1]), (None, made[60][1])]
    made += [(2000, None), (2020, [0.0] * size), (2040, []), (2060, [None] + [1.0] * (size - 1)), (2080, [float("nan")] * size), (2081, [float("inf")] * size)]
    made += [(3000 + k, [1.0, float(k)]) for k in range(30)]  # another size
    return spark.createDataFrame([(i, v, 1, "r", 2, "a", 0.5, 3) for i, v in made], VECTORS), made


def valid(v):
    return bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)


@pytest.mark.parametrize("block,askers", [(1 << 14, 1 << 10), (200, 20)])
def test_neighbours_against_all_pairs(spark, block, askers):
    df, made = vectors(spark)
    found = defaultdict(list)
    for r in sorted(neighbours.nearest(df, F.col("vec_id") % 20 == 0, 20, block, askers).collect(), key=lambda r: r["rank"]):
        found[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    rows = [(i, np.array(v, np.float32).astype(float)) for i, v in made if valid(v)]
    queries = [(k, i, v) for k, (i, v) in enumerate(rows) if i is not None and i % 20 == 0]
    assert set(found) == {i for _, i, _ in queries}
    hits = total = 0
    for k, i, v in queries:
        others = [(-float((u * v).sum()), j is None, j or 0) for m, (j, u) in enumerate(rows) if m != k and len(u) == len(v)]
        best = sorted(others)[:20]
        if i == 40:
            assert len(found[i]) == 3 * 20  # three rows are queries by themselves
            continue
        assert [r for r, _, _ in found[i]] == list(range(1, len(best) + 1))
        hits += len({(j, n) for _, n, j in best} & {(j or 0, j is None) for _, j, _ in found[i]})
        total += len(best)
        scores = {(j, n): -s for s, n, j in others}
        assert all(abs(scores[j or 0, j is None] - s) < 1e-9 for _, j, s in found[i])
        assert [(-s, j is None, j or 0) for _, j, s in found[i]] == sorted((-s, j is None, j or 0) for _, j, s in found[i])
    assert hits >= 0.95 * total
    # A third and more equal vectors: ties go to the smallest ids.
    assert [j for _, j, _ in found[20]] == list(range(1000, 1020))


def test_neighbours_of_few_and_none(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5])], "vec_id long, embedding array<double>")
    rows = neighbours.nearest(df, F.col("vec_id") % 20 == 0).collect()
    assert [tuple(r) for r in rows] == [(0, 1, 1, 0.5)]
    assert neighbours.nearest(df.where("false"), F.lit(True)).count() == 0
    assert neighbours.nearest(df, F.lit(False)).count() == 0
    assert neighbours.nearest(df.limit(1), F.lit(True)).count() == 0


def test_neighbours_recall_on_table(spark):
    folder = "/root/testdata/sf0.01"
    rows = neighbours.op11_neighbours(spark, folder).collect()
    table = sorted((r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect())
    ids, data = np.array([i for i, _ in table]), np.array([v for _, v in table], float)
    hits = total = 0
    for q in np.flatnonzero(ids % 20 == 0):
        scores = data @ data[q]
        scores[q] = -np.inf
        hits += len(set(ids[np.argsort(-scores)[:20]].tolist()) & {r["vec_id"] for r in rows if r["query_id"] == ids[q]})
        total += 20
    assert len(rows) == total and hits >= 0.95 * total


def brute_variants(rows):
    small = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(small)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))

    out = {}
    for w, n in words.items():
        others = [v for v in words if near(v, w)]
        best = min(others, key=lambda v: (-words[v], v), default=None)
        out[w] = (best if best and words[best] >= 2 * n else None, n, len(others))
    full = {}
    for w, (form, n, n_near) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        full[w] = (form, root, n, n_near, words[form] if form else None)
    return full


def misspelt(draw, n=500):
    base = ["".join(draw.choice("abcdeéßÀ÷") for _ in range(draw.randrange(4, 9))) for _ in range(60)] + ["x" * 5000, "x" * 4999]
    texts = []
    for _ in range(n):
        words = []
        for _ in range(draw.choice([0, 3, 40])):
            w = draw.choice(base)
            if draw.random() < 0.3:
                k = draw.randrange(len(w))
                w = draw.choice([w[:k] + w[k + 1:], w[:k] + draw.choice("abz") + w[k:], w[:k] + draw.choice("abz") + w[k + 1:], w.upper(), w])
            words.append(w)
        texts.append(draw.choice([" ", "-", "\n", "1"]).join(words))
    return [(k // 2, t) for k, t in enumerate(texts)] + [(None, texts[2]), (7, None), (8, ""), (9, "ÀÉ'Éa ﬁx word_word " * 3)]


@pytest.mark.parametrize("tile", [4096, 3])
def test_spelling_against_all_pairs(spark, tile):
    rows = misspelt(random.Random(5))
    df = spark.createDataFrame([(i, t, "w", 1, 2, "x") for i, t in rows], "doc_id long, text string, word string, n int, size int, sign string").repartition(5)
    found = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in spelling.variants(df, tile).collect()}
    expected = brute_variants(rows)
    assert found == expected and sum(1 for v in expected.values() if v[0]) > 20


def test_spelling_long_texts_and_none(spark):
    rows = misspelt(random.Random(6), 60)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    expected = brute_variants(rows)
    found = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in spelling.variants(df, part=50).collect()}
    assert found == expected
    assert spelling.variants(df.where("false")).count() == 0


def test_roots_of_a_chain(spark):
    n = 37
    df = spark.createDataFrame([(f"w{k}", f"w{k + 1}") for k in range(n)], "word string, form string")
    assert {r["root"] for r in spelling.roots(df).collect()} == {f"w{n}"}


PATHS = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")


def brute_alignment(rows):
    import sentencepiece
    import tokenizers

    a_kind = tokenizers.Tokenizer.from_file(PATHS[0])
    a_kind.encode_special_tokens = True
    b_kind = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    alphabet = alignment.byte_level()

    def groups(text):
        data = (" " + text).encode()
        a, b = a_kind.encode(" " + text, add_special_tokens=False).ids, b_kind.encode(text)
        as_bytes = [bytes(alphabet[c] for c in a_kind.id_to_token(i)) for i in a]
        bs_bytes = [bytes([int(b_kind.id_to_piece(i)[3:5], 16)]) if b_kind.is_byte(i) else b_kind.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not text or b"".join(as_bytes) != data or b"".join(bs_bytes) != data:
            return None
        at_a, at_b = (np.cumsum([len(x) for x in y]).tolist() for y in (as_bytes, bs_bytes))
        out, i, j = [], 0, 0
        for end in sorted(set(at_a) & set(at_b)):
            p, q = at_a.index(end) + 1, at_b.index(end) + 1
            out.append((a[i:p], b[j:q]))
            i, j = p, q
        return len(a), len(b), out

    found = [(doc_id, groups(text or "")) for doc_id, text in rows]
    links = [Counter((x, y) for a, b in f[2] for x in a for y in b) if f else Counter() for _, f in found]
    holding = Counter(pair for some in links for pair in some)
    most = defaultdict(int)
    for (x, _), n in holding.items():
        most[x] = max(most[x], n)
    out = []
    for (doc_id, f), some in zip(found, links, strict=True):
        if f is None:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        said = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in f[2])
        out.append((doc_id, f[0], f[1], len(f[2]), sum(some.values()), sum(n for p, n in some.items() if holding[p] == most[p[0]]),
                    sum(n * holding[p] for p, n in some.items()), hashlib.sha256(said.encode()).hexdigest()))
    return sorted(out, key=str)


ODD = ["a", " a", "a ", "  ", "\n", " \n x", "x \n y\n  z ", "▁", "a▁b c", "<|endoftext|> and </s> <s>[INST]", "don't we'll I'M", "\x00 \x1c \x85 a\x1cb  c\x85 d", "é é ﬁ 　x\xa0y", "日本語 中文。テスト",
       "🙂🙂 👨‍👩‍👧 ok", "1234567 12,5 3.14!", "x" * 700, "ß" * 300 + " " + "𝒳" * 50, "a\tb\r\nc", "((()))):;!?...", "tail\n", "  line ", "<0x0A> <unk>", "ꙮ ᚠᛇᚻ"]


@pytest.mark.parametrize("flat", [4096, 3])
def test_alignment_of_odd_texts(flat, monkeypatch):
    monkeypatch.setattr(alignment, "FLAT", flat)
    both = alignment.Aligner(*PATHS)
    draw = random.Random(3)
    texts = ODD + [draw.choice(["", " ", "\n"]).join(draw.choices(ODD, k=5)) for _ in range(150)] + [sentence(draw, 50)]
    expected = brute_alignment([(k, t) for k, t in enumerate(texts)])
    found = [row for at in range(0, len(texts), 7) for row in both.many(texts[at:at + 7])]
    again = list(both.many(texts))
    for rows in (found, again):
        got = sorted([(k, a, b, g, n, s) for k, (a, b, g, n, s, _, _) in enumerate(rows)], key=str)
        assert got == [(k, a, b, g, n, s) for k, a, b, g, n, _, _, s in expected]


@pytest.mark.parametrize("chunk", [4 << 20, 300])
def test_alignment_against_brute_force(spark, chunk):
    df = documents(spark)
    odd = spark.createDataFrame([(100 + k, t) for k, t in enumerate(ODD * 2)], "doc_id long, text string")
    df = df.unionByName(odd, allowMissingColumns=True).withColumn("chunk", F.lit("c")).withColumn("pair", F.lit(1)).withColumn("copies", F.lit(0))
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    found = sorted([tuple(r) for r in alignment.measured(df, *PATHS, chunk).collect()], key=str)
    assert found == brute_alignment(rows)
    assert alignment.measured(df.where("false"), *PATHS).count() == 0
