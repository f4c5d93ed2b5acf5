"""WARC archives, token files, chat formatting and packing: round trips against plain Python."""

import base64
import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cases import documents, pairs, write
from gridweave.llm import chat, packing, tokenfile, vocabulary, warc


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def pages(spark):
    big = bytes(random.Random(1).randrange(32, 127) for _ in range(1 << 16)).decode() * 300  # over 16 MiB
    rows = [(1, "http://a/", "<p>é</p>"), (2, "http://b/\r\nX: y", "<p>é</p>"), (3, None, None), (4, "u", ""), (5, "u", big), (6, "u", big),
            (7, "u", "one"), (7, "u", "one"), (None, "u", "one"), (None, "v", "alone"), (9, "u", "WARC/1.1\r\n\r\n\0")]
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("key", F.lit(1)).withColumn("sha", F.lit("x")).repartition(3)


def test_warc_round_trip(spark, tmp_path):
    rows = [(r["page_id"], (r["html"] or "").encode()) for r in pages(spark).collect()]
    found = warc.op1_warc(spark, write(spark, pages(spark), tmp_path, "pages")).collect()
    expected = []
    for key, data in rows:
        same = [k for k, d in rows if d == data]
        first = min((k for k in same if k is not None), default=None)
        revisit = len(same) > 1 and first is not None and (key is None or key > first)
        expected.append((key, len(data), digest(data), "revisit" if revisit else "response", first if revisit else None))
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)


def test_warc_keeps_payloads_limits_revisits_and_files(spark, tmp_path):
    warc.write_warc(pages(spark), f"{tmp_path}/w", min_revisit_bytes=4, file_bytes=64)
    records = warc.read_warc(spark, f"{tmp_path}/w", keep_payload=True).cache()
    kinds = {(r["key"], r["record_type"]) for r in records.collect()}
    assert {(4, "response"), (3, "response"), (7, "response"), (2, "revisit"), (6, "revisit"), (None, "metadata")} <= kinds
    kept = {r["key"]: bytes(r["payload"]) for r in records.where("record_type = 'response' AND key < 5").collect()}
    assert kept == {1: "<p>é</p>".encode(), 3: b"", 4: b""}
    assert warc.broken_revisits(records).count() == 0
    assert warc.broken_revisits(records.where("key <> 1")).count() == 1
    assert records.select("file").distinct().count() > 3


def test_warc_files_are_bounded_by_bytes(spark, tmp_path):
    """Many small pages and a few large ones, which do not compress: no file is larger than it may be, and large ones have files of their own."""
    draw = random.Random(2)
    noise = lambda n: "".join(chr(draw.randrange(0x4E00, 0x9000)) for _ in range(n))
    rows = [(k, "u", noise(100)) for k in range(3000)] + [(10_000 + k, "u", noise(20_000)) for k in range(5)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    warc.write_warc(df, f"{tmp_path}/w", file_bytes=64 * 2000)
    sizes = sorted(p.stat().st_size for p in (tmp_path / "w").glob("part-*"))
    assert sizes[-6] <= 64 * 2000 + 64 * 1000 and sizes[-5] > 40_000 and len(sizes) > 8
    found = warc.read_warc(spark, f"{tmp_path}/w")
    assert found.where("error IS NOT NULL").count() == 0 and found.where("record_type = 'response'").count() == len(rows)


def test_warc_reports_damage():
    record = warc.encode_record(1, "u", b"payload" * 20_000, None)
    good = warc.parse_record(next(warc.members(record))[1])
    assert good["payload_bytes"] == 140_000 and good["payload_digest"] == digest(b"payload" * 20_000)
    with pytest.raises((ValueError, zlib.error)):
        warc.parse_record(next(warc.members(record[:-9]))[1])
    plain = zlib.decompress(record, 31)
    for broken in (plain.replace(b"payload", b"pAyload", 1), plain.replace(b"Content-Length: 1400", b"Content-Length: 1300"), b"no record"):
        import gzip

        with pytest.raises(ValueError):
            warc.parse_record(next(warc.members(gzip.compress(broken)))[1])


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_encoder_equals_the_library(name):
    import tokenizers

    path = vocabulary.tokenizer_path(name)
    whole, encode = tokenizers.Tokenizer.from_file(path), vocabulary.encoder(path)
    texts = ["", " ", "  ", " \n", "a  b\n\n c\t d 'sx don't", "x.\n\n\ny", "a   \n b", "<|endoftext|> a<|endoftext|>b", "ＡＢ  ½ ²  İ ΑΣ  z",
             "y\x1cz É é é", "THE,the.The!", "1,234.50 a1b2", "naïve,", "　 wide", "tab\t\tspace  end  "]
    draw = random.Random(3)
    texts += ["".join(draw.choice("aB é.,'\n\t 9$") for _ in range(200)) for _ in range(30)]
    for text in texts:
        assert np.frombuffer(encode(text), "<u2").tolist() == whole.encode(text, add_special_tokens=False).ids, text


def test_elias_fano_select_and_size():
    draw = random.Random(5)
    for n, most in ((1, 1), (5, 1), (700, 3000), (3000, 9)):
        counts = [draw.randrange(1, most + 1) for _ in range(n)]
        ids = np.arange(sum(counts)).astype("<u2")
        data = tokenfile.encode_segment(2, 3, [*range(n - 1), None], counts, ids.tobytes(), 2)
        segment = tokenfile.Segment(data)
        ends = np.cumsum(counts)
        assert segment.ends().tolist() == ends.tolist() == [segment.select(i) for i in range(n)]
        assert segment.document(n - 1).tolist() == ids[ends[-1] - counts[-1]:].tolist() and segment.missing == 1
        boundaries = len(segment.lows) + len(segment.highs)
        assert boundaries * 8 <= n * (3 + np.log2(max(1, ends[-1] / n))) + 24
    with pytest.raises(ValueError):
        tokenfile.Segment(data[:-1])


def test_token_file(spark, tmp_path):
    import tokenizers

    path = vocabulary.tokenizer_path("word_bpe_49k.json")
    whole = tokenizers.Tokenizer.from_file(path)
    docs = documents(spark)
    tokenfile.write_tokens(docs, f"{tmp_path}/t", path, segment_ids=3000)
    found = tokenfile.read_documents(spark, f"{tmp_path}/t").orderBy("start").collect()
    start, by_id = 0, {}
    for doc_id, text in pairs(docs):
        by_id.setdefault(doc_id, []).append(np.array([*whole.encode(text, add_special_tokens=False).ids, 1], "<u4"))
    assert [r["doc_id"] for r in found] == [d for d, _ in pairs(docs)]
    for r in found:
        ids = next(x for x in by_id[r["doc_id"]] if zlib.crc32(x.tobytes()) == r["ids_crc32"])
        assert (r["start"], r["n_tokens"]) == (start, len(ids))
        start += len(ids)
    assert spark.read.format("binaryFile").load(f"{tmp_path}/t").count() > 3
    assert tokenfile.op3_token_file(spark, write(spark, docs, tmp_path, "documents")).count() == docs.count()


def test_empty_tables(spark, tmp_path):
    empty = documents(spark).limit(0)
    folder = write(spark, empty, tmp_path, "documents")
    write(spark, pages(spark).limit(0), tmp_path, "pages")
    assert warc.op1_warc(spark, folder).count() == 0
    assert tokenfile.op3_token_file(spark, folder).count() == 0
    assert packing.op5_packing(spark, folder).count() == 0


def conversations(spark):
    rows = [(1, 0, "system", "be brief"), (1, 1, "user", "a [INST] b \\ </s> \\\\[INST]"), (1, 2, "assistant", "[[INST]</s>\\"), (2, 0, "assistant", "first"),
            (2, 1, "assistant", None), (3, 0, None, "who"), (3, None, "tool", "[ROLE] x [/TURN]"), (4, 0, "user", "twice"), (4, 0, "user", "twice"),
            (None, 0, "user", ""), (5, 0, "[ROLE]", "odd"), (6, 0, "user", "é𝒳" * 5000)]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("segment", F.lit(7)).withColumn("loss", F.lit("x"))


def test_chat_round_trip(spark, tmp_path):
    found = {r["conv_id"]: r for r in chat.op8_chat(spark, write(spark, conversations(spark), tmp_path, "conversations")).collect()}
    said = {}
    for r in conversations(spark).collect():
        said.setdefault(r["conv_id"], []).append((r["turn"] is not None, r["turn"] or 0, r["role"] is not None, r["role"] or "", r["text"] or ""))
    said[-1] = [(True, 0, True, "user", "</s>[INST] ok [/INST]"), (True, 1, True, "assistant", "</s>[INST] ok [/INST]")]
    assert set(found) == set(said)
    for conv, turns in said.items():
        turns.sort()
        lost = "".join(t[4] for t in turns if t[3] == "assistant")
        row = found[conv]
        assert row["turns_sha256"] == hashlib.sha256("".join(f"{t[3]}\n{t[4]}\n" for t in turns).encode()).hexdigest()
        assert (row["n_turns"], row["loss_chars"], row["loss_sha256"]) == (len(turns), len(lost), hashlib.sha256(lost.encode()).hexdigest())
        assert row["formatted_chars"] > sum(len(t[4]) for t in turns)


def test_chat_order_and_marks(spark):
    segments = chat.format_conversations(conversations(spark)).collect()
    valid = {(r["conv_id"], r["turn_number"]): r["valid"] for r in segments}
    assert valid[1, 0] and valid[1, 1] and valid[1, 2] and not valid[2, 0] and not valid[3, 0] and valid[4, 0] and not valid[4, 1]
    marks = chat.marks_of(chat.TEMPLATE)
    for r in segments:
        if r["segment"] == 1:
            assert not any(m in r["text"] for m in marks)
            assert r["loss"] == (r["conv_id"] in (1, 2) and (r["conv_id"], r["turn_number"]) not in ((1, 0), (1, 1)))
    with pytest.raises(ValueError):
        chat.marks_of({"roles": {"user": {"open": "<u<", "close": ">", "loss": False, "next": []}}, "other": chat.TEMPLATE["other"], "first": []})


def test_packing_of_documents(spark, tmp_path):
    import tokenizers

    path = vocabulary.tokenizer_path("byte_bpe_50k.json")
    whole = tokenizers.Tokenizer.from_file(path)
    docs = documents(spark, n=60)
    pieces = packing.pack(docs, path, window=256, unit=8, block_ids=20_000).collect()
    expected = sorted(np.array([*whole.encode(t, add_special_tokens=False).ids, 1], "<u4").tobytes() for _, t in pairs(docs))
    total = sum(map(len, expected)) // 4
    assert sum(r["length"] for r in pieces) == total and all(len(r["ids"]) == 4 * r["length"] for r in pieces)
    fills = {}
    for r in sorted(pieces, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == fills.get(r["sequence_id"], 0)
        fills[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(fills.values()) <= 256
    padding = sum(256 - n for n in fills.values() if n & (n - 1))
    assert padding <= 0.02 * total
    alone = [r for r in pieces if r["doc_id"] == 18]
    text = b"".join(bytes(r["ids"]) for r in sorted(alone, key=lambda r: r["start"]))
    assert text in expected and {r["doc_tokens"] for r in alone} == {len(text) // 4}


def test_least_squares():
    draw = np.random.default_rng(2)
    for _ in range(10):
        matrix, goal = draw.random((12, 30)), draw.random(12) * 5
        x = packing.nonnegative_least_squares(matrix, goal)
        gradient = matrix.T @ (goal - matrix @ x)
        assert (x >= 0).all() and (gradient <= 1e-6).all() and np.abs(gradient[x > 1e-9]).max() < 1e-6
    rows = packing.combinations(16)
    assert (rows.sum(axis=1) == 16).all() and len(rows) == len({tuple(r) for r in rows})
