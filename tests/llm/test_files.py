"""Packing and WARC round trips."""

import gzip
import hashlib
import io
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cartulary.llm import packing, queries, warc
from tests.llm.test_documents import same_as_sql

PATH = public_tokenizers.path("word_bpe_49k.json")


def check_packing(rows, docs, padding):
    tokenizer = Tokenizer.from_file(PATH)
    want = sorted((d is not None, d or 0, [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]) for d, t in docs)
    by_doc, by_sequence = {}, {}
    for r in rows:
        assert r.length > 0 and len(r.ids) == 4 * r.length
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    got = []
    for doc, pieces in by_doc.items():
        if len({(r.start, r.length, bytes(r.ids)) for r in pieces}) < len(pieces) or doc is None:
            continue  # repeated rows: their sequences are checked below
        pieces.sort(key=lambda r: r.start)
        ids = np.frombuffer(b"".join(r.ids for r in pieces), "<u4").tolist()
        assert [r.start for r in pieces] == [sum(p.length for p in pieces[:i]) for i in range(len(pieces))]
        assert {r.doc_tokens for r in pieces} == {len(ids)}
        got.append((True, doc, ids))
    assert all(x in want for x in got)
    assert sum(r.length for r in rows) == sum(len(x[2]) for x in want)
    waste = 0
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r.offset)
        assert [r.offset for r in pieces] == [sum(p.length for p in pieces[:i]) for i in range(len(pieces))]
        size = sum(r.length for r in pieces)
        assert size <= 2048
        waste += 0 if size & (size - 1) == 0 else 2048 - size
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    assert waste <= padding


def test_packing(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    check_packing(packing.pack(docs, PATH).collect(), [(r.doc_id, r.text) for r in docs.collect()], 0)
    some = queries.op6_packing(spark, folder).collect()
    tokenizer = Tokenizer.from_file(PATH)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in some[:50]:
        ids = [*tokenizer.encode(texts[r.doc_id], add_special_tokens=False).ids, 1][r.start : r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())


def test_packing_edges(spark, edge_docs, no_docs):
    check_packing(packing.pack(edge_docs, PATH).collect(), [(r.doc_id, r.text) for r in edge_docs.collect()], 0)
    assert packing.pack(no_docs, PATH).count() == 0
    hot = spark.createDataFrame([(i, "word " * 700) for i in range(60)], "doc_id long, text string").repartition(4)
    check_packing(packing.pack(hot, PATH).collect(), [(r.doc_id, r.text) for r in hot.collect()], 0)


@pytest.mark.parametrize("text", ["it's we'll\tfoo\r\nbar", "a.b, c., d.. e,", "<|ENDOFTEXT|> <|endoftext|>", "İ ß Ⅷ ½", "Á A\u0301. \u0301, x", "日本語。 😀😀", ""])
def test_tokens_are_the_tokenizers(text):
    tokens, tokenizer = packing.Tokens(PATH), Tokenizer.from_file(PATH)
    for _ in range(2):
        assert np.frombuffer(tokens(text), "<u2").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_repeat_counts_never_overdraw():
    rng = np.random.default_rng(1)
    for _ in range(20):
        histogram = rng.integers(0, 1000, 32) * (rng.random(32) < 0.6)
        histogram[0] = 0
        shapes, counts = packing.repeat_counts(histogram, 32, 4)
        used = sum(np.bincount(s, minlength=32) * c for s, c in zip(shapes, counts))
        assert (used <= histogram).all() and min(counts) >= 0 and all(sum(s) == 32 for s in shapes)


def test_warc_equals_sql(spark, folder):
    same_as_sql(spark, folder, "op7_warc")


def test_warc_round_trip(spark, tmp_path):
    long = "x" * 3_000_000
    rows = [(1, "http://a/é b", "é" * 60), (2, "http://b", "é" * 60), (3, None, None), (4, "http://c\r\nX: y", "short"), (5, "http://d", "short"), (None, "http://e", "é" * 60), (6, "u", long), (6, "u", long), (7, "u", "a\r\n\r\nb" * 30)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("record_type", F.lit(1))
    manifest = warc.write_archives(pages, str(tmp_path / "archives"), archive_bytes=2000)
    got = warc.read_archives(manifest).collect()
    assert len(got) == len(rows) == sum(r.records for r in manifest.collect())
    kinds = sorted((str(r.page_id), r.record_type, r.refers_to) for r in got)
    assert kinds == sorted([("1", "response", None), ("2", "revisit", 1), ("3", "response", None), ("4", "response", None), ("5", "response", None), ("None", "revisit", 1), ("6", "response", None), ("6", "response", None), ("7", "response", None)])
    texts = {r[0]: r[2] for r in rows}
    for r in got:
        payload = (texts[r.page_id] or "").encode()
        assert r.payload_bytes == len(payload) and r.payload_digest == hashlib.sha256(payload).hexdigest()
        assert r.record_type == "revisit" or bytes(r.payload) == payload
    assert warc.read_archives(warc.write_archives(pages.limit(0), str(tmp_path / "none"))).count() == 0


def test_damage_is_found():
    data = warc.record(1, "http://a", b"payload", hashlib.sha256(b"payload").hexdigest(), None, False)
    assert len(list(warc.members(io.BytesIO(data * 3)))) == 3
    with pytest.raises(ValueError, match="ends within"):
        list(warc.members(io.BytesIO(data[:-9])))
    plain = gzip.decompress(data)
    with pytest.raises(ValueError, match="digest"):
        warc.parsed(plain.replace(b"payload\r", b"pAyload\r"))
    with pytest.raises(ValueError, match="bytes long"):
        warc.parsed(plain[:-1])


def test_ids_of_words_of_all_scripts():
    """Word by word and in whole texts: letters that come apart when normalised, marks, several stops, random strings."""
    from unicodedata import category

    from tokenizers import Tokenizer

    tokens, tokenizer = packing.Tokens(PATH), Tokenizer.from_file(PATH)
    assert tokens.by_word and tokens.width == "<u2"
    rng = random.Random(5)
    chars = [chr(c) for c in range(32, 0x2FFFF) if category(chr(c))[0] in "LNPMSZ"]
    words = ["\u0130.", "a\u0130,", "\u09b9\u09df,", "\u09ac\u09dc.", "\u0932\u095c.", "e\u0301.", "x,.", "a..", "it's,", "", "\t.", "<|x", "\u00e9.", "\u65e5."]
    words += ["".join(rng.choices(chars, k=rng.randrange(1, 5))) + rng.choice([".", ",", "", ".a"]) for _ in range(3000)]
    texts = words + [" ".join(rng.choices(words, k=6)) for _ in range(500)]
    want = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u2").tolist() for x in tokens.many(texts)] == want
    tokens.by_word = False
    assert [np.frombuffer(x, "<u2").tolist() for x in tokens.many(texts)] == want
