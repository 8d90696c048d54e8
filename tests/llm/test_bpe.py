"""Encoding against the tiktoken library, exact round trips."""

import hashlib
import random

import public_tokenizers as public
import pytest
import tiktoken

from sluice.llm import bpe

PATH = public.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})


def _texts():
    rnd = random.Random(5)
    chars = "ab Z'st\n\t  09.!?é ß漢字😀 \u0085 ‍̀<|endoftext|>"
    made = ["".join(rnd.choice(chars) for _ in range(rnd.randrange(1, 300))) for _ in range(150)]
    long = " ".join(made) * 4
    assert len(long) > 2 * bpe.CHUNK / 2
    return ["", None, " ", "\n\n  x", "I'll we've DON'T", "<|endoftext|>", "x" * 3000, " " * 5000 + "a",
            long * 3, *made]


def test_same_ids_as_tiktoken_and_exact_decoding(spark, reference):
    texts = _texts()
    docs = spark.createDataFrame([(i, t, i, "x") for i, t in enumerate(texts)],
                                 "doc_id long, text string, ids int, bytes string")
    enc = bpe.encode(docs, PATH, public.PATTERN, offsets=True)
    rows = {r["doc_id"]: r for r in enc.collect()}
    for i, t in enumerate(texts):
        assert rows[i]["ids"] == reference.encode_ordinary(t or ""), repr(t)
    two = bpe.decode(enc, PATH).collect()
    assert sorted(map(str, two)) == sorted(map(str, bpe.round_trip(docs, PATH, public.PATTERN).collect()))
    for r in two:
        t = texts[r["doc_id"]] or ""
        assert bytes(r["bytes"]) == t.encode() and r["text"] == t


def test_offsets_cover_the_characters_of_each_token(spark, reference):
    text = "naïve 漢字 😀 end"
    row = bpe.encode(spark.createDataFrame([(1, text)], "doc_id long, text string"), PATH, public.PATTERN,
                     offsets=True).first()
    at = 0
    for token, a, b in zip(row["ids"], row["starts"], row["ends"], strict=True):
        raw = reference.decode_single_token_bytes(token)
        assert text[a:b].encode().find(raw) >= 0
        assert a <= len(text.encode()[:at].decode("utf-8", "ignore")) <= b
        at += len(raw)
    assert row["starts"][0] == 0 and row["ends"][-1] == len(text)


def test_split_characters_decode(spark):
    ids = bpe.encode(spark.createDataFrame([(1, "😀")], "doc_id long, text string"), PATH, public.PATTERN).first()["ids"]
    assert len(ids) > 1
    cut = spark.createDataFrame([(1, ids[:1]), (2, None), (3, [])], "doc_id long, ids array<int>")
    rows = {r["doc_id"]: r for r in bpe.decode(cut, PATH).collect()}
    assert "😀".encode().startswith(bytes(rows[1]["bytes"])) and "�" in rows[1]["text"]
    assert bytes(rows[2]["bytes"]) == b"" == bytes(rows[3]["bytes"])


def test_latin_texts_are_cut_alike():
    enc = bpe._Encoder(bpe.load_vocabulary(PATH)[0], public.PATTERN)
    assert enc.latin is not None and bpe.latin_pattern(r"\p{Han}+") is None
    chars = [chr(c) for c in range(0x2100) if bpe._LATIN.fullmatch(chr(c))]
    assert len(chars) > 500
    rnd = random.Random(2)
    texts = ["".join(f"a{c}{c} {c}1 {c}'s \n{c}" for c in chars[i::40]) for i in range(40)]
    texts += ["".join(rnd.choices(chars + list(" \n'st9") * 30, k=400)) for _ in range(200)]
    for t in texts:
        assert bpe._LATIN.fullmatch(t) and enc.latin.findall(t) == [p for p, _ in enc.split.pre_tokenize_str(t)]


def test_bounded_cache_gives_the_same_ids(spark, reference, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 10)
    model, _ = bpe.load_vocabulary(PATH)
    enc = bpe._Encoder(model, public.PATTERN)
    texts = ["some words that are more than ten pieces, all told, are here", "again some words that differ"] * 3
    assert [enc.ids([t])[0].tolist() for t in texts] == [reference.encode_ordinary(t) for t in texts]


def test_query_digests(spark, tmp_path, reference):
    rows = [(1, "Hello wörld"), (2, None), (3, "")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in bpe.op6_query(spark, str(tmp_path)).collect()}
    for i, t in rows:
        ids = reference.encode_ordinary(t or "")
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256((t or "").encode()).hexdigest()


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.decode(bpe.encode(docs, PATH, public.PATTERN), PATH).count() == 0
