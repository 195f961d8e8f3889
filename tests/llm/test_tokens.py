"""Token files: ids of whole texts, exact round trip, order, odd rows."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from riskframe.llm import tokens

WORDS = public_tokenizers.path("word_bpe_49k.json")


def plain(tokenizer, text):
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], "<u4").tobytes()


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_are_those_of_whole_texts(name):
    path = public_tokenizers.path(name)
    tokenizer, encoder = Tokenizer.from_file(path), tokens.Encoder(path)
    rng = random.Random(4)
    parts = list("aAéÉßΣσς'sİ \n\t\r\x0b\x0ć̸ẞ019!,.#$<=>-_日ﬁ\x1c\x85 ") + ["'s", "'ll", "<|endoftext|>", "word", "Word,", "x" * 70]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(60))) for _ in range(500)] + ["", None]
    assert encoder.encode(texts, 2) == [plain(tokenizer, t) for t in texts]


def test_words_return_from_the_last_generation(monkeypatch):
    monkeypatch.setattr(tokens, "CACHED_WORDS", 3)
    encoder, tokenizer = tokens.Encoder(WORDS), Tokenizer.from_file(WORDS)
    for text in ("one two three, Four", "two five", "one two", "six seven ### eight", "Four five one"):
        assert encoder.encode([text], 2) == [plain(tokenizer, text)]


def test_case_and_marks_take_no_place_among_known_words():
    encoder, tokenizer = tokens.Encoder(WORDS), Tokenizer.from_file(WORDS)
    texts = pa.array(["skipped", None, "\t Alpha, alpha. ALPHA! Über\n\nüber\r", "", "can't", "Alpha"]).slice(1)
    assert encoder.encode(texts, 2) == [plain(tokenizer, t) for t in texts.to_pylist()]
    assert set(encoder.known) == {"", "alpha", "über", "can't", ",", ".", "!"}
    assert encoder.encode([], 2) == [] and encoder.encode(["", None]) == [b"", b""]


def test_slices_are_cut_by_bytes(monkeypatch):
    monkeypatch.setattr(tokens, "SLICE_BYTES", 10)
    batch = pa.RecordBatch.from_pydict({"t": ["four", None, "sixsix", "a" * 50, "b", "", "c"]})
    assert [x["t"].to_pylist() for x in tokens.slices_of(batch, "t")] == [["four", None, "sixsix"], ["a" * 50], ["b", "", "c"]]
    assert list(tokens.slices_of(batch.slice(0, 0), "t")) == []


def test_dictionary_of_few_and_many_samples(tmp_path):
    many = [np.arange(i, i + 400, dtype="<u4").tobytes() for i in range(300)]
    for samples in ([], many[:2], many):
        dictionary = tokens.train_dictionary(samples)
        writer = tokens.Writer(str(tmp_path / "a.rft"), dictionary)
        for i, ids in enumerate(many):
            writer.add(None if i == 299 else i, ids)
        assert writer.close() == (300, 300 * 400)
        reader = tokens.Reader(str(tmp_path / "a.rft"), dictionary)
        assert len(reader) == 300 and reader.ids(17) == many[17] and reader.ids(299) == many[299]
        assert reader.missing.tolist() == [0] * 299 + [1]
        with pytest.raises(ValueError, match="another dictionary"):
            tokens.Reader(str(tmp_path / "a.rft"), dictionary + b"x")


def test_cut_short_file_is_refused(tmp_path):
    path = tmp_path / "b.rft"
    writer = tokens.Writer(str(path), b"\0" * 64)
    writer.add(1, b"\1\0\0\0")
    writer.close()
    path.write_bytes(path.read_bytes()[:-3])
    with pytest.raises(ValueError):
        tokens.Reader(str(path), b"\0" * 64)


def check(spark, df):
    tokenizer = Tokenizer.from_file(WORDS)
    rows = sorted(tokens.encode_documents(spark, df, WORDS).collect(), key=lambda r: r.start)
    assert sorted((r.doc_id is None, r.doc_id or 0, bytes(r.ids)) for r in rows) == sorted(
        (r.doc_id is None, r.doc_id or 0, plain(tokenizer, r.text)) for r in df.select("doc_id", "text").collect()
    )
    keys = [(r.doc_id is None, r.doc_id or 0) for r in rows]
    assert keys == sorted(keys)
    at = 0
    for r in rows:
        assert r.start == at and r.n_tokens * 4 == len(r.ids)
        at += r.n_tokens


def test_round_trip_of_odd_rows(spark):
    odd = [(3, "b"), (1, None), (None, "no key"), (2, ""), (3, "b"), (-4, "Ärger! " * 5000), (9, "x" * 9000), (None, None)]
    check(spark, spark.createDataFrame([(*r, "s", 0) for r in odd], "doc_id long, text string, start string, k int"))
    hot = [(7, f"text number {i}") for i in range(200)] + [(i, "t") for i in range(100)]
    check(spark, spark.createDataFrame(hot, "doc_id long, text string"))


def test_dictionary_where_all_texts_are_long(spark):
    rng = random.Random(3)
    words = [f"word{i}" for i in range(300)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(3000))) for i in range(80)]
    assert min(len(t) for _, t in rows) > tokens.SAMPLE_CHARS
    df = spark.createDataFrame(rows, "doc_id long, text string")
    _, dictionary = tokens.write_tokens(df, tokens.shared_folder(spark, "long"), WORDS)
    assert dictionary[:4] == b"\x37\xa4\x30\xec"  # trained, not raw bytes


def test_files_end_at_their_size_and_the_largest_key_is_a_key(spark):
    rows = [(i, f"text number {i} " * 9) for i in range(200)] + [((1 << 63) - 1, "last"), (None, "none"), (-(1 << 63), "first")]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    files, dictionary = tokens.write_tokens(df, tokens.shared_folder(spark, "cut"), WORDS, file_bytes=400)
    assert files.count() > 16 and files.select("file_no").distinct().count() == files.count()
    got = sorted(tokens.read_tokens(files, dictionary).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [-(1 << 63), *range(200), (1 << 63) - 1, None]
    assert [r.start for r in got] == [sum(r.n_tokens for r in got[:i]) for i in range(len(got))]


def test_empty_table(spark):
    assert tokens.encode_documents(spark, spark.createDataFrame([], "doc_id long, text string"), WORDS).count() == 0


def test_query(spark, sf_dir):
    from riskframe.llm.queries import QUERIES

    tokenizer, at, want = Tokenizer.from_file(WORDS), 0, set()
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect():
        ids = plain(tokenizer, r.text)
        want.add((r.doc_id, at, len(ids) // 4, zlib.crc32(ids)))
        at += len(ids) // 4
    assert {tuple(r) for r in QUERIES["op9_token_files"](spark, sf_dir).collect()} == want
