"""Token ids in binary files: one zstandard frame per document, one dictionary for all files.

A file holds, little-endian: the magic ``RFTOK1\\0\\0``; the SHA-256 of the dictionary; the frames;
the footer (a zstandard frame of the columns doc_id int64, missing uint8, offset uint64, length
uint32, n_tokens uint32); the footer's length and the number of documents (uint64 each); the magic
again. Any document can be read alone by its footer entry. Ids are unsigned 32-bit integers.
"""

from __future__ import annotations

import hashlib
import os
import re
import string
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskframe.llm.common import attempt_name, opened, shared_folder, worker_cache
from riskframe.session import materialise, shuffle_width

MAGIC = b"RFTOK1\0\0"
#: The dictionary is trained on one slice each, of at most so many characters, of at most so many documents.
SAMPLE_DOCUMENTS, SAMPLE_CHARS, DICTIONARY_BYTES = 512, 4096, 65536
#: A file that has grown to this size is closed and followed by another.
FILE_BYTES = 256 << 20
#: Texts that are encoded at once: of this many bytes, or one.
SLICE_BYTES = 2 << 20
#: Words whose ids a worker keeps, and the longest such word.
CACHED_WORDS, CACHED_CHARS = 400_000, 48
_LAST = (1 << 63) - 1

_PROBE = "It's a test, 12 tests!\nThé end\t.."
# Latin letters with a tail of marks: two matches of the pattern at least, and lower-casing letter by
# letter is what the tokenizer does, so that case and tail need no encoding of their own.
_LATIN = "^[A-Za-zÀ-ÖØ-öø-ÿ]+$"
_LETTERS = "".join(c for c in map(chr, range(256)) if re.match(_LATIN, c))
_MARKS = string.punctuation


def runs(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The runs between blanks, tabs and line ends, in order, and their number per text; NULL has none."""
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data or b"", np.uint8)[bounds[0] : bounds[-1]]
    bounds = bounds - bounds[0]
    inside = (data != 32) & (data != 10) & (data != 9) & (data != 13)
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    filled = bounds[1:] > bounds[:-1]
    for edge, at in ((first, bounds[:-1][filled]), (last, bounds[1:][filled] - 1)):
        edge[at] = inside[at]
    starts = np.flatnonzero(first)
    ends = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(np.flatnonzero(last) + 1 - starts, out=ends[1:])
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(ends), pa.py_buffer(data[inside]))
    return words, np.diff(np.searchsorted(starts, bounds))


class Encoder:
    """Ids of whole texts, as bytes.

    Where the vocabulary drops white space, its pattern never crosses it, nor does a normal form:
    the distinct runs of a slice of texts are then split into lower-cased letters and marks behind
    them, ids of parts seen before are looked up, and those of the texts gathered from them. Other
    vocabularies encode each text as it is.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        whole = self.tokenizer.encode(_PROBE, add_special_tokens=False).ids
        parts = [self.tokenizer.encode(w, add_special_tokens=False).ids for w in _PROBE.split()]
        self.by_run = whole == sum(parts, [])
        self.letters = Tokenizer.from_file(path)  # for runs of lower-case letters: no pattern to match
        self.letters.normalizer = normalizers.Sequence([])
        self.letters.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        probe = "these are plain wörds été año"
        if self.letters.encode(probe).ids != self.tokenizer.encode(probe).ids:
            self.letters = self.tokenizer
        self.known: dict[str, bytes] = {"": b""}
        self.old: dict[str, bytes] = {}

    @classmethod
    def of(cls, path: str) -> Encoder:
        cache = worker_cache()
        if ("encoder", path) not in cache:
            cache["encoder", path] = cls(path)
        return cache["encoder", path]

    def encode(self, texts: list[str | None] | pa.Array, end: int | None = None) -> list[bytes]:
        tail = b"" if end is None else struct.pack("<I", end)
        if not self.by_run:
            texts = texts.to_pylist() if isinstance(texts, pa.Array) else texts
            return [ids + tail for ids in self._texts([t or "" for t in texts])]
        if not isinstance(texts, pa.Array):
            texts = pa.array(texts, pa.large_string())
        if not len(texts):
            return []
        words, counts = runs(texts)
        words = words.dictionary_encode()  # each run of these texts is taken apart and looked up once
        whole = words.dictionary
        cores = pc.utf8_rtrim(whole, _MARKS)
        latin = pc.match_substring_regex(cores, _LATIN)
        cores = pc.if_else(latin, pc.utf8_lower(cores), whole).dictionary_encode()
        marks = pc.if_else(latin, pc.utf8_ltrim(whole, _LETTERS), "").dictionary_encode()
        plain = pc.match_substring_regex(cores.dictionary, _LATIN).to_pylist()
        ids = self._ids(cores.dictionary.to_pylist(), plain)
        ids += self._ids(marks.dictionary.to_pylist())
        ids.append(tail)
        pairs = np.stack([cores.indices.to_numpy(), marks.indices.to_numpy() + len(cores.dictionary)], 1)
        order = pairs.take(words.indices.to_numpy(), 0).reshape(-1)
        order = np.insert(order, 2 * np.cumsum(counts), len(ids) - 1)  # texts, each with its end
        lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        n = lengths.take(order)
        stops = np.cumsum(n)
        at = np.repeat((np.cumsum(lengths) - lengths).take(order) - (stops - n), n)
        at += np.arange(len(at))
        out = np.frombuffer(b"".join(ids), "<u4").take(at).tobytes()
        cuts = (4 * stops[np.cumsum(2 * counts + 1) - 1]).tolist()
        return [out[lo:hi] for lo, hi in zip([0, *cuts], cuts)]

    def _ids(self, words: list[str], plain: list[bool] | None = None) -> list[bytes]:
        """Ids of distinct words; ``plain`` ones are lower-case Latin letters only."""
        if len(self.known) > CACHED_WORDS:  # words of the last generation come back when seen again
            self.known, self.old = {"": b""}, self.known
        known, old = self.known, self.old
        found = list(map(known.get, words))
        new = [i for i, ids in enumerate(found) if ids is None]
        for i in new:
            found[i] = known[words[i]] = old.get(words[i])
        new = [i for i in new if found[i] is None]
        for encode, kind, step in ((self._matches, True, 256), (self._texts, False, 4096)):
            chosen = [i for i in new if (plain is not None and plain[i]) is kind]
            for at in range(0, len(chosen), step):
                part = chosen[at : at + step]
                for i, ids in zip(part, encode([words[i] for i in part])):
                    found[i] = known[words[i]] = ids
        for i in new:
            if len(words[i]) > CACHED_CHARS:
                del known[words[i]]
        return found

    def _texts(self, words: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [np.array(x.ids, "<u4").tobytes() for x in found]

    def _matches(self, words: list[str]) -> list[bytes]:
        """The same for words that are one match of the pattern each, as one text."""
        found = self.letters.encode(" ".join(words), add_special_tokens=False)
        ids = np.array(found.ids, "<u4").tobytes()
        cuts = (4 * np.searchsorted(np.array(found.word_ids), np.arange(len(words) + 1))).tolist()
        return [ids[lo:hi] for lo, hi in zip(cuts, cuts[1:])]


def train_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A shared dictionary; of too few samples to train on, their own last bytes."""
    import zstandard

    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return (b"\0" * 8 + b"".join(samples))[-size:]


def _zdict(data: bytes):
    import zstandard

    trained = data[:4] == b"\x37\xa4\x30\xec"  # the magic number of trained dictionaries
    kind = zstandard.DICT_TYPE_FULLDICT if trained else zstandard.DICT_TYPE_RAWCONTENT
    return zstandard.ZstdCompressionDict(data, dict_type=kind)


class Writer:
    """One token file."""

    def __init__(self, path: str, dictionary: bytes):
        import zstandard

        system, inside = opened(path)
        self.out = system.open_output_stream(inside)
        self.frames = zstandard.ZstdCompressor(level=3, dict_data=_zdict(dictionary))
        self.columns = [[], [], [], [], []]
        self.at = self.out.write(MAGIC + hashlib.sha256(dictionary).digest())

    def add(self, doc_id: int | None, ids: bytes) -> None:
        frame = self.frames.compress(ids)
        row = (doc_id or 0, doc_id is None, self.at, len(frame), len(ids) // 4)
        for column, value in zip(self.columns, row):
            column.append(value)
        self.at += self.out.write(frame)

    def close(self) -> tuple[int, int]:
        """(documents, tokens)."""
        import zstandard

        kinds = ("<i8", "u1", "<u8", "<u4", "<u4")
        footer = zstandard.compress(b"".join(np.array(c, k).tobytes() for c, k in zip(self.columns, kinds)))
        n = len(self.columns[0])
        self.out.write(footer + struct.pack("<QQ", len(footer), n) + MAGIC)
        self.out.close()
        return n, sum(self.columns[4])


class Reader:
    """Documents of one token file, in order or by position."""

    def __init__(self, path: str, dictionary: bytes):
        import zstandard

        system, inside = opened(path)
        self.file = system.open_input_file(inside)
        size = self.file.size()
        head, tail = self.file.read_at(40, 0), self.file.read_at(24, size - 24)
        if head[:8] != MAGIC or tail[16:] != MAGIC:
            raise ValueError(f"{path}: not a token file, or cut short")
        if head[8:] != hashlib.sha256(dictionary).digest():
            raise ValueError(f"{path}: written with another dictionary")
        length, n = struct.unpack("<QQ", tail[:16])
        footer = zstandard.decompress(self.file.read_at(length, size - 24 - length))
        kinds, at, columns = ("<i8", "u1", "<u8", "<u4", "<u4"), 0, []
        for kind in kinds:
            columns.append(np.frombuffer(footer, kind, n, at))
            at += columns[-1].nbytes
        self.doc_id, self.missing, self.offset, self.length, self.n_tokens = columns
        self.frames = zstandard.ZstdDecompressor(dict_data=_zdict(dictionary))

    def __len__(self) -> int:
        return len(self.doc_id)

    def ids(self, i: int) -> bytes:
        """Serialized ids of the document at position ``i``: one read, one frame."""
        return self.frames.decompress(self.file.read_at(int(self.length[i]), int(self.offset[i])))


def slices_of(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``SLICE_BYTES`` of text."""
    sizes = pc.binary_length(batch[text]).fill_null(0).to_numpy().astype(np.int64)
    starts = np.flatnonzero(np.diff((np.cumsum(sizes) - sizes) // SLICE_BYTES, prepend=-1)).tolist()
    for lo, hi in zip(starts, [*starts[1:], batch.num_rows]):
        yield batch.slice(lo, hi - lo)


def _bucket(bounds: list[int], key: Column, spread: Column) -> Column:
    """Range of each key; keys that fill several ranges are spread over them."""

    @F.pandas_udf("int")
    def run(keys: pd.Series, salt: pd.Series) -> pd.Series:
        edges, x = np.array(bounds, np.int64), keys.to_numpy()
        low, high = np.searchsorted(edges, x, "left"), np.searchsorted(edges, x, "right")
        inner = np.maximum(high - low - 1, 0)  # whole ranges of this key alone
        return pd.Series((low + np.where(inner > 0, 1 + salt.to_numpy() % np.maximum(inner, 1), 0)).astype(np.int32))

    return run(key, spread)


def write_tokens(
    documents: DataFrame,
    folder: str,
    vocabulary: str,
    end: int | None = 2,
    key: str = "doc_id",
    text: str = "text",
    file_bytes: int = FILE_BYTES,
) -> tuple[DataFrame, bytes]:
    """Write all documents in ascending key order; returns (files, dictionary).

    ``files``: file_no long (ascending with the keys), path, n_docs and n_tokens long; it names the
    files of the attempts that counted, others are left unread. Missing texts are empty, missing
    keys come last, repeated keys stand side by side in any order; an empty table gives no file.
    """
    spark = documents.sparkSession
    rows = documents.select(F.coalesce(F.col(key), F.lit(_LAST)).alias("k"), F.col(key).isNull().alias("m"), F.col(text).alias("t"))
    drawn = rows.where(F.octet_length("t") > 0).select(F.xxhash64("k", F.lit(9)).alias("h"), F.xxhash64("t").alias("h2"), "t")
    room = F.greatest(F.length("t") - SAMPLE_CHARS, F.lit(0)) + 1  # starts that a slice of the text may have
    cut = F.substring(F.col("t"), F.pmod("h2", room).cast("int") + 1, F.lit(SAMPLE_CHARS))
    slices = drawn.select("h", "h2", cut.alias("t")).orderBy("h", "h2").limit(SAMPLE_DOCUMENTS).select("t")

    def samples(batches):
        for b in batches:
            got = Encoder.of(vocabulary).encode(b["t"], end)
            yield pa.RecordBatch.from_pydict({"ids": pa.array(got, pa.binary())})

    dictionary = train_dictionary([bytes(r.ids) for r in slices.mapInArrow(samples, "ids binary").collect()])

    width = shuffle_width(spark)
    shares = [i / width for i in range(1, width)]
    bounds = rows.agg(F.percentile_approx("k", F.array(*map(F.lit, shares)), 100 * width)).first()[0] if shares else []
    system, inside = opened(folder)
    system.create_dir(inside, recursive=True)

    def write(batches):
        encoder, out, path, part = Encoder.of(vocabulary), None, None, 0

        def closed():
            n, tokens = out.close()
            row = {"file_no": (number << 32) + part, "path": path, "n_docs": n, "n_tokens": tokens}
            return pa.RecordBatch.from_pylist([row], schema=files_schema)

        for b in batches:
            number = b["b"][0].as_py()
            for rows in slices_of(b, "t"):
                encoded = encoder.encode(rows["t"], end)
                for k, missing, ids in zip(rows["k"].to_pylist(), rows["m"].to_pylist(), encoded):
                    if out is None:
                        path = f"{folder}/{attempt_name('tokens')}-{part}.rft"
                        out = Writer(path, dictionary)
                    out.add(None if missing else k, ids)
                    if out.at >= file_bytes:
                        yield closed()
                        out, part = None, part + 1
        if out is not None:
            yield closed()

    files_schema = pa.schema([("file_no", pa.int64()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())])
    files = (
        rows.withColumn("b", _bucket(bounds or [], F.col("k"), F.coalesce(F.crc32("t"), F.lit(0)) + F.spark_partition_id()))
        .repartitionById(width, "b")
        .sortWithinPartitions("k", "m")
        .mapInArrow(write, "file_no long, path string, n_docs long, n_tokens long")
    )
    return materialise(files, "token-files"), dictionary


def read_tokens(files: DataFrame, dictionary: bytes, key: str = "doc_id") -> DataFrame:
    """Documents of the files: key, start (tokens of all documents before), n_tokens, ids (binary).

    Each file is read by one task; starts follow from the files' totals, one row per file.
    """
    earlier = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
    begins = files.withColumn("start", F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0)))
    schema = pa.schema([(key, pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def read(batches):
        for b in batches:
            for path, start in zip(b["path"].to_pylist(), b["start"].to_pylist()):
                file = Reader(path, dictionary)
                n = file.n_tokens.astype(np.int64)
                starts = start + np.cumsum(n) - n
                for at in range(0, len(file), 512):
                    part = slice(at, at + 512)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(file.doc_id[part], mask=file.missing[part].astype(bool)),
                            pa.array(starts[part]),
                            pa.array(n[part]),
                            pa.array([file.ids(i) for i in range(at, min(at + 512, len(file)))], pa.binary()),
                        ],
                        schema=schema,
                    )

    width = shuffle_width(files.sparkSession)
    return begins.select("path", "start").repartition(width, "path").mapInArrow(
        read, f"`{key}` long, start long, n_tokens long, ids binary"
    )


def encode_documents(
    spark: SparkSession, documents: DataFrame, vocabulary: str, end: int | None = 2, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Write token files to the shared folder and read them back."""
    files, dictionary = write_tokens(documents, shared_folder(spark, "tokens"), vocabulary, end, key, text)
    return read_tokens(files, dictionary, key)


def checksum(ids: Column) -> Column:
    """Unsigned CRC-32 of serialized ids."""
    return F.crc32(ids)


def crc32(ids: bytes) -> int:
    return zlib.crc32(ids)
