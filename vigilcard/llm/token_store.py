"""Token ids as binary files with a shared dictionary and an index for single documents.

Format. A store is a folder of two tables. ``dictionary`` holds one zstandard dictionary,
trained on serialized id arrays, and its SHA-256. ``frames`` holds frames in ascending doc_id
order; ``frame`` is a self-contained file of its own:

    magic "VTOK1\\0\\0\\0", dictionary hash (32 bytes), documents n (u32), bytes per id (u32),
    n document ids (i64; a bit set of null ids follows), n id counts (u64),
    n + 1 offsets into the body (u64), body: one zstandard frame per document

All numbers are little-endian; ids are written as u16 when the vocabulary fits, else u32. Each
document is compressed separately with the dictionary, so reading one document takes its
frame's index and one slice. Frames are cut at ``FRAME`` bytes of body or ``FRAME_DOCUMENTS``
documents; a single longer document is a frame of its own. ``part`` and ``seq`` order frames;
``tokens`` counts their ids, so the position of any document follows without decoding.

Order: documents are dealt by ranges of doc_id and sorted within; positions come from token
sums per part and per frame, so nothing but one number per part meets in one task. Rows that
share a doc_id are ordered by their text.

Defined cases: a null text is an empty one; an empty text has the end id only; null doc_ids
come first; repeated rows are stored each; an empty table gives an empty store; other columns
are ignored. The dictionary is trained on a bounded sample (``SAMPLE`` documents, least hash of
the id, at most ``SAMPLE_IDS`` ids of each); a sample too small for training gives an empty
dictionary and plain zstandard frames.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigilcard.llm.common import pieces
from vigilcard.sources.scratch import scratch_path

# How the vocabulary's tokenizer cuts lower-cased text.
_PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_²³¹¼½¾]+|[\d²³¹¼½¾]|(?:[^\w\s]|_)+")
# The letter that byte-level vocabularies write for each byte: itself if it is a visible Latin-1
# sign, else the next of the letters from U+0100 on.
_VISIBLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTE_LETTERS = {b: chr(0x100 + k) for k, b in enumerate(sorted(set(range(256)).difference(_VISIBLE)))}
# Beyond Latin letters up to U+017F (without those that change under lower-casing or
# normalisation in their own ways) and common signs, a text is encoded whole.
_UNUSUAL = re.compile("[^\\t\\n\\r\\x20-\\x7e\\xa1-\\u012f\\u0131-\\u017e\\u2013-\\u201d\\u20ac]")
MAGIC = b"VTOK1\0\0\0"
END = 1
_END = np.array([END], np.uint32).tobytes()
FRAME, FRAME_DOCUMENTS = 4_000_000, 4096
SAMPLE, SAMPLE_IDS = 400, 4096
DICTIONARY_BYTES = 65_536
LEVEL = 3
_CACHED = 500_000


class _Pieces(dict):
    """Ids of the pieces the tokenizer's model sees, as bytes."""

    def __init__(self, tokenizer) -> None:
        self.model = tokenizer.model

    def __missing__(self, piece: str) -> bytes:
        if len(self) > _CACHED:
            self.clear()
        shown = piece if piece.isascii() else piece.encode().decode("latin-1").translate(_BYTE_LETTERS)
        self[piece] = found = array("I", [token.id for token in self.model.tokenize(shown)]).tobytes()
        return found


class _Words(dict):
    """Ids of lower-cased words between white space, as bytes."""

    def __init__(self, pieces: _Pieces) -> None:
        self.pieces = pieces

    def __missing__(self, word: str) -> bytes:
        if len(self) > _CACHED:
            self.clear()
        if word.isalpha():
            found = self.pieces[word]
        elif word[:-1].isalpha():  # one digit or sign at the end is a piece of its own
            found = self.pieces[word[:-1]] + self.pieces[word[-1]]
        else:
            found = b"".join(map(self.pieces.__getitem__, _PIECE.findall(word)))
        self[word] = found
        return found


class Encoder:
    """Ids of a text.

    The tokenizer lower-cases, cuts a text into letter runs, digits, runs of signs and English
    endings, and gives each piece to its model. In texts of Latin letters and common signs the
    same pieces are cut here, and the model is asked once for each distinct piece (words and
    pieces are cached, bounded). Any other text is given to the tokenizer whole: where Unicode
    versions, normalisation, letters that lower-case by context or special tokens could differ.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.words = _Words(_Pieces(self.tokenizer))

    def __call__(self, texts: list[str | None]) -> list[np.ndarray]:
        return [np.frombuffer(self.encode(t or "") + _END, np.uint32) for t in texts]

    def encode(self, text: str) -> bytes:
        if _UNUSUAL.search(text) or "<|" in text:
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32).tobytes()
        return b"".join(map(self.words.__getitem__, text.lower().split()))


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """The worker's encoder; its caches serve all tasks of a worker."""
    return Encoder(path)


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    if not dictionary:
        return zstandard.ZstdCompressor(level=LEVEL, write_content_size=True)
    given = zstandard.ZstdCompressionDict(dictionary)
    given.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(dict_data=given, write_dict_id=False, write_content_size=True)


def write_frame(ids: list[int | None], bodies: list[bytes], counts: list[int], width: int, hash_: bytes) -> bytes:
    offsets = np.concatenate(([0], np.cumsum([len(b) for b in bodies]))).astype("<u8")
    nulls = np.packbits(np.array([i is None for i in ids], bool), bitorder="little")
    return b"".join([
        MAGIC, hash_, struct.pack("<II", len(ids), width), np.array([i or 0 for i in ids], "<i8").tobytes(), nulls.tobytes(),
        np.array(counts, "<u8").tobytes(), offsets.tobytes(), *bodies])


class Frame:
    """A frame's index, and its documents on demand."""

    def __init__(self, data: bytes, dictionary: bytes, hash_: bytes) -> None:
        if data[:8] != MAGIC or data[8:40] != hash_:
            raise ValueError("not a frame written with this dictionary")
        n, self.width = struct.unpack_from("<II", data, 40)
        self.ids = np.frombuffer(data, "<i8", n, 48)
        at = 48 + 8 * n
        bits = np.frombuffer(data, np.uint8, (n + 7) // 8, at)
        self.null = np.unpackbits(bits, bitorder="little")[:n].astype(bool)
        at += (n + 7) // 8
        self.counts = np.frombuffer(data, "<u8", n, at)
        self.offsets = np.frombuffer(data, "<u8", n + 1, at + 8 * n)
        self.data, self.body = data, at + 8 * n + 8 * (n + 1)
        given = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        self.reader = zstandard.ZstdDecompressor(dict_data=given)

    def document(self, k: int) -> np.ndarray:
        """The ids of the k-th document."""
        part = self.data[self.body + int(self.offsets[k]) : self.body + int(self.offsets[k + 1])]
        return np.frombuffer(self.reader.decompress(part), "<u2" if self.width == 2 else "<u4")


def train_dictionary(documents: DataFrame, tokenizer: str, width: int) -> bytes:
    """Dictionary for the serialized ids of a bounded sample; empty if zstandard finds it too small."""
    order = [F.xxhash64("doc_id", F.lit("dictionary")), F.col("doc_id")]
    ids = documents.where("doc_id IS NOT NULL").select("doc_id").distinct().orderBy(*order).limit(SAMPLE)
    kind = "<u2" if width == 2 else "<u4"

    def sample(batches):
        encode = encoder(tokenizer)
        for batch in pieces(batches):
            found = [x[:SAMPLE_IDS].astype(kind).tobytes() for x in encode(batch["text"].to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], names=["ids"])

    rows = documents.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select("text").mapInArrow(sample, "ids binary")
    samples = sorted(bytes(r.ids) for r in rows.limit(2 * SAMPLE).collect())
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes() if samples else b""
    except zstandard.ZstdError:
        return b""


def write_store(documents: DataFrame, path: str, tokenizer: str) -> None:
    """Writes the store of all documents to ``path``."""
    from tokenizers import Tokenizer

    spark = documents.sparkSession
    width = 2 if Tokenizer.from_file(tokenizer).get_vocab_size() <= 65_536 else 4
    dictionary = train_dictionary(documents, tokenizer, width)
    hash_ = hashlib.sha256(dictionary).digest()
    spark.createDataFrame([(bytearray(dictionary), hash_.hex(), width)], "dictionary binary, sha256 string, width int").coalesce(
        1).write.parquet(f"{path}/dictionary")
    sent = spark.sparkContext.broadcast(dictionary)
    kind = "<u2" if width == 2 else "<u4"

    def run(batches):
        encode, compressor = encoder(tokenizer), _compressor(sent.value)
        ids, bodies, counts, seq, size, part = [], [], [], 0, 0, None

        def frame():
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([ids[0]], pa.int64()), pa.array([ids[-1]], pa.int64()),
                 pa.array([len(ids)], pa.int32()), pa.array([sum(counts)], pa.int64()),
                 pa.array([write_frame(ids, bodies, counts, width, hash_)], pa.binary())],
                names=["part", "seq", "first_id", "last_id", "documents", "tokens", "frame"])

        for batch in pieces(batches, 128):
            part = batch["part"][0].as_py()
            for doc_id, found in zip(batch["doc_id"].to_pylist(), encode(batch["text"].to_pylist()), strict=True):
                body = compressor.compress(found.astype(kind).tobytes())
                if ids and (size + len(body) > FRAME or len(ids) >= FRAME_DOCUMENTS):
                    yield frame()
                    ids, bodies, counts, seq = [], [], [], seq + 1
                size = len(body) + (size if ids else 0)
                ids.append(doc_id)
                bodies.append(body)
                counts.append(len(found))
        if ids:
            yield frame()

    # Small parts: a task sorts and sends its texts to Python in memory.
    parts = 3 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange(parts, "doc_id")
    rows = rows.sortWithinPartitions("doc_id", "text").withColumn("part", F.spark_partition_id())
    rows.mapInArrow(run, "part int, seq int, first_id long, last_id long, documents int, tokens long, frame binary").write.parquet(f"{path}/frames")


def _dictionary(spark: SparkSession, path: str) -> bytes:
    row = spark.read.parquet(f"{path}/dictionary").first()
    if hashlib.sha256(bytes(row["dictionary"])).hexdigest() != row["sha256"]:
        raise ValueError(f"the dictionary of {path} is damaged")
    return bytes(row["dictionary"])


def positions(frames: DataFrame) -> DataFrame:
    """Frames with ``start``: the ids before them."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = frames.groupBy("part").agg(F.sum("tokens").alias("n")).withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))
    within = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    heads = frames.select("part", "seq", F.coalesce(F.sum("tokens").over(within), F.lit(0)).alias("inside"))
    heads = heads.join(parts, "part").select("part", "seq", (F.col("base") + F.col("inside")).alias("start"))
    return frames.join(heads, ["part", "seq"])


def read_documents(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """(doc_id, ids) of a few documents: only frames whose range holds one are read, and of
    those only the documents asked for."""
    wanted, dictionary = sorted(set(doc_ids)), _dictionary(spark, path)
    hash_ = hashlib.sha256(dictionary).digest()

    def run(batches):
        for batch in batches:
            for data in batch["frame"]:
                frame = Frame(data.as_py(), dictionary, hash_)
                at = np.flatnonzero(np.isin(frame.ids, wanted) & ~frame.null)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(frame.ids[at], pa.int64()), pa.array([frame.document(k).astype(np.int64) for k in at], pa.list_(pa.int64()))],
                    names=["doc_id", "ids"])

    some = F.exists(F.array(*map(F.lit, wanted)), lambda x: (x >= F.coalesce("first_id", x)) & (x <= F.col("last_id"))) if wanted else F.lit(False)
    return spark.read.parquet(f"{path}/frames").where(some).select("frame").mapInArrow(run, "doc_id long, ids array<long>")


def digests(spark: SparkSession, path: str) -> DataFrame:
    """Every stored document, decoded: doc_id, start, n_tokens, ids_crc32 (of u32 ids)."""
    dictionary = _dictionary(spark, path)
    hash_ = hashlib.sha256(dictionary).digest()
    sent = spark.sparkContext.broadcast(dictionary)

    def run(batches):
        for batch in batches:
            for data, start in zip(batch["frame"], batch["start"].to_pylist(), strict=True):
                frame = Frame(data.as_py(), sent.value, hash_)
                found = [frame.document(k) for k in range(len(frame.ids))]
                lengths = np.array([len(x) for x in found], np.int64)
                if (lengths != frame.counts).any():
                    raise ValueError("a document's length differs from the index")
                starts = start + np.concatenate(([0], np.cumsum(lengths)[:-1]))
                crc = [zlib.crc32(x.astype("<u4").tobytes()) for x in found]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(frame.ids, pa.int64(), mask=frame.null), pa.array(starts, pa.int64()), pa.array(lengths), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])

    frames = positions(spark.read.parquet(f"{path}/frames")).select("frame", "start")
    return frames.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op2: all documents with the 49k word vocabulary, written and read back."""
    import public_tokenizers

    path = scratch_path(spark, "tokens")
    write_store(spark.read.parquet(f"{sf_dir}/documents.parquet"), path, public_tokenizers.path("word_bpe_49k.json"))
    return digests(spark, path)
