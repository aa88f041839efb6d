"""Token-id shards as wavelet matrices.

Documents are encoded where they are read, then dealt by ranges of doc_id
(cut at approximate quantiles) as 16-bit or 32-bit ids; each task sorts its
ranges and writes shards of about ``SHARD_TOKENS`` ids as rows of a Parquet
folder, one complete file image a row (FORMAT below). A wavelet matrix keeps one plane of
n bits for each bit of an id, most significant first; after each plane, ids
with a 0 bit go before those with a 1 bit, both in order. With a rank
directory a word of 512 bits, access, counting up to a position and the
position of the k-th occurrence read one bit a plane, without decoding the
shard. Reading a shard back whole undoes the planes from the last to the first.

FORMAT (little endian): magic ``TWM1``, uint32 number of documents, uint64 n,
uint8 planes; int64 doc_id and uint8 null flag of each document; uint64 end of each document;
for each plane: uint64 zeros, the bits (most significant first in a byte),
uint32 ones before each 512-bit word.

Defined cases: null text encodes as the empty text (the end id alone); null
doc_ids sort first; rows that repeat a doc_id follow one another ordered by
their ids; an empty table writes no shard."""

from __future__ import annotations

import re
import struct
import zlib
from array import array

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tessera.llm import words
from tessera.llm.common import range_cuts

MAGIC = b"TWM1"
SHARD_TOKENS = 1 << 20
WORD = 512
END_ID = 2
CACHE_ENTRIES = 500_000     # per Python worker, young and old each; only speed depends on it


class WaveletMatrix:
    """The planes of one sequence of ids."""

    def __init__(self, n: int, planes: list[tuple[int, np.ndarray, np.ndarray]]):
        self.n, self.planes = n, planes       # (zeros, packed bits, ones before each word)

    @classmethod
    def build(cls, ids: np.ndarray) -> "WaveletMatrix":
        n = len(ids)
        width = max(1, int(ids.max(initial=0)).bit_length())
        planes = []
        for shift in range(width - 1, -1, -1):
            bit = ((ids >> ids.dtype.type(shift)) & ids.dtype.type(1)).astype(bool)
            packed = np.packbits(bit)
            words_of = np.add.reduceat(np.bitwise_count(packed).astype(np.uint32), np.arange(0, len(packed), WORD // 8)) if n else np.zeros(0, np.uint32)
            ones = np.concatenate([[0], np.cumsum(words_of)]).astype(np.uint32)
            ids = np.concatenate([np.compress(~bit, ids), np.compress(bit, ids)])
            planes.append((n - int(ones[-1]), packed, ones))
        return cls(n, planes)

    def _bit(self, plane: int, i: int) -> int:
        return int(self.planes[plane][1][i >> 3] >> (7 - (i & 7))) & 1

    def _ones(self, plane: int, i: int) -> int:
        """Ones in the first i bits."""
        _, packed, ones = self.planes[plane]
        w = i // WORD
        total = int(ones[w]) + int(np.bitwise_count(packed[w * WORD // 8:i >> 3]).sum())
        return total + (int(packed[i >> 3] >> (8 - (i & 7))).bit_count() if i & 7 else 0)

    def access(self, i: int) -> int:
        """The id at position i."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for p, (zeros, _, _) in enumerate(self.planes):
            bit, ones = self._bit(p, i), self._ones(p, i)
            value = value << 1 | bit
            i = zeros + ones if bit else i - ones
        return value

    def _range(self, c: int, i: int) -> tuple[int, int]:
        """Where the occurrences of c among the first i ids end up."""
        lo, hi = 0, i
        if c >> len(self.planes):
            return 0, 0
        for p, (zeros, _, _) in enumerate(self.planes):
            a, b = self._ones(p, lo), self._ones(p, hi)
            lo, hi = (zeros + a, zeros + b) if c >> (len(self.planes) - 1 - p) & 1 else (lo - a, hi - b)
        return lo, hi

    def rank(self, c: int, i: int | None = None) -> int:
        """Occurrences of c among the first i ids (all, if not given)."""
        lo, hi = self._range(c, self.n if i is None else i)
        return hi - lo

    def _select_bit(self, plane: int, bit: int, k: int) -> int:
        """Position of the k-th (from 0) such bit of a plane."""
        lo, hi = 0, self.n
        while lo < hi:
            mid = (lo + hi) // 2
            ones = self._ones(plane, mid + 1)
            if (ones if bit else mid + 1 - ones) > k:
                hi = mid
            else:
                lo = mid + 1
        return lo

    def select(self, c: int, k: int) -> int:
        """Position of the k-th (from 0) occurrence of c."""
        lo, hi = self._range(c, self.n)
        if not 0 <= k < hi - lo:
            raise IndexError(k)
        i = lo + k
        for p in range(len(self.planes) - 1, -1, -1):
            zeros = self.planes[p][0]
            i = self._select_bit(p, 1, i - zeros) if c >> (len(self.planes) - 1 - p) & 1 else self._select_bit(p, 0, i)
        return i

    def occurrences(self, c: int) -> list[int]:
        return [self.select(c, k) for k in range(self.rank(c))]

    def ids(self) -> np.ndarray:
        """The whole sequence."""
        out = np.zeros(self.n, np.uint16 if len(self.planes) <= 16 else np.uint32)
        for p in range(len(self.planes) - 1, -1, -1):
            zeros, packed, _ = self.planes[p]
            bit = np.unpackbits(packed, count=self.n).view(bool)
            before = np.empty_like(out)
            before[~bit] = out[:zeros]
            before[bit] = out[zeros:] | out.dtype.type(1 << (len(self.planes) - 1 - p))
            out = before
        return out


def to_bytes(doc_ids: list, ends: np.ndarray, matrix: WaveletMatrix) -> bytes:
    parts = [MAGIC, struct.pack("<IQB", len(doc_ids), matrix.n, len(matrix.planes)),
             np.array([0 if i is None else i for i in doc_ids], "<i8").tobytes(),
             np.array([i is None for i in doc_ids], np.uint8).tobytes(), ends.astype("<u8").tobytes()]
    for zeros, packed, ones in matrix.planes:
        parts += [struct.pack("<Q", zeros), packed.tobytes(), ones.astype("<u4").tobytes()]
    return b"".join(parts)


def from_bytes(data: bytes) -> tuple[list, np.ndarray, WaveletMatrix]:
    if data[:4] != MAGIC:
        raise ValueError("not a token shard")
    docs, n, width = struct.unpack_from("<IQB", data, 4)
    at = 4 + struct.calcsize("<IQB")

    def take(kind, count):
        nonlocal at
        out = np.frombuffer(data, kind, count, at)
        at += out.nbytes
        return out
    ids, null, ends = take("<i8", docs), take(np.uint8, docs), take("<u8", docs)
    planes = []
    for _ in range(width):
        zeros = int(take("<u8", 1)[0])
        planes.append((zeros, take(np.uint8, -(-n // 8)), take("<u4", -(-n // WORD) + 1)))
    return [None if x else int(i) for i, x in zip(ids, null)], ends.astype(np.int64), WaveletMatrix(n, planes)


_tokenizers: dict = {}
# Fixed: the pattern that splits text in the vocabulary file.
_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")


def _byte_letters() -> dict[int, int]:
    """The letter that byte-level vocabularies write for each byte: itself if
    it is printable in Latin-1, else one of those from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: b for b in plain} | {b: 0x100 + n for n, b in enumerate(rest)}


def _usual() -> tuple[re.Pattern, re.Pattern]:
    """(a character that is not usual, the pieces of a lower-case text of usual
    ones). Usual are those below U+0180, common punctuation and currency signs:
    none of them composes with others; but U+001C to U+001F, white space for
    Python alone, are not. The pieces are those of ``_PIECES``."""
    usual = [chr(c) for r in (range(0x180), range(0x2010, 0x2028), range(0x2030, 0x205F), range(0x20A0, 0x20C0)) for c in r]
    low = sorted(set("".join(usual).lower()))
    letters, numbers, spaces = (regex.findall(p, "".join(low)) for p in (r"\p{L}", r"\p{N}", r"\s"))
    marks = set(low).difference(letters, numbers, spaces)
    some = ["".join(map(re.escape, x)) for x in (usual, letters, numbers, sorted(marks))]
    return re.compile(f"[^{some[0]}]|[\x1c-\x1f]"), re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{some[1]}]+|[{some[2]}]|[{some[3]}]+")


_UNUSUAL, _USUAL_PIECES = _usual()


def _any_of(contents: list[str]):
    """Pattern of any of the strings in lower-case text, None without strings."""
    return regex.compile("|".join(r"\s+".join(map(regex.escape, t.lower().split())) for t in contents)) if contents else None


class _Learnt(dict):
    """What ``learn`` gives for each key, kept until ``age`` has put it by twice
    without its being asked for in between."""

    def __init__(self, learn):
        super().__init__()
        self.learn, self.old = learn, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.learn(key)
        self[key] = value
        return value

    def age(self) -> None:
        """Put by what is kept if it is more than ``CACHE_ENTRIES``."""
        if len(self) > CACHE_ENTRIES:
            self.old = dict(self)
            self.clear()


class Encoder:
    """Ids of whole texts with ``add_special_tokens=False``. White space ends a
    piece in this vocabulary. A text of ASCII and Latin letters is cut there;
    what stands between is a piece if it is all letters, else it is cut into the
    vocabulary's pieces. Each piece is merged by the library's model once and
    kept. Other texts go by words, kept too: those of ASCII and Latin letters by
    their pieces; others, and words that hold an added token of the vocabulary,
    through the whole library encoder (whole texts, if an added token holds
    white space)."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        self.letters = _byte_letters()
        self.wide = self.library.get_vocab_size() > 1 << 16
        self.kind = np.uint32 if self.wide else np.uint16
        self.code = "I" if self.wide else "H"
        added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.added = _any_of([t for t in added if not t.lower().isalpha()])
        self.added_words = _any_of([t for t in added if t.lower().isalpha()])
        self.added_spaced = _any_of([t for t in added if t.split() != [t]])
        self.words = _Learnt(self._word)       # of UTF-8
        self.pieces = _Learnt(self._pieces)    # of lower case, and what holds several of them

    def _pieces(self, text: str) -> bytes:
        if not text.isalpha():
            found = _USUAL_PIECES.findall(text)
            if found != [text]:
                return b"".join([self.pieces[x] for x in found])
        return self._piece(text)

    def _piece(self, piece: str) -> bytes:
        spelled = piece if piece.isascii() and piece.isalpha() else piece.encode().decode("latin-1").translate(self.letters)
        return array(self.code, [t.id for t in self.model.tokenize(spelled)]).tobytes()

    def _word(self, w: bytes) -> bytes:
        text = w.decode()
        low = text.lower()
        # there are no composing marks below U+0180
        if not w.isascii() and max(text) >= "ƀ" or self._holds_added(low):
            return array(self.code, self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids).tobytes()
        return b"".join(map(self.pieces.__getitem__, (low,) if low.isalpha() else _PIECES.findall(low)))

    def _holds_added(self, low: str) -> bool:
        return any(p and p.search(low) for p in (self.added, self.added_words, self.added_spaced))

    def encode(self, texts: list[bytes]) -> list[bytes]:
        self.words.age()
        out = []
        for t in texts:
            self.pieces.age()
            text = t.decode()
            low = text.lower()
            if _UNUSUAL.search(text) or self._holds_added(low):
                out.append(b"".join(map(self.words.__getitem__, t.split())))         # ASCII white space only
            else:
                out.append(b"".join(map(self.pieces.__getitem__, low.split())))
        if self.added_spaced:
            for i, t in enumerate(texts):
                if self.added_spaced.search(t.decode().lower()):
                    out[i] = array(self.code, self.library.encode(t.decode(), add_special_tokens=False).ids).tobytes()
        return out


def encoder(path: str) -> Encoder:
    """One encoder per Python worker and vocabulary file."""
    if path not in _tokenizers:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _tokenizers[path] = Encoder(path)
    return _tokenizers[path]


def _encoded(path: str, end_id: int):
    def run(batches):
        code = encoder(path)
        end = np.array([end_id], code.kind).tobytes()
        for batch in batches:
            texts = words.text_array(batch.column("text"))
            _, offsets = words.raw(texts)
            for i, j in words.blocks(offsets):
                ids = [x + end for x in code.encode(texts.slice(i, j - i).cast(pa.binary()).to_pylist())]
                yield pa.record_batch([batch.column("part").slice(i, j - i), batch.column("doc_id").slice(i, j - i), pa.array(ids, pa.binary())],
                                      ["part", "doc_id", "ids"])
    return run


def _sharded(kind, shard_tokens):
    def run(batches):
        part, number, ids, docs, size = None, 0, [], [], 0

        def result():
            flat = np.frombuffer(b"".join(ids), kind)
            ends = np.cumsum([len(x) // np.dtype(kind).itemsize for x in ids])
            return pa.record_batch([pa.array([part], pa.int32()), pa.array([number], pa.int64()), pa.array([len(flat)], pa.int64()),
                                    pa.array([to_bytes(docs, ends, WaveletMatrix.build(flat))], pa.binary())], ["part", "shard", "n_tokens", "file"])
        for batch in batches:
            for p, i, x in zip(*(batch.column(c).to_pylist() for c in ("part", "doc_id", "ids"))):
                n = len(x) // np.dtype(kind).itemsize
                if ids and (p != part or size + n > shard_tokens):
                    yield result()
                    number = number + 1 if p == part else 0
                    ids, docs, size = [], [], 0
                part = p
                ids.append(x)
                docs.append(i)
                size += n
        if ids:
            yield result()
    return run


def write(docs: DataFrame, path: str, vocabulary: str, end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS, parts: int | None = None) -> None:
    """Encode (doc_id, text) and write the shards in the folder ``path``, in
    ascending doc_id order by (part, shard)."""
    spark = docs.sparkSession
    words.small_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = range_cuts(docs, "doc_id", parts)
    part = F.size(F.filter(F.lit(cuts).cast("array<long>"), lambda c: c <= F.col("doc_id"))) if cuts else F.lit(0)
    part = F.when(F.col("doc_id").isNull(), 0).otherwise(part).cast("int")
    kind = encoder(vocabulary).kind
    (docs.withColumn("part", part).mapInArrow(_encoded(vocabulary, end_id), "part int, doc_id long, ids binary")
     .repartition(parts, "part").sortWithinPartitions("part", F.col("doc_id").asc_nulls_first(), F.xxhash64("ids"))
     .mapInArrow(_sharded(kind, shard_tokens), "part int, shard long, n_tokens long, file binary")
     .write.option("compression", "none").parquet(path))


def _read(batches):
    for batch in batches:
        for part, shard, data in zip(*(batch.column(c).to_pylist() for c in ("part", "shard", "file"))):
            docs, ends, matrix = from_bytes(data)
            ids = matrix.ids()
            starts = np.concatenate([[0], ends[:-1]])
            wide = memoryview(ids.astype("<u4")).cast("B")
            crc = [zlib.crc32(wide[4 * a:4 * b]) for a, b in zip(starts.tolist(), ends.tolist())]
            yield pa.record_batch([pa.array([part] * len(docs), pa.int32()), pa.array([shard] * len(docs), pa.int64()),
                                   pa.array(docs, pa.int64()), pa.array(starts, pa.int64()), pa.array(ends - starts, pa.int64()),
                                   pa.array(crc, pa.int64())], ["part", "shard", "doc_id", "inside", "n_tokens", "ids_crc32"])


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files.
    The prefix sum runs over shards inside each part; only one total a part
    comes to the driver."""
    words.small_batches(spark, 8)
    files = spark.read.schema("part int, shard long, n_tokens long, file binary").parquet(path)
    sizes = files.select("part", "shard", "n_tokens")
    before, total = [], 0
    for r in sizes.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect():
        before.append((r["part"], total))
        total += r["n"]
    inner = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = spark.createDataFrame(before, "part int, base long")
    sizes = (sizes.withColumn("ahead", F.coalesce(F.sum("n_tokens").over(inner), F.lit(0)))
             .join(F.broadcast(offsets), "part").select("part", "shard", (F.col("ahead") + F.col("base")).alias("ahead")))
    found = files.select("part", "shard", "file").mapInArrow(
        _read, "part int, shard long, doc_id long, inside long, n_tokens long, ids_crc32 long")
    return found.join(sizes, ["part", "shard"]).select("doc_id", (F.col("ahead") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")
