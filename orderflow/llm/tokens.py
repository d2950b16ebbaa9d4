"""Token ids in patched frame-of-reference blocks.

Texts are encoded with a public tokenizer; the ids of consecutive documents are
cut into blocks of 128. A block stores its minimum, the differences to it in a
width that holds a given share of them, and a list of the exceptions: their
places, and the high bits that did not fit. An index of block starts leads each
file. Files hold ascending ranges of doc_id, and their names sort likewise.

Layout (little endian; a file is a row of Spark's text sink, so it ends with a
line feed):

    header    magic "PFR1"; documents, ids, blocks, words, exceptions (5 x u64)
    documents doc_id i64 (null: flagged), null flag u8, ids of the document u32
    heads     per block: minimum u32, width u8, exceptions u8
    index     per block: start of its words and of its exceptions, 2 x u32
    words     per block: packed differences, 2 * width words of 64 bits, low bits first
    places    per exception, u8
    high      per exception: the bits above the width, u32
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderflow.llm.shared import batched, give_back, rows_of, settle, sliced, working_for

BLOCK = 128
BLOCKS_AT_ONCE = 2048  # packed together; bounds the arrays in between
SHARE = 0.9
END = 0
MAGIC = b"PFR1"
HEAD = np.dtype([("low", "<u4"), ("width", "u1"), ("over", "u1")])
DOC = np.dtype([("id", "<i8"), ("null", "u1"), ("n", "<u4")])


def _slots(width: int) -> Iterator[tuple[int, int, int]]:
    """For each of a block's values: its first 64-bit word, the shift in it, and
    how many bits spill into the next word."""
    for k in range(BLOCK):
        word, shift = divmod(k * width, 64)
        yield word, shift, max(0, shift + width - 64)


def _packed(rest: np.ndarray, width: int) -> np.ndarray:
    """Blocks x 128 values to blocks x (2 * width) words of 64 bits."""
    columns = np.ascontiguousarray(rest.T).astype(np.uint64)
    columns &= np.uint64((1 << width) - 1)
    out = np.zeros((2 * width, len(rest)), np.uint64)
    for value, (word, shift, spill) in zip(columns, _slots(width), strict=True):
        out[word] |= value << np.uint64(shift)
        if spill:
            out[word + 1] |= value >> np.uint64(width - spill)
    return np.ascontiguousarray(out.T)


def _unpacked(words: np.ndarray, width: int) -> np.ndarray:
    columns = np.ascontiguousarray(words.T)
    out = np.empty((BLOCK, len(words)), np.uint32)
    mask = np.uint64((1 << width) - 1)
    for k, (word, shift, spill) in enumerate(_slots(width)):
        value = columns[word] >> np.uint64(shift)
        if spill:
            value |= columns[word + 1] << np.uint64(width - spill)
        out[k] = value & mask
    return np.ascontiguousarray(out.T)


def pack(ids: np.ndarray, share: float = SHARE) -> tuple[np.ndarray, ...]:
    """Blocks of ids: heads, index, words, places and high bits."""
    step = BLOCKS_AT_ONCE * BLOCK
    runs = [_pack(ids[k : k + step], share) for k in range(0, max(1, len(ids)), step)]
    heads, index, words, places, high = zip(*runs, strict=True)
    start = np.zeros(2, "<u4")
    for own, w, p in zip(index, words, places, strict=True):
        own += start
        start = start + np.array([len(w), len(p)], "<u4")
    return tuple(map(np.concatenate, (heads, index, words, places, high)))


def _pack(ids: np.ndarray, share: float) -> tuple[np.ndarray, ...]:
    count = -(-len(ids) // BLOCK)
    heads, index = np.zeros(count, HEAD), np.zeros((count, 2), "<u4")
    if not count:
        return heads, index, np.empty(0, "<u8"), np.empty(0, "u1"), np.empty(0, "<u4")
    # The last block is filled up with the last id; the count of ids tells it apart.
    full = np.concatenate([ids, np.repeat(ids[-1:], count * BLOCK - len(ids))]).astype(np.uint32)
    full = full.reshape(count, BLOCK)
    low = full.min(1)
    rest = full - low[:, None]
    kept = min(BLOCK, max(1, int(np.ceil(share * BLOCK))))
    width = np.frexp(np.partition(rest, kept - 1, axis=1)[:, kept - 1].astype(np.float64))[1]
    over = rest > ((np.uint64(1) << width.astype(np.uint64)) - np.uint64(1)).astype(np.uint32)[:, None]
    heads["low"], heads["width"], heads["over"] = low, width, over.sum(1)
    ends = np.cumsum([2 * width, heads["over"].astype(np.int64)], axis=1)
    index[1:] = ends[:, :-1].T
    words = np.empty(ends[0, -1], "<u8")
    for w in np.unique(width[width > 0]).tolist():
        of = np.flatnonzero(width == w)
        words[index[of, :1].astype(np.int64) + np.arange(2 * w)] = _packed(rest[of], w)
    of, at = np.nonzero(over)
    return heads, index, words, at.astype("u1"), (rest[of, at] >> width[of].astype(np.uint32)).astype("<u4")


def unpack(heads, index, words, places, high, n: int) -> np.ndarray:
    """The ids of all blocks."""
    out = np.zeros((len(heads), BLOCK), np.uint32)
    for w in np.unique(heads["width"]).tolist():
        if w:
            of = np.flatnonzero(heads["width"] == w)
            out[of] = _unpacked(words[index[of, :1].astype(np.int64) + np.arange(2 * w)], w)
    of = np.repeat(np.arange(len(heads)), heads["over"])
    out[of, places] |= high << heads["width"][of].astype(np.uint32)
    out += heads["low"][:, None]
    return out.reshape(-1)[:n]


def encode_file(documents: list[tuple[int | None, np.ndarray]]) -> bytes:
    table = np.zeros(len(documents), DOC)
    for k, (doc, ids) in enumerate(documents):
        table[k] = (doc or 0, doc is None, len(ids))
    ids = np.concatenate([d[1] for d in documents]) if documents else np.empty(0, np.uint32)
    parts = pack(ids)
    sizes = np.array([len(documents), len(ids), len(parts[0]), len(parts[2]), len(parts[3])], "<u8")
    return b"".join([MAGIC, sizes.tobytes(), table.tobytes(), *(p.tobytes() for p in parts)])


def decode_file(content: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The table of documents and all ids of a file."""
    if content[:4] != MAGIC:
        raise ValueError("not a file of packed token ids")
    docs, n, blocks, words, over = np.frombuffer(content, "<u8", 5, 4).tolist()
    at, parts = 44, []
    for kind, count in ((DOC, docs), (HEAD, blocks), (np.dtype("<u4"), 2 * blocks), (np.dtype("<u8"), words), (np.dtype("u1"), over), (np.dtype("<u4"), over)):
        parts.append(np.frombuffer(content, kind, count, at))
        at += count * kind.itemsize
    table, heads, index, *rest = parts
    return table, unpack(heads, index.reshape(-1, 2), *rest, n)


class Encoder:
    """Encodes texts with the tokenizers library, remembering parts of texts.

    Byte-level BPE never merges across the pieces that its pattern cuts, and the
    pattern always cuts before a space that has a non-space on one side at
    least; so the ids of a text are those of its parts, which repeat a lot. A text
    that holds a special string of the vocabulary is left to the library as a whole.
    Memory is bounded: two generations of remembered parts."""

    LIMIT, BLANK_LIMIT = 500_000, 50_000

    def __init__(self, path: str):
        import public_tokenizers
        import regex
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = whole = Tokenizer.from_file(path)
        self.model, size = whole.model, whole.get_vocab_size()
        # Strings that the library takes out of a text before it cuts it.
        self.special = [t.content for t in whole.get_added_tokens_decoder().values()]
        cut = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        # How the byte-level scheme writes each byte, asked from the library.
        written = {}
        for c in map(chr, range(0x800)):
            written.update(zip(c.encode(), cut.pre_tokenize_str(c)[0][0], strict=True))
        for c in map(chr, [*range(0x800, 0x10000, 0x40), *range(0x10000, 0x110000, 0x1000)]):
            if not 0xD800 <= ord(c) < 0xE000:
                written.update(zip(c.encode(), cut.pre_tokenize_str(c)[0][0], strict=True))
        self.written, self.blank = written, written[32]
        self.plain = all(written[k] == chr(k) for k in range(33, 127))
        self.split = regex.compile(public_tokenizers.PATTERN).findall
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.blanks: dict[str, bytes] = {}  # parts that end with white space
        self.ids = [i.to_bytes(4, "little") for i in range(size)]

    def parts(self, text: str) -> list[str]:
        """The text, cut before spaces. A space between white space on both
        sides (or at the end) stays with what is before it."""
        first, *rest = text.split(" ")
        parts = [first] if first else []
        for word in rest:
            if parts and parts[-1][-1].isspace() and not (word and not word[0].isspace()):
                parts[-1] += " " + word
            else:
                parts.append(" " + word)
        return parts

    def _part(self, part: str) -> bytes:
        ids = self.new.get(part) or self.old.get(part) or self.blanks.get(part)
        if ids is None:
            letters = part[1:] if part[:1] == " " else part
            if letters.isalpha():
                ids = self._piece(part)
            elif letters[-1:] in (",", ".") and letters[:-1].isalpha():
                ids = self._part(part[:-1]) + self._part(part[-1])
            else:
                pieces = self.split(part)
                ids = b"".join(map(self._part, pieces)) if len(pieces) > 1 else self._piece(part)
        if len(part) < 64:
            if part[-1:].isspace():
                if len(self.blanks) >= self.BLANK_LIMIT:
                    self.blanks = {}
                self.blanks[part] = ids
                return ids
            if len(self.new) >= self.LIMIT:
                self.old, self.new = self.new, {}
            self.new[part] = ids
        return ids

    def _piece(self, piece: str) -> bytes:
        if self.plain and piece.isascii() and piece.isprintable():
            text = piece.replace(" ", self.blank)
        else:
            text = piece.encode().decode("latin1").translate(self.written)
        return b"".join([self.ids[t.id] for t in self.model.tokenize(text)])

    def __call__(self, text: str) -> np.ndarray:
        if any(s in text for s in self.special):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4")
        if "\0" in text:
            return self._joined(self.parts(text))
        # Cut before every space. That is wrong only for a space with white space on both
        # sides; parts that end with white space are never among the new ones.
        parts = text.replace(" ", "\0 ").split("\0")
        known = list(map(self.new.get, parts))
        for k in [k for k, ids in enumerate(known) if ids is None]:
            part = parts[k]
            if part[-1:].isspace() and k + 1 < len(parts) and not parts[k + 1][1:2].strip():
                return self._joined(self.parts(text))
            known[k] = self._part(part)
        return np.frombuffer(b"".join(known), "<u4")

    def _joined(self, parts: list[str]) -> np.ndarray:
        return np.frombuffer(b"".join(map(self._part, parts)), "<u4")


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def forget_encoders() -> None:
    _encoders.clear()


def write_tokens(docs: DataFrame, path: str, tokenizer: str, file_bytes: int = 16 << 20) -> None:
    """Encode every whole text (null: empty), append the end id, and write files
    in ascending doc_id order (null doc_id first; repeated rows stay, in any
    order among equal doc_ids). An empty table writes no file. A file is what
    one task holds: text of about ``file_bytes``."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    size = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    files = max(1, -(-size // file_bytes))

    def files_of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        working_for("tokens", forget_encoders)
        give_back()  # what the task before has freed
        encode, end = encoder(tokenizer), np.array([END], "<u4")
        held = [(d, np.concatenate([encode(t), end])) for d, t in rows_of(sliced(batches), "doc_id", "text")]
        if held:
            yield from batched([(encode_file(held),)], pa.schema([("value", pa.binary())]))

    (
        own.repartitionByRange(files, "doc_id")
        .sortWithinPartitions("doc_id", F.xxhash64("text"))
        .mapInArrow(files_of, "value binary")
        .select(F.col("value").cast("string").alias("value"))
        .write.text(path)
    )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: file, place (in the file), doc_id, n_tokens,
    ids_crc32 and ids (packed little-endian u32, the end id included)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    schema = pa.schema(
        [
            ("file", pa.string()),
            ("place", pa.int64()),
            ("doc_id", pa.int64()),
            ("n_tokens", pa.int64()),
            ("ids_crc32", pa.int64()),
            ("ids", pa.binary()),
        ]
    )

    def documents(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        working_for("token files")  # encoders are not needed any more

        def rows():
            for file, content in rows_of(batches, "path", "content"):
                table, ids = decode_file(content)
                raw, at = memoryview(ids.astype("<u4").tobytes()), 0
                for place, (doc, null, n) in enumerate(table.tolist()):
                    own = raw[4 * at : 4 * (at + n)]
                    yield file, place, None if null else doc, n, zlib.crc32(own), own.tobytes()
                    at += n

        yield from batched(rows(), schema, 1024)

    return files.select("path", "content").mapInArrow(
        documents, "file string, place long, doc_id long, n_tokens long, ids_crc32 long, ids binary"
    )


def with_starts(tokens: DataFrame) -> DataFrame:
    """Adds start: the ids of all documents before. Sums of files first, so that
    one task sees a row per file and others the documents of one file."""
    ahead = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = (
        tokens.groupBy("file")
        .agg(F.sum("n_tokens").alias("n"))
        .select("file", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("base"))
    )
    inside = Window.partitionBy("file").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return (
        tokens.join(files, "file")
        .withColumn("start", F.col("base") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
        .drop("base")
    )


def token_index(docs: DataFrame, path: str, tokenizer: str) -> DataFrame:
    """Write the files and read them back: doc_id, start, n_tokens, ids_crc32."""
    write_tokens(docs, path, tokenizer)
    read = read_tokens(docs.sparkSession, path).drop("ids")
    return with_starts(settle(read, "tokens")).select("doc_id", "start", "n_tokens", "ids_crc32")
