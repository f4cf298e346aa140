"""Token ids as Parquet list columns.

``write_tokens`` encodes whole texts and writes them in ascending ``doc_id``
order: the rows are range-partitioned by id, sorted, encoded map-side and
written by Spark's Parquet writer, one file per range. Each file has the id
columns plain (statistics and page indexes on ``doc_id`` let a reader skip
row groups and pages), the token ids delta-encoded or dictionary-encoded in
a list column of their own, and row groups of a given size; so metadata can
be read without touching tokens, and a few documents without reading a file.

A document's offset in the whole token stream is its offset within its file
(``local_start``) plus the tokens of all files before it. The second part is
a table of one row per file (``files``), made from the written metadata
columns only: nothing is numbered in one task.

The default tokenizer's pieces (letter runs, digits, symbol runs, lower-cased)
never span a blank, so a text's ids are the ids of its pieces in order. Each
worker takes texts of a few megabytes together, cuts each distinct word of
them into pieces, looks up each distinct piece once, and lays the ids out by
Arrow's and numpy's columns. The tokenizer's model encodes the pieces that
are new. Their ids are kept in two generations of ``MEMO_PIECES``: when the
young one is full it becomes the old one, and what is met again moves back,
so frequent ones stay and memory is bounded in bytes (long ones are not
kept). Words beyond printable ASCII and Latin letters, or with ``<|``, go
through the whole tokenizer and are kept likewise (``MEMO_WORDS``); so does
every text if the tokenizer has other rules than these.

Defined cases: a null or empty text has only the end id; repeated ids are
separate rows, in the order of a hash of their texts; null ids come first;
an empty table gives files without rows.
"""

from __future__ import annotations

import re
import sys
import zlib
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path

TOKENIZER = "word_bpe_49k.json"
END_ID = 2
#: Pieces, and words of other scripts, of a generation that a worker keeps.
MEMO_PIECES, MEMO_WORDS = 200_000, 100_000
#: Letters of a piece or word that is kept, at most.
MEMO_LETTERS = 64
ROW_GROUP_MB = 16
#: Rows of a batch that is sent to a worker.
BATCH_CONF, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 512
#: Bytes of the texts that a worker encodes together (a longer one alone).
TOGETHER = 3 << 20
#: The pre-tokenizer for which words can be cut into pieces here.
SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
#: Printable ASCII and Latin letters: lower-casing is by character, NFC
#: changes nothing, and ``_PIECE`` is the pattern above (or one blank).
_PLAIN = re.compile("[ -~\u00c0-\u024f]*")
_PIECE = re.compile(r" |'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+")


def _byte_letters() -> dict[int, str]:
    """The usual byte-level alphabet: printable bytes stand for themselves,
    the others for the code points from 256 on, in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class _Memo:
    """Ids by string, made by ``make`` (of a list of strings) when missing,
    in two generations of ``limit`` strings."""

    def __init__(self, make, limit: int):
        self.make, self.limit, self.young, self.old = make, limit, {}, {}

    def of(self, strings: list[str]) -> list[bytes]:
        """The ids of distinct strings."""
        found = list(map(self.young.get, strings))
        lost = [i for i, ids in enumerate(found) if ids is None]
        new = []
        for i in lost:
            found[i] = self.old.get(strings[i])
            if found[i] is None:
                new.append(i)
        for i, ids in zip(new, self.make([strings[i] for i in new]) if new else ()):
            found[i] = ids
        for i in lost:
            if len(strings[i]) <= MEMO_LETTERS:
                if len(self.young) >= self.limit:
                    self.young, self.old = {}, self.young
                self.young[strings[i]] = found[i]
        return found


class _Encoder:
    """One tokenizer in one worker process."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        kinds = [n.get("type") for n in _rules(self.tokenizer.normalizer).get("normalizers", [])]
        cut = _rules(self.tokenizer.pre_tokenizer).get("pretokenizers", [{}])
        self.by_word = kinds == ["NFC", "Replace", "Lowercase"] and cut[0].get("pattern") == {"Regex": SPLIT} and len(cut) == 2
        self.letters = _byte_letters()
        self.pieces = _Memo(lambda pieces: list(map(self.piece, pieces)), MEMO_PIECES)
        self.others = _Memo(self.whole, MEMO_WORDS)

    def whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes() for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def piece(self, piece: str) -> bytes:
        if piece == " ":
            return b""
        spelt = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.letters)
        ids = array("I", [t.id for t in self.model.tokenize(spelt)])
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    def words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of words, and where each word's ids begin and how many it has."""
        joined, other = " ".join(words), []
        if not _plain(joined):
            other = [i for i, w in enumerate(words) if not _plain(w)]
            joined = list(words)
            for i in other:
                joined[i] = ""
            joined = " ".join(joined)
        # Lower-casing that depends on neighbours is of other scripts. Pieces
        # hold no blank, so all words are cut in one pass.
        coded = pa.array(_PIECE.findall(joined.lower()), pa.string()).dictionary_encode()
        names = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids = self.pieces.of(names)
        n = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // 4
        piece = coded.indices.to_numpy(zero_copy_only=False)
        flat = _picked(np.frombuffer(b"".join(ids), dtype="<u4"), np.cumsum(n) - n, n, piece)
        # A word ends at the blank behind it, the last one with the pieces.
        blanks = np.flatnonzero(piece == names.index(" ")) if len(words) > 1 else []
        ends = np.append(np.cumsum(n[piece])[blanks], len(flat)) if len(words) else np.zeros(0, dtype=np.int64)
        n = np.diff(ends, prepend=0)
        begin = ends - n
        if other:
            whole = [np.frombuffer(x, dtype="<u4") for x in self.others.of([words[i] for i in other])]
            n[other] = [len(x) for x in whole]
            begin[other] = len(flat) + np.cumsum(n[other]) - n[other]
            flat = np.concatenate([flat, *whole])
        return flat, begin, n

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and each text's number."""
        if not self.by_word:
            ids = self.whole(texts.to_pylist())
            return np.frombuffer(b"".join(ids), dtype="<u4"), np.array([len(x) // 4 for x in ids], dtype=np.int64)
        cut = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        coded = cut.flatten().dictionary_encode()
        flat, begin, n = self.words(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        word = coded.indices.to_numpy(zero_copy_only=False)
        ends = np.cumsum(n[word])[np.cumsum(pc.list_value_length(cut).to_numpy(zero_copy_only=False)) - 1]
        return _picked(flat, begin, n, word), np.diff(ends, prepend=0)


def _plain(words: str) -> bool:
    return _PLAIN.fullmatch(words) is not None and "<|" not in words


def _picked(flat: np.ndarray, begin: np.ndarray, n: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The runs ``which`` of ``flat``, one after the other; a run begins at
    ``begin`` and has ``n`` numbers."""
    length = n[which]
    end = np.cumsum(length)
    # Texts of one Arrow column have less than 2^31 ids.
    at = np.repeat((begin[which] - (end - length)).astype(np.int32), length)
    at += np.arange(len(at), dtype=np.int32)
    return flat[at]


def _rules(part) -> dict:
    """The rules of a normalizer or pre-tokenizer, without the vocabulary."""
    import json

    return json.loads(part.__getstate__()) if part is not None else {}


#: Per worker process, by path.
_loaded: dict[str, _Encoder] = {}


def encode_column(path: str, texts: pa.Array, end_id: int | None = END_ID) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts (none null), one text after the other, and how many
    each text has, the end id included."""
    encoder = _loaded.get(path) or _loaded.setdefault(path, _Encoder(path))
    ids, n = encoder.texts(texts)
    if end_id is None:
        return ids, n
    out = np.full(len(ids) + len(n), end_id, dtype="<u4")
    ends = np.cumsum(n + 1)
    inner = np.ones(len(out), dtype=bool)
    inner[ends - 1] = False
    out[inner] = ids
    return out, n + 1


def encode_texts(path: str, texts: list[str], end_id: int | None = END_ID) -> list[bytes]:
    """Ids of each text as little-endian unsigned 32-bit integers."""
    ids, n = encode_column(path, pa.array(texts, pa.string()), end_id)
    ends = np.cumsum(n)
    return [ids[x:y].tobytes() for x, y in zip(ends - n, ends)]


def _together(batches):
    """The rows of the batches in groups whose texts take about ``TOGETHER``
    bytes, a longer text alone."""
    held, size = [], 0

    def groups():
        whole = pa.concat_batches(held)
        ends = np.cumsum(pc.binary_length(whole.column("text")).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < len(ends):
            before = ends[at - 1] if at else 0
            upto = max(at + 1, int(np.searchsorted(ends, before + TOGETHER, side="right")))
            yield whole.slice(at, upto - at)
            at = upto

    for b in batches:
        held.append(b)
        size += b.nbytes
        if size >= TOGETHER:
            yield from groups()
            held, size = [], 0
    if held:
        yield from groups()


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int | None = END_ID,
                 encoding: str = "delta", row_group_mb: int = ROW_GROUP_MB,
                 partitions: int | None = None, keep: tuple[str, ...] = ()) -> None:
    """Write ``docs`` (``doc_id``, ``text`` and the metadata columns
    ``keep``) to ``path`` as ``doc_id``, ``keep``, ``part``, ``local_start``,
    ``n_tokens`` and ``tokens``. ``encoding``: ``delta`` or ``dictionary``."""
    if encoding not in ("delta", "dictionary"):
        raise ValueError(f"unknown encoding {encoding!r}")
    tokenizer = tokenizer or default_tokenizer()
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *keep)
    order = [F.col("doc_id"), F.xxhash64("text")]
    ranged = (rows.repartitionByRange(partitions, *order) if partitions else rows.repartitionByRange(*order)).sortWithinPartitions(*order)
    names = ["doc_id", *keep]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*names).schema)

    def run(batches):
        part, at = TaskContext.get().partitionId(), 0
        for b in _together(batches):
            ids, n = encode_column(tokenizer, b.column("text"), end_id)
            ends = np.cumsum(n)
            tokens = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(ids.view("<i4")))
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in names], pa.array(np.full(len(b), part, dtype=np.int32)), pa.array(at + ends - n), pa.array(n), tokens],
                names=[*names, "part", "local_start", "n_tokens", "tokens"])
            at += int(ends[-1])

    encoded = ranged.mapInArrow(run, f"{kinds}, part int, local_start long, n_tokens long, tokens array<int>")
    writer = (encoded.write.mode("overwrite").option("parquet.block.size", row_group_mb << 20)
                     .option("parquet.writer.version", "v2").option("parquet.enable.dictionary", "true"))
    if encoding == "delta":
        writer = writer.option("parquet.enable.dictionary#tokens.list.element", "false")
    # Texts reach the workers a few megabytes at a time.
    spark = docs.sparkSession
    before = spark.conf.get(BATCH_CONF)
    spark.conf.set(BATCH_CONF, str(BATCH_ROWS))
    try:
        writer.parquet(path)
    finally:
        spark.conf.set(BATCH_CONF, before)


def files(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: ``part``, ``rows``, ``n_tokens`` and ``base``, the
    tokens of all files before it."""
    per = spark.read.parquet(path).groupBy("part").agg(F.count(F.lit(1)).alias("rows"), F.sum("n_tokens").alias("n_tokens"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return per.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_tokens(spark: SparkSession, path: str, first: int | None = None, last: int | None = None, columns: tuple[str, ...] = ("tokens",)) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens`` and ``columns`` of the documents
    with ids from ``first`` to ``last``; only their row groups and pages, and
    only the named columns, are read."""
    rows = spark.read.parquet(path)
    if first is not None:
        rows = rows.filter(F.col("doc_id") >= first)
    if last is not None:
        rows = rows.filter(F.col("doc_id") <= last)
    # One row per file written: as many as the writer had tasks.
    base = F.broadcast(files(spark, path).select("part", "base"))
    return rows.join(base, "part").select("doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", *columns)


def digests(rows: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens``, ``ids_crc32`` (of the ids as
    little-endian unsigned 32-bit integers) and ``keep`` of read tokens."""
    names = ["doc_id", "start", "n_tokens"]

    def run(batches):
        for b in batches:
            tokens = b.column("tokens")
            flat = tokens.values.to_numpy(zero_copy_only=False).astype("<u4")
            cut = tokens.offsets.to_numpy()
            sums = [zlib.crc32(flat[x:y].tobytes()) for x, y in zip(cut[:-1], cut[1:])]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in names], pa.array(sums, pa.int64()), *[b.column(c) for c in keep]], names=[*names, "ids_crc32", *keep])

    schema = rows.select(*names).schema.add("ids_crc32", "long")
    for c in keep:
        schema = schema.add(rows.schema[c])
    return rows.mapInArrow(run, schema)


def store(docs: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Write all of ``docs`` and read the whole files back."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "tokens")
    write_tokens(docs, path, **options)
    return read_tokens(spark, path)
