"""SimHash near-duplicates by Golay-code fuzzy hashing.

Fingerprint: texts lower-cased (A-Z), words between ASCII white space,
shingles of ``shingle`` words joined by a blank (repeats included; a shorter
text is one shingle), each hashed with 64-bit XXH64; a bit is set if it is
set in more than half of the hashes.

Linking: two fingerprints are linked if they differ in at most 3 bits. They
are cut into four 16-bit segments; with 3 errors at least one segment is
exact, and of the two halves (24 bits) of the other three segments one has
at most one error. Of that half 23 bits are decoded with the binary Golay
code [23,12,7]: every 23-bit word is within 3 bits of exactly one codeword.
If u and v differ in at most one bit, the codeword of u is within 4 bits of
v. So each fingerprint has, for each of the 8 (segment, half) choices, one
home key (its own codeword) and 1 or 6 near keys (all codewords within 4
bits), each joined with the exact segment; home keys are joined with near
keys and the pairs verified by their bit distance. No link can be missed and
no bucket is capped.

Equal fingerprints are one class before the join, so copies are never
expanded; what the join returns are links between different fingerprints
only, and AQE may split a hot key. A fingerprint has about 40 keys, which the
plan's estimate knows nothing of, so nothing here is joined by broadcast. Links become groups by distributed
connected components.

Defined cases: a null or empty text has fingerprint zero, linked like any
other; a null ``doc_id`` gets its group's smallest id; repeated rows stay
separate rows; an empty table gives an empty result.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..session import cut_lineage
from .base import by_shuffle
from .graph import components

SHINGLE = 3
SEED = 42
DISTANCE = 3

#: Generator polynomial of the binary Golay code, x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GOLAY = 0b110001110101


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The unsigned 64-bit SimHash of a text."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        hashes = np.array([digest(line, seed)], dtype=np.uint64)
    else:
        size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        end = np.cumsum(size + 1) - 1
        start = end - size
        n = len(words) - shingle + 1
        cuts = zip(start[:n].tolist(), end[shingle - 1:].tolist())
        hashes = np.fromiter((digest(line[a:b], seed) for a, b in cuts), dtype=np.uint64, count=n)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):  # bounded memory for very long texts
        bits = np.unpackbits(hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


@functools.lru_cache(maxsize=1)
def golay_tables() -> tuple[np.ndarray, np.ndarray]:
    """By 11-bit syndrome: the error word of at most 3 bits, and the 1 or 6
    error words of at most 4 bits (the first repeated where there is one)."""
    from itertools import combinations

    unit = []
    for i in range(23):
        r = 1 << i
        for b in range(22, 10, -1):
            if r >> b & 1:
                r ^= GOLAY << (b - 11)
        unit.append(r)
    near: list[list[int]] = [[] for _ in range(2048)]
    for weight in range(5):
        for at in combinations(range(23), weight):
            s = e = 0
            for i in at:
                s ^= unit[i]
                e |= 1 << i
            near[s].append(e)
    leader = np.array([x[0] for x in near], dtype=np.uint64)
    table = np.array([x + x[:1] * (6 - len(x)) for x in near], dtype=np.uint64)
    return leader, table


def _syndrome(v: np.ndarray) -> np.ndarray:
    s = v.copy()
    for b in range(22, 10, -1):
        s ^= (s >> np.uint64(b) & np.uint64(1)) * np.uint64(GOLAY << (b - 11))
    return s


def golay_keys(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(home keys [n, 8], near keys [n, 8, 6]) of unsigned fingerprints; near
    keys are repeated where there are fewer."""
    leader, table = golay_tables()
    seg = [(fp >> np.uint64(16 * i)) & np.uint64(0xFFFF) for i in range(4)]
    home, near = [], []
    for exact in range(4):
        a, b, c = (seg[i] for i in range(4) if i != exact)
        rest = a | b << np.uint64(16) | c << np.uint64(32)
        for half in range(2):
            v = (rest >> np.uint64(24 * half)) & np.uint64(0x7FFFFF)
            s = _syndrome(v)
            # Systematic code: the upper 12 bits of a codeword are its index.
            tag = np.uint64(exact * 2 + half) << np.uint64(28) | seg[exact] << np.uint64(12)
            home.append(tag | (v ^ leader[s]) >> np.uint64(11))
            near.append(tag[:, None] | (v[:, None] ^ table[s]) >> np.uint64(11))
    return np.stack(home, 1), np.stack(near, 1)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED, keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id``, ``keep`` and ``fp`` (the fingerprint as a signed long)."""
    rows = docs.select("doc_id", "text", *keep)
    names = ["doc_id", *keep]
    schema = StructType([*[rows.schema[c] for c in names], StructField("fp", LongType())])

    def run(batches):
        for b in batches:
            fp = np.fromiter((fingerprint(t.as_py(), shingle, seed) for t in b.column("text")), dtype=np.uint64, count=len(b))
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in names], pa.array(fp.view(np.int64))], names=[*names, "fp"])

    return rows.mapInArrow(run, schema)


def links(classes: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Pairs (``u`` < ``v``) of distinct fingerprints of ``classes`` (column
    ``fp``) that differ in at most ``distance`` (3 or fewer) bits."""
    if not 0 <= distance <= 3:
        raise ValueError("the code covers up to 3 bits")

    def run(near: bool):
        def keys(batches):
            for b in batches:
                fp = b.column("fp").to_numpy()
                home, around = golay_keys(fp.view(np.uint64))
                k = (around if near else home).reshape(len(fp), -1).view(np.int64)
                k = np.sort(k, axis=1)
                first = np.ones(k.shape, dtype=bool)
                first[:, 1:] = k[:, 1:] != k[:, :-1]
                row, col = np.nonzero(first)
                yield pa.RecordBatch.from_arrays([pa.array(k[row, col]), pa.array(fp[row])], names=["key", "fp"])

        return keys

    fps = classes.select("fp")
    home = fps.mapInArrow(run(False), "key long, fp long").withColumnRenamed("fp", "u")
    near = fps.mapInArrow(run(True), "key long, fp long").withColumnRenamed("fp", "v")
    close = (F.col("u") < F.col("v")) & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= distance)
    pairs = home.join(by_shuffle(near), (home["key"] == near["key"]) & close)
    return pairs.select("u", "v").distinct()


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, seed: int = SEED, keep: tuple[str, ...] = ()) -> DataFrame:
    """Every row of ``docs`` with ``fp``, its group's ``root`` (the smallest
    fingerprint) and ``component_id``, the smallest ``doc_id`` that it is
    linked to, itself included."""
    rows = cut_lineage(fingerprints(docs, shingle, seed, keep), "simhash")
    classes = cut_lineage(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-classes")
    roots = components(links(classes, distance)).select(F.col("node").alias("fp"), "root")
    joined = classes.join(by_shuffle(roots), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    first = joined.groupBy("root").agg(F.min("first").alias("component_id"))
    of_class = cut_lineage(joined.join(by_shuffle(first), "root").select("fp", "root", "component_id"), "simhash-groups")
    return rows.join(by_shuffle(of_class), "fp")


def hex_fingerprint(fp: str = "fp") -> Column:
    """A signed fingerprint as 16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """One row of ``docs`` of each group, all columns kept: the one with the
    smallest ``doc_id`` (null last), then the first by hash of the text."""
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    hashed = docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("_hash"), F.struct(F.lit(0).alias("_"), *rest).alias("_row"))
    groups = near_duplicates(hashed, keep=("_hash",), **options)
    lead = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_hash")).alias("lead")
    leads = groups.groupBy("root").agg(lead).select(F.col("lead.doc_id").alias("_lead"), F.col("lead._hash").alias("_lead_hash")).distinct()
    rows = hashed.join(by_shuffle(leads), F.col("doc_id").eqNullSafe(F.col("_lead")) & (F.col("_hash") == F.col("_lead_hash")), "left_semi")
    # Repeated rows of the lead: one stays.
    order = Window.partitionBy("doc_id", "_hash").orderBy(F.xxhash64("_row"), *[F.col(f"_row.{c}").asc_nulls_last() for c in rest])
    one = rows.withColumn("_n", F.row_number().over(order)).filter("_n = 1")
    return one.select(*[c if c in ("doc_id", "text") else F.col(f"_row.{c}").alias(c) for c in docs.columns])
