"""Phrases whose words occur together more often than by chance.

Counting, by growing length: a phrase can reach ``min_count`` only if every
phrase inside it does. Words are counted exactly; then each pass over the
texts counts 64-bit hashes of the phrases of one length whose parts may be
frequent, and leaves a bit map of those that may be frequent themselves. The
bit maps have a fixed size and never miss a phrase (a full one only lets more
through). The last pass counts the phrases that all maps let through, as
text, exactly. Each task reduces its counts before the shuffle.

Estimation streams the counts, as external language model estimation does:
all frequent phrases lie in prefix order (sorted word by word) and again in
suffix order (sorted by the reversed words), both range-partitioned, so no
first word is hot. In prefix order a phrase directly follows the phrases it
extends, so one scan with a short stack meets, for every phrase, the counts
of all its beginnings; in suffix order, those of all its endings. What a
range lacks are beginnings of its first row only (``max_words`` - 1 at most),
looked up in the counts and broadcast. The two streams are merge-joined in
order of the phrase: left counts, right counts, and from one-word extensions
to either side whether a longer phrase stands for this one. If any longer
phrase holds a phrase nearly as often, so does an extension by one word.

Scores use decimals of 38 digits, exact up to 10^38.

Defined cases: a null text has no words; a null language counts as ``und``;
repeated rows count as often as they are there; ties are ordered by count,
then by phrase; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

#: Bits of a map of phrases that may be frequent.
MAP_BITS = 26
#: Keys that a task holds before it sends them on.
HELD_TEXTS, HELD_HASHES = 300_000, 1 << 21
#: Ranks are first taken within so many parts of a language.
SALTS = 32
UNKNOWN = "und"

#: A-Z to a-z, tab to blank, ends of pieces to line feed.
_PLAIN = bytes(10 if b in b".,;:!?\x0a\x0b\x0c\x0d" else b + 32 if 65 <= b <= 90 else 32 if b == 9 else b for b in range(256))
_MIX1, _MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def pieces(text: bytes | None) -> list[list[bytes]]:
    """The words of each piece of a text in UTF-8."""
    return [p.split() for p in (text or b"").translate(_PLAIN).split(b"\n")]


def texts_of(docs: DataFrame, lang: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col("text").cast("binary").alias("text"))


def _batches(batches, rows: int = 256):
    for b in batches:
        for i in range(0, len(b), rows):
            some = b.slice(i, rows)
            yield some.column("lang").to_pylist(), some.column("text").to_pylist()


def _text_rows(held: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
    for lang, c in held.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(c), pa.string()), pa.array(list(c), pa.binary()), pa.array(list(c.values()), pa.int64())], names=["lang", "phrase", "n"])


def count_words(texts: DataFrame) -> DataFrame:
    """(``lang``, ``phrase``, ``n``) of all words."""
    def run(batches):
        held: dict[str, Counter] = {}
        for langs, some in _batches(batches):
            for lang, text in zip(langs, some):
                c = held.setdefault(lang, Counter())
                for words in pieces(text):
                    c.update(words)
            if sum(map(len, held.values())) > HELD_TEXTS:
                yield from _text_rows(held)
                held = {}
        yield from _text_rows(held)

    rows = texts.mapInArrow(run, "lang string, phrase binary, n long")
    return rows.groupBy("lang", F.col("phrase").cast("string").alias("phrase")).agg(F.sum("n").alias("n"))


def _mixed(key: np.ndarray) -> np.ndarray:
    key = (key ^ (key >> np.uint64(29))) * _MIX2
    return key ^ (key >> np.uint64(32))


def word_keys(langs: list[str], of: np.ndarray, words: list[bytes]) -> np.ndarray:
    """64-bit keys of words; ``of``: which of ``langs`` each is in."""
    from xxhash import xxh64_intdigest

    hashed = lambda some: np.fromiter(map(xxh64_intdigest, some), dtype=np.uint64, count=len(some))
    return _mixed(hashed(words) + _MIX1 * hashed([lang.encode("utf-8", "surrogatepass") for lang in langs])[of])


def _in_map(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = keys >> np.uint64(64 - MAP_BITS)
    return (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _phrases(langs: list[str], texts: list[bytes | None], maps: list[np.ndarray], longest: int):
    """The words of some texts in a row, the text of each, and for each length
    up to ``longest`` the keys of the phrases starting at each word and
    whether they may be frequent. ``maps`` are by length; lengths beyond them
    are let through if both their parts one word shorter are."""
    words: list[bytes] = []
    lens, of = [], []
    for i, text in enumerate(texts):
        for p in pieces(text):
            if p:
                words += p
                lens.append(len(p))
                of.append(i)
    piece = np.repeat(np.arange(len(lens)), np.array(lens, dtype=np.int64))
    row = np.array(of, dtype=np.int64)[piece]
    single = word_keys(langs, row, words)
    out = [(single, _in_map(maps[0], single) if maps else np.ones(len(words), dtype=bool))]
    for m in range(2, longest + 1):
        key, ok = out[-1]
        n = max(0, len(words) - m + 1)
        # The key grows by the next word's.
        longer = _mixed(key[:n] * _MIX1 + single[m - 1:])
        may = ok[:n] & ok[1:n + 1] & (piece[:n] == piece[m - 1:])
        if m <= len(maps):
            at = np.flatnonzero(may)
            may[at] = _in_map(maps[m - 1], longer[at])
        out.append((longer, may))
    return words, row, out


def bit_map(keys: DataFrame) -> np.ndarray:
    """A map of the ``key`` column: at most 2^(MAP_BITS - 6) rows reach the
    driver."""
    at = F.shiftrightunsigned("key", 64 - MAP_BITS)
    got = keys.groupBy(F.shiftright(at, 6).alias("at")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(63).cast("int"))).alias("bits")).toArrow()
    out = np.zeros(1 << (MAP_BITS - 6), dtype=np.uint64)
    out[got.column("at").to_numpy()] = got.column("bits").to_numpy().view(np.uint64)
    return out.view(np.uint8)


def hash_counts(texts: DataFrame, shared, order: int) -> DataFrame:
    """(``key``, ``n``) of the phrases of ``order`` words whose parts may be
    frequent by the maps ``shared``."""
    def run(batches):
        held, size = [], 0

        def reduced():
            keys, n = np.unique(np.concatenate(held), return_counts=True) if held else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n.astype(np.int32))], names=["key", "n"])

        for langs, some in _batches(batches):
            _, _, found = _phrases(langs, some, shared.value, order)
            keys, may = found[-1]
            held.append(keys[may])
            size += len(held[-1])
            if size >= HELD_HASHES:
                yield reduced()
                held, size = [], 0
        yield reduced()

    return texts.mapInArrow(run, "key long, n int").groupBy("key").agg(F.sum("n").alias("n"))


def count_phrases(texts: DataFrame, shared, longest: int) -> DataFrame:
    """(``lang``, ``phrase``, ``n``) of the phrases of 2 to ``longest`` words
    that the maps let through."""
    def run(batches):
        held: dict[str, Counter] = {}
        for langs, some in _batches(batches):
            words, row, found = _phrases(langs, some, shared.value, longest)
            for m, (_, may) in enumerate(found[1:], 2):
                for i in np.flatnonzero(may).tolist():
                    held.setdefault(langs[row[i]], Counter())[b" ".join(words[i:i + m])] += 1
            if sum(map(len, held.values())) > HELD_TEXTS:
                yield from _text_rows(held)
                held = {}
        yield from _text_rows(held)

    rows = texts.mapInArrow(run, "lang string, phrase binary, n long")
    return rows.groupBy("lang", F.col("phrase").cast("string").alias("phrase")).agg(F.sum("n").alias("n"))


def frequent_phrases(docs: DataFrame, min_count: int, max_words: int, lang: str = "lang") -> tuple[DataFrame, DataFrame]:
    """(``lang``, ``words``, ``n``) of all phrases of up to ``max_words``
    words with ``min_count`` or more occurrences, and (``lang``, ``total``),
    the number of words."""
    sc = docs.sparkSession.sparkContext
    texts = texts_of(docs, lang)
    all_words = cut_lineage(count_words(texts), "collocation-words")
    totals = all_words.groupBy("lang").agg(F.sum("n").alias("total"))
    often = all_words.filter(F.col("n") >= min_count)

    def keyed(batches):
        for b in batches:
            keys = word_keys(b.column("lang").to_pylist(), np.arange(len(b)), b.column("phrase").to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64))], names=["key"])

    maps = [bit_map(often.select("lang", F.col("phrase").cast("binary").alias("phrase")).mapInArrow(keyed, "key long"))]
    # Lengths 4 and more are let through by their parts of 3.
    for order in range(2, min(3, max_words) + 1):
        counted = hash_counts(texts, sc.broadcast(list(maps)), order)
        maps.append(bit_map(counted.filter(F.col("n") >= min_count)))
    longer = count_phrases(texts, sc.broadcast(maps), max_words).filter(F.col("n") >= min_count)
    found = often.unionByName(longer).select("lang", F.split("phrase", " ").alias("words"), "n")
    return cut_lineage(found, "collocation-counts"), totals


def scan(ordered: DataFrame) -> DataFrame:
    """(``lang``, ``words``, ``n``, ``parts``) of phrases sorted by language
    and words within each partition: ``parts`` has the counts of the first 1,
    2, ... words, null where the partition does not hold them."""
    def run(batches):
        stack: list[tuple[list[str], int]] = []
        at = None
        for b in batches:
            parts = []
            for lang, words, n in zip(b.column("lang").to_pylist(), b.column("words").to_pylist(), b.column("n").to_pylist()):
                if lang != at:
                    at, stack = lang, []
                while stack and stack[-1][0] != words[:len(stack[-1][0])]:
                    stack.pop()
                below = dict.fromkeys(range(1, len(words)))
                below.update((len(w), c) for w, c in stack)
                parts.append(list(below.values()))
                stack.append((words, n))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(parts, pa.list_(pa.int64()))], names=["lang", "words", "n", "parts"])

    return ordered.mapInArrow(run, "lang string, words array<string>, n long, parts array<long>")


def beginnings(counts: DataFrame, max_words: int, name: str) -> DataFrame:
    """``scan`` of ``counts`` in order over ranges, gaps filled."""
    order = ["lang", "words"]
    streamed = cut_lineage(scan(counts.select(*order, "n").repartitionByRange(*order).sortWithinPartitions(*order)), name)
    # Only beginnings of a range's first row are in an earlier range.
    gaps = streamed.select("lang", "words", F.posexplode("parts").alias("at", "have")).filter("have IS NULL")
    gaps = gaps.select("lang", F.expr("slice(words, 1, at + 1)").alias("words")).distinct()
    known = F.broadcast(cut_lineage(gaps.join(counts.select("lang", "words", F.col("n").alias("have")), order), f"{name}-gaps"))
    out = streamed
    for k in range(1, max_words):
        own = known.select(F.col("lang").alias("_lang"), F.col("words").alias("_lead"), F.col("have").alias(f"_have{k}"))
        lacks = (F.size("parts") >= k) & F.get("parts", F.lit(k - 1)).isNull()
        out = out.withColumn("_own", F.when(lacks, F.slice("words", 1, k)))
        out = out.join(own, (F.col("lang") == F.col("_lang")) & (F.col("_own") == F.col("_lead")), "left").drop("_lang", "_lead", "_own")
    filled = [F.coalesce(F.get("parts", F.lit(k - 1)), F.col(f"_have{k}")) for k in range(1, max_words)]
    return out.select("lang", "words", "n", F.slice(F.array(*filled), 1, F.size("parts")).alias("parts"))


def collocations(docs: DataFrame, min_count: int = 100, max_words: int = 5, cover: int = 100, top: int = 2000, lang: str = "lang") -> DataFrame:
    """Per language the first ``top`` phrases of 2 to ``max_words`` words:
    ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``.
    A phrase goes if a longer one that holds it has ``cover`` percent of its
    occurrences or more."""
    counts, totals = frequent_phrases(docs, min_count, max_words, lang)
    lefts = beginnings(counts, max_words, "collocation-prefix")
    backward = beginnings(counts.select("lang", F.reverse("words").alias("words"), "n"), max_words, "collocation-suffix")
    rights = backward.select("lang", F.reverse("words").alias("words"), F.col("parts").alias("ends"))
    both = lefts.hint("merge").join(rights, ["lang", "words"]).filter(F.size("words") > 1)
    both = cut_lineage(both, "collocation-streams")
    size = F.size("words")
    # One-word extensions: a phrase less its last, or its first, word.
    last = F.element_at("parts", -1), F.slice("words", 1, size - 1)
    first = F.element_at("ends", -1), F.slice("words", 2, size - 1)
    covered = [both.filter(100 * F.col("n") >= cover * part).select("lang", words.alias("words")) for part, words in (last, first)]
    kept = both.join(covered[0].unionByName(covered[1]).distinct(), ["lang", "words"], "left_anti")
    # One row per language.
    kept = kept.withColumnRenamed("n", "a").join(F.broadcast(totals.withColumnRenamed("total", "n")), "lang")
    whole = lambda c: c.cast("decimal(19,0)")

    def cut(k):
        left, right = F.element_at("parts", k), F.element_at("ends", size - k)
        score = F.call_function("div", F.lit(1000).cast("decimal(4,0)") * whole(F.col("a")) * whole(F.col("n")), whole(left) * whole(right))
        return F.struct(score.alias("score"), k.alias("k"), left.alias("l"), right.alias("r"))

    best = F.array_min(F.transform(F.sequence(F.lit(1), size - 1), cut))
    scored = kept.withColumn("best", best).select(
        "lang", F.array_join("words", " ").alias("phrase"), "a", F.col("best.l").alias("l"), F.col("best.r").alias("r"), "n",
        F.col("best.score").alias("score"))
    by = [F.desc("score"), F.desc("a"), "phrase"]
    # At most SALTS * top rows of a language reach its one window.
    part = Window.partitionBy("lang", "_salt").orderBy(*by)
    near = scored.withColumn("_salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).withColumn("_rank", F.row_number().over(part)).filter(F.col("_rank") <= top)
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*by)).cast("long")).filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
