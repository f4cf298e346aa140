"""Language identification, word first, backing off to character n-grams.

A text is split into lower-cased runs of letters. A word that the learned
texts hold often enough (``MIN_COUNT`` times) is known and scored by its log
frequency per language. Any other word is scored by its character 4-grams; if
none is known by its 3-grams, then 2-grams, then single letters (a word is
framed by blanks, so beginnings and ends are n-grams of their own). Log
frequencies are taken relative to the mean over the languages and mixed with
it::

    v(w, l) = ln((1 - MIX) * f_l(w) / mean_l f_l(w) + MIX)

so the sum over a text's words is a log-likelihood ratio in which no single
word decides, and large and small languages weigh the same. The answer is the
language of the greatest sum, the score its share after a softmax.

One pass over the texts counts words, each task reducing (language, word)
before the shuffle; n-grams are counted from the words found. The table of known words grows with the corpus. Words
whose share of all occurrences is large enough go to the workers as sorted
64-bit hashes with a row of figures each: a share of 1 / bound leaves at most
``bound`` words, and if the whole table was counted to be within the bound,
all words go. Words beyond it are joined by shuffle to the words of each text
that the broadcast does not know (hot ones by a broadcast of their own). N-grams
are known from a share of 1 / ``GRAMS`` of their order, so at most ``GRAMS``
of each order are broadcast; rarer ones count as unseen at every size.

Defined cases: a null text, or one without a letter, is ``und`` with score 0;
words none of whose parts is known say nothing; ties go to the language first
in order; without anything learned all texts with letters are ``und``; rows
are treated one by one, so null and repeated ids do not matter; an empty
table gives no rows; other columns are ignored. Lower-casing and letters are
those of Unicode.
"""

from __future__ import annotations

import re
from collections import Counter
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

#: Orders of n-grams, the longest first.
ORDERS = (4, 3, 2, 1)
#: A word is known from so many learned occurrences on.
MIN_COUNT = 5
MIX = 0.02
#: N-grams known of each order, at most.
GRAMS = 1 << 18
#: Figures (words x languages) broadcast at most.
FIGURES = 1 << 23
#: Keys that a task holds before it sends them on.
HELD = 250_000
#: Scores of unseen words that a worker keeps.
MEMO = 100_000
#: A word with more than one in so many of the joined rows is joined by broadcast.
HOT = 1024
UNKNOWN = "und"

_RUN = re.compile(r"[^\W\d_]+")


def letter_words(text: str | None) -> list[str]:
    """Lower-cased runs of letters."""
    words = _RUN.findall((text or "").lower())
    if all(map(str.isalpha, words)):
        return words
    # Runs may hold numerals such as one half.
    return ["".join(run) for w in words for letters, run in groupby(w, str.isalpha) if letters]


def grams(word: str, order: int) -> list[str]:
    """Character n-grams of the word framed by blanks; single letters bare."""
    framed = word if order == 1 else f" {word} "
    return [framed[i:i + order] for i in range(len(framed) - order + 1)]


def _rows(held: dict[str, Counter], kind: int):
    for name, c in held.items():
        if c:
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(c), pa.string()), pa.array([kind] * len(c), pa.int32()), pa.array(list(c), pa.string()), pa.array(list(c.values()), pa.int64())],
                names=["lang", "kind", "key", "n"])


COUNTS = "lang string, kind int, key string, n long"


def _added(rows: DataFrame) -> DataFrame:
    return rows.groupBy("lang", "kind", "key").agg(F.sum("n").alias("n"))


def word_counts(docs: DataFrame, learn: Column, lang: str) -> DataFrame:
    """(``lang``, ``kind`` 0, ``key``, ``n``): occurrences of words in the
    learned texts."""
    def run(batches):
        held: dict[str, Counter] = {}
        for b in batches:
            for name, text in zip(b.column("lang").to_pylist(), b.column("text")):
                held.setdefault(name, Counter()).update(letter_words(text.as_py()))
                if sum(map(len, held.values())) > HELD:
                    yield from _rows(held, 0)
                    held = {}
        yield from _rows(held, 0)

    rows = docs.filter(learn & F.col(lang).isNotNull() & F.col("text").isNotNull()).select(F.col(lang).cast("string").alias("lang"), "text")
    return _added(rows.mapInArrow(run, COUNTS))


def gram_counts(words: DataFrame) -> DataFrame:
    """(``lang``, ``kind``, ``key``, ``n``): occurrences of n-grams (kind: the
    order) in the words of ``word_counts``, each as often as its word."""
    def run(batches):
        held: dict[int, dict[str, Counter]] = {order: {} for order in ORDERS}

        def told():
            for order, some in held.items():
                yield from _rows(some, order)
                some.clear()

        for b in batches:
            for name, word, n in zip(b.column("lang").to_pylist(), b.column("key").to_pylist(), b.column("n").to_pylist()):
                for order, some in held.items():
                    c = some.setdefault(name, Counter())
                    for g in grams(word, order):
                        c[g] += n
            if sum(len(c) for some in held.values() for c in some.values()) > HELD:
                yield from told()
        yield from told()

    return _added(words.mapInArrow(run, COUNTS))


class Model:
    """``langs`` in order; ``words``: (``key``, ``share``, ``v`` array of
    figures by language) as a DataFrame; ``grams``: n-gram -> row of
    ``gram_figures``."""

    def __init__(self, langs: list[str], words: DataFrame | None, grams: dict[str, int], gram_figures: np.ndarray):
        self.langs, self.words, self.grams, self.gram_figures = langs, words, grams, gram_figures


def _figures(by_lang: DataFrame, totals: dict[str, float], mix: float) -> DataFrame:
    """(``key``, ``kind``, ``n``, ``v``) from rows (``kind``, ``key``,
    ``lang``, ``n``); ``totals`` by language."""
    langs = sorted(totals)
    share = F.create_map(*[F.lit(x) for name in langs for x in (name, 1.0 / totals[name])])
    grouped = by_lang.groupBy("kind", "key").agg(
        F.sum("n").alias("n"),
        F.map_from_entries(F.collect_list(F.struct("lang", F.col("n") * F.element_at(share, F.col("lang"))))).alias("f"))
    mean = F.aggregate(F.map_values("f"), F.lit(0.0), lambda a, x: a + x) / float(len(langs))
    value = lambda name: F.log((1.0 - mix) * F.coalesce(F.element_at("f", name), F.lit(0.0)) / mean + mix)
    return grouped.select("kind", "key", "n", F.transform(F.lit(langs), value).cast("array<float>").alias("v"))


def learn_model(docs: DataFrame, learn: Column, lang: str = "lang", min_count: int = MIN_COUNT, mix: float = MIX, grams: int = GRAMS) -> Model:
    """Count the texts for which ``learn`` holds and which have a language.
    The languages and the known n-grams reach the driver."""
    of_words = cut_lineage(word_counts(docs, learn, lang), "langid-words")
    counted = of_words.unionByName(cut_lineage(gram_counts(of_words), "langid-grams"))
    totals = {(r["lang"], r["kind"]): r["n"] for r in counted.groupBy("lang", "kind").agg(F.sum("n").alias("n")).collect()}
    langs = sorted({name for name, _ in totals})
    if not langs:
        return Model([], None, {}, np.zeros((0, 0), dtype=np.float32))
    of = lambda kind: {name: float(totals.get((name, kind), 1)) for name in langs}
    rows, figures = [], []
    for order in ORDERS:
        floor = sum(totals.get((name, order), 0) for name in langs) / grams
        some = _figures(counted.filter(F.col("kind") == order), of(order), mix).filter(F.col("n") >= floor).orderBy("key").toArrow()
        rows += some.column("key").to_pylist()
        figures.append(np.array(some.column("v").to_pylist(), dtype=np.float32).reshape(-1, len(langs)))
    words = _figures(counted.filter("kind = 0"), of(0), mix).filter(F.col("n") >= min_count)
    everything = float(sum(of(0).values()))
    words = cut_lineage(words.select("key", (F.col("n") / everything).alias("share"), "v"), "langid-known")
    return Model(langs, words, {g: i for i, g in enumerate(rows)}, np.concatenate(figures))


def _hashes(words: list[str]) -> np.ndarray:
    from xxhash import xxh64_intdigest

    return np.fromiter(map(xxh64_intdigest, words), dtype=np.uint64, count=len(words))


def _hashed(batches):
    for b in batches:
        yield pa.RecordBatch.from_arrays([pa.array(_hashes(b.column("key").to_pylist()).view(np.int64)), b.column("v")], names=["hash", "v"])


class _Scorer:
    """The broadcast part of a model in one worker process."""

    def __init__(self, known: np.ndarray, figures: np.ndarray, grams: dict[str, int], gram_figures: np.ndarray):
        self.known, self.figures, self.grams, self.gram_figures = known, figures, grams, gram_figures
        self.memo: dict[str, np.ndarray] = {}

    def unseen(self, word: str) -> np.ndarray:
        """Mean figures of the longest n-grams of which any is known."""
        got = self.memo.get(word)
        if got is None:
            if len(self.memo) >= MEMO:
                self.memo.clear()
            got = np.zeros(self.gram_figures.shape[1])
            for order in ORDERS:
                at = [i for i in map(self.grams.get, grams(word, order)) if i is not None]
                if at:
                    got = self.gram_figures[at].mean(axis=0, dtype=np.float64)
                    break
            self.memo[word] = got
        return got

    def known_rows(self, words: list[str]) -> np.ndarray:
        """Row of each word's figures, -1 where not broadcast."""
        h = _hashes(words)
        if not len(self.known) or not len(h):
            return np.full(len(h), -1)
        at = np.minimum(np.searchsorted(self.known, h), len(self.known) - 1)
        return np.where(self.known[at] == h, at, -1)


def _answer(langs: list[str], sums: np.ndarray, letters: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Language and score from the sums of each text."""
    if not langs:
        return pa.array([UNKNOWN] * len(letters)), pa.array(np.zeros(len(letters)))
    best = np.argmax(np.round(sums, 9), axis=1)
    top = sums[np.arange(len(sums)), best][:, None] if len(sums) else sums
    share = 1.0 / np.exp(sums - top).sum(axis=1)
    names = [langs[i] if some else UNKNOWN for i, some in zip(best.tolist(), letters)]
    return pa.array(names, pa.string()), pa.array(np.where(letters, np.round(share, 6), 0.0))


def predict(docs: DataFrame, model: Model, keep: dict[str, Column] | None = None, bound: int | None = None) -> DataFrame:
    """Per row of ``docs`` the columns ``keep`` (default: ``doc_id``),
    ``lang_pred`` and ``score``. ``bound``: words broadcast at most (default:
    ``FIGURES`` by the number of languages)."""
    spark = docs.sparkSession
    keep = keep or {"doc_id": F.col("doc_id")}
    langs, names = model.langs, list(keep)
    bound = bound or max(1, FIGURES // max(1, len(langs)))
    rest, chosen = None, None
    if model.words is not None:
        # A share of 1 / bound or more: no more than bound words.
        whole_table = model.words.limit(bound + 1).count() <= bound
        large = F.lit(True) if whole_table else F.col("share") * bound >= 1
        rest = None if whole_table else model.words.filter(~large)
        chosen = model.words.filter(large).select("key", "v").mapInArrow(_hashed, "hash long, v array<float>").toArrow()
    known, table = np.zeros(0, dtype=np.uint64), np.zeros((0, len(langs)), dtype=np.float32)
    if chosen is not None and len(chosen):
        known = chosen.column("hash").to_numpy().view(np.uint64)
        table = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in chosen.column("v").chunks]).reshape(-1, len(langs))
        order = np.argsort(known, kind="stable")
        known, table = known[order], table[order]
    shared = spark.sparkContext.broadcast((known, table, model.grams, model.gram_figures))

    def scored(batches, finish):
        scorer = _Scorer(*shared.value)
        width = max(1, len(langs))
        for whole_batch in batches:
            for i in range(0, len(whole_batch), 256):
                b = whole_batch.slice(i, 256)
                texts = [letter_words(t) for t in b.column("text").to_pylist()]
                sizes = np.array([len(t) for t in texts], dtype=np.int64)
                words = [w for t in texts for w in t]
                doc = np.repeat(np.arange(len(texts)), sizes)
                at = scorer.known_rows(words)
                own, sums = at >= 0, np.zeros((len(texts), width))
                for k in range(len(langs)):
                    sums[:, k] = np.bincount(doc[own], scorer.figures[at[own], k], minlength=len(texts))
                left: list[Counter] = [Counter() for _ in texts]
                for j in np.flatnonzero(~own).tolist():
                    left[doc[j]][words[j]] += 1
                yield from finish(scorer, b, sums, left, sizes > 0)

    def at_once(scorer, b, sums, left, letters):
        if langs:
            for d, words in enumerate(left):
                for w, n in words.items():
                    sums[d] += n * scorer.unseen(w)
        yield pa.RecordBatch.from_arrays([*[b.column(c) for c in names], *_answer(langs, sums, letters)], names=[*names, "lang_pred", "score"])

    rows = docs.select(*[c.alias(n) for n, c in keep.items()], *([] if "text" in names else ["text"]))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*names).schema)
    answer = f"{kinds}, lang_pred string, score double"
    if rest is None:
        return rows.mapInArrow(lambda batches: scored(batches, at_once), answer)

    def listed(scorer, b, sums, left, letters):
        kind = pa.list_(pa.struct([("key", pa.string()), ("n", pa.int64())]))
        words = pa.array([[{"key": w, "n": n} for w, n in c.items()] for c in left], kind)
        yield pa.RecordBatch.from_arrays(
            [*[b.column(c) for c in ["_row", *names]], pa.array(sums.tolist(), pa.list_(pa.float64())), pa.array(letters), words],
            names=["_row", *names, "_sums", "_letters", "_left"])

    # Staged, so that the row numbers are the same in both joins.
    texts = cut_lineage(rows.withColumn("_row", F.monotonically_increasing_id()).mapInArrow(
        lambda batches: scored(batches, listed),
        f"_row long, {kinds}, _sums array<double>, _letters boolean, _left array<struct<key:string,n:long>>"), "langid-texts")
    left, rest = texts.select("_row", F.inline("_left")), rest.select("key", "v")
    # Words that were not learned may be in any number of texts. At most HOT
    # words have more than one in HOT of these rows.
    many = left.count()
    often = cut_lineage(left.groupBy("key").count().filter(F.col("count") * HOT > many).join(rest, "key", "left").select("key", "v"), "langid-often")
    found = left.join(F.broadcast(often), "key").unionByName(
        left.join(F.broadcast(often.select("key")), "key", "left_anti").join(rest, "key", "left"))

    def backed_off(batches):
        scorer = _Scorer(*shared.value)
        for b in batches:
            v = [x if x is not None else scorer.unseen(w).tolist() for w, x in zip(b.column("key").to_pylist(), b.column("v").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("_row"), b.column("n"), pa.array(v, pa.list_(pa.float64()))], names=["_row", "n", "v"])

    each = found.select("_row", "n", "key", F.col("v").cast("array<double>").alias("v")).mapInArrow(backed_off, "_row long, n long, v array<double>")
    more = each.groupBy("_row").agg(*[F.sum(F.col("n") * F.col("v")[k]).alias(f"_s{k}") for k in range(len(langs))])
    total = F.array(*[F.col("_sums")[k] + F.coalesce(F.col(f"_s{k}"), F.lit(0.0)) for k in range(len(langs))])
    both = texts.drop("_left").join(more, "_row", "left").select(*names, "_letters", total.alias("_sums"))

    def answered(batches):
        for b in batches:
            sums = np.array(b.column("_sums").to_pylist(), dtype=np.float64).reshape(-1, len(langs))
            letters = np.array(b.column("_letters").to_pylist(), dtype=bool)
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in names], *_answer(langs, sums, letters)], names=[*names, "lang_pred", "score"])

    return both.mapInArrow(answered, answer)


def identify(docs: DataFrame, learn: Column, lang: str = "lang", keep: dict[str, Column] | None = None, **options) -> DataFrame:
    """Learn from the rows of ``docs`` for which ``learn`` holds, answer for
    all: ``keep``, ``lang_pred`` and ``score``."""
    return predict(docs, learn_model(docs, learn, lang, **options), keep)
