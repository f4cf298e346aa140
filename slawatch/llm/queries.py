"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from . import audit, chat, collocations, decontaminate, dedup, langid, mixing, pii, quality, simhash, tokens, topk, toxicity
from .base import remainder, table, workers_import

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def add(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            workers_import(spark)
            return f(spark, sf_dir)

        QUERIES[name] = run
        if sql:
            ORACLE[name] = sql
        return run

    return add


MIXING_SQL = """
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
         md5('42:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))) AS digest FROM documents),
src AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM sized GROUP BY source),
w AS (
  SELECT *, [5, 2, 1][(rank % 3 + 1)::INT] AS weight, (sum(source_size) OVER ())::BIGINT AS total,
         3 * source_size AS cap FROM src),
rising AS (
  SELECT *, row_number() OVER o AS turn,
         total - coalesce((sum(cap) OVER (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))::BIGINT, 0) AS free,
         (sum(weight) OVER (ORDER BY cap / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS rest
  FROM w WINDOW o AS (ORDER BY cap / weight, rank)),
level AS (
  SELECT turn AS t, free AS f, rest AS r FROM rising
  WHERE free * weight::DOUBLE <= cap * rest::DOUBLE ORDER BY turn LIMIT 1),
target AS (
  SELECT source, rank, source_size, total, greatest(1, total // (1 << 20)) AS block,
         CASE WHEN turn < t THEN cap::DOUBLE ELSE f * weight::DOUBLE / r END AS target
  FROM rising, level),
sn AS (
  SELECT *, total // block AS q, target / sum(target) OVER () AS mean, count(*) OVER () / 2.0 AS n FROM target),
ss AS (
  SELECT *, greatest(0, floor(mean * (q - n) + 0.5))::BIGINT AS sure,
         greatest(0, floor(mean * (q + n) + 0.5) + 1)::BIGINT AS most FROM sn),
sl AS (SELECT *, q - (sum(sure) OVER ())::BIGINT AS lft FROM ss),
sk AS (SELECT rank, target, lft, unnest(range(sure + 1, most + 1)) AS k FROM sl),
sr AS (SELECT rank, lft, row_number() OVER (ORDER BY target / (2 * k - 1) DESC, rank) AS i FROM sk),
sw AS (SELECT rank, count(*) AS won FROM sr WHERE i <= lft GROUP BY rank),
sources AS (
  SELECT sl.*, least(sure + coalesce(won, 0), floor(source_size * 3 / block)::BIGINT) AS seats,
         greatest(1, ceil(source_size / 1048576))::BIGINT AS shards FROM sl LEFT JOIN sw USING (rank)),
placed AS (
  SELECT doc_id, size, digest, o.*, ('0x' || substr(digest, 1, 8))::BIGINT % shards AS shard
  FROM sized d JOIN sources o ON d.source IS NOT DISTINCT FROM o.source),
shard AS (
  SELECT rank, shard, seats, block, sum(size)::BIGINT AS shard_size FROM placed GROUP BY ALL),
hn AS (
  SELECT *, shard_size / sum(shard_size) OVER (PARTITION BY rank) AS mean,
         count(*) OVER (PARTITION BY rank) / 2.0 AS n FROM shard),
hs AS (
  SELECT *, coalesce(greatest(0, floor(mean * (seats - n) + 0.5)), 0)::BIGINT AS sure,
         coalesce(greatest(0, floor(mean * (seats + n) + 0.5) + 1), 0)::BIGINT AS most FROM hn),
hl AS (SELECT *, seats - (sum(sure) OVER (PARTITION BY rank))::BIGINT AS lft FROM hs),
hk AS (SELECT rank, shard, shard_size, lft, unnest(range(sure + 1, most + 1)) AS k FROM hl),
hr AS (
  SELECT rank, shard, lft, row_number() OVER (PARTITION BY rank ORDER BY shard_size / (2 * k - 1) DESC, shard) AS i FROM hk),
hw AS (SELECT rank, shard, count(*) AS won FROM hr WHERE i <= lft GROUP BY ALL),
quota AS (
  SELECT rank, shard, greatest(shard_size, 1) AS ring,
         least(sure + coalesce(won, 0), floor(shard_size * 3 / block)::BIGINT) * block AS words,
         ('0x' || substr(md5('42:' || rank || ':' || shard), 1, 8))::BIGINT % greatest(1, shard_size // block) * block AS first
  FROM hl LEFT JOIN hw USING (rank, shard)),
laid AS (
  SELECT p.*, ring, words // ring AS copies, first, first + words % ring AS last,
         coalesce((sum(size) OVER (PARTITION BY p.rank, p.shard ORDER BY digest
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))::BIGINT, 0) AS a
  FROM placed p JOIN quota USING (rank, shard))
SELECT doc_id, size, source_size, target,
       copies * size + greatest(0, least(size, last - a)) - greatest(0, least(size, first - a))
       + greatest(0, least(size, last - ring - a)) AS taken
FROM laid
"""


@register("op3_mix_sources", MIXING_SQL)
def op3_mix_sources(spark, sf_dir):
    """Words that a mix at the target weights takes from every document."""
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


CHAT_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
sized AS (
  SELECT *, 17 + length(role) + length(text)
         + length(regexp_replace(role || text, '[^\\<\[]', '', 'g')) AS chars,
         CASE WHEN role = 'assistant' THEN text ELSE '' END AS loss FROM rows)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       sum(length(loss))::BIGINT AS loss_chars,
       sha256(string_agg(loss, '' ORDER BY turn, role, text)) AS loss_sha256,
       (3 + sum(chars))::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""
#: Both turns of the extra conversation say this.
CONTROL = "</s>[INST] ok [/INST]"


@register("op5_chat_format", CHAT_SQL)
def op5_chat_format(spark, sf_dir):
    """Every conversation formatted as one text, read back from the files."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-1, 0, "user", CONTROL), (-1, 1, "assistant", CONTROL)], rows.schema)
    messages = chat.as_tree(rows.unionByName(extra))
    return chat.digests(chat.write_formatted(spark, chat.format_conversations(messages)))


DECONTAMINATION_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bi AS (SELECT item_id, w, least(13, len(w)) AS n, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS i FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS t FROM bi),
di AS (SELECT row, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n),
h AS (SELECT row, i, di.n, item_id FROM di JOIN bw ON bw.n = di.n AND bw.t = array_to_string(w[i:i + di.n - 1], ' ')),
c AS (SELECT row, count(DISTINCT p) AS n_hit FROM (SELECT row, unnest(range(i, i + n)) AS p FROM h) GROUP BY row),
j AS (SELECT row, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
      FROM (SELECT DISTINCT row, item_id::VARCHAR AS item FROM h) GROUP BY row)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN c USING (row) LEFT JOIN j USING (row)
"""


@register("op9_decontaminate", DECONTAMINATION_SQL)
def op9_decontaminate(spark, sf_dir):
    """Benchmark passages in every document."""
    found = decontaminate.hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


@register("op6_simhash")
def op6_simhash(spark, sf_dir):
    """Fingerprint and near-duplicate group of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_fingerprint().alias("fingerprint"), "component_id")


@register("op1_token_ids")
def op1_token_ids(spark, sf_dir):
    """Token ids of every document, written to files and read back."""
    return tokens.digests(tokens.store(table(spark, sf_dir, "documents")))

@register("op10_quality")
def op10_quality(spark, sf_dir):
    """Quality score of every document."""
    found = quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), remainder("doc_id", 5) == 0)
    return found.select("doc_id", "held_out", "score", "predicted")


@register("op4_toxicity")
def op4_toxicity(spark, sf_dir):
    """Toxicity score of every document."""
    rest = remainder("doc_id", 3)
    fold = F.when(rest == 0, 0).when(rest == 2, 1)
    found = toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), fold)
    return found.select("doc_id", F.col("fold").isNull().alias("held_out"), "score", "predicted")


TOPK_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM s QUALIFY rank <= 5
"""


@register("op8_top_k", TOPK_SQL)
def op8_top_k(spark, sf_dir):
    """The 5 largest inner products of every 50th vector, against all rows."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@register("op2_personal_data")
def op2_personal_data(spark, sf_dir):
    """Spans of personal data in every document."""
    found = pii.find(table(spark, sf_dir, "documents"))
    return found.select("doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in pii.KINDS],
                        F.sha2(pii.listed(*pii.KINDS), 256).alias("base_sha256"), pii.listed(*pii.KINDS, "secret").alias("spans"))


@register("op7_repeated_strings")
def op7_repeated_strings(spark, sf_dir):
    """What stays of every document without its repeated 100-byte strings."""
    found = dedup.remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda a, r: a + r["end"] - r["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"))


COLLOCATION_SQL = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
g AS (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM w, (SELECT unnest(range(1, 6)) AS m) WHERE len(w) >= m),
f AS (SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase, count(*)::BIGINT AS f FROM g GROUP BY ALL),
t AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE m = 1 GROUP BY lang),
c AS (SELECT lang, m, phrase, string_split(phrase, ' ') AS w, f AS a FROM f WHERE m > 1 AND f >= 100),
inside AS (
  SELECT DISTINCT lang, array_to_string(w[i:i + k - 1], ' ') AS phrase, a
  FROM (SELECT *, unnest(range(1, m - k + 2)) AS i FROM (SELECT *, unnest(range(2, m)) AS k FROM c))),
dropped AS (SELECT DISTINCT c.lang, c.phrase FROM c JOIN inside USING (lang, phrase) WHERE 100 * inside.a >= 100 * c.a),
cut AS (SELECT *, unnest(range(1, m)) AS k FROM c WHERE NOT EXISTS (SELECT 1 FROM dropped d WHERE d.lang = c.lang AND d.phrase = c.phrase)),
s AS (
  SELECT cut.lang, cut.phrase, a, l.f AS l, r.f AS r, n, k, ((1000::HUGEINT * a * n) // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM cut JOIN t USING (lang)
  JOIN f l ON l.lang = cut.lang AND l.phrase = array_to_string(w[1:k], ' ')
  JOIN f r ON r.lang = cut.lang AND r.phrase = array_to_string(w[k + 1:], ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM b QUALIFY rank <= 2000
"""


@register("op11_collocations", COLLOCATION_SQL)
def op11_collocations(spark, sf_dir):
    """The phrases of each language that occur together most beyond chance."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


@register("op12_language_id")
def op12_language_id(spark, sf_dir):
    """Language of every document."""
    learn = remainder("doc_id", 4) != 2
    return langid.identify(table(spark, sf_dir, "documents"), learn, keep={"doc_id": F.col("doc_id"), "held_out": ~learn})


AUDIT_SQL = r"""
WITH w AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
first AS (SELECT text, min(doc_id) AS id FROM w GROUP BY text),
l AS (SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic
      FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
d AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         (len(w) < 100)::INT + 2 * (100 * len(list_distinct(w)) < 80 * len(w))::INT
         + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text))::INT
         + 8 * regexp_matches(text, '[#$%&*|]')::INT + 16 * coalesce(doc_id > id, false)::INT AS mask
  FROM w JOIN first USING (text) LEFT JOIN l USING (doc_id)),
c AS (SELECT part, good, toxic, mask, count(*) AS n FROM d GROUP BY ALL),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM x a, x b, x c, x d, x e
      WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT filter_order, step, filter_order[step] AS x, 1 << (ascii(filter_order[step]) - 65) AS bit,
             list_sum(list_transform(range(1, step), lambda i: 1 << (ascii(filter_order[i]) - 65)))::INT AS seen
      FROM o, (SELECT unnest(range(1, 6))::INT AS step)),
v AS (SELECT part, filter_order, step, x, n, good, toxic, mask & bit <> 0 AS fails, mask & coalesce(seen, 0) = 0 AS alive, mask = bit AS alone FROM c, s),
r AS (
  SELECT part, filter_order, step, x,
         coalesce(sum(n) FILTER (alive AND NOT fails), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (alive AND fails), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (NOT alive AND fails), 0)::BIGINT AS redundant, coalesce(sum(n) FILTER (alone), 0)::BIGINT AS unique_fails,
         coalesce(sum(n) FILTER (alive AND fails AND good), 0)::BIGINT AS good_lost, coalesce(sum(n) FILTER (alive AND fails AND toxic), 0)::BIGINT AS toxic_lost
  FROM v GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, x))::BIGINT AS shapley FROM r
"""


@register("op13_filter_audit", AUDIT_SQL)
def op13_filter_audit(spark, sf_dir):
    """What five filters remove of every language, in every order."""
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark, sf_dir):
    """Documents to token ids, through all stages."""
    return corpus_pipeline.run(spark, sf_dir)
