"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import workers_import  # noqa: F401

#: White space between words: space and tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(text: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(text), F.lit(""))


def seeded(seed: int, *cols: Column) -> Column:
    """Hex digest that orders rows pseudo-randomly, the same on every run and
    in any engine that has md5; a null part counts as empty."""
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in cols]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *parts))


def bucket(digest: Column, n: Column) -> Column:
    """A bucket from 0 to n - 1, from the first 32 bits of a hex digest."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % n


#: Byte by byte: A-Z to a-z; ASCII other than letters and digits to blanks.
PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def plain_words(text: str | None) -> list[bytes]:
    """Runs of ASCII letters and digits and of any character beyond ASCII,
    A-Z lower-cased, in UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(PLAIN).split()


def remainder(doc_id: str, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; a null id counts as empty."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % mod


#: Tables of at most so many small rows may be broadcast; the rest is joined by shuffle.
BROADCAST_ROWS = 2_000_000


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it was counted to be small enough."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def by_shuffle(df: DataFrame) -> DataFrame:
    """``df``, to be joined by shuffle whatever its size is taken for: a plan
    takes the rows that Python code yields for as many as it reads, and a
    stored table for its compressed bytes, and would broadcast millions."""
    return df.hint("merge")
