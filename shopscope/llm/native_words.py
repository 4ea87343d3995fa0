"""Words, shingles and bigrams of texts as Spark expressions.

Words are runs of letters and digits of the text in lower case. Null texts count as empty.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What separates words, for Spark and for the SQL that checks it.
BETWEEN = r"[^\p{L}\p{N}]+"


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), BETWEEN), "")


def shingles(word_hashes: Column, size: int) -> Column:
    """Hashes of each ``size`` words in a row; fewer words, but at least one, are one shingle. Takes hashed words, as a column that is not computed anew for each shingle."""
    count = F.size(word_hashes)
    many = F.transform(F.sequence(F.lit(0), count - size), lambda i: F.xxhash64(*[F.get(word_hashes, i + n) for n in range(size)]))
    few = F.array(F.aggregate(word_hashes, F.lit(1).cast("long"), lambda held, word: F.xxhash64(held, word)))
    return F.when(count >= size, many).when(count > 0, few).otherwise(F.array().cast("array<bigint>"))
