"""Token counts by a two-tier lookup in the tasks; no pre-token is shuffled.

Tier one is a broadcast table from frequent pre-tokens to their number of tokens, tier two a bounded cache in each
Python worker; what neither knows is encoded by the tokenizer's own library, each distinct pre-token of a batch once.
Both tiers only remember what the library said, so they change the speed and never a count.

Defined cases: a null or empty text has 0 tokens and 0 bytes; repeated rows each get a row; an empty table gives an
empty result; other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from starloom.llm.common import arrow_batches, texts
from starloom.llm.pretokens import MARKER, pretokens, processor

#: Entries of the broadcast table, documents it is drawn from, entries of a worker's cache, longest remembered pre-token.
FREQUENT, SAMPLE_DOCUMENTS, CACHED, LONGEST = 65_536, 2_000, 200_000, 64


def frequent_lengths(docs: DataFrame, model: str, entries: int = FREQUENT, documents: int = SAMPLE_DOCUMENTS) -> dict[str, int]:
    """Token counts of the most frequent pre-tokens of a random sample of about ``documents`` rows; a warm start for the
    lookups, no statistic.  Words are counted in the tasks first, so the shuffle holds those of the sample at most."""
    share = min(1.0, documents / max(1, docs.count()))
    words = F.explode(F.split(F.replace("text", F.lit(MARKER), F.lit(" ")), " "))
    top = (
        texts(docs).sample(share, seed=1).select(words.alias("word")).where(F.length("word").between(1, LONGEST))
        .groupBy("word").count().orderBy(F.desc("count"), "word").limit(entries)
    )
    found = [r.word for r in top.collect()]
    return dict(zip(found, map(len, processor(model).encode(found, num_threads=1))))


class Counter:
    """Counts tokens of texts with a table of known lengths and a bounded memory of its own."""

    def __init__(self, model: str, known: dict[str, int], cached: int = CACHED):
        self.model, self.known, self.cached, self.recent = model, known, cached, {}

    def lengths(self, found: set[str]) -> dict[str, int]:
        """What the batch needs beyond the broadcast table."""
        recent = self.recent
        misses = [w for w in found if w not in recent]
        fresh = dict(zip(misses, map(len, processor(self.model).encode(misses, num_threads=1)))) if misses else {}
        batch = {w: recent[w] for w in found if w in recent} | fresh
        if len(recent) + len(fresh) > self.cached:
            recent.clear()
        recent.update({w: n for w, n in list(fresh.items())[: self.cached] if len(w) <= LONGEST})
        return batch

    def count(self, batch: pd.Series) -> pd.Series:
        split = [pretokens(t) for t in batch]
        counts = [list(map(self.known.get, words)) for words in split]
        missing = {w for words, own in zip(split, counts) if None in own for w, n in zip(words, own) if n is None}
        table = self.lengths(missing)
        for words, own in zip(split, counts):
            if None in own:
                own[:] = [table[w] if n is None else n for w, n in zip(words, own)]
        return pd.Series([sum(own) for own in counts], dtype="int64")


def token_counts(docs: DataFrame, model: str, limit: int = 4096, key: str = "doc_id", column: str = "text") -> DataFrame:
    """Per row: key, n_bytes (UTF-8), n_tokens, over_limit (more than ``limit`` tokens).

    ``model`` is the path of a SentencePiece model whose pieces carry the white-space marker at the start only.
    """
    spark = docs.sparkSession
    arrow_batches(spark)
    rows = texts(docs, key, column=column)
    table = spark.sparkContext.broadcast(frequent_lengths(rows, model))

    @F.pandas_udf(LongType())
    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = Counter(model, table.value)
        for batch in batches:
            yield counter.count(batch)

    counted = rows.select(key, F.octet_length("text").cast("long").alias("n_bytes"), tokens("text").alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
