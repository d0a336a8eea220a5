"""Token counts of whole texts with a two-tier lookup in the map task.

The lengths of frequent pre-tokens are broadcast in a compact table; what it
lacks is encoded once per worker and cached there. No pre-token is shuffled.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, functions as F

from cellmend.llm.common import map_arrow
from cellmend.llm.pretokens import Encoder, Table, cut_runs
from cellmend.llm.text_arrays import span_hashes

#: About how many texts the frequent pre-tokens are taken from, and the longest of them.
#: They decide what is quick to find, never what is counted.
SAMPLE_TEXTS = 1000
SAMPLE_CHARS = 50_000
#: Entries of the broadcast table: 10 bytes each.
FREQUENT = 1 << 16


def frequent_lengths(docs: DataFrame, path: str, words: bool) -> Table:
    """The first tier: lengths of the sample's most frequent pre-tokens. About
    SAMPLE_TEXTS texts are drawn evenly from all partitions."""
    drawn = min(1.0, SAMPLE_TEXTS / max(docs.count(), 1))
    sample = docs.select("text").sample(drawn, seed=1).filter(F.length("text") <= SAMPLE_CHARS).toArrow()
    found: Counter = Counter()
    texts: dict[int, str] = {}
    for cut in cut_runs(sample["text"], words):
        keys, at, n = np.unique(span_hashes(cut.codes, cut.starts, cut.ends),
                                return_index=True, return_counts=True)
        for key, i, k in zip(keys.tolist(), at, n.tolist()):
            found[key] += k
            if key not in texts:
                texts[key] = cut.codes_text(cut.starts[i], cut.ends[i])
    best = sorted(key for key, _ in found.most_common(FREQUENT))
    lengths = [len(x) for x in Encoder(path, words)._encode([texts[k] for k in best])] if best else []
    return Table(np.array(best, np.uint64), np.array(lengths, np.uint16))


def count_tokens(docs: DataFrame, tokenizer_path: str, words: bool = True, limit: int = 2048) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)``, one row per row of ``docs``.

    ``n_tokens`` is what the tokenizer gives for the whole text without added
    special tokens, truncation or padding. ``words`` tells the tokenizer's
    pattern: words without white space, or byte-level pieces that keep it.

    A null text counts as empty: 0 bytes, 0 tokens. A null ``doc_id`` and
    repeated rows stay as they are; other columns are not read. An empty table
    gives an empty result.
    """
    spark = docs.sparkSession
    tier = frequent_lengths(docs, tokenizer_path, words)
    shared = spark.sparkContext.broadcast((tier.keys, tier.lengths.astype(np.uint16)))

    def count(batches):
        keys, lengths = shared.value
        encoder = Encoder.of_worker(tokenizer_path, words, Table(keys, lengths))
        for batch in batches:
            n = np.zeros(batch.num_rows, np.int64)
            for rows, found in encoder.lengths(batch.column("text")):
                n[rows] = found
            yield {"doc_id": batch.column("doc_id"), "n_bytes": batch.column("n_bytes"), "n_tokens": n}

    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    rows = docs.select("doc_id", "text", n_bytes.alias("n_bytes"))
    kind = dict(rows.dtypes)["doc_id"]
    return map_arrow(rows, count, f"doc_id {kind}, n_bytes long, n_tokens long").withColumn(
        "over_limit", F.col("n_tokens") > limit)
