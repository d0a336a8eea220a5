"""Language-model scores from a probabilistic suffix tree.

The tree's nodes are contexts of the last words. The root holds smoothed word
frequencies; a longer context is kept if it is frequent enough and if its
next-word distribution diverges from that of its longest kept suffix, measured
by what the training text gains in likelihood. A node lists the next words that
it makes more likely and leaves the rest to its suffix, so each node's
distribution stays a distribution. A text is scored from the longest kept
context of each word.

A context needs a fixed count, as do the listed next words, whatever the size of
the corpus: so the tree grows with it, and stays spread over buckets like the
word counts. Each node and each listed word adds one number to a token's score:
a node what it leaves to its suffix, a listed word what it has beyond that. So a
text's score is the sum of what the buckets hold of its words, pairs and triples.
What is broadcast only saves look-ups and is bounded: the sums of the most
frequent grams, and a bit table that tells most grams that no bucket holds.
"""

from __future__ import annotations

import gc
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cellmend.llm.common import buckets, by_bucket, crc_of_id, map_arrow, pack, settled, unpack
from cellmend.llm.text_arrays import mix, words_of
from cellmend.operators.ordering import scratch_path

DEPTH = 2
LEAST_COUNT = 4
#: Share of all tokens from which a gram's sum is broadcast: at most 1 / HOT_SHARE a level.
HOT_SHARE = 2e-6
#: The bit table has 2 to the BITS bits, kept as 2 to the PARTS parts.
BITS, PARTS = 27, 6
#: A next word is listed if it is so many times likelier than the suffix has it.
LEAST_RATIO = 1.5
DISCOUNT = 0.5
#: Least gain of a kept context, in natural units.
LEAST_GAIN = 4.0
END = np.uint64(0x5AFE0FE0D0FADA7A)
_FLUSH = 1 << 19
#: Grams that a task adds up before it sends them.
_GRAM_FLUSH = 1 << 21
#: Texts whose tokens are held at a time.
_SLICE = 512
_STEP = np.uint64(0x9E3779B97F4A7C15)


def tokens_of(column):
    """(rows, hashes of all tokens, texts + 1 offsets): words, then one end each."""
    for start in range(0, len(column), _SLICE):
        for words in words_of(column.slice(start, _SLICE), lower=True):
            n = words.counts + 1
            at = np.concatenate([[0], np.cumsum(n)])
            out = np.empty(at[-1], np.uint64)
            end = np.zeros(at[-1], bool)
            end[at[1:] - 1] = True
            out[end], out[~end] = END, words.hashes
            yield words.rows + start, out, at


def _filled(at: np.ndarray) -> np.ndarray:
    """The buckets with anything in them, by their n + 1 limits."""
    return np.flatnonzero(np.diff(at)).astype(np.int32)


def _cut(x: np.ndarray, at: np.ndarray) -> list[bytes]:
    """What each of those buckets holds."""
    return [pack(x[at[b]:at[b + 1]]) for b in _filled(at)]


def _counted(docs: DataFrame, keys_of, n_buckets: int) -> DataFrame:
    """``(bucket, keys, counts, n)``: how often each key occurs, packed by bucket.
    ``keys_of(hashes, offsets)`` gives the keys of a run of texts. Counts are
    added up within a task before they are sent."""
    def partial(batches):
        held, size = [], 0

        def flush():
            keys, n = np.unique(np.concatenate(held), return_counts=True)
            order, at = by_bucket(keys.view(np.uint64), n_buckets)
            keys, n = keys[order], n[order].astype(np.uint32)
            return {"bucket": _filled(at), "keys": _cut(keys, at), "counts": _cut(n, at)}

        for batch in batches:
            for _, hashes, at in tokens_of(batch.column("text")):
                held.append(keys_of(hashes, at))
                size += len(held[-1])
                if size >= _FLUSH:
                    yield flush()
                    held, size = [], 0
        if size:
            yield flush()

    return (map_arrow(docs.select("text"), partial, "bucket int, keys binary, counts binary")
            .groupBy("bucket").applyInArrow(_added, "bucket int, keys binary, counts binary, n long"))


def _added(batch: pa.Table) -> pa.Table:
    keys, counts = unpack(batch["keys"], np.uint64), unpack(batch["counts"], np.uint32).astype(np.int64)
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    counts = np.add.reduceat(counts, first) if len(first) else counts
    return pa.table({"bucket": batch["bucket"].slice(0, 1), "keys": [pack(keys[first])],
                     "counts": [pack(counts)], "n": [len(first)]},
                    schema=pa.schema([("bucket", pa.int32()), ("keys", pa.binary()),
                                      ("counts", pa.binary()), ("n", pa.int64())]))


def _frequent(counted: DataFrame, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(keys in order, counts) of what occurs ``least`` times."""
    def rows(batches):
        for batch in batches:
            keys, counts = unpack(batch.column("keys"), np.uint64), unpack(batch.column("counts"), np.int64)
            keep = counts >= least
            yield {"key": keys[keep].view(np.int64), "n": counts[keep]}

    table = map_arrow(counted.select("keys", "counts"), rows, "key long, n long").toArrow()
    keys, n = table["key"].to_numpy().view(np.uint64), table["n"].to_numpy()
    order = np.argsort(keys)
    return keys[order], n[order]


def _place(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Index of each key, -1 if it is not there; each distinct key is sought once."""
    if not len(sorted_keys) or not len(keys):
        return np.full(len(keys), -1, np.int64)
    distinct, back = np.unique(keys, return_inverse=True)
    at = np.minimum(np.searchsorted(sorted_keys, distinct), len(sorted_keys) - 1)
    return np.where(sorted_keys[at] == distinct, at, -1)[back]


def _word_counts(docs: DataFrame, n_buckets: int) -> tuple[DataFrame, int, int]:
    """Counts of all words by bucket, their sum, and how many words there are."""
    counts = settled(_counted(docs, lambda hashes, at: hashes, n_buckets))
    sums = map_arrow(counts.select("counts"), _totals, "total long").agg(F.sum("total").alias("t")).first()
    distinct = counts.agg(F.sum("n").alias("v")).first()["v"]
    return counts, int(sums["t"] or 0), int(distinct or 0)


def _totals(batches):
    for batch in batches:
        yield {"total": [int(unpack(batch.column("counts"), np.int64).sum())]}


def _tidied(spark) -> None:
    """Let Spark's cleaner delete the shuffle files of tables that are settled or
    no longer referred to; it acts when the driver's garbage is collected."""
    gc.collect()
    spark.sparkContext._jvm.java.lang.System.gc()


def gram_keys(pre: np.ndarray, suf: np.ndarray) -> np.ndarray:
    """One number for each gram, from those of the gram without its last and
    without its first word; a single word stands for itself."""
    return mix(pre * _STEP + suf)


def grams_of(hashes: np.ndarray, at: np.ndarray, most: int):
    """For runs of 1, 2 .. ``most`` tokens within a text: (index of the last
    token, keys, keys without the last word, keys without the first)."""
    inside = np.arange(len(hashes)) - np.repeat(at[:-1], np.diff(at))
    ends, keys = np.arange(len(hashes)), hashes
    yield ends, keys, None, None
    for n in range(2, most + 1):
        # ``keys`` are by last token: those of a run and of the one a token before it.
        whole = np.zeros(len(hashes), np.uint64)
        whole[ends] = keys
        ends = np.flatnonzero(inside >= n - 1)
        pre, suf = whole[ends - 1], whole[ends]
        keys = gram_keys(pre, suf)
        yield ends, keys, pre, suf


def _in_table(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each key may be among those of the bit table."""
    place = keys >> np.uint64(64 - BITS)
    return (table[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def bit_table(grams: DataFrame) -> np.ndarray:
    """Bits of all grams' keys, set part by part; its size never depends on the
    grams, only how many others it lets pass."""
    def places(batches):
        held, size = [], 0

        def flush():
            place = np.unique(np.concatenate(held) >> np.uint64(64 - BITS)).astype(np.uint32)
            limits = np.searchsorted(place >> np.uint32(BITS - PARTS), np.arange((1 << PARTS) + 1))
            return {"part": _filled(limits), "places": _cut(place, limits)}

        for batch in batches:
            held.append(batch.column("key").to_numpy().view(np.uint64))
            size += len(held[-1])
            if size >= _FLUSH:
                yield flush()
                held, size = [], 0
        if size:
            yield flush()

    def joined(table: pa.Table) -> pa.Table:
        bits = np.zeros(1 << (BITS - PARTS), bool)
        for places in table["places"]:
            bits[np.frombuffer(places.as_buffer(), np.uint32) & np.uint32(len(bits) - 1)] = True
        return pa.table({"part": table["part"].slice(0, 1), "bits": [pack(np.packbits(bits, bitorder="little"))]},
                        schema=pa.schema([("part", pa.int32()), ("bits", pa.binary())]))

    out = np.zeros((1 << PARTS, 1 << (BITS - PARTS - 3)), np.uint8)
    for row in map_arrow(grams.select("key"), places, "part int, places binary").groupBy("part").applyInArrow(
            joined, "part int, bits binary").collect():
        out[row["part"]] = np.frombuffer(row["bits"], np.uint8)
    return out.ravel()


def _gram_counts(docs: DataFrame, n: int, shorter: np.ndarray, n_buckets: int) -> DataFrame:
    """``(key, pre, suf, n)``: the grams of n words that occur LEAST_COUNT times.
    Only those are sent whose shorter grams may be such, by their bit table."""
    shared = docs.sparkSession.sparkContext.broadcast(shorter)

    def partial(batches):
        table, held, size = shared.value, [], 0

        def flush():
            pre, suf = (np.concatenate([h[k] for h in held]) for k in (0, 1))
            keys, first, counts = np.unique(gram_keys(pre, suf), return_index=True, return_counts=True)
            order, at = by_bucket(keys, n_buckets)
            first = first[order]
            return {"bucket": _filled(at), "pre": _cut(pre[first], at), "suf": _cut(suf[first], at),
                    "n": _cut(counts[order].astype(np.uint32), at)}

        for batch in batches:
            for _, hashes, at in tokens_of(batch.column("text")):
                *_, (_, _, pre, suf) = grams_of(hashes, at, n)
                wanted = _in_table(table, suf) & _in_table(table, pre)
                held.append((pre[wanted], suf[wanted]))
                size += len(held[-1][0])
                if size >= _GRAM_FLUSH:
                    yield flush()
                    held, size = [], 0
        if size:
            yield flush()

    def added(table: pa.Table) -> pa.Table:
        pre, suf, counts = unpack(table["pre"], np.uint64), unpack(table["suf"], np.uint64), unpack(table["n"], np.uint32)
        keys = gram_keys(pre, suf)
        order = np.argsort(keys)
        keys = keys[order]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
        total = np.add.reduceat(counts[order].astype(np.int64), first) if len(first) else np.zeros(0, np.int64)
        often = total >= LEAST_COUNT
        of = lambda x: x[order][first][often].view(np.int64)
        return pa.table({"key": keys[first][often].view(np.int64), "pre": of(pre), "suf": of(suf), "n": total[often]})

    return (map_arrow(docs.select("text"), partial, "bucket int, pre binary, suf binary, n binary")
            .groupBy("bucket").applyInArrow(added, "key long, pre long, suf long, n long"))


def _judged(grams: DataFrame) -> DataFrame:
    """``grams``, which have ``n``, their context ``pre`` and its count ``own`` and the natural
    log ``suffix`` of what the suffix gives the word, with ``rest`` (natural log of
    what the node leaves to its suffix, null if it is not kept) and ``p`` (natural
    log of the word's probability, null if it is not listed)."""
    listed = F.col("n") / F.col("own") >= LEAST_RATIO * F.exp("suffix")
    grams = grams.withColumn("listed", listed)
    sums = (grams.groupBy("pre", "own")
            .agg(F.sum(F.when(F.col("listed"), F.col("n")).otherwise(0)).alias("given"),
                 F.sum(F.col("listed").cast("long")).alias("n_listed"))
            .withColumn("left", (F.col("own") - F.col("given") + DISCOUNT * F.col("n_listed")) / F.col("own")))
    p = F.when(F.col("listed"), F.log((F.col("n") - DISCOUNT) / F.col("own") + F.col("left") * F.exp("suffix")))
    grams = grams.join(sums.select("pre", "left", "given", "n_listed"), "pre").withColumn("p", p)
    kept = (grams.groupBy("pre", "own", "given", "left", "n_listed")
            .agg(F.sum(F.col("n") * (F.col("p") - F.col("suffix"))).alias("won"))
            .filter((F.col("n_listed") > 0) & (F.col("left") > 0) & (
                F.col("won") + (F.col("own") - F.col("given")) * F.log(F.greatest("left", F.lit(1e-300))) >= LEAST_GAIN))
            .select("pre", F.log("left").alias("rest")))
    return (grams.drop("left", "given", "n_listed", "listed").join(kept, "pre", "left")
            .withColumn("p", F.when(F.col("rest").isNotNull(), F.col("p"))))


def _written(df: DataFrame, label: str) -> DataFrame:
    """A table written once; its columns are packed, unlike a checkpoint's rows."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def model(docs: DataFrame, n_buckets: int, depth: int) -> tuple[DataFrame, DataFrame, int, int]:
    """(``(key, n, value)`` of each gram that occurs LEAST_COUNT times, counts of
    all words by bucket, their sum, number of words). The values of a text's
    grams add up to the decimal log of its probability over the root's."""
    counts, total, distinct = _word_counts(docs, n_buckets)

    def frequent(batches):
        for batch in batches:
            keys, n = unpack(batch.column("keys"), np.uint64), unpack(batch.column("counts"), np.int64)
            yield {"key": keys[n >= LEAST_COUNT].view(np.int64), "n": n[n >= LEAST_COUNT]}

    # Settled tables between the steps keep a task at one Python worker.
    words = settled(map_arrow(counts.select("keys", "counts"), frequent, "key long, n long"))
    root = F.log((F.col("n") + 0.1) / (total + 0.1 * (distinct + 1)))
    in_decimal = lambda value: (F.coalesce(value, F.lit(0.0)) / float(np.log(10))).alias("value")
    # ``given``: natural log of what the longest kept context gives the last word, over the root.
    last = words.select("key", root.alias("root"), F.lit(0.0).alias("given"))
    shorter, values = words.withColumn("more", F.lit(0.0)), []
    judged = nodes = None
    for length in range(2, depth + 2):
        table = bit_table(shorter)
        found = _written(_gram_counts(docs, length, table, n_buckets), "grams")
        _tidied(docs.sparkSession)
        own = shorter.select(F.col("key").alias("pre"), F.col("n").alias("own"))
        below = last.select(F.col("key").alias("suf"), "root", F.col("given").alias("less"))
        given = F.coalesce(F.col("p") - F.col("root"), F.col("rest") + F.col("less"), F.col("less"))
        more = F.coalesce(F.col("p") - F.col("root") - F.col("rest") - F.col("less"), F.lit(0.0))
        judged = _written(_judged(found.join(own, "pre").join(below, "suf").withColumn(
            "suffix", F.col("root") + F.col("less"))).select(
            "key", "pre", "n", "root", given.alias("given"), more.alias("more"), "rest"), "judged")
        del found, own, below
        _tidied(docs.sparkSession)
        nodes = judged.filter("rest IS NOT NULL").groupBy(F.col("pre").alias("key")).agg(F.first("rest").alias("leave"))
        # What a shorter gram adds as a listed word, and as the node of the next word.
        values.append(settled(shorter.join(nodes, "key", "left").select(
            "key", "n", in_decimal(F.coalesce("leave", F.lit(0.0)) + F.col("more")))))
        last, shorter = judged.select("key", "root", "given"), judged.select("key", "n", "more")
    values.append(shorter.select("key", "n", in_decimal(F.col("more"))))
    del last, nodes
    _tidied(docs.sparkSession)
    out = values[0]
    for more in values[1:]:
        out = out.unionByName(more)
    return out, counts, total, distinct


#: Tokens whose grams one bucket answers for.
ASKED_TOKENS = 1 << 22


def _fewer(n_buckets: int, wanted: int) -> int:
    """A number of buckets that divides ``n_buckets``, so that a key's bucket
    follows from its old one; ``wanted`` or a little more."""
    return next(n_buckets // k for k in range(max(1, n_buckets // max(wanted, 1)), 0, -1) if n_buckets % k == 0)


_PARTS = ("rows", "ids", "nameless", "held_out", "n_tokens", "known", "base", "gain")


def score_texts(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)``,
    one row per row of ``docs``.

    Learned from rows whose crc32 of the id is not 0 modulo 10. Tokens are words
    with A-Z lower-cased, and one end per text. ``base_score`` is the sum of
    log10 of smoothed word frequencies, ``score`` that of the suffix tree; both
    are over the whole text.

    A null text counts as empty: its one token is the end. A null ``doc_id`` is
    scored, counts as not held out and is not learned from. Repeated rows are
    learned and scored as often as they occur. Other columns are not read. With
    nothing to learn from, every word is unknown. An empty table gives an empty
    result.
    """
    n_buckets = buckets(docs.sparkSession)
    out = F.pmod(crc_of_id(), F.lit(10)) == 0
    values, counts, total, distinct = model(docs.filter(~out), n_buckets, depth)
    log_root = lambda n: np.log10((n + 0.1) / (total + 0.1 * (distinct + 1)))
    hot = max(LEAST_COUNT, int(np.ceil(total * HOT_SHARE)))
    words, word_counts = _frequent(counts, hot)
    often = values.filter(F.col("n") >= hot).select("key", "value").toArrow()
    hot_keys, hot_values = often["key"].to_numpy().view(np.uint64), often["value"].to_numpy()
    order = np.argsort(hot_keys)
    some = settled(values.filter("value <> 0"))
    # Fewer buckets than counts need: as many as the texts' tokens ask for.
    n_asked = _fewer(n_buckets, max(docs.sparkSession.sparkContext.defaultParallelism,
                                    -(-total // ASKED_TOKENS)))
    shared = docs.sparkSession.sparkContext.broadcast(
        (words, log_root(word_counts), hot_keys[order], hot_values[order], bit_table(some)))

    def dealt(batches):
        """The sums by bucket, beside the word counts."""
        held, size = [], 0

        def flush():
            keys, sums = (np.concatenate([h[i] for h in held]) for i in (0, 1))
            order, at = by_bucket(keys, n_asked)
            none = pa.nulls(len(_filled(at)), pa.binary())
            return {"bucket": _filled(at), "keys": none, "counts": none,
                    "grams": _cut(keys[order], at), "sums": _cut(sums[order], at)}

        for batch in batches:
            held.append((batch.column("key").to_numpy().view(np.uint64), batch.column("value").to_numpy()))
            size += len(held[-1][0])
            if size >= _FLUSH:
                yield flush()
                held, size = [], 0
        if size:
            yield flush()

    known = counts.select((F.col("bucket") % n_asked).alias("bucket"), "keys", "counts", F.lit(None).cast("binary").alias("grams"),
                          F.lit(None).cast("binary").alias("sums")).unionByName(
        map_arrow(some.select("key", "value").coalesce(n_asked), dealt,
                  "bucket int, keys binary, counts binary, grams binary, sums binary"))

    def ask(batches):
        """What is known in the task, and the rare words and grams for the buckets."""
        words, roots, hot_keys, hot_values, table = shared.value
        roots, hot_values = np.append(roots, 0), np.append(hot_values, 0)
        held, size = [], 0

        def flush():
            info = {name: np.concatenate([h[2][name] for h in held]) for name in _PARTS}
            first = info["rows"].min()
            dealt, full = {}, set()
            for k, (name, owner) in enumerate((("words", "owners"), ("grams", "gram_owners"))):
                keys, owners = (np.concatenate([h[k][i] for h in held]) for i in (0, 1))
                order, at = by_bucket(keys, n_asked)
                # A task's rows are numbered one behind the other: 4 bytes tell them apart.
                here = _filled(at).tolist()
                dealt[name] = dict(zip(here, _cut(keys[order], at)))
                dealt[owner] = dict(zip(here, _cut((owners[order] - first).astype(np.uint32), at)))
                full.update(here)
            # What is known of the texts goes along with one of the buckets.
            turn = int(first) % n_asked
            full = sorted(full | {turn})
            return {"bucket": np.array(full, np.int32), "first": np.full(len(full), first)} | {
                name: [parts.get(b, b"") for b in full] for name, parts in dealt.items()} | {
                name: [pack(info[name]) if b == turn else None for b in full] for name in _PARTS}

        for batch in batches:
            keys, ids = batch.column("row").to_numpy(), batch.column("doc_id")
            nameless = ids.is_null().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(0).to_numpy()
            held_out = batch.column("held_out").to_numpy(zero_copy_only=False)
            for rows, hashes, at in tokens_of(batch.column("text")):
                word = _place(words, hashes)
                frequent = word >= 0
                owner = np.repeat(np.arange(len(rows)), np.diff(at))
                per_text = lambda x: np.bincount(owner, x, minlength=len(rows))
                gain, asked = np.zeros(len(rows)), [(np.zeros(0, np.uint64), np.zeros(0, np.int64))]
                for n, (ends, gram, _, _) in enumerate(grams_of(hashes, at, depth + 1), 1):
                    may = _in_table(table, gram)
                    gram, of = gram[may], owner[ends[may]]
                    place = _place(hot_keys, gram)
                    gain += np.bincount(of, hot_values[place], minlength=len(rows))
                    if n > 1:  # rare words are asked for anyway
                        asked.append((gram[place < 0], keys[rows][of[place < 0]]))
                info = {"rows": keys[rows], "ids": ids[rows], "nameless": nameless[rows],
                        "held_out": held_out[rows], "n_tokens": np.diff(at),
                        "known": per_text(frequent).astype(np.int64), "base": per_text(roots[word]),
                        "gain": gain}
                grams = tuple(np.concatenate([x[i] for x in asked]) for i in (0, 1))
                held.append(((hashes[~frequent], keys[rows][owner[~frequent]]), grams, info))
                size += int((~frequent).sum()) + len(grams[0]) + len(rows)
                if size >= _FLUSH:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    def answer(asked: pa.Table, known: pa.Table) -> pa.Table:
        """A row for each flush that asks: sums by text, packed, and what came along."""
        def asked_by(owners):
            sizes = [len(x.as_buffer()) // 4 for x in asked[owners]]
            return unpack(asked[owners], np.uint32).astype(np.int64) + (np.repeat(np.arange(len(sizes), dtype=np.int64), sizes) << 32)

        words, owners = unpack(asked["words"], np.uint64), asked_by("owners")
        keys, n = unpack(known["keys"], np.uint64), unpack(known["counts"], np.int64)
        order = np.argsort(keys)
        place = _place(keys[order], words)
        found = np.where(place >= 0, np.append(n[order], 0)[place], 0)
        # The sums of grams, and those of the rare words.
        grams, sums = unpack(known["grams"], np.uint64), unpack(known["sums"], float)
        order = np.argsort(grams)
        grams, sums = grams[order], np.append(sums[order], 0)
        asked_grams, gram_owners = unpack(asked["grams"], np.uint64), asked_by("gram_owners")
        texts, back = np.unique(np.r_[owners, gram_owners], return_inverse=True)
        of_words = back[:len(owners)]
        base = np.bincount(of_words, log_root(found), minlength=len(texts))
        seen = np.bincount(of_words, found > 0, minlength=len(texts)).astype(np.uint32)
        gain = np.bincount(back, np.r_[sums[_place(grams, words)], sums[_place(grams, asked_grams)]], minlength=len(texts))
        at = np.searchsorted(texts, np.arange(asked.num_rows + 1, dtype=np.int64) << 32)
        out = asked.select(["first", *_PARTS])
        for name, x in (("texts", texts.astype(np.uint32)), ("of_base", base), ("of_seen", seen), ("of_gain", gain)):
            out = out.append_column(name, pa.array([pack(x[i:j]) for i, j in zip(at[:-1], at[1:])], pa.binary()))
        return out

    def together(parts: pa.Table) -> pa.Table:
        """The texts of one flush, with the sums of all buckets."""
        kinds = {"nameless": bool, "held_out": bool, "base": float, "gain": float}
        info = {name: unpack(parts[name], kinds.get(name, np.int64)) for name in _PARTS}
        order = np.argsort(info["rows"])
        info = {name: x[order] for name, x in info.items()}
        at = np.searchsorted(info["rows"], unpack(parts["texts"], np.uint32).astype(np.int64) + parts["first"][0].as_py())
        plus = lambda name, kind: np.bincount(at, unpack(parts[name], kind), minlength=len(order))
        return pa.table({
            "doc_id": pa.array(info["ids"], mask=info["nameless"]), "held_out": info["held_out"],
            "n_tokens": info["n_tokens"], "n_known": info["known"] + plus("of_seen", np.uint32).astype(np.int64),
            "base_score": info["base"] + plus("of_base", float), "gain": info["gain"] + plus("of_gain", float)})

    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id",
                       F.coalesce(out, F.lit(False)).alias("held_out"), "text")
    asked = map_arrow(rows, ask, "bucket int, first long, words binary, owners binary, grams binary, gram_owners binary, "
                      + ", ".join(f"{name} binary" for name in _PARTS))
    info = ", ".join(f"{name} binary" for name in _PARTS)
    parts = asked.groupBy("bucket").cogroup(known.groupBy("bucket")).applyInArrow(
        answer, f"first long, {info}, texts binary, of_base binary, of_seen binary, of_gain binary")
    return parts.groupBy("first").applyInArrow(
        together, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, gain double"
    ).select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"),
             "base_score", (F.col("base_score") + F.col("gain")).alias("score"))
