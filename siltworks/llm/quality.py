"""Quality by perplexity under an interpolated modified Kneser-Ney model of character n-grams."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.llm.common import stage, staged_in_buckets, text_of

#: The model is of ORDER-grams of symbols: begin, end, unknown, and every character at its code point plus FIRST, in BITS bits.
#: All characters of the trusted text are its alphabet, which counts as SYMBOLS symbols at least.
SYMBOLS, ORDER, BITS = 64, 4, 21
BEGIN, END, UNKNOWN, FIRST = 0, 1, 2, 3
#: Characters of a block: the different grams of its documents are joined with the counts together.
BLOCK = 16_000_000
#: Texts above this share of the trusted texts of their language are rejected. The share is taken of the
#: trusted texts that the model wasn't trained on (crc32 of the id, mod CALIBRATE, is 0), as it knows the others too well.
QUANTILE, CALIBRATE = 0.995, 5
#: Ids of trusted texts are broadcast up to so many rows (8 bytes each); beyond, they are joined by a shuffle.
IDS = 2_000_000
#: Characters that a worker handles at a time, and places of a table that finds the different ones among them without sorting.
SEGMENT, TABLE = 2_000_000, 1 << 25


def _symbols(text: str):
    import numpy as np

    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64) + FIRST


def _segments(texts) -> Iterator[tuple[list[str], list[int]]]:
    """(texts, their row) of about SEGMENT characters."""
    held, rows, size = [], [], 0
    for k, t in enumerate(texts):
        held.append(t.as_py())
        rows.append(k)
        size += len(held[-1])
        if size > SEGMENT:
            yield held, rows
            held, rows, size = [], [], 0
    if held:
        yield held, rows


def _distinct(g, bound: int):
    """np.unique(g, return_inverse=True) of numbers below bound, by a table where that is small."""
    import numpy as np

    if bound > TABLE:
        return np.unique(g, return_inverse=True)
    seen = np.zeros(bound, bool)
    seen[g] = True
    own = np.flatnonzero(seen)
    rank = np.empty(bound, np.int32)
    rank[own] = np.arange(len(own), dtype=np.int32)
    return own, rank[g]


def _grams(texts: list[str]):
    """The different grams of texts as contexts (symbols of BITS bits each) and symbols; which of them each predicted symbol has, one text after the other; and how many each text has (its length and the end)."""
    import numpy as np

    parts, lengths = [], []
    for t in texts:
        own = _symbols(t)
        parts += [np.full(ORDER - 1, BEGIN, np.int64), own, np.array([END])]
        lengths.append(len(own) + 1)
    s = np.concatenate(parts)
    # windows that end at padding predict nothing
    keep = s[ORDER - 1 :] != BEGIN
    seen = np.zeros(1 << BITS, bool)
    seen[s] = True
    alphabet = np.flatnonzero(seen)
    size, n = len(alphabet), len(s) - ORDER + 1
    if size**ORDER < 1 << 63:
        rank = (np.cumsum(seen) - 1)[s]
        g = np.zeros(n, np.int64)
        for k in range(ORDER):
            g = g * size + rank[k : k + n]
        own, which = _distinct(g[keep], size**ORDER)
        symbols, contexts = alphabet[own % size], np.zeros(len(own), np.int64)
        for k in range(ORDER - 1):
            contexts |= alphabet[own // size ** (k + 1) % size] << (BITS * k)
    else:
        c = np.zeros(n, np.int64)
        for k in range(ORDER - 1):
            c = c << BITS | s[k : k + n]
        contexts, place = np.unique(c[keep], return_inverse=True)
        own, which = np.unique(place << BITS | s[ORDER - 1 :][keep], return_inverse=True)
        contexts, symbols = contexts[own >> BITS], own & ((1 << BITS) - 1)
    return contexts, symbols, which, np.array(lengths)


def _count_grams(batches) -> Iterator:
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        for held, _ in _segments(batch.column(0)):
            contexts, symbols, which, _ = _grams(held)
            n = np.bincount(which, minlength=len(contexts))
            for k in range(0, len(n), 200_000):
                part = slice(k, k + 200_000)
                yield pa.RecordBatch.from_arrays([pa.array(contexts[part]), pa.array(symbols[part]), pa.array(n[part])], names=["context", "symbol", "n"])


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts of counts 1, 2 and more, from how many grams have the counts 1 to 4; 0.5, 1, 1.5 where these are too few to tell."""
    if not (n1 and n2 and n3 and n4):
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    found = 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3
    return tuple(min(max(d, 0.05), k - 0.05) for k, d in enumerate(found, 1))


class Model:
    """size: of the alphabet; by order from 1 on, contexts: staged (context, weight), and grams: staged (context, symbol, p)."""

    def __init__(self, size: int, contexts: list[DataFrame], grams: list[DataFrame]):
        self.size, self.contexts, self.grams = size, contexts, grams

def _last(context: Column, order: int) -> Column:
    """The context that an order sees of a longer one."""
    return context.bitwiseAND(F.lit((1 << BITS * (order - 1)) - 1).cast("long"))


def train(trusted: DataFrame) -> Model:
    """An interpolated modified Kneser-Ney model of ORDER-grams of characters from all of trusted(text).

    Executors count grams in their partitions; the counts meet in shuffles by gram. An order's grams are joined with the totals of their contexts and
    with the next lower order's probabilities, by key. Lower orders count the different symbols before
    a gram. The end of a text is a symbol. Without text, all symbols are equally likely.
    """
    counted = trusted.mapInArrow(_count_grams, "context long, symbol long, n long").groupBy("context", "symbol").agg(F.sum("n").alias("n"))
    counts = {ORDER: stage(counted, "quality-counts")}
    for k in range(ORDER - 1, 0, -1):
        counts[k] = stage(counts[k + 1].groupBy(_last(F.col("context"), k).alias("context"), "symbol").agg(F.count("*").alias("n")), "quality-counts")
    size = max(SYMBOLS, FIRST + counts[1].where(F.col("symbol") >= FIRST).count())
    contexts, grams = [], []
    for k in range(1, ORDER + 1):
        of = counts[k].agg(*(F.count(F.when(F.col("n") == c, 1)) for c in (1, 2, 3, 4))).collect()[0]
        d = discounts(*of)
        off = F.when(F.col("n") == 1, d[0]).when(F.col("n") == 2, d[1]).otherwise(d[2])
        totals = stage(counts[k].groupBy("context").agg(F.sum("n").alias("total"), (F.sum(off) / F.sum("n")).alias("weight")), "quality-contexts")
        seen = counts[k].join(totals, "context").select("context", "symbol", ((F.col("n") - off) / F.col("total")).alias("own"), "weight")
        if k == 1:
            p = seen.select("context", "symbol", (F.col("own") + F.col("weight") / (size - 1)).alias("p"))
        else:
            low = grams[-1].select(F.col("context").alias("rest"), F.col("symbol").alias("s"), F.col("p").alias("p_low"))
            p = seen.join(low, (_last(F.col("context"), k - 1) == F.col("rest")) & (F.col("symbol") == F.col("s"))).select("context", "symbol", (F.col("own") + F.col("weight") * F.col("p_low")).alias("p"))
        contexts.append(totals.select("context", "weight"))
        grams.append(stage(p, "quality-probabilities"))
    return Model(size, contexts, grams)


def _packed(ids, langs, texts: list[str]) -> bytes:
    import pyarrow as pa

    batch = pa.record_batch([ids, langs, pa.array(texts, pa.string())], names=["doc_id", "lang", "text"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=3))) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _ordered(contexts, symbols):
    """The different pairs of contexts and symbols, in order."""
    import numpy as np

    by = np.lexsort((symbols, contexts))
    contexts, symbols = contexts[by], symbols[by]
    new = np.ones(len(by), bool)
    new[1:] = (contexts[1:] != contexts[:-1]) | (symbols[1:] != symbols[:-1])
    return contexts[new], symbols[new]


def _blocks(batches) -> Iterator:
    """For each block of documents (about BLOCK characters of a partition) a row for each different gram, and its documents, packed, in rows without a gram."""
    import numpy as np
    import pyarrow as pa
    from pyspark import TaskContext

    names = ["block", "context", "symbol", "packed"]
    block, size, grams = TaskContext.get().partitionId() << 32, 0, []

    def close():
        contexts, symbols = _ordered(*(np.concatenate(c) for c in zip(*grams, strict=True)))
        for k in range(0, len(contexts), 200_000):
            c, own = contexts[k : k + 200_000], symbols[k : k + 200_000]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(c), block)), pa.array(c), pa.array(own), pa.nulls(len(c), pa.binary())], names=names)

    for batch in batches:
        for held, rows in _segments(batch.column(1)):
            contexts, symbols, _, lengths = _grams(held)
            grams.append((contexts, symbols))
            packed = _packed(batch.column(0).take(pa.array(rows)), batch.column(2).take(pa.array(rows)), held)
            yield pa.RecordBatch.from_arrays([pa.array([block]), *[pa.nulls(1, pa.int64())] * 2, pa.array([packed], pa.binary())], names=names)
            size += int(lengths.sum())
            if size > BLOCK:
                yield from close()
                block, size, grams = block + 1, 0, []
    if grams:
        yield from close()


def _scores(documents, grams):
    """doc_id, lang, perplexity of a block's packed documents, given its grams and their logarithms."""
    import numpy as np
    import pyarrow as pa

    contexts, symbols, logs = (grams.column(k).to_numpy() for k in ("context", "symbol", "log"))
    known = np.unique(contexts)
    keys = np.searchsorted(known, contexts) << BITS | symbols
    by = np.argsort(keys)
    keys, logs, out = keys[by], logs[by], []
    for packed in documents.column("packed"):
        table = pa.ipc.open_stream(packed.as_buffer()).read_all()
        contexts, symbols, which, lengths = _grams(table.column("text").to_pylist())
        own = logs[np.searchsorted(keys, np.searchsorted(known, contexts) << BITS | symbols)]
        sums = np.add.reduceat(own[which], np.cumsum(lengths) - lengths)
        out.append(table.drop_columns("text").append_column("perplexity", pa.array(np.exp(-sums / lengths))))
    return pa.concat_tables(out)


def _perplexities(rows: DataFrame, model: Model, id_type: str) -> DataFrame:
    """doc_id, lang, perplexity of rows(doc_id, text, lang).

    The different grams of all blocks are joined with the counts of each order, shard by shard; every block then gets
    the logarithms of its own grams by another join, and sums them for each of its documents. Blocks are written in buckets, so that
    the packed documents wait there and only grams travel.
    """
    found = staged_in_buckets(rows.mapInArrow(_blocks, "block long, context long, symbol long, packed binary"), "quality-blocks", "block")
    grams = found.where("symbol IS NOT NULL").select("block", "context", "symbol")
    p = grams.select("context", "symbol").distinct().withColumn("p", F.lit(1 / (model.size - 1)))
    for k, (contexts, own) in enumerate(zip(model.contexts, model.grams, strict=True), 1):
        contexts, own = contexts.select(F.col("context").alias("c"), "weight"), own.select(F.col("context").alias("c2"), F.col("symbol").alias("s2"), F.col("p").alias("own"))
        if k <= 2:  # a row for each character at most
            contexts = F.broadcast(contexts)
        p = p.join(contexts, _last(F.col("context"), k) == F.col("c"), "left").join(own, (_last(F.col("context"), k) == F.col("c2")) & (F.col("symbol") == F.col("s2")), "left")
        p = p.select("context", "symbol", F.coalesce("own", F.coalesce("weight", F.lit(1.0)) * F.col("p")).alias("p"))
    logs = stage(p.select("context", "symbol", F.log("p").alias("log")), "quality-logs")
    fetched = grams.join(logs, ["context", "symbol"]).select(F.col("block").alias("of"), "context", "symbol", "log")
    packed = found.where("symbol IS NULL").select("block", "packed")
    return packed.groupBy("block").cogroup(fetched.groupBy("of")).applyInArrow(_scores, f"doc_id {id_type}, lang string, perplexity double")


def calibrates(id_col: str):
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % CALIBRATE == 0, F.lit(False))


def trusted_texts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """text of all documents that a label calls good, but for those that calibrate the thresholds. An id labelled both ways isn't trusted; null labels don't count."""
    good = trusted_ids(labels, id_col, label_col)
    return docs.where(~calibrates(id_col)).select(F.col(id_col).alias("__id"), text_of(text_col).alias("text")).join(good, "__id", "left_semi").select("text")


def trusted_ids(labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> DataFrame:
    good = labels.where(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("__id")).agg(F.min(label_col).alias("q")).where("q = 1").select("__id")
    good = stage(good, "quality-trusted")
    return F.broadcast(good) if good.count() <= IDS else good


def perplexity_filter(docs: DataFrame, labels: DataFrame, model: Model | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", quantile: float = QUANTILE) -> DataFrame:
    """doc_id, perplexity, threshold, kept: one row per input row.

    The threshold is the quantile of the trusted texts of the row's language, to
    0.01 % of ranks; a language without trusted texts (null is one of its own) takes the quantile of all
    of them, and without any trusted text all rows stay. Null and empty texts have the perplexity of a
    text's end at its beginning. Repeated rows are judged each; an empty table gives no rows.
    """
    model = model or train(trusted_texts(docs, labels, id_col, text_col))
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"), F.coalesce(F.col(lang_col), F.lit("\0")).alias("lang"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    scored = stage(_perplexities(rows, model, id_type), "quality-scores")
    good = scored.where(calibrates("doc_id")).join(trusted_ids(labels, id_col), F.col("doc_id") == F.col("__id"), "left_semi")
    cut = F.percentile_approx("perplexity", quantile, 10_000)
    by_lang = good.groupBy(F.col("lang").alias("__lang")).agg(cut.alias("own"))
    by_lang = stage(by_lang, "quality-thresholds")
    if by_lang.count() <= 100_000:
        by_lang = F.broadcast(by_lang)
    overall = good.agg(cut).collect()[0][0]
    threshold = F.coalesce("own", F.lit(overall).cast("double"))
    out = scored.join(by_lang, F.col("lang") == F.col("__lang"), "left")
    return out.select("doc_id", "perplexity", threshold.alias("threshold"), F.coalesce(F.col("perplexity") <= threshold, F.lit(True)).alias("kept"))
